from .exprs import *  # noqa: F401,F403

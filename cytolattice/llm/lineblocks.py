"""Main text of web pages by line-block distribution.

Markup is stripped to lines: a line is the text of one block of the page.  Text inside elements that never hold an
article (scripts, styles, menus, headers, footers, sidebars, notices, adverts, forms, comments) has no length of its own, nor has the text of links.  The
lengths of a sliding window of lines are summed; where the sum rises over a threshold the text surges, where it falls to nothing it
dives, and the lines between are the article.  Lines that an ``article`` or ``main`` element encloses weigh more: each of
them, its links too, surges by itself.  All stretches stay, with every line in them that is
not beside; headings count with their links.

Null, empty and unparsable pages give the empty text; rows are judged alone, so ties and repeated rows do not
matter; an empty table gives an empty table; columns named like the results are replaced.
"""

import html
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.functions import pandas_udf

from .text import parts

WINDOW, SURGE = 3, 40

# Fixed lists: elements by their meaning in the HTML standard.
RAW = frozenset("script style noscript template svg iframe object canvas textarea select head title".split())
ASIDE = frozenset("nav footer aside form dialog menu button fieldset".split())
#: Elements beside the article that some sites put around a whole page.
WRAPS = frozenset("form fieldset dialog".split())
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul""".split())
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words in class, id or role that name something beside the article.
BESIDE = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent notice alert popup modal
    nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer masthead header comment comments disqus respond reply
    replies related share sharing social newsletter subscribe subscription signup login search pagination pager widget toolbar
    complementary contentinfo""".split())
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)|<!--|<[!?/]")
ATTRIBUTES = re.compile(r"(?:[^\"'>]|\"[^\"]*\"|'[^']*')*+")
NAMED = re.compile(r"(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
WORDS = re.compile(r"[^a-z0-9]+")
SPACE = re.compile(r"\s+")
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}


class Line:
    """Text of one block: pieces, length of links, its innermost mark (later whether it lies beside the article), its article number, whether it is a heading."""

    __slots__ = ("pieces", "linked", "beside", "article", "heading", "said")

    def __init__(self, beside, article, heading):
        self.pieces, self.linked, self.beside, self.article, self.heading = [], 0, beside, article, heading

    def text(self):
        return SPACE.sub(" ", html.unescape("".join(self.pieces))).strip()


def beside(name, attributes, inside_article):
    """What marks an element as holding no article text: "tag", "wrap" (a form), "name", "hidden", or nothing.

    A class, id or role counts whole; one with hyphens if each of its parts does.
    """
    if name in ASIDE or name == "header" and not inside_article:
        return "wrap" if name in WRAPS else "tag"
    if not attributes or name in ("html", "body", "article", "main"):
        return None
    if "hidden" in attributes.lower().split():
        return "hidden"
    for m in NAMED.finditer(attributes):
        for whole in m[1].strip("\"'").lower().split():
            if all(x in BESIDE for x in WORDS.split(whole) if x != "site") and whole.strip("-_") != "site":
                return "name"
    return None


def settle_marks(lines, marks):
    """Decide which marks (parent, kind, encloses main, encloses article) hold, and set ``beside`` of the lines.

    A mark around a ``main`` does not hold, nor around an ``article`` unless another article or main begins outside
    of all marks.  By name, or as a form, it does not hold around more than half of the text of a page without either.
    """
    said, free = [0] * len(marks), False
    for x in lines:
        if x.beside >= 0:
            said[x.beside] += len(x.said)
        free = free or x.beside < 0 and x.article > 0
    for i in range(len(marks) - 1, 0, -1):
        parent, _, main, article = marks[i]
        if parent >= 0:
            said[parent] += said[i]
            marks[parent][2], marks[parent][3] = marks[parent][2] or main, marks[parent][3] or article
    total, any_marked, off = sum(len(x.said) for x in lines), any(x.article for x in lines), []
    for (parent, kind, main, article), n in zip(marks, said):
        holds = kind == "hidden" or not (main or article and not free or not any_marked and kind in ("name", "wrap") and 2 * n > total)
        off.append(holds or parent >= 0 and off[parent])
    for x in lines:
        x.beside = x.beside >= 0 and off[x.beside]


def lines_of(page):
    """Lines of a page, markup stripped; one pass over the page."""
    out, open_, at, n = [], [], 0, len(page)
    counts, unclosed, last_end = Counter(), set(), page.rfind(">")
    depth_article = articles = links = 0
    marks, mark = [], -1  # the innermost open mark
    line = Line(-1, 0, False)

    def cut():
        nonlocal line
        if line.pieces:
            line.said = line.text()
            if line.said:
                out.append(line)
        line = Line(mark, articles if depth_article else 0, any(counts[h] for h in HEADINGS))

    def say(text):
        if text:
            line.pieces.append(text)
            if links:
                line.linked += len(text)

    def close(upto):
        nonlocal depth_article, links, mark
        while len(open_) > upto:
            name, off, art = open_.pop()
            counts[name] -= 1
            if off:
                mark = marks[mark][0]
            depth_article -= art
            links -= name == "a"

    while at < n:
        m = TAG.search(page, at)
        if not m or m.end() > last_end + (not m[2]):  # without a later end no tag begins
            say(page[at:])
            break
        say(page[at:m.start()])
        at = m.end()
        if not m[2]:
            stop = page.find("-->" if m[0] == "<!--" else ">", at)
            at = n if stop < 0 else stop + (3 if m[0] == "<!--" else 1)
            continue
        name, stop = m[2].lower(), ATTRIBUTES.match(page, at).end()
        stop = stop if page[stop:stop + 1] == ">" else page.find(">", at)  # a quote that never closes
        attributes, at = page[at:stop], stop + 1
        if m[1]:
            if counts[name]:
                close(next(i for i in range(len(open_) - 1, -1, -1) if open_[i][0] == name))
            if name in BLOCKS:
                cut()
            continue
        if name in RAW:
            if name != "head":
                end = None if attributes.endswith("/") or name in unclosed else re.compile(f"</{re.escape(name)}[^>]*>", re.I).search(page, at)
                if not end:
                    unclosed.add(name)
                at = end.end() if end else (n if name in ("script", "style") else at)
            continue
        if name == "br":
            say(" ")
        if name in VOID:
            if name == "hr":
                cut()
            continue
        if any(counts[x] for x in CLOSES.get(name, ())):
            for i in range(len(open_) - 1, -1, -1):
                if open_[i][0] in CLOSES.get(name, ()):
                    close(i)
                    break
                if open_[i][0] in ("ul", "ol", "dl", "table"):
                    break
        off, art = beside(name, attributes, depth_article > 0), name in ("article", "main")
        if not attributes.endswith("/"):
            open_.append((name, off, art))
            counts[name] += 1
            if off:
                marks.append([mark, off, False, False])
                mark = len(marks) - 1
            if art and mark >= 0:
                marks[mark][2 if name == "main" else 3] = True
            articles += art and not depth_article
            depth_article += art
            links += name == "a"
        if name in BLOCKS:
            cut()
    cut()
    settle_marks(out, marks)
    return out


def stretches(lengths, window, surge):
    """(start, end) of the lines between each surge and its dive; ``lengths`` are the lines' text lengths."""
    n, out, start = len(lengths), [], None
    sums = [0]
    for x in lengths:
        sums.append(sums[-1] + x)
    blocks = [sums[min(n, i + window)] - sums[i] for i in range(n)]
    for i in range(n):
        if start is None and lengths[i] and blocks[i] >= surge:
            start = i
        elif start is not None and not blocks[i]:
            out.append((start, i))
            start = None
    if start is not None:
        out.append((start, n))
    return out


def main_text(page, window=WINDOW, surge=SURGE):
    """The article of a page: its blocks joined by empty lines."""
    if not page:
        return ""
    found = [(x, x.said) for x in lines_of(page)]
    # The page's own mark is a weight: its lines count with their links and reach the surge alone.
    lengths = [0 if x.beside else surge + len(t) if x.article else len(t) if x.heading else max(0, len(t) - x.linked) for x, t in found]
    spans = stretches(lengths, window, surge) or stretches(lengths, window, 1)
    return "\n\n".join(found[i][1] for a, b in spans for i in range(a, b) if not found[i][0].beside)


def extract_main_text(pages: DataFrame, page: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with the main text of each page."""
    @pandas_udf(T.StringType())
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            for part in parts(batch):
                yield pd.Series([main_text(p) for p in part], dtype=object)

    return pages.withColumn(into, text_of(F.col(f"`{page}`")))

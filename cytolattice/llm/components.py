"""Connected components of a table of links, by alternating small-star and large-star rounds."""

from pyspark.sql import DataFrame, functions as F

from ..session import settle


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of a link; root is the smallest node reachable.

    Each round is two grouped minima and two equi-joins on a written table; a hot node is split by adaptive skew joins.
    """
    hi, lo = F.greatest(a, b), F.least(a, b)
    stars = settle(links.select(hi.alias("hi"), lo.alias("lo")).where("hi > lo").distinct(), "links")
    while True:
        least = stars.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (stars.join(least, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).where("hi > lo")
                 .union(least.select("hi", F.col("m").alias("lo"))).distinct())
        small = settle(small, "links")
        both = small.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(small.select("lo", "hi"))
        centre = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        stars = settle(both.where("v > u").join(centre, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct(), "links")
        single = stars.groupBy("hi").agg(F.count("*").alias("n")).where("n > 1").limit(1).count() == 0
        if single and stars.join(stars.select(F.col("hi").alias("lo")), "lo", "left_semi").limit(1).count() == 0:
            break
    roots = stars.select("lo").distinct()
    return stars.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(roots.select("lo", F.col("lo")))

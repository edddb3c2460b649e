"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probity.llm.scratch import new_folder, saved


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its least node) for every end of a link (a, b).

    Each round every node tells its neighbours the least node it knows of its
    neighbourhood, and the links are redrawn to that one (large star, then small
    star), so paths shorten at least by half. A node with many links never has
    them in one place: minima are combined before the shuffle and joins may be
    split. Each round is written to the shared folder; the last changes nothing.
    """
    folder = new_folder(links.sparkSession)
    rows = links.count()  # no round has more
    now = links.selectExpr("greatest(a, b) AS a", "least(a, b) AS b").filter("a <> b").distinct()
    now, before, number = saved(now, folder, "links0", rows), None, 0
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        # large star: larger neighbours are linked to the least of the neighbourhood
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        # small star: smaller neighbours and the node itself are
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(
            F.explode(F.array(F.col("a"), F.col("b"))).alias("a"), F.col("m").alias("b")
        )
        number += 1
        now = saved(small.filter("a <> b").distinct(), folder, f"links{number}", rows)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == before:
            break
        before = state
    pairs = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = pairs.select("component").distinct().select(F.col("component").alias("node"), "component")
    return pairs.union(roots)

"""Connected components by contraction.

Every round each node points at the neighbour (or itself) that comes first by
degree, then in a random order drawn for the round; pointers are doubled and
the links are contracted through them.  A hub takes its whole star in one
round, and a chain loses most of its nodes per round, so the number of rounds
is logarithmic.  The driver sees only whether links are left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricefold.llm.shared import stage


def connected_components(links: DataFrame, folder: str) -> DataFrame:
    """``links(a, b)`` -> ``(node, root)`` for every node of a link.

    Nodes of one component get the same root, a node of it.  Repeated links,
    links of a node with itself and an empty table are fine; links with a null
    end are ignored.
    """
    links = stage(links.select("a", "b").where("a <> b").distinct(), folder, "links0")
    maps: list[DataFrame] = []
    while not links.isEmpty():
        k = len(maps) + 1
        both = links.union(links.select("b", "a"))
        degree = both.groupBy(F.col("a").alias("b")).agg(F.count(F.lit(1)).alias("d"))
        rank = lambda d, c: F.struct((-F.col(d)).alias("d"), F.xxhash64(F.col(c), F.lit(k)).alias("h"),
                                     F.col(c).alias("node"))
        first = (both.join(degree, "b").groupBy("a").agg(F.min(rank("d", "b")).alias("n"), F.count(F.lit(1)).alias("d"))
                 .select(F.col("a").alias("node"), F.least(F.col("n"), rank("d", "a")).getField("node").alias("p")))
        first = stage(first, folder, f"first{k}")
        for _ in range(2):
            up = first.select(F.col("node").alias("p"), F.col("p").alias("pp"))
            first = first.join(up, "p", "left").select("node", F.coalesce("pp", "p").alias("p"))
        first = stage(first, folder, f"map{k}")
        maps.append(first)
        a = first.select(F.col("node").alias("a"), F.col("p").alias("pa"))
        b = first.select(F.col("node").alias("b"), F.col("p").alias("pb"))
        links = stage(links.join(a, "a").join(b, "b").where("pa <> pb")
                      .select(F.col("pa").alias("a"), F.col("pb").alias("b")).distinct(), folder, f"links{k}")
    if not maps:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    out = maps[0].select("node", F.col("p").alias("root"))
    for m in maps[1:]:
        out = (out.join(m.select(F.col("node").alias("root"), "p"), "root", "left")
               .select("node", F.coalesce("p", "root").alias("root")))
    return stage(out, folder, "roots")

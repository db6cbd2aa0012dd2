"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.shared_files import stored


def _to_least(edges: DataFrame, keep_own: bool) -> DataFrame:
    """Point the neighbours of every node at the least node around it.

    `keep_own` is the small star: only smaller neighbours count, and the node itself is pointed too.
    Otherwise the large star: all neighbours count, and the larger ones are pointed.
    """
    if not keep_own:
        edges = edges.unionByName(edges.select(F.col("low").alias("high"), F.col("high").alias("low")))
    least = edges.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("least"))
    least = least.select("node", F.least("node", "least").alias("least"))
    turned = edges.join(least, F.col("high") == F.col("node"))
    if keep_own:
        moved = turned.select(F.col("low").alias("one"), F.col("least").alias("two"))
        moved = moved.unionByName(least.select(F.col("node").alias("one"), F.col("least").alias("two")))
    else:
        moved = turned.where(F.col("low") > F.col("high")).select(F.col("low").alias("one"), F.col("least").alias("two"))
    return (
        moved.where(F.col("one") != F.col("two"))
        .select(F.greatest("one", "two").alias("high"), F.least("one", "two").alias("low"))
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in `links` (low, high: long): root is the least node reachable.

    Each round contracts every neighbourhood onto its least node, so chains shrink by a factor per round and
    a node with very many links costs no more rows than it has links. Rounds are written to the shared
    folder; the driver sees one count and one checksum of each.
    """
    edges = stored(
        links.where(F.col("low") != F.col("high"))
        .select(F.greatest("low", "high").alias("high"), F.least("low", "high").alias("low"))
        .distinct(),
        "links",
    )
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("low", "high").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        edges = stored(_to_least(_to_least(edges, False), True), "links")
    return edges.select(F.col("high").alias("node"), F.col("low").alias("root")).unionByName(
        edges.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
    )

"""Connected components by alternating stars, for any number of edges.

Each step hangs the neighbours of a node on its smallest neighbour, first the larger ones,
then the smaller ones. Only (node, neighbour) rows are shuffled; minima are combined before
the shuffle, and a node with very many neighbours is split by the adaptive join. Every
round is written to the shared folder, so plans do not grow.
"""

from pyspark.sql import functions as F

from fleetbook.llm.tables import stage


def _fingerprint(edges):
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _round(edges):
    both = edges.union(edges.select(F.col("v"), F.col("u"))).filter("u <> v")
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = (
        both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        .filter("u <> v").distinct())
    down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return least.select("u", F.col("m").alias("v")).union(moved).filter("u <> v").distinct()


def components(edges, label="components", limit=64):
    """(node, component): for every node of an edge the smallest node it can reach.

    ``edges`` has two long columns; self links are ignored, repeated and reversed links
    count once, an empty frame gives an empty result."""
    a, b = edges.columns
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    edges = stage(edges, label)
    before = _fingerprint(edges)
    for _ in range(limit):
        if not before[0]:
            break
        edges = stage(_round(edges), label)
        now = _fingerprint(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {limit} rounds")
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)

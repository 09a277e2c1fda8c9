"""Exact top-k inner products in tiles.

Vectors become integers, floor(256 * x). Both sides are packed into blocks, matrices of
at most about ``SIDE`` rows. Every pair of a query block and a candidate block is a tile:
one matrix product, a partial selection of k per query, ``k`` rows out. Lists of a query
are merged as a tree: first over groups of ``FAN`` candidate blocks, then over what is left.

The products are exact: in doubles while no partial sum can reach 2**53, else in 64-bit
integers (which wrap, as longs do).

Defined cases: vectors that are null, hold null or non-finite components, or have no vec_id
take no part; vectors meet only those of their own length; floors outside 64 bits are cut
to the nearest that fits; of rows with one vec_id the smallest vector counts; fewer candidates
than k give fewer rows; no rows give no rows. Ties go to the smaller vec_id.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Window, functions as F

from fleetbook.llm.tables import stage

K, EVERY = 5, 50
SIDE, FAN = 2048, 32


def integers(embedding):
    """floor(256 * x) of every component as longs."""
    return np.clip(np.floor(256.0 * np.asarray(embedding, np.float64)), -2.0**63, 2.0**63 - 1024).astype(np.int64)


def products(a, b):
    """Inner products of the rows of two integer matrices."""
    if not a.shape[1]:
        return np.zeros((len(a), len(b)), np.int64)
    most = float(np.abs(a.astype(np.float64)).max()) * float(np.abs(b.astype(np.float64)).max()) * a.shape[1]
    if most < 2.0**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def _pack(keys, frame):
    """A block as one row: ids ascending, the vector of each, the matrix as bytes."""
    rows = {}
    for i, e in zip(frame["vec_id"], frame["embedding"]):
        e = tuple(e)
        rows[i] = min(rows.get(i, e), e)
    ids = np.array(sorted(rows), np.int64)
    matrix = np.array([integers(rows[i]) for i in ids], np.int64)
    return pd.DataFrame({"size": [keys[0]], "block": [keys[1]], "ids": [ids.tobytes()], "matrix": [matrix.tobytes()]})


def _select(scores, ids, own, k):
    """(row, id, score) of the k best of each row; equal scores by smaller id. ``ids`` ascend."""
    rows, found = [], []
    for r in range(len(scores)):
        s = scores[r]
        at = np.flatnonzero(ids != own[r])
        if len(at) > k:
            limit = np.partition(s[at], len(at) - k)[len(at) - k]
            above, ties = at[s[at] > limit], at[s[at] == limit]
            at = np.concatenate([above, ties[:k - len(above)]])
        rows += [r] * len(at)
        found.append(at)
    at = np.concatenate(found) if found else np.zeros(0, np.int64)
    rows = np.array(rows, np.int64)
    return rows, ids[at], scores[rows, at] if len(rows) else np.zeros(0, np.int64)


def _tiles(k):
    def run(frames):
        for frame in frames:
            for row in frame.itertuples(index=False):
                qids, ids = np.frombuffer(row.qids, np.int64), np.frombuffer(row.ids, np.int64)
                q = np.frombuffer(row.qmatrix, np.int64).reshape(len(qids), row.size)
                m = np.frombuffer(row.matrix, np.int64).reshape(len(ids), row.size)
                for at in range(0, len(qids), 256):
                    part = qids[at:at + 256]
                    rows, found, scores = _select(products(q[at:at + 256], m), ids, part, k)
                    yield pd.DataFrame({"query_id": part[rows], "vec_id": found, "score": scores, "block": np.int32(row.block)})
    return run


def _best(lists, k, *by):
    order = Window.partitionBy("query_id", *by).orderBy(F.desc("score"), "vec_id")
    return lists.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def blocks_of(vectors, label, side=SIDE):
    """``vectors`` (vec_id, embedding) packed into about rows / side blocks for each length."""
    count = max(1, -(-vectors.count() // side))
    dealt = vectors.select(
        "vec_id", "embedding", F.size("embedding").alias("size"),
        F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(count)).cast("int").alias("block"))
    return stage(dealt.groupBy("size", "block").applyInPandas(
        _pack, "size int, block int, ids binary, matrix binary"), label), count


def top_k(vectors, queries, k=K):
    """query_id, rank, vec_id, score: for each row of ``queries`` (vec_id, embedding) its k
    best rows of ``vectors`` with another vec_id."""
    shards, _ = blocks_of(usable(vectors), "shards")
    asked, _ = blocks_of(usable(queries), "queries", SIDE // 2)
    asked = asked.select("size", F.col("block").alias("qblock"), F.col("ids").alias("qids"), F.col("matrix").alias("qmatrix"))
    # A tile per pair of blocks of one vector length; both sides are dealt out by the pair,
    # so tiles spread evenly however few blocks one side has.
    left = shards.join(asked.select("size", "qblock"), "size")
    right = asked.join(shards.select("size", "block"), "size")
    tiles = left.join(right, ["size", "block", "qblock"])
    lists = tiles.mapInPandas(_tiles(k), "query_id long, vec_id long, score long, block int")
    merged = _best(lists.withColumn("part", (F.col("block") / FAN).cast("int")), k, "part")
    return _best(merged, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def usable(vectors):
    """vec_id and embedding (as doubles) of the rows that take part."""
    e = F.col("embedding").cast("array<double>")
    fine = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("embedding")).filter(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(fine, F.lit(False)))


def asked(vectors, every=EVERY):
    return vectors.filter(F.col("vec_id") % every == 0)

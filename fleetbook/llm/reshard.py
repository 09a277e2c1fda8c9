"""Resharding with the fewest bytes moved, as a minimum-cost flow.

Old shards hold documents, new shards get equal byte capacities (the law is ``bytes``).
Bytes that stay in the shard of the same number cost nothing, all others one each; the flow
between the few shards is solved by successive shortest paths. In each old shard the
documents are laid out by blocks, in each block the long ones first; a flow is a range of
that order, the part that stays comes first. A document goes where the middle of its range
lies, so a shard misses its capacity by about a document at each of its few cuts.

``rewrite`` carries the transfers out on a stored table: files of blocks that stay whole are
left as they are, moved blocks and blocks with a cut are written anew.

Running sums never gather a shard in one task: blocks hold about ``BLOCK_ROWS`` rows (more
in tables of over 300 million), sums inside a block are a window, block totals are summed
over the shard. Tables of one row a block have at most ``MOST_BLOCKS`` rows, so they are
broadcast; texts are shuffled once, when the old layout is written.

Defined cases: a null text has size 1; null doc_ids are placed like others and come first
in a block; repeated rows are separate documents, those equal in doc_id and text share a
block; no rows give no rows and an empty plan. Columns may have any names; a ``shard`` or
``slot`` of the input is replaced.
"""

import heapq

from pyspark.sql import Window, functions as F

from fleetbook.llm.tables import stage
from fleetbook.session import scratch_dir

OLD, NEW = 6, 8
BLOCK_ROWS = 5_000
MOST_BLOCKS = 60_000             # so tables of one row a block stay below about 3 MB


def size_of(text):
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def capacities(total, shards=NEW):
    """Byte capacities, at most one apart."""
    return [total // shards + (j < total % shards) for j in range(shards)]


def min_cost_flow(supply, capacity):
    """Transfers {(old, new): bytes} that place all supply and move the fewest bytes.

    Successive shortest paths over the two-sided network: an old shard reaches the new one
    of its number at cost 0, others at cost 1; placed bytes may be sent back."""
    flow = {}
    need, room = list(supply), list(capacity)
    cost = lambda i, j: int(i != j)
    while True:
        heap = [(0, ("o", i)) for i, s in enumerate(need) if s]
        best, before = {node: 0 for _, node in heap}, {}
        heapq.heapify(heap)
        # Costs of 0 and 1 with returned flow at -cost: labels are corrected until stable.
        while heap:
            d, node = heapq.heappop(heap)
            if d > best[node]:
                continue
            kind, x = node
            steps = (
                [(("n", j), cost(x, j)) for j in range(len(room))] if kind == "o"
                else [(("o", i), -cost(i, x)) for i in range(len(need)) if flow.get((i, x))])
            for to, c in steps:
                if d + c < best.get(to, 1 << 30):
                    best[to], before[to] = d + c, node
                    heapq.heappush(heap, (d + c, to))
        ends = [(best[("n", j)], j) for j, r in enumerate(room) if r and ("n", j) in best]
        if not ends:
            return {k: v for k, v in flow.items() if v}
        node = ("n", min(ends)[1])
        path = [node]
        while node in before:
            node = before[node]
            path.append(node)
        path.reverse()
        pairs = list(zip(path, path[1:]))
        amount = min([need[path[0][1]], room[path[-1][1]]] + [flow[(b[1], a[1])] for a, b in pairs if a[0] == "n"])
        for a, b in pairs:
            key, sign = ((a[1], b[1]), 1) if a[0] == "o" else ((b[1], a[1]), -1)
            flow[key] = flow.get(key, 0) + sign * amount
        need[path[0][1]] -= amount
        room[path[-1][1]] -= amount


def cuts(flow, old):
    """Ranges (new, from, to) of the order of an old shard; what stays comes first."""
    at, out = 0, []
    for (_, j), n in sorted(((k, v) for k, v in flow.items() if k[0] == old), key=lambda x: (x[0][1] != old, x[0][1])):
        out.append((j, at, at + n))
        at += n
    return out


def _target(flow, shards):
    """Column: the new shard of the doubled position ``middle`` in shard ``__old``."""
    choice = F.lit(None).cast("int")
    for old in range(shards):
        for new, _, to in reversed(cuts(flow, old)):
            choice = F.when((F.col("__old") == old) & (F.col("middle") < 2 * to), F.lit(new)).otherwise(choice)
    return choice


def store(docs, old=None, shards=OLD):
    """Write ``docs`` as a table of block files below a folder per old shard; its path.

    ``old`` is a column with the present shard (0 to ``shards`` - 1); the default deals by
    the checksum of doc_id. A row's block depends on its doc_id, its text and the number of
    rows; a task has one block or a few. The columns of ``docs`` are kept in one, ``row``,
    so that none of their names can clash."""
    if old is None:
        old = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % shards, F.lit(0))
    blocks = min(MOST_BLOCKS // shards, max(1, -(-docs.count() // (BLOCK_ROWS * shards))))
    text = F.col("text").cast("string")
    rows = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), old.cast("int").alias("__old"),
        F.pmod(F.xxhash64(F.col("doc_id"), text, F.lit(11)), F.lit(blocks)).cast("int").alias("__block"),
        size_of(text).alias("__size"))
    inside = Window.partitionBy("__old", "__block").orderBy(F.desc("__size"), "row.doc_id", "row.text")
    table = (
        rows.repartition(min(MOST_BLOCKS, 2 * blocks * shards), "__old", "__block")
        .withColumn("__place", F.row_number().over(inside))
        .withColumn("__upto", F.sum("__size").over(inside.rowsBetween(Window.unboundedPreceding, 0))))
    path = scratch_dir(docs.sparkSession, "sharded")
    table.write.partitionBy("__old", "__block").parquet(path)
    return docs.sparkSession.read.schema(table.schema).parquet(path)


def plan(table, new=NEW):
    """(pieces, flow) for a stored table. A piece is the run of rows of a block that goes to
    one shard: __old, __block, shard, from, to (places) and first, the slot of its first row.
    There are at most ``MOST_BLOCKS`` blocks and a piece more for each cut."""
    per_block = table.groupBy("__old", "__block").agg(F.sum("__size").alias("bytes"))
    before = Window.partitionBy("__old").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    per_block = stage(per_block.withColumn("start", F.coalesce(F.sum("bytes").over(before), F.lit(0))), "blocks")
    totals = {r["__old"]: r["bytes"] for r in per_block.groupBy("__old").agg(F.sum("bytes").alias("bytes")).collect()}
    supply = [totals.get(i, 0) for i in range(max(totals, default=-1) + 1)]
    flow = min_cost_flow(supply, capacities(sum(supply), new))
    pieces = (
        table.select("__old", "__block", "__place", "__size", "__upto")
        .join(F.broadcast(per_block), ["__old", "__block"])
        .withColumn("middle", 2 * (F.col("start") + F.col("__upto")) - F.col("__size"))
        .groupBy("__old", "__block", _target(flow, len(supply)).alias("shard"))
        .agg(F.min("__place").alias("from"), F.max("__place").alias("to")))
    ahead = Window.partitionBy("shard").orderBy("__old", "__block").rowsBetween(Window.unboundedPreceding, -1)
    rows = F.col("to") - F.col("from") + 1
    return stage(pieces.withColumn("first", F.coalesce(F.sum(rows).over(ahead), F.lit(0))), "pieces"), flow


def _placed(table, pieces):
    pieces = F.broadcast(pieces.select(
        F.col("__old").alias("o"), F.col("__block").alias("b"), "shard", "from", "to", "first"))
    at = F.col("__place")
    joined = table.join(pieces, (F.col("__old") == F.col("o")) & (F.col("__block") == F.col("b")) & at.between(F.col("from"), F.col("to")))
    return joined.select("row", "shard", (F.col("first") + at - F.col("from")).cast("long").alias("slot"))


def rewrite(table, pieces):
    """The resharded table: blocks that stay whole in their shard are read from their old
    files, all other rows from files written anew below a folder per new shard."""
    stays = pieces.groupBy("__old", "__block").agg(F.min(F.col("shard") == F.col("__old")).alias("stays"))
    stays = stage(stays, "stays")
    kept = F.broadcast(stays.filter("stays").select("__old", "__block"))
    moved = F.broadcast(stays.filter("NOT stays").select("__old", "__block"))
    spark, path = table.sparkSession, scratch_dir(table.sparkSession, "resharded")
    anew = _placed(table.join(moved, ["__old", "__block"], "left_semi"), pieces)
    anew.write.partitionBy("shard").parquet(path)
    placed = _placed(table.join(kept, ["__old", "__block"], "left_semi"), pieces).unionByName(
        spark.read.schema(anew.schema).parquet(path))
    return placed.select("row.*", "shard", "slot")


def reshard(docs, old=None, shards=OLD, new=NEW):
    """The rows of ``docs`` with shard and slot, from the rewritten files."""
    clash = [c for c in ("shard", "slot") if c in docs.columns]
    table = store(docs.drop(*clash), old, shards)
    pieces, _ = plan(table, new)
    return rewrite(table, pieces)


def digest(placed):
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of a resharded table."""
    text = F.col("text").cast("string")
    return placed.select(
        "doc_id", size_of(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))

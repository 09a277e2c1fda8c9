"""What every filter of a chain removes, in every order of the filters.

A document's failures are a bit mask. Documents are counted by (part, mask) first, so the
orders are worked out on at most 2**k rows a part, whatever the number of documents. The
removal step of a mask under an order is a min-plus product: costs of the mask (0 where it
fails a filter, ``k`` where it passes) plus the filter's position in the order (the inverse
permutation), by minimum over the filters. The counts of masks are scattered to these steps.

Rules of ``RULES`` read the text alone; ``REPEAT`` is the filter for texts that a smaller
doc_id has as well, told by SHA-256.

Defined cases: null texts are empty; null ``lang`` is the part ''; rows without a doc_id are
counted, have no smaller and no larger doc_id and no labels; repeated rows count each, and
rows that share a doc_id do not repeat one another; of several labels of a doc_id any that
is 1 counts; labels without a document count nothing; no documents give no rows.
"""

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

PIECE = 1 << 20                  # bytes of a text split into words at a time
UPPER = bytes(range(65, 91))
MARKS = b"#$%&*|"

#: The filters that read one text: (words, distinct words, A-Z, code points, marks) -> fails.
RULES = {
    "A": lambda n, distinct, upper, points, marks: n < 100,
    "B": lambda n, distinct, upper, points, marks: 100 * distinct < 80 * n,
    "C": lambda n, distinct, upper, points, marks: 100 * upper > 10 * points,
    "D": lambda n, distinct, upper, points, marks: marks > 0,
}
REPEAT = "E"
FILTERS = (*RULES, REPEAT)


def facts(text):
    """Words, distinct words, capitals, code points and marks of a text. ``bytes.split``
    parts at space and the control characters 9 to 13, and nothing else."""
    raw = text.encode()
    n, seen, rest = 0, set(), b""
    for at in range(0, len(raw), PIECE):
        piece = rest + raw[at:at + PIECE]
        found = piece.split()
        # The last word of a piece may go on in the next one.
        rest = found.pop() if found and at + PIECE < len(raw) and not piece[-1:].isspace() else b""
        n += len(found)
        seen.update(found)
    upper = len(raw) - len(raw.translate(None, UPPER))
    marks = len(raw) - len(raw.translate(None, MARKS))
    return n, len(seen), upper, len(text), marks


def _flags(rules):
    def run(batches):
        for batch in batches:
            masks, digests = [], []
            for value in batch["text"]:
                text = value.as_py() or ""
                found = facts(text)
                masks.append(sum(int(fails(*found)) << k for k, fails in enumerate(rules.values())))
                digests.append(hashlib.sha256(text.encode()).digest())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["part"], pa.array(masks, pa.int64()), pa.array(digests, pa.binary())],
                ["doc_id", "part", "mask", "digest"])
    return run


def failures(docs, labels, rules=RULES, part="lang"):
    """part, mask, n, good, toxic: documents by failures. Bit i of the mask is the i-th rule,
    the next one ``REPEAT``; good and toxic count those with the label."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.col("text").cast("string").alias("text")).mapInArrow(
            _flags(rules), "doc_id long, part string, mask long, digest binary")
    # Equal rows become one; the key is spread over copies and over repeated ids alike.
    rows = rows.groupBy("digest", "doc_id", "part", "mask").agg(F.count("*").alias("n"))
    marked = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.coalesce("quality", F.lit(0)) == 1).cast("long")).alias("good"),
        F.max((F.coalesce("toxic", F.lit(0)) == 1).cast("long")).alias("toxic")).filter("good + toxic > 0")
    named = rows.filter("doc_id IS NOT NULL").join(marked, "doc_id", "left").fillna(0, ["good", "toxic"])
    # Copies: per text, part and labels the smallest id with its rows, then the smallest of the text.
    copies = named.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min(F.struct("doc_id", "n")).alias("low"))
    lowest = copies.groupBy("digest").agg(F.min("low.doc_id").alias("least"))
    copies = copies.join(lowest, "digest").withColumn("first", F.when(F.col("low.doc_id") == F.col("least"), F.col("low.n")).otherwise(0))
    repeat = 1 << len(rules)
    kinds = F.explode(F.array(
        F.struct(F.col("mask").alias("mask"), F.col("first").alias("n")),
        F.struct((F.col("mask") + repeat).alias("mask"), (F.col("n") - F.col("first")).alias("n")))).alias("kind")
    named = copies.select("part", "good", "toxic", kinds).select(
        "part", "kind.mask", "kind.n", (F.col("good") * F.col("kind.n")).alias("good"), (F.col("toxic") * F.col("kind.n")).alias("toxic"))
    nameless = rows.filter("doc_id IS NULL").select("part", "mask", "n", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    return named.unionByName(nameless).groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def removal_steps(masks, orders):
    """Step (from 0; k: never) at which each mask is removed under each order: the min-plus
    product of mask costs and positions, a filter at a time."""
    k = orders.shape[1]
    places = np.argsort(orders, axis=1)
    costs = np.where(masks[:, None] >> np.arange(k) & 1, 0, k)
    steps = np.full((len(masks), len(orders)), k)
    for f in range(k):
        np.minimum(steps, costs[:, f, None] + places[None, :, f], out=steps)
    return steps


def scatter(owner, n_owners, masks, weights, orders):
    """Counts by (owner, order, step) of entries: (kept, removed, redundant, unique, good,
    toxic, shapley); ``weights`` are the columns n, good, toxic of the entries."""
    n_orders, k = orders.shape
    places = np.argsort(orders, axis=1)
    steps = removal_steps(masks, orders)
    base = (owner[:, None] * n_orders + np.arange(n_orders)) * (k + 1)

    def add(at, values):
        out = np.zeros(n_owners * n_orders * (k + 1), np.int64)
        np.add.at(out, (base + at).reshape(-1), np.broadcast_to(values, base.shape).reshape(-1))
        return out.reshape(n_owners, n_orders, k + 1)

    lost = [add(steps, w[:, None]) for w in weights]
    removed = lost[0]
    kept = removed.sum(axis=2, keepdims=True) - np.cumsum(removed, axis=2)
    redundant, unique = np.zeros_like(removed), np.zeros_like(removed)
    shapley = np.zeros_like(removed)
    for f in range(k):
        fails = (masks >> f & 1)[:, None]
        place = np.broadcast_to(places[None, :, f], steps.shape)
        redundant += add(place, weights[0][:, None] * (fails & (steps < place)))
        unique += add(place, weights[0][:, None] * (masks == 1 << f)[:, None])
        at = np.arange(n_orders)
        shapley[:, at, places[:, f]] = removed[:, at, places[:, f]].sum(axis=1, keepdims=True)
    return [x[:, :, :k] for x in (kept, removed, redundant, unique, lost[1], lost[2], shapley)]


_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(counted, filters=FILTERS, orders=None):
    """A row per part, order and step (from 1) with the counts of ``_COUNTS``. ``counted``
    has part, mask, n, good, toxic, one row per part and mask; ``orders`` are strings of the
    filters' letters, all permutations where none are given."""
    names = list(orders or ("".join(p) for p in itertools.permutations(filters)))
    table = np.array([[filters.index(x) for x in name] for name in names])
    n_orders, k = table.shape

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                sizes = pa.compute.list_value_length(part["entries"]).to_numpy()
                flat = part["entries"].flatten()
                masks, *weights = (flat.field(c).to_numpy().astype(np.int64) for c in ("mask", "n", "good", "toxic"))
                counts = scatter(np.repeat(np.arange(len(sizes)), sizes), len(sizes), masks, weights, table)
                rows = n_orders * k
                order = np.tile(np.repeat(np.arange(n_orders), k), len(sizes))
                step = np.tile(np.arange(1, k + 1), len(sizes) * n_orders)
                yield pa.RecordBatch.from_arrays(
                    [part["part"].take(pa.array(np.repeat(np.arange(len(sizes)), rows))),
                     pa.array(names).take(pa.array(order)), pa.array(step, pa.int32()),
                     *[pa.array(c.reshape(-1), pa.int64()) for c in counts]], ["part", "filter_order", "step", *_COUNTS])

    entries = counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("entries"))
    return entries.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in _COUNTS))


def interactions(docs, labels):
    """The audit of the five filters, by language."""
    return audit(failures(docs, labels))

"""Document quality by logistic regression over hashed word n-grams, trained with
follow-the-regularised-leader updates.

A text is cut into words (runs of letters and digits) and marks (runs of other visible
characters). Features are the words and pairs of neighbours, a class of each pair (equal or
not, kind and case of both), and a mark for pairs that stood earlier in the text; all are
hashed into ``2**BITS`` places. A text's vector holds the share of each feature, so its
score does not depend on length, and the dot product is the mean weight of its features.

Labels are learned from at most ``SAMPLE`` labelled rows, those with the smallest hash of
doc_id; the bound keeps training in one task and the model at ``2**BITS`` numbers. Every
document is scored, by its whole text.

Defined cases: null and empty texts have no features and get the score of the bias; labels
that are null or not 0 or 1, or without a document, teach nothing; a doc_id that is labelled
several times teaches each of them; without any label of one class all scores are the bias.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from fleetbook.llm import words
from fleetbook.llm.tables import stage, texts

BITS = 18
SAMPLE = 12_000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.6, 1.0, 0.02, 0.05
SCALE = 8.0                      # a text's shares are multiplied by this
ACCEPT = 0.7
_MASK = np.uint64((1 << BITS) - 1)
_U = np.uint64

# Kinds of bytes: 1 letters and digits (all bytes of other alphabets), 2 other visible ones.
_KIND = np.full(256, 2, np.uint8)
_KIND[[32, 9, 10, 11, 12, 13]] = 0
for _a, _b in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _KIND[_a:_b] = 1


def _group_heads(doc, hashes):
    """True where a pair (doc, hash) stands for the first time in its text."""
    key = words.mix(hashes + doc.astype(_U) * _U(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    head = np.empty(len(key), bool)
    head[order[:1]] = True
    head[order[1:]] = ordered[1:] != ordered[:-1]
    return head


def features(column):
    """(places, bounds): hashed features of text i are ``places[bounds[i]:bounds[i + 1]]``."""
    raw, offsets = words.buffers(column)
    starts, ends = words.runs(raw, offsets, _KIND)
    n = len(starts)
    tokens = words.hash_runs(raw, starts, ends)
    doc = np.searchsorted(offsets, starts, side="right") - 1
    first = raw[starts] if n else np.zeros(0, np.uint8)
    last = raw[ends - 1] if n else first
    shape = np.where(_KIND[first] == 2, 3, np.where((first >= 65) & (first < 91), np.where((last >= 65) & (last < 91), 2, 1), 0))
    same = np.flatnonzero(doc[1:] == doc[:-1])
    a, b = tokens[same], tokens[same + 1]
    pair = words.mix(a * _U(0x2545F4914F6CDD1D) + b)
    kind = (shape[same] * 8 + shape[same + 1] * 2 + (a == b)).astype(_U)
    repeat = (~_group_heads(doc[same], pair)).astype(_U)
    marks = words.mix(kind * _U(2) + repeat + _U(77777))
    places = np.concatenate([tokens, pair, marks]) & _MASK
    owner = np.concatenate([doc, doc[same], doc[same]])
    order = np.argsort(owner, kind="stable")
    return places[order].astype(np.int64), np.searchsorted(owner[order], np.arange(len(offsets)))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class Ftrl:
    """Per-coordinate follow-the-regularised-leader for the logistic loss. The last place
    is the bias, which is not regularised."""

    def __init__(self, size):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(self, at):
        z, n = self.z[at], self.n[at]
        l1 = np.where(at == len(self.z) - 1, 0.0, L1)
        w = -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= l1, 0.0, w)

    def update(self, at, x, label):
        at, x = np.append(at, len(self.z) - 1), np.append(x, 1.0)
        w = self.weights(at)
        g = (_sigmoid(w @ x) - label) * x
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def _train(batches):
    """One pass over the bounded sample builds sparse vectors, the epochs go over those."""
    rows = []
    for batch in batches:
        places, bounds = features(batch["text"])
        for i, label in enumerate(batch["label"].to_pylist()):
            at, count = np.unique(places[bounds[i]:bounds[i + 1]], return_counts=True)
            rows.append((batch["h"][i].as_py(), label, at.astype(np.int32), (SCALE * count / max(1, count.sum())).astype(np.float32)))
    rows.sort(key=lambda r: r[0])
    model = Ftrl(1 << BITS)
    if len({r[1] for r in rows}) > 1:
        for epoch in range(EPOCHS):
            for i in np.random.default_rng(epoch).permutation(len(rows)):
                _, label, at, x = rows[i]
                model.update(at, x.astype(float), label)
    w = model.weights(np.arange((1 << BITS) + 1))
    at = np.flatnonzero(w)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(w[at])], ["place", "weight"])


def held_out(doc_id):
    """Column: the rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs, labels, sample=SAMPLE):
    """Weights as an array, learned from at most ``sample`` different rows of ``docs`` outside
    the held-out part. Labels of absent documents spend none of the sample, and a doc_id on
    very many rows gives no more than its share of it."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
        .filter("label IN (0, 1) AND doc_id IS NOT NULL").filter(~held_out(F.col("doc_id"))).distinct())
    named = texts(docs).withColumn("th", F.xxhash64("text"))
    # Only short rows are ordered; the texts of those chosen are fetched after.
    chosen = (
        named.select("doc_id", "th").join(known, "doc_id").distinct()
        .withColumn("h", F.xxhash64("doc_id", F.lit(3))).orderBy("h", "doc_id", "th", "label").limit(sample))
    chosen = stage(chosen, "labels")
    found = named.join(F.broadcast(chosen.select("doc_id", "th").distinct()), ["doc_id", "th"], "left_semi").dropDuplicates(["doc_id", "th"])
    rows = stage(found.join(F.broadcast(chosen), ["doc_id", "th"]).select("h", "label", "text"), "sample")
    weights = np.zeros((1 << BITS) + 1)
    for row in rows.coalesce(1).mapInArrow(_train, "place long, weight double").collect():
        weights[row["place"]] = row["weight"]
    return weights


def score(docs, weights):
    """doc_id and score of every row: the sparse dot product of its text and the weights."""
    weights = weights.astype(np.float32)

    def scored(batches):
        for batch in batches:
            for part in words.slices(batch, "text", 1 << 21):
                places, bounds = features(part["text"])
                sums = np.concatenate([[0.0], np.cumsum(weights[places], dtype=np.float64)])
                count = np.diff(bounds)
                mean = (sums[bounds[1:]] - sums[bounds[:-1]]) / np.maximum(count, 1)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(_sigmoid(SCALE * mean + float(weights[-1])))], ["doc_id", "score"])

    return texts(docs).mapInArrow(scored, "doc_id long, score double")


def classify(docs, labels):
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    scored = score(docs, train(docs, labels))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


def accepted(docs, labels):
    """The rows of ``docs`` whose text the classifier accepts."""
    weights = train(docs, labels).astype(np.float32)

    def kept(batches):
        for batch in batches:
            for part in words.slices(batch, "__text", 1 << 21):
                places, bounds = features(part["__text"])
                sums = np.concatenate([[0.0], np.cumsum(weights[places], dtype=np.float64)])
                mean = (sums[bounds[1:]] - sums[bounds[:-1]]) / np.maximum(np.diff(bounds), 1)
                yield part.filter(pa.array(_sigmoid(SCALE * mean + float(weights[-1])) >= ACCEPT)).drop_columns(["__text"])

    return docs.withColumn("__text", F.col("text").cast("string")).mapInArrow(kept, docs.schema)

"""Benchmark decontamination by latent semantic retrieval and a check of word order.

1. Document frequencies of hashed words over all documents give idf weights.
2. The benchmark's items are cut into passages of at most ``PASSAGE`` words, and these are
   dealt into groups of about ``GROUP``. The leading ``RANK`` right singular vectors of a
   group's TF-IDF matrix are its latent space, or so many more that each passage keeps at
   least ``OWN`` of its length. A group is fitted in one task. So what a space keeps of a
   passage does not fall as the benchmark grows.
3. Every document is cut into overlapping windows of several lengths. Windows and passages
   meet in the latent space of the passage's group. A window's length counts all its words,
   also those outside the space, so an exact copy has the cosine that the passage has with
   itself; ``COSINE`` of that or more makes a candidate. Windows with too few words of the
   group cannot hold a passage and are passed over.
4. A candidate is confirmed on the text: the longest common subsequence of the words of the
   passage and of the window with its surroundings must hold ``SURE`` of the passage, or
   ``LIKELY`` of it and ``ANSWER`` of its answer. The answer is the passage's rarest words,
   or the benchmark's ``answer`` column where it has one. An item counts as found in a
   document where any of its passages is.

Documents are never shuffled. A scan of them searches ``GROUPS`` groups, whose tables are
small enough to be sent to the tasks (a few MB each); larger benchmarks take more scans.

Words are runs of letters and digits, A-Z lower-cased. Defined cases: null and empty texts
and items have no words and match nothing; items below ``LEAST`` words are too short to
tell and are left out; rows without item_id are left out; documents without doc_id are
reported with null; repeated rows are reported once; empty tables give no rows.
"""

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from fleetbook.llm import words
from fleetbook.llm.quality import _KIND
from fleetbook.llm.tables import stage, texts

PLACES = 1 << 16                 # hashed words
RANK, OWN = 128, 0.5             # dimensions of a latent space; more where a passage keeps less of its length
PASSAGE, LEAST = 64, 8
RUN = 8                          # windows start and end at multiples of so many words
SIZES = (16, 32, 64)             # window lengths; steps are half of them
COSINE = 0.33                    # of the cosine of a passage with itself
SHARE = 0.35                     # least share of a window's words that the benchmark has
SURE, LIKELY, ANSWER, RAREST = 0.8, 0.6, 0.75, 5
GROUP, GROUPS = 256, 8           # passages of a latent space, spaces of a scan

_LETTERS = np.where(_KIND == 1, 1, 0).astype(np.uint8)
_U = np.uint64


def word_hashes(column):
    """(hashes, bounds) of the words of a text column."""
    raw, offsets = words.buffers(column)
    starts, ends = words.runs(raw, offsets, _LETTERS)
    return words.hash_runs(raw, starts, ends), np.searchsorted(starts, offsets)


def _places(hashes):
    return (hashes & _U(PLACES - 1)).astype(np.int64)


def _frequencies(batches):
    """Documents that hold each hashed word, summed over a task."""
    counts, n = np.zeros(PLACES, np.int64), 0
    for batch in batches:
        for part in words.slices(batch, "text", 1 << 21):
            hashes, bounds = word_hashes(part["text"])
            row = np.repeat(np.arange(part.num_rows), np.diff(bounds))
            key = np.unique(row * PLACES + _places(hashes))
            counts += np.bincount(key % PLACES, minlength=PLACES)
            n += part.num_rows
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(at, -1)), pa.array(np.append(counts[at], n))], ["place", "docs"])


def idf(docs):
    """Weights of all hashed words, from all documents: squared logarithms, as most words
    of a window are common ones."""
    rows = texts(docs).select("text").mapInArrow(_frequencies, "place long, docs long")
    counts = np.zeros(PLACES + 1)
    for row in rows.groupBy("place").agg(F.sum("docs").alias("docs")).collect():
        counts[row["place"]] = row["docs"]
    return (np.log((counts[-1] + 1) / (counts[:-1] + 1)) + 0.05) ** 2


def passages_of(benchmark):
    """item_id, passage, hashes (of its words) and answer (hashes or null)."""
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"),
                            answer.alias("answer")).filter("item_id IS NOT NULL AND text IS NOT NULL").distinct()

    def cut(batches):
        for batch in batches:
            (hashes, bounds), (answers, edges) = word_hashes(batch["text"]), word_hashes(batch["answer"])
            out = []
            for i, item in enumerate(batch["item_id"].to_pylist()):
                found = hashes[bounds[i]:bounds[i + 1]].view(np.int64)
                parts = max(1, -(-len(found) // PASSAGE))
                for k, part in enumerate(np.array_split(found, parts)):
                    if len(part) >= LEAST:
                        out.append((item, k, part.tolist(), answers[edges[i]:edges[i + 1]].view(np.int64).tolist()))
            columns = list(zip(*out)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()),
                 pa.array(columns[2], pa.list_(pa.int64())), pa.array(columns[3], pa.list_(pa.int64()))],
                ["item_id", "passage", "hashes", "answer"])

    return stage(rows.mapInArrow(cut, "item_id long, passage int, hashes array<long>, answer array<long>"), "passages")


def _tfidf(hashes, weights):
    """Places and unit-length TF-IDF values of one passage."""
    places, counts = np.unique(_places(np.asarray(hashes, np.int64).view(_U)), return_counts=True)
    values = (1 + np.log(counts)) * weights[places]
    return places, values / np.linalg.norm(values)


def latent_space(block, weights, rank=RANK):
    """(places, table, coords, own) of a group of passages: the hashed words that occur,
    ascending; their weighted rows of the leading right singular vectors of the TF-IDF
    matrix; the passages' directions in that space; the share of their length that it keeps."""
    rows = [_tfidf(hashes, weights) for _, _, hashes, _ in block]
    vocabulary = np.unique(np.concatenate([places for places, _ in rows]))
    matrix = np.zeros((len(rows), len(vocabulary)))
    for k, (places, values) in enumerate(rows):
        matrix[k, np.searchsorted(vocabulary, places)] = values
    energy, left = np.linalg.eigh(matrix @ matrix.T)
    lead = np.argsort(-energy)
    lead = lead[energy[lead] > 1e-9 * energy.max()]
    kept = np.sqrt(np.cumsum(energy[lead] * left[:, lead] ** 2, axis=1)).min(axis=0)
    lead = lead[:max(rank, int(np.searchsorted(kept, OWN)) + 1)]
    vectors = matrix.T @ (left[:, lead] / np.sqrt(energy[lead]))
    coords = matrix @ vectors
    own = np.linalg.norm(coords, axis=1)
    return (vocabulary, (vectors * weights[vocabulary, None]).astype(np.float32),
            (coords / np.maximum(own, 1e-9)[:, None]).astype(np.float32), own)


def _spaces(passages, weights, groups):
    """block and, pickled, the passages of each group with its latent space."""
    def fit(frame):
        import pandas as pd

        frame = frame.sort_values(["item_id", "passage"], kind="stable")
        block = [(int(i), int(k), h.tolist(), a.tolist()) for i, k, h, a in zip(
            frame["item_id"], frame["passage"], frame["hashes"], frame["answer"])]
        return pd.DataFrame({"block": [int(frame["block"].iloc[0])], "space": [pickle.dumps((block, latent_space(block, weights)))]})

    numbered = passages.withColumn("block", F.pmod(F.xxhash64("item_id", "passage", "hashes"), F.lit(groups)).cast("int"))
    return stage(numbered.groupBy("block").applyInPandas(fit, "block int, space binary"), "spaces")


def common_subsequence(a, b):
    """Length of the longest common subsequence of two lists, a bit per element of ``a``."""
    masks = {}
    for k, x in enumerate(a):
        masks[x] = masks.get(x, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        hit = row & masks.get(x, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def _windows(n):
    """Starts and ends, in runs of eight words, of the windows of a text of ``n`` words."""
    runs = -(-n // RUN)
    out = []
    for size in SIZES:
        size //= RUN
        at = np.arange(0, max(1, runs - size // 2), size // 2)
        out.append(np.stack([at, np.minimum(at + size, runs)], axis=1))
        if runs <= size:
            break
    return np.concatenate(out)


class _Group:
    """A group of passages and its latent space, ready for windows."""

    def __init__(self, block, space, weights):
        vocabulary, vectors, self.coords, own = space
        # Rows of the weighted table; words outside the space and padding get the zero row.
        self.row_of = np.full(PLACES + 1, len(vocabulary), np.int32)
        self.row_of[vocabulary] = np.arange(len(vocabulary))
        self.known = self.row_of[:-1] < len(vocabulary)
        self.table = np.append(vectors, np.zeros((1, vectors.shape[1]), np.float32), axis=0)
        self.least = (COSINE * own).astype(np.float32)
        self.block, self.answers = block, []
        for _, _, hashes, answer in block:
            rare = sorted(set(hashes), key=lambda h: (-weights[h & PLACES - 1], h))
            self.answers.append(set(answer) or set(rare[:RAREST]))

    def confirm(self, found, start, end, k):
        """Share of the passage in order around the window, if that is enough."""
        _, _, hashes, _ = self.block[k]
        near = found[max(0, start - len(hashes)):end + len(hashes)].view(np.int64).tolist()
        share = common_subsequence(hashes, near) / len(hashes)
        here = set(near)
        held = sum(h in here for h in self.answers[k]) / len(self.answers[k])
        return share if share >= SURE or (share >= LIKELY and held >= ANSWER) else None


def _search(spaces, weights):
    """Function over document batches: the passages of the groups found in each."""
    groups = [_Group(*pickle.loads(space), weights) for space in spaces]

    def search(batches):
        for batch in batches:
            for part in words.slices(batch, "text", 1 << 20):
                hashes, bounds = word_hashes(part["text"])
                places = _places(hashes)
                ids, out = part["doc_id"].to_pylist(), []
                for group in groups:
                    seen = np.concatenate([[0], np.cumsum(group.known[places])])
                    hits = {}
                    for i in np.flatnonzero(np.diff(bounds) >= LEAST):
                        lo, hi = bounds[i], bounds[i + 1]
                        if seen[hi] - seen[lo] >= SHARE * LEAST:
                            one_text(group, hashes[lo:hi], places[lo:hi], seen[lo:hi + 1], i, hits)
                    out += [(ids[i], group.block[k][0], share, cosine) for (i, k), (share, cosine) in sorted(hits.items())]
                columns = list(zip(*out)) or [[], [], [], []]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64(), pa.float64()))],
                    ["doc_id", "item_id", "share", "cosine"])

    def one_text(group, hashes, places, seen, i, hits):
        n = len(hashes)
        spans = _windows(n)
        ends = np.minimum(spans[:, 1] * RUN, n)
        starts = spans[:, 0] * RUN
        rich = seen[ends] - seen[starts] >= SHARE * (ends - starts)
        spans, starts, ends = spans[rich], starts[rich], ends[rich]
        if not len(spans):
            return
        # Sums over runs of eight words, a bounded number at a time; windows are sums of runs.
        padded = np.append(places, np.full(-n % RUN, PLACES)).reshape(-1, RUN)
        sums = np.zeros((len(padded) + 1, group.table.shape[1]))
        for at in range(0, len(padded), 1024):
            sums[at + 1:at + 1025] = group.table[group.row_of[padded[at:at + 1024]]].sum(axis=1)
        np.cumsum(sums, axis=0, out=sums)
        energy = np.concatenate([[0.0], np.cumsum(weights[places] ** 2)])
        for at in range(0, len(spans), 2048):
            part = slice(at, at + 2048)
            z = (sums[spans[part, 1]] - sums[spans[part, 0]]).astype(np.float32)
            z /= np.sqrt(np.maximum(energy[ends[part]] - energy[starts[part]], 1e-9))[:, None].astype(np.float32)
            cosines = z @ group.coords.T
            for w, k in zip(*np.nonzero(cosines >= group.least)):
                if hits.get((i, k), (0, 0))[0] < 1:
                    share = group.confirm(hashes, starts[at + w], ends[at + w], k)
                    if share is not None:
                        hits[i, k] = max(hits.get((i, k), (0, 0)), (share, float(cosines[w, k])))

    return search


def matches(docs, benchmark):
    """doc_id, item_id, share (of the best passage in order) and cosine: a row for every
    item found in a document."""
    docs = texts(docs)
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, share double, cosine double"
    passages = passages_of(benchmark)
    count = passages.count()
    if not count:
        return spark.createDataFrame([], schema)
    weights = idf(docs)
    groups = -(-count // GROUP)
    spaces = _spaces(passages, weights, groups)
    found = None
    for k in range(0, groups, GROUPS):
        scan = [bytes(r["space"]) for r in spaces.filter(F.col("block").between(k, k + GROUPS - 1)).orderBy("block").select("space").collect()]
        sent = spark.sparkContext.broadcast((scan, weights))
        hits = docs.mapInArrow(lambda batches, sent=sent: _search(*sent.value)(batches), schema)
        found = hits if found is None else found.union(hits)
    return found.groupBy("doc_id", "item_id").agg(F.max("share").alias("share"), F.max("cosine").alias("cosine"))


def clean(docs, benchmark):
    """The rows of ``docs`` in which no benchmark item was found."""
    found = matches(docs.filter("doc_id IS NOT NULL"), benchmark).select("doc_id").distinct()
    return docs.join(stage(found, "leaks"), "doc_id", "left_anti").select(*docs.columns)

"""Alignment of two tokenizations of the same bytes, and how often their tokens meet.

Both sides encode a space and the text. Where a token of A and a token of B end at the same
byte, a group ends. ``walk`` finds the groups by skipping along diagonals: as long as both
lists of ends agree at the present shift, slices of doubling length are compared, then of
halving length up to the first difference; the irregular group there is resolved token by
token, which sets the next shift. Links are the overlapping token pairs.

Documents are encoded once, in blocks (one Arrow batch each). A block keeps each of its id
pairs once, with its count; a document refers to its block's list by position. Counts of
the whole corpus are sums over blocks, and return to the documents block by block. So a pair
that every document holds is at most one row per block, at any size of the corpus.

Vocabularies are files of public tokenizers; their paths are parameters and must be readable
on every executor. Strings of special tokens inside texts are plain text.

Defined cases: null and empty texts, and texts that either side does not give back byte for
byte, have no tokens: counts of 0 and an empty digest. Repeated rows, rows without a doc_id
and rows that share one are counted each. No rows give no rows. Texts are encoded whole; a
task holds the tokens of one text, or of some 2 MB of them, at a time.
"""

import hashlib
import json
import os
import re
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from fleetbook.llm import words
from fleetbook.llm.lengths import PATTERN
from fleetbook.llm.tables import stage, texts

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"
SLICE = 2 << 20                  # bytes of text encoded at a time
#: Texts outside Latin letters and common signs, or with long white space, take the slower way.
UNUSUAL = re.compile(r"[^\x00-\u024F\u2010-\u2027\u20AC]|\s{200}")

_READY = {}


def _byte_letters():
    """The letters by which a byte-level vocabulary writes bytes: printable ones stand for
    themselves, the others follow from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class ByteLevel:
    """A byte-level vocabulary: ``encode`` gives ids, ``pieces`` the bytes of each id.

    Where the file's merges make its ids in ascending order, ids are the ranks of the merges,
    and texts of Latin letters are encoded by them directly, which is several times faster and
    gives the same ids. All other texts go through the file's own encoder."""

    def __init__(self, path):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        letters = _byte_letters()
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, special = file["model"], {t["id"] for t in file["added_tokens"]}
        vocabulary = model["vocab"]
        self.pieces = [b""] * (max([*vocabulary.values(), *special]) + 1)
        for token, k in vocabulary.items():
            known = all(c in letters for c in token)
            self.pieces[k] = bytes(letters[c] for c in token) if known else token.encode()
        for t in file["added_tokens"]:
            self.pieces[t["id"]] = t["content"].encode()
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [vocabulary["".join(m)] for m in merges]
        first = sorted(vocabulary[c] for c in letters)
        ranked = made == list(range(256, 256 + len(made))) and first == list(range(256))
        usual = file["normalizer"] is None and file["pre_tokenizer"] == {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        self.ranked = None
        if ranked and usual:
            import tiktoken

            self.ranked = tiktoken.Encoding("ranked", pat_str=PATTERN, special_tokens={}, mergeable_ranks={
                p: k for k, p in enumerate(self.pieces) if k not in special}).encode_ordinary

    def encode(self, texts):
        out = [None if self.ranked is None or UNUSUAL.search(t) else self.ranked(" " + t) for t in texts]
        rest = [k for k, ids in enumerate(out) if ids is None]
        found = self.tokenizer.encode_batch_fast([" " + texts[k] for k in rest], add_special_tokens=False)
        for k, e in zip(rest, found):
            out[k] = e.ids
        return out


class Pieces:
    """A piece vocabulary with byte fallback, which adds the leading space itself."""

    def __init__(self, path):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(self.model.get_piece_size())
        self.pieces = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(k) else p.replace("▁", " ").encode()
            for k, p in zip(every, self.model.id_to_piece(list(every)))]

    def encode(self, texts):
        return self.model.encode(texts, num_threads=1)


def coder(kind, path):
    """The encoder of a file, made once per worker."""
    if (kind, path) not in _READY:
        made = kind(path)
        made.lengths = np.array([len(p) for p in made.pieces], np.int64)
        _READY[kind, path] = made
    return _READY[kind, path]


def walk(a, b):
    """(runs, gaps, left, right) of two ascending lists of ends with the same last end.
    ``runs`` are (i, j, n): n groups of one token each from i and j on; ``gaps`` are irregular
    groups (i, j, to_i, to_j); together they ascend and cover both lists. ``left`` and
    ``right`` are the sides of the overlapping pairs inside the gaps."""
    i, j, n = 0, 0, len(a)
    runs, gaps, left, right = [], [], [], []
    while i < n:
        # Here both sides are at a common end: compare at the shift j - i.
        if a[i] == b[j]:
            done, wide = 1, 2
            while i + done < n and a[i + done:i + done + wide] == b[j + done:j + done + wide]:
                done += wide
                wide *= 2
            while wide > 1 and i + done < n:
                wide //= 2
                if a[i + done:i + done + wide] == b[j + done:j + done + wide]:
                    done += wide
            done = min(done, n - i)
            runs.append((i, j, done))
            i, j = i + done, j + done
            if i == n:
                break
        # The next ends differ: step on the side that is behind until both meet.
        from_i, from_j, x, y = i, j, a[i], b[j]
        left.append(i)
        right.append(j)
        while x != y:
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
            left.append(i)
            right.append(j)
        i, j = i + 1, j + 1
        gaps.append((from_i, from_j, i, j))
    return runs, gaps, left, right


def _gives_back(coder, ids, raw):
    return b"".join(map(coder.pieces.__getitem__, ids)) == raw


def tokens(values, left, right):
    """Ids of A and of B of the texts one after the other, and how many each text has; none
    where a text is empty or not given back."""
    full = [k for k, t in enumerate(values) if t]
    chosen = [values[k] for k in full]
    ids = [[[]] * len(values), [[]] * len(values)]
    for k, a, b in zip(full, left.encode(chosen), right.encode(chosen)):
        raw = b" " + values[k].encode()
        if _gives_back(left, a, raw) and _gives_back(right, b, raw):
            ids[0][k], ids[1][k] = a, b
    sizes = [np.array([len(x) for x in side], np.int64) for side in ids]
    return *(np.fromiter(chain.from_iterable(side), np.int64, n.sum()) for side, n in zip(ids, sizes)), *sizes


class Alignment:
    """The groups and links of the texts of a slice, taken as one text: the last token of each
    document ends a group, since both sides have its bytes."""

    def __init__(self, values, left, right):
        self.a, self.b, self.n_a, self.n_b = tokens(values, left, right)
        self.coders = left, right
        runs, gaps, i, j = walk(*(np.cumsum(c.lengths[x]).tolist() for c, x in ((left, self.a), (right, self.b))))
        start, other, n = np.array(runs, np.int64).reshape(-1, 3).T
        gaps = np.array(gaps, np.int64).reshape(-1, 4)
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        run_i, run_j = np.repeat(start, n) + step, np.repeat(other, n) + step
        # Where groups end on both sides, and the links by their place on both sides.
        self.to_a = np.sort(np.concatenate([run_i + 1, gaps[:, 2]]), kind="stable")
        self.to_b = np.sort(np.concatenate([run_j + 1, gaps[:, 3]]), kind="stable")
        i, j = np.concatenate([run_i, np.array(i, np.int64)]), np.concatenate([run_j, np.array(j, np.int64)])
        place = np.argsort(i, kind="stable")
        self.i, self.j = i[place], j[place]

    def counts(self):
        """(groups, links) of each text."""
        ends = np.concatenate([[0], np.cumsum(self.n_a)])
        return np.diff(np.searchsorted(self.to_a, ends, side="right")), np.diff(np.searchsorted(self.i, ends))

    def codes(self):
        """One long per link: the id of A above, that of B in the lower 32 bits."""
        return self.a[self.i] << 32 | self.b[self.j]

    def texts(self):
        """``a1,a2|b1;a3|b2,b3`` of each text in bytes: the names of all tokens, each with the
        sign that follows it, laid side by side in the order of their groups."""
        left, right = self.coders
        if not hasattr(left, "signs"):
            left.signs = {}
        v, w = len(left.pieces), len(right.pieces)
        if (v, w) not in left.signs:
            kinds = [(v, ","), (v, "|"), (w, ","), (w, ";")]
            left.signs[v, w] = pa.array([f"{k}{sign}" for n, sign in kinds for k in range(n)], pa.large_string())
        n_a, n_b = len(self.a), len(self.b)
        kind = np.empty(n_a + n_b, np.int64)
        last_a, last_b = np.zeros(n_a, np.int64), np.zeros(n_b, np.int64)
        last_a[self.to_a - 1] = 1
        last_b[self.to_b - 1] = 1
        before_b = np.concatenate([[0], self.to_b[:-1]])[:len(self.to_b)]
        kind[np.arange(n_a) + np.repeat(before_b, np.diff(self.to_a, prepend=0))] = self.a + v * last_a
        kind[np.arange(n_b) + np.repeat(self.to_a, np.diff(self.to_b, prepend=0))] = 2 * v + self.b + w * last_b
        _, offsets, data = left.signs[v, w].take(pa.array(kind)).buffers()
        offsets = np.frombuffer(offsets, np.int64)[np.concatenate([[0], np.cumsum(self.n_a + self.n_b)])].tolist()
        data = memoryview(data or b"")
        return [data[x:max(x, y - 1)] for x, y in zip(offsets[:-1], offsets[1:])]


_ROW = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, block long, "
        "at array<int>, times array<int>, pairs array<long>, counts array<long>")
_NAMES = [c.split()[0] for c in _ROW.split(", ")]


def _blocks(left_of, right_of):
    def run(batches):
        left, right = coder(*left_of), coder(*right_of)
        first = TaskContext.get().partitionId() << 32
        for number, batch in enumerate(batches):
            ids, rows, codes = [], [], []
            for part in words.slices(batch, "text", SLICE):
                ids += part["doc_id"].to_pylist()
                found = Alignment([t.as_py() or "" for t in part["text"]], left, right)
                digests = [hashlib.sha256(t).hexdigest() if len(t) else "" for t in found.texts()]
                counts = found.counts()
                rows += zip(found.n_a.tolist(), found.n_b.tolist(), counts[0].tolist(), counts[1].tolist(), digests)
                codes.append(found.codes())
            if not rows:
                continue
            sizes = np.array([r[3] for r in rows], np.int64)
            at, pairs = pd.factorize(np.concatenate(codes))
            counts, wide = np.bincount(at, minlength=len(pairs)), max(1, len(pairs))
            # Documents come in order, so their entries stay together.
            of, kept = pd.factorize(np.repeat(np.arange(len(sizes)), sizes) * wide + at)
            times = np.bincount(of, minlength=len(kept))
            offsets = np.searchsorted(kept // wide, np.arange(len(sizes) + 1)).astype(np.int32)

            def cells(values):
                return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))

            n, block = len(rows), first + number
            cols = [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 4 + [pa.string()])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *cols, pa.array([block] * n, pa.int64()), cells(kept % wide), cells(times),
                 pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int64()))], _NAMES)
            last = {"block": pa.array([block], pa.int64()), "pairs": pa.array([pairs], pa.list_(pa.int64())),
                    "counts": pa.array([counts], pa.list_(pa.int64()))}
            kinds = dict(zip(_NAMES, [pa.int64()] * 5 + [pa.string(), pa.int64()] + [pa.list_(pa.int32())] * 2))
            yield pa.RecordBatch.from_arrays([last[c] if c in last else pa.nulls(1, kinds[c]) for c in _NAMES], _NAMES)
    return run


def _scored(left, right):
    """Documents of a block with the corpus counts of its pairs (rows by position)."""
    place = np.argsort(right["pos"].to_numpy())
    n, best = right["n"].to_numpy()[place], right["best"].to_numpy(zero_copy_only=False)[place]
    times, at = (left[c].combine_chunks() for c in ("times", "at"))
    edges = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(at).to_numpy())])
    times, at = times.flatten().to_numpy().astype(np.int64), at.flatten().to_numpy()

    def total(values):
        sums = np.concatenate([[0], np.cumsum(values)])
        return pa.array(sums[edges[1:]] - sums[edges[:-1]], pa.int64())

    return left.select(["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]).append_column(
        "n_best", total(times * best[at])).append_column("count_sum", total(times * n[at]))


def encoded(docs, left=(ByteLevel, BYTE_BPE), right=(Pieces, PIECE_BPE)):
    """The written table of documents by block (``pairs`` null) and of blocks."""
    return stage(texts(docs).mapInArrow(_blocks(left, right), _ROW), "aligned")


def pair_counts(blocks):
    """pair, n: how many links of the corpus hold each id pair."""
    one = F.explode(F.arrays_zip("pairs", "counts")).alias("one")
    return blocks.filter("pairs IS NOT NULL").select(one).groupBy(F.col("one.pairs").alias("pair")).agg(
        F.sum("one.counts").alias("n"))


def alignments(docs, left=(ByteLevel, BYTE_BPE), right=(Pieces, PIECE_BPE)):
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best
    (links whose pair is the commonest of its id of B) and count_sum (over links)."""
    rows = encoded(docs, left, right)
    counts = stage(pair_counts(rows), "pairs").withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))
    best = counts.groupBy("b").agg(F.max("n").alias("most"))
    counts = counts.join(best, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    entries = rows.filter("pairs IS NOT NULL").select("block", F.posexplode("pairs").alias("pos", "pair")).join(
        counts, "pair").select(F.col("block").alias("of"), "pos", "n", "best")
    documents = rows.filter("pairs IS NULL").drop("pairs", "counts")
    return documents.groupBy("block").cogroup(entries.groupBy("of")).applyInArrow(
        _scored, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long")

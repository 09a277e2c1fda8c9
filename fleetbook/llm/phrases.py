"""Passages that documents repeat from one another, found by phrase automata.

A window is ``WINDOW`` consecutive words of a document; words are runs of anything but space
and control characters 9 to 13. A window that also starts in a document with a smaller
doc_id is a repeat, and its words go.

1. Every document writes, for each of its windows, the smallest hash of the ``PHRASE``-word
   phrases inside. Equal windows have equal smallest phrases, so a repeat always shares a
   phrase with the earlier document, and only about one phrase in 18 words is written.
   Documents of equal words count once, as a class; later copies go whole.
2. Phrases that several documents hold recur. Their words are cut from their first document,
   which confirms them as text, and put into shards by that document, so that the documents
   that repeat a text meet in few shards. A shard holds about ``SHARD`` phrases.
3. Each shard is compiled into an Aho-Corasick automaton, through which the documents that
   hold one of its phrases are streamed; many documents of a shard are dealt to several tasks.
   It finds every occurrence, and the windows around occurrences are told by 128-bit hashes.
   Every block of documents lists its windows once, with the smallest doc_id of the block;
   minima over blocks give the first holder of each window. A window that every document
   holds is thus at most one row per block.
4. The words under windows with an earlier holder are cut out.

Defined cases: null and empty texts have no words and keep none (the digest is that of the
empty text); documents under ``WINDOW`` words keep all; rows without a doc_id are no one's
copy and nobody's origin; rows that share a doc_id are judged each by its own text and do not
repeat one another, but equal words under one doc_id are one text; no rows give no rows.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from fleetbook.llm import words
from fleetbook.llm.tables import stage, texts

WINDOW = 50                      # words of a window
PHRASE = 16                      # words of a phrase
SHARD = 4096                     # phrases of an automaton, about
DEALT = 4096                     # documents that one task streams through an automaton, about
BLOCK = 2 << 20                  # bytes of documents whose windows are listed together
EMPTY = hashlib.sha256(b"").hexdigest()
_U = np.uint64


def joined(text):
    """The words of a text, one space between them, in UTF-8. ``bytes.split`` parts at space
    and the control characters 9 to 13, and nothing else."""
    return b" ".join((text or "").encode().split())


def phrase_hashes(hashes):
    """The hash of the phrase at each word, from the hashes of words."""
    n = len(hashes) - PHRASE + 1
    acc = np.zeros(max(n, 0), _U)
    for k in range(PHRASE if n > 0 else 0):
        acc = acc * _U(0x9E3779B97F4A7C15) + hashes[k:n + k]
    return words.mix(acc)


def sliding_minima(values, width):
    """Minima of all runs of ``width`` values: of the end of one block and the start of the next."""
    n = len(values)
    if n < width:
        return values[:0]
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    table = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(table, axis=1).reshape(-1)
    back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def anchors(hashes):
    """The distinct smallest phrase hashes of the windows of a document."""
    return np.unique(sliding_minima(phrase_hashes(hashes), WINDOW - PHRASE + 1))


def _scan(batches):
    for batch in batches:
        for part in words.slices(batch, "text"):
            hashes, bounds = words.word_hashes(part["text"], lower=False)
            found = [anchors(hashes[a:b]) if b - a >= WINDOW else hashes[:0] for a, b in zip(bounds[:-1], bounds[1:])]
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
            digests = [hashlib.sha256(joined(t.as_py())).hexdigest() for t in part["text"]]
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], part["th"], pa.array(np.diff(bounds).astype(np.int64)), pa.array(digests, pa.string()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found).view(np.int64)))],
                ["doc_id", "th", "n_words", "sha", "anchors"])


def _cut_phrases(batches):
    """The words of the phrases that each document is the first holder of."""
    for batch in batches:
        for part in words.slices(batch, "text"):
            hashes, bounds = words.word_hashes(part["text"], lower=False)
            shards, phrases = [], []
            for k, wanted in enumerate(part["wanted"]):
                shard_of = {w["fp"]: w["shard"] for w in wanted.as_py()}
                at = phrase_hashes(hashes[bounds[k]:bounds[k + 1]]).view(np.int64)
                split = joined(part["text"][k].as_py()).split()
                for p in np.flatnonzero(np.isin(at, list(shard_of))).tolist():
                    shards.append(shard_of[int(at[p])])
                    phrases.append(b" ".join(split[p:p + PHRASE]).decode())
            yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), pa.array(phrases, pa.string())], ["shard", "phrase"])


def _letters(raw):
    """Bytes as a string of one letter each, with a space at both ends."""
    return " " + raw.decode("latin-1") + " "


def repeated_windows(automaton, raw):
    """(first words of the windows that hold a phrase of the automaton, their digests)."""
    import xxhash

    text = _letters(raw)
    ends = np.array([e for e, _ in automaton.iter(text)], np.int64)
    spaces = np.flatnonzero(np.frombuffer(text.encode("latin-1"), np.uint8) == 32)
    last = len(spaces) - 1 - WINDOW
    if not len(ends) or last < 0:
        return np.zeros(0, np.int64), []
    first = np.searchsorted(spaces, ends) - PHRASE
    edge = np.zeros(last + 2, np.int64)
    np.add.at(edge, np.clip(first - (WINDOW - PHRASE), 0, last + 1), 1)
    np.add.at(edge, np.clip(first + 1, 0, last + 1), -1)
    starts = np.flatnonzero(np.cumsum(edge)[:-1] > 0)
    view, digest = memoryview(raw), xxhash.xxh3_128_digest
    return starts, [digest(view[a:b]) for a, b in zip(spaces[starts].tolist(), (spaces[starts + WINDOW] - 1).tolist())]


_LOCATED = "rep long, th long, block long, at array<int>, starts array<int>, h1 array<long>, h2 array<long>, lows array<long>"
_TYPES = [pa.int64(), pa.int64(), pa.int64(), *[pa.list_(pa.int32())] * 2, *[pa.list_(pa.int64())] * 3]


def _locate(batches):
    """Streams documents through the automaton of their shard. Rows come sorted: the phrases
    of a shard, then its documents."""
    import ahocorasick

    schema = pa.schema(list(zip([c.split()[0] for c in _LOCATED.split(", ")], _TYPES)))
    key = automaton = None
    ready, number, size = False, TaskContext.get().partitionId() << 32, 0
    rows, seen, lows = [], {}, []

    def block():
        hashes = np.frombuffer(b"".join(seen), ">i8").astype(np.int64).reshape(-1, 2)
        made = [(rep, th, number, at, starts, None, None, None) for rep, th, at, starts in rows]
        made.append((None, None, number, None, None, hashes[:, 0], hashes[:, 1], lows))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), schema)], schema=schema)

    for batch in batches:
        cols = [batch[c].to_pylist() for c in ("shard", "salt", "kind", "rep", "th")]
        for shard, salt, kind, rep, th, text in zip(*cols, batch["text"]):
            if (shard, salt) != key:
                key, automaton, ready = (shard, salt), ahocorasick.Automaton(ahocorasick.STORE_LENGTH), False
            if kind == 0:
                automaton.add_word(_letters(text.as_py().encode()))
                continue
            if not ready:
                automaton.make_automaton()
                ready = True
            raw = joined(text.as_py())
            starts, digests = repeated_windows(automaton, raw) if automaton.kind == ahocorasick.AHOCORASICK else ([], [])
            at = [seen.setdefault(d, len(seen)) for d in digests]
            lows += [rep] * (len(seen) - len(lows))
            for k in at:
                if rep < lows[k]:
                    lows[k] = rep
            if at:
                rows.append((rep, th, at, starts))
            size += len(raw)
            if size > BLOCK:
                if rows:
                    yield block()
                rows, seen, lows, size, number = [], {}, [], 0, number + 1
    if rows:
        yield block()


def _spans(left, right):
    """Per document of a block the word ranges under windows with an earlier holder."""
    owner = right["owner"].to_numpy()[np.argsort(right["pos"].to_numpy())]
    out = []
    for rep, th, at, starts in zip(*[left[c] for c in ("rep", "th", "at", "starts")]):
        rep = rep.as_py()
        begin = starts.values.to_numpy()[owner[at.values.to_numpy()] < rep].astype(np.int64)
        if len(begin):
            new = np.concatenate([[True], begin[1:] > begin[:-1] + WINDOW])
            ends = begin[np.concatenate([np.flatnonzero(new)[1:] - 1, [-1]])] + WINDOW
            out.append((rep, th.as_py(), begin[new], ends))
    cols = list(zip(*out)) or [[]] * 4
    return pa.table([pa.array(c, t) for c, t in zip(cols, [pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 2])],
                    names=["rep", "th", "begins", "ends"])


def _cut(batches):
    for batch in batches:
        removed, digests = [], []
        for text, begins, ends in zip(batch["text"], batch["begins"], batch["ends"]):
            split = joined(text.as_py()).split()
            edge = np.zeros(len(split) + 1, np.int64)
            for some, way in ((begins, 1), (ends, -1)):
                for one in some.as_py():
                    np.add.at(edge, np.array(one, np.int64), way)
            gone = np.cumsum(edge)[:-1] > 0
            removed.append(int(gone.sum()))
            digests.append(hashlib.sha256(b" ".join([split[k] for k in np.flatnonzero(~gone)])).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch["rep"], batch["th"], pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
            ["rep", "th", "n_removed", "kept_sha256"])


def recurring_phrases(classes):
    """fp, owner, owner_th, shard: the phrases that documents with different ids hold."""
    found = classes.select("rep", "th", F.explode("anchors").alias("fp")).groupBy("fp").agg(
        F.min(F.struct("rep", "th")).alias("low"), F.max("rep").alias("high")).filter("low.rep < high")
    found = stage(found.select("fp", F.col("low.rep").alias("owner"), F.col("low.th").alias("owner_th")), "recurring")
    # Documents with very many phrases are split over shards.
    sizes = found.groupBy("owner", "owner_th").agg(F.ceil(F.count("*") / SHARD).alias("parts"))
    n_shards = max(1, -(-found.count() // SHARD))
    return found.join(sizes, ["owner", "owner_th"]).select(
        "fp", "owner", "owner_th",
        F.pmod(F.xxhash64("owner", "owner_th", F.pmod(F.xxhash64("fp"), "parts")), F.lit(n_shards)).cast("int").alias("shard"))


def spans(docs):
    """(scanned, classes, spans, held): one row per row of ``docs`` with its words' digest; the
    classes; the repeated word ranges of classes; and the texts of the classes that share phrases."""
    docs = texts(docs).withColumn("th", F.xxhash64("text"))
    scanned = stage(docs.mapInArrow(_scan, "doc_id long, th long, n_words long, sha string, anchors array<long>"), "scanned")
    classes = stage(
        scanned.filter(F.col("doc_id").isNotNull() & (F.col("n_words") >= WINDOW)).groupBy("sha").agg(
            F.min(F.struct("doc_id", "th")).alias("low"), F.first("anchors").alias("anchors"))
        .select("sha", F.col("low.doc_id").alias("rep"), F.col("low.th").alias("th"), "anchors"), "classes")
    found = stage(recurring_phrases(classes), "phrases")
    routes = stage(
        classes.select("rep", "th", F.explode("anchors").alias("fp")).join(found.select("fp", "shard"), "fp")
        .select("rep", "th", "shard").distinct(), "routes")
    # The list of wanted texts grows with the input, so it is joined by a merge at every size.
    wanted = routes.select(F.col("rep").alias("doc_id"), "th").distinct().hint("merge")
    held = stage(
        docs.join(wanted, ["doc_id", "th"], "left_semi").dropDuplicates(["doc_id", "th"])
        .select(F.col("doc_id").alias("rep"), "th", "text"), "held")
    cut = found.groupBy(F.col("owner").alias("rep"), F.col("owner_th").alias("th")).agg(
        F.collect_list(F.struct("fp", "shard")).alias("wanted"))
    phrases = held.join(cut, ["rep", "th"]).select("text", "wanted").mapInArrow(_cut_phrases, "shard int, phrase string").distinct()
    salts = routes.groupBy("shard").agg(F.ceil(F.count("*") / DEALT).cast("int").alias("salts"))
    patterns = phrases.join(salts, "shard").select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("kind"),
        F.lit(None).cast("long").alias("rep"), F.lit(None).cast("long").alias("th"), F.col("phrase").alias("text"))
    streamed = held.join(routes.join(salts, "shard"), ["rep", "th"]).select(
        "shard", F.pmod(F.xxhash64("rep", "th"), "salts").cast("int").alias("salt"), F.lit(1).alias("kind"), "rep", "th", "text")
    located = stage(
        patterns.unionByName(streamed).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind")
        .mapInArrow(_locate, _LOCATED), "located")
    windows = located.filter("lows IS NOT NULL").select("block", F.posexplode(F.arrays_zip("h1", "h2", "lows")).alias("pos", "w")).select(
        F.col("block").alias("of"), "pos", "w.h1", "w.h2", "w.lows")
    owners = windows.groupBy("h1", "h2").agg(F.min("lows").alias("owner"))
    entries = windows.join(owners, ["h1", "h2"]).select("of", "pos", "owner")
    rows = located.filter("lows IS NULL").select("rep", "th", "block", "at", "starts")
    ranges = rows.groupBy("block").cogroup(entries.groupBy("of")).applyInArrow(
        _spans, "rep long, th long, begins array<long>, ends array<long>")
    return scanned, classes, stage(ranges, "spans"), held


def remove_repeats(docs):
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256."""
    scanned, classes, ranges, held = spans(docs)
    # A document may have ranges from several shards.
    whole = ranges.groupBy("rep", "th").agg(F.collect_list("begins").alias("begins"), F.collect_list("ends").alias("ends"))
    cut = held.join(whole, ["rep", "th"]).mapInArrow(_cut, "rep long, th long, n_removed long, kept_sha256 string")
    of_class = classes.select("sha", "rep", "th").join(cut, ["rep", "th"], "left").select(
        "sha", "rep", "n_removed", "kept_sha256")
    long_ones = F.col("doc_id").isNotNull() & (F.col("n_words") >= WINDOW)
    rest = scanned.filter(~long_ones).select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("sha").alias("kept_sha256"))
    copy = F.col("doc_id") > F.col("rep")
    judged = scanned.filter(long_ones).select("doc_id", "n_words", "sha").join(of_class, "sha").select(
        "doc_id", "n_words", F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(EMPTY)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"))
    return judged.unionByName(rest)

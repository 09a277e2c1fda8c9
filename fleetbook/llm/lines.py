"""Fuzzy line deduplication by MinHash over character shingles.

A line is what stands between line feeds, without spaces at both ends. Its set holds the
runs of eight characters (code points). Lines link where the sets' Jaccard similarity is at
least 0.8; equal lines are one class. Of each component of links the first line stays, by
doc_id, then by place; all others go. Lines of fewer than ``CHARS`` characters always stay.

One pass hashes and signs all lines of a batch at once. Lines are known by a 64-bit hash of
their bytes: two different lines of a corpus of 100 million share one with probability
3e-4. A line that repeats itself has fewer distinct runs than characters, so different
lines can have equal sets, of a single run too. Texts are only fetched for lines that share
a band.

Defined cases: null texts have no lines and stay as they are; rows that repeat doc_id and
text are one row of the result; rows without doc_id come last among occurrences; very long
lines are lines like others; no rows give no rows.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from fleetbook.llm import linking, words
from fleetbook.llm.tables import stage, texts

CHARS = 8
PIECE = 1 << 15                  # code points hashed or counted at a time
STEPS = 16                       # bytes taken off an end one by one
EXACT = 1 << 12                  # larger sets are counted by whole hashes
_U = np.uint64
_LINE_KIND = np.ones(256, np.uint8)
_LINE_KIND[10] = 0
_CHAR_TABLE = np.random.default_rng(8).integers(1, 1 << 64, 1 << 16, dtype=_U) | _U(1)


def _code_points(raw):
    """Code points of UTF-8 bytes."""
    return np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)


def _shingle_hashes(points):
    """Hashes of all runs of eight code points, by doubling: 2, 4, 8; a piece at a time,
    which stays in the processor's cache."""
    pieces = [_piece_hashes(points[at:at + PIECE + CHARS - 1]) for at in range(0, max(1, len(points) - CHARS + 1), PIECE)]
    return pieces[0] if len(pieces) == 1 else np.concatenate(pieces)


def _piece_hashes(points):
    h = _CHAR_TABLE[points & 0xFFFF] + points.astype(_U)
    for width, odd in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F), (4, 0x165667B19E3779F9)):
        if len(h) <= width:
            return np.zeros(0, _U)
        h = h[:-width] * _U(odd) + (h[width:] ^ (h[width:] >> _U(29)))
    return words.mix(h)


def _trim(raw, starts, ends):
    """Byte ranges without spaces at both ends."""
    starts, ends = starts.copy(), ends.copy()
    for _ in range(STEPS):
        open_ = np.flatnonzero(starts < ends)
        left = open_[words._SPACE[raw[starts[open_]]]]
        starts[left] += 1
        open_ = open_[starts[open_] < ends[open_]]
        right = open_[words._SPACE[raw[ends[open_] - 1]]]
        ends[right] -= 1
        if not len(left) and not len(right):
            return starts, ends
    # Long runs of spaces: by the places of all other bytes.
    solid = np.flatnonzero(~words._SPACE[raw])
    lo, hi = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    full = np.flatnonzero(hi > lo)
    ends = starts.copy()
    starts[full], ends[full] = solid[lo[full]], solid[hi[full] - 1] + 1
    return starts, ends


def lines_of(column):
    """(raw, starts, ends, row, place): trimmed lines of a text column that are not blank;
    ``place`` numbers all lines of a text from 0."""
    raw, offsets = words.buffers(column)
    starts, ends = words.runs(raw, offsets, _LINE_KIND)
    row = np.searchsorted(offsets, starts, side="right") - 1
    feeds = np.flatnonzero(raw == 10)
    place = np.searchsorted(feeds, starts) - np.searchsorted(feeds, offsets)[row]
    starts, ends = _trim(raw, starts, ends)
    keep = ends > starts
    return raw, starts[keep], ends[keep], row[keep], place[keep]


def line_sets(column):
    """The sets of an Arrow column of trimmed lines, each sorted."""
    raw, offsets = words.buffers(column)
    points, before = _code_points(raw), np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    hashes, out = _shingle_hashes(points), []
    for a, b in zip(before[offsets[:-1]].tolist(), before[offsets[1:]].tolist()):
        one = hashes[a:max(a, b - CHARS + 1)].copy()
        one.sort()
        fresh = np.ones(len(one), bool)
        np.not_equal(one[1:], one[:-1], out=fresh[1:])
        out.append(one[fresh])
    return out


#: A pair at 0.8 shares none of the 8 bands of 3 with probability 0.003, at 0.9 3e-5.
SCHEME = linking.Scheme(sets=line_sets, percent=80, hashes=32, bands=8, rows=3, seed=80, narrow=True)
_SIGNED = "doc_id long, th long, place int, line long, times long, n long, items long, bands array<long>, sig array<long>"
_PLAIN = "doc_id long, th long, n_lines int, lines array<struct<place: int, line: long>>"


def _cut(part):
    """Long enough lines of a batch: raw, ranges, row, place, hash, and a function from
    byte places to the number of code points before them."""
    raw, starts, ends, row, place = lines_of(part["text"])
    inner = np.flatnonzero((raw & 0xC0) == 0x80)

    def before(at):
        return at - np.searchsorted(inner, at)

    keep = before(ends) - before(starts) >= CHARS
    starts, ends, row, place = starts[keep], ends[keep], row[keep], place[keep]
    return raw, starts, ends, row, place, words.hash_runs(raw, starts, ends, lower=False), before


def _distinct(hashes, sizes):
    """How many distinct hashes each of the sets has that lie one after the other; those of
    a small set are told apart by their leading bits, 47 or more of them."""
    out, ends = sizes.copy(), np.cumsum(sizes)
    starts, at = ends - sizes, 0
    while at < len(sizes):
        # One sort for all sets of a block that stays in the processor's cache: the set's
        # number above the leading bits of the hash.
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + PIECE, side="right")))
        own = sizes[at:to]
        bits = _U(max(1, len(own) - 1).bit_length())
        key = np.repeat(np.arange(len(own), dtype=_U) << _U(64) - bits, own) | hashes[starts[at]:ends[to - 1]] >> bits
        key.sort()
        again = (key[1:][key[1:] == key[:-1]] >> _U(64) - bits).astype(np.int64)
        out[at:to] -= np.bincount(again, minlength=len(own))
        at = to
    for k in np.flatnonzero((sizes > EXACT) & (out < sizes)):
        out[k] = len(np.unique(hashes[starts[k]:ends[k]]))
    return out


def _sign(batches):
    for batch in batches:
        for part in words.slices(batch, "text", 1 << 20):
            raw, starts, ends, row, place, line, before = _cut(part)
            # A class needs its signature once: of equal lines of the batch the first one
            # by document and place goes on.
            named = part["doc_id"].is_valid().to_numpy(zero_copy_only=False)
            ids, th = part["doc_id"].fill_null(0).to_numpy(), part["th"].to_numpy()
            order = np.lexsort((place, th[row], ids[row], ~named[row]))
            _, at, times = np.unique(line[order], return_index=True, return_counts=True)
            at = order[at]
            by_place = np.argsort(at)
            at, times = at[by_place], times[by_place]
            starts, ends, row, place, line = starts[at], ends[at], row[at], place[at], line[at]
            hashes = _shingle_hashes(_code_points(raw))
            # The runs that lie within one of the lines, which ascend and do not touch.
            a = before(starts)
            n = before(ends) - a - CHARS + 1
            marks = np.zeros(len(hashes) + 1, np.int8)
            marks[a], marks[a + n] = 1, -1
            within = hashes[np.cumsum(marks[:-1], dtype=np.int8).view(bool)]
            bands, sig = linking.sign(SCHEME, within, n)
            distinct = _distinct(within, n)
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"].take(pa.array(row)), part["th"].take(pa.array(row)), pa.array(place.astype(np.int32)),
                 pa.array(line.view(np.int64)), pa.array(times.astype(np.int64)), pa.array(distinct.astype(np.int64)), pa.array(n.astype(np.int64)), bands, sig],
                ["doc_id", "th", "place", "line", "times", "n", "items", "bands", "sig"])


def _number(batches):
    """Hashes of the long enough lines of each text, by place."""
    for batch in batches:
        for part in words.slices(batch, "text", 1 << 21):
            raw, starts, ends, row, place, line, _ = _cut(part)
            bounds = np.searchsorted(row, np.arange(part.num_rows + 1))
            _, offsets = words.buffers(part["text"])
            feeds = np.diff(np.searchsorted(np.flatnonzero(raw == 10), offsets))
            n_lines = np.where(part["text"].is_null().to_numpy(zero_copy_only=False), 0, feeds + 1)
            rows = pa.StructArray.from_arrays([pa.array(place.astype(np.int32)), pa.array(line.view(np.int64))], ["place", "line"])
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], part["th"], pa.array(n_lines.astype(np.int32)),
                 pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), rows)],
                ["doc_id", "th", "n_lines", "lines"])


def _extract(batches):
    """Texts of the wanted places of each document."""
    for batch in batches:
        for text, places, names in zip(batch["text"], batch["places"].to_pylist(), batch["names"].to_pylist()):
            lines = text.as_py().split("\n")
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), pa.array([lines[p].strip(" \t\n\x0b\x0c\r") for p in places], pa.string())], ["rep", "text"])


def decisions(docs):
    """doc_id, n_lines, n_kept and dropped (the places of the lines that go, ascending) for
    every distinct row of doc_id and text."""
    docs = texts(docs).withColumn("th", F.xxhash64("text"))
    signed = docs.mapInArrow(_sign, _SIGNED)
    # Of equal lines the first occurrence is the smallest (no doc_id last).
    where = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "th", "place"))
    classes = stage(
        signed.groupBy(F.col("line").alias("rep")).agg(
            where.alias("at"), F.sum("times").alias("times"), F.first("n").alias("n"), F.first("items").alias("items"), F.first("bands").alias("bands"), F.first("sig").alias("sig")), "lines")

    def fetch(reps):
        wanted = classes.join(reps, "rep", "left_semi").groupBy("at.doc_id", "at.th").agg(
            F.collect_list(F.col("at.place")).alias("places"), F.collect_list("rep").alias("names"))
        named = docs.withColumn("doc_id", F.coalesce("doc_id", F.lit(-(1 << 63))))
        wanted = wanted.withColumn("doc_id", F.coalesce("doc_id", F.lit(-(1 << 63))))
        # Rows that repeat doc_id and text give their lines again.
        return named.join(wanted.hint("merge"), ["doc_id", "th"]).select("text", "places", "names").mapInArrow(
            _extract, "rep long, text string").dropDuplicates(["rep"])

    _, found = linking.link(SCHEME, classes.select("rep", "n", "items", "bands", "sig"), fetch)
    # The line that stays, for every class that has links or occurs again: the first
    # occurrence in its component. All other lines stay.
    linked = classes.select("rep", "at").join(found.withColumnRenamed("node", "rep"), "rep")
    again = classes.filter("times > 1").select("rep", "at").join(found.select(F.col("node").alias("rep")), "rep", "left_anti")
    stays = linked.join(linked.groupBy("component").agg(F.min("at").alias("stay")), "component").select(
        F.col("rep").alias("line"), "stay").union(again.select("rep", "at"))
    numbered = stage(docs.mapInArrow(_number, _PLAIN), "numbered")
    rows = numbered.select("doc_id", "th", "n_lines", F.explode("lines").alias("l")).select("doc_id", "th", "l.place", "l.line")
    stay = F.col("stay")
    gone = rows.join(stays, "line").filter(
        ~(stay.doc_id.eqNullSafe(F.col("doc_id")) & (stay.th == F.col("th")) & (stay.place == F.col("place"))))
    gone = gone.groupBy("doc_id", "th").agg(F.sort_array(F.collect_set("place")).alias("dropped"))
    each = numbered.select("doc_id", "th", "n_lines").distinct()
    key = [each[c].eqNullSafe(gone[c]) for c in ("doc_id", "th")]
    none = F.array().cast("array<int>")
    return each.join(gone, key, "left").select(
        each["doc_id"], each["th"], "n_lines", (F.col("n_lines") - F.coalesce(F.size("dropped"), F.lit(0))).alias("n_kept"),
        F.coalesce("dropped", none).alias("dropped"))


def _rewrite(batches):
    for batch in batches:
        out = []
        for text, dropped in zip(batch["text"].to_pylist(), batch["dropped"].to_pylist()):
            gone = set(dropped or ())
            out.append(text if text is None or not gone else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone))
        yield batch.drop_columns(["dropped"]).set_column(batch.schema.get_field_index("text"), "text", pa.array(out, pa.string()))


def deduplicate(docs):
    """``docs`` with the lines that go taken out of the texts; no row goes."""
    chosen = decisions(docs).filter(F.size("dropped") > 0).select(
        F.col("doc_id").alias("__id"), F.col("th").alias("__th"), F.col("dropped").alias("__gone"))
    text = F.col("text").cast("string")
    hit = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__th"))
    rows = docs.join(chosen, hit, "left").withColumn("text", text).withColumnRenamed("__gone", "dropped").drop("__id", "__th")
    return rows.mapInArrow(_rewrite, rows.drop("dropped").schema)

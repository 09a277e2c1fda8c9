"""Near-duplicate documents by b-bit MinHash.

Rules: A-Z is lower-cased; words are runs of anything but space and control characters 9
to 13; a document's set holds its distinct runs of five words as 64-bit hashes. Documents
link where ``100 * |intersection| >= percent * |union|``: ``SCHEME`` has 85, ``LOOSER`` 80.

One pass over the texts writes a small row per document: set size, a 128-bit fingerprint of
the set, keys of the bands of full minima, and the low bits of all minima packed into longs.
Copies (equal sets) then count once, as a class; ``linking`` finds the links of classes.

Defined cases: null or empty texts have an empty set and link with nothing, not even with
each other; rows without a doc_id are returned as their own (component null, kept); rows
that share a doc_id are judged each by its own text, and kept is true for all of them where
the smallest doc_id of their component is theirs; no rows give no rows.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from fleetbook.llm import linking, words
from fleetbook.llm.tables import stage, texts

SHINGLE = 5
_SIGNED = "doc_id long, th long, n_shingles long, f1 long, f2 long, bands array<long>, sig array<long>"


def shingle_sets(column):
    """The sets of an Arrow text column, each sorted."""
    hashes, bounds = words.word_hashes(column)
    return [words.shingles_of(hashes[a:b], SHINGLE) for a, b in zip(bounds[:-1], bounds[1:])]


#: A pair at 0.85 shares none of the 25 bands of 5 with probability 4e-7.
SCHEME = linking.Scheme(sets=shingle_sets, percent=85, hashes=192, bands=25, rows=5, seed=85)
#: A pair at 0.8 shares none of the 38 bands of 5 with probability 3e-7.
LOOSER = linking.Scheme(sets=shingle_sets, percent=80, hashes=192, bands=38, rows=5, seed=85)


def _sign(scheme):
    def run(batches):
        for batch in batches:
            for part in words.slices(batch, "text", 1 << 21):
                sets = shingle_sets(part["text"])
                sizes = np.array([len(s) for s in sets], np.int64)
                flat = np.concatenate(sets)
                bands, sig = linking.sign(scheme, flat, sizes)
                edges = np.concatenate([[0], np.cumsum(sizes)])
                sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(x)]) for x in (flat, words.mix(flat ^ np.uint64(0xA5A5A5A5A5A5A5A5)))]
                f1, f2 = (pa.array((s[edges[1:]] - s[edges[:-1]]).view(np.int64)) for s in sums)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["th"], pa.array(sizes), f1, f2, bands, sig],
                    ["doc_id", "th", "n_shingles", "f1", "f2", "bands", "sig"])
    return run


def _grouped(docs, scheme):
    docs = texts(docs).withColumn("th", F.xxhash64("text"))
    signed = stage(docs.mapInArrow(_sign(scheme), _SIGNED), "signed")
    known = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    sets = stage(
        known.groupBy("f1", "f2", "n_shingles").agg(
            F.min(F.struct("doc_id", "th")).alias("low"), F.first("bands").alias("bands"), F.first("sig").alias("sig")), "sets")
    # A class is named by its smallest doc_id; where several classes have the same one, all
    # but one of them by a hash.
    owner = sets.groupBy("low.doc_id").agg(F.min(F.struct("f1", "f2", "n_shingles")).alias("o")).select(
        F.struct("doc_id").alias("own"), "o.*")
    classes = stage(
        sets.join(owner, ["f1", "f2", "n_shingles"], "left").select(
            "f1", "f2", F.col("n_shingles").alias("n"), F.col("low.doc_id").alias("doc_id"), F.col("low.th").alias("th"),
            F.when(F.col("own.doc_id") == F.col("low.doc_id"), F.col("low.doc_id"))
            .otherwise(F.xxhash64("f1", "f2", "n_shingles")).alias("rep"), "bands", "sig"), "classes")

    def fetch(reps):
        # The list grows with the input, so it is joined by a merge at every size.
        wanted = classes.join(reps, "rep", "left_semi").select("rep", "doc_id", "th")
        return docs.join(wanted.hint("merge"), ["doc_id", "th"]).select("rep", "text").dropDuplicates(["rep"])

    links, found = linking.link(scheme, classes, fetch)
    degree = links.select(F.col("a").alias("rep")).union(links.select("b")).groupBy("rep").agg(F.count("*").alias("n_links"))
    linked = found.withColumnRenamed("node", "rep").join(classes.select("rep", "doc_id", "th"), "rep")
    low = linked.groupBy("component").agg(F.min(F.struct("doc_id", "th")).alias("low"))
    linked = linked.select("rep", "component").join(low, "component").select("rep", "low")
    own = F.struct(classes["doc_id"], classes["th"])
    of_class = (
        classes.join(linked, "rep", "left").join(degree, "rep", "left")
        .select("f1", "f2", F.col("n").alias("n_shingles"), F.coalesce("low", own).alias("low"), "n_links"))
    alone = signed.filter("n_shingles = 0 OR doc_id IS NULL").select(
        "doc_id", "th", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"),
        F.lit(True).alias("first"))
    rows = known.join(of_class, ["f1", "f2", "n_shingles"]).select(
        "doc_id", "th", "n_shingles", F.col("low.doc_id").alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.expr("doc_id = low.doc_id AND th = low.th").alias("first"))
    return rows.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def near_duplicates(docs, scheme=SCHEME):
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept, n_links (the
    links of its class with other classes that were confirmed; pairs inside a component that
    is known already are not looked at)."""
    return _grouped(docs, scheme).select("doc_id", "n_shingles", "component_id", "kept", "n_links")


def one_per_group(docs, scheme=SCHEME):
    """The rows of ``docs`` that stay: of each group the one with the smallest doc_id, and
    one of several rows with the same doc_id and text. Rows without a doc_id stay."""
    named = docs.filter("doc_id IS NOT NULL").withColumn("__th", F.xxhash64(F.col("text").cast("string")))
    kept = _grouped(docs, scheme).filter("first AND doc_id IS NOT NULL").select("doc_id", F.col("th").alias("__th"))
    first = named.dropDuplicates(["doc_id", "__th"]).join(kept, ["doc_id", "__th"], "left_semi")
    return first.select(*docs.columns).unionByName(docs.filter("doc_id IS NULL"))

"""Links between sets whose Jaccard similarity reaches a threshold, by b-bit MinHash.

A ``Scheme`` names the sets of a text and the sizes of its signature. ``sign`` computes
minima, band keys and packed low bits; ``link`` finds the links among distinct sets:

1. Sets that share a band key are candidates. Every bucket first compares its members with
   one of them, its centre, chosen differently in each band: rows grow with members, not
   with pairs. The packed bits estimate the similarity, corrected for minima that agree by
   chance; pairs far below the threshold go. The rest are confirmed on the full sets.
2. Components of the confirmed links. Buckets that still hold several components have the
   pairs between those estimated, and confirmed on the full sets, inside tiles of bounded
   size; only links leave a tile. So no pair that shares a band key is left out, and pairs
   inside a component, which cannot change the result, are not looked at.
"""

from dataclasses import dataclass
from typing import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from fleetbook.llm import words
from fleetbook.llm.components import components
from fleetbook.llm.tables import stage

BITS = 2                         # low bits kept of each minimum
TILE = 2048                      # most members a side of a tile
TILE_ITEMS = 2_000_000           # and about the most set items
_HALF = 0x5555555555555555


@dataclass(frozen=True)
class Scheme:
    """``sets`` maps an Arrow text column to a list of sorted arrays of distinct hashes."""

    sets: Callable
    percent: int
    hashes: int
    bands: int
    rows: int
    seed: int
    narrow: bool = False         # minima of 32 bits: cheaper, for sets of some thousand hashes

    @property
    def longs(self):
        return -(-self.hashes * BITS // 64)

    @property
    def least_agreeing(self):
        """Agreeing minima that a pair at the threshold has, less four standard errors."""
        chance = 1 / (1 << BITS)
        agree = chance + (1 - chance) * self.percent / 100
        return int(np.floor(self.hashes * agree - 4 * (self.hashes * agree * (1 - agree)) ** 0.5))

    @property
    def factors(self):
        odd = np.random.default_rng(self.seed).integers(0, 1 << 64, self.hashes, dtype=np.uint64)
        return odd | np.uint64(1)


def minima(scheme, flat, sizes):
    """Minima under all hashes of sets that lie one after the other in ``flat``; empty sets
    get all ones."""
    out = np.full((len(sizes), scheme.hashes), np.uint64(0xFFFFFFFFFFFFFFFF))
    full = np.flatnonzero(sizes)
    if len(full):
        starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
        factors = scheme.factors
        if scheme.narrow:
            flat, factors = (flat >> np.uint64(32)).astype(np.uint32), factors.astype(np.uint32)
        buffer = np.empty_like(flat)
        for k, odd in enumerate(factors):
            np.multiply(flat, odd, out=buffer)
            out[full, k] = np.minimum.reduceat(buffer, starts)
    return words.mix(out)


def band_keys(scheme, low):
    keys = np.empty((len(low), scheme.bands), np.uint64)
    for band in range(scheme.bands):
        acc = np.full(len(low), band + 1, np.uint64)
        for row in range(scheme.rows):
            acc = words.mix(acc * np.uint64(0x9E3779B97F4A7C15) + low[:, band * scheme.rows + row])
        keys[:, band] = acc
    return keys


def pack(scheme, low):
    """The low bits of all minima side by side in longs; unused bits are zero."""
    per = 64 // BITS
    bits = np.zeros((len(low), scheme.longs * per), np.uint64)
    bits[:, :scheme.hashes] = low & np.uint64((1 << BITS) - 1)
    shifts = np.arange(per, dtype=np.uint64) * np.uint64(BITS)
    return np.bitwise_or.reduce(bits.reshape(len(low), scheme.longs, per) << shifts, axis=2)


def lists(values):
    """A matrix of 64-bit numbers as an Arrow list column."""
    n, width = values.shape
    flat = pa.array(np.ascontiguousarray(values).reshape(-1).view(np.int64))
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), flat)


def sign(scheme, flat, sizes):
    """Arrow columns (band keys, packed bits) of sets in ``flat``."""
    low = minima(scheme, flat, sizes)
    return lists(band_keys(scheme, low)), lists(pack(scheme, low))


def agreeing(scheme, a, b):
    """Column: how many packed minima agree, counted by bits."""
    def one(i):
        x = a[i].bitwiseXOR(b[i])
        return F.bit_count(F.bitwise_not(x.bitwiseOR(F.shiftrightunsigned(x, 1))).bitwiseAND(F.lit(_HALF)))
    unused = scheme.longs * 64 // BITS - scheme.hashes
    return sum((one(i) for i in range(1, scheme.longs)), one(0)) - unused


def similarity(scheme, a, b):
    """Column: estimated similarity, corrected for minima that agree by chance."""
    chance = 1 / (1 << BITS)
    return (agreeing(scheme, a, b) / scheme.hashes - chance) / (1 - chance)


def _reaches(scheme, x, y):
    both = np.concatenate((x, y))
    both.sort()
    both = np.count_nonzero(both[1:] == both[:-1])
    return 100 * both >= scheme.percent * (len(x) + len(y) - both)


def _confirm(scheme):
    def run(batches):
        for batch in batches:
            _, at, of = np.unique(batch["a"].to_numpy(), return_index=True, return_inverse=True)
            first = scheme.sets(batch["text_a"].take(pa.array(at)))
            keep = [_reaches(scheme, first[k], y) for k, y in zip(of, scheme.sets(batch["text_b"]))]
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _matrix(column):
    flat = column.flatten().to_numpy()
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _tiles(scheme):
    """Links of tiles between different components. Rows come sorted by tile and rep; a tile
    may go on in the next batch. A pair is looked at only in the first band that both share,
    so once in all tiles; components that a link joins are one for the rest of the batch."""
    least = scheme.least_agreeing + scheme.longs * 64 // BITS - scheme.hashes

    def pairs_of(lo, hi, c):
        """Rows (k, m) of one tile that may link."""
        i, j, band = c["i"][lo], c["j"][lo], (c["bands"][lo] == c["key"][lo]).argmax()
        rows = np.arange(lo, hi)
        left, right = rows[c["block"][lo:hi] == i], rows[c["block"][lo:hi] == j]
        for at in range(0, len(left), max(1, 65536 // max(1, len(right)))):
            part = left[at:at + max(1, 65536 // max(1, len(right)))]
            k, m = np.repeat(part, len(right)), np.tile(right, len(part))
            fit = (c["component"][k] != c["component"][m]) & (
                100 * np.minimum(c["n"][k], c["n"][m]) >= scheme.percent * np.maximum(c["n"][k], c["n"][m]))
            if i == j:
                fit &= m > k
            k, m = k[fit], m[fit]
            x = c["sig"][k] ^ c["sig"][m]
            same = np.bitwise_count(~(x | x >> np.uint64(1)) & np.uint64(_HALF)).sum(axis=1, dtype=np.int64)
            k, m = k[same >= least], m[same >= least]
            once = (c["bands"][k] == c["bands"][m]).argmax(axis=1) == band
            yield k[once], m[once]

    def links_of(table):
        c = {x: table[x].to_numpy() for x in ("key", "i", "j", "block", "n", "rep", "component")}
        c["sig"], c["bands"] = _matrix(table["sig"]).view(np.uint64), _matrix(table["bands"])
        edge = np.flatnonzero((np.diff(c["key"]) != 0) | (np.diff(c["i"]) != 0) | (np.diff(c["j"]) != 0)) + 1
        found = []
        for lo, hi in zip(np.append(0, edge), np.append(edge, table.num_rows)):
            found += list(pairs_of(lo, hi, c))
        k = np.concatenate([f[0] for f in found]) if found else np.zeros(0, int)
        m = np.concatenate([f[1] for f in found]) if found else k
        needed = np.unique(np.concatenate([k, m]))
        sets = dict(zip(needed.tolist(), scheme.sets(table["text"].take(pa.array(needed))))) if len(needed) else {}
        label, rep, out = c["component"].copy(), c["rep"], []
        for x, y in zip(k.tolist(), m.tolist()):
            if label[x] != label[y] and _reaches(scheme, sets[x], sets[y]):
                out.append((min(rep[x], rep[y]), max(rep[x], rep[y])))
                label[label == label[y]] = label[x]
        ends = list(zip(*out)) or [[], []]
        return pa.RecordBatch.from_arrays([pa.array(e, pa.int64()) for e in ends], ["a", "b"])

    def run(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch]).combine_chunks()
            if not table.num_rows:
                continue
            last = table.slice(table.num_rows - 1).to_pylist()[0]
            same = np.ones(table.num_rows, bool)
            for x in ("key", "i", "j"):
                same &= table[x].to_numpy() == last[x]
            cut = table.num_rows - int(same.sum())
            rest = table.slice(cut)
            if cut:
                yield links_of(table.slice(0, cut).combine_chunks().to_batches()[0])
        if rest is not None and rest.num_rows:
            yield links_of(rest.combine_chunks().to_batches()[0])
    return run


def _confirmed(scheme, pairs, have):
    a, b = (have.select(F.col("rep").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab")
    return pairs.join(a, "a").join(b, "b").select("a", "text_a", "b", "text_b").mapInArrow(
        _confirm(scheme), "a long, b long")


def link(scheme, classes, fetch):
    """(links, found) among distinct sets: links (a, b) that were confirmed, and (node,
    component) of all that have one.

    ``classes`` has rep (long, unique), n (the size of the set), bands, sig, and may have
    items, which bounds tiles in place of n where texts hold more than their sets; ``fetch``
    gets a frame of the reps whose texts are needed and returns (rep, text)."""
    # Rows of the buckets are narrow, as all bands of all sets are shuffled: what else a set
    # has is joined to the few that share a bucket. A bucket's centre is its least name under
    # a mask of the bucket's own, which a minimum over plain longs finds.
    entries = classes.select("rep", F.explode("bands").alias("key"))
    mask = F.xxhash64("key")
    buckets = entries.groupBy("key").agg(
        F.count("*").alias("size"), F.min(F.col("rep").bitwiseXOR(mask)).alias("low")
    ).filter("size > 1").select("key", "size", F.col("low").bitwiseXOR(mask).alias("centre"))
    shared = stage(entries.join(buckets, "key"), "buckets")
    have = stage(fetch(shared.select("rep").distinct()), "texts")
    a, b = (classes.select(F.col("rep").alias(c), F.col("n").alias(f"n{c}"), F.col("sig").alias(f"s{c}")) for c in "ab")
    star = (
        shared.filter("rep <> centre")
        .select(F.least("rep", "centre").alias("a"), F.greatest("rep", "centre").alias("b")).distinct()
        .join(a, "a").join(b, "b")
        .filter(F.expr(f"100 * least(na, nb) >= {scheme.percent} * greatest(na, nb)"))
        .filter(agreeing(scheme, F.col("sa"), F.col("sb")) >= scheme.least_agreeing).select("a", "b"))
    links = stage(_confirmed(scheme, star, have), "links")
    found = components(links)

    # Buckets of three and more whose members are not all connected yet.
    labelled = shared.filter("size > 2").join(found.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
        "component", F.coalesce("component", "rep"))
    open_ = labelled.groupBy("key").agg(
        F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("key")
    items = F.col("items" if "items" in classes.columns else "n").alias("items")
    inside = stage(
        labelled.select("key", "rep", "component").join(open_, "key")
        .join(classes.select("rep", "n", items, "sig", "bands"), "rep"), "open")
    blocks = inside.groupBy("key").agg(
        F.greatest(F.ceil(F.count("*") / TILE), F.ceil(F.sum("items") / TILE_ITEMS)).cast("int").alias("blocks"))
    members = (
        inside.join(blocks, "key").join(have, "rep")
        .withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("key", "rep", "n", "component", "sig", "bands", "text", "block",
                F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")))
    tiles = members.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "rep")
    extra = stage(tiles.mapInArrow(_tiles(scheme), "a long, b long").distinct(), "links")
    if not extra.isEmpty():
        links = links.union(extra).distinct()
        found = components(links)
    return links, found

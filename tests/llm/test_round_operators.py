"""The filter audit, the alignment of tokenizers and the removal of repeated passages, against
brute force and on nulls, empty and long texts, ties, repeated rows, empty tables and extra
columns with clashing names."""

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from fleetbook.llm import align, audit, phrases
from fleetbook.llm.tables import prepare

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n long, mask long, part string, block long, rep long, sha string"


def docs_of(spark, rows):
    rows = [(i, t, lang, "s", 1, 2, "p", 3, 4, "x") for i, t, lang in rows]
    return prepare(spark).createDataFrame(rows, DOCS)


# ---- 11 ----------------------------------------------------------------------------------

def brute_audit(rows, labels):
    lows, good, toxic = {}, set(), set()
    for i, t, _ in rows:
        if i is not None:
            lows[t or ""] = min(i, lows.get(t or "", i))
    for i, q, x in labels:
        if i is not None:
            good |= {i} if q == 1 else set()
            toxic |= {i} if x == 1 else set()
    found = []
    for i, t, lang in rows:
        t = t or ""
        w = WORD.findall(t)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                 "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and i > lows[t]}
        found.append((lang or "", fails, i in good, i in toxic))
    out = {}
    for part in {f[0] for f in found}:
        alive_of, shapley = {}, collections.Counter()
        for order in itertools.permutations("ABCDE"):
            alive = [f for f in found if f[0] == part]
            every = alive
            for step, x in enumerate(order, 1):
                gone = [f for f in alive if f[1][x]]
                alive = [f for f in alive if not f[1][x]]
                shapley[x] += len(gone)
                alive_of[order, step] = (
                    len(alive), len(gone), sum(f[1][x] for f in every) - len(gone),
                    sum(f[1][x] and sum(f[1].values()) == 1 for f in every), sum(f[2] for f in gone), sum(f[3] for f in gone), x)
        for (order, step), v in alive_of.items():
            out[part, "".join(order), step] = (*v[:-1], shapley[v[-1]])
    return out


def test_audit(spark):
    rng = random.Random(4)
    long = " ".join(f"w{k}" for k in range(150))
    some = [None, "", "  ", "one", "ONE TWO", "a#b", long, long + " #", "SHOUT " * 120, "same word " * 90, "é ü " * 200]
    rows = [(k if k % 9 else None, rng.choice(some), rng.choice(["en", None, "", "de"])) for k in range(1, 120)]
    rows += rows[:7] + [(5, long, "en"), (5, "other", "en"), (5, "other", "de")]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for k in range(0, 60, 2)] * 2 + [(None, 1, 1), (4, 1, 0), (999, 1, 1)]
    frame = docs_of(spark, rows)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {tuple(r)[:3]: tuple(r)[3:] for r in audit.interactions(frame, marks).collect()}
    assert got == brute_audit(rows, labels)
    assert audit.interactions(frame.limit(0), marks).count() == 0
    assert audit.interactions(frame, marks.limit(0)).filter("good_lost + toxic_lost > 0").count() == 0


def test_audit_of_stated_orders(spark):
    counted = spark.createDataFrame([("x", 3, 10, 1, 0), ("x", 0, 5, 0, 0), ("x", 2, 4, 0, 1)], "part string, mask long, n long, good long, toxic long")
    got = {(r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"])
           for r in audit.audit(counted, ("A", "B"), ["AB", "BA"]).collect()}
    assert got == {("AB", 1): (9, 10, 0, 0), ("AB", 2): (5, 4, 10, 4), ("BA", 1): (5, 14, 0, 4), ("BA", 2): (5, 0, 10, 0)}


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1 << 20])
def test_facts_do_not_depend_on_pieces(monkeypatch, size):
    monkeypatch.setattr(audit, "PIECE", size)
    for text in ("", " ", "a", " a  b\tc\x0bA a ", "é x é", "ab" * 9 + " ab", "x\n"):
        w = WORD.findall(text)
        assert audit.facts(text)[:2] == (len(w), len(set(w)))


# ---- 12 ----------------------------------------------------------------------------------

def brute_align(texts):
    left, right = align.coder(align.ByteLevel, align.BYTE_BPE), align.coder(align.Pieces, align.PIECE_BPE)
    counts, found = collections.Counter(), []
    for t in texts:
        a, b = (c.encode([t])[0] for c in (left, right)) if t else ([], [])
        raw = b" " + (t or "").encode()
        if not t or b"".join(left.pieces[k] for k in a) != raw or b"".join(right.pieces[k] for k in b) != raw:
            found.append(None)
            continue
        ends = [list(itertools.accumulate(len(c.pieces[k]) for k in ids)) for c, ids in ((left, a), (right, b))]
        groups, links, i, j = [], [], 0, 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            x, y = i, j
            while i < len(a) and ends[0][i] <= cut:
                i += 1
            while j < len(b) and ends[1][j] <= cut:
                j += 1
            groups.append((a[x:i], b[y:j]))
            links += [(a[u], b[v]) for u in range(x, i) for v in range(y, j)
                      if max(ends[0][u] - len(left.pieces[a[u]]), ends[1][v] - len(right.pieces[b[v]])) < min(ends[0][u], ends[1][v])]
        counts.update(links)
        found.append((len(a), len(b), groups, links))
    best = collections.Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    for f in found:
        if f is None:
            yield 0, 0, 0, 0, "", 0, 0
        else:
            text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in f[2])
            yield (f[0], f[1], len(f[2]), len(f[3]), hashlib.sha256(text.encode()).hexdigest(),
                   sum(counts[x] == best[x[1]] for x in f[3]), sum(counts[x] for x in f[3]))


def test_alignment(spark, monkeypatch):
    rng = random.Random(3)
    pool = ["tokenization", " ", "  ", "\n", "\t", "straße", "naïve", "漢字", "<s>", "<|endoftext|>", "<0x41>", "1234", "don't", "ﬁ", "\x00", "🙂", "é", "A"]
    texts = [None, "", " ", "▁", "a▁b", "x" * 3000, " " * 2000 + "end", "plain words", "plain words"]
    texts += ["".join(rng.choice(pool) for _ in range(rng.randrange(1, 40))) for _ in range(120)]
    rows = [(k if k % 11 else None, t, None) for k, t in enumerate(texts)] + [(1, "again", None), (1, "again", None), (1, "other", None)]
    frame = docs_of(spark, rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    got = align.alignments(frame).collect()
    prepare(spark)
    want = [(i, *w) for (i, _, _), w in zip(rows, brute_align([t for _, t, _ in rows]))]
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))
    assert sum(w[1] == 0 for w in want) >= 4
    assert align.alignments(frame.limit(0)).count() == 0


def test_ranks_encode_as_the_file_does():
    coder = align.coder(align.ByteLevel, align.BYTE_BPE)
    rng = random.Random(6)
    letters = [chr(k) for k in range(0x250)] + list("  \n\t'sreltvmd“”‘’…–—•€ abcdefghij0123456789")
    texts = ["".join(rng.choices(letters, k=rng.randrange(1, 80))) for _ in range(4000)] + ["漢字", " " * 1_000_000 + "x"]
    assert coder.ranked and coder.encode(texts) == [
        e.ids for e in coder.tokenizer.encode_batch([" " + t for t in texts], add_special_tokens=False)]


def test_walk_covers_both_sides():
    rng = random.Random(8)
    for _ in range(300):
        last = rng.randrange(1, 60)
        a, b = (sorted({*rng.sample(range(1, last + 1), rng.randrange(0, last)), last}) for _ in range(2))
        runs, gaps, left, right = align.walk(a, b)
        pieces = sorted([(i, j, i + n, j + n) for i, j, n in runs] + gaps)
        assert [p[:2] for p in pieces] == [(0, 0), *[p[2:] for p in pieces[:-1]]] and pieces[-1][2:] == (len(a), len(b))
        assert {a[i + k] for i, j, n in runs for k in range(n)} | {a[g[2] - 1] for g in gaps} == set(a) & set(b)
        assert len(left) == len(right) == sum((g[2] - g[0]) + (g[3] - g[1]) - 1 for g in gaps)


# ---- 13 ----------------------------------------------------------------------------------

def brute_repeats(rows):
    firsts = {}
    split = [(i, WORD.findall(t or "")) for i, t, _ in rows]
    for i, w in split:
        for p in range(len(w) - 49 if i is not None else 0):
            key = tuple(w[p:p + 50])
            firsts[key] = min(i, firsts.get(key, i))
    for i, w in split:
        gone = set()
        for p in range(len(w) - 49 if i is not None else 0):
            if firsts[tuple(w[p:p + 50])] < i:
                gone |= set(range(p, p + 50))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        yield i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()


def passages():
    rng = random.Random(5)
    words = [f"w{k}" for k in range(4000)] + ["é", "漢字", " "]

    def some(n):
        return [rng.choice(words) for _ in range(n)]

    shared = [some(n) for n in (49, 50, 51, 60, 120, 400)] + [["na"] * 80, ["na", "no"] * 60]
    rows = []
    for k in range(1, 90):
        w = some(rng.randrange(0, 120))
        for _ in range(rng.randrange(0, 3)):
            p = rng.choice(shared)
            a = rng.randrange(0, max(1, len(p) - 55))
            w += p[a:a + rng.randrange(45, 130)] + some(rng.randrange(0, 20))
        rows.append((k * 3 % 97, rng.choice([" ", "\n", " \t "]).join(w), None))
    rows += [(200, None, None), (201, "", None), (202, " \n", None), (None, rows[3][1], None), (None, rows[4][1], None)]
    rows += [(300 + k, rows[k % 3][1], None) for k in range(9)] + [rows[5], (rows[6][0], rows[7][1], None)]
    rows += [(400, " ".join(shared[0]), None), (2, " ".join(shared[1]), None), (401, " ".join(some(30_000) + shared[5]), None)]
    return rows


@pytest.mark.parametrize("shard, dealt, block", [(4096, 4096, 2 << 20), (3, 2, 500)])
def test_repeats(spark, monkeypatch, shard, dealt, block):
    monkeypatch.setattr(phrases, "SHARD", shard)
    monkeypatch.setattr(phrases, "DEALT", dealt)
    rows = passages()
    frame = docs_of(spark, rows)
    got = sorted(str(tuple(r)) for r in phrases.remove_repeats(frame).collect())
    assert got == sorted(str(x) for x in brute_repeats(rows))


def test_repeats_of_nothing(spark):
    frame = docs_of(spark, [(1, "few words", None), (2, None, None)])
    assert phrases.remove_repeats(frame.limit(0)).count() == 0
    assert {tuple(r)[:3] for r in phrases.remove_repeats(frame).collect()} == {(1, 2, 0), (2, 0, 0)}


def test_sliding_minima():
    rng = np.random.default_rng(1)
    for n in (0, 1, 4, 5, 6, 23):
        x = rng.integers(0, 50, n).astype(np.uint64)
        assert phrases.sliding_minima(x, 5).tolist() == [x[k:k + 5].min() for k in range(n - 4)]

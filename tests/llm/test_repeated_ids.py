"""One doc_id on rows of different texts, labels without documents, names that clash, and
near duplicates against brute force."""

import numpy as np
from pyspark.sql import functions as F

from fleetbook.llm import minhash, quality, reshard
from fleetbook.llm.tables import prepare


def _frame(spark, rows, schema="doc_id long, text string"):
    return prepare(spark).createDataFrame(rows, schema)


def _words(prefix, n):
    return " ".join(f"{prefix}{i}" for i in range(n))


def test_texts_of_one_doc_id_keep_their_own_links(spark):
    a, b = _words("a", 300), _words("b", 300)
    frame = _frame(spark, [(1, a), (1, b), (2, a + " tail"), (3, b + " tail"), (4, b), (5, _words("c", 40)), (1, a)])
    got = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(frame).collect())
    assert got == [(1, 1, True)] * 3 + [(2, 1, False), (3, 1, False), (4, 1, False), (5, 5, True)]
    left = sorted((r["doc_id"], r["text"][0]) for r in minhash.one_per_group(frame).collect())
    assert left == [(1, "a"), (1, "b"), (5, "c")]
    # Both texts of doc 7 lie in one group: one of them stays.
    one = _frame(spark, [(7, a), (7, a + " tail"), (9, a + " tail end")])
    assert [r["doc_id"] for r in minhash.one_per_group(one).collect()] == [7]


def test_groups_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(30):
        base = [f"w{x}" for x in rng.integers(0, 400, 150)]
        for cut in rng.integers(0, 20, 6):
            rows.append((len(rows) * 7 % 181, " ".join(base[: 150 - cut] + [f"n{k}x{i}" for i in range(int(cut) // 2)])))
    rows += [(500, ""), (501, None), (502, "two words"), (503, "Two  words")]
    sets = {}
    for i, text in rows:
        words = [w.lower() for w in (text or "").split()]
        sets[i] = {tuple(words[j:j + 5]) for j in range(len(words) - 4)} or ({tuple(words)} if words else set())
    root = {i: i for i in sets}
    changed = True
    links = [(x, y) for x in sets for y in sets if x < y and sets[x] and 100 * len(sets[x] & sets[y]) >= 85 * len(sets[x] | sets[y])]
    while changed:
        changed = False
        for x, y in links:
            low = min(root[x], root[y])
            if root[x] != low or root[y] != low:
                root[x] = root[y] = low
                changed = True
    got = minhash.near_duplicates(_frame(spark, rows)).collect()
    assert len(links) > 100 and len(got) == len(rows)
    for r in got:
        assert (r["component_id"], r["kept"], r["n_shingles"]) == (root[r["doc_id"]], root[r["doc_id"]] == r["doc_id"], len(sets[r["doc_id"]]))


def test_labels_of_absent_documents_spend_no_sample(spark):
    rows = [(i, _words("good" if i % 2 else "bad", 30 + i % 7)) for i in range(120)]
    labels = [(i, i % 2) for i in range(120)]
    absent = labels + [(i, 1) for i in range(1000, 6000)]
    docs = _frame(spark, rows)
    with_absent, without = (
        quality.train(docs, _frame(spark, x, "doc_id long, quality int"), sample=100) for x in (absent, labels))
    assert np.any(without) and np.array_equal(with_absent, without)
    # One doc_id on many rows: no more than ``sample`` of them teach, and nothing fails.
    many = _frame(spark, rows + [(3, f"{_words('x', 5)} {i}") for i in range(500)])
    assert np.any(quality.train(many, _frame(spark, labels, "doc_id long, quality int"), sample=50))


def test_any_column_names_are_resharded(spark):
    names = ["first", "from", "to", "o", "b", "row", "__x", "__size", "__old", "shard", "size"]
    rows = [(i, f"text {i}", *range(len(names))) for i in range(40)]
    docs = _frame(spark, rows, "doc_id long, text string, " + ", ".join(f"`{n}` long" for n in names))
    placed = reshard.reshard(docs, new=3)
    assert sorted(placed.columns) == sorted(docs.columns + ["slot"])
    keep = [f"`{c}`" for c in docs.columns if c != "shard"]
    assert sorted(map(tuple, placed.select(*keep).collect())) == sorted(map(tuple, docs.select(*keep).collect()))


def test_one_doc_id_on_all_rows_is_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(reshard, "BLOCK_ROWS", 50)
    docs = _frame(spark, [(None if i % 2 else 1, f"text {i}") for i in range(3000)])
    table = reshard.store(docs, old=F.lit(0))
    sizes = [r["count"] for r in table.groupBy("__old", "__block").count().collect()]
    assert sum(sizes) == 3000 and max(sizes) < 600
    placed = reshard.reshard(docs, new=4)
    size = {r["shard"]: r["s"] for r in placed.groupBy("shard").agg(F.sum(reshard.size_of(F.col("text"))).alias("s")).collect()}
    assert placed.count() == 3000 and max(size.values()) - min(size.values()) < 40

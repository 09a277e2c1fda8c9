"""Each operator and stage on nulls, empty and long texts, ties, repeated rows, empty
tables and extra columns with clashing names."""

import hashlib
import itertools

import numpy as np
import pytest

import corpus_pipeline
from fleetbook.llm import (
    decontaminate, lengths, lines, linking, minhash, mixing, pii, quality, reshard, topk, warc, words,
)
from fleetbook.llm.components import components
from fleetbook.llm.tables import prepare

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, th string, slot int, rep int"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
NEAR = " ".join(f"near{i}" for i in range(200))
ITEM = "which river crosses the old town of marn before it meets the southern sea answer the velda"


def docs_of(spark, rows):
    rows = [(i, t, None, "s", None, 1, "x", 2, 3) for i, t in rows]
    return prepare(spark).createDataFrame(rows, DOCS)


ROWS = [(1, None), (2, ""), (3, "   \n\t"), (4, "one two"), (5, "one two"), (5, "one two"), (6, "One  TWO"), (None, "no id here at all"),
        (7, LONG), (8, NEAR), (9, NEAR + " tail"), (10, NEAR), (11, "intro words " + ITEM + " closing words"), (12, "é" * 40 + "\nline")]


@pytest.fixture(scope="module")
def docs(spark):
    return docs_of(spark, ROWS).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(4, 1, 0), (5, 0, 0), (8, 1, 1), (9, None, 1), (None, 1, 0), (77, 1, 0), (4, 1, 0), (7, 1, None)],
        "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (None, ITEM), (1, ITEM)], "item_id long, text string")


def test_minhash(spark, docs):
    got = {(r["doc_id"]): r for r in minhash.near_duplicates(docs).collect()}
    assert minhash.near_duplicates(docs).count() == len(ROWS)
    assert got[1]["n_shingles"] == got[2]["n_shingles"] == got[3]["n_shingles"] == 0 and got[1]["kept"] and got[2]["component_id"] == 2
    assert got[4]["n_shingles"] == 1 and got[6]["component_id"] == got[5]["component_id"] == 4
    assert got[9]["component_id"] == got[10]["component_id"] == 8 and not got[9]["kept"]
    assert got[None]["component_id"] is None and got[None]["kept"]
    kept = minhash.one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 7, 8, 11, 12]


def test_pipeline_drops_copies_from_80_percent_on(spark):
    # Pairs of 200 words with the last 18 or 24 changed: 0.83 and 0.78 of the sets are common.
    rows = []
    for k in range(20):
        base = [f"p{k}x{i}" for i in range(204)]
        rows += [(100 * k + n, " ".join(base[:204 - n] + [f"q{k}y{n}z{i}" for i in range(n)])) for n in (0, 18, 24)]
    frame = docs_of(spark, rows)
    left = {r["doc_id"] for r in corpus_pipeline.near_duplicate_stage(spark, frame, "").collect()}
    assert left == {100 * k + n for k in range(20) for n in (0, 24)}
    assert minhash.near_duplicates(frame).filter("kept").count() == len(rows)


def test_estimate_follows_the_similarity(spark):
    sets = [words.shingles_of(np.arange(a, a + 1000, dtype=np.uint64)) for a in range(0, 400, 20)]
    bands, sig = linking.sign(minhash.SCHEME, np.concatenate(sets), np.array([len(s) for s in sets]))
    frame = spark.createDataFrame([(i, x.as_py()) for i, x in enumerate(sig)], "i int, sig array<long>")
    a, b = frame.selectExpr("i a", "sig sa"), frame.selectExpr("i b", "sig sb")
    rows = a.join(b, a["a"] < b["b"]).select("a", "b", linking.similarity(minhash.SCHEME, a["sa"], b["sb"]).alias("s")).collect()
    for r in rows:
        x, y = sets[r["a"]], sets[r["b"]]
        both = len(np.intersect1d(x, y))
        assert abs(r["s"] - both / (len(x) + len(y) - both)) < 0.2


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 1), (9, 8), (8, 9), (5, 5), (20, 10)] + [(100 + k, 101 + k) for k in range(30)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8, 10: 10, 20: 10, **{100 + k: 100 for k in range(31)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_quality(docs, labels):
    got = quality.classify(docs, labels).collect()
    assert len(got) == len(ROWS) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (1, 2, 3)}) == 1
    assert quality.accepted(docs, labels).columns == docs.columns
    flat = quality.classify(docs, labels.limit(0)).collect()
    assert {r["score"] for r in flat} == {0.5}


def test_lines(spark, docs):
    base = "the quick brown fox jumps over the lazy dog near the river bank today"
    more = docs_of(spark, [(1, base + "\nshort\n\n" + base), (2, base.replace("today", "todax") + "\nshort"), (3, None), (4, ""),
                           (4, ""), (None, base), (5, "\n".join([LONG, LONG + "!"]))])
    got = {r["doc_id"]: r for r in lines.decisions(more).collect()}
    assert got[1]["dropped"] == [3] and got[2]["dropped"] == [0] and got[None]["dropped"] == [0] and got[5]["dropped"] == [1]
    assert (got[3]["n_lines"], got[4]["n_lines"], got[1]["n_kept"]) == (0, 1, 3)
    out = {r["doc_id"]: r["text"] for r in lines.deduplicate(more).collect()}
    assert out[1] == base + "\nshort\n" and out[2] == "short" and out[None] == "" and out[3] is None and out[5] == LONG
    assert lines.deduplicate(more).columns == more.columns


def test_lines_that_repeat_themselves(spark):
    texts = ["-" * 20, "-" * 40, "Ating. " * 20, "Ating. " * 60, "abcdefghijk", "abcdefghijkl", "zyxwvutsrq", "zyxwvutsrqp"]
    got = {r["doc_id"]: r["dropped"] for r in lines.decisions(docs_of(spark, list(enumerate(texts)))).collect()}
    # Sets of 1 and 1, 7 and 7, 4 in 5, and 3 in 4 runs, which is below 0.8.
    assert [len(got[k]) for k in range(5)] == [0, 1, 0, 1, 0] and [len(got[k]) for k in (6, 7)] == [0, 0]
    near = [("ab cd efg" + str(k) + "-hij") for k in range(40)]
    frame = docs_of(spark, [(2 * k + e, t + "x" * e) for k, t in enumerate(near) for e in (0, 1)])
    sets = [frozenset(t[i:i + 8] for i in range(len(t) - 7)) for t in [x + "x" * e for x in near for e in (0, 1)]]
    linked = {k for k, a in enumerate(sets) if any(5 * len(a & b) >= 4 * len(a | b) for b in sets[:k])}
    found = {r["doc_id"] for r in lines.decisions(frame).collect() if r["dropped"]}
    assert found <= linked and len(found) >= 0.9 * len(linked) > 0


def test_distinct_counts():
    rng = np.random.default_rng(7)
    sizes = np.array([5, 0, 1, 900, 3, 40])
    flat = words.mix(rng.integers(0, 60, sizes.sum()).astype(np.uint64))
    parts = np.split(flat, np.cumsum(sizes)[:-1])
    assert lines._distinct(flat, sizes).tolist() == [len(np.unique(p)) for p in parts]
    assert lines._distinct(flat[:0], sizes[:0]).tolist() == []


def test_reshard(spark, docs):
    placed = reshard.reshard(docs, new=3)
    rows = reshard.digest(placed).collect()
    assert len(rows) == len(ROWS) and sorted(placed.columns) == sorted(docs.columns + ["shard"])
    for shard, group in itertools.groupby(sorted(rows, key=lambda r: (r["shard"], r["slot"])), key=lambda r: r["shard"]):
        assert [r["slot"] for r in group] == list(range(sum(r["shard"] == shard for r in rows)))
    assert {r["doc_id"]: r["size"] for r in rows}[12] == 86


def test_flow_moves_the_fewest_bytes():
    rng = np.random.default_rng(1)
    for _ in range(50):
        supply = rng.integers(0, 50, rng.integers(1, 8)).tolist()
        new = int(rng.integers(1, 9))
        cap = reshard.capacities(sum(supply), new)
        flow = reshard.min_cost_flow(supply, cap)
        assert [sum(v for (i, _), v in flow.items() if i == k) for k in range(len(supply))] == supply
        assert [sum(v for (_, j), v in flow.items() if j == k) for k in range(new)] == cap
        stay = sum(min(s, cap[i]) for i, s in enumerate(supply) if i < new)
        assert sum(v for (i, j), v in flow.items() if i == j) == stay


def test_decontaminate(docs, benchmark):
    got = decontaminate.matches(docs, benchmark).collect()
    assert [(r["doc_id"], r["item_id"], r["share"]) for r in got] == [(11, 1, 1.0)]
    left = decontaminate.clean(docs, benchmark)
    assert left.columns == docs.columns and left.count() == len(ROWS) - 1
    assert decontaminate.matches(docs, benchmark.limit(0)).count() == 0


def test_decontaminate_finds_copies_of_a_large_benchmark(spark):
    rng = np.random.default_rng(5)
    items = [" ".join(f"w{x}" for x in rng.integers(0, 20_000, 40)) for _ in range(5000)]
    rows = [(i, " ".join(f"f{x}" for x in rng.integers(0, 500, 60)) + " " + items[i * 25] + " and more") for i in range(200)]
    rows += [(1000 + i, " ".join(f"w{x}" for x in rng.integers(0, 20_000, 80))) for i in range(50)]
    large = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = decontaminate.matches(docs_of(spark, rows), large).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(i, i * 25) for i in range(200)]


def test_subsequence():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a, b = (rng.integers(0, 4, rng.integers(1, 12)).tolist() for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        assert decontaminate.common_subsequence(a, b) == best[-1][-1]


def test_pii(spark):
    text = "call +1 (456) 555-2186 or 456 555 2186, mail a.b@x.org, host 10.0.0.300 10.0.0.30, card 4111 1111 1111 1111"
    got = {r["doc_id"]: r for r in pii.find(docs_of(spark, [(1, text), (2, None), (3, ""), (4, "é " + text)])).collect()}
    assert [got[1][f"n_{k}"] for k in pii.KINDS] == [1, 1, 1, 1]
    assert got[2]["spans"] == "" and got[2]["base_sha256"] == got[3]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    base = pii.joined(pii.rule_spans(text))
    assert got[1]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
    assert set(base.split(",")) <= set(got[1]["spans"].split(","))
    assert pii.rule_spans("é " + text)[0] == ("email", pii.rule_spans(text)[0][1] + 2, pii.rule_spans(text)[0][2] + 2)


def test_field_labels_a_second_mention():
    texts = [f"text {k} call +1 ({k + 200}) 555-{k + 1000} and then id {k * 7919 + 1000000} here" for k in range(300)]
    model = pii.fit([(t, pii.nodes(t, pii.rule_spans(t))) for t in texts])
    text = "call +1 (456) 555-2186 now or 456 555 2186 later, code 1234567"
    found = pii.added([(text, pii.nodes(text, pii.rule_spans(text)))], model)[0]
    assert found == [("phone", 30, 42)]


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "@" * 100_000, "+1" + " " * 200_000):
        pii.rule_spans(text)


def test_lengths(docs):
    rows = sorted(lengths.token_histogram(docs).collect(), key=lambda r: r["n_tokens"])
    encode = lengths.coder(lengths.RANKS).encode_ordinary
    each = sorted(len(encode(t or "")) for _, t in ROWS)
    assert [(r["n_tokens"], r["n_docs"]) for r in rows] == [(k, len(list(g))) for k, g in itertools.groupby(each)]
    for r in rows:
        limit = r["n_tokens"]
        assert r["truncated_total"] == sum(min(x, limit) for x in each) and r["docs_longer"] == sum(x > limit for x in each)
    sums = lengths.token_histogram(docs)
    assert {r["limit"]: r["truncated_total"] for r in lengths.at_limits(sums, [0, 3, 10**9]).collect()} == {
        0: 0, 3: sum(min(x, 3) for x in each), 10**9: sum(each)}
    assert lengths.quantile(sums, 0.5).first()[0] == each[(len(each) + 1) // 2 - 1]


def test_mixing(docs, labels):
    members = mixing.rates(docs, labels).collect()
    assert sum(r["copies"] for r in members) == len(ROWS)
    for r in members:
        assert r["rate"] >= 0 and abs(sum(r[f"p_{d}"] for d in mixing.DOMAINS) - 1) < 1e-9
    assert {r["n_tokens"] for r in members if r["doc_id"] in (1, 2, 3)} == {0}
    plain = mixing.rates(docs, labels.limit(0)).collect()
    assert {r["p_clean"] for r in plain} == {1.0}
    assert mixing.sample(docs, labels).columns == docs.columns


def test_labels_without_documents_give_no_prior(spark):
    frame = docs_of(spark, [(k, f"alpha beta gamma rare{k}") for k in range(20)] + [(50, None)])
    labels = [(k, 1, 0) for k in range(10)] + [(1000 + k, 0, 0) for k in range(500)] + [(50, 0, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    words = mixing._words(frame)
    _, priors = mixing.train(words, labels)
    assert priors == {"clean": 0.0, "toxic": None, "junk": None}
    _, priors = mixing.train(words, labels, sample=5)
    assert priors == {"clean": 0.0, "toxic": None, "junk": None}
    assert {r["p_clean"] for r in mixing.membership(frame, labels).collect()} == {1.0}


def test_rates_meet_targets(spark):
    rng = np.random.default_rng(3)
    p = rng.dirichlet([0.3, 0.3, 0.3], 400)
    members = spark.createDataFrame(
        [(i, 1, int(n), *map(float, q)) for i, (n, q) in enumerate(zip(rng.integers(1, 100, 400), p))],
        "doc_id long, copies long, n_tokens long, p_clean double, p_toxic double, p_junk double")
    _, reached, goal = mixing.fit_rates(members)
    total = sum(goal.values())
    assert all(abs(reached[d] - goal[d]) < 1e-4 * total for d in goal)
    _, reached, goal = mixing.fit_rates(members, {"clean": 9000.0, "toxic": 10.0, "junk": 500.0})
    assert abs(reached["clean"] - 9000) < 200


@pytest.mark.parametrize("targets", [None, {"clean": 6000.0, "toxic": 5000.0, "junk": 9000.0}, {"clean": 7500.0, "toxic": 900.0, "junk": 900.0}])
def test_projected_steps_agree_with_the_dual_problem(spark, monkeypatch, targets):
    monkeypatch.setattr(mixing, "HELD", 3)
    rng = np.random.default_rng(5)
    p = rng.dirichlet([0.4, 0.4, 0.4], 500)
    n = rng.integers(0, 100, 500)
    members = spark.createDataFrame(
        [(i, 1 + i % 2, int(k), *map(float, q)) for i, (k, q) in enumerate(zip(n, p))],
        "doc_id long, copies long, n_tokens long, p_clean double, p_toxic double, p_junk double")
    rated, reached, goal = mixing.fit_rates(members, targets)
    assert all(abs(reached[d] - goal[d]) <= 1e-3 * goal[d] for d in goal)
    rows = rated.collect()
    assert all(r["rate"] >= 0 and (r["n_tokens"] > 0 or r["rate"] == 1) for r in rows)
    for d in goal:  # the rates are those whose totals were reported
        assert abs(sum(r["rate"] * r["copies"] * r["n_tokens"] * r[f"p_{d}"] for r in rows) - reached[d]) < 1e-6 * goal[d]
    # A bound that no rate comes near leaves the same problem, which prices solve.
    rated, dual, _ = mixing.fit_rates(members, targets, most=1e6)
    assert all(abs(reached[d] - dual[d]) <= 1e-3 * goal[d] for d in goal)
    if targets is None:
        other = {r["doc_id"]: r["rate"] for r in rated.collect()}
        assert max(abs(other[r["doc_id"]] - r["rate"]) for r in rows if r["n_tokens"]) < 0.02


def test_bounded_rates_keep_the_clean_total(spark):
    # Few toxic tokens, as in the pipeline: the fit must not stop while a target can be met.
    rows = [(i, 1, 100, 0.999 - 0.004 * (i % 7), 0.001 + 0.004 * (i % 7), 0.0) for i in range(990)]
    rows += [(1000 + i, 1, 50, 0.02 * i, 1 - 0.02 * i, 0.0) for i in range(20)]
    members = spark.createDataFrame(rows, "doc_id long, copies long, n_tokens long, p_clean double, p_toxic double, p_junk double")
    # Totals of rates that are 1 for all clean documents and 0 for most toxic ones.
    best = [min(1.0, max(0.0, 1 + r[3] - 3 * r[4])) for r in rows]
    targets = {d: sum(x * r[2] * r[3 + k] for x, r in zip(best, rows)) for k, d in enumerate(mixing.DOMAINS)}
    rated, reached, goal = mixing.fit_rates(members, targets, most=1.0)
    assert all(abs(reached[d] - goal[d]) <= 3e-4 * goal[d] for d in ("clean", "toxic"))
    spread = rated.selectExpr("min(rate)", "max(rate)").first()
    assert 0 <= spread[0] and spread[1] <= 1


def test_lengths_of_long_runs(spark):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    whole.encode_special_tokens = True
    n = 1_000_000
    texts = [" " * n, "\n" * n + "x", "a" + " " * n + "b" + "\t" * 3000 + "\n", " \n" * 2000 + "'s", "x" + "\u3000\x85" * 900 + "y", "\x1c" * 3000 + " z", "a" * 200_000]
    got = {r["doc_id"]: r["n_tokens"] for r in lengths.encoded_lengths(docs_of(spark, list(enumerate(texts)))).collect()}
    assert got == {k: len(whole.encode(t, add_special_tokens=False).ids) for k, t in enumerate(texts)}


def test_topk(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=6).round(1).tolist()) for i in range(300)]
    rows += [(300, None), (301, [1.0, None]), (302, [float("nan")] * 6), (303, [float("inf")] * 6), (None, [1.0] * 6), (3, rows[3][1]), (350, [1.0, 2.0])]
    vectors = prepare(spark).createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.top_k(vectors, topk.asked(vectors)).collect()
    ints = {i: np.floor(256 * np.array(e, np.float32).astype(float)).astype(int) for i, e in rows[:300]}
    for q in range(0, 300, 50):
        best = sorted((-int(ints[q] @ v), i) for i, v in ints.items() if i != q)[:5]
        assert [(r["rank"], -r["score"], r["vec_id"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] == [
            (k + 1, s, i) for k, (s, i) in enumerate(best)]
    assert len(got) == 30


def test_topk_ties_and_large_numbers():
    scores = np.array([[5, 7, 7, 7, 1]])
    rows, ids, best = topk._select(scores, np.array([10, 20, 30, 40, 50]), [30], 2)
    assert ids.tolist() == [20, 40] and best.tolist() == [7, 7]
    big = topk.integers([1e15, -1e15])
    assert topk.products(big[None], np.array([[2, 1]]))[0, 0] == 256 * 10**15


def test_warc(spark, tmp_path):
    body = "x" * 150
    rows = [(1, "http://a/\r\nb", body), (2, None, body), (3, "u", None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"),
            (None, "u", body), (2, None, body), (7, "u", "é" * 60), (8, "u", "y" * 1_000_000)]
    pages = prepare(spark).createDataFrame(rows, "page_id long, url string, html string")
    got = warc.round_trip(pages).collect()
    assert len(got) == len(rows) and all(r["verified"] for r in got)
    kinds = {r["page_id"]: (r["record_type"], r["refers_to"], r["payload_bytes"]) for r in got}
    assert kinds == {1: ("response", None, 150), 2: ("revisit", 1, 150), 3: ("response", None, 0), 4: ("response", None, 0),
                     5: ("response", None, 5), 6: ("response", None, 5), None: ("revisit", 1, 150), 7: ("response", None, 120), 8: ("response", None, 1_000_000)}
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_damaged_archives():
    import io

    def member(i, body=b"hello"):
        return warc._member(warc.record(i, "u", body, hashlib.sha256(body).hexdigest(), None, "d"))

    bad = warc._member(warc.record(2, "u", b"hello", "0" * 64, None, "d"))
    rows = list(warc.records(io.BytesIO(member(1) + bad + member(3)[:-9] + member(4) + member(5)[:30])))
    assert [r[0] for r in rows if r[6]] == [1, 4]
    assert sum(not r[6] for r in rows) >= 3


def test_pipeline(spark, docs, labels, benchmark, tmp_path):
    for name, frame in (("documents", docs), ("labels", labels), ("benchmark", benchmark)):
        frame.write.parquet(str(tmp_path / f"{name}.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert all(r["shard"] is not None for r in rows)


@pytest.mark.parametrize("stage", range(5))
def test_stages_on_an_empty_table(spark, docs, labels, benchmark, tmp_path, stage):
    for name, frame in (("labels", labels), ("benchmark", benchmark)):
        frame.write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.STAGES[stage][1](spark, docs.limit(0), str(tmp_path)).count() == 0

"""The registered queries of the corpus operators, each over its whole table."""

import corpus_pipeline
from fleetbook.llm import align, audit, decontaminate, lengths, lines, minhash, mixing, phrases, pii, quality, reshard, topk, warc
from fleetbook.llm.tables import read

QUERIES = {}
SQL = {}


def query(name):
    def add(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(spark, str(sf_dir).rstrip("/"))
        return fn
    return add


@query("op2_minhash")
def op2(spark, sf):
    return minhash.near_duplicates(read(spark, sf, "documents"))


@query("op3_quality")
def op3(spark, sf):
    return quality.classify(read(spark, sf, "documents"), read(spark, sf, "labels"))


@query("op5_reshard")
def op5(spark, sf):
    return reshard.digest(reshard.reshard(read(spark, sf, "documents").select("doc_id", "text")))


@query("op10_topk")
def op10(spark, sf):
    vectors = read(spark, sf, "embeddings")
    return topk.top_k(vectors, topk.asked(vectors))


SQL["op10_topk"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""


@query("op7_pii")
def op7(spark, sf):
    return pii.find(read(spark, sf, "documents"))


@query("op1_warc")
def op1(spark, sf):
    return warc.round_trip(read(spark, sf, "pages"))


SQL["op1_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
     g AS (SELECT h, min(page_id) AS low FROM p WHERE strlen(h) >= 100 GROUP BY h)
SELECT p.page_id, strlen(p.h) AS payload_bytes, sha256(p.h) AS payload_digest,
       CASE WHEN g.low <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN g.low <> p.page_id THEN g.low END AS refers_to, true AS verified
FROM p LEFT JOIN g ON p.h = g.h
"""


@query("op8_lengths")
def op8(spark, sf):
    return lengths.token_histogram(read(spark, sf, "documents"))


@query("op4_lines")
def op4(spark, sf):
    return lines.decisions(read(spark, sf, "documents")).drop("th")


@query("op6_decontaminate")
def op6(spark, sf):
    return decontaminate.matches(read(spark, sf, "documents"), read(spark, sf, "benchmark"))


@query("op9_mixing")
def op9(spark, sf):
    return mixing.rates(read(spark, sf, "documents"), read(spark, sf, "labels")).drop("th")


@query("op11_audit")
def op11(spark, sf):
    return audit.interactions(read(spark, sf, "documents"), read(spark, sf, "labels"))


SQL["op11_audit"] = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM (SELECT DISTINCT t FROM d)),
low AS (SELECT t, min(doc_id) AS lo FROM d GROUP BY t),
lab AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
               max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (
    SELECT d.part, len(ws) < 100 AS a, 100 * len(list_distinct(ws)) < 80 * len(ws) AS b,
           100 * length(regexp_replace(d.t, '[^A-Z]', '', 'g')) > 10 * length(d.t) AS c,
           regexp_matches(d.t, '[#$%&*|]') AS d, coalesce(d.doc_id > low.lo, false) AS e,
           coalesce(lab.good, 0) AS good, coalesce(lab.toxic, 0) AS toxic
    FROM d JOIN w ON d.t = w.t JOIN low ON d.t = low.t LEFT JOIN lab ON d.doc_id = lab.doc_id
), g AS (SELECT part, a, b, c, d, e, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
    SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM l p, l q, l r, l s, l t
    WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5
), j AS (
    SELECT g.*, filter_order, step, substr(filter_order, step, 1) AS x, substr(filter_order, 1, step - 1) AS before,
           CAST(a AS INT) + CAST(b AS INT) + CAST(c AS INT) + CAST(d AS INT) + CAST(e AS INT) AS n_fails
    FROM g, o, (SELECT CAST(unnest([1, 2, 3, 4, 5]) AS INTEGER) AS step)
), k AS (
    SELECT *, CASE x WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END AS fails,
           (a AND contains(before, 'A')) OR (b AND contains(before, 'B')) OR (c AND contains(before, 'C'))
           OR (d AND contains(before, 'D')) OR (e AND contains(before, 'E')) AS gone
    FROM j
), r AS (
    SELECT part, filter_order, step, x,
           sum(CASE WHEN NOT fails AND NOT gone THEN n ELSE 0 END) AS kept, sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN fails AND gone THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fails AND n_fails = 1 THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN fails AND NOT gone THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN fails AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
    FROM k GROUP BY ALL
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM r
"""


@query("op12_align")
def op12(spark, sf):
    return align.alignments(read(spark, sf, "documents"))


@query("op13_phrases")
def op13(spark, sf):
    return phrases.remove_repeats(read(spark, sf, "documents"))


SQL["op13_phrases"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (
    SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS k
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM d WHERE len(ws) >= 50)
),
lo AS (SELECT k, min(doc_id) AS first FROM g GROUP BY k),
gone AS (SELECT DISTINCT doc_id, i + unnest(range(0, 50)) AS p FROM g JOIN lo USING (k) WHERE first < doc_id),
w AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM d),
r AS (
    SELECT w.doc_id, string_agg(word, ' ' ORDER BY w.p) FILTER (WHERE gone.p IS NULL) AS kept, count(gone.p) AS n_removed
    FROM w LEFT JOIN gone ON w.doc_id = gone.doc_id AND w.p = gone.p GROUP BY w.doc_id
)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN r ON d.doc_id = r.doc_id
"""


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL

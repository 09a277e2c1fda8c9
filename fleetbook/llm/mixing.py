"""Soft-membership mixing to target token totals, with DataFrame functions only.

1. The labels table names the domain of some documents: junk (quality 0), toxic (toxic 1),
   clean (the rest). A naive Bayes classifier over hashed distinct words, and over classes
   of the share of distinct words, is counted from at most ``SAMPLE`` labels of present
   documents, those with the smallest hash of doc_id; the bound lets the list of labels be
   broadcast. Priors and words are counted on the same rows. The table has ``PLACES`` rows,
   so it is broadcast as well.
2. Every document gets posteriors of all domains (log odds divided by ``HEAT``, so they
   stay soft) and its number of words as token count.
3. Rates: a document of n tokens and posteriors p adds ``rate * n * p`` to the domain
   totals. Nonnegative rates fit these expected totals to the targets in least squares, each
   domain by its own target, by projected gradient steps from rates of 1:
   ``rate = max(0, rate - p . step)``, where ``step`` is a length times each domain's miss as a
   share of its target. The length follows the last two steps (Barzilai and Borwein) and is
   never below the one that always descends. A rate is the fold of the steps so far, so a
   pass is one aggregate over the documents; every ``HELD`` steps the rates are written. Only
   a few sums reach the driver.
4. Where rates are bounded above too (``most``; the pipeline repeats no document), projected
   steps leave misses of 0.2 to 5 percent after 60 passes, as most rates lie at the bound.
   There rates are ``1 - p . price``, cut at the bounds; prices come from Newton steps on the
   dual problem, without the rates at a bound in its Gram matrix, four step lengths a pass.

Targets are domain totals as multiples of the present ones (``WEIGHTS``), or any totals.

Defined cases: null and empty texts have no words: prior posteriors, 0 tokens, rate 1;
rows without doc_id get posteriors and rates like others; rows that repeat doc_id and text
count each but are one row of the result, with their number; labels that are null or
without a document or whose document has no words teach nothing; a domain that no document
teaches gets posterior 0 and keeps its total; without any all documents are clean; no rows
give no rows.
"""

import numpy as np
from pyspark.sql import functions as F

from fleetbook.llm.tables import stage, texts

DOMAINS = ("clean", "toxic", "junk")
WEIGHTS = {"clean": 1.0, "toxic": 0.3, "junk": 0.3}
SAMPLE = 20_000
PLACES = 1 << 14
HEAT = 2.0
STEPS, NEAR = 60, 1e-5            # most passes; remaining miss, as a share of each domain's target
LOOSE, RIDGE = 1e-1, 1e-5        # weight of rates near 1 against the targets: at first, at the end
LENGTHS = (1.0, 1 / 4, 1 / 16, 1 / 64)
HELD = 16                        # projected steps folded before the rates are written
LONGEST, LAST = 1e3, 4           # longest step against the safe one; last passes, with safe steps
STILL = 1e-12                    # mean squared move of the rates at which steps end


def _words(docs):
    """doc_id, th, n_tokens and the distinct words of each row."""
    words = F.filter(F.split(F.translate("text", "\n\t\r\x0b\x0c", "     "), " "), lambda w: w != "")
    rows = texts(docs).withColumn("th", F.xxhash64("text")).withColumn("words", F.coalesce(words, F.array().cast("array<string>")))
    distinct = F.array_distinct("words")
    # The share of distinct words, in tenths, stands for one more word.
    share = F.concat(F.lit("\n"), F.round(F.size(distinct) * 10 / F.greatest(F.size("words"), F.lit(1))).cast("int").cast("string"))
    return rows.select(
        "doc_id", "th", F.size("words").cast("long").alias("n_tokens"),
        F.when(F.size("words") > 0, F.concat(distinct, F.array(share))).otherwise(distinct).alias("words"))


def _place(word):
    return F.pmod(F.xxhash64(word, F.lit(9)), F.lit(PLACES)).cast("int")


def domain_of(quality, toxic):
    return F.when(quality == 0, "junk").when(toxic == 1, "toxic").when(quality == 1, "clean")


def train(words, labels, sample=SAMPLE):
    """(table, priors): log likelihoods per hashed word, and log priors by domain."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), domain_of(F.col("quality"), F.col("toxic")).alias("domain"))
        .filter("doc_id IS NOT NULL AND domain IS NOT NULL")
        .join(words.select("doc_id").distinct(), "doc_id", "left_semi").withColumn("h", F.xxhash64("doc_id", F.lit(9)))
        .orderBy("h", "doc_id", "domain").limit(sample).drop("h"))
    known = F.broadcast(stage(known, "labels"))
    taught = words.filter("n_tokens > 0").join(known, "doc_id").select("domain", "words")
    # One entry without a word counts the row itself.
    entries = taught.select("domain", F.explode(F.concat(F.array(F.lit(None).cast("string")), "words")).alias("word"))
    counts = entries.groupBy(F.when(F.col("word").isNotNull(), _place("word")).alias("place")).agg(
        *[F.count(F.when(F.col("domain") == d, 1)).alias(d) for d in DOMAINS])
    counts = stage(counts, "counts")
    rows = counts.filter("place IS NULL").first()
    docs = {d: rows[d] if rows else 0 for d in DOMAINS}
    counts = counts.filter("place IS NOT NULL")
    sums = counts.agg(*[F.sum(d).alias(d) for d in DOMAINS]).first()
    n = sum(docs.values())
    priors = {d: float(np.log(docs[d] / n)) if docs.get(d) else None for d in DOMAINS}
    if not n:
        priors["clean"] = 0.0
    table = counts.select("place", *[
        F.log((F.col(d) + 0.5) / F.lit(float((sums[d] or 0) + 0.5 * PLACES))).alias(d) for d in DOMAINS])
    return stage(table, "likelihoods"), priors


def posteriors(words, table, priors):
    """doc_id, th, n_tokens, copies and p_<domain> of every distinct row."""
    # One entry without a word marks each row, so equal rows are counted on the way.
    entries = words.select("doc_id", "th", "n_tokens", F.explode(F.concat(F.array(F.lit(None).cast("string")), "words")).alias("word"))
    place = F.when(F.col("word").isNotNull(), _place("word"))
    scored = (
        entries.select("doc_id", "th", "n_tokens", place.alias("place")).join(F.broadcast(table), "place", "left")
        .groupBy("doc_id", "th", "n_tokens").agg(
            F.count(F.when(F.col("place").isNull(), 1)).alias("copies"), *[F.sum(d).alias(d) for d in DOMAINS]))
    used = [d for d in DOMAINS if priors[d] is not None]
    odds = [F.coalesce(F.col(d), F.lit(0.0)) / F.col("copies") / HEAT + priors[d] for d in used]
    top = F.greatest(*odds) if len(odds) > 1 else odds[0]
    mass = [F.exp(o - top) for o in odds]
    total = sum(mass[1:], mass[0])
    shares = {d: m / total for d, m in zip(used, mass)}
    return scored.select("doc_id", "th", "copies", "n_tokens", *[shares.get(d, F.lit(0.0)).alias(f"p_{d}") for d in DOMAINS])


def _rate(price, most):
    """Columns (rate, whether it is within its bounds) at prices, numbers or columns."""
    raw = F.lit(1.0) - sum((F.col(f"p_{d}") * x for d, x in zip(DOMAINS, price)), F.lit(0.0))
    raw = F.when(F.col("n_tokens") > 0, raw).otherwise(1.0)
    cut = F.greatest(F.lit(0.0), raw)
    return (cut, raw >= 0) if most is None else (F.least(F.lit(float(most)), cut), raw.between(0.0, float(most)))


def _totals(members, prices, most):
    """(totals, Gram matrix of the rates within their bounds, value) for each of the prices."""
    n, p = len(DOMAINS), [F.col(f"p_{d}") for d in DOMAINS]
    # Prices come as rows, so the plan, and its compiled code, is the same in each pass.
    listed = members.sparkSession.createDataFrame(
        [(k, *map(float, price)) for k, price in enumerate(prices)], "k int, " + ", ".join(f"x{i} double" for i in range(n)))
    rate, free = _rate([F.col(f"x{i}") for i in range(n)], most)
    cost = sum((p[i] * F.col(f"x{i}") for i in range(n)), F.lit(0.0))
    each = members.join(F.broadcast(listed)).select(
        "k", *p, (F.col("copies") * F.col("n_tokens")).alias("w"), rate.alias("r"), free.alias("free"), cost.alias("cost"))
    r, w = F.col("r"), F.col("w")
    rows = each.groupBy("k").agg(
        *[F.sum(w * r * x).alias(f"t{i}") for i, x in enumerate(p)],
        *[F.sum(F.when(F.col("free"), w * p[i] * p[j])).alias(f"g{i}{j}") for i in range(n) for j in range(i, n)],
        F.sum(w * (0.5 * (r - 1) * (r - 1) + r * F.col("cost"))).alias("v")).collect()
    out = [(np.zeros(n), np.zeros((n, n)), 0.0)] * len(prices)
    for row in rows:
        out[row["k"]] = (
            np.array([row[f"t{i}"] or 0.0 for i in range(n)]),
            np.array([[row[f"g{min(i, j)}{max(i, j)}"] or 0.0 for j in range(n)] for i in range(n)]), row["v"] or 0.0)
    return out


def _folded(steps):
    """Column (rate, the one a step before) after projected steps from the column ``rate``."""
    def step(at, x):
        down = sum((F.col(f"p_{d}") * x[d] for d in DOMAINS), F.lit(0.0))
        return F.struct(F.greatest(F.lit(0.0), at["now"] - down).alias("now"), at["now"].alias("before"))

    start = F.struct(F.col("rate").alias("now"), F.col("rate").alias("before"))
    return F.when(F.col("n_tokens") > 0, F.aggregate(steps, start, step)).otherwise(start)


_STEPS = "steps array<struct<" + ", ".join(f"{d}: double" for d in DOMAINS) + ">>"


def _stepped(members, steps):
    """The rows with ``at``, their rates after the steps. The steps come as the one row of a
    frame, so the plan, and its compiled code, is the same in each pass."""
    listed = members.sparkSession.createDataFrame([([tuple(map(float, x)) for x in steps],)], _STEPS)
    return members.join(F.broadcast(listed)).withColumn("at", _folded("steps")).drop("steps")


def descend(members, goal, totals, gram, scale):
    """(members with their rates, totals): nonnegative rates by projected gradient steps."""
    weight = F.col("copies") * F.col("n_tokens")
    safe = 1 / max(np.linalg.eigvalsh(gram / np.sqrt(np.outer(scale, scale))).max(), 1e-300)
    members, steps, length = members.withColumn("rate", F.lit(1.0)), [], safe
    miss = (totals - goal) / scale
    for k in range(STEPS):
        if (np.abs(miss) <= NEAR).all():
            break
        steps.append(length * miss)
        at = F.col("at")
        row = _stepped(members, steps).agg(
            *[F.sum(weight * at["now"] * F.col(f"p_{d}")) for d in DOMAINS],
            F.sum(weight * (at["now"] - at["before"]) * (at["now"] - at["before"])), F.sum(weight)).first()
        if not row[-1]:
            break
        new, moved = np.array(row[:-2], float), row[-2]
        bend = ((new - totals) / scale) @ (new - totals)
        length = min(max(safe, moved / bend), LONGEST * safe) if bend > 0 and k < STEPS - LAST else safe
        totals, miss = new, (new - goal) / scale
        if moved <= STILL * row[-1]:
            break
        if len(steps) == HELD:
            members, steps = stage(_stepped(members, steps).withColumn("rate", F.col("at.now")).drop("at"), "rates"), []
    return _stepped(members, steps).withColumn("rate", F.col("at.now")).drop("at"), totals


def fit_rates(members, targets=None, most=None):
    """(members with their rates, totals reached, targets). ``most`` bounds the rates above,
    where documents are not to be repeated."""
    price = np.zeros(len(DOMAINS))
    (totals, gram, value), = _totals(members, [price], None)
    goal = np.array([targets[d] for d in DOMAINS]) if targets else totals * np.array([WEIGHTS[d] for d in DOMAINS])
    scale = np.maximum(goal, 1e-6 * max(totals.sum(), 1.0))
    if most is None:
        rated, totals = descend(members, goal, totals, gram, scale)
    else:
        if most < 1:
            (totals, gram, value), = _totals(members, [price], most)
        price, totals = _prices(members, goal, totals, gram, value, scale, most)
        rated = members.withColumn("rate", _rate([float(x) for x in price], most)[0])
    return rated, dict(zip(DOMAINS, totals)), dict(zip(DOMAINS, goal))


def _prices(members, goal, totals, gram, value, scale, most):
    """(prices, totals) of bounded rates, by Newton steps on the dual problem."""
    price, ridge = np.zeros(len(DOMAINS)), LOOSE
    def dual(price, value):
        return value - price @ goal - 0.5 * ridge * (scale * price ** 2).sum()

    for _ in range(STEPS):
        # Looser problems first: their prices are close to those of the next.
        while (np.abs(miss := totals - goal - ridge * scale * price) <= max(NEAR, ridge / 10) * scale).all() and ridge > RIDGE * 1.01:
            ridge /= 100
        if (np.abs(miss) <= NEAR * scale).all():
            break
        step = np.linalg.lstsq(gram + np.diag(ridge * scale), miss, rcond=None)[0]
        tried = [price + length * step for length in LENGTHS]
        found = _totals(members, tried, most)
        best = max(range(len(tried)), key=lambda k: dual(tried[k], found[k][2]))
        if dual(tried[best], found[best][2]) <= dual(price, value):
            break
        price, (totals, gram, value) = tried[best], found[best]
    return price, totals


def membership(docs, labels):
    """doc_id, th, copies, n_tokens and posteriors of every distinct row."""
    words = _words(docs)
    return stage(posteriors(words, *train(words, labels)), "members")


def rates(docs, labels, targets=None, most=None):
    """doc_id, th, copies, n_tokens, p_<domain> and rate of every distinct row."""
    rated, _, _ = fit_rates(membership(docs, labels), targets, most)
    return rated


def sample(docs, labels, targets=None, most=1.0):
    """``docs`` at their rates: a row goes out as often as the whole part of its rate says,
    and once more where a hash of its doc_id and text is below the rest."""
    chosen = rates(docs, labels, targets, most)
    even = (F.pmod(F.xxhash64("doc_id", "th", F.lit(99)), F.lit(1 << 30)) + 0.5) / (1 << 30)
    # Adding 1e-9 keeps a rate of 1 from falling below it by rounding.
    times = F.floor(F.col("rate") + even + 1e-9).cast("int")
    chosen = chosen.select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"), times.alias("__times")).filter("__times > 0")
    text = F.col("text").cast("string")
    hit = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__th"))
    return docs.join(chosen, hit).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(*docs.columns)

"""Usual dates and amounts are read by the places of their parts; the outcome is that of the
full reading."""

import random

from pyspark.sql import functions as F

from fleetbook.functions import amounts, dates
from fleetbook.functions.text import strip


def _full_date(c, *orders):
    text = F.translate(strip(c), "/", "-")
    worded = dates._let(text, lambda t: dates._let(dates._numbered_month(t), lambda u: dates._let(
        dates._four_digits(dates._full_day(u)), lambda w: dates._read(w, orders))))
    return F.coalesce(dates._read(dates._four_digits(text), orders), F.when(text.rlike("[A-Za-z]{2}|[A-Za-z][.]"), worded))


def _full_number(c):
    text = strip(c)
    last = F.right(text, F.lit(1))
    return F.when(last.between("0", "9") | (last == "."), text.try_cast("double"))


def _texts(seed, make, alphabet, n=6000):
    rng = random.Random(seed)
    for _ in range(n):
        text = list(make(rng))
        for _ in range(rng.choice((0, 0, 1, 2))):
            at, op = rng.randrange(len(text) + 1), rng.randrange(3)
            text[at:at + (op > 0)] = [] if op == 1 else [rng.choice(alphabet)]
        yield "".join(text)


def _some_date(rng):
    sep, second = rng.choice("-/"), rng.choice("--//.")
    y, m, d = rng.choice(("1997", "2024", "0097", "97")), f"{rng.randint(0, 14):02d}", f"{rng.randint(0, 33):02d}"
    order = rng.choice(((y, m, d), (d, m, y), (m, d, y)))
    return rng.choice(("", "", " ")) + order[0] + sep + order[1] + rng.choice((sep, sep, second)) + order[2] + rng.choice(
        ("", "", "", " ", " 10:05:07", "T10:05", " 1:05 PM", " 10:00 Asia/Tokyo", " 10:00:00 +01:00"))


def test_dates_as_in_the_full_reading(spark):
    texts = list(_texts(1, _some_date, "0123456789-/ :TZ+. \u0001\t٣a")) + ["", "n/a", "1997/01/02", "02/01/1997", "1 /02/1997"]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    for orders in (("ymd", "dmy", "mdy"), ("dmy", "ymd", "mdy"), ("mdy", "dmy"), ("ymd",)):
        wrong = df.filter(~dates.parse_timestamp(F.col("t"), *orders).eqNullSafe(_full_date(F.col("t"), *orders)))
        assert wrong.collect() == []
    assert df.filter(dates.parse_date_ladder(F.col("t")).isNotNull()).count() > 1000


def test_amounts_as_in_the_full_reading(spark):
    def some(rng):
        return rng.choice(("", "-", " ", "$", "-$", "$ ")) + rng.choice(("1,234", "7", "0", "12")) + rng.choice(("", ".", ".5", ".50")) + rng.choice(
            ("", "", " ", " ", "d", "e3"))

    texts = list(_texts(2, some, "0123456789$,.-+ eEdfNx \u0001٣")) + ["", "NaN", "Infinity", "0x1p3", "1d", "5 $", "$5,"]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    money = F.abs(_full_number(F.translate("t", "$,", "")))
    assert df.filter(~amounts.parse_money(F.col("t")).eqNullSafe(money)).collect() == []
    assert df.filter(~amounts.to_number(F.col("t")).eqNullSafe(_full_number(F.col("t")))).collect() == []


def test_usual_dates_need_no_patterns(spark):
    """Of the readings in the plan the first ones use neither a pattern nor a translation."""
    first = dates._read_usual(F.col("t"), ("ymd", "dmy", "mdy"))
    df = spark.createDataFrame([("1997/03/05",), ("05/03/1997",), ("1997-03-05",)], "t string").select(
        F.coalesce(*first).alias("day"))
    assert {str(r.day) for r in df.collect()} == {"1997-03-05 00:00:00"}
    assert "regexp" not in df._jdf.queryExecution().optimizedPlan().toString()

"""Edge values of the column functions."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetbook.functions import amounts, dates, eco, keys, text


def apply(spark, function, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, x string")
    return [r[0] for r in df.orderBy("i").select(function(F.col("x"))).collect()]


@pytest.mark.parametrize("function,cases", [
    (eco.normalize_eco, {
        "AU-213(JW)": "AU-213", " au 7 ": "AU-007", "CA.12": "CA-012", "CA-1234": "CA-1234",
        "AU001LZC": "AU-001", "moto 3": "MOTO3", "": "", None: None}),
    (eco.normalize_eco_lzc, {
        "au 7 lzc": "AU-007 LZC", "AU-001LZC": "AU-001 LZC", "AU-213(JW)": "AU-213", " x y ": "X Y"}),
    (eco.eco_master_format, {
        "AU001": "AU-001", "ca-002lzc": "CA-002 LZC", "AU-003 LZC": "AU-003 LZC", "AU-1": None}),
    (eco.plate_key, {" ab-12 c": "AB12C", "nan": None, "": None}),
    (eco.eco_key, {"AU-001 lzc": "AU001LZC"}),
    (amounts.parse_money, {
        "-$1,234.50": 1234.5, "$ 7": 7.0, "": None, "n/a": None, "1d": None, "NaN": None,
        "Infinity": None, "1e3": 1000.0}),
    (text.normalize_card, {
        "9999999999999999": "9999999999999999", "123.0": "123", "1,234": "1234", "12.5": "12.5",
        "abc..": "abc", "nan": None, " ": None}),
    (text.clean_tag, {"12 345 678.": "IMDM12345678", "IMDM1": "IMDM1"}),
    (text.strip_float, {"12.0": "12", "nan": "", None: "", " 7 ": "7"}),
    (text.product_type, {" arco  magna": "REGULAR", "MAGNA PLUS": "MAGNA PLUS", None: None}),
    (text.sanitize_path, {"A/B  C.V.,": "A-B_C.V.", "": "sin_empresa", None: "sin_empresa", "ñ": "sin_empresa"}),
    (text.header_key, {"Fecha Transacción": "fechatransaccion", "Nº Económico": "noeconomico"}),
    (text.company_from_text, {
        "\n NÚMERO DE CLIENTE: 5\n\nACME": "ACME", "ACME\nx": "ACME", "": "sin_empresa"}),
    (keys.strip_hash_prefix, {"PASE_0123456789ab_x.csv": "x.csv", "pase_01_x.csv": "pase_01_x.csv"}),
    (keys.client_number_in_file, {"g1A53089.12.csv": "53089", "cruces.csv": None}),
    (keys.client_number_in_text, {"Número de cliente: 53089 x": "53089", "cliente 5": None}),
    (dates.month_title, {"2026-01": "Enero 2026", "sin mes": "sin mes"}),
])
def test_values(spark, function, cases):
    assert apply(spark, function, cases) == list(cases.values())


def test_dates_are_read_row_by_row(spark):
    values = ["2025/03/05", "05/03/2025", "2025-03-05", "25/12/2025 10:30", "12/25/2025", "5-3-2025",
              "31/02/2025", "45231", "12:30", "n/a", "", None]
    march = dt.datetime(2025, 3, 5)
    assert apply(spark, dates.parse_date_ladder, values) == [
        march, march, march, dt.datetime(2025, 12, 25, 10, 30), dt.datetime(2025, 12, 25), march,
        None, None, None, None, None, None]


def test_fixed_timestamp_accepts_one_format(spark):
    assert apply(spark, dates.parse_ts_fixed, ["2025/03/05 01:02:03", "2025/03/05", "05/03/2025 01:02:03"]) == [
        dt.datetime(2025, 3, 5, 1, 2, 3), None, None]


def test_billing_periods(spark):
    targets = [(1996, 12), (1997, 1), (1997, 4)]
    texts = ["DEL 16 DE DICIEMBRE AL 15 DE ENERO DEL 1997", "Enero del 1997", "DEL 1 DE MAYO AL 2 DE JUNIO DEL 1997",
             "sin año", "DEL 1 MARZO AL 30 DE ABRIL DEL 1997"]
    assert apply(spark, lambda c: dates.period_to_month(c, targets), texts) == [199612, 199701, None, None, 199704]


def test_months_cover_the_last_partial_month():
    assert dates.months_between_dates(dt.date(2025, 11, 30), dt.date(2026, 1, 2)) == [
        (2025, 11), (2025, 12), (2026, 1)]
    assert dates.months_to_date(dt.date(2026, 2, 1)) == [(2026, 1), (2026, 2)]
    assert dates.months_of_last_year(dt.date(2026, 2, 1))[-1] == (2025, 12)
    with pytest.raises(ValueError):
        dates.months_between_dates(dt.date(2026, 1, 2), dt.date(2026, 1, 1))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("AUCaulzc -.()0123456789", max_size=12), min_size=1, max_size=60))
def test_normalising_twice_changes_nothing(spark, values):
    once = apply(spark, eco.normalize_eco, values)
    assert apply(spark, eco.normalize_eco, once) == once
    df = spark.createDataFrame([(v,) for v in values], "x string")
    agree = eco.is_unit(F.col("x")) == eco.is_valid_eco(eco.normalize_eco(F.col("x")))
    assert df.filter(~agree).count() == 0


def test_row_id_ignores_archive_prefix_and_outer_blanks(spark):
    df = spark.createDataFrame([
        ("x.csv", 3, ["AU-1 ", None]), ("pase_0123456789ab_x.csv", 3, [" AU-1", ""]), ("x.csv", 4, ["AU-1", ""]),
    ], "f string, i int, cells array<string>")
    a, b, c = [r[0] for r in df.select(keys.row_id("Pase", F.col("f"), F.col("i"), F.col("cells"))).collect()]
    assert a == b != c

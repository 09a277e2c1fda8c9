"""Rows that the catalogue multiplies: the same rows as of a plain join, made last."""

import datetime as dt
import itertools
import random
import urllib.parse

import pytest

from fleetbook.operators import joins
from fleetbook.plans import dashboard

UNITS = ["AU-001", "au 1", "AU.001", "AU-1 LZC", "AU001LZC", "XX-12", "XX 12", "xx12", "n/a", "", " ", "NAN", None, "CA-900"]


def _key(shown):
    kept = "".join(c for c in shown.upper() if c.isascii() and (c.isdigit() or c.isupper())) if shown is not None else None
    return "NAN" if kept is None else kept


def _plain(spark, facts, master):
    """The full outer join row by row."""
    from fleetbook.functions.eco import normalize_eco_lzc
    from pyspark.sql import functions as F

    texts = spark.createDataFrame([(m[0],) for m in master], "t string")
    shown = {r.t: r.s for r in texts.select("t", normalize_eco_lzc(F.col("t")).alias("s")).collect()}
    listed = [(_key(shown[m[0]]), shown[m[0]], m[1]) for m in master]
    used, out = {_key(f[0]) for f in facts}, []
    for unit, amount in facts:
        found = [(s, e) for k, s, e in listed if k == _key(unit)] or [(None, None)]
        out += [(unit if s is None else s, e, amount) for s, e in found]
    return out + [(s, e, None) for k, s, e in listed if k not in used]


@pytest.mark.parametrize("pack", [1000, 2])
@pytest.mark.parametrize("broadcast", [True, False])
def test_as_many_rows_as_of_a_plain_join(spark, monkeypatch, pack, broadcast):
    monkeypatch.setattr(joins, "_PACK", pack)
    rng = random.Random(pack)
    master = [(rng.choice(UNITS), rng.choice(["E1", "E2", None])) for _ in range(40)]
    facts = [(rng.choice(UNITS[:-1] + ["AU-777"]), float(rng.randint(0, 3))) for _ in range(60)]
    if not broadcast:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = dashboard.join_master(spark.createDataFrame(facts, "ECO string, Importe double"),
                                      spark.createDataFrame(master, "ECO string, Empresa string"))
        assert table.columns == ["ECO", "Empresa", "Importe"]
        assert sorted(map(tuple, table.collect()), key=repr) == sorted(_plain(spark, facts, master), key=repr)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_catalogue_of_units_alone(spark):
    table = dashboard.join_master(spark.createDataFrame([("AU-001", 2.0)], "ECO string, Importe double"),
                                  spark.createDataFrame([("AU-001",), ("AU 1",), ("CA-5",)], "ECO string"))
    assert sorted(map(tuple, table.collect()), key=repr) == [("AU-001", 2.0), ("AU-001", 2.0), ("CA-005", None)]


def _job(spark, monkeypatch, tmp_path, compared):
    seen = dashboard.new_by_signature

    def counting(source, *rest):
        compared.append(source.count())
        return seen(source, *rest)

    monkeypatch.setattr(dashboard, "new_by_signature", counting)
    columns = "`No. economico` string, `Fecha de cruce` string, `Importe al 100` string"
    master = spark.sql("""SELECT CASE WHEN id < 30 THEN 'XX-1' WHEN id < 50 THEN 'AU 1' ELSE 'CA-' || id END AS ECO,
        'E' || id AS Empresa, 'P' || id AS Placas, 'S' || id AS `Supramax ID`, id AS pos FROM range(51)""")
    for days in (2, 3, 3):
        rows = spark.createDataFrame([("AU 1", f"1997/0{d}/01", "5.5") for d in range(1, days + 1)], columns)
        rows.write.mode("overwrite").parquet(str(tmp_path / "toll"))
        yield dashboard.run(spark, {"Pase": str(tmp_path / "toll")}, None, master, "pos", dt.date(1998, 6, 15), str(tmp_path / "report"))


def test_a_report_compares_rows_before_the_catalogue_multiplies_them(spark, monkeypatch, tmp_path):
    compared = []
    runs = list(_job(spark, monkeypatch, tmp_path, compared))
    # Twenty names for the unit; thirty and one of units without rows, whose two spellings are compared once each.
    assert [n for _, n in runs] == [40 + 31, 20, 0] and compared == [3 + 2, 3 + 2]
    kept = runs[-1][0].read()
    assert kept.count() == 91 and kept.distinct().count() == 91
    assert sorted(f"{r.Mes}" for r in kept.collect()) == sorted(["None"] * 31 + ["1"] * 20 + ["2"] * 20 + ["3"] * 20)


def test_a_report_is_written_unit_by_unit(spark, monkeypatch, tmp_path):
    """Within a file a unit's rows lie together, so that what repeats costs next to nothing."""
    *_, (report, _) = _job(spark, monkeypatch, tmp_path, [])
    for name in report.read().inputFiles():
        units = [r.ECO for r in spark.read.parquet(urllib.parse.unquote(name)).collect()]
        assert len(list(itertools.groupby(units))) == len(set(units))
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"

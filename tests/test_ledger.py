"""Merges, the stored table, the stream, and what must hold for any data."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from fleetbook.operators import joins, merge, windows
from fleetbook.operators.storage import LedgerTable
from fleetbook.plans import ingest, recon, yoy
from fleetbook.operators.aggregates import month_detail
from fleetbook.streaming.ledger_stream import ingest_stream
from fleetbook.vocabulary import LEDGER_SCHEMA

NAMES = (f"ledger_{i}" for i in itertools.count())


def rows(spark, *items):
    """Ledger rows from (ECO, day, Importe, Sistema, Id, Cantidad, Tipo)."""
    full = []
    for eco, day, amount, *rest in items:
        system, key, qty, kind = (list(rest) + ["Supramax", None, 1.0, "DIESEL"][len(rest):])
        full.append((eco, day, "X", kind, qty, amount, system, "E", key, "f"))
    return spark.createDataFrame(full, LEDGER_SCHEMA)


D1, D2 = dt.date(2026, 1, 31), dt.date(2026, 2, 1)


def test_tolerance_agrees_with_brute_force(spark):
    rng = random.Random(7)
    def draw(n):
        return [("AU-001", D1, round(rng.choice([10.0, 10.1, 99.99, 0.0]) + rng.uniform(-.025, .025), 4), "Supramax",
                 None, rng.choice([None, 5.0, 5.005, 5.0099, 5.0101, 4.995]), rng.choice([None, "", "DIESEL"]))
                for _ in range(n)]
    source, target = draw(300), draw(40)
    def same(s, t):
        def q(x):
            return -1.0 if x is None else x
        return (abs(s[2] - t[2]) < 0.01 and abs(q(s[5]) - q(t[5])) < 0.01 and (s[6] or "") == (t[6] or ""))
    expected = sorted(s[2] for s in source if not any(same(s, t) for t in target))
    found = merge.new_by_natural_key(rows(spark, *source), rows(spark, *target))
    assert sorted(r.Importe for r in found.collect()) == expected
    assert 0 < len(expected) < len(source)


def test_rows_without_id_are_always_new(spark):
    target = rows(spark, ("AU-001", D1, 1.0, "Pase", "a"), ("AU-001", D1, 1.0, "Pase", None))
    source = rows(spark, ("AU-001", D1, 1.0, "Pase", "a"), ("AU-001", D1, 2.0, "Pase", None),
                  ("AU-001", D1, 3.0, "Edenred", "a"))
    assert sorted(r.Importe for r in merge.new_by_id(source, target).collect()) == [2.0, 3.0]


def test_stored_ledger(spark, tmp_path):
    ledger = LedgerTable(spark, next(NAMES), str(tmp_path / "l")).create().create()
    batch = rows(spark, ("AU-001", D1, 1.0), ("AU-002", D2, 2.0), ("AU-003", D2, 3.0, "Pase", "p1"))
    for _ in range(2):
        ledger.merge(batch)
    assert ledger.read().count() == 3
    ledger.merge(rows(spark, ("AU-003", D1, 9.0, "Pase", "p1")), by_id=True)
    assert ledger.read().count() == 3
    ledger.delete_month("Supramax", 2026, 2)
    assert sorted(r.ECO for r in ledger.read().collect()) == ["AU-001", "AU-003"]
    with pytest.raises(ValueError):
        ledger.delete_month("Otro", 2026, 2)
    for _ in range(2):
        ledger.replace_months(rows(spark, ("AU-009", D2, 5.0), ("AU-008", dt.date(2026, 3, 1), 6.0)),
                              "Supramax", [(2026, 1), (2026, 2)])
    assert sorted(r.ECO for r in ledger.read().collect()) == ["AU-003", "AU-008", "AU-009"]
    ledger.replace_months(rows(spark, ("AU-010", D2, 5.0)), "Supramax", [(2026, 2)], partial=True)
    assert ledger.read().count() == 4
    ledger.append(rows(spark, ("AU-010", D2, 5.0)))
    ledger.backup_and_dedup("b", str(tmp_path / "b"))
    assert ledger.read().count() == 4 and spark.table(f"{ledger.name}_backup_b").count() == 5
    assert "Nota" in spark.table(ledger.add_columns("Nota", "Empresa").name).columns
    ledger.append(rows(spark, ("AU-011", D2, 5.0)))
    assert ledger.read().count() == 5


def test_scan_prunes_partitions_and_columns(spark, tmp_path):
    ledger = LedgerTable(spark, next(NAMES), str(tmp_path / "l")).create()
    ledger.append(rows(spark, ("AU-001", D1, 1.0), ("AU-002", D2, 2.0)))
    query = ledger.read().filter((F.col("Sistema") == "Supramax") & (F.col("Fecha") >= D2)).select("ECO")
    plan = query._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(Fecha,2026-02-01)" in plan and "PartitionFilters: [isnotnull(Sistema" in plan
    assert "ReadSchema: struct<ECO:string,Fecha:date>" in plan


def test_stream_merges_each_row_once(spark, tmp_path):
    ledger = LedgerTable(spark, next(NAMES), str(tmp_path / "l")).create()
    folder = str(tmp_path / "in")
    batch = rows(spark, ("au 1", D1, 1.0), ("AU-002", D2, 2.0), ("total", D2, 3.0), ("AU-002", D2, 2.0))
    for _ in range(2):
        batch.write.mode("append").parquet(folder)
        stream = spark.readStream.schema(LEDGER_SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
        ingest_stream(stream, ledger, str(tmp_path / "c")).awaitTermination()
    assert sorted(r.ECO for r in ledger.read().collect()) == ["AU-001", "AU-002"]


def test_stream_cleans_a_batch_once(spark, tmp_path):
    """Every pass of a merge over the batch once repeated its cleaning."""
    seen = []

    class Table:
        def __init__(self):
            self.spark = spark

        def merge(self, batch, by_id=False):
            seen.append((batch._jdf.queryExecution().optimizedPlan().toString(), batch.inputFiles(), batch.count()))

    folder = str(tmp_path / "in")
    rows(spark, ("au 1", D1, 1.0), ("total", D2, 3.0)).write.parquet(folder)
    stream = spark.readStream.schema(LEDGER_SCHEMA).parquet(folder)
    ingest_stream(stream, Table(), str(tmp_path / "c")).awaitTermination()
    (plan, files, n), = seen
    assert "regexp" not in plan.lower() and "rlike" not in plan.lower() and n == 1
    import os
    assert files and not any(os.path.exists(f.removeprefix("file://")) for f in files)  # they go with the batch


def test_text_batch_is_coerced(spark):
    df = spark.createDataFrame([
        ("AU-1", "05/03/2025", "10.5", "Supramax"), ("AU-2", "2025-03-06", "x", "Supramax"),
        ("total", "05/03/2025", "1", "Supramax")], "ECO string, Fecha string, Importe string, Sistema string")
    clean = ingest.clean_batch(df, 2025, 3).collect()
    assert [(r.ECO, r.Fecha, r.Importe) for r in clean] == [("AU-001", dt.date(2025, 3, 5), 10.5)]
    assert ingest.stage_counts(df, 2025, 3).first() == (3, 2, 2, 1)


def test_catalog_counts_listed_copies(spark):
    ledger = rows(spark, ("AU-001", D1, 1.5), ("AU-001", D2, 2.0), ("AU-009", D1, 4.0))
    master = spark.createDataFrame([("AU-001", "A"), ("AU-001", "A"), ("AU-002", "B")], "ECO string, Empresa string")
    check = {r.ECO: r for r in yoy.catalog_check(ledger, master).collect()}
    assert (check["AU-001"].Total_Transacciones, check["AU-001"].Total_Importe) == (4, 7.0)
    assert (check["AU-002"].Sistemas, check["AU-002"].Total_Transacciones) == ("SIN ACTIVIDAD", 0)
    assert check["AU-009"].En_Tabla_Maestra == "NO" and check["AU-009"].Empresa_Catalogo == "N/A"


def test_year_report_has_one_row_per_unit(spark):
    ledger = rows(spark, ("AU-001", dt.date(2025, 1, 1), 1.0), ("AU-001", D1, 2.0), ("AU-002", D1, 3.0),
                  ("AU-003", dt.date(2025, 1, 9), 3.0), ("AU-004", D2, 3.0))
    report = yoy.compare_years(month_detail(ledger, 1, 2025, 2026), 2025, 2026)
    ordered = [(r.ECO, r.Presencia) for r in report.orderBy(*yoy.presence_order(2025, 2026)).collect()]
    assert ordered == [("AU-001", "AMBOS"), ("AU-002", "SOLO_2026"), ("AU-003", "SOLO_2025")]


def test_reconciliation_totals_add_up(spark):
    ledger = rows(spark, ("AU-001", D1, 10.0), ("AU-002", D1, 20.0), ("AU-003", D1, 5.0, "Pase"))
    sheet = spark.createDataFrame(
        [(" au -001", D1, 0.0, 10.0, 0.0, 0.0), ("AU-002", D1, 1.0, 19.0, 0.0, 0.0), ("AU-004", D1, 0.0, 7.0, 0.0, 0.0),
         ("AU-005", None, 0.0, 7.0, 0.0, 0.0), ("AU-006", D1, -3.0, 0.0, 0.0, 0.0)],
        "UNIDAD string, MES date, `IAVE PASE` double, SUPRAMAX double, `TICKET CARD` double, MANTENIMIENTO double")
    detail, summary = recon.reconcile(ledger, sheet, dt.date(2026, 1, 1))
    status = {(r.Concepto, r.Unidad): r.Estado for r in detail.collect()}
    assert status == {
        ("Supramax", "AU-001"): "✅ CUADRA PERFECTO", ("Supramax", "AU-002"): "📊 DIFERENCIA DE MONTO",
        ("Supramax", "AU-004"): "⚠️ FALTA EN BOT AUTOMÁTICO", ("Pase", "AU-003"): "❌ FALTA EN REPORTE MANUAL",
        ("Pase", "AU-002"): "⚠️ FALTA EN BOT AUTOMÁTICO"}
    totals = {r.Concepto: r for r in summary.collect()}
    by_system = detail.groupBy("Concepto").agg(F.sum("Manual"), F.sum("Automatico")).collect()
    assert {(c, m, a) for c, m, a in by_system} == {
        (c, r.Total_Manual, r.Total_Auto) for c, r in totals.items()}
    assert totals["Supramax"].Variacion == round(-6 / 36, 6)


def test_last_alias_wins(spark):
    master = spark.createDataFrame([
        ("AU-001", "AB-1", "S1", 1), ("AU-002", "AB 1", None, 2), ("AU003", "S1", "nan", 3), ("bad", "ZZ1", "S9", 4)],
        ["ECO", "Placas", "Supramax ID", "pos"])
    aliases = joins.alias_table(master, "pos")
    units = spark.createDataFrame([("ab-1",), ("s1",), ("zz1",), ("au 7",)], "ECO string")
    assert [r.ECO for r in joins.resolve_alias(units, "ECO", aliases).orderBy("ECO").collect()] == [
        "AU-002", "AU-003", "AU-007", "ZZ1"]


def test_undated_card_wins(spark):
    df = spark.createDataFrame(
        [("AU-001", "a", D2), ("AU-001", "b", D1), ("AU-002", "c", D2), ("AU-002", "d", None), ("AU-003", None, D1)],
        "ECO string, card string, d date")
    assert {tuple(r) for r in windows.last_per_unit(df, "card", "d").collect()} == {("AU-001", "a"), ("AU-002", "d")}

"""Rows that must not get lost, and jobs that run twice."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fleetbook import session
from fleetbook.functions.dates import parse_date_ladder
from fleetbook.operators import merge
from fleetbook.operators.aggregates import dominant_month
from fleetbook.operators.dedup import dedup_batch
from fleetbook.operators.storage import LedgerTable
from fleetbook.plans import consolidate, ingest, unify
from fleetbook.plans.dashboard import join_master
from fleetbook.plans.trips import trips_table
from fleetbook.sources import archive, ragged
from fleetbook.sources.vendors import edenred_rows
from fleetbook.streaming import changed_files
from fleetbook.vocabulary import LEDGER_SCHEMA

DAY = dt.date(2025, 3, 5)


def ledger(spark, *rows):
    """Rows of (ECO, Importe, Id_Origen)."""
    return spark.createDataFrame(
        [(e, DAY, "PEAJES", None, None, float(x), "Pase", "ACME", i, "a.csv") for e, x, i in rows], LEDGER_SCHEMA)


def test_rows_without_id_stay_apart(spark):
    batch = ledger(spark, ("AU-001", 1, None), ("AU-002", 2, None), ("AU-003", 3, "x"), ("AU-004", 4, "x"), ("AU-002", 2, None))
    assert dedup_batch(batch, by_id=True).count() == 3


def test_replayed_batch_adds_nothing(spark):
    batch = ledger(spark, ("AU-001", 1, None), ("AU-003", 3, "x"))
    assert merge.new_in_batch(batch, batch, by_id=True).count() == 0
    table = LedgerTable(spark, "replayed").create()
    for _ in range(2):
        table.merge(batch, by_id=True)
    assert table.read().count() == 2


def test_backup_keeps_later_columns(spark):
    table = LedgerTable(spark, "evolved").create().add_columns("Nota")
    table.append(ledger(spark, ("AU-001", 1, "x"), ("AU-001", 1, "y")).withColumn("Nota", F.lit("hola")))
    table.backup_and_dedup("one")
    assert [r["Nota"] for r in spark.table("evolved").collect()] == ["hola"]


@pytest.mark.parametrize("text, expected", [
    ("05/03/25", dt.datetime(2025, 3, 5)), ("31/12/99", dt.datetime(1999, 12, 31)),
    ("05/03/2025 01:02:03 PM", dt.datetime(2025, 3, 5, 13, 2, 3)), ("5/3/2025 12:30 a.m.", dt.datetime(2025, 3, 5, 0, 30)),
    ("05-mar-2025", dt.datetime(2025, 3, 5)), ("32/12/99", None), ("05-xyz-2025", None)])
def test_date_forms(spark, text, expected):
    assert spark.range(1).select(parse_date_ladder(F.lit(text)).alias("d")).first()["d"] == expected


def test_unread_dates_are_counted(spark):
    rows = spark.createDataFrame([("AU-001", "05/03/25", "1"), ("AU-001", "soon", "1"), ("AU-001", None, "1")], "ECO string, Fecha string, Importe string")
    assert ingest.unread_dates(rows).first()["fecha_no_leida"] == 1


def test_trips_run_over_their_own_result(spark):
    rows = spark.createDataFrame(
        [("AU-001", dt.datetime(2025, 3, 9, 10), dt.datetime(2025, 3, 9, 11), "u", 1.0, 1)],
        "ECO string, `Fecha-hora Inicio` timestamp_ntz, `Fecha-hora Término` timestamp_ntz, Usuario string, `Distancia(KM)` double, pos int")
    first = trips_table(rows, None, ["pos"])
    again = trips_table(rows, first, ["pos"])
    assert again.columns == first.columns and again.count() == 1
    assert again.first()["Es_Domingo_Aux"] == 1


def test_catalogue_with_columns_of_the_ledger(spark):
    master = spark.createDataFrame([("AU-001", "Pickup")], "ECO string, Tipo string")
    expenses = spark.createDataFrame([("AU-001", "MAGNA", 5.0)], "ECO string, Tipo string, Importe double")
    row = join_master(expenses, master).first()
    assert (row["Tipo_maestra"], row["Tipo_consumo"]) == ("Pickup", "MAGNA")


def test_card_header_in_any_row(spark):
    header = ["Fecha Transacción", "Mercancía", "Cantidad Mercancía", "Importe Transacción", "Núm Tarjeta", "Vehículo"]
    row = ["05/03/2025", "MAGNA", "1", "2", "3", "AU-001"]
    raw = spark.createDataFrame(
        [("a.csv", 0, header), ("a.csv", 1, row), ("b.csv", 0, ["x"]), ("b.csv", 5, header), ("b.csv", 6, row)],
        "path string, row_idx bigint, cells array<string>")
    assert edenred_rows(raw).count() == 2


def test_dominant_month_takes_the_earliest_of_equals(spark):
    at = [dt.datetime(2025, m, 1) for m in (4, 3, 3, 4, 5)]
    rows = spark.createDataFrame([("f", t) for t in at], "Archivo_Origen string, t timestamp_ntz")
    assert tuple(dominant_month(rows, "t").first()) == ("f", 2025, 3)


def test_cluster_without_shared_folder_stops():
    class Fake:
        class conf:
            get = staticmethod(lambda key, default=None: None)

        class sparkContext:
            master, applicationId = "spark://host:7077", "app"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_dir(Fake, "x")


def test_only_changed_files_are_consolidated(spark, tmp_path):
    folder = tmp_path / "in" / "2025 [a]"
    folder.mkdir(parents=True)
    head = "No. economico;Fecha;Importe;Tag\n"
    (folder / "a.csv").write_text(head + "AU-1;2025/03/05;1;T\n")
    (folder / "b.csv").write_text(head + "AU-2;2025/03/05;2;T\n")
    stored = spark.createDataFrame([], "ECO string")
    registry = spark.createDataFrame([], "path string, length bigint, modificationTime timestamp, processed_at timestamp")

    def run(n):
        rows, seen = consolidate.consolidate(spark, "Pase", str(tmp_path / "in"), stored, registry, dt.datetime(2025, 1, n))
        rows.write.parquet(str(tmp_path / f"rows{n}"))
        seen.write.parquet(str(tmp_path / f"seen{n}"))
        return spark.read.parquet(str(tmp_path / f"rows{n}")), spark.read.parquet(str(tmp_path / f"seen{n}"))

    stored, registry = run(1)
    assert sorted(r.ECO for r in stored.collect()) == ["AU-1", "AU-2"]
    (folder / "a.csv").write_text(head + "AU-1;2025/03/05;1;T\nAU-3;2025/03/06;3;T\n")
    stored, registry = run(2)
    assert sorted(r.ECO for r in stored.collect()) == ["AU-1", "AU-2", "AU-3"]
    assert sorted(r.processed_at.day for r in registry.collect()) == [1, 2]
    again = consolidate.consolidate(spark, "Pase", str(tmp_path / "in"), stored, registry, dt.datetime(2025, 1, 3))
    assert again == (stored, registry)


CARDS = "Folio,Vehículo,Fecha Transacción,Mercancía,Cantidad Mercancía,Importe Transacción,Núm Tarjeta,Unidad\n"
FILES = {
    "Pase": {
        "good.csv": "No. economico;Fecha;Importe;Tag\nAU-1;2025/03/05;1;T\n", "bare.csv": "AU-7;2025/03/05;1;T\nAU-8;2025/03/05;1;T\n",
        "nul.csv": "No. economico;Fecha;Importe;Tag\nAU-9;2025/03/05;1;T\n\0\0\n",
        "open.csv": 'No. economico;Fecha;Importe;Tag\nAU-9;2025/03/05;1;T\nAU-9;"' + "x;y\n" * 60_000, "empty.csv": ""},
    "Edenred": {
        "good.csv": CARDS + "1,AU-1,05/03/2025,MAGNA,1,2,3,x\n", "low.csv": "Reporte\n\nCliente:,ACME\n\n\n" + CARDS + "1,AU-2,05/03/2025,MAGNA,1,2,3,x\n",
        "bare.csv": "1,AU-7,05/03/2025,MAGNA,1,2,3,x\n", "nul.csv": CARDS + "1,AU-9,05/03/2025,MAGNA,1,2,3,x\0\n", "empty.csv": ""},
    "Supramax": {
        "good.xls": "<table><tr><td>PLACAS</td><td>FECHA</td></tr><tr><td>AU-1</td><td>x</td></tr></table>",
        "bare.xls": "<table><tr><td>AU-7</td><td>x</td></tr></table>", "nul.xls": "\0\1\2", "empty.xls": ""},
}


@pytest.mark.parametrize("system", sorted(FILES))
def test_every_file_has_an_outcome(spark, tmp_path, system):
    folder = tmp_path / "in ñ"
    folder.mkdir()
    for name, text in FILES[system].items():
        (folder / name).write_text(text)
    stored = spark.createDataFrame([], "Archivo_Origen string")
    registry = spark.createDataFrame([], changed_files.REGISTRY)

    def run(n):
        rows, seen = consolidate.consolidate(spark, system, str(folder), stored, registry, dt.datetime(2025, 1, n))
        rows.write.parquet(str(tmp_path / f"rows{n}"))
        seen.write.parquet(str(tmp_path / f"seen{n}"))
        return spark.read.parquet(str(tmp_path / f"rows{n}")), spark.read.parquet(str(tmp_path / f"seen{n}"))

    stored, registry = run(1)
    states = {r.path.rsplit("/", 1)[1].split(".")[0]: (r.state, r.problem) for r in registry.collect()}
    assert states.pop("good") == ("read", None) and states.pop("bare") == ("no header", "no header row")
    assert "empty" not in states  # Spark lists no files without bytes
    if system == "Edenred":
        assert states.pop("low") == ("read", None)
    if system != "Supramax":
        assert states.pop("nul") == ("torn", "not a text file")
    if system == "Pase":
        assert states.pop("open") == ("torn", "a cell of more than 131072 characters")
    unit = {"Pase": "ECO", "Edenred": "Vehículo", "Supramax": "PLACAS"}[system]
    first = {"Edenred": ["AU-1", "AU-2"]}.get(system, ["AU-1"])
    assert sorted(r[unit] for r in stored.collect()) == first
    # The files that could not be read come again, and count once they are mended.
    ending = sorted(FILES[system])[0].rsplit(".", 1)[1]
    (folder / f"bare.{ending}").write_text(FILES[system][f"good.{ending}"].replace("AU-1", "AU-7"))
    stored, registry = run(2)
    assert sorted(r[unit] for r in stored.collect()) == first + ["AU-7"]
    days = {r.path.rsplit("/", 1)[1].split(".")[0]: (r.state, r.processed_at.day) for r in registry.collect()}
    assert days["good"] == ("read", 1) and days["bare"] == ("read", 2)


def test_jobs_stop_at_a_file_without_header(spark):
    header = ["Fecha Transacción", "Mercancía", "Cantidad Mercancía", "Importe Transacción", "Núm Tarjeta", "Vehículo"]
    good = [("Edenred/2025/e/a.csv", 0, header), ("Edenred/2025/e/a.csv", 1, ["05/03/2025", "MAGNA", "1", "2", "3", "AU-001"])]
    kind = "path string, row_idx bigint, cells array<string>"
    raw = spark.createDataFrame(good, kind)
    assert unify.unify_edenred(raw)[1].count() == 1
    assert unify.recover_edenred(raw, ledger(spark), 2025).count() == 1
    lost = spark.createDataFrame(good + [("Edenred/2025/e/b.csv", 0, ["x"])], kind)
    for job in (lambda: unify.unify_edenred(lost)[0], lambda: unify.recover_edenred(lost, ledger(spark), 2025), lambda: unify.unify_supramax(lost)):
        with pytest.raises(Exception, match="no header row in Edenred/2025/e/"):
            job().collect()


def test_archive_path_from_content(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Fecha;Fecha de cruce\n2024/01/01;2025/03/05\n2024/01/01;2025/03/05\n2024/01/01;2025/04/01\n")
    (tmp_path / "b.csv").write_text("x;y\n1;2\n")
    period = archive.content_period(ragged.read_ragged(spark, str(tmp_path)), "Pase")
    found = archive.manifest(archive.read_files(spark, str(tmp_path), "*.csv"), "Pase", dt.date(2023, 7, 1), period=period)
    assert sorted(r.archive.split("/pase_")[0] for r in found.collect()) == ["Pase/2023/07", "Pase/2025/03"]

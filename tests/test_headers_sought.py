"""Headers are sought in the first rows of files before all rows are searched."""

import datetime as dt

import pytest

from fleetbook.plans import consolidate
from fleetbook.sources import headers, ragged
from fleetbook.streaming import changed_files

CARDS = "Folio,Vehículo,Fecha Transacción,Mercancía,Cantidad Mercancía,Importe Transacción,Núm Tarjeta,Unidad\n"
ROW = "1,AU-{},05/03/2025,MAGNA,1,2,3,x\n"


@pytest.mark.parametrize("named", [1000, 1])
def test_headers_are_those_of_a_whole_search(spark, monkeypatch, named):
    monkeypatch.setattr(headers, "_NAMED", named)
    rows = [(f"f{f}", k, [" PLACAS", str(k)] if k in at else ["PLACAS x", "y"])
            for f, at in enumerate([(0,), (3, 0), (99, 101), (100,), (150, 170), (), (1,)]) for k in range(180)]
    raw = ragged.land(spark, spark.createDataFrame(rows, ragged.RAW_SCHEMA).repartition(3))
    for some in (raw, raw.filter("path in ('f0', 'f6')"), raw.filter("path in ('f4', 'f5')"), raw.limit(0)):
        whole = headers.marker_headers(some, "PLACAS").collect()
        assert sorted(headers.sought_headers(some, headers.marker_headers, "PLACAS").collect()) == sorted(whole)
    assert sorted((r.path, r.header_row) for r in headers.sought_headers(raw, headers.marker_headers, "PLACAS").collect()) == [
        ("f0", 0), ("f1", 0), ("f2", 99), ("f3", 100), ("f4", 150), ("f6", 1)]


def test_a_consolidation_searches_first_rows_and_files_without_a_header(spark, tmp_path, monkeypatch):
    """The rows of a large file with its header on top are not searched."""
    looked = []

    def found(raw, *args):
        looked.append(raw.count())
        return headers.marker_headers(raw, "Fecha Transacción")

    monkeypatch.setattr(consolidate, "card_headers", found)
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "good.csv").write_text(CARDS + "".join(ROW.format(k) for k in range(3000)))
    (folder / "low.csv").write_text("Reporte,\n" * 120 + CARDS + ROW.format(1))
    (folder / "bare.csv").write_text(ROW.format(7) * 5)
    rows, seen = consolidate.consolidate(
        spark, "Edenred", str(folder), spark.createDataFrame([], "Archivo_Origen string"),
        spark.createDataFrame([], changed_files.REGISTRY), dt.datetime(2025, 1, 1))
    assert rows.count() == 3001 and looked == [100 + 100 + 5, 122 + 5]
    assert sorted((r.path.rsplit("/", 1)[1], r.state) for r in seen.collect()) == [
        ("bare.csv", "no header"), ("good.csv", "read"), ("low.csv", "read")]


def test_deliveries_are_written_in_one_go_and_come_one_by_one(spark, monkeypatch):
    import __spark_entry__ as entry
    from checks import source_queries

    written, files = [], []
    write, take = source_queries._write_lines, consolidate.consolidate
    monkeypatch.setattr(source_queries, "_write_lines", lambda *a: (written.append(a[2]), write(*a)))

    def counting(spark, system, folder, *rest):
        files.append(len(spark.read.option("recursiveFileLookup", True).text(folder).inputFiles()))
        return take(spark, system, folder, *rest)

    monkeypatch.setattr(consolidate, "consolidate", counting)
    entry.queries()["job_consolidate_outcomes"](spark, "/root/testdata/sf0.001")
    assert len(written) == 2 and files == [4, 6, 6] * 2

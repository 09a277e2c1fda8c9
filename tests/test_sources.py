"""Readers on hand-made files."""

import contextlib
import csv
import datetime as dt
import io
import random

import pytest
from pyspark.sql import functions as F

from fleetbook.plans import unify
from fleetbook.sources import archive, headers, html, maps, ragged, vendors
from fleetbook.streaming import changed_files


def cells(df):
    return [(r.row_idx, r.cells) for r in df.orderBy("path", "row_idx").collect()]


def put(folder, name, text, encoding="utf-8"):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return str(path)


TOLL = ("No. económico;Fecha de cruce;Importe al 100;Nota;Nota\n"
        "AU-1;2025/03/05;$1,234.50;\"a;b\"\n\nCA 2;06/03/2025;-7;x;y; \nAU3;2025-03-07;1;;;extra;\n")


@pytest.mark.parametrize("encoding", ["utf-8", "utf-8-sig", "latin-1"])
def test_no_cell_is_lost(spark, tmp_path, encoding):
    put(tmp_path, "a.csv", TOLL, encoding)
    assert cells(ragged.read_ragged(spark, str(tmp_path))) == [
        (0, ["No. económico", "Fecha de cruce", "Importe al 100", "Nota", "Nota"]),
        (1, ["AU-1", "2025/03/05", "$1,234.50", "a;b"]),
        (2, ["CA 2", "06/03/2025", "-7", "x", "y", " "]),
        (3, ["AU3", "2025-03-07", "1", "", "", "extra", ""])]


@contextlib.contextmanager
def splits_of(spark, size):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_line_numbers_continue_over_blocks(spark, tmp_path):
    text = "a,b\n" + "".join(f"{i},é{i}\n" for i in range(3000))
    put(tmp_path, "big.csv", text)
    put(tmp_path, "other.csv", "c|d\n1|2\n")
    with splits_of(spark, 4096):
        split = cells(ragged.read_ragged(spark, str(tmp_path)))
    assert split == cells(ragged.read_ragged(spark, str(tmp_path)))
    assert [c for _, c in split][:3001] == [["a", "b"], *[[str(i), f"é{i}"] for i in range(3000)]]


#: Lines of tabs, stray quotes, quoted delimiters and line breaks, blank lines.
ODD = ['AU-1;2;x', '\t\t', 'AU-2;"a "b" c";11', '"x\ny";2;"z;1"', '', 'e"f;"g ""h"" i";3', '"p\r\nq\n\n r";;\t',
       '   ', '""', '"";"";5', 'k;"l\n\nm"', '"\n"', 'é;ñ;"ü"']


@pytest.mark.parametrize("skip_blank", [True, False])
@pytest.mark.parametrize("encoding", ["utf-8", "latin-1"])
def test_rows_do_not_depend_on_splits(spark, tmp_path, encoding, skip_blank):
    rng = random.Random(7)
    body = ["a;b;c"] + [rng.choice(ODD) for _ in range(400)]
    text = "\n".join(body) + "\n"
    put(tmp_path, "odd.csv", text, encoding)
    put(tmp_path, "cr.csv", "a;b;c\r\n" + "\r\n".join(rng.choice(ODD[:4]) for _ in range(60)), encoding)
    expected = []
    for name in ("cr.csv", "odd.csv"):
        data = (tmp_path / name).read_bytes().decode(encoding)
        rows = csv.reader(io.StringIO(data, newline=""), delimiter=";", quotechar='"')
        kept = [r for r in rows if not skip_blank or r == ["\n"] or len(r) > 1 or (r and r[0].strip())]
        expected += list(enumerate(kept))
    for size in (64, 333, 1500, 1 << 27):
        with splits_of(spark, size):
            assert cells(ragged.read_ragged(spark, str(tmp_path), skip_blank)) == expected, size


def test_unclosed_quotes_and_binary_files_fail(spark, tmp_path):
    put(tmp_path / "u", "a.csv", 'a;b\n1;"x\n' + "y;z\n" * 60000)
    for size in (5000, 1 << 27):
        with splits_of(spark, size), pytest.raises(Exception, match="131072"):
            ragged.read_ragged(spark, str(tmp_path / "u")).collect()
    put(tmp_path / "b", "a.xls", "a\0b")
    with pytest.raises(Exception, match="not a text file"):
        ragged.read_ragged(spark, str(tmp_path / "b")).collect()


def test_files_are_chosen_before_they_are_read(spark, tmp_path):
    kept = put(tmp_path, "2025/a.csv", "a;b\n1;2\n")
    put(tmp_path, "2025/a.xlsx", "a\0b")
    put(tmp_path, "2024/a.csv", "a\0b")
    raw = ragged.read_ragged(spark, str(tmp_path), suffixes=[".csv", ".txt"], year=2025)
    assert cells(raw) == [(0, ["a", "b"]), (1, ["1", "2"])]
    assert all(r.path.endswith(kept) for r in raw.collect())
    assert cells(ragged.read_ragged(spark, [kept])) == cells(raw)


def test_header_names(spark, tmp_path):
    put(tmp_path, "a.csv", TOLL)
    row = headers.first_row_headers(ragged.land(spark, ragged.read_ragged(spark, str(tmp_path)))).first()
    assert row.header == ["No. económico", "Fecha de cruce", "Importe al 100", "Nota", "Nota__dup2",
                          "__extra_col_1", "__extra_col_2"]
    assert row.kept == [0, 1, 2, 3, 4, 5]


def test_toll_rows(spark, tmp_path):
    put(tmp_path, "pase_0123456789ab_g1A5.1.csv", TOLL)
    rows = vendors.clean_pase(ragged.read_ragged(spark, str(tmp_path)), "ACME").orderBy("Fecha").collect()
    assert [(r.ECO, r.Fecha.day, r.Importe, r.Concepto, r.Empresa) for r in rows] == [
        ("AU-1", 5, 1234.5, "PEAJES", "ACME"), ("CA 2", 6, 7.0, "PEAJES", "ACME"), ("AU3", 7, 1.0, "PEAJES", "ACME")]
    again = tmp_path / "copy"
    put(again, "g1A5.1.csv", TOLL)
    ids = {r.Id_Origen for r in vendors.clean_pase(ragged.read_ragged(spark, str(again))).collect()}
    assert ids == {r.Id_Origen for r in rows} and len(ids) == 3


def test_fuel_header_in_fourth_row(spark, tmp_path):
    put(tmp_path, "f.csv", "Reporte\n\nx,y\n PLACAS ,FECHA,PRODUCTO,CANTIDAD,IMPORTE\n"
        "AU-1,2025/03/05 01:02:03,ARCO MAGNA,10.5,250\nTOTAL,,,,250\n")
    raw = ragged.read_ragged(spark, str(tmp_path), skip_blank=False)
    rows = vendors.clean_supramax(vendors.supramax_rows(raw), "E").orderBy("ECO").collect()
    assert (rows[0].ECO, rows[0].Fecha, rows[0].Tipo, rows[0].Cantidad) == (
        "AU-1", dt.datetime(2025, 3, 5, 1, 2, 3), "REGULAR", 10.5)
    assert rows[1].Fecha is None and rows[1].Empresa == "E"


def test_card_export_with_preamble(spark, tmp_path):
    head = "Reporte\n,Cliente:, Acme sa \n\n\n\n"
    put(tmp_path, "Edenred/x_y/2025/03/a.csv", head +
        "Folio,Vehículo,Fecha Transacción,Mercancía,Cantidad Mercancía,Importe Transacción,Núm Tarjeta\n"
        "1,AU-001,05/03/2025,DIESEL,10,200.5,9999\n")
    raw = ragged.read_ragged(spark, str(tmp_path), skip_blank=False)
    assert headers.preamble_value(raw, "Cliente:").first().value == "ACME SA"
    row = vendors.clean_edenred(vendors.edenred_rows(raw)).first()
    assert (row.ECO, row.Fecha, row.Tipo, row.Cantidad, row.Importe) == (
        "AU-001", dt.datetime(2025, 3, 5), "DIESEL", 10.0, "200.5")
    raw_rows, clean = unify.unify_edenred(raw)
    assert raw_rows.count() == 1 and clean.first().Importe == 200.5


def test_fuel_exports_that_are_html(spark, tmp_path):
    page = ("<table><tr><td>Reporte</td></tr><tr><th>PLACAS</th><th>FECHA</th><th>PRODUCTO</th><th>CANTIDAD</th>"
            "<th>IMPORTE</th></tr><tr><td>AU-1</td><td>2025/03/05 01:02:03</td><td>Diésel</td><td>2</td><td>9.5</td>"
            "</tr></table><table><tr><td>pie</td></tr></table>")
    put(tmp_path, "Supramax/2025/03/a.xls", page, "latin-1")
    put(tmp_path, "Supramax/2025/03/b.xls", page, "utf-8")
    put(tmp_path, "Supramax/2025/03/c.csv", "a;b\n")
    put(tmp_path, "Supramax/2024/03/d.xls", "")
    raw = html.read_html_files(spark, str(tmp_path), [".xls"], 2025)
    rows = vendors.clean_supramax(vendors.supramax_rows(headers.with_header(raw, headers.marker_headers, "PLACAS")))
    assert [(r.ECO, r.Tipo, r.Cantidad, r.Importe) for r in rows.collect()] == [("AU-1", "DIÉSEL", 2.0, "9.5")] * 2
    put(tmp_path, "Supramax/2025/03/e.xls", "<table><tr><td>sin datos</td></tr></table>")
    raw = html.read_html_files(spark, str(tmp_path), [".xls"], 2025)
    with pytest.raises(Exception, match="no header row in .*e.xls"):
        headers.with_header(raw, headers.marker_headers, "PLACAS").collect()


def test_consolidation_has_its_own_ladder(spark, tmp_path):
    put(tmp_path, "Pase/ACME/2025/03/a.csv", "Fecha de facturación;Importe base;Fecha;Importe;No. Económico;Tag\n"
        "2025/01/01;5;2025/03/02;-7.5;AU-1;T1.\n")
    put(tmp_path, "Pase/ACME/2025/03/b.csv", "Fecha;Monto;Eco\n2025/03/02;5;AU-2\n")
    rows = vendors.pase_consolidated(ragged.read_ragged(spark, str(tmp_path)))
    found = {r.Archivo_Origen: (r.ECO, r.Fecha and r.Fecha.day, r.Importe, r["Tarjeta IDMX"]) for r in rows.collect()}
    assert found == {"a.csv": ("AU-1", 2, 7.5, "T1"), "b.csv": (None, 2, None, None)}


def test_html_tables(spark):
    page = ("<table><tr><th> A</th><th>B</th></tr><tr><td>1<td><b>2</b> &amp; 3</tr>"
            "<tr><td><table><tr><td>in</td></tr></table>x</td></tr></table><table><tr><td>z</td></tr></table>")
    df = spark.createDataFrame([("p", page), ("q", None), ("r", "<p>none</p>")], "path string, html string")
    rows = html.html_table_rows(df, "path", "html")
    assert sorted((r.table, r.row_idx, r.cells) for r in rows.collect()) == [
        (0, 0, ["A", "B"]), (0, 1, ["1", "2 & 3"]), (0, 2, ["x"]), (1, 0, ["in"]), (2, 0, ["z"])]


def test_tag_links_first_block_wins(spark):
    page = ('<div><div><a href="/uc/detalletag/1">IM 1.</a><p>AU-001 x</p></div>'
            '<div><a href="/uc/detalletag/2">IM 2</a><p>otro</p><p> CA-002</p></div>'
            '<div><a href="/uc/detalletag/3">IM 3</a><p>AU-001</p></div></div>')
    df = spark.createDataFrame([("p", page)], "path string, html string")
    assert {(r.ECO, r.tag) for r in html.html_tag_pairs(df, "path", "html").collect()} == {
        ("AU-001", "IM1"), ("CA-002", "IM2")}


def test_look_up_files(spark, tmp_path):
    put(tmp_path, "tags.json", '{"AU-001": "T1",\n "CA-002": "T2"}')
    assert {tuple(r) for r in maps.read_json_map(spark, str(tmp_path / "tags.json")).collect()} == {
        ("AU-001", "T1"), ("CA-002", "T2")}
    df = spark.createDataFrame([
        ('{"by_number": {"5": "A", "6": ""}, "by_slot": {"1": "B"}}',), ('{"7": "C"}',), ("broken",)], "j string")
    assert {tuple(r) for r in maps.client_map(df, "j").collect()} == {
        ("by_number", "5", "A"), ("by_slot", "1", "B"), ("by_number", "7", "C")}
    put(tmp_path, "keys.txt", " au 1 \n\nCA-2\n")
    assert [r.ECO for r in maps.read_key_list(spark, str(tmp_path / "keys.txt")).collect()] == ["AU-001", "CA-002"]


def test_required_columns_are_checked(spark):
    with pytest.raises(ValueError):
        vendors.from_consolidated(spark.createDataFrame([("a",)], "ECO string"), "Pase")


def test_manifest_and_changed_files(spark, tmp_path):
    put(tmp_path, "a.csv", "1")
    put(tmp_path, "b.csv", "22")
    files = spark.read.format("binaryFile").load(str(tmp_path))
    paths = {r.archive for r in archive.manifest(files, "Pase", dt.date(2026, 1, 5), company="A B").collect()}
    assert "Pase/A_B/2026/01/pase_6b86b273ff34_a.csv" in paths and len(paths) == 2
    found = changed_files.listing(spark, str(tmp_path))
    nothing = found.limit(0).withColumn("processed_at", F.lit("t"))
    registry = spark.createDataFrame(changed_files.registered(nothing, found, "t").collect())
    assert changed_files.changed(found, registry).count() == 0
    put(tmp_path, "b.csv", "333")
    again = changed_files.listing(spark, str(tmp_path))
    fresh = changed_files.changed(again, registry)
    assert [r.path[-5:] for r in fresh.collect()] == ["b.csv"]
    assert changed_files.registered(registry, fresh, "u").count() == 2


def test_the_best_of_several_html_tables(spark, tmp_path):
    """Most units win, then most columns, then the first; a preferred table of a file that has
    units there goes first; files without a unit column give no rows."""
    from fleetbook.sources import tables

    def table(*rows):
        return "<table>" + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows) + "</table>"

    none = table(("Total", "Suma"), ("AU-001", "9"))
    one = table(("Fecha", "No. Económico"), ("x", "AU-1"), ("y", " "))
    two = table(("ECO", "Importe", "Nota"), ("CA-1", "1", ""), ("CA-2", "2"))
    put(tmp_path, "a.xls", none + one + two)
    put(tmp_path, "b.xls", two + one + two)
    put(tmp_path, "c.xls", none)
    put(tmp_path, "d.xls", table(("ECO",)) + none)
    put(tmp_path, "e.xls", "")
    raw = html.read_html_files(spark, str(tmp_path), [".xls"], table=html.BEST)
    got = {(r.path[-5:], r.row_idx): r.cells for r in raw.collect()}
    assert got == {
        ("a.xls", 0): ["ECO", "Importe", "Nota"], ("a.xls", 1): ["CA-1", "1", ""], ("a.xls", 2): ["CA-2", "2"],
        ("b.xls", 0): ["ECO", "Importe", "Nota"], ("b.xls", 1): ["CA-1", "1", ""], ("b.xls", 2): ["CA-2", "2"],
        ("d.xls", 0): ["ECO"]}
    rows = spark.createDataFrame(
        [("a", 0, 0, ["ECO"]), ("a", 0, 1, ["AU-1"]), ("a", 1, 0, ["ECO"]), ("b", 1, 0, ["x"]), ("b", 0, 0, ["ECO"])],
        "path string, table int, row_idx long, cells array<string>")
    best = tables.best_tables(tables.table_stats(rows), preferred=(1,))
    assert {(r.path, r.table) for r in best.collect()} == {("a", 1), ("b", 0)}

"""Files are read once, headers are found once, and rows stay where they are meanwhile."""

import datetime as dt
import random
import re

import pytest

from fleetbook.plans import consolidate, unify
from fleetbook.sources import headers, ragged, vendors
from fleetbook.streaming import changed_files

KIND = "path string, row_idx bigint, cells array<string>"


def _plan(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def _landed(spark, header, rows, files=3):
    made = [(f"Pase/ACME/2025/f{i}.csv", k, cells) for i in range(files) for k, cells in enumerate([header, *rows])]
    return ragged.land(spark, spark.createDataFrame(made, KIND))


CARD = ["Fecha Transacción", "Mercancía", "Cantidad Mercancía", "Importe Transacción", "Núm Tarjeta", "Vehículo"]
CARD_ROWS = [["05/03/2025", "MAGNA", "1", "2", "3", "AU-001"]]
TOLL_ROWS = [["AU-1", "2025/03/05", "1", "T"]]
JOBS = {
    "edenred": lambda raw: vendors.edenred_rows(raw),
    "unify_edenred": lambda raw: unify.unify_edenred(raw)[0],
    "clean_pase": lambda raw: vendors.clean_pase(raw, "E"),
    "consolidated": lambda raw: vendors.pase_consolidated(raw),
}


@pytest.mark.parametrize("job", sorted(JOBS))
def test_rows_are_not_shuffled_by_file(spark, job):
    """On the path alone, all rows of a large file would meet in one task."""
    toll = job in ("clean_pase", "consolidated")
    raw = _landed(spark, *((["No. económico", "Fecha de cruce", "Importe al 100", "Tarjeta IDMX"], TOLL_ROWS) if toll else (CARD, CARD_ROWS)))
    plan = _plan(JOBS[job](raw))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning(path" not in plan


def test_a_marker_is_searched_in_one_pass(spark):
    raw = _landed(spark, CARD, CARD_ROWS)
    assert _plan(headers.marker_headers(raw, vendors.CARD_MARKER)).count("FileScan parquet") == 1


def test_extra_cells_count_where_they_are_filled(spark):
    rows = [("a", 0, [" x ", "x", None]), ("a", 1, ["1"]), ("a", 2, ["1", "2", "3", " ", None, "z", ""]), ("a", 3, ["1", "2", "3", "4"]),
            ("b", 0, ["x"]), ("b", 1, ["1", " "]), ("c", 1, ["1", "2"]), ("d", 0, []), ("d", 1, ["", "q"])]
    found = headers.first_row_headers(spark.createDataFrame(rows, KIND)).collect()
    assert {r.path: (r.header, r.kept) for r in found} == {
        "a": (["x", "x", None, *[f"__extra_col_{i}" for i in range(1, 5)]], [0, 1, 2, 3, 5]),
        "b": (["x", "__extra_col_1"], [0]), "d": (["__extra_col_1", "__extra_col_2"], [1])}


def test_text_is_scanned_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a;b\n1;2\n")
    assert len(re.findall("FileScan text", _plan(ragged.read_ragged(spark, str(tmp_path))))) == 1


def test_files_that_are_not_wanted_stay_closed(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a;b\n1;2\n")
    (tmp_path / "b.csv.gz").write_bytes(b"\x1f\x8b no archive")
    wanted = changed_files.listing(spark, str(tmp_path), "*.csv", uri=True).selectExpr("uri as path")
    assert [r.cells for r in ragged.read_ragged(spark, str(tmp_path), files=wanted).orderBy("row_idx").collect()] == [["a", "b"], ["1", "2"]]


def test_more_files_than_are_named_to_the_scan(spark, tmp_path, monkeypatch):
    for name in "abc":
        (tmp_path / f"{name}.csv").write_text(f"{name};1\n")
    monkeypatch.setattr(ragged, "_NAMED", 1)
    wanted = changed_files.listing(spark, str(tmp_path), "[ab].csv", uri=True).selectExpr("uri as path")
    rows = ragged.read_ragged(spark, str(tmp_path), files=wanted).collect()
    assert sorted(r.cells[0] for r in rows) == ["a", "b"]


def test_a_run_without_readable_files_leaves_the_store_alone(spark, tmp_path):
    (tmp_path / "bare.csv").write_text("AU-7;2025/03/05;1;T\nAU-8;2025/03/05;1;T\n")
    stored = spark.createDataFrame([("AU-1",)], "ECO string")
    registry = spark.createDataFrame([], changed_files.REGISTRY)
    rows, seen = consolidate.consolidate(spark, "Pase", str(tmp_path), stored, registry, dt.datetime(2025, 1, 1))
    assert "Aggregate" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert [(r.ECO, r.Importe) for r in rows.collect()] == [("AU-1", None)] and rows.columns == [
        "ECO", "Fecha", "Importe", "Tarjeta IDMX", "Archivo_Origen"]
    assert [r.state for r in seen.collect()] == ["no header"]


def test_plain_lines_are_what_the_parser_reads():
    rng, plain = random.Random(3), 0
    for _ in range(3000):
        text = "".join(rng.choice(["a", "é", ";", ";", "\t", " ", "\n", "\n", "\x0b", " ", "\x85", "'"] + ['"', "\r"] * (rng.random() < 0.2))
                       for _ in range(rng.randint(0, 30))) + "\n"
        for delimiter in ";\t":
            for skip_blank in (True, False):
                lines = ragged._plain_lines(text, (delimiter, '"', False), skip_blank)
                if lines is None:
                    continue
                plain += 1
                read = [cells for cells, _, n, still_open in ragged._records(text, False, delimiter, '"', False)
                        if ragged._counts(cells, n, still_open, skip_blank)]
                assert read == [line.split(delimiter) for line in lines], text
                if lines:
                    batch = ragged._plain_batch("p", 7, lines, delimiter).to_pylist()
                    assert [r["cells"] for r in batch] == read and [r["row_idx"] for r in batch] == list(range(7, 7 + len(read)))
    assert plain > 3000

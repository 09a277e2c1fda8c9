"""What the physical plans must and must not hold."""

import datetime as dt

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    return entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "sink_merge_insert_tol", "sink_merge_insert_id", "agg_catalog", "agg_recon_summary", "set_coverage_gaps",
    "join_alias_resolve", "job_cards", "job_dashboard", "src_pase", "win_first_of_day_flags"])
def test_no_pairwise_join(spark, name):
    text = plan(spark, name)
    assert "NestedLoop" not in text and "CartesianProduct" not in text


def test_merge_joins_on_the_amount_cells(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(spark, "sink_merge_insert_tol")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = next(line for line in text.splitlines() if "SortMergeJoin" in line)
    assert "LeftAnti" in join and "_cell_amt" in join and "_cell_qty" in join


def test_dedup_limits_groups_before_the_shuffle(spark):
    text = plan(spark, "win_dedup_ledger")
    assert text.index("WindowGroupLimit", text.index("Exchange")) > 0 and "Partial" in text


def test_report_scan_is_pruned(spark):
    text = plan(spark, "agg_units_by_month")
    assert "GreaterThanOrEqual(Fecha,1996-01-01)" in text and "LessThan(Fecha,1998-01-01)" in text
    assert "ReadSchema: struct<ECO:string,Fecha:date>" in text
    assert "Expand" not in text


def test_trip_flags_need_no_window(spark):
    assert "Window" not in plan(spark, "win_first_of_day_flags")


def test_yearly_report_shuffles_little(spark):
    text = plan(spark, "job_yoy_report")
    assert text.count("Exchange hashpartitioning") <= 8 and text.count("Window") == 0
    # The ledger is not among what the sheets read: they read three stored aggregates.
    assert "Archivo_Origen" not in text


@pytest.mark.parametrize("name", ["sort_custom_rank", "sort_report"])
def test_positions_need_no_single_task(spark, name):
    text = plan(spark, name)
    assert "SinglePartition" not in text and "Window" not in text


def test_positions_agree_with_sorting(spark):
    from pyspark.sql import functions as F

    from fleetbook.operators.positions import with_positions

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(5000).select(((F.col("id") * 7919) % 5003).alias("a"), (F.col("id") % 7).alias("b"))
        got = with_positions(rows, [F.col("b").desc(), "a"]).collect()
        assert len({r["pos"] for r in got}) == 5000 == len(got)
        assert [(r["a"], r["b"]) for r in sorted(got, key=lambda r: r["pos"])] == sorted(((r["a"], r["b"]) for r in got), key=lambda t: (-t[1], t[0]))
        assert with_positions(rows.limit(0), ["a"]).count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_dashboard_plans_its_rows_once(spark):
    text = plan(spark, "job_dashboard")
    # One scan of the rows; the map of units and the catalogue have theirs.
    assert text.count("fecha_raw") and len([x for x in text.splitlines() if "FileScan" in x and "fecha_raw" in x]) == 1
    assert text.count("FileScan") <= 8


def test_a_stored_report_grows_by_unseen_rows(spark, tmp_path):
    """Rows are added once, a run after a failure adds the rest, rows without a day have a
    partition; a report without the calendar columns is replaced."""
    from fleetbook.plans.dashboard import StoredReport

    kinds = "ECO string, Fecha timestamp, Concepto string, Importe double, Sistema string, Litros double, Semana_Mes int"
    rows = spark.sql("""SELECT 'AU-' || id AS ECO, timestamp'1998-01-30' + make_interval(0, 0, 0, CAST(id AS INT)) AS Fecha,
        'PEAJES' AS Concepto, CAST(id AS DOUBLE) AS Importe, 'Pase' AS Sistema, CAST(NULL AS DOUBLE) AS Litros, 1 AS Semana_Mes
        FROM range(5)""")
    idle = spark.createDataFrame([("AU-9", None, "SIN ACTIVIDAD", 0.0, "N/A", None, 0)], kinds)
    report = StoredReport(spark, str(tmp_path / "r"))
    assert not report.exists()
    assert report.append(rows.filter("Importe < 2").unionByName(idle)) == 3
    assert report.append(rows.unionByName(idle)) == 3
    assert report.append(rows.unionByName(idle)) == 0
    assert report.append(idle.limit(0)) == 0
    assert sorted(r.ECO for r in report.read().collect()) == ["AU-0", "AU-1", "AU-2", "AU-3", "AU-4", "AU-9"]
    rows.drop("Semana_Mes").write.parquet(str(tmp_path / "old"))
    old = StoredReport(spark, str(tmp_path / "old"))
    assert old.append(idle) == 1 and [r.ECO for r in old.read().collect()] == ["AU-9"]


def test_rows_of_the_report_are_written_once(spark, tmp_path, monkeypatch):
    """Of a run only expenses, maps of units and months go to scratch tables: rows that the catalogue
    multiplies are written into the report and nowhere else."""
    from fleetbook.plans import dashboard

    kept = []

    def stored(df, label):
        out = kept_stored(df, label)
        kept.append((label, out.count()))
        return out

    kept_stored = dashboard.stored
    monkeypatch.setattr(dashboard, "stored", stored)
    columns = "`No. economico` string, `Fecha de cruce` string, `Importe al 100` string"
    place, report = str(tmp_path / "toll"), str(tmp_path / "report")
    master = spark.sql("SELECT 'AU-001' AS ECO, 'E' || id AS Empresa, 'P' || id AS Placas, 'S' || id AS `Supramax ID`, id AS pos FROM range(50)")
    for days, added in ((2, 100), (3, 50)):
        rows = spark.createDataFrame([("AU 1", f"1997/01/0{d}", "5.5") for d in range(1, days + 1)], columns)
        rows.write.mode("overwrite").parquet(place)
        table, n = dashboard.run(spark, {"Pase": place}, None, master, "pos", dt.date(1998, 6, 15), report)
        assert n == added and max(size for _, size in kept) <= days
    assert table.read().count() == 150 and table.read().distinct().count() == 150

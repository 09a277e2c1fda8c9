"""The dashboard table: ledger joined with the master catalogue, and the stored report that
grows by the rows it does not hold yet."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from ..functions.amounts import zero_to_null
from ..functions.dates import in_kpi, is_ytd, month_label, week_of_month
from ..functions.eco import eco_key, normalize_eco_lzc
from ..functions.keys import signature_expense
from ..operators.filters import required, valid_eco
from ..operators.joins import alias_map, alias_table, by_alias_map, full_outer_with_catalog, packed, unpacked
from ..operators.merge import insert_new, new_by_signature
from ..operators.sets import union_sources
from ..session import setting, stored
from ..sources.vendors import clean_maintenance, read_consolidated
from ..vocabulary import NO_ACTIVITY, NO_INFO, NOT_AVAILABLE

DIMENSIONS = ["Dirección", "Empresa", "Sucursal"]
_KEY = ["ECO", "Fecha", "Concepto", "Tipo", "Importe", "Sistema", "Cantidad"]


def standardize(source, aliases):
    """(rows, units): a vendor's consolidated rows with resolved units, incomplete and unknown
    units dropped, repeated rows removed; and the units they have."""
    rows = required(source.select(*_KEY))
    names = alias_map(rows, "ECO", aliases)
    units = valid_eco(names.select(F.col("eco").alias("ECO")), lzc=True).distinct()
    return valid_eco(by_alias_map(rows, "ECO", names), lzc=True).dropDuplicates(_KEY), units


def default_dimensions(df):
    present = [c for c in DIMENSIONS if c in df.columns]
    return df.na.fill(NO_INFO, present).na.fill(
        {"Importe": 0.0, "Concepto": NO_ACTIVITY, "Sistema": NOT_AVAILABLE})


class MasterJoin:
    """Full outer join on letters and digits of the unit; the catalogue's spelling of the
    unit is shown. Missing keys share one text, so they pair up. Of columns that both sides
    have, the catalogue's ends in ``_maestra`` and the ledger's in ``_consumo``. ``units`` holds the units that the
    expenses have, where they are known.

    A unit that the catalogue names several times has its rows as often. So the join has two
    steps: ``rows`` holds every expense once per spelling of its unit, with the number of rows it
    will become (``_n``); ``finish`` multiplies them. What can be done before (calendar, search in the
    stored report, moving rows between tasks) is done on few rows."""

    def __init__(self, expenses, master, units=None):
        def key(df):
            return F.coalesce(eco_key(F.col("ECO")), F.lit("NAN"))

        shared = {c for c in master.columns if c in expenses.columns and c != "ECO"}
        master = master.withColumnsRenamed({c: f"{c}_maestra" for c in shared})
        expenses = expenses.withColumnsRenamed({c: f"{c}_consumo" for c in shared})
        self.described = [c for c in master.columns if c != "ECO"]
        catalog = master.withColumn("ECO", normalize_eco_lzc(F.col("ECO")))
        catalog = catalog.withColumns({"ECO_key": key(catalog)}).withColumnRenamed("ECO", "_eco_master")
        # A key has no bar, and a missing unit differs from an empty one.
        named = ["ECO_key", "_eco_master", "_unit"]
        catalog = catalog.withColumn("_unit", F.concat_ws("|", "ECO_key", "_eco_master"))
        self.packs = stored(packed(catalog, named), "catalog")
        units_named = self.packs.groupBy(*named).agg(F.sum(F.size("_rows")).alias("_n"))
        facts = expenses.withColumns({"ECO_key": key(expenses)}).withColumnRenamed("ECO", "_eco_use")
        used = None if units is None else units.select(key(units).alias("ECO_key"))
        joined = full_outer_with_catalog(facts, units_named, "ECO_key", used)
        rest = [c for c in expenses.columns if c != "ECO"]
        self.rows = joined.select(
            F.coalesce("_eco_master", "_eco_use").alias("ECO"), *[f"`{c}`" for c in rest], "_unit",
            F.coalesce("_n", F.lit(1)).alias("_n"))

    def finish(self, rows):
        """``rows``, with whatever columns were added, multiplied: the unit, the catalogue's columns, the others."""
        rest = [c for c in rows.columns if c not in ("ECO", "_unit", "_n")]
        return unpacked(rows, self.packs, "_unit").select("ECO", *[f"`{c}`" for c in self.described + rest])


def join_master(expenses, master, units=None):
    """``MasterJoin`` as one frame."""
    join = MasterJoin(expenses, master, units)
    return join.finish(join.rows)


def calendar_columns(df, as_of):
    """Year, month, week and the flags that depend on the report day."""
    year, month = F.year("Fecha"), F.month("Fecha")
    return df.withColumns({
        "Anio": year,
        "Mes": month,
        "Semana_Mes": week_of_month(F.col("Fecha")),
        "es_ytd": is_ytd(year, month, as_of),
        "incluir_en_kpi": in_kpi(month, as_of),
        "Nombre_Mes": month_label(month),
    })


def expenses(sources, master, position, maintenance=None):
    """(rows, units): the vendors' consolidated rows, standardised, and the maintenance rows,
    which are complete and hold units already (``vendors.clean_maintenance``). ``position``
    orders the catalogue's rows."""
    aliases = alias_table(master, position)
    parts = [standardize(s, aliases) for s in sources]
    if maintenance is not None:
        parts.append((maintenance.select(*_KEY), maintenance.select("ECO").distinct()))
    rows, units = zip(*parts)
    return union_sources(*rows), union_sources(*units)


class ReportRows(MasterJoin):
    """Dashboard rows from expenses and the units they have. A unit that the catalogue names
    several times has its rows as often. The calendar is added last before they are multiplied."""

    def __init__(self, rows, units, master, position, as_of):
        super().__init__(rows, master.drop(position), units)
        table = default_dimensions(self.rows).withColumn("Cantidad", zero_to_null(F.col("Cantidad")))
        self.rows, self.as_of = table.withColumnRenamed("Cantidad", "Litros"), as_of

    def finish(self, rows):
        return default_dimensions(super().finish(calendar_columns(rows, self.as_of)))


def report_rows(rows, units, master, position, as_of):
    """``ReportRows`` as one frame."""
    report = ReportRows(rows, units, master, position, as_of)
    return report.finish(report.rows)


def dashboard(sources, master, position, as_of, maintenance=None):
    """Dashboard rows from the vendors' consolidated rows and the maintenance rows."""
    return report_rows(*expenses(sources, master, position, maintenance), master, position, as_of)


_SIGNED = ["ECO", "Fecha", "Concepto", "Importe", "Sistema", "Litros"]


def expense_signature(df):
    return signature_expense(*[F.col(c) for c in _SIGNED])


def append_unseen(existing, table):
    """The stored report with the rows it does not hold yet."""
    return insert_new(existing, new_by_signature(table, existing, expense_signature))


PERIOD = "periodo"
_NO_DAY = "sin fecha"
# A task has its rows sorted by month before they are multiplied. With more writers allowed than it
# has months it opens the next one instead of sorting the many rows again.
_WRITERS, _MONTHS = "spark.sql.maxConcurrentOutputFileWriters", 200
_ROW_GROUP = 32 << 20


class StoredReport:
    """A report in a Parquet folder, partitioned by month; rows without a day have a
    partition of their own. A report that was written before the calendar columns were
    added is replaced by the next table, others only grow."""

    def __init__(self, spark, path):
        self.spark, self.path = spark, path.rstrip("/")

    def exists(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def read(self):
        return self.spark.read.option("mergeSchema", True).parquet(self.path).drop(PERIOD)

    def append(self, table, finish=None):
        """Add the rows of ``table`` whose signature is not stored; how many. Only the stored
        months that the table has rows of are read. A run that failed is run again: what it
        had added is not added twice. The table is planned twice, so what takes long in it
        should be stored.

        ``finish`` multiplies rows (``MasterJoin``), whose number stands in ``_n``. It comes last: what it
        makes is neither compared nor shuffled nor sorted, only written, each month's units together."""
        month = F.coalesce(F.date_format("Fecha", "yyyy-MM"), F.lit(_NO_DAY))
        table = table.withColumn(PERIOD, month)
        new, mode = table, "overwrite"
        if self.exists():
            held = self.spark.read.option("mergeSchema", True).parquet(self.path)
            if "Semana_Mes" in held.columns and PERIOD in held.columns:
                months = stored(table.select(PERIOD).distinct(), "months")
                held = held.join(months, PERIOD, "left_semi").select(*_SIGNED).distinct()
                new, mode = new_by_signature(table, held, expense_signature), "append"
        watch = Observation()
        count = F.count("*") if finish is None else F.coalesce(F.sum("_n"), F.lit(0))
        new = new.hint("rebalance", PERIOD).observe(watch, count.alias("added")).sortWithinPartitions(PERIOD, "ECO")
        with setting(self.spark, _WRITERS, _MONTHS):
            (finish or (lambda rows: rows))(new).write.partitionBy(PERIOD).mode(mode).option(
                "parquet.block.size", _ROW_GROUP).parquet(self.path)
        return watch.get.get("added", 0)


def run(spark, exports, sheet, master, position, as_of, report):
    """The whole job: consolidated exports by system (``{"Pase": path, ...}``), the raw
    maintenance sheet or None, and the catalogue become dashboard rows; those that the stored
    report at ``report`` does not hold are added. Returns (report, rows added)."""
    sources = [read_consolidated(spark, path, system) for system, path in exports.items()]
    # Written first: what made the sheet's texts would else be repeated wherever they are parsed.
    maintenance = None if sheet is None else clean_maintenance(stored(sheet, "sheet"), "Excel Mantenimientos")
    rows = stored(expenses(sources, master, position, maintenance)[0], "expenses")
    kept = StoredReport(spark, report)
    table = ReportRows(rows, rows.select("ECO"), master, position, as_of)
    return kept, kept.append(table.rows, table.finish)

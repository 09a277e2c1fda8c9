"""The stored ledger: a Parquet table partitioned by system and month, the unit in
which periods are replaced."""

from pyspark.sql import functions as F

from ..functions.dates import year_month
from ..session import scratch_dir
from ..vocabulary import LEDGER_COLS, LEDGER_SCHEMA, SYSTEMS
from .dedup import dedup_ledger
from .merge import new_by_id, new_by_natural_key

PARTITIONS = ["Sistema", "anio_mes"]
_STORED = [c for c in LEDGER_COLS if c != "Sistema"] + PARTITIONS


def month_text(year, month):
    return f"{int(year):04d}-{int(month):02d}"


class LedgerTable:
    """A ledger by table name; with ``location`` its files live in that folder."""

    def __init__(self, spark, name, location=None):
        self.spark, self.name, self.location = spark, name, location

    def create(self):
        """Create the table where it does not exist yet."""
        kinds = {f.name: f.dataType.simpleString() for f in LEDGER_SCHEMA}
        columns = ", ".join(f"`{c}` {kinds.get(c, 'string')}" for c in _STORED)
        place = f" LOCATION '{self.location}'" if self.location else ""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}) USING parquet "
            f"PARTITIONED BY ({', '.join(PARTITIONS)}){place}")
        return self

    def add_columns(self, *names):
        """Add the nullable text columns that are missing."""
        missing = [n for n in names if n not in self._columns()]
        if missing:
            columns = ", ".join(f"`{n}` string" for n in missing)
            self.spark.sql(f"ALTER TABLE {self.name} ADD COLUMNS ({columns})")
        return self

    def _table(self):
        """The table as stored now. Other sessions write to it too, a stream's batches run
        in one of their own, and a session keeps the file list of its last read."""
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def _columns(self):
        return self.spark.table(self.name).columns

    def read(self):
        return self._table().select(*LEDGER_COLS)

    def touched_by(self, batch):
        """Stored rows of the (system, month) partitions a batch falls into; the join on
        the partition columns lets Spark prune the others at run time."""
        months = self._with_month(batch).select(*PARTITIONS).distinct()
        return self._table().join(months, PARTITIONS, "left_semi").select(*LEDGER_COLS)

    def append(self, rows):
        self._write(rows, "append")

    def merge(self, batch, by_id=False):
        """Insert the rows of a cleaned batch that are not stored yet. Rows with an id are
        looked for in all months of their systems, the others in the months they fall into;
        the joins on partition columns leave the rest of the table unread."""
        if not by_id:
            return self.append(new_by_natural_key(batch, self.touched_by(batch)))
        named, others = batch.filter("Id_Origen IS NOT NULL"), batch.filter("Id_Origen IS NULL")
        systems = named.select("Sistema").distinct()
        stored = self._table().join(systems, "Sistema", "left_semi").select(*LEDGER_COLS)
        fresh = new_by_id(named, stored).unionByName(new_by_natural_key(others, self.touched_by(others)))
        self.append(fresh)

    def delete_month(self, system, year, month):
        """Empty one partition; nothing else is read or rewritten."""
        if system not in SYSTEMS:
            raise ValueError(f"unknown system: {system}")
        self._empty(system, month_text(year, month))

    def replace_months(self, rows, system, months, partial=False, by_id=False):
        """Load whole months anew; repeating it changes nothing. Rows dated outside them
        are merged. A ``partial`` run holds only some accounts, so it only merges: emptying
        the months would lose the other accounts' rows."""
        if system not in SYSTEMS:
            raise ValueError(f"unknown system: {system}")
        rows = rows.filter(F.col("Sistema") == system)
        if partial:
            return self.merge(rows, by_id)
        # Used three times below, so it is written once to shared storage.
        path = scratch_dir(self.spark, "period")
        rows.write.parquet(path)
        rows = self.spark.read.schema(rows.schema).parquet(path)
        texts = [month_text(*m) for m in months]
        inside = year_month("Fecha").isin(texts)
        self._write(rows.filter(inside), "overwrite")
        # At most one value per requested month comes back.
        loaded = {r[0] for r in rows.filter(inside).select(year_month("Fecha")).distinct().collect()}
        for text in set(texts) - loaded:
            self._empty(system, text)
        self.merge(rows.filter(~inside), by_id)

    def backup_and_dedup(self, tag, location=None):
        """Copy the table, then rewrite it from the copy without duplicate rows."""
        copy = f"{self.name}_backup_{tag}"
        writer = self._table().write.partitionBy(*PARTITIONS).format("parquet")
        if location:
            writer = writer.option("path", location)
        writer.saveAsTable(copy)
        rows = dedup_ledger(self.spark.table(copy).drop("anio_mes"))
        self._write(rows, "overwrite")
        return copy

    def _with_month(self, rows):
        return rows.withColumn("anio_mes", year_month("Fecha"))

    def _write(self, rows, mode):
        """Rebalancing by partition makes few files for small months and several for a
        month with very many rows, where hashing would leave that month to one task."""
        out = self._with_month(rows).select(*_STORED, *self._later_columns(rows))
        out = out.hint("rebalance", *PARTITIONS).sortWithinPartitions(*PARTITIONS, "ECO")
        setting = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(setting)
        # insertInto takes the mode from the session only: replace the partitions that
        # receive rows and leave the others.
        self.spark.conf.set(setting, "dynamic")
        try:
            out.select(*self._table_order()).write.mode(mode).insertInto(self.name)
        finally:
            self.spark.conf.set(setting, before)

    def _later_columns(self, rows):
        known = set(_STORED)
        return [
            (F.col(c) if c in rows.columns else F.lit(None).cast("string")).alias(c)
            for c in self._columns() if c not in known]

    def _table_order(self):
        return [F.col(c) for c in self._columns()]

    def _empty(self, system, text):
        kinds = self.spark.table(self.name).dtypes
        nothing = ", ".join(f"CAST(NULL AS {t}) AS `{c}`" for c, t in kinds if c not in PARTITIONS)
        self.spark.sql(
            f"INSERT OVERWRITE TABLE {self.name} PARTITION (Sistema = '{system}', anio_mes = '{text}') "
            f"SELECT {nothing} WHERE false")

"""Cleaning of a vendor batch and its merge into the ledger."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from ..functions.amounts import to_number
from ..functions.dates import in_month, in_year, parse_dayfirst
from ..functions.eco import is_unit
from ..operators import filters
from ..operators.dedup import dedup_batch
from ..operators.merge import insert_new, new_in_batch
from ..operators.versions import VersionedLedger
from ..session import stored
from ..vocabulary import LEDGER_SCHEMA


def to_ledger_columns(df):
    """The ten ledger columns in order; optional ones a vendor lacks become null."""
    present = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in present else F.lit(None)).cast("string").alias(f.name)
        if f.dataType.simpleString() == "string"
        else (F.col(f.name) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in LEDGER_SCHEMA
    ])


def coerce_types(df):
    """Text dates and amounts to their types, bad values to null; typed ones are kept."""
    kinds = dict(df.dtypes)
    fecha = F.col("Fecha")
    casts = {"Fecha": (parse_dayfirst(fecha) if kinds["Fecha"] == "string" else fecha).cast("date")}
    for c in ("Cantidad", "Importe"):
        if kinds[c] == "string":
            casts[c] = to_number(F.col(c))
        else:
            number = F.col(c).cast("double")
            casts[c] = F.when(~F.isnan(number), number)
    return df.withColumns(casts)


def clean_batch(df, year=None, month=None, late_rows=False, by_id=False, dedup=True, watch=None):
    """Project, coerce, drop incomplete rows, filter the period, normalise and check the
    unit, and remove duplicates. An ``Observation`` as ``watch`` gets the counts of
    ``stage_counts`` and ``unread_dates`` from the pass that reads the result."""
    rows = to_ledger_columns(df)
    if watch is None:
        rows = coerce_types(rows)
    else:
        rows = coerce_types(rows.withColumn("_fecha", F.col("Fecha").cast("string")))
        rows = rows.observe(watch, *_counts(year, month, late_rows), _unread()).drop("_fecha")
    rows = filters.required(filters.normalized_units(rows))
    rows = filters.in_period(rows, year, month, late_rows)
    return dedup_batch(rows, by_id) if dedup else rows


def _counts(year, month, late_rows):
    """How many coerced rows survive each cleaning stage."""
    complete = F.col("Importe").isNotNull() & F.col("Fecha").isNotNull() & F.col("ECO").isNotNull()
    period = F.lit(True)
    if year is not None:
        by_month = month is not None and not late_rows
        period = in_month(F.col("Fecha"), year, month) if by_month else in_year(F.col("Fecha"), year)
    valid = is_unit(F.col("ECO"))
    return [
        F.count("*").alias("leidas"),
        F.count_if(complete).alias("completas"),
        F.count_if(complete & period).alias("en_periodo"),
        F.count_if(complete & period & valid).alias("eco_valido"),
    ]


def _unread():
    unread = F.col("Fecha").isNull() & F.coalesce(F.trim("_fecha") != "", F.lit(False))
    return F.count_if(unread).alias("fecha_no_leida")


def stage_counts(df, year=None, month=None, late_rows=False):
    """How many rows survive each cleaning stage, in one pass over the batch."""
    return coerce_types(to_ledger_columns(df)).agg(*_counts(year, month, late_rows))


def unread_dates(df):
    """How many rows hold a date text that no reading understands; ``required`` drops them."""
    given = to_ledger_columns(df).withColumn("_fecha", F.col("Fecha").cast("string"))
    return coerce_types(given).agg(_unread())


def load(df, table, by_id=False, batch_of=None, **cleaning):
    """Clean a batch and merge it into a stored ledger. The batch is read once: its cleaned rows
    are written, counted on the way, and merged from there. Returns the counts of
    ``stage_counts`` and ``unread_dates`` with ``unicas``, the rows that went into the merge."""
    watch = Observation()
    rows = stored(clean_batch(df, by_id=by_id, watch=watch, **cleaning), "batch")
    if isinstance(table, VersionedLedger):
        table.merge(rows, by_id, batch_of)
    else:
        table.merge(rows, by_id)
    return {**watch.get, "unicas": rows.count()}


def new_rows(batch, ledger, by_id=False):
    return new_in_batch(batch, ledger, by_id)


def ingest(batch, ledger, by_id=False, **cleaning):
    """The ledger after a batch: cleaned rows that are not there yet are added."""
    clean = clean_batch(batch, by_id=by_id, **cleaning)
    return insert_new(ledger, new_rows(clean, ledger, by_id))

"""Duplicate removal."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.amounts import CENTS
from ..vocabulary import LEDGER_COLS


def keep_first(df, keys, order):
    """First row per key in the given order. ``order`` should end in columns that make
    rows distinct. The ``row_number() = 1`` filter becomes a group limit below the
    shuffle, so a hot key sends one row per task and not all of its rows."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def dedup_batch(df, by_id=False):
    """One row per ``Id_Origen``, or per whole ledger row. By id, rows without one are
    told apart by the whole row."""
    if by_id:
        named = keep_first(df.filter("Id_Origen IS NOT NULL"), ["Id_Origen"], [F.col(c) for c in LEDGER_COLS])
        return named.unionByName(df.filter("Id_Origen IS NULL").dropDuplicates(LEDGER_COLS))
    return df.dropDuplicates(LEDGER_COLS)


def dedup_ledger(df):
    """Collapse rows that agree on the eight business columns, whatever file they came
    from. On demand only: it also merges real same-day, same-amount toll crossings."""
    keys = [
        "ECO", "Fecha", "Concepto", "Tipo",
        F.col("Cantidad").cast(CENTS), F.col("Importe").cast(CENTS), "Sistema", "Empresa",
    ]
    rest = [c for c in df.columns if c not in ("Archivo_Origen", "Id_Origen")]
    order = [F.col("Archivo_Origen"), F.col("Id_Origen"), *[F.col(c) for c in rest]]
    return keep_first(df, keys, order)

"""Manual control sheet against the ledger."""

from pyspark.sql import functions as F

from ..functions.amounts import cents, sum_cents
from ..functions.dates import month_title, year_month
from ..functions.eco import eco_light
from ..operators.aggregates import monthly_by_system, pivot_systems
from ..vocabulary import (
    RECON_SYSTEMS, STATUS_DIFFERENT, STATUS_EXACT, STATUS_NONE, STATUS_ONLY_AUTOMATED,
    STATUS_ONLY_MANUAL,
)

MANUAL_COLUMNS = [manual for _, manual, _ in RECON_SYSTEMS]


def manual_sums(sheet):
    """Amounts per unit and month of the manual sheet; rows without a month are dropped."""
    month = year_month("MES")
    return (
        sheet.filter(F.col("MES").isNotNull())
        .groupBy(eco_light(F.col("UNIDAD")).alias("ECO_Limpio"), month.alias("MES_str"))
        .agg(*[F.coalesce(sum_cents(F.col(f"`{c}`")), F.lit(0.0)).alias(c) for c in MANUAL_COLUMNS])
    )


def cross(manual, automated):
    """Full outer join of two frames with one row per unit and month; missing is 0. The
    columns become ``m_pase``, ``a_pase`` and so on, since both sides name a system alike."""
    def side(df, prefix, names):
        return df.select("ECO_Limpio", "MES_str", *[
            F.col(f"`{name}`").alias(f"{prefix}_{label.lower()}") for label, name in names])

    left = side(manual, "m", [(label, column) for label, column, _ in RECON_SYSTEMS])
    right = side(automated, "a", [(label, system) for label, _, system in RECON_SYSTEMS])
    return left.join(right, ["ECO_Limpio", "MES_str"], "full").na.fill(0.0)


def by_system(crossed):
    """One row per unit, month and system with both amounts, where either is positive."""
    rows = F.array(*[
        F.struct(
            F.lit(label).alias("Concepto"), cents(F.col(f"m_{label.lower()}")).alias("manual"),
            cents(F.col(f"a_{label.lower()}")).alias("auto"))
        for label, _, _ in RECON_SYSTEMS
    ])
    return (
        crossed.select("ECO_Limpio", "MES_str", F.inline(rows))
        .filter((F.col("manual") > 0) | (F.col("auto") > 0))
    )


def detail(crossed):
    """Difference and status per unit, month and system."""
    manual, auto = F.col("manual"), F.col("auto")
    status = (
        F.when((manual == 0) & (auto > 0), STATUS_ONLY_AUTOMATED)
        .when((manual > 0) & (auto == 0), STATUS_ONLY_MANUAL)
        .when((manual > 0) & (auto > 0) & (manual != auto), STATUS_DIFFERENT)
        .when((manual > 0) & (auto > 0), STATUS_EXACT)
        .otherwise(STATUS_NONE)
    )
    return by_system(crossed).select(
        "Concepto", "MES_str", month_title(F.col("MES_str")).alias("Mes"),
        F.col("ECO_Limpio").alias("Unidad"),
        manual.cast("double").alias("Manual"), auto.cast("double").alias("Automatico"),
        (auto - manual).cast("double").alias("Diferencia"), status.alias("Estado"))


def summary(crossed):
    """Totals and presence counts per month and system; empty pairs are left out."""
    manual, auto = F.col("manual"), F.col("auto")
    only_auto = (manual == 0) & (auto > 0)
    only_manual = (manual > 0) & (auto == 0)

    def total(value, when=None):
        return F.coalesce(F.sum(value if when is None else F.when(when, value)), F.lit(0))

    sums = by_system(crossed).groupBy("MES_str", "Concepto").agg(
        total(manual).alias("m"), total(auto).alias("a"),
        F.count_if(only_auto).alias("Unidades_Solo_Auto"),
        total(auto, only_auto).cast("double").alias("Importe_Solo_Auto"),
        F.count_if(only_manual).alias("Unidades_Solo_Manual"),
        total(manual, only_manual).cast("double").alias("Importe_Solo_Manual"),
        F.count_if((manual > 0) & (auto > 0)).alias("Unidades_Ambos"))
    change = F.when(F.col("m") != 0, (F.col("a") - F.col("m")).cast("double") / F.col("m").cast("double"))
    return sums.filter((F.col("m") != 0) | (F.col("a") != 0)).select(
        "MES_str", "Concepto",
        F.col("m").cast("double").alias("Total_Manual"), F.col("a").cast("double").alias("Total_Auto"),
        (F.col("a") - F.col("m")).cast("double").alias("Diferencia"),
        F.round(F.coalesce(change, F.lit(0.0)), 6).alias("Variacion"),
        "Unidades_Solo_Auto", "Importe_Solo_Auto", "Unidades_Solo_Manual", "Importe_Solo_Manual",
        "Unidades_Ambos")


def reconcile(ledger, sheet, start):
    """(detail, summary) of the reconciliation since a date."""
    crossed = cross(manual_sums(sheet), pivot_systems(monthly_by_system(ledger, start)))
    return detail(crossed), summary(crossed)

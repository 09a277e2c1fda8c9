"""Aggregations over the ledger and over raw files."""

from pyspark.sql import functions as F

from ..functions.amounts import cents, sum_cents
from ..functions.dates import between, in_month, month_start, month_title, year_month
from ..vocabulary import SYSTEM_ALIASES, SYSTEMS


def system_name(c):
    """One name per system where two are in use."""
    pairs = [F.lit(v) for kv in SYSTEM_ALIASES.items() for v in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), c)


def sorted_list(c, sep=", "):
    """Distinct values as sorted text. Use on pre-aggregated rows: the set is one cell."""
    return F.array_join(F.sort_array(F.collect_set(c)), sep)


def in_years(c, year_a, year_b):
    first, second = sorted((year_a, year_b))
    if second - first == 1:
        return between(c, month_start(first, 1), month_start(second + 1, 1))
    return between(c, month_start(first, 1), month_start(first + 1, 1)) | between(
        c, month_start(second, 1), month_start(second + 1, 1))


def units_by_month(ledger, year_a, year_b):
    """Distinct units per calendar month in each of two years. Rows are reduced to
    distinct (year, month, unit) before counting; a plain conditional count distinct
    would double every row first."""
    units = (
        ledger.filter(in_years(F.col("Fecha"), year_a, year_b))
        .select(F.year("Fecha").alias("y"), F.month("Fecha").alias("Mes"), "ECO")
        .distinct()
    )
    def count(year):
        return F.count(F.when(F.col("y") == year, F.col("ECO"))).alias(f"Unidades_{year}")
    return units.groupBy("Mes").agg(count(year_a), count(year_b))


def units_twelve_months(by_month, year_a, year_b):
    """All twelve months with 0 where nothing happened, the difference, and a last row
    (month 13) with the averages."""
    a, b = f"Unidades_{year_a}", f"Unidades_{year_b}"
    spine = by_month.sparkSession.range(1, 13).select(F.col("id").cast("int").alias("Mes"))
    months = spine.join(by_month, "Mes", "left").select(
        "Mes", *[F.coalesce(F.col(c), F.lit(0)).cast("double").alias(c) for c in (a, b)])
    average = months.agg(
        F.lit(13).alias("Mes"), *[F.round(F.avg(c), 6).alias(c) for c in (a, b)])
    return months.unionByName(average).withColumn("Diferencia", F.round(F.col(b) - F.col(a), 6))


def month_detail(ledger, month, year_a, year_b):
    """Rows and amount per unit, system and year for one calendar month."""
    days = in_month(F.col("Fecha"), year_a, month) | in_month(F.col("Fecha"), year_b, month)
    return (
        ledger.filter(days)
        .groupBy("ECO", "Sistema", F.year("Fecha").alias("Anio"))
        .agg(F.count("*").alias("Regs"), sum_cents(F.col("Importe")).alias("Importe"))
    )


def with_total(df, label_col, sums, label="Total"):
    """The report with one more row holding the column sums."""
    total = df.agg(*[
        F.sum(cents(F.col(c)) if t == "double" else F.col(c)).cast(t).alias(c)
        for c, t in df.dtypes if c in sums
    ]).withColumn(label_col, F.lit(label))
    return df.unionByName(total, allowMissingColumns=True)


def monthly_by_system(ledger, start):
    """Amount per unit, month and system since a date."""
    return (
        ledger.filter(F.col("Fecha") >= F.lit(start))
        .groupBy(F.col("ECO").alias("ECO_Limpio"), year_month("Fecha").alias("MES_str"), "Sistema")
        .agg(sum_cents(F.col("Importe")).alias("Total"))
    )


def pivot_systems(monthly, systems=SYSTEMS):
    """One column per system, always all of them, 0 where a unit has none."""
    named = monthly.withColumn("Sistema", system_name(F.col("Sistema")))
    sums = [
        F.coalesce(sum_cents(F.when(F.col("Sistema") == s, F.col("Total"))), F.lit(0.0)).alias(s)
        for s in systems
    ]
    return named.groupBy("ECO_Limpio", "MES_str").agg(*sums)


def card_list(df, card, unit="ECO"):
    """Distinct cards per unit, sorted and joined with `` | ``."""
    cards = df.filter(F.col(card).isNotNull()).select(unit, card).distinct()
    return cards.groupBy(unit).agg(sorted_list(F.col(card), " | ").alias(card))


def dominant_month(df, moment, file="Archivo_Origen", by="timestamp"):
    """(year, month) each file belongs to: that of its most frequent timestamp, of equally
    frequent ones the earliest. ``by="month"`` takes the most frequent month. Timestamps
    are counted first, so no file's values are held in one buffer."""
    value = F.trunc(moment, "month") if by == "month" else F.col(moment)
    counts = df.filter(F.col(moment).isNotNull()).groupBy(file, value.alias("v")).agg(
        F.count("*").alias("n"))
    winner = counts.groupBy(file).agg(F.min(F.struct((-F.col("n")).alias("less"), "v"))["v"].alias("v"))
    return winner.select(file, F.year("v").alias("Anio"), F.month("v").alias("Mes"))


def file_subtotals(df, file="Archivo_Origen"):
    """Amount per file and, with a null file name, for all files."""
    return (
        df.rollup(file)
        .agg(F.grouping(file).cast("int").alias("es_total"),
             F.sum(cents(F.col("Importe"))).cast("double").alias("Importe"))
    )


def last_tags(df, eco, tag, position):
    """Tag per unit: the last row wins."""
    return df.groupBy(F.col(eco).alias("key")).agg(F.max_by(tag, position).alias("value"))


def title_of_month(df, col="MES_str"):
    return df.withColumn("Mes", month_title(F.col(col)))

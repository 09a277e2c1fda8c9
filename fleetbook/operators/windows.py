"""First and last rows inside groups."""

from pyspark.sql import functions as F

from ..functions.dates import hour_fraction
from ..functions.keys import base_name, strip_hash_prefix
from ..sources.paths import company_prefix, path_period
from .dedup import keep_first

_NEW_LAYOUT = r"^Pase/[^/]+/\d{4}/\d{2}/"


def last_per_unit(df, card, date, unit="ECO"):
    """Last non-null card per unit by date; undated rows come last, so they win. Rows are
    first reduced to one per (unit, card), so only distinct cards are shuffled."""
    dated = (
        df.filter(F.col(card).isNotNull())
        .groupBy(unit, card)
        .agg(F.max(F.col(date).isNull().cast("int")).alias("_undated"), F.max(date).alias("_date"))
    )
    return dated.groupBy(unit).agg(
        F.max_by(card, F.struct("_undated", "_date", card)).alias(card))


FLAGS = ("Es_Domingo_Aux", "Es_Sabado_Tarde_Aux", "Es_Semana_Noche_Aux")


def off_hours_flags(df, start, position, unit="ECO"):
    """Three 0/1 columns: Sunday, Saturday from 16:00, weekday from 20:00. Only the first
    row of a unit's day inside its class gets the 1. ``position`` names columns that
    order the rows and make them unique.

    The first rows come from a pre-aggregated minimum and are joined back on day, class
    and position. A window per unit and day would hold all rows of a busy unit in one task.
    Rows outside the three classes take no part in the shuffle.
    """
    weekday, hour = F.weekday(start), hour_fraction(F.col(start))
    kind = (
        F.when(weekday == 6, F.lit("D"))
        .when((weekday == 5) & (hour >= 16), F.lit("S"))
        .when((weekday < 5) & (hour >= 20), F.lit("N"))
    )
    tagged = df.withColumns({"_day": F.to_date(start), "_kind": kind})
    off = tagged.filter("_kind is not null")
    first = (
        off.groupBy(unit, "_day", "_kind").agg(F.min(F.struct(*position)).alias("_p"))
        .select(unit, "_day", "_kind", "_p.*", F.lit(1).alias("_first"))
    )
    flagged = off.join(first, [unit, "_day", "_kind", *position], "left").unionByName(
        tagged.filter("_kind is null"), allowMissingColumns=True)

    def flag(code):
        return F.when((F.col("_kind") == code) & F.col("_first").isNotNull(), 1).otherwise(0)

    flags = dict(zip(FLAGS, (flag("D"), flag("S"), flag("N"))))
    return flagged.withColumns(flags).select(*[c for c in df.columns if c not in flags], *flags)


def prefer_layout(files, col="path"):
    """One file per archived export. Generic names are told apart by company and month,
    other names are unique by themselves; a copy in the newer folder layout wins."""
    path = F.col(col)
    name = strip_hash_prefix(base_name(path))
    year, month = path_period(path)
    generic = F.lower(name).contains("cruces.csv")
    keys = {
        "_name": name,
        "_company": F.when(generic, company_prefix(path)),
        "_year": F.when(generic, year),
        "_month": F.when(generic, month),
    }
    new_first = path.rlike(_NEW_LAYOUT).cast("int").desc()
    return keep_first(files.withColumns(keys), list(keys), [new_first, path]).drop(*keys)

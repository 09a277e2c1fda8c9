"""Row filters of the ingest and the reports."""

from functools import reduce

from pyspark.sql import functions as F

from ..functions.dates import in_month, in_year
from ..functions.eco import is_unit, is_valid_eco, normalize_eco


def required(df, cols=("Importe", "Fecha", "ECO")):
    """Drop rows where a needed value is missing (total lines at the end of exports)."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))


def normalized_units(df, col="ECO"):
    """Rows with a valid unit, normalised. Testing the raw text first spares the others
    (and the filter below the projection) the normalisation."""
    return df.filter(is_unit(F.col(col))).withColumn(col, normalize_eco(F.col(col)))


def valid_eco(df, col="ECO", lzc=False):
    return df.filter(is_valid_eco(F.col(col), lzc))


def in_period(df, year=None, month=None, late_rows=False, col="Fecha"):
    """Rows of one month, else of one year. With ``late_rows`` (tolls are billed months
    after the crossing) the month is ignored and only the year counts."""
    if month is not None and year is not None and not late_rows:
        return df.filter(in_month(F.col(col), year, month))
    return df if year is None else df.filter(in_year(F.col(col), year))


def same_year_as_path(df, path_year="path_year", year=None, col="Fecha"):
    """Rows dated in the year of the folder they came from; files without a year in
    their path are kept whole. Optionally also one requested year."""
    folder = F.col(path_year)
    kept = df.filter(folder.isNull() | (F.year(col) == folder))
    return kept if year is None else kept.filter(in_year(F.col(col), year))


def accounts(df, col, include=None, exclude=()):
    """Accounts containing a text, without those listed by name; case is ignored."""
    name = F.upper(col)
    if include:
        df = df.filter(name.contains(include.upper()))
    if exclude:
        df = df.filter(~name.isin(sorted({e.upper() for e in exclude})))
    return df


def since(df, start, col="Fecha"):
    return df.filter(F.col(col) >= F.lit(start))


def any_positive(df, *cols):
    return df.filter(reduce(lambda a, b: a | b, [F.col(c) > 0 for c in cols]))


def file_type(df, suffixes, year=None, col="path"):
    """Files by ending and, optionally, by the year folder in their path."""
    kept = df.filter(reduce(lambda a, b: a | b, [F.col(col).endswith(s) for s in suffixes]))
    return kept if year is None else kept.filter(F.col(col).contains(f"/{year}/"))

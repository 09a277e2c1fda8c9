"""What archive paths say about a file."""

from pyspark.sql import functions as F

from ..functions.keys import base_name

_PERIOD = r"/(\d{4})/(\d{2})/"


def path_period(path):
    """(year, month) columns from ``/YYYY/MM/``; null where the path has none."""
    def part(i):
        return F.nullif(F.regexp_extract(path, _PERIOD, i), F.lit("")).cast("int")
    return part(1), part(2)


def company_prefix(path):
    """Everything before ``/YYYY/MM/``, or ``Legacy``."""
    prefix = F.regexp_extract(path, r"^(.*?)/\d{4}/\d{2}/", 1)
    return F.when(path.rlike(_PERIOD), prefix).otherwise(F.lit("Legacy"))


def company_segment(path, unless=None):
    """Second path segment as company name. ``unless`` names the year folder that stands
    there when the path holds no company."""
    parts = F.split(path, "/")
    second = F.get(parts, F.lit(1))
    name = F.when(F.size(parts) >= 3, F.upper(F.replace(second, F.lit("_"), F.lit(" "))))
    return name if unless is None else F.when(second != str(unless), name)


def with_path_columns(df, col="path"):
    year, month = path_period(F.col(col))
    return df.withColumns({
        "path_year": year,
        "path_month": month,
        "path_company": company_prefix(F.col(col)),
        "company_segment": company_segment(F.col(col)),
        "file_name": base_name(F.col(col)),
    })

"""Tag maps from vendor portals' exports."""

from pyspark.sql import functions as F

from ..functions.eco import normalize_eco
from ..functions.text import blank_to_null, clean_tag, strip
from ..operators.aggregates import last_tags
from ..sources.headers import cell, keyword_headers, rows_below

_FUEL_PREFIXES = ("AU", "CA", "PRE")


def supramax_tags(raw):
    """(key, value) unit to tag of raw fuel-portal listings; the last row of a unit wins."""
    rows = rows_below(raw, keyword_headers(raw))
    pairs = rows.select(
        normalize_eco(cell(F.col("plate_pos")), _FUEL_PREFIXES).alias("ECO"),
        F.nullif(blank_to_null(cell(F.col("tag_pos"))), F.lit("")).alias("tag"),
        F.struct("path", "row_idx").alias("pos"))
    known = F.col("ECO").rlike(rf"^({'|'.join(_FUEL_PREFIXES)})-\d{{3}}$")
    return last_tags(pairs.filter(known & F.col("tag").isNotNull()), "ECO", "tag", "pos")


def pase_tags(df, eco, tag, position):
    """(key, value) unit to tag of a toll-portal listing: units written out in full."""
    unit = F.regexp_extract(F.upper(strip(F.col(eco))), r"^((?:AU|CA)-\d{3})", 1)
    value = clean_tag(F.col(tag))
    pairs = df.select(unit.alias("ECO"), value.alias("tag"), F.col(position).alias("pos"))
    return last_tags(pairs.filter("ECO <> '' and tag <> '' and tag <> 'NAN'"), "ECO", "tag", "pos")

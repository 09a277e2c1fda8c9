"""Small look-up files: JSON objects, key lists, tabbed frames and candidate tables."""

from pyspark.sql import functions as F

from ..functions.eco import normalize_eco
from ..functions.text import strip

_MAP = "map<string,string>"


def _filled(m):
    return F.map_filter(m, lambda k, v: (k != "") & v.isNotNull() & (v != ""))


def json_map(df, col):
    """(key, value) rows of JSON objects."""
    return df.select(F.explode(F.from_json(F.col(col), _MAP)).alias("key", "value"))


def read_json_map(spark, path):
    return json_map(spark.read.text(path, wholetext=True), "value")


def client_map(df, col):
    """(kind, number, company) rows of client maps. The present form nests ``by_number``
    and ``by_slot``; an older flat object counts as ``by_number``."""
    whole = F.from_json(F.col(col), _MAP)
    nested = F.map_contains_key("m", "by_number")
    by_number = F.when(nested, F.from_json(F.col("m")["by_number"], _MAP)).otherwise(F.col("m"))
    by_slot = F.when(nested, F.from_json(F.try_element_at("m", F.lit("by_slot")), _MAP))
    kinds = F.create_map(F.lit("by_number"), _filled(by_number), F.lit("by_slot"), _filled(by_slot))
    return (
        df.select(whole.alias("m")).filter("m is not null")
        .select(F.explode(kinds).alias("kind", "entries"))
        .select("kind", F.explode("entries").alias("number", "company"))
    )


def key_list(df, col="value"):
    """Distinct-as-given unit keys of a text with one key per line."""
    return df.select(strip(F.col(col)).alias("k")).filter("k <> ''").select(
        normalize_eco(F.col("k")).alias("ECO"))


def read_key_list(spark, path):
    return key_list(spark.read.text(path))


def expand_tabbed(df):
    """A frame whose only named column is tab-separated text becomes real columns; short
    rows are filled with empty text, long ones cut. Other frames are returned as they are."""
    real = [c for c in df.columns if not c.startswith("Unnamed:")]
    if len(real) != 1 or "\t" not in real[0]:
        return df
    parts = F.split(F.coalesce(F.col(f"`{real[0]}`"), F.lit("")), "\t")
    return df.select(parts.alias("p")).select(*[
        F.coalesce(strip(F.get("p", F.lit(i))), F.lit("")).alias(name.strip())
        for i, name in enumerate(real[0].split("\t"))])


def pick_table(stats, preferred):
    """Best of candidate tables ``(name, has_eco, rows_with_eco, columns)``: the first
    preferred name that has a unit column, else most units, then most columns. Equal ones
    go by ``position`` where the frame has it, else by name."""
    names = F.array(*[F.lit(n) for n in preferred])
    rank = F.nullif(F.array_position(names, F.col("name")), F.lit(0))
    last = "position" if "position" in stats.columns else "name"
    order = [
        rank.asc_nulls_last(), F.col("rows_with_eco").desc(), F.col("columns").desc(), F.col(last)]
    return stats.filter("has_eco").orderBy(*order).limit(1).select("name")

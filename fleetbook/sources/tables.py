"""Choice among several tables of one file by what they hold.

Rows are raw rows that carry a table number: ``(path, table, row_idx, cells)``, the header
in row 0.
"""

from pyspark.sql import Window, functions as F

from ..functions.text import strip
from .headers import find_eco


def table_stats(rows):
    """(path, table, has_eco, rows_with_eco, columns) of every table, from one pass: filled
    cells are counted by column before anything is shuffled, so what follows has a row per
    column of a table, however long the table is. ``rows_with_eco`` counts the filled cells
    of the unit column below the header."""
    cells = rows.select("path", "table", "row_idx", F.posexplode("cells").alias("pos", "cell"))
    named = F.when(F.col("row_idx") == 0, strip(F.coalesce("cell", F.lit(""))))
    filled = (F.col("row_idx") > 0) & (strip(F.coalesce("cell", F.lit(""))) != "")
    columns = cells.groupBy("path", "table", "pos").agg(
        F.max(named).alias("name"), F.count_if(filled).alias("filled")).filter("name is not null")
    tables = columns.groupBy("path", "table").agg(
        F.sort_array(F.collect_list(F.struct("pos", "name", "filled"))).alias("c"))
    unit = find_eco(F.col("c.name"))
    return tables.select(
        "path", "table", unit.isNotNull().alias("has_eco"),
        F.coalesce(F.get("c.filled", unit), F.lit(0)).cast("bigint").alias("rows_with_eco"),
        F.size("c").alias("columns"))


def best_tables(stats, preferred=()):
    """(path, table): of each file the first preferred table that has a unit column, else the
    one with most units, then most columns, then the first. Files without such a table have
    no row."""
    rank = F.nullif(F.array_position(F.array(*[F.lit(t) for t in preferred]).cast("array<int>"), F.col("table")), F.lit(0))
    order = Window.partitionBy("path").orderBy(
        rank.asc_nulls_last(), F.col("rows_with_eco").desc(), F.col("columns").desc(), "table")
    return stats.filter("has_eco").withColumn("_k", F.row_number().over(order)).filter("_k = 1").select("path", "table")


def of_best_tables(rows, preferred=()):
    """The raw rows of each file's best table. ``rows`` are read twice, so they should be
    stored (``ragged.land``)."""
    return rows.join(best_tables(table_stats(rows), preferred), ["path", "table"], "left_semi")

"""Manifest of files on their way to the archive."""

from pyspark.sql import functions as F

from ..functions.dates import parse_date_ladder, parse_dayfirst, parse_ts_fixed
from ..functions.keys import archive_path, base_name
from ..operators.aggregates import dominant_month
from .headers import cell, find_contains, fixed_headers, marker_headers, rows_below


def read_files(spark, path, glob=None):
    """(path, content) of the files below a folder, paths as the raw readers give them."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(F.col("_metadata.file_path").alias("path"), "content")


def content_period(raw, system):
    """(path, Anio, Mes) of raw files: the month of the most frequent moment in their date
    column. Files without such a column or without a readable date are left out."""
    if system == "Pase":
        headers, parse = fixed_headers(raw, 0), parse_date_ladder
    elif system == "Supramax":
        headers, parse = marker_headers(raw, "PLACAS"), parse_ts_fixed
    else:
        headers, parse = marker_headers(raw, "Fecha Transacción"), parse_dayfirst
    positions = headers.select(
        "path", "header_row", find_contains(F.col("header"), "fechadecruce", "fecha").alias("p_fecha"))
    dates = rows_below(raw, positions).select("path", parse(cell(F.col("p_fecha"))).alias("Fecha"))
    return dominant_month(dates, "Fecha", file="path")


def manifest(files, system, as_of, company=None, period=None):
    """(path, archive) for a frame ``(path, content)``. The period is given as
    (year, month), or found per file in a frame ``(path, Anio, Mes)``, else that of
    ``as_of``."""
    digest = F.sha2(F.col("content"), 256)
    listed = files.select("path", digest.alias("digest"), base_name(F.col("path")).alias("name"))
    year, month = F.lit(as_of.year), F.lit(as_of.month)
    if isinstance(period, tuple):
        year, month = F.lit(period[0]), F.lit(period[1])
    elif period is not None:
        listed = listed.join(period.select("path", "Anio", "Mes"), "path", "left")
        year, month = F.coalesce("Anio", year), F.coalesce("Mes", month)
    company = F.lit(company) if company is None or isinstance(company, str) else company
    return listed.select("path", archive_path(
        F.lit(system), company.cast("string"), year, month, F.col("name"), F.col("digest")).alias("archive"))

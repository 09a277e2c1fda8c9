"""Incremental consolidation: only new and changed files are read, each with an outcome."""

from pyspark.sql import functions as F

from ..operators.filters import required
from ..session import scratch_dir, stored as written
from ..sources import html, ragged
from ..sources.headers import marker_headers, own_headers, sought_headers
from ..sources.vendors import card_headers, edenred_rows, pase_consolidated, pase_consolidated_positions, supramax_rows
from ..streaming.changed_files import READ, changed, listing, outcomes, registered
from .unify import extend_consolidated


def _toll_headers(raw):
    """Files whose first row names unit, date and amount."""
    found = pase_consolidated_positions(own_headers(raw))
    return found.filter("p_eco IS NOT NULL AND p_fecha IS NOT NULL AND p_importe IS NOT NULL")


class Export:
    """How the exports of a system are read: the names of its files, their raw rows, the header
    frame of the files that have one, and the rows of the files of a header frame."""

    def __init__(self, glob, read, headers, rows):
        self.glob, self.read, self.headers, self.rows = glob, read, headers, rows


def _texts(skip_blank):
    def read(spark, folder, glob, files, since):
        wanted = files.select(files["uri"].alias("path"))
        return ragged.read_ragged(
            spark, folder, skip_blank, suffixes=[glob.lstrip("*")], files=wanted, since=since, strict=False)
    return read


def _sheets(spark, folder, glob, files, since):
    found = html.read_html_files(spark, folder, [glob.lstrip("*")], files=files.select("path"), since=since)
    names = files.select(F.col("path").alias("file"), F.col("uri").alias("to"))
    return found.join(names, found["path"] == names["file"]).select(F.col("to").alias("path"), "row_idx", "cells")


SYSTEMS = {
    "Pase": Export("*.csv", _texts(True), _toll_headers, lambda raw, headers: required(pase_consolidated(raw, headers)).drop("path")),
    "Supramax": Export("*.xls", _sheets, lambda raw: sought_headers(raw, marker_headers, "PLACAS"), supramax_rows),
    "Edenred": Export("*.csv", _texts(False), lambda raw: sought_headers(raw, card_headers), lambda raw, headers: edenred_rows(raw, headers=headers).drop("path")),
}


def consolidate(spark, system, folder, stored, registry, at):
    """(consolidated frame, registry) after the files below ``folder`` that the registry does
    not hold as read with their size and time. Rows stored already are not repeated.

    A file that is no text, is torn or has no header row neither fails the run nor counts as
    read: the registry tells its state and problem, and the next run tries it again (empty files
    are not listed by Spark, and wait likewise). The list
    of files stays a frame; the driver gets their number and least modification time, by which
    readers leave older files closed. Both frames are to be written before the next run."""
    export = SYSTEMS[system]
    place = scratch_dir(spark, "changed")
    changed(listing(spark, folder, export.glob, uri=True), registry).write.parquet(place)
    fresh = spark.read.parquet(place)
    n, since = fresh.selectExpr("count(*)", "min(modificationTime)").first()
    if not n:
        return stored, registry
    raw = ragged.land(spark, export.read(spark, folder, export.glob, fresh, since))
    headers = written(export.headers(raw.filter(raw["row_idx"] != ragged.PROBLEM)), "headers")
    told = written(outcomes(fresh, raw, headers, ragged.PROBLEM), "outcomes")
    good = told.filter(told["state"] == READ).select(told["uri"].alias("path"))
    rows = export.rows(raw, headers.join(good, "path", "left_semi"))
    if good.isEmpty():  # nothing to add but columns: what is stored is not read again
        rows = rows.filter("false")
        return stored.unionByName(rows, allowMissingColumns=True), registered(registry, told, at)
    return extend_consolidated(stored, rows), registered(registry, told, at)

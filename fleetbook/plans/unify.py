"""Archived exports of one vendor to one frame, and their recovery into the ledger."""

from pyspark.sql import functions as F

from ..functions.eco import normalize_eco
from ..operators.filters import file_type, required, same_year_as_path
from ..operators.merge import insert_new
from ..operators.sets import combine_distinct
from ..operators.windows import prefer_layout
from ..session import stored
from ..sources.headers import marker_headers, preamble_value, required_headers
from ..sources.paths import company_segment, path_period
from ..sources.vendors import card_headers, clean_edenred, clean_pase, edenred_rows, pase_consolidated, supramax_rows
from .ingest import clean_batch, new_rows


def chosen_files(raw, year=None):
    """Raw rows of the files that count: each export once, in the preferred layout."""
    files = file_type(raw.select("path").distinct(), [".csv"], year)
    return raw.join(prefer_layout(files), "path", "left_semi")


def unify_pase(raw, year=None):
    """All toll exports as one frame. Rows must be dated in the year of their folder; the
    month is not checked, since crossings are billed late."""
    rows = required(pase_consolidated(chosen_files(raw, year)))
    rows = rows.withColumn("ECO", normalize_eco(F.col("ECO")))
    return same_year_as_path(
        rows.withColumn("path_year", path_period(F.col("path"))[0]), year=year).drop("path", "path_year")


def unify_supramax(raw):
    """All fuel exports as one frame of their named columns and the file name. A file without
    a header row fails the job."""
    return supramax_rows(raw, required_headers(raw, marker_headers, "PLACAS"))


def _card_rows(raw, header_row):
    """Card exports by their own header row, or a given one; a file without it fails the job."""
    return edenred_rows(raw, header_row, required_headers(raw, card_headers, header_row))


def unify_edenred(raw, header_row=None):
    """(raw, clean) frames of all card exports. Headers stand in any row (row 0 of text
    exports, row 5 of converted sheets); a file without one fails the job."""
    rows = _card_rows(raw, header_row)
    clean = clean_batch(clean_edenred(rows), dedup=False).select(
        "ECO", "Fecha", "Concepto", "Tipo", "Cantidad", "Importe", "Sistema", "Archivo_Origen")
    return rows.drop("path"), clean


def extend_consolidated(existing, new):
    """A stored consolidated frame with newly processed rows, without repeated rows."""
    return combine_distinct(existing, new)


def recover_pase(raw, ledger, year):
    """The ledger after all toll files of a year, companies taken from their paths."""
    files = file_type(raw, [".csv"], year)
    company = F.coalesce(company_segment(F.col("path")), F.lit("UNKNOWN"))
    batch = clean_batch(clean_pase(files, company), by_id=True)
    return insert_new(ledger, new_rows(batch, ledger, by_id=True))


def recover_edenred(raw, ledger, year, header_row=None):
    """The ledger after all card files of a year. The company stands in the preamble, else
    in the path. A file without a header row fails the job."""
    files = file_type(raw, [".csv"], year)
    stated = stored(preamble_value(files, "Cliente:").select("path", F.col("value").alias("_company")), "companies")
    rows = _card_rows(files, header_row).join(stated, "path", "left")
    company = F.coalesce("_company", company_segment(F.col("path"), unless=year))
    cleaned = clean_edenred(rows, company)
    batch = clean_batch(cleaned)
    return insert_new(ledger, new_rows(batch, ledger))

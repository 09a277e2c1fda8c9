"""Technical keys: row ids, text signatures, and what file names say."""

from pyspark.sql import functions as F

from .amounts import CENTS
from .text import strip

_TS = "yyyy-MM-dd HH:mm:ss"


def strip_hash_prefix(name):
    """File name without the ``pase_<12 hex>_`` an archive copy carries."""
    return F.regexp_replace(name, r"(?i)^pase_[0-9a-f]{12}_(?=.)", "")


def _text(c):
    return F.coalesce(strip(c), F.lit(""))


def row_id(system, file_name, row_idx, cells):
    """SHA-1 over system, file, row number and the trimmed cells of the row, given as a
    list of columns or as one array. The name is hashed without the archive prefix, so a
    recovered copy keeps its ids."""
    if isinstance(cells, (list, tuple)):
        content = F.concat_ws("||", *[_text(c) for c in cells])
    else:
        content = F.array_join(F.transform(cells, _text), "||")
    parts = [F.lit(system), strip_hash_prefix(file_name), row_idx.cast("string"), content]
    return F.sha1(F.concat_ws("|", *parts))


def _moment(c):
    return F.coalesce(F.date_format(c, _TS), F.lit(""))


def _amount(c):
    return F.coalesce(c.cast(CENTS), F.lit(0).cast(CENTS)).cast("string")


def signature_expense(eco, fecha, concepto, importe, sistema, litros):
    return F.concat_ws(
        "_", _text(eco), _moment(fecha), F.upper(_text(concepto)), _amount(importe),
        F.upper(_text(sistema)), _amount(litros))


def signature_trip(eco, start, end, user, km):
    return F.concat_ws(
        "_", _text(eco), _moment(start), _moment(end), F.upper(_text(user)), _amount(km))


def client_number_in_text(c):
    return F.nullif(
        F.regexp_extract(c, r"(?i)N(?:Ú|ú|U)MERO\s+DE\s+CLIENTE\s*:\s*(\d+)", 1), F.lit(""))


def client_number_in_file(name):
    """``g1A53089.12.csv`` belongs to client 53089."""
    return F.nullif(F.regexp_extract(name, r"(?i)^g\d+[A-Z](\d+)\.\d+\.csv$", 1), F.lit(""))


def period_code_in_file(name):
    return F.nullif(F.regexp_extract(name, r"(?i)\.(\d+)\.csv$", 1), F.lit(""))


def base_name(path):
    return F.substring_index(path, "/", -1)


def archive_path(system, company, year, month, name, digest):
    """``system[/company]/yyyy/mm/system_<12 hex>_name``; ``digest`` is the SHA-256."""
    from .text import sanitize_path

    folder = F.when(strip(F.coalesce(company, F.lit(""))) != "", sanitize_path(company))
    stored = F.concat_ws("_", F.lower(system), F.substring(digest, 1, 12), name)
    return F.concat_ws(
        "/", system, folder, F.lpad(year.cast("string"), 4, "0"),
        F.lpad(month.cast("string"), 2, "0"), stored)

"""Vendor exports to ledger rows."""

from pyspark.sql import functions as F

from ..functions.amounts import parse_money, to_number
from ..functions.dates import parse_date_ladder, parse_dayfirst, parse_ts_fixed
from ..functions.eco import normalize_eco_lzc
from ..functions.keys import base_name, row_id
from ..functions.text import drop_trailing_dots, product_type, strip
from ..operators.filters import required, valid_eco
from ..session import stored
from ..vocabulary import CONCEPT_BY_SYSTEM
from .headers import (
    cell, find_contains, find_either, find_equal, first_row_headers, fixed_headers, marker_headers,
    own_headers, rows_below,
)


def _company(empresa):
    return empresa if empresa is not None and not isinstance(empresa, str) else F.lit(empresa).cast("string")


def clean_supramax(df, empresa=None):
    """Fuel rows from the columns PLACAS, FECHA, PRODUCTO, CANTIDAD and IMPORTE."""
    return df.select(
        F.col("PLACAS").alias("ECO"), parse_ts_fixed(F.col("FECHA")).alias("Fecha"),
        F.lit(CONCEPT_BY_SYSTEM["Supramax"]).alias("Concepto"),
        product_type(F.col("PRODUCTO")).alias("Tipo"),
        to_number(F.col("CANTIDAD")).alias("Cantidad"), F.col("IMPORTE").alias("Importe"),
        F.lit("Supramax").alias("Sistema"), _company(empresa).alias("Empresa"))


def supramax_rows(raw, headers=None):
    """Named columns of raw fuel exports, whose header row holds PLACAS, with the file. A header
    frame that is stored already may be given, here and below."""
    headers = stored(marker_headers(raw, "PLACAS"), "headers") if headers is None else headers
    names = ["PLACAS", "FECHA", "PRODUCTO", "CANTIDAD", "IMPORTE", "IDENTIFICADOR"]
    positions = headers.select(
        "path", "header_row", *[find_equal(F.col("header"), n).alias(f"p_{n}") for n in names])
    return rows_below(raw, positions).select(
        *[cell(F.col(f"p_{n}")).alias(n) for n in names], base_name(F.col("path")).alias("Archivo_Origen"))


def _pase_positions(headers):
    header = F.col("header")
    return headers.withColumns({
        "p_eco": find_contains(header, "noeconomico", "eco"),
        "p_fecha": find_contains(header, "fechadecruce", "fecha"),
        "p_importe": find_contains(header, "importeal100", "importe", "monto", "cobro"),
        "p_tarjeta": find_contains(header, "tarjetaidmx", "tarjeta", "tag"),
    })


def clean_pase(raw, empresa=None):
    """Toll rows of raw exports, columns found per file by name. The id of a row is a
    hash over its file, number and cells, so loading it again changes nothing."""
    rows = rows_below(raw, stored(_pase_positions(first_row_headers(raw)).drop("header"), "positions"))
    cells = F.transform("kept", lambda i: F.get("cells", i))
    file_name = base_name(F.col("path"))
    return rows.select(
        cell(F.col("p_eco"), "").alias("ECO"),
        parse_date_ladder(cell(F.col("p_fecha"))).alias("Fecha"),
        F.lit(CONCEPT_BY_SYSTEM["Pase"]).alias("Concepto"),
        F.lit(None).cast("string").alias("Tipo"), F.lit(None).cast("double").alias("Cantidad"),
        parse_money(cell(F.col("p_importe"))).alias("Importe"), F.lit("Pase").alias("Sistema"),
        _company(empresa).alias("Empresa"),
        row_id("Pase", file_name, F.col("row_idx") - F.col("header_row") - 1, cells).alias("Id_Origen"),
        file_name.alias("Archivo_Origen"))


def pase_consolidated_positions(headers):
    """The consolidation names its columns more strictly than the ingest: a billing date or
    a base amount left of the real ones is not taken for them."""
    header = F.col("header")
    return headers.withColumns({
        "p_eco": find_either(header, ["economico"]),
        "p_fecha": find_either(header, ["fechadecruce"], ["fecha"]),
        "p_importe": find_either(header, ["importeal100"], ["importe"]),
        "p_tarjeta": F.coalesce(
            find_either(header, ["tarjetaidmx"]), find_either(header, ["tarjeta"], ["tag"])),
    })


def pase_consolidated(raw, headers=None):
    """Toll rows as kept in the consolidated export: unit, date, amount, card, file. Columns
    that a file does not name are null."""
    headers = stored(own_headers(raw), "headers") if headers is None else headers
    rows = rows_below(raw, pase_consolidated_positions(headers))
    return rows.select(
        strip(cell(F.col("p_eco"), "")).alias("ECO"),
        parse_date_ladder(cell(F.col("p_fecha"))).alias("Fecha"),
        parse_money(cell(F.col("p_importe"))).alias("Importe"),
        drop_trailing_dots(strip(cell(F.col("p_tarjeta"), ""))).alias("Tarjeta IDMX"),
        base_name(F.col("path")).alias("Archivo_Origen"), "path")


CARD_MARKER = "Fecha Transacción"
_EDENRED_UNIT = "Vehículo"
_EDENRED_UNIT_POSITION = 7


def card_headers(raw, header_row=None):
    return marker_headers(raw, CARD_MARKER) if header_row is None else fixed_headers(raw, header_row)


def edenred_rows(raw, header_row=None, headers=None):
    """Named columns of raw card exports. The header is, per file, the first row that names
    the transaction date (row 0 of text exports, row 5 of converted sheets), or the given
    row. The unit stands in *Vehículo*, or in the eighth column of files without it."""
    if headers is None:
        headers = stored(card_headers(raw, header_row), "headers")
    names = ["Fecha Transacción", "Mercancía", "Cantidad Mercancía", "Importe Transacción", "Núm Tarjeta"]
    unit = F.coalesce(find_equal(F.col("header"), _EDENRED_UNIT), F.lit(_EDENRED_UNIT_POSITION))
    positions = headers.select(
        "path", "header_row", unit.alias("p_unit"),
        *[find_equal(F.col("header"), n).alias(f"p_{n}") for n in names])
    return rows_below(raw, positions).select(
        cell(F.col("p_unit")).alias(_EDENRED_UNIT),
        *[cell(F.col(f"`p_{n}`")).alias(n) for n in names],
        base_name(F.col("path")).alias("Archivo_Origen"), "path")


def clean_edenred(df, empresa=None):
    """Fuel-card rows from the columns of ``edenred_rows``."""
    extra = [c for c in ("Archivo_Origen",) if c in df.columns]
    return df.select(
        F.col(_EDENRED_UNIT).alias("ECO"), parse_dayfirst(F.col("Fecha Transacción")).alias("Fecha"),
        F.lit(CONCEPT_BY_SYSTEM["Edenred"]).alias("Concepto"), F.col("Mercancía").alias("Tipo"),
        to_number(F.col("Cantidad Mercancía")).alias("Cantidad"),
        F.col("Importe Transacción").alias("Importe"), F.lit("Edenred").alias("Sistema"),
        _company(empresa).alias("Empresa"), *extra)


def _first_with(columns, *words):
    return next((c for c in columns if any(w in c.lower() for w in words)), None)


def clean_maintenance(df, system="Google Sheets"):
    """Maintenance rows: columns found by name, repeated rows of the whole sheet dropped."""
    eco, fecha = _first_with(df.columns, "eco"), _first_with(df.columns, "fecha")
    importe = _first_with(df.columns, "importe", "precioneto", "costo")
    if not (eco and fecha and importe):
        raise ValueError(f"no unit, date or amount column among {df.columns}")
    kinds = dict(df.dtypes)
    day = parse_dayfirst(F.col(f"`{fecha}`")) if kinds[fecha] == "string" else F.col(f"`{fecha}`")
    rows = df.distinct().select(
        normalize_eco_lzc(F.col(f"`{eco}`")).alias("ECO"), day.alias("Fecha"),
        F.lit(CONCEPT_BY_SYSTEM["Google Sheets"]).alias("Concepto"),
        F.lit(None).cast("string").alias("Tipo"), F.lit(None).cast("double").alias("Cantidad"),
        to_number(F.col(f"`{importe}`")).alias("Importe"), F.lit(system).alias("Sistema"))
    return valid_eco(required(rows), lzc=True)


# Names under which a consolidated export may hold each column, best first.
ALIASES = {
    "ECO": ["ECO", "PLACAS", "No. economico", "No Economico", "Vehículo"],
    "Fecha": ["Fecha", "Fecha Transacción", "Fecha de cruce"],
    "Importe": ["Importe", "Importe Transacción", "Importe al 100"],
    "Cantidad": ["Cantidad", "Cantidad Mercancía"],
    "Tipo": ["Tipo", "PRODUCTO", "Mercancía"],
    "Concepto": ["Concepto"],
}


def from_consolidated(df, system):
    """Seven common columns of a consolidated export; required ones must be there. Only
    the columns found are read."""
    import unicodedata

    def key(name):
        text = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode().lower()
        return "".join(ch for ch in text if ch.isascii() and ch.isalnum())

    by_key = {}
    for column in df.columns:
        by_key.setdefault(key(column), column)
    found = {
        target: next((by_key[key(n)] for n in names if key(n) in by_key), None)
        for target, names in ALIASES.items()
    }
    missing = [c for c in ("ECO", "Fecha", "Importe") if not found[c]]
    if missing:
        raise ValueError(f"no column for {missing} among {df.columns}")

    def source(target):
        name = found[target]
        return F.lit(None).cast("string") if name is None else F.col(f"`{name}`").cast("string")

    tolls = system == "Pase"
    concept = F.lit(CONCEPT_BY_SYSTEM[system])
    return df.select(
        source("ECO").alias("ECO"), parse_date_ladder(source("Fecha")).alias("Fecha"),
        (concept if tolls else F.coalesce(source("Concepto"), concept)).alias("Concepto"),
        (F.lit(None).cast("string") if tolls else source("Tipo")).alias("Tipo"),
        to_number(source("Importe")).alias("Importe"), F.lit(system).alias("Sistema"),
        (F.lit(None).cast("double") if tolls else to_number(source("Cantidad"))).alias("Cantidad"))


def read_consolidated(spark, path, system):
    """Consolidated export from CSV with header, or from Parquet."""
    if path.endswith(".csv"):
        df = spark.read.csv(path, header=True)
    else:
        df = spark.read.parquet(path)
    return from_consolidated(df, system)

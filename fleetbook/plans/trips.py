"""Trips outside working hours."""

from pyspark.sql import functions as F

from ..functions.dates import week_of_month
from ..functions.eco import normalize_eco_lzc
from ..functions.keys import signature_trip
from ..operators.filters import valid_eco
from ..operators.merge import insert_new, new_by_signature
from ..operators.windows import FLAGS, off_hours_flags
from ..vocabulary import NO_INFO

START, END, USER, KM = "Fecha-hora Inicio", "Fecha-hora Término", "Usuario", "Distancia(KM)"


def clean_trips(raw):
    return valid_eco(raw.withColumn("ECO", normalize_eco_lzc(F.col("ECO"))), lzc=True)


def trip_signature(df):
    return signature_trip(*[F.col(f"`{c}`") for c in ("ECO", START, END, USER, KM)])


def helper_columns(trips, position):
    """Calendar parts and off-hours flags; dimensions get their default."""
    start = F.col(f"`{START}`")
    named = trips.withColumns({
        "Anio": F.coalesce(F.year(start), F.lit(0)),
        "Mes_Num": F.coalesce(F.month(start), F.lit(0)),
        "Semana_Mes": week_of_month(start),
    })
    named = named.na.fill(NO_INFO, [c for c in ("Dirección", "Empresa", "Sucursal") if c in named.columns])
    return off_hours_flags(named, START, position)


def trips_table(raw, existing, position):
    """Stored trips and new ones, with the flags computed over all of them, so a day is
    flagged once however many batches it came in. ``existing`` may be an earlier result."""
    fresh = clean_trips(raw)
    if existing is not None:
        existing = existing.drop("Anio", "Mes_Num", "Semana_Mes", *FLAGS)
        fresh = insert_new(existing, new_by_signature(fresh, existing, trip_signature))
    return helper_columns(fresh, position)

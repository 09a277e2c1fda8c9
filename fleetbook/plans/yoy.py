"""Which units were active in two years, and the catalogue check."""

from pyspark.sql import functions as F

from ..functions.amounts import cents
from ..operators.aggregates import in_years, sorted_list, units_by_month, units_twelve_months, with_total
from ..session import stored
from ..vocabulary import NO_ACTIVITY, NOT_AVAILABLE, SYSTEMS


def _measures(year_a, year_b):
    """Systems, rows and amount of both years over rows of (unit, system, year)."""
    def of(year, value):
        return F.when(F.col("Anio") == year, value)

    columns = []
    for year in (year_a, year_b):
        columns += [
            sorted_list(of(year, F.col("Sistema"))).alias(f"Sistemas_{year}"),
            F.coalesce(F.sum(of(year, F.col("Regs"))), F.lit(0)).alias(f"Regs_{year}"),
            F.coalesce(F.sum(of(year, cents(F.col("Importe")))), F.lit(0)).cast("double")
            .alias(f"Importe_{year}"),
        ]
    return columns


def _presence(both, year_a, year_b):
    a, b = str(year_a), str(year_b)
    here = {y: F.when(F.col(f"Regs_{y}") > 0, "SÍ").otherwise("NO") for y in (a, b)}
    presence = (
        F.when((F.col(f"Regs_{a}") > 0) & (F.col(f"Regs_{b}") > 0), "AMBOS")
        .when(F.col(f"Regs_{b}") > 0, f"SOLO_{b}")
        .otherwise(f"SOLO_{a}")
    )
    return both.withColumns({f"En_{a}": here[a], f"En_{b}": here[b], "Presencia": presence})


def compare_years(detail, year_a, year_b, system=None):
    """One row per unit with systems, rows and amount of both years and its presence.
    A conditional aggregate stands in for joining the two years."""
    rows = detail if system is None else detail.filter(F.col("Sistema") == system)
    both = rows.filter(F.col("Anio").isin(year_a, year_b)).groupBy("ECO").agg(*_measures(year_a, year_b))
    return _presence(both, year_a, year_b)


def compare_systems(detail, year_a, year_b):
    """The comparison of all systems together (``hoja`` null) and of each, with their total
    rows (``es_total``, unit *Total*), by grouping sets over one scan and one shuffle."""
    rows = detail.filter(F.col("Anio").isin(year_a, year_b)).withColumns({"unit": F.col("ECO"), "hoja": F.col("Sistema")})
    unit, sheet = F.col("unit"), F.col("hoja")
    sets = rows.groupingSets([[unit], [unit, sheet], [sheet], []], unit, sheet)
    found = sets.agg((F.grouping("unit") == 1).alias("es_total"), *_measures(year_a, year_b))
    found = _presence(found, year_a, year_b)
    only_units = [c for c in found.columns if c.startswith(("Sistemas_", "En_", "Presencia"))]
    return found.select(
        "hoja", "es_total", F.when(F.col("es_total"), "Total").otherwise(unit).alias("ECO"), *[
            F.when(~F.col("es_total"), F.col(c)).alias(c) if c in only_units else F.col(c)
            for c in found.columns if c not in ("hoja", "es_total", "unit")])


def sheet_of(compared, system=None):
    """One sheet of ``compare_systems`` with its total row."""
    wanted = F.col("hoja").isNull() if system is None else F.col("hoja") == system
    return compared.filter(wanted).drop("hoja", "es_total")


def presence_order(year_a, year_b):
    """Units of both years, then of the second year only, then of the first only."""
    rank = (
        F.when(F.col("Presencia") == "AMBOS", 1)
        .when(F.col("Presencia") == f"SOLO_{year_b}", 2)
        .otherwise(3)
    )
    return [rank, F.col("ECO")]


def usage(ledger):
    """One row per unit, system, company and month (its first day): all that the sheets of
    the yearly report need of the ledger."""
    return ledger.groupBy("ECO", "Sistema", "Empresa", F.trunc("Fecha", "month").alias("Fecha")).agg(
        F.count("*").alias("n"), F.sum(cents(F.col("Importe"))).alias("amount"),
        F.min("Fecha").alias("first"), F.max("Fecha").alias("last"))


def detail_of(used, month, year_a, year_b):
    """``month_detail`` from the rows of ``usage``."""
    rows = used.filter(in_years(F.col("Fecha"), year_a, year_b) & (F.month("Fecha") == month))
    return rows.groupBy("ECO", "Sistema", F.year("Fecha").alias("Anio")).agg(
        F.sum("n").alias("Regs"), F.sum("amount").cast("double").alias("Importe"))


def catalog_check(ledger, master):
    """Every unit of the catalogue or the ledger: is it catalogued, by whom was it used,
    how often, for how much, first and last day.

    The ledger is reduced to one row per unit before it meets the catalogue. A unit
    listed n times under one company counts its rows n times, as a row-level join would.
    """
    return catalog_of(ledger.groupBy("ECO", "Sistema", "Empresa").agg(
        F.count("ECO").alias("n"), F.sum(cents(F.col("Importe"))).alias("amount"),
        F.min("Fecha").alias("first"), F.max("Fecha").alias("last")), master)


def catalog_of(per_use, master):
    """``catalog_check`` from rows by unit, system and company, or finer ones."""
    per_unit = per_use.groupBy("ECO").agg(
        sorted_list(F.col("Sistema")).alias("systems"),
        sorted_list(F.coalesce("Empresa", F.lit(NOT_AVAILABLE))).alias("companies"),
        F.sum("n").alias("n"), F.sum("amount").alias("amount"),
        F.min("first").alias("first"), F.max("last").alias("last"))
    listed = master.groupBy(F.col("ECO").alias("m_eco"), F.col("Empresa").alias("m_company")).agg(
        F.count("*").alias("copies"))
    joined = listed.join(per_unit, F.col("m_eco") == F.col("ECO"), "full")
    copies = F.coalesce("copies", F.lit(1))
    active = F.col("n").isNotNull()
    return joined.select(
        F.coalesce("m_eco", "ECO").alias("ECO"),
        F.when(F.col("m_eco").isNull(), "NO").otherwise("SÍ").alias("En_Tabla_Maestra"),
        F.coalesce("m_company", F.lit(NOT_AVAILABLE)).alias("Empresa_Catalogo"),
        F.when(active, F.col("systems")).otherwise(NO_ACTIVITY).alias("Sistemas"),
        F.when(active, F.col("companies")).otherwise(NOT_AVAILABLE).alias("Empresas_en_Txs"),
        F.coalesce(F.col("n") * copies, F.lit(0)).alias("Total_Transacciones"),
        F.coalesce(F.col("amount") * copies, F.lit(0)).cast("double").alias("Total_Importe"),
        F.col("first").alias("Primera_Transaccion"),
        F.col("last").alias("Ultima_Transaccion"),
    )


def with_original_names(catalog, names):
    """Adds the spelling used in the transactions, the canonical key where there is none."""
    return catalog.join(names, "ECO", "left").withColumn(
        "ECO_Original", F.coalesce("ECO_Original", "ECO"))


def yoy_report(ledger, master, names, month, year_a, year_b):
    """All result tables of the yearly comparison, by sheet name. The ledger is read once, into
    a stored aggregate; the comparisons, and the catalogue check, are stored for their sheets
    and totals, so no sheet repeats the work of another."""
    used = stored(usage(ledger), "usage")
    compared = stored(compare_systems(detail_of(used, month, year_a, year_b), year_a, year_b), "comparison")
    listed = stored(with_original_names(catalog_of(used, master), names), "catalogue")
    sheets = {
        "RESUMEN GENERAL": units_twelve_months(units_by_month(used, year_a, year_b), year_a, year_b),
        "COMPARATIVA": sheet_of(compared),
    }
    for system in SYSTEMS:
        title = "MANTENIMIENTOS" if system == "Google Sheets" else system.upper()
        sheets[title] = sheet_of(compared, system)
    sheets["VALIDACION CATALOGO"] = with_total(listed, "ECO", ["Total_Transacciones", "Total_Importe"])
    return sheets

"""Cards and tags per unit."""

from functools import reduce

from pyspark.sql import functions as F

from ..functions.eco import is_unit, normalize_eco
from ..functions.text import blank_to_null, drop_trailing_dots, normalize_card, strip, strip_float
from ..operators.joins import last_value
from ..operators.windows import last_per_unit


def system_map(df, eco, card, date, output):
    """(ECO, card) with the card each unit used last in one system."""
    rows = df.filter(is_unit(F.col(eco))).select(
        normalize_eco(F.col(eco)).alias("ECO"), normalize_card(F.col(card)).alias(output),
        F.col(date).alias("_date"))
    return last_per_unit(rows, output, "_date")


def master_cards(master, position):
    """Cards the catalogue lists per unit; the last row of a unit wins."""
    def compact(c):
        return F.translate(strip(F.coalesce(F.col(c).cast("string"), F.lit(""))), " ", "")

    rows = master.filter(is_unit(F.col("ECO"))).select(
        normalize_eco(F.col("ECO")).alias("ECO"),
        F.struct(
            compact("Supramax ID").alias("Supramax"),
            compact("Ticket Card ID").alias("Ticket Card"),
            drop_trailing_dots(compact("IAVE Pase ID")).alias("Pase")).alias("cards"),
        F.col(position).alias("pos"))
    return last_value(rows, "ECO", "cards", "pos").select("ECO", "cards.*")


def cards_report(supramax, ticket, pase, active, pase_tags, supramax_tags, master):
    """One row per known unit with its card in each system. Cards not seen in the
    transactions come from the tag maps, then from the catalogue.

    All sources are stacked and grouped by unit once, in place of a join per source. The
    maps and the catalogue add cards to units but no units.
    """
    sources = {"Supramax": supramax, "Ticket Card": ticket, "Pase": pase}
    fallback = {"tag Supramax": supramax_tags, "tag Pase": pase_tags}

    def entries(df, slot, value, known, unit="ECO"):
        return df.select(
            F.col(unit).alias("ECO"), F.lit(slot).alias("slot"), value.alias("card"), F.lit(known).alias("known"))

    parts = [entries(df, name, blank_to_null(F.col(f"`{name}`")), True) for name, df in sources.items()]
    parts.append(entries(active, "", F.lit(None).cast("string"), True))
    parts += [entries(df, name, blank_to_null(F.col("value")), False, "key") for name, df in fallback.items()]
    parts += [entries(master, f"master {name}", blank_to_null(F.col(f"`{name}`")), False) for name in sources]
    stacked = reduce(lambda a, b: a.unionByName(b), parts)

    def slot(name):
        return F.max(F.when(F.col("slot") == name, F.col("card")))

    chosen = {
        name: F.coalesce(*[slot(s) for s in (name, f"tag {name}", f"master {name}")]) for name in sources}
    return (
        stacked.groupBy("ECO")
        .agg(F.bool_or("known").alias("known"), *[strip_float(c).alias(n) for n, c in chosen.items()])
        .filter("known").drop("known"))

"""Insert-only merges as anti joins: which rows of a batch are new."""

from pyspark.sql import functions as F

# Amounts are compared with a tolerance. A cell is wider than the tolerance, so equal
# amounts lie in one cell or, near its border, in two neighbouring ones.
TOLERANCE = 0.01
_CELL = 0.1
_REACH = TOLERANCE * 1.1


def new_by_id(source, target):
    """Rows whose (Sistema, Id_Origen) the target does not hold.

    Rows without an id never match, so they are all new. The salt spreads them over
    tasks: on the join key alone they would meet in one.
    """
    has_id = F.col("Id_Origen").isNotNull()
    salt = F.when(has_id, F.lit(0)).otherwise(F.pmod(F.xxhash64(*source.columns), F.lit(4096)) + 1)
    left = source.withColumn("_salt", salt.cast("int"))
    right = (
        target.filter(has_id).select("Sistema", "Id_Origen").withColumn("_salt", F.lit(0))
    )
    return left.join(right, ["Sistema", "Id_Origen", "_salt"], "left_anti").select(*source.columns)


def new_in_batch(source, target, by_id=False):
    """New rows of a batch: those with an id by it, the others by natural key, so a batch
    that is run again adds nothing. Without ``by_id`` all go by natural key."""
    if not by_id:
        return new_by_natural_key(source, target)
    named = new_by_id(source.filter("Id_Origen IS NOT NULL"), target)
    return named.unionByName(new_by_natural_key(source.filter("Id_Origen IS NULL"), target))


def _cell(c):
    return F.floor(c / _CELL)


def _cells_within_reach(c):
    return F.explode(F.sequence(_cell(c - _REACH), _cell(c + _REACH)))


def new_by_natural_key(source, target):
    """Rows for which the target has none with equal ECO, Fecha, Concepto, Sistema and
    Tipo (missing equals missing) and with Cantidad and Importe less than 0.01 apart.

    Joining on the day alone would compare every pair of a busy unit's rows. Here the
    join key also holds the cell of both amounts; target rows near a border are listed
    in both cells, so no match is lost, and the exact test stays as the join condition.
    """
    def keyed(df):
        return df.withColumns({
            "_tipo": F.coalesce("Tipo", F.lit("")),
            "_qty": F.coalesce("Cantidad", F.lit(-1.0)),
        })

    keys = ["ECO", "Fecha", "Concepto", "Sistema", "_tipo", "_cell_qty", "_cell_amt"]
    left = (
        keyed(source)
        .withColumns({"_cell_qty": _cell(F.col("_qty")), "_cell_amt": _cell(F.col("Importe"))})
        .alias("s")
    )
    right = (
        keyed(target)
        .select("ECO", "Fecha", "Concepto", "Sistema", "_tipo", "_qty", "Importe")
        .withColumn("_cell_qty", _cells_within_reach(F.col("_qty")))
        .withColumn("_cell_amt", _cells_within_reach(F.col("Importe")))
        .alias("t")
    )
    same = [F.col(f"s.{k}") == F.col(f"t.{k}") for k in keys]
    close = [
        F.abs(F.col(f"t.{c}") - F.col(f"s.{c}")) < TOLERANCE for c in ("_qty", "Importe")
    ]
    condition = same[0]
    for test in same[1:] + close:
        condition = condition & test
    return left.join(right, condition, "left_anti").select(*source.columns)


def new_by_signature(source, target, signature):
    """Rows whose text signature the target does not hold. ``signature`` maps a frame
    to its signature column."""
    seen = target.select(signature(target).alias("_sig"))
    return (
        source.withColumn("_sig", signature(source))
        .join(seen, "_sig", "left_anti")
        .drop("_sig")
    )


def insert_new(target, new_rows):
    """Target with the new rows; columns only one side has are filled with null."""
    return target.unionByName(new_rows, allowMissingColumns=True)

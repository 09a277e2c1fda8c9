"""Places of rows in an order over the whole frame."""

from pyspark.sql import functions as F

from ..session import stored

_BITS = 33  # monotonically_increasing_id counts rows of a partition in the lower 33 bits


def with_positions(df, order, name="pos"):
    """The rows with their place (from 1) in ``order``, and in that order within and across
    partitions. Rows are dealt out by ranges of the order and sorted there; a place is the number
    of rows of the partitions before, and the place within its own. No task meets all rows:
    the driver gets one count per partition. Rows that ``order`` does not tell apart come in any
    order, but each once."""
    sorted_ = stored(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "sorted")
    part = F.shiftrightunsigned("_at", _BITS)
    before, offsets = 0, {}
    for p, n in sorted_.groupBy(part.alias("p")).agg(F.count("*").alias("n")).orderBy("p").collect():
        offsets[p] = before
        before += n
    if not offsets:
        return sorted_.withColumn(name, F.lit(0).cast("long")).drop("_at")
    table = F.create_map(*[F.lit(x).cast("long") for pair in offsets.items() for x in pair])
    place = table[part.cast("long")] + F.col("_at").bitwiseAND(F.lit((1 << _BITS) - 1)) + 1
    return sorted_.withColumn(name, place).drop("_at")

"""Numbers and money. Nothing raises on bad text: it becomes null."""

from pyspark.sql import functions as F

from .text import strip

CENTS = "decimal(18,2)"


def to_number(c):
    """Text to double. A number ends in a digit or a dot; that shuts out what a bare cast
    would let through (``1d``, ``NaN``, ``Infinity``)."""
    text = strip(c.cast("string"))
    last = F.right(text, F.lit(1))
    careful = F.when(last.between("0", "9") | (last == "."), text.try_cast("double"))
    return F.coalesce(_plain_number(c.cast("string"), c.cast("string")), careful)


def _plain_number(c, text):
    """``text`` as double where ``c`` ends in a digit, as nearly all rows do: nothing has to be
    stripped there first."""
    return F.when(F.substring(c, -1, 1).between("0", "9"), text.try_cast("double"))


def parse_money(c):
    """``-$1,234.50`` to 1234.5: sign, dollar and comma carry no meaning."""
    plain = F.replace(F.replace(c, F.lit("$"), F.lit("")), F.lit(","), F.lit(""))
    return F.abs(F.coalesce(_plain_number(c, plain), to_number(F.translate(c, "$,", ""))))


def cents(c):
    """Exact amount, so that sums do not depend on the order of rows."""
    return c.cast(CENTS)


def sum_cents(c):
    """Sum of exact amounts as double."""
    return F.sum(cents(c)).cast("double")


def zero_to_null(c):
    return F.nullif(c, F.lit(0))

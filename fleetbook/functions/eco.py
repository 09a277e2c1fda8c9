"""Vehicle keys (ECO): canonical form ``AU-###`` or ``CA-###``."""

from pyspark.sql import functions as F

from .text import strip

PREFIXES = ("AU", "CA")
VALID = r"^(AU|CA)-\d{3}$"
VALID_LZC = r"^(AU|CA)-\d{3}(?:\s*LZC)?$"
_MASTER = r"^(AU|CA)-?\d{3}(?:\s*LZC)?$"


def _pattern(prefixes):
    return rf"^({'|'.join(prefixes)})-?(\d{{1,3}})(?!\d)"


def _canonical(cleaned, prefixes=PREFIXES):
    """``XX-###`` where the text starts with a prefix and 1 to 3 digits, else null."""
    prefix, digits = (F.regexp_extract(cleaned, _pattern(prefixes), i) for i in (1, 2))
    return F.when(digits != "", F.concat_ws("-", prefix, F.lpad(digits, 3, "0")))


def _cleaned(c):
    """In capitals, without blanks and dots."""
    return F.replace(F.replace(F.upper(strip(c)), F.lit(" "), F.lit("")), F.lit("."), F.lit(""))


def is_unit(c):
    """Whether the normalised text will be a valid unit: one test on the raw text, so a
    filter need not normalise every row first."""
    return _cleaned(c).rlike(_pattern(PREFIXES))


def normalize_eco(c, prefixes=PREFIXES):
    """Canonical key; notes such as ``(JW)`` are dropped, other text is kept cleaned."""
    cleaned = _cleaned(c)
    return F.coalesce(_canonical(cleaned, prefixes), cleaned)


def normalize_eco_lzc(c):
    """Canonical key that keeps the LZC site suffix."""
    upper = F.upper(strip(c))
    text = F.translate(upper, ".", "")
    bare = F.translate(F.replace(text, F.lit("LZC"), F.lit("")), " ", "")
    suffix = F.when(text.contains("LZC"), F.lit(" LZC")).otherwise(F.lit(""))
    return F.coalesce(F.concat(_canonical(bare), suffix), upper)


def eco_key(c):
    """Join key: letters and digits only."""
    return F.regexp_replace(F.upper(c), "[^A-Z0-9]", "")


def eco_light(c):
    return F.translate(F.upper(strip(c)), " ", "")


def eco_master_format(c):
    """Key as the master catalogue writes it; null where the text is no unit number."""
    text = F.upper(strip(c))
    dashed = F.regexp_replace(text, r"^(AU|CA)-?", "$1-")
    spaced = F.regexp_replace(dashed, r"(?<! )LZC$", " LZC")
    return F.when(text.rlike(_MASTER), spaced)


def plate_key(c):
    plate = F.translate(F.upper(strip(c)), " -", "")
    return F.when((plate != "") & (plate != "NAN"), plate)


def is_valid_eco(c, lzc=False):
    return c.rlike(VALID_LZC if lzc else VALID)

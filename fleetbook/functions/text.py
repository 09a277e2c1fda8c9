"""Text clean-up: Column in, Column out."""

import json
import unicodedata

from pyspark.sql import functions as F

from ..vocabulary import NO_COMPANY

# Every character that counts as white space when text is stripped.
_SPACES = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def strip(c):
    """Text without white space at its ends. Where it starts and ends in plain ASCII signs, as
    nearly all texts do, nothing is searched for; the search takes many times as long."""
    c = c.cast("string")
    bare = (c >= "!") & (c < "\x7f") & F.substring(c, -1, 1).between("!", "~")
    return F.when(bare, c).otherwise(F.btrim(c, F.lit(_SPACES)))


def blank_to_null(c):
    """Null, blank and the text ``nan`` all count as missing."""
    text = strip(c)
    return F.when((text != "") & (F.lower(text) != "nan"), text)


def strip_float(c):
    """Drop the ``.0`` a numeric column left behind; missing becomes empty text."""
    text = F.regexp_replace(c, r"\.0$", "")
    return F.coalesce(F.when(text != "nan", strip(text)), F.lit(""))


def drop_trailing_dots(c):
    return F.regexp_replace(c, r"\.+$", "")


_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def normalize_card(c):
    """Card number as text. Whole numbers lose their decimals; decimal arithmetic
    keeps all digits of 16-digit cards."""
    text = drop_trailing_dots(strip(c))
    plain = F.regexp_replace(text, ",", "")
    number = F.when(plain.rlike(_NUMBER), plain.try_cast("decimal(38,6)"))
    whole = number.cast("decimal(32,0)")
    return (
        F.when((text == "") | (F.lower(text) == "nan"), None)
        .when(number == whole, whole.cast("string"))
        .otherwise(text)
    )


def clean_tag(c):
    """Toll tag: no spaces, no trailing dots; 8 digits get the issuer prefix."""
    tag = drop_trailing_dots(F.translate(strip(c), " ", ""))
    return F.when(tag.rlike(r"^\d{8}$"), F.concat(F.lit("IMDM"), tag)).otherwise(tag)


def product_type(c):
    """Fuel name without brand; MAGNA is sold as REGULAR."""
    name = F.regexp_replace(F.upper(strip(c)), r"^ARCO\s+", "")
    return F.when(name == "MAGNA", F.lit("REGULAR")).otherwise(name)


def sanitize_path(c, default=NO_COMPANY):
    """Text that is safe as one folder name."""
    text = strip(F.coalesce(c, F.lit("")))
    text = F.regexp_replace(text, r"[\\/]+", "-")
    text = F.regexp_replace(text, r"\s+", "_")
    text = F.regexp_replace(text, r"[^A-Za-z0-9._-]", "")
    return F.when(text == "", F.lit(default)).otherwise(text)


def _decompositions():
    """What every character beyond ASCII leaves of its compatibility decomposition in ASCII:
    (characters with one letter, those letters, {character: several letters})."""
    source, target, several = [], [], {}
    for code in range(0x80, 0x20000):  # no character beyond leaves any ASCII
        if 0xD800 <= code < 0xE000:
            continue
        plain = unicodedata.normalize("NFKD", chr(code)).encode("ascii", "ignore").decode()
        if len(plain) == 1 and code < 0x10000:
            source.append(chr(code))
            target.append(plain)
        elif plain:
            several[chr(code)] = plain
    return "".join(source), "".join(target), several


_ACCENTED, _PLAIN, _SEVERAL = _decompositions()


def _spelled_out(c):
    """Ligatures, fractions, unit signs and letters beyond the basic plane as their letters. Only
    texts that may hold one are taken apart."""
    table = F.from_json(F.lit(json.dumps(_SEVERAL)), "map<string,string>")
    letters = F.regexp_extract_all(c, F.lit("(?s)."), F.lit(0))
    spelled = F.array_join(F.transform(letters, lambda x: F.coalesce(F.try_element_at(table, x), x)), "")
    held = "[\\u00BC-\\u00BE\\u0132\\u0133\\u01C4-\\u01CC\\u01F1-\\u01F3]|[^\\x00-\\u024F]"
    return F.when(c.rlike(held), spelled).otherwise(c)


def header_key(c):
    """Column name reduced to ``[a-z0-9]``: accents, case, signs and compatibility forms do not
    matter."""
    return F.regexp_replace(F.lower(F.translate(_spelled_out(c), _ACCENTED, _PLAIN)), "[^a-z0-9]", "")


def loose_header(c):
    """Weaker reduction used by the toll export: lower case without blanks and dots."""
    return F.translate(F.lower(c), "ó .", "o")


def company_from_text(c):
    """Company shown on an account card: the first line with text, or the second one
    where the first holds the client number."""
    lines = F.filter(
        F.transform(F.split(F.coalesce(c, F.lit("")), r"\r\n|\r|\n"), strip), lambda x: x != ""
    )
    first = F.get(lines, F.lit(0))
    second = F.get(lines, F.lit(1))
    is_number = F.upper(first).rlike("^N[ÚU]MERO DE CLIENTE")
    return F.coalesce(F.when(is_number, second), first, F.lit(NO_COMPANY))

"""Dates: parsing ladders, calendar parts, month arithmetic and range predicates."""

import datetime as dt

from pyspark.sql import functions as F

from ..vocabulary import DAY_NAMES, MONTH_NAMES
from .text import strip

# How the parts of a date that starts with one or two digits are put in ISO order.
_SHORT_FIRST = r"^(\d+)-(\d+)-(\d{4})(?!\d)"
_REWRITES = {"dmy": "$3-$2-$1", "mdy": "$3-$1-$2"}


# Two-digit years belong to 1969 to 2068, as in the usual two-digit format.
_SHORT_YEARS = ((r"^(\d{1,2}-\d{1,2}-)(69|[7-9]\d)(?!\d)", "$119$2"), (r"^(\d{1,2}-\d{1,2}-)(\d{2})(?!\d)", "$120$2"))
_HALF_DAY = r"(?i)^(.*?)(\d{1,2})(:\d{2}(?::\d{2})?)\s*([ap])\.?\s?m\.?$"
_NAMED_MONTH = r"(?i)^(\d{1,2})[- ]([a-z]{3})[a-z]*\.?[- ](\d{2,4})(.*)$"
_MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def _let(value, body):
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _four_digits(text):
    for pattern, full in _SHORT_YEARS:
        text = F.regexp_replace(text, pattern, full)
    return text


def _numbered_month(text):
    """``05-mar-2025`` in ISO order, other texts as they are."""
    numbers = F.create_map(*[v for i, m in enumerate(_MONTHS, 1) for v in (F.lit(m), F.lit(f"{i:02d}"))])
    part = [F.regexp_extract(text, _NAMED_MONTH, k) for k in range(5)]
    year = F.when(F.length(part[3]) == 2, F.concat(F.when(part[3] >= "69", "19").otherwise("20"), part[3])).otherwise(part[3])
    iso = F.concat(year, F.lit("-"), F.try_element_at(numbers, F.lower(part[2])), F.lit("-"), F.lpad(part[1], 2, "0"), part[4])
    return F.when(part[0] != "", F.coalesce(iso, text)).otherwise(text)


def _full_day(text):
    """Times with AM or PM as hours from 0 to 23, other texts as they are."""
    part = [F.regexp_extract(text, _HALF_DAY, k) for k in range(5)]
    hour = part[2].try_cast("int")
    clock = F.when(hour.between(1, 12), F.lpad(
        (hour % 12 + F.when(F.lower(part[4]) == "p", 12).otherwise(0)).cast("string"), 2, "0"))
    return F.when(part[0] != "", F.concat(part[1], clock, part[3])).otherwise(text)


def _read(text, orders):
    first = F.instr(text, "-")
    readings = []
    for order in orders:
        if order == "ymd":
            readings.append(F.when(first == 5, text.try_cast("timestamp_ntz")))
        else:
            iso = F.regexp_replace(text, _SHORT_FIRST, _REWRITES[order])
            readings.append(F.when(first.isin(2, 3), iso.try_cast("timestamp_ntz")))
    return F.coalesce(*readings)


def _at(c, start, length):
    return F.substring(c, start, length)


def _read_usual(c, orders):
    """What ``_read`` finds for ``1997/03/05…`` and ``05/03/1997``, put in order by the places of
    their parts alone; null for every other text. Nearly all rows are of these forms, and
    the patterns of the full reading take many times as long."""
    def split_at(first, second):
        return _at(c, first, 1).isin("-", "/") & _at(c, second, 1).isin("-", "/")

    dash, found = F.lit("-"), []
    if "ymd" in orders:
        rest = F.substring(c, 9, 1 << 20)
        iso = F.concat(_at(c, 1, 4), dash, _at(c, 6, 2), dash, rest)
        found.append(F.when(split_at(5, 8) & ~rest.contains("/"), iso.try_cast("timestamp_ntz")))
    # The time keeps the cast from skipping a blank behind the last part.
    short = [F.concat(_at(c, 7, 4), dash, *parts, F.lit(" 00:00:00")).try_cast("timestamp_ntz") for parts in [
        {"dmy": (_at(c, 4, 2), dash, _at(c, 1, 2)), "mdy": (_at(c, 1, 2), dash, _at(c, 4, 2))}[o] for o in orders if o != "ymd"]]
    if short:
        found.append(F.when((F.length(c) == 10) & split_at(3, 6), F.coalesce(*short)))
    return found


def parse_timestamp(c, *orders):
    """First reading, in the given orders, that is a real date; else null. Years may have
    two digits, months English names, times AM or PM.

    Each row is read on its own, so one odd row never changes how the others are
    understood, and ISO text is never read day first. The place of the first separator
    tells the orders apart, so a text is only parsed by those that can apply; only texts
    with letters go the longer way.
    """
    text = F.translate(strip(c), "/", "-")
    worded = _let(text, lambda t: _let(_numbered_month(t), lambda u: _let(
        _four_digits(_full_day(u)), lambda w: _read(w, orders))))
    return F.coalesce(*_read_usual(c, orders), _read(_four_digits(text), orders), F.when(text.rlike("[A-Za-z]{2}|[A-Za-z][.]"), worded))


def parse_date_ladder(c):
    """Year first, then day first, then month first."""
    return parse_timestamp(c, "ymd", "dmy", "mdy")


def parse_dayfirst(c):
    return parse_timestamp(c, "dmy", "ymd", "mdy")


def parse_ts_fixed(c):
    """``yyyy/MM/dd HH:mm:ss`` and nothing else."""
    text = F.when(c.rlike(r"^\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"), c)
    return parse_timestamp(text, "ymd")


def _name(names, position):
    return F.get(F.array(*[F.lit(n) for n in names]), position - 1)


def month_name(month):
    """``Enero``; numbers out of range stay as text."""
    return F.coalesce(_name(MONTH_NAMES, month), month.cast("string"))


def month_title(ym):
    """``2026-01`` to ``Enero 2026``; other text is kept."""
    parts = F.split(ym, "-")
    name = _name(MONTH_NAMES, F.get(parts, F.lit(1)).try_cast("int"))
    title = F.concat_ws(" ", F.coalesce(name, F.get(parts, F.lit(1))), F.get(parts, F.lit(0)))
    return F.when(F.size(parts) == 2, title).otherwise(ym)


def month_label(month):
    """``01 - Enero``; null where there is no month."""
    return F.concat(F.lpad(month.cast("string"), 2, "0"), F.lit(" - "), _name(MONTH_NAMES, month))


def day_name(c):
    """Spanish weekday, empty where there is no date."""
    return F.coalesce(_name(DAY_NAMES, F.weekday(c) + 1), F.lit(""))


def year_month(c):
    return F.date_format(c, "yyyy-MM")


def week_of_month(c):
    return F.coalesce(F.floor((F.dayofmonth(c) - 1) / 7).cast("int") + 1, F.lit(0))


def hour_fraction(c):
    return F.hour(c) + F.minute(c) / F.lit(60.0)


def is_ytd(year, month, as_of):
    """Earlier years, and this year up to the month of ``as_of``."""
    current = (year == as_of.year) & (month <= as_of.month)
    return F.coalesce(current | (year < as_of.year), F.lit(False))


def in_kpi(month, as_of):
    return F.coalesce(month <= as_of.month, F.lit(False))


def month_start(year, month):
    """First day of a month; month 13 is January of the next year."""
    return dt.date(year + (month - 1) // 12, (month - 1) % 12 + 1, 1)


def between(c, start, end):
    """Half-open range: reaches the Parquet scan, unlike ``year(c) = k``."""
    return (c >= F.lit(start)) & (c < F.lit(end))


def in_year(c, year):
    return between(c, month_start(year, 1), month_start(year + 1, 1))


def in_month(c, year, month):
    return between(c, month_start(year, month), month_start(year, month + 1))


def months_between_dates(start, end):
    """(year, month) of every month touched by start..end, both included."""
    if start > end:
        raise ValueError("the first date is after the last one")
    first, last = start.year * 12 + start.month - 1, end.year * 12 + end.month - 1
    return [(m // 12, m % 12 + 1) for m in range(first, last + 1)]


def months_to_date(today):
    return months_between_dates(dt.date(today.year, 1, 1), today)


def months_of_last_year(today):
    return [(today.year - 1, m) for m in range(1, 13)]


def month_sequence(start, end):
    """Array with the first day of every month from start to end."""
    return F.sequence(F.trunc(start, "month"), F.trunc(end, "month"), F.expr("interval 1 month"))


def period_to_month(c, target_months):
    """First target month (yyyymm) covered by a billing period written in Spanish.

    ``DEL 16 DE DICIEMBRE AL 15 DE ENERO DEL 1997`` runs from December 1996 to January
    1997: the year belongs to the end, and a start month after the end month lies in
    the year before.
    """
    text = F.upper(c)
    end_year = F.try_element_at(F.regexp_extract_all(text, F.lit(r"\b(\d{4})\b")), F.lit(-1))
    endings = F.regexp_extract_all(text, F.lit(r"(\w+\s+DEL\s+\d{4})"))
    ending = F.get(F.filter(endings, lambda x: x.endswith(end_year)), F.lit(0))
    numbers = F.create_map(*[v for i, n in enumerate(MONTH_NAMES, 1) for v in (F.lit(n.upper()), F.lit(i))])
    end_month = F.try_element_at(numbers, F.regexp_extract(ending, r"^(\w+)", 1))
    start_name = F.regexp_extract(text, r"DEL\s+\d+\s+(?:DE\s+)?(\w+)", 1)
    start_month = F.coalesce(F.try_element_at(numbers, start_name), end_month)
    year = end_year.cast("int")
    start_year = F.when(start_month <= end_month, year).otherwise(year - 1)
    targets = F.array(*[F.lit(y * 100 + m) for y, m in sorted(target_months)])
    first, last = start_year * 100 + start_month, year * 100 + end_month
    return F.get(F.filter(targets, lambda t: (t >= first) & (t <= last)), F.lit(0))

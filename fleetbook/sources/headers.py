"""Header discovery and column resolution on raw rows ``(path, row_idx, cells)``.

A header frame has one row per file: ``path``, ``header_row``, ``header`` and the
positions of the columns found. Rows then read their cells by position. Header frames are
written once (``session.stored``) before rows are joined with them: Spark then knows how small
they are, and the raw rows are neither shuffled by path (a task per file) nor searched again.
"""

from functools import reduce

from pyspark.sql import functions as F

from ..functions.text import header_key, loose_header, strip
from ..session import stored


def dedupe_headers(header):
    """Repeated names get ``__dup2``, ``__dup3``… in order."""
    def rename(name, i):
        earlier = F.size(F.filter(F.slice(header, F.lit(1), i), lambda other: other == name))
        return F.when(earlier == 0, name).otherwise(
            F.concat(name, F.lit("__dup"), (earlier + 1).cast("string")))
    return F.transform(header, rename)


def extend_header(header, width):
    """Names ``__extra_col_n`` for cells beyond the header."""
    extra = F.transform(
        F.sequence(F.lit(1), F.greatest(width - F.size(header), F.lit(1))),
        lambda n: F.concat(F.lit("__extra_col_"), n.cast("string")))
    return F.when(width > F.size(header), F.concat(header, extra)).otherwise(header)


def own_headers(raw):
    """Header frame of files whose first record is the header: its unique, stripped names."""
    own = raw.filter("row_idx = 0").groupBy("path").agg(F.first("cells", ignorenulls=True).alias("own"))
    return own.filter("own is not null").select(
        "path", F.lit(0).cast("bigint").alias("header_row"),
        F.transform(dedupe_headers(F.col("own")), strip).alias("header"))


def first_row_headers(raw):
    """Header frame of files whose first record is the header: unique, stripped names,
    and ``kept``, the positions of all columns except extra ones that are blank in
    every row. Reading ``raw`` twice is cheap where it is stored (see ``ragged.land``)."""
    headers = stored(own_headers(raw), "headers").withColumn("own_width", F.size("header"))
    # Only rows longer than their header hold extra cells, and only those cells are looked at;
    # their distinct positions are at most the file's width.
    extra = F.slice("cells", F.col("own_width") + 1, F.size("cells"))
    beyond = (
        raw.join(headers.select("path", "own_width"), "path")
        .filter("row_idx > 0 and size(cells) > own_width")
        .select("path", "own_width", F.posexplode(extra).alias("pos", "cell"))
        .groupBy("path", (F.col("own_width") + F.col("pos")).alias("pos"))
        .agg(F.max(strip(F.col("cell")) != "").alias("filled"))
        .groupBy("path").agg(
            (F.max("pos") + 1).alias("width"),
            F.sort_array(F.collect_list(F.when(F.col("filled"), F.col("pos")))).alias("filled"))
    )
    found = headers.join(beyond, "path", "left")
    names = extend_header(F.col("header"), F.coalesce("width", "own_width"))
    own = F.when(F.col("own_width") > 0, F.sequence(F.lit(0), F.col("own_width") - 1))
    none = F.array().cast("array<int>")
    return found.select(
        "path", "header_row", names.alias("header"), F.concat(F.coalesce(own, none), F.coalesce("filled", none)).alias("kept"))


def marker_headers(raw, marker):
    """Header frame: the first row with a cell equal to ``marker``, found in one pass. Only rows
    whose text holds it have their cells stripped one by one."""
    names, held = F.transform("cells", strip), F.array_join("cells", " ").contains(marker)
    found = raw.filter(held & F.array_contains(names, marker)).select("path", "row_idx", names.alias("header"))
    return found.groupBy("path").agg(F.min(F.struct("row_idx", "header")).alias("h")).select(
        "path", F.col("h.row_idx").alias("header_row"), "h.header")


_TOP = 100  # rows of a file in which its header nearly always stands
_NAMED = 1000


def sought_headers(raw, find, *args):
    """The header frame ``find(raw, *args)``, written once, where ``find`` takes a file's first row that
    fits. It is sought in the first rows of all files, of which stored raw rows (``ragged.land``)
    are read by their number, then in all rows of the files that are left."""
    top = stored(find(raw.filter(F.col("row_idx") < _TOP), *args), "headers")
    lost = raw.select("path").distinct().join(top.select("path"), "path", "left_anti")
    names = [r.path for r in lost.limit(_NAMED + 1).collect()]
    if not names:
        return top
    rest = raw.filter(F.col("path").isin(names)) if len(names) <= _NAMED else raw.join(lost, "path", "left_semi")
    return top.unionByName(stored(find(rest, *args), "headers"))


def fixed_headers(raw, row):
    """Header frame: the header stands in one known row (0-based)."""
    return raw.filter(F.col("row_idx") == row).select(
        "path", F.col("row_idx").alias("header_row"), F.transform("cells", strip).alias("header"))


def with_header(raw, find, *args):
    """The raw rows again; fails when read if ``find(raw, *args)`` names no header row for
    some file. Without it such a file would give no rows and no sign of it."""
    starts = raw.groupBy("path").agg(F.min("row_idx").alias("row_idx"))
    lost = starts.join(find(raw, *args).select("path", F.lit(True).alias("found")), "path", "left")
    told = lost.select("path", "row_idx", F.when(F.col("found").isNull(), F.raise_error(
        F.concat(F.lit("no header row in "), "path"))).cast("string").alias("_lost"))
    return raw.join(told, ["path", "row_idx"], "left").filter("_lost is null").drop("_lost")


def required_headers(raw, find, *args):
    """The header frame ``find(raw, *args)``, written once; fails at once, naming a file, if a
    file has no row in it. One path reaches the driver."""
    headers = stored(find(raw, *args), "headers")
    lost = raw.select("path").distinct().join(headers.select("path"), "path", "left_anti").first()
    if lost:
        raise ValueError(f"no header row in {lost['path']}")
    return headers


def keyword_headers(raw, plate_words=("placa",), tag_words=("tag", "identificador", "tarjeta"), rows=10):
    """Header frame with ``plate_pos`` and ``tag_pos``. The header is the first record, or
    one of the next ``rows``, that names both a plate and a tag column. In files without
    one the plate is taken from the second column and the tag from the last."""
    words = F.transform("cells", lambda c: F.lower(strip(F.coalesce(c, F.lit("")))))

    def position(keys):
        hit = F.transform(F.col("words"), lambda w: reduce(
            lambda a, b: a | b, [w.contains(k) for k in keys]))
        return F.nullif(F.array_position(hit, True), F.lit(0)) - 1

    top = raw.filter(F.col("row_idx") <= rows).select("path", "row_idx", words.alias("words"))
    top = top.withColumns({"plate_pos": position(plate_words), "tag_pos": position(tag_words)})
    named = top.filter("plate_pos is not null and tag_pos is not null")
    first = named.groupBy("path").agg(
        F.min(F.struct("row_idx", "plate_pos", "tag_pos")).alias("h")).select("path", "h.*")
    width = F.size("words")
    start = top.filter("row_idx = 0").select(
        "path", F.when(width >= 3, 1).alias("second"), F.when(width >= 3, width - 1).alias("last"))
    return start.join(first, "path", "left").select(
        "path", F.coalesce("row_idx", F.lit(0)).cast("bigint").alias("header_row"),
        F.coalesce("plate_pos", "second").cast("int").alias("plate_pos"),
        F.coalesce("tag_pos", "last").cast("int").alias("tag_pos"))


def rows_below(raw, headers):
    """Data rows with their file's header columns."""
    return raw.join(headers, "path").filter("row_idx > header_row")


def cell(position, default=None):
    """Cell at a 0-based position; null where the file has no such column. Rows that end
    early read as ``default``."""
    value = F.get("cells", position)
    return value if default is None else F.when(position.isNotNull(), F.coalesce(value, F.lit(default)))


def _position(names, test):
    return F.nullif(F.array_position(F.transform(names, test), True), F.lit(0)).cast("int") - 1


def _first_found(names, tests):
    return F.coalesce(*[_position(names, test) for test in tests])


def _contains(text):
    return lambda name: name.contains(text)


def _equals(text):
    return lambda name: name == text


def find_contains(header, *candidates):
    """Position of the first column whose loosely reduced name contains the first
    candidate that occurs at all."""
    return _first_found(F.transform(header, loose_header), [_contains(c) for c in candidates])


def find_either(header, contains=(), equal=()):
    """Position of the first column whose loosely reduced name contains one of the first
    texts or equals one of the second."""
    tests = [_contains(c) for c in contains] + [_equals(c) for c in equal]
    return _position(F.transform(header, loose_header), lambda name: reduce(
        lambda a, b: a | b, [test(name) for test in tests]))


def find_exact(header, *candidates):
    """Position of the column equal to the first candidate found, accents, case and
    signs aside."""
    names = F.transform(header, header_key)
    return _first_found(names, [_equals(header_key(F.lit(c))) for c in candidates])


def find_equal(header, *names):
    """Position of the first of ``names`` that occurs literally."""
    return _first_found(header, [_equals(F.lit(n)) for n in names])


def find_eco(header):
    """Position of the unit column: ``ECO``, else some spelling of *No. económico*."""
    names = F.transform(header, header_key)
    return _first_found(names, [
        _equals(F.lit("eco")),
        lambda n: (n == "numeroeconomico") | (n.contains("economico") & n.contains("no")),
    ])


def preamble_value(raw, label, rows=5):
    """(path, value): of the first rows, the first whose first filled cell contains
    ``label`` gives its second filled cell, trimmed and in capitals."""
    filled = F.filter("cells", lambda c: c.isNotNull() & (strip(c) != ""))
    hits = (
        raw.filter(F.col("row_idx") < rows)
        .select("path", "row_idx", filled.alias("f"))
        .filter((F.size("f") >= 2) & F.get("f", F.lit(0)).contains(label))
        .select("path", "row_idx", F.upper(strip(F.get("f", F.lit(1)))).alias("value"))
    )
    return hits.groupBy("path").agg(F.min_by("value", "row_idx").alias("value"))

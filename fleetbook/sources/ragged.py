"""Ragged delimited files to rows ``(path, row_idx, cells)`` without losing a cell.

Every file may have its own delimiter, encoding and width, so files are not read into
one schema: cells stay an array until the header of their file is resolved.

All files are read by one rule, whatever their size and wherever they are split. The scan's
lines are packed into pieces. Per piece it is found how many records start in it and whether
a quoted cell is open at its end, both for a start outside and inside a quoted cell. Running
sums over these few numbers give each piece its true start and first row number, and a record
that runs on past its piece the text that completes it. Then every piece is parsed alone.
Pieces without a quote are cut at their line ends and delimiters, all lines at once.
"""

import csv
import io
import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import scratch_dir

RAW_SCHEMA = "path string, row_idx bigint, cells array<string>"
_ARROW = pa.schema([("path", pa.string()), ("row_idx", pa.int64()), ("cells", pa.list_(pa.string()))])
_DELIMITERS = ",;\t|"
_SAMPLE = 8192
_HEAD_BYTES = 4 * _SAMPLE  # a character has at most four bytes
_CHUNK = 5000
_PIECE = 1 << 20
_CELL_LIMIT = 131072
_NAMED = 10_000  # files that are named to the scan, so that it opens no others
PROBLEM = -1  # row number of what is wrong with a file, where problems do not fail the job


def _dialect(sample):
    try:
        found = csv.Sniffer().sniff(sample, delimiters=_DELIMITERS)
    except csv.Error:
        found = csv.excel
    return found.delimiter, found.quotechar or '"', bool(found.skipinitialspace)


def _is_blank(cells):
    return not cells or (len(cells) == 1 and not cells[0].strip())


def _batches(rows, schema):
    while chunk := list(itertools.islice(rows, _CHUNK)):
        columns = zip(*chunk)
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _runs(batch):
    """(path, block, lines with their ends) of each run of lines of one block."""
    path, block = batch.column("path").dictionary_encode(), batch.column("block").to_numpy()
    index, lines = path.indices.to_numpy(), batch.column("line").to_pylist()
    edges = np.flatnonzero((np.diff(index) != 0) | (np.diff(block) != 0)) + 1
    for lo, hi in itertools.pairwise([0, *edges.tolist(), len(lines)]):
        if hi > lo:
            yield path.dictionary[index[lo]].as_py(), int(block[lo]), b"\n".join(lines[lo:hi]) + b"\n"


def _pieces(batches):
    """(path, block, piece, bytes): consecutive lines of one block of the scan, about 1 MB
    each. A block's lines come in order and in one task."""
    key, piece, held, size = None, 0, [], 0
    for path, block, data in itertools.chain.from_iterable(map(_runs, batches)):
        if key != (path, block) or size >= _PIECE:
            if held:
                yield *key, piece, b"".join(held)
            piece = piece + 1 if key == (path, block) else 0
            key, held, size = (path, block), [], 0
        held.append(data)
        size += len(data)
    if held:
        yield *key, piece, b"".join(held)


_PACKED = pa.schema([
    ("path", pa.string()), ("block", pa.int64()), ("piece", pa.int64()), ("data", pa.binary())])


def _pack(batches):
    for path, block, piece, data in _pieces(batches):
        yield pa.record_batch([[path], [block], [piece], pa.array([data], pa.binary())], schema=_PACKED)


def _is_utf8(data):
    try:
        data.decode("utf-8")
    except UnicodeDecodeError:
        return False
    return True


_DESCRIBED = pa.schema([
    ("path", pa.string()), ("block", pa.int64()), ("piece", pa.int64()), ("latin", pa.bool_()),
    ("head", pa.binary()), ("problem", pa.string())])


def _describe(strict):
    """Per piece whether it is UTF-8, and its first bytes where they may be the file's."""
    def describe(batches):
        def rows():
            for batch in batches:
                for values in zip(*(batch.column(c) for c in _PACKED.names)):
                    path, block, piece, data = (x.as_py() for x in values)
                    problem = "not a text file" if b"\0" in data else None
                    if problem and strict:
                        raise ValueError(f"{path}: {problem}")
                    first = piece == 0 and block < _HEAD_BYTES
                    yield path, block, piece, not _is_utf8(data), data[:_HEAD_BYTES] if first else None, problem
        yield from _batches(rows(), _DESCRIBED)
    return describe


def _add_dialect(batches):
    """Delimiter, quote and blank handling of each file from its first characters."""
    for batch in batches:
        found = []
        for head, latin in zip(batch.column("head").to_pylist(), batch.column("latin").to_pylist()):
            data = b"".join(h["head"] for h in head)[:_HEAD_BYTES]
            # UTF-8 first: Latin-1 accepts any bytes and would hide accents.
            text = data.decode("latin-1") if latin else data.decode("utf-8-sig", errors="ignore")
            found.append(_dialect(text[:_SAMPLE]))
        batch = batch.drop_columns(["head"])
        for i, (name, kind) in enumerate((
                ("delimiter", pa.string()), ("quotechar", pa.string()), ("skipspace", pa.bool_()))):
            batch = batch.append_column(name, pa.array([f[i] for f in found], kind))
        yield batch


def _text(path, block, piece, data, latin):
    text = data.decode("latin-1" if latin else "utf-8")
    return text.removeprefix("\ufeff") if block == 0 and piece == 0 else text


def _records(text, inside, delimiter, quotechar, skipspace):
    """(cells, lines read so far, lines of the record, whether it is still open at the end
    of the text). ``inside``: the text starts in a quoted cell."""
    ended = False

    def lines():
        nonlocal ended
        yield from io.StringIO(quotechar + text if inside else text, newline="")
        ended = True

    rows = csv.reader(lines(), delimiter=delimiter, quotechar=quotechar, skipinitialspace=skipspace)
    before = 0
    for cells in rows:
        yield cells, rows.line_num, rows.line_num - before, ended
        before = rows.line_num


def _counts(cells, lines, still_open, skip_blank):
    """Whether a record has a row number. Blank ones have none; a record with a quoted line
    break is not blank."""
    return not skip_blank or lines > 1 or still_open or not _is_blank(cells)


def _plain_lines(text, dialect, skip_blank):
    """The records of a text as lines, where no line needs the parser: without a quote every
    line is a record and every delimiter ends a cell. Else None."""
    delimiter, quotechar, skipspace = dialect
    if skipspace or quotechar in text or "\r" in text or not text.endswith("\n"):
        return None
    lines = text.split("\n")
    lines.pop()
    if skip_blank:
        lines = [line for line in lines if line and (not line.isspace() or delimiter in line)]
    elif "" in lines:  # a record without cells
        return None
    return lines if max(map(len, lines), default=0) <= _CELL_LIMIT else None


def _outside(text, dialect, skip_blank):
    """(records, open at the end, cell too long, records up to each line that ends one). The
    last is empty for texts without a quote, whose lines all end one."""
    lines = _plain_lines(text, dialect, skip_blank)
    if lines is not None:
        return len(lines), False, False, {}
    n, ends, still_open = 0, {}, False
    try:
        for cells, line, lines, still_open in _records(text, False, *dialect):
            n += _counts(cells, lines, still_open, skip_blank)
            if not still_open:
                ends[line] = n
    except csv.Error:
        return n, True, True, ends
    return n, still_open, False, ends


def _inside(text, dialect, skip_blank, outside):
    """(records, open at the end, cell too long, text up to the end of the open record,
    whether that is all). As soon as a record ends on a line where one also ends when read
    from outside, the rest is known."""
    total, open_outside, long_outside, ends = outside
    if dialect[1] not in text:
        return 0, True, len(text) > _CELL_LIMIT, text if len(text) <= _CELL_LIMIT else None, True
    n, lead = 0, None
    try:
        for cells, line, lines, still_open in _records(text, True, *dialect):
            if lead is None:
                if still_open:
                    return 0, True, False, text, True
                lead = "".join(itertools.islice(io.StringIO(text, newline=""), line))
            else:
                n += _counts(cells, lines, still_open, skip_blank)
            if still_open:
                return n, True, False, lead, False
            if line in ends:
                return n + total - ends[line], open_outside, long_outside, lead, False
    except csv.Error:
        return n, True, True, lead, lead is None
    return n, False, False, lead, False


_COUNTED = pa.schema([
    ("path", pa.string()), ("block", pa.int64()), ("piece", pa.int64()), ("latin", pa.bool_()),
    ("delimiter", pa.string()), ("quotechar", pa.string()), ("skipspace", pa.bool_()),
    ("n0", pa.int64()), ("end0", pa.int32()), ("long0", pa.bool_()),
    ("n1", pa.int64()), ("end1", pa.int32()), ("long1", pa.bool_()),
    ("lead", pa.string()), ("whole", pa.bool_()), ("problem", pa.string())])
_COUNTED_DDL = (
    "path string, block bigint, piece bigint, latin boolean, delimiter string, quotechar string, "
    "skipspace boolean, n0 bigint, end0 int, long0 boolean, n1 bigint, end1 int, long1 boolean, "
    "lead string, whole boolean, problem string")
_DIALECT = ("delimiter", "quotechar", "skipspace")


def _count(skip_blank):
    def count(batches):
        csv.field_size_limit(_CELL_LIMIT)

        def rows():
            names = ("path", "block", "piece", "data", "latin", "problem", *_DIALECT)
            for batch in batches:
                for path, block, piece, data, latin, problem, *dialect in zip(
                        *(batch.column(c) for c in names)):
                    path, block, piece, latin, problem = (x.as_py() for x in (path, block, piece, latin, problem))
                    dialect = [x.as_py() for x in dialect]
                    text = "" if problem else _text(path, block, piece, data.as_py(), latin)
                    outside = _outside(text, dialect, skip_blank)
                    inside = _inside(text, dialect, skip_blank, outside)
                    yield (path, block, piece, latin, *dialect, outside[0], int(outside[1]),
                           outside[2], inside[0], int(inside[1]), *inside[2:], problem)
        yield from _batches(rows(), _COUNTED)
    return count


def _starts(counted):
    """Per piece: whether it starts inside a quoted cell, its first row number, and the text
    after it that completes its last record. One row per piece is numbered per file."""
    order = Window.partitionBy("path").orderBy("block", "piece")
    before, upto = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(
        Window.unboundedPreceding, 0)
    # A piece keeps the state, flips it, or ends in a state of its own (it settles it).
    flips = F.expr("end0 = 1 and end1 = 0").cast("int")
    settles = F.col("end0") == F.col("end1")
    counted = counted.withColumns({
        "flips_upto": F.sum(flips).over(upto), "flips_before": F.coalesce(F.sum(flips).over(before), F.lit(0))})
    counted = counted.withColumn("settled", F.last(
        F.when(settles, F.struct("end0", "flips_upto")), ignorenulls=True).over(before))
    counted = counted.withColumn("inside", (
        (F.coalesce("settled.end0", F.lit(0)) + F.col("flips_before")
         - F.coalesce("settled.flips_upto", F.lit(0))) % 2 == 1))
    starts_record = ~F.col("inside") | ~F.col("whole")
    counted = counted.withColumns({
        "first": F.coalesce(F.sum(F.when(F.col("inside"), F.col("n1")).otherwise(F.col("n0"))).over(before), F.lit(0)),
        "owner": F.coalesce(F.sum(starts_record.cast("int")).over(before), F.lit(0)),
        "too_long": F.when(F.col("inside"), F.col("long1")).otherwise(F.col("long0"))})
    # The pieces that start inside the record of a piece come with the next owner number.
    following = Window.partitionBy("path").orderBy("owner").rangeBetween(1, 1)
    leads = F.collect_list(F.when(F.col("inside"), F.struct("block", "piece", "lead"))).over(following)
    rest = F.array_join(F.transform(F.array_sort(leads), lambda x: x.lead), "")
    return counted.select(
        "path", "block", "piece", "latin", *_DIALECT, "inside", "first", "too_long", rest.alias("rest"), "problem")


def _plain_batch(path, number, lines, delimiter):
    cells = pc.split_pattern(pa.array(lines, pa.string()), delimiter)
    numbers = pa.array(np.arange(number, number + len(lines), dtype=np.int64))
    return pa.record_batch([pa.repeat(pa.scalar(path, pa.string()), len(lines)), numbers, cells.cast(_ARROW.field("cells").type)], schema=_ARROW)


def _parse(skip_blank, strict):
    def rows(path, number, text, inside, dialect):
        records = _records(text, inside, *dialect)
        if inside:
            next(records, None)
        for cells, _, lines, still_open in records:
            if _counts(cells, lines, still_open, skip_blank):
                yield path, number, cells
                number += 1

    def parse(batches):
        csv.field_size_limit(_CELL_LIMIT)
        names = ("path", "block", "piece", "data", "latin", "inside", "first", "too_long", "rest", "problem", *_DIALECT)
        for batch in batches:
            for values in zip(*(batch.column(c) for c in names)):
                path, block, piece, data, latin, inside, number, too_long, rest, problem, *dialect = (
                    x.as_py() for x in values)
                if too_long and not problem:
                    problem = f"a cell of more than {_CELL_LIMIT} characters"
                    if strict:
                        raise ValueError(f"{path}: {problem}")
                if problem:
                    yield from _batches(iter([(path, PROBLEM, [problem])]), _ARROW)
                    continue
                text = _text(path, block, piece, data, latin) + rest
                lines = None if inside else _plain_lines(text, dialect, skip_blank)
                if lines is None:
                    yield from _batches(rows(path, number, text, inside, dialect), _ARROW)
                else:
                    yield _plain_batch(path, number, lines, dialect[0])
    return parse


def read_ragged(spark, path, skip_blank=True, suffixes=None, year=None, files=None, since=None, strict=True):
    """Raw rows of all files below ``path``, a folder, a file or a list of them. Row numbers
    count records with text (or, with ``skip_blank=False``, all records) from 0, the header's.

    ``suffixes`` (such as ``[".csv"]``) and ``year`` (a folder of that name) choose files
    before any is opened, as ``since`` does, a least modification time. ``files`` is a frame
    with the ``path`` of those whose rows are wanted, as ``_metadata.file_path`` has it. Up to
    10,000 are named to the scan, which leaves the others closed; of more it drops what it read.

    A quoted cell may hold line breaks; one of more than 131,072 characters, as an unclosed
    quote makes it, and a file that is not text fail the job. Where they shall not (``strict``
    false), such a file has rows of the number ``PROBLEM`` whose cell says what is wrong. A
    quoted cell that is open at the end of its file ends with a line break."""
    reader = spark.read.option("recursiveFileLookup", True).option("lineSep", "\n")
    if suffixes:
        reader = reader.option("pathGlobFilter", "*{" + ",".join(suffixes) + "}")
    lines = reader.text(path)
    if year is not None:
        lines = lines.filter(F.col("_metadata.file_path").contains(f"/{year}/"))
    if since is not None:
        lines = lines.filter(F.col("_metadata.file_modification_time") >= F.lit(since))
    if files is not None:
        names = [r.path for r in files.select("path").limit(_NAMED + 1).collect()]
        if len(names) <= _NAMED:
            lines = lines.filter(F.col("_metadata.file_path").isin(names))
    lines = lines.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("line"))
    keys = ["path", "block", "piece"]
    # One shuffle of the bytes in even pieces, which all three passes read again: the joins on
    # the keys would otherwise test them below the shuffle, and make it another one.
    pieces = lines.mapInArrow(_pack, "path string, block bigint, piece bigint, data binary")
    if files is not None and len(names) > _NAMED:
        pieces = pieces.join(files.select("path"), "path", "left_semi")
    pieces = pieces.filter("path is not null and block is not null and piece is not null").repartition(*keys)
    described = pieces.mapInArrow(
        _describe(strict), "path string, block bigint, piece bigint, latin boolean, head binary, problem string")
    # Heads come from the first 32 KB of a file only; of every piece its two numbers.
    heads = F.collect_list(F.when(F.col("head").isNotNull(), F.struct("block", "head")))
    found = described.groupBy("path").agg(
        F.bool_or("latin").alias("latin"), F.array_sort(heads).alias("head"), F.max("problem").alias("problem"),
        F.collect_list(F.struct("block", "piece")).alias("pieces"))
    found = found.mapInArrow(
        _add_dialect, "path string, latin boolean, problem string, pieces array<struct<block: bigint, piece: bigint>>, "
        "delimiter string, quotechar string, skipspace boolean")
    dialects = found.select("path", F.explode("pieces").alias("at"), "latin", "problem", *_DIALECT).select(
        "path", "at.block", "at.piece", "latin", "problem", *_DIALECT)
    counted = pieces.join(dialects, keys).mapInArrow(_count(skip_blank), _COUNTED_DDL)
    starts = _starts(counted)
    return pieces.join(starts, keys).mapInArrow(_parse(skip_blank, strict), RAW_SCHEMA)


def land(spark, raw):
    """The raw rows, written once. Headers are resolved in several passes over them;
    without this each pass would parse every file again."""
    path = scratch_dir(spark, "landed")
    raw.write.parquet(path)
    return spark.read.schema(RAW_SCHEMA).parquet(path)

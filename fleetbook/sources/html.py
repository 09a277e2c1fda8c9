"""Tables and tag links in HTML documents."""

import itertools
import re
import unicodedata
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import functions as F

from ..functions.text import drop_trailing_dots, strip
from ..operators.dedup import keep_first

BEST = "best"
_CHUNK = 5000


class _Tables(HTMLParser):
    """Collects (table, row cells) of a document; nested tables count on their own."""

    def __init__(self):
        super().__init__()
        self.rows, self.open, self.tables = [], [], 0

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.open.append({"table": self.tables, "row": None, "cell": None})
            self.tables += 1
        elif self.open and tag == "tr":
            self._end_row()
            self.open[-1]["row"] = []
        elif self.open and tag in ("td", "th") and self.open[-1]["row"] is not None:
            self._end_cell()
            self.open[-1]["cell"] = []

    def handle_endtag(self, tag):
        if not self.open:
            return
        if tag in ("td", "th"):
            self._end_cell()
        elif tag == "tr":
            self._end_row()
        elif tag == "table":
            self._end_row()
            self.open.pop()

    def handle_data(self, data):
        if self.open and self.open[-1]["cell"] is not None:
            self.open[-1]["cell"].append(data)

    def _end_cell(self):
        top = self.open[-1]
        if top["cell"] is not None:
            top["row"].append("".join(top["cell"]).strip())
            top["cell"] = None

    def _end_row(self):
        self._end_cell()
        top = self.open[-1]
        if top["row"] is not None:
            self.rows.append((top["table"], top["row"]))
            top["row"] = None

    def add_row(self, cells):
        """A row of the innermost table that starts and ends here."""
        self._end_row()
        self.rows.append((self.open[-1]["table"], cells))

    def close(self):
        super().close()
        while self.open:
            self._end_row()
            self.open.pop()


class _TagLinks(HTMLParser):
    """For each <div>: the text of its first tag link and the texts of its paragraphs."""

    def __init__(self):
        super().__init__()
        self.divs, self.open, self.link, self.para = [], [], None, None

    def handle_starttag(self, tag, attrs):
        if tag == "div":
            entry = {"link": None, "paras": []}
            self.divs.append(entry)
            self.open.append(entry)
        elif tag == "a" and "/uc/detalletag/" in (dict(attrs).get("href") or ""):
            self.link = []
        elif tag == "p":
            self.para = []

    def handle_endtag(self, tag):
        if tag == "div" and self.open:
            self.open.pop()
        elif tag == "a" and self.link is not None:
            for div in self.open:
                if div["link"] is None:
                    div["link"] = "".join(self.link)
            self.link = None
        elif tag == "p" and self.para is not None:
            for div in self.open:
                div["paras"].append("".join(self.para).strip())
            self.para = None

    def handle_data(self, data):
        for buffer in (self.link, self.para):
            if buffer is not None:
                buffer.append(data)

    def pairs(self):
        for i, div in enumerate(self.divs):
            if div["link"] is not None:
                unit = next((m.group(0) for m in map(re.compile(r"(AU|CA)-\d{3}").match, div["paras"]) if m), None)
                if unit:
                    yield i, unit, div["link"]


def _parse(document, parser):
    parser.feed(document or "")
    parser.close()
    return parser


# A tag without anything that needs the full parser, and the text behind it.
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)([^<>]*)>([^<]*)")
_PLAIN_ATTRIBUTES = re.compile(
    r"""(?:[ \t\n\r\f]+[a-zA-Z][a-zA-Z0-9_:-]*(?:=(?:"[^"]*"|'[^']*'|[^\s"'=`/]+))?)*[ \t\n\r\f]*""")
# What stands in these elements is no markup, or not always.
_INLINE = r"</?(?:b|i|u|em|strong|span)>"
_TEXT = rf"[^<]*(?:{_INLINE}[^<]*)*"
# A row of cells with text, at most marked up within a cell, and the text behind the row.
_PLAIN_ROW = re.compile(rf"<tr><t[dh]>({_TEXT}(?:</t[dh]><t[dh]>{_TEXT})*)</t[dh]></tr>[^<]*")
_BETWEEN, _MARKS = re.compile("</t[dh]><t[dh]>"), re.compile(_INLINE)
_RAW_TEXT = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext"}


def _unescaped(text):
    n = text.count("&")
    if not n:
        return text
    return text.replace("&amp;", "&") if n == text.count("&amp;") else unescape(text)


def _plain_cells(body):
    """The cells of a ``_PLAIN_ROW``, as the handlers would collect them."""
    cells = body.split("</td><td>") if "<t" not in body or "th>" not in body else _BETWEEN.split(body)
    if "&" in body or body.count("<") > 2 * len(cells) - 2:
        cells = ["".join([_unescaped(part) for part in _MARKS.split(cell)]) if "<" in cell else _unescaped(cell)
                 for cell in cells]
    return [cell.strip() for cell in cells]


def _feed_plainly(document, parser):
    """Hands the tags and texts of a document to the parser's handlers, in a fraction of the
    time that ``feed`` takes. What is more than plain tags and text (a comment, a stray ``<``,
    odd attributes) goes through ``feed`` until nothing of it is pending, so the outcome is
    that of ``feed`` for every document. Attributes and the text before the first tag are left
    out. Rows of plain cells are taken whole: a tag by itself takes as long as such a row. Yields
    now and then, so that rows need not pile up."""
    at, end, n = document.find("<"), len(document), 0
    while 0 <= at < end:
        found = document.startswith("<tr>", at) and _PLAIN_ROW.match(document, at)
        if found:
            if parser.open:
                parser.add_row(_plain_cells(found[1]))
            at, n = found.end(), n + 1
            if n % _CHUNK == 0:
                yield
            continue
        found = _PLAIN_TAG.match(document, at)
        closing, name, attributes, text = found.groups() if found else ("", "", "", "")
        name = name.lower()
        if not found or name in _RAW_TEXT or (
                attributes and (closing or not _PLAIN_ATTRIBUTES.fullmatch(attributes))):
            span = 64
            while at < end:
                stop = document.find("<", at + span)
                stop, span = stop if stop >= 0 else end, 2 * span
                parser.feed(document[at:stop])
                at = stop
                if not parser.rawdata and parser.cdata_elem is None:
                    break
            continue
        if closing:
            parser.handle_endtag(name)
        else:
            parser.handle_starttag(name, ())
        if text:
            parser.handle_data(unescape(text) if "&" in text else text)
        at, n = found.end(), n + 1
        if n % _CHUNK == 0:
            yield
    parser.close()
    yield


def _mapper(extract, schema):
    def run(batches):
        for batch in batches:
            found = (
                (path, *row)
                for path, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for row in extract(html))
            while chunk := list(itertools.islice(found, _CHUNK)):
                columns = zip(*chunk)
                yield pa.record_batch(
                    [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
    return run


def _table_rows(html, only=None):
    """(table, row_idx, cells) in the order in which rows end, as they are found."""
    parser, counts = _Tables(), {}
    for _ in _feed_plainly(html or "", parser):
        found, parser.rows = parser.rows, []
        for table, cells in found:
            if only is None or table == only:
                counts[table] = counts.get(table, -1) + 1
                yield table, counts[table], cells


def _unit_column(header):
    """As ``headers.find_eco``: the position of the unit column among these names, or None."""
    names = [re.sub("[^a-z0-9]", "", unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode().lower())
             for name in header]
    tests = (lambda n: n == "eco", lambda n: n == "numeroeconomico" or ("economico" in n and "no" in n))
    return next((i for test in tests for i, name in enumerate(names) if test(name)), None)


def _best_table_rows(html):
    """The rows of the best table, as ``tables.best_tables`` chooses it: all tables of a
    document are at hand, so nothing has to be counted over the rows of all documents."""
    tables, best, rank = {}, (), None
    for table, row_idx, cells in _table_rows(html):
        tables.setdefault(table, []).append((table, row_idx, cells))
    for table, rows in sorted(tables.items()):
        header = rows[0][2]
        unit = _unit_column(header)
        if unit is not None:
            units = sum(1 for _, _, cells in rows[1:] if unit < len(cells) and cells[unit])
            if rank is None or (units, len(header)) > rank:
                best, rank = rows, (units, len(header))
    return best


def html_table_rows(df, path, html, table=None):
    """Raw rows ``(path, table, row_idx, cells)`` of the tables in each document, of its n-th
    table only, or (``BEST``) of the one with most units, then most columns, then the first."""
    arrow = pa.schema([
        ("path", pa.string()), ("table", pa.int32()), ("row_idx", pa.int64()),
        ("cells", pa.list_(pa.string()))])
    extract = _best_table_rows if table == BEST else lambda document: _table_rows(document, table)
    return df.select(F.col(path).cast("string"), F.col(html)).mapInArrow(
        _mapper(extract, arrow), "path string, table int, row_idx bigint, cells array<string>")


def read_html_files(spark, path, suffixes=None, year=None, table=0, files=None, since=None):
    """Raw rows ``(path, row_idx, cells)`` of one table of each HTML file below ``path``, as
    vendors give them under spreadsheet names. Text is UTF-8 where it can be, else Latin-1.
    ``table`` is the table's number in its file, or ``BEST``: the one with most units.
    ``suffixes``, ``year`` and ``since`` (a least modification time) choose files before any is
    opened; ``files`` is a frame with the ``path`` of those that are wanted."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if suffixes:
        reader = reader.option("pathGlobFilter", "*{" + ",".join(suffixes) + "}")
    found = reader.load(path)
    if since is not None:
        found = found.filter(F.col("modificationTime") >= F.lit(since))
    if files is not None:
        found = found.join(files.select("path"), "path", "left_semi")
    if year is not None:
        found = found.filter(F.col("_metadata.file_path").contains(f"/{year}/"))
    utf8 = F.is_valid_utf8(F.col("content").cast("string"))
    text = F.when(utf8, F.col("content").cast("string")).otherwise(F.decode("content", "ISO-8859-1"))
    pages = found.select("path", text.alias("html"))
    return html_table_rows(pages, "path", "html", table).select("path", "row_idx", "cells")


def html_tag_pairs(df, path, html):
    """(ECO, tag) from blocks with a link to a tag and a paragraph that starts with a
    unit. The first block of a unit wins."""
    arrow = pa.schema([
        ("path", pa.string()), ("block", pa.int32()), ("ECO", pa.string()), ("tag", pa.string())])
    found = df.select(F.col(path).cast("string"), F.col(html)).mapInArrow(
        _mapper(lambda h: _parse(h, _TagLinks()).pairs(), arrow),
        "path string, block int, ECO string, tag string")
    clean = drop_trailing_dots(F.translate(strip(F.col("tag")), "\n ", ""))
    first = keep_first(found, ["ECO"], [F.col("path"), F.col("block")])
    return first.select("ECO", clean.alias("tag"))

"""Plain HTML is cut by one pattern; the outcome is that of the full parser."""

import random

from fleetbook.sources import html, tables


def _full(document):
    return html._parse(document, html._Tables()).rows


def _plain(document):
    return [(table, cells) for table, _, cells in html._table_rows(document)]


PIECES = [
    "<table>", "</table>", "<tr>", "</tr>", "<td>", "</td>", "<th>", "<TD >", "</td >", "<td/>", "<b>", "</b>", "<br/>",
    "x", " y ", "&amp;", "&am", "&", "&#65;", "1 < 2", "<", ">", "<!-- <td>no</td> -->", "<!--", "-->", "<!DOCTYPE html>",
    "<td class=a>", '<td title="a>b">', "<td title='<'>", "<td a=\"b\" c='d' e=f g>", "<td a=b/>", "</td x>", "<style>", "</style>",
    "<script>if (a<b) '<td>'</script>", "<td-x>", "<?pi <td>?>", "</ td>", "<\x00>", "ñ", "<td a =1>", "<td\n>", "<title>", "</title>",
    "<![CDATA[<td>]]>", "<textarea>", "<td a==\"1\">", "<td \"a\">", "</>"]


def test_same_rows_as_the_full_parser():
    rng = random.Random(5)
    for _ in range(30_000):
        document = "".join(rng.choice(PIECES) for _ in range(rng.randint(1, 25)))
        assert _plain(document) == _full(document), document
    long = "<table>" + "<tr><td>a<td>b &lt; c</tr>" * 9000 + "<!-- x -->" + "<tr><td>z</tr>" * 9000
    assert _plain(long) == _full(long)


ROW_PIECES = [
    "<table>", "</table>", "<tr><td>", "<tr><th>", "</td></tr>", "</th></tr>", "</td></tr>\n x", "</td><td>", "</th><td>", "</td><th>",
    "<b>", "</b>", "<span>", "<i", "x", " y ", "&amp;", "&am", "p;", "&", "th>", "<t", "<tr>", "<td>", "</td>", "<!-- ", "-->", "<a href=x>",
    "<title>", "</title>", "\n", "<TR><td>", "<td >"]


def test_rows_taken_whole_are_those_of_the_full_parser():
    rng, whole = random.Random(7), 0
    for _ in range(40_000):
        document = "".join(rng.choice(ROW_PIECES) for _ in range(rng.randint(1, 25)))
        whole += bool(html._PLAIN_ROW.search(document))
        assert _plain(document) == _full(document), document
    assert whole > 2000


def test_a_plain_row_takes_no_handler(monkeypatch):
    """Twelve tags of a row of five cells once took a call each."""
    calls = []
    monkeypatch.setattr(html._Tables, "handle_data", lambda self, data: calls.append(data))
    page = "<table>" + "<tr><td>AU-1</td><td><b>1</b> &amp; c</td><td> z</td></tr>\n" * 50 + "</table>"
    assert _plain(page) == [(0, ["AU-1", "1 & c", "z"])] * 50 and not calls


def test_plain_documents_never_reach_the_full_parser(monkeypatch):
    monkeypatch.setattr(html._Tables, "feed", None)
    page = '<html><table border=0 class="a b"><tr><th> A</th></tr><tr><td><b>1</b> &amp; c</td></tr></table></html>'
    assert _plain(page) == [(0, ["A"]), (0, ["1 & c"])]


def test_best_table_is_that_of_the_counts(spark):
    rng = random.Random(6)
    names = ["ECO", "eco.", "Importe", "No. Económico", "Número económico", "x", "", "Ｅｃｏ"]

    def table():
        width, size = rng.randint(1, 4), rng.randint(0, 4)
        rows = [[rng.choice(names) for _ in range(width)]] + [
            [rng.choice(["", " ", "AU-1"]) for _ in range(rng.randint(1, 4))] for _ in range(size)]
        return "<table>" + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows) + "</table>"

    pages = spark.createDataFrame(
        [(str(i), "".join(table() for _ in range(rng.randint(0, 4)))) for i in range(200)], "path string, html string")
    got = {tuple(map(str, r)) for r in html.html_table_rows(pages, "path", "html", table=html.BEST).collect()}
    want = tables.of_best_tables(html.html_table_rows(pages, "path", "html"))
    assert got == {tuple(map(str, r)) for r in want.select("path", "table", "row_idx", "cells").collect()} and got

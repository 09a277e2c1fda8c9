"""Readers: raw rows, headers, vendor exports, HTML, JSON and archive paths. Their inputs
are spelled out from the tables; where files are needed Spark writes them first."""

from pyspark.sql import functions as F

from fleetbook.functions.amounts import sum_cents
from fleetbook.plans import consolidate, tags, unify
from fleetbook.streaming import changed_files
from fleetbook.session import scratch_dir
from fleetbook.sources import archive, headers, html, maps, ragged, vendors

from . import views as v
from .registry import query
from .views_sql import LEDGER, cents_sum, norm_eco, norm_eco_lzc, parse_day, unit

_pfx, _num, _p3 = unit("s_suppkey")

# --- ragged files ---

_PASE_HEADER = "No. económico;Fecha de cruce;Importe al 100;Tarjeta IDMX"


def _write_lines(lines, header, path, *by):
    """Lines as text files, each starting with the header."""
    (lines.withColumnRenamed("line", header).write.partitionBy(*by)
     .option("header", True)
     .option("sep", "\x01").option("quote", "\x02").option("escapeQuotes", False)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("emptyValue", "").csv(path))


def _arrive(spark, written, place):
    """A folder that was written elsewhere, in its place."""
    source, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (written, place))
    files = source.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.rename(source, target):
        raise OSError(f"{written} does not go to {place}")


def _ragged_files(spark, sf):
    """Toll exports of uneven width: every third row has an extra cell, some cells are
    quoted and hold the delimiter."""
    raw = v.ledger_raw(spark, sf)
    extra = F.when(F.col("l_partkey") % 3 == 0, F.concat(F.lit(";x"), F.col("l_linenumber").cast("string"))).otherwise("")
    amount = F.when(F.col("l_partkey") % 2 == 0, F.concat(F.lit('"1;'), "importe_raw", F.lit('"'))).otherwise(F.col("importe_raw"))
    line = F.concat(F.concat_ws(";", "eco_raw", "fecha_raw", amount, F.lit("ñandú")), extra)
    path = scratch_dir(spark, "ragged")
    _write_lines(raw.select(line.alias("line"), "Sistema"), _PASE_HEADER, path, "Sistema")
    return path


_RAGGED = """
SELECT cells, count(*) AS n FROM (SELECT eco_raw || '|' || fecha_raw || '|' ||
  CASE WHEN l_partkey % 2 = 0 THEN '1;' ELSE '' END || importe_raw || '|ñandú' ||
  CASE WHEN l_partkey % 3 = 0 THEN '|x' || l_linenumber ELSE '' END AS cells FROM ledger_raw) GROUP BY ALL"""


def _cell_counts(raw):
    return raw.filter("row_idx > 0").groupBy(F.array_join("cells", "|").alias("cells")).agg(F.count("*").alias("n"))


@query("src_lossless_csv", _RAGGED)
def _(spark, sf):
    return _cell_counts(ragged.read_ragged(spark, _ragged_files(spark, sf)))


@query("src_lossless_lines", _RAGGED)
def _(spark, sf):
    return _cell_counts(ragged.read_ragged(spark, _ragged_files(spark, sf), skip_blank=False))


# --- raw rows by vendor ---


def _raw(path, row_idx, cells):
    return [path.alias("path"), row_idx.cast("bigint").alias("row_idx"), cells.alias("cells")]


def _words(*words):
    return F.array(*[F.lit(w) for w in words])


_FUEL = ["PLACAS", "FECHA", "PRODUCTO", "CANTIDAD", "IMPORTE", "IDENTIFICADOR"]


def _fuel_raw(spark, sf):
    return v.stored(spark, sf, "fuel_raw", _make_fuel_raw)


def _make_fuel_raw(spark, sf):
    """Fuel exports, one file per supplier, with one to three lines above the header."""
    s = v.table(spark, sf, "supplier")
    path = F.concat(F.lit("Supramax/f"), F.col("s_suppkey").cast("string"), F.lit(".csv"))
    top = s.select(*_raw(path, F.lit(0), _words("Reporte de consumos")))
    head = s.select(*_raw(path, 1 + F.col("s_suppkey") % 3, _words(" PLACAS ", *_FUEL[1:])))
    raw = v.ledger_raw(spark, sf)
    hour = F.lpad((F.col("l_partkey") % 24).cast("string"), 2, "0")
    moment = F.concat(F.date_format("l_shipdate", "yyyy/MM/dd"), F.lit(" "), hour, F.lit(":10:05"))
    cells = F.array(
        "eco_raw", moment, F.coalesce("tipo_raw", F.lit("DIESEL")),
        F.col("Cantidad").cast("string"), F.translate("importe_raw", "$,", ""), "tarjeta_raw")
    path = F.concat(F.lit("Supramax/f"), F.col("l_suppkey").cast("string"), F.lit(".csv"))
    return top.union(head).union(raw.select(*_raw(path, 10 + F.col("row_idx"), cells)))


_FUEL_SQL = """
SELECT eco_raw AS PLACAS, strftime(l_shipdate, '%Y/%m/%d') || ' ' || lpad(CAST(l_partkey % 24 AS VARCHAR), 2, '0') || ':10:05' AS FECHA,
  coalesce(tipo_raw, 'DIESEL') AS PRODUCTO, Cantidad, replace(replace(importe_raw, '$', ''), ',', '') AS IMPORTE,
  tarjeta_raw AS IDENTIFICADOR, 'f' || l_suppkey || '.csv' AS Archivo_Origen FROM ledger_raw"""


@query("src_header_row", f"SELECT PLACAS, FECHA, PRODUCTO, IMPORTE, IDENTIFICADOR, Archivo_Origen FROM ({_FUEL_SQL})")
def _(spark, sf):
    return vendors.supramax_rows(_fuel_raw(spark, sf)).drop("CANTIDAD")


@query("src_supramax", f"""
SELECT PLACAS AS ECO, FECHA AS Fecha, 'COMBUSTIBLE' AS Concepto, CASE trim(PRODUCTO) WHEN 'ARCO MAGNA' THEN 'REGULAR'
  WHEN 'magna' THEN 'REGULAR' WHEN 'ARCO  PREMIUM' THEN 'PREMIUM' ELSE PRODUCTO END AS Tipo,
  Cantidad, CAST(IMPORTE AS DOUBLE) AS Importe, 'Supramax' AS Sistema, 'EMP' AS Empresa FROM ({_FUEL_SQL})""")
def _(spark, sf):
    rows = vendors.clean_supramax(vendors.supramax_rows(_fuel_raw(spark, sf)), "EMP")
    return rows.withColumns({
        "Fecha": F.date_format("Fecha", "yyyy/MM/dd HH:mm:ss"), "Importe": F.col("Importe").cast("double")})


@query("job_unify_supramax", f"""
SELECT Archivo_Origen, count(*) AS n, count(DISTINCT PLACAS) AS unidades, {cents_sum('CAST(IMPORTE AS DOUBLE)')} AS Importe
FROM ({_FUEL_SQL}) GROUP BY ALL""")
def _(spark, sf):
    rows = unify.unify_supramax(_fuel_raw(spark, sf))
    return rows.groupBy("Archivo_Origen").agg(
        F.count("*").alias("n"), F.countDistinct("PLACAS").alias("unidades"),
        sum_cents(F.col("IMPORTE")).alias("Importe"))


@query("src_supramax_html", f"""
SELECT trim(PLACAS) AS ECO, FECHA AS Fecha, 'AÑO' AS Tipo, Cantidad, CAST(IMPORTE AS DOUBLE) AS Importe,
  count(*) AS n FROM ({_FUEL_SQL}) GROUP BY ALL""")
def _(spark, sf):
    """HTML files under a spreadsheet name, odd ones in Latin-1, written and read back."""
    raw = v.ledger_raw(spark, sf)
    hour = F.lpad((F.col("l_partkey") % 24).cast("string"), 2, "0")
    moment = F.concat(F.date_format("l_shipdate", "yyyy/MM/dd"), F.lit(" "), hour, F.lit(":10:05"))

    def tr(*cells):
        return F.concat(F.lit("<tr><td>"), F.concat_ws("</td><td>", *cells), F.lit("</td></tr>"))

    line = tr("eco_raw", moment, F.lit("AÑO"), F.coalesce(F.col("Cantidad").cast("string"), F.lit("")),
              F.translate("importe_raw", "$,", ""))
    path, top = scratch_dir(spark, "fuel-html"), "<table><tr><td>Reporte</td></tr><tr><td>" + "</td><td>".join(_FUEL[:5])
    for odd, charset in ((0, "UTF-8"), (1, "ISO-8859-1")):
        (raw.filter(F.col("l_suppkey") % 2 == odd).select(line.alias(top)).write.mode("append").option("header", True)
         .option("encoding", charset).option("sep", "\x01").option("quote", "\x02").option("escapeQuotes", False)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{path}/{charset}"))
    files = ragged.land(spark, html.read_html_files(spark, path, [".csv"]))
    found = vendors.supramax_rows(headers.with_header(files, headers.marker_headers, "PLACAS"))
    rows = vendors.clean_supramax(found).select(
        "ECO", F.date_format("Fecha", "yyyy/MM/dd HH:mm:ss").alias("Fecha"), "Tipo", "Cantidad",
        F.col("Importe").cast("double").alias("Importe"))
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))


def _tag_raw(spark, sf):
    return v.stored(spark, sf, "tag_raw", _make_tag_raw)


def _make_tag_raw(spark, sf):
    """Tag listings: header first, header in the fifth row, or none at all."""
    s = v.table(spark, sf, "supplier")
    key = F.col("s_suppkey")
    kind = key % 3
    pfx, num, p3 = v._unit(key)
    path = F.concat(F.lit("t"), key.cast("string"))
    plate = F.when(key % 7 == 0, F.concat(F.lit("pre "), num)).otherwise(F.concat(pfx, F.lit("."), p3, F.lit(" (x)")))
    tag = F.when(key % 11 == 0, "nan").otherwise(F.concat(F.lit(" T"), key.cast("string")))
    named = _words("No", "Nombre", "Tag ID", "Placas", "Estado")
    first = s.filter(kind != 1).select(*_raw(path, F.lit(0), F.when(kind == 0, named).otherwise(_words("a", "b", "c", "d"))))
    fifth = s.filter(kind == 1).select(path.alias("path"), F.posexplode(F.array(
        _words("Reporte"), _words("Tarjetas del mes"), _words("", ""), _words("x"), named)).alias("row_idx", "cells"))
    fifth = fifth.select(*_raw(F.col("path"), F.col("row_idx"), F.col("cells")))
    cells = F.when(kind == 2, F.array(F.lit("1"), plate, F.lit("z"), tag)).otherwise(
        F.array(F.lit("1"), F.lit("n"), tag, plate, F.lit("ok")))
    return first.union(fifth).union(s.select(*_raw(path, F.lit(5), cells)))


@query("src_header_scan", """
SELECT 't' || s_suppkey AS path, CASE s_suppkey % 3 WHEN 1 THEN 4 ELSE 0 END AS header_row,
  CASE s_suppkey % 3 WHEN 2 THEN 1 ELSE 3 END AS plate_pos, CASE s_suppkey % 3 WHEN 2 THEN 3 ELSE 2 END AS tag_pos FROM supplier""")
def _(spark, sf):
    return headers.keyword_headers(_tag_raw(spark, sf))


@query("agg_supramax_tags", f"""
SELECT key, arg_max(tag, path) AS value FROM (
  SELECT CASE WHEN s_suppkey % 7 = 0 THEN 'PRE-' || {_p3} ELSE {_pfx} || '-' || {_p3} END AS key,
    'T' || s_suppkey AS tag, 't' || s_suppkey AS path FROM supplier WHERE s_suppkey % 11 <> 0) GROUP BY key""")
def _(spark, sf):
    return tags.supramax_tags(_tag_raw(spark, sf))


@query("agg_pase_tags", f"""
SELECT key, arg_max(tag, s_suppkey) AS value FROM (SELECT s_suppkey, {_pfx} || '-' || {_p3} AS key,
  CASE WHEN s_suppkey % 2 = 0 THEN 'IMDM' || lpad(CAST(s_suppkey AS VARCHAR), 8, '0') ELSE 'X' || s_suppkey END AS tag
  FROM supplier WHERE s_suppkey % 5 <> 0) GROUP BY key""")
def _(spark, sf):
    key = F.col("s_suppkey")
    pfx, _, p3 = v._unit(key)
    name = F.when(key % 5 == 0, F.concat(pfx, p3)).otherwise(F.concat(F.lit(" "), F.lower(pfx), F.lit("-"), p3, F.lit(" base")))
    tag = F.when(key % 2 == 0, F.lpad(key.cast("string"), 8, "0")).otherwise(F.concat(F.lit("X "), key.cast("string"), F.lit(".")))
    df = v.table(spark, sf, "supplier").select(name.alias("Vehiculo"), tag.alias("Tag"), "s_suppkey")
    return tags.pase_tags(df, "Vehiculo", "Tag", "s_suppkey")


_CARD = ["Folio", "Vehículo", "Fecha Transacción", "Mercancía", "Cantidad Mercancía", "Importe Transacción", "Núm Tarjeta", "Unidad"]


def _card_raw(spark, sf):
    return v.stored(spark, sf, "card_raw", _make_card_raw)


def _make_card_raw(spark, sf):
    """Card exports by supplier, header in row 5. Odd files name no *Vehículo* column:
    there the unit is the eighth. Two thirds state the client above the header."""
    s = v.table(spark, sf, "supplier")
    key = F.col("s_suppkey")
    year = F.lit("1996")

    def path(k):
        old = F.concat(F.lit("Edenred/"), year, F.lit("/03/e"), k.cast("string"), F.lit(".csv"))
        new = F.concat(F.lit("Edenred/emp_s_"), k.cast("string"), F.lit("/"), year, F.lit("/03/e"), k.cast("string"), F.lit(".csv"))
        return F.when(k % 2 == 0, new).otherwise(old)

    client = F.array(F.lit(None).cast("string"), F.lit(" Cliente: "), F.concat(F.lit(" emp "), key.cast("string"), F.lit(" ")))
    top = s.filter(key % 3 != 0).select(*_raw(path(key), 1 + key % 4, client))
    odd_name = F.transform(_words(*_CARD), lambda c: F.when(c == "Vehículo", "Chofer").otherwise(c))
    head = s.select(*_raw(path(key), F.lit(5), F.when(key % 2 == 0, _words(*_CARD)).otherwise(odd_name)))
    raw, k = v.ledger_raw(spark, sf), F.col("l_suppkey")
    cells = F.array(
        F.lit("1"), F.when(k % 2 == 0, F.col("eco_raw")).otherwise("Ana"), F.date_format("l_shipdate", "dd/MM/yyyy"), F.coalesce("tipo_raw", F.lit("DIESEL")),
        F.col("Cantidad").cast("string"), F.translate("importe_raw", "$,-", ""), "tarjeta_raw",
        F.when(k % 2 == 0, "Ana").otherwise(F.col("eco_raw")))
    return top.union(head).union(raw.select(*_raw(path(k), 10 + F.col("row_idx"), cells)))


_CARD_SQL = f"""
SELECT eco_raw AS unidad, CAST(l_shipdate AS DATE) AS Fecha, coalesce(tipo_raw, 'DIESEL') AS Tipo, Cantidad,
  CAST(replace(replace(replace(importe_raw, '$', ''), ',', ''), '-', '') AS DOUBLE) AS Importe, tarjeta_raw AS tarjeta,
  'e' || l_suppkey || '.csv' AS Archivo_Origen, l_suppkey,
  CASE WHEN l_suppkey % 3 <> 0 THEN 'EMP ' || l_suppkey WHEN l_suppkey % 2 = 0 THEN 'EMP S ' || l_suppkey END AS Empresa
FROM ledger_raw"""


@query("src_skip_rows", f"""SELECT unidad, tarjeta, Importe, Archivo_Origen, count(*) AS n FROM ({_CARD_SQL}) GROUP BY ALL""")
def _(spark, sf):
    rows = vendors.edenred_rows(_card_raw(spark, sf)).select(
        F.col("Vehículo").alias("unidad"), F.col("Núm Tarjeta").alias("tarjeta"),
        F.col("Importe Transacción").cast("double").alias("Importe"), "Archivo_Origen")
    return rows.groupBy("unidad", "tarjeta", "Importe", "Archivo_Origen").agg(F.count("*").alias("n"))


@query("src_edenred", f"""
SELECT unidad AS ECO, Fecha, 'COMBUSTIBLE' AS Concepto, Tipo, Cantidad, Importe, 'Edenred' AS Sistema, 'EMP' AS Empresa,
  Archivo_Origen FROM ({_CARD_SQL})""")
def _(spark, sf):
    rows = vendors.clean_edenred(vendors.edenred_rows(_card_raw(spark, sf)), "EMP")
    return rows.withColumns({"Fecha": F.to_date("Fecha"), "Importe": F.col("Importe").cast("double")})


@query("src_preamble_value", """
SELECT 'e' || s_suppkey || '.csv' AS file, 'EMP ' || s_suppkey AS value FROM supplier WHERE s_suppkey % 3 <> 0""")
def _(spark, sf):
    from fleetbook.functions.keys import base_name

    return headers.preamble_value(_card_raw(spark, sf), "Cliente:").select(
        base_name(F.col("path")).alias("file"), "value")


@query("job_unify_edenred", f"""
SELECT 'crudo' AS hoja, Archivo_Origen, count(*) AS n, {cents_sum('Importe')} AS Importe FROM ({_CARD_SQL}) GROUP BY ALL
UNION ALL SELECT 'limpio', Archivo_Origen, count(*), {cents_sum('Importe')} FROM ({_CARD_SQL})
WHERE regexp_matches({norm_eco('unidad')}, '^(AU|CA)-\\d{{3}}$') GROUP BY ALL""")
def _(spark, sf):
    raw, clean = unify.unify_edenred(_card_raw(spark, sf))
    raw = raw.select(F.lit("crudo").alias("hoja"), "Archivo_Origen", F.col("Importe Transacción").cast("double").alias("Importe"))
    both = raw.union(clean.select(F.lit("limpio"), "Archivo_Origen", "Importe"))
    return both.groupBy("hoja", "Archivo_Origen").agg(F.count("*").alias("n"), sum_cents(F.col("Importe")).alias("Importe"))


# --- tolls ---


def _toll_raw(spark, sf):
    return v.stored(spark, sf, "toll_raw", _make_toll_raw)


def _make_toll_raw(spark, sf):
    """Toll exports by supplier with three headers. Every tenth row has a fifth cell; in
    odd files it is blank, so the column does not count."""
    s, raw = v.table(spark, sf, "supplier"), v.ledger_raw(spark, sf)

    def path(k):
        return F.concat(F.lit("Pase/EMP_X/1997/0"), (1 + k % 9).cast("string"), F.lit("/g1A"), k.cast("string"), F.lit(".7.csv"))

    kind = F.col("s_suppkey") % 3
    head = F.when(kind == 0, _words("No. económico", "Fecha de cruce", " Importe al 100", "Tarjeta IDMX")).when(
        kind == 1, _words("Fecha", "Monto", "ECO", "Tag")).otherwise(_words("Cobro", "Fecha", "x", "Eco."))
    rows = s.select(*_raw(path(F.col("s_suppkey")), F.lit(0), head))
    k = F.col("l_suppkey") % 3
    eco, day, amount = F.col("eco_raw"), F.col("fecha_raw"), F.col("importe_raw")
    cells = F.when(k == 0, F.array(eco, day, amount, F.lit("T1."))).when(
        k == 1, F.array(day, amount, eco, F.lit("T2"))).otherwise(F.array(amount, day, F.lit("x"), eco))
    extra = F.array(F.when(F.col("l_suppkey") % 2 == 0, "nota").otherwise(" "))
    cells = F.when(F.col("l_partkey") % 10 == 0, F.concat(cells, extra)).otherwise(cells)
    return rows.union(raw.select(*_raw(path(F.col("l_suppkey")), 1 + F.col("row_idx"), cells)))


_TOLL_SQL = f"""
SELECT eco_raw AS ECO, {parse_day('fecha_raw')} AS Fecha,
  abs(TRY_CAST(replace(replace(importe_raw, '$', ''), ',', '') AS DOUBLE)) AS Importe,
  'g1A' || l_suppkey || '.7.csv' AS file, row_idx, l_suppkey,
  CASE l_suppkey % 3 WHEN 0 THEN trim(eco_raw) || '||' || fecha_raw || '||' || importe_raw || '||T1.'
    WHEN 1 THEN fecha_raw || '||' || importe_raw || '||' || trim(eco_raw) || '||T2'
    ELSE importe_raw || '||' || fecha_raw || '||x||' || trim(eco_raw) END ||
  CASE WHEN max(CASE WHEN l_suppkey % 2 = 0 AND l_partkey % 10 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY l_suppkey) = 1
    THEN '||' || CASE WHEN l_partkey % 10 = 0 THEN 'nota' ELSE '' END ELSE '' END AS content
FROM ledger_raw"""


@query("src_pase", f"""
SELECT ECO, Fecha, 'PEAJES' AS Concepto, CAST(NULL AS VARCHAR) AS Tipo, CAST(NULL AS DOUBLE) AS Cantidad, Importe, 'Pase' AS Sistema,
  'EMP' AS Empresa, sha1('Pase|' || file || '|' || row_idx || '|' || content) AS Id_Origen, file AS Archivo_Origen FROM ({_TOLL_SQL})""")
def _(spark, sf):
    return vendors.clean_pase(_toll_raw(spark, sf), "EMP").withColumn("Fecha", F.to_date("Fecha"))


def _toll_archive(spark, sf):
    """The toll exports, a third of them also archived in the older layout. A third has a
    billing date and a base amount left of the real columns; another third names neither
    unit nor amount as the consolidation wants them."""
    raw, named = _toll_raw(spark, sf), F.element_at("cells", 3) == "ECO"
    traps = F.when(named, _words("Fecha de facturación", "Importe base")).otherwise(_words("1997/01/01", "5"))
    names = F.when(named, _words("Fecha", "Importe", "No. Económico", "Tag")).otherwise(F.col("cells"))
    second = F.regexp_extract("path", r"g1A(\d+)\.7", 1).cast("int") % 3 == 1
    raw = raw.withColumn("cells", F.when(second, F.concat(traps, names)).otherwise(F.col("cells")))
    old = raw.filter(F.col("path").rlike(r"[147]\.7\.csv$")).withColumn(
        "path", F.regexp_replace("path", "EMP_X/1997/0", "1997/1"))
    return raw.union(old)


@query("job_unify_pase", f"""
SELECT {norm_eco('ECO')} AS ECO, Fecha, Importe, CASE l_suppkey % 3 WHEN 0 THEN 'T1' ELSE 'T2' END AS tarjeta,
  file AS Archivo_Origen FROM ({_TOLL_SQL}) WHERE l_suppkey % 3 <> 2 AND Fecha IS NOT NULL AND year(Fecha) = 1997""")
def _(spark, sf):
    rows = unify.unify_pase(_toll_archive(spark, sf), year=1997)
    return rows.select("ECO", F.to_date("Fecha").alias("Fecha"), "Importe",
                       F.coalesce("Tarjeta IDMX", F.lit("")).alias("tarjeta"), "Archivo_Origen")


@query("job_consolidate", f"""
SELECT DISTINCT trim(ECO) AS ECO, Fecha, Importe FROM ({_TOLL_SQL}) WHERE Fecha IS NOT NULL AND Importe IS NOT NULL""")
def _(spark, sf):
    """Toll files in two deliveries, consolidated after each and once more without news."""
    import datetime as dt

    raw, place, old = v.ledger_raw(spark, sf), scratch_dir(spark, "deliveries"), scratch_dir(spark, "consolidated")
    line = F.concat_ws(";", "eco_raw", "fecha_raw", "importe_raw", F.lit("T1."))
    store = spark.createDataFrame([], "ECO string, Fecha timestamp, Importe double")
    registry = spark.createDataFrame(
        [], "path string, length bigint, modificationTime timestamp, processed_at timestamp")
    for run in range(3):
        if run < 2:
            _write_lines(raw.filter(F.col("l_partkey") % 2 == run).select(line.alias("line"), "Sistema"),
                         _PASE_HEADER, f"{place}/entrega={run}", "Sistema")
        rows, seen = consolidate.consolidate(
            spark, "Pase", place, store, registry, dt.datetime(2000, 1, 1 + run))
        rows.write.parquet(f"{old}/rows{run}")
        seen.write.parquet(f"{old}/files{run}")
        store, registry = spark.read.parquet(f"{old}/rows{run}"), spark.read.parquet(f"{old}/files{run}")
    return store.select("ECO", F.to_date("Fecha").alias("Fecha"), "Importe").distinct()


@query("job_consolidate_outcomes", f"""
SELECT 'Pase' AS sistema, 'row' AS kind, trim(ECO) AS ECO, strftime(Fecha, '%d/%m/%Y') AS Fecha, Importe, count(DISTINCT l_suppkey % 4) AS n
FROM ({_TOLL_SQL}) WHERE Fecha IS NOT NULL AND Importe IS NOT NULL GROUP BY ALL
UNION ALL
SELECT 'Edenred', 'row', trim(eco_raw), strftime(l_shipdate, '%d/%m/%Y'), CAST(replace(replace(importe_raw, '$', ''), ',', '') AS DOUBLE),
  count(DISTINCT l_suppkey % 4) FROM ledger_raw GROUP BY ALL
UNION ALL
SELECT s, k, NULL, NULL, NULL, n FROM (VALUES ('Pase'), ('Edenred')) AS a(s), (VALUES ('read', 4), ('torn', 1), ('no header', 1)) AS b(k, n)""")
def _(spark, sf):
    """From bytes to rows and outcomes: toll and card files in two deliveries, the first with a
    file without a header and one that is no text. Every stored row counts, none is merged."""
    import datetime as dt

    raw, place, old = v.ledger_raw(spark, sf), scratch_dir(spark, "outcome-files"), scratch_dir(spark, "outcome-rows")
    kinds = {
        "Pase": (_PASE_HEADER, F.concat_ws(";", "eco_raw", "fecha_raw", "importe_raw", F.lit("T1."))),
        "Edenred": (",".join(_CARD), F.concat_ws(
            ",", F.lit("1"), "eco_raw", F.date_format("l_shipdate", "dd/MM/yyyy"), F.lit("DIESEL"), F.lit("1"),
            F.translate("importe_raw", "$,", ""), F.lit("9"), F.lit("x")))}
    out = []
    for system, (header, line) in kinds.items():
        folder = f"{place}/{system}"
        lines = raw.select(line.alias("line"), (F.col("l_suppkey") % 4).alias("key"))
        bad = raw.select(line.alias("line")).limit(20).coalesce(1)
        bad.write.option("quote", "\x02").option("sep", "\x01").csv(f"{folder}/bare")
        bad.select(F.concat("line", F.lit(";\x00;")).alias(header)).write.option("header", True).option("quote", "\x02").option(
            "sep", "\x01").csv(f"{folder}/torn")
        # One file a key, each written by a task of its own, and put in place when its delivery comes.
        coming = f"{place}-coming/{system}"
        _write_lines(lines.repartitionById(4, F.col("key").cast("int")).withColumn("entrega", F.floor(F.col("key") / 2)),
                     header, coming, "entrega", "key")
        store = spark.createDataFrame([], "Archivo_Origen string")
        registry = spark.createDataFrame([], changed_files.REGISTRY)
        for run in range(3):
            if run < 2:
                _arrive(spark, f"{coming}/entrega={run}", f"{folder}/entrega={run}")
            rows, seen = consolidate.consolidate(spark, system, folder, store, registry, dt.datetime(2000, 1, 1 + run))
            rows.write.parquet(f"{old}/{system}/rows{run}")
            seen.write.parquet(f"{old}/{system}/files{run}")
            store, registry = (spark.read.parquet(f"{old}/{system}/{kind}{run}") for kind in ("rows", "files"))
        if system == "Pase":
            rows = store.select("ECO", F.date_format("Fecha", "dd/MM/yyyy").alias("Fecha"), "Importe")
        else:
            rows = store.select(F.trim("Vehículo").alias("ECO"), F.col("Fecha Transacción").alias("Fecha"),
                                F.col("Importe Transacción").cast("double").alias("Importe"))
        out.append(rows.groupBy("ECO", "Fecha", "Importe").agg(F.count("*").alias("n")).withColumn("kind", F.lit("row")).withColumn("sistema", F.lit(system)))
        out.append(registry.groupBy(F.col("state").alias("kind")).agg(F.count("*").alias("n")).withColumn("sistema", F.lit(system)))
    frame = out[0]
    for more in out[1:]:
        frame = frame.unionByName(more, allowMissingColumns=True)
    return frame


@query("job_recover_year", f"""
SELECT {LEDGER} FROM merge_target UNION ALL
SELECT ECO, Fecha, 'PEAJES', NULL, NULL, Importe, 'Pase', 'EMP X', Id, file FROM (
  SELECT {norm_eco('ECO')} AS ECO, Fecha, Importe, file, sha1('Pase|' || file || '|' || row_idx || '|' || content) AS Id,
    row_number() OVER (PARTITION BY sha1('Pase|' || file || '|' || row_idx || '|' || content)) AS k FROM ({_TOLL_SQL})
  WHERE Fecha IS NOT NULL) WHERE k = 1 AND regexp_matches(ECO, '^(AU|CA)-\\d{{3}}$')""")
def _(spark, sf):
    return unify.recover_pase(_toll_raw(spark, sf), v.merge_target(spark, sf), 1997)


@query("job_recover_edenred", f"""
SELECT {LEDGER} FROM merge_target UNION ALL
SELECT DISTINCT ECO, Fecha, 'COMBUSTIBLE', Tipo, Cantidad, Importe, 'Edenred', Empresa, NULL, Archivo_Origen FROM (
  SELECT * EXCLUDE (unidad), {norm_eco('unidad')} AS ECO FROM ({_CARD_SQL})) s
WHERE regexp_matches(ECO, '^(AU|CA)-\\d{{3}}$') AND NOT EXISTS (
  SELECT 1 FROM merge_target t WHERE t.ECO = s.ECO AND t.Fecha = s.Fecha AND t.Concepto = 'COMBUSTIBLE' AND t.Sistema = 'Edenred'
    AND coalesce(t.Tipo, '') = coalesce(s.Tipo, '') AND abs(coalesce(t.Cantidad, -1.0) - coalesce(s.Cantidad, -1.0)) < 0.01
    AND abs(t.Importe - s.Importe) < CAST(0.01 AS DOUBLE))""")
def _(spark, sf):
    return unify.recover_edenred(_card_raw(spark, sf), v.merge_target(spark, sf), 1996)


# --- maintenance and consolidated exports ---


@query("src_mantenimiento", f"""
SELECT ECO, Fecha, Concepto, Tipo, Cantidad, Importe, Sistema FROM (SELECT DISTINCT eco_raw, importe_raw, l_orderkey,
  {norm_eco_lzc('eco_raw')} AS ECO, CAST(l_shipdate AS DATE) AS Fecha, 'MANTENIMIENTO' AS Concepto,
  CAST(NULL AS VARCHAR) AS Tipo, CAST(NULL AS DOUBLE) AS Cantidad, CAST(replace(replace(replace(importe_raw, '$', ''), ',', ''), '-', '') AS DOUBLE) AS Importe,
  'Google Sheets' AS Sistema FROM ledger_raw) WHERE regexp_matches(ECO, '^(AU|CA)-\\d{{3}}(\\s*LZC)?$')""")
def _(spark, sf):
    raw = v.ledger_raw(spark, sf)
    sheet = raw.select(
        F.col("eco_raw").alias("No Eco"), F.date_format("l_shipdate", "dd/MM/yyyy").alias("Fecha servicio"),
        F.translate("importe_raw", "$,-", "").alias("PrecioNeto"), F.col("l_orderkey"))
    twice = sheet.union(sheet.filter("l_orderkey % 4 = 0"))
    return vendors.clean_maintenance(twice).withColumn("Fecha", F.to_date("Fecha"))


@query("src_consolidated", """
SELECT eco_raw AS ECO, CAST(l_shipdate AS DATE) AS Fecha, 'COMBUSTIBLE' AS Concepto, tipo_raw AS Tipo,
  CAST(replace(replace(replace(importe_raw, '$', ''), ',', ''), '-', '') AS DOUBLE) AS Importe, 'Supramax' AS Sistema, Cantidad
FROM ledger_raw WHERE Sistema = 'Supramax'""")
def _(spark, sf):
    rows = v.ledger_raw(spark, sf).filter("Sistema = 'Supramax'").select(
        F.col("eco_raw").alias("PLACAS"), F.date_format("l_shipdate", "yyyy/MM/dd HH:mm:ss").alias("FECHA"),
        F.col("tipo_raw").alias("PRODUCTO"), F.col("Cantidad").alias("CANTIDAD"),
        F.translate("importe_raw", "$,-", "").alias("IMPORTE"), "Archivo_Origen")
    path = scratch_dir(spark, "consolidated") + ".csv"
    rows.write.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path, header=True)
    return vendors.read_consolidated(spark, path, "Supramax").withColumn("Fecha", F.to_date("Fecha"))


@query("sink_consolidated_csv", f"""SELECT PLACAS, FECHA, IMPORTE, Archivo_Origen FROM ({_FUEL_SQL})""")
def _(spark, sf):
    from fleetbook.operators.reports import write_tables

    rows = unify.unify_supramax(_fuel_raw(spark, sf))
    path = write_tables({"CONSOLIDADO SUPRAMAX": rows}, scratch_dir(spark, "out"), "csv")["CONSOLIDADO SUPRAMAX"]
    return spark.read.csv(path, header=True).select("PLACAS", "FECHA", "IMPORTE", "Archivo_Origen")


# --- headers ---


@query("fn_resolve_header", """
SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN (c_custkey % 3 + 2) % 3 ELSE c_custkey % 3 END AS eco,
  CASE c_custkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END AS fecha, CASE WHEN c_custkey % 2 = 0 THEN 3 END AS exacta
FROM customer""")
def _(spark, sf):
    k = F.col("c_custkey")
    date = F.when(k % 2 == 0, "Fecha de Cruce").otherwise("FECHA")
    unit_name = F.when(k % 2 == 0, "No. Económico").otherwise("Eco")
    three = (
        F.when(k % 3 == 0, F.array(F.lit("Caseta"), date, F.lit("Importe")))
        .when(k % 3 == 1, F.array(F.lit("Importe"), F.lit("Caseta"), date))
        .otherwise(F.array(date, F.lit("Importe"), F.lit("Caseta"))))
    target = F.when(k % 2 == 0, (k % 3 + 2) % 3).otherwise(k % 3)
    named = F.transform(three, lambda c, i: F.when(i == target, unit_name).otherwise(c))
    last = F.when(k % 2 == 0, "Tarjeta IDMX").otherwise("Otra")
    header = F.concat(named, F.array(last))
    return v.table(spark, sf, "customer").select("c_custkey", header.alias("h")).select(
        "c_custkey", headers.find_eco(F.col("h")).cast("bigint").alias("eco"),
        headers.find_contains(F.col("h"), "fechadecruce", "fecha").cast("bigint").alias("fecha"),
        headers.find_exact(F.col("h"), "tarjeta", "TARJETA-IDMX").cast("bigint").alias("exacta"))


# --- HTML ---


@query("src_html_table", """
SELECT l_orderkey || '.' || l_partkey || '.' || l_linenumber AS path, r.i AS row_idx,
  CASE WHEN r.i = 0 THEN 'PLACAS|FECHA|IMPORTE' ELSE trim(eco_raw) || '|' || fecha_raw || '|' || importe_raw || ' & c' END AS cells,
  count(*) AS n
FROM ledger_raw, range(2) r(i) GROUP BY ALL""")
def _(spark, sf):
    key = F.concat_ws(".", *[F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_linenumber")])
    page = F.concat(
        F.lit("<html><table border=0><tr><th>PLACAS</th><th> FECHA</th><th>IMPORTE</th></tr><tr><td>"), "eco_raw",
        F.lit("</td><td><b>"), "fecha_raw", F.lit("</b></td><td>"), "importe_raw",
        F.lit(" &amp; c</td></tr></table><table><tr><td>pie</td></tr></table></html>"))
    pages = v.ledger_raw(spark, sf).select(key.alias("path"), page.alias("html"))
    rows = html.html_table_rows(pages, "path", "html", table=0)
    return rows.groupBy("path", "row_idx", F.array_join("cells", "|").alias("cells")).agg(F.count("*").alias("n"))


@query("src_html_tag_links", f"""
SELECT ECO, arg_min(tag, CAST(s_suppkey AS VARCHAR)) AS tag FROM (
  SELECT {_pfx} || '-' || {_p3} AS ECO, 'IM' || s_suppkey AS tag, s_suppkey FROM supplier WHERE s_suppkey % 4 <> 0) GROUP BY ECO""")
def _(spark, sf):
    key = F.col("s_suppkey")
    pfx, _, p3 = v._unit(key)
    unit_text = F.when(key % 4 == 0, F.concat(F.lit("Unidad "), pfx, p3)).otherwise(F.concat(pfx, F.lit("-"), p3, F.lit(" Jetta")))
    page = F.concat(
        F.lit('<div class="row"><a href="/otra">no</a><a href="/uc/detalletag/9">\n IM '), key.cast("string"),
        F.lit('. </a><div><p>Activo</p><p> '), unit_text, F.lit("</p></div></div>"))
    pages = v.table(spark, sf, "supplier").select(key.cast("string").alias("path"), page.alias("html"))
    return html.html_tag_pairs(pages, "path", "html")


# --- look-up files ---


@query("src_json_map", "SELECT key, value, count(*) AS n FROM tags GROUP BY ALL")
def _(spark, sf):
    return maps.json_map(v.tag_json(spark, sf), "json").groupBy("key", "value").agg(F.count("*").alias("n"))


@query("src_client_map", """
SELECT 'by_number' AS kind, CAST(c_custkey AS VARCHAR) AS number, c_name AS company FROM customer WHERE c_custkey % 5 <> 0
UNION ALL SELECT 'by_slot', 's' || c_custkey, c_name FROM customer WHERE c_custkey % 2 = 0""")
def _(spark, sf):
    k = F.col("c_custkey")
    name = F.when(k % 5 == 0, "").otherwise(F.col("c_name"))
    flat = F.concat(F.lit('{"'), k.cast("string"), F.lit('": "'), name, F.lit('"}'))
    nested = F.concat(F.lit('{"by_number": '), flat, F.lit(', "by_slot": {"s'), k.cast("string"), F.lit('": "'), "c_name", F.lit('"}}'))
    df = v.table(spark, sf, "customer").select(F.when(k % 2 == 0, nested).otherwise(flat).alias("json"))
    return maps.client_map(df, "json")


@query("src_text_list", f"""
SELECT {norm_eco('eco_raw')} AS ECO, count(*) AS n FROM ledger_raw WHERE l_linenumber <> 5 GROUP BY ALL""")
def _(spark, sf):
    line = F.when(F.col("l_linenumber") == 5, "  ").otherwise(F.col("eco_raw"))
    path = scratch_dir(spark, "keys")
    v.ledger_raw(spark, sf).select(line.alias("value")).write.text(path)
    return maps.read_key_list(spark, path).groupBy("ECO").agg(F.count("*").alias("n"))


@query("src_tabbed_expand", """
SELECT trim(eco_raw) AS ECO, fecha_raw AS Fecha, CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE importe_raw END AS Importe
FROM ledger_raw""")
def _(spark, sf):
    k = F.col("l_linenumber") % 3
    text = F.when(k == 0, F.concat_ws("\t", "eco_raw", "fecha_raw")).when(
        k == 1, F.concat_ws("\t", "eco_raw", "fecha_raw", "importe_raw")).otherwise(
        F.concat_ws("\t", "eco_raw", "fecha_raw", "importe_raw", F.lit("de más")))
    return maps.expand_tabbed(v.ledger_raw(spark, sf).select(text.alias("ECO\tFecha\t Importe")))


@query("src_best_table", """
WITH t AS (SELECT 'N' || c_nationkey AS name, count(*) FILTER (c_acctbal > 0) AS r, max(length(c_name) + c_custkey % 7) AS c
  FROM customer GROUP BY 1)
SELECT 'sin preferencia' AS caso, (SELECT name FROM t ORDER BY r DESC, c DESC, name LIMIT 1) AS name
UNION ALL SELECT 'preferida', 'N7' """)
def _(spark, sf):
    stats = v.table(spark, sf, "customer").groupBy(F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("name")).agg(
        F.count_if(F.col("c_acctbal") > 0).alias("rows_with_eco"),
        F.max(F.length("c_name") + F.col("c_custkey") % 7).alias("columns")).withColumn("has_eco", F.lit(True))
    return maps.pick_table(stats, ["Datos_Unidad"]).select(F.lit("sin preferencia").alias("caso"), "name").union(
        maps.pick_table(stats, ["Datos_Unidad", "N7", "N3"]).select(F.lit("preferida"), "name"))


@query("src_best_table_files", """
WITH c AS (SELECT l_orderkey, count(*) FILTER (l_linenumber % 3 = 0) AS n1, count(*) FILTER (l_linenumber % 2 = 0) AS n2
  FROM ledger_raw GROUP BY 1)
SELECT l_orderkey, CASE WHEN n1 >= n2 THEN 1 ELSE 2 END AS tbl,
  CASE WHEN n1 >= n2 THEN fecha_raw || '|' || CASE WHEN l_linenumber % 3 = 0 THEN trim(eco_raw) ELSE '' END || '|nota'
    ELSE CASE WHEN l_linenumber % 2 = 0 THEN trim(eco_raw) ELSE '' END || '|' || importe_raw END AS cells
FROM ledger_raw JOIN c USING (l_orderkey)""")
def _(spark, sf):
    """Files with a table without units, and two with units in different columns."""
    eco, odd, even = F.col("eco_raw"), F.col("l_linenumber") % 3 == 0, F.col("l_linenumber") % 2 == 0

    def line(*cells):
        return F.concat(F.lit("<tr><td>"), F.concat_ws("</td><td>", *cells), F.lit("</td></tr>"))

    blank = F.lit("")
    files = v.ledger_raw(spark, sf).groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct(
        "l_linenumber", line(F.col("fecha_raw"), F.when(odd, eco).otherwise(blank), F.lit(" nota")).alias("a"),
        line(F.when(even, eco).otherwise(blank), F.col("importe_raw")).alias("b")))).alias("r"))
    page = F.concat(
        F.lit("<table><tr><th>Concepto</th><th>Total</th><th>x</th><th>y</th></tr><tr><td>a</td><td>1</td><td>AU-001</td><td>2</td></tr></table>"
              "<table><tr><th>Fecha</th><th>No. Económico</th><th>Nota</th></tr>"), F.array_join("r.a", ""),
        F.lit("</table><table><tr><th> ECO </th><th>Importe</th></tr>"), F.array_join("r.b", ""), F.lit("</table>"))
    pages = files.select(F.col("l_orderkey").cast("string").alias("path"), page.alias("html"))
    rows = html.html_table_rows(pages, "path", "html", table=html.BEST).filter("row_idx > 0")
    return rows.select(
        F.col("path").cast("bigint").alias("l_orderkey"), F.col("table").alias("tbl"),
        F.array_join("cells", "|").alias("cells"))


# --- archive ---


@query("sink_archive_path", """
SELECT page_id, 'Pase/' || CASE WHEN page_id % 2 = 0 THEN 'Auto_Norte/' ELSE '' END || '1998/06/pase_' || substr(sha256(html), 1, 12)
  || '_p' || page_id || '.csv' AS archive FROM pages""")
def _(spark, sf):
    key = F.col("page_id")
    path = F.concat(F.lit("descargas/p"), key.cast("string"), F.lit(".csv"))
    files = v.table(spark, sf, "pages").select("page_id", path.alias("path"), F.col("html").cast("binary").alias("content"))
    even = archive.manifest(files.filter(key % 2 == 0), "Pase", v.AS_OF, company="Auto  Norte,")
    odd = archive.manifest(files.filter(key % 2 == 1), "Pase", v.AS_OF, period=(1998, 6))
    number = F.regexp_extract("path", r"p(\d+)\.csv$", 1).cast("bigint")
    return even.union(odd).select(number.alias("page_id"), "archive")


@query("sink_archive_period", f"""
SELECT DISTINCT ON (s) s AS supplier, year(Fecha) AS anio, month(Fecha) AS mes FROM (
  SELECT l_suppkey AS s, Fecha, count(*) AS n FROM ({_TOLL_SQL}) WHERE Fecha IS NOT NULL GROUP BY ALL)
ORDER BY s, n DESC, Fecha""")
def _(spark, sf):
    """Archive paths of toll exports from the dominant month of their content."""
    raw = _toll_raw(spark, sf)
    files = raw.filter("row_idx = 0").select("path", F.col("path").cast("binary").alias("content"))
    listed = archive.manifest(files, "Pase", v.AS_OF, period=archive.content_period(raw, "Pase"))
    year, month = (F.regexp_extract("archive", r"^Pase/(?:.*/)?(\d{4})/(\d{2})/", i).cast("bigint") for i in (1, 2))
    return listed.select(F.regexp_extract("path", r"g1A(\d+)\.7", 1).cast("bigint").alias("supplier"),
                         year.alias("anio"), month.alias("mes"))

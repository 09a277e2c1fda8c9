"""Column functions, each over every row of a table."""

import datetime as dt

from pyspark.sql import functions as F

from fleetbook.functions import amounts, dates, eco, keys, text
from fleetbook.sources.headers import dedupe_headers

from . import views as v
from . import views_sql as s
from .registry import query


def _mapped(df, source, **columns):
    """Every distinct input with its outputs and how often it occurs."""
    return df.select(source, *[c.alias(n) for n, c in columns.items()]).groupBy(
        source, *columns).agg(F.count("*").alias("n"))


def _sql(view, source, **columns):
    outs = ", ".join(f"{e} AS {n}" for n, e in columns.items())
    return f"SELECT {source}, {outs}, count(*) AS n FROM {view} GROUP BY ALL"


@query("fn_normalize_eco", _sql("ledger_raw", "eco_raw", eco=s.norm_eco("eco_raw")))
def _(spark, sf):
    return _mapped(v.ledger_raw(spark, sf), "eco_raw", eco=eco.normalize_eco(F.col("eco_raw")))


@query("fn_normalize_eco_lzc", _sql("ledger_raw", "eco_raw", eco=s.norm_eco_lzc("eco_raw")))
def _(spark, sf):
    return _mapped(v.ledger_raw(spark, sf), "eco_raw", eco=eco.normalize_eco_lzc(F.col("eco_raw")))


_PRE = "CASE WHEN l_suppkey % 4 = 0 THEN 'pre ' || {n} ELSE eco_raw END".format(n=s._num)


@query("fn_eco_prefixes", f"""
SELECT raw, {s.norm_eco('raw', 'AU|CA|PRE')} AS eco, count(*) AS n
FROM (SELECT {_PRE} AS raw FROM ledger_raw) GROUP BY ALL""")
def _(spark, sf):
    number = (F.col("l_suppkey") % 1000).cast("string")
    raw = F.when(F.col("l_suppkey") % 4 == 0, F.concat(F.lit("pre "), number)).otherwise(F.col("eco_raw"))
    df = v.ledger_raw(spark, sf).select(raw.alias("raw"))
    return _mapped(df, "raw", eco=eco.normalize_eco(F.col("raw"), ("AU", "CA", "PRE")))


@query("fn_eco_key", _sql("ledger_raw", "eco_raw",
                          key="regexp_replace(upper(eco_raw), '[^A-Z0-9]', '', 'g')"))
def _(spark, sf):
    return _mapped(v.ledger_raw(spark, sf), "eco_raw", key=eco.eco_key(F.col("eco_raw")))


@query("fn_eco_light", _sql("ledger_raw", "eco_raw", eco="replace(upper(trim(eco_raw)), ' ', '')"))
def _(spark, sf):
    return _mapped(v.ledger_raw(spark, sf), "eco_raw", eco=eco.eco_light(F.col("eco_raw")))


@query("fn_eco_master_format", r"""
SELECT raw, CASE WHEN regexp_matches(upper(trim(raw)), '^(AU|CA)-?\d{3}(\s*LZC)?$') THEN
  regexp_replace(regexp_replace(upper(trim(raw)), '^(AU|CA)-?', '\1-'), '(\d)LZC$', '\1 LZC') END AS eco,
  count(*) AS n
FROM (SELECT ECO || CASE WHEN pos % 3 = 0 THEN 'lzc' WHEN pos % 3 = 1 THEN ' LZC' ELSE '' END AS raw
  FROM master UNION ALL SELECT eco_raw FROM ledger_raw) GROUP BY ALL""")
def _(spark, sf):
    pos = F.col("pos") % 3
    suffix = F.when(pos == 0, "lzc").when(pos == 1, " LZC").otherwise("")
    df = v.master(spark, sf).select(F.concat("ECO", suffix).alias("raw")).union(
        v.ledger_raw(spark, sf).select("eco_raw"))
    return _mapped(df, "raw", eco=eco.eco_master_format(F.col("raw")))


@query("fn_plate_key", """
SELECT plate, nullif(nullif(replace(replace(upper(trim(plate)), ' ', ''), '-', ''), ''), 'NAN') AS key,
  count(*) AS n
FROM (SELECT CASE l_linenumber WHEN 1 THEN 'nan' WHEN 2 THEN ' ' WHEN 3 THEN lower(eco_raw)
  ELSE ' pl-' || l_suppkey || ' x ' END AS plate FROM ledger_raw) GROUP BY ALL""")
def _(spark, sf):
    line = F.col("l_linenumber")
    plate = (
        F.when(line == 1, "nan").when(line == 2, " ").when(line == 3, F.lower("eco_raw"))
        .otherwise(F.concat(F.lit(" pl-"), F.col("l_suppkey").cast("string"), F.lit(" x "))))
    df = v.ledger_raw(spark, sf).select(plate.alias("plate"))
    return _mapped(df, "plate", key=eco.plate_key(F.col("plate")))


@query("fn_norm_header", """
SELECT name, regexp_replace(lower(strip_accents(name)), '[^a-z0-9]', '', 'g') AS key, count(*) AS n
FROM (SELECT text AS name FROM conversations) GROUP BY ALL""")
def _(spark, sf):
    df = v.table(spark, sf, "conversations").select(F.col("text").alias("name"))
    return _mapped(df, "name", key=text.header_key(F.col("name")))


#: Characters that a header may hold, and what is left of each.
_FORMS = [("ế", "e"), ("Ǆ", "dz"), ("ﬁ", "fi"), ("½", "12"), ("㎏", "kg"), ("Ⅷ", "viii"), ("№", "no"), ("ẞ", ""), ("ｅ", "e"), ("𝐄", "e"), ("漢", ""), ("ĳ", "ij")]


@query("fn_norm_header_forms", f"""
SELECT conv_id, turn, regexp_replace(lower(strip_accents(text)), '[^a-z0-9]', '', 'g') ||
  CASE (conv_id + turn) % {len(_FORMS)} {' '.join(f"WHEN {k} THEN '{plain}'" for k, (_, plain) in enumerate(_FORMS))} END || 'x' AS key
FROM conversations WHERE text IS NOT NULL""")
def _(spark, sf):
    """Headers with ligatures, unit signs, full-width letters and stacked accents."""
    rows = v.table(spark, sf, "conversations").filter("text IS NOT NULL")
    form = F.get(F.array(*[F.lit(f) for f, _ in _FORMS]), ((F.col("conv_id") + F.col("turn")) % len(_FORMS)).cast("int"))
    return rows.select("conv_id", "turn", text.header_key(F.concat("text", form, F.lit(" X"))).alias("key"))


@query("fn_parse_money", _sql("ledger_raw", "importe_raw", amount=(
    "abs(TRY_CAST(replace(replace(importe_raw, '$', ''), ',', '') AS DOUBLE))")))
def _(spark, sf):
    return _mapped(v.ledger_raw(spark, sf), "importe_raw", amount=amounts.parse_money(F.col("importe_raw")))


@query("fn_to_number", _sql("ledger_raw", "tarjeta_raw", number=(
    "CASE WHEN lower(tarjeta_raw) <> 'nan' THEN TRY_CAST(tarjeta_raw AS DOUBLE) END")))
def _(spark, sf):
    return _mapped(v.ledger_raw(spark, sf), "tarjeta_raw", number=amounts.to_number(F.col("tarjeta_raw")))


@query("fn_parse_date_ladder", _sql("ledger_raw", "fecha_raw", fecha=s.parse_day("fecha_raw")))
def _(spark, sf):
    return _mapped(v.ledger_raw(spark, sf), "fecha_raw",
                   fecha=dates.parse_date_ladder(F.col("fecha_raw")).cast("date"))


@query("fn_parse_ts_fixed", """
SELECT event_id, CAST(strftime(try_strptime(t, '%Y/%m/%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS VARCHAR) AS moment
FROM (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN strftime(ts, '%d/%m/%Y %H:%M:%S')
  WHEN event_id % 7 = 0 THEN strftime(ts, '%Y/%m/%d') ELSE strftime(ts, '%Y/%m/%d %H:%M:%S') END AS t
  FROM events)""")
def _(spark, sf):
    i = F.col("event_id")
    t = (
        F.when(i % 5 == 0, F.date_format("ts", "dd/MM/yyyy HH:mm:ss"))
        .when(i % 7 == 0, F.date_format("ts", "yyyy/MM/dd"))
        .otherwise(F.date_format("ts", "yyyy/MM/dd HH:mm:ss")))
    return v.table(spark, sf, "events").select("event_id", t.alias("t")).select(
        "event_id", F.date_format(dates.parse_ts_fixed(F.col("t")), "yyyy-MM-dd HH:mm:ss").alias("moment"))


@query("fn_parse_dayfirst", """
SELECT event_id, strftime(coalesce(try_strptime(t, '%d/%m/%Y %H:%M:%S'), try_strptime(t, '%d/%m/%Y'),
  try_strptime(t, '%Y-%m-%d')), '%Y-%m-%d %H:%M:%S') AS moment
FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN strftime(ts, '%d/%m/%Y')
  WHEN 1 THEN strftime(ts, '%Y-%m-%d') WHEN 2 THEN 'sin fecha'
  ELSE strftime(ts, '%d/%m/%Y %H:%M:%S') END AS t FROM events)""")
def _(spark, sf):
    i = F.col("event_id") % 4
    t = (
        F.when(i == 0, F.date_format("ts", "dd/MM/yyyy")).when(i == 1, F.date_format("ts", "yyyy-MM-dd"))
        .when(i == 2, "sin fecha").otherwise(F.date_format("ts", "dd/MM/yyyy HH:mm:ss")))
    return v.table(spark, sf, "events").select("event_id", t.alias("t")).select(
        "event_id", F.date_format(dates.parse_dayfirst(F.col("t")), "yyyy-MM-dd HH:mm:ss").alias("moment"))


@query("fn_product_type", _sql("ledger_raw", "tipo_raw", tipo=(
    r"CASE WHEN regexp_replace(trim(upper(tipo_raw)), '^ARCO\s+', '') = 'MAGNA' THEN 'REGULAR' "
    r"ELSE regexp_replace(trim(upper(tipo_raw)), '^ARCO\s+', '') END")))
def _(spark, sf):
    return _mapped(v.ledger_raw(spark, sf), "tipo_raw", tipo=text.product_type(F.col("tipo_raw")))


@query("fn_row_id", """
SELECT l_orderkey, l_linenumber, l_partkey, sha1('Pase|' || plain || '|' || row_idx || '|' || trim(eco_raw)
  || '||' || coalesce(trim(tipo_raw), '') || '||' || importe_raw) AS id
FROM ledger_raw""")
def _(spark, sf):
    cells = [F.col(c) for c in ("eco_raw", "tipo_raw", "importe_raw")]
    return v.ledger_raw(spark, sf).select(
        "l_orderkey", "l_linenumber", "l_partkey",
        keys.row_id("Pase", F.col("Archivo_Origen"), F.col("row_idx"), cells).alias("id"))


@query("fn_signature_expense", """
SELECT concat_ws('_', ECO, strftime(Fecha, '%Y-%m-%d 00:00:00'), Concepto, CAST(CAST(Importe AS DECIMAL(18,2)) AS VARCHAR),
  upper(Sistema), CAST(CAST(coalesce(Cantidad, 0) AS DECIMAL(18,2)) AS VARCHAR)) AS signature, count(*) AS n
FROM ledger GROUP BY ALL""")
def _(spark, sf):
    c = F.col
    sig = keys.signature_expense(
        c("ECO"), c("Fecha"), c("Concepto"), c("Importe"), c("Sistema"), c("Cantidad"))
    return v.ledger(spark, sf).groupBy(sig.alias("signature")).agg(F.count("*").alias("n"))


@query("fn_signature_trip", """
SELECT event_id, concat_ws('_', trim(ECO), strftime("Fecha-hora Inicio", '%Y-%m-%d %H:%M:%S'),
  strftime("Fecha-hora Término", '%Y-%m-%d %H:%M:%S'), upper(Usuario),
  CAST(CAST("Distancia(KM)" AS DECIMAL(18,2)) AS VARCHAR)) AS signature
FROM trips""")
def _(spark, sf):
    c = F.col
    return v.trips(spark, sf).select("event_id", keys.signature_trip(
        c("ECO"), c("`Fecha-hora Inicio`"), c("`Fecha-hora Término`"), c("Usuario"),
        c("`Distancia(KM)`")).alias("signature"))


_CARD = "CASE l_partkey % 4 WHEN 0 THEN tarjeta_raw || '..' WHEN 1 THEN ' 99,' || lpad(tarjeta_raw, 16, '9') " \
        "WHEN 2 THEN tarjeta_raw || '.25' ELSE tarjeta_raw END"


@query("fn_normalize_card", f"""
SELECT card, CASE WHEN t = '' OR lower(t) = 'nan' THEN NULL
  WHEN regexp_matches(replace(t, ',', ''), '^\\d+(\\.0*)?$')
    THEN CAST(CAST(regexp_replace(replace(t, ',', ''), '\\.0*$', '') AS HUGEINT) AS VARCHAR) ELSE t END AS norm, count(*) AS n
FROM (SELECT card, rtrim(trim(card), '.') AS t FROM (SELECT {_CARD} AS card FROM ledger_raw)) GROUP BY ALL""")
def _(spark, sf):
    c, k = F.col("tarjeta_raw"), F.col("l_partkey") % 4
    card = (
        F.when(k == 0, F.concat(c, F.lit("..")))
        .when(k == 1, F.concat(F.lit(" 99,"), F.lpad(c, 16, "9")))
        .when(k == 2, F.concat(c, F.lit(".25"))).otherwise(c))
    df = v.ledger_raw(spark, sf).select(card.alias("card"))
    return _mapped(df, "card", norm=text.normalize_card(F.col("card")))


@query("fn_clean_tag", """
SELECT tag, CASE WHEN regexp_matches(t, '^\\d{8}$') THEN 'IMDM' || t ELSE t END AS clean, count(*) AS n
FROM (SELECT tag, rtrim(replace(trim(tag), ' ', ''), '.') AS t FROM (
  SELECT CASE l_linenumber % 3 WHEN 0 THEN lpad(tarjeta_raw, 8, '0') || '.' WHEN 1 THEN ' 12 ' || tarjeta_raw
    ELSE tarjeta_raw END AS tag FROM ledger_raw)) GROUP BY ALL""")
def _(spark, sf):
    c, k = F.col("tarjeta_raw"), F.col("l_linenumber") % 3
    tag = F.when(k == 0, F.concat(F.lpad(c, 8, "0"), F.lit("."))).when(
        k == 1, F.concat(F.lit(" 12 "), c)).otherwise(c)
    df = v.ledger_raw(spark, sf).select(tag.alias("tag"))
    return _mapped(df, "tag", clean=text.clean_tag(F.col("tag")))


@query("fn_strip_float", _sql("ledger_raw", "tarjeta_raw", clean=(
    r"CASE WHEN tarjeta_raw = 'nan' THEN '' ELSE trim(regexp_replace(tarjeta_raw, '\.0$', '')) END")))
def _(spark, sf):
    return _mapped(v.ledger_raw(spark, sf), "tarjeta_raw", clean=text.strip_float(F.col("tarjeta_raw")))


@query("fn_blank_to_null", _sql("ledger_raw", "tarjeta_raw", clean=(
    "CASE WHEN trim(tarjeta_raw) <> '' AND lower(trim(tarjeta_raw)) <> 'nan' THEN trim(tarjeta_raw) END")))
def _(spark, sf):
    return _mapped(v.ledger_raw(spark, sf), "tarjeta_raw", clean=text.blank_to_null(F.col("tarjeta_raw")))


_MONTHS = ("['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre','Octubre',"
           "'Noviembre','Diciembre']")


@query("fn_month_name", f"""
SELECT month(l_shipdate) AS m, {_MONTHS}[month(l_shipdate)] AS name,
  {_MONTHS}[month(l_shipdate)] || ' ' || year(l_shipdate) AS title,
  lpad(CAST(month(l_shipdate) AS VARCHAR), 2, '0') || ' - ' || {_MONTHS}[month(l_shipdate)] AS label, count(*) AS n
FROM lineitem GROUP BY ALL""")
def _(spark, sf):
    m = F.month("l_shipdate")
    return v.table(spark, sf, "lineitem").select(
        m.cast("bigint").alias("m"), dates.month_name(m).alias("name"),
        dates.month_title(dates.year_month("l_shipdate")).alias("title"),
        dates.month_label(m).alias("label")).groupBy("m", "name", "title", "label").agg(F.count("*").alias("n"))


@query("fn_week_of_month", """
SELECT fecha_raw, CAST(coalesce((day(f) - 1) // 7 + 1, 0) AS BIGINT) AS week, count(*) AS n
FROM (SELECT fecha_raw, """ + s.parse_day("fecha_raw") + """ AS f FROM ledger_raw) GROUP BY ALL""")
def _(spark, sf):
    return _mapped(v.ledger_raw(spark, sf), "fecha_raw", week=dates.week_of_month(
        dates.parse_date_ladder(F.col("fecha_raw"))).cast("bigint"))


@query("fn_calendar_parts", """
SELECT event_id, year(ts) AS y, month(ts) AS m, strftime(ts, '%Y-%m') AS ym,
  ['Domingo','Lunes','Martes','Miércoles','Jueves','Viernes','Sábado'][dayofweek(ts) + 1] AS d,
  round(hour(ts) + minute(ts) / 60.0, 6) AS h
FROM events""")
def _(spark, sf):
    return v.table(spark, sf, "events").select(
        "event_id", F.year("ts").cast("bigint").alias("y"), F.month("ts").cast("bigint").alias("m"),
        dates.year_month("ts").alias("ym"), dates.day_name("ts").alias("d"),
        F.round(dates.hour_fraction("ts"), 6).alias("h"))


@query("fn_ytd_flags", """
SELECT fecha_raw, coalesce((year(f) = 1998 AND month(f) <= 6) OR year(f) < 1998, false) AS es_ytd,
  coalesce(month(f) <= 6, false) AS incluir_en_kpi, count(*) AS n
FROM (SELECT fecha_raw, """ + s.parse_day("fecha_raw") + """ AS f FROM ledger_raw) GROUP BY ALL""")
def _(spark, sf):
    f = dates.parse_date_ladder(F.col("fecha_raw"))
    return _mapped(
        v.ledger_raw(spark, sf), "fecha_raw", es_ytd=dates.is_ytd(F.year(f), F.month(f), v.AS_OF),
        incluir_en_kpi=dates.in_kpi(F.month(f), v.AS_OF))


@query("fn_zero_to_null", """
SELECT l_partkey, l_quantity, nullif(l_quantity - 10, 0) AS litros, count(*) AS n FROM lineitem GROUP BY ALL""")
def _(spark, sf):
    return v.table(spark, sf, "lineitem").select(
        "l_partkey", "l_quantity", amounts.zero_to_null(F.col("l_quantity") - 10).alias("litros"),
    ).groupBy("l_partkey", "l_quantity", "litros").agg(F.count("*").alias("n"))


@query("fn_default_dims", """
SELECT ECO, coalesce(Empresa, 'SIN INFORMACIÓN') AS Empresa, coalesce(Sucursal, 'SIN INFORMACIÓN') AS Sucursal,
  coalesce(Concepto, 'SIN ACTIVIDAD') AS Concepto, coalesce(Sistema, 'N/A') AS Sistema,
  coalesce(Importe, 0) AS Importe, pos
FROM (SELECT *, CASE WHEN pos % 2 = 0 THEN 'PEAJES' END AS Concepto, CASE WHEN pos % 2 = 0 THEN 'Pase' END AS Sistema,
  CASE WHEN pos % 2 = 0 THEN CAST(pos AS DOUBLE) END AS Importe FROM master)""")
def _(spark, sf):
    from fleetbook.plans.dashboard import default_dimensions

    even = F.col("pos") % 2 == 0
    df = v.master(spark, sf).withColumns({
        "Concepto": F.when(even, "PEAJES"), "Sistema": F.when(even, "Pase"),
        "Importe": F.when(even, F.col("pos").cast("double"))})
    return default_dimensions(df).select("ECO", "Empresa", "Sucursal", "Concepto", "Sistema", "Importe", "pos")


@query("fn_sanitize_path", r"""
SELECT page_id, CASE WHEN p = '' THEN 'sin_empresa' ELSE p END AS folder FROM (
  SELECT page_id, regexp_replace(regexp_replace(regexp_replace(trim(t), '[\\/]+', '-', 'g'), '\s+', '_', 'g'),
    '[^A-Za-z0-9._-]', '', 'g') AS p
  FROM (SELECT page_id, CASE WHEN page_id % 5 = 0 THEN '' WHEN page_id % 7 = 0 THEN '%%'
    ELSE url || ' S.A. de  C.V. ' END AS t FROM pages))""")
def _(spark, sf):
    i = F.col("page_id")
    t = F.when(i % 5 == 0, "").when(i % 7 == 0, "%%").otherwise(F.concat("url", F.lit(" S.A. de  C.V. ")))
    return v.table(spark, sf, "pages").select("page_id", text.sanitize_path(t).alias("folder"))


@query("fn_strip_hash_prefix", "SELECT Archivo_Origen, plain AS name, count(*) AS n FROM ledger_raw GROUP BY ALL")
def _(spark, sf):
    return _mapped(v.ledger_raw(spark, sf), "Archivo_Origen", name=keys.strip_hash_prefix(F.col("Archivo_Origen")))


@query("fn_client_number", r"""
SELECT name, nullif(regexp_extract(name, '(?i)^g\d+[A-Z](\d+)\.\d+\.csv$', 1), '') AS client,
  nullif(regexp_extract(name, '(?i)\.(\d+)\.csv$', 1), '') AS period,
  nullif(regexp_extract(name || ' número de cliente : ' || c_custkey, '(?i)(?:NÚMERO|NUMERO)\s+DE\s+CLIENTE\s*:\s*(\d+)', 1), '') AS in_text
FROM (SELECT c_custkey, regexp_extract(path, '[^/]*$') AS name FROM file_listing)""")
def _(spark, sf):
    name = keys.base_name(F.col("path"))
    words = F.concat(name, F.lit(" número de cliente : "), F.col("c_custkey").cast("string"))
    return v.file_listing(spark, sf).select(
        name.alias("name"), keys.client_number_in_file(name).alias("client"),
        keys.period_code_in_file(name).alias("period"), keys.client_number_in_text(words).alias("in_text"))


@query("fn_company_from_text", r"""
SELECT c_custkey, CASE WHEN len(l) = 0 THEN 'sin_empresa'
  WHEN len(l) >= 2 AND (starts_with(upper(l[1]), 'NÚMERO DE CLIENTE') OR starts_with(upper(l[1]), 'NUMERO DE CLIENTE'))
  THEN l[2] ELSE l[1] END AS company
FROM (SELECT c_custkey, list_filter(list_transform(string_split(t, chr(10)), lambda x: trim(x)), lambda x: x <> '') AS l
  FROM (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN chr(10) || ' ' WHEN 1 THEN ' Número de cliente: 5' || chr(10) || chr(10) || c_name
    WHEN 2 THEN 'NUMERO DE CLIENTE: 1' ELSE ' ' || c_name || ' ' || chr(10) || c_mktsegment END AS t FROM customer))""")
def _(spark, sf):
    i, n = F.col("c_custkey") % 4, F.lit("\n")
    t = (
        F.when(i == 0, "\n ").when(i == 1, F.concat(F.lit(" Número de cliente: 5\n\n"), "c_name"))
        .when(i == 2, "NUMERO DE CLIENTE: 1")
        .otherwise(F.concat(F.lit(" "), "c_name", F.lit(" "), n, "c_mktsegment")))
    return v.table(spark, sf, "customer").select("c_custkey", text.company_from_text(t).alias("company"))


_TARGETS = dates.months_between_dates(dt.date(1996, 1, 1), dt.date(1997, 12, 1))
_NAMES_UP = _MONTHS.upper()


@query("fn_period_to_month", f"""
SELECT o_orderkey, CASE WHEN kind < 3 THEN (SELECT min(t) FROM (SELECT unnest(range(1, 13)) + 199600 AS t
    UNION ALL SELECT unnest(range(1, 13)) + 199700) WHERE t BETWEEN lo AND hi) END AS target
FROM (SELECT o_orderkey, kind,
    CASE WHEN kind = 2 OR sm <= em THEN y ELSE y - 1 END * 100 + CASE WHEN kind = 2 THEN em ELSE sm END AS lo,
    y * 100 + em AS hi
  FROM (SELECT o_orderkey, o_orderkey % 4 AS kind, month(o_orderdate) AS sm,
    (month(o_orderdate) % 12) + 1 AS em, year(o_orderdate) AS y FROM orders))""")
def _(spark, sf):
    names = F.array(*[F.lit(m.upper()) for m in v_months()])
    start = F.get(names, F.month("o_orderdate") - 1)
    end = F.get(names, F.month("o_orderdate") % 12)
    year = F.year("o_orderdate").cast("string")
    kind = F.col("o_orderkey") % 4
    t = (
        F.when(kind < 2, F.concat(F.lit("Del 16 de "), F.lower(start), F.lit(" AL 15 DE "), end, F.lit(" DEL "), year))
        .when(kind == 2, F.concat(F.lit("PERIODO: "), end, F.lit("  DEL "), year))
        .otherwise(F.concat(F.lit("PERIODO "), end)))
    return v.table(spark, sf, "orders").select(
        "o_orderkey", dates.period_to_month(t, _TARGETS).cast("bigint").alias("target"))


def v_months():
    from fleetbook.vocabulary import MONTH_NAMES

    return MONTH_NAMES


@query("fn_month_spine", """
SELECT month_start, count(*) AS n FROM (
  SELECT CAST(unnest(generate_series(date_trunc('month', o_orderdate),
    date_trunc('month', o_orderdate + INTERVAL 75 DAY), INTERVAL 1 MONTH)) AS DATE) AS month_start FROM orders)
GROUP BY ALL""")
def _(spark, sf):
    start = F.col("o_orderdate").cast("date")
    months = dates.month_sequence(start, F.date_add(start, 75))
    return v.table(spark, sf, "orders").select(F.explode(months).alias("month_start")).groupBy(
        "month_start").agg(F.count("*").alias("n"))


@query("src_dedupe_headers", """
SELECT l_orderkey, position, name || CASE WHEN k = 1 THEN '' ELSE '__dup' || k END AS name FROM (
  SELECT l_orderkey, position, name,
    row_number() OVER (PARTITION BY l_orderkey, l_partkey, l_linenumber, l_suppkey, name ORDER BY position) AS k
  FROM (SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, unnest(h) AS name, generate_subscripts(h, 1) AS position
    FROM (SELECT DISTINCT l_orderkey, l_partkey, l_linenumber, l_suppkey,
      ['Fecha', 'H' || (l_partkey % 3), 'H' || (l_suppkey % 3), 'H' || (l_linenumber % 3), 'Fecha'] AS h FROM lineitem)))""")
def _(spark, sf):
    def name(c):
        return F.concat(F.lit("H"), (F.col(c) % 3).cast("string"))

    rows = v.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey").distinct()
    header = F.array(F.lit("Fecha"), name("l_partkey"), name("l_suppkey"), name("l_linenumber"), F.lit("Fecha"))
    return rows.select("l_orderkey", header.alias("h")).select(
        "l_orderkey", F.posexplode(dedupe_headers(F.col("h"))).alias("p", "name")).select(
        "l_orderkey", (F.col("p") + 1).cast("bigint").alias("position"), "name")

"""Joins, aggregates, windows and reports over the ledger."""

from pyspark.sql import functions as F

from fleetbook.operators.positions import with_positions
from fleetbook.operators import aggregates, joins
from fleetbook.plans import cards, dashboard, recon, trips, yoy
from fleetbook.session import scratch_dir
from fleetbook.sources.maps import json_map

from . import views as v
from .registry import query
from .views_sql import cents_sum, norm_eco, norm_eco_lzc

A, B, M = v.YEAR_A, v.YEAR_B, v.MONTH

# --- two years ---

_UNITS = f"""
SELECT month(Fecha) AS Mes, count(DISTINCT CASE WHEN year(Fecha) = {A} THEN ECO END) AS Unidades_{A},
  count(DISTINCT CASE WHEN year(Fecha) = {B} THEN ECO END) AS Unidades_{B}
FROM ledger WHERE year(Fecha) IN ({A}, {B}) GROUP BY 1"""


@query("agg_units_by_month", _UNITS)
def _(spark, sf):
    return aggregates.units_by_month(v.ledger(spark, sf), A, B)


_TWELVE = f"""
WITH u AS ({_UNITS}), m AS (
  SELECT CAST(i AS INT) AS Mes, CAST(coalesce(Unidades_{A}, 0) AS DOUBLE) AS Unidades_{A},
    CAST(coalesce(Unidades_{B}, 0) AS DOUBLE) AS Unidades_{B}
  FROM range(1, 13) r(i) LEFT JOIN u ON u.Mes = i),
t AS (SELECT * FROM m UNION ALL SELECT 13, round(avg(Unidades_{A}), 6), round(avg(Unidades_{B}), 6) FROM m)
SELECT *, round(Unidades_{B} - Unidades_{A}, 6) AS Diferencia FROM t"""


@query("agg_units_12m", _TWELVE)
def _(spark, sf):
    return aggregates.units_twelve_months(aggregates.units_by_month(v.ledger(spark, sf), A, B), A, B)


_DETAIL = f"""
SELECT ECO, Sistema, year(Fecha) AS Anio, count(*) AS Regs, {cents_sum('Importe')} AS Importe
FROM ledger WHERE month(Fecha) = {M} AND year(Fecha) IN ({A}, {B}) GROUP BY ALL"""


@query("agg_month_detail", _DETAIL)
def _(spark, sf):
    return aggregates.month_detail(v.ledger(spark, sf), M, A, B)


def _compare(system=None):
    where = f"WHERE Sistema = '{system}'" if system else ""
    def year(y):
        return (
            f"coalesce(string_agg(DISTINCT Sistema, ', ' ORDER BY Sistema) FILTER (Anio = {y}), '') AS Sistemas_{y}, "
            f"CAST(coalesce(sum(Regs) FILTER (Anio = {y}), 0) AS BIGINT) AS Regs_{y}, "
            f"coalesce({cents_sum('CASE WHEN Anio = %d THEN Importe END' % y)}, 0) AS Importe_{y}")
    return f"""
SELECT *, CASE WHEN Regs_{A} > 0 THEN 'SÍ' ELSE 'NO' END AS En_{A}, CASE WHEN Regs_{B} > 0 THEN 'SÍ' ELSE 'NO' END AS En_{B},
  CASE WHEN Regs_{A} > 0 AND Regs_{B} > 0 THEN 'AMBOS' WHEN Regs_{B} > 0 THEN 'SOLO_{B}' ELSE 'SOLO_{A}' END AS Presencia
FROM (SELECT ECO, {year(A)}, {year(B)} FROM detail {where} GROUP BY ECO)"""


_WITH_DETAIL = f"WITH detail AS ({_DETAIL}) "


def _month_detail(spark, sf):
    return aggregates.month_detail(v.ledger(spark, sf), M, A, B)


@query("agg_yoy_compare", _WITH_DETAIL + _compare())
def _(spark, sf):
    return yoy.compare_years(_month_detail(spark, sf), A, B)


@query("agg_yoy_compare_system", _WITH_DETAIL + _compare("Edenred"))
def _(spark, sf):
    return yoy.compare_years(_month_detail(spark, sf), A, B, "Edenred")


@query("join_full_yoy", f"""
WITH y AS (SELECT ECO, year(Fecha) AS Anio, count(*) AS Regs, {cents_sum('Importe')} AS Importe FROM ledger GROUP BY ALL)
SELECT coalesce(a.ECO, b.ECO) AS ECO, coalesce(a.Regs, 0) AS Regs_{A}, coalesce(a.Importe, 0) AS Importe_{A},
  coalesce(b.Regs, 0) AS Regs_{B}, coalesce(b.Importe, 0) AS Importe_{B}
FROM (SELECT * FROM y WHERE Anio = {A}) a FULL JOIN (SELECT * FROM y WHERE Anio = {B}) b ON a.ECO = b.ECO""")
def _(spark, sf):
    rows = v.ledger(spark, sf).filter(aggregates.in_years(F.col("Fecha"), A, B))
    detail = rows.groupBy("ECO", "Sistema", F.year("Fecha").alias("Anio")).agg(
        F.count("*").alias("Regs"), aggregates.sum_cents(F.col("Importe")).alias("Importe"))
    return yoy.compare_years(detail, A, B).select(
        "ECO", f"Regs_{A}", f"Importe_{A}", f"Regs_{B}", f"Importe_{B}")


_SUMS = f"CAST(sum(Regs_{A}) AS BIGINT) AS Regs_{A}, {cents_sum(f'Importe_{A}')} AS Importe_{A}, " \
        f"CAST(sum(Regs_{B}) AS BIGINT) AS Regs_{B}, {cents_sum(f'Importe_{B}')} AS Importe_{B}"
_TOTALS = f"""
WITH detail AS ({_DETAIL}), c AS ({_compare()})
SELECT * FROM c UNION ALL BY NAME SELECT 'Total' AS ECO, {_SUMS} FROM c"""


@query("agg_report_totals", _TOTALS)
def _(spark, sf):
    return yoy.sheet_of(yoy.compare_systems(_month_detail(spark, sf), A, B))


@query("sort_custom_rank", _WITH_DETAIL + f"""
SELECT row_number() OVER (ORDER BY CASE Presencia WHEN 'AMBOS' THEN 1 WHEN 'SOLO_{B}' THEN 2 ELSE 3 END, ECO) AS pos,
  ECO, Presencia FROM ({_compare('Pase')})""")
def _(spark, sf):
    report = yoy.compare_years(_month_detail(spark, sf), A, B, "Pase").select("ECO", "Presencia")
    return with_positions(report, yoy.presence_order(A, B))


@query("sort_report", """
SELECT MES_str, ECO_Limpio, Pase, Supramax, Edenred, "Google Sheets", row_number() OVER (ORDER BY MES_str, ECO_Limpio) AS pos FROM wide""")
def _(spark, sf):
    wide = aggregates.pivot_systems(aggregates.monthly_by_system(v.ledger(spark, sf), "1900-01-01"))
    return with_positions(wide, ["MES_str", "ECO_Limpio"])


# --- catalogue ---

_CATALOG = f"""
SELECT coalesce(m.ECO, g.ECO) AS ECO, CASE WHEN m.ECO IS NULL THEN 'NO' ELSE 'SÍ' END AS En_Tabla_Maestra,
  coalesce(m.Empresa, 'N/A') AS Empresa_Catalogo,
  coalesce(string_agg(DISTINCT g.Sistema, ', ' ORDER BY g.Sistema), 'SIN ACTIVIDAD') AS Sistemas,
  coalesce(string_agg(DISTINCT CASE WHEN g.ECO IS NOT NULL THEN coalesce(g.Empresa, 'N/A') END, ', '
    ORDER BY CASE WHEN g.ECO IS NOT NULL THEN coalesce(g.Empresa, 'N/A') END), 'N/A') AS Empresas_en_Txs,
  count(g.ECO) AS Total_Transacciones, coalesce({cents_sum('g.Importe')}, 0) AS Total_Importe,
  min(g.Fecha) AS Primera_Transaccion, max(g.Fecha) AS Ultima_Transaccion
FROM catalog m FULL JOIN ledger g ON m.ECO = g.ECO GROUP BY 1, 2, 3"""


@query("agg_catalog", _CATALOG)
def _(spark, sf):
    return yoy.catalog_check(v.ledger(spark, sf), v.catalog(spark, sf))


@query("join_full_catalog", f"""
SELECT coalesce(m.ECO, g.ECO) AS ECO, m.Empresa AS Empresa_Catalogo, g.n FROM catalog m
FULL JOIN (SELECT ECO, count(*) AS n FROM ledger GROUP BY ECO) g ON m.ECO = g.ECO""")
def _(spark, sf):
    used = v.ledger(spark, sf).groupBy("ECO").agg(F.count("*").alias("n"))
    listed = v.catalog(spark, sf).withColumnRenamed("Empresa", "Empresa_Catalogo")
    return joins.full_outer_with_catalog(used, listed, "ECO").select("ECO", "Empresa_Catalogo", "n")


_NAMES = f"""
SELECT ECO, arg_max(t, p) AS ECO_Original FROM (
  SELECT {norm_eco('eco_raw')} AS ECO, trim(eco_raw) AS t, min(row_idx * 10 + l_linenumber) AS p FROM ledger_raw GROUP BY ALL)
WHERE contains(t, 'LZC') AND t <> ECO GROUP BY ECO"""


def _names(spark, sf):
    raw = v.ledger_raw(spark, sf).withColumn("pos", F.col("row_idx") * 10 + F.col("l_linenumber"))
    return joins.original_names(raw, "eco_raw", "pos")


@query("join_original_name", f"""
WITH names AS ({_NAMES})
SELECT c.ECO, coalesce(n.ECO_Original, c.ECO) AS ECO_Original, c.Total_Transacciones
FROM ({_CATALOG}) c LEFT JOIN names n ON n.ECO = c.ECO""")
def _(spark, sf):
    check = yoy.catalog_check(v.ledger(spark, sf), v.catalog(spark, sf)).select("ECO", "Total_Transacciones")
    return yoy.with_original_names(check, _names(spark, sf))


_REPORT = f"""
WITH detail AS ({_DETAIL}), names AS ({_NAMES}), general AS ({_TWELVE}), cat AS ({_CATALOG}),
lines AS (
  SELECT 'RESUMEN GENERAL' AS hoja, CAST(Mes AS VARCHAR) AS linea, Unidades_{A} AS a, Unidades_{B} AS b FROM general
  UNION ALL SELECT 'COMPARATIVA', ECO || ' ' || Presencia, Importe_{A}, Importe_{B} FROM ({_compare()})
  UNION ALL SELECT 'PASE', ECO || ' ' || Presencia, Importe_{A}, Importe_{B} FROM ({_compare('Pase')})
  UNION ALL SELECT 'SUPRAMAX', ECO || ' ' || Presencia, Importe_{A}, Importe_{B} FROM ({_compare('Supramax')})
  UNION ALL SELECT 'EDENRED', ECO || ' ' || Presencia, Importe_{A}, Importe_{B} FROM ({_compare('Edenred')})
  UNION ALL SELECT 'MANTENIMIENTOS', ECO || ' ' || Presencia, Importe_{A}, Importe_{B} FROM ({_compare('Google Sheets')})
  UNION ALL SELECT 'VALIDACION CATALOGO', c.ECO || ' ' || coalesce(ECO_Original, c.ECO), CAST(Total_Transacciones AS DOUBLE),
    Total_Importe FROM cat c LEFT JOIN names n ON n.ECO = c.ECO)
SELECT hoja, linea, a, b FROM lines
UNION ALL SELECT hoja, 'Total', {cents_sum('a')}, {cents_sum('b')} FROM lines WHERE hoja <> 'RESUMEN GENERAL' GROUP BY hoja"""


def _lines(sheets):
    """Text and both numbers of every line of the sheets."""
    def lines(title, df):
        if title == "RESUMEN GENERAL":
            text, a, b = F.col("Mes").cast("string"), f"Unidades_{A}", f"Unidades_{B}"
        elif title == "VALIDACION CATALOGO":
            text, a, b = F.concat_ws(" ", "ECO", "ECO_Original"), "Total_Transacciones", "Total_Importe"
        else:
            text, a, b = F.concat_ws(" ", "ECO", "Presencia"), f"Importe_{A}", f"Importe_{B}"
        return df.select(F.lit(title).alias("hoja"), text.alias("linea"),
                         F.col(a).cast("double").alias("a"), F.col(b).cast("double").alias("b"))

    frames = [lines(t, d) for t, d in sheets.items()]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


@query("job_yoy_report", _REPORT)
def _(spark, sf):
    return _lines(yoy.yoy_report(v.ledger(spark, sf), v.catalog(spark, sf), _names(spark, sf), M, A, B))


@query("sink_report_tables", _REPORT)
def _(spark, sf):
    """All seven sheets, written and read back."""
    from fleetbook.operators.reports import write_tables
    from fleetbook.session import scratch_dir

    sheets = yoy.yoy_report(v.ledger(spark, sf), v.catalog(spark, sf), _names(spark, sf), M, A, B)
    paths = write_tables(sheets, scratch_dir(spark, "report"))
    return _lines({title: spark.read.parquet(path) for title, path in paths.items()})


@query("sink_report_csv", f"""
WITH detail AS ({_DETAIL}), c AS ({_compare('Pase')})
SELECT * FROM c UNION ALL BY NAME SELECT 'Total' AS ECO, {_SUMS} FROM c""")
def _(spark, sf):
    """A system's sheet as CSV and back, all columns."""
    from fleetbook.operators.reports import write_tables
    from fleetbook.session import scratch_dir

    sheet = yoy.sheet_of(yoy.compare_systems(_month_detail(spark, sf), A, B), "Pase")
    paths = write_tables({"PASE": sheet}, scratch_dir(spark, "report"), "csv")
    # An empty text and none are one in CSV; systems of a year without rows are an empty text.
    back = spark.read.schema(sheet.schema).csv(paths["PASE"], header=True)
    return back.withColumns({f"Sistemas_{y}": F.when(F.col("ECO") != "Total", F.coalesce(f"Sistemas_{y}", F.lit(""))) for y in (A, B)})


# --- manual reconciliation ---

_SINCE = v.SINCE.isoformat()


@query("agg_monthly_system", f"SELECT * FROM monthly WHERE MES_str >= '{_SINCE[:7]}'")
def _(spark, sf):
    return aggregates.monthly_by_system(v.ledger(spark, sf), v.SINCE)


@query("agg_pivot_system", "SELECT * FROM wide")
def _(spark, sf):
    return aggregates.pivot_systems(aggregates.monthly_by_system(v.ledger(spark, sf), "1900-01-01"))


_MANUAL = f"""
SELECT replace(upper(trim(UNIDAD)), ' ', '') AS ECO_Limpio, strftime(MES, '%Y-%m') AS MES_str,
  {cents_sum('"IAVE PASE"')} AS "IAVE PASE", {cents_sum('SUPRAMAX')} AS SUPRAMAX,
  {cents_sum('"TICKET CARD"')} AS "TICKET CARD", {cents_sum('MANTENIMIENTO')} AS MANTENIMIENTO
FROM manual WHERE MES IS NOT NULL GROUP BY ALL"""


@query("agg_manual_sums", _MANUAL)
def _(spark, sf):
    return recon.manual_sums(v.manual(spark, sf))


_CROSS = f"""
SELECT coalesce(m.ECO_Limpio, w.ECO_Limpio) AS ECO_Limpio, coalesce(m.MES_str, w.MES_str) AS MES_str,
  coalesce("IAVE PASE", 0) AS "IAVE PASE", coalesce(SUPRAMAX, 0) AS SUPRAMAX, coalesce("TICKET CARD", 0) AS "TICKET CARD",
  coalesce(MANTENIMIENTO, 0) AS MANTENIMIENTO, coalesce(Pase, 0) AS Pase, coalesce(w.Supra, 0) AS Supra,
  coalesce(Edenred, 0) AS Edenred, coalesce("Google Sheets", 0) AS "Google Sheets"
FROM ({_MANUAL}) m FULL JOIN (SELECT * RENAME (Supramax AS Supra) FROM wide WHERE MES_str >= '{_SINCE[:7]}') w
  ON m.ECO_Limpio = w.ECO_Limpio AND m.MES_str = w.MES_str"""


def _crossed(spark, sf):
    automated = aggregates.pivot_systems(aggregates.monthly_by_system(v.ledger(spark, sf), v.SINCE))
    manual = recon.manual_sums(v.manual(spark, sf))
    return recon.cross(manual, automated)


@query("join_full_manual", f"""
SELECT ECO_Limpio, MES_str, "IAVE PASE" AS m_pase, SUPRAMAX AS m_supramax, "TICKET CARD" AS m_edenred,
  MANTENIMIENTO AS m_mantenimientos, Pase AS a_pase, Supra AS a_supramax, Edenred AS a_edenred,
  "Google Sheets" AS a_mantenimientos FROM ({_CROSS})""")
def _(spark, sf):
    return _crossed(spark, sf)


_BY_SYSTEM = f"""
SELECT ECO_Limpio, MES_str, Concepto, CAST(m AS DECIMAL(18,2)) AS m, CAST(a AS DECIMAL(18,2)) AS a FROM (
  SELECT ECO_Limpio, MES_str, 'Pase' AS Concepto, "IAVE PASE" AS m, Pase AS a FROM c
  UNION ALL SELECT ECO_Limpio, MES_str, 'Supramax', SUPRAMAX, Supra FROM c
  UNION ALL SELECT ECO_Limpio, MES_str, 'Edenred', "TICKET CARD", Edenred FROM c
  UNION ALL SELECT ECO_Limpio, MES_str, 'Mantenimientos', MANTENIMIENTO, "Google Sheets" FROM c)
WHERE m > 0 OR a > 0"""
_MONTHS = ("['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre','Octubre',"
           "'Noviembre','Diciembre']")
_RECON_DETAIL = f"""
SELECT Concepto, MES_str, {_MONTHS}[CAST(substr(MES_str, 6, 2) AS INT)] || ' ' || substr(MES_str, 1, 4) AS Mes,
  ECO_Limpio AS Unidad, CAST(m AS DOUBLE) AS Manual, CAST(a AS DOUBLE) AS Automatico, CAST(a - m AS DOUBLE) AS Diferencia,
  CASE WHEN m = 0 AND a > 0 THEN '❌ FALTA EN REPORTE MANUAL' WHEN m > 0 AND a = 0 THEN '⚠️ FALTA EN BOT AUTOMÁTICO'
    WHEN m > 0 AND a > 0 AND a <> m THEN '📊 DIFERENCIA DE MONTO' WHEN m > 0 AND a > 0 THEN '✅ CUADRA PERFECTO'
    ELSE '⚪ SIN MOVIMIENTO' END AS Estado FROM s"""


@query("agg_recon_detail", f"WITH c AS ({_CROSS}), s AS ({_BY_SYSTEM}) {_RECON_DETAIL}")
def _(spark, sf):
    return recon.detail(_crossed(spark, sf))


_SUMMARY = """
SELECT MES_str, Concepto, CAST(tm AS DOUBLE) AS Total_Manual, CAST(ta AS DOUBLE) AS Total_Auto,
  CAST(ta - tm AS DOUBLE) AS Diferencia,
  round(CASE WHEN tm <> 0 THEN CAST(ta - tm AS DOUBLE) / CAST(tm AS DOUBLE) ELSE 0 END, 6) AS Variacion,
  ua AS Unidades_Solo_Auto, ia AS Importe_Solo_Auto, um AS Unidades_Solo_Manual, im AS Importe_Solo_Manual, ub AS Unidades_Ambos
FROM (SELECT MES_str, Concepto, sum(m) AS tm, sum(a) AS ta, count(*) FILTER (m = 0 AND a > 0) AS ua,
  CAST(coalesce(sum(a) FILTER (m = 0 AND a > 0), 0) AS DOUBLE) AS ia, count(*) FILTER (m > 0 AND a = 0) AS um,
  CAST(coalesce(sum(m) FILTER (m > 0 AND a = 0), 0) AS DOUBLE) AS im, count(*) FILTER (m > 0 AND a > 0) AS ub
  FROM s GROUP BY ALL) WHERE tm <> 0 OR ta <> 0"""


@query("agg_recon_summary", f"WITH c AS ({_CROSS}), s AS ({_BY_SYSTEM}) {_SUMMARY}")
def _(spark, sf):
    return recon.summary(_crossed(spark, sf))


@query("job_manual_recon", f"""
WITH c AS ({_CROSS}), s AS ({_BY_SYSTEM}), d AS ({_RECON_DETAIL}), r AS ({_SUMMARY})
SELECT 'detalle' AS hoja, Concepto, MES_str, Unidad || ' ' || Estado AS linea, Diferencia FROM d
UNION ALL SELECT 'resumen', Concepto, MES_str, CAST(Unidades_Ambos AS VARCHAR), Diferencia FROM r""")
def _(spark, sf):
    detail, summary = recon.reconcile(v.ledger(spark, sf), v.manual(spark, sf), v.SINCE)
    return detail.select(
        F.lit("detalle").alias("hoja"), "Concepto", "MES_str",
        F.concat_ws(" ", "Unidad", "Estado").alias("linea"), "Diferencia").unionByName(
        summary.select(F.lit("resumen").alias("hoja"), "Concepto", "MES_str",
                       F.col("Unidades_Ambos").cast("string").alias("linea"), "Diferencia"))


# --- files ---


@query("agg_dominant_month", """
SELECT Archivo_Origen, CAST(year(ts) AS INT) AS Anio, CAST(month(ts) AS INT) AS Mes FROM (
  SELECT *, row_number() OVER (PARTITION BY Archivo_Origen ORDER BY n DESC, ts) AS k
  FROM (SELECT Archivo_Origen, Fecha AS ts, count(*) AS n FROM ledger GROUP BY ALL)) WHERE k = 1""")
def _(spark, sf):
    return aggregates.dominant_month(v.ledger(spark, sf), "Fecha")


@query("agg_dominant_month_by_month", """
SELECT Archivo_Origen, CAST(year(ts) AS INT) AS Anio, CAST(month(ts) AS INT) AS Mes FROM (
  SELECT *, row_number() OVER (PARTITION BY Archivo_Origen ORDER BY n DESC, ts) AS k
  FROM (SELECT Archivo_Origen, date_trunc('month', Fecha) AS ts, count(*) AS n FROM ledger GROUP BY ALL)) WHERE k = 1""")
def _(spark, sf):
    return aggregates.dominant_month(v.ledger(spark, sf), "Fecha", by="month")


@query("agg_file_subtotals", f"""
SELECT Archivo_Origen, CAST(grouping(Archivo_Origen) AS INT) AS es_total, {cents_sum('Importe')} AS Importe
FROM ledger GROUP BY ROLLUP (Archivo_Origen)""")
def _(spark, sf):
    return aggregates.file_subtotals(v.ledger(spark, sf))


# --- cards ---

_CARDS = f"""
SELECT {norm_eco('eco_raw')} AS ECO, Sistema,
  CASE WHEN tarjeta_raw IN ('', 'nan') THEN NULL ELSE regexp_replace(tarjeta_raw, '\\.0$', '') END AS card,
  CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE l_shipdate END AS d FROM ledger_raw"""
_VALID = "regexp_matches(ECO, '^(AU|CA)-\\d{3}$') AND card IS NOT NULL"


def _latest(system):
    return f"""
SELECT ECO, card FROM (SELECT *, row_number() OVER (PARTITION BY ECO ORDER BY d DESC NULLS FIRST, card DESC) AS k
  FROM (SELECT * FROM ({_CARDS}) WHERE Sistema = '{system}' AND {_VALID})) WHERE k = 1"""


def _card_rows(spark, sf, system):
    date = F.when(F.col("l_partkey") % 13 != 0, F.col("l_shipdate"))
    return v.ledger_raw(spark, sf).filter(F.col("Sistema") == system).withColumn("d", date)


def _card_map(spark, sf, system, name):
    return cards.system_map(_card_rows(spark, sf, system), "eco_raw", "tarjeta_raw", "d", name)


@query("win_latest_card", _latest("Supramax"))
def _(spark, sf):
    return _card_map(spark, sf, "Supramax", "card")


@query("agg_card_list", f"""
SELECT ECO, string_agg(DISTINCT card, ' | ' ORDER BY card) AS card FROM ({_CARDS}) WHERE {_VALID} GROUP BY ECO""")
def _(spark, sf):
    from fleetbook.functions.eco import is_unit, normalize_eco
    from fleetbook.functions.text import normalize_card

    raw = v.ledger_raw(spark, sf).filter(is_unit(F.col("eco_raw")))
    rows = raw.select(normalize_eco(F.col("eco_raw")).alias("ECO"), normalize_card(F.col("tarjeta_raw")).alias("card"))
    return aggregates.card_list(rows, "card")


_TAGS = "SELECT key, arg_max(value, s_suppkey) AS value FROM tags {where} GROUP BY key"


def _tags(spark, sf, where):
    s = v.tag_json(spark, sf).filter(where)
    rows = s.select("s_suppkey", F.explode(F.from_json("json", "map<string,string>")).alias("key", "value"))
    return aggregates.last_tags(rows, "key", "value", "s_suppkey")


@query("agg_mapped_tags", _TAGS.format(where="WHERE true"))
def _(spark, sf):
    return _tags(spark, sf, "true")


_MASTER_CARDS = f"""
SELECT ECO, arg_max(a, pos) AS Supramax, arg_max(t, pos) AS "Ticket Card", arg_max(p, pos) AS Pase FROM (
  SELECT {norm_eco('ECO')} AS ECO, coalesce(replace("Supramax ID", ' ', ''), '') AS a,
    coalesce(replace("Ticket Card ID", ' ', ''), '') AS t,
    coalesce(rtrim(replace("IAVE Pase ID", ' ', ''), '.'), '') AS p, pos FROM master) GROUP BY ECO"""


@query("join_left_chain", f"""
SELECT k.ECO, s.card AS Supramax, e.card AS "Ticket Card", p.card AS Pase
FROM (SELECT DISTINCT ECO FROM catalog) k LEFT JOIN ({_latest('Supramax')}) s USING (ECO)
LEFT JOIN ({_latest('Edenred')}) e USING (ECO) LEFT JOIN ({_latest('Pase')}) p USING (ECO)""")
def _(spark, sf):
    maps = [_card_map(spark, sf, s, n) for s, n in (("Supramax", "Supramax"), ("Edenred", "Ticket Card"), ("Pase", "Pase"))]
    return joins.left_chain(v.catalog(spark, sf).select("ECO").distinct(), maps)


@query("join_lookup_fallback", f"""
SELECT k.ECO, coalesce(p.card, t.value, nullif(m.Pase, '')) AS Pase
FROM (SELECT DISTINCT ECO FROM catalog UNION SELECT key FROM tags) k LEFT JOIN ({_latest('Pase')}) p USING (ECO)
LEFT JOIN ({_TAGS.format(where='WHERE s_suppkey % 3 = 0')}) t ON t.key = k.ECO LEFT JOIN ({_MASTER_CARDS}) m ON m.ECO = k.ECO""")
def _(spark, sf):
    keys = v.catalog(spark, sf).select("ECO").union(
        json_map(v.tag_json(spark, sf), "json").select("key")).distinct()
    rows = joins.left_chain(keys, [_card_map(spark, sf, "Pase", "Pase")])
    master = cards.master_cards(v.master(spark, sf), "pos")
    return joins.fill_missing(rows, "Pase", [_tags(spark, sf, "s_suppkey % 3 = 0"), master.select("ECO", "Pase")])


@query("job_cards", f"""
WITH m AS ({_MASTER_CARDS}), s AS ({_latest('Supramax')}), e AS ({_latest('Edenred')}), p AS ({_latest('Pase')}),
k AS (SELECT ECO FROM s UNION SELECT ECO FROM e UNION SELECT ECO FROM p UNION SELECT ECO FROM catalog)
SELECT k.ECO, coalesce(s.card, nullif(ts.value, ''), nullif(m.Supramax, ''), '') AS Supramax,
  coalesce(e.card, nullif(m."Ticket Card", ''), '') AS "Ticket Card",
  coalesce(p.card, nullif(tp.value, ''), nullif(m.Pase, ''), '') AS Pase
FROM k LEFT JOIN s USING (ECO) LEFT JOIN e USING (ECO) LEFT JOIN p USING (ECO) LEFT JOIN m USING (ECO)
LEFT JOIN ({_TAGS.format(where='WHERE s_suppkey % 3 = 0')}) tp ON tp.key = k.ECO
LEFT JOIN ({_TAGS.format(where='WHERE s_suppkey % 3 = 1')}) ts ON ts.key = k.ECO""")
def _(spark, sf):
    return cards.cards_report(
        _card_map(spark, sf, "Supramax", "Supramax"), _card_map(spark, sf, "Edenred", "Ticket Card"),
        _card_map(spark, sf, "Pase", "Pase"), v.catalog(spark, sf), _tags(spark, sf, "s_suppkey % 3 = 0"),
        _tags(spark, sf, "s_suppkey % 3 = 1"), cards.master_cards(v.master(spark, sf), "pos"))


# --- dashboard ---

_RAW_UNIT = """CASE l_linenumber WHEN 5 THEN ' pl-' || l_suppkey WHEN 6 THEN 'smx' || l_suppkey ELSE eco_raw END"""


def _with_aliases(spark, sf):
    """Vendor rows where some units are given as plate or vendor id."""
    raw, line = v.ledger_raw(spark, sf), F.col("l_linenumber")
    key = F.col("l_suppkey").cast("string")
    unit = (
        F.when(line == 5, F.concat(F.lit(" pl-"), key)).when(line == 6, F.concat(F.lit("smx"), key))
        .otherwise(F.col("eco_raw")))
    return raw.withColumn("ECO", unit)


_ALIAS = rf"""
SELECT alias, arg_max(eco, pos * 2 + kind) AS eco FROM (
  SELECT replace(replace(upper(Placas), ' ', ''), '-', '') AS alias, 0 AS kind, pos, {norm_eco('ECO')} AS eco FROM master WHERE Placas IS NOT NULL
  UNION ALL SELECT upper("Supramax ID"), 1, pos, {norm_eco('ECO')} FROM master WHERE "Supramax ID" IS NOT NULL) GROUP BY alias"""


def _resolved(cols, src):
    return rf"""
SELECT raw, CASE WHEN regexp_matches(n, '^(AU|CA)-\d{{3}}(\s*LZC)?$') THEN n ELSE coalesce(a.eco, b.eco, n) END AS ECO, {cols}
FROM (SELECT raw, {norm_eco_lzc('raw')} AS n, * EXCLUDE (raw) FROM ({src})) x
LEFT JOIN alias a ON a.alias = replace(replace(upper(trim(raw)), ' ', ''), '-', '')
LEFT JOIN alias b ON b.alias = upper(trim(raw))"""


@query("join_alias_resolve", f"""
WITH alias AS ({_ALIAS}) SELECT raw, ECO, count(*) AS n FROM (
  {_resolved('1 AS one', f'SELECT {_RAW_UNIT} AS raw, 1 AS two FROM ledger_raw')}) GROUP BY ALL""")
def _(spark, sf):
    rows = _with_aliases(spark, sf).select("ECO", F.col("ECO").alias("raw"))
    aliases = joins.alias_table(v.master(spark, sf), "pos")
    return joins.resolve_alias(rows, "ECO", aliases).groupBy("raw", "ECO").agg(F.count("*").alias("n"))


def _dashboard(spark, sf):
    from fleetbook.functions.amounts import parse_money
    from fleetbook.functions.dates import parse_date_ladder
    from fleetbook.vocabulary import CONCEPT_BY_SYSTEM

    concept = F.create_map(*[F.lit(x) for kv in CONCEPT_BY_SYSTEM.items() for x in kv])
    source = _with_aliases(spark, sf).select(
        "ECO", parse_date_ladder(F.col("fecha_raw")).cast("date").alias("Fecha"),
        concept[F.col("Sistema")].alias("Concepto"), F.col("tipo_raw").alias("Tipo"),
        parse_money(F.col("importe_raw")).alias("Importe"), "Sistema", "Cantidad")
    listed = v.master(spark, sf).select("ECO", "Empresa", "Sucursal", "Placas", "Supramax ID", "pos")
    return dashboard.dashboard([source], listed, "pos", v.AS_OF)


_DASHBOARD = rf"""
WITH alias AS ({_ALIAS}), r AS ({_resolved(
    'Fecha, Concepto, Tipo, Importe, Sistema, Cantidad',
    f'SELECT {_RAW_UNIT} AS raw, b.Fecha, b.Concepto, b.tipo_raw AS Tipo, b.Importe, b.Sistema, b.Cantidad FROM typed b')}),
f AS (SELECT DISTINCT ECO, Fecha, Concepto, Tipo, Importe, Sistema, Cantidad FROM r
  WHERE Fecha IS NOT NULL AND Importe IS NOT NULL AND regexp_matches(ECO, '^(AU|CA)-\d{{3}}(\s*LZC)?$')),
m AS (SELECT * REPLACE ({norm_eco_lzc('ECO')} AS ECO) FROM master)
SELECT coalesce(m.ECO, f.ECO) AS ECO, coalesce(m.Empresa, 'SIN INFORMACIÓN') AS Empresa,
  coalesce(Sucursal, 'SIN INFORMACIÓN') AS Sucursal, Placas, "Supramax ID", Fecha, coalesce(Concepto, 'SIN ACTIVIDAD') AS Concepto,
  Tipo, coalesce(Importe, 0) AS Importe, coalesce(Sistema, 'N/A') AS Sistema, nullif(Cantidad, 0) AS Litros,
  CAST(year(Fecha) AS INT) AS Anio, CAST(month(Fecha) AS INT) AS Mes, CAST(coalesce((day(Fecha) - 1) // 7 + 1, 0) AS INT) AS Semana_Mes,
  coalesce((year(Fecha) = 1998 AND month(Fecha) <= 6) OR year(Fecha) < 1998, false) AS es_ytd,
  coalesce(month(Fecha) <= 6, false) AS incluir_en_kpi,
  lpad(CAST(month(Fecha) AS VARCHAR), 2, '0') || ' - ' || {_MONTHS}[month(Fecha)] AS Nombre_Mes
FROM m FULL JOIN f ON regexp_replace(m.ECO, '[^A-Z0-9]', '', 'g') = regexp_replace(f.ECO, '[^A-Z0-9]', '', 'g')"""
_TYPED = """
SELECT l.*, CAST(coalesce(try_strptime(fecha_raw, '%Y/%m/%d'), try_strptime(fecha_raw, '%d/%m/%Y'),
    try_strptime(fecha_raw, '%Y-%m-%d')) AS DATE) AS Fecha,
  CASE Sistema WHEN 'Pase' THEN 'PEAJES' WHEN 'Google Sheets' THEN 'MANTENIMIENTO' ELSE 'COMBUSTIBLE' END AS Concepto,
  abs(TRY_CAST(replace(replace(importe_raw, '$', ''), ',', '') AS DOUBLE)) AS Importe FROM ledger_raw l"""
_DASHBOARD = _DASHBOARD.replace("FROM typed b", f"FROM ({_TYPED}) b")


@query("job_dashboard", _DASHBOARD)
def _(spark, sf):
    return _dashboard(spark, sf)


_EXPORTED = f"""
SELECT {_RAW_UNIT} AS raw, Fecha, CASE Sistema WHEN 'Pase' THEN 'PEAJES' ELSE 'COMBUSTIBLE' END AS Concepto,
  CASE WHEN Sistema <> 'Pase' THEN tipo_raw END AS Tipo, Importe, Sistema,
  CASE WHEN Sistema <> 'Pase' THEN Cantidad END AS Cantidad
FROM ({_TYPED}) WHERE Sistema <> 'Google Sheets'"""


@query("job_dashboard_run", rf"""
WITH alias AS ({_ALIAS}), r AS ({_resolved('Fecha, Concepto, Tipo, Importe, Sistema, Cantidad', _EXPORTED)}),
f AS (SELECT DISTINCT ECO, Fecha, Concepto, Tipo, Importe, Sistema, Cantidad FROM r
  WHERE Fecha IS NOT NULL AND Importe IS NOT NULL AND regexp_matches(ECO, '^(AU|CA)-\d{{3}}(\s*LZC)?$')
  UNION ALL SELECT ECO, Fecha, 'MANTENIMIENTO', NULL, Importe, 'Excel Mantenimientos', NULL FROM (
    SELECT DISTINCT l_orderkey, eco_raw, {norm_eco_lzc('eco_raw')} AS ECO, CAST(l_shipdate AS DATE) AS Fecha,
      CAST(replace(replace(replace(importe_raw, '$', ''), ',', ''), '-', '') AS DOUBLE) AS Importe
    FROM ledger_raw WHERE Sistema = 'Google Sheets') WHERE regexp_matches(ECO, '^(AU|CA)-\d{{3}}(\s*LZC)?$')),
k AS (SELECT *, regexp_replace(ECO, '[^A-Z0-9]', '', 'g') AS k FROM f),
m AS (SELECT * EXCLUDE (n), n AS shown, regexp_replace(n, '[^A-Z0-9]', '', 'g') AS k FROM (
  SELECT *, {norm_eco_lzc('ECO')} AS n FROM master)),
d AS (SELECT coalesce(shown, k.ECO) AS ECO, Empresa, Sucursal, Placas, Fecha, Concepto, Tipo, Importe, Sistema, Cantidad
  FROM k LEFT JOIN m USING (k)
  UNION ALL SELECT shown, Empresa, Sucursal, Placas, NULL, 'SIN ACTIVIDAD', NULL, 0, 'N/A', NULL FROM m
    WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.k = m.k AND year(k.Fecha) < {B}))
SELECT * REPLACE (coalesce(Empresa, 'SIN INFORMACIÓN') AS Empresa, coalesce(Sucursal, 'SIN INFORMACIÓN') AS Sucursal) RENAME (Cantidad AS Litros),
  CAST(month(Fecha) AS INT) AS Mes, CAST(coalesce((day(Fecha) - 1) // 7 + 1, 0) AS INT) AS Semana_Mes FROM d""")
def _(spark, sf):
    """The whole job twice on one stored report: exports of three systems and the maintenance
    sheet up to a year, then all of them."""
    raw = _with_aliases(spark, sf)
    day = F.to_date(F.col("l_shipdate"))
    amount = F.translate("importe_raw", "$,-", "")
    columns = {
        "Pase": [F.col("ECO").alias("No. economico"), F.col("fecha_raw").alias("Fecha de cruce"),
                 amount.alias("Importe al 100"), F.col("tarjeta_raw").alias("Tarjeta IDMX")],
        "Supramax": [F.col("ECO").alias("PLACAS"), F.col("fecha_raw").alias("FECHA"), amount.alias("IMPORTE"),
                     F.col("Cantidad").alias("CANTIDAD"), F.col("tipo_raw").alias("PRODUCTO")],
        "Edenred": [F.col("ECO").alias("Vehículo"), F.col("fecha_raw").alias("Fecha Transacción"),
                    amount.alias("Importe Transacción"), F.col("Cantidad").alias("Cantidad Mercancía"),
                    F.col("tipo_raw").alias("Mercancía")],
    }
    listed = v.master(spark, sf).select("ECO", "Empresa", "Sucursal", "Placas", "Supramax ID", "pos")
    report = scratch_dir(spark, "dashboard")
    for rows in (raw.filter(F.year(day) < B), raw):
        exports = {}
        for system, names in columns.items():
            exports[system] = scratch_dir(spark, "export") + ".csv"
            rows.filter(F.col("Sistema") == system).select(*names).write.options(
                header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(exports[system])
        sheet = rows.filter("Sistema = 'Google Sheets'").select(
            F.col("eco_raw").alias("No Eco"), F.date_format("l_shipdate", "dd/MM/yyyy").alias("Fecha servicio"),
            amount.alias("PrecioNeto"), "l_orderkey")
        kept, _ = dashboard.run(
            spark, exports, sheet.union(sheet.filter("l_orderkey % 4 = 0")), listed, "pos", v.AS_OF, report)
    return kept.read().withColumn("Fecha", F.to_date("Fecha")).select(
        "ECO", "Empresa", "Sucursal", "Placas", "Fecha", "Concepto", "Tipo", "Importe", "Sistema", "Litros",
        "Mes", "Semana_Mes")


@query("join_full_dashboard", """
SELECT coalesce(m.ECO, f.ECO) AS ECO, m.Empresa, Sucursal, f.Fecha, f.Importe
FROM master m FULL JOIN ledger f ON regexp_replace(m.ECO, '[^A-Z0-9]', '', 'g') = regexp_replace(f.ECO, '[^A-Z0-9]', '', 'g')
""".replace("coalesce(m.ECO, f.ECO)", f"coalesce({norm_eco_lzc('m.ECO')}, f.ECO)"))
def _(spark, sf):
    facts = v.ledger(spark, sf).select("ECO", "Fecha", "Importe")
    return dashboard.join_master(facts, v.master(spark, sf).select("ECO", "Empresa", "Sucursal"))


# --- trips ---

_FLAGS = """
SELECT event_id, ECO, Usuario, CAST(year(s) AS INT) AS Anio, CAST(month(s) AS INT) AS Mes_Num, CAST((day(s) - 1) // 7 + 1 AS INT) AS Semana_Mes,
  CASE WHEN kind = 'D' AND k = 1 THEN 1 ELSE 0 END AS Es_Domingo_Aux,
  CASE WHEN kind = 'S' AND k = 1 THEN 1 ELSE 0 END AS Es_Sabado_Tarde_Aux,
  CASE WHEN kind = 'N' AND k = 1 THEN 1 ELSE 0 END AS Es_Semana_Noche_Aux
FROM (SELECT *, row_number() OVER (PARTITION BY ECO, CAST(s AS DATE), kind ORDER BY s, event_id) AS k FROM (
  SELECT *, "Fecha-hora Inicio" AS s, CASE WHEN dayofweek("Fecha-hora Inicio") = 0 THEN 'D'
    WHEN dayofweek("Fecha-hora Inicio") = 6 AND hour("Fecha-hora Inicio") >= 16 THEN 'S'
    WHEN dayofweek("Fecha-hora Inicio") BETWEEN 1 AND 5 AND hour("Fecha-hora Inicio") >= 20 THEN 'N' END AS kind
  FROM trips_clean {where}))"""
_POSITION = [trips.START, "event_id"]
_OUT = ["event_id", "ECO", "Usuario", "Anio", "Mes_Num", "Semana_Mes", "Es_Domingo_Aux", "Es_Sabado_Tarde_Aux",
        "Es_Semana_Noche_Aux"]


@query("win_first_of_day_flags", _FLAGS.format(where=""))
def _(spark, sf):
    return trips.helper_columns(trips.clean_trips(v.trips(spark, sf)), _POSITION).select(*_OUT)


@query("job_trips", _FLAGS.format(where="""WHERE event_id % 3 = 0 OR NOT EXISTS (SELECT 1 FROM trips_clean o
  WHERE o.event_id % 3 = 0 AND o.ECO = trips_clean.ECO AND upper(o.Usuario) = upper(trips_clean.Usuario)
    AND date_trunc('second', o."Fecha-hora Inicio") = date_trunc('second', trips_clean."Fecha-hora Inicio")
    AND CAST(o."Distancia(KM)" AS DECIMAL(18,2)) = CAST(trips_clean."Distancia(KM)" AS DECIMAL(18,2)))"""))
def _(spark, sf):
    raw = v.trips(spark, sf)
    stored = trips.clean_trips(raw.filter("event_id % 3 = 0"))
    return trips.trips_table(raw, stored, _POSITION).select(*_OUT)

"""The frames of ``views`` as SQL views."""

import re


def norm_eco(x, keep="AU|CA"):
    c = f"replace(replace(upper(trim({x})),' ',''),'.','')"
    return (
        f"CASE WHEN regexp_matches({c}, '^({keep})-?(\\d{{1,3}})(\\D|$)') "
        f"THEN regexp_extract({c}, '^({keep})', 1) || '-' || "
        f"lpad(regexp_extract({c}, '^(?:{keep})-?(\\d{{1,3}})(?:\\D|$)', 1), 3, '0') ELSE {c} END")


def norm_eco_lzc(x):
    s = f"replace(upper(trim({x})),'.','')"
    bare = f"replace(replace({s},'LZC',''),' ','')"
    return (
        f"CASE WHEN regexp_matches({bare}, '^(AU|CA)-?(\\d{{1,3}})(\\D|$)') "
        f"THEN regexp_extract({bare}, '^(AU|CA)', 1) || '-' || "
        f"lpad(regexp_extract({bare}, '^(?:AU|CA)-?(\\d{{1,3}})(?:\\D|$)', 1), 3, '0') "
        f"|| CASE WHEN contains({s}, 'LZC') THEN ' LZC' ELSE '' END ELSE upper(trim({x})) END")


def cents_sum(x):
    return f"CAST(sum(CAST({x} AS DECIMAL(18,2))) AS DOUBLE)"


def parse_day(x):
    return (
        f"CAST(coalesce(try_strptime({x}, '%Y/%m/%d'), try_strptime({x}, '%d/%m/%Y'), "
        f"try_strptime({x}, '%Y-%m-%d')) AS DATE)")


LEDGER = "ECO, Fecha, Concepto, Tipo, Cantidad, Importe, Sistema, Empresa, Id_Origen, Archivo_Origen"

_PFX = "CASE WHEN {k} % 3 = 0 THEN 'CA' ELSE 'AU' END"
_NUM = "CAST({k} % 1000 AS VARCHAR)"


def unit(k):
    return _PFX.format(k=k), _NUM.format(k=k), f"lpad({_NUM.format(k=k)}, 3, '0')"


_pfx, _num, _p3 = unit("l_suppkey")
_spfx, _snum, _sp3 = unit("s_suppkey")
_upfx, _unum, _up3 = unit("u")

VIEWS = {
    "ledger_raw": rf"""
SELECT *, CASE WHEN Sistema = 'Pase' THEN NULL ELSE t0 END AS tipo_raw,
  CASE WHEN Sistema = 'Pase' THEN NULL ELSE l_quantity END AS Cantidad,
  CASE WHEN l_orderkey % 2 = 0 THEN 'pase_' || substr(sha1(CAST(l_orderkey AS VARCHAR)), 1, 12) || '_' || plain
    ELSE plain END AS Archivo_Origen
FROM (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, l_quantity,
  CASE l_linenumber WHEN 1 THEN {_pfx} || '-' || {_p3}
    WHEN 2 THEN ' ' || lower({_pfx}) || ' ' || {_num} || ' '
    WHEN 3 THEN {_pfx} || '.' || {_p3} || '(JW)'
    WHEN 4 THEN {_pfx} || '-' || {_p3} || ' LZC'
    WHEN 5 THEN 'XX-' || {_num}
    WHEN 6 THEN {_pfx} || '-1' || {_p3}
    ELSE {_pfx} || {_p3} END AS eco_raw,
  CASE WHEN l_partkey % 97 = 0 THEN 'n/a' WHEN l_partkey % 3 = 0 THEN strftime(l_shipdate, '%Y/%m/%d')
    WHEN l_partkey % 3 = 1 THEN strftime(l_shipdate, '%d/%m/%Y')
    ELSE strftime(l_shipdate, '%Y-%m-%d') END AS fecha_raw,
  CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN '-' ELSE '' END || '$' ||
    regexp_replace(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR), '^(\d+)(\d{{3}}\.)', '\1,\2')
    AS importe_raw,
  CASE WHEN l_linenumber = 7 THEN 'Google Sheets' WHEN l_returnflag = 'A' THEN 'Pase'
    WHEN l_returnflag = 'N' THEN 'Supramax' ELSE 'Edenred' END AS Sistema,
  CASE l_partkey % 4 WHEN 0 THEN 'ARCO MAGNA' WHEN 1 THEN 'magna ' WHEN 2 THEN 'ARCO  PREMIUM'
    ELSE 'DIESEL' END AS t0,
  'EMP_' || l_linestatus AS Empresa,
  'g1A' || CAST(l_suppkey % 10 AS VARCHAR) || '.' || CAST(year(l_shipdate) AS VARCHAR) || '.csv' AS plain,
  l_orderkey * 10 + l_linenumber AS row_idx,
  CASE WHEN l_partkey % 11 = 0 THEN 'nan' WHEN l_partkey % 7 = 0 THEN ''
    WHEN l_partkey % 5 = 0 THEN CAST(l_partkey AS VARCHAR) || '.0'
    ELSE CAST(l_partkey AS VARCHAR) END AS tarjeta_raw
FROM lineitem)""",
    "batch": rf"""
SELECT eco_raw AS ECO, {parse_day('fecha_raw')} AS Fecha,
  CASE Sistema WHEN 'Pase' THEN 'PEAJES' WHEN 'Google Sheets' THEN 'MANTENIMIENTO'
    ELSE 'COMBUSTIBLE' END AS Concepto,
  CASE trim(tipo_raw) WHEN 'ARCO MAGNA' THEN 'REGULAR' WHEN 'magna' THEN 'REGULAR'
    WHEN 'ARCO  PREMIUM' THEN 'PREMIUM' ELSE tipo_raw END AS Tipo,
  Cantidad, abs(TRY_CAST(replace(replace(importe_raw, '$', ''), ',', '') AS DOUBLE)) AS Importe,
  Sistema, Empresa,
  CASE WHEN Sistema = 'Pase' THEN sha1('Pase|' || plain || '|' || CAST(row_idx AS VARCHAR) || '|' ||
    trim(eco_raw) || '||' || fecha_raw || '||' || importe_raw) END AS Id_Origen,
  Archivo_Origen, l_orderkey, l_partkey
FROM ledger_raw""",
    "ledger_keyed": rf"""
SELECT * FROM (SELECT * REPLACE ({norm_eco('ECO')} AS ECO) FROM batch
  WHERE Importe IS NOT NULL AND Fecha IS NOT NULL)
WHERE regexp_matches(ECO, '^(AU|CA)-\d{{3}}$')""",
    "ledger": f"SELECT {LEDGER} FROM ledger_keyed",
    "ledger_with_copies": f"""
SELECT {LEDGER} FROM ledger_keyed UNION ALL
SELECT {LEDGER} FROM (SELECT * REPLACE ('z_' || Archivo_Origen AS Archivo_Origen)
  FROM ledger_keyed WHERE l_partkey % 10 = 0)""",
    "merge_target": f"SELECT {LEDGER} FROM ledger_keyed WHERE l_orderkey % 2 = 0",
    "merge_source": f"""
SELECT {LEDGER} FROM (SELECT * REPLACE (
  Importe + CAST(CASE WHEN l_partkey % 2 = 0 THEN 0.004 ELSE 0.02 END AS DOUBLE) AS Importe)
FROM ledger_keyed)""",
    "master": rf"""
SELECT {_spfx} || CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE '-' END || {_sp3} AS ECO, n_name AS Empresa,
  'PL-' || s_suppkey AS Placas, 'SMX' || s_suppkey AS "Supramax ID",
  '60 ' || s_suppkey || ' ' AS "Ticket Card ID", 'IM ' || s_suppkey || '..' AS "IAVE Pase ID",
  CASE WHEN s_suppkey % 2 = 0 THEN 'SUC_' || n_regionkey END AS Sucursal, s_suppkey AS pos
FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 5 <> 0
UNION ALL
SELECT 'CA-9' || lpad(CAST(i * 3 + 1 AS VARCHAR), 2, '0'), 'EMP_IDLE', NULL, NULL, NULL, NULL, NULL,
  10000000000 + i FROM range(10) r(i)""",
    "catalog": f"SELECT {norm_eco('ECO')} AS ECO, Empresa FROM master",
    "monthly": f"""
SELECT ECO AS ECO_Limpio, strftime(Fecha, '%Y-%m') AS MES_str, Sistema, {cents_sum('Importe')} AS Total
FROM ledger GROUP BY ALL""",
    "wide": """
SELECT ECO_Limpio, MES_str,
  coalesce(sum(Total) FILTER (Sistema = 'Pase'), 0) AS Pase,
  coalesce(sum(Total) FILTER (Sistema = 'Supramax'), 0) AS Supramax,
  coalesce(sum(Total) FILTER (Sistema = 'Edenred'), 0) AS Edenred,
  coalesce(sum(Total) FILTER (Sistema = 'Google Sheets'), 0) AS "Google Sheets"
FROM monthly GROUP BY ALL""",
    "manual": """
SELECT lower(ECO_Limpio) AS UNIDAD,
  CASE WHEN n % 17 <> 0 THEN CAST(MES_str || '-01' AS DATE) END AS MES,
  Pase + CASE WHEN n % 5 = 1 THEN 10.0 ELSE 0.0 END AS "IAVE PASE",
  CASE WHEN n % 5 = 2 THEN 0.0 ELSE Supramax END AS "SUPRAMAX",
  Edenred AS "TICKET CARD", "Google Sheets" AS "MANTENIMIENTO"
FROM (SELECT *, CAST(substr(ECO_Limpio, 4, 3) AS INT) + CAST(substr(MES_str, 6, 2) AS INT) AS n FROM wide)
WHERE n % 5 <> 0""",
    "trips": rf"""
SELECT CASE u % 4 WHEN 0 THEN {_upfx} || {_unum} WHEN 1 THEN lower({_upfx}) || '-' || {_up3}
    WHEN 2 THEN {_upfx} || '-' || {_up3} || 'LZC' ELSE 'ZZ-' || {_up3} END AS ECO,
  ts AS "Fecha-hora Inicio", ts + INTERVAL 30 MINUTE AS "Fecha-hora Término", event_type AS Usuario,
  value AS "Distancia(KM)", event_id
FROM (SELECT *, user_id % 40 AS u FROM events)""",
    "trips_clean": rf"""
SELECT * FROM (SELECT * REPLACE ({norm_eco_lzc('ECO')} AS ECO) FROM trips)
WHERE regexp_matches(ECO, '^(AU|CA)-\d{{3}}(?:\s*LZC)?$')""",
    "tags": f"""
SELECT s_suppkey, {_spfx} || '-' || {_sp3} AS key,
  CASE WHEN s_suppkey % 2 = 0 THEN '' ELSE 'IMDM' END || lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS value
FROM supplier""",
    "file_listing": """
SELECT CASE WHEN c_custkey % 4 < 2
  THEN 'Pase/EMP_' || c_nationkey || '/' || y || '/' || m || '/pase_' || substr(sha1(c_name), 1, 12) || '_' || name
  ELSE 'Pase/' || y || '/' || m || '/' || name END AS path, c_custkey,
  c_custkey * 17 % 1000 AS length, c_custkey % 400 AS stamp
FROM (SELECT *, CASE WHEN c_custkey % 3 = 0 THEN 'cruces.csv'
    ELSE 'g1A' || (c_custkey % 50) || '.' || (c_custkey % 9) || '.csv' END AS name,
  CAST(1996 + c_custkey % 2 AS VARCHAR) AS y, lpad(CAST(c_custkey % 12 + 1 AS VARCHAR), 2, '0') AS m
  FROM customer)""",
}

_WORD = re.compile(r"\b(" + "|".join(VIEWS) + r")\b")


def _needed(sql, seen):
    for name in _WORD.findall(sql):
        if name not in seen:
            _needed(VIEWS[name], seen)
            if name not in seen:
                seen.append(name)
    return seen


def with_views(sql):
    """The SQL with the views it names, and those they name, as a WITH clause."""
    names = _needed(sql, [])
    if not names:
        return sql
    clause = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in names)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {clause},\n{body[5:]}"
    return f"WITH {clause}\n{body}"

"""Domain frames derived from the test tables; ``views_sql`` states the same in SQL."""

import datetime as dt

from pyspark.sql import functions as F

from fleetbook.functions.amounts import parse_money, sum_cents
from fleetbook.functions.dates import parse_date_ladder, year_month
from fleetbook.functions.eco import normalize_eco
from fleetbook.functions.keys import row_id
from fleetbook.functions.text import product_type
from fleetbook.operators.aggregates import pivot_systems
from fleetbook.operators.filters import normalized_units, required
from fleetbook.session import scratch_dir
from fleetbook.vocabulary import CONCEPT_BY_SYSTEM, LEDGER_COLS

YEAR_A, YEAR_B, MONTH = 1996, 1997, 3
AS_OF = dt.date(1998, 6, 15)
SINCE = dt.date(1997, 1, 1)


_SPREAD = {"lineitem", "events"}
_SCHEMAS = {}


def table(spark, sf, name):
    """A test table. The fact tables are single small files, which one task would read
    and parse; they are dealt out to all cores. Larger tables have enough splits of their
    own and are left as they are."""
    path = f"{sf}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    df = spark.read.schema(_SCHEMAS[key]).parquet(path)
    cores = spark.sparkContext.defaultParallelism
    if name in _SPREAD and df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df


def _unit(number):
    prefix = F.when(number % 3 == 0, "CA").otherwise("AU")
    return prefix, (number % 1000).cast("string"), F.lpad((number % 1000).cast("string"), 3, "0")


_STORED = {}


def stored(spark, sf, name, make, *by):
    """A frame written once per session into the shared scratch folder, as the landing
    and ledger tables are in use: queries scan it with columns and filters pushed down,
    and expressions that made it are not repeated in their plans."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _STORED:
        path, frame = scratch_dir(spark, name), make(spark, sf)
        frame.write.partitionBy(*by).parquet(path)
        _STORED[key] = path, frame.schema
    path, schema = _STORED[key]
    return spark.read.schema(schema).parquet(path)


def ledger_raw(spark, sf):
    """Vendor rows as text: units, dates, amounts and cards in every spelling."""
    return stored(spark, sf, "ledger_raw", _ledger_raw)


def _ledger_raw(spark, sf):
    li = table(spark, sf, "lineitem")
    pfx, num, p3 = _unit(F.col("l_suppkey"))
    line, part = F.col("l_linenumber"), F.col("l_partkey")
    eco = (
        F.when(line == 1, F.concat(pfx, F.lit("-"), p3))
        .when(line == 2, F.concat(F.lit(" "), F.lower(pfx), F.lit(" "), num, F.lit(" ")))
        .when(line == 3, F.concat(pfx, F.lit("."), p3, F.lit("(JW)")))
        .when(line == 4, F.concat(pfx, F.lit("-"), p3, F.lit(" LZC")))
        .when(line == 5, F.concat(F.lit("XX-"), num))
        .when(line == 6, F.concat(pfx, F.lit("-1"), p3))
        .otherwise(F.concat(pfx, p3))
    )
    day = F.col("l_shipdate")
    fecha = (
        F.when(part % 97 == 0, F.lit("n/a"))
        .when(part % 3 == 0, F.date_format(day, "yyyy/MM/dd"))
        .when(part % 3 == 1, F.date_format(day, "dd/MM/yyyy"))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
    )
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    system = (
        F.when(line == 7, "Google Sheets").when(flag == "A", "Pase").when(flag == "N", "Supramax")
        .otherwise("Edenred")
    )
    sign = F.when((flag == "A") & (status == "F"), "-").otherwise("")
    amount = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    amount = F.when((F.length(amount) > 6) & (amount >= "0"), F.concat(
        F.left(amount, F.length(amount) - 6),
        F.lit(","), F.right(amount, F.lit(6)))).otherwise(amount)
    product = F.get(F.array(*[F.lit(p) for p in ("ARCO MAGNA", "magna ", "ARCO  PREMIUM", "DIESEL")]), (part % 4).cast("int"))
    plain = F.concat(
        F.lit("g1A"), (F.col("l_suppkey") % 10).cast("string"), F.lit("."),
        F.year(day).cast("string"), F.lit(".csv"))
    archived = F.concat(
        F.lit("pase_"), F.substring(F.sha1(F.col("l_orderkey").cast("string")), 1, 12), F.lit("_"), plain)
    text = part.cast("string")
    card = (
        F.when(part % 11 == 0, "nan").when(part % 7 == 0, "")
        .when(part % 5 == 0, F.concat(text, F.lit(".0"))).otherwise(text)
    )
    pase = system == "Pase"
    return li.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate",
        eco.alias("eco_raw"), fecha.alias("fecha_raw"),
        F.concat(sign, F.lit("$"), amount).alias("importe_raw"), system.alias("Sistema"),
        F.when(~pase, product).alias("tipo_raw"), F.when(~pase, F.col("l_quantity")).alias("Cantidad"),
        F.concat(F.lit("EMP_"), status).alias("Empresa"),
        F.when(F.col("l_orderkey") % 2 == 0, archived).otherwise(plain).alias("Archivo_Origen"),
        (F.col("l_orderkey") * 10 + line).alias("row_idx"), card.alias("tarjeta_raw"))


def batch(spark, sf):
    """Typed vendor rows before any filter, with the columns the fixtures select by."""
    raw = ledger_raw(spark, sf)
    concept = F.create_map(*[F.lit(v) for kv in CONCEPT_BY_SYSTEM.items() for v in kv])
    cells = [F.col(c) for c in ("eco_raw", "fecha_raw", "importe_raw")]
    return raw.select(
        F.col("eco_raw").alias("ECO"), parse_date_ladder(F.col("fecha_raw")).cast("date").alias("Fecha"),
        concept[F.col("Sistema")].alias("Concepto"), product_type(F.col("tipo_raw")).alias("Tipo"),
        "Cantidad", parse_money(F.col("importe_raw")).alias("Importe"), "Sistema", "Empresa",
        F.when(F.col("Sistema") == "Pase",
               row_id("Pase", F.col("Archivo_Origen"), F.col("row_idx"), cells)).alias("Id_Origen"),
        "Archivo_Origen", "l_orderkey", "l_partkey")


def ledger_keyed(spark, sf):
    """Ledger rows with the order and part they came from."""
    return stored(
        spark, sf, "ledger", lambda *at: required(normalized_units(batch(*at))), "Sistema")


def ledger(spark, sf):
    return ledger_keyed(spark, sf).select(*LEDGER_COLS)


def ledger_with_copies(spark, sf):
    """The ledger plus an overlapping export: a tenth of its rows from another file."""
    rows = ledger_keyed(spark, sf)
    copies = rows.filter("l_partkey % 10 = 0").withColumn(
        "Archivo_Origen", F.concat(F.lit("z_"), "Archivo_Origen"))
    return rows.unionByName(copies).select(*LEDGER_COLS)


def merge_target(spark, sf):
    return ledger_keyed(spark, sf).filter("l_orderkey % 2 = 0").select(*LEDGER_COLS)


def merge_source(spark, sf):
    """All rows with amounts moved inside the tolerance, or outside it."""
    moved = F.col("Importe") + F.when(F.col("l_partkey") % 2 == 0, 0.004).otherwise(0.02)
    return ledger_keyed(spark, sf).withColumn("Importe", moved).select(*LEDGER_COLS)


def master(spark, sf):
    """Catalogue of four fifths of the units, some without dash, and ten idle ones."""
    s = table(spark, sf, "supplier").join(
        table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    pfx, _, p3 = _unit(F.col("s_suppkey"))
    dash = F.when(F.col("s_suppkey") % 4 == 0, "").otherwise("-")
    key = F.col("s_suppkey").cast("string")
    listed = s.filter("s_suppkey % 5 <> 0").select(
        F.concat(pfx, dash, p3).alias("ECO"), F.col("n_name").alias("Empresa"),
        F.concat(F.lit("PL-"), key).alias("Placas"), F.concat(F.lit("SMX"), key).alias("Supramax ID"),
        F.concat(F.lit("60 "), key, F.lit(" ")).alias("Ticket Card ID"),
        F.concat(F.lit("IM "), key, F.lit("..")).alias("IAVE Pase ID"),
        F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("SUC_"), F.col("n_regionkey").cast("string")))
        .alias("Sucursal"), F.col("s_suppkey").alias("pos"))
    idle = spark.range(10).select(
        F.concat(F.lit("CA-9"), F.lpad((F.col("id") * 3 + 1).cast("string"), 2, "0")).alias("ECO"),
        F.lit("EMP_IDLE").alias("Empresa"), *[
            F.lit(None).cast("string").alias(c)
            for c in ("Placas", "Supramax ID", "Ticket Card ID", "IAVE Pase ID", "Sucursal")],
        (F.col("id") + 10_000_000_000).alias("pos"))
    return listed.unionByName(idle)


def catalog(spark, sf):
    """(ECO, Empresa) of the catalogue with canonical units."""
    return master(spark, sf).select(normalize_eco(F.col("ECO")).alias("ECO"), "Empresa")


def manual(spark, sf):
    """Manual control sheet: the ledger's monthly amounts with known errors."""
    monthly = (
        ledger(spark, sf)
        .groupBy(F.col("ECO").alias("ECO_Limpio"), year_month("Fecha").alias("MES_str"), "Sistema")
        .agg(sum_cents(F.col("Importe")).alias("Total")))
    wide = pivot_systems(monthly)
    number = F.substring("ECO_Limpio", 4, 3).cast("int")
    month = F.substring("MES_str", 6, 2).cast("int")
    rule = (number + month) % 5
    day = F.when((number + month) % 17 != 0, F.concat("MES_str", F.lit("-01")).cast("date"))
    return wide.filter(rule != 0).select(
        F.lower("ECO_Limpio").alias("UNIDAD"), day.alias("MES"),
        (F.col("Pase") + F.when(rule == 1, 10.0).otherwise(0.0)).alias("IAVE PASE"),
        F.when(rule == 2, 0.0).otherwise(F.col("Supramax")).alias("SUPRAMAX"),
        F.col("Edenred").alias("TICKET CARD"), F.col("Google Sheets").alias("MANTENIMIENTO"))


def trips(spark, sf):
    """Trip log from the events; ``event_id`` is the position in the source."""
    e = table(spark, sf, "events")
    unit = F.col("user_id") % 40
    pfx, num, p3 = _unit(unit)
    text = (
        F.when(unit % 4 == 0, F.concat(pfx, num)).when(unit % 4 == 1, F.concat(F.lower(pfx), F.lit("-"), p3))
        .when(unit % 4 == 2, F.concat(pfx, F.lit("-"), p3, F.lit("LZC"))).otherwise(F.concat(F.lit("ZZ-"), p3))
    )
    return e.select(
        text.alias("ECO"), F.col("ts").alias("Fecha-hora Inicio"),
        (F.col("ts") + F.expr("interval 30 minutes")).alias("Fecha-hora Término"),
        F.col("event_type").alias("Usuario"), F.col("value").alias("Distancia(KM)"), "event_id")


def tag_json(spark, sf):
    """One JSON object per supplier: unit to tag; even ones have the bare 8 digits."""
    s = table(spark, sf, "supplier")
    pfx, _, p3 = _unit(F.col("s_suppkey"))
    digits = F.lpad(F.col("s_suppkey").cast("string"), 8, "0")
    tag = F.when(F.col("s_suppkey") % 2 == 0, digits).otherwise(F.concat(F.lit("IMDM"), digits))
    return s.select(
        "s_suppkey", F.concat(F.lit('{"'), pfx, F.lit("-"), p3, F.lit('":"'), tag, F.lit('"}')).alias("json"))


def file_listing(spark, sf):
    """Archive listing with both folder layouts and archived copies of the same name."""
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    name = F.when(k % 3 == 0, "cruces.csv").otherwise(F.concat(
        F.lit("g1A"), (k % 50).cast("string"), F.lit("."), (k % 9).cast("string"), F.lit(".csv")))
    year = (F.lit(1996) + k % 2).cast("string")
    month = F.lpad((k % 12 + 1).cast("string"), 2, "0")
    new = F.concat(
        F.lit("Pase/EMP_"), F.col("c_nationkey").cast("string"), F.lit("/"), year, F.lit("/"), month,
        F.lit("/pase_"), F.substring(F.sha1(F.col("c_name")), 1, 12), F.lit("_"), name)
    old = F.concat(F.lit("Pase/"), year, F.lit("/"), month, F.lit("/"), name)
    return c.select(
        F.when(k % 4 < 2, new).otherwise(old).alias("path"), "c_custkey",
        (k * 17 % 1000).alias("length"), (k % 400).alias("stamp"))

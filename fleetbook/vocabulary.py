"""Names and values shared by every module."""

from pyspark.sql import types as T

# --- fixed values: they must equal what users of the ledger already store ---
LEDGER_SCHEMA = T.StructType([
    T.StructField("ECO", T.StringType()),
    T.StructField("Fecha", T.DateType()),
    T.StructField("Concepto", T.StringType()),
    T.StructField("Tipo", T.StringType()),
    T.StructField("Cantidad", T.DoubleType()),
    T.StructField("Importe", T.DoubleType()),
    T.StructField("Sistema", T.StringType(), nullable=False),
    T.StructField("Empresa", T.StringType()),
    T.StructField("Id_Origen", T.StringType()),
    T.StructField("Archivo_Origen", T.StringType()),
])

SYSTEMS = ["Pase", "Supramax", "Edenred", "Google Sheets"]
SYSTEM_ALIASES = {"Excel Mantenimientos": "Google Sheets"}

CONCEPT_BY_SYSTEM = {
    "Pase": "PEAJES",
    "Supramax": "COMBUSTIBLE",
    "Edenred": "COMBUSTIBLE",
    "Google Sheets": "MANTENIMIENTO",
}

# (label in the reconciliation, column of the manual sheet, system in the ledger)
RECON_SYSTEMS = [
    ("Pase", "IAVE PASE", "Pase"),
    ("Supramax", "SUPRAMAX", "Supramax"),
    ("Edenred", "TICKET CARD", "Edenred"),
    ("Mantenimientos", "MANTENIMIENTO", "Google Sheets"),
]

STATUS_ONLY_AUTOMATED = "❌ FALTA EN REPORTE MANUAL"
STATUS_ONLY_MANUAL = "⚠️ FALTA EN BOT AUTOMÁTICO"
STATUS_DIFFERENT = "📊 DIFERENCIA DE MONTO"
STATUS_EXACT = "✅ CUADRA PERFECTO"
STATUS_NONE = "⚪ SIN MOVIMIENTO"

MONTH_NAMES = [
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
]
DAY_NAMES = ["Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo"]

NO_INFO = "SIN INFORMACIÓN"
NO_ACTIVITY = "SIN ACTIVIDAD"
NOT_AVAILABLE = "N/A"
NO_COMPANY = "sin_empresa"
# --- end of fixed values ---

LEDGER_COLS = LEDGER_SCHEMA.fieldNames()
NATURAL_KEY = ["ECO", "Fecha", "Concepto", "Tipo", "Sistema"]

"""Session settings and the shared scratch folder."""

import atexit
import contextlib
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


# Runtime settings the jobs rely on.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM does not compile methods over 8000 bytes. Wide parsing projections exceed
    # that when fused into one method; below this limit Spark keeps them in small ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app="fleetbook", master=None, **conf):
    """A session with the settings above; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark):
    """Apply the settings to a session made elsewhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextlib.contextmanager
def setting(spark, key, value):
    """The session with a setting that the block alone needs."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


_LOCAL = {}


def shared_dir(spark):
    """The folder for intermediate tables that all executors share: the one the cluster
    names in ``spark.checkpoint.dir``, else the context's checkpoint folder. Only a session
    in local mode, as in tests, may go without; it gets a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="fleetbook-")
        atexit.register(shutil.rmtree, _LOCAL[app], ignore_errors=True)
    return _LOCAL[app]


def scratch_dir(spark, label):
    """A new folder name below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def stored(df, label):
    """A frame written once to the shared folder and read from there: what follows neither
    repeats its work nor depends on the executors that did it."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

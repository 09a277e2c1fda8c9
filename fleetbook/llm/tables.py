"""Scratch tables in the shared folder, and reading of the input tables."""

from pyspark.sql import functions as F

from fleetbook.session import scratch_dir

#: Arrow batches handed to Python stay below this size, whatever the length of a row.
ARROW = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


def prepare(spark):
    for key, value in ARROW.items():
        spark.conf.set(key, value)
    return spark


def read(spark, sf_dir, name):
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df, label):
    """Write a frame to the shared scratch folder and read it back: later jobs neither
    repeat its work nor depend on the executors that made it."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(docs):
    """doc_id and text alone, so that other columns cannot clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

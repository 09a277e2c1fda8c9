"""Which files are new or changed since they were last processed."""

from pyspark.sql import functions as F

READ, TORN, BARE = "read", "torn", "no header"
REGISTRY = ("path string, length bigint, modificationTime timestamp, state string, problem string, "
            "processed_at timestamp")


def listing(spark, path, glob=None, uri=False):
    """(path, length, modificationTime) of the files below a folder; contents stay unread.
    With ``uri`` also their names as other readers' ``_metadata.file_path`` gives them."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "length", "modificationTime", *([F.col("_metadata.file_path").alias("uri")] if uri else []))


def changed(files, registry):
    """Files the registry does not hold, as read, with this very size and time."""
    if "state" in registry.columns:
        registry = registry.filter(F.col("state") == READ)
    return files.join(registry, ["path", "length", "modificationTime"], "left_anti")


def registered(registry, processed, at):
    """The registry with processed files entered; a changed file replaces its entry. Where
    ``processed`` says how each file came out (``state``, ``problem``), that is kept."""
    told = [c for c in ("state", "problem") if c in processed.columns]
    fresh = processed.select("path", "length", "modificationTime", *told, F.lit(at).alias("processed_at"))
    return registry.join(fresh, "path", "left_anti").unionByName(fresh, allowMissingColumns=True)


def outcomes(files, raw, headers, problem_row):
    """The files with ``state`` and ``problem``. A file is
    ``READ`` where the header frame ``headers`` has it; it is ``TORN`` where a raw row of the number
    ``problem_row`` says what is wrong, and ``BARE`` where it has no header, or no rows."""
    torn = raw.filter(F.col("row_idx") == problem_row).groupBy(F.col("path").alias("uri")).agg(
        F.min(F.get("cells", F.lit(0))).alias("torn"))
    good = headers.select(F.col("path").alias("uri"), F.lit(True).alias("named")).distinct()
    state = F.when(F.col("torn").isNotNull(), TORN).when(F.col("named"), READ).otherwise(BARE)
    told = files.join(torn, "uri", "left").join(good, "uri", "left").select(
        *files.columns, state.alias("state"),
        F.coalesce("torn", F.when(F.col("named").isNull(), F.lit("no header row"))).alias("problem"))
    return told

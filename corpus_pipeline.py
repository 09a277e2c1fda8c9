"""From raw documents to shards: each stage works on the rows its predecessor kept.

A stage is a function (spark, docs, sf_dir) that returns a frame. ``run`` writes the result
of each as Parquet in the shared scratch folder and reads it back as the next one's input.
All stages but the last return the columns of ``documents``; the last adds shard and slot.
"""

from fleetbook.llm import decontaminate, minhash, mixing, quality, reshard
from fleetbook.llm.tables import prepare, read, stage


def quality_stage(spark, docs, sf_dir):
    """Documents that the quality classifier rejects go."""
    return quality.accepted(docs, read(spark, sf_dir, "labels"))


def near_duplicate_stage(spark, docs, sf_dir):
    """One document of each group of near copies, at a similarity of 0.8 or more, stays."""
    prepare(spark)
    return minhash.one_per_group(docs, minhash.LOOSER)


def decontamination_stage(spark, docs, sf_dir):
    """Documents that hold an item of the benchmark go."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def mixing_stage(spark, docs, sf_dir):
    """Documents of toxic and junk domains are thinned to their target totals; rates are at
    most 1, so that no document is repeated after near copies went."""
    return mixing.sample(docs, read(spark, sf_dir, "labels"), most=1.0)


def sharding_stage(spark, docs, sf_dir):
    """Documents are put into eight shards of near equal size."""
    prepare(spark)
    return reshard.reshard(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: The classifiers and the similarity search cannot be written in SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    sf_dir = str(sf_dir).rstrip("/")
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

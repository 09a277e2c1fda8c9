"""Continuous ingest: every micro-batch is cleaned and merged into the ledger."""

from ..operators.versions import Folder, VersionedLedger
from ..plans.ingest import clean_batch
from ..session import scratch_dir


def ingest_stream(stream, table, checkpoint, by_id=False, trigger=None, query=None, **cleaning):
    """Start a query that merges a stream of vendor rows into a ledger.

    Merging inserts only rows that are not stored, so a batch that is run again after a
    failure adds nothing, and late rows need no watermark. A ``VersionedLedger`` also commits
    the batch number with the rows, under the name ``query`` (the checkpoint's folder): a
    batch counts once even where its rows have neither id nor fixed amounts, and of two
    drivers that run the same query only one commits a batch.

    A merge reads its batch several times (rows with an id, those without, their months), so
    the cleaned rows are written once and merged from there; the folder goes with the batch.
    """
    name = query or checkpoint

    def merge(batch, number):
        place, clean = scratch_dir(batch.sparkSession, "batch"), clean_batch(batch, by_id=by_id, **cleaning)
        try:
            clean.write.parquet(place)
            rows = table.spark.read.schema(clean.schema).parquet(place)
            if isinstance(table, VersionedLedger):
                table.merge(rows, by_id=by_id, batch_of=(name, number))
            else:
                table.merge(rows, by_id=by_id)
        finally:
            Folder(table.spark, place).remove("")

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()

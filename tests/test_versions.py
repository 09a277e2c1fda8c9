"""Commits of the ledger: merges on the table of ids, failures between the steps, two
writers, streams that are cut off, older versions."""

import datetime as dt
import itertools

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from fleetbook.operators.versions import Conflict, VersionedLedger
from fleetbook.plans import ingest
from fleetbook.streaming.ledger_stream import ingest_stream
from fleetbook.vocabulary import LEDGER_COLS, LEDGER_SCHEMA

NAMES = (f"versions_{i}" for i in itertools.count())
D1, D2, D3 = dt.date(2026, 1, 31), dt.date(2026, 2, 1), dt.date(2026, 3, 1)


def rows(spark, *items):
    """Ledger rows from (ECO, day, Importe, Sistema, Id)."""
    full = []
    for eco, day, amount, *rest in items:
        system, key = (list(rest) + ["Supramax", None][len(rest):])
        full.append((eco, day, "X", "DIESEL", 1.0, amount, system, "E", key, "f"))
    return spark.createDataFrame(full, LEDGER_SCHEMA)


@pytest.fixture
def ledger(spark, tmp_path):
    return VersionedLedger(spark, next(NAMES), str(tmp_path / "l"), buckets=8).create()


def units(frame):
    return sorted(r.ECO for r in frame.select("ECO").collect())


def test_merges_and_replacements(spark, ledger):
    assert ledger.read().count() == 0 and ledger.read().columns == LEDGER_COLS
    batch = rows(spark, ("AU-001", D1, 1.0), ("AU-002", D2, 2.0), ("AU-003", D2, 3.0, "Pase", "p1"), ("AU-003", D3, 4.0, "Pase", "p2"))
    for _ in range(2):
        ledger.merge(batch, by_id=True)
    assert units(ledger.read()) == ["AU-001", "AU-002", "AU-003", "AU-003"]
    ledger.merge(batch.filter("Id_Origen IS NOT NULL").withColumn("Importe", F.lit(9.0)), by_id=True)
    assert ledger.read().count() == 4
    # The id of a dropped month is free again, the other one is not.
    ledger.delete_month("Pase", 2026, 2)
    ledger.merge(batch, by_id=True)
    assert units(ledger.read()) == ["AU-001", "AU-002", "AU-003", "AU-003"]
    with pytest.raises(ValueError):
        ledger.delete_month("Otro", 2026, 2)
    for _ in range(2):
        ledger.replace_months(rows(spark, ("AU-009", D2, 5.0), ("AU-008", D3, 6.0), ("AU-001", D1, 7.0)), "Supramax", [(2026, 1), (2026, 2)])
    assert units(ledger.read().filter("Sistema = 'Supramax'")) == ["AU-001", "AU-008", "AU-009"]
    ledger.replace_months(rows(spark, ("AU-010", D2, 5.0)), "Supramax", [(2026, 2)], partial=True)
    assert units(ledger.read().filter("Sistema = 'Supramax'")) == ["AU-001", "AU-008", "AU-009", "AU-010"]


def test_later_columns_backups_and_restores(spark, ledger):
    ledger.append(rows(spark, ("AU-001", D1, 1.0)))
    ledger.add_columns("Nota", "Empresa", "Nota")
    ledger.append(rows(spark, ("AU-002", D2, 2.0), ("AU-002", D2, 2.0)).withColumn("Nota", F.lit("hola")))
    before = ledger.backup_and_dedup("marzo")
    assert [r.Nota for r in ledger.read(extra=True).orderBy("ECO").collect()] == [None, "hola"]
    assert ledger.read(tag="marzo").count() == ledger.read(version=before).count() == 3
    ledger.vacuum(keep=1)
    assert ledger.read(tag="marzo").count() == 3
    ledger.restore(tag="marzo")
    assert ledger.read().count() == 3
    again = VersionedLedger(spark, next(NAMES), ledger.location, buckets=8).create()
    assert again.read(extra=True).count() == 3


@pytest.mark.parametrize("step", ["_put", "_index", "_commit"])
def test_a_failure_between_the_steps_leaves_the_old_version(spark, ledger, monkeypatch, step):
    ledger.append(rows(spark, ("AU-001", D1, 1.0, "Pase", "a"), ("AU-001", D1, 1.0, "Pase", "a"), ("AU-002", D2, 2.0, "Pase", "b")))
    fresh = rows(spark, ("AU-009", D1, 5.0, "Pase", "z"))
    done = getattr(VersionedLedger, step)

    def cut(self, *args):
        if step != "_commit":
            done(self, *args)
        raise OSError("cut off")

    for change in (lambda: ledger.backup_and_dedup("x"), lambda: ledger.replace_months(fresh, "Pase", [(2026, 1)], by_id=True),
                   lambda: ledger.merge(fresh, by_id=True)):
        monkeypatch.setattr(VersionedLedger, step, cut)
        with pytest.raises(OSError):
            change()
        monkeypatch.setattr(VersionedLedger, step, done)
        assert units(ledger.read()) == ["AU-001", "AU-001", "AU-002"] and ledger.versions() == [1]
    # The ids of the writes that were cut off do not count.
    ledger.merge(fresh, by_id=True)
    assert units(ledger.read()) == ["AU-001", "AU-001", "AU-002", "AU-009"]
    ledger.vacuum()
    assert len([n for n in ledger.data.names() if n.startswith("write=")]) == 2
    assert ledger.read().count() == ledger.stored_ids(ledger.state()).count() == 4


def test_the_second_writer_looks_again(spark, ledger, monkeypatch):
    mine, theirs = (rows(spark, ("AU-001", D1, 1.0, "Pase", "a"), (eco, D1, 2.0, "Pase", eco)) for eco in ("AU-002", "AU-003"))
    put, busy = VersionedLedger._put, []

    def with_another(self, batch):
        if not busy:
            busy.append(1)
            VersionedLedger(spark, self.name, self.location, buckets=8).merge(theirs, by_id=True)
        return put(self, batch)

    monkeypatch.setattr(VersionedLedger, "_put", with_another)
    assert ledger.merge(mine, by_id=True) == 2
    assert units(ledger.read()) == ["AU-001", "AU-002", "AU-003"]
    with pytest.raises(Conflict):
        ledger._commit({**ledger.state(), "version": 1})


def test_a_batch_counts_once(spark, ledger):
    # Rows without an id and with an amount that moves would be merged again by their key.
    for amount in (1.0, 2.0):
        ledger.merge(rows(spark, ("AU-001", D1, amount)), batch_of=("q", 0))
    assert [r.Importe for r in ledger.read().collect()] == [1.0]
    ledger.merge(rows(spark, ("AU-001", D1, 2.0)), batch_of=("q", 1))
    ledger.merge(rows(spark, ("AU-001", D1, 3.0)), batch_of=("other", 0))
    assert sorted(r.Importe for r in ledger.read().collect()) == [1.0, 2.0, 3.0]


def test_stored_ids_are_not_shuffled(spark, ledger):
    ledger.append(rows(spark, ("AU-001", D1, 1.0, "Pase", "a"), ("AU-002", D2, 2.0, "Pase", "b")))
    ledger.append(rows(spark, ("AU-003", D2, 1.0, "Pase", "c")))
    ledger.delete_month("Pase", 2026, 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch = rows(spark, ("AU-003", D2, 1.0, "Pase", "c"), ("AU-004", D2, 1.0, "Pase", "d"))
        found = batch.join(ledger.stored_ids(ledger.state()), ["Sistema", "Id_Origen"], "left_anti")
        text = found._jdf.queryExecution().executedPlan().toString()
        assert units(found) == ["AU-004"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    stored = text[text.index("LeftAnti"):]
    # Below the join come the batch, with its exchange, and the ids: a scan by bucket without one.
    assert stored.count("Exchange") == 1 and stored.index("Exchange") < stored.index("FileScan parquet") and "Bucketed: true" in stored


def test_a_stream_that_is_cut_off(spark, ledger, tmp_path, monkeypatch):
    folder = str(tmp_path / "in")
    for k in range(3):
        rows(spark, (f"AU-00{k}", D1, 1.0), (f"AU-10{k}", D2, 2.0, "Pase", f"p{k}"), ("AU-100", D2, 2.0, "Pase", "p0")).coalesce(1).write.mode("append").parquet(folder)
    done, cuts = VersionedLedger._commit, []

    def cut_once(self, state):
        if state["version"] == 2 and not cuts:
            cuts.append(1)
            raise OSError("cut off")
        done(self, state)

    def run():
        stream = spark.readStream.schema(LEDGER_SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
        ingest_stream(stream, ledger, str(tmp_path / "c"), by_id=True).awaitTermination()

    monkeypatch.setattr(VersionedLedger, "_commit", cut_once)
    with pytest.raises(StreamingQueryException):
        run()
    assert len(ledger.versions()) == 1
    for _ in range(2):
        run()
    assert units(ledger.read()) == ["AU-000", "AU-001", "AU-002", "AU-100", "AU-101", "AU-102"]
    assert list(ledger.state()["streams"].values()) == [2] and ledger.versions() == [1, 2, 3]


def test_a_load_counts_its_own_pass(spark, ledger):
    batch = spark.createDataFrame([
        ("AU-1", "05/03/2025", "10.5", "Supramax"), ("AU-1", "05/03/2025", "10.5", "Supramax"), ("AU-2", "2025-03-06", "x", "Supramax"),
        ("AU-3", "soon", "1", "Supramax"), ("AU-4", "05/04/2025", "1", "Supramax"), ("total", "05/03/2025", "1", "Supramax")],
        "ECO string, Fecha string, Importe string, Sistema string").withColumn("Concepto", F.lit("COMBUSTIBLE"))
    for _ in range(2):
        counts = ingest.load(batch, ledger, year=2025, month=3, batch_of=None)
        assert counts == {"leidas": 6, "completas": 4, "en_periodo": 3, "eco_valido": 2, "fecha_no_leida": 1, "unicas": 1}
    assert units(ledger.read()) == ["AU-001"]
    assert ingest.stage_counts(batch, 2025, 3).first() == (6, 4, 3, 2) and ingest.unread_dates(batch).first()[0] == 1

"""A ledger whose every change is one commit.

Rows are written into a folder of their own, which nobody reads until a commit names it. A
commit is a small file, put in place by one rename that fails where the next version exists
already: of two writers one wins, the other looks again at what is stored. Readers see the
last commit, or an older one by number or tag; nothing that a commit names is rewritten.

Beside the ledger lies a table of stored ids, bucketed by (Sistema, Id_Origen). Merges by id
shuffle the batch to its buckets; the stored ids stay where they are. An id counts only while
a live commit names its folder and partition, so ids of writes that were cut off do no harm.

The folder's file system must rename atomically, as HDFS does.
"""

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import year_month
from ..vocabulary import LEDGER_COLS, LEDGER_SCHEMA, SYSTEMS
from .dedup import dedup_ledger
from .merge import new_by_natural_key
from .storage import PARTITIONS, LedgerTable, month_text


class Conflict(RuntimeError):
    """Another writer made the version first."""


class Folder:
    """Small files of a folder, through the file system that Spark uses for it."""

    def __init__(self, spark, path):
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.path = path.rstrip("/")
        self.fs = self._at("").getFileSystem(self.conf)

    def _at(self, name):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self):
        if not self.fs.exists(self._at("")):
            return []
        return [s.getPath().getName() for s in self.fs.listStatus(self._at(""))]

    def matching(self, pattern):
        """The last two parts of the paths that match."""
        found = [s.getPath() for s in self.fs.globStatus(self._at(pattern)) or []]
        return [f"{p.getParent().getName()}/{p.getName()}" for p in found]

    def text(self, name):
        stream = self.fs.open(self._at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name, text):
        """Put a file in place, whole and only where none has its name."""
        draft = f".{name}.{uuid.uuid4().hex}"
        stream = self.fs.create(self._at(draft))
        stream.write(bytearray(text.encode()))
        stream.close()
        kinds = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.jvm.java.lang.reflect.Array.newInstance(kinds.NONE.getClass(), 1)
        options[0] = kinds.NONE
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._at("").toUri(), self.conf)
        try:
            context.rename(self._at(draft), self._at(name), options)
        except Py4JJavaError as e:
            self.fs.delete(self._at(draft), False)
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                raise Conflict(name) from None
            raise

    def remove(self, name):
        self.fs.delete(self._at(name), True)


#: What a ledger holds before its first commit. ``writes`` maps a folder to its live
#: partitions and whether all of them are live; ``streams`` a query to its last batch.
NOTHING = {"version": 0, "writes": {}, "columns": [], "streams": {}, "tags": {}}


class VersionedLedger(LedgerTable):
    """A ledger below ``location``; ``name`` is that of its table of ids. ``buckets`` should
    be about the number of tasks that a merge of the whole ledger would use."""

    def __init__(self, spark, name, location, buckets=64):
        super().__init__(spark, name, location.rstrip("/"))
        self.ids, self.buckets = f"{name}_ids", buckets
        self.commits, self.data = Folder(spark, f"{self.location}/commits"), Folder(spark, f"{self.location}/data")

    def create(self):
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.ids} (Sistema string, Id_Origen string, part string, `write` string) "
            f"USING parquet PARTITIONED BY (`write`) CLUSTERED BY (Sistema, Id_Origen) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.location}/ids'")
        if "ids" in Folder(self.spark, self.location).names():
            self.spark.sql(f"ALTER TABLE {self.ids} RECOVER PARTITIONS")
        return self

    # --- versions ---

    def versions(self):
        return sorted(int(n[:-5]) for n in self.commits.names() if n.endswith(".json") and n[:-5].isdigit())

    def state(self, version=None):
        """The commit of a version (the last one), as ``NOTHING`` shows it."""
        if version is None:
            version = max(self.versions(), default=0)
        return json.loads(self.commits.text(f"{version:012d}.json")) if version else dict(NOTHING)

    def _commit(self, state):
        self.commits.put(f"{state['version']:012d}.json", json.dumps(state))

    def change(self, make, batch_of=None, tries=20):
        """Commit what ``make(state)`` says: (rows to add or None, state without them). Where
        another writer was first, look again. ``batch_of`` is (query, batch number): a batch
        that is committed already, or an older one, changes nothing."""
        for _ in range(tries):
            state = self.state()
            if batch_of and state["streams"].get(batch_of[0], -1) >= batch_of[1]:
                return state["version"]
            rows, new = make(state)
            new = {**new, "version": state["version"] + 1}
            write = None
            if rows is not None:
                write, parts = self._put(rows)
                if parts:
                    self._index(write, parts)
                    new["writes"] = {**new["writes"], write: {"parts": parts, "whole": True}}
            if batch_of:
                new["streams"] = {**new["streams"], batch_of[0]: batch_of[1]}
            try:
                self._commit(new)
                return new["version"]
            except Conflict:
                self._discard(write)
        raise Conflict(f"{self.name}: other writers were first {tries} times")

    def _put(self, rows):
        """Write rows into a new folder; (its name, its partitions)."""
        write = uuid.uuid4().hex
        rows = self._with_month(rows)
        out = rows.select(*[
            F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in self._schema(self.state()) if f.name != "write"])
        out.hint("rebalance", *PARTITIONS).sortWithinPartitions(*PARTITIONS, "ECO").write.partitionBy(*PARTITIONS).parquet(
            f"{self.data.path}/write={write}")
        return write, sorted(self.data.matching(f"write={write}/Sistema=*/anio_mes=*"))

    def _index(self, write, parts):
        rows = self._open({"columns": [], "writes": {write: {"parts": parts, "whole": True}}})
        part = F.concat(F.lit("Sistema="), "Sistema", F.lit("/anio_mes="), F.coalesce("anio_mes", F.lit("")))
        rows.filter("Id_Origen IS NOT NULL").select("Sistema", "Id_Origen", part.alias("part"), "write").repartition(
            self.buckets, "Sistema", "Id_Origen").write.mode("append").insertInto(self.ids)

    def _discard(self, write):
        if write:
            self.spark.sql(f"ALTER TABLE {self.ids} DROP IF EXISTS PARTITION (`write` = '{write}')")
            Folder(self.spark, f"{self.location}/ids").remove(f"write={write}")
            self.data.remove(f"write={write}")

    def vacuum(self, keep=10):
        """Remove folders that neither the last ``keep`` commits nor a tagged one name, such as
        those of writes that were cut off. Not to be run beside a writer."""
        last = self.state()
        live = {w for v in {*self.versions()[-keep:], *last["tags"].values()} for w in self.state(v)["writes"]}
        for folder in self.data.names():
            if folder.startswith("write=") and folder[6:] not in live:
                self._discard(folder[6:])

    # --- reading ---

    def _schema(self, state):
        fields = [f for f in LEDGER_SCHEMA if f.name != "Sistema"]
        texts = [*state["columns"], "write", *PARTITIONS]
        return T.StructType(fields + [T.StructField(c, T.StringType()) for c in texts])

    def _open(self, state):
        paths = []
        for write, held in state["writes"].items():
            root = f"{self.data.path}/write={write}"
            paths += [root] if held["whole"] else [f"{root}/{p}" for p in held["parts"]]
        schema = self._schema(state)
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.data.path).parquet(*paths)

    def _table(self):
        return self._open(self.state())

    def _columns(self):
        return [c for c in self._schema(self.state()).names if c != "write"]

    def read(self, version=None, tag=None, extra=False):
        """The ledger as of the last commit, a version or a tag; with ``extra`` the columns
        that were added later too."""
        state = self.state(self.state()["tags"][tag] if tag else version)
        return self._open(state).select(*LEDGER_COLS, *(state["columns"] if extra else []))

    def stored_ids(self, state):
        """(Sistema, Id_Origen) of the rows that a commit names, by bucket. A partition that a
        later commit dropped is told apart by its folder and name."""
        self.spark.catalog.refreshTable(self.ids)
        gone = F.lit(False)
        for write, held in state["writes"].items():
            if not held["whole"]:
                gone = gone | ((F.col("write") == write) & ~F.col("part").isin(held["parts"]))
        return self.spark.table(self.ids).filter(F.col("write").isin(list(state["writes"])) & ~gone).select(
            "Sistema", "Id_Origen")

    # --- changes ---

    def new_rows(self, batch, state, by_id):
        """Rows of a cleaned batch that the state does not hold."""
        stored = self._open(state)

        def by_key(rows):
            months = self._with_month(rows).select(*PARTITIONS).distinct()
            return new_by_natural_key(rows, stored.join(months, PARTITIONS, "left_semi").select(*LEDGER_COLS))

        if not by_id:
            return by_key(batch)
        named = batch.filter("Id_Origen IS NOT NULL").join(self.stored_ids(state), ["Sistema", "Id_Origen"], "left_anti")
        return named.select(*batch.columns).unionByName(by_key(batch.filter("Id_Origen IS NULL")))

    def add_columns(self, *names):
        self.change(lambda state: (None, {**state, "columns": state["columns"] + [
            n for n in dict.fromkeys(names) if n not in self._schema(state).names]}))
        return self

    def append(self, rows):
        return self.change(lambda state: (rows, state))

    def merge(self, batch, by_id=False, batch_of=None):
        """Insert the rows of a cleaned batch that are not stored yet, once per ``batch_of``."""
        return self.change(lambda state: (self.new_rows(batch, state, by_id), state), batch_of)

    def _without(self, state, system, texts):
        """The state without the partitions of a system's months."""
        names = {f"Sistema={system}/anio_mes={t}" for t in texts}
        writes = {}
        for write, held in state["writes"].items():
            parts = [p for p in held["parts"] if p not in names]
            if parts:
                writes[write] = {"parts": parts, "whole": held["whole"] and len(parts) == len(held["parts"])}
        return {**state, "writes": writes}

    def delete_month(self, system, year, month):
        """Drop one partition: a commit, no rows are read or written."""
        if system not in SYSTEMS:
            raise ValueError(f"unknown system: {system}")
        return self.change(lambda state: (None, self._without(state, system, [month_text(year, month)])))

    def replace_months(self, rows, system, months, partial=False, by_id=False):
        """Load whole months anew in one commit: the months' rows and, of rows dated outside
        them, those that are not stored yet. A ``partial`` run holds only some accounts, so it
        only merges: emptying the months would lose the other accounts' rows."""
        if system not in SYSTEMS:
            raise ValueError(f"unknown system: {system}")
        rows = rows.filter(F.col("Sistema") == system)
        if partial:
            return self.merge(rows, by_id)
        texts = [month_text(*m) for m in months]
        inside = F.coalesce(year_month("Fecha").isin(texts), F.lit(False))

        def make(state):
            rest = self._without(state, system, texts)
            outside = self.new_rows(rows.filter(~inside), rest, by_id)
            return rows.filter(inside).unionByName(outside), rest

        return self.change(make)

    def backup_and_dedup(self, tag):
        """Name the present version, then commit the ledger without duplicate rows as a new
        one; the tagged rows stay readable. Returns the version that was tagged."""
        def make(state):
            rows = dedup_ledger(self._open(state).drop("anio_mes", "write"))
            return rows, {**state, "writes": {}, "tags": {**state["tags"], tag: state["version"]}}

        self.change(make)
        return self.state()["tags"][tag]

    def restore(self, version=None, tag=None):
        """Make an older version's rows the present ones, in one commit."""
        def make(state):
            old = self.state(state["tags"][tag] if tag else version)
            return None, {**state, "writes": old["writes"]}

        return self.change(make)

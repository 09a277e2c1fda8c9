"""WARC archives: one gzip member per record, written and read record by record.

``write`` makes a record per page. Of pages with equal payloads of at least ``LEAST`` bytes
the one with the smallest page_id is a response, the others are revisits that refer to it.
Payload digests are computed in the JVM; only the few digests with several pages are joined
back. Each task streams its records into archives of about ``ROLL`` bytes in the shared
folder; only archives of the manifest, which is written last, count, so a task that is run
again leaves nothing double.

``read_archives`` reads archives one after the other in each task: members are inflated in
steps of bounded size, headers end at the blank line, Content-Length frames the block, and
the payload's digest is computed while it is inflated and compared with the header. A member
that is cut off, does not inflate or is framed wrongly gives a row with its ``problem``; the
reader goes on at the next member.

The folder may lie in any store that pyarrow opens by URI (file, hdfs, s3, gs).

Defined cases: a null html is an empty payload; a null url leaves out the target URI; rows
without page_id are records with page_id null, and are never referred to; rows that repeat
the smallest page_id of their payload are responses; control characters in a url are
percent-encoded; no pages give a manifest without rows, which reads as no records.
"""

import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import functions as F

from fleetbook.llm.tables import stage
from fleetbook.session import scratch_dir

LEAST = 100
ROLL = 256 << 20
STEP = 1 << 18
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORDS = ("page_id long, target_uri string, record_type string, refers_to long, payload_bytes long, "
            "payload_digest string, verified boolean, problem string, archive string")
_EMPTY = hashlib.sha256(b"").hexdigest()


def _open(path):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _name(page_id):
    return "<urn:page:none>" if page_id is None else f"<urn:page:{page_id}>"


def _id(name):
    text = (name or "").strip("<>").rpartition(":")[2]
    return int(text) if text.lstrip("-").isdigit() else None


def _header_text(url):
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def record(page_id, url, payload, digest, refers_to, date):
    """The bytes of one record, headers and block."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_name(page_id)}",
            f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_header_text(url)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_name(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http;msgtype=response",
             f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data):
    deflate = zlib.compressobj(5, zlib.DEFLATED, 31)
    return deflate.compress(data) + deflate.flush()


def _writer(folder, date):
    def run(batches):
        store, root = _open(folder)
        store.create_dir(root, recursive=True)
        out = path = None
        done = []
        records = size = 0
        for batch in batches:
            for page_id, url, html, digest, refers in zip(*(batch[c].to_pylist() for c in ("page_id", "url", "html", "digest", "refers_to"))):
                if out is None:
                    path = f"{root}/{uuid.uuid4().hex}.warc.gz"
                    out, records, size = store.open_output_stream(path), 0, 0
                data = _member(record(page_id, url, (html or "").encode(), digest, refers, date))
                out.write(data)
                records, size = records + 1, size + len(data)
                if size >= ROLL:
                    out.close()
                    done.append((path, records, size))
                    out = None
        if out is not None:
            out.close()
            done.append((path, records, size))
        if done:
            names, counts, sizes = zip(*done)
            names = [f"{folder}/{n.rpartition('/')[2]}" for n in names]
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())], ["archive", "records", "bytes"])
    return run


def write(pages, folder=None, date="2024-01-01T00:00:00Z"):
    """Write ``pages`` (page_id, url, html) as archives; the manifest (archive, records, bytes)."""
    spark = pages.sparkSession
    folder = folder or scratch_dir(spark, "warc")
    html = F.col("html").cast("string")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"),
        F.sha2(F.coalesce(html, F.lit("")).cast("binary"), 256).alias("digest"),
        F.coalesce(F.octet_length(html), F.lit(0)).alias("size"))
    shared = rows.filter(F.col("size") >= LEAST).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1 AND first IS NOT NULL").drop("n")
    rows = rows.join(stage(shared, "digests"), "digest", "left").withColumn(
        "refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")))
    return stage(rows.select("page_id", "url", "html", "digest", "refers_to").mapInArrow(
        _writer(folder, date), "archive string, records long, bytes long"), "manifest")


class _Member:
    """One gzip member: bytes as they are inflated, in steps of bounded size."""

    def __init__(self, source):
        self.source, self.inflate, self.buffer, self.over = source, zlib.decompressobj(31), b"", False

    def more(self):
        """Inflate a step; False at the end of the member."""
        if self.over or self.inflate.eof:
            return False
        data = self.inflate.unconsumed_tail or self.source.take()
        if not data:
            raise EOFError("cut off")
        self.buffer += self.inflate.decompress(data, STEP)
        if self.inflate.eof:
            self.source.back(self.inflate.unused_data)
        return True

    def until_blank(self, most=1 << 20):
        while (at := self.buffer.find(b"\r\n\r\n")) < 0:
            if len(self.buffer) > most or not self.more():
                raise ValueError("no end of headers")
        head, self.buffer = self.buffer[:at], self.buffer[at + 4:]
        return head, at + 4

    def body(self, size):
        """The next ``size`` bytes in parts."""
        while size:
            if not self.buffer and not self.more():
                raise ValueError("block shorter than its length")
            part, self.buffer = self.buffer[:size], self.buffer[size:]
            size -= len(part)
            if part:
                yield part

    def rest(self):
        while self.more():
            pass
        return self.buffer


class _Source:
    """Compressed bytes with a place for what a member did not use, and the last ones given
    out, among which the next member is sought after damage."""

    def __init__(self, stream):
        self.stream, self.left, self.recent = stream, b"", b""

    def take(self):
        data, self.left = self.left or self.stream.read(STEP), b""
        self.recent = (self.recent + data)[-4 * STEP:]
        return data

    def back(self, data):
        self.left = data + self.left

    def at_end(self):
        """True where nothing is left; else a member starts here."""
        self.left, self.recent = self.left or self.stream.read(STEP), b""
        return not self.left

    def skip(self):
        """Go on at the next start of a gzip member after that of the damaged one."""
        tail, self.left = self.recent[1:] + self.left, b""
        while True:
            at = tail.find(b"\x1f\x8b\x08")
            if at >= 0:
                return self.back(tail[at:])
            data = self.stream.read(STEP)
            if not data:
                return None
            tail = tail[-2:] + data


def _fields(head):
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    pairs = (line.partition(":") for line in lines)
    return first, {k.strip().lower(): v.strip() for k, _, v in pairs}


def _record(member):
    first, fields = _fields(member.until_blank()[0])
    if not first.startswith("WARC/"):
        raise ValueError("no WARC record")
    size = int(fields.get("content-length", "-1"))
    if size < 0:
        raise ValueError("no length")
    kind, declared = fields.get("warc-type"), fields.get("warc-payload-digest", "").partition(":")[2].lower()
    http, used = member.until_blank()
    length = _fields(http)[1].get("content-length")
    if used > size:
        raise ValueError("block shorter than its length")
    sha, payload = hashlib.sha256(), 0
    for part in member.body(size - used):
        sha.update(part)
        payload += len(part)
    if member.rest() != b"\r\n\r\n":
        raise ValueError("block longer than its length")
    if kind == "revisit":
        digest, payload, good = declared, int(length or 0), payload == 0
    else:
        digest = sha.hexdigest()
        good = digest == declared and (length is None or int(length) == payload)
    return (_id(fields.get("warc-record-id")), fields.get("warc-target-uri"), kind, _id(fields.get("warc-refers-to")),
            payload, digest, good, None if good else "digest or length differs")


def records(stream):
    """Rows of the records of one archive, in order."""
    source = _Source(stream)
    while not source.at_end():
        member = _Member(source)
        try:
            yield _record(member)
        except (EOFError, ValueError, zlib.error) as e:
            yield (None, None, None, None, None, None, False, str(e) or type(e).__name__)
            if not member.inflate.eof:
                try:  # a member that inflates is passed whole, else the next start is sought
                    member.buffer = b""
                    while member.more():
                        member.buffer = b""
                except (EOFError, zlib.error):
                    source.skip()


def _reader(batches):
    names = [f.split()[0] for f in _RECORDS.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.string(), pa.string()]

    def batch_of(rows):
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    for batch in batches:
        for archive in batch["archive"].to_pylist():
            store, path = _open(archive)
            rows = []
            with store.open_input_stream(path) as stream:
                for row in records(stream):
                    rows.append((*row, archive))
                    if len(rows) == 2000:
                        yield batch_of(rows)
                        rows = []
            if rows:
                yield batch_of(rows)


def read_archives(manifest):
    """A row per record of the archives named in ``manifest``."""
    archives = manifest.select("archive")
    return archives.repartition(max(1, min(archives.count(), 10_000))).mapInArrow(_reader, _RECORDS)


def round_trip(pages):
    """Write ``pages``, read the archives back: page_id, payload_bytes, payload_digest,
    record_type, refers_to, verified."""
    return read_archives(write(pages)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "verified")

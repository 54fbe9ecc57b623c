"""Web archives: index first, then coalesced reads.

``write_archives`` writes one WARC record a page and, before anything is read
back, an index row for each record: file, offset, length, URL, digest.
``read_records`` takes any selection of index rows, sorts them by file and
offset, joins near byte ranges into one read, and parses the records.

Records are gzip members, so each can be read by its range alone.  A task
writes its records to files of its own under a name no other attempt uses;
only files that the stored index names count, so a failed or repeated attempt
leaves no trace in the result.  Files are reached by ``pyarrow.fs``, which
knows local mounts, HDFS and object stores.
"""

from __future__ import annotations

import uuid
import zlib
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docindex.session import scratch_path

from .common import bounded_batches, partitions, stored

#: Archive files are closed at about this size.
FILE_BYTES = 256 << 20
#: Ranges closer than GAP are read in one go, up to READ_BYTES (one record at least).
GAP = 64 << 10
READ_BYTES = 8 << 20
LEAST_REVISIT = 1000

INDEX = "page_id long, url string, file string, offset long, length long, payload_bytes long, payload_digest string, record_type string, refers_to long"
_INDEX = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
                    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
RECORD = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
_RECORD = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                     ("refers_to", pa.int64()), ("payload", pa.binary())])


#: Written as the target of a page without URL: the field is mandatory.
NO_URL = "about:invalid"


def clean(value) -> str:
    """A header value on one line."""
    return "" if value is None else " ".join(str(value).split())


def record(r: dict, date: str) -> bytes:
    """One record: header, blank line, block, two line ends; as a gzip member.

    The block is an HTTP message: a response has the page as its body, a revisit
    only the head.  Every record has an id of its own; a revisit names the
    record it repeats by the payload's digest and the page's number."""
    body = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {r['payload_bytes']}\r\n\r\n").encode()
    if r["record_type"] == "response":
        body += (r["html"] or "").encode("utf-8")
    head = [("WARC-Type", r["record_type"]), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date), ("WARC-Target-URI", clean(r["url"]) or NO_URL),
            ("WARC-Payload-Digest", "sha1:" + r["payload_digest"]), ("Content-Type", "application/http; msgtype=response"),
            # extension fields: the page's number, and the full payload's size
            ("X-Page-ID", clean(r["page_id"])), ("X-Payload-Length", str(r["payload_bytes"]))]
    if r["refers_to"] is not None:
        head += [("X-Refers-To-Page", str(r["refers_to"])), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    head.append(("Content-Length", str(len(body))))
    raw = b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode("utf-8") + b"\r\n" + body + b"\r\n\r\n"
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def parse(member: bytes) -> dict:
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    h = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    _, _, body = rest[:int(h["Content-Length"])].partition(b"\r\n\r\n")
    number = lambda k: int(h[k]) if h.get(k) else None
    url = h["WARC-Target-URI"]
    return {"page_id": number("X-Page-ID"), "url": "" if url == NO_URL else url, "record_type": h["WARC-Type"], "payload_bytes": number("X-Payload-Length"),
            "payload_digest": h["WARC-Payload-Digest"].removeprefix("sha1:"), "refers_to": number("X-Refers-To-Page"), "payload": body}


def _write(root: str, date: str):
    def run(batches):
        out, file, path, at = None, None, None, 0
        try:
            for batch in batches:
                rows = []
                for i in range(batch.num_rows):
                    r = batch.slice(i, 1).to_pylist()[0]
                    if out is None or at >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        file, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        store, path = pafs.FileSystem.from_uri(root)
                        store.create_dir(path, recursive=True)
                        out = store.open_output_stream(f"{path}/{file}", compression=None)
                    member = record(r, date)
                    out.write(member)
                    rows.append({**{k: r[k] for k in ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to")}, "file": file, "offset": at, "length": len(member)})
                    at += len(member)
                yield pa.RecordBatch.from_pylist(rows, schema=_INDEX)
        finally:
            if out is not None:
                out.close()
    return run


def _read(root: str):
    def run(batches):
        store, path = pafs.FileSystem.from_uri(root)
        open_file, source = None, None
        for batch in batches:
            rows = batch.to_pylist()
            i = 0
            while i < len(rows):
                first, j, end = rows[i], i, rows[i]["offset"] + rows[i]["length"]
                while (j + 1 < len(rows) and rows[j + 1]["file"] == first["file"] and rows[j + 1]["offset"] - end <= GAP
                       and rows[j + 1]["offset"] + rows[j + 1]["length"] - first["offset"] <= READ_BYTES):
                    j += 1
                    end = max(end, rows[j]["offset"] + rows[j]["length"])
                if open_file != first["file"]:
                    if source is not None:
                        source.close()
                    open_file, source = first["file"], store.open_input_file(f"{path}/{first['file']}")
                data = memoryview(source.read_at(end - first["offset"], first["offset"]))
                got = []
                for r in rows[i:j + 1]:
                    a = r["offset"] - first["offset"]
                    got.append(parse(data[a:a + r["length"]]))
                yield pa.RecordBatch.from_pylist(got, schema=_RECORD)
                i = j + 1
        if source is not None:
            source.close()
    return run


def _uri(path: str) -> str:
    return path if "://" in path else path.replace("file:", "file://", 1) if path.startswith("file:/") else f"file://{path}"


def write_archives(pages: DataFrame, root: str) -> DataFrame:
    """Write ``pages`` (page_id, url, html) below ``root`` (a folder that all
    executors share) and return the stored index.

    The payload is the html in UTF-8, null as empty.  Of pages with equal
    payloads of at least 1000 bytes, the one with the largest page_id is a
    response and the others revisits of it.  Pages without page_id are always
    responses.  Rows that repeat the largest page_id of their payload are all
    responses.  A URL is written on one line; a page without one reads back an
    empty one.  Pages of any length are one record; an empty table writes no
    file; other columns of ``pages`` are not looked at.
    """
    bounded_batches(pages.sparkSession)
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    df = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html)
    df = df.withColumn("payload_bytes", F.octet_length("html").cast("long")).withColumn("payload_digest", F.sha1(F.encode("html", "utf-8")))
    long = df.where(F.col("payload_bytes") >= LEAST_REVISIT)
    # payloads that occur more than once; a join with them splits hot ones
    keep = long.groupBy("payload_digest").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).where("n > 1").drop("n")
    keep = stored(keep, "keepers")
    again = F.col("keeper").isNotNull() & (F.col("payload_bytes") >= LEAST_REVISIT) & (F.col("page_id") < F.col("keeper"))
    df = (df.join(keep, "payload_digest", "left").withColumn("record_type", F.when(again, "revisit").otherwise("response"))
          .withColumn("refers_to", F.when(again, F.col("keeper"))).drop("keeper")
          .withColumn("html", F.when(F.col("record_type") == "response", F.col("html"))))
    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    return stored(df.mapInArrow(_write(_uri(root), date), INDEX), "index")


def read_records(index: DataFrame, root: str) -> DataFrame:
    """The records of ``index`` rows, in ranges sorted by file and offset."""
    rows = index.select("file", "offset", "length").repartitionByRange(partitions(index.sparkSession), "file", "offset").sortWithinPartitions("file", "offset")
    return rows.mapInArrow(_read(_uri(root)), RECORD)


def round_trip(pages: DataFrame, root: str | None = None) -> DataFrame:
    """Write ``pages`` as archives and read every record back."""
    root = root or scratch_path(pages.sparkSession, "warc")
    return read_records(write_archives(pages, root), root)

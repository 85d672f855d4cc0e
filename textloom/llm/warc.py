"""WARC archives: one gzip member per record, written and read sequentially.

Writing: every task streams its rows into files of bounded size in a folder
that all machines share, and returns one manifest row per closed file. A file
name is drawn anew by each attempt, so a repeated task leaves files that no
manifest row names. Reading: a task streams one file at a time, inflating
member by member and framing each record by its Content-Length, and checks
block and payload digests.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import materialise, open_shared, scratch_folder, small_batches

#: A file is closed by the record that takes it over this many bytes.
FILE_BYTES = 32 << 20
CHUNK = 1 << 18
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = datetime(2024, 1, 1, tzinfo=timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


class WarcError(ValueError):
    """A record that breaks the format or fails a digest."""


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _line(value: str) -> str:
    """A header value on one line."""
    return " ".join(value.split()) if any(c in value for c in "\r\n") else value


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, digest: str | None = None) -> bytes:
    """One WARC/1.1 record as a gzip member: a response with its payload, or
    a revisit of the record of ``refers_to`` with the HTTP headers only."""
    digest = digest or _sha1(payload)
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        *([("WARC-Target-URI", _line(url))] if url is not None else []),
        *([("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")] if revisit else []),
        ("WARC-Payload-Digest", digest),
        ("WARC-Block-Digest", _sha1(block)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    raw = text.encode("utf-8", "surrogatepass")
    return packer.compress(raw) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def _members(stream, chunk: int = CHUNK):
    """The inflated bytes of each gzip member, as an iterator of pieces."""
    held = b""
    while True:
        if not held:
            held = stream.read(chunk)
            if not held:
                return
        box = {"rest": b""}

        def pieces(first=held, box=box):
            unpack, data = zlib.decompressobj(31), first
            while True:
                try:
                    out = unpack.decompress(data, chunk)
                except zlib.error as e:
                    raise WarcError(f"bad gzip member: {e}") from e
                if out:
                    yield out
                if unpack.eof:
                    box["rest"] = unpack.unused_data
                    return
                data = unpack.unconsumed_tail or stream.read(chunk)
                if not data and not out:
                    raise WarcError("file ends inside a gzip member")

        yield pieces()
        held = box["rest"]


def _header_end(data: bytearray, pieces) -> int:
    while (at := data.find(b"\r\n\r\n")) < 0:
        more = next(pieces, None)
        if more is None:
            raise WarcError("headers do not end")
        data += more
    return at


def _fields(raw: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = raw.decode("utf-8", "surrogatepass").split("\r\n")
    out = {}
    for line in lines:
        name, sep, value = line.partition(":")
        if not sep:
            raise WarcError(f"bad header line {line[:80]!r}")
        out[name.strip().lower()] = value.strip()
    return first, out


def read_records(stream, keep_payload: bool = False):
    """Records of a gzipped WARC stream, one at a time, as dicts.

    Bodies pass through in pieces of at most CHUNK bytes unless the payload
    is kept. Raises WarcError on a bad version, length, trailer or digest.
    """
    for pieces in _members(stream):
        data = bytearray()
        at = _header_end(data, pieces)
        version, head = _fields(bytes(data[:at]))
        if not version.startswith("WARC/1."):
            raise WarcError(f"bad version {version[:40]!r}")
        length = int(head["content-length"])
        del data[: at + 4]
        whole, body, left = hashlib.sha1(), hashlib.sha1(), length
        payload, http, lead, size = bytearray(), None, bytearray(), 0
        while True:
            part = bytes(data[:left])
            del data[:left]
            left -= len(part)
            whole.update(part)
            if http is None:
                lead += part
                if (at := lead.find(b"\r\n\r\n")) >= 0:
                    http = _fields(bytes(lead[:at]))[1]
                    part = bytes(lead[at + 4 :])
                else:
                    part = b""
            body.update(part)
            size += len(part)
            if keep_payload:
                payload += part
            if not left:
                break
            more = next(pieces, None)
            if more is None:
                raise WarcError("record is shorter than its Content-Length")
            data += more
        for more in pieces:
            data += more
        if data != b"\r\n\r\n":
            raise WarcError("record does not end at its Content-Length")
        if head["warc-block-digest"] != "sha1:" + base64.b32encode(whole.digest()).decode():
            raise WarcError(f"block digest of {head['warc-record-id']} fails")
        kind, stated = head["warc-type"], head["warc-payload-digest"]
        full = int((http or {}).get("content-length", size))
        if kind == "response" and (stated != "sha1:" + base64.b32encode(body.digest()).decode() or full != size):
            raise WarcError(f"payload digest of {head['warc-record-id']} fails")
        ident = lambda v: int(v[10:-1]) if v and v[10:-1] else None
        yield {
            "page_id": ident(head["warc-record-id"]),
            "url": head.get("warc-target-uri"),
            "payload_bytes": full,
            "payload_digest": base64.b32decode(stated[5:]).hex(),
            "record_type": kind,
            "refers_to": ident(head.get("warc-refers-to")),
            "payload": bytes(payload) if keep_payload and kind == "response" else None,
        }


MANIFEST = "path string, records long, bytes long"


def _writer(folder: str, file_bytes: int):
    def run(batches):
        out, name, n, size = None, None, 0, 0
        for pdf in batches:
            for page, url, html, refers in zip(pdf["page_id"], pdf["url"], pdf["html"], pdf["refers_to"]):
                if out is None:
                    name, n, size = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = open_shared(name, "wb")
                raw = record(None if pd.isna(page) else int(page), url, html.encode("utf-8", "surrogatepass"), None if pd.isna(refers) else int(refers))
                out.write(raw)
                n, size = n + 1, size + len(raw)
                if size >= file_bytes:
                    out.close()
                    out = None
                    yield pd.DataFrame({"path": [name], "records": [n], "bytes": [size]})
        if out is not None:
            out.close()
            yield pd.DataFrame({"path": [name], "records": [n], "bytes": [size]})

    return run


def with_revisits(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """(page_id, url, html, refers_to): of rows with equal payloads of at
    least ``least_bytes`` bytes, those of the largest page_id are responses
    (refers_to null) and all others refer to it."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.when(F.octet_length("html") >= least_bytes, F.sha2("html", 256)))
    # Only payloads that occur twice take part in the join; the table is
    # written first, so its size is known and a hot payload can be split.
    twice = rows.where("digest is not null").groupBy("digest").agg(F.max("page_id").alias("top"), F.count("*").alias("n")).where("n > 1")
    twice = materialise(twice.select("digest", "top"), "payloads")
    if twice.isEmpty():
        return rows.select("page_id", "url", "html", F.lit(None).cast("long").alias("refers_to"))
    out = rows.join(twice, "digest", "left")
    refers = F.when(F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top")), F.col("top"))
    return out.select("page_id", "url", "html", refers.alias("refers_to"))


def write_archives(pages: DataFrame, folder: str | None = None, file_bytes: int = FILE_BYTES, least_bytes: int = 1000) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as .warc.gz files; returns the
    manifest (path, records, bytes), a table in the shared folder.

    Null html is an empty payload, a null url leaves the target out, a null
    page_id gives an id without number. Repeated rows are records of their
    own; where the largest page_id of a payload repeats, each such row is a
    response. Very long payloads are written whole; the archives stay until
    the application ends if no ``folder`` is named. Other columns are ignored,
    whatever their names. An empty table gives no file.
    """
    spark = pages.sparkSession
    small_batches(spark, 200)
    folder = folder or scratch_folder(spark, "warc")
    return materialise(with_revisits(pages, least_bytes).mapInPandas(_writer(folder, file_bytes), MANIFEST), "manifest")


RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_archives(manifest: DataFrame, keep_payload: bool = False) -> DataFrame:
    """All records of the files in column ``path``, in file order within each
    file; with ``keep_payload``, a binary column ``payload`` too."""
    schema = RECORD + (", payload binary" if keep_payload else "")
    names = [x.split()[0] for x in schema.split(", ")]
    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        for pdf in batches:
            for path in pdf["path"]:
                rows, held = [], 0
                with open_shared(path, "rb") as stream:
                    for r in read_records(stream, keep_payload):
                        rows.append([r[k] for k in names])
                        held += len(r["payload"] or b"")
                        if len(rows) >= 2000 or held > 1 << 24:
                            yield _frame(rows, names)
                            rows, held = [], 0
                if rows:
                    yield _frame(rows, names)

    return manifest.select("path").repartition(parts, "path").mapInPandas(run, schema)


def _frame(rows: list, names: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=names)
    for k in ("page_id", "refers_to"):
        out[k] = out[k].astype("Int64")
    return out

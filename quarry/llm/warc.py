"""WARC archives: writing, and normalising whole-file gzip to one gzip member
per record with a sidecar offset index.

A monolithic ``.warc.gz`` is one gzip stream over the whole file: no record
can be read without inflating everything before it.  The normaliser inflates
each such file once as a stream, writes every record as a gzip member of its
own and notes offset and length of each member in a sidecar index; any record
can then be read on its own.  Memory is bounded by the longest record.

Equal payloads are stored once: of records with the same payload (of at least
``least`` bytes) the one with the largest page_id is the response, the others
are revisits that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm import store
from quarry.llm.text import pieces, texts

END = b"\r\n"
MANIFEST = "path string, records long, bytes long"
#: Date of every record unless one is given: archives of the same pages are the same bytes.
DATE = "1970-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, payload_digest: str, refers_to: int | None, payload_bytes: int, date: str = DATE) -> bytes:
    """One WARC/1.1 record; a revisit (``refers_to``) has no payload.

    The target's control characters are percent-written, as header lines end
    at line breaks."""
    target = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or "")
    head = [b"WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}".encode(), f"WARC-Record-ID: <urn:page:{page_id if page_id is not None else 'null'}>".encode(), f"WARC-Target-URI: {target}".encode(), f"WARC-Date: {date}".encode(), f"WARC-Payload-Digest: sha1:{payload_digest}".encode(), f"X-Payload-Length: {payload_bytes}".encode()]
    if refers_to is not None:
        head += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>".encode()]
        payload = b""
    head.append(f"Content-Length: {len(payload)}".encode())
    return END.join([*head, b"", b""]) + payload + END + END


def revisits(pages: DataFrame, least: int = 0) -> DataFrame:
    """Pages with payload_digest, payload_bytes and refers_to.

    Only (digest, bytes, page_id) are shuffled, and pre-aggregated per task, so
    a payload that a third of all pages share is one row per task.  The largest
    page_id of a payload is met again by the same join; rows that repeat both
    payload and page_id are all responses.  A null page_id is never the
    response of another page; it revisits if any page has its payload."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    known = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("html"),
        F.unhex(F.sha1(payload.cast("binary"))).alias("sha"), F.octet_length(payload).cast("long").alias("payload_bytes"),
    )
    last = known.groupBy("sha", "payload_bytes").agg(F.max("page_id").alias("last")).withColumnRenamed("payload_bytes", "n")
    found = known.join(last, (known.sha == last.sha) & (known.payload_bytes == last.n), "left").select(known["*"], "last")
    other = F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last")) & (F.col("payload_bytes") >= least)
    return found.select("page_id", "url", F.base64("sha").alias("payload_digest"), "payload_bytes", F.when(other, F.col("last")).alias("refers_to"), "html")


def write(pages: DataFrame, folder: str, least: int = 0, level: int = 1) -> DataFrame:
    """Write every page as a record into monolithic archives, one gzip stream
    per task; returns the manifest (path, records, bytes)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        path = f"{folder}/part-{context.partitionId():05d}-{context.taskAttemptId()}.warc.gz"
        squeeze, out, n, size = zlib.compressobj(level, zlib.DEFLATED, 31), None, 0, 0
        for batch in pieces(batches, "html"):
            out = out or store.create(path)
            rows = zip(*(batch[c].to_pylist() for c in ("page_id", "url", "payload_digest", "payload_bytes", "refers_to")), texts(batch["html"]), strict=True)
            for page_id, url, sha, length, refers_to, payload in rows:
                made = squeeze.compress(record(page_id, url, payload, base64.b32encode(base64.b64decode(sha)).decode(), refers_to, length))
                out.write(made)
                n, size = n + 1, size + len(made)
        if out:
            made = squeeze.flush()
            out.write(made)
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n]), pa.array([size + len(made)])], ["path", "records", "bytes"])

    return store.table(revisits(pages, least).mapInArrow(task, MANIFEST), "warc-manifest")


def inflated(path: str, block: int = 1 << 20) -> Iterator[bytes]:
    """A gzip file's content in blocks of bounded size, whatever its members."""
    with store.opened(path) as f:
        pull, within = zlib.decompressobj(31), False
        while raw := f.read(block):
            while True:
                out = pull.decompress(raw, block)
                raw, within = pull.unconsumed_tail, True
                if out:
                    yield out
                if pull.eof:
                    raw, pull, within = pull.unused_data, zlib.decompressobj(31), False
                    if not raw:
                        break
                elif not raw and len(out) < block:
                    break
        if within:
            raise ValueError(f"the gzip stream of {path} ends early")


def records(blocks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """Headers, payload and raw bytes of each record of a stream.

    A stream that ends inside a record is an error, never a shorter record."""
    held, done = bytearray(), False

    def more() -> bool:
        nonlocal done
        if not done and (block := next(blocks, None)) is not None:
            held.extend(block)
        else:
            done = True
        return not done

    while True:
        while (end := held.find(END + END)) < 0 and more():
            pass
        if end < 0:
            if held.strip():
                raise ValueError("the archive ends inside a record's header")
            return
        lines = bytes(held[:end]).decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(headers["content-length"])
        whole = end + 4 + size + 4
        while len(held) < whole and more():
            pass
        if len(held) < whole:
            raise ValueError("the archive ends inside a record")
        raw = bytes(held[:whole])
        del held[:whole]
        yield headers, raw[end + 4 : end + 4 + size], raw


def normalise(manifest: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """Rewrite each archive with a gzip member per record, and write beside it
    ``<archive>.idx``: one JSON line per record with offset, length, id and
    digest.  Returns the manifest of the new archives."""
    count = manifest.count()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            for path in batch["path"].to_pylist():
                name = path.rpartition("/")[2].removesuffix(".warc.gz")
                to, at, n = f"{folder}/{name}-{attempt}.warc.gz", 0, 0
                with store.create(to) as out, store.create(f"{to}.idx") as index:
                    for headers, _, raw in records(inflated(path)):
                        squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
                        made = squeeze.compress(raw) + squeeze.flush()
                        out.write(made)
                        line = {"offset": at, "length": len(made), "id": headers["warc-record-id"], "digest": headers.get("warc-payload-digest", "")}
                        index.write(json.dumps(line).encode() + b"\n")
                        at, n = at + len(made), n + 1
                yield pa.RecordBatch.from_arrays([pa.array([to]), pa.array([n]), pa.array([at])], ["path", "records", "bytes"])

    return store.table(manifest.repartition(max(1, count)).mapInArrow(task, MANIFEST), "warc-members")


def read(manifest: DataFrame, verify: bool = True) -> DataFrame:
    """Read every record back through the sidecar indexes, each by its own
    offset and length: page_id, url, payload_digest, payload_bytes,
    record_type, refers_to, html (null for revisits).  With ``verify`` a
    response whose payload doesn't have its digest is an error."""
    count = manifest.count()
    schema = "page_id long, url string, payload_digest string, payload_bytes long, record_type string, refers_to long, html string"
    kinds = [("page_id", pa.int64()), ("url", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("html", pa.string())]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*rows, strict=True), kinds, strict=True)], [n for n, _ in kinds])

    def page(urn: str) -> int | None:
        name = urn.removeprefix("<urn:page:").removesuffix(">")
        return None if name == "null" else int(name)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch["path"].to_pylist():
                with store.opened(f"{path}.idx") as f:
                    lines = [json.loads(x) for x in f.read().splitlines()]
                rows, size = [], 0
                with store.random_access(path) as f:
                    for line in lines:
                        f.seek(line["offset"])
                        headers, payload, _ = next(records(iter([zlib.decompress(f.read(line["length"]), 31)])))
                        sha = headers["warc-payload-digest"].removeprefix("sha1:")
                        revisit = headers["warc-type"] == "revisit"
                        if verify and not revisit and digest(payload) != sha:
                            raise ValueError(f"payload of {headers['warc-record-id']} in {path} doesn't match its digest")
                        rows.append((page(headers["warc-record-id"]), headers["warc-target-uri"], sha, int(headers["x-payload-length"]) if revisit else len(payload), headers["warc-type"], page(headers["warc-refers-to"]) if revisit else None, None if revisit else payload.decode()))
                        size += len(payload)
                        if size > 8 << 20:
                            yield batch_of(rows)
                            rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    return manifest.repartition(max(1, count)).mapInArrow(task, schema)

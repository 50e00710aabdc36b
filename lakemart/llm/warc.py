"""WARC archives: writer with revisit records, splittable reader.

Every record is a gzip member of its own. The reader cuts files into byte
ranges, one per task: a task searches its range for gzip magic, validates
each candidate by decoding a WARC header from it, and owns the records whose
member starts inside the range (the last one may be read past its end). So a
large archive needs no index and no task reads a whole file.

Archives are written by Spark's own text writer (atomic task commit on any
store; an executor that is lost leaves nothing behind): each value is a
record's member plus an empty member whose last byte is the writer's line
separator, so files stay valid gzip. They are read through ``pyarrow.fs``:
shared mounts, S3, GCS or HDFS.

Defined cases: null html is an empty payload, a null url has no target; null
page ids are written as ``null`` and count as smallest; of several rows with
the largest id and equal payloads all are responses; empty tables make empty
archives; a damaged or truncated member is an error (``damaged="skip"``: the
reader goes on at the next valid record).
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import checkpoint_dir
from .common import sized

#: Payloads below this many bytes are always stored in full.
MIN_REVISIT = 1000
SPLIT_BYTES = 8 << 20
#: Partitions of a read at most; a task then takes several ranges, one after another.
MAX_TASKS = 20_000
WARC_DATE = "2024-01-01T00:00:00Z"
MAGIC = b"\x1f\x8b\x08"
_CHUNK = 1 << 16
#: The most bytes of a member that are decoded at a time to find its header.
_STEP = 1 << 20
_BATCH_BYTES = 8 << 20


def _member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


_EMPTY = _member(b"")
assert _EMPTY[-1] == 0


def _header_text(s: str) -> str:
    """A header value: control characters percent-encoded."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in s)


def build_record(page_id: int | None, url: str | None, payload: bytes, kind: str, refers_to: int | None, date: str = WARC_DATE) -> bytes:
    """An uncompressed WARC record; a revisit holds no payload."""
    digest = hashlib.sha1(payload).digest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    name = "null" if page_id is None else str(page_id)
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_header_text(url)}")
    if kind == "revisit":
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += [f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}", f"X-Payload-Length: {len(payload)}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_header(data: bytes) -> tuple[dict[str, str], int] | None:
    """Header fields (lower-case names) and where the block begins, or None
    if ``data`` does not begin with a whole WARC header."""
    end = data.find(b"\r\n\r\n")
    if not data.startswith(b"WARC/") or end < 0:
        return None
    fields = dict((k.strip().lower(), v.strip()) for k, c, v in
                  (line.partition(":") for line in data[:end].decode("utf-8", "replace").split("\r\n")[1:]) if c)
    return (fields, end + 4) if "warc-type" in fields and fields.get("content-length", "").isdigit() else None


def plan_records(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, payload (bytes), kind, refers_to. Groups of copies are
    found from digests only; payloads stay where they were read unless there
    are more groups than may be broadcast."""
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    p = pages.select("page_id", "url", body.alias("payload"), F.sha1(body).alias("digest"))
    copies = (p.filter(F.octet_length("payload") >= min_revisit).groupBy("digest")
              .agg(F.max("page_id").alias("holder"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "holder"))
    joined = p.join(sized(copies), "digest", "left")
    again = F.col("holder").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("holder"))
    return joined.select("page_id", "url", "payload", F.when(again, "revisit").otherwise("response").alias("kind"),
                         F.when(again, F.col("holder")).alias("refers_to"))


def write_archives(records: DataFrame, path: str, date: str = WARC_DATE) -> None:
    """Write the records of ``plan_records`` under ``path``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, held = [], 0
            for page_id, url, payload, kind, refers_to in zip(*(c.to_pylist() for c in b.columns)):
                out.append(_member(build_record(page_id, url, payload, kind, refers_to, date)) + _EMPTY[:-1])
                held += len(out[-1])
                if held >= _BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])
                    out, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])
    members = records.select("page_id", "url", "payload", "kind", "refers_to").mapInArrow(run, "member binary")
    # a cast to string keeps the bytes; the separator ends the empty member
    members.select(F.col("member").cast("string").alias("value")).write.option("lineSep", "\x00").text(path)


def _open(path: str):
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + path[5:].lstrip("/"))
    if "://" not in path:
        return fs.LocalFileSystem().open_input_file(path)
    store, inside = fs.FileSystem.from_uri(path)
    return store.open_input_file(inside)


def _is_record(f, at: int) -> bool:
    """Whether a member at ``at`` decodes to a WARC header, however long."""
    f.seek(at)
    z, out, rest = zlib.decompressobj(31), bytearray(), b""
    try:
        while not z.eof:
            chunk = rest or f.read(_CHUNK)
            if not chunk:
                return False
            seen = max(0, len(out) - 3)
            out += z.decompress(chunk, _STEP)
            rest = z.unconsumed_tail
            if not b"WARC/".startswith(out[:5]):
                return False
            if out.find(b"\r\n\r\n", seen) >= 0:
                return parse_header(bytes(out)) is not None
    except zlib.error:
        pass
    return False


def _next_record(f, start: int, end: int) -> int | None:
    """Offset of the first valid record that starts in [start, end)."""
    at = start
    while at < end:
        f.seek(at)
        buf = f.read(_CHUNK + 2)
        i = buf.find(MAGIC)
        while 0 <= i < _CHUNK and at + i < end:
            if _is_record(f, at + i):
                return at + i
            i = buf.find(MAGIC, i + 1)
        if len(buf) < _CHUNK + 2:
            return None
        at += _CHUNK
    return None


def read_range(f, start: int, end: int, damaged: str = "raise") -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header fields, block) of the records that start in
    [start, end) of an open file."""
    at = _next_record(f, start, end)
    while at is not None and at < end:
        f.seek(at)
        buf, problem = b"", ""
        while at < end and not problem:
            z, out, used = zlib.decompressobj(31), [], 0
            try:
                while not z.eof:
                    buf = buf or f.read(_CHUNK)
                    if not buf:
                        break
                    out.append(z.decompress(buf))
                    used += len(buf)
                    buf = z.unused_data
            except zlib.error as e:
                problem = str(e)
                break
            if not z.eof:
                if not used:
                    return
                problem = "it ends before its member does"
                break
            data = b"".join(out)
            if data:
                head = parse_header(data)
                if head is None or len(data) < head[1] + int(head[0]["content-length"]):
                    problem = "no whole WARC record"
                    break
                fields, begin = head
                yield at, fields, data[begin:begin + int(fields["content-length"])]
            at += used - len(buf)
        if not problem:
            return
        if damaged != "skip":
            raise ValueError(f"damaged member at byte {at}: {problem}")
        at = _next_record(f, at + 1, end)


def archive_ranges(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES, max_tasks: int = MAX_TASKS) -> DataFrame:
    """(path, start, end): byte ranges of all files under ``path``, one
    partition each up to ``MAX_TASKS``, beyond that several."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .select("path", "length").filter("length > 0"))
    cut = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long"))
    ranges = files.select("path", "length", F.explode(cut).alias("start"))
    ranges = ranges.select("path", "start", F.least(F.col("start") + split_bytes, "length").alias("end"))
    return ranges.repartition(min(max(1, ranges.count()), max_tasks))


RECORD = "path string, offset long, record_type string, record_id string, target_uri string, payload_digest string, payload_bytes long, refers_to string, payload binary"


def read_archives(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES, payloads: bool = True, damaged: str = "raise") -> DataFrame:
    """One row per response or revisit record. ``payload_digest`` is bare
    lower-case hex and, with ``payload_bytes``, that of the full payload:
    computed from it, or as the revisit record states."""
    names = [c.split()[0] for c in RECORD.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]

    def rows(name: str, start: int, end: int):
        with _open(name) as f:
            for at, head, block in read_range(f, start, end, damaged):
                kind = head["warc-type"]
                if kind not in ("response", "revisit"):
                    continue
                _, _, payload = block.partition(b"\r\n\r\n")
                if kind == "response":
                    digest, size = hashlib.sha1(payload).hexdigest(), len(payload)
                else:
                    said = head.get("warc-payload-digest", "").removeprefix("sha1:")
                    digest, size = base64.b32decode(said).hex(), int(head["x-payload-length"]) if "x-payload-length" in head else None
                yield (name, at, kind, head.get("warc-record-id"), head.get("warc-target-uri"), digest, size,
                       head.get("warc-refers-to"), payload if payloads and kind == "response" else None)

    def run(batches):
        for b in batches:
            for name, start, end in zip(*(c.to_pylist() for c in b.columns)):
                held, size = [], 0
                for r in rows(name, start, end):
                    held.append(r)
                    size += 200 + len(r[-1] or b"")
                    if size >= _BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)
    return archive_ranges(spark, path, split_bytes).mapInArrow(run, RECORD)


def page_number(record_id: Column) -> Column:
    """The page id in a record id (null for a null id)."""
    return F.regexp_extract(record_id, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def archive_pages(pages: DataFrame, path: str | None = None, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Write ``pages`` to archives (by default in a new folder beside the
    shared checkpoints) and read them back."""
    spark = pages.sparkSession
    path = path or f"{checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write_archives(plan_records(pages), path)
    return read_archives(spark, path, split_bytes, payloads=False)

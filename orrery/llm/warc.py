"""WARC archives: records of web pages, written with segments and chunked framing, and put together again on reading."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_arrow, join_dealt, scratch, table, write_atomically, written

#: Bytes of a record's block after which it goes on in a continuation record; of an archive after which the next begins; of a chunk.
SEGMENT_BYTES, ARCHIVE_BYTES, CHUNK_BYTES = 16_384, 16 << 20, 4_096
#: Bytes of an archive that are unpacked at once; bytes of blocks and records in a batch that a reader hands on; zlib's level.
READ_BYTES, BATCH_BYTES, BATCH_RECORDS, LEVEL = 8_192, 1 << 20, 1_000, 3
#: Records carry no time of their own; the date is a parameter, so that equal input gives equal archives.
DATE = "1970-01-01T00:00:00Z"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """The payload in chunked transfer framing."""
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in [*parts, b""])


def unchunked(body: bytes) -> bytes:
    """The payload of chunked transfer framing; extensions and trailers are passed over, broken framing is an error."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("a chunk's size is missing")
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            if not body.endswith(b"\r\n"):
                raise ValueError("the last chunk isn't ended")
            return b"".join(out)
        at = end + 2 + size
        if body[at : at + 2] != b"\r\n":
            raise ValueError("a chunk is cut short")
        out.append(body[end + 2 : at])
        at += 2


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response: chunked if its head says so, else all that follows the head."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("the response has no end of its head")
    return unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """One record, compressed as a gzip member of its own."""
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", len(block))])
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def record_id(*parts: object) -> str:
    """The name of a record: a UUID of what tells it from all others of all runs."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, repr(parts))}>"


def info(run: str, file: str) -> bytes:
    return record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(run, file)), ("WARC-Date", DATE), ("WARC-Filename", file), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")


def records_of(page: int | None, url: str | None, payload: bytes, digest: str, own: str, refers: str | None, segment_bytes: int) -> list[bytes]:
    """The records of a page, the first one's name being `own`: a revisit of `refers` without payload, or a response with the continuations that its block needs."""
    name = f"urn:orrery:page:{'' if page is None else page}"
    target = (url or name).replace("\r", "%0D").replace("\n", "%0A")
    page_field = [("Page-ID", page)] if page is not None else []
    common = [("WARC-Record-ID", own), ("WARC-Date", DATE), ("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha1:{digest}"), *page_field, ("Content-Type", "application/http; msgtype=response")]
    if refers:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        return [record([("WARC-Type", "revisit"), *common, ("WARC-Profile", profile), ("WARC-Refers-To", refers)], b"HTTP/1.1 200 OK\r\n\r\n")]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    if len(block) <= segment_bytes:
        return [record([("WARC-Type", "response"), *common], block)]
    pieces = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    out = [record([("WARC-Type", "response"), *common, ("WARC-Segment-Number", 1)], pieces[0])]
    for n, piece in enumerate(pieces[1:], 2):
        last = [("WARC-Segment-Total-Length", len(block))] if n == len(pieces) else []
        out.append(record([("WARC-Type", "continuation"), ("WARC-Record-ID", record_id(own, n)), ("WARC-Date", DATE), ("WARC-Target-URI", target), ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", n), *last], piece))
    return out


def members(content: bytes) -> Iterator[bytes]:
    """The gzip members of an archive, one at a time; what a member leaves of the bytes read for it begins the next one."""
    view, at = memoryview(content), 0
    while at < len(view):
        unpack, out = zlib.decompressobj(31), []
        while not unpack.eof:
            if at >= len(view):
                raise ValueError("the archive is cut short")
            out.append(unpack.decompress(view[at : at + READ_BYTES]))
            at = min(len(view), at + READ_BYTES)
        at -= len(unpack.unused_data)
        yield b"".join(out)


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    size = int(fields["content-length"])
    if len(rest) != size + 4:
        raise ValueError(f"{fields.get('warc-record-id')}: its length isn't that of its block")
    return fields, rest[:size]


def payload(html: Column) -> Column:
    return F.encode(F.coalesce(html, F.lit("")), "UTF-8")


MANIFEST = "file string, path string, records long"


def write_archives(spark: SparkSession, pages: DataFrame, folder: str, segment_bytes: int = SEGMENT_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes a record for each row of pages (page_id, url, html); returns the manifest, a row for each archive.

    Of rows with equal payloads (a null html is an empty payload) that with the largest page_id is a response and the others
    revisit it; rows that repeat that page_id are responses too, and rows without page_id revisit any that has one. What a row
    is gets decided on (page_id, digest) alone, of payloads that more than one row has; payloads are dealt once, by page_id and
    digest, so a payload that very many pages share is no hot key. An archive begins with a warcinfo record. Names of records
    are of this run; a task that is run again writes the same files. Revisits name the response's record: of several rows
    that repeat one page_id and payload, the first in its task.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload(F.col("html")).alias("payload")).withColumn("sha1", F.sha1("payload"))
    pairs = written(spark, pages.groupBy("page_id", "sha1").agg(F.count("*").alias("times")), "warc-pairs")
    shared = pairs.groupBy("sha1").agg(F.max("page_id").alias("kept"), F.sum("times").alias("times")).filter("times > 1").select("sha1", "kept")
    decided = join_dealt(pairs, shared, ["sha1"], pairs.count(), by=F.xxhash64("page_id")).select(F.col("page_id").alias("page"), F.col("sha1").alias("digest"), "kept")
    same = F.col("page_id").eqNullSafe(F.col("page")) & (F.col("sha1") == F.col("digest"))
    dealt = pages.join(decided.hint("merge"), same, "left").select("page_id", "url", "payload", "sha1", "kept").sortWithinPartitions("page_id", "sha1", "url")
    run = uuid.uuid4().hex

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, part, out, size, count, before = TaskContext.get().partitionId(), 0, [], 0, 0, None

        def close() -> pa.RecordBatch:
            name = f"pages-{task:06d}-{part:04d}.warc.gz"
            path = write_atomically(folder, name, b"".join([info(run, name), *out]))
            return pa.RecordBatch.from_pydict({"file": [name], "path": [path], "records": [count]})

        for b in batches:
            for page, url, content, sha1, kept in zip(*(b.column(c) if c == "payload" else b.column(c).to_pylist() for c in ("page_id", "url", "payload", "sha1", "kept")), strict=True):
                key = (page, sha1)
                refers = record_id(run, kept, sha1) if kept is not None and kept != page else None
                own = record_id(run, *key) if key != before and not refers else record_id(run, *key, task, part, count)
                before = key
                for x in records_of(page, url, content.as_py(), base64.b32encode(bytes.fromhex(sha1)).decode(), own, refers, segment_bytes):
                    if size >= archive_bytes:
                        yield close()
                        part, out, size, count = part + 1, [], 0, 0
                    out.append(x)
                    size, count = size + len(x), count + 1
        if out:
            yield close()

    return written(spark, in_arrow(dealt, work, MANIFEST), "warc-manifest")


RECORDS = "file string, page_id long, kind string, record string, digest string, bytes long, refers string, origin string, segment int, total long, block binary"
_arrow = pa.schema([(x.split()[0], {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[x.split()[1]]) for x in RECORDS.split(", ")])


def described(raw: bytes, file: str) -> tuple:
    """A record's row of RECORDS. Only one in segments keeps its block; the payload of a whole one must have its digest."""
    fields, block = parsed(raw)
    kind, number, total = fields["warc-type"], fields.get("warc-segment-number"), fields.get("warc-segment-total-length")
    page, digest, own = fields.get("page-id"), fields.get("warc-payload-digest", "").removeprefix("sha1:") or None, fields["warc-record-id"]
    size = None
    if kind == "response" and not number:
        whole = payload_of(block)
        size = len(whole)
        if digest_of(whole) != digest:
            raise ValueError(f"{own}: its payload hasn't its digest")
    origin = fields.get("warc-segment-origin-id") or own if number else None
    return file, page and int(page), kind, own, digest, size, fields.get("warc-refers-to"), origin, number and int(number), total and int(total), block if number else None


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each record of the folder's archives; warcinfo records are passed over."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column("path").to_pylist(), b.column("content"), strict=True):
                file, rows, held = path.rsplit("/", 1)[1], [], 0
                for raw in members(content.as_buffer()):
                    if (row := described(raw, file))[2] != "warcinfo":
                        rows.append(row)
                        held += len(row[-1] or b"")
                    if held >= BATCH_BYTES or len(rows) >= BATCH_RECORDS:
                        yield _batch(rows, _arrow)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows, _arrow)

    return in_arrow(spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select("path", "content"), work, RECORDS)


WHOLE = pa.schema([("page_id", pa.int64()), ("record", pa.string()), ("digest", pa.string()), ("bytes", pa.int64())])


def reassembled(records: DataFrame) -> DataFrame:
    """page_id, record, digest, bytes of responses in segments: grouped by origin, in order of number, length and digest verified.

    A missing, repeated or misnumbered segment, a wrong total or broken framing is an error. A group holds one record.
    """
    parts = records.groupBy("origin").agg(F.sort_array(F.collect_list(F.struct("segment", "block", "total", "page_id", "digest"))).alias("parts"))

    def whole(origin: str, parts: list) -> tuple:
        if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)):
            raise ValueError(f"{origin}: its segments are {[p['segment'] for p in parts]}")
        block = b"".join(p["block"] for p in parts)
        if parts[-1]["total"] != len(block):
            raise ValueError(f"{origin}: its segments have {len(block)} bytes, its total length is {parts[-1]['total']}")
        content = payload_of(block)
        if digest_of(content) != parts[0]["digest"]:
            raise ValueError(f"{origin}: its payload hasn't its digest")
        return parts[0]["page_id"], origin, parts[0]["digest"], len(content)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield _batch([whole(o.as_py(), p.as_py()) for o, p in zip(b.column("origin"), b.column("parts"), strict=True)], WHOLE)

    return in_arrow(parts, work, "page_id long, record string, digest string, bytes long")


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, from the archives that the manifest names.

    A revisit's page and length are those of the response whose record it names, which must have its digest; where that is
    missing, they are null.
    """
    records = written(spark, read_records(spark, folder).join(manifest.select("file"), "file", "left_semi"), "warc-records")
    whole = records.filter("kind = 'response' and segment is null").select("page_id", "record", "digest", "bytes")
    responses = written(spark, whole.unionByName(reassembled(records.filter("segment is not null"))), "warc-responses")
    revisits = records.filter("kind = 'revisit'").select("page_id", "digest", F.col("refers").alias("record"))
    named = responses.groupBy("record", "digest").agg(F.max("page_id").alias("refers_to"), F.max("bytes").alias("bytes"))
    revisits = join_dealt(revisits, named, ["record", "digest"], revisits.count(), "left", by=F.monotonically_increasing_id()).withColumn("record_type", F.lit("revisit"))
    both = responses.withColumns({"record_type": F.lit("response"), "refers_to": F.lit(None).cast("long")}).unionByName(revisits.select("page_id", "record", "digest", "bytes", "record_type", "refers_to"))
    return both.select("page_id", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WARC archives of all pages, written, read back and put together."""
    folder = scratch(spark, "warc")
    return read_archives(spark, folder, write_archives(spark, table(spark, sf_dir, "pages"), folder))

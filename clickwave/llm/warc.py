"""Web archives: written from pages, read back, assembled into captures.

A page becomes three records: a response that holds its bytes (or a revisit
without them, where an earlier page has the same bytes), and a request and a
metadata record that name it as concurrent.  Archives are plain WARC/1.1: a
task appends its records to one string, which becomes a file as soon as it has
``archive_bytes``, so a file never holds more than that and one page.  Spark's
text writer commits the files; the empty line between two records is its line
separator.

Reading: every file is taken apart by the lengths its records state, so any
bytes may stand in a payload; archives compressed as a whole or record by
record are read as well.  :func:`captures` joins request and metadata records to the response or
revisit that they are concurrent to, directly or through one another's
capture, and gives one nested row per capture.  A revisit has no payload: its
length, and the page that has it, come from the response with the same payload
digest.

Scale: pages are joined with the digests that stand on several pages, dealt
over ``SALTS`` tasks a digest (or sent to all tasks, if they are few), so one
digest of a third of all pages is no task's alone; the join back of revisits is
dealt the same way.  Payloads never pass a shuffle when read back: only digests
and header fields do.  A task holds one archive at a time.

Defined results: null html is the empty payload, null url an empty one; line
breaks in an url are written as %0D, %0A; rows that repeat the smallest page id
of a payload are all responses; a null page id comes after all others, and is a
response only if no other page has its payload; a record cut off by the end of
its file, or without a length, ends that file with an error; captures with
several requests or metadata records take those of smallest id; an empty table
gives no rows; extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickwave.llm.common import small_side
from clickwave.session import checkpoint_dir

MIN_PAYLOAD, ARCHIVE_BYTES, SALTS = 100, 16_000_000, 16
#: Payloads on several pages that are sent to all tasks (80 bytes each), at most.
SMALL_PAYLOADS = 20_000
_BREAK = b"\r\n"
_RECORD = ("type string, record_id string, concurrent_to string, uri string, page_id string, refers_to_uri string, "
           "payload_bytes long, payload_digest string, stated_digest string")


# ---------------------------------------------------------------- writing

def _record(kind: str, record_id: str, fields: list[tuple[str, str]], content_type: str, block: bytes) -> bytes:
    lines = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", "2024-01-01T00:00:00Z"), *fields,
             ("Content-Type", content_type), ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {v}\r\n" for k, v in lines)
    return b"WARC/1.1\r\n" + head.encode() + _BREAK + block


def capture_records(row_id: int, page_id: str | None, url: str | None, html: str | None, digest: str,
                    refers_uri: str | None, revisit: bool) -> list[bytes]:
    """The three records of a page."""
    uri = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    ids = [f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(f'{row_id} {kind} {page_id} {digest}'.encode()).digest()[:16])}>"
           for kind in ("response", "request", "metadata")]
    payload = b"" if revisit else (html or "").encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if revisit:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                   ("WARC-Refers-To-Target-URI", (refers_uri or "").replace("\r", "%0D").replace("\n", "%0A"))]
    about = [("WARC-Target-URI", uri), ("WARC-Concurrent-To", ids[0])]
    return [_record("revisit" if revisit else "response", ids[0], fields, "application/http; msgtype=response", http + payload),
            _record("request", ids[1], about, "application/http; msgtype=request", f"GET {uri} HTTP/1.1\r\n\r\n".encode()),
            _record("metadata", ids[2], about, "application/warc-fields", b"" if page_id is None else f"page-id: {page_id}\r\n".encode())]


def _salt(value: Column) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(SALTS)).cast("int")


def marked_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """``id, url, html, digest, first_uri, revisit`` of every page."""
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), html.alias("html"),
                        F.sha2(html, 256).alias("digest"), F.octet_length(html).cast("long").alias("bytes"))
    shared = (rows.where(F.col("bytes") >= min_payload).groupBy("digest")
              .agg(F.count(F.lit(1)).alias("pages"), F.min(F.struct(F.col("id").isNull().alias("none"), "id", "url")).alias("first"))
              .where(F.col("pages") > 1)
              .select(F.col("digest").alias("_d"), F.col("first.id").alias("first_id"), F.col("first.url").alias("first_uri")))
    small = small_side(shared, SMALL_PAYLOADS)
    if small is shared:
        small = shared.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = rows.join(small, (F.col("digest") == F.col("_d")) & (_salt(F.xxhash64("id", "url")) == F.col("_s")), "left")
    else:
        joined = rows.join(small, F.col("digest") == F.col("_d"), "left")
    return joined.select("id", "url", "html", "digest", "first_uri",
                         (F.col("_d").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id"))).alias("revisit"))


def write_archives(pages: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES, compression: str = "gzip", **options) -> None:
    """Write every page's records to archives below ``path``, compressed
    (``gzip``) or as they are (``none``)."""
    rows = marked_pages(pages, **options).select(F.monotonically_increasing_id().alias("row_id"), F.col("id").cast("string"),
                                                 "url", "html", "digest", "first_uri", "revisit")

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        def flush() -> pa.RecordBatch:  # noqa: E306
            joined = pa.array([(_BREAK + _BREAK).join(held)], pa.binary()).cast(pa.string())
            held.clear()
            return pa.RecordBatch.from_arrays([joined], names=["value"])
        for batch in batches:
            for values in zip(*(column.to_pylist() for column in batch.columns)):
                made = capture_records(*values)
                held += made
                size += sum(map(len, made))
                if size >= archive_bytes:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    writer = rows.mapInArrow(archives, "value string").write.option("maxRecordsPerFile", 1)
    writer.option("lineSep", "\r\n\r\n").option("compression", compression).text(path)


# ---------------------------------------------------------------- reading

def _members(content: bytes) -> Iterator[bytes]:
    """The bytes of an archive; a compressed one member by member."""
    if content[:2] != b"\x1f\x8b":
        yield content
        return
    while content:
        member = zlib.decompressobj(31)
        yield member.decompress(content) + member.flush()
        content = member.unused_data


def parse_records(content: bytes) -> Iterator[tuple[dict[str, str], memoryview]]:
    """Header fields (names in lower case) and block of every record."""
    for data in _members(content):
        at, view = 0, memoryview(data)
        while at < len(data):
            end = data.find(b"\r\n\r\n", at)
            head = data[at:end].decode("utf-8", "replace").split("\r\n") if end >= 0 else []
            fields = {}
            for line in head[1:]:
                name, _, value = line.partition(":")
                fields[name.strip().lower()] = value.strip()
            if not head or not head[0].startswith("WARC/") or not fields.get("content-length", "").isdigit():
                raise ValueError(f"not a record at byte {at} of an archive")
            start, size = end + 4, int(fields["content-length"])
            if start + size > len(data):
                raise ValueError(f"record at byte {at} goes beyond its archive")
            yield fields, view[start:start + size]
            at = start + size
            while data[at:at + 2] == _BREAK:
                at += 2


def http_payload(block: memoryview) -> memoryview:
    """What follows the header lines of an HTTP message."""
    head = bytes(block[:65536]).find(b"\r\n\r\n")
    if head < 0:
        head = bytes(block).find(b"\r\n\r\n")
    return block[head + 4:] if head >= 0 else block[:0]


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record of the archives at ``path``; ``payload`` holds the
    body of a response, unless only its length and digest are wanted."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _RECORD.split(", ")] + ["payload"]
        kinds = [pa.int64() if n == "payload_bytes" else pa.binary() if n == "payload" else pa.string() for n in names]

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for fields, block in parse_records(content.as_py()):
                    kind = fields.get("warc-type")
                    body = http_payload(block) if kind == "response" else None
                    page = None
                    if kind == "metadata":
                        about = dict(line.split(": ", 1) for line in bytes(block).decode("utf-8", "replace").split("\r\n") if ": " in line)
                        page = about.get("page-id")
                    rows.append((kind, fields.get("warc-record-id"), fields.get("warc-concurrent-to"), fields.get("warc-target-uri"),
                                 page, fields.get("warc-refers-to-target-uri"), None if body is None else len(body),
                                 None if body is None else hashlib.sha256(body).hexdigest(),
                                 fields.get("warc-payload-digest", "").removeprefix("sha256:") or None,
                                 bytes(body) if payloads and body is not None else None))
                    size += len(block)
                    if len(rows) >= 5000 or (payloads and size > 8_000_000):
                        yield out(rows)
                        rows, size = [], 0
                if rows:
                    yield out(rows)

    return files.mapInArrow(records, f"{_RECORD}, payload binary")


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture_id, uri, record_type, payload_bytes,
    payload_digest, payload, request, metadata, refers_to_uri``; a revisit's
    length is not known here (:func:`resolved`)."""
    def concurrent(kind: str, name: str) -> DataFrame:
        rows = records.where((F.col("type") == kind) & F.col("concurrent_to").isNotNull())
        return (rows.groupBy(F.col("concurrent_to").alias("capture_id"))
                .agg(F.min(F.struct("record_id", "uri", "page_id")).alias(name)))
    main = records.where(F.col("type").isin("response", "revisit")).select(
        F.col("record_id").alias("capture_id"), "uri", F.col("type").alias("record_type"), "payload_bytes",
        F.coalesce("payload_digest", "stated_digest").alias("payload_digest"), "payload", "refers_to_uri")
    return (main.join(concurrent("request", "request"), "capture_id", "left")
            .join(concurrent("metadata", "metadata"), "capture_id", "left"))


def resolved(found: DataFrame) -> DataFrame:
    """``captures`` with the length and the page (``refers_to``) of the payload
    that each revisit names by its digest."""
    known = (found.where(F.col("record_type") == "response").groupBy(F.col("payload_digest").alias("_d"))
             .agg(F.max("payload_bytes").alias("_bytes"),
                  F.min(F.struct(F.col("metadata.page_id").isNull().alias("none"),
                                 F.col("metadata.page_id").cast("long").alias("n"), F.col("metadata.page_id").alias("id"))).alias("_page")))
    wanted = found.where(F.col("record_type") == "revisit").select(F.col("payload_digest").alias("_w")).distinct()
    known = (known.join(wanted, F.col("_d") == F.col("_w"), "left_semi")
             .withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    revisits = found.where(F.col("record_type") == "revisit").withColumn("_t", _salt(F.col("capture_id")))
    joined = (revisits.join(known, (F.col("payload_digest") == F.col("_d")) & (F.col("_t") == F.col("_s")), "left")
              .withColumn("payload_bytes", F.col("_bytes")).withColumn("refers_to", F.col("_page.id"))
              .drop("_t", "_d", "_s", "_bytes", "_page"))
    rest = found.where(F.col("record_type") != "revisit").withColumn("refers_to", F.lit(None).cast("string"))
    return joined.unionByName(rest)


def archived_pages(pages: DataFrame, id_col: str = "page_id", folder: str | None = None,
                   archive_bytes: int = ARCHIVE_BYTES, **options) -> DataFrame:
    """Write the pages to archives and read them back: ``id, payload_bytes,
    payload_digest, record_type, refers_to`` per page."""
    spark = pages.sparkSession
    folder = folder or f"{checkpoint_dir(spark).rstrip('/')}/archives/{uuid.uuid4().hex}"
    write_archives(pages, folder, archive_bytes, id_col=id_col, **options)
    found = resolved(captures(read_archives(spark, folder, payloads=False).checkpoint()).drop("payload").checkpoint())
    kind = pages.schema[id_col].dataType
    return found.select(F.col("metadata.page_id").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type",
                        F.col("refers_to").cast(kind).alias("refers_to"))

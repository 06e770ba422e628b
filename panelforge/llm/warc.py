"""WARC archives: deduplicating writer and reader with segment reassembly.

Writing (Spark's text sink, so any file system and codec Spark knows): each
page becomes a ``response`` record whose HTTP message carries the payload in
chunked transfer framing. A message longer than ``segment_bytes`` is cut into
a first segment and ``continuation`` records that name the first record as
their origin, their number and, in the last one, the total length. A payload
of at least ``min_revisit_bytes`` equal to that of a page with a smaller id
becomes a ``revisit`` record without payload.

Reading splits the files at the version line with Spark's text source, so
records stream through tasks of bounded memory and plain files can be split.
Framing ends a chunk inside every "WARC/1.1" of a payload, so that the version
line cannot occur in a block of these archives; a record whose block has
another length than its header says is an error, never a silent misreading.

Segments are grouped by origin, ordered by number and verified: numbers 1..n
without a gap, and the total length of the last. Only segmented records are
shuffled. The message is then decoded from its chunks, and digests are checked.

Defined cases: a null html is the empty payload; a null url is left out of the
record, control characters in a url become spaces; repeated rows (same id and
payload) of the smallest id are all responses; a null page_id is never referred
to (equal payloads among null ids only are all responses); an empty table
writes an empty archive and reads as no rows.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_REVISIT_BYTES = 100
SEGMENT_BYTES = 32 * 1024
CHUNK_CHARS = 8192

_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_REVISIT = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = "\r\n\r\n"
_VERSION = "WARC/1.1\r\n"


def _chunked(text):
    """Chunked transfer framing of a text column."""
    parts = F.when(text.contains("WARC/1.1"), F.split(text, r"(?<=WARC)(?=/1\.1)")).otherwise(F.array(text))
    chunks = F.flatten(F.transform(parts, lambda p: F.when(F.octet_length(p).between(1, CHUNK_CHARS), F.array(p)).otherwise(
        F.regexp_extract_all(p, F.lit(rf"(?s).{{1,{CHUNK_CHARS}}}"), F.lit(0)))))
    framed = F.transform(chunks, lambda c: F.concat(F.lower(F.hex(F.octet_length(c))), F.lit("\r\n"), c, F.lit("\r\n")))
    return F.concat(F.array_join(framed, ""), F.lit("0\r\n\r\n"))


def _field(name: str, value):
    """A header line, or nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))


def records(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html",
            min_revisit_bytes: int = MIN_REVISIT_BYTES, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """One row ``value`` per WARC record, without the end of record."""
    body = F.coalesce(F.col(html), F.lit(""))
    uri = F.replace(F.regexp_replace(F.col(url), "[\\x00-\\x20\\x7f]", " "), F.lit("WARC/1.1"), F.lit("WARC%2F1.1"))
    rows = pages.select(F.col(page_id).alias("id"), uri.alias("url"), body.alias("body"),
                        F.sha2(body, 256).alias("digest"), F.octet_length(body).alias("size"))
    shared = (rows.where((F.col("size") >= min_revisit_bytes)).groupBy("digest")
              .agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1 and first_id is not null")
              .select(F.col("digest").alias("of"), "first_id"))
    rows = rows.join(shared, (F.col("digest") == F.col("of")) & (F.col("size") >= min_revisit_bytes), "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("first_id").eqNullSafe(F.col("id"))
    whole = F.when(~F.col("revisit"), F.concat(F.lit(_HTTP), _chunked(F.col("body"))).cast("binary"))
    cut = (rows.withColumn("revisit", revisit).withColumn("message", whole)
           .withColumn("total", F.octet_length("message")).drop("body", "of")
           .withColumn("record", F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">")))
           .withColumn("number", F.explode(F.sequence(
               F.lit(1), F.coalesce(F.ceil(F.col("total") / segment_bytes).cast("int"), F.lit(1))))))
    common = [_field("WARC-Record-ID", F.col("record")), _field("WARC-Target-URI", F.col("url")),
              _field("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
              _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
              _field("Page-Id", F.col("id")), F.lit("Content-Type: application/http; msgtype=response\r\n")]
    again = F.concat(F.lit("WARC-Type: revisit\r\n"), *common, F.lit(f"WARC-Profile: {_PROFILE}\r\n"),
                     _field("Refers-To-Page-Id", F.col("first_id")), _field("Payload-Length", F.col("size")),
                     F.lit(f"Content-Length: {len(_REVISIT)}{_END}{_REVISIT}"))
    block = F.substring("message", (F.col("number") - 1) * segment_bytes + 1, F.lit(segment_bytes))
    last, one = F.col("number") * segment_bytes >= F.col("total"), F.col("total") <= segment_bytes
    start = F.concat(F.lit("WARC-Type: response\r\n"), *common)
    more = F.concat(F.lit("WARC-Type: continuation\r\n"),
                    F.concat(F.lit("WARC-Record-ID: <urn:uuid:"), F.uuid(), F.lit(">\r\n")),
                    _field("WARC-Segment-Origin-ID", F.col("record")))
    response = F.concat(
        F.when(F.col("number") == 1, start).otherwise(more),
        F.when(~one, _field("WARC-Segment-Number", F.col("number"))).otherwise(F.lit("")),
        F.when(~one & last, _field("WARC-Segment-Total-Length", F.col("total"))).otherwise(F.lit("")),
        _field("Content-Length", F.octet_length(block)), F.lit("\r\n"), block.cast("string"))
    return cut.select(F.concat(F.lit(_VERSION), F.when(F.col("revisit"), again).otherwise(response)).alias("value"))


def write(pages: DataFrame, path: str, *, compression: str = "gzip", **settings) -> None:
    """Write the pages as WARC files under path."""
    records(pages, **settings).write.option("lineSep", _END).option("compression", compression).text(path)


def _parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and block of one record without its version line."""
    head, _, block = raw.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n"):
        name, _, value = line.partition(b":")
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not block.endswith(b"\r\n\r\n") or int(fields.get("content-length", -1)) != len(block) - 4:
        raise ValueError(f"damaged WARC record {fields.get('warc-record-id')}: {fields.get('content-length')} bytes "
                         f"announced, {len(block) - 4} found")
    return fields, block[:-4]


def _records(batch):
    for value in batch.column("value").cast(pa.binary()):
        if raw := value.as_buffer().to_pybytes():          # nothing stands before a file's first record
            yield _parse(raw)


_SEGMENT = pa.schema([("record", pa.string()), ("number", pa.int32()), ("total", pa.int64()), ("page_id", pa.string()),
                      ("digest", pa.string()), ("block", pa.binary())])
_PAGE = pa.schema([("record", pa.string()), ("kind", pa.string()), ("page_id", pa.string()), ("payload", pa.binary()),
                   ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.string())])
_SEGMENT_SQL = "record string, number int, total long, page_id string, digest string, block binary"
_PAGE_SQL = ("record string, kind string, page_id string, payload binary, payload_bytes long, payload_digest string, "
             "refers_to string")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _digest(fields: dict[str, str]) -> str | None:
    told = fields.get("warc-payload-digest", "")
    return told.removeprefix("sha256:") if told.startswith("sha256:") else None


def _decoded(record, page_id, told, message) -> tuple:
    payload = dechunk(message)
    digest = hashlib.sha256(payload).hexdigest()
    if told and told != digest:
        raise ValueError(f"record {record}: payload digest {digest}, announced {told}")
    return record, "response", page_id, payload, len(payload), digest, None


def _whole(batches):
    """Responses in one record, decoded, and revisits."""
    for b in batches:
        rows = []
        for f, block in _records(b):
            kind, record, page = f.get("warc-type"), f.get("warc-record-id"), f.get("page-id")
            if kind == "response" and "warc-segment-number" not in f:
                rows.append(_decoded(record, page, _digest(f), block))
            elif kind == "revisit":
                size = f.get("payload-length")
                rows.append((record, kind, page, None, int(size) if size else None, _digest(f),
                             f.get("refers-to-page-id")))
        yield _batch(rows, _PAGE)


def _segments(batches):
    for b in batches:
        rows = []
        for f, block in _records(b):
            if (number := f.get("warc-segment-number")) and f.get("warc-type") in ("response", "continuation"):
                total = f.get("warc-segment-total-length")
                rows.append((f.get("warc-segment-origin-id") or f.get("warc-record-id"), int(number),
                             int(total) if total else None, f.get("page-id"), _digest(f), block))
        yield _batch(rows, _SEGMENT)


def _joined(batches):
    """Reassembled messages, decoded."""
    for b in batches:
        yield _batch([_decoded(*r) for r in zip(*(b.column(c).to_pylist() for c in
                                                  ("record", "page_id", "digest", "block")))], _PAGE)


def dechunk(message: bytes) -> bytes:
    """Payload of an HTTP message; chunked transfer framing is decoded where it is used."""
    head, gap, body = message.partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("an HTTP message without end of header")
    if b"transfer-encoding: chunked" not in head.lower():
        return body
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if size == 0:
            return b"".join(out)
        out.append(body[end + 2:end + 2 + size])
        at = end + 2 + size
        if len(out[-1]) != size or body[at:at + 2] != b"\r\n":
            raise ValueError("a chunk of another length than announced")
        at += 2


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records of an archive: (record, kind, page_id, payload, payload_bytes, payload_digest, refers_to).

    ``payload`` is null for revisits; their length and digest are those of the
    payload that they refer to, as their record tells.
    """
    try:
        lines = spark.read.option("lineSep", _VERSION).text(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        lines = spark.createDataFrame([], "value string")
    raw = F.col("value").cast("binary").alias("value")
    whole = lines.select(raw).mapInArrow(_whole, _PAGE_SQL)
    segments = (lines.where(F.col("value").contains("WARC-Segment-Number:")).select(raw)
                .mapInArrow(_segments, _SEGMENT_SQL).groupBy("record")
                .agg(F.max("page_id").alias("page_id"), F.max("digest").alias("digest"), F.max("total").alias("total"),
                     F.sort_array(F.collect_list(F.struct("number", "block"))).alias("parts")))
    message = F.array_join(F.transform("parts", lambda p: p["block"].cast("string")), "").cast("binary")
    counted = F.transform("parts", lambda p: p["number"]) == F.sequence(F.lit(1), F.size("parts"))
    right = counted & F.coalesce(F.octet_length("block") == F.col("total"), F.lit(False))
    wrong = F.raise_error(F.concat(F.lit("segments missing or of a wrong total length: "), F.col("record")))
    joined = segments.withColumn("block", message).select(
        "record", "page_id", "digest", F.when(right, F.col("block")).otherwise(wrong.cast("binary")).alias("block"))
    return whole.unionAll(joined.mapInArrow(_joined, _PAGE_SQL))

"""Web archives: write captures as WARC records, read them back, assemble transactions.

A capture becomes a request, a response (or a revisit of an equal payload) and a
metadata record; request and metadata name the response in ``WARC-Concurrent-To``.
Archives go through Spark's text writer, so they land in any store that Spark
reaches and a lost task is written again. Reading takes whole archive files, whose
size the writer bounds, decompresses them as a stream and holds one record at a time.
Assembly joins the records of a capture through their concurrent-to identifiers.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrow import record_batch

#: Payloads below so many bytes are never revisits.
LEAST_REVISIT = 1000
#: Payload bytes up to which so many captures share an archive file: none of these holds
#: more than 256 MB or one capture. Files also end with their partition.
SIZES = ((1 << 17, 2000), (1 << 21, 128), (1 << 25, 8), (None, 1))
#: Bytes decompressed at once.
CHUNK = 1 << 20
DATE = "2024-01-01T00:00:00Z"
#: Line ends and the end of a record.
CRLF = "\r\n"
END = CRLF * 2

RECORD = (
    "record_id string, type string, concurrent_to string, refers_to string, "
    "target_uri string, date string, payload_bytes bigint, payload_digest string, "
    "fields map<string,string>, payload binary"
)


def with_revisits(captures: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """Add ``holder``: for a revisit the id of the capture with the same payload, else null.

    Payloads are equal if SHA-1 and length are. Of equal ones of at least ``least``
    bytes the largest id holds the payload; rows that repeat that id hold it as well.
    Only ids and digests are grouped; the join is of the form that adaptive execution
    splits when one payload makes up much of the input.
    """
    large = captures.where(F.col("payload_bytes") >= least)
    holders = (
        large.groupBy("payload_digest", "payload_bytes")
        .agg(F.max("page_id").alias("holder"), F.count("*").alias("copies"))
        .where("copies > 1")
        .drop("copies")
    )
    joined = captures.join(holders, ["payload_digest", "payload_bytes"], "left")
    own = F.col("holder").eqNullSafe(F.col("page_id"))
    return joined.withColumn("holder", F.when(~own, F.col("holder")))


def captures(df: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    payload = F.coalesce(df[html], F.lit(""))
    return df.select(
        df[page_id].alias("page_id"),
        # Line ends in an address would end its header.
        F.regexp_replace(F.coalesce(df[url], F.lit("")), r"[\x00-\x20\x7f]", "%20").alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha1(payload.cast("binary")).alias("payload_digest"),
    )


def record(kind: str, record_id: Column, block: Column, **headers: Column) -> Column:
    """One record as text; the writer adds its end."""
    lines = [F.lit(f"WARC/1.1{CRLF}WARC-Type: {kind}{CRLF}WARC-Record-ID: <"), record_id]
    for name, value in headers.items():
        lines += [F.lit(f"{'>' if len(lines) == 2 else ''}{CRLF}{name.replace('_', '-')}: "), value]
    length = F.octet_length(block).cast("string")
    return F.concat(*lines, F.lit(f"{CRLF}Content-Length: "), length, F.lit(END), block)


def archive_text(rows: DataFrame, date: str) -> DataFrame:
    """The three records of each capture as one text."""
    unique = F.concat(
        F.lit("urn:page:"),
        F.coalesce(F.col("page_id").cast("string"), F.lit("none")),
        F.lit(":"),
        F.monotonically_increasing_id().cast("string"),
    )
    rows = rows.withColumn("capture", unique)
    capture, url = F.col("capture"), F.col("url")
    concurrent = F.concat(F.lit("<"), capture, F.lit(":response>"))
    digest = F.concat(F.lit("sha1:"), F.col("payload_digest"))
    size = F.col("payload_bytes").cast("string")
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        size,
        F.lit(END),
    )
    common = {"WARC_Target_URI": url, "WARC_Date": F.lit(date)}
    response_id = F.concat(capture, F.lit(":response"))
    held = {**common, "WARC_Payload_Digest": digest}
    http_type = {"Content_Type": F.lit("application/http; msgtype=response")}
    response = record("response", response_id, F.concat(http, F.col("payload")), **held, **http_type)
    refers = F.concat(F.lit("<urn:page:"), F.col("holder").cast("string"), F.lit(">"))
    profile = F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    revisit = record(
        "revisit", response_id, http, **held, WARC_Refers_To=refers, WARC_Profile=profile, **http_type
    )
    request = record(
        "request",
        F.concat(capture, F.lit(":request")),
        F.concat(F.lit("GET "), url, F.lit(f" HTTP/1.1{END}")),
        **common,
        WARC_Concurrent_To=concurrent,
        Content_Type=F.lit("application/http; msgtype=request"),
    )
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    metadata = record(
        "metadata",
        F.concat(capture, F.lit(":metadata")),
        F.concat(F.lit("page-id: "), page, F.lit(CRLF)),
        **common,
        WARC_Concurrent_To=concurrent,
        Content_Type=F.lit("application/warc-fields"),
    )
    middle = F.when(F.col("holder").isNull(), response).otherwise(revisit)
    return rows.select(F.concat(request, F.lit(END), middle, F.lit(END), metadata).alias("value"))


def write_archives(
    df: DataFrame, folder: str, page_id: str, url: str, html: str, date: str = DATE
) -> None:
    """Write a capture per row of ``df`` as gzipped WARC files to the new ``folder``.

    Captures of similar size share files, so that files are bounded in bytes.

    A null html is an empty payload, a null id is written as none, a null address as
    empty; repeated rows are captures of their own; extra columns are not read.
    """
    given = captures(df, page_id, url, html)
    size_class = F.lit(len(SIZES) - 1)
    for i, (most, _) in reversed(list(enumerate(SIZES[:-1]))):
        size_class = F.when(F.col("payload_bytes") <= most, i).otherwise(size_class)
    present = given.groupBy(size_class.alias("i")).count().collect()
    rows = with_revisits(given).withColumn("size_class", size_class)
    for i in sorted(r["i"] for r in present) or [0]:
        archive_text(rows.where(F.col("size_class") == i), date).write.options(
            lineSep=END,
            compression="gzip",
            maxRecordsPerFile=SIZES[i][1],
            **{"zlib.compress.level": "BEST_SPEED"},
        ).text(f"{folder}/size-{i}")


def read_archives(spark: SparkSession, folder: str, content: bool = True) -> DataFrame:
    """A row per record of the WARC files (plain or gzipped) in ``folder``.

    ``payload_bytes`` and ``payload_digest`` (lowercase hex SHA-1) are taken from the
    payload itself; for a revisit, which has none, from its headers. ``fields`` holds
    the lines of a metadata record. ``content=False`` leaves out the payloads.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    schema = spark.createDataFrame([], RECORD).schema

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                rows, held = [], 0
                for headers, block in records(decompressed(data.as_buffer())):
                    rows.append(row_of(headers, block, content))
                    held += len(block) if content else 0
                    if len(rows) >= 1000 or held > CHUNK * 8:
                        yield record_batch(zip(*rows, strict=True), arrow)
                        rows, held = [], 0
                if rows:
                    yield record_batch(zip(*rows, strict=True), arrow)

    return files.select("content").mapInArrow(run, schema)


def decompressed(data: pa.Buffer) -> Iterator[bytes]:
    """The bytes of a file in chunks, through any number of gzip members."""
    view = memoryview(data)
    if bytes(view[:2]) != b"\x1f\x8b":
        for start in range(0, len(view), CHUNK):
            yield bytes(view[start : start + CHUNK])
        return
    stream = zlib.decompressobj(31)
    for start in range(0, len(view), CHUNK):
        part = bytes(view[start : start + CHUNK])
        while part:
            if stream.eof:
                part = part.lstrip(b"\0")
                stream = zlib.decompressobj(31)
                continue
            yield stream.decompress(part, CHUNK)
            part = stream.unused_data if stream.eof else stream.unconsumed_tail


def records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record, by its Content-Length."""
    held = b""

    def more() -> bool:
        nonlocal held
        for chunk in chunks:
            if chunk:
                held += chunk
                return True
        return False

    while True:
        held = held.lstrip(b"\r\n")
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not more():
                if held.strip():
                    raise ValueError("a WARC file ends inside a record's headers")
                return
            held = held.lstrip(b"\r\n")
        first, *lines = held[:end].decode("utf-8", "replace").split(CRLF)
        if not first.startswith("WARC/"):
            raise ValueError(f"no WARC record starts with {first[:40]!r}")
        pairs = (line.partition(":") for line in lines)
        headers = {name.strip().lower(): value.strip() for name, _, value in pairs}
        size, start = int(headers["content-length"]), end + 4
        parts, have = [held[start:]], len(held) - start
        held = b""
        while have < size:
            if not more():
                raise ValueError("a WARC file ends inside a record")
            parts.append(held)
            have += len(held)
            held = b""
        whole = b"".join(parts)
        held = whole[size:]
        yield headers, whole[:size]


def row_of(headers: dict[str, str], block: bytes, content: bool) -> tuple:
    kind = headers["warc-type"]
    size = digest = payload = fields = None
    if kind in ("response", "revisit"):
        http, _, body = block.partition(b"\r\n\r\n")
        if kind == "response":
            size, digest = len(body), hashlib.sha1(body).hexdigest()
            payload = body if content else None
        else:
            size = int(lines_of(http)["content-length"])
            digest = headers["warc-payload-digest"].partition(":")[2]
    elif kind == "metadata":
        fields = lines_of(block)
    bare = lambda name: headers[name].strip("<>") if name in headers else None
    return (
        bare("warc-record-id"), kind, bare("warc-concurrent-to"), bare("warc-refers-to"),
        headers.get("warc-target-uri"), headers.get("warc-date"), size, digest, fields, payload,
    )


def lines_of(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split(CRLF)
    pairs = (line.partition(":") for line in lines if ":" in line)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def transactions(records: DataFrame) -> DataFrame:
    """A nested row per capture: ``capture_id, response, request, metadata``.

    ``response`` is the response or revisit record, the others are the records that
    name it as concurrent (of several the one with the smallest record id) or null.
    Requests and metadata without a response give no capture.
    """
    captured = records.where(F.col("type").isin("response", "revisit"))
    whole = F.struct(*(c for c in records.columns))

    def concurrent(kind: str, *columns: str) -> DataFrame:
        own = records.where((F.col("type") == kind) & F.col("concurrent_to").isNotNull())
        one = F.min_by(F.struct(*columns), "record_id").alias(kind)
        return own.groupBy(F.col("concurrent_to").alias("capture_id")).agg(one)

    return (
        captured.select(F.col("record_id").alias("capture_id"), whole.alias("response"))
        .join(concurrent("request", "record_id", "target_uri", "date"), "capture_id", "left")
        .join(concurrent("metadata", "record_id", "fields"), "capture_id", "left")
    )


def capture_digests(found: DataFrame, id_type: str = "bigint") -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` per capture.

    The id comes from the capture's metadata record (none: null).
    """
    page = F.col("metadata.fields")["page-id"]
    refers = F.regexp_extract("response.refers_to", r"^urn:page:(.*)$", 1)
    return found.select(
        F.expr("nullif(metadata.fields['page-id'], '')").cast(id_type).alias("page_id")
        if id_type != "string"
        else page.alias("page_id"),
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        F.when(F.col("response.type") == "revisit", refers).cast(id_type).alias("refers_to"),
    )

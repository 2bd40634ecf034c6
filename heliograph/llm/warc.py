"""WARC archives: write captures as request, response and metadata records, read archives back, assemble transactions.

An archive is a Spark text file: a record ends with two line ends, and that is the line separator of the file. Reading
goes by Content-Length, so payloads may hold anything.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heliograph import session
from heliograph.llm.common import fresh, table, told_apart

CRLF = "\r\n"

# Payloads from this size on are written once; later captures of the same payload revisit it.
REVISIT_BYTES = 1000

# Captures in one archive file at most.
FILE_CAPTURES = 5000

# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WHEN = "2024-01-01T00:00:00Z"

RECORD = (
    "type string, record_id string, concurrent_to string, refers_to string, target_uri string, digest string, "
    "payload_bytes bigint, page_id string, payload binary"
)


def _record(kind: str, record_id: Column, headers: list[Column], block: Column) -> Column:
    """One record without the two line ends that follow it."""
    size = F.octet_length(block).cast("string")
    head = [
        F.lit(f"{VERSION}{CRLF}WARC-Type: {kind}{CRLF}WARC-Date: {WHEN}{CRLF}WARC-Record-ID: <"),
        record_id,
        F.lit(f">{CRLF}"),
        *headers,
        F.lit("Content-Length: "),
        size,
        F.lit(CRLF + CRLF),
    ]
    return F.concat(*head, block)


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))


def _urn(kind: str, row: Column) -> Column:
    h = F.md5(F.concat(F.lit(kind), row.cast("string")))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *parts))


def _one_line(text: Column) -> Column:
    """A header value: line ends, other control characters and spaces are percent-encoded."""
    safe = F.coalesce(text, F.lit(""))
    bad = safe.rlike(r"[\x00-\x20\x7F]")
    return F.when(bad, F.replace(F.url_encode(safe), F.lit("+"), F.lit("%20"))).otherwise(safe)


def plan_captures(pages: DataFrame, least: int = REVISIT_BYTES, from_files: bool = False) -> DataFrame:
    """Rows (row, page_id, url, payload, digest, first_row): `first_row` is that of the response a revisit refers to.

    Of the captures with one payload of at least `least` bytes, that with the largest page_id is the response, and of
    these, if rows repeat, the last row; NULL ids come first. Payloads are compared by SHA-256. Only the digests of
    payloads met twice are joined, so a payload that a third of all captures share is spread by a skew join. `pages` is
    read twice; unless it is a table read `from_files`, its rows are written first.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    row = fresh(pages, "row")
    rows = told_apart(pages, row, from_files).select(
        F.col(row).alias("row"),
        "page_id",
        "url",
        payload.alias("payload"),
        F.sha1(F.encode(payload, "UTF-8")).alias("digest"),
        F.when(F.octet_length(payload) >= least, F.unhex(F.sha2(F.encode(payload, "UTF-8"), 256))).alias("same"),
    )
    shared = (
        rows.filter("same IS NOT NULL")
        .groupBy("same")
        .agg(F.max(F.struct("page_id", "row")).alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("same", F.col("first.row").alias("first_row"))
    )
    large, small = rows.filter("same IS NOT NULL"), rows.filter("same IS NULL")
    joined = large.join(shared, "same", "left").withColumn(
        "first_row", F.when(F.col("first_row") != F.col("row"), F.col("first_row"))
    )
    return joined.drop("same").unionByName(
        small.drop("same").withColumn("first_row", F.when(F.lit(False), F.col("row")))
    )


def write_archives(
    pages: DataFrame,
    path: str,
    least: int = REVISIT_BYTES,
    per_file: int = FILE_CAPTURES,
    from_files: bool = False,
) -> None:
    """Write every row of `pages` (page_id, url, html) as three records into gzip archives below `path`.

    The payload is the html in UTF-8, NULL as empty. NULL urls become empty and odd characters in them are encoded.
    The committed output of failed tasks is left to Spark's writer. Extra columns are not read.
    """
    c = plan_captures(pages, least, from_files)
    capture, uri = _urn("capture", F.col("row")), _one_line(F.col("url"))
    target = _header("WARC-Target-URI", uri)
    digest = _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))
    beside = _header("WARC-Concurrent-To", F.concat(F.lit("<"), capture, F.lit(">")))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.octet_length("payload").cast("string"),
        F.lit(CRLF + CRLF),
    )
    request = _record(
        "request",
        _urn("request", F.col("row")),
        [target, beside, _header("Content-Type", F.lit("application/http; msgtype=request"))],
        F.concat(F.lit("GET "), uri, F.lit(f" HTTP/1.1{CRLF}{CRLF}")),
    )
    answer = _header("Content-Type", F.lit("application/http; msgtype=response"))
    response = _record("response", capture, [target, digest, answer], F.concat(http, F.col("payload")))
    refers = _header("WARC-Refers-To", F.concat(F.lit("<"), _urn("capture", F.col("first_row")), F.lit(">")))
    revisit = _record(
        "revisit", capture, [target, digest, answer, _header("WARC-Profile", F.lit(PROFILE)), refers], http
    )
    metadata = _record(
        "metadata",
        _urn("metadata", F.col("row")),
        [target, beside, _header("Content-Type", F.lit("application/warc-fields"))],
        F.concat(F.lit("page_id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(CRLF)),
    )
    main = F.when(F.col("first_row").isNull(), response).otherwise(revisit)
    captures = c.select(F.concat_ws(CRLF + CRLF, request, main, metadata).alias("value"))
    options = {"lineSep": CRLF + CRLF, "compression": "gzip", "maxRecordsPerFile": str(per_file)}
    captures.write.options(**options).text(path)


def _headers(stream: io.BufferedIOBase) -> dict[str, str]:
    found = {}
    while line := stream.readline().rstrip(b"\r\n"):
        name, _, value = line.partition(b":")
        found[name.decode().lower()] = value.strip().decode()
    return found


def _records(content: bytes, payloads: bool) -> Iterator[tuple]:
    """Records of one archive, read as a stream: one record is held at a time."""
    with gzip.GzipFile(fileobj=io.BytesIO(content)) as stream:
        while line := stream.readline():
            if not line.startswith(b"WARC/"):
                if line.strip():
                    raise ValueError("no record begins where the last one ends")
                continue
            head = _headers(stream)
            block = stream.read(int(head["content-length"]))
            kind, payload, page, digest = head["warc-type"], None, None, head.get("warc-payload-digest")
            if kind == "response":
                payload = block[block.index(b"\r\n\r\n") + 4 :]
                found = "sha1:" + hashlib.sha1(payload).hexdigest()
                if digest not in (None, found):
                    raise ValueError(f"{head['warc-record-id']}: the payload does not have its digest")
                digest = found
            elif kind == "metadata":
                page = block.decode().partition("page_id:")[2].strip() or None
            yield (
                kind,
                head["warc-record-id"].strip("<>"),
                head["warc-concurrent-to"].strip("<>") if "warc-concurrent-to" in head else None,
                head["warc-refers-to"].strip("<>") if "warc-refers-to" in head else None,
                head.get("warc-target-uri"),
                digest and digest.removeprefix("sha1:"),
                None if payload is None else len(payload),
                page,
                payload if payloads else None,
            )


def _parsed(payloads: bool, most: int = 16 << 20) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = [field.split()[0] for field in RECORD.split(", ")]
    kinds = {"payload_bytes": pa.int64(), "payload": pa.binary()}

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(x, kinds.get(n, pa.string())) for n, x in zip(names, zip(*rows, strict=True), strict=True)]
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for files in batches:
            for content in files.column("content"):
                rows, held = [], 0
                for record in _records(content.as_py(), payloads):
                    rows.append(record)
                    held += 500 + len(record[-1] or b"")
                    if held > most:
                        yield batch(rows)
                        rows, held = [], 0
                if rows:
                    yield batch(rows)

    return run


def read_records(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """Every record of the archives below `path`; payloads of responses only where asked for.

    A file is read whole, so archives should be of bounded size; `write_archives` sees to that.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_parsed(payloads), RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: its id and the structs request, response (or revisit) and metadata.

    Records are joined through their concurrent-to identifiers. All point to the one response or revisit of their
    capture, so the join is a grouping by that identifier: one shuffle, three rows to a group. A missing part is NULL.
    """
    parts = F.struct(*[c for c in records.columns if c != "concurrent_to"])
    return records.groupBy(F.coalesce("concurrent_to", "record_id").alias("capture")).agg(
        F.first(F.when(F.col("type") == "request", parts), ignorenulls=True).alias("request"),
        F.first(F.when(F.col("type").isin("response", "revisit"), parts), ignorenulls=True).alias("response"),
        F.first(F.when(F.col("type") == "metadata", parts), ignorenulls=True).alias("metadata"),
    )


def resolve(captures: DataFrame) -> DataFrame:
    """Assembled captures with the page and payload size of what they refer to.

    Only revisits are joined; responses need nothing. `captures` should be a written table, as it is read three times.
    """
    kind = F.col("response.type")
    responses = captures.filter(kind == "response")
    wanted = responses.select(
        F.col("capture").alias("wanted"),
        F.col("metadata.page_id").alias("refers_to"),
        F.col("response.payload_bytes").alias("full_bytes"),
    )
    revisits = captures.filter(kind == "revisit").withColumn("wanted", F.col("response.refers_to"))
    whole = responses.withColumns(
        {"refers_to": F.lit(None).cast("string"), "full_bytes": F.col("response.payload_bytes")}
    )
    return whole.unionByName(revisits.join(wanted, "wanted", "left").drop("wanted"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive every page, read the archives back, and tell what became of each page."""
    pages = table(spark, sf_dir, "pages")
    path = session.run_dir(spark, "archives")
    write_archives(pages, path, from_files=True)
    captures = session.materialise(assemble(read_records(spark, path)), "captures")
    kind = pages.schema["page_id"].dataType
    return resolve(captures).select(
        F.col("metadata.page_id").cast(kind).alias("page_id"),
        F.col("full_bytes").alias("payload_bytes"),
        F.col("response.digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS n FROM pages),
f AS (SELECT *, CASE WHEN n >= {REVISIT_BYTES} THEN max(page_id) OVER (PARTITION BY h) ELSE page_id END AS main FROM p)
SELECT page_id, n AS payload_bytes, sha1(h) AS payload_digest,
  CASE WHEN main = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN main <> page_id THEN main END AS refers_to
FROM f
"""

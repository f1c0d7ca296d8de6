"""WARC archives: written from pages by Spark, read back, and assembled into one nested row per capture.

A capture is a request, a response (or a revisit of an equal payload) and a
metadata record; request and metadata name the response by WARC-Concurrent-To.
Archives are written with Spark's text sink: a record ends in CR LF CR LF, of
which the sink adds the last LF. They are read whole, file by file, so a file
holds about ``FILE_BYTES`` of records.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_path
from .common import Run, col, table
from .urls import split_url

FILE_BYTES = 32 << 20
#: Payloads of fewer bytes are never revisited.
MIN_REVISIT = 100
DATE = "2000-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD = (
    "record_type string, record_id string, concurrent_to string, refers_to string, target_uri string, date string, "
    "content_type string, declared_digest string, payload_bytes long, payload_sha256 string, "
    "fields map<string,string>, payload binary"
)


def _uuid(*parts: Column) -> Column:
    """A record id made from the parts alone, so that a task that runs again writes the same id."""
    hexed = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]).cast("binary"))
    return F.regexp_replace(hexed, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>")


def _record(kind: Column | str, headers: list[Column | str], block: Column) -> Column:
    """Text of a record without its last LF; a null header is left out."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    head = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), kind),
        *[F.lit(h) if isinstance(h, str) else h for h in headers],
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    )
    return F.concat(head, F.lit("\r\n\r\n"), block, F.lit("\r\n\r"))


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value)


def write_archives(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = DATE
) -> None:
    """Write a request, a response or revisit, and a metadata record for every page to gzipped archives.

    Of pages with equal payloads of at least 100 bytes the one with the
    smallest id (null ids last) is the response, pages with other ids revisit
    it. Null html is an empty payload, a null url an empty one. CR and LF in a
    url are percent-encoded. Repeated rows are written as often as they occur;
    their records have the same ids. An empty table writes no record.
    """
    pick = pages.select(
        col(id_col).cast("string").alias("page"),
        col(id_col).alias("id"),
        F.replace(F.replace(F.coalesce(col(url_col), F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")).alias("url"),
        F.coalesce(col(html_col), F.lit("")).alias("payload"),
    ).select("*", F.octet_length("payload").alias("bytes"), F.sha2(F.col("payload").cast("binary"), 256).alias("digest"))
    size = pages.agg(F.sum(F.octet_length(col(html_col))), F.count(F.lit(1))).first()
    mean = 1500 + (size[0] or 0) / max(size[1], 1)
    # only payloads that occur twice: most pages need no partner
    first = (
        pick.where(F.col("bytes") >= MIN_REVISIT)
        .groupBy("digest")
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.min(F.struct(F.col("id").isNull().alias("last"), F.col("id"), F.col("url"))).alias("first"),
        )
        .where("copies > 1")
        .select("digest", F.col("first.id").alias("first_id"), F.col("first.url").alias("first_url"), F.lit(True).alias("shared"))
    )
    again = F.col("shared").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id"))
    own = _uuid(F.lit("response"), F.col("page"), F.col("url"), F.col("digest"))
    known = pick.join(first, "digest", "left").select(
        "*", again.alias("again"), own.alias("own"), *[p.alias(n) for p, n in zip(split_url(F.col("url")), ("host", "path"))]
    )
    target = _header("WARC-Target-URI", F.col("url"))
    common = [target, f"WARC-Date: {date}"]
    tied = _header("WARC-Concurrent-To", F.col("own"))
    request = _record(
        "request",
        [_header("WARC-Record-ID", _uuid(F.lit("request"), F.col("own"))), tied, *common, "Content-Type: application/http;msgtype=request"],
        F.concat(F.lit("GET "), F.when(F.col("path") != "", F.col("path")).otherwise("/"), F.lit(" HTTP/1.1\r\nHost: "), F.col("host"), F.lit("\r\n\r\n")),
    )
    refers = _uuid(F.lit("response"), F.col("first_id"), F.col("first_url"), F.col("digest"))
    response = _record(
        F.when(F.col("again"), "revisit").otherwise("response"),
        [
            _header("WARC-Record-ID", F.col("own")),
            *common,
            _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
            F.when(F.col("again"), F.lit(f"WARC-Profile: {_PROFILE}")),
            F.when(F.col("again"), _header("WARC-Refers-To", refers)),
            F.when(F.col("again"), _header("WARC-Refers-To-Target-URI", F.col("first_url"))),
            "Content-Type: application/http;msgtype=response",
        ],
        F.concat(
            F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
            F.col("bytes").cast("string"),
            F.lit("\r\n\r\n"),
            F.when(F.col("again"), "").otherwise(F.col("payload")),
        ),
    )
    metadata = _record(
        "metadata",
        [_header("WARC-Record-ID", _uuid(F.lit("metadata"), F.col("own"))), tied, *common, "Content-Type: application/warc-fields"],
        F.concat_ws("", F.concat(F.lit("page_id: "), F.col("page"), F.lit("\r\n")), F.lit("payload_bytes: "), F.col("bytes").cast("string"), F.lit("\r\n")),
    )
    (
        known.select(F.explode(F.array(request, response, metadata)).alias("value"))
        .write.option("compression", "gzip")
        .option("maxRecordsPerFile", max(3, int(3 * FILE_BYTES / mean)))
        .text(path)
    )


def parse_records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of every record of an archive."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record where one should begin: {line[:60]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        length = int(headers["content-length"])
        block = stream.read(length)
        if len(block) < length:
            raise ValueError("an archive ends inside a record")
        yield headers, block


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """A row for every record of the archives under a path, gzipped or not.

    ``payload`` is the block behind its HTTP header, null unless asked for;
    its length and SHA-256 are always computed from the whole payload. A
    response whose declared digest is not that of its payload fails.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")

    def run(batches):
        import pyarrow as pa

        def batch_of(rows):
            columns = list(zip(*rows)) if rows else [()] * 12
            kinds = [pa.string()] * 8 + [pa.int64(), pa.string(), pa.map_(pa.string(), pa.string()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for batch in batches:
            for content in batch.column(0):
                raw = content.as_py()
                plain = gzip.GzipFile(fileobj=io.BytesIO(raw)) if raw[:2] == b"\x1f\x8b" else io.BytesIO(raw)
                rows, held = [], 0
                for headers, block in parse_records(io.BufferedReader(plain, 1 << 20)):
                    kind, content_type = headers.get("warc-type"), headers.get("content-type", "")
                    payload = block.partition(b"\r\n\r\n")[2] if content_type.startswith("application/http") else block
                    fields = None
                    if content_type.startswith("application/warc-fields"):
                        parts = (x.partition(":") for x in block.decode("utf-8", "replace").split("\r\n") if x)
                        fields = [(name.strip(), value.strip()) for name, _, value in parts]
                    digest = hashlib.sha256(payload).hexdigest()
                    declared = headers.get("warc-payload-digest")
                    if kind == "response" and declared and declared.startswith("sha256:") and declared[7:] != digest:
                        raise ValueError(f"the payload of {headers.get('warc-record-id')} is damaged")
                    rows.append(
                        (kind, headers.get("warc-record-id"), headers.get("warc-concurrent-to"), headers.get("warc-refers-to"),
                         headers.get("warc-target-uri"), headers.get("warc-date"), content_type, declared,
                         len(payload), digest, fields, payload if payloads else None)
                    )
                    held += len(payload) if payloads else 200
                    if held > 8 << 20:
                        yield batch_of(rows)
                        rows, held = [], 0
                yield batch_of(rows)

    names = [part.split()[0] for part in _RECORD.split(", ")]
    return files.mapInArrow(run, _RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture_id, request, response, metadata``, joined through concurrent-to ids.

    ``response`` is the response or revisit record. A missing part is null;
    records that name no response of the archives make a row without one.
    Responses that occur several times under one id give as many rows, with
    the same parts. The parts are first values per capture, so repeats are
    combined before the shuffle.
    """
    main = F.col("record_type").isin("response", "revisit")
    part = F.struct(*[col(c) for c in records.columns])
    grouped = records.groupBy(F.when(main, F.col("record_id")).otherwise(F.coalesce("concurrent_to", "record_id")).alias("capture_id")).agg(
        F.first(F.when(F.col("record_type") == "request", part), ignorenulls=True).alias("request"),
        F.first(F.when(main, part), ignorenulls=True).alias("response"),
        F.first(F.when(F.col("record_type") == "metadata", part), ignorenulls=True).alias("metadata"),
        F.count_if(main).alias("copies"),
    )
    times = F.sequence(F.lit(1).cast("long"), F.greatest(F.col("copies"), F.lit(1).cast("long")))
    return grouped.select("*", F.explode(times).alias("copy")).drop("copies", "copy")


def digests(captures: DataFrame, id_type: str = "bigint") -> DataFrame:
    """Per capture: page_id, payload_bytes, payload_digest, record_type and refers_to, the page id of the revisited response."""
    flat = captures.select(
        F.try_element_at("metadata.fields", F.lit("page_id")).cast(id_type).alias("page_id"),
        F.when(F.col("response.record_type") == "response", F.col("response.payload_bytes"))
        .otherwise(F.try_element_at("metadata.fields", F.lit("payload_bytes")).cast("long"))
        .alias("payload_bytes"),
        F.when(F.col("response.record_type") == "response", F.col("response.payload_sha256"))
        .otherwise(F.regexp_replace("response.declared_digest", "^sha256:", ""))
        .alias("payload_digest"),
        F.col("response.record_type").alias("record_type"),
        "capture_id",
        F.col("response.refers_to").alias("target"),
    )
    responses = flat.where("record_type = 'response'").select(F.col("capture_id").alias("target"), F.col("page_id").alias("refers_to")).distinct()
    # a capture that revisits nothing gets a key of its own that no response has, so that these are dealt out evenly
    spread = flat.withColumn("target", F.coalesce("target", F.concat(F.lit("none "), "capture_id")))
    return spread.join(responses, "target", "left").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7(spark, folder):
    path = new_path(spark, "warc")
    write_archives(table(spark, folder, "pages"), path)
    return digests(assemble(read_records(spark, path, payloads=False)))


_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), d AS (
  SELECT page_id, octet_length(encode(html)) AS n, sha256(html) AS digest FROM p
), f AS (
  SELECT digest, min(page_id) AS first_id FROM d WHERE n >= 100 GROUP BY digest
)
SELECT page_id, n AS payload_bytes, d.digest AS payload_digest,
  CASE WHEN page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d LEFT JOIN f ON d.digest = f.digest
"""

QUERIES: dict[str, Run] = {"op7_warc": op7}
SQL: dict[str, str] = {"op7_warc": _SQL}

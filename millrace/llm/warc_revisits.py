"""WARC archives in which repeated payloads are revisit records.

Only headers are shuffled: id, length and digests of each payload meet by digest, the record with the largest id of a
long payload becomes the response and the others revisit it. Spark's text writer then writes the archives, one record
after the other with the record separator as line separator, so each file is a plain gzip-compressed WARC stream and a lost
executor only repeats its tasks. Reading back walks the records by Content-Length and joins revisit records to the
responses they refer to.

Edge cases: a null payload is empty; a null id is written as an empty id, loses against any other id and comes back
null. Among rows that repeat id and payload one is the response; equal ids are told apart by a record number, and each
row keeps its own URI. Control characters in a URI are percent-encoded, a null URI is left out. An empty table gives an empty archive. Columns other
than id, URI and payload are not read. As text, an id must be free of control characters.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm.scratch import Scratch, skew_aware

# Fixed values of the format.
VERSION = "WARC/1.1"
SEPARATOR = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MIN_BYTES = 1000
RECORDS_PER_FILE = 100_000
READ_BYTES = 1 << 20


def resolve_revisits(
    pages: DataFrame, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html", min_bytes: int = MIN_BYTES
) -> DataFrame:
    """The headers of every row: row, id, uri, bytes, sha1, sha256, record_type, refers_row, refers_to. Payloads stay where they are."""
    skew_aware(pages.sparkSession)
    body = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    headers = pages.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        F.col(uri_col).alias("uri"),
        F.octet_length(body).cast("long").alias("bytes"),
        F.sha1(body).alias("sha1"),
        F.sha2(body, 256).alias("sha256"),
    )
    scratch = Scratch(pages.sparkSession, "warc-headers")
    headers = scratch.keep(headers, "headers")
    same = ["sha1", "sha256"]
    first = (
        headers.where(F.col("bytes") >= min_bytes)
        .groupBy(*same)
        .agg(F.max(F.struct("id", "row")).alias("first"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .drop("copies")
    )
    first = scratch.keep(first, "first")  # the join then has a shuffle of its own, which Spark can split
    revisit = (F.col("row") != F.col("first.row")) & (F.col("bytes") >= min_bytes)
    return headers.join(first, same, "left").select(
        "row",
        "id",
        "uri",
        "bytes",
        *same,
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first.row")).alias("refers_row"),
        F.when(revisit, F.col("first.id")).alias("refers_to"),
    )


def _record_id(row, identity):
    return F.concat(F.lit("<urn:millrace:"), row.cast("string"), F.lit(":"), F.coalesce(identity.cast("string"), F.lit("")), F.lit(">"))


def write_archives(
    pages: DataFrame,
    path: str,
    date: str,
    id_col: str = "page_id",
    uri_col: str = "url",
    payload_col: str = "html",
    min_bytes: int = MIN_BYTES,
) -> None:
    """Writes the archives to ``path``; ``date`` is the WARC-Date of all records, as in 2024-06-01T00:00:00Z."""
    scratch = Scratch(pages.sparkSession, "warc-write")
    resolved = scratch.keep(resolve_revisits(pages, id_col, uri_col, payload_col, min_bytes), "resolved")
    # Rows find their headers by id, URI and digest; rows equal in all three differ in nothing but the number they get here.
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    source = pages.select(F.col(id_col).alias("id"), F.col(uri_col).alias("uri"), payload.alias("payload"))
    keyed = source.withColumn("sha256", F.sha2(F.col("payload").cast("binary"), 256))
    headers = resolved.select(
        F.col("id").alias("h_id"), F.col("uri").alias("h_uri"), F.col("sha256").alias("h_sha"), "row",
        (F.col("record_type") == "revisit").alias("revisits"), "refers_row", "refers_to", "sha1",
    )
    if not resolved.groupBy("id", "uri", "sha256").count().where("count > 1").isEmpty():
        # Of such rows one payload is read, and written once per header.
        keyed = keyed.dropDuplicates(["id", "uri", "sha256"])
    same = keyed["id"].eqNullSafe(headers["h_id"]) & keyed["uri"].eqNullSafe(headers["h_uri"]) & (keyed["sha256"] == headers["h_sha"])
    records = keyed.join(headers, same)
    uri = F.replace(F.replace(F.regexp_replace("uri", r"[\x00-\x09\x0B\x0C\x0E-\x1F\x7F]", "%20"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))

    def line(name, value):
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    record = F.concat(
        F.lit(f"{VERSION}\r\n"),
        line("WARC-Type", F.when(F.col("revisits"), "revisit").otherwise("response")),
        line("WARC-Record-ID", _record_id(F.col("row"), F.col("id"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", uri),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(
            F.col("revisits"),
            F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", _record_id(F.col("refers_row"), F.col("refers_to")))),
        ).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.when(F.col("revisits"), F.lit(0)).otherwise(F.octet_length("payload")).cast("string")),
        F.lit("\r\n"),
        F.when(F.col("revisits"), F.lit("")).otherwise(F.col("payload")),
    )
    records.select(record.alias("value")).write.option("lineSep", SEPARATOR).option("compression", "gzip").option(
        "maxRecordsPerFile", RECORDS_PER_FILE
    ).text(path)


def _chunks(content: bytes) -> Iterator[bytes]:
    """The decompressed stream, a bounded piece at a time."""
    stream = zlib.decompressobj(wbits=31)
    data = content
    while True:
        piece = stream.decompress(data, READ_BYTES)
        if piece:
            yield piece
        data = stream.unconsumed_tail
        if stream.eof and stream.unused_data:
            data, stream = stream.unused_data, zlib.decompressobj(wbits=31)
        elif not data:
            return


def _records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and payload of every record of an archive file."""
    held, chunks = bytearray(), _chunks(content)

    def until(n: int) -> None:
        while len(held) < n:
            held.extend(next(chunks))

    while True:
        while (end := held.find(b"\r\n\r\n")) < 0:
            if (piece := next(chunks, None)) is None:
                if held:
                    raise ValueError("the archive ends within a record")
                return
            held.extend(piece)
        first, *lines = held[:end].decode("utf-8", "replace").split("\r\n")
        if first != VERSION:
            raise ValueError(f"no record starts here: {first[:40]!r}")
        fields = dict(x.split(": ", 1) for x in lines)
        size = int(fields["Content-Length"])
        until(end + 4 + size + 4)
        payload = bytes(held[end + 4 : end + 4 + size])
        if held[end + 4 + size : end + 8 + size] != b"\r\n\r\n":
            raise ValueError("a record is longer than its Content-Length")
        del held[: end + 8 + size]
        yield fields, payload


RECORD_SCHEMA = "record_id string, id string, uri string, record_type string, digest string, refers_id string, payload binary"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives under ``path``, as written."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in RECORD_SCHEMA.split(", ")]
        types = [pa.string()] * 6 + [pa.binary()]
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for fields, payload in _records(content.as_buffer()):
                    record = fields["WARC-Record-ID"]
                    rows.append(
                        (record, record[1:-1].split(":", 3)[3] or None, fields.get("WARC-Target-URI"), fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields.get("WARC-Refers-To"), payload)
                    )
                    size += len(payload)
                    if size > 8 * READ_BYTES or len(rows) >= 4096:
                        yield _batch(rows, names, types)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows, names, types)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(walk, RECORD_SCHEMA)


def _batch(rows, names, types) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def read_archives(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """One row per record: id, uri, record_type, refers_to, payload_bytes, payload_digest, digest_matches.

    Length and digest are those of the payload itself; a revisit takes them from the response it refers to.
    """
    skew_aware(spark)
    measured = read_records(spark, path).select(
        "record_id",
        F.col("id").cast(id_type).alias("id"),
        "uri",
        "record_type",
        "digest",
        "refers_id",
        F.octet_length("payload").cast("long").alias("bytes"),
        F.sha1("payload").alias("sha1"),
    )
    measured = Scratch(spark, "warc-read").keep(measured, "records")
    responses = measured.where("record_type = 'response'")
    plain = responses.select(
        "id", "uri", "record_type", F.lit(None).cast(id_type).alias("refers_to"), F.col("bytes").alias("payload_bytes"), F.col("sha1").alias("payload_digest"), "digest"
    )
    target = responses.select(
        F.col("record_id").alias("refers_id"), F.col("id").alias("refers_to"), F.col("bytes").alias("payload_bytes"), F.col("sha1").alias("payload_digest")
    )
    resolved = (
        measured.where("record_type = 'revisit'")
        .select("id", "uri", "record_type", "digest", "refers_id")
        .join(target, "refers_id", "left")
        .select(*plain.columns)
    )
    return plain.unionByName(resolved).withColumn("digest_matches", F.col("digest") == F.col("payload_digest")).drop("digest")

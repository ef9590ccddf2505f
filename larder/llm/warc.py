"""Content-addressed WARC archive: payload bytes once by digest, exact record heads apart, records back by joins.

`payloads` holds each distinct payload once, under its SHA-256, in buckets of the digest. `heads` holds one row per
record: the exact bytes of its WARC header and HTTP header. `export` joins the two into records and writes plain WARC
files; `parse` reads such files, record after record by `Content-Length`; `reconstruct` gives a revisit the payload of the
record that it refers to.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from larder.sources.staging import settle

MIN_REVISIT_BYTES = 1000
CRLF = "\r\n"
STORE = "sha256 string, sha1 string, payload_bytes long, owner long, copies long, payload binary"
HEADS = "page_id long, sha256 string, payload_bytes long, record_type string, head binary"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _described(pages: DataFrame, key: str, url: str, body: str) -> DataFrame:
    payload = F.encode(F.coalesce(body, F.lit("")), "UTF-8")
    return pages.select(
        F.col(key).cast("long").alias("page_id"),
        F.col(url).alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha1(payload).alias("sha1"),
        F.sha2(payload, 256).alias("sha256"),
    )


def payload_store(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """Each distinct payload once: (sha256, sha1, payload_bytes, owner, copies, payload).

    `owner` is the largest page with the payload. A SHA-256 shared by different bytes stops the job, as the digest then
    wouldn't name one content. Copies are combined before the shuffle.
    """
    rows = _described(pages, key, url, body).groupBy("sha256").agg(
        F.min("sha1").alias("sha1"),
        F.min("payload_bytes").alias("payload_bytes"),
        F.max("page_id").alias("owner"),
        F.count("*").alias("copies"),
        F.min("payload").alias("payload"),
        F.max("payload").alias("other"),
    )
    checked = F.when(F.col("payload") == F.col("other"), F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("payloads differ under one digest: "), "sha256")))
    return rows.select("sha256", "sha1", "payload_bytes", "owner", "copies", checked.alias("payload"))


def _uuid(page: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.coalesce(page.cast("string"), F.lit("")), digest))
    parts = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """One header line; none for a null value. Line ends inside a value are percent-encoded."""
    clean = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit(CRLF)), F.lit(""))


def record_heads(pages: DataFrame, store: DataFrame, date: str, key: str = "page_id", url: str = "url", body: str = "html", min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """One row per page: (page_id, sha256, payload_bytes, record_type, head), `head` the exact bytes before the record's payload.

    Of pages with equal payloads of at least `min_bytes`, the largest is a response and the others revisit it. Rows
    that repeat the largest page are responses too. A null page_id is only then a response of a shared payload if no
    page with that payload has an id.
    """
    owners = store.select("sha256", "owner")
    rows = _described(pages, key, url, body).drop("payload").join(owners, "sha256")
    revisit = (F.col("payload_bytes") >= min_bytes) & F.coalesce(F.col("page_id") != F.col("owner"), F.col("owner").isNotNull())
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(CRLF * 2),
    )
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    warc = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _uuid(F.col("page_id"), F.col("sha256"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.coalesce("url", F.lit("urn:unknown"))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha1")),
        _line("WARC-Profile", F.when(revisit, PROFILE)),
        _line("WARC-Refers-To", F.when(revisit, _uuid(F.col("owner"), F.col("sha256")))),
        _line("X-Page-ID", F.col("page_id").cast("string")),
        _line("X-Refers-To-Page-ID", F.when(revisit, F.col("owner").cast("string"))),
        _line("Content-Type", F.lit("application/http;msgtype=response")),
        _line("Content-Length", length.cast("string")),
        F.lit(CRLF),
        http,
    )
    kind = F.when(revisit, "revisit").otherwise("response")
    return rows.select("page_id", "sha256", "payload_bytes", kind.alias("record_type"), F.encode(warc, "UTF-8").alias("head"))


def write(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", key: str = "page_id", url: str = "url", body: str = "html", min_bytes: int = MIN_REVISIT_BYTES) -> int:
    """Write the archive of `pages` to a new folder and return its number of buckets.

    Null bodies are empty payloads; other columns aren't read.
    """
    spark = pages.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = payload_store(pages, key, url, body).write.bucketBy(buckets, "sha256").sortBy("sha256")
    rows.format("parquet").option("path", f"{path}/payloads").option("compression", "zstd").saveAsTable(f"payloads_{uuid.uuid4().hex}")
    store = _store(spark, path)
    record_heads(pages, store, date, key, url, body, min_bytes).write.option("compression", "zstd").parquet(f"{path}/heads")
    return buckets


def _store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORE).parquet(f"{path}/payloads")


def _heads(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HEADS).parquet(f"{path}/heads")


def _bucketed(spark: SparkSession, path: str, buckets: int) -> DataFrame:
    """The payload store as a table whose buckets Spark knows, so that it isn't shuffled for a join on the digest."""
    name = f"payloads_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} ({STORE}) USING parquet CLUSTERED BY (sha256) SORTED BY (sha256) INTO {buckets} BUCKETS LOCATION '{path}/payloads'")
    return spark.table(name)


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: `head`, the full `payload` (that of the original for a revisit), `record_type`."""
    heads, store = _heads(spark, path), _store(spark, path)
    return heads.select("sha256", "record_type", "head").join(store.select("sha256", "payload"), "sha256")


def records(spark: SparkSession, path: str, buckets: int | None = None, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(record): the exact bytes of each record, its head and, but for a revisit, its payload.

    Payloads that can be revisited are in one record each, joined in the store's buckets, where their number is given.
    Smaller ones may be in very many records (the empty one); their join is one that Spark can split. The bound is that
    given to `write`.
    """
    heads, store = _heads(spark, path), _store(spark, path)
    responses = heads.where("record_type = 'response'")
    small = store.where(F.col("payload_bytes") < min_bytes).select("sha256", "payload")
    large = (_bucketed(spark, path, buckets) if buckets else store).where(F.col("payload_bytes") >= min_bytes).select("sha256", "payload")
    # a head's own row says how long its payload is, so that each meets one side only
    is_small = F.col("payload_bytes") < min_bytes
    whole = F.concat("head", "payload").alias("record")
    inner = responses.where(is_small).join(small, "sha256").select(whole)
    outer = responses.where(~is_small).join(large, "sha256").select(whole)
    return heads.where("record_type = 'revisit'").select(F.col("head").alias("record")).union(inner).union(outer)


def export(spark: SparkSession, path: str, out: str, compression: str | None = None, buckets: int | None = None, min_bytes: int = MIN_REVISIT_BYTES) -> None:
    """WARC files, one a partition: Spark's text writer ends each record with the two line ends it needs."""
    texts = records(spark, path, buckets, min_bytes).select(F.col("record").cast("string").alias("value"))
    texts.write.option("lineSep", CRLF * 2).option("compression", compression or "none").text(out)


RECORDS = StructType(
    [
        *(StructField(c, StringType()) for c in ("record_type", "record_id", "refers_to")),
        StructField("page_id", LongType()),
        *(StructField(c, StringType()) for c in ("uri", "digest")),
        *(StructField(c, BinaryType()) for c in ("head", "payload")),
    ]
)
BATCH_BYTES = 4 << 20


def records_of(content: bytes) -> Iterator[tuple]:
    """The columns of RECORDS for each record of a WARC file, gzipped or not; borders are as `Content-Length` says.

    A file that ends within a record, or a record that isn't followed by two line ends, is an error.
    """
    held, chunks = b"", _inflated(content)

    def fill(size: int) -> bool:
        nonlocal held
        parts, have = [held], len(held)
        for chunk in chunks if have < size else ():
            parts.append(chunk)
            have += len(chunk)
            if have >= size:
                break
        held = b"".join(parts)
        return have >= size

    while fill(1):
        end = held.find(b"\r\n\r\n")
        while end < 0:
            if not fill(len(held) + 1):
                raise ValueError("the file ends within a WARC header")
            end = held.find(b"\r\n\r\n")
        version, *lines = held[:end].decode().split(CRLF)
        if not version.startswith("WARC/"):
            raise ValueError(f"no WARC record begins with {version[:40]!r}")
        fields = {name.lower(): value for name, _, value in (line.partition(": ") for line in lines)}
        start, length = end + 4, int(fields["content-length"])
        if not fill(start + length + 4) or held[start + length : start + length + 4] != b"\r\n\r\n":
            raise ValueError("a WARC record is longer or shorter than its Content-Length")
        block = held[start : start + length]
        http, mark, payload = block.partition(b"\r\n\r\n")
        page = fields.get("x-page-id")
        yield (
            fields["warc-type"], fields["warc-record-id"], fields.get("warc-refers-to"), None if page is None else int(page),
            fields.get("warc-target-uri"), fields.get("warc-payload-digest"), held[:start] + http + mark, payload,
        )
        held = held[start + length + 4 :]


def _inflated(content: bytes) -> Iterator[bytes]:
    if content[:2] != b"\x1f\x8b":
        for at in range(0, len(content), BATCH_BYTES):
            yield content[at : at + BATCH_BYTES]
        return
    while content:
        stream = zlib.decompressobj(wbits=31)
        while not stream.eof and content:
            chunk = stream.decompress(content, BATCH_BYTES)
            content = stream.unconsumed_tail or stream.unused_data
            yield chunk
        if not stream.eof:
            raise ValueError("the file ends within a gzip member")


def parse(spark: SparkSession, files: str) -> DataFrame:
    """The records of all WARC files in a folder, as RECORDS: what they say of themselves, exact head bytes and payload."""
    kinds = [to_arrow_type(f.dataType) for f in RECORDS.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=RECORDS.fieldNames())

        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for row in records_of(content.as_py()):
                    rows.append(row)
                    size += len(row[-1]) + len(row[-2])
                    if size > BATCH_BYTES:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    return spark.read.format("binaryFile").load(files).select("content").mapInArrow(run, RECORDS)


def reconstruct(parsed: DataFrame) -> DataFrame:
    """The records with the full payload: revisits get that of the record they refer to, by a join on its id.

    A revisit whose original is not there keeps its own, empty payload. Rows that repeat an original are one for it.
    """
    originals = parsed.where("record_type = 'response'").groupBy("record_id").agg(F.min("payload").alias("original"))
    revisits = parsed.where("record_type = 'revisit'").join(originals.withColumnRenamed("record_id", "of"), F.col("refers_to") == F.col("of"), "left")
    full = revisits.select(*(F.coalesce("original", "payload").alias(c) if c == "payload" else F.col(c) for c in parsed.columns))
    return parsed.where("record_type <> 'revisit'").unionByName(full)


def described(parsed: DataFrame) -> DataFrame:
    """Per record of parsed files: page, length and SHA-1 of the full payload, type, and the page that a revisit refers to.

    Only lengths and digests are joined. The table of them is written first, so that files are parsed once.
    """
    brief = parsed.select(
        "record_type", "record_id", "refers_to", "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest")
    )
    brief = settle(brief, "warc_records")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    responses = brief.where("record_type = 'response'")
    originals = responses.select(F.col("record_id").alias("of"), F.col("page_id").alias("page"), F.col("payload_bytes").alias("n"), F.col("payload_digest").alias("d")).distinct()
    originals = settle(originals, "warc_originals")
    revisits = brief.where("record_type = 'revisit'").join(originals, F.col("refers_to") == F.col("of"), "left")
    full = revisits.select("page_id", F.coalesce("n", "payload_bytes"), F.coalesce("d", "payload_digest"), "record_type", F.col("page").alias("refers_to"))
    return responses.select(*columns, F.lit(None).cast("long").alias("refers_to")).union(full)


def _header(name: str) -> Column:
    """Value of a line of the WARC header, which ends at the first empty line; null if absent."""
    lines = F.substring_index(F.decode("head", "UTF-8"), CRLF * 2, 1)
    value = F.regexp_extract(lines, rf"(?m)^{name}: ([^\r\n]*)", 1)
    return F.nullif(value, F.lit(""))


def catalogue(records: DataFrame) -> DataFrame:
    """What the records say of themselves, with length and digest of the payload bytes read back."""
    return records.select(
        _header("X-Page-ID").cast("long").alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
        _header("WARC-Type").alias("record_type"),
        _header("X-Refers-To-Page-ID").cast("long").alias("refers_to"),
    )

"""Web archives with each payload stored once, addressed by its content.

An archive is a folder with two tables. ``payloads`` holds every distinct payload once, by its
SHA-256, with the length and SHA-1 it was filed under. ``records`` holds one row a record: the exact
bytes of its WARC header block and of its HTTP header, and the digest of the payload they belong to.
The first of the records with one payload (of the smallest page_id; a null comes last) is the
response, the others are revisits that refer to it. Reading back joins both tables; a payload whose
bytes no longer have the digests and the length they were filed under fails the job that reads it.

Defined cases: a null html is an empty payload, and an empty payload is a payload like any other (unless
``min_bytes`` says otherwise); a null url gives a record without a target URI. Rows that repeat, null
page_ids included, are records of their own: one of them is the response. Very long texts are whole
payloads. Columns of the caller's other than page_id, url and html are left out, whatever their names.
An empty table is an archive without records.

Hot payloads: rows are grouped by digest in two steps (Spark's partial aggregates), so a payload that
a third of all records share reaches the shuffle once a task; facts about it return to its records by
``looked_up``, which broadcasts those of at most ``HOT`` frequent keys and joins the rest.
"""

from __future__ import annotations

import gzip

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import looked_up
from tablewright.runtime import ship_package

BASE16, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
END = "\r\n"
#: Ends a WARC record, after its block.
RECORD_END = END + END
#: A line of a header block; only line feeds start a line, whatever a URL holds.
HEADER = r"(?md)^{}\r$"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base32: ten hexadecimal digits are eight digits to the base 32."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), BASE16, BASE32)


def payload_of(pages: DataFrame) -> Column:
    return F.coalesce(F.encode(F.col("html"), "UTF-8"), F.lit("").cast("binary"))


def record_uri(page_id: Column, number: Column) -> Column:
    """Names a record: its page, and a number that no other record of the archive has."""
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(":"), number.cast("string"), F.lit(">"))


def header_blocks(rows: DataFrame, date: str) -> DataFrame:
    """page_id, digest, record (header block) and http (header), both exact bytes as text."""
    revisit = F.col("number") != F.col("first.number")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=UTF-8{END}Content-Length: "), F.col("bytes").cast("string"), F.lit(END + END))
    block = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("bytes"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(END))
    header = F.concat(
        F.lit(f"WARC/1.1{END}"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", record_uri(F.col("page_id"), F.col("number"))),
        line("WARC-Date", F.lit(date)),
        # a target URI is one line, whatever the table holds
        F.when(F.col("url").isNotNull(), line("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]", ""))).otherwise(""),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", record_uri(F.col("first.page_id"), F.col("first.number"))))).otherwise(""),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", block.cast("string")),
        F.lit(END),
    )
    return rows.select("page_id", "digest", header.alias("record"), http.alias("http"))


def write_archive(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "2000-01-01T00:00:00Z") -> None:
    """An archive of ``pages`` (page_id, url, html) in the new folder ``path``.

    Payloads of fewer than ``min_bytes`` bytes are responses, all of them. Only digests, lengths and
    addresses are shuffled for the records; payloads move once, to the one copy that stays.
    """
    spark = pages.sparkSession
    payload = payload_of(pages)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.sha2(payload, 256).alias("digest"), base32_sha1(payload).alias("sha1"), F.octet_length(payload).cast("long").alias("bytes"))
    # stored, so that a record keeps its number whatever reads it again
    rows.withColumn("number", F.monotonically_increasing_id()).write.parquet(f"{path}/index")
    index = spark.read.parquet(f"{path}/index")
    own = F.struct("page_id", "number")
    order = F.struct(F.col("page_id").isNull().alias("none"), F.col("page_id").alias("page_id"), F.col("number").alias("number"))
    first = index.where(F.col("bytes") >= min_bytes).groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("n"))
    first = first.select("digest", F.struct("first.page_id", "first.number").alias("first"), "n")
    found = looked_up(index, first, "digest", "n").withColumn("first", F.coalesce("first", own))
    header_blocks(found, date).write.option("compression", "zstd").parquet(f"{path}/records")
    # by both digests and the length: payloads that share one digest only would be two
    once = pages.select(F.sha2(payload, 256).alias("digest"), base32_sha1(payload).alias("sha1"), payload.alias("payload")).groupBy("digest", "sha1", F.octet_length("payload").cast("long").alias("bytes")).agg(F.first("payload").alias("payload"))
    once.write.option("compression", "zstd").parquet(f"{path}/payloads")


def payloads(spark: SparkSession, path: str) -> DataFrame:
    """digest, sha1, bytes, payload; each payload is held against what it was filed under."""
    stored = spark.read.parquet(f"{path}/payloads")
    sound = (F.sha2("payload", 256) == F.col("digest")) & (base32_sha1(F.col("payload")) == F.col("sha1")) & (F.octet_length("payload") == F.col("bytes"))
    return stored.select("digest", "sha1", "bytes", F.when(sound, F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), "digest")).cast("binary")).alias("payload"))


def fields_of(records: DataFrame) -> DataFrame:
    """The records' rows with what their header blocks say: record_type, page_id, refers_to,
    payload_digest."""
    said = lambda pattern: F.regexp_extract("record", HEADER.format(pattern), 1)
    page = lambda name: F.nullif(said(f"{name}: <urn:x-page:(-?[0-9]*):[0-9]+>"), F.lit("")).cast("long")
    return records.select(
        page("WARC-Record-ID").alias("page_id"),
        said("WARC-Type: ([a-z]+)").alias("record_type"),
        page("WARC-Refers-To").alias("refers_to"),
        said("WARC-Payload-Digest: sha1:([A-Z2-7]{32})").alias("payload_digest"),
        *(c for c in records.columns if c != "page_id"),
    )


def page_summary(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, from the archive's bytes.

    The payloads' sizes and digests are computed from the payloads as read; a record whose header
    names another digest fails the job.
    """
    read = payloads(spark, path).select("digest", F.octet_length("payload").cast("long").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("computed"))
    records = fields_of(spark.read.parquet(f"{path}/records"))
    uses = records.groupBy("digest").agg(F.count("*").alias("n"))
    both = looked_up(records, read.join(uses, "digest"), "digest", "n")
    digest = F.when(F.col("payload_digest") == F.col("computed"), F.col("computed")).otherwise(F.raise_error(F.concat(F.lit("record with another digest than its payload: "), "digest")))
    return both.select("page_id", "payload_bytes", digest.alias("payload_digest"), "record_type", "refers_to")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """page_id, record_type, content: every record's exact bytes, as a WARC file holds them. Only
    responses carry their payload, and (but for those below min_bytes) each payload has one, so the
    join has no hot key."""
    records = fields_of(spark.read.parquet(f"{path}/records"))
    head = F.encode(F.concat("record", "http"), "UTF-8")
    responses = records.where("record_type = 'response'").join(payloads(spark, path).select("digest", "payload"), "digest")
    revisits = records.where("record_type <> 'response'")
    return responses.select("page_id", "record_type", F.concat(head, "payload").alias("content")).unionAll(revisits.select("page_id", "record_type", head.alias("content")))


def original_pages(spark: SparkSession, path: str) -> DataFrame:
    """page_id, url and payload of every record, revisits too. The join repeats a payload for each
    of its records; AQE splits the partition of a hot one."""
    url = F.nullif(F.regexp_extract("record", HEADER.format("WARC-Target-URI: ([^\r\n]*)"), 1), F.lit(""))
    return fields_of(spark.read.parquet(f"{path}/records")).join(payloads(spark, path).select("digest", "payload"), "digest").select("page_id", url.alias("url"), "payload")


def export_warc(spark: SparkSession, path: str, out: str) -> None:
    """The archive as WARC files in the folder ``out``, of the size AQE gives partitions. The text
    writer puts down a string's bytes as they are, and the end of a record takes a line end's place."""
    content = read_records(spark, path).select(F.col("content").cast("string").alias("value"))
    content.hint("rebalance").write.option("lineSep", RECORD_END).text(out)


def read_warc(spark: SparkSession, where: str) -> DataFrame:
    """uri, record_type, refers_to, url, payload_digest, payload of the records of WARC files, by
    their lengths; also of files in which each record, or the whole, is a gzip member. A file is
    read by one task, so it should keep to the usual gigabyte; Spark refuses files of over two.
    Payload is null where the record is a revisit."""
    ship_package(spark)

    def parsed(batches):
        for batch in batches:
            for content in batch.column("content"):
                found = list(parse_warc(content.as_buffer().to_pybytes()))
                for start in range(0, len(found), 64):
                    part = found[start : start + 64]
                    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in part], t) for i, t in enumerate((*[pa.string()] * 5, pa.binary()))], names=WARC_COLUMNS)

    schema = ", ".join(f"{c} {'binary' if c == 'payload' else 'string'}" for c in WARC_COLUMNS)
    return spark.read.format("binaryFile").load(where).select("content").mapInArrow(parsed, schema)


WARC_COLUMNS = ["uri", "record_type", "refers_to", "url", "payload_digest", "payload"]


def parse_warc(content: bytes):
    """The records of one file's bytes, as tuples of WARC_COLUMNS."""
    if content[:2] == b"\x1f\x8b":
        content = gzip.decompress(content)  # all members, one after another
    at = 0
    while at < len(content):
        body = content.index(b"\r\n\r\n", at) + 4
        lines = content[at:body].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        said = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}
        end = body + int(said["content-length"])
        block = content[body:end]
        payload = None
        if said["warc-type"] == "response":
            payload = block[block.index(b"\r\n\r\n") + 4 :] if said.get("content-type", "").startswith("application/http") else block
        yield said.get("warc-record-id"), said["warc-type"], said.get("warc-refers-to"), said.get("warc-target-uri"), said.get("warc-payload-digest"), payload
        at = end
        while content[at : at + 2] == b"\r\n":
            at += 2

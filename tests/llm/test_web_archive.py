import base64
import gzip
import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tablewright.llm import web_archive

PAGES = [
    (5, "http://a", "<p>é</p>"), (3, "http://b", "<p>é</p>"), (9, None, None), (2, "http://c", ""), (7, "http://d\r\nX: y\u2028WARC-Type: none", "x" * 300_000),
    (None, "http://e", "<p>é</p>"), (None, "http://f", "only null"), (None, "http://f", "only null"), (11, "u", "WARC/1.1\r\n\r\nHTTP\r\n\r\n"), (11, "u", "WARC/1.1\r\n\r\nHTTP\r\n\r\n"), (-4, "n", "\u0000 <b>"),
]


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('warc')}/a"
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "'x' AS digest", "'y' AS n", "'z' AS first", "1 AS number", "2 AS bytes", "3 AS record").repartition(3)
    web_archive.write_archive(pages, path)
    return path


def test_summary(spark, archive):
    got = Counter(map(tuple, web_archive.page_summary(spark, archive).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()))
    want = Counter()
    groups = {}
    for i, _, html in PAGES:
        groups.setdefault(html or "", []).append(i)
    for html, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i or 0))
        for k, i in enumerate(ids):
            want[(i, len(html.encode()), sha(html), "revisit" if k else "response", ids[0] if k else None)] += 1
    assert got == want
    assert spark.read.parquet(f"{archive}/payloads").count() == len(groups)


def test_records_are_exact(spark, archive):
    contents = [bytes(r.content) for r in web_archive.read_records(spark, archive).collect()]
    read = [r for c in contents for r in web_archive.parse_warc(c + b"\r\n\r\n")]
    assert len(read) == len(PAGES) and len({r[0] for r in read}) == len(PAGES)
    by = {r[0]: r for r in read}
    for uri, kind, refers, url, digest, payload in read:
        assert kind == ("response" if refers is None else "revisit") and "\r" not in (url or "")
        assert digest == "sha1:" + sha((payload if payload is not None else by[refers][5]).decode())
    whole = Counter((r.page_id, bytes(r.payload)) for r in web_archive.original_pages(spark, archive).collect())
    assert whole == Counter((i, (h or "").encode()) for i, _, h in PAGES)


def test_files_round_trip(spark, archive, tmp_path):
    web_archive.export_warc(spark, archive, f"{tmp_path}/out")
    want = Counter(r for c in web_archive.read_records(spark, archive).collect() for r in web_archive.parse_warc(bytes(c.content)))
    read = lambda where: Counter((*r[:5], None if r.payload is None else bytes(r.payload)) for r in web_archive.read_warc(spark, where).collect())
    assert read(f"{tmp_path}/out/part-*") == want
    (tmp_path / "gz").mkdir()
    with open(tmp_path / "gz" / "a.warc.gz", "wb") as f:  # a member for each record
        for c in web_archive.read_records(spark, archive).collect():
            f.write(gzip.compress(bytes(c.content) + b"\r\n\r\n"))
    assert read(f"{tmp_path}/gz") == want
    with pytest.raises(ValueError):
        list(web_archive.parse_warc(b"nonsense\r\n\r\n"))


def test_small_payloads_and_empty_tables(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    web_archive.write_archive(pages, f"{tmp_path}/a", min_bytes=10)
    types = {(r.page_id, r.payload_bytes): r.record_type for r in web_archive.page_summary(spark, f"{tmp_path}/a").collect()}
    assert types[2, 0] == types[9, 0] == types[5, 9] == types[3, 9] == "response"
    assert len([r for r in web_archive.read_records(spark, f"{tmp_path}/a").collect() if r.record_type == "response"]) == len(PAGES) - 1
    web_archive.write_archive(pages.limit(0), f"{tmp_path}/b")
    assert web_archive.page_summary(spark, f"{tmp_path}/b").count() == web_archive.read_records(spark, f"{tmp_path}/b").count() == 0


def test_damage_is_found(spark, archive, tmp_path):
    stored = spark.read.parquet(f"{archive}/payloads")
    for name, bad in (("x", F.concat("payload", F.lit("!").cast("binary"))), ("y", F.lit("other").cast("binary"))):
        stored.withColumn("payload", bad).write.parquet(f"{tmp_path}/{name}/payloads")
        spark.read.parquet(f"{archive}/records").write.parquet(f"{tmp_path}/{name}/records")
        with pytest.raises(Exception, match="damaged payload"):
            web_archive.page_summary(spark, f"{tmp_path}/{name}").collect()


def test_hot_payload_is_broadcast(spark, tmp_path, monkeypatch):
    """With a low bound on hot keys the same rows come out, whichever way each key goes."""
    from tablewright.llm import common

    pages = spark.range(600).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 200).cast("string")).alias("html"))
    found = []
    for hot in (2, 10_000):
        monkeypatch.setattr(common, "HOT", hot)
        web_archive.write_archive(pages, f"{tmp_path}/{hot}")
        found.append(sorted(map(str, web_archive.page_summary(spark, f"{tmp_path}/{hot}").collect())))
    assert found[0] == found[1] and len(found[0]) == 600

"""WARC archives: exact round trip, revisits, assembly."""

import base64
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from pricefold.llm import warc


def pages(seed, n=60):
    rnd = random.Random(seed)
    bodies = ["<p>Über 日本</p>", "", "x", "line\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n", "y" * 5000, "\x00\x01", "🙂" * 20]
    rows = [(i * 2, rnd.choice(["http://a.b/c d?e=f#g", "https://h/", None, "odd\nurl", ""]),
             rnd.choice(bodies) if rnd.random() < 0.6 else f"<html>{i}</html>" * rnd.randint(1, 99)) for i in range(n)]
    return rows + [(1001, "http://z", None)]


def base32(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


@pytest.mark.parametrize("least,file_bytes", [(0, 16 << 20), (0, 500), (10, 2000), (10**9, 2000)])
def test_round_trip_and_revisits(spark, least, file_bytes):
    rows = pages(least % 97 + file_bytes)
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("sha", F.lit(1)).repartition(4)
    files = warc.write_warc(df, least, file_bytes=file_bytes)
    assert sum(r.captures for r in files.collect()) == len(rows)
    found = warc.captures(warc.read_warc(files)).withColumn("page_id", warc.metadata_field("page-id")).withColumn(
        "refers_to", warc.metadata_field("refers-to-page")).collect()
    got = {r.page_id: r for r in found}
    assert len(found) == len(got) == len(rows)
    top = {}
    for i, _, html in rows:
        top[html or ""] = max(top.get(html or "", -1), i)
    for i, url, html in rows:
        r, payload = got[i], (html or "").encode()
        again = len(payload) >= least and top[html or ""] != i
        assert r.response.warc_type == ("revisit" if again else "response")
        assert r.refers_to == (top[html or ""] if again else None)
        assert (r.response.payload_bytes, r.response.payload_digest) == (len(payload), base32(html))
        assert r.request.warc_type == "request" and r.metadata.warc_type == "metadata"
        if not again:
            assert bytes(r.response.block).partition(b"\r\n\r\n")[2] == payload and r.response.digest_ok


def test_ties_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(None, "u", "same"), (5, "u", "same"), (5, "u", "same"), (3, "u", "same"), (None, "v", "alone"),
                                (None, "v", "alone")], "page_id long, url string, html string")
    found = warc.captures(warc.read_warc(warc.write_warc(df), payloads=False))
    got = sorted(((r.i, r.response.warc_type, r.to) for r in found.select(
        "response", warc.metadata_field("page-id").alias("i"), warc.metadata_field("refers-to-page").alias("to")).collect()), key=repr)
    assert got == sorted([(None, "revisit", 5), (5, "response", None), (5, "response", None), (3, "revisit", 5),
                          (None, "response", None), (None, "response", None)], key=repr)
    assert warc.captures(warc.read_warc(warc.write_warc(df.limit(0)))).count() == 0


def test_assembly_of_incomplete_and_repeated_records(spark):
    rec = lambda i, kind, to=None: (i, kind, to, "u", "d", None, None, None, bytearray(i.encode()))
    rows = [rec("r1", "response"), rec("q1", "request", "r1"), rec("m1", "metadata", "r1"), rec("m2", "metadata", "r1"),
            rec("r2", "revisit"), rec("q9", "request", "gone"), rec("m9", "metadata")]
    got = {r.record_id: r for r in warc.captures(spark.createDataFrame(rows, warc.RECORD)).collect()}
    assert set(got) == {"r1", "r2"}
    assert got["r1"].request.record_id == "q1" and got["r1"].metadata.record_id == "m2"
    assert got["r2"].request is None and got["r2"].metadata is None


def test_a_wrong_digest_is_told(spark, tmp):
    good = b"".join(warc.capture_records(1, "http://a/", b"payload", None, False, "2000-01-01T00:00:00Z"))
    import gzip
    raw = gzip.decompress(good).replace(b"payload\r\n", b"paylond\r\n")
    with gzip.open(f"{tmp}/x.warc.gz", "wb") as f:
        f.write(raw)
    files = spark.createDataFrame([(f"{tmp}/x.warc.gz",)], "path string")
    got = {r.warc_type: r.digest_ok for r in warc.read_warc(files).collect()}
    assert got == {"response": False, "request": None, "metadata": None}


def test_broken_archives_give_rejects_and_the_rest(spark, tmp):
    """Cut-off, corrupt and foreign bytes: what is whole is read, the rest is told."""
    one = lambda i: b"".join(warc.capture_records(i, "http://a/", b"payload %d" % i, None, False, "2000-01-01T00:00:00Z"))
    import gzip
    bad = gzip.compress(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: many\r\n\r\nxyz\r\n\r\n")
    short = gzip.compress(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 900\r\n\r\nxyz")
    broken = bytearray(one(3))
    broken[40:60] = bytes(20)  # within the first member
    files = {"cut": one(1) + one(2)[:-30], "length": one(4) + bad + one(5), "short": short + one(6), "broken": bytes(broken) + one(7),
             "foreign": b"no gzip at all", "empty": b"", "good": one(8)}
    for name, raw in files.items():
        with open(f"{tmp}/{name}", "wb") as f:
            f.write(raw)
    records = warc.read_warc(spark.createDataFrame([(f"{tmp}/{n}",) for n in files], "path string"))
    got = sorted(r.i for r in warc.captures(records).select(warc.metadata_field("page-id").alias("i")).collect() if r.i is not None)
    assert got == [1, 4, 5, 6, 7, 8]
    told = {(r.path.rsplit("/", 1)[1], r.reason) for r in warc.rejects(records).collect()}
    assert {("cut", "gzip member"), ("length", "content length"), ("short", "truncated record"), ("broken", "gzip member"),
            ("foreign", "gzip member")} <= told and not {n for n, _ in told} & {"good", "empty"}
    assert warc.captures(records).where("response.warc_type = 'response'").count() >= 7  # page 2's response is whole


def test_a_payload_above_a_megabyte_and_one_reading(spark):
    body = "Ü" * 1_500_000
    df = spark.createDataFrame([(1, "u", body), (2, "u", body), (3, "u", "x")], "page_id long, url string, html string")
    found = warc.captures(warc.read_warc(warc.write_warc(df)))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Join" not in plan
    got = {r.i: (r.response.warc_type, r.response.payload_bytes) for r in found.select("response", warc.metadata_field("page-id").alias("i")).collect()}
    assert got == {1: ("revisit", 3_000_000), 2: ("response", 3_000_000), 3: ("response", 1)}

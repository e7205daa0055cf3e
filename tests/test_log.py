"""The offset-addressed log: ranges, starts, restarts, retention."""

import os

import pytest
from pyspark.sql import functions as F

from pricefold.sources import log as L


def messages(spark, a, b):
    """Messages a..b-1 over three partitions; partition 2 has few."""
    part = F.when(F.col("id") % 10 == 0, 2).otherwise(F.col("id") % 2)
    return spark.range(a, b).select(part.alias("partition"), F.col("id").cast("string").cast("binary").alias("key"),
                                    F.concat(F.lit("v"), F.col("id")).cast("binary").alias("value"),
                                    F.timestamp_millis(F.col("id")).alias("timestamp"))


def numbers(n, upto):
    return [i for i in range(upto) if (2 if i % 10 == 0 else i % 2) == n]


def got(df):
    out = {}
    for r in df.select("partition", "offset", F.col("value").cast("string").alias("v")).orderBy("partition", "offset").collect():
        out.setdefault(r.partition, []).append((r.offset, int(r.v[1:])))
    return out


def want(ranges, upto):
    return {p: [(o, numbers(p, upto)[o]) for o in range(a, b)] for p, (a, b) in ranges.items() if b > a}


def test_ranges(spark, tmp):
    path = f"{tmp}/odds"
    L.append_log(messages(spark, 0, 100), path, segment_rows=7)
    L.append_log(messages(spark, 100, 140), path, segment_rows=7)
    sizes = {p: len(numbers(p, 140)) for p in range(3)}
    assert L.log_ends(path) == sizes
    assert got(L.log_batch(spark, path)) == want({p: (0, n) for p, n in sizes.items()}, 140)
    assert got(L.log_batch(spark, path, {0: 5, 1: 20}, {0: 33, 1: 20})) == want({0: (5, 33), 1: (20, 20), 2: (0, sizes[2])}, 140)
    assert got(L.log_batch(spark, path, "latest")) == {}
    first = L.log_batch(spark, path).first()
    assert first.topic == "odds" and first.timestamp is not None
    assert L.log_batch(spark, f"{tmp}/none").count() == 0


def test_lost_offsets_fail_unless_allowed(spark, tmp):
    path = f"{tmp}/odds"
    L.append_log(messages(spark, 0, 100), path, segment_rows=10)
    os.rename(f"{path}/partition=0/base=0", f"{tmp}/gone")  # as retention would
    with pytest.raises(Exception, match="partition 0: offsets 0 to 50 asked for|partition 0: offsets 0 to"):
        L.log_batch(spark, path, {0: 0}).collect()
    left = got(L.log_batch(spark, path, {0: 0}, fail_on_data_loss=False))
    n = len(numbers(0, 100))
    assert left == want({0: (10, n), 1: (0, len(numbers(1, 100))), 2: (0, 10)}, 100)
    with pytest.raises(Exception, match="asked for"):
        L.log_batch(spark, path, end={1: 1000}).collect()


def test_uncommitted_segment_leaves_a_gap(spark, tmp):
    path = f"{tmp}/odds"
    L.append_log(messages(spark, 0, 100), path, segment_rows=10)
    os.rename(f"{path}/partition=1/base=20", f"{tmp}/later")
    assert L.log_ends(path)[1] == 20
    os.rename(f"{tmp}/later", f"{path}/partition=1/base=20")
    assert L.log_ends(path)[1] == len(numbers(1, 100))


def run(df, tmp, name):
    q = (df.writeStream.format("parquet").option("checkpointLocation", f"{tmp}/{name}-ckpt").option("path", f"{tmp}/{name}")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


@pytest.mark.parametrize("starting", ["earliest", "latest", {0: 40}])
def test_stream_resumes_after_restart(spark, tmp, starting):
    path = f"{tmp}/odds"
    L.append_log(messages(spark, 0, 100), path, segment_rows=16)
    sizes = {p: len(numbers(p, 100)) for p in range(3)}
    run(L.log_stream(spark, path, starting), tmp, "out")
    begin = {"earliest": dict.fromkeys(range(3), 0), "latest": sizes}.get(starting if isinstance(starting, str) else "", {0: 40, 1: 0, 2: 0})
    if any(begin[p] < sizes[p] for p in sizes):
        assert got(spark.read.parquet(f"{tmp}/out")) == want({p: (begin[p], sizes[p]) for p in sizes}, 100)
    L.append_log(messages(spark, 100, 130), path, segment_rows=16)
    run(L.log_stream(spark, path, "earliest"), tmp, "out")  # the checkpoint decides
    after = {p: len(numbers(p, 130)) for p in range(3)}
    assert got(spark.read.parquet(f"{tmp}/out")) == want({p: (begin[p], after[p]) for p in sizes}, 130)

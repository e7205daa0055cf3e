"""Chunked running aggregates equal plain running windows."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from pricefold.operators.scan import running


def test_running_matches_plain_windows(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice(["k1", "k2", "hot"]) if i % 3 else "hot", i, rnd.randint(0, 50),
             None if rnd.random() < 0.3 else float(rnd.randint(0, 9))) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, t long, x long, y double")
    for inclusive in (True, False):
        end = 0 if inclusive else -1
        w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, end)
        ref = df.select("k", "t", F.max("x").over(w).alias("mx"), F.sum("x").over(w).alias("sx"),
                        F.last("y", ignorenulls=True).over(w).alias("ly"))
        for width in (1, 7, 64, 10_000):
            got = running(df, ["k"], "t", "x", "max", "mx", width, inclusive)
            got = running(got, ["k"], "t", "x", "sum", "sx", width, inclusive)
            got = running(got, ["k"], "t", "y", "last", "ly", width, inclusive)
            a = sorted(tuple(r) for r in got.select("k", "t", "mx", "sx", "ly").collect())
            b = sorted(tuple(r) for r in ref.collect())
            assert a == b, (inclusive, width)


def test_running_keeps_null_keys(spark):
    rows = [(None, 1, 5), (None, 2, 7), ("a", 1, 1), ("a", 9, 2), (None, 90, 1)]
    df = spark.createDataFrame(rows, "k string, t long, x long")
    got = sorted(map(tuple, running(df, ["k"], "t", "x", "sum", "s", 8).select("t", "x", "s").collect()))
    assert got == [(1, 1, 1), (1, 5, 5), (2, 7, 12), (9, 2, 3), (90, 1, 13)]


def test_timeline_chunking_is_exact(spark):
    from conftest import odds_rows
    from pricefold.operators import timeline as TL
    from test_stream import triggers
    rows = [r for t in triggers() for r in t]
    df = odds_rows(spark, rows)
    base = sorted(tuple(r) for r in TL.arbitrage_timeline(df).collect())
    for width in (1, 3):
        assert sorted(tuple(r) for r in TL.arbitrage_timeline(df, chunk=width).collect()) == base

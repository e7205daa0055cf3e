"""Detection with one shuffle of compressed blocks."""

import random

import pytest
from conftest import odds_rows

from pricefold.operators import detect as D
from pricefold.operators.packed import packed_best_prices


def updates(n=3000):
    rnd, inf = random.Random(8), float("inf")
    out = [("hot" if i % 4 == 0 else f"m{rnd.randint(0, 90)}\u00e9", rnd.choice("ABC\u00c4"), rnd.choice([1.5, 3.0, 7.0, inf]),
            rnd.choice([3.0, 8.0]), rnd.choice([2.0, 9.0]), rnd.randint(1, 9), rnd.randint(1, 50)) for i in range(n)]
    return out + [("a", "A", 2.0, 2.0, 9.0, 1, 1), ("a\0", "B", 9.0, 9.0, 2.0, 1, 1), (None, "A", 9.0, 9.0, 9.0, 1, 1),
                  ("m1", "Z", float("nan"), 9.0, 9.0, 99, 99), ("m1", "Z", 0.5, 9.0, 9.0, 99, 99), ("m1", "Z", 9.0, 9.0, 9.0, None, 99)]


def test_packed_strategy_agrees(spark):
    df = odds_rows(spark, updates()).repartition(5)
    want, got = D.detect_snapshot(df, now_ms=0), D.detect_snapshot(df, now_ms=0, strategy="packed")
    assert got.columns == want.columns and [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count() > 20


@pytest.mark.parametrize("buckets, rows", [(1, 100), (7, 10), (2048, 1 << 20)])
def test_best_prices_do_not_depend_on_blocks(spark, buckets, rows):
    valid = D.valid_odds(odds_rows(spark, updates(800))).select(*D.DETECT_COLUMNS)
    want = D.best_prices(D.latest_odds(valid))
    got = packed_best_prices(valid.repartition(3), buckets, rows).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_no_rows(spark):
    assert D.detect_snapshot(odds_rows(spark, []), now_ms=0, strategy="packed").count() == 0


def test_scaling_query_ships_blocks(spark):
    from pricefold.plans.registry import QUERIES
    plan = QUERIES["detect_snapshot_li_x10"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Exchange hashpartitioning(bucket" in plan

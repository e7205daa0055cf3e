"""Physical plans: no Python on the batch path, expected exchanges, pruned scans."""

from pricefold.operators import detect as D
from pricefold.sources import views as V

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_snapshot_plan_is_jvm_only_with_two_exchanges(spark):
    p = plan(D.detect_snapshot(V.odds_li(spark, SF), now_ms=0))
    assert "Python" not in p and "ArrowEval" not in p and "MapInPandas" not in p
    assert p.count("Exchange hashpartitioning") == 2, p


def test_colocated_strategy_has_one_exchange(spark):
    p = plan(D.detect_snapshot(V.odds_li(spark, SF), now_ms=0, strategy="colocated"))
    assert p.count("Exchange hashpartitioning") == 1, p


def test_scan_reads_only_needed_columns(spark):
    df = D.detect_snapshot(V.odds_li(spark, SF), now_ms=0)
    p = df._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in p.splitlines() if "FileScan parquet" in line or "ReadSchema" in line]
    text = " ".join(scan)
    assert "l_extendedprice" not in text and "l_returnflag" not in text
    assert "l_quantity" in text


def test_building_a_query_runs_no_job(spark):
    """Batch queries over a shuffled input only plan: no job before an action."""
    from pricefold.operators import report as R
    from pricefold.operators import timeline as TL
    from pricefold.sources import views as V
    odds = V.odds_ev(spark, SF).dropDuplicates()
    metrics, opps = V.run_metrics(spark, SF), V.run_opps(spark, SF)
    sc = spark.sparkContext
    sc.setJobGroup("building", "plans only")
    try:
        built = [D.detect_snapshot(V.replicate(odds, 10)), D.detect_window(odds, 1000), D.price_maps(odds),
                 TL.emit_on_change(TL.arbitrage_timeline(odds)), R.run_summary(metrics, opps), R.latency_cdf(opps),
                 R.box_stats(metrics), R.replay_schedule(odds, 60.0)]
        assert len(built) == 8 and not sc.statusTracker().getJobIdsForGroup("building")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_hot_run_and_hot_value_spread_over_tasks(spark):
    """One run, one latency value: the CDF's rows come from many tasks."""
    from pyspark.sql import functions as F
    from pricefold.operators import report as R
    opps = spark.range(400_000).select(F.lit("t").alias("tag"), F.lit("m").alias("method"), F.lit(5).cast("long").alias("e2e_latency_ms"))
    aqe = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        per_task = R.latency_cdf(opps).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", aqe)
    assert sum(r["count"] for r in per_task) == 400_000 and len(per_task) > 2
    assert max(r["count"] for r in per_task) < 300_000


def test_latest_uses_partial_window_group_limit(spark):
    p = plan(D.detect_snapshot(V.odds_li(spark, SF), now_ms=0))
    assert "WindowGroupLimit" in p and "Partial" in p, p

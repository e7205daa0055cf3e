"""Writers: summaries without NaN text, tagged results with partition pruning, run config."""

import json
import os

from pyspark.sql import functions as F

from pricefold import sinks
from pricefold.session import checkpoint_dir, run_dir


def test_write_summary_turns_nan_into_null(spark, tmp):
    df = spark.createDataFrame([("fast", "batch", float("nan"), 1.5)], "tag string, label string, a double, b double")
    sinks.write_summary(df, f"{tmp}/summary")
    assert os.path.isdir(f"{tmp}/summary/tag=fast")
    text = "".join(open(os.path.join(r, f)).read() for r, _, fs in os.walk(f"{tmp}/summary") for f in fs
                   if f.endswith(".json"))
    assert "NaN" not in text and '"b":1.5' in text


def test_tag_results_and_pruned_read(spark, tmp):
    opps = spark.createDataFrame([("m1", 0.1)], "match_id string, profit_margin double")
    sinks.tag_results({"batch_opps": opps}, "fast", tmp)
    sinks.tag_results({"batch_opps": opps.withColumn("profit_margin", F.lit(0.2))}, "slow", tmp)
    back = spark.read.parquet(f"{tmp}/batch_opps").where("tag = 'slow'")
    assert [r.profit_margin for r in back.collect()] == [0.2]
    assert "PartitionFilters: [isnotnull(tag" in back._jdf.queryExecution().executedPlan().toString()


def test_run_config_and_comparison(spark, tmp):
    sinks.write_run_config(spark, {"events": 10000, "window_s": 10}, "fast", f"{tmp}/config")
    row = spark.read.json(f"{tmp}/config").collect()[0]
    assert row.tag == "fast" and json.loads(row.config) == {"events": 10000, "window_s": 10}
    sinks.write_comparison(spark.createDataFrame([("fast", "batch", 1.0)], "tag string, label string, x double"),
                           f"{tmp}/cmp")
    assert spark.read.option("header", True).csv(f"{tmp}/cmp").columns == ["tag", "label", "x"]


def test_run_dirs_are_fresh_under_checkpoint_dir(spark):
    a, b = run_dir(spark, "x"), run_dir(spark, "x")
    assert a != b and a.startswith(checkpoint_dir(spark))


def test_a_run_appears_whole(spark, tmp):
    """Readers between two writes of a tag see the old sets; a write without a manifest is never seen."""
    one, two = (spark.createDataFrame([(f"m{k}", k)], "match_id string, n int") for k in (1, 2))
    sinks.write_run({"a": one, "b": one}, "fast", tmp)
    sinks.write_run({"a": two, "b": two}, "slow", tmp)
    seen = lambda name, tags=None: sorted((r.tag, r.n) for r in sinks.read_runs(spark, tmp, name, tags).collect())
    two.write.parquet(f"{tmp}/a/tag=fast/write=99999999999999999999-half")  # the next write, its first set only
    assert seen("a") == seen("b") == [("fast", 1), ("slow", 2)]
    sinks.write_run({"a": two, "b": two}, "fast", tmp)
    assert seen("a") == seen("b") == [("fast", 2), ("slow", 2)] and seen("a", ["slow"]) == [("slow", 2)]
    assert not [f for _, _, fs in os.walk(f"{tmp}/_manifests") for f in fs if f.endswith(".tmp")]


def test_colocated_detection_on_a_bucketed_table_shuffles_nothing(spark, tmp):
    from pricefold.operators import detect as D
    from pricefold.sources import views as V
    odds = V.odds_li(spark, "/root/testdata/sf0.001").select(*D.DETECT_COLUMNS)
    table = sinks.write_bucketed(odds, "odds_" + os.path.basename(tmp).replace("-", "_"), f"{tmp}/t", 4, sort=("bookmaker",))
    got = D.detect_snapshot(table, now_ms=0, strategy="colocated")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan, plan
    want = D.detect_snapshot(odds, now_ms=0)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count() == 820


def test_listener_writes_records_out_and_holds_few(spark, tmp):
    import time
    from pricefold.streaming import stream as S
    spark.range(3).write.parquet(f"{tmp}/in")
    lst = S.MetricsListener(path=f"{tmp}/m", most=1)
    spark.streams.addListener(lst)
    try:
        for k in range(2):
            src = S.file_stream(spark, f"{tmp}/in", schema="id long")
            q = src.writeStream.format("noop").option("checkpointLocation", f"{tmp}/c{k}").trigger(availableNow=True).start()
            q.awaitTermination()
        deadline = time.time() + 30
        while time.time() < deadline and len(lst.last) < 2:
            time.sleep(0.2)
        time.sleep(0.5)
    finally:
        spark.streams.removeListener(lst)
    assert len(lst.records) == 1
    got = S.MetricsListener.read_metrics(spark, f"{tmp}/m").where("rows_read > 0").collect()
    assert len({r.query_id for r in got}) == 2 and {r.rows_read for r in got} == {3}


def test_empty_polls_have_a_record(spark, tmp):
    import time
    from pricefold.sources import views as V
    from pricefold.streaming import stream as S
    V.odds_ev(spark, "/root/testdata/sf0.001").write.parquet(f"{tmp}/in")
    q = S.start_polling(S.file_stream(spark, f"{tmp}/in"), f"{tmp}/out", f"{tmp}/ckpt", f"{tmp}/metrics",
                        trigger={"processingTime": "300 milliseconds"})
    deadline = time.time() + 60
    while time.time() < deadline and not (os.path.isdir(f"{tmp}/metrics-idle") and len(os.listdir(f"{tmp}/metrics-idle")) > 3):
        time.sleep(0.2)
    q.stop()
    rows = S.read_polls(spark, f"{tmp}/metrics").collect()
    full, empty = [r for r in rows if r.batch is not None], [r for r in rows if r.batch is None]
    assert len(full) == 1 and full[0].rows_decoded == 1000
    assert empty and all(r.rows_decoded == r.opps_found == 0 and r.wall_time_ms > 0 for r in empty)

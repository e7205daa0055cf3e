"""Reports: golden run summary, percentiles, ratio, pivot, CDF, box stats, overlap."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricefold.operators import report as R

# Published trigger metrics and opportunity latencies of one run ("fast").
BATCH_METRICS = [(1, 0, 0, 371, 1779491976908), (2, 10000, 9, 3706, 1779491990249),
                 (3, 0, 0, 319, 1779491996868), (4, 0, 0, 317, 1779492006871)]
STREAM_METRICS = [(1, 0, 0, 64, 1779491977715), (2, 151, 0, 541, 1779491981008),
                  (3, 9849, 9, 804, 1779491981898)]
BATCH_LAT = [9754, 9741, 9883, 9815, 9746, 9800, 9813, 9610, 9570]
STREAM_LAT = [1489, 1430, 1476, 1422, 1491, 1417, 1246, 1286, 1559]
# Published summary values for that run.
GOLDEN = {
    "batch": dict(batches=4, events=10000, opps=9, proc_ms_p50=345.0, proc_ms_p95=3205.75, proc_ms_p99=3605.95,
                  lat_ms_p50=9754.0, lat_ms_p95=9855.8, lat_ms_p99=9877.56, throughput_ev_s=333.7449521075994),
    "stream": dict(batches=3, events=10000, opps=9, proc_ms_p50=541.0, proc_ms_p95=777.7, proc_ms_p99=798.74,
                   lat_ms_p50=1430.0, lat_ms_p95=1531.8, lat_ms_p99=1553.56, throughput_ev_s=2390.628735357399),
}


@pytest.fixture()
def run_frames(spark):
    m = [("fast", "batch") + r for r in BATCH_METRICS] + [("fast", "stream") + r for r in STREAM_METRICS]
    metrics = spark.createDataFrame(m, "tag string, method string, batch bigint, rows_read bigint, "
                                       "opps_found bigint, processing_ms bigint, wall_time_ms bigint")
    o = [("fast", "batch", f"b{i}", v) for i, v in enumerate(BATCH_LAT)] + \
        [("fast", "stream", f"s{i}", v) for i, v in enumerate(STREAM_LAT)]
    opps = spark.createDataFrame(o, "tag string, method string, match_id string, e2e_latency_ms bigint")
    return metrics, opps


def test_run_summary_matches_published(spark, run_frames):
    s = {r.label: r.asDict() for r in R.run_summary(*run_frames).collect()}
    for label, exp in GOLDEN.items():
        for k, v in exp.items():
            assert s[label][k] == v, (label, k, s[label][k], v)
        assert s[label]["tag"] == "fast"


def test_run_summary_edge_cases(spark):
    metrics = spark.createDataFrame([("t", "one", 1, 5, 0, 10, 100), ("t", "flat", 1, 5, 0, 10, 100),
                                     ("t", "flat", 2, 5, 0, 20, 100)],
                                    "tag string, method string, batch bigint, rows_read bigint, "
                                    "opps_found bigint, processing_ms bigint, wall_time_ms bigint")
    opps = spark.createDataFrame([], "tag string, method string, match_id string, e2e_latency_ms bigint")
    s = {r.label: r for r in R.run_summary(metrics, opps).collect()}
    assert s["one"].throughput_ev_s is None      # a single trigger
    assert s["flat"].throughput_ev_s is None     # zero span
    assert s["one"].lat_ms_p50 is None           # no opportunities
    assert s["flat"].proc_ms_p50 == 15.0


def test_percentiles_equal_numpy(spark, run_frames):
    p = {(r.method, r.p): r.value for r in R.run_percentiles(run_frames[0]).collect()}
    for method, rows in (("batch", BATCH_METRICS), ("stream", STREAM_METRICS)):
        vals = [r[3] for r in rows]
        for q in (0.5, 0.95, 0.99):
            assert p[(method, q)] == round(float(np.percentile(vals, q * 100)), 6)


def test_method_ratio_and_pivot(spark, run_frames):
    s = R.run_summary(*run_frames)
    ratio = {r.metric: r for r in R.method_ratio(s).collect()}
    assert math.isclose(ratio["throughput_ev_s"].ratio, 333.7449521075994 / 2390.628735357399)
    assert ratio["opps"].ratio == 1.0
    piv = R.pivot_metric(s, "lat_ms_p50").collect()[0]
    assert (piv.batch, piv.stream) == (9754.0, 1430.0)
    dup = s.unionByName(s)
    with pytest.raises(Exception, match="duplicate"):
        R.pivot_metric(dup, "lat_ms_p50").collect()
    zero = s.withColumn("opps", F.when(F.col("label") == "stream", F.lit(0)).otherwise(F.col("opps")))
    assert {r.metric: r.ratio for r in R.method_ratio(zero).collect()}["opps"] is None


def test_run_compare_columns(spark, run_frames):
    s = R.run_summary(*run_frames)
    c = R.run_compare([s.where("label = 'batch'"), s.where("label = 'stream'")])
    assert c.columns == ["tag", "label", "events", "opps", "lat_p50_ms", "lat_p95_ms", "proc_p50_ms",
                         "proc_p95_ms", "throughput"]
    assert c.count() == 2


def test_latency_cdf_ties_get_distinct_steps(spark):
    vals = [5, 1, 5, 3, 5]
    df = spark.createDataFrame([("t", "m", f"x{i}", v) for i, v in enumerate(vals)],
                               "tag string, method string, match_id string, e2e_latency_ms bigint")
    got = sorted((r.x, r.cdf) for r in R.latency_cdf(df).collect())
    s = np.sort(np.array(vals) / 1000.0)
    assert got == list(zip(s.tolist(), (np.arange(1, 6) / 5).tolist()))


def test_latency_cdf_chunks_large_counts(spark, monkeypatch):
    monkeypatch.setattr(R, "CDF_CHUNK", 3)
    df = spark.createDataFrame([("t", "m", "x", 7)] * 8 + [("t", "m", "y", 9)] * 2,
                               "tag string, method string, match_id string, e2e_latency_ms bigint")
    got = sorted(r.cdf for r in R.latency_cdf(df).collect())
    assert got == [i / 10 for i in range(1, 11)]


def test_box_stats_like_matplotlib(spark):
    vals = [1, 2, 3, 4, 5, 6, 7, 8, 100, -50]
    df = spark.createDataFrame([("t", "m", i, 1, 0, v, i) for i, v in enumerate(vals)],
                               "tag string, method string, batch bigint, rows_read bigint, opps_found bigint, "
                               "processing_ms bigint, wall_time_ms bigint")
    r = R.box_stats(df).collect()[0]
    q1, med, q3 = np.percentile(vals, [25, 50, 75])
    iqr = q3 - q1
    inside = [v for v in vals if q1 - 1.5 * iqr <= v <= q3 + 1.5 * iqr]
    assert (r.q1, r.median, r.q3) == (q1, med, q3)
    assert (r.whisker_low, r.whisker_high) == (min(inside), max(inside))
    assert r.n_outliers == 2
    assert sorted(x.processing_ms for x in R.box_outliers(df).collect()) == [-50, 100]


def test_overlap_set_algebra(spark):
    a = spark.createDataFrame([("m1",), ("m2",), ("m2",), ("m3",)], "match_id string")
    b = spark.createDataFrame([("m2",), ("m4",)], "match_id string")
    r = R.overlap(a, b).collect()[0]
    assert (r.only_a, r.only_b, r.both, r.total_unique, r.n_a, r.n_b) == (2, 1, 1, 4, 3, 2)
    assert sorted(x.match_id for x in R.only_in(a, b).collect()) == ["m1", "m3"]
    assert [x.match_id for x in R.in_both(a, b).collect()] == ["m2"]


def test_top_margins_and_head(spark):
    from conftest import odds_rows
    from test_detect import golden_events
    from pricefold.operators import detect as D
    opps = D.detect_snapshot(odds_rows(spark, golden_events()), now_ms=0)
    top = R.top_margins(opps, 3).collect()
    assert [r.rank for r in top] == [1, 2, 3]
    assert top[0].match_id == "F1-2020-09-16-Paris_SG-Metz"
    assert math.isclose(top[0].margin_pct, 9.335815047021945)
    head = R.chronological_head(odds_rows(spark, golden_events()), 2).collect()
    assert [r.event_time_ms for r in head] == [1600286400000, 1600286400000]


def test_replay_schedule(spark):
    from conftest import odds_rows
    rows = [("m1", "A", 2.0, 2.0, 2.0, 0, 1), ("m1", "B", 2.0, 2.0, 2.0, 0, 2),
            ("m2", "A", 2.0, 2.0, 2.0, 60_000, 3), ("m3", "A", 2.0, 2.0, 2.0, 3_600_000, 4)]
    df = odds_rows(spark, rows).withColumn("match_date", F.lit("d"))
    got = {r.real_time_ms: r.offset_s for r in R.replay_schedule(df, speed=60.0, cap_s=5.0).collect()}
    assert got == {1: 0.0, 2: 0.0, 3: 1.0, 4: 6.0}   # 60 s / 60 = 1 s; 59 min / 60 capped at 5 s
    still = {r.real_time_ms: r.offset_s for r in R.replay_schedule(df, speed=0.0).collect()}
    assert set(still.values()) == {0.0}


ODD_VALUES = [0.25, -0.5, 1.5, 1.5, 1e300, -1e300, 5e-324, 0.0, -0.0, 2.0**60, 3.25, 3.25, 3.25, 1e-9]


@pytest.fixture()
def odd_frames(spark):
    """NULL tag, NULL method, both NULL; fractional values of all sizes, NULL values."""
    rnd = np.random.default_rng(4)
    rows, opps = [], []
    for g, (tag, method) in enumerate([(None, "batch"), ("t", None), (None, None), ("t", "batch")]):
        vals = [*ODD_VALUES, *(rnd.normal(size=60) * 10.0 ** rnd.integers(-3, 4)).tolist(), None][g:]
        rows += [(tag, method, i, 3, i % 2, v, 1000 + 250 * i) for i, v in enumerate(vals)]
        opps += [(tag, method, f"m{i}", v) for i, v in enumerate(vals)]
    return (spark.createDataFrame(rows, "tag string, method string, batch bigint, rows_read bigint, opps_found bigint, "
                                        "processing_ms double, wall_time_ms bigint").repartition(3),
            spark.createDataFrame(opps, "tag string, method string, match_id string, e2e_latency_ms double").repartition(3))


def by_group(rows, value):
    out = {}
    for r in rows:
        if r[value] is not None:
            out.setdefault((r["tag"], r["method"]), []).append(r[value])
    return out


def test_quantiles_of_fractions_and_null_keys_equal_numpy(odd_frames):
    metrics, opps = odd_frames
    ps = (0.0, 0.25, 0.5, 0.95, 0.99, 1.0)
    groups = by_group(metrics.collect(), "processing_ms")
    got = {(r.tag, r.method): [r[f"q{i}"] for i in range(len(ps))] for r in R.quantiles(metrics, "processing_ms", ["tag", "method"], ps).collect()}
    assert got.keys() == groups.keys() and len(got) == 4
    for g, vals in groups.items():
        assert np.allclose(got[g], np.quantile(vals, ps), rtol=1e-12, atol=0), g
    s = {(r.tag, r.label): r for r in R.run_summary(metrics, opps).collect()}
    assert s.keys() == groups.keys()
    for g, vals in groups.items():
        assert math.isclose(s[g].proc_ms_p50, round(float(np.quantile(vals, 0.5)), 6), rel_tol=1e-9, abs_tol=1e-6)
        assert math.isclose(s[g].lat_ms_p95, round(float(np.quantile(vals, 0.95)), 6), rel_tol=1e-9, abs_tol=1e-6)


def test_quantiles_of_one_value_and_no_value(spark):
    df = spark.createDataFrame([("a", 2.5), ("b", None), ("c", float("nan")), ("c", 1.0), ("c", float("-inf"))], "k string, v double")
    got = {r.k: (r.q0, r.q1) for r in R.quantiles(df, "v", ["k"], (0.0, 0.5)).collect()}
    assert got == {"a": (2.5, 2.5), "c": (float("-inf"), 1.0)}


def test_value_ranges_never_fall(spark):
    vals = sorted([*ODD_VALUES, float("inf"), float("-inf"), 1.7976931348623157e308, *np.random.default_rng(1).normal(size=500).tolist()])
    df = spark.createDataFrame([(float(v),) for v in vals] + [(float("nan"),)], "v double")
    b = [r[1] for r in sorted(df.select("v", R.value_range(F.col("v"))).collect(), key=lambda r: (math.isnan(r[0]), r[0]))]
    assert b == sorted(b) and b[-1] > b[-2]


def test_cdf_timeline_and_box_keep_null_groups(odd_frames):
    metrics, opps = odd_frames
    groups = by_group(opps.collect(), "e2e_latency_ms")
    cdf = {}
    for r in R.latency_cdf(opps, scale=1.0).collect():
        cdf.setdefault((r.tag, r.method), []).append((r.x, r.cdf))
    assert cdf.keys() == groups.keys()
    for g, vals in groups.items():
        assert sorted(cdf[g]) == [(v, (i + 1) / len(vals)) for i, v in enumerate(sorted(vals))]
    times = R.run_timeline(metrics).collect()
    assert len(times) == metrics.count() and all(r.t_s == 0.25 * r.batch for r in times)
    for r in R.box_stats(metrics).collect():
        vals = np.array(groups[(r.tag, r.method)])
        q1, med, q3 = np.quantile(vals, (0.25, 0.5, 0.75))
        assert np.allclose([r.q1, r.median, r.q3], [q1, med, q3], rtol=1e-6, atol=1e-6)
        inside = vals[(vals >= q1 - 1.5 * (q3 - q1)) & (vals <= q3 + 1.5 * (q3 - q1))]
        assert (r.whisker_low, r.whisker_high, r.n_outliers) == (inside.min(), inside.max(), len(vals) - len(inside))
    assert R.box_outliers(metrics).count() == sum(r.n_outliers for r in R.box_stats(metrics).collect())


def test_decimal_and_text_free_types(spark):
    df = spark.createDataFrame([(i,) for i in range(11)], "v int").select(F.lit(1).alias("k"), (F.col("v") / 4).cast("decimal(10,2)").alias("v"))
    assert R.quantiles(df, "v", ["k"], (0.25,)).collect()[0].q0 == np.quantile([i / 4 for i in range(11)], 0.25)


def test_quantiles_scan_once(spark):
    from pricefold.sources import views as V
    df = R.quantiles(V.run_metrics(spark, "/root/testdata/sf0.001"), "processing_ms", ["tag", "method"])
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") <= 5, plan

"""Reporting over detection runs: summaries, percentiles, distributions,
overlap between methods, coverage and rankings.

Inputs are DataFrames of trigger metrics (``batch, rows_read, opps_found,
processing_ms, wall_time_ms``) and opportunity records, grouped by
``keys`` (default: ``tag`` and ``method``), so one call reports many runs.  A
NULL key is a group like any other; measured values may be of any numeric type.

Scale notes: percentiles and the CDF rank distinct values, counted map-side
and cut into narrow value ranges (``ranked_values``), so no task sorts or holds a
group's rows; the CDF's rows are made in bounded chunks, dealt over tasks
first; per-group values go back to the rows by a salted join, so a run's rows
are not shuffled to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricefold.operators import detect as D
from pricefold.operators.scan import running
from pricefold.schema import EPSILON, METHOD_BATCH, METHOD_STREAM

PCTS = (0.5, 0.95, 0.99)
ROUND = 6
CDF_CHUNK = 65536


SALTS = 32
#: Value ranges per power of two that ``ranked_values`` tells apart.
RANGES_PER_OCTAVE = 1 << 16


def value_range(v: Column, per_octave: int = RANGES_PER_OCTAVE) -> Column:
    """A bigint that never falls as the double ``v`` rises: its power of two in
    ``per_octave`` steps, mirrored for negative values; infinities and NaN (the
    greatest) have numbers of their own."""
    top = F.lit(1 << 62)
    size = F.floor((F.log2(F.abs(v)) + F.lit(1076.0)) * F.lit(float(per_octave))).cast("bigint")
    inf = F.abs(v) == F.lit(float("inf"))
    far = F.when(inf, top).otherwise(size)
    return F.when(F.isnan(v), top + 1).when(v == 0, F.lit(0).cast("bigint")).when(v > 0, far).otherwise(-far)


def ranked_values(df: DataFrame, value: str, keys: Sequence[str], per_octave: int = RANGES_PER_OCTAVE) -> DataFrame:
    """Distinct values of a numeric column per group with their ranks: ``_g``
    (struct of ``keys``: equal also where a key is NULL), ``_v`` (double), ``_c``
    (rows), ``_before`` (rows of smaller values) and ``_n`` (rows of the group).
    NULL values do not count.

    Rows are counted per distinct value map-side.  A running sum orders the
    values of one narrow range of values, and the carry into a range is a running
    sum over the ranges' totals, so no task sees a whole group's values.
    Four shuffles, none of rows.
    """
    v = F.col(value).cast("double") + F.lit(0.0)  # -0.0 and 0.0 are one value
    rows = df.where(F.col(value).isNotNull()).select(F.struct(*keys).alias("_g"), v.alias("_v"))
    # never null, so that the join below adds no filter and both its sides share their shuffles
    piece = F.coalesce(value_range(F.col("_v"), per_octave), F.lit(0))
    counts = rows.groupBy("_g", piece.alias("_b"), "_v").agg(F.count(F.lit(1)).alias("_c"))
    inside = Window.partitionBy("_g", "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    within = counts.repartition("_g", "_b").withColumn("_upto", F.sum("_c").over(inside))
    group = Window.partitionBy("_g")
    carried = within.groupBy("_g", "_b").agg(F.max("_upto").alias("_all")).select(
        "_g", "_b", F.sum("_all").over(group).alias("_n"),
        F.sum("_all").over(group.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)).alias("_end"), "_all")
    carried = carried.select("_g", "_b", "_n", (F.col("_end") - F.col("_all")).alias("_carry"))
    return within.join(carried, ["_g", "_b"]).select(
        "_g", "_v", "_c", (F.col("_carry") + F.col("_upto") - F.col("_c")).alias("_before"), "_n")


def quantiles(df: DataFrame, value: str, keys: Sequence[str], ps: Sequence[float] = PCTS,
              per_octave: int = RANGES_PER_OCTAVE) -> DataFrame:
    """Exact, linearly interpolated quantiles of a numeric column per group:
    ``keys``, ``q0``, ``q1``, ...; NULLs do not count, NaN is the greatest value.

    Rank ``p * (n - 1)`` lies between two of the ranked distinct values; only
    the values that hold a wanted rank reach the last, tiny shuffle.
    """
    ranked = ranked_values(df, value, keys, per_octave)
    aggs, holds = [], lambda r: (F.col("_before") <= r) & (r < F.col("_before") + F.col("_c"))
    wanted = F.lit(False)
    for i, p in enumerate(ps):
        at = F.lit(float(p)) * (F.col("_n") - 1)
        lo, hi = holds(F.floor(at)), holds(F.ceil(at))
        wanted = wanted | lo | hi
        aggs += [F.max(F.when(lo, F.col("_v"))).alias(f"_lo{i}"), F.max(F.when(hi, F.col("_v"))).alias(f"_hi{i}"),
                 F.max(at - F.floor(at)).alias(f"_f{i}")]
    q = ranked.where(wanted).groupBy("_g").agg(*aggs)
    between = [F.when(F.col(f"_f{i}") == 0, F.col(f"_lo{i}")).otherwise(
        (1 - F.col(f"_f{i}")) * F.col(f"_lo{i}") + F.col(f"_f{i}") * F.col(f"_hi{i}")).alias(f"q{i}") for i in range(len(ps))]
    return q.select("_g.*", *between)


def spread_join(rows: DataFrame, per_group: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """``rows`` joined with one row per group (NULL keys match), a group's rows
    split over ``SALTS`` tasks by the hash of column ``by`` (a small right side
    is broadcast by adaptive execution, whose size check that is)."""
    group = F.struct(*keys).alias("_g")  # structs compare NULL fields as equal
    salted = rows.select("*", group, F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int").alias("_salt"))
    copies = per_group.select(group, *[c for c in per_group.columns if c not in keys],
                              F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    return salted.join(copies, ["_g", "_salt"]).drop("_g", "_salt")


def run_summary(metrics: DataFrame, opps: DataFrame, keys: Sequence[str] = ("tag", "method")) -> DataFrame:
    """One row per run and method: triggers, rows, opportunities, processing
    time and latency percentiles (p50/p95/p99), throughput.

    Throughput = rows / (last - first wall time in s); NULL with fewer than
    two triggers or a zero span.  Latency percentiles are NULL without
    opportunities.  Every column is always present.
    """
    keys = list(keys)
    m = metrics.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("rows_read").cast("bigint").alias("events"),
        F.sum("opps_found").cast("bigint").alias("opps"),
        F.min("wall_time_ms").alias("_w0"), F.max("wall_time_ms").alias("_w1"),
    )
    proc, lat = (quantiles(d, v, keys).select(*keys, *[F.col(f"q{i}").alias(f"_{n}{i}") for i in range(len(PCTS))])
                 for d, v, n in ((metrics, "processing_ms", "p"), (opps, "e2e_latency_ms", "l")))
    # one row per group from all three: grouping, unlike a join, matches NULL keys
    parts = m.unionByName(proc, allowMissingColumns=True).unionByName(lat, allowMissingColumns=True)
    names = [c for c in parts.columns if c not in keys]
    both = parts.groupBy(*keys).agg(*[F.max(c).alias(c) for c in names]).where(F.col("batches").isNotNull())
    span_s = (F.col("_w1") - F.col("_w0")) / F.lit(1000.0)
    thr = F.when((F.col("batches") >= 2) & (F.col("_w1") > F.col("_w0")), F.col("events") / span_s)
    label = keys[-1]
    cols = [F.col(k) for k in keys[:-1]] + [F.col(label).alias("label"), "batches", "events", "opps"]
    for i, p in enumerate(("p50", "p95", "p99")):
        cols.append(F.round(F.col(f"_p{i}"), ROUND).alias(f"proc_ms_{p}"))
    for i, p in enumerate(("p50", "p95", "p99")):
        cols.append(F.round(F.col(f"_l{i}"), ROUND).alias(f"lat_ms_{p}"))
    cols.append(thr.alias("throughput_ev_s"))
    return both.select(*cols)


def run_percentiles(metrics: DataFrame, value: str = "processing_ms",
                    keys: Sequence[str] = ("tag", "method")) -> DataFrame:
    """Exact, linearly interpolated p50/p95/p99 of ``value`` per group, one
    row per percentile."""
    keys = list(keys)
    pairs = F.array(*[F.struct(F.lit(p).alias("p"), F.round(f"q{i}", ROUND).alias("value")) for i, p in enumerate(PCTS)])
    return quantiles(metrics, value, keys).select(*keys, F.inline(pairs))


SUMMARY_METRICS = ["batches", "events", "opps", "proc_ms_p50", "proc_ms_p95", "proc_ms_p99",
                   "lat_ms_p50", "lat_ms_p95", "lat_ms_p99", "throughput_ev_s"]


def method_ratio(summary: DataFrame, num: str = METHOD_BATCH, den: str = METHOD_STREAM,
                 keys: Sequence[str] = ("tag",)) -> DataFrame:
    """Per run and metric: the two methods' values and their ratio; NULL
    when either is missing or the divisor is 0."""
    keys = list(keys)
    long = summary.select(*keys, "label", *[F.col(c).cast("double").alias(c) for c in SUMMARY_METRICS]).unpivot(
        ids=keys + ["label"], values=SUMMARY_METRICS, variableColumnName="metric", valueColumnName="value")
    wide = long.groupBy(*keys, "metric").pivot("label", [num, den]).agg(F.first("value"))
    ratio = F.when(F.col(den).isNull() | (F.col(den) == 0) | F.col(num).isNull(), F.lit(None)).otherwise(
        F.try_divide(F.col(num), F.col(den)))
    return wide.select(*keys, "metric", F.col(num).alias(f"{num}_value"), F.col(den).alias(f"{den}_value"),
                       ratio.alias("ratio"))


def run_compare(summaries: Sequence[DataFrame]) -> DataFrame:
    """Union of tagged summaries with the compact comparison columns."""
    out = summaries[0]
    for s in summaries[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return out.select("tag", "label", "events", "opps",
                      F.col("lat_ms_p50").alias("lat_p50_ms"), F.col("lat_ms_p95").alias("lat_p95_ms"),
                      F.col("proc_ms_p50").alias("proc_p50_ms"), F.col("proc_ms_p95").alias("proc_p95_ms"),
                      F.col("throughput_ev_s").alias("throughput"))


def pivot_metric(summary: DataFrame, metric: str, labels: Sequence[str] = (METHOD_BATCH, METHOD_STREAM),
                 index: str = "tag") -> DataFrame:
    """``index`` x label table of one metric; a duplicate (index, label)
    fails the job, as a pivot of a non-unique index must."""
    cell = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit(f"duplicate {index}/label in pivot of {metric}"))) \
        .otherwise(F.first(F.col(metric).cast("double")))
    return summary.groupBy(index).pivot("label", list(labels)).agg(cell)


def latency_cdf(opps: DataFrame, value: str = "e2e_latency_ms", keys: Sequence[str] = ("tag", "method"),
                scale: float = 1000.0) -> DataFrame:
    """Empirical CDF: for the i-th smallest of n values, ``y = i / n``
    (ties get distinct y), ``x = value / scale`` (ms → s).

    Built from the ranked distinct values: each value's rows are regenerated
    in chunks of at most ``CDF_CHUNK``, shuffled by (value, chunk) first, so no
    group of rows is sorted, collected or made in one task.
    """
    ranked = ranked_values(opps, value, keys)
    chunks = ranked.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_c") - 1) / F.lit(CDF_CHUNK)).cast("bigint"))).alias("k"))
    # a hot value's chunks are dealt over tasks before their rows are made
    rows = chunks.repartition("_g", "_v", "k").select(
        "_g", "_v", "_n",
        F.explode(F.sequence(F.col("_before") + F.col("k") * CDF_CHUNK + 1,
                             F.least(F.col("_before") + F.col("_c"),
                                     F.col("_before") + (F.col("k") + 1) * CDF_CHUNK))).alias("i"))
    return rows.select("_g.*", (F.col("_v") / F.lit(scale)).alias("x"),
                       (F.col("i").cast("double") / F.col("_n")).alias("cdf"))


def run_timeline(metrics: DataFrame, keys: Sequence[str] = ("tag", "method")) -> DataFrame:
    """Seconds since the run's first trigger, with rows read per trigger."""
    keys = list(keys)
    start = metrics.groupBy(*keys).agg(F.min("wall_time_ms").alias("_w0"))
    return spread_join(metrics, start, keys, "batch").select(
        *keys, "batch", ((F.col("wall_time_ms") - F.col("_w0")) / F.lit(1000.0)).alias("t_s"), "rows_read")


def box_stats(metrics: DataFrame, value: str = "processing_ms", keys: Sequence[str] = ("tag", "method"),
              whis: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (furthest data point within ``whis`` IQR of the
    box) and outlier count per group."""
    keys = list(keys)
    q = quantiles(metrics, value, keys, (0.25, 0.5, 0.75)).toDF(*keys, "q1", "median", "q3")
    lo = F.col("q1") - F.lit(whis) * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + F.lit(whis) * (F.col("q3") - F.col("q1"))
    v = F.col(value).cast("double")
    # one row per distinct value, with how often it occurs
    j = metrics.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))
    j = spread_join(j, q, keys, value)
    return j.groupBy(*keys).agg(
        F.round(F.first("q1"), ROUND).alias("q1"), F.round(F.first("median"), ROUND).alias("median"),
        F.round(F.first("q3"), ROUND).alias("q3"),
        F.min(F.when(v >= lo, v)).alias("whisker_low"), F.max(F.when(v <= hi, v)).alias("whisker_high"),
        F.coalesce(F.sum(F.when((v < lo) | (v > hi), F.col("_c"))), F.lit(0)).alias("n_outliers"),
    )


def box_outliers(metrics: DataFrame, value: str = "processing_ms", keys: Sequence[str] = ("tag", "method"),
                 whis: float = 1.5) -> DataFrame:
    """The outlier rows themselves (a filter, not a collected list)."""
    keys = list(keys)
    stats = box_stats(metrics, value, keys, whis)
    return spread_join(metrics, stats, keys, value).where(
        (F.col(value) < F.col("whisker_low")) | (F.col(value) > F.col("whisker_high"))).select(*keys, value)


def overlap(a: DataFrame, b: DataFrame, key: str = "match_id") -> DataFrame:
    """Set algebra of the keys two methods reported: only in a, only in b,
    in both, unique total, and each side's distinct count."""
    da = a.select(F.col(key).alias("k")).distinct().withColumn("in_a", F.lit(True))
    db = b.select(F.col(key).alias("k")).distinct().withColumn("in_b", F.lit(True))
    j = da.join(db, "k", "full_outer")
    return j.agg(
        F.count_if(F.col("in_a").isNotNull() & F.col("in_b").isNull()).alias("only_a"),
        F.count_if(F.col("in_b").isNotNull() & F.col("in_a").isNull()).alias("only_b"),
        F.count_if(F.col("in_a").isNotNull() & F.col("in_b").isNotNull()).alias("both"),
        F.count(F.lit(1)).alias("total_unique"),
        F.count_if(F.col("in_a").isNotNull()).alias("n_a"),
        F.count_if(F.col("in_b").isNotNull()).alias("n_b"),
    )


def only_in(a: DataFrame, b: DataFrame, key: str = "match_id") -> DataFrame:
    """Keys reported by ``a`` and not by ``b`` (anti join)."""
    return a.select(key).distinct().join(b.select(key), key, "left_anti")


def in_both(a: DataFrame, b: DataFrame, key: str = "match_id") -> DataFrame:
    return a.select(key).distinct().join(b.select(key), key, "left_semi")


def count_by_group(odds: DataFrame, group: str) -> DataFrame:
    """Distinct matches per ``group`` value, largest first."""
    return (odds.select(group, "match_id").distinct().groupBy(group)
            .agg(F.count(F.lit(1)).alias("matches")).orderBy(F.desc("matches"), group))


def distinct_counts(odds: DataFrame) -> DataFrame:
    return odds.agg(
        F.count(F.lit(1)).alias("updates"),
        F.count_distinct("match_id").alias("matches"),
        F.count_distinct("bookmaker").alias("bookmakers"),
        F.count_distinct("match_date").alias("match_dates"),
    )


def arb_rate(odds: DataFrame, min_books: int = 2, eps: float = EPSILON) -> DataFrame:
    """Matches with at least ``min_books`` sources, opportunities among them,
    and the rate in percent (NULL when nothing was scanned)."""
    best = D.implied_prob(D.best_prices(D.latest_odds(D.valid_odds(odds).select(*D.DETECT_COLUMNS))))
    scanned = best.where(F.col("n_books") >= min_books)
    return scanned.agg(
        F.count(F.lit(1)).alias("scanned"),
        F.count_if(F.col("profit_margin") > F.lit(eps)).alias("opportunities"),
    ).select("scanned", "opportunities",
             F.when(F.col("scanned") > 0, F.lit(100.0) * F.col("opportunities") / F.col("scanned")).alias("rate_pct"))


def opp_count(opps: DataFrame) -> DataFrame:
    return opps.groupBy("method").agg(F.count(F.lit(1)).alias("opps"))


def top_margins(opps: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` largest margins (ties by match id) with a running number
    and the margin in percent; a top-k, so Spark plans TakeOrderedAndProject."""
    top = opps.orderBy(F.desc("profit_margin"), "match_id").limit(n)
    w = Window.orderBy(F.desc("profit_margin"), "match_id")  # over at most n rows
    return top.select(
        F.row_number().over(w).cast("bigint").alias("rank"), (F.col("profit_margin") * F.lit(100.0)).alias("margin_pct"),
        "match_id", "best_odds_home", "best_book_home", "best_odds_draw", "best_book_draw",
        "best_odds_away", "best_book_away")


def chronological_head(odds: DataFrame, n: int | None = 100) -> DataFrame:
    """Updates in kickoff order (total order: time, match, source, send
    time); the first ``n`` of them, or all when ``n`` is None."""
    ordered = odds.orderBy("event_time_ms", "match_id", "bookmaker", "real_time_ms")
    return ordered if n is None else ordered.limit(n)


def replay_schedule(odds: DataFrame, speed: float, cap_s: float = 5.0, partition: str = "match_date",
                    chunk: int = 3_600_000) -> DataFrame:
    """Replay offsets per ``partition`` (e.g. day): between consecutive
    distinct kickoff times the replay waits ``gap / speed`` seconds, at most
    ``cap_s``, and nothing when ``speed <= 0``.  ``offset_s`` is the running
    sum, the same for all updates sharing a kickoff time.

    Works on distinct (partition, time) pairs, so many updates at one
    instant never pile up in one task, and the running values are chunked
    scans (``chunk`` ms per chunk), so a busy day is split too.
    """
    times = odds.select(partition, "event_time_ms").distinct()
    # previous distinct time = running max of earlier times (chunked scan)
    times = running(times, [partition], "event_time_ms", "event_time_ms", "max", "_prev_t", chunk, inclusive=False)
    gap_s = (F.col("event_time_ms") - F.col("_prev_t")) / F.lit(1000.0)
    if speed > 0:
        sleep = F.when(gap_s > 0, F.least(gap_s / F.lit(float(speed)), F.lit(float(cap_s)))).otherwise(F.lit(0.0))
    else:
        sleep = F.lit(0.0)
    sched = times.select(partition, "event_time_ms", sleep.alias("sleep_s"))
    sched = running(sched, [partition], "event_time_ms", "sleep_s", "sum", "_off", chunk)
    sched = sched.select(partition, "event_time_ms", F.round("_off", ROUND).alias("offset_s"))
    return odds.select("match_id", "bookmaker", partition, "event_time_ms", "real_time_ms").join(
        sched, [partition, "event_time_ms"])

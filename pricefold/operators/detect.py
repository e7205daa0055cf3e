"""Cross-source arbitrage detection as DataFrame operators.

Plan (one lazy plan, one action)::

    odds --valid--> latest_odds --(match)--> best_prices --> opportunities

Scale notes
-----------
* ``latest_odds`` is ``row_number() = 1`` per (match, source): Spark runs a
  partial ``WindowGroupLimit`` before the shuffle, so a hot (match, source)
  pair ships at most one row per map task, whatever its size.
* ``best_prices`` groups the de-duplicated rows by match.  A match has at most
  one row per source, so the per-key work is bounded by the number of sources,
  not by the number of updates.
* Everything is built-in expressions; there is no Python on the data path.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricefold.functions.odds import (
    implied_prob_sum, now_ms as _now_ms, profit_margin, stake, usable,
)
from pricefold.schema import EPSILON, METHOD_BATCH

# Latest-row order: newest event time, then newest send time, then prices, so
# the choice is total even when (match, source, event time) repeats.
LATEST_ORDER = ["event_time_ms", "real_time_ms", "odds_home", "odds_draw", "odds_away"]
OUTCOMES = ("home", "draw", "away")
# Columns detection needs; the rest is pruned before the shuffle.
DETECT_COLUMNS = ["match_id", "bookmaker"] + LATEST_ORDER


def _now(now_ms) -> Column:
    if now_ms is None:
        return _now_ms()
    return now_ms if isinstance(now_ms, Column) else F.lit(int(now_ms)).cast("bigint")


def _bucketed_by(odds: DataFrame, key: str) -> bool:
    """Whether the plan delivers rows hashed by ``key`` alone: a bucketed scan."""
    partitioning = odds._jdf.queryExecution().sparkPlan().outputPartitioning().toString()
    return re.match(rf"hashpartitioning\({re.escape(key)}#\d+, ", partitioning) is not None


def valid_odds(odds: DataFrame) -> DataFrame:
    """Rows usable for detection: keyed, timed, and all three prices numbers > 1.0."""
    return odds.where(usable())


def latest_odds(odds: DataFrame, keys: Sequence[str] = ("match_id",), source: str = "bookmaker",
                strategy: str = "window", input_partitions: int | None = None) -> DataFrame:
    """Latest update per (``keys``, ``source``).

    Order: event time, send time, then home/draw/away price, all descending;
    the remaining columns break any remaining tie so the result is
    deterministic.

    ``strategy="window"`` (default) is ``row_number() = 1``: Spark plans a
    partial ``WindowGroupLimit`` before the shuffle, so every map task ships
    at most one row per (key, source) and a hot key cannot pile up.
    ``strategy="aggregate"`` is a partial + final ``max(struct)``
    aggregation with the same property (measured slightly slower: its
    struct buffer forces a sort-based aggregate).  ``strategy="colocated"``
    shuffles once on the first key and
    does everything after it without another exchange, and not even once if the
    input is a table bucketed by that key (``sinks.write_bucketed``); it gets no
    map-side reduction.

    ``input_partitions`` (off by default) deals the raw rows round-robin to so
    many tasks first; only for an input that is one unsplittable file.
    """
    keys = list(keys)
    group = keys + [source]
    order = [c for c in LATEST_ORDER if c in odds.columns]
    rest = [c for c in odds.columns if c not in group and c not in order]
    if strategy == "colocated":
        if not _bucketed_by(odds, keys[0]):
            odds = odds.repartition(keys[0])
        strategy = "window"
    elif input_partitions:
        odds = odds.repartition(input_partitions)
    if strategy == "window":
        w = Window.partitionBy(*group).orderBy(*[F.col(c).desc() for c in order + rest])
        return odds.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    packed = F.max(F.struct(*[F.col(c) for c in order + rest])).alias("_r")
    return (odds.groupBy(*group).agg(packed)
            .select(*group, *[F.col(f"_r.{c}").alias(c) for c in order + rest])
            .select(*odds.columns))


def best_prices(latest: DataFrame, keys: Sequence[str] = ("match_id",), source: str = "bookmaker") -> DataFrame:
    """Best price per outcome over the sources of each key.

    Ties between sources go to the lexicographically smallest source name
    (prices and margin do not depend on the tie-break).  Also returns the
    number of sources and the newest event / send time.
    """
    keys = list(keys)
    aggs = [F.count(F.lit(1)).alias("n_books")]
    for o in OUTCOMES:
        aggs.append(F.min(F.struct((-F.col(f"odds_{o}")).alias("neg"), F.col(source).alias("book"))).alias(f"_{o}"))
    aggs += [F.max("event_time_ms").alias("max_event_time_ms"), F.max("real_time_ms").alias("max_real_time_ms")]
    out = latest.groupBy(*keys).agg(*aggs)
    cols = [F.col(k) for k in keys] + [F.col("n_books")]
    for o in OUTCOMES:
        cols += [F.col(f"_{o}.book").alias(f"best_book_{o}"), (-F.col(f"_{o}.neg")).alias(f"best_odds_{o}")]
    return out.select(*cols, "max_event_time_ms", "max_real_time_ms")


def implied_prob(best: DataFrame) -> DataFrame:
    """Adds ``implied_prob_sum``, ``profit_margin`` and ``is_arbitrage``."""
    return (best.withColumn("implied_prob_sum", implied_prob_sum())
            .withColumn("profit_margin", profit_margin())
            .withColumn("is_arbitrage", F.col("profit_margin") > F.lit(EPSILON)))


def opportunities(best: DataFrame, now_ms=None, method: str = METHOD_BATCH, min_books: int = 2,
                  eps: float = EPSILON, keys: Sequence[str] = ()) -> DataFrame:
    """Opportunity records (batch form) from ``best_prices`` output."""
    now = _now(now_ms)
    scored = implied_prob(best.where(F.col("n_books") >= min_books))
    return scored.where(F.col("profit_margin") > F.lit(eps)).select(
        *[F.col(k) for k in keys],
        F.lit(method).alias("method"), "match_id",
        "best_book_home", "best_odds_home", "best_book_draw", "best_odds_draw",
        "best_book_away", "best_odds_away", "profit_margin", "implied_prob_sum",
        now.alias("detected_at_ms"), "max_event_time_ms", "max_real_time_ms",
        (now - F.col("max_real_time_ms")).alias("e2e_latency_ms"),
    )


def detect_snapshot(odds: DataFrame, now_ms=None, min_books: int = 2, eps: float = EPSILON,
                    method: str = METHOD_BATCH, strategy: str = "window") -> DataFrame:
    """The whole input as one snapshot: latest price per source, best per
    outcome, opportunities where ``1/h + 1/d + 1/a < 1``.

    ``strategy="packed"`` (Arrow in the tasks) shuffles once, in compressed blocks of
    many rows, and sorts nothing on disk: for inputs whose matches are spread over
    the whole input, where map-side reduction finds little to reduce."""
    if strategy == "packed":
        from pricefold.operators.packed import packed_best_prices
        best = packed_best_prices(valid_odds(odds).select(*DETECT_COLUMNS))
        return opportunities(best, now_ms=now_ms, method=method, min_books=min_books, eps=eps)
    best = best_prices(latest_odds(valid_odds(odds).select(*DETECT_COLUMNS), strategy=strategy))
    return opportunities(best, now_ms=now_ms, method=method, min_books=min_books, eps=eps)


def window_start(time_col: str, width_ms: int) -> Column:
    t = F.col(time_col)
    w = F.lit(int(width_ms)).cast("bigint")
    return t - F.pmod(t, w)


def detect_window(odds: DataFrame, width_ms: int, time_col: str = "real_time_ms", now_ms=None,
                  min_books: int = 2, eps: float = EPSILON, method: str = METHOD_BATCH) -> DataFrame:
    """Tumbling-window detection: every window of ``width_ms`` on
    ``time_col`` is judged alone (stateless), like a polling consumer that
    reads only the updates of its period.  Adds ``window_start_ms``."""
    keyed = (valid_odds(odds).withColumn("window_start_ms", window_start(time_col, width_ms))
             .select("window_start_ms", *DETECT_COLUMNS))
    keys = ["window_start_ms", "match_id"]
    best = best_prices(latest_odds(keyed, keys=keys), keys=keys)
    return opportunities(best, now_ms=now_ms, method=method, min_books=min_books, eps=eps,
                         keys=["window_start_ms"])


def optimal_stakes(opps: DataFrame, total_stake: float = 100.0) -> DataFrame:
    """Stake split with equal payout on every outcome."""
    return opps.select(
        "*",
        stake(total_stake, "best_odds_home").alias("stake_home"),
        stake(total_stake, "best_odds_draw").alias("stake_draw"),
        stake(total_stake, "best_odds_away").alias("stake_away"),
    )


def match_book_count(odds: DataFrame, min_books: int = 2) -> DataFrame:
    """Sources per match after de-duplication, matches with >= ``min_books``."""
    latest = latest_odds(valid_odds(odds).select(*DETECT_COLUMNS))
    return (latest.groupBy("match_id").agg(F.count(F.lit(1)).alias("n_books"))
            .where(F.col("n_books") >= min_books))


def price_maps(odds: DataFrame, as_text: bool = False) -> DataFrame:
    """``{source -> price}`` per outcome and match, from the latest prices.

    A map holds one entry per source of the match, so its size is bounded by
    the number of sources.  ``as_text`` renders each map as
    ``source=price`` pairs sorted by source, separated by ``;``.
    """
    latest = latest_odds(valid_odds(odds).select(*DETECT_COLUMNS))
    aggs = []
    for o in OUTCOMES:
        entries = F.array_sort(F.collect_list(F.struct(F.col("bookmaker").alias("k"), F.col(f"odds_{o}").alias("v"))))
        if as_text:
            rendered = F.transform(entries, lambda e: F.concat(e["k"], F.lit("="), e["v"].cast("string")))
            aggs.append(F.array_join(rendered, ";").alias(f"{o}_odds"))
        else:
            aggs.append(F.map_from_entries(entries).alias(f"{o}_odds"))
    return latest.groupBy("match_id").agg(*aggs)

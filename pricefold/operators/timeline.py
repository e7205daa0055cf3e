"""Boundary-free batch twins of the streaming detector.

``arbitrage_timeline`` evaluates a match after every accepted update, in
arrival order, independent of trigger boundaries:

1. updates of one (match, source, arrival) are one: the newest.  An update
   delivered twice so counts once, whether its arrival repeats or not;
2. acceptance (late data): an update is accepted iff its event time is >=
   the largest event time of the earlier arrivals of the same (match,
   source) - a running ``max``;
3. every accepted update is joined once with the match's distinct sources; the
   price stands on the update's own source, and a running ``last non-null``
   over (match, source) carries each source's price forward (an as-of
   lookup).  Rows: updates x sources of the match, never update x update;
   both running values are chunked scans (``operators.scan``), so a hot
   (match, source) is spread over tasks;
4. a grouped aggregation per evaluation point gives the best prices.

``emit_on_change`` applies the change-only emission rule over the timeline.
That rule depends on the last *emitted* margin, a sequential fold, but only
within a stretch of opportunities: whatever comes after a vanished one starts
anew.  A running sum numbers the stretches, and only opportunity rows go to
``mapInPandas``, keyed by (match, stretch) and sorted by arrival: memory is
bounded by the Arrow batch, and a hot match is as many keys as it has stretches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricefold.functions.odds import implied_prob_sum, profit_margin
from pricefold.operators.detect import OUTCOMES, valid_odds
from pricefold.operators.scan import running
from pricefold.schema import EMIT_TOLERANCE, EPSILON
from pricefold.session import ship_package

TIMELINE_COLUMNS = [
    "match_id", "arrival", "bookmaker", "event_time_ms", "n_books",
    "best_book_home", "best_odds_home", "best_book_draw", "best_odds_draw",
    "best_book_away", "best_odds_away", "max_real_time_ms", "implied_prob_sum", "profit_margin", "is_arbitrage",
]


# Arrival range per chunk of the skew-safe scans (``operators.scan``): with
# millisecond send times about 17 minutes, with log offsets 1M messages.
CHUNK = 1 << 20


def accepted_updates(odds: DataFrame, arrival: str = "real_time_ms", chunk: int = CHUNK) -> DataFrame:
    """Valid updates that a keyed latest-value state would accept: event time
    newer than or equal to every earlier arrival of the same source.  One row
    per (match, source, arrival), the newest of several by event time, send
    time and prices.  The running max is a chunked scan, so a hot (match,
    source) is split."""
    rest = ["event_time_ms", "real_time_ms", *[f"odds_{o}" for o in OUTCOMES]]
    v = valid_odds(odds).where(F.col(arrival).isNotNull()).withColumn("arrival", F.col(arrival).cast("bigint"))
    v = v.groupBy("match_id", "bookmaker", "arrival").agg(F.max(F.struct(*rest)).alias("_u"))
    v = v.select("match_id", "bookmaker", "arrival", "_u.*")
    v = running(v, ["match_id", "bookmaker"], "arrival", "event_time_ms", "max", "_prev", chunk, inclusive=False)
    return v.where(F.col("_prev").isNull() | (F.col("event_time_ms") >= F.col("_prev"))).drop("_prev")


def arbitrage_timeline(odds: DataFrame, arrival: str = "real_time_ms", eps: float = EPSILON,
                       chunk: int = CHUNK) -> DataFrame:
    """One row per accepted update: the match's state right after all updates
    of its arrival.

    ``arrival`` orders the updates of a match.  ``n_books`` counts the distinct
    sources with a price so far; ``is_arbitrage`` needs at least two.
    """
    acc = accepted_updates(odds, arrival, chunk)
    books = acc.select("match_id", F.col("bookmaker").alias("src")).distinct()
    # evaluation rows: one per (accepted update, source of the match)
    px = F.when(F.col("src") == F.col("bookmaker"), F.struct(*[F.col(f"odds_{o}") for o in OUTCOMES], F.col("real_time_ms")))
    rows = acc.join(books, "match_id").select("match_id", "src", "arrival", "bookmaker", "event_time_ms", px.alias("px"))
    asof = running(rows, ["match_id", "src"], "arrival", "px", "last", "_px", chunk).where(F.col("_px").isNotNull())
    aggs = [F.count(F.lit(1)).alias("n_books")]
    for o in OUTCOMES:
        aggs.append(F.min(F.struct((-F.col(f"_px.odds_{o}")).alias("neg"), F.col("src").alias("book"))).alias(f"_{o}"))
    aggs.append(F.max("_px.real_time_ms").alias("max_real_time_ms"))
    ev = asof.groupBy("match_id", "arrival", "bookmaker", "event_time_ms").agg(*aggs)
    cols = [F.col(c) for c in ("match_id", "arrival", "bookmaker", "event_time_ms", "n_books")]
    for o in OUTCOMES:
        cols += [F.col(f"_{o}.book").alias(f"best_book_{o}"), (-F.col(f"_{o}.neg")).alias(f"best_odds_{o}")]
    cols.append(F.col("max_real_time_ms"))
    out = ev.select(*cols)
    out = out.withColumn("implied_prob_sum", implied_prob_sum()).withColumn("profit_margin", profit_margin())
    return out.withColumn("is_arbitrage", (F.col("n_books") >= 2) & (F.col("profit_margin") > F.lit(eps)))


EMIT_SCHEMA = T.StructType([
    T.StructField("match_id", T.StringType()),
    T.StructField("arrival", T.LongType()),
    T.StructField("profit_margin", T.DoubleType()),
    T.StructField("implied_prob_sum", T.DoubleType()),
    T.StructField("best_book_home", T.StringType()),
    T.StructField("best_odds_home", T.DoubleType()),
    T.StructField("best_book_draw", T.StringType()),
    T.StructField("best_odds_draw", T.DoubleType()),
    T.StructField("best_book_away", T.StringType()),
    T.StructField("best_odds_away", T.DoubleType()),
])


def _emit_fold(tolerance: float):
    names = [f.name for f in EMIT_SCHEMA.fields]

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cur, memo = None, 0.0  # carried across batches: a stretch may span two
        for pdf in batches:
            margin = pdf["profit_margin"].to_numpy()
            keep = np.zeros(len(pdf), dtype=bool)
            for i, key in enumerate(zip(pdf["match_id"], pdf["stretch"])):
                if key != cur or abs(memo - margin[i]) >= tolerance:
                    cur, memo, keep[i] = key, float(margin[i]), True
            if keep.any():
                yield pdf.loc[keep, names]

    return fold


def emit_on_change(timeline: DataFrame, tolerance: float = EMIT_TOLERANCE, eps: float = EPSILON,
                   chunk: int = CHUNK) -> DataFrame:
    """Change-only emissions over ``arbitrage_timeline`` output: emit when
    an opportunity's margin differs by at least ``tolerance`` from the
    margin emitted last for the match; a vanished opportunity clears it;
    fewer than two sources leaves it unchanged.  Updates of one arrival have
    one state and emit once."""
    ship_package(timeline.sparkSession)  # the fold runs in executor Python workers
    state = timeline.where("n_books >= 2").select(*[f.name for f in EMIT_SCHEMA.fields]).dropDuplicates(["match_id", "arrival"])
    gone = (~(F.col("profit_margin") > F.lit(eps))).cast("bigint")
    state = running(state, ["match_id"], "arrival", gone, "sum", "stretch", chunk)
    ordered = (state.where(F.col("profit_margin") > F.lit(eps)).repartition("match_id", "stretch")
               .sortWithinPartitions("match_id", "stretch", "arrival"))
    return ordered.mapInPandas(_emit_fold(tolerance), EMIT_SCHEMA)

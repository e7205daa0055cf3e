"""Keyed streaming state for arbitrage detection (``transformWithState``).

One processor instance serves the keys (match ids) of one state-store
partition on an executor.  Per match it keeps one packed value: each source's
newest accepted price, and the margin emitted last.

A trigger's rows of a match are folded in any order with one entry per source:
what counts of them is, for each source, the row of the greatest (event time,
arrival, prices).  It replaces the stored one iff its event time is newer **or
equal** - the same state as applying all rows in arrival order, where older
ones are rejected (late data) - and the match is evaluated iff any source's
row did.  Then

1. with fewer than two sources nothing happens (the memo is kept);
2. no opportunity (margin <= eps) clears the memo;
3. an opportunity is emitted unless it is within ``tolerance`` of the last
   emitted margin.

The processor outputs one row per evaluated match with ``emit`` telling
whether it is an emission, so the query can count evaluated matches.
"""

from __future__ import annotations

import time
from collections.abc import Iterable, Sequence

from pyspark.sql import Row
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from pricefold.schema import EMIT_TOLERANCE, EPSILON, METHOD_STREAM

PRICE = ("event_time_ms", "odds_home", "odds_draw", "odds_away", "real_time_ms")

EVAL_SCHEMA = T.StructType([
    T.StructField("emit", T.BooleanType()),
    T.StructField("method", T.StringType()),
    T.StructField("match_id", T.StringType()),
    T.StructField("n_books", T.LongType()),
    T.StructField("best_book_home", T.StringType()),
    T.StructField("best_odds_home", T.DoubleType()),
    T.StructField("best_book_draw", T.StringType()),
    T.StructField("best_odds_draw", T.DoubleType()),
    T.StructField("best_book_away", T.StringType()),
    T.StructField("best_odds_away", T.DoubleType()),
    T.StructField("profit_margin", T.DoubleType()),
    T.StructField("implied_prob_sum", T.DoubleType()),
    T.StructField("detected_at_ms", T.LongType()),
    T.StructField("max_real_time_ms", T.LongType()),
    T.StructField("e2e_latency_ms", T.LongType()),
])


STATE_SCHEMA = T.StructType([
    T.StructField("books", T.ArrayType(T.StringType())),
    T.StructField("event_time_ms", T.ArrayType(T.LongType())),
    T.StructField("odds_home", T.ArrayType(T.DoubleType())),
    T.StructField("odds_draw", T.ArrayType(T.DoubleType())),
    T.StructField("odds_away", T.ArrayType(T.DoubleType())),
    T.StructField("real_time_ms", T.ArrayType(T.LongType())),
    T.StructField("memo", T.DoubleType()),
])


def newest(rows: Iterable, arrival: Sequence[str]) -> dict[str, tuple]:
    """Per source the price of its greatest row by (event time, arrival,
    prices); one pass, one entry per source."""
    best: dict[str, tuple] = {}
    for r in rows:
        rank = (r["event_time_ms"], *(r[c] for c in arrival), r["odds_home"], r["odds_draw"], r["odds_away"])
        held = best.get(r["bookmaker"])
        if held is None or rank > held[0]:
            best[r["bookmaker"]] = (rank, tuple(r[c] for c in PRICE))
    return {book: price for book, (_, price) in best.items()}


def merged(stored: dict[str, tuple], fresh: dict[str, tuple]) -> dict[str, tuple] | None:
    """The state after a trigger; None if no row was accepted."""
    taken = {b: p for b, p in fresh.items() if b not in stored or p[0] >= stored[b][0]}
    return {**stored, **taken} if taken else None


def evaluate(books: dict[str, tuple], eps: float = EPSILON) -> dict | None:
    """Best price per outcome (highest, ties to the smallest source name),
    implied probability sum and margin; None with fewer than two sources."""
    if len(books) < 2:
        return None
    names = sorted(books)
    res = {"n_books": len(names)}
    for i, o in ((1, "home"), (2, "draw"), (3, "away")):
        best = names[0]
        for b in names[1:]:
            if books[b][i] > books[best][i]:
                best = b
        res[f"best_book_{o}"] = best
        res[f"best_odds_{o}"] = books[best][i]
    s = (1.0 / res["best_odds_home"]) + (1.0 / res["best_odds_draw"]) + (1.0 / res["best_odds_away"])
    res["implied_prob_sum"] = s
    res["profit_margin"] = 1.0 - s
    res["max_real_time_ms"] = max(v[4] for v in books.values())
    return res


class OddsRowProcessor(StatefulProcessor):
    """Latest price per source, change-only arbitrage emission per match: one
    read and one write of the packed state per evaluated match and trigger.
    ``now_ms`` fixes the clock, for replays and tests.  With ``expire`` (event-time
    mode) a match leaves the state once the watermark reaches its newest event
    time.  Initial state, one row per match with the array ``prices``, counts as
    a trigger that was judged before."""

    def __init__(self, arrival: Sequence[str] = ("real_time_ms",), tolerance: float = EMIT_TOLERANCE,
                 eps: float = EPSILON, state_ttl_ms: int | None = None, method: str = METHOD_STREAM,
                 now_ms: int | None = None, expire: bool = False):
        self.expire = expire
        self.arrival = list(arrival)
        self.tolerance = tolerance
        self.eps = eps
        self.ttl = state_ttl_ms
        self.method = method
        self.now_ms = now_ms
        self.cols = [c.name for c in EVAL_SCHEMA.fields]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("match", STATE_SCHEMA, self.ttl)

    def _store(self, books: dict[str, tuple], memo: float | None, timers) -> None:
        last = max(p[0] for p in books.values())
        if self.expire and last <= timers.getCurrentWatermarkInMs():
            self.state.clear()
            return
        names = list(books)
        self.state.update((names, *(list(column) for column in zip(*(books[b] for b in names))), memo))
        if self.expire:
            self.handle.registerTimer(last)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        books = {p["bookmaker"]: tuple(p[c] for c in PRICE) for p in initialState["prices"]}
        found = evaluate(books, self.eps)
        self._store(books, found["profit_margin"] if found and found["profit_margin"] > self.eps else None, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        held = self.state.get()
        if held is not None and max(held[1]) <= timerValues.getCurrentWatermarkInMs():
            self.state.clear()  # else a later timer stands
        return iter([])

    def handleInputRows(self, key, rows, timerValues):
        held = self.state.get()
        stored, memo = {}, None
        if held is not None:
            books, *prices, memo = held
            stored = {b: tuple(p) for b, *p in zip(books, *prices)}
        books = merged(stored, newest(rows, self.arrival))
        if books is None:
            return
        now = int(time.time() * 1000) if self.now_ms is None else self.now_ms
        found = evaluate(books, self.eps)
        emit = False
        if found is not None:
            margin = found["profit_margin"]
            if margin <= self.eps:
                memo = None
            elif memo is None or abs(memo - margin) >= self.tolerance:
                emit, memo = True, margin
            found |= {"detected_at_ms": now, "e2e_latency_ms": now - found["max_real_time_ms"]}
        self._store(books, memo, timerValues)
        row = {"emit": emit, "method": self.method, "match_id": key[0], **(found or {})}
        yield Row(**{c: row.get(c) for c in self.cols})

    def close(self) -> None:
        pass

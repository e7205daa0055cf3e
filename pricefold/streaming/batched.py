"""Change-only emission with the state of many matches folded at once.

Matches are dealt to ``buckets``; a bucket's state is one value, the Arrow
record batch of the newest price per (match, source) and the margin emitted
last per match.  A trigger's rows are first reduced to the newest per (match,
source) within each Arrow batch, on the map side; then each touched bucket is
merged, evaluated and written back with array operations, under the rules
of ``OddsRowProcessor`` (``streaming.processor``).

A bucket is read and written whole, so ``buckets`` should follow the number of
live matches (some hundred to some ten thousand matches a bucket); like the number of shuffle
partitions it is fixed once a checkpoint exists.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from pricefold.schema import EMIT_TOLERANCE, EPSILON, METHOD_STREAM
from pricefold.streaming.processor import EVAL_SCHEMA

#: Buckets of a query that names none: thousands of matches each when there are tens of millions.
BUCKETS = 1024
OUTCOMES = ("home", "draw", "away")
_NUMBERS = ("event_time_ms", "odds_home", "odds_draw", "odds_away", "real_time_ms")
_STATE = pa.schema([("match_id", pa.string()), ("bookmaker", pa.string()), ("event_time_ms", pa.int64()),
                    ("odds_home", pa.float64()), ("odds_draw", pa.float64()), ("odds_away", pa.float64()),
                    ("real_time_ms", pa.int64()), ("memo", pa.float64())])
BLOB = T.StructType([T.StructField("prices", T.BinaryType())])


def _last_of_each(*keys: np.ndarray) -> np.ndarray:
    """Whether a sorted row is the last with its values of ``keys``."""
    out = np.ones(len(keys[0]), bool)
    if len(out) > 1:
        out[:-1] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return out


def newest_per_source(columns: dict[str, np.ndarray], arrival: Sequence[str]) -> np.ndarray:
    """Positions of the newest row of every (match, source): greatest event time,
    then arrival, then prices."""
    match = np.unique(columns["match_id"], return_inverse=True)[1]
    book = np.unique(columns["bookmaker"], return_inverse=True)[1]
    rank = [columns[c] for c in ("odds_away", "odds_draw", "odds_home", *reversed(arrival), "event_time_ms")]
    order = np.lexsort((*rank, book, match))
    return order[_last_of_each(match[order], book[order])]


def reduce_batches(arrival: Sequence[str]):
    """Arrow batches -> their newest row per (match, source)."""

    def run(batches):
        for batch in batches:
            if batch.num_rows > 1:
                columns = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in batch.schema.names}
                for n in ("match_id", "bookmaker"):  # codes sort faster than strings
                    columns[n] = batch.column(n).dictionary_encode().indices.to_numpy()
                batch = batch.take(pa.array(np.sort(newest_per_source(columns, arrival))))
            yield batch

    return run


class Prices:
    """Newest prices of a bucket's matches as arrays, sorted by (match, source)."""

    def __init__(self, table: dict[str, np.ndarray]):
        self.table = table

    @classmethod
    def load(cls, blob: bytes | None) -> Prices:
        if blob is None:
            return cls({f.name: np.zeros(0, object if f.type == pa.string() else f.type.to_pandas_dtype()) for f in _STATE})
        batch = pa.ipc.read_record_batch(pa.py_buffer(blob), _STATE)
        return cls({n: batch.column(n).to_numpy(zero_copy_only=False) for n in _STATE.names})

    def dump(self) -> bytes:
        arrays = [pa.array(self.table[f.name], f.type, from_pandas=False) for f in _STATE]
        return pa.RecordBatch.from_arrays(arrays, schema=_STATE).serialize().to_pybytes()

    def __len__(self) -> int:
        return len(self.table["match_id"])

    def live(self, watermark: int) -> Prices:
        """Without the matches whose newest event time the watermark has reached."""
        if not len(self):
            return self
        start, group = self._groups()
        keep = (np.maximum.reduceat(self.table["event_time_ms"], start) > watermark)[group]
        return Prices({n: v[keep] for n, v in self.table.items()})

    def next_end(self) -> int | None:
        """The event time at which the first match ends."""
        if not len(self):
            return None
        return int(np.maximum.reduceat(self.table["event_time_ms"], self._groups()[0]).min())

    def _groups(self) -> tuple[np.ndarray, np.ndarray]:
        new = np.ones(len(self), bool)
        new[1:] = self.table["match_id"][1:] != self.table["match_id"][:-1]
        return np.flatnonzero(new), np.cumsum(new) - 1

    def merge(self, rows: dict[str, np.ndarray], arrival: Sequence[str]) -> tuple[Prices, np.ndarray]:
        """State after a trigger's rows, and for each of its rows whether it is new:
        an update replaces the stored one iff its event time is newer or equal."""
        n, m = len(self), len(rows["match_id"])
        both = {c: np.concatenate([self.table[c], rows[c]]) for c in ("match_id", "bookmaker", *_NUMBERS)}
        fresh = np.concatenate([np.zeros(n, bool), np.ones(m, bool)])
        memo = np.concatenate([self.table["memo"], np.full(m, np.nan)])
        match = pd.factorize(both["match_id"], sort=True)[0]
        book = pd.factorize(both["bookmaker"], sort=True)[0]
        rank = [np.concatenate([np.zeros(n, rows[c].dtype), rows[c]]) for c in reversed(arrival)]
        order = np.lexsort((both["odds_away"], both["odds_draw"], both["odds_home"], *rank, fresh, both["event_time_ms"], book, match))
        order = order[_last_of_each(match[order], book[order])]
        out = {c: v[order] for c, v in both.items()}
        held = np.full(int(match.max()) + 1 if len(match) else 0, np.nan)
        held[match[:n]] = memo[:n]  # a match's rows share their memo
        out["memo"] = held[match[order]]
        return Prices(out), fresh[order]

    def evaluate(self, new: np.ndarray, eps: float, tolerance: float) -> dict[str, np.ndarray]:
        """Best prices and margins of the matches with new rows; updates their
        memo.  ``emit`` tells the emissions; other columns are undefined where
        ``n_books`` is 1."""
        start, group = self._groups()
        touched = np.logical_or.reduceat(new, start) if len(start) else np.zeros(0, bool)
        books = np.diff([*start, len(self)])
        out = {"match_id": self.table["match_id"][start], "n_books": books}
        total = np.zeros(len(start))
        for o in OUTCOMES:
            price = self.table[f"odds_{o}"]
            top = np.maximum.reduceat(price, start) if len(start) else price
            at = np.flatnonzero(price == top[group])  # the first of a match: the smallest source name
            at = at[np.unique(group[at], return_index=True)[1]]
            out[f"best_book_{o}"], out[f"best_odds_{o}"] = self.table["bookmaker"][at], top
            total = total + 1.0 / top
        margin = 1.0 - total
        memo = self.table["memo"][start]
        judged = touched & (books >= 2)
        found = judged & (margin > eps)
        out["emit"] = found & (np.isnan(memo) | (np.abs(memo - margin) >= tolerance))
        memo = np.where(judged & ~found, np.nan, np.where(out["emit"], margin, memo))
        self.table["memo"] = memo[group]
        out |= {"implied_prob_sum": total, "profit_margin": margin,
                "max_real_time_ms": np.maximum.reduceat(self.table["real_time_ms"], start) if len(start) else start}
        return {c: v[touched] for c, v in out.items()}


def _columns(frames, names: Sequence[str]) -> dict[str, np.ndarray] | None:
    held = [f for f in frames if len(f)]
    if not held:
        return None
    whole = pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]
    return {n: whole[n].to_numpy() for n in names}


class BucketProcessor(StatefulProcessor):
    """``transformWithStateInPandas`` over buckets.  With ``expire`` (event-time
    mode) a match leaves the state once the watermark reaches its newest event
    time; ``now_ms`` fixes the clock."""

    def __init__(self, arrival: Sequence[str], tolerance: float = EMIT_TOLERANCE, eps: float = EPSILON,
                 method: str = METHOD_STREAM, now_ms: int | None = None, expire: bool = False):
        self.arrival, self.tolerance, self.eps, self.method, self.now_ms, self.expire = list(arrival), tolerance, eps, method, now_ms, expire

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("bucket", BLOB)

    def _load(self) -> Prices:
        held = self.state.get()
        return Prices.load(None if held is None else bytes(held[0]))

    def _store(self, prices: Prices, timers) -> None:
        if self.expire:
            prices = prices.live(timers.getCurrentWatermarkInMs())
        if not len(prices):
            self.state.clear()
            return
        self.state.update((prices.dump(),))
        if self.expire:
            self.handle.registerTimer(prices.next_end())

    def handleInitialState(self, key, initialState, timerValues) -> None:
        rows = _columns([initialState], ["match_id", "bookmaker", *_NUMBERS])
        if rows is not None:
            prices, _ = self._load().merge(rows, ["real_time_ms"])
            prices.table["memo"] = np.full(len(prices), np.nan)  # of a bucket that comes in parts, only the whole counts
            prices.evaluate(np.ones(len(prices), bool), self.eps, self.tolerance)
            self._store(prices, timerValues)

    def handleInputRows(self, key, rows, timerValues):
        columns = _columns(rows, dict.fromkeys(["match_id", "bookmaker", *_NUMBERS, *self.arrival]))
        if columns is None:
            return
        prices, new = self._load().merge(columns, self.arrival)
        if not new.any():
            return
        found = prices.evaluate(new, self.eps, self.tolerance)
        self._store(prices, timerValues)
        now = int(time.time() * 1000) if self.now_ms is None else self.now_ms
        out = pd.DataFrame({**found, "method": self.method, "detected_at_ms": now,
                            "e2e_latency_ms": now - found["max_real_time_ms"]})[EVAL_SCHEMA.names]
        alone = (out["n_books"] < 2).to_numpy()
        if alone.any():  # nothing is known of a match with one source
            for c in EVAL_SCHEMA.names:
                if c not in ("emit", "method", "match_id"):
                    column = out[c].astype("Int64") if out[c].dtype.kind == "i" else out[c]
                    out[c] = column.mask(alone)
        yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self._store(self._load(), timerValues)
        return iter([])

    def close(self) -> None:
        pass


MATCH_STATE = "match_id string, books array<string>, max_event_time_ms long, memo double"


def unpack_matches(batches):
    """Arrow batches of bucket values -> a row per match."""
    for batch in batches:
        for blob in batch.column(0):
            prices = Prices.load(blob.as_py())
            if len(prices):
                start, _ = prices._groups()
                memo = prices.table["memo"][start]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(prices.table["match_id"][start], pa.string()),
                     pa.ListArray.from_arrays(pa.array([*start, len(prices)], pa.int32()), pa.array(prices.table["bookmaker"], pa.string())),
                     pa.array(np.maximum.reduceat(prices.table["event_time_ms"], start)), pa.array(memo, mask=np.isnan(memo))],
                    ["match_id", "books", "max_event_time_ms", "memo"])


def bucketed(odds: DataFrame, arrival: Sequence[str], buckets: int) -> DataFrame:
    """``odds`` reduced within Arrow batches, with the bucket of every row."""
    from pyspark.sql import functions as F
    small = odds.mapInArrow(reduce_batches(arrival), odds.schema)
    return small.withColumn("bucket", F.pmod(F.xxhash64("match_id"), F.lit(int(buckets))).cast("int"))

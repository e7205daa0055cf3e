"""Best prices per match with one shuffle of compressed blocks.

Matches are dealt to buckets by hash.  A task gathers Arrow batches up to
``rows`` rows, keeps the newest row per (match, source) of them, and ships one
compressed Arrow block per bucket; Spark shuffles and groups the blocks by bucket, and
each bucket is folded by the arrays that also hold a stream's state
(``streaming.batched``).  A row ships in some 15 bytes instead of 90, and
what Spark sorts are blocks.  A bucket's newest rows are held at once, so
``buckets`` should follow the number of matches.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricefold.session import ship_package

BUCKETS = 2048
ROWS = 1 << 20
_BEST = ("match_id string, n_books long, best_book_home string, best_odds_home double, best_book_draw string, best_odds_draw double, "
         "best_book_away string, best_odds_away double, max_event_time_ms long, max_real_time_ms long")


def _pack(rows: int):
    def blocks(held: list[pa.RecordBatch]):
        from pricefold.streaming.batched import newest_per_source
        table = pa.Table.from_batches(held).combine_chunks()
        columns = {n: table.column(n).combine_chunks() for n in table.schema.names if n != "bucket"}
        arrays = {n: (c.dictionary_encode().indices if n in ("match_id", "bookmaker") else c).to_numpy(zero_copy_only=False)
                  for n, c in columns.items()}
        keep = newest_per_source(arrays, ["real_time_ms"])
        bucket = table.column("bucket").to_numpy()[keep]
        order = np.argsort(bucket, kind="stable")  # within a bucket, rows of a match stay together
        keep, bucket = keep[order], bucket[order]
        data = table.drop_columns(["bucket"]).take(pa.array(keep)).combine_chunks().to_batches()[0]
        at = [*np.flatnonzero(np.diff(bucket, prepend=-1)).tolist(), len(bucket)]
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for lo in range(0, len(at) - 1, 256):
            part = list(zip(at, at[1:]))[lo : lo + 256]
            blobs = []
            for a, b in part:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, data.schema, options=options) as out:
                    out.write_batch(data.slice(a, b - a))
                blobs.append(sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays([pa.array([int(bucket[a]) for a, _ in part], pa.int32()), pa.array(blobs, pa.binary())],
                                             ["bucket", "block"])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= rows:
                yield from blocks(held)
                held, n = [], 0
        if n:
            yield from blocks(held)

    return run


def _fold(table: pa.Table) -> pa.Table:
    """One bucket's blocks -> the best prices of its matches."""
    from pricefold.streaming.batched import OUTCOMES, Prices

    prices, held, n = Prices.load(None), [], 0

    def merge():
        rows = pa.concat_tables(held).combine_chunks()
        return prices.merge({c: rows.column(c).to_numpy() for c in rows.column_names}, ["real_time_ms"])[0]

    for block in table.column("block"):
        held.append(pa.ipc.open_stream(block.as_buffer()).read_all())
        n += held[-1].num_rows
        if n > len(prices) + ROWS:  # a match with many updates does not gather them
            prices, held, n = merge(), [], 0
    if held:
        prices = merge()
    start, _ = prices._groups()
    found = prices.evaluate(np.ones(len(prices), bool), 0.0, 0.0)
    columns = {"match_id": found["match_id"], "n_books": found["n_books"]}
    for o in OUTCOMES:
        columns |= {f"best_book_{o}": found[f"best_book_{o}"], f"best_odds_{o}": found[f"best_odds_{o}"]}
    columns |= {"max_event_time_ms": np.maximum.reduceat(prices.table["event_time_ms"], start), "max_real_time_ms": found["max_real_time_ms"]}
    return pa.table({n: pa.array(v) for n, v in columns.items()})


def packed_best_prices(odds: DataFrame, buckets: int = BUCKETS, rows: int = ROWS) -> DataFrame:
    """``best_prices(latest_odds(odds))`` of the detection columns of valid updates."""
    ship_package(odds.sparkSession)
    dealt = odds.withColumn("bucket", F.pmod(F.xxhash64("match_id"), F.lit(int(buckets))).cast("int"))
    blocks = dealt.mapInArrow(_pack(int(rows)), "bucket int, block binary")
    return blocks.groupBy("bucket").applyInArrow(_fold, _BEST)

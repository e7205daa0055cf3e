"""Skew-safe running aggregates (prefix scans) over an ordered key.

A plain running window ``agg(x) over (partition by k order by t)`` hands a
key's whole history to one task.  ``running`` computes the same values in
two levels:

1. rows are cut into chunks of ``t`` (``floor(t / width)``); within a
   (key, chunk) the running value is an ordinary window, so one task sees at
   most one chunk of one key;
2. each chunk's total comes from the same window partition (no second
   shuffle of the rows), and the carry into a chunk is a running window
   over the chunk totals of its key - one row per chunk, not per update;
3. row value = combine(carry of earlier chunks, running value in its chunk).

The chunks of a hot key land in different tasks (the shuffle is on key and
chunk).  ``width`` should be chosen so that a chunk holds a bounded number of
rows (e.g. a range of offsets, or of milliseconds at the peak rate).
Supported: ``max``, ``sum`` and ``last`` (last non-null value, any type).
``t`` is an integer; rows with equal ``t`` are peers and get the same value
(inclusive: of all rows up to ``t``, else of all before it).  ``last`` needs at
most one non-null value per key and ``t`` to be deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _chunk(order: str, width: int) -> Column:
    """Never null (rows without an order come first), so that the join of the
    carries adds no filter and both its sides share one shuffle."""
    return F.coalesce(F.floor(F.col(order) / F.lit(int(width))).cast("bigint"), F.lit(-(1 << 63)))


def running(df: DataFrame, keys: Sequence[str], order: str, value: str | Column, how: str, out: str,
            width: int, inclusive: bool = True) -> DataFrame:
    """Add column ``out`` = ``how`` of ``value`` over the rows of the same
    ``keys`` ordered before (``inclusive``: up to and including) this row."""
    names = [c for c in df.columns if c != out]
    # one struct for the keys: equal in windows and in the join also where a field is NULL
    group, keys = F.struct(*keys), ["_scan_k"]
    v = value if isinstance(value, Column) else F.col(value)
    d = df.withColumn("_scan_v", v).withColumn("_scan_c", _chunk(order, width)).withColumn("_scan_k", group)
    base = Window.partitionBy(*keys, "_scan_c").orderBy(order)
    w_in = base.rangeBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    w_all = base.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w_ch = Window.partitionBy(*keys).orderBy("_scan_c").rowsBetween(Window.unboundedPreceding, -1)
    if how == "max":
        inner, total = F.max("_scan_v").over(w_in), F.max("_scan_v").over(w_all)
        carry = F.max("_scan_t").over(w_ch)
        combine = F.greatest(F.col("_scan_carry"), F.col("_scan_in"))
    elif how == "sum":
        inner, total = F.sum("_scan_v").over(w_in), F.sum("_scan_v").over(w_all)
        carry = F.sum("_scan_t").over(w_ch)
        combine = F.when(F.col("_scan_carry").isNull() & F.col("_scan_in").isNull(), F.lit(None)).otherwise(
            F.coalesce(F.col("_scan_carry"), F.lit(0)) + F.coalesce(F.col("_scan_in"), F.lit(0)))
    elif how == "last":
        inner = F.last("_scan_v", ignorenulls=True).over(w_in)
        total = F.last("_scan_v", ignorenulls=True).over(w_all)
        carry = F.last("_scan_t", ignorenulls=True).over(w_ch)
        combine = F.coalesce(F.col("_scan_in"), F.col("_scan_carry"))
    else:
        raise ValueError(f"unsupported running aggregate {how!r}")
    # one shuffle of the rows (by key and chunk); both windows share it
    within = d.withColumn("_scan_in", inner).withColumn("_scan_t", total)
    # one row per chunk: the carry into each chunk from the earlier ones
    carries = within.select(*keys, "_scan_c", "_scan_t").dropDuplicates(keys + ["_scan_c"]) \
        .select(*keys, "_scan_c", carry.alias("_scan_carry"))
    return (within.join(carries, keys + ["_scan_c"], "left")
            .select(*names, combine.alias(out)))

"""Records of CSV files that are read in splits, quoted line ends included.

A quoted cell may hold line ends, so whether a line begins a record depends on
everything before it in the file.  Two passes over the lines settle that without
reading a file in one task:

1. each split tells in which state (inside quotes or not) it ends when it
   begins outside and when it begins inside: one row per split;
2. these are composed along each file by a running window over the split rows,
   and every split, now knowing its state, cuts its lines into records.  What is
   open at its end, and what it continues from before, leaves as a fragment;
   fragments (at most two per split) are put together by file and order.

Lines without a quote outside of quotes pass as they are, with no Python per
line.  Quote rules: a cell is quoted if its first character is a quote, a
doubled quote stands for one, and text after the closing quote belongs to the
cell.  Lines end with LF or CRLF.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricefold.functions.text import once
from pricefold.session import ship_package

#: A record longer than this is rejected, not held: an unclosed quote may swallow a file.
MAX_RECORD = 64 << 20
_BOM = b"\xef\xbb\xbf"


def ends_inside(line: bytes, inside: bool) -> bool:
    """Whether a line ends within quotes."""
    at = 0
    while True:
        if inside:
            at = line.find(b'"', at)
            if at < 0:
                return True
            if line[at + 1 : at + 2] == b'"':
                at += 2
                continue
            inside = False
            at += 1
        elif line[at : at + 1] == b'"':  # at the start of a cell
            inside, at = True, at + 1
            continue
        at = line.find(b",", at)
        if at < 0:
            return False
        at += 1


def cells_of(record: bytes) -> list[str]:
    """Cells of one whole record."""
    out, at = [], 0
    while True:
        cell = b""
        if record[at : at + 1] == b'"':
            at += 1
            while True:
                end = record.find(b'"', at)
                if end < 0:
                    end = len(record)
                cell += record[at:end]
                at = end + 1
                if record[at : at + 1] != b'"':
                    break
                cell += b'"'
                at += 1
        end = record.find(b",", at)
        cell += record[at : end if end >= 0 else len(record)]
        out.append(cell.decode("utf-8", "replace"))
        if end < 0:
            return out
        at = end + 1


def _splits(batch: pa.RecordBatch):
    """Runs of lines of one split within a batch: file, block, from, to."""
    n = batch.num_rows
    block = batch.column("block").to_numpy(zero_copy_only=False)
    file = batch.column("file")
    same = np.ones(n, bool)
    if n > 1:
        same[1:] = (block[1:] == block[:-1]) & pc.equal(file.slice(1), file.slice(0, n - 1)).to_numpy(zero_copy_only=False)
    same[:1] = False
    at = [*np.flatnonzero(~same).tolist(), n]
    for a, b in zip(at, at[1:]):
        yield file[a].as_py(), int(block[a]), a, b


def _first(line: bytes, block: int, new: bool) -> bytes:
    return line[3:] if new and not block and line.startswith(_BOM) else line


def _ends(batches):
    """Per split its end states for both start states (lines without a quote come as nulls)."""
    key, after = None, [False, True]
    for batch in batches:
        if not batch.num_rows:
            continue
        out, lines = [], batch.column("line")
        quoted = np.flatnonzero(lines.is_valid().to_numpy(zero_copy_only=False))
        for file, block, a, b in _splits(batch):
            new = key != (file, block)
            if new:
                if key is not None:
                    out.append((*key, *after))
                key, after = (file, block), [False, True]
            for i in quoted[np.searchsorted(quoted, a) : np.searchsorted(quoted, b)].tolist():
                line = _first(lines[i].as_py(), block, new and i == a)
                after = [ends_inside(line, s) for s in after]
        yield _rows(out, _ENDS)
    if key is not None:
        yield _rows([(*key, *after)], _ENDS)


_ENDS = [("file", pa.string()), ("block", pa.int64()), ("out_end", pa.bool_()), ("in_end", pa.bool_())]
_CUT = [("file", pa.string()), ("block", pa.int64()), ("start", pa.bool_()), ("done", pa.bool_()), ("head", pa.bool_()),
        ("long", pa.bool_()), ("line", pa.binary()), ("cells", pa.list_(pa.string()))]
_CUT_DDL = "file string, block long, start boolean, done boolean, head boolean, long boolean, line binary, cells array<string>"


def _rows(rows: list[tuple], kinds) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(kinds)], [n for n, _ in kinds])


class _Cutter:
    """Records of one split after another; ``open`` holds the lines of a record
    that has not ended."""

    def __init__(self, most: int):
        self.most, self.key, self.open, self.size, self.long = most, None, None, 0, False
        self.out: list[tuple] = []

    def begin(self, file: str, block: int, inside: bool) -> None:
        self.finish()
        self.key = (file, block)
        self.starts = not inside  # whether the open record starts in this split
        self.head = block == 0    # whether the next record is the file's first
        if inside:
            self.open = []

    def add(self, lines: list[bytes]) -> None:
        self.size += sum(map(len, lines)) + len(lines)
        self.long = self.long or self.size > self.most
        if self.long:
            self.open = []
        else:
            self.open.extend(lines)

    def line(self, line: bytes) -> None:
        """The next line of the split."""
        was = self.open is not None
        if not was:
            if not line.strip(b" \t\r"):
                return  # blank
            self.open = []
        self.add([line])
        if not ends_inside(line, was):
            self.close(True)

    def close(self, done: bool) -> None:
        text = None if self.long else b"\n".join(self.open)
        whole = self.starts and done and not self.long
        self.out.append((*self.key, self.starts, done, self.head and self.starts, self.long, None if whole else text,
                         cells_of(text.removesuffix(b"\r")) if whole else None))
        if self.starts:
            self.head = False
        self.open, self.size, self.long, self.starts = None, 0, False, True

    def finish(self) -> None:
        if self.key is not None and self.open is not None:
            self.close(False)
        self.key = None


def _cut(most: int):
    def run(batches):
        cutter = _Cutter(most)
        for batch in batches:
            if not batch.num_rows:
                continue
            lines = batch.column("line")
            has = pc.match_substring(lines, '"').to_numpy(zero_copy_only=False)
            inside = batch.column("inside")
            plain = []
            for file, block, a, b in _splits(batch):
                new = cutter.key != (file, block)
                if new:
                    cutter.begin(file, block, inside[a].as_py())
                at = a
                if new and not block:  # the file's first line may have a mark
                    cutter.line(_first(lines[a].as_py(), block, True))
                    at = a + 1
                for q in [*(at + np.flatnonzero(has[at:b])).tolist(), b]:
                    if q > at:  # lines without quotes
                        if cutter.open is not None:
                            cutter.add([x.as_py() for x in lines.slice(at, q - at)])
                        else:
                            while cutter.head and at < q:  # the header, after blank lines perhaps
                                cutter.line(lines[at].as_py())
                                at += 1
                            plain.append((at, q))
                    if q < b:
                        cutter.line(lines[q].as_py())
                    at = q + 1
            take = np.concatenate([np.arange(a, b) for a, b in plain]) if plain else np.zeros(0, np.int64)
            n = len(take)
            yes, no = pa.array(np.ones(n, bool)), pa.array(np.zeros(n, bool))
            picked = pa.array(take)
            yield pa.RecordBatch.from_arrays(
                [batch.column("file").take(picked), batch.column("block").take(picked), yes, yes, no, no, lines.take(picked),
                 pa.nulls(n, pa.list_(pa.string()))], [c for c, _ in _CUT])
            yield _rows(cutter.out, _CUT)
            cutter.out = []
        cutter.finish()
        yield _rows(cutter.out, _CUT)

    return run


def _split_cells(batches):
    for batch in batches:
        cells = [None if x is None else cells_of(x.removesuffix(b"\r")) for x in batch.column("line").to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.list_(pa.string()))], [*batch.schema.names, "cells"])


def csv_records(spark: SparkSession, paths: list[str], max_record: int = MAX_RECORD) -> DataFrame:
    """``file`` (URI), ``header`` (whether it is the file's first record), ``cells``
    (array of strings) and ``reason``: null, or why the record is no row:
    ``unclosed_quote`` (a quote opens and the file ends) or ``too_long`` (above
    ``max_record`` bytes; its cells are null).

    Blank lines are no records.  Bytes that are not UTF-8 become replacement
    characters.  A byte-order mark is removed.
    """
    ship_package(spark)
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("value").cast("binary").alias("line"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"))
    quoted = F.when(F.contains("line", F.lit(b'"')), F.col("line")).alias("line")
    ends = lines.select(quoted, "file", "block").mapInArrow(_ends, "file string, block long, out_end boolean, in_end boolean")

    # state before each split: that of the last split with one end state for both starts, flipped by the swaps since
    so_far = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    swap = (F.col("out_end") & ~F.col("in_end")).cast("int")
    known = F.when(F.col("out_end") == F.col("in_end"), F.struct(F.col("out_end").alias("end"), F.col("swaps").alias("swaps")))
    starts = ends.withColumn("swaps", F.sum(swap).over(upto)).select(
        "file", "block", F.last(known, ignorenulls=True).over(so_far).alias("fixed"),
        F.coalesce(F.sum(swap).over(so_far), F.lit(0)).alias("before"))
    flips = F.col("before") - F.coalesce(F.col("fixed.swaps"), F.lit(0))
    starts = starts.select("file", "block", (F.coalesce(F.col("fixed.end"), F.lit(False)) != (flips % 2 == 1)).alias("inside"))

    # one row per split of the files listed: no more than the listing that planned the scan
    cut = lines.join(F.broadcast(starts), ["file", "block"]).select("line", "file", "block", "inside").mapInArrow(
        _cut(max_record), _CUT_DDL)
    whole = cut.where("start and done and not long")
    text = F.regexp_replace(F.make_valid_utf8(F.col("line").cast("string")), "\r$", "")
    # one pass for both: lines the cutter left whole are split here
    records = whole.select("file", "head", "cells", once(F.when(F.col("cells").isNull(), text)).alias("text"))
    records = records.where(F.col("cells").isNotNull() | (F.trim("text", F.lit(" \t")) != ""))
    ready = records.select("file", "head", once(F.coalesce("cells", F.split("text", ",", -1))).alias("cells")).withColumn(
        "reason", F.lit(None).cast("string"))

    parts = cut.where("not (start and done) or long").select("file", "block", "start", "done", "head", "long", "line")
    # a split's fragments: what it continues, then over-long records, then what it leaves open
    number = Window.partitionBy("file").orderBy("block", "start", F.desc("done")).rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.withColumn("record", F.sum(F.col("start").cast("int")).over(number))
    one = Window.partitionBy("file", "record")
    parts = parts.withColumn("long", F.max("long").over(one) | (F.sum(F.octet_length("line") + 1).over(one) > max_record))
    parts = parts.withColumn("line", F.when(~F.col("long"), F.col("line")))  # nothing long is gathered
    gathered = F.transform(F.array_sort(F.collect_list(F.struct("block", "line"))), lambda p: p["line"])
    joined = parts.groupBy("file", "record").agg(
        F.max("head").alias("head"), F.max("done").alias("closed"), F.max("long").alias("long"),
        F.aggregate(gathered, F.lit(None).cast("binary"),
                    lambda a, x: F.when(a.isNull(), x).otherwise(F.concat(a, F.lit(b"\n"), x))).alias("line"))
    reason = F.when(F.col("long"), F.lit("too_long")).when(~F.col("closed"), F.lit("unclosed_quote"))
    joined = joined.select("file", "head", reason.alias("reason"), "line").mapInArrow(
        _split_cells, "file string, head boolean, reason string, line binary, cells array<string>")
    return ready.unionByName(joined.drop("line")).select("file", F.col("head").alias("header"), "cells", "reason")

"""Structured Streaming detection.

``detect_stream`` is the stateful path (``OddsRowProcessor`` in the executors'
state store, keyed by match or by bucket).  ``latest_prices_stream`` is the native
path (a streaming aggregation per (match, source), no Python): its state holds
the newest price of every source, from which ``current_prices`` and the batch
rule give best prices and opportunities at any time.  ``detect_window_stream``
judges event-time windows natively.  All read any streaming DataFrame with
the odds columns: a message log after ``decode_events``, or a file source.

Trigger metrics come from named ``observe`` metrics in each
``StreamingQueryProgress`` (rows decoded, valid rows, evaluated matches,
emissions) plus the trigger duration; ``MetricsListener`` turns them into
metric records.  No data row goes through the driver.
"""

from __future__ import annotations

import json
import uuid
from collections import deque
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from pricefold.operators.detect import DETECT_COLUMNS, best_prices, latest_odds, opportunities, valid_odds
from pricefold.session import ROCKSDB_PROVIDER, ship_package
from pricefold.sinks.writers import write_file
from pricefold.schema import EMIT_TOLERANCE, EPSILON, ODDS_SCHEMA, STREAM_OPP_COLUMNS
from pricefold.streaming.processor import EVAL_SCHEMA, PRICE, OddsRowProcessor

INPUT_METRICS = "pricefold_input"
VALID_METRICS = "pricefold_valid"
EVAL_METRICS = "pricefold_eval"


def detect_stream(odds: DataFrame, arrival: Sequence[str] = ("real_time_ms",), tolerance: float = EMIT_TOLERANCE,
                  eps: float = EPSILON, state_ttl_ms: int | None = None, with_evaluations: bool = False,
                  now_ms: int | None = None, buckets: int | None = None, keep_ms: int | None = None,
                  history: DataFrame | None = None) -> DataFrame:
    """Change-only arbitrage emissions of a stream of odds updates.

    ``arrival``: columns giving the arrival order inside a trigger (e.g.
    ``("partition", "offset")`` for a message log, whose producer keys by
    match so one match stays in one partition).  Updates that
    ``valid_odds`` rejects, such as those without a time, are dropped.
    ``now_ms`` fixes the clock.

    State: one value per bucket of matches, folded by array operations
    (``streaming.batched``).  ``buckets`` (``BUCKETS`` unless given) is fixed once
    a checkpoint exists.  With ``buckets=0``, and always with ``state_ttl_ms``, it is
    one value per match, at a call into the state store per match and trigger;
    the emissions are the same.  ``keep_ms`` bounds it by event time: a match leaves once an event time
    ``keep_ms`` after its newest one has been seen, and updates older than
    that are late and dropped; ``availableNow`` runs clear it too.  ``state_ttl_ms``
    (per match only) drops a match's whole state when no update of it was
    accepted for that long; expiry runs in processing-time mode, so use it with
    a processing-time trigger (``availableNow`` keeps scheduling timer batches in
    that mode).

    ``history``: updates of the past, judged in batch (their newest price per
    match and source) and handed over as the state of a new query, so the
    stream goes on as if it had read them in a trigger before.
    """
    from pricefold.streaming.batched import BUCKETS, BucketProcessor, bucketed

    if state_ttl_ms and (buckets or keep_ms):
        raise ValueError("state_ttl_ms goes with neither buckets nor keep_ms")
    if buckets is None and not state_ttl_ms:
        buckets = BUCKETS
    spark = odds.sparkSession
    ship_package(spark)
    # transformWithState keeps its state in RocksDB; a session conf that
    # applies to queries started from now on (a restarted query keeps
    # the provider recorded in its checkpoint)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    order = list(arrival) or ["real_time_ms"]
    extra = [c for c in order if c not in DETECT_COLUMNS]
    observed = odds.observe(INPUT_METRICS, F.count(F.lit(1)).alias("rows_decoded"))
    rows = valid_odds(observed).select(*DETECT_COLUMNS, *extra).observe(VALID_METRICS, F.count(F.lit(1)).alias("rows_valid"))
    past = None if history is None else latest_odds(valid_odds(history).select(*DETECT_COLUMNS))
    key = "bucket" if buckets else "match_id"
    if buckets:
        rows = bucketed(rows, order, buckets)
        past = past if past is None else bucketed(past, ["real_time_ms"], buckets)
    elif past is not None:
        past = past.groupBy("match_id").agg(F.collect_list(F.struct("bookmaker", *PRICE)).alias("prices"))
    if keep_ms is not None:
        rows = rows.withColumn("_at", F.timestamp_millis("event_time_ms")).withWatermark("_at", f"{int(keep_ms)} milliseconds")
    # Processing-time mode schedules extra no-data batches for timers; it is needed only to expire state by TTL.
    mode = "EventTime" if keep_ms is not None else "ProcessingTime" if state_ttl_ms else "None"
    common = {"arrival": order, "tolerance": tolerance, "eps": eps, "now_ms": now_ms, "expire": keep_ms is not None}
    grouped, start = rows.groupBy(key), past.groupBy(key) if past is not None else None
    if buckets:
        evals = grouped.transformWithStateInPandas(
            statefulProcessor=BucketProcessor(**common), outputStructType=EVAL_SCHEMA, outputMode="Append", timeMode=mode, initialState=start)
    else:
        evals = grouped.transformWithState(
            statefulProcessor=OddsRowProcessor(state_ttl_ms=state_ttl_ms, **common), outputStructType=EVAL_SCHEMA, outputMode="Append",
            timeMode=mode, initialState=start)
    evals = evals.observe(EVAL_METRICS, F.count(F.lit(1)).alias("touched_matches"),
                          F.count_if(F.col("emit")).alias("opps_found"))
    if with_evaluations:
        return evals
    return evals.where(F.col("emit")).select(*STREAM_OPP_COLUMNS)


def latest_prices_stream(odds: DataFrame) -> DataFrame:
    """Newest price of every (match, source) as a native streaming aggregation
    (update mode): newest event time, then send time, then prices.  Whatever
    sources come are kept; state is one row per (match, source)."""
    newest = F.max(F.struct("event_time_ms", "real_time_ms", "odds_home", "odds_draw", "odds_away")).alias("_p")
    return valid_odds(odds).groupBy("match_id", "bookmaker").agg(newest).select("match_id", "bookmaker", "_p.*")


def file_stream(spark: SparkSession, path: str, fmt: str = "parquet", max_files_per_trigger: int | None = None,
                schema=ODDS_SCHEMA) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def start(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", trigger: dict | None = None,
          output_mode: str = "append", query_name: str | None = None) -> StreamingQuery:
    """Start a file-sink query (exactly once: the sink's commit log makes a
    replayed trigger idempotent).  ``trigger`` e.g. ``{"processingTime":
    "200 milliseconds"}`` or ``{"availableNow": True}``."""
    w = (df.writeStream.format(fmt).outputMode(output_mode).option("checkpointLocation", checkpoint)
         .option("path", path).trigger(**(trigger or {"availableNow": True})))
    if query_name:
        w = w.queryName(query_name)
    return w.start()


def detect_window_stream(odds: DataFrame, width_ms: int, delay_ms: int, time_col: str = "event_time_ms", now_ms=None,
                         min_books: int = 2, eps: float = EPSILON) -> DataFrame:
    """``detect_window`` on a stream, without Python: the newest price per
    (window, match, source) and the best per (window, match) are two chained
    streaming aggregations in append mode.  A window's opportunities come out
    once, when the watermark (``delay_ms`` behind the newest time) passes its
    end, and its state goes; updates of closed windows are late and dropped.
    """
    timed = odds.withColumn("_at", F.timestamp_millis(time_col)).withWatermark("_at", f"{int(delay_ms)} milliseconds")
    newest = F.max(F.struct("event_time_ms", "real_time_ms", "odds_home", "odds_draw", "odds_away")).alias("_p")
    latest = (valid_odds(timed).groupBy(F.window("_at", f"{int(width_ms)} milliseconds").alias("window"), "match_id", "bookmaker")
              .agg(newest).select("window", "match_id", "bookmaker", "_p.*"))
    best = best_prices(latest, keys=["window", "match_id"])
    found = opportunities(best, now_ms=now_ms, method="batch", min_books=min_books, eps=eps, keys=["window"])
    return found.select(F.unix_millis("window.start").alias("window_start_ms"), *[c for c in found.columns if c != "window"])


def start_state(df: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Start an update-mode aggregation whose result is its state, read by
    ``state_prices``: no rows are written anywhere else."""
    return (df.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def state_prices(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """Newest price per (match, source), as the state of a ``latest_prices_stream``
    query holds it after its last committed trigger (or after ``batch_id``), by
    Spark's state data source: one task per state partition."""
    r = spark.read.format("statestore").option("path", checkpoint)
    if batch_id is not None:
        r = r.option("batchId", str(batch_id))
    state = r.load()
    value = state.schema["value"].dataType.names[0]
    return state.select("key.match_id", "key.bookmaker", f"value.`{value}`.*")


def current_prices(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Best prices per match from the state of a ``latest_prices_stream`` query."""
    return best_prices(state_prices(spark, checkpoint))


def current_opportunities(spark: SparkSession, checkpoint: str, now_ms=None, eps: float = EPSILON) -> DataFrame:
    """Opportunities that stand now, with both latency columns: the batch rule
    over the newest prices, so one that has vanished is not among them."""
    return opportunities(current_prices(spark, checkpoint), now_ms=now_ms, method="stream", eps=eps)


def match_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Matches in the state of a ``detect_stream`` query:
    ``match_id``, its sources and newest event time, and the margin emitted last."""
    from pricefold.streaming.batched import MATCH_STATE, unpack_matches

    held = [r[0] or "" for r in spark.read.format("state-metadata").load(checkpoint).select("operatorProperties").collect()]  # one an operator
    if any('"stateName":"bucket"' in h.replace(" ", "") for h in held):
        ship_package(spark)
        state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "bucket").load()
        return state.select("value.prices").mapInArrow(unpack_matches, MATCH_STATE)
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "match").load()
    return state.select("key.match_id", F.col("value.books").alias("books"),
                        F.array_max("value.event_time_ms").alias("max_event_time_ms"), F.col("value.memo").alias("memo"))


def start_polling(odds: DataFrame, path: str, checkpoint: str, metrics_path: str | None = None,
                  trigger: dict | None = None, min_books: int = 2, eps: float = EPSILON) -> StreamingQuery:
    """The polling consumer: every trigger's new updates are judged alone
    with the batch rule (``detect_snapshot`` on the micro-batch), as a
    consumer that reads only the offsets of its period.  Opportunities go to
    ``path/batch_id=<id>`` (a replayed batch overwrites its own folder), and
    one metric record per trigger to ``metrics_path``: decoded rows, rows
    after the latest-per-source step, opportunities, duration, wall clock; a
    trigger without new data has a record of zeros (``read_polls`` reads all).
    Counts come from observations of the one detection job, not extra passes.
    """
    from pyspark.sql import Observation

    from pricefold.operators import detect as D

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        import time
        t0 = time.time()
        o_in, o_snap, o_opps = (Observation(f"{n}_{batch_id}") for n in ("in", "snap", "opps"))
        src = batch.observe(o_in, F.count(F.lit(1)).alias("rows_decoded"))
        latest = D.latest_odds(D.valid_odds(src).select(*D.DETECT_COLUMNS)).observe(
            o_snap, F.count(F.lit(1)).alias("rows_snapshot"))
        opps = D.opportunities(D.best_prices(latest), method="batch", min_books=min_books, eps=eps)
        opps = opps.withColumn("batch_id", F.lit(batch_id).cast("bigint")).observe(
            o_opps, F.count(F.lit(1)).alias("opps_found"))
        opps.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        if metrics_path:
            rec = [(int(batch_id), int(o_in.get["rows_decoded"]), int(o_snap.get.get("rows_snapshot", 0)),
                    int(o_opps.get.get("opps_found", 0)), int((time.time() - t0) * 1000), int(time.time() * 1000))]
            batch.sparkSession.createDataFrame(
                rec, "batch bigint, rows_decoded bigint, rows_read bigint, opps_found bigint, "
                     "processing_ms bigint, wall_time_ms bigint").write.mode("overwrite").json(
                f"{metrics_path}/batch_id={batch_id}")

    spark = odds.sparkSession
    idle = None
    if metrics_path:
        # a poll without new offsets runs no batch; its record comes from the idle event of every such trigger
        every = "spark.sql.streaming.noDataProgressEventInterval"
        before = spark.conf.get(every)
        idle = _IdlePolls(metrics_path)
        spark.streams.addListener(idle)
        spark.conf.set(every, "1")  # taken over by the query when it starts
    try:
        query = (odds.writeStream.option("checkpointLocation", checkpoint).foreachBatch(per_batch)
                 .trigger(**(trigger or {"availableNow": True})).start())
    finally:
        if idle is not None:
            spark.conf.set(every, before)
    if idle is not None:
        idle.watch(spark, str(query.runId))
    return query


class _IdlePolls(StreamingQueryListener):
    """Writes a record of zeros for every trigger of one query that found
    nothing new, and removes itself when the query ends."""

    def __init__(self, path: str):
        self.path, self.spark, self.run, self.early = path, None, None, []

    def watch(self, spark: SparkSession, run: str) -> None:
        self.spark, self.run = spark, run
        for when in [w for r, w in self.early if r == run]:
            self._write(when)

    def _write(self, timestamp: str) -> None:
        when = datetime.strptime(timestamp.replace("Z", "+0000"), "%Y-%m-%dT%H:%M:%S.%f%z")
        ms = int(when.timestamp() * 1000)
        record = {"batch": None, "rows_decoded": 0, "rows_read": 0, "opps_found": 0, "processing_ms": 0, "wall_time_ms": ms}
        write_file(self.spark, f"{self.path}-idle/{ms:015d}-{uuid.uuid4().hex[:8]}.json", json.dumps(record) + "\n")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        if self.run is None:
            self.early.append((str(event.runId), event.timestamp))
        elif str(event.runId) == self.run:
            self._write(event.timestamp)

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == self.run:
            self.spark.streams.removeListener(self)


def read_polls(spark: SparkSession, metrics_path: str) -> DataFrame:
    """All trigger records of a polling consumer, those of empty polls (beside
    ``metrics_path``, in ``<metrics_path>-idle``) with no batch number and 0 rows."""
    schema = "batch bigint, rows_decoded bigint, rows_read bigint, opps_found bigint, processing_ms bigint, wall_time_ms bigint"
    return spark.read.schema(schema).option("recursiveFileLookup", True).json(f"{metrics_path}*")


def run_for(query: StreamingQuery, seconds: float) -> None:
    """Bounded run: wait at most ``seconds``, then stop the query."""
    if not query.awaitTermination(seconds):
        query.stop()


def run_triggers(query: StreamingQuery, n: int, poll_s: float = 0.1) -> None:
    """Bounded run: stop the query once ``n`` triggers have completed (or it
    ends by itself)."""
    while query.isActive:
        last = query.lastProgress
        if last is not None and last["batchId"] + 1 >= n:
            query.stop()
            return
        query.awaitTermination(poll_s)


METRIC_FIELDS = ("query_id", "spark_batch_id", "rows_read", "rows_valid", "touched_matches", "opps_found", "processing_ms",
                 "wall_time_ms")


class MetricsListener(StreamingQueryListener):
    """One metric record per trigger of the watched queries.

    Records: batch (1-based), spark_batch_id, rows_read (decoded rows),
    rows_valid, touched_matches, opps_found, processing_ms (trigger
    duration), wall_time_ms (trigger end).  A trigger without new data is a
    record of 0 rows.  Metadata only: one small record per trigger.

    The newest ``most`` records are held; with ``path`` every record is also
    written out, as a JSON line file of its own, and ``read_metrics`` reads all.
    """

    def __init__(self, path: str | None = None, most: int = 10_000):
        self.path, self.records = path, deque(maxlen=most)
        self.last: dict[str, int] = {}

    def _add(self, record: dict) -> None:
        self.last[record["query_id"]] = record["spark_batch_id"]
        self.records.append(record)
        spark = SparkSession.getActiveSession() or SparkSession._instantiatedSession
        if self.path and spark is not None:
            name = f"{record['query_id']}/{record['wall_time_ms']:015d}-{uuid.uuid4().hex[:8]}.json"
            write_file(spark, f"{self.path}/{name}", json.dumps(record) + "\n")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        when = datetime.strptime(event.timestamp.replace("Z", "+0000"), "%Y-%m-%dT%H:%M:%S.%f%z")
        self._add({"query_id": str(event.id), "spark_batch_id": self.last.get(str(event.id), -1), "rows_read": 0, "rows_valid": 0,
                   "touched_matches": 0, "opps_found": 0, "processing_ms": 0, "wall_time_ms": int(when.timestamp() * 1000)})

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        obs = p.observedMetrics or {}
        inp, ok = obs.get(INPUT_METRICS), obs.get(VALID_METRICS)
        ev = obs.get(EVAL_METRICS)
        ts = datetime.strptime(p.timestamp.replace("Z", "+0000"), "%Y-%m-%dT%H:%M:%S.%f%z")
        dur = int(p.durationMs.get("triggerExecution", 0)) if p.durationMs else 0
        self._add({
            "query_id": str(p.id), "spark_batch_id": int(p.batchId),
            "rows_read": int(inp["rows_decoded"]) if inp is not None else int(p.numInputRows),
            "rows_valid": int(ok["rows_valid"]) if ok is not None else None,
            "touched_matches": int(ev["touched_matches"]) if ev is not None else None,
            "opps_found": int(ev["opps_found"]) if ev is not None else None,
            "processing_ms": dur,
            "wall_time_ms": int(ts.timestamp() * 1000) + dur,
        })

    @staticmethod
    def read_metrics(spark: SparkSession, path: str) -> DataFrame:
        """All records written under ``path``, of all queries and runs."""
        types = ", ".join(f"{f} {'string' if f == 'query_id' else 'bigint'}" for f in METRIC_FIELDS)
        return spark.read.schema(types).json(f"{path}/*/*.json")

    def to_frame(self, spark: SparkSession, query_id: str | None = None, tag: str | None = None,
                 method: str | None = None) -> DataFrame:
        """Metric records as a DataFrame; with ``tag``/``method`` it is ready
        for ``report.run_summary``."""
        recs = [r for r in self.records if query_id is None or r["query_id"] == query_id]
        recs = sorted(recs, key=lambda r: (r["query_id"], r["wall_time_ms"]))
        rows = [(i + 1, r["spark_batch_id"], r["rows_read"], r["rows_valid"], r["touched_matches"], r["opps_found"],
                 r["processing_ms"], r["wall_time_ms"]) for i, r in enumerate(recs)]
        df = spark.createDataFrame(rows, "batch bigint, spark_batch_id bigint, rows_read bigint, rows_valid bigint, "
                                         "touched_matches bigint, opps_found bigint, processing_ms bigint, "
                                         "wall_time_ms bigint")
        if tag is not None:
            df = df.withColumn("tag", F.lit(tag))
        if method is not None:
            df = df.withColumn("method", F.lit(method))
        return df

    def to_json_lines(self) -> str:
        return "\n".join(json.dumps(r) for r in self.records)

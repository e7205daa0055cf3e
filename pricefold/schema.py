"""Fixed schemas and domain constants.

Everything on the data path is typed up front: odds updates, opportunity
records, trigger metrics and run summaries.  Time is epoch milliseconds in
``LongType`` columns, as in the event format being replaced.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values that must equal the source system's -----------------------
# Six bookmakers and the wide CSV column triple (home, draw, away) of each,
# in the order the source system lists them.
BOOKMAKERS: dict[str, tuple[str, str, str]] = {
    "Bet365": ("B365H", "B365D", "B365A"),
    "BetAndWin": ("BWH", "BWD", "BWA"),
    "Betfair": ("BFH", "BFD", "BFA"),
    "Pinnacle": ("PSH", "PSD", "PSA"),
    "WilliamHill": ("WHH", "WHD", "WHA"),
    "1XBet": ("1XBH", "1XBD", "1XBA"),
}
# Margin below which an "opportunity" is floating point noise.
EPSILON = 1e-9
# Change-only emission: re-emit when |margin - last emitted| >= this.
EMIT_TOLERANCE = 1e-4
# Kickoff time used when the Time cell is absent or blank.
DEFAULT_KICKOFF_TIME = "12:00"
# Team name used when the team column is absent from a file.
MISSING_TEAM = "?"
# Text the source system writes for an empty team cell.
EMPTY_TEAM = "nan"
# Method ids of the two detection paths.
METHOD_BATCH = "batch"
METHOD_STREAM = "stream"
# -----------------------------------------------------------------------------

ODDS_FIELDS = [
    "match_id", "league", "home_team", "away_team", "match_date", "bookmaker",
    "odds_home", "odds_draw", "odds_away", "event_time_ms", "real_time_ms",
]

# Declared non-null flags are documentation only: JSON decoding yields
# nullable columns, and validity is checked by ``operators.clean.split_valid``.
ODDS_SCHEMA = T.StructType([
    T.StructField("match_id", T.StringType(), True),
    T.StructField("league", T.StringType(), True),
    T.StructField("home_team", T.StringType(), True),
    T.StructField("away_team", T.StringType(), True),
    T.StructField("match_date", T.StringType(), True),
    T.StructField("bookmaker", T.StringType(), True),
    T.StructField("odds_home", T.DoubleType(), True),
    T.StructField("odds_draw", T.DoubleType(), True),
    T.StructField("odds_away", T.DoubleType(), True),
    T.StructField("event_time_ms", T.LongType(), True),
    T.StructField("real_time_ms", T.LongType(), True),
])

OPP_COLUMNS_COMMON = [
    "method", "match_id",
    "best_book_home", "best_odds_home",
    "best_book_draw", "best_odds_draw",
    "best_book_away", "best_odds_away",
    "profit_margin", "implied_prob_sum", "detected_at_ms",
]
BATCH_OPP_COLUMNS = OPP_COLUMNS_COMMON + ["max_event_time_ms", "max_real_time_ms", "e2e_latency_ms"]
STREAM_OPP_COLUMNS = OPP_COLUMNS_COMMON + ["max_real_time_ms", "e2e_latency_ms"]

STREAM_OPP_SCHEMA = T.StructType([
    T.StructField("method", T.StringType()),
    T.StructField("match_id", T.StringType()),
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

BATCH_METRIC_SCHEMA = T.StructType([
    T.StructField("batch", T.LongType()),
    T.StructField("rows_read", T.LongType()),
    T.StructField("opps_found", T.LongType()),
    T.StructField("processing_ms", T.LongType()),
    T.StructField("wall_time_ms", T.LongType()),
])

STREAM_METRIC_SCHEMA = T.StructType(BATCH_METRIC_SCHEMA.fields + [
    T.StructField("spark_batch_id", T.LongType()),
    T.StructField("touched_matches", T.LongType()),
])

OPP_LATENCY_SCHEMA = T.StructType([
    T.StructField("method", T.StringType()),
    T.StructField("match_id", T.StringType()),
    T.StructField("profit_margin", T.DoubleType()),
    T.StructField("e2e_latency_ms", T.LongType()),
])

SUMMARY_COLUMNS = [
    "label", "batches", "events", "opps",
    "proc_ms_p50", "proc_ms_p95", "proc_ms_p99",
    "lat_ms_p50", "lat_ms_p95", "lat_ms_p99",
    "throughput_ev_s",
]

SUMMARY_SCHEMA = T.StructType([
    T.StructField("label", T.StringType()),
    T.StructField("batches", T.LongType()),
    T.StructField("events", T.LongType()),
    T.StructField("opps", T.LongType()),
    T.StructField("proc_ms_p50", T.DoubleType()),
    T.StructField("proc_ms_p95", T.DoubleType()),
    T.StructField("proc_ms_p99", T.DoubleType()),
    T.StructField("lat_ms_p50", T.DoubleType()),
    T.StructField("lat_ms_p95", T.DoubleType()),
    T.StructField("lat_ms_p99", T.DoubleType()),
    T.StructField("throughput_ev_s", T.DoubleType()),
])

# Raw Kafka source columns (what ``spark.read.format("kafka")`` yields).
KAFKA_SOURCE_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])

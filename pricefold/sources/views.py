"""Odds tables derived from the driver's generic test tables.

The engine works on any table of price updates with the ``ODDS_SCHEMA``
columns.  These views turn the generic ``events`` and ``lineitem`` tables
into such updates so that every query scales with those tables.

``odds_ev``: match = user x day, bookmaker = event type (five sources),
prices derived from the event id and the JSON property ``k``; some rows are
deliberately invalid (price <= 1.0).

``odds_li``: match = order, bookmaker = supplier mod 6; the bench view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricefold.functions.text import epoch_ms


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def odds_from_events(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return events.select(
        F.concat(F.lit("U"), F.col("user_id").cast("string"), F.lit("-"),
                 F.col("ts").cast("date").cast("string")).alias("match_id"),
        F.lit(None).cast("string").alias("league"),
        F.lit(None).cast("string").alias("home_team"),
        F.lit(None).cast("string").alias("away_team"),
        F.col("ts").cast("date").cast("string").alias("match_date"),
        F.col("event_type").alias("bookmaker"),
        (F.lit(0.95) + (F.col("event_id") % 83) / F.lit(45.0)).alias("odds_home"),
        (F.lit(1.2) + k / F.lit(40.0)).alias("odds_draw"),
        (F.lit(1.1) + (F.col("event_id") % 61) / F.lit(30.0)).alias("odds_away"),
        epoch_ms("ts").alias("event_time_ms"),
        F.col("event_id").alias("real_time_ms"),
    )


def odds_from_lineitem(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.concat(F.lit("L"), F.col("l_orderkey").cast("string")).alias("match_id"),
        F.lit(None).cast("string").alias("league"),
        F.lit(None).cast("string").alias("home_team"),
        F.lit(None).cast("string").alias("away_team"),
        F.col("l_shipdate").cast("date").cast("string").alias("match_date"),
        F.concat(F.lit("B"), (F.col("l_suppkey") % 6).cast("string")).alias("bookmaker"),
        (F.lit(0.95) + F.col("l_quantity") / F.lit(20.0)).alias("odds_home"),
        (F.lit(2.0) + F.col("l_discount") * F.lit(16.0)).alias("odds_draw"),
        (F.lit(1.5) + F.col("l_tax") * F.lit(30.0)).alias("odds_away"),
        epoch_ms("l_shipdate").alias("event_time_ms"),
        (F.col("l_linenumber") * F.lit(1000000) + F.col("l_partkey")).cast("bigint").alias("real_time_ms"),
    )


def odds_ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return odds_from_events(table(spark, sf_dir, "events"))


def odds_li(spark: SparkSession, sf_dir: str) -> DataFrame:
    return odds_from_lineitem(table(spark, sf_dir, "lineitem"))


def replicate(odds: DataFrame, copies: int) -> DataFrame:
    """``copies`` copies of an odds table with distinct match ids (``c<i>-``
    prefix), for scaling runs; a generator, not a join."""
    c = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("_copy")
    return odds.select("*", c).withColumn(
        "match_id", F.concat(F.lit("c"), F.col("_copy").cast("string"), F.lit("-"), F.col("match_id"))).drop("_copy")


def delivered(odds: DataFrame, ranges: int) -> DataFrame:
    """``odds`` as a log delivers it in ``ranges`` equal arrival ranges (column
    ``trig``): a tenth of the updates comes again one range later, and a
    fiftieth has a twin without event time and with better prices."""
    top = odds.agg(F.max("real_time_ms").alias("_top"))  # one row
    log = odds.join(F.broadcast(top)).withColumn(
        "trig", F.expr(f"(real_time_ms * {int(ranges)}) div (_top + 1)")).drop("_top")
    again = log.where("real_time_ms % 10 = 0").withColumn("trig", F.least(F.col("trig") + 1, F.lit(ranges - 1)))
    untimed = (log.where("real_time_ms % 50 = 0").withColumn("event_time_ms", F.lit(None).cast("bigint"))
               .withColumn("odds_home", F.col("odds_home") * 10.0))
    return log.unionByName(again).unionByName(untimed)


def run_metrics_from_events(events: DataFrame) -> DataFrame:
    """Trigger-metric records derived from ``events``.

    method = parity of the event id, tag = half of the month, one record per
    event; ``processing_ms`` and ``rows_read`` come from the event value.
    """
    return events.select(
        F.when(F.dayofmonth("ts") <= 15, F.lit("h1")).otherwise(F.lit("h2")).alias("tag"),
        F.when(F.col("event_id") % 2 == 0, F.lit("batch")).otherwise(F.lit("stream")).alias("method"),
        F.col("event_id").alias("batch"),
        ((F.col("event_id") % 7) + 1).cast("bigint").alias("rows_read"),
        (F.col("event_id") % 3).cast("bigint").alias("opps_found"),
        F.floor(F.col("value") * F.lit(100.0)).cast("bigint").alias("processing_ms"),
        epoch_ms("ts").alias("wall_time_ms"),
    )


def run_opps_from_events(events: DataFrame) -> DataFrame:
    """Opportunity latency records derived from ``events``, one per event."""
    return events.select(
        F.when(F.dayofmonth("ts") <= 15, F.lit("h1")).otherwise(F.lit("h2")).alias("tag"),
        F.when(F.col("event_id") % 2 == 0, F.lit("batch")).otherwise(F.lit("stream")).alias("method"),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("match_id"),
        F.floor(F.col("value") * F.lit(1000.0)).cast("bigint").alias("e2e_latency_ms"),
    )


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_metrics_from_events(table(spark, sf_dir, "events"))


def run_opps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_opps_from_events(table(spark, sf_dir, "events"))


def wide_books_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """A wide match table (one row per line, one price triple per bookmaker)
    as the historical files carry it, built from ``lineitem``.

    Every line gets prices of three of the six bookmakers (depending on the
    supplier), the other triples are NULL; prices are text as in a CSV.
    """
    from pricefold.schema import BOOKMAKERS
    cols = [
        F.concat(F.lit("L"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("row_id"),
        F.col("l_shipdate").alias("kickoff"),
    ]
    for i, (_, (h, d, a)) in enumerate(BOOKMAKERS.items()):
        present = ((F.col("l_suppkey") + F.lit(i)) % 2) == 0
        cols += [
            F.when(present, (F.lit(0.95) + F.col("l_quantity") / F.lit(20.0 + i)).cast("string")).alias(h),
            F.when(present, (F.lit(2.0) + F.col("l_discount") * F.lit(16.0 + i)).cast("string")).alias(d),
            F.when(present, (F.lit(1.5) + F.col("l_tax") * F.lit(30.0 + i)).cast("string")).alias(a),
        ]
    return lineitem.select(*cols)


def wide_matches_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Historical-file shaped text table from ``lineitem``: ``Div``, ``Date``
    (``dd/MM/yyyy`` or ``dd/MM/yy``), ``Time`` (blank for a third of the rows),
    team names with a space and a slash, and the six bookmakers' price
    triples as text (three present per row)."""
    from pricefold.schema import BOOKMAKERS
    date_text = F.when(F.col("l_linenumber") % 2 == 0, F.date_format("l_shipdate", "dd/MM/yyyy")) \
        .otherwise(F.date_format("l_shipdate", "dd/MM/yy"))
    hm = F.concat(F.lpad((F.col("l_partkey") % 24).cast("string"), 2, "0"), F.lit(":"),
                  F.lpad((F.col("l_suppkey") % 60).cast("string"), 2, "0"))
    cols = [
        F.concat(F.lit("L"), F.col("l_returnflag")).alias("Div"),
        date_text.alias("Date"),
        F.when(F.col("l_partkey") % 3 == 0, F.lit("")).otherwise(hm).alias("Time"),
        F.concat(F.lit("Team "), (F.col("l_partkey") % 50).cast("string")).alias("HomeTeam"),
        F.concat(F.lit("Club/"), (F.col("l_suppkey") % 40).cast("string")).alias("AwayTeam"),
    ]
    for i, (_, (h, d, a)) in enumerate(BOOKMAKERS.items()):
        present = ((F.col("l_suppkey") + F.lit(i)) % 2) == 0
        cols += [
            F.when(present, (F.lit(0.95) + F.col("l_quantity") / F.lit(20.0 + i)).cast("string")).alias(h),
            F.when(present, (F.lit(2.0) + F.col("l_discount") * F.lit(16.0 + i)).cast("string")).alias(d),
            F.when(present, (F.lit(1.5) + F.col("l_tax") * F.lit(30.0 + i)).cast("string")).alias(a),
        ]
    return lineitem.select(*cols)


# Headers of three file layouts: a quoted name with a comma and a repeated name; another order; a byte-order mark.
CSV_HEADERS = ('Div,Date,"Home,Team",Note,Note', "Date,Ref,Div", "\ufeffNote,Div,Date")


def csv_layout_lines(orders: DataFrame, layout: int) -> DataFrame:
    """CSV records (column ``value``) of every third order in one of three
    layouts.  Notes are quoted and hold doubled quotes, commas and a line end;
    a fifth of the records lacks its last cells, a seventh has one too many."""
    key = F.col("o_orderkey")
    date, div = F.date_format("o_orderdate", "dd/MM/yyyy"), F.concat(F.lit("L"), F.col("o_orderstatus"))
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    home = F.concat(F.lit('The "Reds", no. '), (key % 50).cast("string"))
    note = F.concat(F.lit('said "'), F.col("o_orderpriority"), F.lit('",\nthen left'))
    short, comma = key % 5 == 0, F.lit(",")
    if layout == 0:
        line = F.concat_ws(",", div, date, quoted(home), F.when(~short, quoted(note)), F.when(~short, key.cast("string")))
    elif layout == 1:
        line = F.concat_ws(",", date, key.cast("string"), F.when(~short, div))
    else:
        line = F.concat_ws(",", quoted(note), div, F.when(~short, date))
    line = F.when(key % 7 == 0, F.concat(F.when(short, F.concat(line, F.lit(",,"))).otherwise(line), comma, F.lit("surplus"))).otherwise(line)
    return orders.where(key % 3 == layout).select(line.alias("value"))


def write_csv_layouts(orders: DataFrame, folder: str) -> None:
    """Files ``L<layout>_21-<number>.csv``, each with its header: the parts of a
    distributed text write, renamed."""
    spark = orders.sparkSession
    for layout, header in enumerate(CSV_HEADERS):
        end = "\r\n" if layout == 2 else "\n"
        first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
        lines = csv_layout_lines(orders, layout).repartition(3)
        lines.select(F.when(first, F.concat(F.lit(header + end), F.col("value"))).otherwise(F.col("value")).alias("value")) \
            .write.option("lineSep", end).text(f"{folder}/layout{layout}")
        root = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/layout{layout}")
        fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
        for k, f in enumerate(s for s in fs.listStatus(root) if s.getPath().getName().startswith("part-")):
            fs.rename(f.getPath(), spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/layout{layout}/L{layout}_21-{k}.csv"))


def log_messages(odds: DataFrame, partitions: int = 3) -> DataFrame:
    """``odds`` as messages of a log of so many partitions, keyed by match (the
    number in its id), stamped with the send time."""
    keyed = odds.where(F.col("match_id").isNotNull())
    number = F.regexp_extract("match_id", "^U([0-9]+)", 1).cast("bigint")
    return keyed.select(F.col("match_id").cast("binary").alias("key"),
                        F.to_json(F.struct(*keyed.columns)).cast("binary").alias("value"),
                        F.timestamp_millis("real_time_ms").alias("timestamp"), (number % partitions).cast("int").alias("partition"))

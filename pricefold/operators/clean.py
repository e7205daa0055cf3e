"""Cleaning: wide match rows to typed price updates, validity split.

``unpivot_books`` turns one wide row per match (three price columns per
bookmaker) into one update per (match, bookmaker); ``split_valid`` sends
unusable updates to a quarantine output with a reason instead of failing the
job.  All of it is per-row expressions (no shuffle).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricefold.functions.odds import invalid_reason, usable, valid_prices
from pricefold.functions.text import build_match_id, epoch_ms, iso_date, once, parse_kickoff
from pricefold.schema import BOOKMAKERS, MISSING_TEAM, ODDS_FIELDS


def _num(df: DataFrame, name: str):
    """Raw cell → double; text that is not a number gives NULL (ANSI-safe)."""
    c = F.col(f"`{name}`")
    if dict(df.dtypes)[name] == "string":
        return F.trim(c).try_cast("double")
    return c.cast("double")


def unpivot_books(wide: DataFrame, keep: list[str] | tuple[str, ...] = (),
                  books: Mapping[str, tuple[str, str, str]] = BOOKMAKERS,
                  only_valid: bool = True) -> DataFrame:
    """One row per (input row, bookmaker) with ``odds_home/draw/away``.

    A bookmaker whose three columns are not all present in ``wide`` is
    skipped.  With ``only_valid`` (the default, as the event producer does)
    triples that are not three numbers > 1.0 are dropped; otherwise they are
    kept with NULL for text that is not a number.
    """
    present = [(b, cols) for b, cols in books.items() if all(c in wide.columns for c in cols)]
    if not present:
        raise ValueError("no bookmaker has all three price columns")
    triples = F.array(*[
        F.struct(F.lit(b).alias("bookmaker"), _num(wide, h).alias("odds_home"),
                 _num(wide, d).alias("odds_draw"), _num(wide, a).alias("odds_away"))
        for b, (h, d, a) in present
    ])
    out = wide.select(*[F.col(f"`{k}`") for k in keep], F.inline(triples))
    return out.where(valid_prices()) if only_valid else out


def _filled(df: DataFrame, name: str):
    """Whether a raw cell holds anything: text that is not a number counts."""
    c = F.col(f"`{name}`")
    return (F.trim(c) != "") if dict(df.dtypes)[name] == "string" else c.isNotNull()


def book_coverage(wide: DataFrame, books: Mapping[str, tuple[str, str, str]] = BOOKMAKERS) -> DataFrame:
    """Per bookmaker, most covered first: rows where all three price cells are
    non-empty.  A bookmaker whose columns are absent counts 0.  No price test
    is applied (coverage, not validity).

    One row of counts is aggregated (map-side) and turned into one row per
    configured bookmaker; ties are in name order.
    """
    counts = []
    for b, cols in books.items():
        if all(c in wide.columns for c in cols):
            whole = _filled(wide, cols[0]) & _filled(wide, cols[1]) & _filled(wide, cols[2])
            counts.append((b, F.count_if(F.coalesce(whole, F.lit(False)))))
        else:
            counts.append((b, F.count_if(F.lit(False))))
    row = wide.agg(*[c.alias(f"_{i}") for i, (_, c) in enumerate(counts)])
    pairs = F.array(*[F.struct(F.lit(b).alias("bookmaker"), F.col(f"_{i}").alias("matches_with_odds"))
                      for i, (b, _) in enumerate(counts)])
    return row.select(F.inline(pairs)).orderBy(F.desc("matches_with_odds"), "bookmaker")


def split_valid(odds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine).  Quarantine rows carry a ``reason`` column."""
    valid = odds.where(usable())
    bad = odds.withColumn("reason", invalid_reason()).where(F.col("reason").isNotNull())
    return valid, bad


def strict(odds: DataFrame) -> DataFrame:
    """Fail the job on the first unusable update (the source system's
    behaviour), through a JVM-side ``raise_error``."""
    reason = invalid_reason()
    # a predicate, so the optimizer cannot prune the check away
    check = F.when(reason.isNotNull(), F.raise_error(F.concat(F.lit("invalid odds update: "), reason))) \
        .otherwise(F.lit(True))
    return odds.where(check)


def matches_to_events(wide: DataFrame, league_col: str = "league",
                      books: Mapping[str, tuple[str, str, str]] = BOOKMAKERS,
                      kickoff_col: str | None = None) -> DataFrame:
    """Historical wide match rows → ``ODDS_SCHEMA`` updates.

    Rows whose kickoff does not parse are dropped (as the producer does);
    ``real_time_ms`` is 0 until the send time is stamped (``stamp_send_time``).
    """
    if kickoff_col is None:
        time_c = F.col("Time") if "Time" in wide.columns else None
        kickoff = parse_kickoff(F.col("Date"), time_c)
    else:
        kickoff = F.col(kickoff_col).cast("timestamp")
    home = F.col("HomeTeam") if "HomeTeam" in wide.columns else F.lit(MISSING_TEAM)
    away = F.col("AwayTeam") if "AwayTeam" in wide.columns else F.lit(MISSING_TEAM)
    league = F.col(league_col) if league_col in wide.columns else F.lit(None).cast("string")
    base = wide.select(
        "*", once(kickoff).alias("_kickoff"), home.cast("string").alias("_home"),
        away.cast("string").alias("_away"), league.alias("_league"),
    ).where(F.col("_kickoff").isNotNull())
    base = base.withColumn("_date", iso_date("_kickoff"))
    long = unpivot_books(base, keep=["_kickoff", "_home", "_away", "_league", "_date"], books=books)
    return long.select(
        build_match_id("_league", "_date", "_home", "_away").alias("match_id"),
        F.col("_league").alias("league"),
        F.coalesce("_home", F.lit("nan")).alias("home_team"),
        F.coalesce("_away", F.lit("nan")).alias("away_team"),
        F.col("_date").alias("match_date"),
        "bookmaker", "odds_home", "odds_draw", "odds_away",
        epoch_ms("_kickoff").alias("event_time_ms"),
        F.lit(0).cast("bigint").alias("real_time_ms"),
    ).select(*ODDS_FIELDS)


def stamp_send_time(odds: DataFrame) -> DataFrame:
    """Overwrite ``real_time_ms`` with the wall clock at send time."""
    return odds.withColumn("real_time_ms", F.unix_millis(F.current_timestamp()))

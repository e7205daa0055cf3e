"""Scalar text and time functions used when cleaning raw match files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricefold.schema import DEFAULT_KICKOFF_TIME, EMPTY_TEAM


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clean_team(x) -> Column:
    """Blank → '_' and '/' → '-' so the id is safe as a message key.

    A NULL team renders as the literal text the source system wrote for an
    empty cell.
    """
    c = F.coalesce(_c(x).cast("string"), F.lit(EMPTY_TEAM))
    return F.replace(F.replace(c, F.lit(" "), F.lit("_")), F.lit("/"), F.lit("-"))


def build_match_id(league, match_date, home, away) -> Column:
    """``league-YYYY-MM-DD-Home-Away``."""
    return F.concat(
        F.coalesce(_c(league).cast("string"), F.lit(EMPTY_TEAM)), F.lit("-"),
        _c(match_date), F.lit("-"), clean_team(home), F.lit("-"), clean_team(away))


def once(c: Column) -> Column:
    """A generated column (``select(..., once(c).alias(name))``): computed once a
    row.  Predicates on a projected column are pushed below the projection with a
    copy of its expression for every use; below a generator they are not."""
    return F.explode(F.array(c))


def blank_to_null(x) -> Column:
    return F.nullif(F.trim(_c(x)), F.lit(""))


def parse_kickoff(date, time=None) -> Column:
    """Kickoff timestamp (session time zone, UTC) from ``d/m/Y`` or ``d/m/y``.

    The time defaults to noon when absent or blank.  A four-digit year is
    tried first; a two-digit year follows the POSIX ``%y`` pivot: 69-99 are
    19xx and 00-68 are 20xx (Spark's ``yy`` alone would give 2069-2099).
    Unparseable text gives NULL.

    A failed parse costs many times a good one, so dates of the usual form
    (``5/12/2021``, ``05/12/21``) are parsed once, with the century written out;
    only other text is tried with both patterns.
    """
    t = F.lit(DEFAULT_KICKOFF_TIME) if time is None else F.coalesce(blank_to_null(time), F.lit(DEFAULT_KICKOFF_TIME))
    day = F.trim(_c(date))
    text = F.concat(day, F.lit(" "), t)
    century = F.when(F.right(day, F.lit(2)) >= "69", F.lit("19")).otherwise(F.lit("20"))
    full = F.when(day.rlike(r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}\z"), day).when(
        day.rlike(r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{2}\z"),
        F.concat(F.substring_index(day, "/", 2), F.lit("/"), century, F.right(day, F.lit(2))))
    usual = F.try_to_timestamp(F.concat(full, F.lit(" "), t), F.lit("d/M/yyyy H:m"))
    four = F.try_to_timestamp(text, F.lit("d/M/yyyy H:m"))
    two = F.try_to_timestamp(text, F.lit("d/M/yy H:m"))
    # make_timestamp keeps the time of day while moving the century back
    shifted = F.when(
        F.year(two) >= 2069,
        F.make_timestamp(F.year(two) - 100, F.month(two), F.dayofmonth(two),
                         F.hour(two), F.minute(two), F.second(two)),
    ).otherwise(two)
    return F.when(full.isNotNull(), usual).otherwise(F.coalesce(four, shifted))


def iso_date(ts) -> Column:
    return F.date_format(_c(ts), "yyyy-MM-dd")


def epoch_ms(ts) -> Column:
    """Epoch milliseconds, floored; a TIMESTAMP_NTZ is read as UTC wall time."""
    return F.unix_millis(_c(ts).cast("timestamp"))


def file_stem_parts(file_name) -> tuple[Column, Column]:
    """``E0_2021.csv`` → (``E0``, ``2021``): split the stem at the first ``_``."""
    pat = r"^([^_]+)_(.*)\.[^.]*$"
    fn = _c(file_name)
    return (F.nullif(F.regexp_extract(fn, pat, 1), F.lit("")),
            F.nullif(F.regexp_extract(fn, pat, 2), F.lit("")))

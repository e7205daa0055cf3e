"""Column expressions for prices: validity, implied probability, margin, stakes.

All of them are built-in Catalyst expressions, so they stay inside
whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricefold.schema import EPSILON


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def valid_price(x) -> Column:
    """A decimal price is usable when it is a number above 1.0.

    Spark orders NaN above every number, so ``NaN > 1.0`` is true there; the
    explicit ``isnan`` test keeps Python's semantics (NaN is rejected).
    NULL yields false through ``coalesce``.  Infinity passes.
    """
    c = _c(x)
    return F.coalesce((c > F.lit(1.0)) & ~F.isnan(c), F.lit(False))


def valid_prices(home="odds_home", draw="odds_draw", away="odds_away") -> Column:
    return valid_price(home) & valid_price(draw) & valid_price(away)


def usable(home="odds_home", draw="odds_draw", away="odds_away", match_id="match_id", bookmaker="bookmaker",
           event_time="event_time_ms", send_time="real_time_ms") -> Column:
    """An update that detection can use: keyed, with both times, and three
    prices above 1.0.  The rows that ``invalid_reason`` gives no reason for."""
    present = [_c(c).isNotNull() for c in (match_id, bookmaker, event_time, send_time)]
    return present[0] & present[1] & present[2] & present[3] & valid_prices(home, draw, away)


def invalid_reason(home="odds_home", draw="odds_draw", away="odds_away",
                   match_id="match_id", bookmaker="bookmaker",
                   event_time="event_time_ms", send_time="real_time_ms") -> Column:
    """Why a row goes to quarantine; NULL for a valid row."""
    h, d, a = _c(home), _c(draw), _c(away)
    nulls = h.isNull() | d.isNull() | a.isNull()
    nans = F.isnan(h) | F.isnan(d) | F.isnan(a)
    return (F.when(_c(match_id).isNull(), F.lit("missing_match_id"))
            .when(_c(bookmaker).isNull(), F.lit("missing_bookmaker"))
            .when(nulls, F.lit("missing_odds"))
            .when(nans, F.lit("nan_odds"))
            .when(~valid_prices(home, draw, away), F.lit("odds_not_above_1"))
            .when(_c(event_time).isNull() | _c(send_time).isNull(), F.lit("missing_time")))


def implied_prob_sum(home="best_odds_home", draw="best_odds_draw", away="best_odds_away") -> Column:
    """1/h + 1/d + 1/a, added in that order (bit-equal to the reference values)."""
    one = F.lit(1.0)
    return (one / _c(home)) + (one / _c(draw)) + (one / _c(away))


def profit_margin(prob_sum="implied_prob_sum") -> Column:
    return F.lit(1.0) - _c(prob_sum)


def is_arbitrage(margin="profit_margin", eps: float = EPSILON) -> Column:
    return _c(margin) > F.lit(eps)


def stake(total, odds, prob_sum="implied_prob_sum") -> Column:
    """Share of ``total`` on one outcome so that every outcome pays the same."""
    t = total if isinstance(total, Column) else F.lit(float(total))
    return t * (F.lit(1.0) / _c(odds)) / _c(prob_sum)


def now_ms() -> Column:
    """Wall clock in epoch ms; constant within one query / one trigger."""
    return F.unix_millis(F.current_timestamp())

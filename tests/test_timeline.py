"""Boundary-free timeline: equals the stream semantics with one update per trigger."""

from conftest import odds_rows
from pricefold.operators import timeline as TL
from test_stream import triggers, twin


def test_emit_on_change_equals_one_update_per_trigger(spark):
    rows = [r for t in triggers() for r in t]
    df = odds_rows(spark, rows)
    got = sorted((r.match_id, r.profit_margin) for r in TL.emit_on_change(TL.arbitrage_timeline(df)).collect())
    assert got == sorted(twin([[r] for r in rows]))


def test_timeline_rejects_late_and_counts_books(spark):
    rows = [("m", "A", 2.0, 2.0, 2.0, 10, 1), ("m", "A", 9.0, 9.0, 9.0, 5, 2),  # late: rejected
            ("m", "B", 3.0, 1.5, 1.5, 10, 3), ("m", "A", 2.5, 2.0, 2.0, 10, 4)]  # equal time: accepted
    tl = {r.arrival: r for r in TL.arbitrage_timeline(odds_rows(spark, rows)).collect()}
    assert sorted(tl) == [1, 3, 4]
    assert tl[1].n_books == 1 and not tl[1].is_arbitrage
    assert tl[3].n_books == 2 and tl[3].best_odds_home == 3.0 and tl[3].best_book_home == "B"
    assert tl[4].best_odds_draw == 2.0 and tl[4].bookmaker == "A"

"""Snapshot / window detection: golden rows, tie-breaks, edge values, properties."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import odds_rows
from pricefold.operators import detect as D

# Nine published opportunities: (match, (home, book), (draw, book), (away, book), prob_sum, margin, max_event_ms)
GOLDEN = [
    ("E1-2020-11-28-Norwich-Coventry", (1.69, "Pinnacle"), (4.25, "BetAndWin"), (6.0, "Bet365"),
     0.9936767606450864, 0.0063232393549136345, 1606575600000),
    ("E1-2020-12-02-Sheffield_Weds-Reading", (2.64, "Pinnacle"), (3.25, "Bet365"), (3.2, "BetAndWin"),
     0.9989801864801865, 0.001019813519813506, 1606938300000),
    ("F1-2020-09-16-Paris_SG-Metz", (1.28, "BetAndWin"), (11.0, "WilliamHill"), (29.0, "WilliamHill"),
     0.9066418495297806, 0.09335815047021945, 1600286400000),
    ("F1-2020-10-25-Montpellier-Reims", (2.21, "Pinnacle"), (3.5, "Bet365"), (4.2, "Bet365"),
     0.9762982115923293, 0.023701788407670676, 1603634400000),
    ("F1-2020-11-29-Monaco-Nimes", (1.42, "BetAndWin"), (5.65, "Pinnacle"), (9.0, "Bet365"),
     0.9923276136662651, 0.007672386333734904, 1606658400000),
    ("I1-2020-11-01-Torino-Lazio", (3.6, "Bet365"), (3.8, "Bet365"), (2.72, "Pinnacle"),
     0.9085827313381494, 0.09141726866185063, 1604239200000),
    ("N1-2020-10-25-Den_Haag-AZ_Alkmaar", (5.0, "Bet365"), (4.17, "Pinnacle"), (1.83, "WilliamHill"),
     0.9862562409089122, 0.013743759091087826, 1603652400000),
    ("N1-2021-01-26-Zwolle-Heracles", (2.66, "Pinnacle"), (3.6, "Bet365"), (2.9, "WilliamHill"),
     0.9985452136087345, 0.0014547863912655057, 1611683100000),
    ("P1-2021-02-13-Nacional-Farense", (2.79, "Pinnacle"), (3.2, "Bet365"), (3.1, "BetAndWin"),
     0.9935035842293907, 0.006496415770609332, 1613230200000),
]


def golden_events():
    rows = []
    for i, (m, h, d, a, _, _, ev) in enumerate(GOLDEN):
        books = {}
        for k, (price, book) in enumerate((h, d, a)):
            books.setdefault(book, [1.01, 1.01, 1.01])[k] = price
        for j, (book, p) in enumerate(sorted(books.items())):
            rows.append((m, book, p[0], p[1], p[2], ev, 1000 * i + j))
    return rows


def test_golden_opportunities_bit_exact(spark):
    out = {r.match_id: r for r in D.detect_snapshot(odds_rows(spark, golden_events()), now_ms=0).collect()}
    assert len(out) == 9
    for m, h, d, a, s, margin, ev in GOLDEN:
        r = out[m]
        assert (r.best_odds_home, r.best_book_home) == h
        assert (r.best_odds_draw, r.best_book_draw) == d
        assert (r.best_odds_away, r.best_book_away) == a
        assert r.implied_prob_sum == s  # exact, not approximate
        assert r.profit_margin == margin
        assert r.max_event_time_ms == ev
        assert r.method == "batch"


def test_latest_update_wins_and_ties_are_deterministic(spark):
    rows = [
        ("m", "A", 3.0, 3.0, 3.0, 100, 1),
        ("m", "A", 9.0, 9.0, 9.0, 50, 2),    # older event time, later arrival: not latest
        ("m", "B", 2.5, 4.0, 4.0, 100, 3),
        ("m", "C", 3.0, 4.0, 1.5, 100, 4),   # ties A on home, B on draw
    ]
    best = D.best_prices(D.latest_odds(D.valid_odds(odds_rows(spark, rows)))).collect()[0]
    assert best.n_books == 3
    assert (best.best_odds_home, best.best_book_home) == (3.0, "A")
    assert (best.best_odds_draw, best.best_book_draw) == (4.0, "B")
    assert (best.best_odds_away, best.best_book_away) == (4.0, "B")


def test_equal_event_time_uses_send_time(spark):
    rows = [("m", "A", 2.0, 2.0, 2.0, 100, 5), ("m", "A", 3.0, 3.0, 3.0, 100, 7), ("m", "A", 4.0, 4.0, 4.0, 100, 6)]
    lat = D.latest_odds(odds_rows(spark, rows)).collect()
    assert len(lat) == 1 and lat[0].odds_home == 3.0


def test_window_and_colocated_strategies_agree(spark):
    rows = golden_events() + [("x", "A", 2.1, 3.3, 4.4, 1, 1), ("x", "A", 2.2, 3.3, 4.4, 1, 1)]
    df = odds_rows(spark, rows)
    base = D.detect_snapshot(df, now_ms=0)
    for strategy in ("aggregate", "colocated"):
        other = D.detect_snapshot(df, now_ms=0, strategy=strategy)
        assert base.exceptAll(other).count() == 0 and other.exceptAll(base).count() == 0


def test_invalid_prices_never_replace_valid_ones(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        ("m", "A", 2.0, 4.0, 5.0, 100, 1),
        ("m", "A", nan, 4.0, 5.0, 200, 2),   # newer but NaN: rejected, A keeps 2.0
        ("m", "A", 1.0, 4.0, 5.0, 300, 3),   # exactly 1.0: rejected
        ("m", "A", None, 4.0, 5.0, 400, 4),  # NULL: rejected
        ("m", "B", inf, 1.5, 1.5, 100, 5),   # infinity is a valid price (probability 0)
    ]
    opp = D.detect_snapshot(odds_rows(spark, rows), now_ms=0).collect()
    assert len(opp) == 1
    r = opp[0]
    assert r.best_odds_home == inf and r.best_book_home == "B"
    assert r.implied_prob_sum == 0.0 + 1 / 4.0 + 1 / 5.0


def test_one_bookmaker_is_not_enough(spark):
    rows = [("m", "A", 5.0, 5.0, 5.0, 1, 1), ("m", "A", 6.0, 6.0, 6.0, 2, 2)]
    assert D.detect_snapshot(odds_rows(spark, rows), now_ms=0).count() == 0
    assert D.match_book_count(odds_rows(spark, rows)).count() == 0


def test_detect_window_judges_each_window_alone(spark):
    rows = [("m", "A", 3.0, 1.01, 1.01, 1, 10), ("m", "B", 1.01, 3.5, 3.5, 1, 20_000)]
    df = odds_rows(spark, rows)
    assert D.detect_snapshot(df, now_ms=0).count() == 1
    assert D.detect_window(df, 10_000, time_col="real_time_ms", now_ms=0).count() == 0
    assert D.detect_window(df, 100_000, time_col="real_time_ms", now_ms=0).count() == 1


def test_optimal_stakes_equal_payout(spark):
    opps = D.optimal_stakes(D.detect_snapshot(odds_rows(spark, golden_events()), now_ms=0), 100.0).collect()
    for r in opps:
        total = r.stake_home + r.stake_draw + r.stake_away
        assert math.isclose(total, 100.0, rel_tol=1e-12)
        payouts = [r.stake_home * r.best_odds_home, r.stake_draw * r.best_odds_draw, r.stake_away * r.best_odds_away]
        assert max(payouts) - min(payouts) < 1e-9
        assert math.isclose(payouts[0], 100.0 / r.implied_prob_sum, rel_tol=1e-12)


def test_price_maps(spark):
    df = odds_rows(spark, [("m", "B", 2.0, 3.0, 4.0, 1, 1), ("m", "A", 2.5, 3.5, 1.5, 1, 2)])
    r = D.price_maps(df).collect()[0]
    assert r.home_odds == {"A": 2.5, "B": 2.0} and r.away_odds == {"A": 1.5, "B": 4.0}
    t = D.price_maps(df, as_text=True).collect()[0]
    assert t.home_odds == "A=2.5;B=2.0"


prices = st.floats(min_value=1.01, max_value=50.0, allow_nan=False)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ABCD"), prices, prices, prices, st.integers(0, 5)),
                min_size=2, max_size=10),
       st.tuples(prices, prices, prices))
def test_margin_never_drops_when_a_source_is_added(spark, updates, extra):
    rows = [("m", b, h, d, a, e, i) for i, (b, h, d, a, e) in enumerate(updates)]
    df = odds_rows(spark, rows)
    before = D.implied_prob(D.best_prices(D.latest_odds(D.valid_odds(df)))).collect()[0]
    df2 = odds_rows(spark, rows + [("m", "NEW", extra[0], extra[1], extra[2], 0, 99)])
    after = D.implied_prob(D.best_prices(D.latest_odds(D.valid_odds(df2)))).collect()[0]
    assert after.profit_margin >= before.profit_margin


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["m1", "m2"]), st.sampled_from("ABC"), prices, prices, prices,
                          st.integers(0, 3), st.integers(0, 3)), min_size=1, max_size=12),
       st.randoms())
def test_latest_is_order_and_duplicate_invariant(spark, rows, rnd):
    shuffled = list(rows) + list(rows[: len(rows) // 2])  # duplicates are idempotent
    rnd.shuffle(shuffled)
    a = D.latest_odds(odds_rows(spark, rows))
    b = D.latest_odds(odds_rows(spark, shuffled).repartition(3))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_strict_mode_raises(spark):
    import pytest
    from pricefold.operators.clean import strict
    df = odds_rows(spark, [("m", "A", 0.5, 2.0, 2.0, 1, 1)])
    with pytest.raises(Exception, match="invalid odds update"):
        strict(df).collect()


def test_quarantine_reasons(spark):
    from pricefold.operators.clean import split_valid
    nan = float("nan")
    rows = [("m", "A", 2.0, 2.0, 2.0, 1, 1), (None, "A", 2.0, 2.0, 2.0, 1, 2), ("m", None, 2.0, 2.0, 2.0, 1, 3),
            ("m", "A", None, 2.0, 2.0, 1, 4), ("m", "A", nan, 2.0, 2.0, 1, 5), ("m", "A", 1.0, 2.0, 2.0, 1, 6)]
    valid, bad = split_valid(odds_rows(spark, rows))
    assert valid.count() == 1
    reasons = {r.real_time_ms: r.reason for r in bad.collect()}
    assert reasons == {2: "missing_match_id", 3: "missing_bookmaker", 4: "missing_odds", 5: "nan_odds",
                       6: "odds_not_above_1"}
    assert F is not None


def test_hot_match_with_a_third_of_all_rows(spark):
    """One match holds a third of the updates (many per source, out of
    order): detection and the chunked timeline stay exact."""
    import random
    from pricefold.operators import timeline as TL
    rnd = random.Random(3)
    rows = []
    for i in range(300):
        if i % 3 == 0:
            rows.append(("hot", rnd.choice("ABCD"), rnd.uniform(1.5, 4), rnd.uniform(1.5, 4), rnd.uniform(1.5, 4),
                         rnd.randint(0, 20), i))
        else:
            rows.append((f"m{i % 17}", rnd.choice("AB"), rnd.uniform(1.5, 4), rnd.uniform(1.5, 4),
                         rnd.uniform(1.5, 4), rnd.randint(0, 20), i))
    df = odds_rows(spark, rows).repartition(7)
    # reference: plain Python latest-per-source and best prices
    latest = {}
    for m, b, h, d, a, e, r in rows:
        cur = latest.get((m, b))
        if cur is None or (e, r, h, d, a) > cur[:5]:
            latest[(m, b)] = (e, r, h, d, a)
    best = {}
    for (m, b), (e, r, h, d, a) in latest.items():
        cur = best.setdefault(m, [0.0, 0.0, 0.0, 0])
        cur[0], cur[1], cur[2], cur[3] = max(cur[0], h), max(cur[1], d), max(cur[2], a), cur[3] + 1
    expect = {m: 1.0 - ((1.0 / v[0]) + (1.0 / v[1]) + (1.0 / v[2])) for m, v in best.items() if v[3] >= 2}
    expect = {m: x for m, x in expect.items() if x > 1e-9}
    got = {r.match_id: r.profit_margin for r in D.detect_snapshot(df, now_ms=0).collect()}
    assert got == expect
    tl_small = TL.arbitrage_timeline(df, chunk=5)  # the hot match spans many chunks
    tl_big = TL.arbitrage_timeline(df)
    assert sorted(map(tuple, tl_small.collect())) == sorted(map(tuple, tl_big.collect()))

"""DuckDB SQL for every registered query: the independent correctness oracle.

Rules that make the two engines agree to the bit: constants as ``1.0e0``
(a bare ``1.0`` is DECIMAL), additions in the order home, draw, away, epoch
milliseconds floored (``epoch_us // 1000``), and no wall clock in compared
columns (``NOW_MS`` is a fixed parameter).
"""

from __future__ import annotations

NOW_MS = 1_700_000_000_000  # fixed detection clock used by registered queries
EPS = "1.0e-9"

ODDS_EV = """
SELECT concat('U', CAST(user_id AS VARCHAR), '-', CAST(CAST(ts AS DATE) AS VARCHAR)) AS match_id,
       CAST(NULL AS VARCHAR) AS league, CAST(NULL AS VARCHAR) AS home_team,
       CAST(NULL AS VARCHAR) AS away_team, CAST(CAST(ts AS DATE) AS VARCHAR) AS match_date,
       event_type AS bookmaker,
       0.95e0 + (event_id % 83) / 4.5e1 AS odds_home,
       1.2e0 + CAST(props->>'$.k' AS INTEGER) / 4.0e1 AS odds_draw,
       1.1e0 + (event_id % 61) / 3.0e1 AS odds_away,
       epoch_us(ts) // 1000 AS event_time_ms,
       event_id AS real_time_ms
FROM events
"""

ODDS_LI = """
SELECT concat('L', CAST(l_orderkey AS VARCHAR)) AS match_id,
       CAST(NULL AS VARCHAR) AS league, CAST(NULL AS VARCHAR) AS home_team,
       CAST(NULL AS VARCHAR) AS away_team, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS match_date,
       concat('B', CAST(l_suppkey % 6 AS VARCHAR)) AS bookmaker,
       0.95e0 + l_quantity / 2.0e1 AS odds_home,
       2.0e0 + l_discount * 1.6e1 AS odds_draw,
       1.5e0 + l_tax * 3.0e1 AS odds_away,
       epoch_us(l_shipdate) // 1000 AS event_time_ms,
       CAST(l_linenumber * 1000000 + l_partkey AS BIGINT) AS real_time_ms
FROM lineitem
"""

RUN_METRICS = """
SELECT CASE WHEN dayofmonth(ts) <= 15 THEN 'h1' ELSE 'h2' END AS tag,
       CASE WHEN event_id % 2 = 0 THEN 'batch' ELSE 'stream' END AS method,
       event_id AS batch,
       CAST((event_id % 7) + 1 AS BIGINT) AS rows_read,
       CAST(event_id % 3 AS BIGINT) AS opps_found,
       CAST(floor(value * 100.0e0) AS BIGINT) AS processing_ms,
       epoch_us(ts) // 1000 AS wall_time_ms
FROM events
"""

RUN_OPPS = """
SELECT CASE WHEN dayofmonth(ts) <= 15 THEN 'h1' ELSE 'h2' END AS tag,
       CASE WHEN event_id % 2 = 0 THEN 'batch' ELSE 'stream' END AS method,
       concat('U', CAST(user_id AS VARCHAR)) AS match_id,
       CAST(floor(value * 1000.0e0) AS BIGINT) AS e2e_latency_ms
FROM events
"""

VALID = """odds_home > 1.0e0 AND NOT isnan(odds_home) AND odds_draw > 1.0e0 AND NOT isnan(odds_draw)
 AND odds_away > 1.0e0 AND NOT isnan(odds_away) AND match_id IS NOT NULL AND bookmaker IS NOT NULL
 AND event_time_ms IS NOT NULL AND real_time_ms IS NOT NULL"""


def latest_sql(src: str, keys: str = "match_id") -> str:
    return f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY {keys}, bookmaker
      ORDER BY event_time_ms DESC, real_time_ms DESC, odds_home DESC, odds_draw DESC, odds_away DESC) AS rn
  FROM ({src}) WHERE {VALID}) WHERE rn = 1"""


def best_sql(latest: str, keys: str = "match_id") -> str:
    return f"""
SELECT {keys}, count(*) AS n_books,
  min(bookmaker) FILTER (WHERE odds_home = mh) AS best_book_home, max(odds_home) AS best_odds_home,
  min(bookmaker) FILTER (WHERE odds_draw = md) AS best_book_draw, max(odds_draw) AS best_odds_draw,
  min(bookmaker) FILTER (WHERE odds_away = ma) AS best_book_away, max(odds_away) AS best_odds_away,
  max(event_time_ms) AS max_event_time_ms, max(real_time_ms) AS max_real_time_ms
FROM (SELECT *, max(odds_home) OVER (PARTITION BY {keys}) AS mh,
             max(odds_draw) OVER (PARTITION BY {keys}) AS md,
             max(odds_away) OVER (PARTITION BY {keys}) AS ma FROM ({latest}))
GROUP BY {keys}"""


def scored_sql(best: str) -> str:
    return f"""
SELECT *, 1.0e0 - implied_prob_sum AS profit_margin FROM (
  SELECT *, 1.0e0 / best_odds_home + 1.0e0 / best_odds_draw + 1.0e0 / best_odds_away AS implied_prob_sum
  FROM ({best}))"""


def opps_sql(src: str, keys: str = "match_id", extra: str = "", method: str = "batch",
             now_ms: int = NOW_MS) -> str:
    scored = scored_sql(best_sql(latest_sql(src, keys), keys))
    return f"""
SELECT {extra}'{method}' AS method, match_id, best_book_home, best_odds_home, best_book_draw, best_odds_draw,
       best_book_away, best_odds_away, profit_margin, implied_prob_sum,
       CAST({now_ms} AS BIGINT) AS detected_at_ms, max_event_time_ms, max_real_time_ms,
       CAST({now_ms} AS BIGINT) - max_real_time_ms AS e2e_latency_ms
FROM ({scored}) WHERE n_books >= 2 AND profit_margin > {EPS}"""


def window_src(src: str, width_ms: int, time_col: str) -> str:
    return f"""SELECT *, {time_col} - (({time_col} % {width_ms}) + {width_ms}) % {width_ms} AS window_start_ms
FROM ({src})"""


def timeline_sql(src: str) -> str:
    """Evaluation after every accepted update, via DuckDB's ASOF JOIN."""
    return f"""
WITH v AS (SELECT match_id, bookmaker, odds_home, odds_draw, odds_away, event_time_ms, real_time_ms,
                  real_time_ms AS arrival FROM ({src}) WHERE {VALID}),
a AS (SELECT * FROM (SELECT *, max(event_time_ms) OVER (PARTITION BY match_id, bookmaker ORDER BY arrival
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM v)
      WHERE prev IS NULL OR event_time_ms >= prev),
books AS (SELECT DISTINCT match_id, bookmaker AS src FROM a),
e AS (SELECT p.match_id, p.arrival AS p, p.bookmaker AS upd_book, p.event_time_ms AS upd_et, b.src
      FROM a p JOIN books b ON p.match_id = b.match_id),
j AS (SELECT e.*, x.odds_home, x.odds_draw, x.odds_away, x.real_time_ms FROM e ASOF JOIN a x
      ON e.match_id = x.match_id AND e.src = x.bookmaker AND e.p >= x.arrival),
m AS (SELECT *, max(odds_home) OVER w AS mh, max(odds_draw) OVER w AS md, max(odds_away) OVER w AS ma
      FROM j WINDOW w AS (PARTITION BY match_id, p)),
g AS (SELECT match_id, p AS arrival, any_value(upd_book) AS bookmaker, any_value(upd_et) AS event_time_ms,
        count(*) AS n_books,
        min(src) FILTER (WHERE odds_home = mh) AS best_book_home, max(odds_home) AS best_odds_home,
        min(src) FILTER (WHERE odds_draw = md) AS best_book_draw, max(odds_draw) AS best_odds_draw,
        min(src) FILTER (WHERE odds_away = ma) AS best_book_away, max(odds_away) AS best_odds_away,
        max(real_time_ms) AS max_real_time_ms
      FROM m GROUP BY match_id, p),
s AS (SELECT *, 1.0e0 / best_odds_home + 1.0e0 / best_odds_draw + 1.0e0 / best_odds_away AS implied_prob_sum FROM g)
SELECT *, 1.0e0 - implied_prob_sum AS profit_margin,
       n_books >= 2 AND 1.0e0 - implied_prob_sum > {EPS} AS is_arbitrage FROM s"""


def emit_sql(src: str, tol: str = "1.0e-4") -> str:
    """Change-only emission over each match's timeline, one per arrival."""
    one = f"SELECT * FROM ({timeline_sql(src)}) QUALIFY row_number() OVER (PARTITION BY match_id, arrival ORDER BY bookmaker) = 1"
    return f"""
SELECT match_id, arrival, profit_margin, implied_prob_sum, best_book_home, best_odds_home,
       best_book_draw, best_odds_draw, best_book_away, best_odds_away FROM ({fold_sql(one, tol)})"""


def delivered_sql(triggers: int = 4) -> str:
    """``odds_ev`` as a log delivers it in ``triggers`` arrival ranges: a tenth
    of the updates comes again one trigger later, and a fiftieth has a twin
    without event time and with better prices."""
    return f"""
SELECT * FROM (SELECT *, (real_time_ms * {triggers}) // ((SELECT max(event_id) FROM events) + 1) AS trig FROM ({ODDS_EV}))
UNION ALL
SELECT *, least((real_time_ms * {triggers}) // ((SELECT max(event_id) FROM events) + 1) + 1, {triggers - 1}) FROM ({ODDS_EV})
WHERE real_time_ms % 10 = 0
UNION ALL
SELECT * REPLACE (CAST(NULL AS BIGINT) AS event_time_ms, odds_home * 10.0e0 AS odds_home),
       (real_time_ms * {triggers}) // ((SELECT max(event_id) FROM events) + 1) FROM ({ODDS_EV}) WHERE real_time_ms % 50 = 0"""


def stream_sql(triggers: int = 4, now_ms: int = NOW_MS, past: int = 0) -> str:
    """Emissions of the stateful stream: the state at every trigger's end, the
    matches it touched, and the change-only fold over them.  ``past``: so many
    first arrival ranges are one trigger, whose emissions are left out."""
    best = best_sql("SELECT * FROM st SEMI JOIN touched USING (k, match_id)", "k, match_id")
    return f"""
WITH v AS (SELECT * REPLACE (CASE WHEN trig < {past} THEN 0 ELSE trig END AS trig) FROM ({delivered_sql(triggers)}) WHERE {VALID}),
ks AS (SELECT unnest(range({triggers})) AS k),
st AS (SELECT k, match_id, bookmaker, odds_home, odds_draw, odds_away, event_time_ms, real_time_ms FROM v JOIN ks ON v.trig <= k
       QUALIFY row_number() OVER (PARTITION BY k, match_id, bookmaker
         ORDER BY event_time_ms DESC, trig DESC, real_time_ms DESC, odds_home DESC, odds_draw DESC, odds_away DESC) = 1),
touched AS (SELECT DISTINCT trig AS k, match_id FROM (
  SELECT *, max(event_time_ms) OVER (PARTITION BY match_id, bookmaker ORDER BY trig
    RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM v) WHERE prev IS NULL OR event_time_ms >= prev),
e AS (SELECT *, k AS arrival FROM ({scored_sql(best)}))
SELECT 'stream' AS method, match_id, best_book_home, best_odds_home, best_book_draw, best_odds_draw, best_book_away,
       best_odds_away, profit_margin, implied_prob_sum, CAST({now_ms} AS BIGINT) AS detected_at_ms, max_real_time_ms,
       CAST({now_ms} AS BIGINT) - max_real_time_ms AS e2e_latency_ms FROM ({fold_sql("SELECT * FROM e")}) WHERE arrival >= {past}"""


def fold_sql(timeline: str, tol: str = "1.0e-4") -> str:
    """Change-only emission as a recursive fold over each match's evaluations."""
    return f"""
WITH RECURSIVE t AS (SELECT *, row_number() OVER (PARTITION BY match_id ORDER BY arrival) AS rn
                     FROM ({timeline})),
f AS (
  SELECT match_id, rn,
    CASE WHEN n_books >= 2 AND profit_margin > {EPS} THEN profit_margin END AS memo,
    (n_books >= 2 AND profit_margin > {EPS}) AS emit
  FROM t WHERE rn = 1
  UNION ALL
  SELECT t.match_id, t.rn,
    CASE WHEN t.n_books < 2 THEN f.memo
         WHEN NOT (t.profit_margin > {EPS}) THEN NULL
         WHEN f.memo IS NULL OR abs(f.memo - t.profit_margin) >= {tol} THEN t.profit_margin
         ELSE f.memo END,
    (t.n_books >= 2 AND t.profit_margin > {EPS} AND (f.memo IS NULL OR abs(f.memo - t.profit_margin) >= {tol}))
  FROM f JOIN t ON t.match_id = f.match_id AND t.rn = f.rn + 1)
SELECT t.* FROM f JOIN t ON f.match_id = t.match_id AND f.rn = t.rn WHERE f.emit"""

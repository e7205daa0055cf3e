"""Cleaning and sources: CSV edge rows, kickoff parsing, ids, unpivot, message decoding."""

import os
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from pricefold.functions import text as T
from pricefold.operators import clean as C
from pricefold.schema import BOOKMAKERS as BOOKS
from pricefold.sources import files, kafka


def ms(*a):
    return int(datetime(*a, tzinfo=timezone.utc).timestamp() * 1000)


E0 = "﻿Date,Time,HomeTeam,AwayTeam,B365H,B365D,B365A,PSH,PSD,PSA\n" + "\n".join([
    "28/11/2020,15:00,Norwich,Coventry,1.69,4.25,6.0,1.70,4.0,5.5",
    "01/12/20,,Sheff Weds,Man/Utd,2.0,3.0,4.0,abc,3.0,4.0",
    "01/12/69,12:30,A,B,NaN,3.0,4.0,inf,3.2,4.1",
    "bad date,12:00,A,B,2,3,4,2,3,4",
    "02/12/2020,12:00,A,B,1.0,3,4, 1.5 ,3,4",
    "03/12/2020,12:00,A,B,2,3,4,2,3,4,EXTRA",
    "04/12/2020,12:00,A",
    "05/12/2020,12:00,,B,0.5,3,4,2,3,4",
]) + "\n"
SP1 = "Date,HomeTeam,AwayTeam,WHH,WHD,WHA\n10/01/2022,X,Y,2.1,3.1,4.1\n"


@pytest.fixture()
def csv_dir(tmp_path):
    (tmp_path / "E0_2021.csv").write_text(E0, encoding="utf-8")
    (tmp_path / "SP1_2122.csv").write_text(SP1, encoding="utf-8")
    return str(tmp_path)


def test_read_odds_csv_headers_bom_bad_lines(spark, csv_dir):
    df = files.read_odds_csv(spark, csv_dir)
    rows = df.collect()
    assert len(rows) == 8  # the long row is dropped, the short one kept
    assert "Date" in df.columns and "﻿Date" not in df.columns
    by = {(r.league, r.season) for r in rows}
    assert by == {("E0", "2021"), ("SP1", "2122")}
    sp1 = [r for r in rows if r.league == "SP1"][0]
    assert sp1.WHH == "2.1" and sp1.Time is None and sp1.B365H is None  # no shift across headers
    short = [r for r in rows if r.Date == "04/12/2020"][0]
    assert short.AwayTeam is None and short.B365H is None


def test_read_odds_csv_empty_folder_fails(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_odds_csv(spark, str(tmp_path))


def test_matches_to_events(spark, csv_dir):
    ev = C.matches_to_events(files.read_odds_csv(spark, csv_dir)).collect()
    got = sorted((r.match_id, r.bookmaker, r.odds_home, r.event_time_ms) for r in ev)
    assert got == sorted([
        ("E0-2020-11-28-Norwich-Coventry", "Bet365", 1.69, ms(2020, 11, 28, 15)),
        ("E0-2020-11-28-Norwich-Coventry", "Pinnacle", 1.70, ms(2020, 11, 28, 15)),
        ("E0-2020-12-01-Sheff_Weds-Man-Utd", "Bet365", 2.0, ms(2020, 12, 1, 12)),
        ("E0-1969-12-01-A-B", "Pinnacle", float("inf"), ms(1969, 12, 1, 12, 30)),
        ("E0-2020-12-02-A-B", "Pinnacle", 1.5, ms(2020, 12, 2, 12)),
        ("E0-2020-12-05-nan-B", "Pinnacle", 2.0, ms(2020, 12, 5, 12)),
        ("SP1-2022-01-10-X-Y", "WilliamHill", 2.1, ms(2022, 1, 10, 12)),
    ])
    assert all(r.real_time_ms == 0 for r in ev)
    nov = [r for r in ev if r.match_id.startswith("E0-2020-11-28")][0]
    assert nov.match_date == "2020-11-28" and nov.league == "E0"


def test_parse_kickoff_formats(spark):
    cases = [
        ("1/2/2020", "7:05", ms(2020, 2, 1, 7, 5)),
        ("01/02/2020", None, ms(2020, 2, 1, 12)),
        ("01/02/2020", "  ", ms(2020, 2, 1, 12)),
        ("01/02/69", "10:00", ms(1969, 2, 1, 10)),
        ("01/02/68", "10:00", ms(2068, 2, 1, 10)),
        ("01/02/99", "10:00", ms(1999, 2, 1, 10)),
        ("31/02/2020", "10:00", None),
        ("", "10:00", None),
        (None, "10:00", None),
        ("2020-02-01", "10:00", None),
    ]
    df = spark.createDataFrame([(d, t) for d, t, _ in cases], "d string, t string")
    got = [r[0] for r in df.select(T.epoch_ms(T.parse_kickoff("d", "t"))).collect()]
    assert got == [e for _, _, e in cases]


def test_build_match_id(spark):
    df = spark.createDataFrame([("E0", "2020-01-01", "Sheff Weds", "A/B"), ("E1", "2020-01-02", None, "X")],
                               "l string, d string, h string, a string")
    got = [r[0] for r in df.select(T.build_match_id("l", "d", "h", "a")).collect()]
    assert got == ["E0-2020-01-01-Sheff_Weds-A-B", "E1-2020-01-02-nan-X"]


def test_file_stem_parts(spark):
    df = spark.createDataFrame([("E0_2021.csv",), ("SP1_21_22.csv",), ("nounder.csv",)], "f string")
    got = [(r[0], r[1]) for r in df.select(*T.file_stem_parts("f")).collect()]
    assert got == [("E0", "2021"), ("SP1", "21_22"), (None, None)]


def test_unpivot_skips_absent_and_invalid(spark):
    df = spark.createDataFrame([("r1", "2.0", "3.0", "4.0", "abc", "3", "4")],
                               "id string, B365H string, B365D string, B365A string, PSH string, PSD string, PSA string")
    got = C.unpivot_books(df, keep=["id"]).collect()
    assert [(r.bookmaker, r.odds_home) for r in got] == [("Bet365", 2.0)]
    allrows = C.unpivot_books(df, keep=["id"], only_valid=False).collect()
    assert [(r.bookmaker, r.odds_home) for r in allrows] == [("Bet365", 2.0), ("Pinnacle", None)]


def test_book_coverage_counts_zero_for_absent(spark):
    df = spark.createDataFrame([("2.0", "3.0", "4.0"), ("2.0", None, "4.0")], "B365H string, B365D string, B365A string")
    got = {r.bookmaker: r.matches_with_odds for r in C.book_coverage(df).collect()}
    assert got["Bet365"] == 1 and got["Pinnacle"] == 0 and len(got) == 6


def test_decode_events_edge_rows(spark):
    rows = [
        (b"k", b'{"match_id":"m","bookmaker":"A","odds_home":2.0,"odds_draw":3.0,"odds_away":4.0,'
               b'"event_time_ms":1,"real_time_ms":2}'),
        (b"k", b"{not json"),
        (b"k", None),
        (b"k", b'{"bookmaker":"A","odds_home":2.0}'),
        (b"k", b'{"match_id":"m2","bookmaker":"A","odds_home":"abc","odds_draw":3.0,"odds_away":4.0}'),
    ]
    raw = spark.createDataFrame(rows, "key binary, value binary")
    got = {r.match_id: r for r in kafka.decode_events(raw).collect()}
    assert set(got) == {"m", "m2"}
    assert got["m"].odds_home == 2.0 and got["m"].event_time_ms == 1
    assert got["m2"].odds_home is None  # mistyped field decodes to NULL, then fails validation
    valid, bad = C.split_valid(kafka.decode_events(raw))
    assert valid.count() == 1 and bad.collect()[0].reason == "missing_odds"


def test_encode_decode_round_trip(spark):
    from conftest import odds_rows
    df = odds_rows(spark, [("m", "A", 1.0166666666666666, 3.3, 4.4, 10, 20)])
    enc = kafka.encode_events(df)
    assert enc.columns == ["key", "value"]
    back = kafka.decode_events(enc).collect()[0]
    assert back.odds_home == 1.0166666666666666 and back.match_id == "m"
    assert enc.collect()[0].key == b"m"


def test_offsets_json():
    assert kafka.offsets_json("t", {1: 5, 0: 3}) == '{"t": {"0": 3, "1": 5}}'


def test_read_jsonl_missing_and_summary(spark, tmp_path):
    from pricefold.schema import BATCH_METRIC_SCHEMA
    empty = files.read_jsonl(spark, str(tmp_path / "none.jsonl"), BATCH_METRIC_SCHEMA)
    assert empty.count() == 0 and empty.schema == BATCH_METRIC_SCHEMA
    p = tmp_path / "m.jsonl"
    p.write_text('{"batch": 1, "rows_read": 5, "opps_found": 0, "processing_ms": 3, "wall_time_ms": 9}\n\n')
    assert files.read_jsonl(spark, str(p), BATCH_METRIC_SCHEMA).count() == 1
    with pytest.raises(FileNotFoundError):
        files.read_summary(spark, str(tmp_path / "nope.json"), "t")
    s = tmp_path / "summary.json"
    s.write_text('[{"label": "batch", "batches": 4}, {"label": "stream", "batches": 3}]')
    got = files.read_summary(spark, str(s), "fast").collect()
    assert {(r.label, r.tag) for r in got} == {("batch", "fast"), ("stream", "fast")}
    assert os.path.exists(str(s)) and F is not None


def test_coverage_counts_text_cells_and_sorts(spark):
    cols = [c for triple in BOOKS.values() for c in triple]
    rows = [("abc", "2", "3") + (None,) * (len(cols) - 3), (" ", "2", "3") + ("1", "x", "y") + (None,) * (len(cols) - 6),
            ("1", "2", "3") + ("1", "x", "y") + (None,) * (len(cols) - 6), ("1", "2", "3") + (None,) * (len(cols) - 3)]
    wide = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in cols))
    got = [tuple(r) for r in C.book_coverage(wide).collect()]
    names = list(BOOKS)
    assert got[:2] == [(names[0], 3), (names[1], 2)]
    assert got[2:] == sorted((n, 0) for n in names[2:])


def test_csv_headers_quotes_two_layouts_and_uris(spark, tmp):
    import os
    from pricefold.sources import files as FS
    os.makedirs(f"{tmp}/raw")
    with open(f"{tmp}/raw/E0_2021.csv", "w", encoding="utf-8-sig") as f:
        f.write('"Div","Date","Home,Team","B365H"\nE0,01/02/2021,"A, B",2.0\nE0,bad,C,2.0,extra\nE0,03/02/2021\n')
    with open(f"{tmp}/raw/SP1_2122.csv", "w") as f:
        f.write("Date,Div,B365H\n04/02/2022,SP1,3.0\n")
    for base in (f"{tmp}/raw", f"file://{tmp}/raw"):
        df = FS.read_odds_csv(spark, base)
        got = {(r["Div"], r["Date"]): r for r in df.collect()}
        assert "Home,Team" in df.columns and set(got) == {("E0", "01/02/2021"), ("E0", "03/02/2021"), ("SP1", "04/02/2022")}
        assert got["E0", "01/02/2021"]["Home,Team"] == "A, B" and got["E0", "03/02/2021"]["B365H"] is None
        assert (got["SP1", "04/02/2022"].league, got["SP1", "04/02/2022"].season) == ("SP1", "2122")
    with open(f"{tmp}/x.jsonl", "w") as f:
        f.write('{"a": 1}\n\n{"a": 2}\n')
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("a", T.LongType())])
    assert FS.read_jsonl(spark, f"{tmp}/x.jsonl", schema).count() == FS.read_jsonl(spark, f"file://{tmp}/x.jsonl", schema).count() == 2
    assert FS.read_jsonl(spark, f"file://{tmp}/none.jsonl", schema).count() == 0
    with open(f"{tmp}/s.json", "w") as f:
        f.write('[{"a": 1}]')
    assert FS.read_summary(spark, f"file://{tmp}/s.json", "t").collect()[0].tag == "t"


def test_kickoff_forms_equal_both_patterns(spark):
    """Every form parses as by the two patterns one after the other."""
    from pyspark.sql import functions as F
    dates = ["5/12/2021", "05/12/21", "29/02/68", "29/02/72", "29/2/1900", "31/12/69", "01/01/68", "1/1/00", " 7/8/99 ", "32/1/21", "1/13/2021",
             "1/2/021", "1/2/20211", "001/2/21", "1/2/+2021", "x", "", None, "1/2/21 ", "1/2/21\n", "٣/2/21", "1-2-21", "0/1/2021"]
    times = ["12:30", "7:5", "007:5", "24:00", "x", "", " 9:15 ", None, "12:30:01"]
    df = spark.createDataFrame([(d, t) for d in dates for t in times], "d string, t string")
    text = F.concat(F.trim("d"), F.lit(" "), F.coalesce(T.blank_to_null("t"), F.lit("12:00")))
    two = F.try_to_timestamp(text, F.lit("d/M/yy H:m"))
    two = F.when(F.year(two) >= 2069, F.make_timestamp(F.year(two) - 100, F.month(two), F.dayofmonth(two), F.hour(two), F.minute(two), F.second(two))).otherwise(two)
    want = F.coalesce(F.try_to_timestamp(text, F.lit("d/M/yyyy H:m")), two)
    rows = df.select("d", "t", T.parse_kickoff("d", "t").alias("got"), want.alias("want")).collect()
    assert [(r.d, r.t, r.got) for r in rows] == [(r.d, r.t, r.want) for r in rows]
    assert sum(r.got is not None for r in rows) > 40


def test_cells_and_kickoff_are_computed_once(spark, tmp):
    path = f"{tmp}/raw"
    import os
    os.makedirs(path)
    with open(f"{path}/E0_21.csv", "w") as f:
        f.write("Div,Date,Time,HomeTeam,AwayTeam,B365H,B365D,B365A\nE0,05/12/21,12:30,A,B,2,3,4\nE0,x,12:30,A,B,2,3,4\n")
    events = C.matches_to_events(files.read_odds_csv(spark, path), league_col="Div")
    assert [(r.match_id, r.odds_draw) for r in events.collect()] == [("E0-2021-12-05-A-B", 3.0)]
    plan = events._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") <= 4 and plan.count("gettimestamp(") <= 12, plan

"""CSV records cut over splits against Python's csv module."""

import csv
import io
import os
import random

import pytest

from pricefold.sources import files as FS
from pricefold.sources.records import cells_of, csv_records, ends_inside


def make(seed, rows, cells=4):
    """CSV text whose quoted cells hold commas, quotes and line ends."""
    rnd = random.Random(seed)
    alphabet = ["a", "Ü", "1", " ", ",", '"', "\n", "\r\n", '""', "x,y", ""]
    buf = io.StringIO()
    w = csv.writer(buf, lineterminator=rnd.choice(["\n", "\r\n"]))
    w.writerow([f"c{i}" for i in range(cells)])
    for _ in range(rows):
        quoted = rnd.random() < 0.4
        n = rnd.choice([cells] * 6 + [cells - 1, cells + 1])
        w.writerow(["".join(rnd.choice(alphabet if quoted else alphabet[:4]) for _ in range(rnd.randint(0, 12))) or "e" for _ in range(n)])
    return buf.getvalue()


def plain(text):
    return [r for r in csv.reader(io.StringIO(text, newline="")) if r]


@pytest.fixture()
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda n: (spark.conf.set("spark.sql.files.maxPartitionBytes", str(n)), spark.conf.set("spark.sql.files.openCostInBytes", "1"))
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("split", [11, 64, 700, 1 << 20])
def test_records_do_not_depend_on_splits(spark, tmp, small_splits, split):
    want, paths = [], []
    for k in range(3):
        text = make(10 * split + k, 60)
        paths.append(f"{tmp}/f {k}.csv")
        with open(paths[-1], "w", newline="", encoding="utf-8-sig" if k else "utf-8") as f:
            f.write(text if k < 2 else "\n  \n" + text + "\n \t\n")
        want += [(f"f%20{k}.csv", i == 0, r) for i, r in enumerate(plain(text))]
    small_splits(split)
    got = [(r.file.rsplit("/", 1)[1], r.header, r.cells) for r in csv_records(spark, paths).collect() if r.reason is None]
    assert sorted(got) == sorted(want)


def test_lines_and_cells():
    assert cells_of(b'a,"b ""q"" c",,"x"y,') == ["a", 'b "q" c', "", "xy", ""]
    assert cells_of(b'5" pipe,"d\r\n,e"') == ['5" pipe', "d\r\n,e"]
    assert not ends_inside(b'5" pipe,b', False) and ends_inside(b'a,"b', False)
    assert ends_inside(b"a,b", True) and not ends_inside(b'x"" y",z', True) and ends_inside(b'x",a,"', True)


def test_rejected_records(spark, tmp, small_splits):
    with open(f"{tmp}/E0_2021.csv", "w") as f:
        f.write('Date,H,H,h\n1,2,3,4\n1,2,3,4,\n1,"two\nlines, ""q""",3\n9,"never closed\n' + "x,y\n" * 200)
    for split in (32, 1 << 20):
        small_splits(split)
        df = FS.read_odds_csv(spark, tmp)
        assert df.columns == ["Date", "H", "H.1", "h.2", "league", "season", "source_file"]
        got = sorted(tuple(r)[:4] for r in df.collect())
        assert got == sorted([("1", "2", "3", "4"), ("1", 'two\nlines, "q"', "3", None)])
        bad = {r.reason: r.cells for r in FS.rejected_records(spark, tmp).collect()}
        assert bad.keys() == {"too_many_cells", "unclosed_quote"} and bad["too_many_cells"] == ["1", "2", "3", "4", ""]
        long = csv_records(spark, [f"{tmp}/E0_2021.csv"], max_record=300).where("reason = 'too_long'").collect()
        assert len(long) == 1 and long[0].cells is None


def test_file_columns_give_way_and_bytes_that_are_not_utf8(spark, tmp):
    with open(f"{tmp}/SP1_2122.csv", "wb") as f:
        f.write(b'Date,Season,league,HomeTeam\n1,s,l,"Caf\xe9"\n2,s,l,Caf\xe9\n')
    rows = FS.read_odds_csv(spark, tmp).collect()
    assert [(r.Date, r.league, r.season, r.HomeTeam) for r in sorted(rows)] == [("1", "SP1", "2122", "Caf�"), ("2", "SP1", "2122", "Caf�")]
    assert os.listdir(tmp) == ["SP1_2122.csv"]

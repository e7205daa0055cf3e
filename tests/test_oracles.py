"""Every registered query against its DuckDB oracle (the driver's check) at sf0.001."""

import pytest

from oracle_check import compare

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() == 4 and "profit_margin" in df.columns


def test_all_registered_queries_match_oracle(spark):
    from __spark_entry__ import oracle_sql, queries
    assert set(oracle_sql()) <= set(queries())
    res = compare(spark, SF, list(oracle_sql()))
    bad = {k: v for k, v in res.items() if v[0] == "MISMATCH"}
    assert not bad, bad


@pytest.mark.parametrize("name", ["detect_snapshot", "detect_snapshot_li"])
def test_flagship_counts(spark, name):
    from __spark_entry__ import queries
    expected = {"detect_snapshot": 4, "detect_snapshot_li": 820}
    assert queries()[name](spark, SF).count() == expected[name]

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pricefold.session import session
    s = session("local[4]", app="pricefold-tests", conf={"spark.sql.shuffle.partitions": "8"})
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


def odds_rows(spark, rows):
    """Odds DataFrame from tuples (match, book, h, d, a, event_ms, real_ms)."""
    from pricefold.schema import ODDS_SCHEMA
    full = [(m, None, None, None, None, b, h, d, a, e, r) for (m, b, h, d, a, e, r) in rows]
    return spark.createDataFrame(full, ODDS_SCHEMA)

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))
import compare  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

CORE = {k for part in entry.CORE for k in part.QUERIES}


def test_registration():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert CORE <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(CORE))
def test_query_against_sql(spark, tiny, name):
    df = entry.queries()[name](spark, tiny)
    got = compare.rows_of(df.columns, [tuple(r) for r in df.collect()])
    sql = entry.oracle_sql().get(name)
    if sql:
        res = compare.connect(tiny).execute(sql)
        cols = [x[0] for x in res.description]
        assert sorted(cols) == sorted(df.columns)
        assert compare.rows_of(cols, res.fetchall()) == got
    else:
        assert got


def test_entry(spark, tiny):
    assert entry.entry(spark).count() > 0

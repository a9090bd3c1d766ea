import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))
import compare  # noqa: E402

queries = pytest.importorskip("fieldlark.llm.queries")


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_against_sql(spark, tiny, name):
    df = queries.QUERIES[name](spark, tiny)
    got = compare.rows_of(df.columns, [tuple(r) for r in df.collect()])
    sql = queries.SQL.get(name)
    if sql:
        res = compare.connect(tiny).execute(sql)
        cols = [x[0] for x in res.description]
        assert sorted(cols) == sorted(df.columns)
        assert compare.rows_of(cols, res.fetchall()) == got

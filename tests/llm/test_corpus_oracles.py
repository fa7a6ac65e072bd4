"""The queries that SQL can express give the oracle's rows."""

import duckdb
import pytest

from textmill.llm import entry

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    result = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    df = entry.queries()[name](spark, SF)
    assert sorted(names) == sorted(df.columns)
    want = sorted(repr([dict(zip(names, row))[c] for c in sorted(names)]) for row in result.fetchall())
    assert sorted(repr([r[c] for c in sorted(names)]) for r in df.collect()) == want

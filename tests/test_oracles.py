"""Every query with an oracle gives the oracle's rows; the others run."""

import duckdb
import pytest

from textmill import plans

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, oracle, name):
    df = plans.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(repr([plain(r[c]) for c in columns]) for r in df.toArrow().to_pylist())
    if name not in plans.ORACLES:
        assert got
        return
    result = oracle.execute(plans.ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = sorted(repr([plain(dict(zip(names, row))[c]) for c in columns]) for row in result.fetchall())
    assert got == want


def test_entry_runs_and_names_match(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(plans.QUERIES) <= set(entry.queries())

"""Every registered query of the engine against its SQL oracle."""

import duckdb
import pytest

from millrace import queries as engine

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(engine.oracle_sql()))
def test_matches_oracle(spark, sf, con, name):
    df = engine.queries()[name](spark, sf)
    ours = sorted(map(str, (tuple(r) for r in df.collect())))
    cursor = con.execute(engine.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    theirs = sorted(map(str, (tuple(r[names.index(c)] for c in df.columns) for r in cursor.fetchall())))
    assert ours == theirs


def test_entry_runs_without_the_optional_part(spark):
    import __spark_entry__ as e

    assert set(engine.queries()) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())


def test_greedy_batches_keep_limits(spark, sf):
    rows = engine.queries()["greedy_batches"](spark, sf).collect()
    assert rows and all(r["total"] <= 2000 and r["n"] <= 64 for r in rows)

"""Every registered query of the record engine against its SQL in DuckDB."""

import duckdb
import pytest

from millrace.plans import queries as Q

DATA = "/root/testdata"
DIR = f"{DATA}/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def one(v):
        if v is None or v != v:
            return "null"
        return f"{float(v):.5f}" if hasattr(v, "__float__") and not isinstance(v, (bool, str)) else str(v)

    return sorted(tuple(one(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query(spark, name):
    df = Q.QUERIES[name](spark, DIR)
    rows = df.collect()
    assert len(set(df.columns)) == len(df.columns)
    if name in Q.SQL:
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
        want = con.execute(Q.SQL[name])
        names = [c[0] for c in want.description]
        assert sorted(names) == sorted(df.columns)
        assert canonical(rows, df.columns) == canonical(want.fetchall(), names)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())

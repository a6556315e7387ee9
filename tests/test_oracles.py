"""Every query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def same(v):
    return round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else v


def table(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(same(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    answer = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == sorted(df.columns)
    assert table(df.collect(), df.columns) == table(answer.fetchall(), names)

"""Every registered query of the act analytics against its DuckDB SQL, on the smallest data."""

from __future__ import annotations

import datetime

import duckdb
import pytest

from actlens.plans import registry

#: Queries that SQL cannot express, tested against plain readings in test_operators.
PLAIN = {"partition_parts", "partition_outline", "partition_chunks"}
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def db(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def cell(v):
    if v is None or v != v:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (datetime.date, datetime.datetime)):
        return str(v)
    try:
        return round(float(v), 6) if not isinstance(v, str) else v
    except (TypeError, ValueError):
        return str(v)


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(cell(r[i]) for i in order) for r in values), key=repr)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, sf_dir, db, name):
    df = registry.queries()[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert name in PLAIN
        return
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, got) == rows(names, result.fetchall())


def test_every_sql_has_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())

from __future__ import annotations

import os
import re

import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def test_names_and_pairs():
    names = entry.queries()
    assert len(names) > 150
    assert set(entry.oracle_sql()) <= set(names)
    assert len([n for n in names if not re.match(r"op\d+_|pipeline$", n)]) > 150
    assert entry.FLAGSHIP in names


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")
def test_every_sql_runs():
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    for name, sql in entry.oracle_sql().items():
        assert con.execute(sql).description, name


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")
def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 4 and "sessions_entered" in df.columns

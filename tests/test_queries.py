from __future__ import annotations

import duckdb
import pytest

import checks
from tests.conftest import SF
from tools.compare import TABLES, rows_of

QUERIES, SQL = checks.load()
#: This SQL names the one feature that correlation prunes at that size.
AT_SIZE = dict.fromkeys(("select_features", "stage_select"), "/root/testdata/sf0.01")
@pytest.fixture(scope="module")
def duck():
    made = {}

    def connect(folder):
        if folder not in made:
            made[folder] = duckdb.connect()
            for t in TABLES:
                made[folder].execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
        return made[folder]

    return connect


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, duck, name):
    folder = AT_SIZE.get(name, SF)
    df = QUERIES[name](spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = duck(folder).execute(SQL[name])
    assert got == rows_of([d[0] for d in cur.description], cur.fetchall())


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_runs(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns == ["feature", "iv"] and df.count() == 12

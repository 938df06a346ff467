"""Driver contract: entry() runs, every query has an oracle, and a sample of queries
matches its DuckDB oracle on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from given_tables import SF0001
from rivulet.plans import oracles, registry
from tools.compare import rows as _rows

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["win_start", "win_end", "event_type", "cnt", "total_value"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(oracles()) == set(registry())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(registry()))
def test_query_matches_oracle_sf0001(spark, duck, name):
    con = duck
    got = entry.queries()[name](spark, SF0001).toPandas()
    want = con.execute(entry.oracle_sql()[name]).df()
    assert _rows(got) == _rows(want)

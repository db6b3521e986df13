"""Driver contract: entry smoke, registry shape, and every query against its DuckDB SQL."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from scripts.oracle_check import TABLES, digest
from tests.conftest import SF

# the optional subpackage tests its own queries
OWN = sorted({**E.batch_queries(), **E.stream_queries()})


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["event_id", "line_id", "line_name", "severity", "is_known_line", "n_stations",
                          "n_routes", "gridlock_alert"]


def test_every_query_has_oracle():
    assert set(OWN) <= set(E.queries()) and set(OWN) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, duck, name):
    got = digest(E.queries()[name](spark, SF).toPandas())
    want = digest(duck.execute(E.oracle_sql()[name]).df())
    assert got == want


def test_queries_do_not_depend_on_the_callers_time_zone(spark, duck):
    """The caller's session may use any zone; the registered queries fix UTC themselves."""
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        for name in ("iso_timestamp", "worst_status", "parse_props"):
            got = digest(E.queries()[name](spark, SF).toPandas())
            assert got == digest(duck.execute(E.oracle_sql()[name]).df()), name
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("name", OWN)
def test_outputs_are_scalar_and_uniquely_named(spark, name):
    schema = E.queries()[name](spark, SF).schema
    names = [f.name for f in schema.fields]
    assert len(names) == len(set(names))
    assert all(f.dataType.typeName() in ("string", "integer", "long", "double", "boolean") for f in schema.fields), \
        [(f.name, f.dataType.simpleString()) for f in schema.fields]

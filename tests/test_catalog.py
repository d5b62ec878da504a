"""Every registered query on the smallest scale, against its SQL and against plan rules."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F
from support import SF

import __spark_entry__ as contract
from curbside.catalog import ORACLE_SQL, QUERIES, tables
from curbside.operators import clean
from curbside.plans.settle import settle, settling

TYPES = {"boolean": "BOOLEAN", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}
# Model fits without a SQL counterpart are covered by the model tests.
SLOW = {"m8_boosted_trees", "m9_feature_importances", "m10_model_comparison", "o6_importances_ascending"}


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_sql_has_a_query():
    assert set(ORACLE_SQL) <= set(QUERIES)
    assert contract.queries().keys() >= QUERIES.keys()
    assert contract.oracle_sql().keys() >= ORACLE_SQL.keys()


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SLOW])
def test_query(spark, engine, name):
    before = set(spark.sparkContext._jsc.getPersistentRDDs())
    with settling():
        check(spark, engine, name)
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= before  # no table stays behind


def check(spark, engine, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for forbidden in ("NestedLoopJoin", "CartesianProduct", "PythonUDF", "BatchEvalPython", "ArrowEvalPython"):
        assert forbidden not in plan
    rows = df.collect()
    if name not in ORACLE_SQL:
        assert rows
        return
    expected = engine.sql(ORACLE_SQL[name])
    names = sorted(df.columns)
    assert names == sorted(expected.columns)
    kinds = dict(zip(expected.columns, map(str, expected.types), strict=True))
    assert {n: TYPES[t] for n, t in df.dtypes} == kinds
    order = [expected.columns.index(n) for n in names]
    want = Counter(tuple(row[i] for i in order) for row in expected.fetchall())
    assert Counter(tuple(row[n] for n in names) for row in rows) == want


def test_wide_tables_lie_on_both_sides_of_the_bounds(spark):
    trips = tables.wide_trips(spark, "/root/testdata/sf0.01")
    minutes = clean.duration_min()
    for value, low, high in (("passenger_count", 1, 8), ("trip_distance", 0.1, 100), ("PULocationID", 1, 265), (minutes, 1, 300)):
        column = F.col(value) if isinstance(value, str) else value
        found = trips.agg(F.count_if(column < low), F.count_if(column.between(low, high)), F.count_if(column > high)).first()
        assert min(found) > 100, value
    miles = QUERIES["f9_fare_per_mile_wide"](spark, SF).agg(F.count_if(F.col("fare_per_mile").isNull()), F.count("fare_per_mile")).first()
    assert min(miles) > 100
    scored = QUERIES["f14_capped_distance_wide"](spark, SF).collect()
    assert {r.nearest_station_km > 30 for r in scored} == {True, False}
    assert all(r.nearest_station_km_clipped == min(r.nearest_station_km, 30) for r in scored)


def test_settled_tables_go_with_their_block_also_after_a_failure(spark):
    kept = lambda: len(spark.sparkContext._jsc.getPersistentRDDs())
    before, inner, outer = kept(), spark.range(5).selectExpr("id * 3 AS x"), spark.range(7).selectExpr("id * 5 AS y")
    with settling():
        settle(outer).count()
        with pytest.raises(ValueError), settling():
            settle(inner).count()
            assert kept() == before + 2
            raise ValueError
        assert kept() == before + 1 and outer.is_cached
    assert kept() == before
    assert settle(inner).count() == 5 and kept() == before + 1  # without a block it is the caller's
    inner.unpersist()


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert [r["rank"] for r in rows] == list(range(1, 11))


@pytest.mark.parametrize("name", ["c6_scaling_sizes", "s14_scaling_json", "s9_dated_trips", "s4_source_choice"])
def test_trips_are_derived_once(spark, monkeypatch, name):
    """However often a query reads the trips, lineitem and orders are joined in one of its jobs."""
    from pyspark.sql import DataFrameWriter

    joins = []
    collect = lambda df: joins.append("o_orderkey" in df._jdf.queryExecution().optimizedPlan().toString())
    for kind in ("parquet", "csv", "json", "save"):
        plain = getattr(DataFrameWriter, kind)
        monkeypatch.setattr(DataFrameWriter, kind, lambda self, *a, plain=plain, **b: (collect(self._df), plain(self, *a, **b))[1])
    result = QUERIES[name](spark, SF)
    collect(result)
    assert joins.count(True) == 1 and len(joins) > 2

"""The given tables seen as trips, zones and stations.

One SQL text per table, run unchanged by Spark and by the check engine. Every row of lineitem,
nation and supplier becomes a trip, a zone and a station; nothing is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from curbside.sources.schema import conform

def _trips_sql(passengers: str, seconds: str, miles: str, pickup_zone: str) -> str:
    return f"""
SELECT CAST(l_suppkey % 2 + 1 AS INT) AS VendorID,
       o_orderdate + sec * INTERVAL '1' SECOND AS tpep_pickup_datetime,
       o_orderdate + (sec + dur) * INTERVAL '1' SECOND AS tpep_dropoff_datetime,
       CAST({passengers} AS DOUBLE) AS passenger_count,
       {miles} AS trip_distance,
       CAST(1 AS DOUBLE) AS RatecodeID,
       CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
       CAST({pickup_zone} AS INT) AS PULocationID,
       CAST(l_suppkey % 28 AS INT) AS DOLocationID,
       CAST(l_partkey % 4 + 1 AS INT) AS payment_type,
       l_extendedprice / 200 AS fare_amount,
       CAST(0 AS DOUBLE) AS extra, CAST(0.5 AS DOUBLE) AS mta_tax,
       l_extendedprice / 200 * l_discount AS tip_amount,
       CAST(0 AS DOUBLE) AS tolls_amount, CAST(0.3 AS DOUBLE) AS improvement_surcharge,
       l_extendedprice / 200 * (1 + l_tax) - 10 AS total_amount,
       CAST(2.5 AS DOUBLE) AS congestion_surcharge
FROM (SELECT *, (l_orderkey * 7919 + l_partkey * 104729 + l_linenumber * 613) % 86400 AS sec,
             {seconds} AS dur
      FROM {{lineitem}}) l JOIN {{orders}} ON l_orderkey = o_orderkey
"""


TRIPS_SQL = _trips_sql(
    passengers="NULLIF(l_linenumber, 7)",
    seconds="(l_partkey * 17 + l_suppkey * 29) % 5400",
    miles="(l_quantity * 4 - 3) / 20",
    pickup_zone="o_custkey % 30 + 1",
)

# The same trips with values on both sides of bounds that those above never reach: 0 to 10 passengers, 0 to 360
# minutes, 0 to 122.5 miles, pickup zones 0 to 270.
WIDE_TRIPS_SQL = _trips_sql(
    passengers="NULLIF(l_linenumber, 7) * 2 - 2",
    seconds="(l_partkey * 613 + l_suppkey * 29) % 21600",
    miles="(l_quantity - 1) * 5 / 2",
    pickup_zone="o_custkey % 271",
)


def _zones_sql(moved: str = "") -> str:
    return f"""
SELECT CAST(n_nationkey + 1 AS INT) AS zone_id, n_name AS zone_name, r_name AS borough,
       CAST(40.5 AS DOUBLE) + n_nationkey * 7 % 25 * CAST(0.018 AS DOUBLE){moved} AS zone_lat,
       CAST(-74.25 AS DOUBLE) + n_nationkey * 11 % 25 * CAST(0.022 AS DOUBLE) AS zone_lon
FROM {{nation}} JOIN {{region}} ON n_regionkey = r_regionkey
"""


# Pickup zones 26-30 have no row here on purpose.
ZONES_SQL = _zones_sql()

# Zones 21 to 25 lie 22 to 111 km further north, most of them beyond the cap of the distance to a station.
WIDE_ZONES_SQL = _zones_sql(" + greatest(n_nationkey - 19, 0) * CAST(0.2 AS DOUBLE)")

# Suppliers are scattered around 15 of the zones, so the other zones stay without a station nearby
# however many suppliers there are.
STATIONS_SQL = """
SELECT s_name AS name,
       CAST(40.5 AS DOUBLE) + s_nationkey % 15 * 7 % 25 * CAST(0.018 AS DOUBLE)
         + (s_suppkey * 37 % 101 - 50) * CAST(0.0004 AS DOUBLE) AS lat,
       CAST(-74.25 AS DOUBLE) + s_nationkey % 15 * 11 % 25 * CAST(0.022 AS DOUBLE)
         + (s_suppkey * 53 % 97 - 48) * CAST(0.0005 AS DOUBLE) AS lon,
       CAST(s_suppkey % 20 + 1 AS INT) AS num_chargers
FROM {supplier}
"""


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _mapped(spark: SparkSession, sf_dir: str, sql: str, *names: str) -> DataFrame:
    return spark.sql(sql, **{name: _table(spark, sf_dir, name) for name in names})


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(_mapped(spark, sf_dir, TRIPS_SQL, "lineitem", "orders"))


def wide_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(_mapped(spark, sf_dir, WIDE_TRIPS_SQL, "lineitem", "orders"))


def wide_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mapped(spark, sf_dir, WIDE_ZONES_SQL, "nation", "region")


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mapped(spark, sf_dir, ZONES_SQL, "nation", "region")


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mapped(spark, sf_dir, STATIONS_SQL, "supplier")

"""Values that several test modules share. Not named conftest: another folder has a module of that name."""

from datetime import datetime

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"

GOOD_TRIP = {
    "VendorID": 1,
    "tpep_pickup_datetime": datetime(2023, 1, 4, 8, 0, 0),
    "tpep_dropoff_datetime": datetime(2023, 1, 4, 8, 30, 0),
    "passenger_count": 2.0,
    "trip_distance": 5.0,
    "RatecodeID": 1.0,
    "store_and_fwd_flag": "N",
    "PULocationID": 161,
    "DOLocationID": 162,
    "payment_type": 1,
    "fare_amount": 20.0,
    "extra": 0.0,
    "mta_tax": 0.5,
    "tip_amount": 2.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 0.3,
    "total_amount": 25.0,
    "congestion_surcharge": 2.5,
}


def as_ntz(df):
    names = ("tpep_pickup_datetime", "tpep_dropoff_datetime")
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})

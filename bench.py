"""Headline timings on the given tables, as one JSON line.

The mapped trips are first written once as Parquet and CSV (not timed), because the work to be
measured starts from stored trip files. Every query is then run to the end on all rows; the best of
two runs counts, except for the long ones, which run once.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from pathlib import Path

from curbside.catalog import tables
from curbside.operators import aggregates, clean, features, models
from curbside.params import Params
from curbside.plans import build_session, settle
from curbside.plans.job import run_job
from curbside.plans.sites import recommend_from_trips
from curbside.sources import read_trips


def finish(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "curbside bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")

    work = tempfile.mkdtemp(prefix="curbside-bench-")
    parquet, csv = f"{work}/trips.parquet", f"{work}/trips_text.csv"
    mapped = tables.trips(spark, folder).repartition(int(cpus))
    mapped.write.parquet(parquet)
    spark.read.parquet(parquet).write.option("header", True).csv(csv)
    tables.zones(spark, folder).write.parquet(f"{work}/zones.parquet")
    tables.stations(spark, folder).write.parquet(f"{work}/stations.parquet")

    def trips():
        return read_trips(spark, parquet)

    def zones():
        return spark.read.parquet(f"{work}/zones.parquet")

    def stations():
        return spark.read.parquet(f"{work}/stations.parquet")

    def zone_aggregates():
        return aggregates.zone_aggregates(features.trip_features(trips()), zones())

    zone_table = settle(zone_aggregates())
    hourly = settle(aggregates.hourly_demand(features.trip_features(trips()), zones()))
    zone_table.count(), hourly.count()  # computed before the models are timed

    repeated = {
        "c5_compact_etl_csv": lambda: finish(aggregates.compact_etl(read_trips(spark, csv))),
        "c5_compact_etl_parquet": lambda: finish(aggregates.compact_etl(trips())),
        "c1_clean_and_engineer": lambda: finish(features.clean_and_engineer(trips(), zones())),
        "a1_zone_aggregates": lambda: finish(zone_aggregates()),
        "a2_hourly_demand": lambda: finish(
            aggregates.hourly_demand(features.trip_features(trips()), zones())
        ),
        "p21_rule_audit": lambda: finish(clean.audit(trips())),
        "c3_site_recommendations": lambda: finish(
            recommend_from_trips(trips(), zones(), stations())
        ),
        "m3_kmeans": lambda: finish(models.run_kmeans(zone_table)[2]),
    }
    once = {
        "m4_k_sweep": lambda: finish(models.k_sweep(zone_table, range(2, 10))),
        "m10_model_comparison": lambda: finish(models.run_regression(hourly)[0]),
        "c4_full_job": lambda: run_job(
            trips(), zones(), stations(), f"{work}/job", Params(), sweep=None
        ),
    }
    seconds = {}
    for name, run in {**repeated, **once}.items():
        best = float("inf")
        for _ in range(2 if name in repeated else 1):
            start = time.perf_counter()
            run()
            best = min(best, time.perf_counter() - start)
        seconds[name] = round(best, 3)

    rows = trips().count()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
                "trips": rows,
                "compact_csv_rows_per_second": round(rows / seconds["c5_compact_etl_csv"]),
                "compact_parquet_rows_per_second": round(rows / seconds["c5_compact_etl_parquet"]),
            }
        )
    )


if __name__ == "__main__":
    main()

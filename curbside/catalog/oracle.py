"""The same results in plain SQL, for a check engine with the given tables as views."""

from __future__ import annotations

from curbside.catalog.tables import STATIONS_SQL, TRIPS_SQL, WIDE_TRIPS_SQL, WIDE_ZONES_SQL, ZONES_SQL

_NAMES = {n: n for n in ("lineitem", "orders", "nation", "region", "supplier")}

_SECONDS = "CAST(floor(epoch({0})) AS BIGINT)"
_PICKUP_S = _SECONDS.format("tpep_pickup_datetime")
_DROPOFF_S = _SECONDS.format("tpep_dropoff_datetime")
_MINUTES = f"(({_DROPOFF_S} - {_PICKUP_S}) / CAST(60 AS DOUBLE))"
_SPEED = f"CASE WHEN {_MINUTES} > 0 THEN trip_distance / ({_MINUTES} / CAST(60 AS DOUBLE)) END"
_FARE_PER_MILE = "CASE WHEN trip_distance > 0 THEN fare_amount / trip_distance END"
_HOUR = "CAST(hour(tpep_pickup_datetime) AS INT)"
_DOW = "CAST(dayofweek(tpep_pickup_datetime) + 1 AS INT)"
_MONTH = "CAST(month(tpep_pickup_datetime) AS INT)"
_WEEKEND = f"CAST(CASE WHEN {_DOW} IN (1, 7) THEN 1 ELSE 0 END AS INT)"


def _rush(hour: str) -> str:
    return f"CAST(CASE WHEN {hour} BETWEEN 7 AND 9 OR {hour} BETWEEN 16 AND 19 THEN 1 ELSE 0 END AS INT)"


_DAY_PART = f"""CASE WHEN {_HOUR} BETWEEN 0 AND 5 THEN 'late_night'
    WHEN {_HOUR} BETWEEN 6 AND 9 THEN 'morning_rush' WHEN {_HOUR} BETWEEN 10 AND 15 THEN 'midday'
    WHEN {_HOUR} BETWEEN 16 AND 19 THEN 'evening_rush' ELSE 'evening' END"""


def _present(*names: str) -> str:
    floating = {"trip_distance", "fare_amount", "passenger_count"}
    checks = [f"{n} IS NOT NULL" for n in names]
    return " AND ".join(checks + [f"NOT isnan({n})" for n in names if n in floating])


_RULES = {
    "required": _present(
        "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_distance",
        "PULocationID", "DOLocationID", "fare_amount", "passenger_count",
    ),
    "distance": "trip_distance BETWEEN 0.1 AND 100",
    "fare": "fare_amount BETWEEN 2.5 AND 500",
    "passengers": "passenger_count BETWEEN 1 AND 8",
    "time_order": "tpep_dropoff_datetime > tpep_pickup_datetime",
    "pickup_zone": "PULocationID BETWEEN 1 AND 265",
    "dropoff_zone": "DOLocationID BETWEEN 1 AND 265",
    "total": "total_amount > 0",
    "duration": f"{_MINUTES} BETWEEN 1 AND 300",
    "speed": f"{_SPEED} BETWEEN 0.5 AND 80",
}
_BASIC = list(_RULES)[:8]
_COMPACT = _present("trip_distance", "fare_amount", "passenger_count", "PULocationID") + "".join(
    f" AND {_RULES[n]}" for n in ("distance", "fare", "passengers")
)


def _where(names: list[str]) -> str:
    return " AND ".join(f"({_RULES[n]})" for n in names)


def _haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (
        f"(pow(sin(radians({lat2} - {lat1}) / 2), 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))"
    )
    return f"(12742 * atan2(sqrt({a}), sqrt(1 - {a})))"


_CLUSTER_FEATURES = (
    "total_trips", "avg_distance", "avg_fare", "avg_speed_mph", "rush_hour_fraction",
    "weekend_fraction", "avg_duration_min",
)
_DEMAND_FEATURES = (
    "PULocationID", "pickup_hour", "pickup_dow", "is_weekend", "is_rush_hour", "avg_distance", "avg_fare",
)
_BUCKET = "CAST('0x' || substring(md5({0}), 1, 8) AS BIGINT) % 100"
_DEMAND_BUCKET = _BUCKET.format("concat_ws('|', PULocationID, pickup_hour, pickup_dow)")


def _ranked(min_trips: int) -> str:
    """Scored zones above the threshold and not covered, ranked, with name and savings."""
    return f"""
SELECT s.PULocationID, s.borough, lat, lon, total_trips, rush_hour_fraction, avg_distance, avg_fare,
       demand_score, nearest_station_km, chargers_within_1km, nearest_station_km_clipped, gap_score,
       priority_score, coalesce(zone_name, 'Zone ' || s.PULocationID) AS zone_name,
       annual_trips_est, annual_co2_saved_kg,
       round_even(annual_co2_saved_kg / CAST(1000 AS DOUBLE) * 10, 0) / 10 AS annual_co2_saved_tonnes,
       CAST(row_number() OVER (ORDER BY priority_score DESC, s.PULocationID) AS INT) AS rank
FROM (SELECT *, CAST(round_even(annual_trips_est * CAST(0.3 AS DOUBLE) * (324 * avg_distance) / 1000, 0)
                     AS BIGINT) AS annual_co2_saved_kg
      FROM (SELECT *, CAST(total_trips * 12 AS BIGINT) AS annual_trips_est FROM scored)) s
LEFT JOIN zones ON zone_id = s.PULocationID
WHERE total_trips >= {min_trips} AND chargers_within_1km < 2
ORDER BY priority_score DESC, s.PULocationID LIMIT 10"""


def _summary_of(clustered: str) -> str:
    return f"""SELECT c.*, b.borough AS dominant_borough FROM (
  SELECT cluster, count(*) AS num_zones, CAST(sum(total_trips) AS BIGINT) AS total_trips,
         avg(total_trips) AS avg_trips_per_zone, avg(avg_distance) AS avg_distance,
         avg(avg_fare) AS avg_fare, avg(rush_hour_fraction) AS rush_hour_fraction,
         avg(weekend_fraction) AS weekend_fraction, avg(lat) AS centroid_lat, avg(lon) AS centroid_lon
  FROM {clustered} GROUP BY cluster) c
LEFT JOIN (SELECT cluster, borough, row_number() OVER (
             PARTITION BY cluster ORDER BY count(*) DESC, borough) AS place
           FROM {clustered} WHERE borough IS NOT NULL GROUP BY cluster, borough) b
  ON b.cluster = c.cluster AND place = 1"""


def _apart(a: str, b: str) -> str:
    """Squared distance of two rows of scaled features."""
    return " + ".join(f"({a}.{n}_z - {b}.{n}_z) * ({a}.{n}_z - {b}.{n}_z)" for n in _CLUSTER_FEATURES)


_REGRESSED = (*_DEMAND_FEATURES, "trip_count")


def _pivot(p: int) -> str:
    """One step of Gauss-Jordan elimination on the one-row table of the equations; the last column is the right side."""
    size = len(_DEMAND_FEATURES)
    kept = [f"m{i}" for i in range(size + 1)]
    for i in range(size):
        for j in range(p + 1, size + 1):
            reduced = f"a{p}_{j} / a{p}_{p}" if i == p else f"a{i}_{j} - a{i}_{p} * a{p}_{j} / a{p}_{p}"
            kept.append(f"{reduced} AS a{i}_{j}")
    return f"SELECT {', '.join(kept)} FROM {f'solved{p - 1}' if p else 'gram'}"


_BINS = 32


def _tree_tables(trees: int, depth: int) -> dict[str, tuple[tuple[str, ...], str]]:
    """The tables of boosted trees: rows with bins, then for each level the rows' nodes and the nodes' best splits."""
    names = _DEMAND_FEATURES
    ends = ", ".join(f"min(CAST({n} AS DOUBLE)) AS low{i}, max(CAST({n} AS DOUBLE)) AS high{i}" for i, n in enumerate(names))
    bins = ", ".join(
        f"len([j for j in range(1, {_BINS}) if low{i} < high{i} AND low{i} + (high{i} - low{i}) * j / {_BINS} < CAST({n} AS DOUBLE)])"
        for i, n in enumerate(names)
    )
    out = {
        "tree_ends": (("hourly",), f"SELECT {ends} FROM hourly WHERE {_DEMAND_BUCKET} < 80"),
        "tree_rows0": (
            ("hourly", "tree_ends"),
            f"""SELECT PULocationID, pickup_hour, pickup_dow, trip_count, {_DEMAND_BUCKET} < 80 AS train, [{bins}] AS bins,
       CAST(0 AS DOUBLE) AS prediction FROM hourly, tree_ends""",
        ),
    }
    for t in range(trees):
        out[f"nodes{t}_0"] = ((f"tree_rows{t}",), f"SELECT *, trip_count - prediction AS e, 1 AS node FROM tree_rows{t}")
        for level in range(depth):
            rows, best = f"nodes{t}_{level}", f"best{t}_{level}"
            out[best] = (
                (rows,),
                f"""SELECT node, feature, bin, gain FROM (
  SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain DESC, feature, bin) AS place FROM (
    SELECT *, round(ls * ls / ln + (s - ls) * (s - ls) / (n - ln) - s * s / n, 6) AS gain FROM (
      SELECT node, feature, bin, sum(s) OVER upto AS ls, sum(n) OVER upto AS ln,
             sum(s) OVER whole AS s, sum(n) OVER whole AS n, sum(q) OVER whole AS q
      FROM (SELECT node, feature, bin, sum(e) AS s, sum(e * e) AS q, CAST(count(*) AS BIGINT) AS n
            FROM (SELECT node, e, unnest(range({len(names)})) AS feature, unnest(bins) AS bin
                  FROM {rows} WHERE train AND node >= {1 << level}) GROUP BY node, feature, bin)
      WINDOW whole AS (PARTITION BY node, feature), upto AS (PARTITION BY node, feature ORDER BY bin))
    WHERE n > ln)
  WHERE gain > CAST(1e-9 AS DOUBLE) * q)
WHERE place = 1""",
            )
            out[f"nodes{t}_{level + 1}"] = (
                (rows, best),
                f"""SELECT r.* REPLACE (CASE WHEN b.node IS NULL THEN r.node ELSE 2 * r.node
    + CASE WHEN r.bins[b.feature + 1] <= b.bin THEN 0 ELSE 1 END END AS node)
FROM {rows} r LEFT JOIN {best} b ON b.node = r.node""",
            )
        out[f"tree_rows{t + 1}"] = (
            (f"nodes{t}_{depth}",),
            f"""SELECT PULocationID, pickup_hour, pickup_dow, trip_count, train, bins,
       prediction + {"1" if t == 0 else "CAST(0.1 AS DOUBLE)"} * mean AS prediction
FROM nodes{t}_{depth} JOIN (SELECT node, avg(e) AS mean FROM nodes{t}_{depth} WHERE train GROUP BY node) USING (node)""",
        )
    return out


# Common table expressions by name: (names it reads, text).
_CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "trips": ((), TRIPS_SQL.format(**_NAMES)),
    "zones": ((), ZONES_SQL.format(**_NAMES)),
    "stations": ((), STATIONS_SQL.format(**_NAMES)),
    "clean": (("trips",), f"SELECT * FROM trips WHERE {_where(_BASIC)}"),
    "features": (
        ("clean",),
        f"""SELECT *, {_HOUR} AS pickup_hour, {_DOW} AS pickup_dow, {_MONTH} AS pickup_month,
       {_WEEKEND} AS is_weekend, {_rush(_HOUR)} AS is_rush_hour, {_DAY_PART} AS time_of_day,
       {_MINUTES} AS trip_duration_min, {_SPEED} AS speed_mph, {_FARE_PER_MILE} AS fare_per_mile
FROM clean WHERE {_where(["duration", "speed"])}""",
    ),
    "zone_sums": (
        ("features",),
        """SELECT PULocationID, count(*) AS total_trips, avg(trip_distance) AS avg_distance,
       avg(fare_amount) AS avg_fare, avg(passenger_count) AS avg_passengers,
       avg(trip_duration_min) AS avg_duration_min, avg(speed_mph) AS avg_speed_mph,
       CAST(sum(is_rush_hour) AS DOUBLE) AS rush_hour_trips,
       avg(CAST(is_weekend AS DOUBLE)) AS weekend_fraction
FROM features GROUP BY PULocationID""",
    ),
    "zone_agg": (
        ("zone_sums", "zones"),
        """SELECT a.*, zone_lat AS lat, zone_lon AS lon, borough,
       rush_hour_trips / total_trips AS rush_hour_fraction
FROM zone_sums a LEFT JOIN zones ON zone_id = PULocationID""",
    ),
    "located": (("zone_agg",), "SELECT * FROM zone_agg WHERE lat IS NOT NULL AND lon IS NOT NULL"),
    "hourly": (
        ("features", "zones"),
        """SELECT h.*, borough FROM (
  SELECT PULocationID, pickup_hour, pickup_dow, count(*) AS trip_count,
         avg(trip_distance) AS avg_distance, avg(fare_amount) AS avg_fare,
         max(is_weekend) AS is_weekend, max(is_rush_hour) AS is_rush_hour
  FROM features GROUP BY PULocationID, pickup_hour, pickup_dow) h
LEFT JOIN zones ON zone_id = PULocationID""",
    ),
    "station_km": (
        ("zones", "stations"),
        f"""SELECT zone_id, name, num_chargers, {_haversine("zone_lat", "zone_lon", "lat", "lon")} AS km
FROM zones, stations""",
    ),
    "measured": (
        ("located", "station_km"),
        """SELECT l.*, nearest_station_km, chargers_within_1km FROM located l JOIN (
  SELECT zone_id, min(km) AS nearest_station_km,
         CAST(count(*) FILTER (WHERE km <= 1) AS BIGINT) AS chargers_within_1km
  FROM station_km GROUP BY zone_id) ON zone_id = PULocationID""",
    ),
    "scored": (
        ("measured",),
        """SELECT *, CAST(0.6 AS DOUBLE) * demand_score + CAST(0.4 AS DOUBLE) * gap_score AS priority_score
FROM (SELECT *, total_trips / (SELECT max(total_trips) FROM measured) * CAST(0.7 AS DOUBLE)
                + rush_hour_fraction * CAST(0.3 AS DOUBLE) AS demand_score,
             least(nearest_station_km, CAST(30 AS DOUBLE)) AS nearest_station_km_clipped,
             least(nearest_station_km, CAST(30 AS DOUBLE))
                / (SELECT max(nearest_station_km) FROM measured) AS gap_score
      FROM measured)""",
    ),
    "recs": (("scored", "zones"), _ranked(1400)),
    "recs_default": (("scored", "zones"), _ranked(500)),
    "fixed_clusters": (
        ("zone_agg",),
        "SELECT *, CAST(PULocationID % 5 AS INT) AS cluster FROM zone_agg",
    ),
    "summary": (("fixed_clusters",), _summary_of("fixed_clusters")),
    "moments": (
        ("zone_agg",),
        "SELECT "
        + ", ".join(f"avg({n}) AS {n}_m, stddev_samp({n}) AS {n}_s" for n in _CLUSTER_FEATURES)
        + " FROM zone_agg",
    ),
    "scaled": (
        ("fixed_clusters", "moments"),
        "SELECT PULocationID, cluster, "
        + ", ".join(f"({n} - {n}_m) / {n}_s AS {n}_z" for n in _CLUSTER_FEATURES)
        + " FROM fixed_clusters, moments",
    ),
    "starts": (
        ("scaled",),
        f"""SELECT 1 AS step, a.PULocationID AS id, {_apart("a", "b")} AS away, b.PULocationID AS center
FROM scaled a, (SELECT * FROM scaled ORDER BY PULocationID LIMIT 1) b
UNION ALL
SELECT step + 1, r.id, least(r.away, {_apart("a", "b")}), r.next
FROM (SELECT step, id, away, first_value(id) OVER (ORDER BY away DESC, id) AS next, max(away) OVER () AS far
      FROM starts) r
JOIN scaled a ON a.PULocationID = r.id JOIN scaled b ON b.PULocationID = r.next
WHERE step < 9 AND far > 0""",
    ),
    "lloyd": (
        ("starts",),
        f"""SELECT k, 0 AS round, id, cluster FROM (
  SELECT k, a.PULocationID AS id, c.cluster,
         row_number() OVER (PARTITION BY k, a.PULocationID ORDER BY {_apart("a", "b")}, c.cluster) AS place
  FROM (SELECT unnest(range(2, 10)) AS k) ks
  JOIN (SELECT DISTINCT step - 1 AS cluster, center FROM starts) c ON c.cluster < k
  JOIN scaled b ON b.PULocationID = c.center CROSS JOIN scaled a)
WHERE place = 1
UNION ALL
SELECT k, round + 1, id, cluster FROM (
  SELECT c.k, c.round, a.PULocationID AS id, c.cluster,
         row_number() OVER (PARTITION BY c.k, a.PULocationID ORDER BY {_apart("a", "c")}, c.cluster) AS place
  FROM (SELECT k, round, l.cluster, {", ".join(f"avg({n}_z) AS {n}_z" for n in _CLUSTER_FEATURES)}
        FROM lloyd l JOIN scaled ON id = PULocationID WHERE round < 50 GROUP BY k, round, l.cluster) c
  CROSS JOIN scaled a)
WHERE place = 1""",
    ),
    "kmeans": (
        ("lloyd", "zone_agg"),
        """SELECT z.*, CAST(l.cluster AS INT) AS cluster FROM zone_agg z
JOIN lloyd l ON id = PULocationID AND k = 8 AND round = 50""",
    ),
    "kmeans_scaled": (
        ("lloyd", "scaled"),
        """SELECT s.* EXCLUDE (cluster), l.k, l.cluster FROM scaled s JOIN lloyd l ON id = PULocationID
WHERE round = CASE WHEN k = 8 THEN 50 ELSE 20 END""",
    ),
    "kmeans_summary": (("kmeans",), _summary_of("kmeans")),
    "gram": (
        ("hourly",),
        "SELECT stddev_pop(CAST(trip_count AS DOUBLE)) AS s, "
        + ", ".join(f"avg(CAST({n} AS DOUBLE)) AS m{i}" for i, n in enumerate(_REGRESSED))
        + ", "
        + ", ".join(
            f"covar_pop(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))"
            + (f" * (1 + CAST(0.01 AS DOUBLE) / stddev_pop(CAST(trip_count AS DOUBLE))) AS a{i}_{j}" if i == j else f" AS a{i}_{j}")
            for i, a in enumerate(_REGRESSED[:-1])
            for j, b in enumerate(_REGRESSED)
        )
        + f" FROM hourly WHERE {_DEMAND_BUCKET} < 80",
    ),
    **{f"solved{p}": ((f"solved{p - 1}" if p else "gram",), _pivot(p)) for p in range(len(_DEMAND_FEATURES))},
    **_tree_tables(2, 5),
    "hour_means": (
        ("hourly",),
        f"""SELECT pickup_hour, avg(trip_count) AS prediction FROM hourly
WHERE {_DEMAND_BUCKET} < 80 GROUP BY pickup_hour""",
    ),
}


def _sql(source: str, body: str) -> str:
    """``body`` behind the common table expressions that the listed sources need."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in _CTES[name][0]:
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for name in source.split():
        visit(name)
    ctes = ",\n".join(f"{name} AS ({_CTES[name][1].strip()})" for name in ordered)
    recursive = "RECURSIVE " if {"starts", "lloyd"} & set(ordered) else ""
    return f"WITH {recursive}{ctes}\n{body}"


_ZONE_MEANS = ("avg_distance", "avg_fare", "avg_passengers", "avg_duration_min", "avg_speed_mph")


def _rounded_value(name: str, count: str = "total_trips") -> str:
    """Six decimals; averages of trips are rounded by their total, as on the query side."""
    if count and name in _ZONE_MEANS:
        return f"round({name} * {count}, 6) / {count}"
    return f"round(CAST({name} AS DOUBLE), 6)"


def _rounded(*names: str, count: str = "total_trips") -> str:
    return ", ".join(f"{_rounded_value(name, count)} AS {name}" for name in names)


_RECORD = f"""VendorID, PULocationID, DOLocationID, trip_distance, fare_amount, passenger_count, total_amount,
       {_PICKUP_S} AS pickup_s, {_DROPOFF_S} AS dropoff_s"""

_AVERAGES = _rounded(
    "avg_distance", "avg_fare", "avg_passengers", "avg_duration_min", "avg_speed_mph", "rush_hour_trips",
    "weekend_fraction", "lat", "lon", "rush_hour_fraction",
)
_HOURLY_AGG = _sql(
    "hourly",
    f"""SELECT PULocationID, pickup_hour, pickup_dow, trip_count, {_rounded("avg_distance", "avg_fare", count="trip_count")},
       is_weekend, is_rush_hour, borough FROM hourly""",
)
_ZONE_AGG = _sql("zone_agg", f"SELECT PULocationID, total_trips, borough, {_AVERAGES} FROM zone_agg")

_SUMMARY = _rounded(
    "avg_trips_per_zone", "avg_distance", "avg_fare", "rush_hour_fraction", "weekend_fraction",
    "centroid_lat", "centroid_lon",
)


def _recommended(name: str) -> str:
    doubles = _rounded(
        "lat", "lon", "rush_hour_fraction", "avg_distance", "avg_fare", "demand_score",
        "nearest_station_km", "nearest_station_km_clipped", "gap_score", "priority_score",
        "annual_co2_saved_tonnes",
    )
    return _sql(
        name,
        f"""SELECT PULocationID, borough, total_trips, chargers_within_1km, zone_name, annual_trips_est,
       annual_co2_saved_kg, rank, {doubles} FROM {name}""",
    )


def _histogram(source: str, value: str, bins: int, columns: str) -> str:
    return _sql(
        source,
        f"""SELECT {columns} FROM (
  SELECT CAST(b.i AS INT) AS bin, lo + i * w AS low, lo + (i + 1) * w AS high,
         count(x) AS "count", count(x) / (n * w) AS density
  FROM range({bins}) b(i)
  CROSS JOIN (SELECT min(x) AS lo, (max(x) - min(x)) / {bins} AS w, count(x) AS n
              FROM (SELECT {value} AS x FROM {source})) s
  LEFT JOIN (SELECT {value} AS x FROM {source}) v
    ON x >= lo + i * w AND (x < lo + (i + 1) * w OR i = {bins} - 1)
  GROUP BY i, lo, w, n)""",
    )


def _curve(source: str, value: str, cap: int) -> str:
    return f"""SELECT CAST(i AS INT) AS point, round(x, 6) AS x, round(density, 6) AS density FROM (
  SELECT i, lo + i * ((hi - lo) / 299) AS x,
         sum(w * exp(-pow((lo + i * ((hi - lo) / 299) - v) / h, 2) / 2)) / sum(w) / (h * sqrt(2 * pi())) AS density
  FROM range(300) g(i)
  CROSS JOIN (SELECT min({value}) AS lo, least(max({value}), {cap}) AS hi,
                     stddev_samp({value}) * pow(count(*), CAST(-0.2 AS DOUBLE)) AS h FROM {source}) s
  CROSS JOIN (SELECT {value} AS v, count(*) AS w FROM {source} GROUP BY {value})
  GROUP BY i, lo, hi, h)"""


_CURVE = _sql("located", _curve("located", "avg_distance", 25))

_GAP_MAP = """SELECT 'zone' AS layer, CAST({zone_id} AS VARCHAR) AS id, round({lon}, 6) AS lon, round({lat}, 6) AS lat
FROM {zones}
UNION ALL SELECT 'station', name, round(lon, 6), round(lat, 6) FROM stations
UNION ALL SELECT 'recommended', CAST(PULocationID AS VARCHAR), round(lon, 6), round(lat, 6) FROM recs"""

_LABELS = _sql(
    "recs",
    """SELECT rank, round(lon, 6) AS lon, round(lat, 6) AS lat,
       '#' || rank || ' ' || substring(zone_name, 1, 18) AS label FROM recs WHERE rank <= 5""",
)
_SAVINGS = "SELECT PULocationID, zone_name, {} FROM recs"
_SAVINGS_TOTAL = _sql(
    "recs",
    "SELECT round(sum(annual_co2_saved_tonnes), 6) AS total_tonnes, count(*) AS sites FROM recs",
)
_PER_HOUR = _sql(
    "features",
    f"""SELECT pickup_hour, count(*) AS trips, {_rush("pickup_hour")} AS is_rush_hour
FROM features GROUP BY pickup_hour""",
)
_BOROUGHS = "SELECT borough, CAST(sum(total_trips) AS BIGINT) AS trips FROM {} GROUP BY borough"
_AVERAGE_MEDIAN = _sql(
    "located",
    "SELECT round(avg(avg_distance), 6) AS mean, round(median(avg_distance), 6) AS median FROM located",
)
_DISTANCE_BINS = _histogram(
    "located", "avg_distance", 30, 'bin, "count", ' + _rounded("low", "high", "density")
)
_COMPACT_SQL = _sql(
    "trips",
    f"""SELECT PULocationID, total_trips, {_rounded("avg_distance", "avg_fare", "rush_hour_fraction")} FROM (
  SELECT PULocationID, count(*) AS total_trips, avg(trip_distance) AS avg_distance,
         avg(fare_amount) AS avg_fare, sum({_rush(_HOUR)}) / count(*) AS rush_hour_fraction
  FROM trips WHERE {_COMPACT} GROUP BY PULocationID)""",
)


def _audit() -> str:
    steps = []
    for i, name in enumerate(_RULES):
        kept = " AND ".join(f"({r})" for r in list(_RULES.values())[: i + 1])
        steps.append(
            f"""SELECT {i + 1} AS step, '{name}' AS rule,
       count(*) - count(*) FILTER (WHERE {_RULES[name]}) AS rows_failing,
       count(*) FILTER (WHERE {kept}) AS rows_kept,
       round(CAST(100 AS DOUBLE) * count(*) FILTER (WHERE {kept}) / count(*), 6) AS percent_kept
FROM trips"""
        )
    return _sql("trips", "\nUNION ALL ".join(steps))


def _describe(*names: str) -> str:
    rows = [
        f"""SELECT '{n}' AS "column", count({n}) AS "count", round(avg({n}), 6) AS mean,
       round(stddev_samp({n}), 6) AS stddev, round(min({n}), 6) AS min, round(max({n}), 6) AS max
FROM trips"""
        for n in names
    ]
    return _sql("trips", "\nUNION ALL ".join(rows))


def _derived(alias: str, expression: str) -> str:
    return _sql("trips", f"SELECT PULocationID, trip_distance, {expression} AS {alias} FROM trips")


def _score(*names: str) -> str:
    return _sql("scored", f"SELECT PULocationID, {_rounded(*names)} FROM scored")


def _rule(condition: str) -> str:
    return _sql("trips", f"SELECT {_RECORD} FROM trips WHERE {condition}")


_PROFILES = (
    "SELECT cluster, "
    + ", ".join(
        f"round(({m} - min({m}) OVER ()) / (max({m}) OVER () - min({m}) OVER () + CAST(1e-9 AS DOUBLE)), 6) AS {m}"
        for m in ("avg_trips_per_zone", "avg_distance", "rush_hour_fraction")
    )
    + " FROM {0}"
)

_FEATURE_NAME = f"[{', '.join(repr(n) for n in _DEMAND_FEATURES)}][feature + 1]"

_SQUARES = " + ".join(f"pow(a.{n}_z - b.{n}_z, 2)" for n in _CLUSTER_FEATURES)


def _silhouettes(scaled: str, by: str = "") -> str:
    """Zones and mean silhouette of the table's clusters; ``by``: of each value of a column, with the squares to own means."""
    key, match = (f"a.{by}, ", f" WHERE a.{by} = b.{by}") if by else ("", "")
    name = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return f"""SELECT {name}count(*) AS zones, avg(CASE WHEN size = 1 THEN 0
         WHEN near < far THEN 1 - near / far WHEN near > far THEN far / near - 1 ELSE 0 END) AS silhouette,
       sum(spread) AS wssse
FROM (SELECT {name}id, min(size) FILTER (WHERE own) AS size,
             min(total / (size - 1)) FILTER (WHERE own AND size > 1) AS near,
             min(total / size) FILTER (WHERE NOT own) AS far,
             min(total / size / 2) FILTER (WHERE own) AS spread
      FROM (SELECT {key}a.PULocationID AS id, a.cluster = b.cluster AS own, count(*) AS size, sum({_SQUARES}) AS total
            FROM {scaled} a, {scaled} b{match} GROUP BY {key}a.PULocationID, a.cluster, b.cluster)
      GROUP BY {name}id){group}"""


_SILHOUETTE = _sql("scaled", f"SELECT zones, round(silhouette, 6) AS silhouette FROM ({_silhouettes('scaled')})")
_KMEANS_SILHOUETTE = f"SELECT zones, round(silhouette, 6) AS silhouette FROM ({_silhouettes('kmeans_scaled', 'k')}) WHERE k = 8"

ORACLE_SQL: dict[str, str] = {
    "s1_trip_scan": _sql("trips", "SELECT * FROM trips"),
    "s5_cast_pass": _sql("trips", f"SELECT {_RECORD}, payment_type, RatecodeID FROM trips"),
    "s7_zone_dimension": _sql("zones", "SELECT * FROM zones"),
    "s8_station_dimension": _sql("stations", "SELECT * FROM stations"),
    "s3_checked_csv": _sql(
        "trips",
        """SELECT reason, count(*) AS "rows", round(sum(fare_amount), 3) AS fares FROM (
  SELECT fare_amount, CASE WHEN payment_type = 3 AND total_amount < 0 THEN 'unreadable trip_distance, PULocationID'
    WHEN payment_type = 3 THEN 'unreadable trip_distance' WHEN total_amount < 0 THEN 'unreadable PULocationID'
    ELSE 'accepted' END AS reason FROM trips) GROUP BY reason""",
    ),
    "s9_dated_trips": _sql(
        "features",
        """SELECT CAST(date_trunc('month', tpep_pickup_datetime) AS DATE) AS pickup_date, count(*) AS trips, round(sum(fare_amount), 6) AS fares,
       round(sum(speed_mph), 6) AS speeds FROM features GROUP BY CAST(date_trunc('month', tpep_pickup_datetime) AS DATE)""",
    ),
    "s10_zone_table_round_trip": _ZONE_AGG,
    "s15_csv_round_trip": _sql("trips", f"SELECT {_RECORD} FROM trips"),
    "s17_row_counts": _sql(
        "trips features hourly",
        """SELECT (SELECT count(*) FROM trips) AS raw_rows, (SELECT count(*) FROM features) AS clean_rows,
       (SELECT count(DISTINCT PULocationID) FROM features) AS zones,
       (SELECT count(*) FROM hourly) AS hourly_rows""",
    ),
    "s19_hash_sample": _sql(
        "trips",
        f"""SELECT * FROM (SELECT {_RECORD} FROM trips)
WHERE {_BUCKET.format("concat_ws('|', VendorID, PULocationID, DOLocationID, pickup_s, dropoff_s)")} < 10""",
    ),
    "p1_required": _rule(_RULES["required"]),
    "p2_distance": _rule(_RULES["distance"]),
    "p3_fare": _rule(_RULES["fare"]),
    "p4_passengers": _rule(_RULES["passengers"]),
    "p5_time_order": _rule(_RULES["time_order"]),
    "p6_pickup_zone": _rule(_RULES["pickup_zone"]),
    "p7_dropoff_zone": _rule(_RULES["dropoff_zone"]),
    "p8_total": _rule(_RULES["total"]),
    "p9_duration": _rule(_RULES["duration"]),
    "p10_speed": _rule(_RULES["speed"]),
    "p11_compact_rules": _rule(_COMPACT),
    "p12_cluster_input": _sql(
        "zone_agg",
        f"SELECT PULocationID, total_trips, {_rounded(*_CLUSTER_FEATURES[1:])} FROM zone_agg",
    ),
    "p13_demand_input": _sql(
        "hourly",
        f"""SELECT PULocationID, pickup_hour, pickup_dow, is_weekend, is_rush_hour,
       {_rounded("avg_distance", "avg_fare", count="trip_count")}, trip_count FROM hourly WHERE trip_count > 0""",
    ),
    "p14_located_zones": _sql(
        "located", f"SELECT PULocationID, {_rounded('lat', 'lon')}, total_trips FROM located"
    ),
    "p14_fully_known_zones": _sql(
        "fixed_clusters",
        f"""SELECT PULocationID, borough, {_rounded("lat", "lon")}, total_trips, cluster FROM fixed_clusters
WHERE borough IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL""",
    ),
    "p15_hotspots": _sql(
        "zone_agg", "SELECT PULocationID, total_trips FROM zone_agg WHERE total_trips >= 1400"
    ),
    "p16_underserved": _sql(
        "measured",
        "SELECT PULocationID, chargers_within_1km FROM measured WHERE chargers_within_1km < 2",
    ),
    "p17_pickup_columns": _sql(
        "zones",
        """SELECT zone_id AS PULocationID, borough AS pu_borough, zone_lat AS pu_lat, zone_lon AS pu_lon
FROM zones""",
    ),
    "p18_drop_rename": _sql(
        "hourly",
        """SELECT PULocationID, pickup_hour, pickup_dow, trip_count AS trips, is_weekend, is_rush_hour
FROM hourly""",
    ),
    "p19_derived_columns": _sql(
        "features",
        """SELECT PULocationID, DOLocationID, pickup_hour, pickup_dow, pickup_month, is_weekend, is_rush_hour,
       time_of_day, trip_duration_min, speed_mph, fare_per_mile FROM features""",
    ),
    "p21_rule_audit": _audit(),
    "j1_pickup_zone": _sql(
        "trips zones",
        """SELECT PULocationID, trip_distance, borough AS pu_borough, zone_lat AS pu_lat, zone_lon AS pu_lon
FROM trips LEFT JOIN zones ON zone_id = PULocationID""",
    ),
    "j2_dropoff_zone": _sql(
        "trips zones",
        """SELECT DOLocationID, trip_distance, borough AS do_borough
FROM trips LEFT JOIN zones ON zone_id = DOLocationID""",
    ),
    "j3_nearest_station": _sql(
        "station_km",
        """SELECT zone_id AS PULocationID, round(km, 6) AS nearest_station_km, name AS nearest_station
FROM (SELECT *, row_number() OVER (PARTITION BY zone_id ORDER BY km, name) AS place FROM station_km)
WHERE place = 1""",
    ),
    "j4_stations_within": _sql(
        "station_km",
        """SELECT zone_id AS PULocationID, count(*) FILTER (WHERE km <= 1) AS stations_within,
       CAST(coalesce(sum(num_chargers) FILTER (WHERE km <= 1), 0) AS BIGINT) AS chargers_total
FROM station_km GROUP BY zone_id""",
    ),
    "j5_zone_names": _sql(
        "zone_agg zones",
        """SELECT PULocationID, total_trips, coalesce(zone_name, 'Zone ' || PULocationID) AS zone_name
FROM zone_agg LEFT JOIN zones ON zone_id = PULocationID""",
    ),
    "j6_gap_map": _sql(
        "located stations recs",
        _GAP_MAP.format(zone_id="PULocationID", lon="lon", lat="lat", zones="located"),
    ),
    "a1_zone_aggregates": _ZONE_AGG,
    "a1_zone_aggregates_from_cube": _ZONE_AGG,
    "a1_zone_aggregates_from_stored_cube": _ZONE_AGG,
    "a2_hourly_demand": _HOURLY_AGG,
    "a2_hourly_demand_from_stored_cube": _HOURLY_AGG,
    "a3_cluster_summary": _sql(
        "summary", f"SELECT cluster, num_zones, total_trips, {_SUMMARY}, dominant_borough FROM summary"
    ),
    "a4_trips_per_hour": _PER_HOUR,
    "a5_trips_per_borough": _sql(
        "zone_agg", _BOROUGHS.format("(SELECT * FROM zone_agg WHERE borough IS NOT NULL)")
    ),
    "a5_trips_per_borough_all": _sql("zone_agg", _BOROUGHS.format("zone_agg")),
    "a6_maxima": _sql(
        "measured",
        """SELECT max(total_trips) AS max_total_trips,
       round(max(nearest_station_km), 6) AS max_nearest_station_km FROM measured""",
    ),
    "a7_total_savings": _SAVINGS_TOTAL,
    "a8_mean_and_median": _AVERAGE_MEDIAN,
    "a8_trip_fares": _sql(
        "trips", "SELECT round(avg(fare_amount), 6) AS mean, round(median(fare_amount), 6) AS median FROM trips"
    ),
    "a9_distance_histogram": _DISTANCE_BINS,
    "a10_trip_histogram": _histogram(
        "trips",
        "least(greatest(trip_distance, CAST(0 AS DOUBLE)), CAST(20 AS DOUBLE))",
        50,
        'bin, "count", ' + _rounded("low", "high"),
    ),
    "a11_density_curve": _CURVE,
    "a11_trip_fare_curve": _sql("trips", _curve("trips", "fare_amount", 1000)),
    "a12_describe": _describe("trip_distance", "fare_amount", "passenger_count", "total_amount"),
    "a13_scaled_profiles": _sql("summary", _PROFILES.format("summary")),
    "a14_compact_aggregate": _COMPACT_SQL,
    "a15_regression_metrics": _sql(
        "hourly hour_means",
        f"""SELECT 'Hourly mean' AS model, round(sqrt(avg(e * e)), 6) AS rmse, round(avg(abs(e)), 6) AS mae,
       round(1 - sum(e * e) / sum(pow(y - m, 2)), 6) AS r2
FROM (SELECT trip_count AS y, trip_count - prediction AS e, avg(trip_count) OVER () AS m
      FROM hourly JOIN hour_means USING (pickup_hour) WHERE {_DEMAND_BUCKET} >= 80)""",
    ),
    "a16_silhouette": _SILHOUETTE,
    "a17_distinct_counts": _sql(
        "hourly", "SELECT count(DISTINCT PULocationID) AS zones, count(*) AS hourly_rows FROM hourly"
    ),
    "a18_point_sizes": _sql(
        "located",
        f"""SELECT PULocationID, {_rounded("lon", "lat")},
       round(80 + total_trips / (SELECT max(total_trips) FROM located) * 400, 6) AS size FROM located""",
    ),
    "w1_rank": _sql("recs", f"SELECT PULocationID, {_rounded('priority_score')}, rank FROM recs"),
    "o1_top_priority": _sql(
        "scored",
        f"""SELECT PULocationID, {_rounded("priority_score")} FROM (
  SELECT * FROM scored ORDER BY scored.priority_score DESC, PULocationID LIMIT 10)""",
    ),
    "o2_busiest_zones": _sql(
        "zone_agg",
        f"""SELECT PULocationID, total_trips, borough, {_AVERAGES} FROM (
  SELECT * FROM zone_agg ORDER BY total_trips DESC, PULocationID LIMIT 10)""",
    ),
    "o3_ordered_hours": _sql(
        "features",
        "SELECT pickup_hour, count(*) AS trips FROM features GROUP BY pickup_hour ORDER BY pickup_hour",
    ),
    "o4_ordered_boroughs": _sql("located", _BOROUGHS.format("located") + " ORDER BY trips, borough"),
    "o5_savings_ascending": _sql(
        "recs",
        _SAVINGS.format("annual_co2_saved_tonnes") + " ORDER BY annual_co2_saved_tonnes, PULocationID",
    ),
    "o7_top_labels": _LABELS,
    "f1_pickup_hour": _derived("pickup_hour", _HOUR),
    "f2_pickup_weekday": _derived("pickup_dow", _DOW),
    "f3_pickup_month": _derived("pickup_month", _MONTH),
    "f4_weekend_flag": _derived("is_weekend", _WEEKEND),
    "f5_rush_flag": _derived("is_rush_hour", _rush(_HOUR)),
    "f6_time_of_day": _derived("time_of_day", _DAY_PART),
    "f7_duration": _derived("trip_duration_min", _MINUTES),
    "f8_speed": _derived("speed_mph", _SPEED),
    "f9_fare_per_mile": _derived("fare_per_mile", _FARE_PER_MILE),
    "f10_rush_share": _sql(
        "zone_agg",
        f"SELECT PULocationID, {_rounded('rush_hour_trips', 'rush_hour_fraction')} FROM zone_agg",
    ),
    "f11_haversine": _sql(
        "trips zones",
        f"""SELECT PULocationID, DOLocationID, trips,
       round({_haversine("p.zone_lat", "p.zone_lon", "e.zone_lat", "e.zone_lon")}, 6) AS km
FROM (SELECT PULocationID, DOLocationID, count(*) AS trips FROM trips GROUP BY PULocationID, DOLocationID)
LEFT JOIN zones p ON p.zone_id = PULocationID LEFT JOIN zones e ON e.zone_id = DOLocationID""",
    ),
    "f13_demand_score": _score("demand_score"),
    "f14_capped_distance": _score("nearest_station_km", "nearest_station_km_clipped"),
    "f15_gap_score": _score("gap_score"),
    "f16_priority_score": _score("priority_score"),
    "f17_saved_grams": _sql(
        "zone_agg",
        "SELECT PULocationID, round(324 * avg_distance, 6) AS saved_grams_per_trip FROM zone_agg",
    ),
    "f18_annual_trips": _sql(
        "zone_agg", "SELECT PULocationID, total_trips * 12 AS annual_trips_est FROM zone_agg"
    ),
    "f19_annual_savings": _sql(
        "zone_agg",
        """SELECT PULocationID, annual_co2_saved_kg,
       round_even(annual_co2_saved_kg / CAST(1000 AS DOUBLE) * 10, 0) / 10 AS annual_co2_saved_tonnes
FROM (SELECT PULocationID, CAST(round_even(
        total_trips * 12 * CAST(0.3 AS DOUBLE) * (324 * avg_distance) / 1000, 0) AS BIGINT) AS annual_co2_saved_kg
      FROM zone_agg)""",
    ),
    "f20_clip": _derived("clipped", "least(greatest(trip_distance, CAST(1 AS DOUBLE)), CAST(5 AS DOUBLE))"),
    "f22_zone_fallback": _sql(
        "trips zones",
        """SELECT PULocationID, coalesce(zone_name, 'Zone ' || PULocationID) AS zone_name
FROM (SELECT DISTINCT PULocationID FROM trips) LEFT JOIN zones ON zone_id = PULocationID""",
    ),
    "m1_cluster_vectors": _sql(
        "zone_agg",
        "SELECT PULocationID, "
        + ", ".join(f"{_rounded_value(n)} AS {n}_v" for n in _CLUSTER_FEATURES)
        + " FROM zone_agg",
    ),
    "m2_standardise": _sql(
        "scaled",
        "SELECT PULocationID, "
        + ", ".join(f"round({n}_z, 6) AS {n}_scaled" for n in _CLUSTER_FEATURES)
        + " FROM scaled",
    ),
    "m2_standard_scaler": _sql(
        "scaled",
        "SELECT PULocationID, "
        + ", ".join(f"round({n}_z, 6) AS {n}_v" for n in _CLUSTER_FEATURES)
        + " FROM scaled",
    ),
    "m5_demand_vectors": _sql(
        "hourly",
        "SELECT "
        + ", ".join(f"{_rounded_value(n, 'trip_count')} AS {n}_v" for n in _DEMAND_FEATURES)
        + ", trip_count FROM hourly",
    ),
    "m3_kmeans_facts": _sql(
        "zone_agg",
        """SELECT count(*) AS zones, CAST(sum(total_trips) AS BIGINT) AS trips, CAST(0 AS BIGINT) AS misplaced
FROM zone_agg""",
    ),
    "m3_kmeans": _sql("kmeans", "SELECT PULocationID, cluster FROM kmeans"),
    "a3_kmeans_summary": _sql(
        "kmeans_summary",
        f"SELECT cluster, num_zones, total_trips, dominant_borough, {_SUMMARY} FROM kmeans_summary",
    ),
    "p20_attach_silhouette": _sql(
        "kmeans_summary kmeans_scaled",
        f"""SELECT cluster, num_zones, total_trips, dominant_borough, {_SUMMARY}, silhouette
FROM kmeans_summary, ({_KMEANS_SILHOUETTE})""",
    ),
    "a16_kmeans_silhouette": _sql("kmeans_scaled", _KMEANS_SILHOUETTE),
    "a18_cluster_map": _sql(
        "kmeans",
        f"""SELECT PULocationID, cluster, {_rounded("lon", "lat")},
       round(80 + total_trips / (SELECT max(total_trips) FROM kmeans WHERE lat IS NOT NULL AND lon IS NOT NULL) * 400, 6) AS size
FROM kmeans WHERE lat IS NOT NULL AND lon IS NOT NULL""",
    ),
    "a19_cluster_labels": _sql("kmeans", "SELECT DISTINCT cluster FROM kmeans"),
    "m4_k_sweep": _sql(
        "kmeans_scaled",
        f"""SELECT CAST(k AS INT) AS k, round(wssse, 6) AS wssse, round(silhouette, 6) AS silhouette
FROM ({_silhouettes("kmeans_scaled", "k")})""",
    ),
    "c7_cluster_profiles": _sql("kmeans_summary", _PROFILES.format("kmeans_summary")),
    "m7_linear_regression": _sql(
        f"hourly solved{len(_DEMAND_FEATURES) - 1}",
        f"""SELECT PULocationID, pickup_hour, pickup_dow, trip_count,
       round(m{len(_DEMAND_FEATURES)}{"".join(f" + a{i}_{len(_DEMAND_FEATURES)} * ({n} - m{i})" for i, n in enumerate(_DEMAND_FEATURES))}, 6) AS prediction
FROM hourly, solved{len(_DEMAND_FEATURES) - 1} WHERE {_DEMAND_BUCKET} >= 80""",
    ),
    "m8_histogram_trees": _sql(
        "tree_rows2",
        "SELECT PULocationID, pickup_hour, pickup_dow, trip_count, round(prediction, 6) AS prediction FROM tree_rows2 WHERE NOT train",
    ),
    "m8_histogram_splits": _sql(
        " ".join(f"best{t}_{level}" for t in range(2) for level in range(5)),
        "\nUNION ALL ".join(
            f"""SELECT CAST({t} AS INT) AS tree, CAST(node AS INT) AS node, {_FEATURE_NAME} AS feature, CAST(bin AS INT) AS bin,
       round(gain, 4) AS gain FROM best{t}_{level}"""
            for t in range(2)
            for level in range(5)
        ),
    ),
    "m9_histogram_importances": _sql(
        " ".join(f"best{t}_{level}" for t in range(2) for level in range(5)),
        f"""SELECT {_FEATURE_NAME} AS feature, round(coalesce(sum(gain), 0) / (SELECT sum(gain) FROM gains), 6) AS importance
FROM (SELECT unnest(range({len(_DEMAND_FEATURES)})) AS feature) LEFT JOIN gains USING (feature) GROUP BY feature""".replace(
            "gains", "(" + " UNION ALL ".join(f"SELECT feature, gain FROM best{t}_{level}" for t in range(2) for level in range(5)) + ") gains"
        ),
    ),
    "m7_linear_facts": _sql(
        "hourly",
        f"""SELECT count(*) AS "rows", round(avg(trip_count), 4) AS mean_label FROM hourly
WHERE {_DEMAND_BUCKET} < 80""",
    ),
    "m8_tree_rows": _sql(
        "hourly",
        f"SELECT PULocationID, pickup_hour, pickup_dow, trip_count FROM hourly WHERE {_DEMAND_BUCKET} >= 80",
    ),
    "m10_comparison_facts": _sql(
        "hourly",
        f"""SELECT model, label_variance FROM
  (SELECT round(var_pop(trip_count), 4) AS label_variance FROM hourly WHERE {_DEMAND_BUCKET} >= 80),
  (VALUES ('Linear Regression'), ('Gradient Boosted Trees')) names(model)""",
    ),
    "m6_random_split_rows": _sql("hourly", "SELECT PULocationID, pickup_hour, pickup_dow, trip_count FROM hourly"),
    "c6_scaling_report": _sql(
        "trips",
        f"""SELECT 'trips' AS input, (SELECT count(*) FROM trips) AS "rows",
       (SELECT count(DISTINCT PULocationID) FROM trips WHERE {_COMPACT}) AS zones""",
    ),
    "c6_scaling_sizes": _sql(
        "trips",
        f"""SELECT share || ' %' AS input, count(*) AS "rows", count(DISTINCT CASE WHEN {_COMPACT} THEN PULocationID END) AS zones
FROM (SELECT *, {_BUCKET.format(f"concat_ws('|', VendorID, PULocationID, DOLocationID, {_PICKUP_S}, {_DROPOFF_S})")} AS bucket FROM trips)
JOIN (VALUES (10), (50), (100)) sizes(share) ON bucket < share GROUP BY share""",
    ),
    "m6_hash_split": _sql(
        "hourly",
        f"""SELECT PULocationID, pickup_hour, pickup_dow,
       CASE WHEN {_DEMAND_BUCKET} < 80 THEN 'train' ELSE 'test' END AS part FROM hourly""",
    ),
    "c1_clean_and_engineer": _sql(
        "features zones",
        """SELECT f.*, p.borough AS pu_borough, p.zone_lat AS pu_lat, p.zone_lon AS pu_lon, e.borough AS do_borough
FROM features f LEFT JOIN zones p ON p.zone_id = PULocationID LEFT JOIN zones e ON e.zone_id = DOLocationID""",
    ),
    "c2_clean": _sql("clean", "SELECT * FROM clean"),
    "c3_site_recommendations": _recommended("recs_default"),
    "c3_site_recommendations_selective": _recommended("recs"),
    "c5_compact_etl": _COMPACT_SQL,
    "c7_demand_by_hour": _sql(
        "features",
        f"""SELECT pickup_hour, count(*) AS trips, {_rush("pickup_hour")} AS is_rush_hour
FROM features GROUP BY pickup_hour""",
    ),
    "c7_borough_comparison": _sql("located", _BOROUGHS.format("located")),
    "c7_distance_histogram": _DISTANCE_BINS,
    "c7_distance_curve": _CURVE,
    "c7_distance_averages": _AVERAGE_MEDIAN,
    "c7_gap_map": _sql(
        "zones stations recs",
        _GAP_MAP.format(zone_id="zone_id", lon="zone_lon", lat="zone_lat", zones="zones"),
    ),
    "c7_gap_map_labels": _LABELS,
    "c7_savings": _sql("recs", _SAVINGS.format("round(annual_co2_saved_tonnes, 6) AS annual_co2_saved_tonnes")),
    "c7_savings_total": _SAVINGS_TOTAL,
}


def _over(name: str, table: str, other: str) -> dict[str, str]:
    """The SQL of a query over another mapping of one table."""
    old, new = (text.format(**_NAMES).strip() for text in (table, other))
    return {f"{name}_wide": ORACLE_SQL[name].replace(old, new)}


for _name in ("p2_distance", "p4_passengers", "p6_pickup_zone", "p9_duration", "p21_rule_audit", "f9_fare_per_mile"):
    ORACLE_SQL |= _over(_name, TRIPS_SQL, WIDE_TRIPS_SQL)
for _name in ("f14_capped_distance", "f15_gap_score"):
    ORACLE_SQL |= _over(_name, ZONES_SQL, WIDE_ZONES_SQL)

ORACLE_SQL |= {
    "s4_source_choice": _sql(
        "trips",
        f"""SELECT source, count(*) AS trips, round(sum(fare_amount), 6) AS fares, CAST(sum({_PICKUP_S}) AS BIGINT) AS seconds
FROM trips JOIN (SELECT unnest(['with_copy', 'alone']) AS source) ON source = 'with_copy' OR payment_type = 1
GROUP BY source""",
    ),
    "s11_cluster_summary_json": ORACLE_SQL["a3_kmeans_summary"],
    "s12_recommendations_json": ORACLE_SQL["c3_site_recommendations_selective"],
    "s13_model_metrics_json": ORACLE_SQL["a15_regression_metrics"],
    "s14_scaling_json": ORACLE_SQL["c6_scaling_sizes"],
    "f12_missing_positions": _sql(
        "station_km",
        """SELECT zone_id AS PULocationID, zone_id % 5 < 2 AS unreachable,
       CASE WHEN zone_id % 5 >= 2 THEN round(min(km), 6) END AS nearest_station_km,
       CAST(count(*) FILTER (WHERE km <= 1 AND zone_id % 5 >= 2) AS BIGINT) AS stations_within
FROM station_km GROUP BY zone_id""",
    ),
}

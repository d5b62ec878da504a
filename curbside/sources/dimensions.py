"""Zone and station dimensions: from files, or the built-in city tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from curbside.sources.schema import STATION_SCHEMA, ZONE_SCHEMA, conform

# Zone id, name, borough, latitude, longitude.
CITY_ZONES = (
    (161, "Midtown Center", "Manhattan", 40.7549, -73.9840),
    (162, "Midtown East", "Manhattan", 40.7549, -73.9680),
    (163, "Midtown North", "Manhattan", 40.7680, -73.9880),
    (224, "Times Sq/Theatre Dist", "Manhattan", 40.7590, -73.9845),
    (186, "Penn Station/Madison Sq", "Manhattan", 40.7505, -73.9934),
    (100, "Garment District", "Manhattan", 40.7540, -73.9960),
    (232, "Union Square", "Manhattan", 40.7359, -73.9911),
    (261, "World Trade Center", "Manhattan", 40.7127, -74.0134),
    (234, "Upper East Side South", "Manhattan", 40.7680, -73.9590),
    (237, "Upper West Side South", "Manhattan", 40.7789, -73.9835),
    (87, "Flatiron", "Manhattan", 40.7410, -73.9897),
    (45, "Chelsea", "Manhattan", 40.7465, -74.0014),
    (79, "East Village", "Manhattan", 40.7264, -73.9805),
    (202, "SoHo", "Manhattan", 40.7230, -74.0024),
    (114, "Greenwich Village South", "Manhattan", 40.7286, -74.0013),
    (113, "Greenwich Village North", "Manhattan", 40.7333, -74.0016),
    (158, "Meatpacking/West Village", "Manhattan", 40.7395, -74.0075),
    (170, "Murray Hill", "Manhattan", 40.7490, -73.9780),
    (128, "Kips Bay", "Manhattan", 40.7434, -73.9768),
    (246, "Washington Heights N", "Manhattan", 40.8589, -73.9350),
    (247, "Washington Heights S", "Manhattan", 40.8492, -73.9330),
    (120, "Harlem North", "Manhattan", 40.8076, -73.9481),
    (116, "Hamilton Heights", "Manhattan", 40.8228, -73.9494),
    (151, "Manhattan Valley", "Manhattan", 40.8005, -73.9647),
    (236, "Upper West Side North", "Manhattan", 40.7887, -73.9757),
    (17, "Bedford-Stuyvesant", "Brooklyn", 40.6872, -73.9418),
    (97, "Greenpoint", "Brooklyn", 40.7295, -73.9514),
    (67, "East Williamsburg", "Brooklyn", 40.7137, -73.9338),
    (29, "Brooklyn Heights", "Brooklyn", 40.6960, -73.9936),
    (25, "Boerum Hill", "Brooklyn", 40.6877, -73.9857),
    (76, "Fort Greene", "Brooklyn", 40.6920, -73.9752),
    (89, "Gowanus", "Brooklyn", 40.6771, -73.9928),
    (63, "DUMBO/Vinegar Hill", "Brooklyn", 40.7030, -73.9893),
    (36, "Carroll Gardens", "Brooklyn", 40.6800, -73.9990),
    (54, "Coney Island", "Brooklyn", 40.5755, -73.9707),
    (33, "Bushwick North", "Brooklyn", 40.7061, -73.9215),
    (72, "Flatlands", "Brooklyn", 40.6234, -73.9318),
    (7, "Astoria", "Queens", 40.7721, -73.9301),
    (117, "Long Island City", "Queens", 40.7471, -73.9417),
    (121, "Queens Plaza", "Queens", 40.7481, -73.9435),
    (73, "Flushing", "Queens", 40.7675, -73.8330),
    (101, "Jackson Heights", "Queens", 40.7554, -73.8830),
    (129, "LaGuardia Airport", "Queens", 40.7773, -73.8740),
    (132, "JFK Airport", "Queens", 40.6413, -73.7781),
    (86, "Forest Hills", "Queens", 40.7176, -73.8448),
    (102, "Jamaica", "Queens", 40.6938, -73.8055),
    (53, "Corona", "Queens", 40.7448, -73.8660),
    (59, "Concourse/Concourse Vil", "Bronx", 40.8266, -73.9196),
    (78, "East Tremont", "Bronx", 40.8416, -73.8790),
    (110, "Melrose South/Mott Haven", "Bronx", 40.8130, -73.9214),
    (103, "Kingsbridge Heights", "Bronx", 40.8699, -73.9043),
    (96, "Hunts Point", "Bronx", 40.8132, -73.8902),
    (167, "New Springville", "Staten Island", 40.5779, -74.1686),
    (223, "Stapleton/Rosebank", "Staten Island", 40.6253, -74.0794),
    (250, "West Brighton", "Staten Island", 40.6345, -74.1276),
    (1, "Newark Airport", "EWR", 40.6895, -74.1745),
)

# Station name, latitude, longitude, number of chargers.
CITY_STATIONS = (
    ("Midtown Manhattan Garage", 40.7540, -73.9870, 8),
    ("Times Square Charging Hub", 40.7580, -73.9855, 12),
    ("JFK Airport Lot E", 40.6390, -73.7760, 20),
    ("LaGuardia Central Garage", 40.7770, -73.8735, 15),
    ("Brooklyn Downtown Lot", 40.6950, -73.9900, 6),
    ("Long Island City Depot", 40.7460, -73.9430, 10),
    ("Astoria Park & Charge", 40.7710, -73.9310, 4),
    ("Penn Station Area Garage", 40.7500, -73.9940, 8),
    ("Flatiron Charging Station", 40.7405, -73.9895, 6),
    ("World Trade Center Garage", 40.7115, -74.0125, 10),
    ("Upper East Side Depot", 40.7740, -73.9600, 6),
    ("Harlem 125th Street", 40.8080, -73.9470, 4),
    ("Bronx Hub Terminal", 40.8270, -73.9200, 4),
    ("Staten Island Ferry Terminal", 40.6436, -74.0736, 3),
    ("Forest Hills Station", 40.7185, -73.8460, 4),
    ("Jamaica Center", 40.6945, -73.8060, 6),
    ("Flushing Main St", 40.7680, -73.8335, 4),
    ("Newark Airport Hub", 40.6900, -74.1750, 12),
    ("Greenpoint Depot", 40.7290, -73.9510, 4),
    ("SoHo Parking Garage", 40.7225, -74.0020, 6),
)


def city_zones(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CITY_ZONES, ZONE_SCHEMA)


def city_stations(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CITY_STATIONS, STATION_SCHEMA)


def _read_dimension(spark: SparkSession, path: str, schema) -> DataFrame:
    if path.endswith(".csv"):
        return spark.read.schema(schema).option("header", True).csv(path)
    if path.endswith(".json"):
        return spark.read.schema(schema).json(path)
    return conform(spark.read.parquet(path), schema)


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone dimension from a file, one row per ``zone_id``."""
    return _read_dimension(spark, path, ZONE_SCHEMA)


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    return _read_dimension(spark, path, STATION_SCHEMA)

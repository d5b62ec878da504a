from curbside.sources.dimensions import city_stations, city_zones, read_stations, read_zones
from curbside.sources.readers import read_trips
from curbside.sources.schema import STATION_SCHEMA, TRIP_SCHEMA, ZONE_SCHEMA, conform
from curbside.sources.writers import write_csv, write_json, write_table, write_trips

__all__ = [
    "STATION_SCHEMA", "TRIP_SCHEMA", "ZONE_SCHEMA", "city_stations", "city_zones", "conform",
    "read_stations", "read_trips", "read_zones", "write_csv", "write_json", "write_table",
    "write_trips",
]

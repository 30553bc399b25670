"""Explicit schemas of the source tables (DDL text) and fixed values."""

from __future__ import annotations

# Letters of the three feeds.
MODES = ("A", "M", "T")


GTFS_STATIC = {
    "routes": "route_id string, agency_id string, route_short_name string, route_long_name string, route_desc string, route_type int, route_url string, route_color string, route_text_color string",
    "trips": "trip_id string, route_id string, service_id string, trip_headsign string, trip_short_name string, direction_id int, block_id string, shape_id string, wheelchair_accessible int",
    "stop_times": "trip_id string, arrival_time string, departure_time string, stop_id string, stop_sequence int, stop_headsign string, pickup_type int, drop_off_type int, shape_dist_traveled double, timepoint int",
    "stops": "stop_id string, stop_code string, stop_name string, stop_desc string, stop_lat double, stop_lon double, zone_id string, stop_url string, location_type int, parent_station string, stop_timezone string, wheelchair_boarding int, platform_code string",
    "calendar": "service_id string, monday int, tuesday int, wednesday int, thursday int, friday int, saturday int, sunday int, start_date string, end_date string",
    "calendar_dates": "service_id string, date string, exception_type int",
    "shapes": "shape_id string, shape_pt_lat double, shape_pt_lon double, shape_pt_sequence int, shape_dist_traveled double",
}

# Key columns per static table and whether it is kept as versions.
STATIC_CONFIG = {
    "routes": {"keys": ["route_id", "mode"], "scd2": True},
    "trips": {"keys": ["trip_id", "mode"], "scd2": False},
    "stops": {"keys": ["stop_id"], "scd2": False},
    "calendar": {"keys": ["service_id"], "scd2": False},
    "calendar_dates": {"keys": ["service_id", "date"], "scd2": False},
    "stop_times": {"keys": ["trip_id", "stop_sequence"], "scd2": False},
    "shapes": {"keys": ["shape_id", "shape_pt_sequence"], "scd2": False},
}

TRIP_UPDATES = "trip_id string, stop_id string, stop_sequence int, arrival long, departure long, schedule_relationship int, load_timestamp timestamp_ntz, mode string"

VEHICLE_POSITIONS = ("bearing double, congestion_level int, current_status int, current_stop_sequence int, direction_id int, id string, label string, "
    "latitude double, license_plate string, longitude double, multi_carriage_details string, occupancy_percentage int, "
    "occupancy_status int, odometer double, position string, route_id string, schedule_relationship int, speed double, "
    "start_date string, start_time string, stop_id string, timestamp long, trip string, trip_id string, vehicle string, "
    "load_timestamp timestamp_ntz, mode string")

HOURLY_FIELDS = {
    "temperature_2m": "double", "wind_speed_10m": "double", "relative_humidity_2m": "double", "precipitation": "double",
    "weather_code": "int", "pressure_msl": "double", "cloud_cover": "double", "visibility": "double", "is_day": "boolean",
}
MIN15_FIELDS = {
    "temperature_2m": "double", "precipitation": "double", "is_day": "boolean",
    "wind_gusts_10m": "double", "wind_speed_10m": "double", "wind_direction_10m": "double",
}

TRAFFIC = "STOP_NAME string, stop_lat double, stop_lon double, current_speed double, free_flow_speed double, current_travel_time double, free_flow_travel_time double, confidence double, load_timestamp string"

FLOW_SEGMENT = {
    "currentSpeed": "current_speed", "freeFlowSpeed": "free_flow_speed", "currentTravelTime": "current_travel_time",
    "freeFlowTravelTime": "free_flow_travel_time", "confidence": "confidence",
}

DELAYS = "trip_id string, stop_id string, stop_name string, trip_headsign string, stop_sequence int, actual_arrival timestamp_ntz, route_short_name string, planned_arrival timestamp_ntz, mode string, event_date string, load_timestamp timestamp_ntz, schedule_timestamp timestamp_ntz, delay long"

# City districts with their reference points.
DISTRICTS = [
    ("Stare Miasto (I)", 50.061389, 19.937222),
    ("Grzegórzki (II)", 50.051389, 19.957778),
    ("Prądnik Czerwony (III)", 50.079167, 19.961667),
    ("Prądnik Biały (IV)", 50.085278, 19.884444),
    ("Krowodrza (V)", 50.063611, 19.924722),
    ("Bronowice (VI)", 50.085833, 19.908333),
    ("Zwierzyniec (VII)", 50.056944, 19.905556),
    ("Dębniki (VIII)", 50.021111, 19.893333),
    ("Łagiewniki-Borek Fałęcki (IX)", 50.013333, 19.951111),
    ("Swoszowice (X)", 49.972778, 19.937778),
    ("Podgórze Duchackie (XI)", 50.024167, 19.939444),
    ("Bieżanów-Prokocim (XII)", 50.018056, 19.969167),
    ("Podgórze (XIII)", 50.042500, 19.948056),
    ("Czyżyny (XIV)", 50.080556, 20.015556),
    ("Mistrzejowice (XV)", 50.085556, 20.071111),
    ("Bieńczyce (XVI)", 50.108333, 20.081389),
    ("Wzgórza Krzesławickie (XVII)", 50.098056, 20.106667),
    ("Nowa Huta (XVIII)", 50.085556, 20.190556),
]

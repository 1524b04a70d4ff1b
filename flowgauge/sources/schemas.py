"""Schemas of the base tables and of the scoring requests."""

from __future__ import annotations

DISTRICTS = """
    id int, code string not null, name string not null, area_km2 decimal(6,2),
    population int, created_at timestamp
"""
ROAD_SEGMENTS = """
    id int, segment_id string not null, district_code string, street_name string not null,
    from_point string, to_point string, length_km decimal(5,3), lanes int, road_type string,
    lat_start decimal(10,7), lon_start decimal(10,7), lat_end decimal(10,7),
    lon_end decimal(10,7), created_at timestamp
"""
TRAFFIC_RECORDS = """
    id bigint, segment_id string, recorded_at timestamp not null, hour smallint not null,
    day_of_week smallint not null, month smallint not null, is_holiday boolean,
    weather_condition string, avg_speed_kmh decimal(5,2), vehicle_count int,
    congestion_level smallint not null, created_at timestamp
"""
PREDICTIONS = """
    id bigint, segment_id string, predicted_at timestamp, target_datetime timestamp not null,
    predicted_level smallint not null, confidence_score decimal(4,3), model_version string,
    input_features string, created_at timestamp
"""
SPECIAL_EVENTS = """
    id int, event_name string not null, event_type string, start_time timestamp not null,
    end_time timestamp not null, affected_area string, impact_level smallint,
    description string, created_at timestamp
"""
REQUESTS = """
    segment_id string, hour int, day_of_week int, month int, is_holiday boolean,
    weather_condition string, avg_speed_kmh double, vehicle_count int, lanes int
"""
METRICS = """
    accuracy double, f1_weighted double, f1_macro double, confusion_matrix array<array<bigint>>,
    trained_at string, model_type string, n_features int, feature_names array<string>,
    cv_mean double, cv_std double
"""

TABLES = {
    "districts": DISTRICTS,
    "road_segments": ROAD_SEGMENTS,
    "traffic_records": TRAFFIC_RECORDS,
    "predictions": PREDICTIONS,
    "special_events": SPECIAL_EVENTS,
}

# Values the tables take where a column is missing on load.
DEFAULTS = {
    "road_segments": {"lanes": 2},
    "traffic_records": {"is_holiday": False, "weather_condition": "clear"},
    "predictions": {"model_version": "v1.0"},
    "special_events": {"impact_level": 1},
}
REQUIRED = {
    "districts": ["code", "name"],
    "road_segments": ["segment_id", "street_name"],
    "traffic_records": [
        "recorded_at", "hour", "day_of_week", "month", "congestion_level",
    ],
    "predictions": ["target_datetime", "predicted_level"],
    "special_events": ["event_name", "start_time", "end_time"],
}
UNIQUE = {"districts": ["code"], "road_segments": ["segment_id"]}

"""Record layouts. Field names, order and types are part of the wire format."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, DoubleType, FloatType, IntegerType, LongType, StringType, StructField, StructType,
    TimestampType,
)

# The wire formats that producers and consumers agree on.
TELEMETRY_DDL = """
    session_id STRING NOT NULL, driver_id STRING NOT NULL, driver_name STRING, car_number STRING,
    lap_number INT, micro_sector_id INT, timestamp_utc STRING NOT NULL,
    speed_kph FLOAT, throttle_pct FLOAT, brake_pressure_bar FLOAT, steering_angle_deg FLOAT,
    gear INT, engine_rpm INT, drs_state STRING, ers_mode STRING,
    battery_pct FLOAT, fuel_mass_kg FLOAT, tyre_compound STRING, tyre_age_laps INT,
    tyre_surface_temp_c FLOAT, tyre_inner_temp_c FLOAT, tyre_pressure_bar FLOAT,
    gps_lat DOUBLE, gps_lon DOUBLE, gps_alt DOUBLE,
    track_status_code STRING, flag_state STRING,
    weather_air_temp_c FLOAT, weather_track_temp_c FLOAT, weather_humidity_pct FLOAT,
    weather_wind_speed_kph FLOAT, weather_wind_direction_deg FLOAT,
    source STRING, ingest_id STRING, sensor_quality_score FLOAT, sequence_number BIGINT,
    sampling_weight FLOAT, telemetry_hash STRING, correlation_id STRING
"""

RACE_EVENT_DDL = """
    session_id STRING NOT NULL, event_id STRING NOT NULL, event_ts_utc STRING NOT NULL,
    event_type STRING NOT NULL, driver_id STRING, driver_name STRING, lap_number INT,
    pit_stop_id STRING, pit_duration_ms BIGINT, penalty_seconds FLOAT, safety_car_state STRING,
    payload STRING, source STRING, event_hash STRING, interaction_strength FLOAT,
    community_id STRING, strategic_context STRING, position_delta INT, sector_time_delta_ms BIGINT
"""

LAP_METRICS_DDL = """
    session_id STRING NOT NULL, driver_id STRING NOT NULL, lap_number INT NOT NULL,
    lap_time_ms BIGINT, sector1_ms BIGINT, sector2_ms BIGINT, sector3_ms BIGINT,
    avg_speed_kph FLOAT, max_speed_kph FLOAT, min_speed_kph FLOAT, tyre_compound STRING,
    fuel_used_kg FLOAT, battery_delta_pct FLOAT, stint_id STRING,
    generated_at TIMESTAMP, metadata ARRAY<STRING>
"""

INTERACTION_DDL = """
    attacker_id STRING, defender_id STRING, driver_a_id STRING, driver_b_id STRING,
    lap_number INT, lap_count INT, avg_gap_ms FLOAT, delta_time_ms FLOAT,
    battle_type STRING, notes STRING
"""

TYPES = {
    "STRING": StringType(), "INT": IntegerType(), "BIGINT": LongType(), "FLOAT": FloatType(),
    "DOUBLE": DoubleType(), "TIMESTAMP": TimestampType(), "ARRAY<STRING>": ArrayType(StringType()),
}


def _struct(ddl: str) -> StructType:
    """``StructType.fromDDL`` for the texts above, without needing a running session."""
    fields = []
    for column in ddl.split(","):
        name, kind, *rest = column.split()
        fields.append(StructField(name, TYPES[kind], rest != ["NOT", "NULL"]))
    return StructType(fields)


TELEMETRY = _struct(TELEMETRY_DDL)
RACE_EVENT = _struct(RACE_EVENT_DDL)
LAP_METRICS = _struct(LAP_METRICS_DDL)
INTERACTION = _struct(INTERACTION_DDL)


def relaxed(schema: StructType) -> StructType:
    """The same fields, all nullable (what ``from_json`` really returns)."""
    return StructType([StructField(f.name, f.dataType, True) for f in schema.fields])

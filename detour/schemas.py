"""Explicit schemas for every record the engine reads or writes (no inference)."""

from pyspark.sql.types import (
    ArrayType, BinaryType, BooleanType, DoubleType, IntegerType, LongType,
    StringType, StructField, StructType, TimestampType,
)

# Raw line-status document: one row per line, statuses as a nested list.
DISRUPTION = StructType([StructField("description", StringType())])
LINE_STATUS = StructType([
    StructField("statusSeverity", IntegerType()),
    StructField("statusSeverityDescription", StringType()),
    StructField("disruption", DISRUPTION),
])
RAW_LINE = StructType([
    StructField("id", StringType()),
    StructField("name", StringType()),
    StructField("lineStatuses", ArrayType(LINE_STATUS)),
])

# Status event: the broker message contract.
STATUS_EVENT = StructType([
    StructField("event_type", StringType()),
    StructField("line_id", StringType()),
    StructField("line_name", StringType()),
    StructField("severity_code", IntegerType()),
    StructField("severity_desc", StringType()),
    StructField("is_disrupted", BooleanType()),
    StructField("disruption_detail", StringType()),
    StructField("ingested_at_utc", StringType()),
])

# Broker record as a Kafka-style source presents it (only these two are used).
BROKER_RECORD = StructType([
    StructField("value", BinaryType()),
    StructField("timestamp", TimestampType()),
])

# Station documents: a list under ``stopPoints``.
STATION_POINT = StructType([
    StructField("id", StringType()),
    StructField("commonName", StringType()),
    StructField("lat", DoubleType()),
    StructField("lon", DoubleType()),
    StructField("stopType", StringType()),
])
STATION_DOC = StructType([StructField("stopPoints", ArrayType(STATION_POINT))])

# Nearby-stop documents: one per station, each stop lists the routes serving it.
ROUTE_REF = StructType([StructField("id", StringType()), StructField("name", StringType())])
NEARBY_STOP = StructType([
    StructField("id", StringType()),
    StructField("commonName", StringType()),
    StructField("lat", DoubleType()),
    StructField("lon", DoubleType()),
    StructField("distance", DoubleType()),
    StructField("lines", ArrayType(ROUTE_REF)),
])
NEARBY_DOC = StructType([
    StructField("station_id", StringType()),
    StructField("stopPoints", ArrayType(NEARBY_STOP)),
])

# Line membership documents: the stop points a line calls at.
MEMBER_STOP = StructType([StructField("id", StringType()), StructField("stopType", StringType())])
MEMBERSHIP_DOC = StructType([
    StructField("line_id", StringType()),
    StructField("stops", ArrayType(MEMBER_STOP)),
])

# Path row and alert (the history table contract).
PATH_ROW = StructType([
    StructField("station_name", StringType()),
    StructField("bus_stop_name", StringType()),
    StructField("bus_stop_id", StringType()),
    StructField("lat", DoubleType()),
    StructField("lon", DoubleType()),
    StructField("distance_metres", DoubleType()),
    StructField("route_name", StringType()),
])
ALERT = StructType([
    StructField("line_id", StringType()),
    StructField("line_name", StringType()),
    StructField("severity", StringType()),
    StructField("gridlock_alert", BooleanType()),
    StructField("affected_stations", ArrayType(StringType())),
    StructField("available_routes", ArrayType(StringType())),
    StructField("nearby_bus_stops", ArrayType(PATH_ROW)),
    StructField("batch_id", LongType()),
    StructField("ingested_at_utc", StringType()),
    StructField("processed_at_utc", StringType()),
])

from detour.fixed import BUS_STOP_TYPE, METRO_STATION_TYPE, STATUS_EVENT_TYPE  # noqa: E402,F401

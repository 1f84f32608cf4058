"""Record layouts."""

from pyspark.sql import types as T

# Column names of the raw trip file, in file order (fixed values).
RAW_TRIP = T.StructType([
    T.StructField("Trip Duration", T.IntegerType()),
    T.StructField("Start Time", T.StringType()),
    T.StructField("Stop Time", T.StringType()),
    T.StructField("Start Station ID", T.StringType()),
    T.StructField("Start Station Name", T.StringType()),
    T.StructField("Start Station Latitude", T.DoubleType()),
    T.StructField("Start Station Longitude", T.DoubleType()),
    T.StructField("End Station ID", T.StringType()),
    T.StructField("End Station Name", T.StringType()),
    T.StructField("End Station Latitude", T.DoubleType()),
    T.StructField("End Station Longitude", T.DoubleType()),
    T.StructField("Bike ID", T.StringType()),
    T.StructField("User Type", T.StringType()),
    T.StructField("Birth Year", T.DoubleType()),
    T.StructField("Gender", T.IntegerType()),
])

TRIP = T.StructType([
    T.StructField("bike_id", T.StringType()),
    T.StructField("start_station_id", T.LongType()),
    T.StructField("end_station_id", T.LongType()),
    T.StructField("started_at_ms", T.LongType()),
    T.StructField("ended_at_ms", T.LongType()),
    T.StructField("ingest_ts_ms", T.LongType()),
    T.StructField("trip_seq", T.LongType()),
])

# The wire form of a trip: every field is text, as in a string map.
WIRE_TRIP = T.StructType([T.StructField(f.name, T.StringType()) for f in TRIP])

MATCH = T.StructType([
    T.StructField("bike_id", T.StringType()),
    T.StructField("a1_start", T.LongType()),
    T.StructField("ai_end", T.LongType()),
    T.StructField("b_end", T.LongType()),
    T.StructField("first_ts_ms", T.LongType()),
    T.StructField("b_ended_ms", T.LongType()),
    T.StructField("length_a", T.IntegerType()),
    T.StructField("ingest_ts_ms", T.LongType()),
    T.StructField("emit_ts_ms", T.LongType()),
])

MATCH_TEXT = T.StructType([T.StructField(f.name, T.StringType()) for f in MATCH])

LATENCY = T.StructType([
    T.StructField("shard", T.IntegerType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("latency_ms", T.DoubleType()),
])

BACKLOG = T.StructType([
    T.StructField("shard", T.IntegerType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("pending", T.LongType()),
])

SHED_FLAGS = T.StructType([
    T.StructField("shard", T.IntegerType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("active", T.BooleanType()),
])

CHAIN = T.ArrayType(T.StructType([
    T.StructField("start_station_id", T.LongType()),
    T.StructField("end_station_id", T.LongType()),
    T.StructField("started_at_ms", T.LongType()),
    T.StructField("ended_at_ms", T.LongType()),
]))

"""Row types shared by the batch and the streaming operators."""

from pyspark.sql import types as T

READING = T.StructType([
    T.StructField("device_id", T.StringType()),
    T.StructField("sensor", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("value", T.DoubleType()),
    # where the row came from: the tie-break for readings with equal timestamps
    T.StructField("src_partition", T.IntegerType()),
    T.StructField("src_offset", T.LongType()),
])

STATS = T.StructType([
    T.StructField("device_id", T.StringType()),
    T.StructField("sensor", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("min_value", T.DoubleType()),
    T.StructField("max_value", T.DoubleType()),
    T.StructField("avg_value", T.DoubleType()),
    T.StructField("n", T.LongType()),
    T.StructField("expected_n", T.LongType()),
    T.StructField("is_complete", T.BooleanType()),
])

# what a Kafka sink takes
RECORD = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("value", T.StringType()),
])

# a landed MQTT message
MESSAGE = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("payload", T.StringType()),
    T.StructField("ts", T.TimestampType()),
])

READING_KEY = ("device_id", "sensor", "metric")
ARRIVAL_ORDER = ("ts", "src_partition", "src_offset")

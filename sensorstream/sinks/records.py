"""Where (topic, value) records, dead letters and tables go."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from sensorstream import fixed
from sensorstream.functions.topics import is_legal_kafka_topic
from sensorstream.schemas import RECORD

ILLEGAL_TOPIC = "illegal topic name"
NO_PAYLOAD = "no payload"


def kafka_sink_options(bootstrap_servers: str, topic: str | None = None, **producer: str) -> dict[str, str]:
    """Without `topic` every record goes to the topic in its own column."""
    options = {"kafka.bootstrap.servers": bootstrap_servers}
    if topic:
        options["topic"] = topic
    return options | {f"kafka.{key}": value for key, value in producer.items()}


def checkpointed(writer: DataStreamWriter, checkpoint: str, period: str | None = fixed.CHECKPOINT_PERIOD):
    """A trigger every `period`; None processes what there is and stops."""
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=period) if period else writer.trigger(availableNow=True)


def to_kafka(records: DataFrame, checkpoint: str, bootstrap_servers: str, topic: str | None = None,
             period: str | None = fixed.CHECKPOINT_PERIOD, **producer: str) -> DataStreamWriter:
    """At least once; needs the Spark Kafka connector on the class path."""
    writer = records.writeStream.format("kafka").outputMode("append")
    writer = writer.options(**kafka_sink_options(bootstrap_servers, topic, **producer))
    return checkpointed(writer, checkpoint, period)


def publish_to_kafka(records: DataFrame, bootstrap_servers: str, topic: str | None = None, **producer: str) -> None:
    """A finished table of records, sent once; needs the Spark Kafka connector."""
    records.write.format("kafka").options(**kafka_sink_options(bootstrap_servers, topic, **producer)).save()


def one_record(spark: SparkSession, topic: str, text: str) -> DataFrame:
    """A single text message for a topic."""
    return spark.createDataFrame([(topic, text)], RECORD)


def to_lines(df: DataFrame, path: str, checkpoint: str,
             period: str | None = fixed.CHECKPOINT_PERIOD) -> DataStreamWriter:
    """Every row as a JSON line in text files, written where the rows are."""
    lines = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))
    return checkpointed(lines.writeStream.format("text").option("path", path).outputMode("append"), checkpoint, period)


def to_table(df: DataFrame, path: str, checkpoint: str,
             period: str | None = fixed.CHECKPOINT_PERIOD) -> DataStreamWriter:
    """Append to a table that other queries follow. The log kept in the table names each batch's files
    once: a batch that runs again adds nothing, and readers see all of a batch or none of it."""
    return checkpointed(df.writeStream.format("parquet").option("path", path).outputMode("append"), checkpoint, period)


def preview_on_console(df: DataFrame, checkpoint: str, rows: int = 20,
                       period: str | None = fixed.CHECKPOINT_PERIOD) -> DataStreamWriter:
    """A look at the first `rows` rows of each micro-batch on the driver's console; `to_lines` writes all."""
    writer = df.writeStream.format("console").outputMode("append")
    return checkpointed(writer.option("truncate", "false").option("numRows", rows), checkpoint, period)


def write_by_topic(records: DataFrame, path: str, mode: str = "append") -> None:
    """A table partitioned by topic, so a topic filter later reads only its folder.

    The rebalance lets Spark cut a hot topic into several files at run time and put rare ones
    together in a task, each with a file of its own.
    """
    records.hint("rebalance", F.col("topic")).write.mode(mode).partitionBy("topic").parquet(path)


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch={batch_id}"


def to_tables(df: DataFrame, checkpoint: str, outputs: dict[str, Callable[[DataFrame], DataFrame]],
              period: str | None = fixed.CHECKPOINT_PERIOD) -> DataStreamWriter:
    """Several tables from one pass of a stream, each micro-batch in a folder of its own.

    A batch that is run again after a failure overwrites its folder, so the tables hold every
    batch once. Read them with `spark.read.parquet(path)`.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        several = len(outputs) > 1
        if several:
            batch = batch.persist()
        try:
            for path, view in outputs.items():
                view(batch).write.mode("overwrite").parquet(batch_folder(path, batch_id))
        finally:
            if several:
                batch.unpersist()

    return checkpointed(df.writeStream.outputMode("append").foreachBatch(write), checkpoint, period)


def bridge_error(topic: Column, payload: Column) -> Column:
    """Why a rewritten message cannot be forwarded; null if it can."""
    return (
        F.when(~F.coalesce(is_legal_kafka_topic(topic), F.lit(False)), ILLEGAL_TOPIC)
        .when(payload.isNull(), NO_PAYLOAD)
    )


def letter(error: Column, topic: Column, payload: Column, at: Column) -> Column:
    """The JSON text of a dead letter; `at` is the time of failure."""
    body = F.struct(
        error.alias("error"),
        topic.alias("originalTopic"),
        payload.alias("originalPayload"),
        F.unix_millis(at).cast("string").alias("timestamp"),
    )
    return F.to_json(body, {"ignoreNullFields": "false"})


def dead_letters(failed: DataFrame, error: Column, topic: Column, payload: Column, at: Column,
                 dead_topic: str = fixed.DEAD_TOPIC, keep=()) -> DataFrame:
    """Failed messages as JSON records for the dead topic."""
    return failed.select(
        *keep, F.lit(dead_topic).alias("topic"), letter(error, topic, payload, at).alias("value")
    )


def reject_letters(rejects: DataFrame, at: Column, payload: str, dead_topic: str = fixed.DEAD_TOPIC,
                   keep=()) -> DataFrame:
    """Parser rejects as dead letters."""
    return dead_letters(rejects, F.col("reject_reason"), F.col("topic"), F.col(payload), at, dead_topic, keep)

"""Run streams to the end of their input and read back what they wrote."""

from __future__ import annotations

import atexit
import shutil
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from sensorstream.session import STATE_SETTINGS

_OWN_SCRATCH: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints. Where it names none, a folder below the
    warehouse, which is removed when a local session's process ends; on a cluster the
    warehouse must then not be a local path."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    local = warehouse.startswith(("/", "file:"))
    if local and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if warehouse not in _OWN_SCRATCH:
        _OWN_SCRATCH[warehouse] = f"{warehouse}/sensorstream-{uuid.uuid4().hex}"
        if local:
            path = "/" + _OWN_SCRATCH[warehouse].removeprefix("file:").lstrip("/")
            atexit.register(shutil.rmtree, path, ignore_errors=True)
    return _OWN_SCRATCH[warehouse]


@contextmanager
def stream_settings(spark: SparkSession, state_partitions: int | None = None) -> Iterator[None]:
    """Settings a query takes over when it starts: state store, number of state partitions.

    The number of state partitions is fixed by a query's first run.
    """
    wanted = dict(STATE_SETTINGS)
    if state_partitions:
        wanted["spark.sql.shuffle.partitions"] = str(state_partitions)
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def run_to_table(
    stream: DataFrame, name: str, state_partitions: int | None = None, folder: str | None = None
) -> DataFrame:
    """Process all there is and return what the stream appended, as a table.

    State, offsets and rows go to the shared folder, so a lost executor costs a retried task.
    Called again with the same `folder`, the query continues from its checkpoint; without one
    it starts anew.
    """
    spark = stream.sparkSession
    folder = folder or f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with stream_settings(spark, state_partitions or spark.sparkContext.defaultParallelism):
        query = (
            stream.writeStream.format("parquet")
            .outputMode("append")
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .start(f"{folder}/rows")
        )
        query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")

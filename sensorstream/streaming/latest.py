"""The latest row of each key, kept up to date by a stream in a table that a retried batch does not change."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from sensorstream.schemas import ARRIVAL_ORDER


def latest_rows(rows: DataFrame, key_cols: Sequence[str], order_cols: Sequence[str] = ARRIVAL_ORDER) -> DataFrame:
    """Of the rows of each key the last one in `order_cols`; null keys are keys like any other. Combined in
    each task before the shuffle."""
    order = F.struct(*order_cols)
    last = rows.groupBy(*key_cols).agg(F.max_by(F.struct(*rows.columns), order).alias("_row"))
    return last.select("_row.*")


class LatestTable:
    """A keyed table below `folder`: `delta/batch=N` holds the latest row of every key that batch N brought, `base/batch=N`
    what all batches up to N came to. A batch writes its own delta only, so what a micro-batch costs follows its keys, not the
    table; every `compact_every` batches a base is written and reading starts from there. A batch that runs
    again replaces what it wrote. Older folders are left to the owner's retention: a reader may still be in them."""

    def __init__(
        self, spark: SparkSession, folder: str, schema: T.StructType, key_cols: Sequence[str],
        order_cols: Sequence[str] = ARRIVAL_ORDER, compact_every: int = 50,
    ):
        if compact_every < 1:
            raise ValueError("compact_every must be positive")
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema
        self.key_cols, self.order_cols, self.compact_every = list(key_cols), list(order_cols), compact_every

    def _batches(self, kind: str) -> list[int]:
        """Numbers of the batches that are whole: they have their success mark."""
        jvm = self.spark._jvm.org.apache.hadoop.fs
        marks = jvm.Path(f"{self.folder}/{kind}/batch=*/_SUCCESS")
        found = marks.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).globStatus(marks) or []
        return sorted(int(s.getPath().getParent().getName().partition("=")[2]) for s in found)

    def read(self, upto: int | None = None) -> DataFrame:
        """The table after the last whole batch, or after batch `upto`."""
        known = [b for b in self._batches("base") if upto is None or b <= upto]
        start = known[-1] if known else -1
        paths = [f"{self.folder}/base/batch={start}"] if known else []
        paths += [f"{self.folder}/delta/batch={b}" for b in self._batches("delta") if b > start and (upto is None or b <= upto)]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        # the files of a batch, not its folder: no column is made of its name
        return latest_rows(self.spark.read.schema(self.schema).parquet(*paths), self.key_cols, self.order_cols)

    def write_batch(self, rows: DataFrame, batch_id: int) -> None:
        newest = latest_rows(rows.select(*self.schema.names), self.key_cols, self.order_cols)
        newest.write.mode("overwrite").parquet(f"{self.folder}/delta/batch={batch_id}")
        if batch_id % self.compact_every == self.compact_every - 1:
            self.read(batch_id).write.mode("overwrite").parquet(f"{self.folder}/base/batch={batch_id}")

    def follow(self, stream: DataFrame, checkpoint: str) -> DataStreamWriter:
        """The writer that keeps this table up to date from `stream`; start it with a trigger of choice."""
        return stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(self.write_batch)


def latest_to_table(stream: DataFrame, folder: str, key_cols: Sequence[str], order_cols: Sequence[str] = ARRIVAL_ORDER, compact_every: int = 50) -> DataFrame:
    """Follow `stream` to the end of its input and return the table. Called again with the same folder it goes on where it stopped."""
    table = LatestTable(stream.sparkSession, f"{folder}/latest", stream.schema, key_cols, order_cols, compact_every)
    table.follow(stream, f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return table.read()

"""The last known value at every tick of a clock, on a stream."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sensorstream import fixed
from sensorstream.functions.timing import duration_us
from sensorstream.operators.carry import hold_ranges
from sensorstream.schemas import ARRIVAL_ORDER, READING_KEY


class Holder(StatefulProcessor):
    """Keeps each key's value and the last tick at which it was shown, and shows it at the ticks that follow
    until a new value comes or, by a timer, as far as the watermark has come.

    It returns stretches of ticks, not ticks: a key costs a row per new value and per micro-batch of silence.
    """

    def __init__(self, key_names: list[str], tick_us: int):
        self.key_names = key_names
        self.tick_us = tick_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", T.StructType([
            T.StructField("value", T.DoubleType()), T.StructField("shown_us", T.LongType())]))

    def _rows(self, key, value: float, first_us: int, last_us: int) -> Iterator[Row]:
        if first_us <= last_us:
            yield Row(**dict(zip(self.key_names, key)), value=value, _from_us=first_us, _to_us=last_us)

    def _timer_ms(self, shown_us: int) -> int:
        # the first whole millisecond after the next tick: by then its own samples are in
        return (shown_us + self.tick_us) // 1000 + 1

    def _keep(self, value: float, shown_us: int) -> None:
        self.held.update((value, shown_us))
        self.handle.registerTimer(self._timer_ms(shown_us))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        value, shown = self.held.get() if self.held.exists() else (None, None)
        if shown is not None:
            self.handle.deleteTimer(self._timer_ms(shown))
        for row in sorted(rows, key=lambda r: r["tick_us"]):
            if shown is not None:
                yield from self._rows(key, value, shown + self.tick_us, row["tick_us"] - self.tick_us)
            value, shown = row["value"], row["tick_us"]
            yield from self._rows(key, value, shown, shown)
        self._keep(value, shown)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.held.exists():
            return
        value, shown = self.held.get()
        if self._timer_ms(shown) != expiredTimerInfo.getExpiryTimeInMs():
            return
        # ticks before the watermark: samples of a tick at the watermark may still come
        last = (timerValues.getCurrentWatermarkInMs() * 1000 - 1) // self.tick_us * self.tick_us
        yield from self._rows(key, value, shown + self.tick_us, last)
        self._keep(value, max(shown, last))

    def close(self) -> None:
        pass


def held_values_stream(
    samples: DataFrame,
    tick: str = fixed.EXPECTED_INTERVAL,
    key_cols=READING_KEY,
    order_cols=ARRIVAL_ORDER,
) -> DataFrame:
    """The stream form of `held_values`, over samples watermarked on `ts`: a tick is shown once the watermark has
    passed it, by silent sensors too. A sensor that stays silent is repeated as long as the stream runs.

    Samples are first combined per key and tick by a windowed aggregate, which also brings them
    in order; the state step sees one row per key and tick with a value. Missing samples move time on too.
    """
    tick_us = duration_us(tick)
    keys = list(key_cols)
    # a microsecond late: windows are (tick before, tick]
    window = F.window("ts", f"{tick_us} microseconds", f"{tick_us} microseconds", "1 microseconds")
    # missing samples are left out after the aggregate: a filter before it would be moved below the watermark
    newest = (
        samples.groupBy(window.alias("span"), *keys)
        .agg(F.max_by("value", F.when(F.col("value").isNotNull(), F.struct(*order_cols))).alias("value"))
        .where(F.col("value").isNotNull())
        .select(*keys, "value", (F.unix_micros("span.end") - 1).alias("tick_us"))
    )
    schema = T.StructType(
        [newest.schema[k] for k in keys]
        + [T.StructField("value", T.DoubleType()), T.StructField("_from_us", T.LongType()), T.StructField("_to_us", T.LongType())]
    )
    ranges = newest.groupBy(*keys).transformWithState(
        statefulProcessor=Holder(keys, tick_us), outputStructType=schema, outputMode="Append", timeMode="EventTime",
    )
    return hold_ranges(ranges, keys, tick_us)

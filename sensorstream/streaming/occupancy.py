"""The occupancy state machine on a stream."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sensorstream import fixed
from sensorstream.functions.timing import duration_us
from sensorstream.operators.occupancy import OCCUPIED, UNOCCUPIED

_EPOCH = datetime(1970, 1, 1)


def _instant(us: int) -> datetime:
    return _EPOCH + timedelta(microseconds=us)


class Occupancy(StatefulProcessor):
    """Occupied at the first event of a stay, Unoccupied when the timeout passes without one.

    State is the time of the last event of the open stay. A micro-batch may hold several stays,
    so its events are walked in time order and stays end inside the batch as well as by timer.
    """

    def __init__(self, key_names: list[str], timeout_us: int):
        self.key_names = key_names
        self.timeout_us = timeout_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.stay = handle.getValueState("stay", T.StructType([T.StructField("last_us", T.LongType())]))

    def _row(self, key, state: str, us: int) -> Row:
        return Row(**dict(zip(self.key_names, key)), state=state, at=_instant(us))

    def _timer_ms(self, last_us: int) -> int:
        # the first whole millisecond at which the timeout has passed
        return -(-(last_us + self.timeout_us) // 1000)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = self.stay.get()[0] if self.stay.exists() else None
        last = before
        for us in sorted({row["at_us"] for row in rows}):
            if last is not None and us - last > self.timeout_us:
                yield self._row(key, UNOCCUPIED, last + self.timeout_us)
                last = None
            if last is None:
                yield self._row(key, OCCUPIED, us)
            # an event older than the last one does not bring the timeout forward
            last = us if last is None else max(last, us)
        if last != before:
            if before is not None:
                self.handle.deleteTimer(self._timer_ms(before))
            self.stay.update((last,))
            self.handle.registerTimer(self._timer_ms(last))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.stay.exists():
            last = self.stay.get()[0]
            if self._timer_ms(last) <= expiredTimerInfo.getExpiryTimeInMs():
                self.stay.clear()
                yield self._row(key, UNOCCUPIED, last + self.timeout_us)

    def close(self) -> None:
        pass


def occupancy_transitions_stream(
    events: DataFrame, key_cols=("room",), timeout: str = fixed.OCCUPANCY_TIMEOUT
) -> DataFrame:
    """key_cols, state, at. `events` is watermarked on `at`.

    Events of one key and instant are first combined by a windowless aggregate, whose partial
    step leaves at most one row per key, instant and task before its shuffle: the state machine
    of a single global key sees one row per instant, however many devices report. The aggregate
    also hands events on only once the watermark has passed them, so they come in order across
    micro-batches.
    """
    keys = list(key_cols)
    rows = (
        events.groupBy(*keys, "at")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*keys, "at", F.unix_micros("at").alias("at_us"))
    )
    schema = T.StructType(
        [rows.schema[k] for k in keys]
        + [T.StructField("state", T.StringType()), T.StructField("at", T.TimestampType())]
    )
    return rows.groupBy(*keys).transformWithState(
        statefulProcessor=Occupancy(keys, duration_us(timeout)),
        outputStructType=schema,
        outputMode="Append",
        timeMode="EventTime",
    )


def occupancy_stays_stream(
    events: DataFrame, key_cols=("room",), timeout: str = fixed.OCCUPANCY_TIMEOUT
) -> DataFrame:
    """key_cols, since, until, n: every stay once it is over, with its number of events. `events` is
    watermarked on `at`.

    A stay is a session window with a gap of the timeout and a microsecond, as exactly one timeout
    apart is the same stay. Spark merges sessions inside each task before the shuffle (a stream
    setting of `stream_settings`) and in the state store, without Python. A stay is shown when the
    watermark passes its end; `occupancy_transitions_stream` shows Occupied at once.
    """
    keys = list(key_cols)
    stays = events.groupBy(F.session_window("at", f"{duration_us(timeout) + 1} microseconds").alias("stay"), *keys).agg(
        F.count(F.lit(1)).alias("n")
    )
    until = F.timestamp_micros(F.unix_micros("stay.end") - 1)
    return stays.select(*keys, F.col("stay.start").alias("since"), until.alias("until"), "n")

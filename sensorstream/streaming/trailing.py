"""Aggregates over the readings of the last `width`, one result per reading, on a stream."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorstream.functions.timing import duration_us
from sensorstream.schemas import READING_KEY


def frames(at: np.ndarray, value: np.ndarray, known: np.ndarray, own: int, width_us: int):
    """n, sum, min and max of (t - width, t] for the readings from index `own` on; all of `at` lies within a
    width before and a width after at[own]'s part. A frame is an end of the part before and a beginning of the own
    part, so running aggregates from the border both ways answer all frames; nothing is subtracted."""
    low = np.searchsorted(at[:own], at[own:] - width_us, "right")
    high = np.searchsorted(at[own:], at[own:], "right") - 1
    out = []
    for run, start, blank in ((np.add, 0, 0), (np.add, 0.0, 0.0), (np.minimum, np.inf, np.inf), (np.maximum, -np.inf, -np.inf)):
        parts = known.astype(np.int64) if isinstance(blank, int) else np.where(known, value, blank)
        back = np.append(run.accumulate(parts[:own][::-1])[::-1], start)
        out.append(run(back[low], run.accumulate(parts[own:])[high]))
    return out


def _answer(keys: list[str], fields: list[str], names: list[str], width_us: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("run")
            flat = lists.flatten()
            bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
            at, values = flat.field("_at").to_numpy(zero_copy_only=False), flat.field("value")
            value, known = values.fill_null(0.0).to_numpy(zero_copy_only=False), values.is_valid().to_numpy(zero_copy_only=False)
            group, place, found = [], [], []
            for k, border in enumerate(batch.column("_border").to_pylist()):
                first, last = bounds[k], bounds[k + 1]
                own = int(np.searchsorted(at[first:last], border))
                if own == last - first:
                    continue
                found.append(frames(at[first:last], value[first:last], known[first:last], own, width_us))
                place.append(np.arange(first + own, last))
                group.append(np.full(last - first - own, k))
            if not found:
                continue
            rows, groups = pa.array(np.concatenate(place)), pa.array(np.concatenate(group))
            n, *rest = (np.concatenate(columns) for columns in zip(*found, strict=True))
            columns = [batch.column(k).take(groups) for k in keys] + [flat.field(f).take(rows) for f in fields] + [pa.array(n)]
            columns += [pa.array(x, mask=n == 0) for x in rest]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def trailing_stream(readings: DataFrame, width: str, key_cols=READING_KEY, keep=(), step: str | None = None) -> DataFrame:
    """The stream form of `trailing`, over readings watermarked on `ts`: key_cols, ts, value, `keep`, and n, sum_value,
    min_value, max_value of (ts - width, ts].

    A windowed aggregate gathers the readings of `step` (a width, if not given; it must divide it) together with those of the width
    before, in order, and hands them on once the watermark has passed them; what is left needs no state. A result shows
    up to a `step` and the watermark's delay after its reading; state holds width / step + 1 copies of the
    readings. The largest unit is the readings of one key in a width and a step.
    """
    width_us = duration_us(width)
    step_us = duration_us(step) if step else width_us
    if width_us % step_us:
        raise ValueError("the step must divide the width")
    keys = list(key_cols)
    others = [c for c in dict.fromkeys(keep) if c not in (*keys, "ts", "value")]
    fields = ["_at", *others, "value"]
    window = F.window("ts", f"{width_us + step_us} microseconds", f"{step_us} microseconds").alias("span")
    item = F.struct(F.unix_micros("ts").alias("_at"), *others, F.col("value").cast("double").alias("value"))
    gathered = (
        readings.groupBy(window, *keys)
        .agg(F.array_sort(F.collect_list(item)).alias("run"))
        .select(*keys, (F.unix_micros("span.start") + width_us).alias("_border"), "run")
    )
    inner = {f.name: f for f in gathered.schema["run"].dataType.elementType}
    schema = T.StructType(
        [gathered.schema[k] for k in keys] + [inner[f] for f in fields] + [T.StructField("n", T.LongType())]
        + [T.StructField(f, T.DoubleType()) for f in ("sum_value", "min_value", "max_value")]
    )
    found = gathered.mapInArrow(_answer(keys, fields, schema.names, width_us), schema)
    return found.select(*keys, F.timestamp_micros("_at").alias("ts"), "value", *others, "n", "sum_value", "min_value", "max_value")

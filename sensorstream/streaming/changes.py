"""Threshold changes on a stream."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sensorstream import fixed
from sensorstream.functions.timing import duration_us
from sensorstream.operators.changes import is_above
from sensorstream.schemas import ARRIVAL_ORDER, READING_KEY

PANE = "1 second"


#: Edges that leave the state step together.
OUT_ROWS = 10_000


def _is_fixed(kind: T.DataType) -> bool:
    return isinstance(kind, (T.BooleanType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.TimestampType, T.TimestampNTZType, T.DateType))


class Packing:
    """Rows of edges as bytes: values of fixed width and their null marks as records, all others pickled. A row of
    bytes holds many edges, so that Python holds some 50 bytes an edge, not a row of objects."""

    def __init__(self, fields: list[T.StructField]):
        self.fixed = [f.name for f in fields if _is_fixed(f.dataType)]
        self.other = [f.name for f in fields if not _is_fixed(f.dataType)]
        self.types = {f.name: to_arrow_type(f.dataType) for f in fields}
        self.record = np.dtype([x for i, name in enumerate(self.fixed) for x in ((f"v{i}", f"i{self._width(name)}"), (f"n{i}", "?"))])

    def _width(self, name: str) -> int:
        return max(1, self.types[name].bit_width // 8)

    def _ints(self, name: str) -> pa.DataType:
        return {1: pa.uint8(), 4: pa.int32(), 8: pa.int64()}[self._width(name)]

    def records(self, rows: pa.Table) -> np.ndarray:
        out = np.empty(rows.num_rows, self.record)
        for i, name in enumerate(self.fixed):
            column = rows.column(name).combine_chunks()
            out[f"n{i}"] = column.is_null().to_numpy(zero_copy_only=False)
            ints = column.cast(pa.uint8()) if self._width(name) == 1 else column.view(self._ints(name))
            out[f"v{i}"] = ints.fill_null(0).to_numpy()
        return out

    def values(self, records: np.ndarray, name: str) -> pa.Array:
        i = self.fixed.index(name)
        ints = pa.array(np.ascontiguousarray(records[f"v{i}"]).astype(self._ints(name).to_pandas_dtype()), mask=np.ascontiguousarray(records[f"n{i}"]))
        return ints.cast(self.types[name]) if self._width(name) == 1 else ints.view(self.types[name])


def _by_key(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of edges to rows of bytes: one for each key in a batch, whichever edges the batch has."""
    packing = Packing([f for f in rows.schema.fields if f.name not in keys])
    kept = T.StructType([*(f for f in rows.schema.fields if f.name in keys), *_BYTES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if not len(rows):
                continue
            groups = rows.select(keys).append_column("_row", pa.array(np.arange(len(rows)))).group_by(keys, use_threads=False).aggregate([("_row", "list")])
            places = groups.column("_row_list").combine_chunks()
            rows = rows.take(places.flatten())
            cuts = (places.offsets.to_numpy() - places.offsets[0].as_py()).tolist()
            raw, width = packing.records(rows).tobytes(), packing.record.itemsize
            others = list(zip(*(rows.column(c).to_pylist() for c in packing.other), strict=True))
            fixed = [raw[a * width : b * width] for a, b in zip(cuts, cuts[1:])]
            other = [pickle.dumps(others[a:b]) if others else None for a, b in zip(cuts, cuts[1:])]
            found = [groups.column(n).combine_chunks() if n in keys else pa.array(fixed if n == "_fixed" else other, pa.binary()) for n in kept.names]
            yield pa.RecordBatch.from_arrays(found, names=kept.names)

    return rows.mapInArrow(run, kept)


def _unpacked(packed: DataFrame, schema: T.StructType, keys: list[str], extra: list[T.StructField]) -> DataFrame:
    packing = Packing([f for f in [*extra, *schema.fields] if f.name not in keys])
    types = {f.name: to_arrow_type(f.dataType) for f in schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                own = batch.slice(k, 1)
                records = np.frombuffer(own.column("_fixed")[0].as_py(), packing.record)
                raw = own.column("_other")[0].as_py()
                others = pickle.loads(raw) if raw else []
                columns = []
                for name in schema.names:
                    if name in keys:
                        columns.append(own.column(name).take(pa.array(np.zeros(len(records), np.int64))))
                    elif name in packing.fixed:
                        columns.append(packing.values(records, name))
                    else:
                        at = packing.other.index(name)
                        columns.append(pa.array([row[at] for row in others], types[name]))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return packed.mapInArrow(run, schema)


_BYTES = [T.StructField("_fixed", T.BinaryType()), T.StructField("_other", T.BinaryType())]
_PLACE = [T.StructField("_pane", T.LongType()), T.StructField("_at", T.IntegerType())]


class PaneEdges(StatefulProcessor):
    """Keeps the last status of each key. A pane brings its first reading and the readings at which the
    status changes inside; the first one is a change only if the pane before ended differently."""

    def __init__(self, packing: Packing, key_names: list[str]):
        self.packing = packing
        self.key_names = key_names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", T.StructType([T.StructField("above", T.BooleanType())]))

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self.last.update((initialState["above"],))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = self.last.get()[0] if self.last.exists() else None
        raw, others = bytearray(), []
        for row in rows:
            raw += row["_fixed"]
            if row["_other"]:
                others += pickle.loads(row["_other"])
        edges = np.frombuffer(raw, self.packing.record)
        if not len(edges):
            return
        pane, at, status = (f"v{self.packing.fixed.index(name)}" for name in ("_pane", "_at", "above"))
        order = np.lexsort((edges[at], edges[pane]))
        above = edges[status][order] != 0
        changed = np.empty(len(above), bool)
        changed[0] = known is None or above[0] != known
        changed[1:] = above[1:] != above[:-1]
        self.last.update((bool(above[-1]),))
        order = order[changed]
        for begin in range(0, len(order), OUT_ROWS):
            own = order[begin : begin + OUT_ROWS]
            other = pickle.dumps([others[i] for i in own.tolist()]) if others else None
            yield Row(**dict(zip(self.key_names, key)), _fixed=edges[own].tobytes(), _other=other)

    def close(self) -> None:
        pass


def last_status(
    readings: DataFrame, threshold: float = fixed.CO2_THRESHOLD, key_cols=READING_KEY, order_cols=ARRIVAL_ORDER
) -> DataFrame:
    """key_cols, above: the status of each key's last reading in a table. Combined before the shuffle."""
    above = is_above(F.col("value"), threshold)
    known = readings.where(F.col("value").isNotNull())
    return known.groupBy(*key_cols).agg(F.max_by(above, F.struct(*order_cols)).alias("above"))


def threshold_changes_stream(
    readings: DataFrame,
    threshold: float = fixed.CO2_THRESHOLD,
    key_cols=READING_KEY,
    order_cols=ARRIVAL_ORDER,
    pane: str = PANE,
    initial: DataFrame | None = None,
) -> DataFrame:
    """The stream form of `threshold_changes`, over readings watermarked on `ts`.

    Readings are first put in order per key and pane by a windowed aggregate, which hands a pane
    on once the watermark has passed it; the state step then compares panes of a key, in event
    order, whatever the micro-batches were. Panes reach the state step packed, many to a row, and its changes leave it
    packed. A change shows a pane and the watermark's delay
    after it happened. The largest unit is the readings of one key in one pane.

    `initial` (see `last_status`) has the status at which keys start, one row per key, taken over by the query's first run:
    the first reading of such a key is a change only if its status differs. Then history from a table and
    what comes after it on the stream give the changes of both together.
    """
    keys, order = list(key_cols), list(order_cols)
    columns = list(dict.fromkeys([*keys, *order, "value"]))
    rows = readings.where(F.col("value").isNotNull()).select(
        *columns, is_above(F.col("value"), threshold).alias("above")
    )
    inner = [c for c in dict.fromkeys([*order, *columns, "above"]) if c not in keys]
    run = F.array_sort(F.collect_list(F.struct(*inner)))
    panes = (
        rows.groupBy(F.window("ts", f"{duration_us(pane)} microseconds").alias("pane"), *keys)
        .agg(run.alias("run"))
        .select(
            *keys,
            F.unix_micros("pane.start").alias("pane_us"),
            F.posexplode(
                F.filter("run", lambda r, i: (i == 0) | (r["above"] != F.get("run", i - 1)["above"]))
            ).alias("_at", "edge"),
        )
        .select(*keys, F.col("pane_us").alias("_pane"), "_at", *(F.col("edge")[c].alias(c) for c in inner))
    )
    started = initial.select(*keys, "above").groupBy(*keys) if initial is not None else None
    packed = _by_key(panes, keys)
    packing = Packing([f for f in panes.schema.fields if f.name not in keys])
    found = packed.groupBy(*keys).transformWithState(
        statefulProcessor=PaneEdges(packing, keys),
        outputStructType=T.StructType([*(panes.schema[k] for k in keys), *_BYTES]),
        outputMode="Append",
        timeMode="None",
        initialState=started,
    )
    return _unpacked(found, panes.select(*rows.columns).schema, keys, _PLACE)

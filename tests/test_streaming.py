"""Streams against tables: the same rows, whatever the micro-batches."""

import tracemalloc
import uuid
from datetime import timedelta

import numpy as np
import pyarrow as pa
import pytest
from readings import START, at, make_readings, ms, random_readings
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorstream.operators import carry, changes, occupancy, samples, stats, trailing, trend
from sensorstream.operators.parse import only_metric
from sensorstream.plans import analytics as plan
from sensorstream.plans import bridge, collectors
from sensorstream.sinks import records as sinks
from sensorstream.sources import messages as src
from sensorstream.streaming.hold import held_values_stream
from sensorstream.streaming.latest import LatestTable, latest_to_table
from sensorstream.streaming.changes import Packing, PaneEdges, last_status, threshold_changes_stream
from sensorstream.streaming.occupancy import occupancy_stays_stream, occupancy_transitions_stream
from sensorstream.streaming.trailing import trailing_stream
from sensorstream.streaming.run import run_to_table, shared_folder, stream_settings

PARTITIONS = 1


@pytest.fixture
def land(spark, tmp_path):
    """Write frames as files of one folder, oldest first, and stream them one per micro-batch."""

    def stream(*frames):
        path = str(tmp_path / uuid.uuid4().hex)
        for i, frame in enumerate(frames):
            target = f"{path}/{i:03d}"
            frame.coalesce(1).write.parquet(target)
        return src.read_stream(spark, f"{path}/*", frames[0].schema, files_per_trigger=1)

    return stream


def slices(readings, n):
    """n frames in event order."""
    ordered = readings.orderBy("ts", "src_offset").collect()
    spark, size = readings.sparkSession, -(-len(ordered) // n)
    return [spark.createDataFrame(ordered[i: i + size], readings.schema) for i in range(0, len(ordered), size)]


def window_rows(df):
    return sorted((r.device_id, r.metric, ms(r.window_start), r.min_value, r.max_value, round(r.avg_value, 8), r.n)
                  for r in df.collect())


def closed(windows, readings, delay_ms=10_000):
    limit = ms(readings.agg(F.max("ts")).first()[0]) - delay_ms
    return windows.where(F.unix_millis("window_end") <= limit)


def test_sliding_stats(spark, land):
    readings = random_readings(spark, 400, span_s=3_000)
    stream = src.watermarked(land(*slices(readings, 4)))
    found = run_to_table(stats.sliding_stats(stream).drop("window"), "stats", PARTITIONS)
    assert window_rows(found) == window_rows(closed(stats.sliding_stats(readings), readings))


def test_late_rows_are_left_out_of_closed_windows(spark, land):
    # a row is judged by the watermark of the micro-batch before it, so 3601 comes in between
    frames = [make_readings(spark, [(START + timedelta(seconds=s), v)]) for s, v in (
        (0, 1), (3600, 2), (3601, 2), (10, 3), (3610, 4), (7200, 5))]
    stream = src.watermarked(land(*frames))
    found = run_to_table(stats.sliding_stats(stream, "5 minutes", "5 minutes").drop("window"), "late", PARTITIONS)
    assert sorted((ms(r.window_start) - ms(START), r.n, r.max_value) for r in found.collect()) == [
        (0, 1, 1.0), (3_600_000, 3, 4.0)]


def edges(df, limit):
    """Changes in panes of a second that the watermark has passed."""
    rows = sorted((r.device_id, ms(r.ts), r.src_offset, r.above) for r in df.collect())
    return [r for r in rows if (r[1] // 1000 + 1) * 1000 <= limit]


def watermark(readings):
    return ms(readings.agg(F.max("ts")).first()[0]) - 10_000


@pytest.mark.parametrize("batches", [1, 5, 50])
def test_threshold_changes(spark, land, batches):
    readings = random_readings(spark, 300, step_ms=5_000)
    stream = src.watermarked(land(*slices(readings, batches)))
    found = run_to_table(threshold_changes_stream(stream), "changes", PARTITIONS)
    limit = watermark(readings)
    assert edges(found, 10**18) == edges(changes.threshold_changes(readings), limit)


def test_threshold_changes_out_of_order_across_micro_batches(spark, land):
    # micro-batches of 8 s of readings, each late half in the next one
    readings = random_readings(spark, 400, span_s=64, step_ms=250)
    at = F.unix_millis("ts") - ms(START)
    place = F.floor(at / 8000) + F.when(F.col("src_offset") % 2 == 0, 1).otherwise(0)
    frames = [readings.where(place == i) for i in range(9)]
    stream = src.watermarked(land(*frames))
    found = run_to_table(threshold_changes_stream(stream), "disorder", PARTITIONS)
    assert edges(found, 10**18) == edges(changes.threshold_changes(readings), watermark(readings))


def test_threshold_changes_keep_missing_keys_and_odd_columns(spark, land):
    readings = random_readings(spark, 60, step_ms=5_000).withColumns({
        "sensor": F.expr("nullif(sensor, sensor)"), "src_partition": F.expr("if(src_offset % 3 = 0, null, src_offset % 2)"),
        "value": F.expr("case src_offset % 11 when 4 then double('NaN') when 5 then -0.0d else value end"),
        "mark": F.expr("if(src_offset % 4 = 0, null, repeat('é', int(src_offset % 3)))"), "cents": F.expr("cast(src_offset as decimal(20, 2))"),
        "flag": F.expr("nullif(src_offset % 3, 0) = 1"), "small": F.expr("cast(src_offset as smallint)"), "day": F.expr("if(src_offset % 5 = 0, null, date'0001-01-03')"),
    })
    order = ("ts", "src_partition", "src_offset", "mark", "cents", "flag", "small", "day")
    found = run_to_table(threshold_changes_stream(src.watermarked(land(readings)), order_cols=order), "odd", PARTITIONS)
    wanted = changes.threshold_changes(readings, order_cols=order).where((F.floor(F.unix_millis("ts") / 1000) + 1) * 1000 <= watermark(readings))
    assert found.schema.simpleString() == wanted.schema.simpleString()
    assert sorted(map(repr, found.collect())) == sorted(map(repr, wanted.collect())) and found.count() > 5


def test_threshold_changes_of_a_key_stay_small_in_python():
    inner = T.StructType.fromDDL("_pane long, _at int, ts timestamp, src_partition int, src_offset long, value double, above boolean")
    packing = Packing(inner.fields)
    n, size = 100_000, 1_000
    rows = pa.table({
        "_pane": np.arange(n)[::-1], "_at": np.zeros(n, np.int32), "ts": pa.array(np.arange(n)).cast(pa.timestamp("us", "UTC")), "src_partition": pa.nulls(n, pa.int32()),
        "src_offset": np.arange(n), "value": np.ones(n), "above": np.arange(n) % 2 == 0,
    })
    packed = [Row(_fixed=packing.records(rows.slice(i, size)).tobytes(), _other=None) for i in range(0, n, size)]

    class Last:
        value = None

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

    step = PaneEdges(packing, ["device_id"])
    step.last = Last()
    tracemalloc.start()
    found = list(step.handleInputRows(("s1",), iter(packed), None))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 * n and step.last.value == (True,)
    out = np.concatenate([np.frombuffer(r["_fixed"], packing.record) for r in found])
    assert packing.values(out, "src_offset").to_pylist() == list(range(n))[::-1] and packing.values(out, "src_partition").null_count == n
    # what follows is a change only where it differs from the last one
    assert len(list(step.handleInputRows(("s1",), iter(packed[-1:]), None))) == 1 and step.last.value == (True,)


@pytest.mark.parametrize("batches", [1, 4])
def test_threshold_changes_go_on_from_a_table(spark, land, batches):
    readings = random_readings(spark, 300, step_ms=5_000)
    cut = F.col("ts") < F.lit(START + timedelta(seconds=9_000))
    # a key that only the table has, and one whose last value in the table is missing
    only = make_readings(spark, [(START, 900.0, "s7"), (START + timedelta(seconds=5), 100.0, "s7"), (START + timedelta(seconds=9), None, "s7")])
    history = readings.where(cut).unionByName(only)
    stream = src.watermarked(land(*slices(readings.where(~cut), batches)))
    rest = run_to_table(threshold_changes_stream(stream, initial=last_status(history)), "resumed", PARTITIONS)
    whole = changes.threshold_changes(readings.unionByName(only))
    limit = watermark(readings)
    both = changes.threshold_changes(history).unionByName(rest)
    assert edges(both, 10**18) == edges(whole, limit)
    # without the status, readings that are no change would show as first ones
    assert rest.count() < changes.threshold_changes(readings.where(~cut)).count()


def test_initial_status_without_rows(spark, land):
    readings = random_readings(spark, 50, step_ms=5_000)
    stream = src.watermarked(land(readings))
    found = run_to_table(threshold_changes_stream(stream, initial=last_status(readings.limit(0))), "fresh", PARTITIONS)
    assert edges(found, 10**18) == edges(changes.threshold_changes(readings), watermark(readings))


@pytest.mark.parametrize("batches", [1, 4])
def test_trend(spark, land, batches):
    rows = [(START + timedelta(seconds=20 * i), (i % 23) // 2, f"s{1001 + i % 2}") for i in range(200)]
    readings = make_readings(spark, rows)
    stream = src.watermarked(land(*slices(readings, batches)))
    found = run_to_table(trend.trend_windows_stream(stream).drop("window"), "trend", PARTITIONS)
    wanted = closed(trend.trend_windows(readings), readings)

    def plain(df):
        return sorted((r.sensor, ms(r.window_start), r.n) for r in df.collect())

    assert plain(found) == plain(wanted) and plain(found)


def test_a_restarted_query_goes_on_where_it_stopped(spark, tmp_path):
    readings = random_readings(spark, 300, step_ms=5_000)
    path, folder = str(tmp_path / "landed"), str(tmp_path / "query")

    def run():
        stream = src.watermarked(src.read_stream(spark, f"{path}/*", readings.schema, files_per_trigger=1))
        return run_to_table(threshold_changes_stream(stream), "restart", PARTITIONS, folder)

    for i, part in enumerate(slices(readings, 3)):
        part.coalesce(1).write.parquet(f"{path}/{i}")
        found = run()
    assert edges(found, 10**18) == edges(changes.threshold_changes(readings), watermark(readings))


def test_latest_commands_follow_a_stream(spark, land, tmp_path):
    topic = "i483/actuators/s1001/co2_threshold_crossed"
    frames = [
        spark.createDataFrame([(topic, payload, START + timedelta(seconds=s), 0, s)],
                              "topic string, payload string, ts timestamp, src_partition int, src_offset bigint")
        for s, payload in ((1, "yes"), (5, "no"), (3, "yes"))
    ]
    latest = samples.actuator_latest(samples.actuator_commands(land(*frames)))
    path = str(tmp_path / "latest")
    with stream_settings(spark, PARTITIONS):
        latest.writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).trigger(
            availableNow=True
        ).foreachBatch(lambda df, i: df.write.mode("overwrite").parquet(f"{path}/{i}")).start().awaitTermination()
    assert [spark.read.parquet(f"{path}/{i}").first().on for i in range(3)] == [True, False, False]


COMMANDS = "topic string, on boolean, ts timestamp, src_partition int, src_offset bigint"


@pytest.mark.parametrize("batches", [1, 7])
def test_the_latest_command_is_kept_in_a_table(spark, land, tmp_path, batches):
    readings = random_readings(spark, 300, devices=5, span_s=400, step_ms=1000)
    commands = readings.select(F.nullif("device_id", F.lit("s1003")).alias("topic"), (F.col("value") > 700).alias("on"), "ts", "src_partition", "src_offset")
    rows = sorted(commands.collect(), key=lambda r: r.src_offset % 17)
    size = -(-len(rows) // batches)
    frames = [spark.createDataFrame(rows[i: i + size], COMMANDS) for i in range(0, len(rows), size)]
    found = latest_to_table(land(*frames), str(tmp_path / "t"), ["topic"], compact_every=3)
    wanted = samples.actuator_latest(commands)
    assert {(r.topic, r.on, r.ts) for r in found.collect()} == {(r.topic, r.on, r.since) for r in wanted.collect()}


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    frame = lambda *rows: spark.createDataFrame([(t, on, START + timedelta(seconds=s), 0, s) for t, on, s in rows], COMMANDS)
    table = LatestTable(spark, str(tmp_path / "t"), frame(("a", True, 1)).schema, ["topic"], compact_every=2)
    state = lambda: {(r.topic, r.on, r.src_offset) for r in table.read().collect()}
    assert state() == set()
    for number, rows in enumerate([[("a", True, 5), ("b", True, 1)], [("a", False, 3)], [("b", False, 9), ("b", True, 8), (None, True, 1)]]):
        table.write_batch(frame(*rows), number)
        before = state()
        table.write_batch(frame(*rows), number)
        assert state() == before
    assert before == {("a", True, 5), ("b", False, 9), (None, True, 1)}
    table.write_batch(frame(("a", False, 7)).limit(0), 3)
    assert state() == before and table._batches("base") == [1, 3]


@pytest.mark.parametrize("batches, step", [(1, None), (4, "20 seconds")])
def test_frames_that_end_at_every_reading(spark, land, batches, step):
    """Ties, readings exactly a width apart, missing values, null keys, an odd key of one reading."""
    readings = random_readings(spark, 300, span_s=1_200, step_ms=1_000).withColumns({
        "value": F.when(F.col("src_offset") % 3 != 0, F.col("value")), "device_id": F.nullif("device_id", F.lit("s1003")),
    }).unionByName(make_readings(spark, [(START + timedelta(seconds=31), None, "s9"), (START + timedelta(seconds=9_000), 1, "end")]))
    stream = src.watermarked(land(*slices(readings, batches)))
    found = run_to_table(trailing_stream(stream, "1 minute", keep=["src_offset"], step=step), "frames", PARTITIONS)
    plain = lambda df: sorted((r.device_id or "", ms(r.ts), r.src_offset, r.value is None, r.n, r.min_value or 0, r.max_value or 0, round(r.sum_value or 0, 6))
                              for r in df.collect())
    wanted = trailing.trailing(readings.where("device_id is null or device_id <> 'end'"), "1 minute", keep=["src_offset"])
    assert plain(found) == plain(wanted) and len(plain(found)) == 301
    lone = found.where("device_id = 's9'").first()
    assert (lone.n, lone.sum_value, lone.min_value) == (0, None, None)


def test_a_step_must_divide_the_width(spark, land):
    with pytest.raises(ValueError):
        trailing_stream(src.watermarked(land(random_readings(spark, 5))), "1 minute", step="25 seconds")


@pytest.mark.parametrize("batches", [1, 5])
def test_held_values(spark, land, batches):
    """A tick is shown once, whatever the micro-batches, by sensors that have fallen silent too."""
    samples = random_readings(spark, 90, span_s=1_500, step_ms=5_000).withColumns({
        "value": F.when(F.col("src_offset") % 3 != 0, F.col("value")), "device_id": F.nullif("device_id", F.lit("s1003")),
    })
    quiet = make_readings(spark, [(START + timedelta(seconds=t), 5, "s9") for t in (20, 40)])
    clock = make_readings(spark, [(START + timedelta(seconds=t), None, "clock") for t in (1_700, 2_000)])
    samples = samples.unionByName(quiet).unionByName(clock)
    found = run_to_table(held_values_stream(src.watermarked(land(*slices(samples, batches))), "20 seconds"), "held", PARTITIONS)
    plain = lambda df: sorted((r.device_id or "", ms(r.at), r.value) for r in df.collect())
    wanted = plain(carry.held_values(samples, F.lit(START + timedelta(seconds=1_990)), "20 seconds"))
    assert plain(found) == wanted and ("s9", ms(START) + 1_980_000, 5.0) in wanted


def events_of(spark, minutes, room="r"):
    return spark.createDataFrame([(room, START + timedelta(minutes=m)) for m in minutes], "room string, at timestamp")


def states(df):
    return sorted((r.room, ms(r.at), r.state) for r in df.collect())


# the last event only moves the watermark on, so it is not reported itself
@pytest.mark.parametrize("split", [
    [[0, 60, 121, 400, 1000]], [[0], [60], [121], [400], [1000]], [[0, 121], [60], [400, 400], [1000]],
    [[0], [30], [20], [85], [1000]],
])
def test_stays(spark, land, split):
    frames = [events_of(spark, part) for part in split]
    stream = land(*frames).withWatermark("at", "90 minutes")
    found = run_to_table(occupancy_transitions_stream(stream), "stays", PARTITIONS)
    whole = occupancy.occupancy_transitions(events_of(spark, sum(split, [])))
    passed = ms(START) + (1000 - 90) * 60_000
    assert states(found) == [r for r in states(whole) if r[1] <= passed]


@pytest.mark.parametrize("split", [
    [[0, 60, 121, 400, 1000]], [[0], [60], [121], [400], [1000]], [[0, 121], [60], [400, 400], [1000]],
    [[0], [30], [20], [85], [1000]],
])
def test_finished_stays(spark, land, split):
    frames = [events_of(spark, part) for part in split]
    found = run_to_table(occupancy_stays_stream(land(*frames).withWatermark("at", "90 minutes")), "sessions", PARTITIONS)
    moves = states(occupancy.occupancy_transitions(events_of(spark, sum(split, []))))
    wanted = [(a[1], b[1]) for a, b in zip(moves[::2], moves[1::2]) if b[1] < ms(START) + (1000 - 90) * 60_000]
    assert sorted((ms(r.since), ms(r.until)) for r in found.collect()) == wanted
    assert sum(r.n for r in found.collect()) == sum(map(len, split)) - 1


def test_a_late_event_reopens_no_stay_and_null_rooms_are_rooms(spark, land):
    frames = [events_of(spark, [0]), events_of(spark, [300]), events_of(spark, [301], None), events_of(spark, [10]), events_of(spark, [900])]
    found = run_to_table(occupancy_stays_stream(land(*frames).withWatermark("at", "10 minutes")), "late-stays", PARTITIONS)
    assert sorted((r.room or "", (ms(r.since) - ms(START)) // 60_000, r.n) for r in found.collect()) == [("", 301, 1), ("r", 0, 1), ("r", 300, 1)]


def test_timer_needs_no_further_event_of_the_room(spark, land):
    frames = [events_of(spark, [0], "a"), events_of(spark, [30], "b"), events_of(spark, [200], "c")]
    stream = land(*frames).withWatermark("at", "10 seconds")
    found = states(run_to_table(occupancy_transitions_stream(stream), "timers", PARTITIONS))
    t0 = ms(START)
    assert found == [
        ("a", t0, "Occupied"), ("a", t0 + 3_600_000, "Unoccupied"),
        ("b", t0 + 1_800_000, "Occupied"), ("b", t0 + 5_400_000, "Unoccupied"),
    ]


def source_rows(readings):
    return readings.select("topic", F.col("ts").alias("timestamp"), F.col("value").cast("string").alias("value"),
                           F.col("src_partition").alias("partition"), F.col("src_offset").alias("offset"))


def room_readings(spark):
    """Light that jumps twice, two hours apart, CO2 that rises in between, and a quiet end."""
    light = [(START + timedelta(seconds=60 * i), 300 if i in (10, 11, 150) else 20) for i in range(260)]
    co2 = [(START + timedelta(seconds=60 * i), 500 + (i if 40 <= i < 50 else -3 * (i % 2))) for i in range(260)]
    return make_readings(spark, light, "BH1750", "illumination").unionByName(make_readings(spark, co2))


@pytest.mark.parametrize("batches", [1, 4])
def test_whole_graph(spark, land, batches):
    readings = room_readings(spark)
    table = source_rows(readings)
    parts = [source_rows(p) for p in slices(readings, batches)]
    options = plan.AnalyticsOptions(owner="s1001")
    batch = plan.analytics(table, options)
    stream = plan.analytics(land(*parts), options)
    limit = ms(readings.agg(F.max("ts")).first()[0]) - 10_000
    found = run_to_table(stream.transitions, "graph", PARTITIONS)
    # on a stream an event's time is the last microsecond of its window
    moved = found.withColumn("at", F.timestamp_micros(F.unix_micros("at") + 1))
    wanted = [r for r in states(batch.transitions) if r[1] <= limit]
    assert states(moved) == wanted and len(wanted) == 4
    records = run_to_table(stream.records.select("topic", "number"), "records", PARTITIONS)
    whole = batch.stats.where(F.unix_millis("window_end") <= limit)
    assert records.count() == 6 * whole.count()


def windows_folder(spark, stream, options, folder):
    written = run_to_table(plan.window_rows(stream, options), "windows", PARTITIONS, str(folder))
    return src.read_stream(spark, f"{folder}/rows", written.schema), written


@pytest.mark.parametrize("batches, rooms", [(1, ()), (3, ("device_id",))])
def test_sinks_follow_one_windows_table(spark, land, tmp_path, batches, rooms):
    readings = room_readings(spark)
    options = plan.AnalyticsOptions(owner="s1001", room_keys=rooms)
    batch = plan.analytics(source_rows(readings), options)
    stream = land(*[source_rows(p) for p in slices(readings, batches)])
    followed, written = windows_folder(spark, stream, options, tmp_path / "w")
    graph = plan.from_windows(followed, options)
    limit = ms(readings.agg(F.max("ts")).first()[0]) - 10_000
    assert window_rows(run_to_table(graph.stats, "s", PARTITIONS)) == window_rows(batch.stats.where(F.unix_millis("window_end") <= limit))
    assert run_to_table(graph.records.select("topic"), "r", PARTITIONS).count() == 6 * written.where("kind = 'stats'").count()
    room = rooms[0] if rooms else "room"
    plain = lambda df: sorted((r[room], ms(r.at), r.state) for r in df.collect())
    last = ms(written.agg(F.max("window_end")).first()[0])
    found = plain(run_to_table(graph.transitions, "t", PARTITIONS))
    assert found == [r for r in plain(batch.transitions) if r[1] <= last] and len(found) == 4
    # the same table, read as a table
    assert [r for r in plain(plan.from_windows(written, options).transitions) if r[1] <= last] == found


def test_occupancy_follows_windows_that_come_in_pieces(spark, land, tmp_path):
    """Windows query and followers take turns; the last batch of the windows query runs twice."""
    readings, options = room_readings(spark), plan.AnalyticsOptions(owner="s1001")
    path, windows = str(tmp_path / "landed"), tmp_path / "w"
    for i, part in enumerate(slices(readings, 3)):
        source_rows(part).coalesce(1).write.parquet(f"{path}/{i}")
        stream = src.read_stream(spark, f"{path}/*", source_rows(readings).schema, files_per_trigger=1)
        followed, written = windows_folder(spark, stream, options, windows)
        before = written.count()
        commits = windows / "checkpoint" / "commits"
        last = max((p for p in commits.iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
        last.unlink()
        (commits / f".{last.name}.crc").unlink(missing_ok=True)
        stream = src.read_stream(spark, f"{path}/*", source_rows(readings).schema, files_per_trigger=1)
        _, again = windows_folder(spark, stream, options, windows)
        assert again.count() == before
        found = run_to_table(plan.from_windows(followed, options).transitions, "t", PARTITIONS, str(tmp_path / "t"))
    batch = plan.analytics(source_rows(readings), options)
    last = ms(written.agg(F.max("window_end")).first()[0])
    assert states(found) == [r for r in states(batch.transitions) if r[1] <= last] and found.count() == 4


def test_collectors(spark, land):
    readings = random_readings(spark, 200, span_s=2_000)
    table = source_rows(readings)
    stream = land(*[source_rows(p) for p in slices(readings, 3)])
    devices = ["s1001", "s1002"]
    found = run_to_table(collectors.crossings(stream, devices), "crossings", PARTITIONS)
    wanted = collectors.crossings(table, devices)
    limit = watermark(readings.where(F.col("device_id").isin(devices)))
    assert edges(found, 10**18) == edges(wanted, limit)
    assert {r.device_id for r in wanted.collect()} == {"s1001", "s1002"}
    means = run_to_table(collectors.rolling_means(stream, devices, "SCD41/co2"), "means", PARTITIONS)
    own = readings.where(F.col("device_id").isin(devices))
    wanted = collectors.rolling_means(table, devices, "SCD41/co2").where(F.unix_millis("at") < limit)
    plain = lambda df: sorted((r.device_id, ms(r.at), round(r.mean_value, 6), r.n) for r in df.collect())
    assert own.count() and plain(means) == plain(wanted)


def test_a_surplus_part_is_no_value_for_a_collector(spark):
    rows = [("i483-sensors-s1001-BH1750-illumination", START, text, 0, i) for i, text in enumerate(["900,1", " 7 ", "x", None])]
    table = spark.createDataFrame(rows, "topic string, timestamp timestamp, value string, partition int, offset long")
    assert [r.value for r in collectors.collect(table, ["s1001"], "BH1750/illumination").collect()] == [7.0]
    assert sorted(r.value_text for r in collectors.collected_rejects(table, ["s1001"]).collect()) == ["900,1", "null", "x"]


def test_extreme_timestamps_do_not_stop_a_job(spark, land):
    from sensorstream.operators import parse

    stamps = [2**63 - 1, -(2**63), 9223372036854775, 253402300800000, 253402300799999, -62135596800000, -62135596800001, 1748660400000]
    lines = spark.createDataFrame([(f"i483-sensors-s1001-SCD41-co2,{t},1", 0, i) for i, t in enumerate(stamps)], "raw string, src_partition int, src_offset long")
    parsed = parse.parse_envelopes(lines)
    assert sorted(r.src_offset for r in parse.rejects(parsed).collect()) == [0, 1, 2, 3, 6]
    assert {r.reject_reason for r in parse.rejects(parsed).collect()} == {"bad timestamp"}
    assert stats.sliding_stats(parse.readings(parsed), method="rows").count() == 30
    stream = src.watermarked(parse.readings(parse.parse_envelopes(land(lines))))
    assert run_to_table(stats.sliding_stats(stream).drop("window"), "extremes", PARTITIONS).count() >= 10


def test_trend_stream_with_nulls_and_many_devices(spark, land):
    rows = [(START + timedelta(milliseconds=7 * i), None if i % 5 == 0 else i // 100, f"s{i % 1000}") for i in range(3000)]
    rows += [(START + timedelta(seconds=60 * i), i, "s1") for i in range(1, 60)]
    readings = make_readings(spark, rows)
    found = run_to_table(trend.trend_windows_stream(src.watermarked(land(*slices(readings, 2)))).drop("window"), "nulls", PARTITIONS)
    wanted = closed(trend.trend_windows(readings), readings)
    plain = lambda df: sorted((r.sensor, ms(r.window_start), r.n) for r in df.collect())
    assert plain(found) == plain(wanted) and plain(found)


def test_lines_hold_every_row(spark, land, tmp_path):
    frame = spark.range(500).selectExpr("id", "concat('r', id) as name")
    sinks.to_lines(land(frame), str(tmp_path / "lines"), str(tmp_path / "cp"), None).start().awaitTermination()
    assert spark.read.text(str(tmp_path / "lines")).count() == 500


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from sensorstream.streaming import run

    class Conf:
        def get(self, name, default=None):
            return {"spark.sql.warehouse.dir": "file:/tmp/warehouse"}.get(name, default)

    class Cluster:
        conf = Conf()

        class sparkContext:
            master = "spark://host:7077"

            @staticmethod
            def getConf():
                return Conf()

    with pytest.raises(ValueError):
        run.shared_folder(Cluster())


def test_bridge_tables_hold_every_batch_once(spark, land, tmp_path):
    frames = [spark.createDataFrame([(f"a/{i}", str(i)), ("a/ä", "x")], "topic string, payload string") for i in range(3)]
    options = bridge.BridgeOptions.from_properties({
        "mqtt.server": "m", "mqtt.topics.subscribe": "a/#", "bootstrap.servers": "k"})
    forward, dead = str(tmp_path / "forward"), str(tmp_path / "dead")
    with stream_settings(spark, PARTITIONS):
        bridge.bridge_to_tables(land(*frames), options, forward, dead, str(tmp_path / "cp")).start().awaitTermination()
    assert sorted(r.topic for r in spark.read.parquet(forward).collect()) == ["a-0", "a-1", "a-2"]
    assert spark.read.parquet(dead).count() == 3
    # the same batch again, as after a failure
    frames[0].limit(1).write.mode("overwrite").parquet(sinks.batch_folder(forward, 0))
    assert spark.read.parquet(forward).count() == 3


def test_kafka_writers_only_take_options(spark, land):
    writer = sinks.to_kafka(land(events_of(spark, [0])).selectExpr("room as topic", "room as value"), "/cp", "k:9092", period="30 seconds")
    assert hasattr(writer, "start")
    assert hasattr(sinks.preview_on_console(land(events_of(spark, [0])), "/cp"), "start")


def test_scratch_goes_to_the_shared_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_settings_are_put_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with stream_settings(spark, 3):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    src.idle_source_settings(spark)
    assert spark.conf.get("spark.sql.streaming.multipleWatermarkPolicy") == "max"
    spark.conf.unset("spark.sql.streaming.multipleWatermarkPolicy")


def test_metric_filter_works_on_streams(spark, land):
    assert only_metric(land(random_readings(spark, 5)), "CO2").isStreaming
    assert at("2025-05-31 00:00:00").year == 2025

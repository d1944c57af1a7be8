import random

import pytest
from readings import at
from pyspark.sql import functions as F

from sensorstream.functions import bits, text, timing, topics


def test_two_decimals_follow_the_exact_binary_value(spark):
    rnd = random.Random(1)
    numbers = [52.915, 0.125, 0.135, 0.005, 0.015, -0.005, -0.0, 0.0, 1e-300, 0.995, 1.005, 2.5, 99.995,
               4503599627370497.5, 1e15 + 0.5, 9007199254740993.0, 1e17, float("inf"), float("-inf"),
               2.0**62, -(2.0**62), 2.0**63, 1e23, -1e23, 2.0**126, 1e38, 1e100, 1.7976931348623157e308]
    for _ in range(4000):
        numbers += [rnd.uniform(-1, 1), rnd.uniform(-1e3, 1e3), rnd.randint(-10**6, 10**6) / 8192,
                    (2 * rnd.randint(0, 10**5) + 1) / 200, rnd.uniform(-1e15, 1e15)]
    numbers += [rnd.choice([-1, 1]) * 10 ** rnd.uniform(18, 308) for _ in range(300)]
    wanted = {n: f"{n:.2f}".replace("inf", "Infinity") for n in numbers}
    df = text.with_fixed2(spark.createDataFrame([(n,) for n in numbers], "x double"), {"t": F.col("x")})
    assert [(r.x, r.t) for r in df.collect() if wanted[r.x] != r.t and r.x != 0] == []
    # the plain formatter rounds the shortest text instead
    assert spark.range(1).select(F.format_string("%.2f", F.lit(52.915))).first()[0] == "52.92"


def test_only_finite_plain_decimals_are_numbers(spark):
    cases = {"1": 1.0, " 2 ": 2.0, "1.": 1.0, "-.5e3": -500.0, "+7": 7.0, "1\n": 1.0, "281": 281.0, "nan": None,
             "NaN": None, "inf": None, "Infinity": None, "1.0f": None, "1d": None, "0x1p3": None, "1e999": None,
             "": None, "a": None, "1 2": None, ".": None, "null": None}
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    assert {r.s: r.v for r in df.select("s", text.parse_decimal(F.col("s")).alias("v")).collect()} == cases


def test_integers_take_no_blanks(spark):
    cases = {"1748664532945": 1748664532945, "-5": -5, "+5": 5, " 5": None, "5 ": None, "5\n": None, "1.0": None,
             "9223372036854775808": None, "": None}
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    assert {r.s: r.v for r in df.select("s", text.parse_integer(F.col("s")).alias("v")).collect()} == cases


def test_durations():
    assert timing.duration_us("5 minutes") == 300_000_000
    assert timing.duration_us("1 hour 30 seconds") == 3_630_000_000
    for wrong in ("", "5", "five minutes", "5 fortnights", "0 seconds"):
        with pytest.raises(ValueError):
            timing.duration_us(wrong)


def test_floor_division_before_the_epoch(spark):
    df = spark.createDataFrame([(-11,), (-10,), (-1,), (0,), (9,), (10,)], "v bigint")
    assert [r[0] for r in df.select(timing.floor_div(F.col("v"), 10)).collect()] == [-2, -1, -1, 0, 0, 1]


def test_local_time(spark):
    df = spark.createDataFrame([(at("2025-05-31 20:30:05"),)], "ts timestamp")
    assert df.select(timing.local_time_text(F.col("ts"))).first()[0] == "2025-06-01 05:30:05"


def test_checksum_and_signs(spark):
    row = spark.range(1).select(
        bits.crc8(F.lit(0xBE), F.lit(0xEF)).alias("crc"),
        bits.signed(F.lit(0x800), 12).alias("s12"), bits.signed(F.lit(0x80000), 20).alias("s20"),
        bits.signed(F.lit(0x8000), 16).alias("s16"), bits.signed(F.lit(0x7FF), 12).alias("p12"),
        bits.signed(F.lit(0xFFFFFF), 24).alias("s24"),
        bits.word_big_endian(F.lit(1), F.lit(2)).alias("be"), bits.word_little_endian(F.lit(1), F.lit(2)).alias("le"),
        bits.word_big_endian(F.lit(1), F.lit(2), F.lit(3)).alias("be24"),
    ).first()
    assert row.crc == 0x92
    assert (row.s12, row.s20, row.s16, row.p12, row.s24) == (-2048, -524288, -32768, 2047, -1)
    assert (row.be, row.le, row.be24) == (0x102, 0x201, 0x10203)


def test_checksum_of_every_first_byte(spark):
    def slow(octets):
        crc = 0xFF
        for octet in octets:
            crc ^= octet
            for _ in range(8):
                crc = ((crc << 1) ^ 0x31) & 0xFF if crc & 0x80 else (crc << 1) & 0xFF
        return crc

    df = spark.range(256).select(F.col("id").cast("int").alias("b"), ((F.col("id") * 7 + 3) % 256).cast("int").alias("c"))
    for r in df.withColumn("crc", bits.crc8(F.col("b"), F.col("c"))).collect():
        assert r.crc == slow([r.b, r.c])


@pytest.mark.parametrize("name, good", [
    ("i483-sensors-s1001-BH1750-illumination", True),
    ("i483-sensors-s1001-RPR0521RS-ambient_light", True),
    ("i483-sensors-s1001-BH1750_avg-illumination", False),
    ("i483-sensors-s1001-analytics-BH1750_min-illumination", False),
    ("i483-sensors-s1001-BH1750-illumination\n", False),
    ("x483-sensors-s1001-BH1750-illumination", False),
    ("i483-sensors-1001-BH1750-illumination", False),
])
def test_topic_pattern_matches_whole_names(spark, name, good):
    df = spark.createDataFrame([(name,)], "topic string")
    assert df.select(topics.topic_matches(F.col("topic"))).first()[0] is good


@pytest.mark.parametrize("filters, name, good", [
    ("a/#", "a", True), ("a/#", "a/b/c", True), ("a/#", "ab", False), ("#", "x/y", True),
    ("a/+/c", "a/b/c", True), ("a/+/c", "a/b/b/c", False), ("+", "a", True), ("+", "a/b", False),
    ("x  a/b\t\nc", "c", True), ("x a/b", "a.b", False), ("a.b", "axb", False),
])
def test_mqtt_filters(spark, filters, name, good):
    df = spark.createDataFrame([(name,)], "topic string")
    assert df.select(topics.mqtt_matches(F.col("topic"), filters)).first()[0] is good


@pytest.mark.parametrize("wrong", ["", "a/#/b", "a+/b", "a/b#"])
def test_wrong_mqtt_filters(wrong):
    with pytest.raises(ValueError):
        topics.mqtt_filter_pattern(wrong)


def test_topic_rewriting(spark):
    df = spark.createDataFrame([("i483/sensors/s1001/BH1750/illumination",)], "topic string")
    row = df.select(
        topics.to_kafka_topic(F.col("topic")).alias("k"), topics.to_kafka_topic(F.col("topic"), "_").alias("u"),
        topics.strip_prefix(F.col("topic"), "i483/sensors/s1001/").alias("s"),
        topics.strip_prefix(F.col("topic"), "other/").alias("o"),
    ).first()
    assert row.k == "i483-sensors-s1001-BH1750-illumination"
    assert row.u == "i483_sensors_s1001_BH1750_illumination"
    assert (row.s, row.o) == ("BH1750/illumination", "i483/sensors/s1001/BH1750/illumination")
    assert len(topics.device_topics("s1001")) == 11

import math

import pytest
from pyspark.sql import functions as F

from sensorstream.operators import calibrate as C


def one(spark, **columns):
    return spark.range(1).select(*[(c if not isinstance(c, (int, float)) else F.lit(c)).alias(n) for n, c in columns.items()])


@pytest.mark.parametrize("raw, accuracy, lux", [
    (359, 1.0, 299.17), (145, 1.0, 120.83), (359, 0.96, 311.63), (0, 1.44, 0.0),
    (-1, 1.0, None), (359, 0.95, None), (359, 1.45, None),
])
def test_bh1750(spark, raw, accuracy, lux):
    found = C.calibrate_bh1750(one(spark, raw=raw, accuracy=accuracy)).collect()
    assert len(found) == 1
    assert (None if found[0].illumination is None else round(found[0].illumination, 2)) == lux
    assert (found[0].reject_reason is None) == (lux is not None)


# gain 1, 100 ms; recorded on a device
@pytest.mark.parametrize("d0, d1, lux", [
    (145, 67, 118.13), (73, 39, 49.58), (335, 107, 362.63), (13, 7, 8.73), (0, 5, 0.0), (10, 31, 0.0),
])
def test_rpr_recorded(spark, d0, d1, lux):
    row = C.calibrate_rpr(one(spark, ps=51, data0=d0, data1=d1, als_ps_reg=0b00000010, mode_reg=0b11000110)).first()
    assert round(row.ambient_light, 2) == lux
    assert (row.illumination, row.infrared_illumination) == (float(d0), float(d1))
    assert (row.proximity, row.near) == (51, 0)


def test_rpr_registers(spark):
    row = C.rpr_settings(one(spark, als_ps_reg=(3 << 4) | (2 << 2), mode_reg=0xC0 | 12)).first()
    assert (row.gain0, row.gain1, row.measure_ms) == (128, 64, 50)
    assert [
        C.rpr_settings(one(spark, als_ps_reg=0, mode_reg=m)).first().measure_ms for m in (0, 4, 5, 9, 10, 11, 12, 13, 15)
    ] == [0, 0, 100, 100, 400, 400, 50, 0, 0]


def test_rpr_saturates_at_50_ms_only(spark):
    short = C.calibrate_rpr(one(spark, ps=1000, data0=0x8001, data1=0x7FFF, als_ps_reg=0, mode_reg=12)).first()
    assert (short.illumination, short.infrared_illumination, short.near) == (0x7FFF * 2.0, 0x7FFF * 2.0, 1)
    normal = C.calibrate_rpr(one(spark, ps=999, data0=0x8001, data1=0, als_ps_reg=0, mode_reg=6)).first()
    assert (normal.illumination, normal.near) == (float(0x8001), 0)


def test_rpr_not_measuring(spark):
    row = C.calibrate_rpr(one(spark, ps=0, data0=10, data1=10, als_ps_reg=0, mode_reg=0)).first()
    assert (row.ambient_light, row.illumination) == (-1.0, None)


def pack(c0, c1, c00, c10, *rest):
    text = f"{c0 & 0xFFF:03x}{c1 & 0xFFF:03x}{c00 & 0xFFFFF:05x}{c10 & 0xFFFFF:05x}" + "".join(
        f"{c & 0xFFFF:04x}" for c in rest)
    return list(bytes.fromhex(text))


@pytest.mark.parametrize("values", [
    (-2048, -2048, -524288, -524288, -32768, -32768, -32768, -32768, -32768),
    (2047, 2047, 524287, 524287, 32767, 32767, 32767, 32767, 32767),
    (204, -261, 83512, -54286, -2805, 1187, -8864, 51, -1343),
    (0, -1, 1, -1, 0, -1, 1, -1, 1),
])
def test_dps310_coefficients(spark, values):
    df = spark.createDataFrame([("s1", pack(*values))], "device_id string, coeff array<int>")
    row = C.dps310_coefficients(df).first()
    assert (row.c0, row.c1, row.c00, row.c10, row.c01, row.c11, row.c20, row.c21, row.c30) == values


def test_dps310(spark):
    values = (204, -261, 83512, -54286, -2805, 1187, -8864, 51, -1343)
    c0, c1, c00, c10, c01, c11, c20, c21, c30 = values
    tables = spark.createDataFrame([("s1", pack(*values))], "device_id string, coeff array<int>")
    raw = spark.createDataFrame(
        [("s1", -400_000 & 0xFFFFFF, 300_000, 64, 64, 1013.25), ("s9", 1, 1, 1, 1, 1013.25)],
        "device_id string, p_raw bigint, t_raw bigint, p_os int, t_os int, sea_level double")
    row = C.calibrate_dps310(raw, C.dps310_coefficients(tables)).first()
    p, t = -400_000 / 1040384.0, 300_000 / 1040384.0
    assert row.temperature == pytest.approx(c0 * 0.5 + c1 * t)
    hpa = (c00 + p * (c10 + p * (c20 + p * c30)) + t * c01 + t * p * (c11 + p * c21)) / 100
    assert row.air_pressure == pytest.approx(hpa)
    assert row.altitude == pytest.approx(44330 * (1 - (hpa / 1013.25) ** 0.190284))


def test_altitude_and_its_inverse(spark):
    df = spark.createDataFrame(
        [(986.82, 1013.25), (999.35, 1013.25), (0.0, 1013.25), (-1.0, 1013.25), (1000.0, 0.0)], "p double, p0 double")
    found = [r[0] for r in df.select(C.altitude(F.col("p"), F.col("p0"))).collect()]
    assert found[0] == pytest.approx(222.4, abs=0.1) and found[1] == pytest.approx(116.4, abs=0.1)
    assert all(math.isnan(x) for x in found[2:])
    back = spark.createDataFrame([(986.82, found[0]), (986.82, 44330.0), (986.82, 50000.0), (0.0, 10.0)], "p double, h double")
    levels = [r[0] for r in back.select(C.sea_level_pressure(F.col("p"), F.col("h"))).collect()]
    assert levels[0] == pytest.approx(1013.25, abs=1e-3)
    assert levels[1:] == [None, None, None]


def frame(*words, fault=None):
    def crc(octets):
        value = 0xFF
        for octet in octets:
            value ^= octet
            for _ in range(8):
                value = ((value << 1) ^ 0x31) & 0xFF if value & 0x80 else (value << 1) & 0xFF
        return value

    out = []
    for i, word in enumerate(words):
        octets = [word >> 8, word & 255]
        out += [*octets, crc(octets) ^ (i == fault)]
    return tuple(out)


def test_scd41(spark):
    rows = [(*frame(500, 0, 32768), 1), (*frame(500, 26214, 65535, fault=1), 1), (*frame(500, 1, 1), 0x0800)]
    df = spark.createDataFrame(rows, ", ".join(f"b{i} int" for i in range(9)) + ", status int")
    first, bad, early = C.calibrate_scd41(df, ready_word="status").collect()
    assert (first.frame_ok, first.co2, first.temperature, first.humidity) == (True, 500, -45.0, 50.0)
    assert (bad.frame_ok, bad.co2, bad.temperature, bad.humidity) == (False, None, None, None)
    assert (early.frame_ok, early.co2) == (True, None)
    other = C.calibrate_scd41(spark.createDataFrame([frame(1, 65535, 65535)], [f"b{i}" for i in range(9)]), 65535.0).first()
    assert (other.temperature, other.humidity) == (130.0, 100.0)


def test_one_bad_device_does_not_need_python(spark):
    plan = C.calibrate_scd41(spark.createDataFrame([frame(1, 2, 3)], [f"b{i}" for i in range(9)]))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Exchange" not in text


def test_every_sample_comes_out_once_with_a_reason(spark):
    names = ["c0", "c1", "c00", "c10", "c01", "c11", "c20", "c21", "c30"]
    row = lambda device, c30: (device, 200, -260, 80000, -50000, -2500, 1200, -9000, 10, c30)
    known = spark.createDataFrame([row("one", 5), row("one", 5), row("two", 5), row("two", 6), row("gap", None)], "device_id string, " + ", ".join(f"{n} int" for n in names))
    raw = spark.createDataFrame(
        [(1, "one", 1, 1, 1, 1, 1013.0), (2, "two", 1, 1, 1, 1, 1013.0), (3, "gap", 1, 1, 1, 1, 1013.0), (4, None, 1, 1, 1, 1, 1013.0), (5, "one", None, 1, 1, 1, 1013.0),
         (6, "one", 1, 1, 3, 1, 1013.0), (7, "one", 1, 1, 1, 1, None)],
        "id int, device_id string, p_raw int, t_raw int, p_os int, t_os int, sea_level double")
    got = {r.id: r for r in C.calibrate_dps310(raw, known).collect()}
    assert {i: r.reject_reason for i, r in got.items()} == {
        1: None, 2: C.SEVERAL_COEFFICIENTS, 3: C.NO_COEFFICIENTS, 4: C.NO_COEFFICIENTS, 5: C.FAILED_READ, 6: C.BAD_OVERSAMPLING, 7: C.NO_SETTINGS}
    assert got[1].altitude is not None and got[2].temperature is None and got[5].temperature is not None and got[5].air_pressure is None


def test_optical_counts_that_are_missing(spark):
    raw = spark.createDataFrame([(1, 1200, 5, 5, 0, 6), (2, None, 5, 5, 0, 6), (3, 10, None, 5, 0, 6), (4, 10, 5, 5, None, 6), (5, 10, 5, 5, 0, 0)],
                                "id int, ps int, data0 int, data1 int, als_ps_reg int, mode_reg int")
    got = {r.id: (r.near, r.ambient_light is None, r.reject_reason) for r in C.calibrate_rpr(raw).collect()}
    assert got == {1: (1, False, None), 2: (None, False, C.FAILED_READ), 3: (0, True, C.FAILED_READ), 4: (0, True, C.NO_SETTINGS), 5: (0, False, C.NOT_MEASURING)}

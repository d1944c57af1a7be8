"""Raw sensor counts to physical units.

Column expressions over tables of raw counts. Per-device settings and coefficients are
ordinary joined tables; the join strategy is left to Spark, which knows their size. No
Python runs per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorstream import fixed
from sensorstream.functions.bits import bits, crc8, signed, word_big_endian
from sensorstream.sinks.records import dead_letters

NAN = float("nan")

FAILED_READ = "failed read"
NO_SETTINGS = "no settings"
BAD_ACCURACY = "accuracy out of range"
NO_COEFFICIENTS = "no coefficients"
SEVERAL_COEFFICIENTS = "several coefficients"
BAD_OVERSAMPLING = "unknown oversampling"
NOT_MEASURING = "not measuring"
BAD_FRAME = "bad checksum"


# --- BH1750 ---------------------------------------------------------------------
def bh1750_lux(raw: Column, accuracy: Column | float = 1.0) -> Column:
    """Null for a failed read (negative count) or an accuracy outside the data sheet's range."""
    accuracy = F.lit(accuracy) if isinstance(accuracy, (int, float)) else accuracy
    lowest, highest = fixed.BH1750_ACCURACY_RANGE
    lux = raw / F.lit(fixed.BH1750_COUNTS_PER_LUX) / accuracy
    return F.when((raw >= 0) & accuracy.between(lowest, highest), lux)


def calibrate_bh1750(raw: DataFrame) -> DataFrame:
    """Adds illumination from raw and accuracy, and reject_reason where there is none: a failed
    read, a device without settings, or an accuracy outside the data sheet's range. Every row stays."""
    lowest, highest = fixed.BH1750_ACCURACY_RANGE
    reason = (
        F.when(F.col("raw").isNull() | (F.col("raw") < 0), FAILED_READ)
        .when(F.col("accuracy").isNull(), NO_SETTINGS)
        .when(~F.col("accuracy").between(lowest, highest), BAD_ACCURACY)
    )
    return raw.withColumns({
        "illumination": bh1750_lux(F.col("raw"), F.col("accuracy")), "reject_reason": reason,
    })


# --- RPR-0521RS -----------------------------------------------------------------
def _pick(table: Sequence, index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in table]), index.cast("int"))


def rpr_settings(df: DataFrame, als_ps_reg: str = "als_ps_reg", mode_reg: str = "mode_reg") -> DataFrame:
    """Adds gain0, gain1 and measure_ms from the two control registers."""
    als, mode = F.col(als_ps_reg), F.col(mode_reg)
    return df.withColumns({
        "gain0": _pick(fixed.RPR_GAINS, bits(als, 4, 2)),
        "gain1": _pick(fixed.RPR_GAINS, bits(als, 2, 2)),
        "measure_ms": _pick(fixed.RPR_MEASURE_MS, bits(mode, 0, 4)),
    })


def _rpr_adjusted(raw: Column, gain: Column, measure_ms: Column) -> Column:
    """Counts as if taken with gain 1 in 100 ms; null where the sensor does not measure."""
    saturated = (measure_ms == fixed.RPR_SATURATING_MS) & (bits(raw, 15, 1) == 1)
    count = F.when(saturated, F.lit(0x7FFF)).otherwise(raw).cast("double")
    return F.when((measure_ms != 0) & (gain != 0), F.try_divide(count * F.try_divide(F.lit(100.0), measure_ms), gain))


def rpr_lux(d0: Column, d1: Column) -> Column:
    """Lux from the two adjusted channels: 0 in the dark or beyond the last segment."""
    ratio = F.try_divide(d1, d0)
    lux = F.when(d0 == 0, F.lit(0.0))
    for bound, w0, w1 in fixed.RPR_LUX_SEGMENTS:
        lux = lux.when(ratio < bound, F.lit(w0) * d0 - F.lit(w1) * d1)
    return lux.otherwise(F.lit(0.0))


def proximity_state(ps: Column, near: int = fixed.RPR_NEAR_COUNT) -> Column:
    """1 near, 0 far, null without a count."""
    return F.when(ps >= near, F.lit(1)).when(ps < near, F.lit(0))


def calibrate_rpr(raw: DataFrame) -> DataFrame:
    """Adds illumination, infrared_illumination, ambient_light, proximity and near.

    Takes ps, data0, data1, als_ps_reg, mode_reg. Ambient light is -1 where the sensor is set
    not to measure, and null without counts or registers. `reject_reason` says why values are missing.
    """
    timed = rpr_settings(raw)
    adjusted = timed.withColumns({
        "illumination": _rpr_adjusted(F.col("data0"), F.col("gain0"), F.col("measure_ms")),
        "infrared_illumination": _rpr_adjusted(F.col("data1"), F.col("gain1"), F.col("measure_ms")),
    })
    measured = F.col("illumination").isNotNull() & F.col("infrared_illumination").isNotNull()
    unread = F.col("data0").isNull() | F.col("data1").isNull()
    unset = F.col("measure_ms").isNull() | F.col("gain0").isNull() | F.col("gain1").isNull()
    reason = (
        F.when(unread | F.col("ps").isNull(), FAILED_READ)
        .when(unset, NO_SETTINGS)
        .when(~measured, NOT_MEASURING)
    )
    return adjusted.withColumns({
        "ambient_light": F.when(
            measured, rpr_lux(F.col("illumination"), F.col("infrared_illumination"))
        ).when(~unread & ~unset, F.lit(-1.0)),
        "proximity": F.col("ps"),
        "near": proximity_state(F.col("ps")),
        "reject_reason": reason,
    })


# --- DPS310 ---------------------------------------------------------------------
def dps310_coefficients(tables: DataFrame, coeff: str = "coeff") -> DataFrame:
    """The nine signed coefficients packed into 18 bytes.

    The bytes are one bit string: two fields of 12 bits, two of 20, five of 16.
    """
    layout = (("c0", 12), ("c1", 12), ("c00", 20), ("c10", 20),
              ("c01", 16), ("c11", 16), ("c20", 16), ("c21", 16), ("c30", 16))
    fields, at = {}, 0
    for name, width in layout:
        first, last = at // 8, (at + width - 1) // 8
        word = word_big_endian(*[F.get(F.col(coeff), F.lit(i)) for i in range(first, last + 1)])
        fields[name] = signed(bits(word, (last + 1) * 8 - (at + width), width), width)
        at += width
    return tables.withColumns(fields)


def dps310_scale(oversampling: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in fixed.DPS310_SCALE.items() for x in pair])
    return F.try_element_at(table, oversampling.cast("int"))


def dps310_temperature(t_scaled: Column) -> Column:
    return F.col("c0") * F.lit(0.5) + F.col("c1") * t_scaled


def dps310_pressure(p_scaled: Column, t_scaled: Column) -> Column:
    """hPa, from the nine coefficient columns."""
    by_pressure = F.col("c00") + p_scaled * (F.col("c10") + p_scaled * (F.col("c20") + p_scaled * F.col("c30")))
    by_both = t_scaled * p_scaled * (F.col("c11") + p_scaled * F.col("c21"))
    return (by_pressure + t_scaled * F.col("c01") + by_both) / F.lit(100.0)


def altitude(pressure: Column, sea_level: Column | float = fixed.SEA_LEVEL_HPA) -> Column:
    """Metres; NaN where either pressure is not positive."""
    sea_level = F.lit(float(sea_level)) if isinstance(sea_level, (int, float)) else sea_level
    valid = (pressure > 0) & (sea_level > 0)
    ratio = F.try_divide(pressure, sea_level)
    height = F.lit(fixed.BAROMETRIC_METRES) * (F.lit(1.0) - F.pow(ratio, F.lit(fixed.BAROMETRIC_EXPONENT)))
    return F.when(valid, height).when(pressure.isNotNull() & sea_level.isNotNull(), F.lit(NAN))


def sea_level_pressure(pressure: Column, height: Column) -> Column:
    """The reference pressure that puts `pressure` at `height`; null where there is none."""
    base = F.lit(1.0) - height / F.lit(fixed.BAROMETRIC_METRES)
    return F.when(
        (pressure > 0) & (base > 0),
        F.try_divide(pressure, F.pow(base, F.lit(fixed.BAROMETRIC_INVERSE_EXPONENT))),
    )


def calibrate_dps310(raw: DataFrame, coefficients: DataFrame, device: str = "device_id") -> DataFrame:
    """Adds temperature, air_pressure and altitude.

    `raw` has p_raw, t_raw (unsigned 24-bit), p_os, t_os and sea_level; `coefficients` has
    c0..c30 per device; rows that say the same are one. Every sample stays, once, with a reject_reason where a value is
    missing: no or incomplete coefficients, several different ones, no count, an unknown oversampling
    rate, no pressure at sea level.
    """
    names = ("c0", "c1", "c00", "c10", "c01", "c11", "c20", "c21", "c30")
    row = F.struct(*names)
    known = coefficients.groupBy(device).agg(F.min(row).alias("_row"), (F.min(row) != F.max(row)).alias("_several"))
    joined = raw.join(known, device, "left")
    usable = F.when(~F.col("_several"), F.col("_row"))
    joined = joined.withColumns({name: usable[name] for name in names})
    scales = {name: dps310_scale(F.col(name)) for name in ("t_os", "p_os")}
    reason = (
        F.when(F.col("_several"), SEVERAL_COEFFICIENTS)
        .when(F.greatest(*[F.col(name).isNull() for name in names]), NO_COEFFICIENTS)
        .when(F.col("t_raw").isNull() | F.col("p_raw").isNull(), FAILED_READ)
        .when(scales["t_os"].isNull() | scales["p_os"].isNull(), BAD_OVERSAMPLING)
        .when(F.col("sea_level").isNull(), NO_SETTINGS)
    )
    joined = joined.withColumn("reject_reason", reason)
    scaled = joined.withColumns({
        "_t": F.try_divide(signed(F.col("t_raw"), 24), dps310_scale(F.col("t_os"))),
        "_p": F.try_divide(signed(F.col("p_raw"), 24), dps310_scale(F.col("p_os"))),
    })
    measured = scaled.withColumns({
        "temperature": dps310_temperature(F.col("_t")),
        "air_pressure": dps310_pressure(F.col("_p"), F.col("_t")),
    })
    return measured.withColumn("altitude", altitude(F.col("air_pressure"), F.col("sea_level"))).drop(
        "_t", "_p", "_row", "_several", *names
    )


# --- SCD41 ----------------------------------------------------------------------
def scd41_frame_ok(octets: Sequence[str]) -> Column:
    """Every word of the frame agrees with the checksum byte after it; a frame with a missing byte does not."""
    checks = [
        crc8(F.col(octets[i]), F.col(octets[i + 1])) == F.col(octets[i + 2]) for i in range(0, len(octets), 3)
    ]
    ok = checks[0]
    for check in checks[1:]:
        ok = ok & check
    return F.coalesce(ok, F.lit(False))


def scd41_data_ready(word: Column, mask: int = fixed.SCD41_READY_MASK) -> Column:
    return word.bitwiseAND(F.lit(mask)) != 0


def scd41_values(w0: Column, w1: Column, w2: Column, divisor: float = fixed.SCD41_DIVISOR) -> dict[str, Column]:
    return {
        "co2": w0,
        "temperature": F.lit(175.0) * w1 / F.lit(divisor) - F.lit(45.0),
        "humidity": F.lit(100.0) * w2 / F.lit(divisor),
    }


def calibrate_scd41(
    frames: DataFrame, divisor: float = fixed.SCD41_DIVISOR, ready_word: str | None = None
) -> DataFrame:
    """Adds co2, temperature, humidity and frame_ok from bytes b0..b8.

    A frame with any bad word has no values and a reject_reason; where `ready_word` names a
    column, a frame that was read before data was ready has no values either, but is no reject.
    """
    octets = [f"b{i}" for i in range(9)]
    words = [word_big_endian(F.col(octets[i]), F.col(octets[i + 1])) for i in (0, 3, 6)]
    usable = F.col("frame_ok")
    if ready_word:
        usable = usable & scd41_data_ready(F.col(ready_word))
    return frames.withColumn("frame_ok", scd41_frame_ok(octets)).withColumns(
        {name: F.when(usable, value) for name, value in scd41_values(*words, divisor=divisor).items()}
        | {"reject_reason": F.when(~F.col("frame_ok"), BAD_FRAME)}
    )


def frame_letters(calibrated: DataFrame, topic: Column, at: Column, octets: Sequence[str], keep=()) -> DataFrame:
    """Rejected frames as dead letters whose payload is the frame in hex, missing bytes as `??`."""
    payload = F.concat(*[F.coalesce(F.lpad(F.hex(F.col(b).cast("bigint")), 2, "0"), F.lit("??")) for b in octets])
    bad = calibrated.where(F.col("reject_reason").isNotNull())
    return dead_letters(bad, F.col("reject_reason"), topic, payload, at, keep=keep)

"""Raw counts of every line item to physical units."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import inputs as I
from catalogue.registry import query
from sensorstream.functions.bits import word_big_endian, word_little_endian
from sensorstream.operators import calibrate as C
from sensorstream.operators.carry import carry_forward
from sensorstream.operators.settings import settings_in_force


def _bh1750(spark, sf_dir):
    raw = I.bh1750_raw(spark, sf_dir)
    word = word_big_endian(F.col("hi"), F.col("lo"))
    return raw.withColumn("raw", F.when(F.col("failed"), F.lit(-1)).otherwise(word))


@query(f"""with {I.SQL_BH1750}, judged as (
  select *, case when raw < 0 then 'failed read' when accuracy is null then 'no settings'
    when not accuracy between cast(0.96 as double) and cast(1.44 as double) then 'accuracy out of range' end as reject_reason
  from bh)
select sample_id, device_id, raw, reject_reason,
  case when reject_reason is null then raw / cast(1.2 as double) / accuracy end as illumination from judged""")
def calibrate_bh1750(spark, sf_dir):
    out = C.calibrate_bh1750(_bh1750(spark, sf_dir))
    return out.select("sample_id", "device_id", "raw", "illumination", "reject_reason")


def _rpr(spark, sf_dir):
    raw = I.rpr_raw(spark, sf_dir)
    return raw.withColumns({
        "data0": word_little_endian(F.col("d0_lo"), F.col("d0_hi")),
        "data1": word_little_endian(F.col("d1_lo"), F.col("d1_hi")),
    })


@query(f"with {I.SQL_RPR} select sample_id, gain0, gain1, ms as measure_ms from rpr_set")
def rpr_register_settings(spark, sf_dir):
    return C.rpr_settings(_rpr(spark, sf_dir)).select("sample_id", "gain0", "gain1", "measure_ms")


# fixed values in the SQL: the data sheet's lux segments
@query(f"""with {I.SQL_RPR}
select sample_id, d0 as illumination, d1 as infrared_illumination,
  case when data0 is null or ps is null then 'failed read' when ms = 0 then 'not measuring' end as reject_reason,
  cast(case when data0 is null then null when ms = 0 then -1 when d0 = 0 then 0
    when d1 / d0 < 0.595::double then 1.682::double * d0 - 1.877::double * d1
    when d1 / d0 < 1.015::double then 0.644::double * d0 - 0.132::double * d1
    when d1 / d0 < 1.352::double then 0.756::double * d0 - 0.243::double * d1
    when d1 / d0 < 3.053::double then 0.766::double * d0 - 0.25::double * d1
    else 0 end as double) as ambient_light
from rpr_adj""")
def calibrate_rpr(spark, sf_dir):
    out = C.calibrate_rpr(_rpr(spark, sf_dir))
    return out.select("sample_id", "illumination", "infrared_illumination", "ambient_light", "reject_reason")


@query(f"with {I.SQL_RPR} select sample_id, ps as proximity, case when ps >= 1000 then 1 when ps < 1000 then 0 end as near from rpr")
def proximity_state(spark, sf_dir):
    return C.calibrate_rpr(_rpr(spark, sf_dir)).select("sample_id", F.col("proximity").cast("bigint").alias("proximity"), "near")


@query(f"with {I.SQL_DPS310_COEFF} select device_id, c0, c1, c00, c10, c01, c11, c20, c21, c30 from coeff")
def dps310_coefficients(spark, sf_dir):
    return C.dps310_coefficients(I.dps310_tables(spark, sf_dir)).drop("coeff")


@query(f"""with {I.SQL_DPS310}
select sample_id, temperature, air_pressure,
  case when air_pressure > 0 then
    round(cast(44330 as double) * (1 - pow(air_pressure / sea_level, cast(0.190284 as double))), 4) end as altitude,
  coalesce(air_pressure <= 0, false) as no_altitude, reject_reason
from dps_out""")
def calibrate_dps310(spark, sf_dir):
    raw = I.dps310_raw(spark, sf_dir).withColumns({
        "p_raw": word_big_endian(F.col("p2"), F.col("p1"), F.col("p0")),
        "t_raw": word_big_endian(F.col("t2"), F.col("t1"), F.col("t0")),
    })
    coefficients = C.dps310_coefficients(I.dps310_tables(spark, sf_dir))
    some = coefficients.where("cast(substr(device_id, 2) as bigint) % 29 <> 0")
    # some devices have the same row twice, some a second one that differs
    number = F.expr("cast(substr(device_id, 2) as bigint)")
    some = some.unionByName(some.where(number % 7 == 0)).unionByName(some.where(number % 31 == 0).withColumn("c30", F.col("c30") + 1))
    out = C.calibrate_dps310(raw, some)
    return out.select("sample_id", "temperature", "air_pressure", *_altitude_out(), "reject_reason")


def _altitude_out():
    unknown = F.coalesce(F.isnan("altitude"), F.lit(False))
    return F.when(~unknown, F.round("altitude", 4)).alias("altitude"), unknown.alias("no_altitude")


_PRESSURE = "(l_extendedprice / cast(50 as double) - cast(100 as double))"
_SEA_LEVEL = "cast(l_partkey % 40 * 30 as double)"
_HEIGHT = "cast(case when l_partkey % 20 = 19 then 50000 else (l_partkey % 100) * 400 end as double)"


@query(f"""with p as (
  select l_orderkey * 8 + l_linenumber as sample_id, {_PRESSURE} as p, {_SEA_LEVEL} as p0 from lineitem)
select sample_id, case when p > 0 and p0 > 0 then
    round(cast(44330 as double) * (1 - pow(p / p0, cast(0.190284 as double))), 4) end as altitude,
  not (p > 0 and p0 > 0) as no_altitude
from p""")
def altitude(spark, sf_dir):
    rows = I.table(spark, sf_dir, "lineitem").select(
        F.expr("l_orderkey * 8 + l_linenumber").alias("sample_id"),
        C.altitude(F.expr(_PRESSURE), F.expr(_SEA_LEVEL)).alias("altitude"),
    )
    return rows.select("sample_id", *_altitude_out())


@query(f"""with p as (
  select l_orderkey * 8 + l_linenumber as sample_id, {_PRESSURE} as p, {_HEIGHT} as h from lineitem)
select sample_id, case when p > 0 and 1 - h / cast(44330 as double) > 0 then
    round(p / pow(1 - h / cast(44330 as double), cast(5.255301895 as double)), 2) end as sea_level
from p""")
def sea_level(spark, sf_dir):
    return I.table(spark, sf_dir, "lineitem").select(
        F.expr("l_orderkey * 8 + l_linenumber").alias("sample_id"),
        F.round(C.sea_level_pressure(F.expr(_PRESSURE), F.expr(_HEIGHT)), 2).alias("sea_level"),
    )


@query(f"""with {I.SQL_SCD41}, judged as (select *, fault > 3 as frame_ok, status & 2047 <> 0 as ready from frames)
select sample_id, frame_ok, case when not frame_ok then 'bad checksum' end as reject_reason, case when frame_ok and ready then w0 end as co2,
  case when frame_ok and ready then 175 * cast(w1 as double) / 65536 - 45 end as temperature,
  case when frame_ok and ready then 100 * cast(w2 as double) / 65536 end as humidity
from judged""")
def calibrate_scd41(spark, sf_dir):
    out = C.calibrate_scd41(I.scd41_raw(spark, sf_dir), ready_word="status")
    return out.select("sample_id", "frame_ok", "reject_reason", "co2", "temperature", "humidity")


@query(f"""with {I.SQL_SCD41}
select sample_id, 'i483-dead-messages' as topic, cast(json_object('error', 'bad checksum', 'originalTopic', 'SCD41/frame',
  'originalPayload', concat(printf('%02X%02X', w0 // 256, w0 % 256), printf('%02X', b2), printf('%02X%02X', w1 // 256, w1 % 256),
    printf('%02X', b5), printf('%02X%02X', w2 // 256, w2 % 256), case when b8 is null then '??' else printf('%02X', b8) end),
  'timestamp', '1700000000000') as varchar) as value
from frames where fault <= 3""")
def scd41_frame_letters(spark, sf_dir):
    out = C.calibrate_scd41(I.scd41_raw(spark, sf_dir))
    at = F.timestamp_millis(F.lit(1700000000000))
    return C.frame_letters(out, F.lit("SCD41/frame"), at, [f"b{i}" for i in range(9)], keep=["sample_id"])


@query(f"""with {I.SQL_SCD41}, samples as (
  select *, case when fault > 3 and status & 2047 <> 0 then w0 end as co2 from frames)
select sample_id, last_value(co2 ignore nulls) over (partition by device_id order by sample_id, l_partkey
  rows between unbounded preceding and current row) as co2
from samples""")
def scd41_carry_forward(spark, sf_dir):
    """Frames to the CO2 value that a device sends: the last good one while frames are bad or not ready."""
    out = C.calibrate_scd41(I.scd41_raw(spark, sf_dir), ready_word="status")
    at = out.withColumn("ts", F.timestamp_millis(F.col("sample_id") * 1000))
    filled = carry_forward(at, ("device_id",), ("sample_id", "l_partkey"), value="co2", out="sent", block="1 hour")
    return filled.select("sample_id", F.col("sent").alias("co2"))


@query(f"""with {I.SQL_SCD41}
select sample_id, fault > 3 as frame_ok, case when fault > 3 then 175 * cast(w1 as double) / 65535 - 45 end as temperature,
  case when fault > 3 then 100 * cast(w2 as double) / 65535 end as humidity from frames""")
def calibrate_scd41_65535(spark, sf_dir):
    out = C.calibrate_scd41(I.scd41_raw(spark, sf_dir), divisor=65535.0)
    return out.select("sample_id", "frame_ok", "temperature", "humidity")


@query(f"""with {I.SQL_SCD41}
select sample_id, b2, b5, b8, coalesce(b2 = k0 and b5 = k1 and b8 = k2, false) as frame_ok from frames""")
def crc_check(spark, sf_dir):
    frames = I.scd41_raw(spark, sf_dir)
    return frames.select(
        "sample_id", *[F.col(b).cast("bigint").alias(b) for b in ("b2", "b5", "b8")],
        C.scd41_frame_ok([f"b{i}" for i in range(9)]).alias("frame_ok"),
    )


@query(f"with {I.SQL_SCD41} select sample_id, status from frames where status & 2047 <> 0")
def data_ready(spark, sf_dir):
    return I.scd41_raw(spark, sf_dir).where(C.scd41_data_ready(F.col("status"))).select(
        "sample_id", "status"
    )


@query(f"with {I.SQL_RPR} select sample_id, data0, data1 from rpr")
def little_endian_words(spark, sf_dir):
    return _rpr(spark, sf_dir).select("sample_id", "data0", "data1")


def _in_force(samples, spark, sf_dir, *names):
    return settings_in_force(samples, I.settings_log(spark, sf_dir), names, tie_cols=("settings_id",))


@query(f"""with {I.SQL_SETTINGS}, bh as (
  select l_orderkey * 8 + l_linenumber as sample_id, case when l_orderkey % 50 = 0 then -1 else {I.BH_RAW} end as raw,
    cast(0.9 as double) + (settings_id % 60) / cast(100 as double) as accuracy from {I.SQL_SETTINGS_LINES}),
judged as (
  select *, case when raw < 0 then 'failed read' when accuracy is null then 'no settings'
    when not accuracy between cast(0.96 as double) and cast(1.44 as double) then 'accuracy out of range' end as reject_reason
  from bh)
select sample_id, accuracy, reject_reason,
  case when reject_reason is null then raw / cast(1.2 as double) / accuracy end as illumination from judged""")
def bh1750_changing_accuracy(spark, sf_dir):
    """Light by the accuracy that was set when the sample was taken."""
    samples = I.bh1750_samples(spark, sf_dir)
    out = C.calibrate_bh1750(_in_force(samples, spark, sf_dir, "accuracy"))
    return out.select("sample_id", "accuracy", "illumination", "reject_reason")


# fixed values in the SQL: the data sheet's lux segments
@query(f"""with {I.SQL_SETTINGS}, {I.sql_rpr("(settings_id * 37) % 256", "(settings_id * 11) % 256", I.SQL_SETTINGS_LINES)}
select sample_id, gain0, gain1, ms as measure_ms,
  case when data0 is null or ps is null then 'failed read' when ms is null then 'no settings' when ms = 0 then 'not measuring' end as reject_reason,
  cast(case when data0 is null or ms is null then null when ms = 0 then -1 when d0 = 0 then 0
    when d1 / d0 < 0.595::double then 1.682::double * d0 - 1.877::double * d1
    when d1 / d0 < 1.015::double then 0.644::double * d0 - 0.132::double * d1
    when d1 / d0 < 1.352::double then 0.756::double * d0 - 0.243::double * d1
    when d1 / d0 < 3.053::double then 0.766::double * d0 - 0.25::double * d1
    else 0 end as double) as ambient_light
from rpr_adj""")
def rpr_changing_registers(spark, sf_dir):
    """Light by the gains and the measurement time of the registers in force."""
    samples = _rpr(spark, sf_dir).drop("als_ps_reg", "mode_reg")
    out = C.calibrate_rpr(_in_force(samples, spark, sf_dir, "als_ps_reg", "mode_reg"))
    return out.select("sample_id", "gain0", "gain1", "measure_ms", "ambient_light", "reject_reason")


@query(f"""with {I.SQL_SETTINGS}, p as (
  select l_orderkey * 8 + l_linenumber as sample_id, {_PRESSURE} as p,
    cast(980 + settings_id % 60 as double) as p0 from {I.SQL_SETTINGS_LINES})
select sample_id, p0 as sea_level, case when p > 0 then
    round(cast(44330 as double) * (1 - pow(p / p0, cast(0.190284 as double))), 4) end as altitude,
  coalesce(p <= 0, false) and p0 is not null as no_altitude
from p""")
def altitude_changing_sea_level(spark, sf_dir):
    """Height by the pressure at sea level that was set last."""
    samples = I.table(spark, sf_dir, "lineitem").select(
        F.expr("l_orderkey * 8 + l_linenumber").alias("sample_id"),
        F.expr("concat('s', cast(1000 + l_suppkey as string))").alias("device_id"),
        F.col("l_shipdate").cast("timestamp").alias("ts"), F.expr(_PRESSURE).alias("air_pressure"),
    )
    known = _in_force(samples, spark, sf_dir, "sea_level")
    out = known.withColumn("altitude", C.altitude(F.col("air_pressure"), F.col("sea_level")))
    return out.select("sample_id", "sea_level", *_altitude_out())

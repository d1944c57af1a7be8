"""The given tables as sensor data, in Spark and as the same SQL.

`events` becomes a stream of messages and `lineitem`/`supplier` raw sensor counts. Every
mapping is a projection of whole tables, so the work of a query grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorstream.functions.bits import crc8
from sensorstream.operators import parse
from sensorstream.session import pin_settings

OWNER = "s1001"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    pin_settings(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- messages from events ---------------------------------------------------------
# view, click, purchase and signup are good readings; error is one of eight faults, the
# eighth of which is a good reading with a surplus part.
_SUFFIX = """
case event_type
  when 'view' then '-BH1750-illumination'
  when 'click' then '-SCD41-co2'
  when 'purchase' then '-DPS310-temperature'
  when 'signup' then '-RPR0521RS-proximity'
  else case event_id % 8
    when 2 then '-SCD41'
    when 4 then '-BH1750_avg-illumination'
    when 5 then '-DPS310-temperature'
    when 7 then case event_id div 8 % 3 when 0 then '-RPR0521RS-infrared_illumination'
      when 1 then '-BH1750-illumination' else '-SCD41-co2' end
    else '-SCD41-co2' end
end"""
_PREFIX = "case when event_type = 'error' and event_id % 8 = 3 then 'x483-sensors-s' else 'i483-sensors-s' end"
# whole and fraction of the value as text
_WHOLE = "case event_type when 'click' then 400 + cents div 10 when 'purchase' then cents div 1000 end"
_FRACTION = """case event_type when 'click' then cast(cents % 10 as string)
  when 'purchase' then lpad(cast(cents % 1000 as string), 3, '0') end"""
_VALUE = """
case when event_type = 'error' then
    case event_id % 8 when 0 then 'n/a' when 1 then null when 5 then 'NaN' when 6 then '1e999'
      when 7 then concat(text, ',9') else '1' end
  when whole is null then text
  else concat(cast(whole as string), '.', fraction) end"""


def as_records(events: DataFrame) -> DataFrame:
    """events as Kafka rows: topic, timestamp, value, partition, offset."""
    return (
        events.select(
            "event_id", "ts", "event_type",
            F.expr("cast(1000 + user_id % 10 as string)").alias("device"),
            F.expr("cast(value as string)").alias("text"),
            F.expr("cast(round(value * 100) as bigint)").alias("cents"),
        )
        .withColumns({
            "prefix": F.expr(_PREFIX), "suffix": F.expr(_SUFFIX),
            "whole": F.expr(_WHOLE), "fraction": F.expr(_FRACTION),
        })
        .select(
            "event_id",
            F.timestamp_millis(F.unix_millis(F.col("ts").cast("timestamp"))).alias("timestamp"),
            F.expr("cast(event_id % 4 as int)").alias("partition"),
            F.expr("event_id div 4").alias("offset"),
            # out of a generator, so that queries see plain columns as of a landed table
            F.inline(F.array(F.struct(
                F.concat("prefix", "device", "suffix").alias("topic"), F.expr(_VALUE).alias("value")
            ))),
        )
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_records(table(spark, sf_dir, "events"))


def record_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    events = (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    )
    return as_records(events)


def readings_of(source: DataFrame) -> DataFrame:
    return parse.readings(parse.parse_records(parse.decode_records(parse.only_topics(source))))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_of(records(spark, sf_dir))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records as text lines, some of the faults turned into faults of the line itself: no
    timestamp, no line at all, and three timestamps beyond any calendar."""
    return records(spark, sf_dir).select(
        "event_id",
        F.expr("""
            case when value = 'NaN' then concat(topic, ',abc,1')
                 when value = '1e999' then 'ERROR: broken'
                 when value = 'n/a' and event_id % 32 = 8 then concat(topic, ',9223372036854775807,1')
                 when value = 'n/a' and event_id % 32 = 16 then concat(topic, ',9223372036854775,1')
                 when value = 'n/a' and event_id % 32 = 24 then concat(topic, ',-62135596800001,1')
                 else concat_ws(',', topic, cast(unix_millis(timestamp) as string), coalesce(value, 'null'))
            end""").alias("raw"),
        F.col("partition").alias("src_partition"),
        F.col("offset").alias("src_offset"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records as landed MQTT messages, with payloads that need care when quoted and some
    topics Kafka would not take."""
    return as_messages(records(spark, sf_dir))


def as_messages(source: DataFrame) -> DataFrame:
    return source.select(
        "event_id",
        F.expr("""
            case when value = 'n/a' then concat(replace(topic, '-', '/'), '/bad name')
                 else replace(topic, '-', '/') end""").alias("topic"),
        F.when(F.col("value") == "n/a", F.lit('a "quoted" \\ text\nin two lines'))
        .otherwise(F.col("value")).alias("payload"),
        F.col("timestamp").alias("ts"),
    )


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings whose partitions deliver every five rows in reverse; the last partition has no number."""
    return readings(spark, sf_dir).withColumns({
        "src_offset": F.expr("(src_offset div 5) * 5 + (4 - src_offset % 5)"), "src_partition": F.expr("nullif(src_partition, 3)"),
    })


# The same mappings for the oracle.
SQL_RECORDS = """
base as (
  select *, 's' || cast(1000 + user_id % 10 as varchar) as dev, cast(round(value * 100) as bigint) as cents
  from events),
rec as (
  select event_id, epoch_us(ts) // 1000 as ts_ms, cast(event_id % 4 as integer) as src_partition, event_id // 4 as src_offset,
    case event_type
      when 'view' then 'i483-sensors-' || dev || '-BH1750-illumination'
      when 'click' then 'i483-sensors-' || dev || '-SCD41-co2'
      when 'purchase' then 'i483-sensors-' || dev || '-DPS310-temperature'
      when 'signup' then 'i483-sensors-' || dev || '-RPR0521RS-proximity'
      else case event_id % 8
        when 2 then 'i483-sensors-' || dev || '-SCD41'
        when 3 then 'x483-sensors-' || dev || '-SCD41-co2'
        when 4 then 'i483-sensors-' || dev || '-BH1750_avg-illumination'
        when 5 then 'i483-sensors-' || dev || '-DPS310-temperature'
        when 7 then 'i483-sensors-' || dev || case event_id // 8 % 3 when 0 then '-RPR0521RS-infrared_illumination'
          when 1 then '-BH1750-illumination' else '-SCD41-co2' end
        else 'i483-sensors-' || dev || '-SCD41-co2' end
    end as topic,
    case event_type
      when 'view' then cast(value as varchar)
      when 'click' then cast(400 + cents // 10 as varchar) || '.' || cast(cents % 10 as varchar)
      when 'purchase' then cast(cents // 1000 as varchar) || '.' || lpad(cast(cents % 1000 as varchar), 3, '0')
      when 'signup' then cast(value as varchar)
      else case event_id % 8
        when 0 then 'n/a' when 1 then null when 5 then 'NaN' when 6 then '1e999'
        when 7 then cast(value as varchar) || ',9' else '1' end
    end as value
  from base)"""

SQL_READINGS = SQL_RECORDS + r""",
dec as (
  select topic, ts_ms, src_partition, src_offset, split_part(coalesce(value, 'null'), ',', 1) as v
  from rec
  where regexp_full_match(topic, 'i483-sensors-s[0-9]+-[A-Z0-9]+-[a-zA-Z0-9_]+')),
readings as (
  select split_part(topic, '-', 3) as device_id, split_part(topic, '-', 4) as sensor,
    split_part(topic, '-', 5) as metric, topic, ts_ms, cast(v as double) as value, src_partition, src_offset
  from dec
  where regexp_full_match(v, '\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*') and v <> '1e999')"""

SQL_LINES = SQL_RECORDS + """,
lines as (
  select event_id, src_partition, src_offset,
    case when value = 'NaN' then topic || ',abc,1'
         when value = '1e999' then 'ERROR: broken'
         when value = 'n/a' and event_id % 32 = 8 then topic || ',9223372036854775807,1'
         when value = 'n/a' and event_id % 32 = 16 then topic || ',9223372036854775,1'
         when value = 'n/a' and event_id % 32 = 24 then topic || ',-62135596800001,1'
         else topic || ',' || ts_ms || ',' || coalesce(value, 'null') end as raw
  from rec)"""

SQL_MESSAGES = SQL_RECORDS + r""",
messages as (
  select event_id, ts_ms,
    case when value = 'n/a' then replace(topic, '-', '/') || '/bad name' else replace(topic, '-', '/') end as topic,
    case when value = 'n/a' then 'a "quoted" \ text' || chr(10) || 'in two lines' else value end as payload
  from rec)"""


# --- raw counts from lineitem and supplier -------------------------------------------
def _hash(a: int, b: int, modulus: int) -> str:
    """A spread-out non-negative number; the text is both Spark SQL and DuckDB SQL."""
    return f"((l_orderkey * {a} + l_linenumber * {b} + l_partkey * 31) % {modulus})"


BH_RAW = _hash(7919, 104729, 65536)
RPR_PS = _hash(3571, 7727, 4096)
RPR_D0 = _hash(6007, 15013, 65536)
RPR_D1 = _hash(5003, 12007, 65536)
DPS_P = _hash(1299709, 15485863, 16777216)
DPS_T = _hash(179424673, 32452843, 16777216)
SCD_W = [_hash(9973, 611953, 65536), _hash(10007, 700001, 65536), _hash(10009, 800011, 65536)]
SCD_FAULT = _hash(17, 29, 20)

_SAMPLE_ID = "l_orderkey * 8 + l_linenumber"
_LINE_DEVICE = "concat('s', cast(1000 + l_suppkey as string))"


def _counts(spark: SparkSession, sf_dir: str, **columns: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.expr(_SAMPLE_ID).alias("sample_id"),
        F.expr(_LINE_DEVICE).alias("device_id"),
        *[F.expr(text).alias(name) for name, text in columns.items()],
    )


def bh1750_raw(spark, sf_dir) -> DataFrame:
    """Two bytes per sample, and a failed read now and then; accuracy is set per device, but not for all."""
    counts = _counts(
        spark, sf_dir,
        hi=f"cast({BH_RAW} div 256 as int)", lo=f"cast({BH_RAW} % 256 as int)",
        failed="l_orderkey % 50 = 0", settings_id="l_suppkey",
    )
    settings = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("settings_id"),
        F.expr("cast(0.9 as double) + (s_suppkey % 60) / cast(100 as double)").alias("accuracy"),
    )
    return counts.join(settings.where("settings_id % 23 <> 0"), "settings_id", "left").drop("settings_id")


def bh1750_samples(spark, sf_dir) -> DataFrame:
    """Counts with their time and without settings."""
    raw = f"case when l_orderkey % 50 = 0 then -1 else cast({BH_RAW} as int) end"
    return _counts(spark, sf_dir, ts="cast(l_shipdate as timestamp)", raw=raw)


SQL_BH1750 = f"""
bh as (
  select l_orderkey * 8 + l_linenumber as sample_id, 's' || cast(1000 + l_suppkey as varchar) as device_id,
    case when l_orderkey % 50 = 0 then -1 else {BH_RAW} end as raw,
    cast(0.9 as double) + (s_suppkey % 60) / cast(100 as double) as accuracy
  from lineitem left join supplier on l_suppkey = s_suppkey and s_suppkey % 23 <> 0)"""


def settings_log(spark, sf_dir) -> DataFrame:
    """Settings by device and time, a row per order; devices may have several of the same instant, or none."""
    return table(spark, sf_dir, "orders").select(
        F.expr("concat('s', cast(1000 + o_custkey as string))").alias("device_id"),
        F.col("o_orderdate").cast("timestamp").alias("since"), F.col("o_orderkey").alias("settings_id"),
        F.expr("cast(0.9 as double) + (o_orderkey % 60) / cast(100 as double)").alias("accuracy"),
        F.expr("cast((o_orderkey * 37) % 256 as int)").alias("als_ps_reg"),
        F.expr("cast((o_orderkey * 11) % 256 as int)").alias("mode_reg"),
        F.expr("cast(980 + o_orderkey % 60 as double)").alias("sea_level"),
    )


SQL_SETTINGS = """
settings as (
  select o_custkey as number, o_orderdate as since, max(o_orderkey) as settings_id from orders group by all)"""
SQL_SETTINGS_LINES = "(lineitem asof left join settings on l_suppkey = number and l_shipdate >= since)"


def rpr_raw(spark, sf_dir) -> DataFrame:
    return _counts(
        spark, sf_dir,
        ps=f"case when l_orderkey % 43 <> 0 then cast({RPR_PS} as int) end",
        d0_lo=f"case when l_orderkey % 41 <> 0 then cast({RPR_D0} % 256 as int) end", d0_hi=f"cast({RPR_D0} div 256 as int)",
        d1_lo=f"cast({RPR_D1} % 256 as int)", d1_hi=f"cast({RPR_D1} div 256 as int)",
        als_ps_reg="cast((l_suppkey * 37) % 256 as int)", mode_reg="cast((l_suppkey * 11) % 256 as int)",
        ts="cast(l_shipdate as timestamp)",
    )


def sql_rpr(als: str, mode: str, lines: str = "lineitem") -> str:
    return f"""
rpr as (
  select l_orderkey * 8 + l_linenumber as sample_id, 's' || cast(1000 + l_suppkey as varchar) as device_id,
    case when l_orderkey % 43 <> 0 then {RPR_PS} end as ps, case when l_orderkey % 41 <> 0 then {RPR_D0} end as data0, {RPR_D1} as data1,
    {als} as als, {mode} as mode
  from {lines}),
rpr_set as ( -- fixed values: gains and measurement times of the data sheet, by register field
  select *, ([1, 2, 64, 128])[cast((als >> 4) & 3 as integer) + 1] as gain0,
    ([1, 2, 64, 128])[cast((als >> 2) & 3 as integer) + 1] as gain1,
    ([0, 0, 0, 0, 0, 100, 100, 100, 100, 100, 400, 400, 50, 0, 0, 0])[cast(mode & 15 as integer) + 1] as ms
  from rpr),
rpr_adj as (
  select *,
    case when ms <> 0 then cast(case when ms = 50 and data0 >= 32768 then 32767 else data0 end as double)
      * (cast(100 as double) / ms) / gain0 end as d0,
    case when ms <> 0 then cast(case when ms = 50 and data1 >= 32768 then 32767 else data1 end as double)
      * (cast(100 as double) / ms) / gain1 end as d1
  from rpr_set)"""


SQL_RPR = sql_rpr("(l_suppkey * 37) % 256", "(l_suppkey * 11) % 256")


def dps310_tables(spark, sf_dir) -> DataFrame:
    """Eighteen coefficient bytes per device."""
    octets = [F.expr(f"cast((s_suppkey * {31 * i + 17} + {53 * i}) % 256 as int)") for i in range(18)]
    return table(spark, sf_dir, "supplier").select(
        F.expr("concat('s', cast(1000 + s_suppkey as string))").alias("device_id"),
        F.array(*octets).alias("coeff"),
    )


SQL_DPS310_COEFF = """
octets as (
  select 's' || cast(1000 + s_suppkey as varchar) as device_id,
    [(s_suppkey * (31 * i + 17) + 53 * i) % 256 for i in range(18)] as b
  from supplier),
fields as (
  select device_id,
    b[1] * 16 + b[2] // 16 as u_c0, (b[2] % 16) * 256 + b[3] as u_c1,
    b[4] * 4096 + b[5] * 16 + b[6] // 16 as u_c00, (b[6] % 16) * 65536 + b[7] * 256 + b[8] as u_c10,
    b[9] * 256 + b[10] as u_c01, b[11] * 256 + b[12] as u_c11, b[13] * 256 + b[14] as u_c20,
    b[15] * 256 + b[16] as u_c21, b[17] * 256 + b[18] as u_c30
  from octets),
coeff as (
  select device_id,
    case when u_c0 >= 2048 then u_c0 - 4096 else u_c0 end as c0,
    case when u_c1 >= 2048 then u_c1 - 4096 else u_c1 end as c1,
    case when u_c00 >= 524288 then u_c00 - 1048576 else u_c00 end as c00,
    case when u_c10 >= 524288 then u_c10 - 1048576 else u_c10 end as c10,
    case when u_c01 >= 32768 then u_c01 - 65536 else u_c01 end as c01,
    case when u_c11 >= 32768 then u_c11 - 65536 else u_c11 end as c11,
    case when u_c20 >= 32768 then u_c20 - 65536 else u_c20 end as c20,
    case when u_c21 >= 32768 then u_c21 - 65536 else u_c21 end as c21,
    case when u_c30 >= 32768 then u_c30 - 65536 else u_c30 end as c30
  from fields)"""


def dps310_raw(spark, sf_dir) -> DataFrame:
    return _counts(
        spark, sf_dir,
        p2=f"cast({DPS_P} div 65536 as int)", p1=f"cast({DPS_P} div 256 % 256 as int)", p0=f"case when l_orderkey % 50 <> 0 then cast({DPS_P} % 256 as int) end",
        t2=f"cast({DPS_T} div 65536 as int)", t1=f"cast({DPS_T} div 256 % 256 as int)", t0=f"cast({DPS_T} % 256 as int)",
        p_os="case when l_suppkey % 17 = 0 then 3 else cast(shiftleft(1, cast(l_linenumber % 8 as int)) as int) end",
        t_os="cast(shiftleft(1, cast(l_orderkey % 8 as int)) as int)",
        sea_level="cast(1000 + l_suppkey % 30 as double)",
    )


SQL_DPS310 = SQL_DPS310_COEFF + f""",
scales as ( -- fixed values: scale factors of the data sheet, by log2 of the oversampling rate
  select * from (values (0, 524288.0::double), (1, 1572864.0::double), (2, 3670016.0::double), (3, 7864320.0::double),
    (4, 253952.0::double), (5, 516096.0::double), (6, 1040384.0::double), (7, 2088960.0::double)) as s(shift, k)),
dps as (
  select l_orderkey * 8 + l_linenumber as sample_id, coeff.*,
    l_orderkey % 50 = 0 as unread, sp.k is null as unscaled, cast(substr(coeff.device_id, 2) as bigint) % 31 = 0 as several,
    case when l_orderkey % 50 <> 0 then (case when {DPS_P} >= 8388608 then {DPS_P} - 16777216 else {DPS_P} end) / sp.k end as p,
    (case when {DPS_T} >= 8388608 then {DPS_T} - 16777216 else {DPS_T} end) / st.k as t,
    cast(1000 + l_suppkey % 30 as double) as sea_level
  from lineitem
  left join scales sp on l_linenumber % 8 = sp.shift and l_suppkey % 17 <> 0
  join scales st on l_orderkey % 8 = st.shift
  left join coeff on coeff.device_id = 's' || cast(1000 + l_suppkey as varchar)
    and cast(substr(coeff.device_id, 2) as bigint) % 29 <> 0),
dps_out as (
  select *, case when not several then c0 * cast(0.5 as double) + c1 * t end as temperature,
    case when not several then (c00 + p * (c10 + p * (c20 + p * c30)) + t * c01 + t * p * (c11 + p * c21)) / cast(100 as double) end as air_pressure,
    case when several then 'several coefficients' when c0 is null then 'no coefficients' when unread then 'failed read'
      when unscaled then 'unknown oversampling' end as reject_reason
  from dps)"""


def scd41_raw(spark, sf_dir) -> DataFrame:
    """Nine bytes per frame; three checksums in twenty are wrong, one frame in twenty lacks its last
    byte, one in eleven was not ready."""
    columns = {}
    for i, word in enumerate(SCD_W):
        columns[f"b{3 * i}"] = f"cast({word} div 256 as int)"
        columns[f"b{3 * i + 1}"] = f"cast({word} % 256 as int)"
    frames = _counts(spark, sf_dir, l_partkey="l_partkey", fault=f"cast({SCD_FAULT} as int)",
                     status="cast(case when l_orderkey % 11 = 0 then 2048 * 16 else 2048 + l_linenumber end as int)",
                     **columns)
    for i in range(3):
        good = crc8(F.col(f"b{3 * i}"), F.col(f"b{3 * i + 1}"))
        frames = frames.withColumn(
            f"b{3 * i + 2}", F.when(F.col("fault") == i, good.bitwiseXOR(F.lit(1))).otherwise(good).cast("int")
        )
    return frames.withColumn("b8", F.when(F.col("fault") != 3, F.col("b8"))).drop("fault")


def _sql_crc(word: str) -> str:
    """CRC-8 of a two-byte word, bit by bit."""
    step = "case when c & 128 <> 0 then xor((c << 1) & 255, 49) else (c << 1) & 255 end"
    first = f"list_reduce(list_concat([xor(255, {word} // 256)], [0,0,0,0,0,0,0,0]), lambda c, i: {step})"
    return f"list_reduce(list_concat([xor({first}, {word} % 256)], [0,0,0,0,0,0,0,0]), lambda c, i: {step})"


SQL_SCD41 = f"""
words as (
  select l_orderkey * 8 + l_linenumber as sample_id, 's' || cast(1000 + l_suppkey as varchar) as device_id, l_partkey,
    {SCD_W[0]} as w0, {SCD_W[1]} as w1, {SCD_W[2]} as w2,
    {SCD_FAULT} as fault, case when l_orderkey % 11 = 0 then 2048 * 16 else 2048 + l_linenumber end as status
  from lineitem),
crcs as (
  select *, {_sql_crc('w0')} as k0, {_sql_crc('w1')} as k1, {_sql_crc('w2')} as k2 from words),
frames as (
  select *,
    case when fault = 0 then xor(k0, 1) else k0 end as b2,
    case when fault = 1 then xor(k1, 1) else k1 end as b5,
    case fault when 2 then xor(k2, 1) when 3 then null else k2 end as b8
  from crcs)"""

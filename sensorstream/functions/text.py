"""Reading numbers from text and writing them back."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: what counts as a number in a payload
PLAIN_DECIMAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*\z"
PLAIN_INTEGER = r"^[+-]?[0-9]+\z"


def parse_decimal(text: Column) -> Column:
    """Finite plain decimal as double, else null.

    A cast alone would also take `nan`, `inf`, `1.0f`, `1d` and hexadecimal floats.
    """
    number = F.btrim(text, F.lit(" \t\n\r\f\v")).try_cast("double")
    infinity = F.lit(float("inf"))
    return F.when(text.rlike(PLAIN_DECIMAL) & (F.abs(number) < infinity), number)


def parse_integer(text: Column) -> Column:
    """64-bit integer, else null; blanks around the digits are not accepted."""
    return F.when(text.rlike(PLAIN_INTEGER), text.try_cast("bigint"))


def whole_digits(x: Column) -> Column:
    """All digits of a finite double from 2^62 on: an integer of at most 56 bits, times a power of
    two, in limbs of 15 digits. Thirteen doublings are one step, since a limb times 2^13 fits 64 bits."""
    limb = F.lit(10**15)
    power = (F.floor(F.log2(x)) - 54).cast("int")
    start = (x / F.pow(F.lit(2.0), power)).cast("bigint")

    def times(limbs, factor):
        def step(acc, value):
            product = value * factor + acc["carry"]
            return F.struct(
                F.array_append(acc["limbs"], product % limb).alias("limbs"),
                F.call_function("div", product, limb).alias("carry"),
            )

        empty = F.struct(F.array().cast("array<bigint>").alias("limbs"), F.lit(0).cast("bigint").alias("carry"))
        return F.aggregate(
            limbs, empty, step,
            lambda acc: F.when(acc["carry"] > 0, F.array_append(acc["limbs"], acc["carry"])).otherwise(acc["limbs"]),
        )

    factors = F.concat(
        F.array_repeat(F.lit(1 << 13), F.call_function("div", power, F.lit(13)).cast("int")),
        F.array(F.pow(F.lit(2.0), power % 13).cast("int")),
    )
    limbs = F.aggregate(
        factors, F.array(start % limb, F.call_function("div", start, limb)), lambda acc, factor: times(acc, factor.cast("bigint"))
    )
    padded = F.transform(F.reverse(limbs), lambda v: F.lpad(v.cast("string"), 15, "0"))
    return F.ltrim(F.array_join(padded, ""), F.lit("0"))


def with_fixed2(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Adds text columns: the number with two decimals, rounded from its exact binary value,
    ties to even.

    `format_string('%.2f', 52.915)` gives 52.92 because it rounds the shortest decimal text of
    the double; the double itself lies just below 52.915. Here the fraction is taken times 2^62
    as an integer. That is exact unless the fraction is below 2^-10, too small to round up to
    a hundredth. The steps are separate projections, so nothing is computed twice and all of it
    stays in generated code. From 2^53 on there is no fraction, from 2^62 on the digits come from
    `whole_digits`.
    """
    names = list(columns)
    step = {n: [f"_{part}_{i}" for part in ("x", "m", "h")] for i, n in enumerate(names)}

    df = df.withColumns({step[n][0]: columns[n].cast("double") for n in names})

    def fraction(x):
        size = F.abs(x)
        return ((size - F.floor(size)) * F.lit(float(1 << 62))).try_cast("bigint")

    df = df.withColumns({step[n][1]: fraction(F.col(step[n][0])) for n in names})

    # fraction * 100 in units of 2^-56, and whether anything is left below that
    def hundredths(m):
        low = m.bitwiseAND(F.lit(63)) * 100
        return F.struct(
            (F.shiftright(m, 6) * 100 + F.shiftright(low, 6)).alias("high"),
            (low.bitwiseAND(F.lit(63)) != 0).alias("more"),
        )

    df = df.withColumns({step[n][2]: hundredths(F.col(step[n][1])) for n in names})

    def total(x, h):
        high, half = h["high"], F.lit(1 << 55)
        rest = high.bitwiseAND(F.lit((1 << 56) - 1))
        kept = F.shiftright(high, 56)
        up = (rest > half) | ((rest == half) & (h["more"] | (kept.bitwiseAND(F.lit(1)) == 1)))
        return F.when(F.abs(x) < float(1 << 53), F.floor(F.abs(x)) * 100 + kept + up.cast("bigint"))

    df = df.withColumns({step[n][1]: total(F.col(step[n][0]), F.col(step[n][2])) for n in names})

    def text(x, cents):
        negative_zero = (x == 0) & (x.cast("string") == "-0.0")
        sign = F.when((x < 0) | negative_zero, "-").otherwise("")
        whole, part = F.call_function("div", cents, F.lit(100)), F.pmod(cents, F.lit(100))
        point = F.when(part < 10, ".0").otherwise(".")
        return (
            F.when(cents.isNotNull(), F.concat(sign, whole.cast("string"), point, part.cast("string")))
            .when(F.isnan(x), "NaN")
            .when(F.abs(x) == float("inf"), F.concat(sign, F.lit("Infinity")))
            .when(F.abs(x) < float(1 << 62), F.concat(x.try_cast("bigint").cast("string"), F.lit(".00")))
            .when(x.isNotNull(), F.concat(sign, whole_digits(F.abs(x)), F.lit(".00")))
        )

    df = df.withColumns({n: text(F.col(step[n][0]), F.col(step[n][1])) for n in names})
    return df.drop(*[c for n in names for c in step[n]])

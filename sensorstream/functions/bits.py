"""Words, signs and checksums over integer columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorstream import fixed


def bits(value: Column, low: int, width: int) -> Column:
    """The unsigned field of `width` bits that starts at bit `low`."""
    return F.shiftright(value, low).bitwiseAND(F.lit((1 << width) - 1))


def word_big_endian(*octets: Column) -> Column:
    """Bytes, most significant first, as one unsigned number."""
    word = octets[0].cast("bigint")
    for octet in octets[1:]:
        word = F.shiftleft(word, 8).bitwiseOR(octet.cast("bigint"))
    return word


def word_little_endian(*octets: Column) -> Column:
    return word_big_endian(*reversed(octets))


def signed(value: Column, width: int) -> Column:
    """An unsigned field of `width` bits read as two's complement."""
    # (v xor s) - s with s the sign bit: one pass, `value` appears once
    sign = F.lit(1 << (width - 1)).cast("bigint")
    return value.cast("bigint").bitwiseXOR(sign) - sign


def crc8_table(polynomial: int = fixed.CRC8_POLYNOMIAL) -> list[int]:
    """Remainder of every byte value, from the polynomial."""
    table = []
    for byte in range(256):
        remainder = byte
        for _ in range(8):
            remainder = (remainder << 1) ^ (polynomial if remainder >> 7 else 0)
            remainder &= 0xFF
        table.append(remainder)
    return table


def crc8(*octets: Column, polynomial: int = fixed.CRC8_POLYNOMIAL,
         initial: int = fixed.CRC8_INITIAL) -> Column:
    """CRC-8, one table look-up per byte; the table is a plan constant."""
    table = F.array(*[F.lit(r) for r in crc8_table(polynomial)])
    crc = F.lit(initial)
    for octet in octets:
        crc = F.get(table, crc.bitwiseXOR(octet.cast("int")))
    return crc

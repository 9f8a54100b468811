"""Log positions: 64-bit numbers below 2^63, written as upper-case hex ``X/Y``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse(text: str) -> int:
    high, _, low = text.partition("/")
    value = (int(high, 16) << 32) | int(low, 16)
    if not low or int(low, 16) >> 32 or value >> 63:
        raise ValueError(f"not a position: {text!r}")
    return value


def show(value: int) -> str:
    if value < 0:
        raise ValueError("a position is not negative")
    return f"{value >> 32:X}/{value & 0xFFFFFFFF:X}"


def parse_col(text: Column) -> Column:
    """NULL where the text is no position."""
    part = lambda i: F.conv(F.split_part(text, F.lit("/"), F.lit(i)), 16, 10).cast("long")
    return F.when(text.rlike("^[0-9A-Fa-f]{1,8}/[0-9A-Fa-f]{1,8}$"), part(1) * 4294967296 + part(2))


def show_col(value: Column) -> Column:
    return F.concat(F.hex(F.shiftrightunsigned(value, 32)), F.lit("/"), F.hex(value.bitwiseAND(F.lit(0xFFFFFFFF))))

"""Binary COPY blobs to typed rows."""

from __future__ import annotations

import datetime as dt
import struct
import uuid
from collections.abc import Iterator
from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame

# Fixed values of the format.
MAGIC = b"PGCOPY\n\xff\r\n\x00"
EPOCH_DAYS = 10_957
EPOCH_MICROS = 946_684_800_000_000


def body_start(blob: bytes) -> int:
    """Where rows begin: after magic, flags, extension length and extension."""
    if len(blob) < len(MAGIC) + 8 or not blob.startswith(MAGIC):
        raise ValueError("not a binary COPY blob")
    return len(MAGIC) + 8 + struct.unpack_from(">i", blob, len(MAGIC) + 4)[0]


def rows(blob: bytes) -> Iterator[list[bytes | None]]:
    """Fields of each row, up to the trailer; a blob that ends early is an error."""
    at = body_start(blob)
    while True:
        if at + 2 > len(blob):
            raise ValueError("the blob ends without its trailer")
        (n,) = struct.unpack_from(">h", blob, at)
        at += 2
        if n < 0:
            return
        fields = []
        for _ in range(n):
            if at + 4 > len(blob):
                raise ValueError("the blob ends within a row")
            (size,) = struct.unpack_from(">i", blob, at)
            at += 4
            if size < 0:
                fields.append(None)
                continue
            if at + size > len(blob):
                raise ValueError("the blob ends within a field")
            fields.append(blob[at : at + size])
            at += size
        yield fields


def _numeric(v: bytes) -> str:
    n, weight, sign, scale = struct.unpack_from(">hhHh", v)
    if sign == 0xC000:
        return "NaN"
    total = sum(Decimal(d) * Decimal(10000) ** (weight - i) for i, d in enumerate(struct.unpack_from(f">{n}h", v, 8)))
    total = Decimal(total).quantize(Decimal(1).scaleb(-scale)) if scale or n else Decimal(total)
    return f"{-total if sign == 0x4000 else total:f}"


def _stamp(v: bytes) -> int:
    (x,) = struct.unpack(">q", v)
    return x if x in (2**63 - 1, -(2**63)) else max(-(2**63), min(2**63 - 1, x + EPOCH_MICROS))


def _day(v: bytes) -> int:
    (x,) = struct.unpack(">i", v)
    return x if x in (2**31 - 1, -(2**31)) else max(-(2**31), min(2**31 - 1, x + EPOCH_DAYS))


def decode(value: bytes | None, oid: int):
    """A field by its type number; days and microseconds since 1970 as numbers, other types as text."""
    if value is None:
        return None
    plain = {16: ">?", 20: ">q", 21: ">h", 23: ">i", 700: ">f", 701: ">d", 1083: ">q"}.get(oid)
    if plain:
        return struct.unpack(plain, value)[0]
    if oid == 17:
        return value
    if oid == 1082:
        return _day(value)
    if oid in (1114, 1184):
        return _stamp(value)
    if oid == 1700:
        return _numeric(value)
    if oid == 2950:
        return str(uuid.UUID(bytes=value))
    if oid == 3802:
        return value[1:].decode()
    return value.decode("utf-8", "replace")


def date_of(days: int) -> dt.date:
    return dt.date(1970, 1, 1) + dt.timedelta(days)


# What a field becomes.
_KINDS = {16: "boolean", 17: "binary", 20: "bigint", 21: "smallint", 23: "int", 700: "float", 701: "double", 1082: "int", 1083: "bigint", 1114: "bigint", 1184: "bigint"}


def read(blobs: DataFrame, columns: list[tuple[str, int]], content: str = "content") -> DataFrame:
    """Rows of all blobs (``spark.read.format('binaryFile')``), decoded blob by blob on the executors."""
    names = [c for c, _ in columns]

    def run(batches):
        for b in batches:
            for blob in b[content]:
                part = []
                for fields in rows(bytes(blob)):
                    part.append([decode(v, o) for v, (_, o) in zip(fields, columns)])
                    if len(part) == 10_000:
                        yield pd.DataFrame(part, columns=names, dtype=object)
                        part = []
                if part:
                    yield pd.DataFrame(part, columns=names, dtype=object)

    return blobs.select(content).mapInPandas(run, ", ".join(f"`{c}` {_KINDS.get(o, 'string')}" for c, o in columns))

"""The one map from source types to lake types, and how their text forms decode.

Bad text decodes to NULL, never to an error. Date and time infinities become the extreme values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Type numbers of the source's catalogue, with the lake's types.
BY_OID = {
    16: "boolean", 17: "binary", 18: "string", 19: "string", 20: "bigint", 21: "smallint", 23: "int", 25: "string", 114: "string", 650: "string", 700: "float", 701: "double",
    869: "string", 1007: "array<int>", 1009: "array<string>", 1015: "array<string>", 1016: "array<bigint>", 1042: "string", 1043: "string", 1082: "date", 1083: "bigint",
    1114: "timestamp_ntz", 1184: "timestamp", 1700: "decimal(38,18)", 2950: "string", 3802: "string",
}
BY_NAME = {
    "bool": "boolean", "boolean": "boolean", "int2": "int", "smallint": "int", "int4": "int", "int": "int", "integer": "int", "serial": "int", "int8": "bigint", "bigint": "bigint", "bigserial": "bigint",
    "float4": "float", "real": "float", "float8": "double", "double precision": "double", "numeric": "decimal(38,18)", "decimal": "decimal(38,18)", "bytea": "binary", "date": "date", "time": "bigint",
    "timestamp": "timestamp_ntz", "timestamp without time zone": "timestamp_ntz", "timestamptz": "timestamp", "timestamp with time zone": "timestamp",
}
_NUMBER = {"smallint": r"^-?\d+$", "int": r"^-?\d+$", "bigint": r"^-?\d+$", "float": r"^(-?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|NaN|-?Infinity)$"}
_NUMBER["double"] = _NUMBER["float"]
_DECIMAL = r"^-?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def lake_type(name: str) -> str:
    """By the type's name, with or without length; arrays by a leading underscore or trailing brackets; else string."""
    n = name.strip().lower()
    if n.startswith("_"):
        return f"array<{lake_type(n[1:])}>"
    if n.endswith("[]"):
        return f"array<{lake_type(n[:-2])}>"
    head, _, rest = n.partition("(")
    tail = rest.partition(")")[2]
    return BY_NAME.get((head.strip() + (" " + tail.strip() if tail.strip() else "")).strip(), "string")


def oid_type(oid: int) -> str:
    return BY_OID.get(oid, "string")


def array_literal(text: str | None) -> list | None:
    """Elements of a one-dimensional array literal; NULL unquoted is None; None for text that is no such literal."""
    if text is None or len(text) < 2 or text[0] != "{" or text[-1] != "}":
        return None
    if text == "{}":
        return []
    out, item, quoted, inside, i = [], [], False, False, 1
    while i < len(text):
        c = text[i]
        if inside:
            if c == "\\" and i + 1 < len(text):
                i += 1
                item.append(text[i])
            elif c == '"':
                inside = False
            else:
                item.append(c)
        elif c == '"':
            inside = quoted = True
        elif c in ",}":
            s = "".join(item)
            out.append(None if not quoted and s.upper() == "NULL" else s)
            item, quoted = [], False
        elif c == "{":
            return None
        else:
            item.append(c)
        i += 1
    return None if inside else out


def _elements(text: Column) -> Column:
    of = F.pandas_udf(lambda s: s.map(lambda t: None if t is None else array_literal(t)), T.ArrayType(T.StringType()), F.PandasUDFType.SCALAR)
    return of(text)


def decode_text(value: Column, kind: str) -> Column:
    """A text column as the lake type ``kind``."""
    if kind == "boolean":
        return F.when(value.isNotNull(), value == "t")
    if kind in _NUMBER:
        return F.when(value.rlike(_NUMBER[kind]), value.try_cast(kind))
    if kind.startswith("decimal"):
        return F.when(value.rlike(_DECIMAL), value.try_cast(kind))
    if kind == "binary":
        return F.when(value.rlike(r"^\\x([0-9A-Fa-f]{2})*$"), F.unhex(F.substring(value, 3, 2_000_000_000)))
    if kind == "date":
        ends = F.when(value == "infinity", F.date_from_unix_date(F.lit(2147483647))).when(value == "-infinity", F.date_from_unix_date(F.lit(-2147483648)))
        return ends.when(value.rlike(r"^\d{4,}-\d\d-\d\d$"), value.try_cast("date"))
    if kind in ("timestamp", "timestamp_ntz"):
        ends = F.when(value == "infinity", F.timestamp_micros(F.lit(2**63 - 1))).when(value == "-infinity", F.timestamp_micros(F.lit(-(2**63)))) if kind == "timestamp" else None
        shaped = value.rlike(r"^\d{4,}-\d\d-\d\d \d\d:\d\d:\d\d(\.\d{1,6})?([+-]\d\d(:?\d\d)?)?$")
        return ends.when(shaped, value.try_cast(kind)) if ends is not None else F.when(shaped, value.try_cast(kind))
    if kind.startswith("array<"):
        inner = kind[6:-1]
        return F.transform(_elements(value), lambda x: decode_text(x, inner) if inner != "string" else x)
    return value


def struct(columns: list[tuple[str, str, bool]], pk: list[str], comments: dict[str, str] | None = None) -> T.StructType:
    """The lake's schema of (name, type name, not null) columns; keys are required, fields are numbered from 1."""
    kind = lambda n: T._parse_datatype_string(lake_type(n))
    return T.StructType(
        [T.StructField(c, kind(t), not (required or c in pk), {"field_id": i, "pk": c in pk, **({"comment": comments[c]} if comments and c in comments else {})}) for i, (c, t, required) in enumerate(columns, 1)]
    )

"""Logical replication frames: one row a message, decoded on the executors, and typed changes of committed transactions.

A frame's place in the log is ``frame_idx``. What a message needs from those before it (is it in a streamed block, to
which transaction does it belong, how did its relation look) is carried over ranges of that number: each range is
ranked by itself, and only the last value of each range meets in one task.
"""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.types import decode_text
from tidemark.operators.merge import SAME
from tidemark.plans.staged import Staged, cut

#: Frames in a range; microseconds from 1970 to the log's epoch (a fixed value).
RANGE = 1 << 16
EPOCH_MICROS = 946_684_800_000_000

SCHEMA = "frame_idx long, wal_start long, kind string, xid long, subxid long, oid long, lsn long, end_lsn long, ts long, relation string, columns array<struct<name:string,oid:int,key:boolean>>, old array<struct<kind:string,value:binary>>, new array<struct<kind:string,value:binary>>, prefix string, content binary"
_NAMES = [c.strip().split(" ")[0] for c in "frame_idx, wal_start, kind, xid, subxid, oid, lsn, end_lsn, ts, relation, columns, old, new, prefix, content".split(",")]


class _Bytes:
    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def take(self, fmt: str):
        out = struct.unpack_from(">" + fmt, self.data, self.at)
        self.at += struct.calcsize(">" + fmt)
        return out[0] if len(out) == 1 else out

    def text(self) -> str:
        end = self.data.index(0, self.at)
        out, self.at = self.data[self.at : end].decode(), end + 1
        return out

    def raw(self, n: int) -> bytes:
        if self.at + n > len(self.data):
            raise ValueError("the message ends within a value")
        out, self.at = self.data[self.at : self.at + n], self.at + n
        return out

    def tuple(self) -> list[dict]:
        out = []
        for _ in range(self.take("h")):
            kind = self.raw(1).decode()
            out.append({"kind": kind, "value": self.raw(self.take("i")) if kind in "tb" else None})
        return out


def decode(data: bytes, in_stream: bool = False) -> dict:
    """One message; inside a streamed block data messages begin with their transaction."""
    b = _Bytes(data)
    tag = b.raw(1).decode("latin-1")
    m: dict = {"kind": tag}
    if in_stream and tag in "RIUDTYM":
        m["xid"] = b.take("I")
    if tag == "B":
        m["lsn"], m["ts"], m["xid"] = b.take("QqI")
        m["ts"] += EPOCH_MICROS
    elif tag == "C":
        _, m["lsn"], m["end_lsn"], m["ts"] = b.take("BQQq")
        m["ts"] += EPOCH_MICROS
    elif tag == "R":
        m["oid"] = b.take("I")
        m["relation"] = f"{b.text()}.{b.text()}"
        b.raw(1)
        m["columns"] = []
        for _ in range(b.take("h")):
            key = b.take("B") & 1
            name, (oid, _) = b.text(), b.take("Ii")
            m["columns"].append({"name": name, "oid": oid, "key": bool(key)})
    elif tag == "I":
        m["oid"] = b.take("I")
        b.raw(1)
        m["new"] = b.tuple()
    elif tag == "U":
        m["oid"] = b.take("I")
        part = b.raw(1)
        if part in b"KO":
            m["old"] = b.tuple()
            b.raw(1)
        m["new"] = b.tuple()
    elif tag == "D":
        m["oid"] = b.take("I")
        b.raw(1)
        m["old"] = b.tuple()
    elif tag == "T":
        n, _ = b.take("iB")
        m["oids"] = [b.take("I") for _ in range(n)]
    elif tag == "O":
        m["lsn"], m["prefix"] = b.take("Q"), b.text()
    elif tag == "S":
        m["xid"], _ = b.take("IB")
    elif tag == "c":
        m["xid"], _, m["lsn"], m["end_lsn"], m["ts"] = b.take("IBQQq")
        m["ts"] += EPOCH_MICROS
    elif tag == "A":
        m["xid"], m["subxid"] = b.take("II")
    elif tag == "M":
        _, m["lsn"] = b.take("BQ")
        m["prefix"] = b.text()
        m["content"] = b.raw(b.take("i"))
    return m


def copy_data(data: bytes) -> dict:
    """The envelope: w carries a message, k a keepalive."""
    if data[:1] == b"w":
        start, end, ts = struct.unpack_from(">QQq", data, 1)
        return {"kind": "w", "wal_start": start, "wal_end": end, "ts": ts, "data": data[25:]}
    if data[:1] == b"k":
        end, ts, reply = struct.unpack_from(">QqB", data, 1)
        return {"kind": "k", "wal_end": end, "ts": ts, "reply": bool(reply)}
    raise ValueError("unknown envelope")


def status(lsn: int, micros: int, reply: bool = False) -> bytes:
    """The feedback message: written, flushed and applied up to one position."""
    return b"r" + struct.pack(">QQQqB", lsn, lsn, lsn, micros, reply)


def carried(rows: DataFrame, value: Column, name: str, by: list[str] = (), order: str = "frame_idx", size: int | None = None) -> DataFrame:
    """``name``: the last non-null ``value`` at or before each row, for each ``by``, in the order of a number.

    What comes into each range (one row a range and key) is computed at once and its lineage cut, so that ``rows`` stand
    once in the plan; a chain of these would else grow by powers of their uses.
    """
    rows = rows.withColumn("_value", value).withColumn("_range", F.expr(f"`{order}` div {size or RANGE}"))
    last = rows.groupBy(*by, "_range").agg(F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col(order))).alias("_last"))
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = cut(last.withColumn("_before", F.last("_last", ignorenulls=True).over(earlier)).drop("_last"))
    inside = F.last("_value", ignorenulls=True).over(Window.partitionBy(*by, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return rows.join(before, [*by, "_range"]).withColumn(name, F.coalesce(inside, "_before")).drop("_value", "_range", "_before")


def until(frames: DataFrame, lsn: int) -> DataFrame:
    """The frames of a bounded replay: up to the last commit that ends at or before the position."""
    tag, at = F.hex(F.substring("data", 1, 1)), lambda start: F.conv(F.hex(F.substring("data", start, 8)), 16, 10).cast("long")
    end = F.when(tag == "43", at(11)).when(tag == "63", at(15))
    last = frames.where(end <= lsn).agg(F.max("frame_idx")).first()[0]
    return frames.where(F.col("frame_idx") <= F.lit(last).cast("long"))


def read(frames: DataFrame) -> DataFrame:
    """Decode (frame_idx, wal_start, data), of one log or, with ``slot``, of several. Whether a frame stands in a streamed block follows from the last S or E before it."""
    tag = F.hex(F.substring(F.col("data"), 1, 1))
    slotted = frames if "slot" in frames.columns else frames.withColumn("slot", F.lit(""))
    marked = carried(slotted, F.when(tag == "53", F.lit(1)).when(tag == "45", F.lit(0)), "inside", ["slot"]).withColumn("inside", F.coalesce(F.col("inside"), F.lit(0)) == 1)

    def run(batches):
        for b in batches:
            out = []
            for i, start, data, streamed in zip(b.frame_idx, b.wal_start, b.data, b.inside):
                m = decode(bytes(data), bool(streamed))
                for oid in m.pop("oids", [m.get("oid")]):
                    out.append({**m, "oid": oid, "frame_idx": i, "wal_start": start})
            yield pd.DataFrame([[r.get(c) for c in _NAMES] for r in out], columns=_NAMES, dtype=object)

    return marked.select("frame_idx", "wal_start", "data", "inside").mapInPandas(run, SCHEMA)


def transactions(messages: DataFrame) -> DataFrame:
    """Messages with the transaction they belong to (the last begin before them) where none is stated."""
    begun = carried(messages, F.when(F.col("kind") == "B", F.col("xid")), "_begun")
    return begun.withColumn("xid", F.coalesce("xid", "_begun")).drop("_begun")


def with_relations(rows: DataFrame, relations: DataFrame) -> DataFrame:
    """Each row with the latest relation of its oid before it; rows of unknown relations go."""
    both = rows.unionByName(relations, allowMissingColumns=True)
    known = carried(both, F.when(F.col("kind") == "R", F.struct("relation", "columns")), "_k", ["oid"])
    return known.where(~F.col("kind").isin("R") & F.col("_k").isNotNull()).withColumn("relation", F.col("_k.relation")).withColumn("columns", F.col("_k.columns")).drop("_k")


def unknown_relations(rows: DataFrame, relations: DataFrame) -> DataFrame:
    """(oid, n): rows that are dropped because no relation message came before them."""
    kept = with_relations(rows, relations).groupBy("oid").agg(F.count("*").alias("kept"))
    n = rows.groupBy("oid").agg(F.count("*").alias("n")).join(kept, "oid", "left")
    return n.select("oid", (F.col("n") - F.coalesce("kept", F.lit(0))).alias("n")).where("n > 0")


def committed_rows(frames: DataFrame) -> DataFrame:
    """Row messages of committed transactions with relation, commit_lsn, commit_ts; aborted (sub)transactions and unfinished ones are left out.

    Frames are decoded once, into files of the shared checkpoint folder that the rows are read from.
    """
    messages = Staged(read(frames), codec="zstd").df
    of = lambda *kinds: transactions(messages.where(F.col("kind").isin("B", *kinds))).where(F.col("kind").isin(*kinds))
    ends = of("C", "c").select("xid", F.col("end_lsn").alias("commit_lsn"), F.col("ts").alias("commit_ts"))
    gone = messages.where("kind = 'A'").select(F.col("subxid").alias("xid")).distinct()
    # rows of a streamed subtransaction carry its number; its abort names both, and the top one where all is gone
    data = of("I", "U", "D").join(gone, "xid", "left_anti")
    return with_relations(data, messages.where("kind = 'R'")).drop("lsn", "end_lsn", "ts").join(ends, "xid")


def changes(rows: DataFrame, relation: str, schema: list[tuple[str, str]], audit: bool = False) -> DataFrame:
    """Typed changes of one relation: its columns, _op, _ts, _same, and (commit_lsn, frame_idx, part) to order them by.

    Values come by name from the relation as it was at that row; an update that names its old row is a delete of that
    and an update. ``_same`` lists the columns that were sent as unchanged. ``audit``: inserts only.
    """
    mine = rows.where(F.col("relation") == relation)
    side = lambda op, values, part: F.struct(F.lit(op).alias("_op"), values.alias("values"), F.lit(part).alias("part"))
    new, old = F.col("new"), F.col("old")
    sides = (
        F.when(F.col("kind") == "I", F.array(side("I", new, 1)))
        .when(F.col("kind") == "D", F.array(side("D", old, 1)))
        .when(old.isNotNull(), F.array(side("D", old, 0), side("U", new, 1)))
        .otherwise(F.array(side("U", new, 1)))
    )
    if audit:
        mine, sides = mine.where("kind = 'I'"), F.array(side("I", new, 1))
    flat = mine.select("frame_idx", "xid", "commit_lsn", "commit_ts", F.col("columns.name").alias("names"), F.explode(sides).alias("s")).select("*", "s.*").drop("s")
    value = lambda c: F.expr(f"get(values, array_position(names, '{c}') - 1)")
    return flat.select(
        *[decode_text(F.when(value(c)["kind"] == "t", value(c)["value"].cast("string")), kind).alias(c) for c, kind in schema],
        "_op",
        F.col("commit_ts").alias("_ts"),
        F.expr("transform(filter(arrays_zip(names, values), x -> x.values.kind = 'u'), x -> x.names)").alias(SAME),
        "xid",
        "commit_lsn",
        "frame_idx",
        "part",
    )


# Columns of an audit relation that schema changes are recorded in.
AUDIT = [("txn", "bigint"), ("tag", "string"), ("name", "string"), ("namespace", "string"), ("statement", "string")]


def schema_events(rows: DataFrame, relation: str) -> DataFrame:
    """(tag, namespace, name, statement, position, txn) of committed audit inserts, stamped with their commit; those without a tag are no events."""
    found = changes(rows, relation, AUDIT, audit=True)
    return found.where("tag <> ''").select("tag", F.coalesce("namespace", F.lit("public")).alias("namespace"), "name", "statement", F.col("commit_lsn").alias("position"), F.coalesce("txn", "xid").alias("txn"))

"""Training-order materialisation: a keyed Feistel permutation gives every sequence its global slot.

Documents are tokenised and packed once, and the packed rows are written to the shared checkpoint folder: each task
numbers its own sequences, so (tasks before it) + (number in the task) is a dense index. The permutation walks its
cycle until it lands inside the number of sequences, so slots are dense as well. Partitions are ranges of slots, by
arithmetic, that hold whole shards. A shard is a file of ``shard_slots`` fixed-stride records in slot order: the
number of ids (unsigned 32 bits), the ids (unsigned 16 bits each), padding, and a line feed. Slot s stands in shard
s div ``shard_slots`` at byte (s mod ``shard_slots``) x stride, so a reader resumes at any slot by arithmetic alone.

Shards are written by Spark's own writer with its commit protocol, so they may lie in any file system that Spark
reaches, and a lost executor or repeated task leaves whole files only. The order depends on the key and on how the
reader splits the files; it is fixed once the packed rows are written.

Nulls: a null text is an empty document, null doc_ids are kept. Repeated rows are sequences of their own. Very long
texts are many sequences. An empty table gives no slots. Extra columns are ignored.
"""

from __future__ import annotations

import re
import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Staged, checkpoint_folder, ship, shuffle_width, trim
from tidemark.llm.packing import CAPACITY, GROUP, placed_again, windows_of

ROUNDS = 4
SHARD_SLOTS = 1024
PAD_ID = 0
_HEAD, _TAIL = 4, b"\n"


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    x = (x + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def feistel(index: np.ndarray, size: int, key: int, rounds: int = ROUNDS) -> np.ndarray:
    """The slots of the indexes under a permutation of range(size) that the key fixes."""
    half = np.uint64(max(1, (max(size - 1, 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    out = np.asarray(index, np.uint64).copy()
    walking = np.ones(len(out), bool)
    with np.errstate(over="ignore"):
        while walking.any():
            x = out[walking]
            left, right = x >> half, x & mask
            for r in range(rounds):
                left, right = right, left ^ (_mix(right, (key * 0x2545F4914F6CDD1D + r * 0x632BE59BD9B4E019) & (2**64 - 1)) & mask)
            out[walking] = (left << half) | right
            walking[walking] = out[walking] >= size
    return out.astype(np.int64)


def stride(capacity: int = CAPACITY) -> int:
    return _HEAD + 2 * capacity + len(_TAIL)


def _record(capacity: int):
    """Without its line feed, which the writer adds."""
    byte = lambda c: F.lpad(F.hex(c.cast("long")), 2, "0")
    head = F.unhex(F.concat(*[byte(F.expr(f"shiftright(octet_length(ids) div 2, {8 * i}) & 255")) for i in range(_HEAD)]))
    return F.concat(head, F.rpad(F.col("ids"), 2 * capacity, F.lit(PAD_ID.to_bytes(1, "little"))))


_PACKED = "task long, number long, owners array<long>, starts array<long>, lengths array<long>, ids binary"


def sequences(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """Packed sequences (task, number, owners, starts, lengths, ids as unsigned 16-bit bytes), numbered densely within a task; groups of open windows count as tasks of their own."""
    found = windows_of(docs, capacity, path, True)

    def again(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        trim()
        out = [((1 << 40) + int(key[0]), i, [p[0] for p in w], [p[1] for p in w], [len(p[2]) for p in w], b"".join(p[2].tobytes() for p in w)) for i, w in enumerate(placed_again(rows, capacity))]
        return pd.DataFrame(out, columns=[c.split()[0] for c in _PACKED.split(", ")])

    placed = Staged(found.df.where("not full").groupBy(F.expr(f"task div {GROUP}").alias("g")).applyInPandas(again, _PACKED), codec="zstd").df
    found.drop("full=false")
    return found.df.where("full").select(*placed.columns).unionByName(placed)


def materialise(docs: DataFrame, key: int = 20_240_601, capacity: int = CAPACITY, shard_slots: int = SHARD_SLOTS, path: str | None = None) -> tuple[DataFrame, int]:
    """((slot, shard, byte_offset, doc_ids, starts, lengths, ids), number of slots).

    The driver gets one count for each task that packed, never rows of sequences. Full windows are numbered before
    open ones, so the largest number of a task's full windows counts them.
    """
    packed = sequences(docs, capacity, path)
    counts = packed.groupBy("task").agg((F.max("number") + 1).alias("n")).orderBy("task").collect()
    tasks = np.array([r.task for r in counts], np.int64)
    before = np.concatenate(([0], np.cumsum([r.n for r in counts], dtype=np.int64))) if counts else np.zeros(1, np.int64)
    size = int(before[-1])

    @F.pandas_udf("long")
    def slot(task, number):
        trim()
        return pd.Series(feistel(before[np.searchsorted(tasks, task.to_numpy())] + number.to_numpy(), size, key))

    ordered = packed.withColumn("slot", slot("task", "number")).select(
        "slot",
        F.expr(f"slot div {shard_slots}").alias("shard"),
        (F.col("slot") % shard_slots * stride(capacity)).alias("byte_offset"),
        F.col("owners").alias("doc_ids"),
        "starts",
        "lengths",
        "ids",
    )
    return ordered, size


def write_shards(ordered: DataFrame, size: int, folder: str, capacity: int = CAPACITY, shard_slots: int = SHARD_SLOTS) -> int:
    """Write the shards below ``folder``; the number of shards in each range (a partition's files)."""
    shards = max(1, -(-size // shard_slots))
    parts = min(max(shuffle_width(ordered.sparkSession), 1), shards)
    each = -(-shards // parts)

    (
        ordered.select("slot", "ids")
        .repartitionById(-(-shards // each), F.expr(f"int(slot div {shard_slots * each})"))
        .sortWithinPartitions("slot")
        .select(_record(capacity).cast("string").alias("value"))
        .write.option("maxRecordsPerFile", shard_slots)
        .text(folder)
    )
    return each


_NAME = re.compile(r"part-(\d+)-.*-c(\d+)")


def read_slots(spark: SparkSession, folder: str, each: int, capacity: int = CAPACITY, shard_slots: int = SHARD_SLOTS, with_ids: bool = True) -> DataFrame:
    """(slot, shard, byte_offset, n_ids, ids_crc32, and ``with_ids`` ids) of the records of all shards."""
    wide = stride(capacity)
    names = ["slot", "shard", "byte_offset", "n_ids", "ids_crc32", *(["ids"] if with_ids else [])]

    def run(batches):
        trim()
        for b in batches:
            for name, data in zip(b.column("path").to_pylist(), b.column("content")):
                part, file = map(int, _NAME.search(name).groups())
                shard, data = part * each + file, memoryview(data.as_buffer())
                # a shard is cut in steps, so that a batch stays small
                for at in range(0, len(data), 256 * wide):
                    places = range(at, min(at + 256 * wide, len(data)), wide)
                    ids = [data[i + _HEAD : i + _HEAD + 2 * int.from_bytes(data[i : i + _HEAD], "little")] for i in places]
                    first = shard * shard_slots + at // wide
                    cols = [range(first, first + len(ids)), [shard] * len(ids), places, [len(x) // 2 for x in ids], [zlib.crc32(x) for x in ids]]
                    arrays = [pa.array(c, pa.int64()) for c in cols] + ([pa.array(map(bytes, ids), pa.binary())] if with_ids else [])
                    yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = ", ".join(f"{n} {'binary' if n == 'ids' else 'long'}" for n in names)
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("path", "content").mapInArrow(run, schema)


def digest(docs: DataFrame, key: int = 20_240_601, capacity: int = CAPACITY, shard_slots: int = SHARD_SLOTS, path: str | None = None, folder: str | None = None) -> DataFrame:
    """Shards written to ``folder`` (default: a new one in the shared checkpoint folder) and read back: (slot, shard, byte_offset, n_ids, ids_crc32 of the unsigned 16-bit ids)."""
    spark = docs.sparkSession
    ship(spark)
    checkpoint_folder(spark)
    folder = folder or f"{spark.sparkContext.getCheckpointDir()}/shards-{uuid.uuid4().hex}"
    ordered, size = materialise(docs, key, capacity, shard_slots, path)
    each = write_shards(ordered, size, folder, capacity, shard_slots)
    return read_slots(spark, folder, each, capacity, shard_slots, with_ids=False)

"""Sum-of-squares online packing of token sequences.

Each remainder of a document (its whole windows are cut off first) goes to the fill level that minimises the sum of
squared counts of partly filled windows; the counts stand in an array by level. Each task packs the documents it
reads and holds open windows only. Those that are open at its end are placed once more, as they are, by the same
rule: the windows of 8 tasks meet in a group, so how many sequences are packed by the rule does not hang on how
the reader splits its files. What is open after that is laid end to end into whole windows, and the last remainder
of a group becomes sequences whose lengths are powers of two, which need no padding.

Full windows need their ids no more and are written as rows of pieces at once; only open windows carry ids. Both
are written to the shared checkpoint folder, so a lost executor can't change sequences that others have seen.

Nulls: a null text is an empty document (the end id alone), a null doc_id is kept. Repeated rows are packed each.
Ties go to the fullest level. An empty table gives no pieces. Extra columns are ignored. Very long texts only give
more windows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import tokens
from tidemark.llm.common import Staged, few_at_once, ship

CAPACITY = 2048
#: Tasks whose open windows meet.
GROUP = 8
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]


class SquarePacker:
    """Windows of ``capacity``; a piece is (owner, start, ids, owner's token count)."""

    def __init__(self, capacity: int = CAPACITY):
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, np.int64)
        self.open: dict[int, list[list]] = {}

    def level(self, size: int) -> int:
        """The fill level (0: a new window) at which adding ``size`` raises the sum of squares least; ties to the fullest."""
        levels = np.concatenate(([0], np.flatnonzero(self.counts[: self.capacity - size + 1])))
        after = levels + size
        change = np.where(after < self.capacity, 2 * self.counts[after] + 1, 0) - np.where(levels > 0, 2 * self.counts[levels] - 1, 0)
        return int(levels[len(change) - 1 - np.argmin(change[::-1])])

    def place(self, pieces: list, size: int) -> Iterator[list]:
        """Pieces of ``size`` tokens together, under the capacity, go to a window; yields it if it becomes full."""
        at = self.level(size)
        window = []
        if at:
            window = self.open[at].pop()
            self.counts[at] -= 1
        window.extend(pieces)
        if at + size == self.capacity:
            yield window
        else:
            self.open.setdefault(at + size, []).append(window)
            self.counts[at + size] += 1

    def add(self, owner, ids: np.ndarray) -> Iterator[list]:
        """Yields each window that becomes full."""
        n, c = len(ids), self.capacity
        for s in range(0, n - n % c, c):
            yield [(owner, s, ids[s : s + c], n)]
        if size := n % c:
            yield from self.place([(owner, n - size, ids[n - size :], n)], size)

    def windows(self) -> Iterator[list]:
        """The open windows, fullest first."""
        for at in sorted(self.open, reverse=True):
            yield from self.open[at]
        self.open.clear()
        self.counts[:] = 0

    def flush(self) -> Iterator[list]:
        """The open windows laid end to end; what is left over is cut to powers of two."""
        pieces = [p for w in self.windows() for p in w]
        left = sum(len(p[2]) for p in pieces)
        window, room = [], 0
        for owner, start, ids, n in pieces:
            while len(ids):
                if not room:
                    room = self.capacity if left >= self.capacity else 1 << (left.bit_length() - 1)
                part = ids[:room]
                window.append((owner, start, part, n))
                start, ids, room, left = start + len(part), ids[len(part) :], room - len(part), left - len(part)
                if not room:
                    yield window
                    window = []


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def gathered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The rows in batches of ``size`` bytes or more, as far as there are so many."""
    held = []
    for b in batches:
        held.append(b)
        if sum(x.nbytes for x in held) >= size:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def windows_of(docs: DataFrame, capacity: int, path: str | None, with_ids: bool) -> Staged:
    """The windows of each task, full and open ones apart: (task, number, full, owners, starts, totals, lengths, crcs, ids).

    ``ids`` holds unsigned 16-bit ids, of full windows only ``with_ids``. Rows are staged, so numbers are fixed.
    """
    ship(docs.sparkSession)
    longs = pa.list_(pa.int64())
    kinds = {"task": pa.int64(), "number": pa.int64(), "full": pa.bool_(), "owners": longs, "starts": longs, "totals": longs, "lengths": longs, "crcs": longs, "ids": pa.binary()}

    def run(batches):
        from pyspark import TaskContext

        encode, packer, task, rows, number = tokens.tokenizer(path).encode_all, SquarePacker(capacity), TaskContext.get().partitionId(), [], 0

        def take(windows, full=True):
            nonlocal number
            for w in windows:
                ids = b"".join(p[2].tobytes() for p in w) if with_ids or not full else None
                rows.append((task, number, full, [p[0] for p in w], [p[1] for p in w], [p[3] for p in w], [len(p[2]) for p in w], [crc(p[2]) for p in w] if full and not with_ids else None, ids))
                number += 1

        def out():
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds.values())], names=list(kinds))
            rows.clear()
            return batch

        for b in gathered(batches, tokens.GROUP_BYTES):
            for doc, ids in zip(b.column(0).to_pylist(), encode(b.column(1))):
                take(packer.add(doc, ids))
                if len(rows) >= 2000:
                    yield out()
        take(packer.windows(), full=False)
        if rows:
            yield out()

    names = {pa.int64(): "long", pa.bool_(): "boolean", pa.binary(): "binary", longs: "array<long>"}
    with few_at_once(docs.sparkSession):
        return Staged(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, ", ".join(f"{n} {names[k]}" for n, k in kinds.items())), "full", "zstd")


def placed_again(rows: pd.DataFrame, capacity: int) -> Iterator[list]:
    """The windows of a group of tasks, placed by the rule, then laid end to end."""
    packer = SquarePacker(capacity)
    for r in rows.sort_values(["task", "number"]).itertuples():
        ids, at, pieces = np.frombuffer(r.ids, "<u2"), 0, []
        for owner, start, n, size in zip(r.owners, r.starts, r.totals, r.lengths):
            pieces.append((None if owner is None or owner != owner else int(owner), int(start), ids[at : at + size], int(n)))
            at += size
        yield from packer.place(pieces, at)
    yield from packer.flush()


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """Pieces of all documents (doc_id, text) in sequences of at most ``capacity`` tokens.

    sequence_id carries the task's number above bit 40 (the group's, with bit 62 set, where windows were placed again).
    """
    found = windows_of(docs, capacity, path, False).df
    zipped = F.expr("arrays_zip(owners, starts, lengths, crcs, totals, offsets)")
    offsets = F.expr("transform(sequence(0, size(lengths) - 1), i -> aggregate(slice(lengths, 1, i), 0L, (a, x) -> a + x))")
    done = found.where("full").withColumn("offsets", offsets).select(F.expr("shiftleft(task, 40) + number").alias("id"), F.explode(zipped).alias("p"))
    done = done.select(*[F.col(f"p.{c}").alias(n) for c, n in zip(("owners", "starts", "lengths", "crcs", "totals"), _COLUMNS)], F.col("id").alias("sequence_id"), F.col("p.offsets").alias("offset"))

    def again(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for number, window in enumerate(placed_again(rows, capacity)):
            at = 0
            for owner, start, ids, n in window:
                out.append((owner, start, len(ids), crc(ids), n, (1 << 62) + (int(key[0]) << 40) + number, at))
                at += len(ids)
        return pd.DataFrame(out, columns=_COLUMNS).astype({c: "Int64" for c in _COLUMNS})

    return done.unionByName(found.where("not full").drop("crcs").groupBy(F.expr(f"task div {GROUP}").alias("g")).applyInPandas(again, SCHEMA))

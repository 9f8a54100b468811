"""Exact repeats of at least ``LENGTH`` bytes by a sparse, distributed suffix array; deep-shallow sorting.

Every byte covered by a 200-byte string that starts anywhere else too is removed. Such a string holds at least
one of the 32-byte grams that are least within some window of 169 grams (winnowing), and its other occurrences
hold the same gram at the same place, so only suffixes at those anchors are sorted. Anchors whose gram occurs
once have no partner and go. An anchor's context is the 168 bytes to its left and 200 to its right: where equal
contexts meet (by hash, counted, never gathered) all of it is covered, and one of them stands for all from there
on. The rest meet by gram (the first 32 bytes sorted). Within a group the right sides are ordered by multikey quicksort to a shallow depth, and
groups that are still equal there by blind tries, which also give the common prefixes; a node of depth r of that
tree holds for each member the longest common left side l within the node, and where l + r reaches 200 the bytes
from l before to r after the anchor are covered.

A gram of very many contexts is split by what stands around it: the 169 offsets that a window may have around it
are four ranges, and all windows of a range share a core of some 158 bytes. Members meet by the core's hash, one
row a range, and cores that occur once go. Members of a core that is still frequent, and that are equal as far as
its range's windows reach, cover each other (by 128-bit hashes, counted), and one of them goes on; if too many do, the
bytes that all of them share (those that the least and the greatest side share) settle the windows within them, and what
is left of the range below and above those is taken by cores that hold the byte at which members differ, until few meet or, at one offset, a core is the window itself. A member has a row for
each side of such a passage, not one a window; this is exact too, and no group is gathered in one task. Texts leave the scan, to be joined with their
contexts or with what is covered, only if a bounded filter lets them through. Equal texts are one text for the search; with
two or more copies all windows of a text repeat, so it goes whole.

A null text is empty. A null doc_id is kept. Rows that repeat id and text are copies of each other. Long texts
are taken whole. An empty table gives no rows; ``remove`` carries extra columns.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import rolling
from tidemark.llm.common import KeyFilter, Staged, cut, put_back, set_aside, ship, shuffle_width, skewed_lookup, trim

LENGTH = 200
GRAM = 32
SPAN = LENGTH - GRAM + 1
#: Depth to which strings are ordered by multikey quicksort, and members of a gram or core that meet in one task (under 1 MB).
SHALLOW = 64
BLOCK = 2048
#: Parts that a frequent gram's window offsets are split into; (first, last) offset of each.
PARTS = 4
RANGES = [(SPAN * i // PARTS, SPAN * (i + 1) // PARTS - 1) for i in range(PARTS)]
#: Turns in which a range of a frequent core is cut only where its members differ; later ones halve it as well, which bounds their number.
WHOLE_TURNS = 2
_WHOLE = 1 << 40


def _sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """best over each run of ``width`` values, by block prefixes and suffixes."""
    n = len(x)
    fill = np.uint64(2**64 - 1) if best is np.minimum else np.uint64(0)
    blocks = np.concatenate((x, np.full((-n) % width, fill, np.uint64))).reshape(-1, width)
    before = best.accumulate(blocks, 1).ravel()
    after = best.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return best(after[: n - width + 1], before[width - 1 : n])


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, grams' hashes and contexts' hashes of the grams that are least in some window of SPAN grams (all of them, where equal)."""
    n = len(data) - GRAM + 1
    if n < SPAN:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    at = np.arange(n)
    sums = rolling.prefix(data)
    h = rolling.spans(sums, at, at + GRAM)
    least = _sliding(h, SPAN, np.minimum)
    pad = np.zeros(SPAN - 1, np.uint64)
    reach = _sliding(np.concatenate((pad, least, pad)), SPAN, np.maximum)
    chosen = np.flatnonzero(reach == h)
    first = np.maximum(chosen - SPAN + 1, 0)
    around = rolling.spans(sums, first, np.minimum(chosen + LENGTH, len(data)))
    with np.errstate(over="ignore"):
        around = rolling.mix(around + (chosen - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return chosen, h[chosen], around


def common(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix, known to be at least ``start``."""
    n = min(len(a), len(b))
    if a[start:n] == b[start:n]:
        return n
    lo, hi = start, n
    while hi - lo > 8:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    while a[lo] == b[lo]:
        lo += 1
    return lo


class BlindTrie:
    """Orders strings by the bytes at which they branch; a node is [depth, {byte: child}, a string of its own], a leaf a list of numbers.

    A string descends blindly by the branching bytes alone, is compared with the one string it meets, and
    then hangs where the two part.
    """

    def __init__(self, strings: list[bytes], known: int):
        self.strings, self.known, self.root = strings, known, None

    def insert(self, i: int) -> None:
        s = self.strings[i]
        if self.root is None:
            self.root = (None, [i])
            return
        node = self.root
        while node[0] is not None:
            byte = s[node[0]] if node[0] < len(s) else -1
            node = node[1].get(byte) or next(iter(node[1].values()))
        other = self.strings[node[1][0]]
        depth = common(s, other, min(self.known, len(s), len(other)))
        if depth == len(s) == len(other):
            node[1].append(i)
            return
        parent, key, node = None, None, self.root
        while node[0] is not None and node[0] < depth:
            parent, key = node, (s[node[0]] if node[0] < len(s) else -1)
            node = node[1][key]
        byte = s[depth] if depth < len(s) else -1
        if node[0] == depth:
            node[1][byte] = (None, [i])
            return
        old = other[depth] if depth < len(other) else -1
        split = (depth, {byte: (None, [i]), old: node})
        if parent is None:
            self.root = split
        else:
            parent[1][key] = split

    def walk(self, order: list[int], lcps: list[int]) -> None:
        """Append the order, and each string's common prefix with the one before it within this trie."""
        stack = [(self.root, None)]
        while stack:
            node, shared = stack.pop()
            if node[0] is None:
                for j, i in enumerate(node[1]):
                    order.append(i)
                    lcps.append(len(self.strings[i]) if j else shared)
                continue
            for j, byte in reversed(list(enumerate(sorted(node[1])))):
                stack.append((node[1][byte], node[0] if j else shared))


def deep_shallow(strings: list[bytes], known: int = 0, shallow: int = SHALLOW) -> tuple[list[int], list[int]]:
    """(order, common prefix with the one before; 0 for the first) of strings that share ``known`` bytes."""
    order: list[int] = []
    lcps: list[int] = []
    stack = [(list(range(len(strings))), known)]
    while stack:
        group, depth = stack.pop()
        if len(group) == 1:
            order += group
            lcps.append(-1)
            continue
        if depth >= shallow:
            trie = BlindTrie(strings, depth)
            for i in group:
                trie.insert(i)
            mark = len(lcps)
            trie.walk(order, lcps)
            lcps[mark] = -1
            continue
        pivot = strings[group[len(group) // 2]][depth : depth + 8]
        less, equal, more = [], [], []
        for i in group:
            w = strings[i][depth : depth + 8]
            (equal if w == pivot else less if w < pivot else more).append(i)
        if more:
            stack.append((more, depth))
        if len(pivot) == 8:
            stack.append((equal, depth + 8))
        else:
            stack.append((equal, shallow))
        if less:
            stack.append((less, depth))
    for j, x in enumerate(lcps):
        if x is None or x < 0:
            lcps[j] = common(strings[order[j - 1]], strings[order[j]], known) if j else 0
    return order, lcps


def reach(lefts: list[bytes], rights: list[bytes], known: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """For each member (left side reversed, right side): how far it is covered to the left and right of its anchor, (0, 0) if not at all."""
    n = len(lefts)
    if n == 2:
        r, le = common(rights[0], rights[1], known), common(lefts[0], lefts[1])
        return [(le, r)] * 2 if le + r >= length else [(0, 0)] * 2
    out = [(0, 0)] * n
    order, lcps = deep_shallow(rights, known)
    by_left = sorted(range(n), key=lefts.__getitem__)
    rank = [0] * n
    for j, i in enumerate(by_left):
        rank[i] = j
    stack = [(0, n)]
    while stack:
        a, b = stack.pop()
        r = min(lcps[a + 1 : b])
        # the longest common left side of each member within the node: that with a neighbour in left order
        members = sorted(order[a:b], key=rank.__getitem__)
        before = 0
        for j, i in enumerate(members):
            after = common(lefts[i], lefts[members[j + 1]]) if j + 1 < len(members) else 0
            le = max(before, after)
            before = after
            if le + r >= length:
                out[i] = (max(out[i][0], le), max(out[i][1], r))
        if r >= length:
            continue
        start = a
        for j in range(a + 1, b + 1):
            if j == b or lcps[j] == r:
                if j - start > 1:
                    stack.append((start, j))
                start = j
    return out


def _solve(rows: list[tuple]) -> list[tuple]:
    """Covered intervals (ra, rb, start, end) of members (ra, rb, pos, left side reversed, right side).

    Members whose sides are equal all through match each other as far as these reach; one stands for them.
    """
    if len(grams := {r[4][:GRAM] for r in rows}) > 1:  # two grams of one hash
        return [c for g in grams for c in _solve([r for r in rows if r[4][:GRAM] == g])]
    covered = []
    alike: dict[tuple, list] = {}
    for ra, rb, pos, left, right in rows:
        alike.setdefault((left, right), []).append((ra, rb, pos))
    sides = list(alike)
    found = reach([x[0] for x in sides], [x[1] for x in sides], GRAM) if len(sides) > 1 else [(0, 0)]
    for (left, right), (le, r) in zip(sides, found):
        members = alike[left, right]
        if len(members) > 1 and len(left) + len(right) >= LENGTH:
            le, r = len(left), len(right)
        if r:
            covered.extend((ra, rb, pos - le, pos + r) for ra, rb, pos in members)
    return covered


def _places(texts, fa: np.ndarray, ra: np.ndarray, rb: np.ndarray):
    """(gram, context, fa, ra, rb, pos) of each anchor of each text."""
    found = [anchors(np.frombuffer(t.as_buffer(), np.uint8)) for t in texts]
    owner = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
    pos, gram, context = (np.concatenate(x) for x in zip(*found))
    cols = [gram.view(np.int64), context.view(np.int64), fa[owner], ra[owner], rb[owner], pos]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in cols], names=["gram", "context", "fa", "ra", "rb", "pos"])


def _keyed(docs: DataFrame) -> DataFrame:
    """The documents with their row's fingerprint (ra, rb); a null text is empty."""
    text = F.coalesce("text", F.lit(""))
    return docs.withColumn("ra", F.xxhash64("doc_id", text)).withColumn("rb", F.xxhash64(F.lit(0x5DEECE66D), "doc_id", text)).withColumn("text", text)


def spans(row: DataFrame) -> DataFrame:
    """(ra, rb, start, stop) of covered bytes of keyed documents."""
    spark = row.sparkSession
    ship(spark)
    width = shuffle_width(spark)
    long = row.where(F.octet_length("text") >= LENGTH)
    # one row stands for all equal texts; texts with copies go whole
    marks = long.select("ra", "rb", F.xxhash64("text").alias("fa"), F.xxhash64(F.lit(0x5DEECE66D), "text").alias("fb"))
    texts = cut(marks.groupBy("fa", "fb").agg(F.min(F.struct("ra", "rb")).alias("one"), F.count("*").alias("n")))
    # rows that repeat id and text have one fingerprint
    whole = cut(skewed_lookup(marks, texts.where("n > 1").select("fa", "fb", "n"), ["fa", "fb"], _spread("ra")).select("ra", "rb", F.lit(0).cast("long").alias("start"), F.lit(_WHOLE).alias("stop")).distinct())

    def emit(batches):
        for b in batches:
            texts = b.column("text").cast(pa.binary())
            for s in range(0, b.num_rows, 500):
                yield _places(texts[s : s + 500], *(b.column(c).to_numpy()[s : s + 500] for c in ("fa", "ra", "rb")))
        trim()

    found = Staged(long.select("ra", "rb", F.xxhash64("text").alias("fa"), "text").mapInArrow(emit, "gram long, context long, fa long, ra long, rb long, pos long"))
    # of copies' anchors, text and place are the same
    mark = F.xxhash64("fa", "pos")
    repeated = cut(found.df.select("gram", mark.alias("mark")).groupBy("gram").agg(F.count("*").alias("n"), F.min("mark").alias("lo"), F.max("mark").alias("hi")).where("lo <> hi").select("gram", "n"))
    held = KeyFilter(repeated.select("gram"), repeated.count())
    live = skewed_lookup(found.df.drop("fa").where(held.may_hold(F.col("gram"))), repeated, ["gram"], _spread("ra", "pos"))
    live = Staged(live.join(texts.select(F.col("one.ra").alias("ra")).distinct(), "ra", "left_semi"))
    found.drop()
    contexts = Staged(live.df.groupBy("gram", "context").agg(F.count("*").alias("n"), F.min(F.struct("ra", "rb", "pos")).alias("one")))
    equal = skewed_lookup(live.df, contexts.df.where("n > 1").select("gram", "context", "n"), ["gram", "context"], _spread("ra", "pos"))
    equal = cut(equal.select("ra", "rb", F.greatest(F.col("pos") - (SPAN - 1), F.lit(0)).alias("start"), (F.col("pos") + LENGTH).alias("stop")))
    live.drop()
    groups = contexts.df.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").withColumn("size", F.col("n"))
    met = Staged(skewed_lookup(contexts.df.select("gram", "one.ra", "one.rb", "one.pos"), groups, ["gram"], F.xxhash64("ra", "pos")).withColumns({"core": F.lit(0).cast("long"), "first": F.lit(0), "last": F.lit(SPAN - 1)}))
    contexts.drop()
    size = F.col("size")
    frequent = met.df.where(size > BLOCK).drop("size")
    covered, asked = whole.unionByName(equal), met.df.where(size <= BLOCK).select(*_ASKED)
    if split := not frequent.isEmpty():
        cores = Staged(_split(row, frequent))
        asked = asked.unionByName(cores.df.where(size <= BLOCK).select(*_ASKED))
    sides = _sides(row, asked)
    if split:
        found, few, kept = _narrow(_sides(row, cores.df.where(size > BLOCK).select(*_ASKED)))
        covered, sides = covered.unionByName(found), sides.unionByName(few)
    solved = cut(sides.repartition(width, "gram", "core", "first").sortWithinPartitions("gram", "core", "first").mapInArrow(_solve_sorted, _ddl(_SOLVED)))
    met.drop()
    for staged in [cores, *kept] if split else []:
        staged.drop()
    return covered.unionByName(solved)


_ASKED = ["gram", "core", "first", "last", "ra", "rb", "pos"]


def _spread(*cols: str):
    """What rows are dealt by; repeated rows differ in the partition that they come from."""
    return F.xxhash64(*cols, F.spark_partition_id())


_SIDES = [("gram", pa.int64()), ("core", pa.int64()), ("ra", pa.int64()), ("rb", pa.int64()), ("pos", pa.int64()), ("prior", pa.binary()), ("after", pa.binary()), ("first", pa.int32()), ("last", pa.int32())]
_SOLVED = [("ra", pa.int64()), ("rb", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())]
_CORES = [("gram", pa.int64()), ("core", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("ra", pa.int64()), ("rb", pa.int64()), ("pos", pa.int64())]


def _ddl(fields) -> str:
    return ", ".join(f"{n} { {pa.int64(): 'long', pa.int32(): 'int', pa.binary(): 'binary'}[k]}" for n, k in fields)


def _batch(rows: list[tuple], fields) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*rows), fields)], names=[n for n, _ in fields])


def _with_places(row: DataFrame, asked: DataFrame, columns: list[str]) -> DataFrame:
    """(ra, rb, text, at) of the texts that ``asked`` has places of, one row each."""
    of_text = cut(asked.groupBy("ra", "rb").agg(F.collect_list(F.struct(*columns)).alias("at")))
    held = KeyFilter(of_text.select(F.xxhash64("ra", "rb").alias("h")), of_text.count())
    return row.where(held.may_hold(F.xxhash64("ra", "rb"))).select("ra", "rb", "text").dropDuplicates(["ra", "rb"]).join(of_text, ["ra", "rb"]).select("ra", "rb", "text", "at")


def _slices(batches, rows: int = 256):
    """The columns of some rows at a time as lists: Python's objects take many times what Arrow's take."""
    for b in batches:
        for s in range(0, b.num_rows, rows):
            part = b.slice(s, rows)
            yield [part.column(n).cast(pa.binary()).to_pylist() if n == "text" else part.column(n).to_pylist() for n in b.schema.names]


def _mapped(of, fields):
    """A mapInArrow function that yields ``of(ra, rb, text, places)`` of each row (ra, rb, text, at)."""

    def run(batches):
        out: list[tuple] = []
        for columns in _slices(batches):
            for row in zip(*columns):
                out.extend(of(*row))
                if len(out) > 20_000:
                    yield _batch(out, fields)
                    out = []
        if out:
            yield _batch(out, fields)
        trim()

    return run


def _sides(row: DataFrame, asked: DataFrame) -> DataFrame:
    """Each asked place with its sides, as far as its range of offsets needs them."""

    def sides(ra, rb, t, at):
        for x in at:
            p, first, last = x["pos"], x["first"], x["last"]
            yield x["gram"], x["core"], ra, rb, p, t[max(0, p - last) : p][::-1], t[p : p + LENGTH - first], first, last

    return _with_places(row, asked, ["gram", "pos", "core", "first", "last"]).mapInArrow(_mapped(sides, _SIDES), _ddl(_SIDES))


def _solve_sorted(batches):
    key, group, out = None, [], []

    def close():
        if len(group) > 1:
            out.extend(_solve(group))

    for b in batches:
        cols = [b.column(n).to_pylist() for n in ("gram", "core", "first", "ra", "rb", "pos", "prior", "after")]
        for gram, core, first, *rest in zip(*cols):
            if (gram, core, first) == key:
                group.append(tuple(rest))
            else:
                close()
                key, group = (gram, core, first), [tuple(rest)]
            if len(out) > 20_000:
                yield _batch(out, _SOLVED)
                out.clear()
    close()
    if out:
        yield _batch(out, _SOLVED)
    trim()


def _narrow(sides: DataFrame) -> tuple[DataFrame, DataFrame, list[Staged]]:
    """Of members of frequent cores: what is covered (ra, rb, start, stop), and the members, with longer cores, that are few enough to meet; files to drop then."""
    names = [n for n, _ in _SIDES]
    core, reached = ["gram", "core", "first"], (F.octet_length("prior"), F.octet_length("after"))
    here = Staged(sides)
    kept, covered, few = [], [], []
    while True:
        extent = F.unhex(F.md5(F.concat(reached[0].cast("string").cast("binary"), F.lit(b":"), "prior", "after")))
        members = here.df.withColumn("extent", extent)
        one = F.min(F.struct("ra", "rb", "pos")).alias("one")
        extents = Staged(members.groupBy(*core, "last", "extent").agg(F.count("*").alias("n"), one, F.first("prior").alias("prior"), F.first("after").alias("after")))
        equal = members.select(*core, "extent", "ra", "rb", "pos", (F.col("pos") - reached[0]).alias("start"), (F.col("pos") + reached[1]).alias("stop"))
        equal = skewed_lookup(equal.where(F.col("stop") - F.col("start") >= LENGTH), extents.df.where("n > 1").select(*core, "extent", "n"), [*core, "extent"], F.xxhash64("ra", "pos"))
        covered.append(cut(equal.select("ra", "rb", "start", "stop")))
        here.drop()
        # at one offset the core is the window: what is equal is covered, and nothing else meets
        groups = extents.df.where("first < last").groupBy(*core).agg(F.count("*").alias("n")).where("n > 1").withColumn("size", F.col("n"))
        met = Staged(skewed_lookup(extents.df.select(*core, "last", "one.*", "prior", "after"), groups, core, F.xxhash64("ra", "pos")))
        extents.drop()
        kept.append(met)
        few.append(met.df.where(F.col("size") <= BLOCK).select(*names))
        many = met.df.where(F.col("size") > BLOCK).drop("size")
        if many.isEmpty():
            break
        many = _with_shared(many, core)
        shared = many.where(F.col("left") + F.col("right") >= LENGTH)
        covered.append(cut(shared.select("ra", "rb", (F.col("pos") - F.col("left")).alias("start"), (F.col("pos") + F.col("right")).alias("stop"))))
        here = Staged(_parted(many, 1 if len(kept) <= WHOLE_TURNS else 2))
    return reduce(DataFrame.unionByName, covered), reduce(DataFrame.unionByName, few), kept


def _with_shared(members: DataFrame, core: list[str]) -> DataFrame:
    """The members with the bytes that all of their core share to the left and right of their anchors: what its least and greatest side share."""

    @F.pandas_udf("int")
    def alike(a, b):
        import pandas as pd

        return pd.Series([common(x, y) for x, y in zip(a, b)], dtype="int32")

    ends = members.groupBy(*core).agg(F.count("*").alias("n"), *[f(c).alias(f"{n}_{c}") for c in ("prior", "after") for n, f in (("least", F.min), ("most", F.max))])
    shared = ends.select(*core, "n", alike("least_prior", "most_prior").alias("left"), alike("least_after", "most_after").alias("right"))
    return skewed_lookup(members, shared, core, F.xxhash64("ra", "pos"))


def _parted(members: DataFrame, pieces: int) -> DataFrame:
    """Members once for each part of their range of offsets that is open and has a core in their text, with that core and sides as far as the part needs them.

    The windows within what all members share are covered. Those below them reach beyond it to the right and those
    above to the left, so either part's core holds a byte at which members differ. Each is cut into ``pieces``.
    """
    middle = f"greatest(least((first + last) div 2, {LENGTH - 1} - right), left)"
    low = f"least(greatest(if(left + right >= {LENGTH}, {LENGTH - 1} - right, {middle}), first - 1), last)"
    high = f"greatest(if(left + right >= {LENGTH}, left, {middle}) + 1, first)"
    edge = lambda a, b, i: F.expr(f"{a} + ({b} - {a} + 1) * {i} div {pieces}").cast("int")
    parts = F.array(*[F.struct(edge(a, b, i).alias("first"), (edge(a, b, i + 1) - 1).alias("last")) for a, b in (("first", "low"), ("high", "last")) for i in range(pieces)])
    there = lambda x: (x["first"] <= x["last"]) & (x["first"] <= F.octet_length("prior")) & (LENGTH - x["last"] <= F.octet_length("after"))
    open_ = members.withColumns({"low": F.expr(low), "high": F.expr(high)})
    each = open_.withColumn("part", F.explode(F.filter(parts, there))).drop("first", "last", "core").select("*", "part.*").drop("part")
    start = lambda c, n: F.substring(c, F.lit(1), n)
    return each.select(
        "gram",
        F.xxhash64(start("prior", F.col("first")), start("after", LENGTH - F.col("last"))).alias("core"),
        "ra", "rb", "pos",
        start("prior", F.col("last")).alias("prior"),
        start("after", LENGTH - F.col("first")).alias("after"),
        "first", "last",
    )


def _split(row: DataFrame, frequent: DataFrame) -> DataFrame:
    """Places of frequent grams for each range of offsets whose core repeats: (gram, core, first, last, ra, rb, pos, size)."""

    def cores(ra, rb, t, at):
        for x in at:
            p = x["pos"]
            for first, last in RANGES:
                if first <= p and p + LENGTH - last <= len(t):
                    core = hashlib.blake2b(t[p - first : p + LENGTH - last], digest_size=8, salt=bytes([first])).digest()
                    yield x["gram"], int.from_bytes(core, "little", signed=True), first, last, ra, rb, p

    places = cut(_with_places(row, frequent, ["gram", "pos"]).mapInArrow(_mapped(cores, _CORES), _ddl(_CORES)))
    counted = places.groupBy("gram", "core").agg(F.count("*").alias("n")).where("n > 1").withColumn("size", F.col("n"))
    return skewed_lookup(places, counted, ["gram", "core"], F.xxhash64("ra", "pos"))


def kept_bytes(data: bytes, covered) -> tuple[bytes, int]:
    """What is left of the text, and the number of maximal removed runs."""
    parts, at, runs, end = [], 0, 0, -1
    for start, stop in sorted(covered):
        stop = min(stop, len(data))
        if start > end:
            parts.append(data[at:start])
            runs += 1
        end = max(end, stop)
        at = end
    parts.append(data[at:])
    return b"".join(parts), runs


def _joined(docs: DataFrame) -> DataFrame:
    """The documents with ``covered``; only texts that may have covered bytes are shuffled to them."""
    row = _keyed(docs)
    grouped = cut(spans(row).groupBy("ra", "rb").agg(F.flatten(F.collect_set(F.array("start", "stop"))).alias("covered")))
    held = KeyFilter(grouped.select(F.xxhash64("ra", "rb").alias("h")), grouped.count())
    hit = held.may_hold(F.xxhash64("ra", "rb"))
    return row.where(hit).join(grouped, ["ra", "rb"], "left").unionByName(row.where(~hit).withColumn("covered", F.lit(None).cast(grouped.schema["covered"].dataType)))


def _pairs(covered) -> list[tuple[int, int]]:
    """(start, stop) of the numbers in a row."""
    flat = list(covered) if covered is not None else []
    return list(zip(flat[::2], flat[1::2]))


def digest(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document."""

    kinds = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]

    def run(batches):
        for columns in _slices(batches):
            out = []
            for doc, t, c in zip(*columns):
                left, runs = kept_bytes(t, _pairs(c))
                out.append((doc, len(t), len(t) - len(left), runs, hashlib.sha256(left).hexdigest()))
            yield _batch(out, kinds)

    return _joined(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).select("doc_id", "text", "covered").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove(docs: DataFrame) -> DataFrame:
    """The documents with what is left of their texts, n_chars set anew. Bytes that no longer make a character go."""

    @F.pandas_udf("string")
    def left(text, covered):
        import pandas as pd

        trim()

        return pd.Series([kept_bytes(t.encode(), _pairs(c))[0].decode("utf-8", "ignore") if c is not None and len(c) else t for t, c in zip(text, covered)])

    out = _joined(set_aside(docs)).withColumn("text", left("text", "covered"))
    return put_back(out, docs, F.col("text"))

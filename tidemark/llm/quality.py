"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + sum w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)): the identity makes all
pairwise interactions linear in the features present. Words are presence features of one length-normalised
block; structure statistics and the stored length become one-hot bins, so their pairs are interactions too.

It learns from labelled rows whose crc32(doc_id) mod 3 is not 1, at most ``sample`` of them, those with the
smallest hash of doc_id (a bounded sample whatever the input's size), and scores every whole text.

Nulls and empty texts have the statistics of an empty text and get a score; a null doc_id is never held out nor
learnt from; ids may be of any integer type. Repeated rows are scored each; of texts that share an id, the one with
the least hash is learnt from. Very long texts are scored whole; an empty table gives no rows. Rows without label, or with labels that contradict each other, are
not learnt from; without any learnable row every score is 0.5. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ship, trim

#: Labelled rows to learn from, at most; those with the smallest hash.
SAMPLE = 8000
BUCKETS = 1 << 15
FACTORS = 8
EPOCHS = 12

_EDGES = {
    "log_bytes": [2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0, 10.0, 11.0],
    "upper": [0.005, 0.02, 0.05, 0.1, 0.3, 0.6],
    "digit": [0.0005, 0.002, 0.01, 0.03, 0.1, 0.3],
    "symbol": [0.0005, 0.002, 0.01, 0.03, 0.1, 0.2],
    "bar": [0.0005, 0.01, 0.05, 0.1],
    "stop": [0.001, 0.005, 0.01, 0.02, 0.05, 0.1],
    "bang": [0.0005, 0.005, 0.02, 0.1],
    "space": [0.05, 0.1, 0.14, 0.18, 0.25],
    "line_rate": [0.0005, 0.001, 0.002, 0.005, 0.02, 0.1],
    "word_length": [2.0, 3.5, 4.5, 5.5, 7.0, 10.0],
    "unique": [0.1, 0.25, 0.4, 0.55, 0.7, 0.85, 0.95],
    "top_word": [0.02, 0.05, 0.08, 0.12, 0.2, 0.4],
    "line_repeat": [0.01, 0.1, 0.25, 0.5, 0.8],
    "high_bytes": [0.001, 0.02, 0.05, 0.1, 0.3],
    "stored_log_chars": [2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0, 10.0],
}
_OFFSET = {}
_at = BUCKETS
for _name, _e in _EDGES.items():
    _OFFSET[_name] = _at
    _at += len(_e) + 1
#: All features: word buckets, then the bins of each statistic.
WIDTH = _at
_STATS = [(np.array(e), _OFFSET[n]) for n, e in _EDGES.items()]
_SYMBOLS = np.frombuffer(b"#$%&*@^~_=+<>{}[]\\/`", np.uint8)
_WORD_WEIGHT = 1.0


def _statistics(data: bytes, words: list[bytes], counts: Counter, stored: int | None) -> list[float]:
    n = max(len(data), 1)
    h = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    lines = data.split(b"\n")
    longest = max(counts.values(), default=0)
    return [
        np.log1p(len(data)),
        h[65:91].sum() / n,
        h[48:58].sum() / n,
        h[_SYMBOLS].sum() / n,
        h[124] / n,
        (h[46] + h[44]) / n,
        (h[33] + h[63]) / n,
        h[32] / n,
        len(lines) / n,
        sum(map(len, words)) / max(len(words), 1),
        len(counts) / max(len(words), 1),
        longest / max(len(words), 1),
        1 - len(set(lines)) / len(lines),
        h[128:].sum() / n,
        np.log1p(max(stored, 0) if stored is not None else len(data)),
    ]


def features(text: str | None, stored: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers, values) of a whole text and its stored length."""
    data = (text or "").encode("utf-8", "replace")
    words = data.split()
    counts = Counter(words)
    stats = np.array([o + np.searchsorted(e, x, "right") for x, (e, o) in zip(_statistics(data, words, counts, stored), _STATS)])
    hashed = np.unique(np.fromiter((zlib.crc32(w) for w in counts), np.int64, len(counts)) & (BUCKETS - 1))
    values = np.full(len(hashed), _WORD_WEIGHT / np.sqrt(max(len(hashed), 1)))
    return np.concatenate((hashed, stats)), np.concatenate((values, np.full(len(stats), 0.25)))


class FactorisationMachine:
    def __init__(self, width: int = WIDTH, factors: int = FACTORS, seed: int = 7):
        self.bias = 0.0
        self.linear = np.zeros(width, np.float32)
        self.factor = np.random.default_rng(seed).normal(0, 0.05, (width, factors)).astype(np.float32)

    def logit(self, numbers: np.ndarray, values: np.ndarray) -> float:
        vx = self.factor[numbers] * values[:, None]
        return float(self.bias + self.linear[numbers] @ values + 0.5 * ((vx.sum(0) ** 2).sum() - (vx**2).sum()))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS, batch: int = 64, rate: float = 0.1, decay: float = 1e-4, seed: int = 7) -> "FactorisationMachine":
        """AdaGrad on the log loss, over shuffled batches."""
        order = np.random.default_rng(seed)
        share = np.clip(labels.mean(), 0.01, 0.99)
        self.bias, seen = float(np.log(share / (1 - share))), 1e-6
        g_linear, g_factor = np.full_like(self.linear, 1e-6), np.full_like(self.factor, 1e-6)
        for _ in range(epochs):
            for at in np.array_split(order.permutation(len(rows)), -(-len(rows) // batch)):
                numbers = np.concatenate([rows[i][0] for i in at])
                values = np.concatenate([rows[i][1] for i in at]).astype(np.float32)
                ends = np.cumsum([len(rows[i][0]) for i in at])
                starts = np.concatenate(([0], ends[:-1]))
                row = np.repeat(np.arange(len(at)), ends - starts)
                vx = self.factor[numbers] * values[:, None]
                total = np.add.reduceat(vx, starts)
                z = self.bias + np.add.reduceat(self.linear[numbers] * values, starts) + 0.5 * ((total**2).sum(1) - np.add.reduceat((vx**2).sum(1), starts))
                error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[at]).astype(np.float32) / len(at)
                touched, back = np.unique(numbers, return_inverse=True)
                step = np.zeros(len(touched), np.float32)
                np.add.at(step, back, error[row] * values)
                step += decay * self.linear[touched]
                g_linear[touched] += step**2
                self.linear[touched] -= rate * step / np.sqrt(g_linear[touched])
                step = np.zeros((len(touched), self.factor.shape[1]), np.float32)
                np.add.at(step, back, (error[row] * values)[:, None] * (total[row] - vx))
                step += decay * self.factor[touched]
                g_factor[touched] += step**2
                self.factor[touched] -= rate * 0.3 * step / np.sqrt(g_factor[touched])
                g = float(error.sum())
                seen += g * g
                self.bias -= rate * g / seen**0.5
        return self


def held_out(doc_id) -> "F.Column":
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> FactorisationMachine | None:
    """A machine learnt from at most ``sample`` labelled rows; None where there are none."""
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("label"), F.max("quality").alias("other"))
        .where("label = other")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
        .select("doc_id", "label")
    )

    def run(batches):
        trim()
        for b in batches:
            found = [features(t.as_py(), n.as_py()) for t, n in zip(b.column(0), b.column(1))]
            yield pa.RecordBatch.from_arrays([pa.array([f[0].astype(np.int32).tobytes() for f in found], pa.binary()), pa.array([f[1].astype(np.float32).tobytes() for f in found], pa.binary()), b.column(2)], names=["numbers", "vals", "label"])

    row = F.struct(F.xxhash64("text").alias("h"), "text", F.col("n_chars").cast("long").alias("n_chars"), F.col("label").cast("int").alias("label"))
    rows = (
        docs.select("doc_id", "text", "n_chars")
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id")  # of texts that share an id the one with the least hash
        .agg(F.min(row).alias("row"))
        .select("row.text", "row.n_chars", "row.label")
        .mapInArrow(run, "numbers binary, vals binary, label int")
        .collect()
    )
    if not rows:
        return None
    rows.sort(key=lambda r: bytes(r.numbers))
    data = [(np.frombuffer(r.numbers, np.int32), np.frombuffer(r.vals, np.float32)) for r in rows]
    return FactorisationMachine().fit(data, np.array([r.label for r in rows], np.float32))


def _with_length(docs: DataFrame) -> DataFrame:
    return docs if "n_chars" in docs.columns else docs.withColumn("n_chars", F.lit(None).cast("long"))


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    ship(docs.sparkSession)
    docs = _with_length(docs)
    return _apply(docs.select(F.col("doc_id").cast("long"), "text", F.col("n_chars").cast("long").alias("n_chars")), train(docs, labels, sample)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def _scorer(machine: FactorisationMachine | None):
    if machine is None:
        return lambda text, stored: 0.5
    return lambda text, stored: float(1 / (1 + np.exp(-np.clip(machine.logit(*features(text, stored)), -700, 700))))


def _apply(docs: DataFrame, machine: FactorisationMachine | None) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches):
        trim()
        of = _scorer(shared.value)
        for b in batches:
            scores = [of(t.as_py(), n.as_py()) for t, n in zip(b.column(1), b.column(2))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return docs.mapInArrow(run, "doc_id long, score double")


def keep(docs: DataFrame, labels: DataFrame, least: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """The documents, all columns as they are, whose score is at least ``least``."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(train(_with_length(docs), labels, sample))

    def run(batches):
        import pandas as pd

        trim()
        of = _scorer(shared.value)
        for text, stored in batches:
            yield pd.Series([of(t, None if n is None or n != n else int(n)) for t, n in zip(text, stored)], dtype="float64")
        trim()

    scores = F.pandas_udf(run, "double", F.PandasUDFType.SCALAR_ITER)

    stored = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    return docs.where(scores(F.col("text"), stored) >= least)

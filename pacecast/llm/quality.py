"""Quality classifier by Bradley-Terry pairwise ranking (operator 7).

A text is described by ``FEATURES`` numbers about its letters, words and lines.
All labelled rows are dealt into blocks, and within a block every good text is paired with
every bad one; the model is the weight vector w for which sigmoid(w (x_good - x_bad)) is
the chance that the good one is preferred, fitted by Newton steps on the
logistic loss of the feature differences. The score w x of a text is compared
with the quantile of all these rows' scores that leaves their share of bad
texts below it, and reported as sigmoid((w x - threshold) / scale).

Null and empty texts have all-zero features and a score like any other text.
Rows with a null label or id are not learned from; a doc_id that is labelled
repeatedly counts once, with its lowest label. Without labels of both classes
the model is constant: 1 if good is all there is or nothing is known, else 0.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from hashlib import sha256
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, DoubleType, IntegerType, StructField, StructType

from .common import beside, map_arrow, others, ship, slices, stored

FEATURES = ("words", "word length", "upper", "digits", "exclamations", "bars", "symbols",
            "other marks", "distinct words", "repeats next to each other", "line length",
            "short lines", "worst line: upper", "worst line: symbols", "worst line: bars",
            "worst line: repeats", "long words", "stops")
#: Rows of the more frequent class in a block, rows of the other that each of them is paired with at least (about), and
#: tasks that send sums to the driver in a pass.
BLOCK, PARTNERS, TASKS = 128, 32, 32
#: Bytes of a text that go with its features, to order the texts of a repeated id.
HEAD = 64
UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
DIGITS = b"0123456789"
STOPS = b".,;:?\'\""
OTHER = b"-()/"
SYMBOLS = bytes(c for c in range(33, 127)
                if c not in UPPER + LOWER + DIGITS + STOPS + OTHER + b"!|")


def _left(text: bytes, drop: bytes) -> int:
    return len(text) - len(text.translate(None, drop))


def features(text: str | None) -> list[float]:
    """The numbers that describe a text, in the order of ``FEATURES``."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n, size = len(words), len(raw)
    if not n:
        return [0.0] * len(FEATURES)
    lines = [x for x in raw.split(b"\n") if x]
    worst = [0.0] * 4
    for line in lines:
        if len(line) < 20:
            continue
        own = line.split()
        worst = list(map(max, worst, (
            _left(line, UPPER) / len(line), _left(line, SYMBOLS) / len(line), line.count(b"|") / len(own),
            sum(map(eq, own, own[1:])) / len(own)))) if own else worst
    upper = _left(raw, UPPER)
    return [np.log1p(n), (size - n) / n, upper / size, _left(raw, DIGITS) / size, raw.count(b"!") / n,
            raw.count(b"|") / n, _left(raw, SYMBOLS) / size, _left(raw, OTHER) / n,
            len(set(words)) / n ** 0.9, sum(map(eq, words, words[1:])) / n,
            np.log1p(size / max(1, len(lines))), sum(len(x) < 20 for x in lines) / max(1, len(lines)),
            *worst, sum(len(w) > 20 for w in words) / n, _left(raw, STOPS) / n]


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float
    scale: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        raw = np.clip((x - self.mean) / self.spread, -8, 8) @ self.weights
        return 1 / (1 + np.exp(-np.clip((raw - self.threshold) / self.scale, -500, 500)))


def _numbers(values: np.ndarray) -> np.ndarray:
    """Values as whole multiples of 2^-30, whose sums don't depend on the order."""
    return np.array([round(v * 2.0 ** 30) for v in values.ravel().tolist()], object)


def _over(blocks: DataFrame, of: Callable, merge: Callable):
    """``of(x, good, own)`` of all blocks, merged in each task and then here: one result of a task, at most ``TASKS``."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for x, good, own in zip(*(batch.column(c).to_pylist() for c in ("x", "good", "own")), strict=True):
                part = of(np.frombuffer(x).reshape(-1, len(FEATURES)), np.frombuffer(good, bool), np.frombuffer(own, bool))
                total = part if total is None else merge(total, part)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(total)], pa.binary())], names=["part"])

    parts = map_arrow(blocks.coalesce(TASKS), work, "part binary").collect()
    return reduce(merge, (pickle.loads(r["part"]) for r in parts))


def _sums(blocks: DataFrame, of: Callable) -> np.ndarray:
    total = _over(blocks, lambda *block: _numbers(of(*block)), np.add)
    return np.array([v / 2 ** 30 for v in total])


def _blocks(rows: DataFrame, wins: int, losses: int) -> DataFrame:
    """All rows dealt by hash into blocks of about ``BLOCK`` rows of the more frequent class.

    Of the other class, a block gets about ``PARTNERS`` rows or more; where there are too few, a row is copied to
    several blocks (``own``: the first copy), so that every row meets rows of the other class and no block grows.
    """
    count = -(-max(wins, losses) // BLOCK)
    copies = [min(count, -(-PARTNERS * count // n)) for n in (losses, wins)]
    copy = F.explode(F.sequence(F.lit(0), F.when(F.col("label") == 0, copies[0]).otherwise(copies[1]) - 1))
    dealt = rows.select("_id", "label", "x", copy.alias("_copy")).select(
        F.pmod(F.xxhash64("_id") + F.col("_copy"), F.lit(count)).alias("_block"), "label",
        (F.col("_copy") == 0).alias("own"), "x")

    def packed(table: pa.Table) -> pa.Table:
        x = np.array(table.column("x").to_pylist(), float)
        good, own = table.column("label").to_numpy() == 1, table.column("own").to_numpy()
        # rows come in any order: sorted, so that sums are the same in every run
        order = np.lexsort((*x.T, own, good))
        return pa.table({name: pa.array([v[order].tobytes()], pa.binary())
                         for name, v in (("x", x), ("good", good), ("own", own))})

    ship(rows.sparkSession)
    return dealt.groupBy("_block").applyInArrow(packed, "x binary, good binary, own binary")


def fit(rows: DataFrame, wins: int, losses: int, ridge: float = 1e-3) -> Model:
    """Bradley-Terry weights from all (good, bad) pairs within blocks that hold all rows, then the score quantile.

    The driver gets sums over the rows' features and pairs, never the rows.
    """
    blocks = stored(_blocks(rows, wins, losses), "quality-blocks")
    n, size = wins + losses, len(FEATURES)
    mean = _sums(blocks, lambda x, good, own: x[own].sum(axis=0)) / n
    spread = np.sqrt(_sums(blocks, lambda x, good, own: ((x[own] - mean) ** 2).sum(axis=0)) / n) + 1e-9
    w = np.zeros(size)
    for _ in range(30):
        def slopes(x: np.ndarray, good: np.ndarray, own: np.ndarray, w: np.ndarray = w) -> np.ndarray:
            z = np.clip((x - mean) / spread, -8, 8)
            a, b = z[good], z[~good]
            p = 1 / (1 + np.exp(-np.clip(np.subtract.outer(a @ w, b @ w), -500, 500)))
            miss, bent = 1 - p, p * (1 - p)
            # sums over the pairs' differences, without a row per pair
            cross = a.T @ bent @ b
            slope = a.T @ miss.sum(axis=1) - b.T @ miss.sum(axis=0)
            bend = (a.T * bent.sum(axis=1)) @ a + (b.T * bent.sum(axis=0)) @ b - cross - cross.T
            return np.concatenate([[p.size], slope, bend.ravel()])

        pairs, *sums = _sums(blocks, slopes)
        slope = np.array(sums[:size]) / pairs - ridge * w
        step = np.linalg.solve(np.array(sums[size:]).reshape(size, size) / pairs + ridge * np.eye(size), slope)
        w = w + step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break

    def raw(x: np.ndarray, own: np.ndarray) -> np.ndarray:
        return np.clip((x[own] - mean) / spread, -8, 8) @ w

    centre = _sums(blocks, lambda x, good, own: raw(x, own).sum(keepdims=True)) / n
    square = _sums(blocks, lambda x, good, own: ((raw(x, own) - centre) ** 2).sum(keepdims=True)) / n
    return Model(mean, spread, w, _threshold(blocks, raw, losses), float(np.sqrt(square[0]) + 1e-9) / 4)


def _threshold(blocks: DataFrame, raw: Callable, below: int) -> float:
    """The middle between the ``below``-th smallest score and the next one, so that neither is on it.

    Exact, in five passes: scores as whole numbers of the same order, found by 16 bits at a time.
    """
    def ordered(x: np.ndarray, own: np.ndarray) -> np.ndarray:
        bits = (raw(x, own) + 0.0).view(np.int64)
        return np.where(bits < 0, ~bits, bits ^ np.int64(-2 ** 63)).view(np.uint64)

    found, rank = 0, below - 1
    for shift in (48, 32, 16, 0):
        def digits(x: np.ndarray, good: np.ndarray, own: np.ndarray, found: int = found, shift: int = shift) -> Counter:
            head = ordered(x, own) >> np.uint64(shift)
            return Counter((head[head >> np.uint64(16) == found] & np.uint64(65535)).tolist())

        counts = _over(blocks, digits, lambda a, b: a + b)
        for digit in sorted(counts):
            if rank < counts[digit]:
                break
            rank -= counts[digit]
        found = found << 16 | digit
    at = np.array([found], np.uint64)
    value = np.where(at >> np.uint64(63) == 0, ~at, at ^ np.uint64(2 ** 63)).view(np.float64)[0]
    if rank + 1 < counts[digit]:
        return float(value)

    def above(x: np.ndarray, good: np.ndarray, own: np.ndarray) -> float:
        scores = raw(x, own)
        return min(scores[scores > value].tolist(), default=np.inf)

    return float((value + _over(blocks, above, min)) / 2)


def sample(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id",
           text_col: str = "text", label_col: str = "quality", sample_rows: int | None = None) -> DataFrame:
    """Features and label (``_id``, ``label``, ``x``) of one text of each labelled id.

    All of them by default, else those of the ``sample_rows`` ids with the smallest hashes. Of a repeated id's
    texts it is the smallest one, by its beginning and then by digest, since only these go with
    the features: the texts aren't shuffled.
    """
    chosen = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & learn)
              .groupBy(F.col(id_col).alias("_id")).agg(F.min(label_col).cast("int").alias("label")))
    if sample_rows is not None:
        chosen = chosen.orderBy(F.xxhash64("_id"), "_id").limit(sample_rows)
    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    schema = StructType([StructField("_id", texts.schema["_id"].dataType), StructField("missing", BooleanType()),
                         StructField("head", BinaryType()), StructField("digest", BinaryType()),
                         StructField("x", ArrayType(DoubleType()))])
    return (map_arrow(texts, _features, schema).join(chosen, "_id")
            .groupBy("_id", "label").agg(F.min(F.struct("missing", "head", "digest", "x")).alias("_least"))
            .select("_id", "label", "_least.x"))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in slices(batches, 1):
        raw = [(t or "").encode("utf-8", "replace") for t in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([t is None for t in texts]), pa.array([r[:HEAD] for r in raw], pa.binary()),
             pa.array([sha256(r).digest() for r in raw], pa.binary()),
             pa.array([features(t) for t in texts], pa.list_(pa.float64()))],
            names=["_id", "missing", "head", "digest", "x"])


def train(docs: DataFrame, labels: DataFrame, learn: Column, **options) -> Model:
    """Fit on all labelled rows (see :func:`sample` for the options)."""
    rows = stored(sample(docs, labels, learn, **options), "quality-features")
    seen = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    size = len(FEATURES)
    if len(seen) < 2:
        return Model(np.zeros(size), np.ones(size), np.zeros(size), -1.0 if next(iter(seen), 1) else 1.0, 1.0)
    return fit(rows, seen[1], seen[0])


def score(docs: DataFrame, model: Model, text_col: str = "text", to: str = "score",
          predicted_to: str = "predicted") -> DataFrame:
    """All rows and columns but the text, with score (0 to 1) and predicted (1: score >= 0.5).

    An old column with a new one's name gives way to it.
    """
    kept = others(docs, text_col, to, predicted_to)
    held = docs.sparkSession.sparkContext.broadcast(model)
    source, fields = beside(docs, kept, text_col)
    schema = StructType(fields
                        + [StructField(to, DoubleType()), StructField(predicted_to, IntegerType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, len(kept)):
            p = held.value.scores(np.array([features(t) for t in texts]))
            yield pa.RecordBatch.from_arrays(
                batch.columns[:-1] + [pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                names=schema.names)

    return map_arrow(source, work, schema)

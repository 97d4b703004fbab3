"""Toxicity: a linear-chain conditional random field over the words of a text (operator 10).

Tokens are runs of letters, lower-cased; each is tagged 0 (clean) or 1 (toxic).
The labels mark whole texts, so token labels come first: in a bounded sample of
labelled texts, a word or word beginning (``PREFIXES`` characters) is an
indicator if it occurs in toxic texts so often, and in clean ones so rarely,
that chance can't explain it. Texts of the same set of words count
as one there, so copies of a text prove nothing. Tokens with an indicator are
labelled toxic.

The field is trained on all tokens of the sample (hashed
features of a token: word and beginnings; two by two transitions), by gradient
steps on its log likelihood, whose gradients are summed in Spark tasks. Long chains are
cut into segments that look ``HALO`` tokens past either end: every token and transition counts once, and
messages from farther away have faded by then. To
score a text, forward-backward in log-odds form runs over all its tokens; the
marginals give the offending offsets (marginal of at least 0.5) and, by their
largest, the document's score through a logistic curve fitted on the largest of
each of the sample's texts, found in the same way.

Null and empty texts score as a text without toxic tokens. Rows with a null
label or id are not learned from; a doc_id that is labelled repeatedly counts
once, with its highest label. Without toxic labels every score is near 0.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, StructField,
                               StructType)

from .common import beside, map_arrow, others, sampled_texts, slices, stored

TOKEN = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6)
DIMENSIONS = 1 << 18
#: Tokens that a training segment counts, and those it sees besides on either side.
SEGMENT, HALO = 40, 10
#: Texts scored side by side hold at most this many cells, padding included; a longer text goes alone.
CELLS = 4_000_000
#: Most tasks of a training round: each returns one gradient to the driver.
TASKS = 32
#: Words whose weight a worker remembers; the memo starts anew when full.
MEMO_WORDS = 400_000


def word_features(word: str) -> list[str]:
    return ["=" + word, *[f"{n}{word[:n]}" for n in PREFIXES if len(word) >= n]]


def _slots(word: str) -> list[int]:
    return [zlib.crc32(f.encode()) % DIMENSIONS for f in word_features(word)]


@dataclass
class Model:
    """Log-odds weights of features, a bias, transition scores [from][to], doc-score curve."""

    weights: np.ndarray
    bias: float
    moves: np.ndarray
    slope: float
    offset: float

    def word_odds(self, word: str) -> float:
        return float(self.weights[_slots(word)].sum() + self.bias)


def marginal_odds(odds: list[np.ndarray], moves: np.ndarray) -> list[np.ndarray]:
    """Log odds of tag 1 at every token, by forward and backward recursions.

    Texts of similar length run side by side. With two tags, the messages
    reduce to their log odds: f' = e + log((a01 + a11 r) / (a00 + a10 r)), r = exp(f).
    """
    a = np.exp(moves)
    out: list = [None] * len(odds)
    order = sorted(range(len(odds)), key=lambda i: len(odds[i]))
    for i in order:
        if not len(odds[i]):
            out[i] = odds[i]
    order = [i for i in order if len(odds[i])]
    start = 0
    while start < len(order):
        stop = start + 1
        while stop < len(order) and stop - start < 256 and (stop + 1 - start) * len(odds[order[stop]]) <= CELLS:
            stop += 1
        group, start = order[start:stop], stop
        lengths = np.array([len(odds[i]) for i in group])
        longest = int(lengths.max())
        # right-aligned for the forward pass is not needed: what follows a text's end is ignored there
        e = np.zeros((longest, len(group)))
        for c, i in enumerate(group):
            e[:len(odds[i]), c] = odds[i]
        f = np.empty_like(e)
        f[0] = e[0]
        for t in range(1, longest):
            r = np.exp(np.clip(f[t - 1], -40, 40))
            f[t] = e[t] + np.log((a[0, 1] + a[1, 1] * r) / (a[0, 0] + a[1, 0] * r))
        b = np.zeros(len(group))
        for t in range(longest - 2, -1, -1):
            r = np.exp(np.clip(e[t + 1] + b, -40, 40))
            b = np.where(lengths > t + 1, np.log((a[1, 0] + a[1, 1] * r) / (a[0, 0] + a[0, 1] * r)), 0.0)
            f[t] += b
        for c, i in enumerate(group):
            out[i] = f[:lengths[c], c].copy()
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


# ------------------------------------------------------------- training ------

def sample(labels: DataFrame, learn: Column, id_col: str, label_col: str, toxic_rows: int,
           clean_rows: int) -> DataFrame:
    """Ids and labels of a bounded sample: of each class the rows with the smallest id hashes."""
    known = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & learn)
             .groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).alias("_label")))

    def first(label: int, rows: int) -> DataFrame:
        return known.where(F.col("_label") == label).orderBy(F.xxhash64("_id"), "_id").limit(rows)

    return first(1, toxic_rows).unionByName(first(0, clean_rows))


def _presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, label, group) of each text's distinct features; group: a hash of its set of words."""
    for batch, texts in slices(batches, 1):
        for label, text in zip(batch.column(0).to_pylist(), texts, strict=True):
            words = set(TOKEN.findall((text or "").lower()))
            if words:
                group = xxhash.xxh3_64_intdigest("\n".join(sorted(words)).encode()) >> 1
                features = sorted({f for w in words for f in word_features(w)})
                yield pa.RecordBatch.from_arrays(
                    [pa.array(features), pa.array([label] * len(features), pa.int32()),
                     pa.array([group] * len(features), pa.int64())], names=["feature", "label", "group"])


def indicators(texts: DataFrame, chance: float = 0.1) -> set[str]:
    """Features of toxic texts that chance can't explain.

    With toxic texts a share s of the sample, a feature that marks nothing has
    only toxic texts among t with probability s^t; t is set so that ``chance``
    such features are expected over all. One clean text in twenty is tolerated.
    """
    seen = map_arrow(texts, _presence, "feature string, label int, group long").distinct()
    total = texts.agg(F.avg("_label")).first()[0]
    if not total or total >= 1:
        return set()
    counted = (seen.groupBy("feature").agg(F.sum("label").alias("toxic"), F.count("*").alias("n"))
               .where("toxic >= 4 and toxic >= 0.95 * n"))
    found = counted.select("feature", "toxic").toPandas()
    kinds = len(found) + 1000
    least = np.log(chance / kinds) / np.log(total)
    return set(found["feature"][found["toxic"] >= max(4, least)])


def _segments(marks: set[str]):
    """The texts of each slice as segments: distinct words' slots, the segments' tokens (places in the words), the
    tags of all tokens, each once, lengths of the segments, and where their counted tokens begin and end."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, 1):
            places: dict[str, int] = {}
            number, lengths, cores, tags, toxic = [], [], [], [], []
            for label, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                tokens = TOKEN.findall((text or "").lower())
                own = np.fromiter((places.setdefault(w, len(places)) for w in tokens), np.int32, len(tokens))
                for i in range(0, len(tokens), SEGMENT):
                    a, b = max(0, i - HALO), min(len(own), i + SEGMENT + HALO)
                    number.append(own[a:b])
                    lengths.append(b - a)
                    cores += [i - a, min(len(own), i + SEGMENT) - a]
                tags.append(own)
                toxic.append(np.full(len(own), label == 1))
            if lengths:
                slots = [_slots(w) for w in places]
                hits = np.array([not marks.isdisjoint(word_features(w)) for w in places])
                parts = (np.concatenate(slots).astype(np.int32), np.array([len(x) for x in slots], np.int32),
                         np.concatenate(number), hits[np.concatenate(tags)] & np.concatenate(toxic),
                         np.array(lengths, np.int32), np.array(cores, np.int32))
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in parts],
                                                 names=["slots", "sizes", "number", "tags", "lengths", "cores"])
    return work


SEGMENTED = "slots binary, sizes binary, number binary, tags binary, lengths binary, cores binary"


def _gradient(held):
    """Sums over a task's segments: of each slot, the bias and the transitions, truth less expectation."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias, moves = held.value
        total = np.zeros(DIMENSIONS + 5)
        for batch in batches:
            for row in range(batch.num_rows):
                slot, sizes, number, truth, lengths, cores = (
                    np.frombuffer(c[row].as_py(), np.bool_ if name == "tags" else np.int32)
                    for name, c in zip(batch.schema.names, batch.columns, strict=True))
                owner = np.repeat(np.arange(len(sizes)), sizes)
                odds = np.bincount(owner, weights[slot], minlength=len(sizes)) + bias
                starts = np.cumsum(lengths) - lengths
                counted = np.zeros(len(number) + 1, np.int8)
                np.add.at(counted, starts + cores[::2], 1)
                np.add.at(counted, starts + cores[1::2], -1)
                counted = np.cumsum(counted[:-1]).astype(bool)
                p, pairs = _expected(odds[number], starts, lengths, moves, counted)
                miss = truth - p[counted]
                error = np.bincount(number[counted], miss, minlength=len(sizes))
                total[:DIMENSIONS] += np.bincount(slot, error[owner], minlength=DIMENSIONS)
                total[DIMENSIONS] += error.sum()
                own = cores[1::2] - cores[::2]
                inner = np.ones(len(truth), bool)
                inner[(np.cumsum(own) - own)[cores[::2] == 0]] = False  # no transition leads to a text's first token
                here = np.flatnonzero(inner)
                seen = np.bincount(truth[here - 1] * 2 + truth[here], minlength=4)
                total[DIMENSIONS + 1:] += seen - pairs.ravel()
        used = np.flatnonzero(total)
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [pa.array([x.tobytes()], pa.binary()) for x in (used.astype(np.int32), total[used])],
                names=["place", "value"])
    return work


def fit(segments: DataFrame, rounds: int = 40, rate: float = 0.5) -> Model:
    """Maximise the chain's log likelihood by AdaGrad over all segments, with hashed features.

    In each round the driver gets one gradient of a task, and there are at most ``TASKS``.
    """
    context = segments.sparkSession.sparkContext
    weights, bias, moves = np.zeros(DIMENSIONS), -2.0, np.zeros((2, 2))
    g_w, g_b, g_m = np.full(DIMENSIONS, 1e-6), 1e-6, np.full((2, 2), 1e-6)
    for _ in range(rounds):
        held = context.broadcast((weights, bias, moves))
        total = np.zeros(DIMENSIONS + 5)
        for part in map_arrow(segments.coalesce(TASKS), _gradient(held), "place binary, value binary").collect():
            total[np.frombuffer(part["place"], np.int32)] += np.frombuffer(part["value"])
        held.destroy()
        step = total[:DIMENSIONS] - 0.02 * weights
        g_w += step ** 2
        weights = weights + rate * step / np.sqrt(g_w)
        g_b += total[DIMENSIONS] ** 2
        bias += rate * total[DIMENSIONS] / np.sqrt(g_b)
        step = total[DIMENSIONS + 1:].reshape(2, 2)
        g_m += step ** 2
        moves = np.clip(moves + 0.2 * rate * step / np.sqrt(g_m), -4, 4)
    return Model(weights, bias, moves, 1.0, 0.0)


def _expected(odds: np.ndarray, starts: np.ndarray, lengths: np.ndarray, moves: np.ndarray,
              counted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of tag 1 over all tokens in order, and expected transition counts [from][to].

    Transitions into tokens that are not ``counted`` (default: all are) are left out.
    """
    a = np.exp(moves)
    f, p, pairs = np.zeros(len(odds)), np.zeros(len(odds)), np.zeros((2, 2))
    f[starts] = odds[starts]
    longest = int(lengths.max())
    for t in range(1, longest):
        at = starts[lengths > t] + t
        r = np.exp(np.clip(f[at - 1], -40, 40))
        f[at] = odds[at] + np.log((a[0, 1] + a[1, 1] * r) / (a[0, 0] + a[1, 0] * r))
    b = np.zeros(len(odds))
    for t in range(longest - 1, 0, -1):
        at = starts[lengths > t] + t
        r = np.exp(np.clip(odds[at] + b[at], -40, 40))
        left = np.exp(np.clip(f[at - 1], -40, 40))
        joint = np.array([[a[0, 0] + 0 * r, a[0, 1] * r], [a[1, 0] * left, a[1, 1] * left * r]])
        shares = joint / joint.sum(axis=(0, 1))
        pairs += (shares if counted is None else shares * counted[at]).sum(axis=2)
        b[at - 1] = np.log((a[1, 0] + a[1, 1] * r) / (a[0, 0] + a[0, 1] * r))
    p = _sigmoid(f + b)
    return p, pairs


def train(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "toxic", toxic_rows: int = 2_500,
          clean_rows: int = 5_000) -> Model:
    """Fit on at most ``toxic_rows`` + ``clean_rows`` labelled texts, one an id, on all their tokens.

    The sampled ids are broadcast; the driver gets sums over the texts and the
    largest log odds of each, never the texts or their tokens.
    """
    chosen = sample(labels, learn, id_col, label_col, toxic_rows, clean_rows)
    texts = stored(sampled_texts(docs, chosen, id_col, text_col), "toxicity-sample")
    marks = indicators(texts)
    if not marks:
        return Model(np.zeros(DIMENSIONS), -8.0, np.zeros((2, 2)), 1.0, 0.0)
    model = fit(stored(map_arrow(texts, _segments(marks), SEGMENTED), "toxicity-segments"))
    tops = map_arrow(texts, _largest(model), "label int, top double").toArrow()
    label, top = tops["label"].to_numpy(), tops["top"].to_numpy()
    # texts come in any order: sorted, so that the sums are the same in every run
    order = np.lexsort((top, label))
    return _calibrated(model, top[order], label[order].astype(float))


def _largest(model: Model):
    """(label, largest log odds) of every text, as scoring finds it."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, float] = {}
        for batch, texts in slices(batches, 1):
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int32()),
                                              pa.array(token_odds(texts, model, memo)[1])], names=["label", "top"])
    return work


def _calibrated(model: Model, top: np.ndarray, label: np.ndarray) -> Model:
    """Logistic curve from the largest log odds of a text to its label, by Newton steps."""
    x = np.stack([np.clip(top, -12, 12), np.ones(len(top))], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(25):
        p = _sigmoid(x @ w)
        bend = (x * (p * (1 - p))[:, None]).T @ x + np.eye(2) * 0.1
        step = np.linalg.solve(bend, x.T @ (label - p) - 0.1 * (w - [1.0, 0.0]))
        w = w + np.clip(step, -1, 1)
    return Model(model.weights, model.bias, model.moves, max(float(w[0]), 1e-3), float(w[1]))


# -------------------------------------------------------------- scoring ------

def token_odds(texts: list, model: Model, memo: dict[str, float]) -> tuple[list[np.ndarray], np.ndarray]:
    """Log odds of tag 1 at all tokens of each text, and the largest of each text (-12 without tokens)."""
    if len(memo) > MEMO_WORDS:
        memo.clear()
    split = [TOKEN.findall(t.lower()) if t else [] for t in texts]
    for word in {w for s in split for w in s}:
        if word not in memo:
            memo[word] = model.word_odds(word)
    odds = [np.fromiter(map(memo.__getitem__, s), float, len(s)) for s in split]
    found = marginal_odds(odds, model.moves)
    return found, np.array([o.max() if len(o) else -12.0 for o in found])


def tag_texts(texts: list, model: Model, memo: dict[str, float]) -> tuple[np.ndarray, list[list]]:
    """Document scores, and the offending (start, end, marginal) of each text."""
    found, top = token_odds(texts, model, memo)
    spans = []
    for text, own in zip(texts, found, strict=True):
        hits = np.flatnonzero(own >= 0).tolist()
        if hits:
            tokens = _places(text)
            spans.append([(*tokens[k], float(_sigmoid(own[k]))) for k in hits])
        else:
            spans.append([])
    return _sigmoid(model.slope * np.clip(top, -12, 12) + model.offset), spans


def _places(text: str) -> list[tuple[int, int]]:
    """Offsets in the text of the tokens found in its lower-case form."""
    low = text.lower()
    if len(low) == len(text):
        return [m.span() for m in TOKEN.finditer(low)]
    # a few characters get longer in lower case: offsets go back through each character's length
    back = [i for i, c in enumerate(text) for _ in c.lower()]
    return [(back[m.start()], back[m.end() - 1] + 1) for m in TOKEN.finditer(low)]


SPANS = ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType()),
                              StructField("marginal", DoubleType())]))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All rows and columns but the text, with score, predicted (1: score >= 0.5) and spans.

    ``spans`` holds the code point offsets of the toxic tokens and their
    marginals. An old column with a new one's name gives way to it.
    """
    kept = others(docs, text_col, "score", "predicted", "spans")
    held = docs.sparkSession.sparkContext.broadcast(model)
    source, fields = beside(docs, kept, text_col)
    schema = StructType(fields
                        + [StructField("score", DoubleType()), StructField("predicted", IntegerType()),
                           StructField("spans", SPANS)])
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("marginal", pa.float64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, float] = {}
        for batch, texts in slices(batches, len(kept)):
            p, spans = tag_texts(texts, held.value, memo)
            found = [[{"start": a, "end": b, "marginal": m} for a, b, m in s] for s in spans]
            yield pa.RecordBatch.from_arrays(
                batch.columns[:-1] + [pa.array(p), pa.array((p >= 0.5).astype(np.int32)),
                                      pa.array(found, kind)], names=schema.names)

    return map_arrow(source, work, schema)

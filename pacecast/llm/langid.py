"""Language identification: multinomial naive Bayes over hashed character n-grams (operator 5).

Texts are lower-cased, everything but letters becomes a blank, and every run of
one to three characters is hashed into one of ``BUCKETS`` buckets. Training counts (bucket, language) pairs with
partial sums in each task; the smoothed log-probability matrix (buckets x
languages, of a size bounded by ``BUCKETS`` and ``max_languages``) is broadcast, and
a text's score is the sum of the matrix rows of its n-grams, taken in numpy
over a whole slice of texts at once.

A null text, or one without a letter, is ``und`` with score 0. Without any
training row every other text is ``und`` too. Ties go to the language that is
first by code point. Rows with a null language or id are not learned from.
Repeated rows count repeatedly; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import beside, map_arrow, others, slices

BUCKETS = 1 << 15
SMOOTHING = 0.5
#: A text is hashed in pieces of this many characters (n-grams across a cut are kept).
PIECE = 1_000_000
BLANKS = np.full(2, 32, np.uint32)


@dataclass
class Model:
    """Languages by code point, their log priors and the log-probability matrix."""

    languages: list[str]
    priors: np.ndarray
    logs: np.ndarray

    @cached_property
    def usual(self) -> tuple[np.ndarray, np.ndarray]:
        """Mean and standard deviation of an n-gram's log probability in each language's own training text."""
        share = np.exp(self.logs)
        share -= share.min(axis=1, keepdims=True)  # the smoothing, which is all that an unseen n-gram has
        share /= np.maximum(share.sum(axis=1, keepdims=True), 1e-300)
        mean = (share * self.logs).sum(axis=1)
        return mean, np.sqrt((share * (self.logs - mean[:, None]) ** 2).sum(axis=1))


@cache
def _letters() -> np.ndarray:
    """Code point -> lower-case code point of a letter, 32 for all else."""
    out = np.full(0x110000, 32, np.uint32)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            low = char.lower()
            out[point] = ord(low) if len(low) == 1 else point
    return out


def code_points(text: str) -> np.ndarray:
    """The text as the classifier sees it: two blanks, then lower-case letters and blanks."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.concatenate((BLANKS, _letters()[points]))


def buckets(points: np.ndarray) -> list[np.ndarray]:
    """Buckets of the runs of 1, 2 and 3 characters that start at each point but the last two."""
    one = points * np.uint32(0x9E3779B1)
    two = (one[:-1] ^ (points[1:] * np.uint32(0x85EBCA77) >> np.uint32(3))) * np.uint32(0xC2B2AE3D)
    three = (two[:-1] ^ (points[2:] * np.uint32(0x27D4EB2F) >> np.uint32(5))) * np.uint32(0x165667B1)
    shift = np.uint32(32 - (BUCKETS.bit_length() - 1))
    return [g[:len(three)] >> shift for g in (one, two, three)]


def _pieces(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Groups of whole texts, or pieces of a long one: (points, where texts start, number of the first).

    Two points follow those that belong to the group, so that an n-gram never
    depends on which texts share a group.
    """
    at = 0
    while at < len(texts):
        group, size, first = [], 0, at
        while at < len(texts) and (not group or size + len(texts[at]) <= PIECE):
            group.append(code_points(texts[at]))
            size += len(texts[at])
            at += 1
        starts = np.cumsum([0, *map(len, group[:-1])])
        points = np.concatenate((*group, BLANKS))
        if len(group) > 1:
            yield points, starts, first
        else:
            for cut in range(0, len(group[0]), PIECE):
                yield points[cut:cut + PIECE + 2], starts, first


def count(texts: list[str]) -> np.ndarray:
    """How often each bucket occurs in the texts."""
    total = np.zeros(BUCKETS, np.int64)
    for points, _, _ in _pieces(texts):
        for grams in buckets(points):
            total += np.bincount(grams, minlength=BUCKETS)
    return total


def log_likelihoods(texts: list[str], model: Model) -> np.ndarray:
    """Log prior plus log likelihood, one row per text and one column per language."""
    out = np.tile(model.priors, (len(texts), 1))
    for points, starts, first in _pieces(texts):
        for grams in buckets(points):
            for k in range(len(model.languages)):
                out[first:first + len(starts), k] += np.add.reduceat(model.logs[k][grams], starts)
    return out


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          learn: Column | None = None, max_languages: int = 512) -> Model:
    """Fit on all rows with a language (and ``learn``); at most ``max_languages`` languages.

    More languages raise an error: the matrix that is broadcast grows with them.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows if learn is None else rows.where(learn)
    known = rows.select(lang_col).distinct().limit(max_languages + 1).collect()
    if len(known) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    languages = sorted((r[0] for r in known), key=lambda x: x.encode())
    number = {name: k for k, name in enumerate(languages)}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((len(languages), BUCKETS), np.int64)
        docs_of = np.zeros(len(languages), np.int64)
        for batch, texts in slices(batches, 1):
            by: dict[str, list[str]] = {}
            for name, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                by.setdefault(name, []).append(text)
            for name, own in by.items():
                totals[number[name]] += count(own)
                docs_of[number[name]] += len(own)
        for k in range(len(languages)):
            used = np.flatnonzero(totals[k])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used) + 1, k, np.int32)),
                 pa.array(np.append(used, -1).astype(np.int32)),
                 pa.array(np.append(totals[k][used], docs_of[k]))], names=["lang", "bucket", "n"])

    source = rows.select(F.col(lang_col).alias("_lang"), F.col(text_col).alias("_text"))
    counted = (map_arrow(source, work, "lang int, bucket int, n long")
               .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    table = np.zeros((len(languages), BUCKETS + 1))
    table[counted["lang"], counted["bucket"]] = counted["n"]  # bucket -1, the last column: documents
    grams = table[:, :-1] + SMOOTHING
    priors = table[:, -1] + SMOOTHING
    return Model(languages, np.log(priors / priors.sum()) if languages else np.zeros(0),
                 np.log(grams / grams.sum(axis=1, keepdims=True)))


def predict_texts(texts: list, model: Model) -> tuple[list[str], list[float]]:
    """Language and its posterior probability of each text."""
    return judged(texts, model)[:2]


def judged(texts: list, model: Model) -> tuple[list[str], list[float], list]:
    """Language, posterior probability and fit of each text.

    The fit tells how far the mean log probability of a text's n-grams in its language lies from that
    of the language's training text, in standard deviations of an n-gram; it doesn't depend
    on the text's length. Without a letter it is None, where no language was learned 0.
    """
    lettered = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
    names, scores, fits = ["und"] * len(texts), [0.0] * len(texts), [None] * len(texts)
    for i in lettered:
        fits[i] = 0.0
    if model.languages and lettered:
        own = [texts[i] for i in lettered]
        logs = log_likelihoods(own, model)
        best = logs.argmax(axis=1)
        odds = np.exp(logs - logs.max(axis=1, keepdims=True))
        top = 1 / odds.sum(axis=1)
        grams = 3 * np.array([len(t) + len(BLANKS) for t in own])
        mean, spread = model.usual
        fit = ((logs.max(axis=1) - model.priors[best]) / grams - mean[best]) / spread[best]
        for i, k, p, f in zip(lettered, best.tolist(), top.tolist(), fit.tolist(), strict=True):
            names[i], scores[i], fits[i] = model.languages[k], p, f
    return names, scores, fits


def predict(docs: DataFrame, model: Model, text_col: str = "text", lang_to: str = "lang_pred",
            score_to: str = "score", fit_to: str | None = None) -> DataFrame:
    """All rows and columns with the predicted language, its probability and (if named) the fit of ``judged``.

    An old column with a new one's name gives way to it.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    new = {lang_to: StringType(), score_to: DoubleType(), **({fit_to: DoubleType()} if fit_to else {})}
    kept = others(docs, *new)
    source, fields = beside(docs, kept, text_col)
    schema = StructType(fields + [StructField(name, kind) for name, kind in new.items()])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, len(kept)):
            found = zip(judged(texts, held.value), (pa.string(), pa.float64(), pa.float64()), strict=True)
            columns = [pa.array(values, kind) for values, kind in found]
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + columns[:len(new)], names=schema.names)

    return map_arrow(source, work, schema)

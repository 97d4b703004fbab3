"""Language-model scores by subword lattice likelihood (operator 4).

The vocabulary of an existing tokenizer gives the pieces; a word is a blank and
its bytes (A-Z lower-cased), and its probability is the sum over all ways to cut
it into pieces of the product of the pieces' probabilities, found by a forward recursion
in log space. A text is its words and one end; words don't share pieces, so its log
probability is the sum of its words' and the end's.

The pieces' probabilities start from the vocabulary's own ranks (1 / (rank + 1)) and are
learned from the training texts by ``ROUNDS`` rounds of expectation-maximisation over
all segmentations; the recursions run over the distinct words with their counts.

Flow: (1) each slice of documents becomes one row with its distinct words, their
training counts and every document's words as numbers; (2) counts are
added up by word, pieces learned and each distinct word scored once;
(3) the values go back to the slices that hold the word, where documents are
summed up. Only (slice, word) pairs, never single occurrences, are shuffled, and the driver
gets no more than one number for each piece.

A null or empty text is only an end. Rows with a null id are scored but not learned from
(``held_out`` is true). Repeated rows count repeatedly; an empty table gives an empty table;
without training rows the piece probabilities keep their start.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, DoubleType, LongType, StringType,
                               StructField, StructType)

from .common import map_arrow, ship, stored

ROUNDS = 2
SMOOTHING = 0.1
#: Words of at most this many bytes are scored side by side, longer ones one by one.
SIDE_BY_SIDE = 48
#: Distinct words that a task takes on at once.
TOGETHER = 200_000
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"


@dataclass(frozen=True)
class Model:
    """Pieces and natural log probabilities.

    A word starts with a piece that has the blank, where the end of the text is the
    other choice, and goes on with pieces that have none, where ``stop`` is.
    """

    pieces: tuple[bytes, ...]
    logs: np.ndarray
    end: float
    stop: float

    @property
    def trie(self) -> Trie:
        return _trie(self.pieces)


class Trie:
    """Pieces as paths from node 0 over ``after(nodes, bytes)`` (0: none); ``piece[node]`` or -1.

    Most nodes have one child or none: only a node with more has a row of its own.
    """

    def __init__(self, pieces: tuple[bytes, ...]):
        nodes: dict[bytes, int] = {b"": 0}
        steps, piece = [], {}
        for k, p in enumerate(pieces):
            for i in range(1, len(p) + 1):
                if p[:i] not in nodes:
                    nodes[p[:i]] = len(nodes)
                    steps.append((nodes[p[:i - 1]], p[i - 1], nodes[p[:i]]))
            piece[nodes[p]] = k
        a, b, c = np.array(steps, np.int32).reshape(-1, 3).T
        fork = np.bincount(a, minlength=len(nodes)) > 1
        self.only, self.child = np.zeros(len(nodes), np.int32), np.zeros(len(nodes), np.int32)
        single = ~fork[a]
        self.only[a[single]], self.child[a[single]] = b[single], c[single]
        self.row = np.where(fork, np.cumsum(fork), 0).astype(np.int32)
        self.forks = np.zeros((fork.sum() + 1, 256), np.int32)
        self.forks[self.row[a[~single]], b[~single]] = c[~single]
        self.piece = np.full(len(nodes), -1, np.int32)
        self.piece[list(piece)] = list(piece.values())
        self.number = {p: k for k, p in enumerate(pieces)}
        self.longest = max(map(len, pieces), default=0)

    def after(self, nodes: np.ndarray, bytes_: np.ndarray) -> np.ndarray:
        """The nodes that follow the given ones at the given bytes."""
        return np.where(self.only[nodes] == bytes_, self.child[nodes], 0) + self.forks[self.row[nodes], bytes_]


@lru_cache(maxsize=2)
def _trie(pieces: tuple[bytes, ...]) -> Trie:
    return Trie(pieces)


def initial_model(vocab_path: str) -> Model:
    """Pieces of a tiktoken file that can occur in a word, with probabilities by their ranks."""
    with open(vocab_path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    usable = [p for p in sorted(ranks, key=ranks.get)
              if p == p.lower() and not any(c in p[1:] for c in BLANKS) and (p[0] not in BLANKS[1:])]
    weight = np.array([1 / (ranks[p] + 1) for p in usable])
    return _normal(tuple(usable), weight, weight.min(), weight.sum() / 3)


def _normal(pieces: tuple[bytes, ...], weight: np.ndarray, ends: float, stops: float) -> Model:
    """The model whose probabilities are in proportion to the weights, start and inside apart."""
    first = np.array([p[0] == 32 for p in pieces], bool)
    start, inside = weight[first].sum() + ends, weight[~first].sum() + stops
    return Model(pieces, np.log(weight / np.where(first, start, inside)), float(np.log(ends / start)),
                 float(np.log(stops / inside)))


# ------------------------------------------------------------ recursions -----

def _walks(trie: Trie, table: np.ndarray, i: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(end, rows, pieces) of the pieces that start at byte i of the words in ``table``."""
    rows = np.arange(len(table))
    state = np.zeros(len(table), np.int32)
    for j in range(i, table.shape[1]):
        state = trie.after(state, table[rows, j])
        alive = state > 0
        if not alive.all():
            rows, state = rows[alive], state[alive]
            if not len(rows):
                return
        piece = trie.piece[state]
        ends = piece >= 0
        if ends.all():
            yield j + 1, rows, piece
        elif ends.any():
            yield j + 1, rows[ends], piece[ends]


def _forward(model: Model, table: np.ndarray) -> np.ndarray:
    """Log probability of every prefix of words of one length: (words, length + 1)."""
    alpha = np.full((table.shape[1] + 1, len(table)), -np.inf)
    alpha[0] = 0
    for i in range(table.shape[1]):
        for j, rows, piece in _walks(model.trie, table, i):
            alpha[j][rows] = np.logaddexp(alpha[j][rows], alpha[i][rows] + model.logs[piece])
    return alpha.T


def _expect(model: Model, table: np.ndarray, times: np.ndarray, counts: np.ndarray) -> None:
    """Add the expected uses of each piece in words (that occur ``times``) to ``counts``."""
    alpha = _forward(model, table).T
    total = alpha[-1]
    beta = np.full_like(alpha, -np.inf)
    beta[-1] = 0
    for i in range(table.shape[1] - 1, -1, -1):
        for j, rows, piece in _walks(model.trie, table, i):
            rest = model.logs[piece] + beta[j][rows]
            beta[i][rows] = np.logaddexp(beta[i][rows], rest)
            use = times[rows] * np.exp(alpha[i][rows] + rest - total[rows])
            np.add.at(counts, piece, use)


def _matches(trie: Trie, word: bytes, i: int) -> Iterator[tuple[int, int]]:
    """(end, piece) of the pieces that start at byte i of a word."""
    state, piece, only, child, forks, row = 0, trie.piece, trie.only, trie.child, trie.forks, trie.row
    for j in range(i, len(word)):
        byte = word[j]
        state = forks[row[state], byte] or (child[state] if only[state] == byte else 0)
        if not state:
            return
        if piece[state] >= 0:
            yield j + 1, int(piece[state])


def _forward_long(model: Model, word: bytes) -> np.ndarray:
    alpha = np.full(len(word) + 1, -np.inf)
    alpha[0] = 0
    for i in range(len(word)):
        for j, piece in _matches(model.trie, word, i):
            alpha[j] = np.logaddexp(alpha[j], alpha[i] + model.logs[piece])
    return alpha


def _expect_long(model: Model, word: bytes, times: float, counts: np.ndarray) -> None:
    alpha = _forward_long(model, word)
    beta = np.full(len(alpha), -np.inf)
    beta[-1] = 0
    for i in range(len(word) - 1, -1, -1):
        for j, piece in _matches(model.trie, word, i):
            rest = model.logs[piece] + beta[j]
            beta[i] = np.logaddexp(beta[i], rest)
            counts[piece] += times * np.exp(alpha[i] + rest - alpha[-1])


def _tables(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word numbers, table of bytes with a blank in front) of the short words, by length."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for size in np.unique(sizes[sizes < SIDE_BY_SIDE]).tolist():
        at = np.flatnonzero(sizes == size)
        for start in range(0, len(at), 20_000):
            own = at[start:start + 20_000]
            data = np.frombuffer(b"".join([words[k] for k in own.tolist()]), np.uint8)
            yield own, np.concatenate((np.full((len(own), 1), 32, np.uint8), data.reshape(len(own), size)),
                                      axis=1)


def word_logs(words: list[bytes], model: Model) -> np.ndarray:
    """Natural log probability of each word, over all its segmentations."""
    out = np.empty(len(words))
    for own, table in _tables(words):
        out[own] = _forward(model, table)[:, -1] + model.stop
    for k, word in enumerate(words):
        if len(word) >= SIDE_BY_SIDE:
            out[k] = _forward_long(model, b" " + word)[-1] + model.stop
    return out


def expected_uses(words: list[bytes], times: np.ndarray, model: Model) -> np.ndarray:
    """Expected uses of each piece in words that occur ``times``."""
    counts = np.zeros(len(model.pieces))
    for own, table in _tables(words):
        _expect(model, table, times[own], counts)
    for k, word in enumerate(words):
        if len(word) >= SIDE_BY_SIDE:
            _expect_long(model, b" " + word, float(times[k]), counts)
    return counts


# ------------------------------------------------------------- the flow ------

def _occurrences(numbers: np.ndarray, kinds: int) -> np.ndarray:
    """How often each number below ``kinds`` occurs; counted in parts, as numpy counts on wide copies."""
    out = np.zeros(kinds, np.int64)
    for start in range(0, len(numbers), 1 << 18):
        out += np.bincount(numbers[start:start + (1 << 18)], minlength=kinds)
    return out


def _as_one(values: pa.Array) -> pa.ListArray:
    """One list of all the values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _sliced(docs: DataFrame, id_col: str, text_col: str, learn: Column) -> DataFrame:
    """One row per slice: its distinct words with training counts, and its documents."""
    source = docs.select(F.col(id_col).alias("_id"), F.coalesce(learn, F.lit(False)).alias("_learn"),
                         F.col(text_col).alias("_text"))
    id_type = source.schema["_id"].dataType
    schema = StructType([
        StructField("slice", StringType()), StructField("words", ArrayType(BinaryType())),
        StructField("counts", ArrayType(LongType())), StructField("ids", ArrayType(id_type)),
        StructField("learned", ArrayType(BooleanType())), StructField("sizes", ArrayType(LongType())),
        StructField("tokens", BinaryType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:  # bounded by Spark in rows and bytes; one text at a time is unpacked
            learned = batch.column(1).to_pylist()
            number: dict[bytes, int] = {}
            sizes, parts, name = np.zeros(batch.num_rows, np.int64), [], xxhash.xxh3_128()
            for k, text in enumerate(batch.column(2)):
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                name.update(len(raw).to_bytes(8, "little") + raw)
                words = raw.lower().split()
                for word in {*words}:
                    if word not in number:
                        number[word] = len(number)
                sizes[k] = len(words)
                parts.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
            name.update(repr(batch.column(0).to_pylist()).encode())
            names = pa.array(list(number), pa.binary())
            del number
            tokens = np.concatenate([*parts, np.zeros(0, np.int32)])
            del parts
            # frequent words get small numbers, which pack well
            order = np.argsort(-_occurrences(tokens, len(names)), kind="stable")
            place = np.empty(len(names), np.int32)
            place[order] = np.arange(len(names), dtype=np.int32)
            tokens = place[tokens]
            counts = _occurrences(tokens[np.repeat(np.array(learned, bool), sizes)], len(names))
            packed = zstandard.compress(tokens, 1)
            del tokens
            yield pa.RecordBatch.from_arrays([
                pa.array([name.hexdigest()]), _as_one(names.take(pa.array(order))), _as_one(pa.array(counts)),
                _as_one(batch.column(0)), _as_one(pa.array(learned, pa.bool_())), _as_one(pa.array(sizes)),
                pa.array([packed], pa.binary())],
                names=schema.names)

    return map_arrow(source, work, schema)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together to about ``TOGETHER`` rows: many words of each length go side by side."""
    waiting, rows = [], 0
    for batch in batches:
        waiting.append(batch)
        rows += batch.num_rows
        if rows >= TOGETHER:
            yield pa.Table.from_batches(waiting)
            waiting, rows = [], 0
    if rows:
        yield pa.Table.from_batches(waiting)


def _learned(words: DataFrame, model: Model, ends: int, stops: int) -> Model:
    """One round of expectation-maximisation over the training words."""
    held = words.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(held.value.pieces))
        for batch in _gathered(batches):
            counts += expected_uses(batch["word"].to_pylist(), batch["c"].to_numpy().astype(float), held.value)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["piece", "uses"])

    uses = (map_arrow(words.where("c > 0").select("word", "c"), work, "piece long, uses double")
            .groupBy("piece").agg(F.sum("uses").alias("uses")).toPandas())
    counts = np.zeros(len(model.pieces))
    counts[uses["piece"].to_numpy(int)] = uses["uses"]
    return _normal(model.pieces, counts + SMOOTHING, ends + SMOOTHING, stops + SMOOTHING)


def score(docs: DataFrame, learn: Column, vocab_path: str, id_col: str = "doc_id",
          text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``learn`` tells the training rows. Scores are log10 probabilities: ``base_score`` under
    words counted in training plus 0.1, ``score`` under the piece model.
    """
    spark = docs.sparkSession
    sliced = stored(_sliced(docs, id_col, text_col, learn), "lattice-slices")
    at = F.posexplode(F.arrays_zip("words", "counts"))
    placed = sliced.select("slice", at).select("slice", "pos", F.col("col.words").alias("word"),
                                               F.col("col.counts").alias("c"))
    words = stored(placed.groupBy("word").agg(F.sum("c").alias("c")), "lattice-words")
    known, occurrences = words.where("c > 0").agg(F.count("*"), F.coalesce(F.sum("c"), F.lit(0))).first()
    ends = sliced.select(F.explode("learned").alias("l")).where("l").count()
    train_tokens, kinds = occurrences + ends, known + (ends > 0)
    model = initial_model(vocab_path)
    for _ in range(rounds if ends else 0):
        model = _learned(words, model, ends, occurrences)
    held = spark.sparkContext.broadcast(model)

    def value(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches):
            logs = word_logs(batch["word"].to_pylist(), held.value)
            yield from batch.append_column("log", pa.array(logs)).to_batches(max_chunksize=50_000)

    valued = map_arrow(words, value, "word binary, c long, log double")
    back = placed.drop("c").join(valued, "word").select(F.col("slice").alias("of"), "pos", "c", "log")
    id_type = docs.schema[id_col].dataType
    schema = StructType([
        StructField(id_col, id_type), StructField("held_out", BooleanType()),
        StructField("n_tokens", LongType()), StructField("n_known", LongType()),
        StructField("train_tokens", LongType()), StructField("base_score", DoubleType()),
        StructField("score", DoubleType())])
    norm = np.log10(train_tokens + 0.1 * (kinds + 1))
    ten, end_log = np.log(10), model.end

    def total(left: pa.Table, right: pa.Table) -> pa.Table:
        pos = right["pos"].to_numpy()
        c, logs = np.empty(len(pos)), np.empty(len(pos))
        c[pos], logs[pos] = right["c"].to_numpy(), right["log"].to_numpy()
        values = np.stack((c > 0, np.log10(c + 0.1), logs / ten))
        out = []
        # slices of equal contents and ids are equal rows: each is summed up by itself
        for row in left.select(["ids", "learned", "sizes", "tokens"]).to_batches(max_chunksize=1):
            ids, learned = row.column(0).flatten(), row.column(1).flatten()
            sizes = row.column(2).flatten().to_numpy()
            tokens = np.frombuffer(zstandard.decompress(row.column(3)[0].as_py()), np.int32)
            ends_at = np.concatenate(([0], np.cumsum(sizes)))
            sums = np.zeros((3, len(sizes)))
            full = np.flatnonzero(sizes)
            if len(full):
                for k in range(3):
                    sums[k, full] = np.add.reduceat(values[k][tokens], ends_at[full])
            n = sizes + 1
            out.append(pa.Table.from_arrays([
                ids, pa.array(~learned.to_numpy(zero_copy_only=False)), pa.array(n),
                pa.array(sums[0].astype(np.int64) + (ends > 0)),
                pa.array(np.full(len(n), train_tokens)),
                pa.array(sums[1] + np.log10(ends + 0.1) - n * norm), pa.array(sums[2] + end_log / ten)],
                names=schema.names))
        return pa.concat_tables(out)

    ship(spark)
    # the words themselves have done their part: they need not go along
    left = sliced.select("slice", "ids", "learned", "sizes", "tokens")
    return left.groupBy("slice").cogroup(back.groupBy("of")).applyInArrow(total, schema)

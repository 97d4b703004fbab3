"""Collocations counted in quotient filters (operator 13).

Texts are lower-cased (A-Z) and split at ``.,;:!?`` and line ends into pieces, pieces at blanks and
tabs into words; everything is counted per language (null: ``und``).

1. Words are counted per language. A word's id is a 64-bit hash of language and word under a
   seed that gives all distinct words different ids: the table of words is checked, and a
   seed with a collision gives way to the next.
2. A phrase of n words is a key of 64 n bits, the packed ids. Rounds of a cyclic Feistel network
   permute the key invertibly; the leading bits of the result are the quotient, which addresses a bin
   of a counting quotient filter, the rest is a remainder stored in full. Counters are therefore exact, and
   the phrase comes back by running the rounds backwards.
3. Every task sums its slices into one sorted filter of bounded size and sends a bin's run of
   remainders and counts as one row; a bin's runs from all shards are merged in order. The number of
   bins follows the number of words, so a bin holds at most about ``BIN_KEYS`` keys,
   and a phrase that makes up a third of the corpus is one entry of each run.
4. A phrase that occurs ``least`` times holds only shorter phrases that do. Where n words are
   counted, a bitmap of 2 ** ``MARK_BITS`` bits marks the frequent phrases of n - 1 words (of words for
   n = 2), and occurrences with an unmarked part are passed over. A wrong mark only costs an entry.
5. Frequent phrases, cut after each word, are joined with the counts of their two parts.

Only the bitmap, of a fixed size, is broadcast. A null or empty text has no words; repeated rows
count each; a row without an id counts like any other (ids are not read). An empty table
gives an empty table. Whole texts are read; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, slices, stored

#: Distinct keys that a bin is sized for, and entries after which a task's filter is sent on.
BIN_KEYS = 1 << 20
FILTER_KEYS = 1 << 20
#: Fewest bins: so many tasks can merge.
LEAST_BINS = 64
#: Bits of the marks of frequent parts: 8 MB.
MARK_BITS = 26
#: Words whose id or count a task remembers at once, and their bytes.
MEMO_WORDS, MEMO_BYTES = 400_000, 32_000_000
#: Most words of a phrase.
LONGEST = 4

#: Text bytes as the words see them: A-Z lower, piece ends one full stop.
_PLAIN = bytes.maketrans(bytes(range(65, 91)) + b",;:!?\n\x0b\x0c\r",
                         bytes(range(97, 123)) + b"." * 9)


def words(text: str | None) -> list[bytes]:
    """The words of a text; a full stop, which no word can hold, stands for each piece end."""
    if not text:
        return []
    return text.encode("utf-8", "surrogatepass").translate(_PLAIN).replace(b".", b" . ").split()


class Ids(dict):
    """Ids of one language's words; 0 for a piece end."""

    def __init__(self, lang: str, seed: int):
        super().__init__({b".": 0})
        self.seed = xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass"), seed)
        self.size = 0

    def __missing__(self, word: bytes) -> int:
        self.size += len(word)
        value = self[word] = xxhash.xxh3_64_intdigest(word, self.seed)
        return value


def _mixed(x: np.ndarray, turn: int) -> np.ndarray:
    x = (x + np.uint64(turn)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def permuted(lanes: np.ndarray) -> np.ndarray:
    """Keys (one row a key, one column a word id) after two rounds; a single word is its own."""
    out, width = lanes.copy(), lanes.shape[1]
    if width > 1:
        for turn in range(2 * width):
            own = turn % width
            out[:, own] ^= _mixed(out[:, own - 1], turn)
    return out


def restored(lanes: np.ndarray) -> np.ndarray:
    """The inverse of :func:`permuted`."""
    out, width = lanes.copy(), lanes.shape[1]
    if width > 1:
        for turn in range(2 * width - 1, -1, -1):
            own = turn % width
            out[:, own] ^= _mixed(out[:, own - 1], turn)
    return out


def leading(lanes: np.ndarray, bits: int) -> np.ndarray:
    """The first bits of a permuted key. Its last changed word is the last one."""
    return (lanes[:, -1] >> np.uint64(64 - bits)).astype(np.int64)


def summed(lanes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One filter of entries in any order: sorted by permuted key, equal keys added up."""
    if not len(lanes):
        return lanes, counts
    order = np.argsort(lanes[:, -1], kind="stable")
    lanes, counts = lanes[order], counts[order]
    same = lanes[1:, -1] == lanes[:-1, -1]
    if (lanes[1:][same] != lanes[:-1][same]).any():  # keys that differ in other words only: sort by all
        order = np.lexsort(lanes.T)
        lanes, counts = lanes[order], counts[order]
    new = np.ones(len(lanes), bool)
    new[1:] = (lanes[1:] != lanes[:-1]).any(axis=1)
    at = np.flatnonzero(new)
    return lanes[at], np.add.reduceat(counts, at)


class Filter:
    """A counting quotient filter that grows by sorted runs; merged when the runs have doubled it."""

    def __init__(self, width: int):
        self.width, self.runs, self.held, self.whole = width, [], 0, 0

    def add(self, lanes: np.ndarray, counts: np.ndarray) -> None:
        if len(lanes):
            self.runs.append((lanes, counts))
            self.held += len(lanes)
            if self.held > 2 * self.whole + FILTER_KEYS // 4:
                self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.runs:
            return np.zeros((0, self.width), np.uint64), np.zeros(0, np.int64)
        if len(self.runs) > 1:
            self.runs = [summed(np.concatenate([r[0] for r in self.runs]), np.concatenate([r[1] for r in self.runs]))]
        self.held = self.whole = len(self.runs[0][0])
        return self.runs[0]

    def clear(self) -> None:
        self.runs, self.held, self.whole = [], 0, 0


def packed(lanes: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    """Remainders and counts, the latter in as few bytes as the largest needs."""
    kind = next(k for k in ("<u1", "<u2", "<u4", "<i8") if counts.max() <= np.iinfo(k).max)
    return lanes.tobytes(), counts.astype(kind).tobytes()


def unpacked(keys: bytes, counts: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    lanes = np.frombuffer(keys, np.uint64).reshape(-1, width)
    kind = {1: "<u1", 2: "<u2", 4: "<u4", 8: "<i8"}[len(counts) // len(lanes)]
    return lanes, np.frombuffer(counts, kind).astype(np.int64)


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.col(text_col).alias("text")).where("text is not null")


def vocabulary(texts: DataFrame, seed: int) -> DataFrame:
    """(lang, word, id, f): every distinct word with its id and count."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, dict] = {}
        held = size = 0
        for batch, values in slices(batches, 1, max_chars=2_000_000):
            for lang, text in zip(batch.column(0).to_pylist(), values, strict=True):
                own = counts.setdefault(lang, {})
                for word in words(text):
                    if word in own:
                        own[word] += 1
                    else:
                        own[word] = 1
                        held += 1
                        size += len(word)
                if held > MEMO_WORDS or size > MEMO_BYTES:
                    yield from rows(counts)
                    counts, held, size = {}, 0, 0
        yield from rows(counts)

    def rows(counts: dict) -> Iterator[pa.RecordBatch]:
        for lang, own in counts.items():
            own.pop(b".", None)
            names, ids = list(own), Ids(lang, seed)
            found = np.fromiter(map(ids.__getitem__, names), np.uint64, len(names)).view(np.int64)
            for start in range(0, len(names), 20_000):
                part = slice(start, start + 20_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(names[part]), pa.string()),
                     pa.array(names[part], pa.binary()).cast(pa.string()), pa.array(found[part]),
                     pa.array(list(own.values())[part], pa.int64())], names=["lang", "word", "id", "f"])

    return (map_arrow(texts, work, "lang string, word string, id long, f long")
            .groupBy("lang", "word", "id").agg(F.sum("f").alias("f")))


def _distinct_ids(texts: DataFrame, tries: int = 20) -> tuple[DataFrame, int]:
    """The vocabulary under the first seed that gives every word an id of its own, none of them 0."""
    for seed in range(tries):
        found = stored(vocabulary(texts, seed), "collocations-words")
        twice = found.groupBy("id").agg(F.count("*").alias("n")).where("n > 1 or id = 0")
        if twice.isEmpty():
            return found, seed
    raise RuntimeError("no seed gives all words different ids")


def marks(keys: DataFrame) -> bytes:
    """A bitmap of the ``mark`` column, at most 2 ** MARK_BITS bits whatever the number of keys."""
    cells = (keys.groupBy(F.shiftright("mark", 6).alias("cell"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(mark & 63 as int))")).alias("bits")).toArrow())
    out = np.zeros(1 << (MARK_BITS - 6), np.int64)
    out[cells["cell"].to_numpy()] = cells["bits"].to_numpy()
    return out.tobytes()


def phrase_counts(texts: DataFrame, width: int, known: bytes, seed: int, least: int, total: int) -> DataFrame:
    """(key, f, mark) of all phrases of ``width`` words with at least ``least`` occurrences.

    ``key`` packs the word ids, ``known`` marks the frequent phrases of one word less; ``total`` is
    the number of words, from which the number of bins follows.
    """
    shared = texts.sparkSession.sparkContext.broadcast(known)
    bits = max(LEAST_BINS - 1, total // BIN_KEYS).bit_length()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.frombuffer(shared.value, np.uint8)
        memo: dict[str, Ids] = {}
        filled = Filter(width)

        def is_marked(lanes: np.ndarray) -> np.ndarray:
            at = leading(permuted(lanes), MARK_BITS)
            return (marked[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)

        for batch, values in slices(batches, 1, max_chars=2_000_000):
            runs = []
            for lang, text in zip(batch.column(0).to_pylist(), values, strict=True):
                ids = memo.get(lang)
                if ids is None or len(ids) > MEMO_WORDS or ids.size > MEMO_BYTES:
                    ids = memo[lang] = Ids(lang, seed)
                found = words(text)
                runs += [np.fromiter(map(ids.__getitem__, found), np.uint64, len(found)), np.zeros(1, np.uint64)]
            flat = np.concatenate(runs)
            if len(flat) < width:
                continue
            parts = np.lib.stride_tricks.sliding_window_view(flat, width - 1)
            whole = np.flatnonzero((parts != 0).all(axis=1))
            good = np.zeros(len(parts), bool)
            good[whole] = is_marked(parts[whole])
            at = np.flatnonzero(good[:-1] & good[1:])
            lanes = np.lib.stride_tricks.sliding_window_view(flat, width)[at]
            filled.add(*summed(permuted(lanes), np.ones(len(at), np.int64)))
            if filled.held > FILTER_KEYS:
                filled.merge()
                if filled.held > FILTER_KEYS // 2:
                    yield from bins(*filled.merge())
                    filled.clear()
        yield from bins(*filled.merge())

    def bins(lanes: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(lanes):
            return
        own = leading(lanes, bits)
        cuts = [0, *(np.flatnonzero(np.diff(own)) + 1).tolist(), len(own)]
        data = [packed(lanes[a:b], counts[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
        for start in range(0, len(data), 256):
            part = data[start:start + 256]
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[cuts[start:start + len(part)]]), pa.array([d[0] for d in part], pa.binary()),
                 pa.array([d[1] for d in part], pa.binary())], names=["bin", "keys", "counts"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, filled = None, Filter(width)
        for batch in batches:
            for place, keys, counts in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if place != current:
                    yield from frequent(*filled.merge())
                    current, filled = place, Filter(width)
                filled.add(*unpacked(keys, counts, width))
        yield from frequent(*filled.merge())

    def frequent(lanes: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        kept = counts >= least
        if kept.any():
            lanes = lanes[kept]
            mark, ids = leading(lanes, MARK_BITS), restored(lanes)
            for start in range(0, len(lanes), 50_000):
                part = slice(start, start + 50_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k.tobytes() for k in ids[part].astype(">u8")], pa.binary()),
                     pa.array(counts[kept][part]), pa.array(mark[part])], names=["key", "f", "mark"])

    # a bin of its own for each run: bins are many and of one size
    runs = map_arrow(texts, count, "bin long, keys binary, counts binary")
    dealt = runs.repartition("bin").sortWithinPartitions("bin")
    return stored(map_arrow(dealt, merge, "key binary, f long, mark long"), f"collocations-{width}")


def _cut_scores(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """(key, a, l, r, score) of each candidate's lowest-scoring cut; arithmetic in decimals."""
    at = F.explode(F.sequence(F.lit(1), (F.length("key") / 8).cast("int") - 1))
    cuts = (candidates.select("key", F.col("f").alias("a"), at.alias("k"))
            .withColumn("left", F.expr("substring(key, 1, 8 * k)"))
            .withColumn("rest", F.expr("substring(key, 8 * k + 1, length(key) - 8 * k)")))
    left = counts.select(F.col("key").alias("left"), F.col("f").alias("l"))
    rest = counts.select(F.col("key").alias("rest"), F.col("f").alias("r"))
    score = F.expr("2000000 * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    scored = cuts.join(left, "left").join(rest, "rest").select("key", "a", "k", "l", "r", score.alias("score"))
    best = scored.groupBy("key", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    return best.select("key", "a", "best.l", "best.r", "best.score")


def _within_longer(candidates: DataFrame) -> DataFrame:
    """(key, longer): the count of the most frequent longer candidate around each phrase of two words or more."""
    inner = [f"struct({8 * at + 1} as start, {8 * size} as size, {8 * (at + size)} as stop)"
             for size in range(2, LONGEST) for at in range(LONGEST - size + 1)]
    parts = F.explode(F.expr(f"filter(array({', '.join(inner)}), p -> p.stop <= length(key) and p.size < length(key))"))
    return (candidates.where(F.length("key") > 16).select("key", "f", parts.alias("p"))
            .select(F.expr("substring(key, p.start, p.size)").alias("key"), "f")
            .groupBy("key").agg(F.max("f").alias("longer")))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 30,
                 top: int = 2_000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2 to 4 words.

    ``a`` counts the phrase, which occurs at least ``least`` times, ``l`` and ``r`` the two parts at the cut with
    the lowest ``score`` floor(2000000 a / (l + r)) (ties to the earliest cut), ``n`` the language's words. Phrases inside
    a longer one that occurs at least 0.8 times as often are left out. Ranks go by score, count (both descending),
    phrase.
    """
    texts = _texts(docs, text_col, lang_col)
    found, seed = _distinct_ids(texts)
    sizes = found.groupBy("lang").agg(F.sum("f").alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    # a single word is its own permuted key
    often = stored(found.where(F.col("f") >= least).select(
        "lang", "word", "id", "f", F.shiftrightunsigned("id", 64 - MARK_BITS).alias("mark")), "collocations-often")
    key = F.unhex(F.lpad(F.hex("id"), 16, "0"))
    counted = [often.select(key.alias("key"), "f")]
    known = marks(often)
    for width in range(2, LONGEST + 1):
        counts = phrase_counts(texts, width, known, seed, least, total)
        counted.append(counts.select("key", "f"))
        if width < LONGEST:
            known = marks(counts)
    candidates = counted[1]
    for more in counted[2:]:
        candidates = candidates.unionByName(more)
    counts = candidates.unionByName(counted[0])
    scored = (_cut_scores(candidates, counts).join(_within_longer(candidates), "key", "left")
              .where(F.coalesce(F.expr("100 * cast(longer as decimal(20,0)) < 80 * cast(a as decimal(20,0))"),
                                F.lit(True))).drop("longer"))
    scored = stored(scored, "collocations-scored")
    place = F.posexplode(F.expr("transform(sequence(1, length(key), 8), i -> substring(key, i, 8))"))
    named = (scored.select("key", place).select("key", "pos", F.col("col").alias("word_key"))
             .join(often.select(key.alias("word_key"), "lang", "word"), "word_key")
             .groupBy("key").agg(F.first("lang").alias("lang"),
                                 F.sort_array(F.collect_list(F.struct("pos", "word"))).alias("words"))
             .select("key", "lang", F.concat_ws(" ", "words.word").alias("phrase")))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # first inside 64 parts of each language, so that a large language is no single task
    part = F.pmod(F.xxhash64("key"), F.lit(64))
    rows = (scored.join(named, "key").withColumn("_part", part)
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order)))
            .where(F.col("rank") <= top)
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
            .where(F.col("rank") <= top))
    return rows.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                                           "n", F.col("score").cast("long").alias("score"))

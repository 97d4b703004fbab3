"""Near-duplicate documents by HyperMinHash (operator 9).

A document's set holds the hashes of its distinct runs of ``width`` words (A-Z
lower-cased). Its sketch has ``BUCKETS`` buckets; each orders all hashes by a linear
permutation of its own and keeps the least value compressed to its number of leading zeros and
``MANTISSA`` bits after the leading one. (One permutation shared by all buckets
would leave most of them empty on short documents.)

1. Documents with equal sets become one class, named by its smallest id.
2. Classes that agree in all registers of a band share a band bucket. Within
   buckets, the share of equal registers, corrected for collisions of the
   compressed values, estimates the similarity; classes more than six standard
   deviations below the threshold are told apart, the others form groups.
3. Within groups, links are confirmed on the full sets, and connected components
   follow from the links.

Steps 2 and 3 look at all pairs of a bucket or group inside numpy blocks of at most
about ``BLOCK`` classes a side and give back only spanning links, so neither pairs nor
large groups are ever rows or one task: a large group is dealt over all pairs
of its blocks. Band buckets miss a pair of similarity 0.8 with probability 3e-6.

Without words or text (or a null text), a document is linked with nothing; with
fewer than ``width`` words its whole sequence is the one shingle. A row without an id gets
its set size, no component and is kept. Every row counts as a document,
repeated rows included; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from .common import map_arrow, others, slices, stored
from .components import components

BANDS, ROWS = 42, 6
BUCKETS = BANDS * ROWS
MANTISSA = 10
#: Most classes of a block, and shingles of a block; blocks meet in pairs.
BLOCK, BLOCK_SHINGLES = 1_024, 2_000_000
#: Words whose hash a worker remembers; the memo starts anew when full.
MEMO_WORDS = 500_000

_chance = np.random.default_rng(9)
TIMES = _chance.integers(0, 1 << 31, BUCKETS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
PLUS = _chance.integers(0, 1 << 32, BUCKETS, dtype=np.uint32)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0x9E3779B97F4A7C15) ^ (b + np.uint64(0x632BE59BD9B4E019))
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def shingles(text: str | None, width: int, hashes: dict) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct runs of ``width`` words."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else ()
    if not words:
        return np.zeros(0, np.uint64)
    one = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    run = min(width, len(words))
    out = one[:len(words) - run + 1]
    for k in range(1, run):
        out = _mixed(out, one[k:len(words) - run + 1 + k])
    if run < width:
        out = _mixed(out, np.array([run], np.uint64))
    return np.unique(out)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """Compressed least values, one row of ``BUCKETS`` 16-bit registers for each non-empty set."""
    flat = np.concatenate(sets)
    flat = (flat ^ (flat >> np.uint64(32))).astype(np.uint32)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    least = np.empty((BUCKETS, len(sets)), np.uint32)
    value = np.empty_like(flat)
    for k in range(BUCKETS):
        np.multiply(flat, TIMES[k], out=value)
        value += PLUS[k]
        np.minimum.reduceat(value, starts, out=least[k])
    return compress(least.T)


def compress(value: np.ndarray) -> np.ndarray:
    """32-bit values as leading zeros (high 6 bits) and the ``MANTISSA`` bits after the leading one."""
    bits = np.frexp(value.astype(np.float64))[1]  # length in bits; 0 for 0
    rest = value.astype(np.uint64) << (33 - bits).astype(np.uint64) & np.uint64(0xFFFFFFFF)
    return ((32 - bits).astype(np.uint16) << np.uint16(MANTISSA)) | (rest >> np.uint64(32 - MANTISSA)).astype(np.uint16)


def collisions(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Chance that the registers of disjoint sets of n and m shingles are equal.

    The least of n values exceeds t (a share of the range) with probability exp(-n t);
    between 2^-(z+1) and 2^-z a register's cell is 2^-(z+1) / 2^MANTISSA wide.
    """
    both, total = n * m / (n + m), np.zeros(np.broadcast(n, m).shape)
    for zeros in range(33):
        edge = 2.0 ** -(zeros + 1)
        total += edge / (1 << MANTISSA) * both * (np.exp(-(n + m) * edge) - np.exp(-(n + m) * 2 * edge))
    return total


def plausible(equal: np.ndarray, n: np.ndarray, m: np.ndarray, share: float) -> np.ndarray:
    """Whether sets of n and m shingles with ``equal`` equal registers may be as similar as ``share``."""
    by_chance = collisions(n, m)
    estimate = (equal / BUCKETS - by_chance) / (1 - by_chance)
    floor = share - 6 * np.sqrt(share * (1 - share) / BUCKETS)
    return (estimate >= floor) & (np.minimum(n, m) >= share * np.maximum(n, m) - 1e-9)


def _spanning(near: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links from each node to the smallest name of its component; ``near``: symmetric matrix."""
    left = np.ones(len(names), bool)
    a, b = [], []
    for start in np.argsort(names, kind="stable"):
        if left[start]:
            found = np.zeros(len(names), bool)
            found[start] = True
            edge = found
            while edge.any():
                edge = near[edge].any(axis=0) & ~found
                found = found | edge
            left &= ~found
            found[start] = False
            a.append(names[found])
            b.append(np.full(found.sum(), names[start]))
    return np.concatenate(a), np.concatenate(b)


def _both_ways(cross: np.ndarray, first: np.ndarray, second: np.ndarray, count: int) -> np.ndarray:
    near = np.zeros((count, count), bool)
    near[np.ix_(first, second)] = cross
    return near | near.T


def _sides(batch: dict, own: slice) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the group's two blocks (the same rows twice if a block meets itself)."""
    if batch["i"][own.start] == batch["j"][own.start]:
        rows = np.arange(own.stop - own.start)
        return rows, rows
    first = batch["part"][own] == batch["i"][own]
    return np.flatnonzero(first), np.flatnonzero(~first)


def near_by_registers(batch: dict, own: slice, share: float) -> np.ndarray:
    """Plausible pairs of a bucket's two blocks."""
    first, second = _sides(batch, own)
    sketch, n = batch["data"][own], batch["n"][own].astype(float)
    equal = np.empty((len(first), len(second)), np.int32)
    for k, row in enumerate(first):
        equal[k] = np.count_nonzero(sketch[second] == sketch[row], axis=1)
    return _both_ways(plausible(equal, n[first][:, None], n[second][None, :], share),
                      first, second, own.stop - own.start)


def near_by_sets(batch: dict, own: slice, share: float) -> np.ndarray:
    """Pairs of a group's two blocks that are linked, by the full sets.

    Shared shingles are counted by products of 0/1 matrices, 2,048
    shingles at a time; shingles of one document only are left out.
    """
    first, second = _sides(batch, own)
    sets, n = batch["data"][own], batch["n"][own].astype(np.int64)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    kept = count[column] > 1
    row, column = row[kept], (np.cumsum(count > 1) - 1)[column[kept]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    shared = np.zeros((len(first), len(second)))
    width = 2048
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, (start, start + width))
        has = np.zeros((len(sets), min(width, int(column[-1]) + 1 - start)), np.float32)
        has[row[a:b], column[a:b] - start] = 1
        shared += has[first] @ has[second].T
    union = n[first][:, None] + n[second][None, :] - shared
    linked = 100 * shared >= round(100 * share) * union
    return _both_ways(linked, first, second, len(sets))


def pair_by_registers(batch: dict, first: np.ndarray, second: np.ndarray, share: float) -> np.ndarray:
    """Whether the classes at ``first`` and ``second`` are plausible, pair by pair."""
    n = batch["n"].astype(float)
    equal = np.count_nonzero(batch["data"][first] == batch["data"][second], axis=1)
    return plausible(equal, n[first], n[second], share)


def pair_by_sets(batch: dict, first: np.ndarray, second: np.ndarray, share: float) -> np.ndarray:
    """Whether the classes at ``first`` and ``second`` are linked, pair by pair."""
    sets = batch["data"]
    shared = np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                       for a, b in zip(first, second, strict=True)])
    return 100 * shared >= round(100 * share) * (batch["n"][first] + batch["n"][second] - shared)


def _grouped(near: Callable, near_pair: Callable, to_data: Callable, share: float) -> Callable:
    """Arrow work over rows sorted by (place, i, j): spanning links of every group.

    ``near`` gives the matrix of near pairs of a group; groups of two go together to ``near_pair``.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            last = [batch.column(c)[batch.num_rows - 1].as_py() for c in range(3)]
            same = np.ones(batch.num_rows, bool)
            for c in range(3):
                same &= batch.column(c).to_numpy() == last[c]
            cut = int(np.argmax(same))  # where the group that may go on begins
            begun = waiting and last != [waiting[-1].column(c)[0].as_py() for c in range(3)]
            if cut or begun:
                yield links([*waiting, batch.slice(0, cut)])
                waiting = []
            waiting.append(batch.slice(cut))
        if waiting:
            yield links(waiting)

    def links(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(parts)
        batch = {c: whole[c].to_numpy() for c in ("place", "i", "j", "part", "rep", "n")}
        batch["data"] = to_data(whole["data"])
        new = np.ones(len(batch["rep"]), bool)
        new[1:] = (batch["place"][1:] != batch["place"][:-1]) | (batch["i"][1:] != batch["i"][:-1]) \
            | (batch["j"][1:] != batch["j"][:-1])
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(new)))
        a, b = [], []
        twos = starts[(sizes == 2) & (batch["i"][starts] == batch["j"][starts])]
        if len(twos):
            twos = twos[near_pair(batch, twos, twos + 1, share)]
            a.append(batch["rep"][twos])
            b.append(batch["rep"][twos + 1])
        for start, size in zip(starts.tolist(), sizes.tolist(), strict=True):
            if size > 2 or size == 2 and batch["i"][start] != batch["j"][start]:
                own = slice(start, start + size)
                x, y = _spanning(near(batch, own, share), batch["rep"][own])
                a.append(x)
                b.append(y)
        empty = np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a) if a else empty),
                                           pa.array(np.concatenate(b) if b else empty)], names=["a", "b"])

    return work


def _dealt(members: DataFrame, blocks) -> DataFrame:
    """Rows (place, rep, ...) dealt to all pairs of their place's blocks: adds part, i and j."""
    part = F.pmod(F.xxhash64("rep"), F.col("_blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1))
    return (members.withColumn("_blocks", blocks).withColumn("part", part)
            .withColumn("_other", other)
            .withColumn("i", F.least("part", "_other")).withColumn("j", F.greatest("part", "_other"))
            .drop("_blocks", "_other"))


def _spanning_links(rows: DataFrame, work: Callable) -> DataFrame:
    """Run ``work`` over the rows brought together by (place, i, j)."""
    ordered = (rows.select("place", "i", "j", "part", "rep", "n", "data")
               .repartition("place", "i", "j").sortWithinPartitions("place", "i", "j", "rep"))
    return map_arrow(ordered, work, "a long, b long")


def _to_registers(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), BUCKETS)


def _to_sets(column: pa.ChunkedArray) -> list[np.ndarray]:
    out = np.empty(len(column), object)
    for k, data in enumerate(column.to_pylist()):
        out[k] = np.frombuffer(data, np.uint64)
    return out


def sketches(docs: DataFrame, id_col: str, text_col: str, width: int, keep: list[str]) -> DataFrame:
    """(_id, n, key, registers, kept columns) of every row; key and registers are null for an empty set."""
    source = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"),
                         *[F.col(f"`{c}`").alias(f"k_{c}") for c in keep])
    schema = StructType([StructField("_id", LongType()), StructField("n", LongType()),
                         StructField("key", BinaryType()), StructField("registers", BinaryType()),
                         *source.schema.fields[2:]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch, texts in slices(batches, 1, max_chars=2_000_000):
            if len(hashes) > MEMO_WORDS:
                hashes.clear()
            sets = [shingles(t, width, hashes) for t in texts]
            full = [s for s in sets if len(s)]
            packed = iter(registers(full)) if full else iter(())
            key = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            data = [next(packed).tobytes() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(key, pa.binary()), pa.array(data, pa.binary()), *batch.columns[2:]],
                names=schema.names)

    return map_arrow(source, work, schema)


def _groups(classes: DataFrame, share: float) -> DataFrame:
    """(node, component): classes that may be similar, by bands and register estimates."""
    band = F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(
        b, F.substring("data", b * (2 * ROWS) + 1, F.lit(2 * ROWS)))))
    members = classes.select("rep", band).select("rep", F.col("col").alias("place"))
    shared = members.groupBy("place").agg(F.count("*").alias("_count")).where("_count > 1")
    dealt = _dealt(members.join(shared, "place"), F.ceil(F.col("_count") / BLOCK)).drop("_count")
    rows = dealt.join(classes.select("rep", "n", "data"), "rep")
    return components(_spanning_links(
        rows, _grouped(near_by_registers, pair_by_registers, _to_registers, share)))


def _links(docs: DataFrame, classes: DataFrame, groups: DataFrame, id_col: str, text_col: str, width: int,
           share: float) -> DataFrame:
    """(a, b): spanning links of the classes in each group, confirmed on full sets."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch, texts in slices(batches, 1, max_chars=2_000_000):
            if len(hashes) > MEMO_WORDS:
                hashes.clear()
            sets = [shingles(t, width, hashes) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                 pa.array([s.tobytes() for s in sets], pa.binary())], names=["rep", "key", "data"])

    placed = groups.join(classes.select(F.col("rep").alias("node"), "n", "key"), "node")
    placed = placed.select(F.col("node").alias("rep"), F.col("component").alias("place"), "n", "key")
    sizes = placed.groupBy("place").agg(F.count("*").alias("_count"), F.sum("n").alias("_total"))
    texts = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).alias("_text")).where(
        F.col("_text").isNotNull()).join(placed.select("rep"), "rep", "left_semi")
    # repeated rows give the same set; an id given to several texts has one for each of its classes
    sets = (stored(map_arrow(texts, work, "rep long, key binary, data binary"), "neardup-sets")
            .dropDuplicates(["rep", "key"]))
    blocks = F.greatest(F.ceil(F.col("_count") / BLOCK), F.ceil(F.col("_total") / BLOCK_SHINGLES))
    dealt = _dealt(placed.join(sizes, "place"), blocks).drop("_count", "_total")
    return _spanning_links(dealt.join(sets, ["rep", "key"]), _grouped(near_by_sets, pair_by_sets, _to_sets, share))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                    share: float = 0.8, keep: list[str] | None = None) -> DataFrame:
    """(id_col, n_shingles, component_id, kept, columns of ``keep``): one row per document.

    Documents whose sets' Jaccard similarity is at least ``share`` (a multiple of 0.01) are linked;
    ``component_id`` is the smallest id that links lead to, and ``kept`` marks it. Ids are integers.
    """
    keep = [c for c in others(docs, id_col, "n_shingles", "component_id", "kept") if c in (keep or ())]
    sketched = stored(sketches(docs, id_col, text_col, width, keep), "neardup-sketches")
    classes = stored(
        sketched.where("n > 0 and _id is not null").groupBy("key")
        .agg(F.min("_id").alias("rep"), F.first("n").alias("n"), F.first("registers").alias("data")),
        "neardup-classes")
    groups = stored(_groups(classes, share), "neardup-groups")
    linked = components(_links(docs, classes, groups, id_col, text_col, width, share))
    names = classes.select("key", F.col("rep").alias("node")).join(linked, "node", "left").select(
        "key", F.coalesce("component", "node").alias("component"))
    out = sketched.drop("registers").join(names, "key", "left")
    component = F.when(F.col("_id").isNotNull(), F.coalesce("component", "_id"))
    return out.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"),
                      component.alias("component_id"),
                      F.coalesce(F.col("_id") == component, F.lit(True)).alias("kept"),
                      *[F.col(f"`k_{c}`").alias(c) for c in keep])

"""Byte-level BPE by corpus-level merge replay (operator 3).

The distinct pre-tokens of a slice of the corpus are laid out as one long
sequence of byte tokens. An inverted index maps every applicable merge to the
positions of its pair; merges are applied in rank order over all words at
once, and a merge re-indexes only the two neighbours it touches. Words are
independent, so the result is that of merging each alone, and each task can
replay the words of its own slices without a shuffle; a bounded memo of
encoded words is kept between slices.

Null texts count as empty (no ids). Any id type and extra columns are allowed;
repeated rows are encoded repeatedly; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType, BinaryType, LongType

from .common import beside, map_arrow, others, slices

SHIFT = 20  # ids stay below 2**20
NONE = 1 << 30  # no merge
#: Parts, and bytes of parts and their ids, that a task remembers; the memo starts anew when full.
MEMO_WORDS, MEMO_BYTES = 500_000, 48_000_000
#: What a remembered part costs besides its characters and ids.
PART_BYTES = 150
#: Characters of text that are replayed together.
SLICE_CHARS = 3_000_000


class Vocabulary:
    """Ranks of a tiktoken file: ``base64(token) rank`` lines."""

    def __init__(self, data: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
        self.tokens = {i: t for t, i in self.ranks.items()}
        if max(self.tokens, default=0) >= 1 << SHIFT:
            raise ValueError(f"ids must be below {1 << SHIFT}")
        merges = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    merges[left << SHIFT | right] = rank
        pairs = sorted(merges)
        self.pairs = np.array([*pairs, 1 << 62], np.int64)
        self.pair_ranks = np.array([*map(merges.__getitem__, pairs), NONE], np.int32)
        self.byte_ids = np.array([self.ranks.get(bytes([b]), -1) for b in range(256)], np.int64)

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of the token that each pair makes, or NONE."""
        key = left << SHIFT | right
        at = np.searchsorted(self.pairs, key)
        return np.where(self.pairs[at] == key, self.pair_ranks[at], NONE)

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, packed as little-endian unsigned 32-bit integers."""
        out: list = [None] * len(words)
        left: list[int] = []
        for k, word in enumerate(words):
            rank = self.ranks.get(word)
            if rank is not None:
                out[k] = rank.to_bytes(4, "little")
            else:
                left.append(k)
        for k, packed in zip(left, self.replay([words[k] for k in left]), strict=True):
            out[k] = packed
        return out

    def replay(self, words: list[bytes]) -> list[bytes]:
        """Apply every merge in rank order over all words at once; the words' packed ids.

        All words lie in one array: ``token`` is the id at a position (-1: gone
        into the token to its left), ``after``/``before`` link the living
        positions of a word (-1 at its ends) and ``want`` is the rank of the
        pair that starts there. ``index`` maps a rank to the positions noted for
        it; a note is stale when ``want`` has moved on. Equal ranks go from left
        to right. Where a merge makes a pair of a lower rank possible, the order
        inside that word matters, so such (rare) words are merged alone.
        """
        words = list(words)
        flat = np.frombuffer(b"".join(words), np.uint8)
        if not len(flat):
            return [b""] * len(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        token = self.byte_ids[flat]
        if token.min() < 0:
            raise ValueError("the vocabulary lacks a single-byte token")
        after = np.arange(1, len(token) + 1)
        after[ends[lengths > 0] - 1] = -1
        before = np.arange(-1, len(token) - 1)
        before[(ends - lengths)[lengths > 0]] = -1
        want = np.full(len(token), NONE, np.int32)
        inner = np.flatnonzero(after >= 0)
        want[inner] = self.pair_rank(token[inner], token[inner + 1])
        found = np.flatnonzero(want < NONE)
        found = found[np.argsort(want[found], kind="stable")]
        ranks, cuts = np.unique(want[found], return_index=True)
        first = dict(zip(ranks.tolist(), np.split(found, cuts[1:]), strict=True)) if len(found) else {}
        index: dict[int, list[int]] = {}
        queue = list(first)
        heapify(queue)
        odd: list[np.ndarray] = []
        while queue:
            rank = heappop(queue)
            at = first.pop(rank, None)
            if (more := index.pop(rank, None)) is not None:
                more = np.array(more)
                at = np.unique(more if at is None else np.concatenate((at, more)))
            if at is None:
                continue
            at = at[want[at] == rank]
            if not len(at):
                continue
            gone = after[at]
            if (want[gone] == rank).any():  # pairs that overlap: the left one of two is merged
                keep, last = [], -1
                for n, (i, j) in enumerate(zip(at.tolist(), gone.tolist(), strict=True)):
                    if i != last:
                        keep.append(n)
                        last = j
                at, gone = at[keep], gone[keep]
            follow = after[gone]
            token[at], token[gone] = rank, -1
            want[at] = want[gone] = NONE
            after[at] = follow
            inside = follow >= 0
            before[follow[inside]] = at[inside]
            left = np.concatenate((at[inside], (back := before[at])[back >= 0]))
            made = self.pair_rank(token[left], token[after[left]])
            want[left] = made
            hit = made < NONE
            if hit.any():
                left, made = left[hit], made[hit]
                if made.min() < rank:
                    odd.append(np.searchsorted(ends, left[made < rank], side="right"))
                for r, i in zip(made.tolist(), left.tolist(), strict=True):
                    if r in index:
                        index[r].append(i)
                    else:
                        index[r] = [i]
                        heappush(queue, r)
        alive = token >= 0
        count = np.concatenate(([0], np.cumsum(alive)))
        packed = token[alive].astype("<u4").tobytes()
        cut = (4 * count[np.concatenate(([0], ends))]).tolist()
        out = [packed[a:b] for a, b in zip(cut, cut[1:], strict=False)]
        for k in np.unique(np.concatenate(odd)).tolist() if odd else ():
            out[k] = self.merge_alone(words[k])
        return out

    def merge_alone(self, word: bytes) -> bytes:
        """One word by the definition: the leftmost pair of the lowest rank, again and again."""
        parts = [word[i:i + 1] for i in range(len(word))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(a + b, NONE), i)
                          for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == NONE:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return b"".join(self.ranks[p].to_bytes(4, "little") for p in parts)


class Memo:
    """Encoded parts of earlier texts; never changes a result, only its cost.

    A match of a space-led pattern holds a space only in front or within a run
    of white space. A text may then be cut before each space that stands
    between two other characters, and the parts are encoded alone. ``first``,
    ``middle`` and ``last`` hold the ids of such parts (without their space; None
    where white space beside the cut forbids it).
    """

    def __init__(self):
        self.first, self.middle, self.last, self.size = {}, {}, {}, 0

    def trim(self) -> None:
        if self.size > MEMO_BYTES or len(self.first) + len(self.middle) + len(self.last) > MEMO_WORDS:
            self.__init__()


@lru_cache(maxsize=2)
def _codec(data: bytes, pattern: str):
    return Vocabulary(data), regex.compile(pattern)


def encode_texts(texts: list, vocabulary: Vocabulary, pattern, memo: Memo,
                 space_led: bool = True) -> list[bytes]:
    """Packed ids of each text (None: empty), by one replay over their new words."""
    memo.trim()
    first, middle, last, whole = set(), set(), set(), []
    for text in texts:
        parts = text.split(" ") if space_led and text else ()
        if len(parts) > 1:
            first.add(parts[0])
            last.add(parts[-1])
            middle.update(parts[1:-1])
        elif text:
            whole.append(text)
    fresh = [([p for p in parts if p not in known], known, lead) for parts, known, lead in
             ((first, memo.first, ""), (middle, memo.middle, " "), (last, memo.last, " "))]
    split = [[pattern.findall(lead + p) for p in parts] for parts, _, lead in fresh]
    split.append([pattern.findall(t) for t in whole])
    ids = _ids({w for many in split for words in many for w in words}, vocabulary)
    del first, middle, last
    for (parts, known, lead), many in zip(fresh, split, strict=False):
        for part, words in zip(parts, many, strict=True):
            cut_off = known is not memo.first and (not part or part[0].isspace()) \
                or known is not memo.last and part and part[-1].isspace()
            known[part] = whole_part = None if cut_off else b"".join([ids[w] for w in words])
            memo.size += len(part) + len(whole_part or b"") + PART_BYTES
    out = []
    for text in texts:
        parts = text.split(" ") if space_led and text else ()
        if len(parts) > 1:
            try:
                out.append(b"".join([memo.first[parts[0]], *map(memo.middle.__getitem__, parts[1:-1]),
                                     memo.last[parts[-1]]]))
                continue
            except TypeError:  # one of the parts is None
                ids.update(_ids({w for w in pattern.findall(text) if w not in ids}, vocabulary))
        out.append(b"".join([ids[w] for w in pattern.findall(text)]) if text else b"")
    return out


def _ids(words: set[str], vocabulary: Vocabulary) -> dict[str, bytes]:
    order = list(words)
    return dict(zip(order, vocabulary.encode_words([w.encode() for w in order]), strict=True))


def decode_ids(packed: bytes, vocabulary: Vocabulary) -> bytes:
    return b"".join(map(vocabulary.tokens.__getitem__, np.frombuffer(packed, "<u4").tolist()))


def _read(path: str) -> bytes:
    """The vocabulary file: megabytes by its nature, read once on the driver and broadcast."""
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, vocab_path: str, pattern: str, text_col: str = "text",
           keep: list[str] | None = None, decoded: bool = False,
           space_led: bool = True) -> DataFrame:
    """Encode whole texts: ``keep`` columns, ``n_tokens`` long and ``ids`` binary.

    ``ids`` packs the ids as little-endian unsigned 32-bit integers;
    ``decoded`` adds the bytes that decoding those ids gives. Special tokens
    are ordinary text. An old column (``keep``: default all) with a new one's
    name gives way to it.
    """
    names = ["n_tokens", "ids", "decoded"][:3 if decoded else 2]
    kept = [c for c in others(docs, *names) if keep is None or c in keep]
    data = docs.sparkSession.sparkContext.broadcast(_read(vocab_path))
    source, fields = beside(docs, kept, text_col)
    types = (LongType(), BinaryType(), BinaryType())
    schema = StructType(fields
                        + [StructField(n, t) for n, t in zip(names, types, strict=False)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (vocabulary, splitter), memo = _codec(data.value, pattern), Memo()  # the memo goes with the task
        for batch, texts in slices(batches, len(kept), max_chars=SLICE_CHARS, max_rows=10_000):
            ids = encode_texts(texts, vocabulary, splitter, memo, space_led)
            new = [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
            if decoded:
                new.append(pa.array([decode_ids(x, vocabulary) for x in ids], pa.binary()))
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + new, names=schema.names)

    return map_arrow(source, work, schema)


def decode(encoded: DataFrame, vocab_path: str, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """Add the bytes that the packed ids stand for (null ids: null)."""
    data = encoded.sparkSession.sparkContext.broadcast(_read(vocab_path))
    kept = others(encoded, to)
    source, fields = beside(encoded, kept, ids_col)
    schema = StructType(fields + [StructField(to, BinaryType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, _ = _codec(data.value, "")
        for batch in batches:
            out = [None if x is None else decode_ids(x, vocabulary)
                   for x in batch.column(len(kept)).to_pylist()]
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + [pa.array(out, pa.binary())],
                                             names=schema.names)

    return map_arrow(source, work, schema)

"""Grouping sets of a cube, rolled up in arrays where the rows of a key lie.

Each row is a row of every set. As Spark rows the copies would be hashed and sorted a few times per set;
here they are numbers in arrays of a block of keys. Spark deals the rows, one whole key to one partition, and
explodes or sums the results.
"""

from __future__ import annotations

import itertools
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

#: Rows of a block: its keys are rolled up together. A larger key is a block of its own.
BLOCK_ROWS = 1 << 14
_LOW = (1 << 32) - 1


def _codes(values: pa.Array) -> tuple[np.ndarray, int]:
    """Numbers from 0 of the values in order of their first row, null being a value, and how many there are."""
    coded = values.dictionary_encode(null_encoding="encode")
    return coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)


def _runs(ordered: np.ndarray) -> np.ndarray:
    """Marks the first row of each run of equal values."""
    first = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=first[1:])
    return first


def _halves(decimals: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Unscaled values as high * 2^32 + low, whose sums don't overflow; null is 0."""
    words = np.frombuffer(decimals.buffers()[1], "<i8")[2 * decimals.offset:2 * (decimals.offset + len(decimals))]
    low, high = words[::2], words[1::2]
    there = decimals.is_valid().to_numpy(zero_copy_only=False)
    return np.where(there, low & _LOW, 0), np.where(there, (high << 32) | ((low >> 32) & _LOW), 0)


def _decimals(low: np.ndarray, high: np.ndarray, null: np.ndarray, kind: pa.DataType) -> pa.Array:
    """The sums of :func:`_halves` as decimals again."""
    high = high + (low >> 32)
    words = np.stack([(high << 32) | (low & _LOW), high >> 32], 1)
    there = pa.py_buffer(np.packbits(~null, bitorder="little")) if null.any() else None
    return pa.Array.from_buffers(kind, len(low), [there, pa.py_buffer(words)])


def _members(dims: list[pa.Array], sets: list[list[int]], marker: int) -> tuple[list, np.ndarray, int]:
    """Of the copies of the rows for each set, set by set: per member its code and the values of the codes (null
    and the marker are values), and numbers of the slices, all below the last of what is returned."""
    n, count = len(dims[0]), len(sets)
    members, slices = [], np.repeat(np.arange(count), n)
    for i, dim in enumerate(dims):
        coded = dim.dictionary_encode(null_encoding="encode")
        codes, size = coded.indices.to_numpy().astype(np.int64), len(coded.dictionary) + 1
        copies = np.concatenate([codes if i in s else np.full(n, size - 1) for s in sets])
        slices, count = slices * size + copies, count * size
        members.append((copies, pa.concat_arrays([coded.dictionary, pa.array([marker], dim.type)])))
    return members, slices, count


def _block(key: np.ndarray, keys: int, time: pa.Array, dims: list[pa.Array], user: pa.Array, value: pa.Array,
           sets: list[list[int]], marker: int, kind: pa.StructType) -> tuple[np.ndarray, pa.StructArray]:
    """Number of cube rows of each key, and the rows by key. Every key's rows are of one period."""
    n = len(key)
    number = time.cast(pa.int32())
    timed = number.is_valid().to_numpy(zero_copy_only=False)
    at = number.fill_null(0).to_numpy().astype(np.int64)
    at -= (first := at[timed].min() if timed.any() else 0)
    at[~timed] = 0
    times = int(at.max()) + 1
    who, users = _codes(user)
    members, slices, count = _members(dims, sets, marker)
    slices += np.tile(key * count, len(sets))
    at, copies = np.tile(at, len(sets)), len(sets) * n

    # users: the first row of a user in a slice at a time, and in the whole period
    order = np.argsort(by_user := (slices * users + np.tile(who, len(sets))) * times + at)
    by_user = by_user[order]
    here, new = np.zeros(copies, np.int64), np.zeros(copies, np.int64)
    here[order], new[order] = _runs(by_user), _runs(by_user // times)

    # cells: the rows of a slice at a time
    order = np.argsort(by_cell := slices * times + at)
    by_cell = by_cell[order]
    starts = np.flatnonzero(_runs(by_cell))
    cells = by_cell[starts]
    slice_first = np.maximum.accumulate(np.where(_runs(cells // times), np.arange(len(cells)), 0))

    def total(copy_values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(copy_values[order], starts)

    def to_date(totals: np.ndarray) -> np.ndarray:
        running = np.cumsum(totals)
        return running - (running - totals)[slice_first]

    one = order[starts]  # a copy of each cell
    row, untimed = one % n, ~timed[one % n]
    users_here, users_new, rows = total(here), to_date(total(new)), np.diff(starts, append=copies)
    low, high = (total(np.tile(half, len(sets))) for half in _halves(value))
    valued = total(np.tile(value.is_valid().to_numpy(zero_copy_only=False).astype(np.int64), len(sets)))
    money = kind.field("value").type
    out = [pa.array((at[one] + first).astype(np.int32), mask=untimed).cast(time.type),
           *[values.take(pa.array(codes[one])) for codes, values in members],
           pa.array(users_here, mask=untimed), pa.array(users_new, mask=untimed), pa.array(rows), pa.array(to_date(rows)),
           _decimals(low, high, valued == 0, money),
           _decimals(to_date(low), to_date(high), to_date(valued) == 0, money)]
    return np.bincount(key[row], minlength=keys), pa.StructArray.from_arrays(out, fields=list(kind))


def _partition(columns: list[pa.Array], keys: int, sets: list[list[int]], marker: int,
               kind: pa.StructType) -> pa.ListArray:
    """For the first row of each key the cube rows of the key; none for the others."""
    n = len(columns[0])
    key = np.zeros(n, np.int64)
    for column in columns[:keys]:
        codes, size = _codes(column)
        key, _ = _codes(pa.array(key * size + codes))
    order = np.argsort(key, kind="stable")
    starts = np.flatnonzero(_runs(key[order]))
    ends = np.append(starts[1:], n)
    lengths, parts, k = np.zeros(n, np.int64), [], 0
    while k < len(starts):
        last = max(k + 1, int(np.searchsorted(ends, starts[k] + BLOCK_ROWS, "right")))
        rows = order[starts[k]:ends[last - 1]]
        time, *dims, user, value = (c.take(pa.array(rows)) for c in columns[keys:])
        sizes, part = _block(key[rows] - k, last - k, time, dims, user, value, sets, marker, kind)
        lengths[order[starts[k:last]]] = sizes
        parts.append(part)
        k = last
    offsets = pa.array(np.append(0, np.cumsum(lengths)).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, pa.concat_arrays(parts))


def cube_rows(keys: list[str], time: str, dims: list[str], user: str, value: str, sets: list[list[str]],
              marker: int) -> Column:
    """Cube rows of each key, as an array beside one of its rows: to be exploded, by ``inline_outer``.

    Partitions must hold whole keys, and a key the rows of one period (a month) and no more than fit in memory 100-fold.
    Beside the array, select nothing but ``keys``: a filter on them may be moved before it, one on other columns not.
    Per (``time``, members of a set; ``marker`` where rolled up) a row has the distinct users, rows and sum of
    ``value``, each also from the period's start: ``time``, ``dims``, ``users``, ``users_to_date``, ``rows``,
    ``rows_to_date``, ``value``, ``value_to_date``. Rows without a time have no count of users. ``value`` is
    a decimal of at most 28 digits and 2 decimals; null is a value of its own for keys, members and users.
    """
    chosen = [[dims.index(d) for d in s] for s in sets]
    money = pa.decimal128(38, 2)
    kind = pa.struct([(time, pa.date32()), *[(d, pa.int32()) for d in dims],
                      *[(c, pa.int64()) for c in ("users", "users_to_date", "rows", "rows_to_date")],
                      ("value", money), ("value_to_date", money)])

    def work(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        batches = list(batches)
        if not batches:
            return
        out = _partition([pa.concat_arrays(c) for c in zip(*batches, strict=True)], len(keys), chosen, marker, kind)
        ends = list(itertools.accumulate(len(b[0]) for b in batches))
        yield from (out[start:end] for start, end in zip([0, *ends], ends))

    fields = [f"{time}: date", *[f"{d}: int" for d in dims],
              *[f"{c}: bigint" for c in ("users", "users_to_date", "rows", "rows_to_date")],
              "value: decimal(38,2)", "value_to_date: decimal(38,2)"]
    rolled = arrow_udf(work, f"array<struct<{', '.join(fields)}>>")
    return rolled(*[F.col(c) for c in (*keys, time, *dims, user, value)])


def _days(period: pa.Array, dims: list[pa.Array], user: pa.Array, mask: pa.Array, sets: list[list[int]],
          marker: int) -> list[pa.Array]:
    """Per (period, members of a set) and day of the masks: period, members, day, users, users not seen before."""
    who, users = _codes(user)
    when, periods = _codes(period)
    members, slices, count = _members(dims, sets, marker)
    slices += np.tile(when * count, len(sets))
    order = np.argsort(by_user := slices * users + np.tile(who, len(sets)))
    starts = np.flatnonzero(_runs(by_user[order]))
    masks = np.bitwise_or.reduceat(np.tile(mask.fill_null(0).to_numpy().astype(np.int64), len(sets))[order], starts)
    # users of a slice with the same days count together
    order = order[starts]
    again = np.argsort(same := np.cumsum(_runs(slices[order])) << 31 | masks)
    starts = np.flatnonzero(_runs(same[again]))
    number, order, same = np.diff(starts, append=len(again)), order[again[starts]], same[again[starts]]
    masks, starts = same & ((1 << 31) - 1), np.flatnonzero(_runs(same >> 31))
    here = np.stack([np.add.reduceat(number * (masks >> d & 1), starts) for d in range(31)])
    new = np.stack([np.add.reduceat(number * (masks & ((2 << d) - 1) == 1 << d), starts) for d in range(31)])
    day, cell = np.nonzero(here)
    one = order[starts][cell]
    return [period.take(pa.array(one % len(period))), *[values.take(pa.array(codes[one])) for codes, values in members],
            pa.array(day.astype(np.int32)), pa.array(here[day, cell]), pa.array(new[day, cell])]


def users_by_day(masks: DataFrame, period: str, dims: list[str], user: str, mask: str, sets: list[list[str]],
                 marker: int) -> DataFrame:
    """Distinct users of each (``period``, members of a set; ``marker`` where rolled up) and day (``_day``, from 0).

    ``mask`` has a bit for each active day of a user with given members. A partition must hold all rows of its
    (period, user). Counts are of one block of rows and are to be summed: ``users``, and ``new`` of those whose
    first day in the period it is.
    """
    chosen = [[dims.index(d) for d in s] for s in sets]
    names = [period, *dims, "_day", "users", "new"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        columns = [pa.concat_arrays([b.column(i) for b in batches]) for i in range(len(names) - 1)]
        del batches
        (when, _), (who, users) = _codes(columns[0]), _codes(columns[-2])
        order = np.argsort(key := when * users + who)
        ends = np.append(np.flatnonzero(_runs(key[order]))[1:], len(order))
        start = 0
        while start < len(order):
            end = ends[min(np.searchsorted(ends, start + BLOCK_ROWS), len(ends) - 1)]
            time, *members, one, days = (c.take(pa.array(order[start:end])) for c in columns)
            yield pa.RecordBatch.from_arrays(_days(time, members, one, days, chosen, marker), names=names)
            start = end

    return masks.select(period, *dims, user, mask).mapInArrow(
        work, f"{period} date, {', '.join(f'{d} int' for d in dims)}, _day int, users bigint, new bigint")


# the executors need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

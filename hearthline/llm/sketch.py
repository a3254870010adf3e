"""Count-min sketches of hashes, made for each partition, merged by ranges of cells.

A partition's sketch is sparse: for each range of cells the sorted cells that it has met, as gaps.
Merging adds the counts of one range after another, as a stream. What comes to the driver is two bits
for each cell, however large the input is: ``rows * 2**bits / 4`` bytes, 64 MB by default. More hashes
than cells only make more counts too high; no count is ever too low.

``count_apart`` counts in a space that grows with the input and folds only what repeats there into such
cells: they fill with the repeated hashes, not with all, and most hashes of a large corpus occur once.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BITS = 28
RANGE_BITS = 18  # cells of one range
FLUSH = 8 << 20  # bytes of cells held by a task before it writes a sketch
RANGES_AT_ONCE = 128  # of a sketch, in one batch
LEVELS = (2, 16, 1000)  # counts from which a cell is of class 1, 2, 3
SPARE_BITS = 5  # of the space of ``count_apart``, beyond one cell a hash
PART_BITS = 18  # hashes of one of its ranges, about
_SCHEMA = "range int, gaps binary, wide binary, many binary, times binary"


def _cells(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    """The cells of a row of the sketch; rows use different bits of the hash."""
    with np.errstate(over="ignore"):
        return ((hashes * np.uint64(0x9E3779B97F4A7C15 + 2 * row)) >> np.uint64(64 - bits)) + np.uint64(row << bits)


def _ranges(cells: np.ndarray, schema: pa.Schema, range_bits: int = RANGE_BITS, small: type = np.uint8) -> Iterator[pa.RecordBatch]:
    """The sketch of ``cells``, which are sorted in place; gaps that do not fit ``small`` are apart."""
    most = np.iinfo(small).max
    cells.sort()
    first = np.concatenate([[True], cells[1:] != cells[:-1]])
    begin = np.flatnonzero(first)
    found = cells[begin]
    times = np.minimum(np.diff(begin, append=len(cells)), 65535).astype(np.uint16)
    cuts = np.flatnonzero(np.diff(found >> range_bits, prepend=(found[:1] >> range_bits) ^ 1) != 0).tolist()
    rows = []
    for a, z in zip(cuts, [*cuts[1:], len(found)]):
        which = int(found[a]) >> range_bits
        gaps = np.diff(found[a:z].astype(np.int64) - (which << range_bits), prepend=0)
        many = np.flatnonzero(times[a:z] > 1)
        rows.append((which, np.minimum(gaps, most).astype(small).tobytes(), gaps[gaps >= most].astype(np.uint32).tobytes(),
                     many.astype(np.uint32).tobytes(), times[a:z][many].tobytes()))
        if len(rows) == RANGES_AT_ONCE or z == len(found):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
            rows = []


def _met(row: dict, small: type = np.uint8) -> tuple[np.ndarray, np.ndarray]:
    """The cells of a row, from the begin of its range, and how often each was met."""
    gaps = np.frombuffer(row["gaps"], small).astype(np.int64)
    gaps[gaps == np.iinfo(small).max] = np.frombuffer(row["wide"], np.uint32)
    own = np.cumsum(gaps)
    n = np.ones(len(own), np.int64)
    n[np.frombuffer(row["many"], np.uint32)] = np.frombuffer(row["times"], np.uint16)
    return own, n


def _add(counts: np.ndarray, row: dict) -> None:
    own, n = _met(row)
    counts[own] = np.minimum(counts[own] + n, 1 << 30)


def _packed(which: int, classes: np.ndarray) -> pa.RecordBatch:
    """The classes of a range, two bits a cell."""
    four = classes.reshape(-1, 4)
    packed = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    return pa.RecordBatch.from_pydict({"range": pa.array([which], pa.int32()), "packed": [zlib.compress(packed.tobytes(), 1)]})


def _merged(df: DataFrame, sketch: Callable, merge: Callable, cells: int, size: int) -> np.ndarray:
    """The classes of ``cells`` cells from ranges of ``size``, sketched by the tasks of ``df`` and merged range by range."""
    found = (df.mapInArrow(sketch, _SCHEMA).repartition("range").sortWithinPartitions("range")
             .mapInArrow(merge, "range int, packed binary"))
    packed, size = np.zeros(cells // 4, np.uint8), size // 4
    for row in found.collect():
        packed[row["range"] * size:(row["range"] + 1) * size] = np.frombuffer(zlib.decompress(row["packed"]), np.uint8)
    return packed


def _schema() -> pa.Schema:
    return pa.schema([("range", pa.int32()), *((k, pa.binary()) for k in ("gaps", "wide", "many", "times"))])


class Classes:
    """For each hash the class of its estimated count: 0 below the first level, and so on."""

    def __init__(self, packed: np.ndarray, rows: int, bits: int):
        self.packed, self.rows, self.bits = packed, rows, bits

    def __getstate__(self) -> tuple:
        """Compressed, as a broadcast is also written to each executor's disk."""
        return zlib.compress(self.packed.data, 1), self.rows, self.bits

    def __setstate__(self, state: tuple) -> None:
        packed, self.rows, self.bits = state
        self.packed = np.frombuffer(zlib.decompress(packed), np.uint8)

    def of(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), 3, np.uint8)
        for row in range(self.rows):
            cells = _cells(hashes, row, self.bits)
            np.minimum(out, (self.packed[cells >> np.uint64(2)] >> ((cells & np.uint64(3)) * np.uint64(2)).astype(np.uint8)) & 3, out=out)
        return out


def count_min(df: DataFrame, hashes: Callable[[pa.RecordBatch], np.ndarray], bits: int = BITS, rows: int = 1,
              levels: tuple[int, int, int] = LEVELS) -> Classes:
    """The classes of the counts of all hashes that ``hashes`` finds in the batches of ``df``."""

    if not RANGE_BITS <= bits <= 32:
        raise ValueError("bits must be between 18 and 32")
    kind = np.uint32 if rows << bits <= 1 << 32 else np.uint64
    schema = _schema()
    most = FLUSH // np.dtype(kind).itemsize

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.empty(most, kind), 0
        for batch in batches:
            found = hashes(batch)
            for a in range(0, len(found), max(1, most // rows)):
                part = found[a:a + max(1, most // rows)]
                if n + rows * len(part) > most:
                    yield from _ranges(held[:n], schema)
                    n = 0
                for row in range(rows):
                    held[n:n + len(part)] = _cells(part, row, bits)
                    n += len(part)
        if n:
            yield from _ranges(held[:n], schema)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, now = np.zeros(1 << RANGE_BITS, np.int64), None

        def out() -> pa.RecordBatch:
            classes = np.searchsorted(np.array(levels), counts, "right").astype(np.uint8)
            counts[:] = 0
            return _packed(now, classes)
        for batch in batches:
            for row in batch.to_pylist():
                if now is not None and row["range"] != now:
                    yield out()
                now = row["range"]
                _add(counts, row)
        if now is not None:
            yield out()

    return Classes(_merged(df, sketch, merge, rows << bits, 1 << RANGE_BITS), rows, bits)


def count_apart(df: DataFrame, hashes: Callable[[pa.RecordBatch], np.ndarray], n: int, bits: int = BITS,
                levels: tuple[int, int, int] = LEVELS) -> Classes:
    """``count_min`` of about ``n`` hashes in ``2**SPARE_BITS`` cells for each; a cell of the result has the highest class of these.

    The ranges follow from ``n``, so that a task sorts about ``2**PART_BITS`` hashes at a time however many there are. A hash
    that occurs once is of a class above 0 only if it shares a cell of the result with one that repeats.
    """
    if not RANGE_BITS <= bits <= 32:
        raise ValueError("bits must be between 18 and 32")
    space = max(bits, max(n, 1).bit_length() + SPARE_BITS)
    ranges = min(bits - 2, max(space - SPARE_BITS - PART_BITS, 0))  # as bits, like the others
    own, fold, size = space - ranges, space - bits, 1 << bits - ranges
    schema, most = _schema(), FLUSH // 8

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.empty(most, np.uint64), 0
        for batch in batches:
            found = hashes(batch)
            while len(found):
                part, found = found[:most - n], found[most - n:]
                held[n:n + len(part)] = _cells(part, 0, space)
                n += len(part)
                if n == most:
                    yield from _ranges(held, schema, own, np.uint16)
                    n = 0
        if n:
            yield from _ranges(held[:n], schema, own, np.uint16)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None

        def out() -> pa.RecordBatch:
            cells, times = (np.concatenate(x) for x in zip(*held))
            held.clear()
            order = np.argsort(cells)
            cells = cells[order]
            begin = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
            found = np.searchsorted(np.array(levels), np.add.reduceat(times[order], begin, dtype=np.int64), "right").astype(np.uint8)
            classes, some = np.zeros(size, np.uint8), found > 0
            np.maximum.at(classes, cells[begin][some] >> fold, found[some])
            return _packed(now, classes)
        for batch in batches:
            for row in batch.to_pylist():
                if now is not None and row["range"] != now:
                    yield out()
                now = row["range"]
                cells, times = _met(row, np.uint16)
                held.append((cells.astype(np.uint32), times.astype(np.uint16)))
        if now is not None:
            yield out()

    return Classes(_merged(df, sketch, merge, 1 << bits, size), 1, bits)

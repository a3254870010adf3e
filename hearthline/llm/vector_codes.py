"""Vectors as codes of product quantisation: whole-number components, codebooks of their parts, Orchard search.

Everything is exact in whole numbers, so neither the order of rows nor the number of tasks changes a bit of
the result. A codebook is small (parts x entries), a round of training is one scan with partial sums for each
task, and only these sums meet. The nearest entry is found by Orchard's search: each entry has a list of the
others by distance; from the present entry its list is read outward, an entry that is nearer (or as near, with
a lower index) becomes the present one and its list is read from the start, entries met once are not measured
again, and reading stops at an entry more than twice as far from the present one as the vector is: by the
triangle inequality neither it nor any after it can be as near.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import map_batches, small_batches
from hearthline.session import written

SCALE = 256
LARGEST = 1 << 24  # a component's magnitude; squared distances of 2**12 such components still fit 64 bits
ROWS = 1024  # vectors searched at once
HOT_SHARE = 1000  # fewer than so many labels can each hold more than one row in as many


def _integers(column: pa.Array, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(rows, components): the rows whose vector is whole and finite, and their components as whole numbers."""
    offsets = np.asarray(column.offsets, np.int64)
    values = np.asarray(column.values.cast(pa.float64()).fill_null(np.nan))
    size = np.diff(offsets)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    fine = np.asarray(column.is_valid()) & (size > 0) & (bad[offsets[1:]] == bad[offsets[:-1]])
    rows = np.flatnonzero(fine)
    out = np.zeros((len(rows), max(size[rows], default=0) if width is None else width), np.int64)
    inside = np.arange(size[rows].sum()) - np.repeat(np.cumsum(size[rows]) - size[rows], size[rows])
    found = values[np.repeat(offsets[rows], size[rows]) + inside]
    out[np.repeat(np.arange(len(rows)), size[rows]), inside] = np.clip(np.floor(SCALE * found), -LARGEST, LARGEST)
    return rows, out


class Search:
    """The entries of all part positions, and for each entry the others of its position by distance, nearest first."""

    def __init__(self, parts: list[np.ndarray]):
        self.entries = np.concatenate(parts)  # entry e of position p is at p * k + e
        k = self.k = len(parts[0])
        far = np.concatenate([((p[:, None] - p[None]) ** 2).sum(2) for p in parts]).reshape(-1, k)
        own = np.arange(len(far)) % k
        order = np.argsort(far, axis=1, kind="stable")
        self.lists = order[order != own[:, None]].reshape(len(far), k - 1)
        self.far = np.take_along_axis(far, self.lists, 1)
        self.by_sum = [np.argsort(p.sum(1), kind="stable") for p in parts]
        self.sums = [p.sum(1)[order] for p, order in zip(parts, self.by_sum)]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry to each part of rows x positions x components, ties to the lower index."""
        n, parts, k = x.shape[0], x.shape[1], self.k
        begin = [order[np.minimum(np.searchsorted(sums, x[:, p].sum(1)), k - 1)]
                 for p, (order, sums) in enumerate(zip(self.by_sum, self.sums))]
        best = np.stack(begin, 1).ravel()  # a guess: the entry whose sum is near
        base = np.tile(np.arange(parts) * k, n)
        x = x.reshape(n * parts, -1)
        near = ((x - self.entries[base + best]) ** 2).sum(1)
        visited = np.zeros((n * parts, k), bool)
        visited[np.arange(n * parts), best] = True
        place = np.zeros(n * parts, np.int64)
        live = np.arange(n * parts) if k > 1 else np.zeros(0, np.int64)
        while len(live):
            at = base[live] + best[live]
            goes_on = self.far[at, place[live]] <= 4 * near[live]
            live, at = live[goes_on], at[goes_on]
            other = self.lists[at, place[live]]
            place[live] += 1
            new = ~visited[live, other]
            rows, other = live[new], other[new]
            visited[rows, other] = True
            found = ((x[rows] - self.entries[base[rows] + other]) ** 2).sum(1)
            better = (found < near[rows]) | ((found == near[rows]) & (other < best[rows]))
            rows = rows[better]
            best[rows], near[rows], place[rows] = other[better], found[better], 0
            live = live[place[live] < k - 1]
        return best.reshape(n, parts), near.reshape(n, parts)


class Codebooks:
    def __init__(self, parts: list[np.ndarray]):
        self.parts, self.search = parts, None

    def __getstate__(self):
        return self.parts

    def __setstate__(self, parts):
        self.parts, self.search = parts, None

    @property
    def width(self) -> int:
        return sum(p.shape[1] for p in self.parts)

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, errors) of rows x positions."""
        if self.search is None:
            self.search = Search(self.parts)
        codes, errors = (np.zeros((len(x), len(self.parts)), np.int64) for _ in range(2))
        for a in range(0, len(x), ROWS):
            part = x[a:a + ROWS].reshape(-1, len(self.parts), self.width // len(self.parts))
            codes[a:a + ROWS], errors[a:a + ROWS] = self.search.nearest(part)
        return codes, errors

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(v) for p in self.parts for v in p.ravel().tolist()).encode()).hexdigest()


def _seeds(vectors: DataFrame, parts: int, entries: int, width: int) -> Codebooks:
    """The vectors of the smallest ids, cut into parts; of equal ids those of smaller components come first."""
    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        rows, found = _integers(b["embedding"], width)
        keep = np.asarray(b["vec_id"].is_valid())[rows]
        return pa.RecordBatch.from_pydict({
            "vec_id": b["vec_id"].cast(pa.int64()).take(pa.array(rows[keep])),
            "found": pa.array(list(found[keep]), pa.list_(pa.int64()))})
    first = map_batches(vectors, batch, "vec_id long, found array<long>").orderBy("vec_id", "found").limit(entries).collect()
    own = width // parts
    found = np.array([r.found for r in first], np.int64).reshape(len(first), width)
    return Codebooks([found[:, k * own:(k + 1) * own] for k in range(parts)])


def _moved(vectors: DataFrame, now: Codebooks) -> Codebooks:
    """Each entry replaced by the mean of the parts that it is nearest to, rounded down; one scan."""
    spark = vectors.sparkSession
    shared, width, own = spark.sparkContext.broadcast(now), now.width, now.width // len(now.parts)

    def sums(batches):
        total = [np.zeros(p.shape, np.int64) for p in shared.value.parts]
        count = [np.zeros(len(p), np.int64) for p in shared.value.parts]
        for b in batches:
            _, x = _integers(b["embedding"], width)
            codes, _ = shared.value.assign(x)
            for k in range(len(total)):
                np.add.at(total[k], codes[:, k], x[:, k * own:(k + 1) * own])
                count[k] += np.bincount(codes[:, k], minlength=len(count[k]))
        used = [(k, e) for k in range(len(total)) for e in np.flatnonzero(count[k]).tolist()]
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([k for k, _ in used], pa.int32()), "entry": pa.array([e for _, e in used], pa.int32()),
            "total": pa.array([total[k][e].tolist() for k, e in used], pa.list_(pa.int64())),
            "n": pa.array([int(count[k][e]) for k, e in used], pa.int64())})
    found = (vectors.select("embedding").mapInArrow(sums, "part int, entry int, total array<long>, n long")
             .groupBy("part", "entry").agg(F.array(*(F.sum(F.col("total")[i]) for i in range(own))).alias("total"),
                                           F.sum("n").alias("n")).collect())  # at most parts x entries rows
    shared.destroy()
    parts = [p.copy() for p in now.parts]
    for r in found:
        parts[r.part][r.entry] = [t // r.n for t in r.total]
    return Codebooks(parts)


def train(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2) -> Codebooks:
    """The codebooks of ``vectors`` (vec_id, embedding), one for each of ``parts`` consecutive parts of equal width."""
    longest = vectors.where("embedding IS NOT NULL").agg(F.max(F.size("embedding")).alias("n")).first()["n"] or 0
    width = -(-longest // parts) * parts
    books = _seeds(vectors, parts, entries, width)
    if not len(books.parts[0]):
        return Codebooks([np.zeros((0, width // parts), np.int64)] * parts)
    for _ in range(rounds):
        books = _moved(vectors, books)
    return books


def encode(vectors: DataFrame, books: Codebooks, label: str = "label") -> DataFrame:
    """(vec_id, label, code, error) of the vectors that are whole and finite; two hex digits for each part."""
    shared, width, kind = vectors.sparkSession.sparkContext.broadcast(books), books.width, vectors.schema[label].dataType

    def batch(b: pa.RecordBatch) -> pa.RecordBatch | None:
        rows, x = _integers(b["embedding"], width)
        if not len(rows) or not len(shared.value.parts[0]):
            return None
        codes, errors = shared.value.assign(x)
        digits = codes.astype(np.uint8).tobytes().hex()
        size = 2 * codes.shape[1]
        at = pa.array(rows)
        return pa.RecordBatch.from_pydict({
            "vec_id": b["vec_id"].cast(pa.int64()).take(at), "label": b["label"].take(at),
            "code": [digits[k * size:(k + 1) * size] for k in range(len(rows))], "error": pa.array(errors.sum(1))})
    return map_batches(vectors.select("vec_id", "embedding", F.col(f"`{label}`").alias("label")), batch,
                       f"vec_id long, label {kind.simpleString()}, code string, error long")


def _with_label_errors(codes: DataFrame) -> DataFrame:
    """Adds the error summed over equal labels, nulls together.

    Sums have map-side partial sums. Labels with more than a thousandth of all rows, fewer than a thousand by
    that count, are broadcast; rows with them are not shuffled. Other labels are joined, and each is small.
    """
    sums = written(codes.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n"))
                   .withColumnRenamed("label", "own"), "label-errors")
    rows = sums.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(sums.where(F.col("n") * HOT_SHARE > rows).drop("n"))
    same = F.col("label").eqNullSafe(F.col("own"))
    thick = codes.join(hot, same)
    thin = codes.join(hot, same, "left_anti").join(sums.where(F.col("n") * HOT_SHARE <= rows).drop("n"), same)
    return thick.union(thin).drop("own")


def compress(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) for each whole and finite row of ``vectors`` (vec_id, embedding, label).

    A component x becomes floor(256 x), held to a magnitude of 2**24 so that sums of squares fit 64 bits. Codebooks
    start as the parts of the vectors of smallest vec_id (of equal ids, those of smaller components; a null id never
    starts one) and are moved ``rounds`` times to the floor of their parts' mean; an entry nearest to none stays.
    A vector that is null, empty, or holds a null or non-finite value is left out. Vectors shorter than the longest,
    or than a multiple of ``parts``, count as filled with zeros. With fewer vectors than entries, or none but null ids,
    the codebooks are smaller; with none, no row is returned. Repeated ids are vectors of their own, other columns are
    ignored. ``entries`` is at most 256.
    """
    if not 1 <= entries <= 256:
        raise ValueError("two hex digits hold at most 256 entries")
    small_batches(vectors.sparkSession)
    # whatever the element's type, and without the columns that are not asked for
    vectors = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "label")
    books = train(vectors, parts, entries, rounds)
    codes = written(encode(vectors, books), "vector-codes")
    return _with_label_errors(codes).select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))

import hashlib
import math
import random

import numpy as np
import pytest

from hearthline.llm import vector_codes
from hearthline.llm.vector_codes import Search, compress


def brute(rows, parts, entries, rounds):
    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    own = len(kept[0][1]) // parts
    cut = lambda v, k: v[k * own:(k + 1) * own]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    books = [[cut(v, k) for _, v, _ in sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]] for k in range(parts)]

    def nearest(v, k):
        return min((far(cut(v, k), e), i) for i, e in enumerate(books[k]))
    for _ in range(rounds):
        moved = []
        for k in range(parts):
            groups = [[] for _ in books[k]]
            for _, v, _ in kept:
                groups[nearest(v, k)[1]].append(cut(v, k))
            moved.append([[sum(c) // len(g) for c in zip(*g)] if g else e for g, e in zip(groups, books[k])])
        books = moved
    found = [(i, [nearest(v, k) for k in range(parts)], label) for i, v, label in kept]
    totals = {}
    for _, f, label in found:
        totals[label] = totals.get(label, 0) + sum(d for d, _ in f)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted((i, "".join(f"{e:02x}" for _, e in f), sum(d for d, _ in f), totals[label], digest) for i, f, label in found)


def rows_of(n=300, seed=3):
    rng = random.Random(seed)
    rows = [(k, [rng.gauss(0, 0.3) for _ in range(8)], rng.choice([1, 1, 1, 2, None])) for k in rng.sample(range(1000), n)]
    rows += [(2000 + k, rows[0][1], 7) for k in range(200)]  # a hot group of copies
    return rows + [(-1, None, 1), (-2, [0.1] * 7 + [None], 1), (-3, [0.1] * 7 + [math.nan], 1), (-4, [math.inf] * 8, 2), (-5, [], 2)]


@pytest.mark.parametrize("hot", [1000, 1])
def test_equals_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(vector_codes, "HOT_SHARE", hot)  # 1: no label is broadcast
    rows = rows_of()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 AS code", "2 AS own")
    got = compress(df.repartition(5), parts=4, entries=16, rounds=2)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, got.collect())) == brute(rows, 4, 16, 2)


def test_search_is_exact_and_reads_little(monkeypatch):
    rng = np.random.default_rng(1)
    for entries in (rng.integers(-90, 90, (64, 4)), rng.integers(0, 3, (64, 2)), np.zeros((5, 3), int), rng.integers(0, 9, (1, 4))):
        book, x = Search([entries, -entries]), rng.integers(-100, 100, (500, entries.shape[1]))
        x[:50] = entries[rng.integers(0, len(entries), 50)]
        far = ((x[:, None] - entries[None]) ** 2).sum(2)
        best, near = book.nearest(np.stack([x, -x], 1))
        for k in (0, 1):  # argmin takes the lower index of equal ones
            assert (best[:, k] == far.argmin(1)).all() and (near[:, k] == far.min(1)).all()


def test_odd_tables(spark):
    schema = "vec_id long, embedding array<float>, label string"
    assert compress(spark.createDataFrame([], schema)).collect() == []
    assert compress(spark.createDataFrame([(1, None, "a"), (None, [math.nan], None)], schema)).collect() == []
    few = compress(spark.createDataFrame([(None, [1.0, 2.0], None), (5, [0.5, 2.0], "a"), (5, [0.25, 1.0], "a"), (6, [1e30, -1e30, 3.0], "b")],
                                         schema), parts=2, entries=64).collect()
    assert len(few) == 4 and {len(r.code) for r in few} == {4}  # shorter vectors count as filled up, to a multiple of the parts
    assert {r.vec_id: r.label_error for r in few}[6] == {r.vec_id: r.error for r in few}[6]
    nameless = compress(spark.createDataFrame([(None, [1.0, 2.0], "a")], schema), parts=2).collect()
    assert nameless == []  # no id, no codebook

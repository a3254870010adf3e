"""Exact quantiles against numpy, with hot values and brackets narrowed down to a few rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearthline.operators import ranks as ranks_module
from hearthline.operators.ranks import Ranked, exact_medians, exact_quantiles, order_statistics

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


@pytest.fixture(autouse=True, params=["lists", "brackets"])
def way(request, monkeypatch):
    """Every case both ways: small columns sorted whole, and searched like large ones."""
    if request.param == "brackets":
        monkeypatch.setattr(ranks_module, "LIST_VALUES", 0)


def frame(spark, values, kind="double", parts=4):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}").repartition(parts)


@pytest.mark.parametrize("accuracy,task_rows", [(10_000, 1_000_000), (50, 40), (20, 1)])
@pytest.mark.parametrize("shape", ["normal", "hot", "few", "constant", "two"])
def test_quantiles_equal_numpy(spark, shape, accuracy, task_rows):
    rng = random.Random(7)
    values = {
        "normal": [rng.gauss(0, 1e5) for _ in range(3001)],
        "hot": [5.0] * 1000 + [rng.uniform(-10, 20) for _ in range(2000)],
        "few": [float(rng.randrange(7)) for _ in range(2500)],
        "constant": [3.5] * 50,
        "two": [1.0, 2.0],
    }[shape]
    got = exact_quantiles(frame(spark, values), ["x"], PROBS, accuracy=accuracy, task_rows=task_rows)[0]["x"]
    assert got == pytest.approx(list(np.quantile(values, PROBS)), rel=1e-12)


def test_missing_and_nan_do_not_count(spark):
    df = frame(spark, [1.0, None, 2.0, float("nan"), 3.0, 10.0])
    values, first = exact_quantiles(df, ["x"], [0.5])
    assert values["x"] == [2.5] and first["n_0"] == 4


def test_all_missing_column_has_no_quantile(spark):
    assert exact_medians(frame(spark, [None, float("nan")]), ["x"]) == {"x": None}
    assert exact_medians(frame(spark, [1.0]), []) == {}


def test_infinities_are_values(spark):
    got = exact_quantiles(frame(spark, [float("-inf"), 1.0, 2.0, float("inf"), 7.0]), ["x"], [0.25, 0.5, 0.75])[0]["x"]
    assert got == [1.0, 2.0, 7.0]


@pytest.mark.parametrize("task_rows", [1_000_000, 5])
def test_large_integers_keep_every_digit(spark, task_rows):
    base = 2**60
    values = [base + 3 * i for i in range(500)]
    random.Random(1).shuffle(values)
    found = order_statistics(
        frame(spark, values, "bigint"), [Ranked("x", "x", [1, 2, 250, 500], 500)], accuracy=20, task_rows=task_rows)["x"]
    assert {r: f.value for r, f in found.items()} == {r: base + 3 * (r - 1) for r in (1, 2, 250, 500)}
    assert all(f.reach == r for r, f in found.items())


def test_wrong_guess_is_corrected(spark):
    df = spark.range(1000).select(F.col("id").alias("x"))
    for guess in [(0, 1), (900, 999), (5000, 6000), (-10, -5)]:
        found = order_statistics(df, [Ranked("x", "x", [500], 1000, guess)], task_rows=100)["x"][500]
        assert (found.value, found.reach) == (499, 500)


def test_reach_counts_ties(spark):
    found = order_statistics(frame(spark, [1.0, 2.0, 2.0, 2.0, 3.0]), [Ranked("x", "x", [2, 4, 5], 5)])["x"]
    assert [(found[r].value, found[r].reach) for r in (2, 4, 5)] == [(2.0, 4), (2.0, 4), (3.0, 5)]


def test_rank_outside_is_refused(spark):
    with pytest.raises(ValueError, match="outside"):
        order_statistics(spark.range(3), [Ranked("id", "id", [4], 3)])


def test_many_columns_at_once(spark):
    rng = np.random.default_rng(3)
    data = {f"c{i}": rng.normal(size=400) for i in range(6)}
    df = spark.createDataFrame(list(zip(*[v.tolist() for v in data.values()])), list(data))
    got = exact_quantiles(df, list(data), PROBS, accuracy=30, task_rows=8)[0]
    for c, v in data.items():
        assert got[c] == pytest.approx(list(np.quantile(v, PROBS)), rel=1e-12)


@pytest.mark.parametrize("accuracy,task_rows", [(20, 1), (30, 4)])
def test_hashes_and_dense_numbers_beyond_double_precision(spark, accuracy, task_rows):
    rng = random.Random(5)
    spread = [rng.randrange(2**60) for _ in range(700)]
    dense = [2**62 + i for i in range(300)] + [-(2**62)] * 200
    for values in (spread, dense):
        df, ordered = frame(spark, values, "bigint"), sorted(values)
        ranks = [1, 7, 200, 201, 350, len(values)]
        found = order_statistics(df, [Ranked("x", "x", ranks, len(values))], accuracy, task_rows)["x"]
        assert {r: f.value for r, f in found.items()} == {r: ordered[r - 1] for r in ranks}
        assert all(f.reach == sum(v <= f.value for v in values) for f in found.values())


def test_all_brackets_share_one_budget(spark, monkeypatch):
    """A hundred columns: what is ranked in a scan holds few values in all, and no task has more than one bracket's."""
    rng = np.random.default_rng(8)
    data = rng.normal(size=(300, 100))
    data[:100, :50] = 0.25  # hot values
    df = spark.createDataFrame(data.tolist(), [f"c{i}" for i in range(100)])
    seen = []
    plain = ranks_module._ranked
    monkeypatch.setattr(ranks_module, "LIST_VALUES", 600)
    monkeypatch.setattr(ranks_module, "_ranked", lambda frame, wanted: seen.append(sum(b.bound for _, b, _ in wanted)) or plain(frame, wanted))
    got = exact_quantiles(df, df.columns, [0.25, 0.5, 0.75], accuracy=40, task_rows=100)[0]
    for i, c in enumerate(df.columns):
        assert got[c] == pytest.approx(list(np.quantile(data[:, i], [0.25, 0.5, 0.75])), rel=1e-12)
    assert seen and max(seen) <= 600


def test_ranking_leaves_no_list_in_a_row(spark):
    frame = ranks_module._columns(spark.range(50).select(F.col("id").alias("x"), (F.col("id") / 3).alias("y")), [Ranked("x", "x", [1], 50), Ranked("y", "y", [1], 50)])
    brackets = [ranks_module._Bracket(0, [1], None, None, 50), ranks_module._Bracket(1, [1], 2.0, 9.0, 50)]
    found = ranks_module._ranked(frame, [(0, brackets[0], [7, 50]), (1, brackets[1], [1, 3])])
    assert found == {(0, 7): (6, 7), (0, 50): (49, 50), (1, 1): (7 / 3, 1), (1, 3): (3.0, 3)}

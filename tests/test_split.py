import math

import pytest
from pyspark.sql import functions as F

from hearthline.operators import split


def houses(spark, n, price="rand(5) * 1000000"):
    return spark.range(n).selectExpr("id", f"{price} AS price").repartition(3)


@pytest.mark.parametrize("n", [4600, 997])
def test_sizes_are_exact_and_parts_disjoint(spark, n):
    out = split.stratified_split(houses(spark, n)).cache()
    sizes = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    n_test = math.ceil(0.2 * n)
    n_val = math.ceil(0.125 * (n - n_test))
    assert sizes == {"test": n_test, "val": n_val, "train": n - n_test - n_val}
    assert out.select("id").distinct().count() == n


def test_bins_are_represented_in_proportion(spark):
    out = split.stratified_split(houses(spark, 2000))
    for r in out.groupBy("bin").agg(F.count("*").alias("n"), F.count_if(F.col("split") == "test").alias("t")).collect():
        assert r["n"] == 200 and r["t"] == 40


def test_narrowed_brackets_give_the_same_split(spark):
    df = houses(spark, 1500)
    a = {tuple(r) for r in split.stratified_split(df).select("id", "split").collect()}
    b = {tuple(r) for r in split.stratified_split(df, task_rows=3).select("id", "split").collect()}
    assert a == b


def test_hot_price(spark):
    """A third of the rows share one price; the split stays exact."""
    df = houses(spark, 1200, "CASE WHEN id % 3 = 0 THEN 500.0 ELSE CAST(id AS DOUBLE) END")
    sizes = {r["split"]: r["count"] for r in split.stratified_split(df).groupBy("split").count().collect()}
    assert sizes == {"test": 240, "val": 120, "train": 840}


def test_few_distinct_prices(spark):
    df = houses(spark, 300, "CAST(id % 15 AS DOUBLE)")
    sizes = {r["split"]: r["count"] for r in split.stratified_split(df).groupBy("split").count().collect()}
    assert sizes == {"test": 60, "val": 30, "train": 210}


def test_missing_target_is_refused(spark):
    with pytest.raises(ValueError, match="missing"):
        split.stratified_split(houses(spark, 50, "CASE WHEN id = 7 THEN NULL ELSE 1.0 * id END"))


def test_repeated_keys_are_refused(spark):
    df = spark.range(400).selectExpr("CAST(0 AS BIGINT) AS id", "rand(1) AS price")
    with pytest.raises(ValueError, match="not unique"):
        split.stratified_split(df)


def test_too_few_rows_per_stratum(spark):
    with pytest.raises(ValueError):
        split.stratified_split(houses(spark, 9))


def test_tied_hashes_are_decided_by_key(spark, monkeypatch):
    monkeypatch.setattr(split, "row_hash", lambda key, seed, label: f"CAST({key} % 40 AS BIGINT)")
    monkeypatch.setattr(split, "_hash_range", lambda rank, size: (0, 40))
    out = split.stratified_split(houses(spark, 1000))
    sizes = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    assert sizes == {"test": 200, "val": 100, "train": 700}


def test_allocation_by_largest_remainder():
    assert split.allocate([10, 10, 10], 20) == [7, 7, 6]
    assert split.allocate([7, 3], 5) == [4, 1]
    assert sum(split.allocate([13, 29, 5, 53], 81)) == 81


@pytest.mark.parametrize("n,sizes", [(13, [3, 3, 3, 2, 2]), (10, [2] * 5), (5, [1] * 5)])
def test_folds_are_contiguous(spark, n, sizes):
    out = split.kfold_assign(spark.range(n).selectExpr("id * 7 AS id").repartition(3), task_rows=2)
    rows = sorted((r["id"], r["fold"]) for r in out.collect())
    assert [f for _, f in rows] == [i for i, s in enumerate(sizes) for _ in range(s)]


def test_folds_need_a_unique_key_and_enough_rows(spark):
    with pytest.raises(ValueError, match="not unique"):
        split.kfold_assign(spark.createDataFrame([(1,)] * 10, "id bigint"))
    with pytest.raises(ValueError, match="cannot make"):
        split.kfold_assign(spark.range(3))


def test_split_has_no_shuffle(spark):
    plan = split.stratified_split(houses(spark, 500).coalesce(1))._jdf.queryExecution().executedPlan().toString()
    above = plan.split("AdaptiveSparkPlan")[-1] if "AdaptiveSparkPlan" in plan else plan
    assert "Window" not in above and "SortMergeJoin" not in above


def test_repeated_keys_always_raise(spark):
    rows = spark.range(400).selectExpr("CASE WHEN id % 20 = 0 THEN 1 ELSE id END AS id", "cast(id * 7 % 101 AS double) AS price")
    for call in (lambda: split.stratified_split(rows), lambda: split.kfold_assign(rows)):
        with pytest.raises(ValueError, match="not unique"):
            call()

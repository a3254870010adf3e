import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearthline import schema as S
from hearthline.operators import metrics, models, trees
from hearthline.operators.split import stratified_split


def predictions(spark, rows):
    return spark.createDataFrame(rows, "model string, split string, y double, y_pred double")


def test_metrics_by_hand(spark):
    row = metrics.regression_metrics(predictions(spark, [("m", "val", 1.0, 2.0), ("m", "val", 3.0, 3.0), ("m", "val", 5.0, 2.0)])).first()
    assert row["rmse"] == pytest.approx(math.sqrt(10 / 3)) and row["mae"] == pytest.approx(4 / 3)
    assert row["r2"] == pytest.approx(1 - 10 / 8) and row["mape"] == pytest.approx(100 * (1 + 0 + 0.6) / 3)


def test_r2_of_a_constant_target(spark):
    df = predictions(spark, [("good", "val", 2.0, 2.0)] * 2 + [("bad", "val", 2.0, 2.5)] * 2)
    assert {r["model"]: r["r2"] for r in metrics.regression_metrics(df).collect()} == {"good": 1.0, "bad": 0.0}


def table(spark, rows):
    return spark.createDataFrame(rows, "model string, r2_val double")


def test_best_model_ties_and_nan(spark):
    order = ["b", "a", "c"]
    assert metrics.select_best_model(table(spark, [("a", 0.5), ("b", 0.5), ("c", 0.4)]), order).first()["model"] == "b"
    assert metrics.select_best_model(table(spark, [("a", float("nan")), ("b", -3.0), ("c", None)]), order).first()["model"] == "b"
    ranked = [r["model"] for r in metrics.rank_models(table(spark, [("a", float("nan")), ("b", 0.1), ("c", 0.2)])).collect()]
    assert ranked == ["c", "b", "a"]


def test_verdicts(spark):
    df = spark.createDataFrame([("a", 0.52, 0.51), ("b", 0.6, 0.51), ("c", 0.4, 0.31), ("d", 0.3, 0.3)], "model string, r2_val double, r2_test double")
    assert [r["verdict"] for r in metrics.quality_verdict(df).collect()] == ["good", "acceptable", "acceptable", "improve"]


def test_gate_collects_all_warnings(spark):
    df = spark.createDataFrame([("linear_regression", 0.1, 400000.0, 11.0), ("other", 0.0, 9e9, 9e9)],
                               "model string, r2_val double, rmse_val double, training_seconds double")
    rows = {r["model"]: r for r in metrics.performance_gate(df, metrics.criteria_table(spark)).collect()}
    assert rows["linear_regression"]["warnings"] == ["r2", "rmse", "time"] and not rows["linear_regression"]["performance_ok"]
    assert rows["other"]["performance_ok"]


def learnable(spark, n=600, noise=0.0):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(n, len(S.FEATURES)))
    x[:, 8] = x[:, 2] - x[:, 9]  # exactly collinear, as living = above + basement
    y = 200000 + 50000 * x[:, 2] + 9000 * x[:, 1] - 300 * x[:, 10] + noise * rng.normal(size=n)
    rows = [(i, float(y[i]), *map(float, x[i])) for i in range(n)]
    return spark.createDataFrame(rows, "id bigint, price double, " + ", ".join(f"{f} double" for f in S.FEATURES)), x, y


def test_collinear_features_still_predict(spark):
    df, _, y = learnable(spark)
    model = models.fit_model(df, models.build_models_from_config()["linear_regression"])
    got = [r["y_pred"] for r in models.predict(df, model).orderBy("id").collect()]
    assert got == pytest.approx(list(y), rel=1e-6)


def test_linear_cross_validation_equals_refitting(spark):
    df, x, y = learnable(spark, 203, noise=20000.0)
    got = models.cross_validate(df, models.build_models_from_config()["linear_regression"])
    folds = np.array_split(np.arange(203), 5)
    for i, held in enumerate(folds):
        rest = np.setdiff1d(np.arange(203), held)
        a = np.column_stack([np.ones(203), x])
        beta, *_ = np.linalg.lstsq(a[rest], y[rest], rcond=None)
        assert got[i] == pytest.approx(float(np.sqrt(np.mean((y[held] - a[held] @ beta) ** 2))), rel=1e-6)


SMALL = {
    "linear_regression": models.MODEL_CONFIG["linear_regression"],
    "random_forest": {"algorithm": "RandomForestRegressor", "hyperparameters": {
        "n_estimators": 8, "max_depth": 5, "max_features": None, "random_state": 42}},
    "gradient_boosting": {"algorithm": "GradientBoostingRegressor", "hyperparameters": {
        "n_estimators": 10, "max_depth": 3, "learning_rate": 0.3, "random_state": 42, "loss": "squared_error"}},
    "off": {"algorithm": "LinearRegression", "enabled": False},
    "unknown": {"algorithm": "Perceptron"},
}


def test_training_all_models(spark):
    df, _, _ = learnable(spark, noise=1000.0)
    ready = stratified_split(df)
    results = models.train_all(ready, models.build_models_from_config(SMALL), k=2)
    assert list(results) == ["linear_regression", "random_forest", "gradient_boosting"]
    assert models.best_of(results).name == "linear_regression"
    assert all(r.metrics["val"]["r2"] > 0.5 and len(r.cv_rmse) == 2 and r.training_seconds > 0 for r in results.values())


def test_a_failing_model_is_left_out(spark):
    df, _, _ = learnable(spark, 200)
    estimators = models.build_models_from_config(SMALL)
    estimators["random_forest"].setFeaturesCol("nowhere")
    assert "random_forest" not in models.train_all(stratified_split(df), estimators, k=0)


def test_configured_hyperparameters_reach_spark():
    built = models.build_models_from_config()
    forest, boost = built["random_forest"], built["gradient_boosting"]
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getMinInstancesPerNode(), forest.getSeed()) == (100, 8, 2, 42)
    assert forest.getFeatureSubsetStrategy() == "sqrt"
    assert (boost.getMaxIter(), boost.getMaxDepth(), boost.getStepSize(), boost.getSubsamplingRate()) == (50, 4, 0.05, 0.8)
    assert boost.getLossType() == "squared"


def test_early_stopping_stops(spark):
    df, _, _ = learnable(spark, 300)
    boost = models.build_estimator("GradientBoostingRegressor", {"n_estimators": 30, "max_depth": 2, "learning_rate": 1.0})
    rows = models.assemble(df.withColumn(models.VALIDATION, F.col("id") % 4 == 0), S.FEATURES)
    assert models.with_early_stopping(boost, 0.9).fit(rows).getNumTrees < 30


def test_grid_points_spark_cannot_tell_apart_are_fitted_once(spark, monkeypatch):
    df, _, _ = learnable(spark, 120)
    calls = []
    monkeypatch.setattr(models, "cross_validate", lambda *a, **k: calls.append(1) or {0: 1.0, 1: 2.0})
    out = models.grid_search(df, "RandomForestRegressor", {"n_estimators": [2, 3], "min_samples_split": [2, 5]}, k=2)
    assert len(calls) == 2 and out.count() == 4


@pytest.mark.parametrize("algorithm, size, fitted", [("RandomForestRegressor", 324, 108), ("GradientBoostingRegressor", 324, 324)])
def test_without_a_grid_the_published_one_is_searched(spark, monkeypatch, algorithm, size, fitted):
    df, _, _ = learnable(spark, 120)
    calls = []
    monkeypatch.setattr(models, "cross_validate", lambda *a, **k: calls.append(1) or {0: 1.0, 1: 2.0})
    out = models.grid_search(df, algorithm, k=2)
    points = {tuple(sorted(r.params.items())) for r in out.collect()}
    assert len(points) == size and len(calls) == fitted  # min_samples_split, which Spark lacks, only repeats points


def test_grid_search_finds_the_better_point(spark):
    df, _, _ = learnable(spark, 200)
    out = models.grid_search(df, "GradientBoostingRegressor", {"n_estimators": [1, 8]}, {"max_depth": 2, "learning_rate": 0.5, "random_state": 1}, k=2)
    assert out.first()["params"] == {"n_estimators": "8"}


BOOST = {"n_estimators": 6, "max_depth": 2, "learning_rate": 0.4, "subsample": 0.8, "random_state": 42}


def test_staged_errors_and_prefix_equal_shorter_fits(spark):
    df, _, _ = learnable(spark, 200, noise=5000.0)
    train, rest = df.where("id % 4 > 0").coalesce(1).persist(), df.where("id % 4 = 0")
    model = models.fit_model(train, models.build_estimator("GradientBoostingRegressor", BOOST))
    errors = models.staged_errors(model, models.assemble(rest, S.FEATURES))
    assert len(errors) == 6
    for rounds in (1, 4, 6):
        shorter = models.fit_model(train, models.build_estimator("GradientBoostingRegressor", {**BOOST, "n_estimators": rounds}))
        want = {r["id"]: r["y_pred"] for r in models.predict(rest, shorter).collect()}
        prefix = models.predict(rest, models.boosting_prefix(model, rounds)).collect()
        assert {r["id"]: r["y_pred"] for r in prefix} == pytest.approx(want, rel=1e-12)
        assert errors[rounds - 1] == pytest.approx(np.mean([(r["price"] - r["y_pred"]) ** 2 for r in prefix]), rel=1e-9)


def test_patience():
    rule = models.EarlyStopping(patience=2, min_delta=0.01)
    assert rule.rounds([0.1]) == 1
    assert rule.rounds([0.1, 0.2, 0.3]) == 3
    assert rule.rounds([0.1, 0.2, 0.205, 0.209, 0.9]) == 2  # stopped before the last
    assert rule.rounds([0.1, 0.2, 0.205, 0.25, 0.24, 0.23]) == 4
    assert rule.rounds([0.5, 0.4, 0.3]) == 1


def test_stopping_comes_from_the_configuration(spark, tmp_path):
    built = models.build_models_from_config()["gradient_boosting"]
    assert (built.stopping.patience, built.stopping.min_delta, built.getMaxIter()) == (10, 0.001, 50)
    entry = {"algorithm": "GradientBoostingRegressor", "hyperparameters": {**BOOST, "learning_rate": 1.0, "subsample": 1.0, "n_estimators": 5},
             "early_stopping": {"enabled": True, "monitor": "validation_score", "patience": 2, "min_delta": 0.2}}
    df = learnable(spark, 200)[0].coalesce(1).persist()
    ready = df.withColumn("split", F.expr("IF(id % 4 = 0, 'val', 'train')"))
    found = models.train_all(ready, models.build_models_from_config({"boost": entry}), k=0)["boost"]
    assert 1 <= found.model.getNumTrees < 5 and found.params["maxIter"] == str(found.model.getNumTrees)
    found.model.write().save(str(tmp_path / "model"))
    again = type(found.model).load(str(tmp_path / "model"))
    rows = df.limit(20)
    assert [r["y_pred"] for r in models.predict(rows, again).orderBy("id").collect()] == [r["y_pred"] for r in models.predict(rows, found.model).orderBy("id").collect()]


def test_grid_points_of_other_rounds_share_a_fit_and_a_search_goes_on(spark, tmp_path, monkeypatch):
    df = learnable(spark, 100, noise=3000.0)[0].coalesce(1).persist()
    grid, base = {"n_estimators": [1, 3], "learning_rate": [0.2, 0.5]}, {**BOOST, "subsample": 1.0, "max_depth": 1}
    alone = {tuple(p.values()): models.cross_validate(df, models.build_estimator("GradientBoostingRegressor", {**base, **p}), k=2)
             for p in models.grid_points(grid)}
    shared = []
    plain = models.cross_validate_rounds
    monkeypatch.setattr(models, "cross_validate_rounds", lambda *a, **k: shared.append(a[2]) or plain(*a, **k))
    out = str(tmp_path / "results")
    search = lambda g: {(int(r["params"]["n_estimators"]), float(r["params"]["learning_rate"])): r["cv_rmse_mean"]
                        for r in models.grid_search(df, "GradientBoostingRegressor", g, base, k=2, results=out).collect()}
    assert search(grid) == pytest.approx({p: np.mean(list(c.values())) for p, c in alone.items()}, rel=1e-9)
    assert shared == [[1, 3], [1, 3]]
    more = search({**grid, "learning_rate": [0.2, 0.5, 0.7]})
    assert shared == [[1, 3]] * 3 and len(more) == 6  # only what was not yet finished


def test_out_of_bag_equals_brute_force(spark):
    df, _, y = learnable(spark, 90, noise=3000.0)
    forest = models.fit_bagged_forest(df, {"n_estimators": 5, "max_depth": 4, "max_features": None, "random_state": 7})
    bags = df.selectExpr("id", *[f"{forest.weight(i)} AS w{i}" for i in range(5)]).orderBy("id").collect()
    weights = np.array([[r[f"w{i}"] for i in range(5)] for r in bags])
    assert 0.25 < (weights == 0).mean() < 0.5 and weights.max() > 1
    vectors = models.assemble(df, S.FEATURES).orderBy("id").collect()
    each = np.array([[t.predict(r[models.VECTOR]) for t in forest.trees] for r in vectors])
    got = forest.scored(df).orderBy("id").collect()
    some = [k for k in range(90) if (weights[k] == 0).any()]
    want = np.array([each[k][weights[k] == 0].mean() for k in some])
    assert [k for k in range(90) if got[k]["oob_pred"] is not None] == some
    assert [got[k]["oob_pred"] for k in some] == pytest.approx(list(want)) and [r["y_pred"] for r in got] == pytest.approx(list(each.mean(1)))
    assert forest.oob_r2(df) == pytest.approx(1 - np.mean((y[some] - want) ** 2) / np.var(y[some]))
    # a tree is what a weighted fit of its bag gives: repeating rows as often as they are in the bag
    repeated = df.withColumn("w", F.expr(forest.weight(2))).selectExpr("*", "explode(sequence(1, w)) AS copy").where("w > 0")
    alone = models.fit_model(repeated.coalesce(1), models.build_estimator("RandomForestRegressor", {
        "n_estimators": 1, "bootstrap": False, "max_depth": 1, "max_features": None, "random_state": 9}))
    stump = models.fit_bagged_forest(df.coalesce(1), {"n_estimators": 3, "max_depth": 1, "max_features": None, "random_state": 7}).trees[2]
    assert sorted({round(stump.predict(r[models.VECTOR]), 3) for r in vectors}) == sorted({round(alone.predict(r[models.VECTOR]), 3) for r in vectors})


def test_a_large_input_gets_more_partitions_than_asked_for(spark, monkeypatch):
    monkeypatch.setattr(models, "PART_ROWS", 50)
    ready = stratified_split(learnable(spark, 300)[0])
    for asked, made in ((2, 6), (8, 8)):
        kept = models.training_input(ready, partitions=asked)
        assert kept.rdd.getNumPartitions() == made and kept.count() == 300
        kept.unpersist()


def test_rows_that_are_kept_are_not_kept_again(spark):
    ready = stratified_split(learnable(spark, 200)[0]).persist()
    kept = models.training_input(ready)
    assert not kept.storageLevel.useMemory and kept.count() == 200
    kept.unpersist()
    assert ready.storageLevel.useMemory
    ready.unpersist()


def test_folds_of_a_small_table_are_fitted_together(spark, monkeypatch):
    df, pools = learnable(spark, 120, noise=2000.0)[0].coalesce(1), []
    tree = models.build_estimator("RandomForestRegressor", {"n_estimators": 1, "bootstrap": False, "max_depth": 2, "max_features": None})
    pool = models.ThreadPool
    monkeypatch.setattr(models, "ThreadPool", lambda n: pools.append(n) or pool(n))
    together = models.cross_validate(df, tree, k=3)
    monkeypatch.setattr(models, "FIT_ROWS", 100)
    assert models.cross_validate(df, tree, k=3) == pytest.approx(together) and list(together) == [0, 1, 2]
    assert models.cross_validate(df, tree, k=3, parallelism=2) == pytest.approx(together) and pools == [3, 1, 2]


def test_residual_grid(spark):
    rows = [("m", "val", 10.0, 0.0), ("m", "val", 10.0, 10.0), ("m", "val", 6.0, 5.0), ("m", "val", None, 5.0), ("one", "val", 1.0, 1.0)]
    got = {tuple(r) for r in metrics.residual_grid(predictions(spark, rows), bins=4).collect()}
    assert got == {("m", "val", 0, 3, 1), ("m", "val", 3, 0, 1), ("m", "val", 2, 0, 1), ("one", "val", 0, 0, 1)}


PLAIN = {"max_depth": 4, "max_features": None, "random_state": 3, "min_samples_leaf": 3}


@pytest.mark.parametrize("algorithm, settings", [
    ("RandomForestRegressor", {"n_estimators": 1, "bootstrap": False}), ("GradientBoostingRegressor", {"n_estimators": 5, "learning_rate": 0.3})])
def test_trees_without_draws_equal_those_of_spark(spark, tmp_path, algorithm, settings):
    df, _, _ = learnable(spark, 700, noise=5000.0)
    estimator = models.build_estimator(algorithm, PLAIN | settings)
    ready = models.assemble(df, S.FEATURES)
    mine, theirs = models.fit_model(df, estimator), estimator.fit(ready)
    assert type(mine) is type(theirs) and mine.getNumTrees == theirs.getNumTrees and mine.numFeatures == theirs.numFeatures
    assert [t.numNodes for t in mine.trees] == [t.numNodes for t in theirs.trees]
    both = theirs.transform(mine.transform(ready).withColumnRenamed("prediction", "p"))
    assert both.where("abs(p - prediction) > 1e-6 * abs(prediction)").isEmpty()
    assert mine.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), rel=1e-6)
    mine.write().save(str(tmp_path / "model"))
    again = type(mine).load(str(tmp_path / "model"))
    assert again.transform(ready).where("prediction IS NULL").isEmpty() and again.toDebugString == mine.toDebugString


@pytest.mark.parametrize("algorithm, settings", [
    ("RandomForestRegressor", {"n_estimators": 2, "bootstrap": False}), ("GradientBoostingRegressor", {"n_estimators": 4, "learning_rate": 0.3})])
def test_folds_are_grown_together_and_equal_fits_of_their_own(spark, monkeypatch, algorithm, settings):
    df = learnable(spark, 300, noise=5000.0)[0].selectExpr("id", "price", "id % 5 AS a", "id * id % 7 AS b")
    folded = models.kfold_assign(df, "id", 3).repartition(4, "id").persist()  # few values: all fits have the same bins
    estimator, want = models.build_estimator(algorithm, PLAIN | settings), {}
    for i in range(3):
        scored = estimator.fit(models.assemble(folded.where(F.col("fold") != i), ["a", "b"])).transform(
            models.assemble(folded.where(F.col("fold") == i), ["a", "b"]))
        want[i] = scored.agg(F.sqrt(F.avg((F.col("price") - F.col("prediction")) ** 2))).first()[0]
    passes, grow = [], trees._grow
    monkeypatch.setattr(trees, "_grow", lambda blocks, wanted, *a: passes.append(len(wanted)) or grow(blocks, wanted, *a))
    got = models.cross_validate(folded, estimator, ["a", "b"], k=3, parallelism=1)
    assert got == pytest.approx(want)
    assert passes == ([6] if algorithm == "RandomForestRegressor" else [3] * 4)


def test_large_counts_are_merged_in_the_executors(spark, monkeypatch):
    df, _, _ = learnable(spark, 400, noise=5000.0)
    df = df.repartition(3, "id").persist()
    estimator = models.build_estimator("RandomForestRegressor", {"n_estimators": 6, "max_depth": 5, "random_state": 9})
    first = models.fit_model(df, estimator).toDebugString
    monkeypatch.setattr(trees, "DRIVER_BYTES", 0)
    monkeypatch.setattr(trees, "HIST_BYTES", 30_000)  # a node at a time, or a few
    assert models.fit_model(df, estimator).toDebugString == first


def test_odd_rows_fail_as_in_spark(spark):
    df, _, _ = learnable(spark, 50)
    estimator = models.build_estimator("RandomForestRegressor", {"n_estimators": 2, "random_state": 1})
    for odd in ({S.FEATURES[0]: F.lit(None).cast("double")}, {S.FEATURES[1]: F.lit(float("nan"))}, {"price": F.lit(None).cast("double")}):
        with pytest.raises(Exception):
            models.fit_model(df.withColumns(odd), estimator)
    with pytest.raises(Exception):
        models.fit_model(df.where("id < 0"), estimator)

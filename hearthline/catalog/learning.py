"""Metrics, models, scoring, audit and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearthline import schema as S
from hearthline.catalog.base import (
    COMPARE, EVAL, FIT_CTES, LEARNABLE, METRIC, MODELS, PRED, SCORED, SPLIT_CTES, TIER, fixed_scorer, learnable,
    over_audit, over_houses, predictions, query, rounded,
)
from hearthline.functions.columns import confidence
from hearthline.operators import audit, metrics, models, preprocess, scoring, split
from hearthline.plans import house
from hearthline.session import scratch_path
from hearthline.sources import state
from hearthline.sources.tables import audit_log, audit_of, houses, houses_of
from hearthline.streaming import flows

_M = {"rmse": 4, "mae": 4, "r2": 6, "mape": 4}
_M_SQL = "round(rmse, 4) AS rmse, round(mae, 4) AS mae, round(r2, 6) AS r2, round(mape, 4) AS mape"


def measured(spark, folder):
    return metrics.regression_metrics(predictions(spark, folder))


def compared(spark, folder):
    return metrics.comparison(measured(spark, folder))


# -- metrics -----------------------------------------------------------------------

@query("regression_metrics", over_houses(f"SELECT model, split, n, {_M_SQL} FROM m", PRED, METRIC))
def regression_metrics(spark, folder):
    return rounded(measured(spark, folder), _M)


@query("cv_summary", over_houses("""SELECT model, round(avg(rmse), 4) AS cv_rmse_mean, round(stddev_pop(rmse), 4) AS cv_rmse_std
  FROM (SELECT model, fold, sqrt(avg((y - y_pred) * (y - y_pred))) AS rmse FROM p GROUP BY model, fold) GROUP BY model""", PRED))
def cv_summary(spark, folder):
    return rounded(metrics.cv_summary(predictions(spark, folder)), {"cv_rmse_mean": 4, "cv_rmse_std": 4})


@query("rank_models", over_houses("""SELECT model, round(r2_train, 6) AS r2_train, round(r2_val, 6) AS r2_val,
  round(rmse_train, 4) AS rmse_train, round(rmse_val, 4) AS rmse_val, round(mae_val, 4) AS mae_val,
  round(r2_train - r2_val, 6) AS r2_gap, r2_train - r2_val > 0.1 AS overfit,
  row_number() OVER (ORDER BY r2_val DESC, model) AS place FROM c""", PRED, METRIC, COMPARE))
def rank_models(spark, folder):
    ranked = metrics.rank_models(compared(spark, folder)).collect()  # one row per model
    table = spark.createDataFrame([(*r, i + 1) for i, r in enumerate(ranked)],
                                  "model string, r2_train double, r2_val double, rmse_train double, rmse_val double, "
                                  "mae_val double, r2_gap double, overfit boolean, place bigint")
    return rounded(table, {"r2_train": 6, "r2_val": 6, "rmse_train": 4, "rmse_val": 4, "mae_val": 4, "r2_gap": 6})


@query("select_best_model", over_houses("""SELECT model, round(r2_val, 6) AS r2_val FROM c
  ORDER BY c.r2_val DESC, list_position(['linear_regression', 'random_forest', 'gradient_boosting'], model) LIMIT 1""",
                                        PRED, METRIC, COMPARE))
def select_best_model(spark, folder):
    return rounded(metrics.select_best_model(compared(spark, folder), MODELS).select("model", "r2_val"), {"r2_val": 6})


@query("stack_metrics", over_houses("""SELECT model, split, metric, round(value, 4) AS value FROM
  (UNPIVOT (SELECT model, split, rmse, mae, r2, mape FROM m) ON rmse, mae, r2, mape INTO NAME metric VALUE value)""",
                                    PRED, METRIC))
def stack_metrics(spark, folder):
    rows = measured(spark, folder)
    per_model = [metrics.metrics_long(rows.where(F.col("model") == m)) for m in MODELS]
    return rounded(metrics.stack_metrics(per_model), {"value": 4})


@query("evaluate_test", over_houses("""SELECT model, round(rmse_test, 4) AS rmse_test, round(mae_test, 4) AS mae_test,
  round(r2_test, 6) AS r2_test, round(mape_test, 4) AS mape_test, round(r2_val, 6) AS r2_val,
  round(r2_val - r2_test, 6) AS r2_gap, abs(ev.r2_val - ev.r2_test) > 0.05 AS gap_flag,
  CASE WHEN abs(ev.r2_val - ev.r2_test) < 0.05 THEN 'excellent' WHEN abs(ev.r2_val - ev.r2_test) < 0.1 THEN 'good'
  ELSE 'watch' END AS generalisation FROM ev""", PRED, METRIC, EVAL))
def evaluate_test(spark, folder):
    return rounded(metrics.evaluate_test(measured(spark, folder)), {
        "rmse_test": 4, "mae_test": 4, "r2_test": 6, "mape_test": 4, "r2_val": 6, "r2_gap": 6})


@query("quality_verdict", over_houses("""SELECT model, CASE WHEN r2_test > 0.5 AND abs(r2_val - r2_test) < 0.05 THEN 'good'
  WHEN r2_test > 0.3 THEN 'acceptable' ELSE 'improve' END AS verdict FROM ev""", PRED, METRIC, EVAL))
def quality_verdict(spark, folder):
    return metrics.quality_verdict(metrics.evaluate_test(measured(spark, folder))).select("model", "verdict")


_CRITERIA_SQL = ", ".join(f"('{m}', {r}, {e}, {t})" for m, r, e, t in metrics.CRITERIA)


@query("performance_gate", over_houses(f"""SELECT c.model, array_to_string(list_filter([
  CASE WHEN r2_val < min_r2 THEN 'r2' END, CASE WHEN rmse_val > max_rmse THEN 'rmse' END,
  CASE WHEN seconds > max_s THEN 'time' END], lambda x: x IS NOT NULL), ',') AS warnings,
  NOT (r2_val < min_r2 OR rmse_val > max_rmse OR seconds > max_s) AS performance_ok
  FROM (SELECT *, CASE model WHEN 'linear_regression' THEN 12 ELSE 1 END AS seconds FROM c) c
  JOIN (VALUES {_CRITERIA_SQL}) k(model, min_r2, max_rmse, max_s) ON c.model = k.model""", PRED, METRIC, COMPARE))
def performance_gate(spark, folder):
    seconds = F.when(F.col("model") == "linear_regression", 12.0).otherwise(1.0)
    gated = metrics.performance_gate(
        compared(spark, folder).withColumn("training_seconds", seconds), metrics.criteria_table(spark))
    return gated.select("model", F.array_join("warnings", ",").alias("warnings"), "performance_ok")


@query("residual_table", over_houses("SELECT model, row_id, split, fold, y, y_pred, y - y_pred AS residual FROM p", PRED))
def residual_table(spark, folder):
    return metrics.residual_table(predictions(spark, folder))


@query("residual_grid", over_houses("""SELECT model, split, x, y_cell, count(*) AS n FROM (SELECT p.model, p.split,
  CAST(least(floor(coalesce((y_pred - xl) / nullif(xh - xl, 0), 0) * 20), 19) AS INTEGER) AS x,
  CAST(least(floor(coalesce((y - y_pred - yl) / nullif(yh - yl, 0), 0) * 20), 19) AS INTEGER) AS y_cell
  FROM p JOIN (SELECT model, split, min(y_pred) AS xl, max(y_pred) AS xh, min(y - y_pred) AS yl, max(y - y_pred) AS yh FROM p GROUP BY ALL) e
  ON p.model = e.model AND p.split = e.split) GROUP BY ALL""", PRED))
def residual_grid(spark, folder):
    return metrics.residual_grid(predictions(spark, folder))


@query("residual_diagonal", over_houses(
    "SELECT model, split, min(y) AS y_min, max(y) AS y_max FROM p GROUP BY model, split", PRED))
def residual_diagonal(spark, folder):
    return metrics.diagonal(predictions(spark, folder))


@query("chart_metrics_table", over_houses("""SELECT model, split, metric, round(value, 4) AS value,
  CASE model WHEN 'linear_regression' THEN 'Linear Regression' WHEN 'random_forest' THEN 'Random Forest'
  ELSE 'Gradient Boosting' END AS label FROM (UNPIVOT (SELECT model, split, rmse, r2 FROM m WHERE split <> 'test')
  ON rmse, r2 INTO NAME metric VALUE value)""", PRED, METRIC))
def chart_metrics_table(spark, folder):
    return rounded(metrics.chart_metrics_table(measured(spark, folder)), {"value": 4})


# -- models ------------------------------------------------------------------------

def imputed_houses(spark, folder):
    rows = houses(spark, folder)
    return preprocess.impute_median(
        preprocess.fill_constant(rows), preprocess.fit_preprocessing(rows)).select("id", "price", *S.FEATURES)


def learnable_split(spark, folder):
    """Scaled features of the learnable houses, with their split."""
    return house.prepare(learnable(imputed_houses(spark, folder)))[0]


_LEARN_H = f"h2 AS (SELECT id, {LEARNABLE} AS price FROM hi)"
# The same split, taken over the learnable price.
_LEARN_SPLIT = (*FIT_CTES[:3], _LEARN_H, SPLIT_CTES[0].replace("FROM h)", "FROM h2)"), *SPLIT_CTES[1:])


@query("fit_linear", over_houses(
    f"SELECT id, round({LEARNABLE}, 1) AS fitted, TRUE AS within FROM hi", *FIT_CTES[:3]))
def fit_linear(spark, folder):
    """All eleven features: what the fitted numbers give is the price, which follows from them."""
    rows = learnable(imputed_houses(spark, folder))
    fitted = models.LinearFormula.of(
        models.fit_model(rows, models.build_models_from_config()["linear_regression"]), S.FEATURES)
    return rows.select("id", F.round(fitted.column(), 1).alias("fitted"),
                       (F.abs(fitted.column() - F.col("price")) < 0.01).alias("within"))


@query("predict_linear", over_houses(
    f"SELECT id, round({LEARNABLE}, 1) AS y_pred FROM hi", *FIT_CTES[:3]))
def predict_linear(spark, folder):
    """Least squares over all eleven features gives back a price that follows from them."""
    rows = learnable(imputed_houses(spark, folder))
    model = models.fit_model(rows, models.build_models_from_config()["linear_regression"])
    return models.predict(rows, model).select("id", F.round("y_pred", 1).alias("y_pred"))


@query("cross_validate", over_houses(
    "SELECT fold, count(*) AS n, CAST(0 AS DOUBLE) AS rmse FROM f GROUP BY fold", *FIT_CTES[:3],
    "f AS (SELECT CAST(ntile(5) OVER (ORDER BY id) - 1 AS INTEGER) AS fold FROM hi)"))
def cross_validate(spark, folder):
    """All eleven features, five folds: a price that follows from them has no error on any fold."""
    rows = split.kfold_assign(learnable(imputed_houses(spark, folder)))
    found = models.cross_validate(rows, models.build_models_from_config()["linear_regression"])
    errors = spark.createDataFrame(list(found.items()), "fold int, rmse double")
    sizes = rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n"))
    return rounded(sizes.join(F.broadcast(errors), "fold"), {"rmse": 1})


@query("train_evaluate", over_houses("""SELECT split, count(*) AS n, CAST(1 AS DOUBLE) AS r2, CAST(0 AS DOUBLE) AS rmse
  FROM sp WHERE split <> 'test' GROUP BY split""", *_LEARN_SPLIT))
def train_evaluate(spark, folder):
    """The linear model on the learnable houses: exact on train and validation."""
    ready = learnable_split(spark, folder)
    trained = models.train_evaluate("linear_regression", models.build_models_from_config()["linear_regression"], ready)
    found = spark.createDataFrame([(s, m["r2"], m["rmse"]) for s, m in trained.metrics.items()],
                                  "split string, r2 double, rmse double")
    sizes = ready.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    return rounded(sizes.join(F.broadcast(found), "split"), {"r2": 6, "rmse": 2}).select(
        "split", "n", F.abs("r2").alias("r2"), F.abs("rmse").alias("rmse"))


@query("save_model", over_houses("""SELECT 'linear_regression' AS name, 'LinearRegressionModel' AS kind, 11 AS n_features,
  CAST(1 AS DOUBLE) AS r2_val, CAST(1 AS DOUBLE) AS r2_test, count(*) AS n_rows FROM h"""))
def save_model(spark, folder):
    """The best model with its metadata, validation and test metrics apart."""
    out = scratch_path(spark, "model")
    ready = learnable_split(spark, folder)
    chosen = house.train_and_select(ready, {"linear_regression": models.MODEL_CONFIG["linear_regression"]})
    state.save_model(spark, chosen.best, out, chosen.test)
    n = ready.count()
    return spark.read.parquet(f"{out}/models").select(
        "name", "kind", F.size("features").alias("n_features"), F.round("r2_val", 6).alias("r2_val"),
        F.round(F.col("metrics_test")["r2"], 6).alias("r2_test"), F.lit(n).alias("n_rows"))


@query("load_model", over_houses(f"SELECT id, round({LEARNABLE}, 1) AS y_pred FROM hi", *FIT_CTES[:3]))
def load_model(spark, folder):
    out = scratch_path(spark, "model")
    ready = learnable_split(spark, folder)
    chosen = house.train_and_select(ready, {"linear_regression": models.MODEL_CONFIG["linear_regression"]})
    state.save_model(spark, chosen.best, out, chosen.test)
    _, model, features = state.load_model(spark, out)
    return models.predict(ready, model, features).select("id", F.round("y_pred", 1).alias("y_pred"))


@query("model_health", over_houses("SELECT 'healthy' AS status, TRUE AS model_loaded, TRUE AS fit_loaded, count(*) AS n FROM h"))
def model_health(spark, folder):
    out = scratch_path(spark, "health")
    ready, fit = house.prepare(learnable(imputed_houses(spark, folder)))
    chosen = house.train_and_select(ready, {"linear_regression": models.MODEL_CONFIG["linear_regression"]})
    state.save_model(spark, chosen.best, out, fit=fit)
    state.save_fit_state(spark, fit, f"{out}/fit")
    scored = house.load_scorer(spark, out).predictions(houses(spark, folder))
    n = scored.where(F.col("prediction").isNotNull()).count()
    return state.model_health(spark, out, f"{out}/fit").withColumn("n", F.lit(n))


@query("versioned_bundle", over_houses(f"""SELECT id, round({LEARNABLE}, 1) AS served, round(2 * ({LEARNABLE}) + 1000, 1) AS second,
  TRUE AS own_split FROM hi""", *FIT_CTES[:3]))
def versioned_bundle(spark, folder):
    """Two runs into one folder; the second has other data, another fit and a worse validation score.

    What is served stays the first run's prices, by its own fit; the second run can still be asked for by its id.
    Each bundle's rule splits its data again as it was split in training.
    """
    out = scratch_path(spark, "bundles")
    rows = imputed_houses(spark, folder)
    linear = {"linear_regression": models.MODEL_CONFIG["linear_regression"]}
    bias = F.when(F.col("split") == "val", F.lit(200000.0) * (F.col("id") % 7 - 3)).otherwise(0.0)
    own_split = True
    for run, data in (("first", learnable(rows)), ("second", learnable(rows).where("id % 2 = 0").withColumn("price", F.expr("2 * price + 1000D")))):
        found = house.prepared(data)
        ready = (found.ready if run == "first" else found.ready.withColumn("price", F.col("price") + bias)).persist()
        chosen = house.train_and_select(ready, linear, k=0)
        state.save_model(spark, chosen.best, out, chosen.test, fit=found.fit, rule=found.rule, run_id=run)
        again = state.load_bundle(spark, out, run_id=run).rule.apply(data).select("id", "split")
        own_split &= again.exceptAll(ready.select("id", "split")).isEmpty()
        ready.unpersist()
    served, second = house.load_scorer(spark, out), house.load_scorer(spark, out, run_id="second")
    both = second.predictions(served.predictions(rows, "served"), "second")
    return both.select("id", F.round("served", 1).alias("served"), F.round("second", 1).alias("second"), F.lit(own_split).alias("own_split"))


R2_FLOOR = 0.45
_ABOVE = over_houses("SELECT m.model, split, count(*) AS n, TRUE AS above FROM sp, m WHERE {where} GROUP BY m.model, split",
                     *_LEARN_SPLIT, "m AS (SELECT unnest({names}) AS model)")


def _above(spark, scored):
    """Rows of each model and split, and whether the fit explains the price."""
    explained = 1 - F.sum((F.col("y") - F.col("y_pred")) ** 2) / (F.var_pop("y") * F.count("y"))
    return scored.groupBy("model", "split").agg(F.count(F.lit(1)).alias("n"), (explained > R2_FLOOR).alias("above"))


def _register_fit(name: str, key: str) -> None:
    @query(key, _ABOVE.format(where="TRUE", names=[name]))
    def fit(spark, folder):
        ready = models.training_input(learnable_split(spark, folder), partitions=8)
        try:
            model = models.fit_model(ready.where(F.col("split") == "train"), models.build_models_from_config()[name])
        finally:
            ready.unpersist()
        return _above(spark, models.predict(ready, model).select(
            F.lit(name).alias("model"), "split", F.col("price").alias("y"), "y_pred"))


_register_fit("random_forest", "fit_forest")
_register_fit("gradient_boosting", "fit_gbt")

_VIEWS = over_houses("SELECT view, count(*) AS n, round(avg(price), 2) AS y_pred FROM h2 GROUP BY view",
                     *FIT_CTES[:3], f"h2 AS (SELECT view, {LEARNABLE} AS price FROM hi)")


def _register_exact(key: str, algorithm: str, settings: dict) -> None:
    @query(key, _VIEWS)
    def fit(spark, folder):
        """One unsampled tree on one feature of few values predicts the mean price of each."""
        rows = learnable(imputed_houses(spark, folder))
        model = models.fit_model(rows, models.build_estimator(algorithm, settings), ["view"])
        scored = models.predict(rows, model, ["view"]).groupBy("view").agg(
            F.count(F.lit(1)).alias("n"), F.round(F.avg("y_pred"), 2).alias("y_pred"))
        return scored


_register_exact("fit_forest_one_tree", "RandomForestRegressor", {
    "n_estimators": 1, "bootstrap": False, "max_depth": 5, "max_features": None, "random_state": 42})
_register_exact("fit_gbt_one_round", "GradientBoostingRegressor", {
    "n_estimators": 1, "learning_rate": 1.0, "max_depth": 5, "random_state": 42})

@query("fit_gbt_early_stopping", over_houses("""SELECT view, count(*) AS n, round(avg(50000 + 90000 * view), 2) AS y_pred, 1 AS rounds
  FROM hi GROUP BY view""", *FIT_CTES[:3]))
def fit_gbt_early_stopping(spark, folder):
    """Patience from a configuration: a price that the first tree explains whole keeps one round of twelve."""
    entry = {"algorithm": "GradientBoostingRegressor", "early_stopping": {"enabled": True, "patience": 3, "min_delta": 0.001},
             "hyperparameters": {"n_estimators": 12, "learning_rate": 0.5, "max_depth": 5, "random_state": 42}}
    rows = imputed_houses(spark, folder).withColumn("price", F.expr("50000D + 90000D * view"))
    model = models.fit_model(rows, models.build_models_from_config({"boost": entry})["boost"], ["view"], rows)
    return models.predict(rows, model, ["view"]).groupBy("view").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("y_pred"), 2).alias("y_pred"), F.lit(model.getNumTrees).alias("rounds"))


_BAG = "CAST('0x' || substr(md5('42-bag-' || t || '-' || CAST(id AS VARCHAR)), 1, 15) AS BIGINT) / CAST(1152921504606846976 AS DOUBLE)"


@query("forest_oob", over_houses(f"""SELECT count(*) FILTER (seen < 4) AS n_scored, count(*) FILTER (seen = 4) AS n_in_every_bag, TRUE AS explains
  FROM (SELECT id, sum(CASE WHEN {_BAG} >= exp(-1) THEN 1 ELSE 0 END) AS seen FROM h, (SELECT unnest(range(4)) AS t) GROUP BY id)"""))
def forest_oob(spark, folder):
    """The out-of-bag score of a forest on all houses: rows that some tree has not seen, by bags that SQL can repeat."""
    rows = learnable(imputed_houses(spark, folder))
    forest = models.fit_bagged_forest(rows, {"n_estimators": 4, "max_depth": 6, "max_features": None, "random_state": 42})
    score = forest.oob_r2(rows)
    return forest.scored(rows).agg(F.count("oob_pred").alias("n_scored"), F.count_if(F.col("oob_pred").isNull()).alias("n_in_every_bag"),
                                   F.lit(score > R2_FLOOR).alias("explains"))


_CONFIG = models.MODEL_CONFIG | {"disabled": {"algorithm": "LinearRegression", "enabled": False},
                                 "unknown": {"algorithm": "Perceptron"}}


@query("build_models_from_config", _ABOVE.format(where="split <> 'test'", names=sorted(models.MODEL_CONFIG)))
def build_models_from_config(spark, folder):
    """Every enabled and known model of the configuration, fitted; the others are left out."""
    ready = learnable_split(spark, folder)
    results = models.train_all(ready, models.build_models_from_config(_CONFIG), k=0, partitions=8)
    found = spark.createDataFrame([(r.name, s, bool(m["r2"] > R2_FLOOR)) for r in results.values() for s, m in r.metrics.items()],
                                  "model string, split string, above boolean")
    sizes = ready.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    return found.join(sizes, "split").select("model", "split", "n", "above")


@query("train_all", over_houses("""SELECT m.model, m.model = 'linear_regression' AS is_best, TRUE AS cross_validated, count(*) AS n
  FROM sp, m WHERE split = 'train' GROUP BY m.model""", *_LEARN_SPLIT, f"m AS (SELECT unnest({sorted(models.MODEL_CONFIG)}) AS model)"))
def train_all(spark, folder):
    """All configured models trained, cross-validated over five folds and compared; the price is linear."""
    ready = learnable_split(spark, folder)
    chosen = house.train_and_select(ready, _CONFIG, partitions=8)
    n = ready.where(F.col("split") == "train").count()
    return chosen.comparison(spark).select(
        "model", (F.col("model") == chosen.best.name).alias("is_best"),
        (F.col("cv_rmse_mean") >= 0).alias("cross_validated"), F.lit(n).alias("n"))


@query("grid_search", over_houses("""SELECT learning_rate, n_estimators, count(*) AS n, TRUE AS measured
  FROM sp, (SELECT unnest(['0.1', '0.3']) AS learning_rate), (SELECT unnest(['3', '6']) AS n_estimators)
  WHERE split = 'train' GROUP BY ALL""", *_LEARN_SPLIT))
def grid_search(spark, folder):
    """A grid of boosting settings over five folds, two points at a time."""
    ready = learnable_split(spark, folder).where(F.col("split") == "train")
    found = models.grid_search(
        ready, "GradientBoostingRegressor", {"n_estimators": [3, 6], "learning_rate": [0.1, 0.3]},
        {"max_depth": 3, "random_state": 42}, parallelism=2, partitions=8)
    return found.select(F.col("params")["learning_rate"].alias("learning_rate"), F.col("params")["n_estimators"].alias("n_estimators"),
                        F.lit(ready.count()).alias("n"), (F.col("cv_rmse_mean") > 0).alias("measured"))


# -- scoring -----------------------------------------------------------------------

_RESPONSE = (f"SELECT id, md5(CAST(id AS VARCHAR)) AS request_id, round(prediction, 2) AS prix_predit, {TIER} AS confiance, "
             "'linear_regression' AS modele_utilise, strftime(date, '%Y-%m-%dT%H:%M:%S.%fZ') AS timestamp, "
             "round((id % 40) / 3, 2) AS duration_ms "
             "FROM sc WHERE reasons = ''")
_ROW_ID = "md5(CAST(id AS STRING))"


@query("batch_score", over_houses(_RESPONSE, *FIT_CTES, SCORED))
def batch_score(spark, folder):
    rows = houses(spark, folder)
    scorer = fixed_scorer(preprocess.fit_preprocessing(rows))
    return scoring.batch_score(rows, scorer, F.expr(_ROW_ID), F.col("date"), keep=("id",), duration_ms=F.expr("(id % 40) / 3"))[0]


@query("confidence_tier", over_houses(
    "SELECT id, price, CASE WHEN price * 2 > 500000 THEN 'Élevée' WHEN price * 2 > 200000 THEN 'Bonne' ELSE 'Faible' END "
    "AS confiance FROM h"))
def confidence_tier(spark, folder):
    return houses(spark, folder).select("id", "price", confidence(F.col("price") * 2).alias("confiance"))


@query("audit_rows", over_houses(f"""SELECT md5(CAST(id AS VARCHAR)) AS request_id, 'prediction' AS event_type,
  CASE WHEN reasons = '' THEN 'success' ELSE 'error' END AS status, nullif(reasons, '') AS error,
  CASE WHEN reasons = '' THEN round(prediction, 4) ELSE 0 END AS prediction,
  CASE WHEN reasons = '' THEN {TIER} ELSE 'Erreur' END AS confidence, 'linear_regression' AS model_used,
  11 AS feature_count, round((id % 40) / 3, 2) AS duration_ms FROM sc""", *FIT_CTES, SCORED))
def audit_rows(spark, folder):
    rows = houses(spark, folder)
    scorer = fixed_scorer(preprocess.fit_preprocessing(rows))
    records = scoring.audit_rows(rows, scorer, F.expr(_ROW_ID), F.col("date"), duration_ms=F.expr("(id % 40) / 3"))
    return records.select(
        "request_id", "event_type", "status", "error", F.round("output.prediction", 4).alias("prediction"),
        "output.confidence", "output.model_used", "input.feature_count", "performance.duration_ms")


# -- audit -------------------------------------------------------------------------

_KIND = "CASE WHEN json_valid(line) THEN json_extract_string(line, '$.event_type') END"


@query("audit_event_counts", over_audit(f"""SELECT count(*) FILTER (k = 'prediction') AS predictions,
  count(*) FILTER (k = 'health_check') AS health_checks, count(*) FILTER (k = 'error') AS errors
  FROM (SELECT {_KIND} AS k FROM a)"""))
def audit_event_counts(spark, folder):
    return audit.audit_event_counts(audit_log(spark, folder))


@query("audit_tail", over_audit("""SELECT line_no, CASE WHEN json_valid(line) THEN line END AS entry,
  CASE WHEN NOT json_valid(line) THEN line END AS raw_message, CASE WHEN NOT json_valid(line) THEN 'raw' END AS type,
  (SELECT count(*) FROM a) AS total_logs, 25 AS showing FROM a ORDER BY ts DESC, line_no DESC LIMIT 25"""))
def audit_tail(spark, folder):
    return audit.audit_tail(audit_log(spark, folder), 25).drop("ts")


_WINDOWS = over_audit(f"""SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start,
  event_type, count(*) AS n FROM (SELECT ts, {_KIND} AS event_type FROM a)
  WHERE event_type IN ('prediction', 'health_check', 'error') GROUP BY 1, 2""")


def _shown(counts):
    return counts.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "event_type", "n")


@query("audit_window_counts", _WINDOWS)
def audit_window_counts(spark, folder):
    return _shown(audit.audit_window_counts(audit_log(spark, folder)))


# -- streams -----------------------------------------------------------------------

def _stream_of(spark, folder, name):
    """A stream over one given table."""
    known = spark.read.parquet(f"{folder}/{name}.parquet").schema
    return flows.read_stream(spark, folder, known, pattern=f"{name}.parquet")


@query("stream_audit_counts", _WINDOWS)
def stream_audit_counts(spark, folder):
    """Window counts kept current by a stream over the events, open windows included."""
    out, checkpoint = scratch_path(spark, "counts"), scratch_path(spark, "counts-state")
    lines = audit_of(_stream_of(spark, folder, "events"))
    flows.write_counts(flows.stream_audit_counts(lines), out, checkpoint).awaitTermination()
    return _shown(flows.read_counts(spark, out))


@query("stream_score", over_houses(_RESPONSE, *FIT_CTES, SCORED))
def stream_score(spark, folder):
    """The batch scores again, from a stream of requests."""
    out, checkpoint = scratch_path(spark, "scores"), scratch_path(spark, "scores-state")
    scorer = fixed_scorer(preprocess.fit_preprocessing(houses(spark, folder)))
    requests = houses_of(_stream_of(spark, folder, "orders"))
    scored = flows.stream_score(
        requests, scorer, F.expr(_ROW_ID), F.col("date"), keep=("id",), duration_ms=F.expr("(id % 40) / 3"))
    flows.write_stream(scored, out, checkpoint).awaitTermination()
    return spark.read.schema(scored.schema).parquet(out)


@query("stream_score_once", over_houses(_RESPONSE, *FIT_CTES, SCORED))
def stream_score_once(spark, folder):
    """The batch scores once more, from a stream in which every request is sent twice."""
    out, checkpoint = scratch_path(spark, "scores"), scratch_path(spark, "scores-state")
    scorer = fixed_scorer(preprocess.fit_preprocessing(houses(spark, folder)))
    sent = houses_of(_stream_of(spark, folder, "orders"))
    scored = flows.stream_score(
        flows.once(sent.union(sent), "id", "date", "100 years"), scorer, F.expr(_ROW_ID), F.col("date"), keep=("id",),
        duration_ms=F.expr("(id % 40) / 3"))
    flows.write_stream(scored, out, checkpoint).awaitTermination()
    return spark.read.schema(scored.schema).parquet(out)

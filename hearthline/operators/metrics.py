"""Regression metrics and what is decided from them.

Predictions are long rows ``(model, split, y, y_pred, ...)``; metrics are one row per
model and split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.functions.columns import display_name

METRICS = ["rmse", "mae", "r2", "mape"]

# Limits of the verdicts and of the reported gaps.
GOOD_R2, GOOD_GAP, FAIR_R2 = 0.5, 0.05, 0.3
OVERFIT_GAP, GENERAL_GAP, WATCH_GAP = 0.1, 0.05, 0.10

# Performance criteria per model (lowest R2, highest RMSE, longest training).
CRITERIA = [
    ("linear_regression", 0.4, 300000.0, 10.0),
    ("random_forest", 0.45, 280000.0, 60.0),
    ("gradient_boosting", 0.45, 290000.0, 120.0),
]


def metric_columns(y: Column, y_pred: Column) -> list[Column]:
    """rmse, mae, r2, mape. R2 of a constant target is 1 when perfect, else 0."""
    error = y - y_pred
    squares, spread = F.sum(error * error), F.var_pop(y) * F.count(y)
    flat = F.min(y) == F.max(y)
    r2 = F.when(flat, F.when(squares == 0, 1.0).otherwise(0.0)).otherwise(1 - F.try_divide(squares, spread))
    return [
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        r2.alias("r2"),
        (F.avg(F.abs(F.try_divide(error, y + F.lit(1e-8)))) * 100).alias("mape"),
    ]


def regression_metrics(predictions: DataFrame, by: tuple[str, ...] = ("model", "split")) -> DataFrame:
    return predictions.groupBy(*by).agg(*metric_columns(F.col("y"), F.col("y_pred")))


def metrics_long(metrics: DataFrame, by: tuple[str, ...] = ("model", "split")) -> DataFrame:
    return metrics.unpivot(list(by), METRICS, "metric", "value")


def cv_summary(fold_predictions: DataFrame) -> DataFrame:
    """Mean and population std of the fold RMSEs per model."""
    error = F.col("y") - F.col("y_pred")
    folds = fold_predictions.groupBy("model", "fold").agg(F.sqrt(F.avg(error * error)).alias("rmse"))
    return folds.groupBy("model").agg(
        F.avg("rmse").alias("cv_rmse_mean"), F.stddev_pop("rmse").alias("cv_rmse_std"))


def _at(split: str, metric: str) -> Column:
    return F.max(F.when(F.col("split") == split, F.col(metric)))


def comparison(metrics: DataFrame, cv: DataFrame | None = None) -> DataFrame:
    """One row per model: train and validation metrics, the gap, and the CV summary if given."""
    out = metrics.groupBy("model").agg(
        _at("train", "r2").alias("r2_train"), _at("val", "r2").alias("r2_val"),
        _at("train", "rmse").alias("rmse_train"), _at("val", "rmse").alias("rmse_val"),
        _at("val", "mae").alias("mae_val"),
    ).withColumn("r2_gap", F.col("r2_train") - F.col("r2_val"))
    out = out.withColumn("overfit", F.col("r2_gap") > OVERFIT_GAP)
    return out if cv is None else out.join(cv, "model", "left")


def rank_models(table: DataFrame) -> DataFrame:
    """The comparison sorted by validation R2, best first; NaN and ties last and by name."""
    return table.orderBy(F.nanvl("r2_val", F.lit(None)).desc_nulls_last(), "model")


def select_best_model(table: DataFrame, order: list[str] | None = None) -> DataFrame:
    """The model with the highest validation R2. The first listed wins a tie; NaN never wins."""
    rank = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model")) if order else F.col("model")
    usable = F.col("r2_val").isNotNull() & ~F.isnan("r2_val")
    return table.where(usable).orderBy(F.desc("r2_val"), rank).limit(1)


def evaluate_test(metrics: DataFrame) -> DataFrame:
    """Test metrics per model with the validation-test gap, its flag and its tier."""
    out = metrics.groupBy("model").agg(
        *[_at("test", m).alias(f"{m}_test") for m in METRICS], _at("val", "r2").alias("r2_val"))
    gap = F.col("r2_val") - F.col("r2_test")
    return out.withColumn("r2_gap", gap).withColumns({
        "gap_flag": F.abs("r2_gap") > GENERAL_GAP,
        "generalisation": F.when(F.abs("r2_gap") < GENERAL_GAP, "excellent")
        .when(F.abs("r2_gap") < WATCH_GAP, "good").otherwise("watch"),
    })


def quality_verdict(evaluated: DataFrame) -> DataFrame:
    gap = F.abs(F.col("r2_val") - F.col("r2_test"))
    return evaluated.withColumn(
        "verdict",
        F.when((F.col("r2_test") > GOOD_R2) & (gap < GOOD_GAP), "good")
        .when(F.col("r2_test") > FAIR_R2, "acceptable").otherwise("improve"))


def criteria_table(spark) -> DataFrame:
    return spark.createDataFrame(
        CRITERIA, "model string, min_r2_score double, max_rmse double, max_training_time_seconds double")


def performance_gate(results: DataFrame, criteria: DataFrame) -> DataFrame:
    """``(model, r2_val, rmse_val, training_seconds)`` against the criteria: verdict and all warnings.

    A criterion that is absent does not restrict. Both sides have one row per model.
    """
    warnings = F.array_compact(F.array(
        F.when(F.col("r2_val") < F.col("min_r2_score"), "r2"),
        F.when(F.col("rmse_val") > F.col("max_rmse"), "rmse"),
        F.when(F.col("training_seconds") > F.col("max_training_time_seconds"), "time"),
    ))
    return results.join(criteria, "model", "left").withColumn("warnings", warnings).withColumn(
        "performance_ok", F.size("warnings") == 0)


def residual_table(predictions: DataFrame) -> DataFrame:
    return predictions.withColumn("residual", F.col("y") - F.col("y_pred"))


def residual_grid(predictions: DataFrame, bins: int = 20) -> DataFrame:
    """The chart of residuals against predictions in bounded size: per model and split the rows of each of bins x bins
    equal cells from least to greatest value. Cells without rows, and rows without a residual, are left out."""
    rows = residual_table(predictions).where("residual IS NOT NULL")
    ends = rows.groupBy("model", "split").agg(*[f(c).alias(f"{n}_{c}") for c in ("y_pred", "residual") for n, f in (("low", F.min), ("high", F.max))])

    def cell(c: str) -> Column:
        low, high = F.col(f"low_{c}"), F.col(f"high_{c}")
        at = F.floor((F.col(c) - low) / F.nullif(high - low, F.lit(0.0)) * bins)
        return F.least(F.coalesce(at, F.lit(0)), F.lit(bins - 1)).cast("int")  # one value only: the first cell
    # one row of ends for each model and split
    placed = rows.join(F.broadcast(ends), ["model", "split"]).withColumns({"x": cell("y_pred"), "y_cell": cell("residual")})
    return placed.groupBy("model", "split", "x", "y_cell").agg(F.count(F.lit(1)).alias("n"))


def diagonal(predictions: DataFrame) -> DataFrame:
    """Ends of the y = x line per model and split."""
    return predictions.groupBy("model", "split").agg(F.min("y").alias("y_min"), F.max("y").alias("y_max"))


def chart_metrics_table(metrics: DataFrame) -> DataFrame:
    """model x {train, val} x {r2, rmse} in long form, with display names."""
    shown = metrics.where(F.col("split").isin("train", "val"))
    return shown.unpivot(["model", "split"], ["r2", "rmse"], "metric", "value").withColumn(
        "label", display_name(F.col("model")))


def stack_metrics(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out

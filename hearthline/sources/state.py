"""Fit state, models and run records on shared storage."""

from __future__ import annotations

import math
import platform
import uuid
from collections.abc import Callable
from dataclasses import dataclass

import pyspark
from py4j.protocol import Py4JJavaError
from pyspark.ml.base import Model
from pyspark.ml.regression import GBTRegressionModel, LinearRegressionModel, RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from hearthline.operators.models import Trained
from hearthline.operators.preprocess import FeatureFit, Preprocessing
from hearthline.operators.split import SplitRule

_LOADERS = {
    "LinearRegressionModel": LinearRegressionModel,
    "RandomForestRegressionModel": RandomForestRegressionModel,
    "GBTRegressionModel": GBTRegressionModel,
}
MODEL_SCHEMA = (
    "name string, kind string, path string, features array<string>, r2_val double, "
    "metrics_val map<string,double>, metrics_test map<string,double>, hyperparameters map<string,string>, "
    "saved_at timestamp, environment map<string,string>, run_id string, "
    "fit array<struct<feature: string, median: double, mean: double, std_pop: double>>, split_rule string"
)
RUN_SCHEMA = (
    "run_name string, model string, started_at timestamp, params map<string,string>, "
    "metrics map<string,double>, tags map<string,string>"
)


def save_fit_state(spark: SparkSession, fit: Preprocessing, path: str) -> None:
    fit.to_frame(spark).coalesce(1).write.mode("overwrite").parquet(path)


def load_fit_state(spark: SparkSession, path: str) -> Preprocessing:
    try:
        return Preprocessing.from_frame(spark.read.parquet(path))
    except AnalysisException as e:
        raise FileNotFoundError(f"no fit state at {path}") from e


def _numbers(values: dict | None) -> dict[str, float]:
    return {k: float(v) for k, v in (values or {}).items() if v is not None}


def save_model(
    spark: SparkSession, trained: Trained, root: str, metrics_test: dict[str, float] | None = None,
    environment: dict[str, str] | None = None, fit: Preprocessing | None = None, rule: SplitRule | None = None,
    run_id: str | None = None,
) -> str:
    """The model by the ML writer, in a folder of its own, then one row about it in ``root``/models.

    The row is written last, as one file, and never changes. With ``fit`` it is a bundle: it binds the model to
    the preprocessing, features and split that it was trained with, so no later run can part them.
    """
    path = f"{root}/model_{trained.name}-{uuid.uuid4().hex}"
    trained.model.write().save(path)
    versions = {"spark": pyspark.__version__, "python": platform.python_version(), **(environment or {})}
    row = (trained.name, type(trained.model).__name__, path, trained.features, trained.metrics["val"]["r2"],
           _numbers(trained.metrics["val"]), _numbers(metrics_test), trained.params, None, versions, run_id,
           None if fit is None else [(f.feature, f.median, f.mean, f.std_pop) for f in fit.fits],
           None if rule is None else rule.to_json())
    spark.createDataFrame([row], MODEL_SCHEMA).withColumn("saved_at", F.current_timestamp()).coalesce(1).write.mode(
        "append").parquet(f"{root}/models")
    return path


def _saved(spark: SparkSession, root: str) -> DataFrame:
    """One row for each saved model; rows of earlier versions have no run and no fit."""
    try:
        spark.read.parquet(f"{root}/models")  # an absent folder is an error here, not an empty table
    except AnalysisException as e:
        raise FileNotFoundError(f"no models at {root}") from e
    return spark.read.schema(MODEL_SCHEMA).parquet(f"{root}/models")


def _score(r2: float | None) -> float:
    return -math.inf if r2 is None or math.isnan(r2) else r2


def load_model(spark: SparkSession, root: str, name: str | None = None):
    """(name, model, features) of the best validation R2, or of the named model's last save."""
    last = _saved(spark, root).groupBy("name").agg(F.max_by(F.struct("kind", "path", "features", "r2_val"), "saved_at").alias("m"))
    rows = [(r["name"], r["m"]) for r in (last if name is None else last.where(F.col("name") == name)).collect()]
    if not rows:
        raise FileNotFoundError(f"no model {name or ''} at {root}")
    chosen, m = max(sorted(rows), key=lambda row: _score(row[1]["r2_val"]))
    return chosen, _LOADERS[m["kind"]].load(m["path"]), list(m["features"])


@dataclass(frozen=True)
class Bundle:
    """What one training run left for serving: a model and all that its features were made with."""

    run_id: str | None
    name: str
    model: Model
    features: list[str]
    fit: Preprocessing
    rule: SplitRule | None
    metrics_val: dict[str, float]
    metrics_test: dict[str, float]


def load_bundle(spark: SparkSession, root: str, name: str | None = None, run_id: str | None = None) -> Bundle:
    """The bundle of best validation R2 of all runs, or of the run and name given; of equal ones the earliest saved.

    Model, fit, features and split come from one row, so what a run scores does not depend on later runs.
    """
    rows = _saved(spark, root).where("fit IS NOT NULL")
    for column, wanted in (("name", name), ("run_id", run_id)):
        rows = rows if wanted is None else rows.where(F.col(column) == wanted)
    usable = F.coalesce(F.nanvl("r2_val", F.lit(None)), F.lit(-math.inf))
    r = rows.orderBy(usable.desc(), "saved_at", "path").first()
    if r is None:
        raise FileNotFoundError(f"no bundle {run_id or ''} {name or ''} at {root}")
    fit = Preprocessing(tuple(FeatureFit(*f) for f in r["fit"]))
    rule = None if r["split_rule"] is None else SplitRule.from_json(r["split_rule"])
    return Bundle(r["run_id"], r["name"], _LOADERS[r["kind"]].load(r["path"]), list(r["features"]), fit, rule,
                  r["metrics_val"] or {}, r["metrics_test"] or {})


def model_health(spark: SparkSession, model_root: str, fit_path: str | None = None) -> DataFrame:
    """One row: healthy only if the best model and its fit state can both be loaded, the fit from ``fit_path`` if given."""
    def loads(load: Callable[[], object]) -> bool:
        try:
            load()
        except (FileNotFoundError, AnalysisException, Py4JJavaError):
            return False
        return True

    model = loads(lambda: load_model(spark, model_root))
    fit = loads(lambda: load_bundle(spark, model_root) if fit_path is None else load_fit_state(spark, fit_path))
    return spark.range(1).select(
        F.lit("healthy" if model and fit else "unhealthy").alias("status"),
        F.lit(model).alias("model_loaded"), F.lit(fit).alias("fit_loaded"))


def append_run(
    spark: SparkSession, path: str, run_name: str, model: str, params: dict | None = None,
    metrics: dict | None = None, tags: dict | None = None,
) -> None:
    row = (run_name, model, None, {k: str(v) for k, v in (params or {}).items()}, _numbers(metrics),
           {k: str(v) for k, v in (tags or {}).items()})
    spark.createDataFrame([row], RUN_SCHEMA).withColumn("started_at", F.current_timestamp()).coalesce(1).write.mode(
        "append").parquet(path)


def training_run(trained: Trained) -> dict:
    """Metrics, params and tags of a training run, by their recorded names."""
    metrics = {f"{s}_{m}": v for s, ms in trained.metrics.items() for m, v in ms.items()}
    metrics |= {"cv_rmse_mean": trained.cv_mean, "cv_rmse_std": trained.cv_std, "overfitting_gap": trained.r2_gap,
                "training_time_seconds": trained.training_seconds}
    return {"model": trained.name, "params": trained.params, "metrics": metrics,
            "tags": {"model_family": "regression", "overfit": str(trained.overfit)}}


def dataset_info(df: DataFrame, features: list[str], target: str = "price", split: str = "split") -> dict[str, float]:
    """Rows per split, the number of features, and target mean and std per split."""
    rows = df.groupBy(split).agg(
        F.count(F.lit(1)).alias("n"), F.avg(target).alias("mean"), F.stddev_samp(target).alias("std")).collect()
    out: dict[str, float] = {"n_features": float(len(features))}
    for r in rows:
        out |= {f"{r[split]}_samples": r["n"], f"price_mean_{r[split]}": r["mean"], f"price_std_{r[split]}": r["std"]}
    return out

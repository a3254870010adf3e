"""The flows a user runs: prepare a table, train and choose a model, score requests."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline import schema as S
from hearthline.operators.metrics import (
    GENERAL_GAP, WATCH_GAP, comparison, criteria_table, performance_gate, quality_verdict, rank_models,
)
from hearthline.operators.models import Trained, best_of, build_models_from_config, evaluate, train_all, training_input
from hearthline.operators.preprocess import Preprocessing, fit_preprocessing, preprocess_transform
from hearthline.operators.quality import clean
from hearthline.operators.scoring import Scorer
from hearthline.operators.split import SplitRule, fit_split
from hearthline.session import tune
from hearthline.sources.files import scan_raw, scan_splits, sink_splits, sink_table
from hearthline.sources.state import (
    append_run, dataset_info, load_bundle, save_fit_state, save_model, training_run,
)


@dataclass(frozen=True)
class Prepared:
    """Scaled features with key, target and split, and what they were made with."""

    ready: DataFrame
    fit: Preprocessing
    rule: SplitRule


def prepared(df: DataFrame, key: str = "id", target: str = S.TARGET, fit_on: str = "all", **split) -> Prepared:
    """``fit_on="all"`` fits the preprocessing before the split; ``"train"`` fits it on
    the training rows only, so that nothing of the other splits leaks in.
    """
    rule = fit_split(df, key, target, **split)
    marked = rule.apply(df)
    fit = fit_preprocessing(marked, where=None if fit_on == "all" else F.col("split") == "train")
    return Prepared(preprocess_transform(marked, fit, keep=(key, target, "split")), fit, rule)


def prepare(df: DataFrame, key: str = "id", target: str = S.TARGET, fit_on: str = "all", **split) -> tuple[DataFrame, Preprocessing]:
    """The scaled features and the fit of ``prepared``."""
    found = prepared(df, key, target, fit_on, **split)
    return found.ready, found.fit


@dataclass
class Selection:
    """The trained models, the chosen one, and its test metrics."""

    results: dict[str, Trained]
    best: Trained
    test: dict[str, float]

    @property
    def test_gap(self) -> float:
        return self.best.metrics["val"]["r2"] - self.test["r2"]

    @property
    def generalisation(self) -> str:
        gap = abs(self.test_gap)
        return "excellent" if gap < GENERAL_GAP else "good" if gap < WATCH_GAP else "watch"

    def verdict(self, spark: SparkSession) -> str:
        """good, acceptable or improve, by the chosen model's validation and test R2."""
        row = (self.best.name, self.best.metrics["val"]["r2"], self.test["r2"])
        return quality_verdict(spark.createDataFrame([row], "model string, r2_val double, r2_test double")).first()["verdict"]

    def gates(self, spark: SparkSession) -> dict[str, list[str]]:
        """The criteria that each model misses: r2, rmse, time."""
        rows = [(r.name, r.metrics["val"]["r2"], r.metrics["val"]["rmse"], r.training_seconds) for r in self.results.values()]
        table = spark.createDataFrame(rows, "model string, r2_val double, rmse_val double, training_seconds double")
        return {r["model"]: list(r["warnings"]) for r in performance_gate(table, criteria_table(spark)).collect()}

    def comparison(self, spark: SparkSession) -> DataFrame:
        rows = [(r.name, s, *[float(m[k]) for k in ("rmse", "mae", "r2", "mape")])
                for r in self.results.values() for s, m in r.metrics.items()]
        metrics = spark.createDataFrame(
            rows, "model string, split string, rmse double, mae double, r2 double, mape double")
        cv = spark.createDataFrame([(r.name, r.cv_mean, r.cv_std) for r in self.results.values()],
                                   "model string, cv_rmse_mean double, cv_rmse_std double")
        return rank_models(comparison(metrics, cv))


def train_and_select(
    ready: DataFrame, config: dict | None = None, features: list[str] = S.FEATURES, target: str = S.TARGET,
    key: str = "id", k: int = 5, partitions: int | None = None,
) -> Selection:
    estimators = build_models_from_config(target=target) if config is None else build_models_from_config(config, target)
    kept = training_input(ready, key, target, features, partitions)
    try:
        results = train_all(kept, estimators, features, target, key, k)
        best = best_of(results)
        if best is None:
            raise ValueError("no model was trained")
        test = evaluate(kept.where(F.col("split") == "test"), best.model, features, target)["test"]
    finally:
        kept.unpersist()
    return Selection(results, best, test)


def run_training(
    spark: SparkSession, raw_path: str, out: str, key: str = "id", config: dict | None = None, run_id: str | None = None,
) -> Selection:
    """Raw CSV to a saved bundle: clean, prepare, write the splits, train, compare, judge, record, save.

    The bundle is written last. ``out`` otherwise holds the tables of the last run; what an earlier run's
    bundle scores does not depend on them.
    """
    tune(spark)
    run_id = run_id or uuid.uuid4().hex
    sink_table(clean(scan_raw(spark, raw_path)), f"{out}/clean.parquet")
    found = prepared(spark.read.parquet(f"{out}/clean.parquet"), key)
    sink_splits(found.ready, f"{out}/splits")
    save_fit_state(spark, found.fit, f"{out}/fit")
    chosen = train_and_select(scan_splits(spark, f"{out}/splits"), config, key=key)
    sink_table(chosen.comparison(spark).coalesce(1), f"{out}/comparison.csv")
    facts, gates = dataset_info(scan_splits(spark, f"{out}/splits"), S.FEATURES), chosen.gates(spark)
    for r in chosen.results.values():
        run = training_run(r)
        run["metrics"] |= facts
        run["tags"] |= {"run_id": run_id, "performance_ok": str(not gates[r.name]), "warnings": ",".join(gates[r.name])}
        run["tags"] |= {"accepted": str(r.linear_ok)} if r.name == "linear_regression" else {}
        append_run(spark, f"{out}/runs", f"train_{r.name}", **run)
    for name, reason in chosen.results.failed.items():
        append_run(spark, f"{out}/runs", f"train_{name}", name, tags={"failed": reason, "run_id": run_id})
    append_run(spark, f"{out}/runs", f"test_{chosen.best.name}", chosen.best.name,
               metrics={f"test_{m}": v for m, v in chosen.test.items()},
               tags={"final_evaluation": "true", "verdict": chosen.verdict(spark), "run_id": run_id})
    save_model(spark, chosen.best, out, chosen.test, fit=found.fit, rule=found.rule, run_id=run_id)
    return chosen


def load_scorer(spark: SparkSession, out: str, name: str | None = None, run_id: str | None = None) -> Scorer:
    """The best bundle of all runs, or of the run given; its own fit comes with it."""
    found = load_bundle(spark, out, name, run_id)
    return Scorer(found.name, found.model, found.fit)

"""Fitted preprocessing: median imputation and standard scaling of the model features."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from hearthline import schema as S
from hearthline.functions.sqltext import literal_sql, name_sql, present_sql
from hearthline.operators.quality import (
    fill_constant, finite_sql, floating_columns, numeric_columns, replace_inf, rewritten, select_features,
)
from hearthline.operators.ranks import exact_medians, exact_quantiles

FIT_SCHEMA = "feature string, ordinal int, median double, mean double, std_pop double"


@dataclass(frozen=True)
class FeatureFit:
    feature: str
    median: float
    mean: float
    std_pop: float


@dataclass(frozen=True)
class Preprocessing:
    """What was fitted, one entry per feature in model order."""

    fits: tuple[FeatureFit, ...]

    @property
    def features(self) -> list[str]:
        return [f.feature for f in self.fits]

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(f.feature, i, f.median, f.mean, f.std_pop) for i, f in enumerate(self.fits)]
        return spark.createDataFrame(rows, FIT_SCHEMA)

    @classmethod
    def from_frame(cls, table: DataFrame) -> Preprocessing:
        rows = table.orderBy("ordinal").collect()
        return cls(tuple(FeatureFit(r["feature"], r["median"], r["mean"], r["std_pop"]) for r in rows))


def fit_preprocessing(df: DataFrame, features: list[str] = S.FEATURES, where: Column | None = None) -> Preprocessing:
    """Medians of the features, then mean and population std of the imputed features.

    Mean and variance after imputation follow from those of the present values and
    the number of missing ones, so the scaler needs no scan of its own. ``where``
    restricts the fit, for example to the training split. The features are kept for the few scans of the fit.
    """
    rows = df if where is None else df.where(where)
    rows = fill_constant(select_features(rows, features, target=""))
    columns = numeric_columns(rows)
    types = {f.name: f.dataType for f in rows.schema.fields}
    extra = ["count(1) AS rows"]
    for i, c in enumerate(columns):
        v = present_sql(c, types[c])
        extra += [f"avg({v}) AS mean_{i}", f"var_pop({v}) AS var_{i}"]
    kept = rows.storageLevel.useMemory  # by the caller
    rows = rows if kept else rows.persist()
    try:
        medians, stats = exact_quantiles(rows, columns, [0.5], extra)
    finally:
        if not kept:
            rows.unpersist()
    empty = [c for c in columns if medians[c][0] is None]
    if empty:
        raise ValueError(f"nothing to fit in: {empty}")

    n, fits = stats["rows"], []
    for i, c in enumerate(columns):
        present, mean, var, median = stats[f"n_{i}"], stats[f"mean_{i}"], stats[f"var_{i}"], medians[c][0]
        gap, absent = median - mean, n - present
        spread = var * present + gap * gap * present * absent / n
        fits.append(FeatureFit(c, median, mean + gap * absent / n, math.sqrt(max(spread, 0.0) / n)))
    return Preprocessing(tuple(fits))


def imputed_sql(fit: Preprocessing, types: dict, fills: dict[str, float] | None = None) -> dict[str, str]:
    """The features with the fitted median for missing, or their constant of ``fills``, as SQL by name."""
    fills = fills or {}
    return {
        f.feature: f"coalesce(CAST({present_sql(f.feature, types[f.feature])} AS DOUBLE), "
                   f"{literal_sql(float(fills.get(f.feature, f.median)))})"
        for f in fit.fits if f.feature in types
    }


def scaled_sql(fit: Preprocessing, values: dict[str, str]) -> dict[str, str]:
    """(x - mean) / population std of each value; a constant column is only centred."""
    return {
        f.feature: f"({values[f.feature]} - {literal_sql(f.mean)}) / {literal_sql(f.std_pop or 1.0)}"
        for f in fit.fits if f.feature in values
    }


def _types(df: DataFrame) -> dict:
    return {f.name: f.dataType for f in df.schema.fields}


def impute_median(df: DataFrame, fit: Preprocessing) -> DataFrame:
    return rewritten(df, imputed_sql(fit, _types(df)))


def standardize(df: DataFrame, fit: Preprocessing) -> DataFrame:
    return rewritten(df, scaled_sql(fit, {c: name_sql(c) for c in df.columns}))


def add_missing_features(df: DataFrame, fit: Preprocessing) -> DataFrame:
    """Absent feature columns: a fixed default where there is one, else the fitted median."""
    added = {f.feature: float(S.ABSENT_DEFAULTS.get(f.feature, f.median))
             for f in fit.fits if f.feature not in df.columns}
    return df.selectExpr("*", *[f"{literal_sql(v)} AS {name_sql(c)}" for c, v in added.items()]) if added else df


def preprocess(df: DataFrame, fit: Preprocessing) -> DataFrame:
    """Fill, impute and scale the features with stored values; other columns pass through."""
    return rewritten(df, scaled_sql(fit, imputed_sql(fit, _types(df), S.NULL_DEFAULTS)))


def preprocess_fit_transform(
    df: DataFrame, features: list[str] = S.FEATURES, target: str = S.TARGET,
    keep: tuple[str, ...] = (), fit_where: Column | None = None,
) -> tuple[DataFrame, Preprocessing]:
    """Select, fit and apply. ``keep`` carries key columns along; the target stays as it is."""
    fit = fit_preprocessing(df, features, fit_where)
    columns = [*keep, *fit.features] + ([target] if target in df.columns else [])
    return preprocess(df.select(*map(name_sql, columns)), fit), fit


def preprocess_transform(df: DataFrame, fit: Preprocessing | None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Exactly the fitted features, from stored values, whatever columns the input has."""
    if fit is None or not fit.fits:
        raise ValueError("preprocessing has not been fitted")
    full = add_missing_features(df, fit)
    return preprocess(full.select(*map(name_sql, [*keep, *fit.features])), fit)


def fit_engineered_medians(df: DataFrame) -> dict[str, float]:
    """Medians of the numeric columns that have missing or infinite values."""
    rows = replace_inf(df)
    columns = numeric_columns(rows)
    counts = [f"count({name_sql(c)}) AS n{i}" for i, c in enumerate(columns)]
    row = rows.selectExpr("count(1) AS n", *counts).first()
    return exact_medians(rows, [c for i, c in enumerate(columns) if 0 < row[f"n{i}"] < row["n"]])


def impute_engineered(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    """Missing and infinite values replaced by the fitted medians; others of them become null."""
    floats = set(floating_columns(df))
    made = {c: finite_sql(c) for c in floats}
    for c, m in medians.items():
        if c in df.columns:
            made[c] = f"coalesce(CAST({made.get(c, name_sql(c))} AS DOUBLE), {literal_sql(m)})"
    return rewritten(df, made)

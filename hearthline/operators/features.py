"""Derived house features. Each one is made only where its inputs exist."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline import schema as S
from hearthline.functions.columns import (
    age_category, area_category, bin_code, flag, quoted, ratio_or_whole, scaled_to_ten, text_or_missing, zip_zone,
)
from hearthline.operators.codes import LabelCodes, fit_label_codes, lookup_label_codes
from hearthline.operators.preprocess import fit_engineered_medians, impute_engineered
from hearthline.operators.quality import drop_columns, nan_to_null, value_counts_topk

c = F.col


@dataclass(frozen=True)
class Feature:
    """A derived column: its name, the columns it needs, and how it is made."""

    name: str
    needs: tuple[str, ...]
    make: Callable[[], Column]


def years_since_renovation(has_age: bool = True) -> Column:
    """Years since the renovation, or the age where there was none (0 without an age)."""
    otherwise = c("age_propriete") if has_age else F.lit(0)
    return F.when(c("yr_renovated") > 0, S.REFERENCE_YEAR - c("yr_renovated")).otherwise(otherwise)


def quality_score(grade_low: float | None, grade_high: float | None) -> Column:
    """Mean of condition and grade, each on 0..10."""
    return ((c("condition") - 1) / 4 * 10 + scaled_to_ten(c("grade"), grade_low, grade_high)) / 2


# Stages in order: a stage may use the columns of the ones before it.
TIME = [
    [Feature("age_propriete", ("yr_built",), lambda: S.REFERENCE_YEAR - c("yr_built"))],
    [
        Feature("a_ete_renovee", ("yr_renovated",), lambda: flag(c("yr_renovated") > 0)),
        Feature("categorie_age", ("age_propriete",), lambda: age_category("age_propriete")),
    ],
]
AREA = [[
    Feature("prix_par_pied_carre", ("price", "sqft_living"), lambda: F.try_divide(c("price"), c("sqft_living"))),
    Feature("superficie_totale", ("sqft_living", "sqft_basement"), lambda: c("sqft_living") + c("sqft_basement")),
    Feature("ratio_interieur_terrain", ("sqft_living", "sqft_lot"),
            lambda: F.try_divide(c("sqft_living"), c("sqft_lot"))),
    Feature("superficie_par_chambre", ("sqft_living", "bedrooms"),
            lambda: ratio_or_whole(c("sqft_living"), c("bedrooms"))),
    Feature("categorie_superficie", ("sqft_living",), lambda: area_category("sqft_living")),
]]
QUALITY = [[
    Feature("ratio_sdb_par_chambre", ("bathrooms", "bedrooms"), lambda: ratio_or_whole(c("bathrooms"), c("bedrooms"))),
    Feature("score_confort", ("bedrooms", "bathrooms"), lambda: c("bedrooms") + c("bathrooms")),
    Feature("a_sous_sol", ("sqft_basement",), lambda: flag(c("sqft_basement") > 0)),
    Feature("vue_premium", ("waterfront", "view"),
            lambda: flag(F.coalesce(c("waterfront") == 1, F.lit(False)) | F.coalesce(c("view") > 0, F.lit(False)))),
]]
PLACE = [[Feature("zone_zipcode", ("zipcode",), lambda: zip_zone(c("zipcode")))]]
INTERACTION = [[
    Feature("age_x_qualite", ("age_propriete", "condition"), lambda: c("age_propriete") * c("condition")),
    Feature("superficie_x_etages", ("sqft_living", "floors"), lambda: c("sqft_living") * c("floors")),
    Feature("score_luxe", ("vue_premium", "grade", "sqft_living"),
            lambda: c("vue_premium") * 1000 + c("grade") * 100 + c("sqft_living") / 10),
]]


def add_features(df: DataFrame, stages: list[list[Feature]]) -> DataFrame:
    """One projection per stage; features lacking an input are left out."""
    for stage in stages:
        made = {f.name: f.make() for f in stage if set(f.needs) <= set(df.columns)}
        if made:
            df = df.withColumns(made)
    return df


def add_time_features(df: DataFrame) -> DataFrame:
    df = add_features(df, TIME[:1])
    if "yr_renovated" in df.columns:
        df = df.withColumn("annees_depuis_renovation", years_since_renovation("age_propriete" in df.columns))
    return add_features(df, TIME[1:])


def add_area_features(df: DataFrame) -> DataFrame:
    return add_features(df, AREA)


def grade_range(df: DataFrame) -> tuple[float | None, float | None]:
    if "grade" not in df.columns:
        return None, None
    row = nan_to_null(df.select("grade")).agg(F.min("grade").alias("low"), F.max("grade").alias("high")).first()
    return row["low"], row["high"]


def add_quality_features(df: DataFrame, grades: tuple[float | None, float | None]) -> DataFrame:
    df = add_features(df, QUALITY)
    if {"condition", "grade"} <= set(df.columns):
        df = df.withColumn("score_qualite_global", quality_score(*grades))
    return df


def top_cities(df: DataFrame, codes: LabelCodes | None = None, k: int = 10) -> list[str]:
    """The k most frequent cities. Label codes that were counted already serve if no city is missing there."""
    if "city" not in df.columns:
        return []
    if codes is not None and codes.small and codes.table.where(c("value") == S.MISSING_LABEL).isEmpty():
        return [r["value"] for r in codes.table.orderBy(F.desc("n"), "value").limit(k).collect()]
    return [r["city"] for r in value_counts_topk(df, "city", k).collect()]


def add_place_features(df: DataFrame, cities: list[str]) -> DataFrame:
    """One-hot columns of the fitted cities, and the zip zone."""
    if "city" in df.columns and cities:
        df = df.withColumns({S.ONE_HOT_PREFIX + x: flag(c("city") == F.lit(x)) for x in cities})
    return add_features(df, PLACE)


def add_interaction_features(df: DataFrame) -> DataFrame:
    return add_features(df, INTERACTION)


def categories_to_string(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({x: text_or_missing(quoted(x)) for x in columns if x in df.columns})


def quantile_bin(df: DataFrame, edges: list[float], column: str = S.TARGET, output: str = "bin") -> DataFrame:
    return df.withColumn(output, bin_code(column, edges))


@dataclass
class Engineering:
    """What feature engineering takes from the data it is fitted on."""

    grades: tuple[float | None, float | None] = (None, None)
    cities: list[str] = field(default_factory=list)
    codes: dict[str, LabelCodes] = field(default_factory=dict)
    medians: dict[str, float] = field(default_factory=dict)


def _projected(df: DataFrame, fit: Engineering) -> DataFrame:
    df = add_area_features(add_time_features(nan_to_null(df)))
    df = add_place_features(add_quality_features(df, fit.grades), fit.cities)
    return add_interaction_features(df)


def fit_engineering(df: DataFrame) -> Engineering:
    """Grade range, top cities, label codes, then the medians of what is derived from them."""
    rows = nan_to_null(df)
    place = add_features(rows, PLACE)
    codes = {x: fit_label_codes(place, x) for x in S.ENCODED_COLUMNS if x in place.columns}
    fit = Engineering(grade_range(rows), top_cities(rows, codes.get("city")), codes)
    fit.medians = fit_engineered_medians(_projected(df, fit))
    return fit


def engineer_all(df: DataFrame, fit: Engineering, keep: tuple[str, ...] = ()) -> DataFrame:
    """All derived features, encoded, imputed, without the columns they replace.

    ``keep`` names columns to carry on that would otherwise be dropped.
    """
    out = _projected(df, fit)
    for x, codes in fit.codes.items():
        if x in out.columns:
            out = lookup_label_codes(out, x, codes, f"{x}_encoded")
    out = impute_engineered(out, {x: m for x, m in fit.medians.items() if x in out.columns})
    out = drop_columns(out, [x for x in S.DROPPED_COLUMNS if x not in keep])
    return categories_to_string(out, ["categorie_age", "categorie_superficie"])

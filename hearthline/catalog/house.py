"""Preprocessing, derived features, label codes, splits and folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearthline import schema as S
from hearthline.catalog.base import (
    FIT_CTES, FIT_ROWS, SPLIT_CTES, over_houses, over_listings, query, rounded, split_houses,
)
from hearthline.functions.columns import scaled_to_ten
from hearthline.operators import codes, features, preprocess, quality, split
from hearthline.sources.tables import houses, listings

_SIX = {f: 6 for f in S.FEATURES}
_ROUNDED = ", ".join(f"round({f}, 6) AS {f}" for f in S.FEATURES)


# -- preprocessing -----------------------------------------------------------------

@query("fit_median", over_houses(
    " UNION ALL ".join(f"SELECT '{f}' AS feature, med.{f} AS median FROM med" for f in S.FEATURES), *FIT_CTES[:2]))
def fit_median(spark, folder):
    return preprocess.fit_preprocessing(houses(spark, folder)).to_frame(spark).select("feature", "median")


@query("impute_median", over_houses(f"SELECT id, {', '.join(S.FEATURES)} FROM hi", *FIT_CTES[:3]))
def impute_median(spark, folder):
    rows = houses(spark, folder)
    fit = preprocess.fit_preprocessing(rows)
    return preprocess.impute_median(quality.fill_constant(rows), fit).select("id", *S.FEATURES)


@query("fit_standard_scaler", over_houses(FIT_ROWS, *FIT_CTES))
def fit_standard_scaler(spark, folder):
    fit = preprocess.fit_preprocessing(houses(spark, folder))
    return rounded(fit.to_frame(spark), {"median": 6, "mean": 6, "std_pop": 6})


@query("standardize", over_houses(f"SELECT id, {_ROUNDED} FROM hz", *FIT_CTES))
def standardize(spark, folder):
    rows = quality.fill_constant(houses(spark, folder))
    fit = preprocess.fit_preprocessing(rows)
    return rounded(preprocess.standardize(preprocess.impute_median(rows, fit), fit).select("id", *S.FEATURES), _SIX)


@query("preprocess_fit_transform", over_houses(f"SELECT {_ROUNDED}, price FROM hz", *FIT_CTES))
def preprocess_fit_transform(spark, folder):
    return rounded(preprocess.preprocess_fit_transform(houses(spark, folder))[0], _SIX)


_ABSENT = {"view": 0, "waterfront": 0}


@query("preprocess_transform", over_houses("SELECT hz.id, " + ", ".join(
    f"round((CAST({_ABSENT[f]} AS DOUBLE) - st.m_{f}) / st.s_{f}, 6) AS {f}" if f in _ABSENT else f"round(hz.{f}, 6) AS {f}"
    for f in S.FEATURES) + " FROM hz, st", *FIT_CTES))
def preprocess_transform(spark, folder):
    """Stored values applied to a table that lacks two of the features."""
    rows = houses(spark, folder)
    fit = preprocess.fit_preprocessing(rows)
    return rounded(preprocess.preprocess_transform(rows.drop(*_ABSENT), fit, keep=("id",)), _SIX)


@query("minmax_scale", over_houses("""SELECT id, round((grade - (SELECT min(grade) FROM h)) /
  (SELECT max(grade) - min(grade) FROM h) * 10, 6) AS grade_10, (condition - 1) / 4 * 10 AS condition_10 FROM h"""))
def minmax_scale(spark, folder):
    rows = houses(spark, folder)
    low, high = features.grade_range(rows)
    return rows.select("id", F.round(scaled_to_ten(F.col("grade"), low, high), 6).alias("grade_10"),
                       ((F.col("condition") - 1) / 4 * 10).alias("condition_10"))


@query("impute_engineered", over_houses("""SELECT id, round(coalesce(ratio, median(ratio) OVER ()), 6) AS ratio,
  round(coalesce(total, median(total) OVER ()), 6) AS total, round(coalesce(price_ft, median(price_ft) OVER ()), 6) AS price_ft
  FROM (SELECT id, sqft_living / nullif(sqft_lot, 0) AS ratio, sqft_living + sqft_basement AS total,
  price / sqft_living AS price_ft FROM h)"""))
def impute_engineered(spark, folder):
    rows = houses(spark, folder).select(
        "id", F.try_divide("sqft_living", "sqft_lot").alias("ratio"),
        (F.col("sqft_living") + F.col("sqft_basement")).alias("total"),
        F.try_divide("price", "sqft_living").alias("price_ft"))
    out = preprocess.impute_engineered(rows, preprocess.fit_engineered_medians(rows))
    return rounded(out, {"ratio": 6, "total": 6, "price_ft": 6})


# -- derived features ---------------------------------------------------------------

def _cut_sql(value: str, edges: list, labels: list[str]) -> str:
    whens = " ".join(f"WHEN {value} <= {e if e != float('inf') else chr(39) + 'inf' + chr(39) + '::DOUBLE'} THEN '{x}'"
                     for e, x in zip(edges[1:], labels))
    return f"CASE WHEN {value} IS NULL OR {value} < {edges[0]} THEN 'nan' {whens} ELSE 'nan' END"


_AGE = "(2024 - yr_built)"
_PREMIUM = "CASE WHEN waterfront = 1 OR view > 0 THEN 1 ELSE 0 END"
_GRADE = "((condition - 1) / 4 * 10 + (grade - glow) / (ghigh - glow) * 10) / 2"
FEATURE_SQL = {
    "age_propriete": _AGE,
    "annees_depuis_renovation": f"CASE WHEN yr_renovated > 0 THEN 2024 - yr_renovated ELSE {_AGE} END",
    "a_ete_renovee": "CASE WHEN yr_renovated > 0 THEN 1 ELSE 0 END",
    "categorie_age": _cut_sql(_AGE, S.AGE_EDGES, S.AGE_LABELS),
    "prix_par_pied_carre": "price / nullif(sqft_living, 0)",
    "superficie_totale": "sqft_living + sqft_basement",
    "ratio_interieur_terrain": "sqft_living / nullif(sqft_lot, 0)",
    "superficie_par_chambre": "CASE WHEN bedrooms > 0 THEN sqft_living / bedrooms ELSE sqft_living END",
    "categorie_superficie": _cut_sql("sqft_living", S.AREA_EDGES, S.AREA_LABELS),
    "ratio_sdb_par_chambre": "CASE WHEN bedrooms > 0 THEN bathrooms / bedrooms ELSE bathrooms END",
    "score_confort": "bedrooms + bathrooms",
    "a_sous_sol": "CASE WHEN sqft_basement > 0 THEN 1 ELSE 0 END",
    "score_qualite_global": f"round({_GRADE}, 6)",
    "vue_premium": _PREMIUM,
    "zone_zipcode": "CAST(CAST(floor(zipcode / 1000) AS BIGINT) AS VARCHAR)",
    "age_x_qualite": f"{_AGE} * condition",
    "superficie_x_etages": "sqft_living * floors",
    "score_luxe": f"({_PREMIUM}) * 1000 + grade * 100 + sqft_living / 10",
}
_GRADES = "g AS (SELECT min(grade) AS glow, max(grade) AS ghigh FROM h)"


def _engineered(rows):
    rows = features.add_area_features(features.add_time_features(rows))
    rows = features.add_quality_features(rows, features.grade_range(rows) if "grade" in rows.columns else (None, None))
    return features.add_interaction_features(features.add_place_features(rows, []))


def _register_feature(name: str, sql: str) -> None:
    @query(name, over_houses(f"SELECT id, {sql} AS {name} FROM h, g", _GRADES))
    def feature(spark, folder):
        rows = houses(spark, folder)
        if name != "score_qualite_global":
            # only this one needs the grade range of the table
            rows = features.add_area_features(features.add_time_features(rows))
            rows = features.add_features(rows, features.QUALITY)
            rows = features.add_interaction_features(features.add_place_features(rows, []))
            return rows.select("id", name)
        return _engineered(rows).select("id", F.round(name, 6).alias(name))


for _name, _sql in FEATURE_SQL.items():
    _register_feature(_name, _sql)


_TOP = ("top AS (SELECT city, row_number() OVER (ORDER BY count(*) DESC, city) AS place FROM l GROUP BY city "
        "ORDER BY place LIMIT 10)")


@query("ville_one_hot", over_listings("""SELECT id, CASE WHEN place IS NULL THEN '0000000000'
  ELSE rpad(lpad('1', CAST(place AS INTEGER), '0'), 10, '0') END AS flags FROM l LEFT JOIN top ON l.city = top.city""", _TOP))
def ville_one_hot(spark, folder):
    """The ten one-hot flags of a house, most frequent city first, as one text."""
    rows = listings(spark, folder)
    cities = [r["city"] for r in quality.value_counts_topk(rows, "city").collect()]
    hot = features.add_place_features(rows.select("id", "city"), cities)
    return hot.select("id", F.concat(*[F.col(f"`ville_{x}`").cast("string") for x in cities]).alias("flags"))


@query("lookup_label_codes", over_listings("""SELECT id, l.city, code AS city_encoded FROM l JOIN
  (SELECT city, row_number() OVER (ORDER BY city) - 1 AS code FROM (SELECT DISTINCT city FROM l)) k ON l.city = k.city"""))
def lookup_label_codes(spark, folder):
    rows = listings(spark, folder).select("id", "city")
    return codes.lookup_label_codes(rows, "city", codes.fit_label_codes(rows, "city"), "city_encoded")


@query("label_encode", """SELECT coalesce(CAST(c_acctbal AS VARCHAR), 'nan') IS NOT NULL AS known, n_name AS value,
  dense_rank() OVER (ORDER BY n_name) - 1 AS code FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def label_encode(spark, folder):
    customers = spark.read.parquet(f"{folder}/customer.parquet").select("c_nationkey")
    nations = spark.read.parquet(f"{folder}/nation.parquet").select("n_nationkey", "n_name")
    rows = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.lit(True).alias("known"), F.col("n_name").alias("value"))
    return codes.lookup_label_codes(rows, "value", codes.fit_label_codes(rows, "value"), "code")


@query("label_codes_by_range", """SELECT p_name AS value, row_number() OVER (ORDER BY p_name) - 1 AS code, n FROM
  (SELECT p_name, count(*) AS n FROM part GROUP BY p_name)""")
def label_codes_by_range(spark, folder):
    """Codes of many values, ranked in ranges of which none goes to one task whole."""
    part = spark.read.parquet(f"{folder}/part.parquet").select("p_name")
    return codes.fit_label_codes(part, "p_name", broadcast_rows=10, task_rows=2_000).table


@query("lookup_many_codes", """SELECT l_orderkey, l_linenumber, p_name, code FROM lineitem JOIN part ON l_partkey = p_partkey
  JOIN (SELECT p_name AS k, row_number() OVER (ORDER BY p_name) - 1 AS code FROM (SELECT DISTINCT p_name FROM
  lineitem JOIN part ON l_partkey = p_partkey)) ON p_name = k""")
def lookup_many_codes(spark, folder):
    """The lookup beyond the broadcast size: hot values by broadcast, the rest by a spread join."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey")
    part = spark.read.parquet(f"{folder}/part.parquet").select("p_partkey", "p_name")
    rows = lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "l_linenumber", "p_name")
    return codes.lookup_label_codes(rows, "p_name", codes.fit_label_codes(rows, "p_name", 10, 2_000), "code")


@query("category_to_string", over_houses(
    "SELECT id, coalesce(CAST(bedrooms AS VARCHAR), 'nan') AS bedrooms, "
    "CASE WHEN sqft_living IS NULL THEN 'nan' ELSE CAST(CAST(sqft_living AS BIGINT) AS VARCHAR) END AS sqft_living FROM h"))
def category_to_string(spark, folder):
    rows = houses(spark, folder).select("id", "bedrooms", F.col("sqft_living").cast("bigint").alias("sqft_living"))
    return features.categories_to_string(rows, ["bedrooms", "sqft_living"])


@query("quantile_bin", over_houses("SELECT id, tbin AS bin FROM tb", *SPLIT_CTES[:3]))
def quantile_bin(spark, folder):
    rows = houses(spark, folder).select("id", "price")
    return features.quantile_bin(rows, quality.quantile_edges(rows)).select("id", "bin")


_NULLABLE = ["sqft_living", "sqft_basement", "prix_par_pied_carre", "superficie_totale", "ratio_interieur_terrain",
             "superficie_par_chambre", "superficie_x_etages", "score_luxe"]
_KEPT = ["price", *[f for f in S.FEATURES if f not in _NULLABLE], "grade", "yr_renovated"]
_ENGINEERED = (
    "ea AS (SELECT l.*, " + ", ".join(f"{sql} AS {n}" for n, sql in FEATURE_SQL.items())
    + ", CASE WHEN place IS NULL THEN '0000000000' ELSE rpad(lpad('1', CAST(place AS INTEGER), '0'), 10, '0') END AS flags, "
    "dense_rank() OVER (ORDER BY l.city) - 1 AS city_encoded FROM l LEFT JOIN top ON l.city = top.city, "
    "(SELECT min(grade) AS glow, max(grade) AS ghigh FROM l))",
    "eb AS (SELECT *, dense_rank() OVER (ORDER BY zone_zipcode) - 1 AS zone_zipcode_encoded FROM ea)",
)


@query("engineer_all", over_listings(
    "SELECT " + ", ".join(
        [f"{x}" for x in _KEPT]
        + [f"round(coalesce(CAST({x} AS DOUBLE), median(CAST({x} AS DOUBLE)) OVER ()), 6) AS {x}" for x in _NULLABLE]
        + [f"{x}" for x in FEATURE_SQL if x not in _NULLABLE] + ["flags", "city_encoded", "zone_zipcode_encoded"])
    + " FROM eb", _TOP, *_ENGINEERED))
def engineer_all(spark, folder):
    """All derived features of the listings; the one-hot columns are shown as one text."""
    rows = listings(spark, folder)
    fit = features.fit_engineering(rows)
    out = features.engineer_all(rows, fit)
    flags = F.concat(*[F.col(f"`ville_{x}`").cast("string") for x in fit.cities])
    out = out.withColumn("flags", flags).drop(*[f"ville_{x}" for x in fit.cities])
    return rounded(out, {x: 6 for x in [*_NULLABLE, "score_qualite_global"]})


# -- splits and folds ----------------------------------------------------------------

@query("stratified_split", over_houses("SELECT id, price, bin, split FROM sp", *SPLIT_CTES))
def stratified_split(spark, folder):
    return split_houses(spark, folder).select("id", "price", "bin", "split")


@query("split_distribution", over_houses("""SELECT split, count(*) AS n, round(avg(price), 4) AS mean,
  round(stddev_samp(price), 4) AS std, round(stddev_samp(price) / avg(price), 6) AS cv FROM sp GROUP BY split""", *SPLIT_CTES))
def split_distribution(spark, folder):
    return rounded(split.split_distribution(split_houses(spark, folder)), {"mean": 4, "std": 4, "cv": 6})


@query("split_balance", over_houses("""SELECT round(tr, 6) AS cv_train, round(va, 6) AS cv_val, round(te, 6) AS cv_test,
  abs(te - tr) > 0.2 AS unbalanced FROM (SELECT
  stddev_samp(price) FILTER (split = 'train') / avg(price) FILTER (split = 'train') AS tr,
  stddev_samp(price) FILTER (split = 'val') / avg(price) FILTER (split = 'val') AS va,
  stddev_samp(price) FILTER (split = 'test') / avg(price) FILTER (split = 'test') AS te FROM sp)""", *SPLIT_CTES))
def split_balance(spark, folder):
    return rounded(split.split_balance(split_houses(spark, folder)), {"cv_train": 6, "cv_val": 6, "cv_test": 6})


@query("kfold_assign", over_houses("SELECT id, CAST(ntile(5) OVER (ORDER BY id) - 1 AS INTEGER) AS fold FROM h"))
def kfold_assign(spark, folder):
    return split.kfold_assign(houses(spark, folder).select("id"))

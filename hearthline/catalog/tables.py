"""Sources, sinks, column operators, cleaning, profiles and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearthline import schema as S
from hearthline.catalog.base import (
    COMPARE, FIT_CTES, FIT_ROWS, METRIC, PRED, SCORED, SPLIT_CTES, TIER, fixed_scorer, over_audit, over_houses,
    over_listings, predictions, query, rounded, split_houses,
)
from hearthline.functions.columns import display_name
from hearthline.operators import audit, features, metrics, preprocess, quality, scoring
from hearthline.session import scratch_path
from hearthline.sources import files, state
from hearthline.sources.tables import audit_log, houses, listings

# -- sources and sinks -----------------------------------------------------------

_TEXTS = """SELECT id, price, sqft_living, CASE WHEN sqft_living > 3000 THEN 'Très_grand, "vu"' ELSE 'Été' END AS label,
  waterfront = 1 AS waterfront FROM h"""


@query("scan_csv_encoded", over_houses(_TEXTS))
def scan_csv_encoded(spark, folder):
    """Houses written as a Latin-1 CSV, read without being told the encoding or the types."""
    path = scratch_path(spark, "latin")
    houses(spark, folder).selectExpr(
        "id", "price", "sqft_living",
        "CASE WHEN sqft_living > 3000 THEN 'Très_grand, \"vu\"' ELSE 'Été' END AS label",
        "waterfront = 1 AS waterfront",
    ).write.option("header", True).option("encoding", "ISO-8859-1").option("escape", '"').csv(path)
    return files.scan_raw(spark, path)


@query("scan_csv_processed", over_houses(
    "SELECT id, price, bathrooms, sqft_living, sqft_basement, yr_built FROM h"))
def scan_csv_processed(spark, folder):
    path = scratch_path(spark, "processed") + ".csv"
    files.sink_table(houses(spark, folder).select(
        "id", "price", "bathrooms", "sqft_living", "sqft_basement", "yr_built"), path)
    return files.scan_table(spark, path)


@query("sink_csv", over_listings("SELECT id, city, price, zipcode FROM l"))
def sink_csv(spark, folder):
    path = scratch_path(spark, "sink") + ".csv"
    rows = listings(spark, folder).select("id", "city", "price", "zipcode")
    files.sink_table(rows, path)
    return files.scan_table(spark, path, rows.schema)


@query("sink_splits", over_houses("SELECT split, count(*) AS n, sum(id)::BIGINT AS ids FROM sp GROUP BY split", *SPLIT_CTES))
def sink_splits(spark, folder):
    path = scratch_path(spark, "splits")
    files.sink_splits(split_houses(spark, folder).select("id", "price", "split"), path)
    return files.scan_splits(spark, path).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids"))


@query("scan_splits", over_houses("SELECT id, price, split FROM sp WHERE split = 'train'", *SPLIT_CTES))
def scan_splits(spark, folder):
    path = scratch_path(spark, "splits")
    files.sink_splits(split_houses(spark, folder).select("id", "price", "split"), path)
    return files.scan_splits(spark, path, "train")


@query("scan_audit_log", over_audit("""SELECT line, json_valid(line) AS is_json,
  CASE WHEN json_valid(line) THEN json_extract_string(line, '$.event_type') END AS event_type,
  CASE WHEN json_valid(line) THEN json_extract_string(line, '$.status') END AS status,
  CASE WHEN json_valid(line) THEN CAST(json_extract_string(line, '$.performance.duration_ms') AS DOUBLE) END AS duration_ms
  FROM a"""))
def scan_audit_log(spark, folder):
    """The audit lines written as a text log, read back and parsed; plain lines stay unparsed."""
    path = scratch_path(spark, "log")
    audit_log(spark, folder).select("line").write.text(path)
    return audit.parse_audit(files.scan_audit_log(spark, path)).select(
        "line", F.coalesce("is_json", F.lit(False)).alias("is_json"), "record.event_type", "record.status",
        "record.performance.duration_ms")


@query("sink_enriched", over_houses("""SELECT CASE WHEN superficie <= 1000 THEN 'Petit' WHEN superficie <= 2000 THEN 'Moyen'
  WHEN superficie <= 3000 THEN 'Grand' WHEN superficie <= 5000 THEN 'Très_grand' WHEN superficie > 5000 THEN 'Exceptionnel'
  ELSE 'nan' END AS categorie_superficie, count(*) AS n, sum(2024 - yr_built)::BIGINT AS ages
  FROM (SELECT sqft_living AS superficie, yr_built FROM h) GROUP BY 1"""))
def sink_enriched(spark, folder):
    path = scratch_path(spark, "enriched") + ".parquet"
    rows = houses(spark, folder)
    files.sink_table(features.engineer_all(rows, features.fit_engineering(rows)), path)
    return files.scan_table(spark, path).groupBy("categorie_superficie").agg(
        F.count(F.lit(1)).alias("n"), F.sum("age_propriete").alias("ages"))


@query("sink_comparison", over_houses("""SELECT model, round(r2_train, 6) AS r2_train, round(r2_val, 6) AS r2_val,
  round(rmse_val, 4) AS rmse_val FROM c""", PRED, METRIC, COMPARE))
def sink_comparison(spark, folder):
    path = scratch_path(spark, "comparison") + ".csv"
    table = metrics.rank_models(metrics.comparison(metrics.regression_metrics(predictions(spark, folder))))
    files.sink_table(table.coalesce(1), path)
    return rounded(files.scan_table(spark, path).select("model", "r2_train", "r2_val", "rmse_val"),
                   {"r2_train": 6, "r2_val": 6, "rmse_val": 4})


@query("save_fit_state", over_houses(FIT_ROWS, *FIT_CTES))
def save_fit_state(spark, folder):
    path = scratch_path(spark, "fit")
    state.save_fit_state(spark, preprocess.fit_preprocessing(houses(spark, folder)), path)
    return rounded(spark.read.parquet(path), {"median": 6, "mean": 6, "std_pop": 6})


@query("load_fit_state", over_houses(FIT_ROWS, *FIT_CTES))
def load_fit_state(spark, folder):
    path = scratch_path(spark, "fit")
    state.save_fit_state(spark, preprocess.fit_preprocessing(houses(spark, folder)), path)
    return rounded(state.load_fit_state(spark, path).to_frame(spark), {"median": 6, "mean": 6, "std_pop": 6})


@query("sink_runs", over_houses("""SELECT 'train_' || model AS run_name, model, split || '_' || metric AS metric,
  round(value, 4) AS value FROM (UNPIVOT (SELECT model, split, rmse, mae, r2, mape FROM m)
  ON rmse, mae, r2, mape INTO NAME metric VALUE value)""", PRED, METRIC))
def sink_runs(spark, folder):
    path = scratch_path(spark, "runs")
    rows = metrics.regression_metrics(predictions(spark, folder)).collect()
    for model in sorted({r["model"] for r in rows}):
        measured = {f"{r['split']}_{m}": r[m] for r in rows if r["model"] == model for m in metrics.METRICS}
        state.append_run(spark, path, f"train_{model}", model, metrics=measured, tags={"model_family": "regression"})
    return spark.read.parquet(path).select("run_name", "model", F.explode("metrics").alias("metric", "value")).withColumn(
        "value", F.round("value", 4))


@query("sink_audit", over_houses("""SELECT event_type, status, confidence, count(*) AS n, round(avg(prediction), 2) AS prediction
  FROM (SELECT 'prediction' AS event_type, CASE WHEN reasons = '' THEN 'success' ELSE 'error' END AS status,
  CASE WHEN reasons = '' THEN """ + TIER + """ ELSE 'Erreur' END AS confidence,
  CASE WHEN reasons = '' THEN prediction ELSE 0 END AS prediction FROM sc) GROUP BY 1, 2, 3""", *FIT_CTES, SCORED))
def sink_audit(spark, folder):
    path = scratch_path(spark, "audit")
    rows = houses(spark, folder)
    scorer = fixed_scorer(preprocess.fit_preprocessing(rows))
    files.sink_audit(scoring.audit_rows(rows, scorer, F.md5(F.col("id").cast("string")), F.col("date")), path)
    parsed = audit.parse_audit(files.scan_audit_log(spark, path)).select("record.*")
    return parsed.groupBy("event_type", "status", F.col("output.confidence").alias("confidence")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("output.prediction"), 2).alias("prediction"))


# -- column operators ------------------------------------------------------------

_RAW = {"id": " Id ", "sqft_living": " Sqft Living", "yr_built": "YR Built ", "price": "Price"}


@query("normalize_column_names", over_houses("SELECT id, sqft_living, yr_built, price FROM h"))
def normalize_column_names(spark, folder):
    raw = houses(spark, folder).select(*[F.col(c).alias(n) for c, n in _RAW.items()])
    return quality.normalize_column_names(raw)


@query("select_features", over_houses(f"SELECT {', '.join(S.FEATURES)}, price FROM h"))
def select_features(spark, folder):
    return quality.select_features(houses(spark, folder))


@query("add_missing_features", over_houses(f"""SELECT h.id, {', '.join(
    f'CAST(h.{f} AS DOUBLE) AS {f}' if f not in ('view', 'condition', 'sqft_basement', 'waterfront', 'floors', 'sqft_lot')
    else f'med.{f} AS {f}' if f in ('floors', 'sqft_lot') else f"CAST({S.ABSENT_DEFAULTS[f]} AS DOUBLE) AS {f}"
    for f in S.FEATURES)} FROM h, med""", *FIT_CTES[:2]))
def add_missing_features(spark, folder):
    rows = houses(spark, folder)
    fit = preprocess.fit_preprocessing(rows)
    absent = rows.drop("view", "condition", "sqft_basement", "waterfront", "floors", "sqft_lot")
    return preprocess.add_missing_features(absent, fit).select(
        "id", *[F.col(f).cast("double").alias(f) for f in S.FEATURES])


@query("drop_columns", over_listings("SELECT price, grade, yr_renovated, bedrooms FROM l"))
def drop_columns(spark, folder):
    return quality.drop_columns(listings(spark, folder).select(
        "id", "date", "city", "zipcode", "price", "grade", "yr_renovated", "bedrooms"))


_TYPED = {
    "numeric": ["id", "price", *S.FEATURES, "grade", "yr_renovated", "zipcode"],
    "text": ["city", "ville_label"],
    "text_to_encode": ["city"],
}


@query("select_by_dtype", over_listings(" UNION ALL ".join(
    f"SELECT '{kind}' AS kind, '{c}' AS column_name, count({c if c != 'ville_label' else 'city'}) AS n_present FROM l"
    for kind, columns in _TYPED.items() for c in sorted(set(columns)) if not (kind == "numeric" and c == "price"))))
def select_by_dtype(spark, folder):
    """The column sets by type, with how many values each column has."""
    rows = listings(spark, folder).withColumn("ville_label", F.col("city"))
    sets = {"numeric": quality.numeric_columns(rows, exclude=(S.TARGET,)), "text": quality.text_columns(rows),
            "text_to_encode": quality.text_columns(rows, S.ONE_HOT_PREFIX)}
    pairs = [(k, c) for k, columns in sets.items() for c in columns]
    present = quality.profile_table(rows).select("column_name", (F.col("n_rows") - F.col("n_missing")).alias("n_present"))
    return spark.createDataFrame(pairs, "kind string, column_name string").join(F.broadcast(present), "column_name")


@query("cast_columns", over_houses("""SELECT id, CASE WHEN sqft_basement > 0 THEN 1 ELSE 0 END AS has_basement,
  CAST(zipcode AS VARCHAR) AS zipcode, CAST(floor(floors) AS BIGINT) AS floors FROM h"""))
def cast_columns(spark, folder):
    rows = houses(spark, folder).select("id", (F.col("sqft_basement") > 0).alias("has_basement"), "zipcode", "floors")
    return quality.cast_columns(rows, {"has_basement": "int", "zipcode": "string", "floors": "bigint"})


_HAVE = ["id", "price", "bedrooms", "bathrooms", "sqft_living", "grade", "city"]


def _set_difference() -> str:
    missing = [f for f in S.FEATURES if f not in _HAVE]
    extra = [c for c in _HAVE if c not in S.FEATURES and c != "price"]
    return " UNION ALL ".join(
        [f"SELECT '{c}' AS column_name, 'missing' AS problem, CAST(0 AS BIGINT) AS n_present" for c in missing]
        + [f"SELECT '{c}', 'unexpected', count({c}) FROM l" for c in extra])


@query("schema_check", over_listings(_set_difference()))
def schema_check(spark, folder):
    """Missing and unexpected columns, with how many values an unexpected one brings."""
    rows = listings(spark, folder).select(*_HAVE)
    problems = quality.schema_check(spark, [c for c in rows.columns if c != S.TARGET], S.FEATURES)
    present = quality.profile_table(rows).select("column_name", (F.col("n_rows") - F.col("n_missing")).alias("n_present"))
    return problems.join(F.broadcast(present), "column_name", "left").fillna(0, ["n_present"])


@query("feature_set_diff", over_listings(f"""SELECT
  '{','.join(sorted(set(S.FEATURES) - set(_HAVE)))}' AS missing, 'city,grade,id,price' AS unexpected, count(*) AS n_rows FROM l"""))
def feature_set_diff(spark, folder):
    """Both differences of the column sets as arrays, next to the size of the table."""
    rows = listings(spark, folder).select(*_HAVE)
    have, want = (F.array(*[F.lit(c) for c in names]) for names in (rows.columns, S.FEATURES))
    return rows.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.array_join(F.array_sort(F.array_except(want, have)), ",").alias("missing"),
        F.array_join(F.array_sort(F.array_except(have, want)), ",").alias("unexpected"), "n_rows")


_FAMILY_SQL = " UNION ALL ".join(
    f"SELECT '{family}' AS family, '{c}' AS column_name, count({c}) AS n_present FROM l"
    for family, parts in S.VARIABLE_FAMILIES.items()
    for c in ["id", "date", "price", *S.FEATURES, "grade", "yr_renovated", "zipcode", "city"]
    if any(p in c for p in parts))


@query("variable_catalog", over_listings(_FAMILY_SQL))
def variable_catalog(spark, folder):
    """Columns per family, with how many values each has."""
    rows = listings(spark, folder)
    present = quality.profile_table(rows).select("column_name", (F.col("n_rows") - F.col("n_missing")).alias("n_present"))
    return quality.variable_catalog(rows).join(F.broadcast(present), "column_name").select(
        "family", "column_name", "n_present")


# -- cleaning --------------------------------------------------------------------

# The houses twice over for every fifth one, some with most columns missing.
_DIRTY = """SELECT id, CASE WHEN id % 4 = 0 THEN NULL ELSE bedrooms END AS bedrooms,
  CASE WHEN id % 4 < 2 THEN NULL ELSE bathrooms END AS bathrooms, CASE WHEN id % 8 = 0 THEN NULL ELSE price END AS price,
  sqft_living, CASE WHEN id % 3 = 0 THEN NULL ELSE yr_built END AS yr_built, sqft_basement"""
_DIRTY_SQL = f"d AS ({_DIRTY} FROM h UNION ALL {_DIRTY} FROM h WHERE id % 5 = 0)"
_PRESENT = " + ".join(f"({c} IS NOT NULL)::INT" for c in
                      ["id", "bedrooms", "bathrooms", "price", "sqft_living", "yr_built", "sqft_basement"])


def dirty(spark, folder):
    rows = houses(spark, folder).selectExpr(*[x.strip() for x in _split_select(_DIRTY)])
    return rows.unionByName(rows.where(F.col("id") % 5 == 0))


def _split_select(sql: str) -> list[str]:
    """The expressions of a SELECT list without nested commas."""
    return sql.replace("SELECT ", "", 1).split(",")


@query("drop_duplicates", over_houses("SELECT DISTINCT * FROM d", _DIRTY_SQL))
def drop_duplicates(spark, folder):
    return quality.drop_duplicates(dirty(spark, folder))


@query("distinct_rows", over_listings("SELECT DISTINCT city, zipcode, grade FROM l"))
def distinct_rows(spark, folder):
    return listings(spark, folder).select("city", "zipcode", "grade").distinct()


@query("drop_sparse_rows", over_houses(f"SELECT * FROM d WHERE {_PRESENT} >= 4", _DIRTY_SQL))
def drop_sparse_rows(spark, folder):
    return quality.drop_sparse_rows(dirty(spark, folder))


@query("clean_table", over_houses(f"SELECT DISTINCT * FROM d WHERE {_PRESENT} >= 4", _DIRTY_SQL))
def clean_table(spark, folder):
    return quality.clean(dirty(spark, folder))


@query("validate_ranges", over_houses("SELECT id, reasons = '' AS valid FROM (SELECT h.id, " +
                                      SCORED.split("AS prediction, ")[1].split(" AS reasons")[0] + " AS reasons FROM h)"))
def validate_ranges(spark, folder):
    valid, refused = quality.validate_ranges(houses(spark, folder))
    return valid.select("id", F.lit(True).alias("valid")).unionByName(refused.select("id", F.lit(False).alias("valid")))


@query("validate_ranges_reasons", over_houses("SELECT * FROM (SELECT h.id, " +
       SCORED.split("AS prediction, ")[1].split(" AS reasons")[0] + " AS reasons FROM h) WHERE reasons <> ''"))
def validate_ranges_reasons(spark, folder):
    refused = quality.validate_ranges(houses(spark, folder))[1]
    return refused.select("id", F.array_join("reasons", "; ").alias("reasons"))


@query("filter_boolean", over_houses("""SELECT id, price, view FROM h
  WHERE (waterfront = 1 OR view > 0) AND yr_renovated > 0 AND sqft_basement > 0"""))
def filter_boolean(spark, folder):
    return houses(spark, folder).where(
        ((F.col("waterfront") == 1) | (F.col("view") > 0)) & (F.col("yr_renovated") > 0) & (F.col("sqft_basement") > 0)
    ).select("id", "price", "view")


@query("replace_inf", over_houses("""SELECT id, CASE WHEN id % 3 = 0 OR id % 3 = 1 THEN NULL ELSE price END AS price,
  sqft_living FROM h"""))
def replace_inf(spark, folder):
    rows = houses(spark, folder).selectExpr(
        "id", "CASE id % 3 WHEN 0 THEN double('Infinity') WHEN 1 THEN double('NaN') ELSE price END AS price", "sqft_living")
    return quality.replace_inf(rows)


@query("fill_constant", over_houses("SELECT id, coalesce(sqft_basement, 0) AS sqft_basement, sqft_living FROM h"))
def fill_constant(spark, folder):
    return quality.fill_constant(houses(spark, folder).select("id", "sqft_basement", "sqft_living"))


# -- profiles --------------------------------------------------------------------

_LINE = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_quantity": "double",
         "l_extendedprice": "double", "l_discount": "double", "l_tax": "double", "l_returnflag": "string",
         "l_linestatus": "string", "l_shipdate": "timestamp_ntz"}
_LISTING = {"id": "bigint", "date": "timestamp_ntz", "price": "double", "bedrooms": "bigint", "bathrooms": "double",
            "sqft_living": "double", "sqft_lot": "bigint", "floors": "double", "waterfront": "bigint", "view": "bigint",
            "condition": "bigint", "grade": "bigint", "sqft_above": "double", "sqft_basement": "double",
            "yr_built": "bigint", "yr_renovated": "bigint", "zipcode": "bigint", "city": "string"}


def _profile_sql(columns: dict[str, str], table: str) -> str:
    return " UNION ALL ".join(
        f"SELECT count(*) AS n_rows, {len(columns)} AS n_columns, {i} AS position, '{c}' AS column_name, '{t}' AS type, "
        f"count(*) - count({c}) AS n_missing FROM {table}" for i, (c, t) in enumerate(columns.items()))


def lineitem(spark, folder):
    return spark.read.parquet(f"{folder}/lineitem.parquet")


@query("profile_table", over_listings(_profile_sql(_LISTING, "l")))
def profile_table(spark, folder):
    return quality.profile_table(listings(spark, folder))


@query("profile_lineitem", _profile_sql(_LINE, "lineitem"))
def profile_lineitem(spark, folder):
    return quality.profile_table(lineitem(spark, folder))


def _describe_sql(columns: list[str], table: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
        f"CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q25, "
        f"round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS q50, "
        f"round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q75, CAST(max({c}) AS DOUBLE) AS max FROM {table}"
        for c in columns)


_DIGITS = {"mean": 6, "std": 6, "q25": 6, "q50": 6, "q75": 6}
_HOUSE_NUMBERS = ["id", "price", *S.FEATURES[:8], "grade", *S.FEATURES[8:], "yr_renovated", "zipcode"]


@query("describe_numeric", over_houses(_describe_sql(_HOUSE_NUMBERS, "h")))
def describe_numeric(spark, folder):
    return rounded(quality.describe_numeric(houses(spark, folder)), _DIGITS)


@query("describe_lineitem", _describe_sql([c for c, t in _LINE.items() if t in ("bigint", "int", "double")], "lineitem"))
def describe_lineitem(spark, folder):
    return rounded(quality.describe_numeric(lineitem(spark, folder)), _DIGITS)


@query("count_duplicates", over_houses("""SELECT count(*) AS n_rows,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM d)) AS n_duplicates FROM d""", _DIRTY_SQL))
def count_duplicates(spark, folder):
    return quality.count_duplicates(dirty(spark, folder))


@query("count_nulls_total", over_houses(f"""SELECT count(*) AS n_rows, CAST(7 * count(*) - sum({_PRESENT}) AS BIGINT)
  AS n_missing FROM d""", _DIRTY_SQL))
def count_nulls_total(spark, folder):
    return quality.count_nulls_total(dirty(spark, folder))


@query("cleaning_report", over_houses(f"""SELECT (SELECT count(*) FROM d) AS n_initial,
  count(*) FILTER ({_PRESENT} >= 4) AS n_final, (SELECT count(*) FROM d) - count(*) AS n_duplicates,
  count(*) FILTER ({_PRESENT} < 4) AS n_sparse, (SELECT count(*) FROM d) - count(*) FILTER ({_PRESENT} >= 4) AS n_removed
  FROM (SELECT DISTINCT * FROM d)""", _DIRTY_SQL))
def cleaning_report(spark, folder):
    return quality.cleaning_report(dirty(spark, folder))


@query("value_counts_topk", over_listings("SELECT city, count(*) AS n FROM l GROUP BY city ORDER BY n DESC, city LIMIT 10"))
def value_counts_topk(spark, folder):
    return quality.value_counts_topk(listings(spark, folder), "city")


@query("topk_categories", """SELECT p_brand, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey
  GROUP BY p_brand ORDER BY n DESC, p_brand LIMIT 10""")
def topk_categories(spark, folder):
    part = spark.read.parquet(f"{folder}/part.parquet").select("p_partkey", "p_brand")
    return quality.value_counts_topk(
        lineitem(spark, folder).select("l_partkey").join(part, F.col("l_partkey") == F.col("p_partkey")), "p_brand")


@query("heavy_hitters", "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey ORDER BY n DESC, l_partkey LIMIT 20")
def heavy_hitters(spark, folder):
    return quality.heavy_hitters(lineitem(spark, folder), "l_partkey", 20)


@query("count_distinct", over_listings("""SELECT count(DISTINCT city) AS city, count(DISTINCT zipcode) AS zipcode,
  count(DISTINCT price) AS price FROM l"""))
def count_distinct(spark, folder):
    return quality.count_distinct(listings(spark, folder), ["city", "zipcode", "price"])


@query("quantile_edges", """SELECT CAST(unnest(range(len(e))) AS INTEGER) AS edge, round(unnest(e), 6) AS value FROM
  (SELECT list_sort(list_distinct(quantile_cont(l_extendedprice, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS e
  FROM lineitem)""")
def quantile_edges(spark, folder):
    edges = quality.quantile_edges(lineitem(spark, folder).select("l_extendedprice"), "l_extendedprice")
    return spark.createDataFrame(list(enumerate(edges)), "edge int, value double").withColumn("value", F.round("value", 6))


# -- scalar functions ---------------------------------------------------------------

@query("math_functions", over_houses("""SELECT id, sqft_living / nullif(sqft_lot, 0) AS ratio, abs(price - 250000) AS off,
  sqrt(price) AS root, CAST(floor(zipcode / 1000) AS BIGINT) AS zone, CAST(floor(-id / 7) AS BIGINT) AS floored FROM h"""))
def math_functions(spark, folder):
    return houses(spark, folder).select(
        "id", F.try_divide("sqft_living", "sqft_lot").alias("ratio"), F.abs(F.col("price") - 250000).alias("off"),
        F.sqrt("price").alias("root"), F.floor(F.col("zipcode") / 1000).alias("zone"),
        F.floor(-F.col("id") / 7).alias("floored"))


@query("round_two", over_houses("SELECT id, round(price / 3, 2) AS third, round(price, 1) AS tenth FROM h"))
def round_two(spark, folder):
    return houses(spark, folder).select(
        "id", F.round(F.col("price") / 3, 2).alias("third"), F.round("price", 1).alias("tenth"))


@query("string_functions", over_listings("""SELECT id, lower(trim(' ' || city || ' ')) AS tidy, replace(city, '_', ' ') AS spaced,
  contains(city, 'NATION_1') AS has_one, starts_with(city, 'NATION_2') AS starts_two, upper(lower(city)) AS loud,
  'ville_' || city AS joined, 'N' || lower(substr(replace(city, '_', ' '), 2)) AS title FROM l"""))
def string_functions(spark, folder):
    c = F.col("city")
    return listings(spark, folder).select(
        "id", F.lower(F.trim(F.concat(F.lit(" "), c, F.lit(" ")))).alias("tidy"),
        F.replace(c, F.lit("_"), F.lit(" ")).alias("spaced"), c.contains("NATION_1").alias("has_one"),
        c.startswith("NATION_2").alias("starts_two"), F.upper(F.lower(c)).alias("loud"),
        F.concat(F.lit("ville_"), c).alias("joined"), display_name(c).alias("title"))


@query("null_functions", over_houses("""SELECT id, sqft_living IS NULL AS is_missing, coalesce(sqft_living, sqft_above) AS filled,
  nullif(sqft_lot, 0) AS lot FROM h WHERE sqft_basement IS NOT NULL"""))
def null_functions(spark, folder):
    return houses(spark, folder).dropna(subset=["sqft_basement"]).select(
        "id", F.col("sqft_living").isNull().alias("is_missing"), F.coalesce("sqft_living", "sqft_above").alias("filled"),
        F.nullif("sqft_lot", F.lit(0)).alias("lot"))


@query("date_functions", "SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS stamp FROM orders")
def date_functions(spark, folder):
    return houses(spark, folder).select("id", F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("stamp"))


@query("json_functions", """SELECT event_id, '{"id":' || event_id || ',"kind":"' || event_type || '"}' AS packed,
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def json_functions(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet")
    return events.select(
        "event_id", F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind"))).alias("packed"),
        F.from_json("props", "k bigint")["k"].alias("k"))


@query("map_size", over_houses("SELECT id, 11 AS feature_count FROM h"))
def map_size(spark, folder):
    return houses(spark, folder).select("id", F.size(scoring.feature_map()).alias("feature_count"))


@query("request_uuid", over_houses("SELECT count(*) AS n_rows, count(*) AS n_ids, TRUE AS all_36 FROM h"))
def request_uuid(spark, folder):
    """Every row gets an id of its own."""
    marked = houses(spark, folder).select("id", F.uuid().alias("request_id"))
    return marked.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("request_id").alias("n_ids"),
                      F.bool_and(F.length("request_id") == 36).alias("all_36"))

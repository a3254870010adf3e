"""The register of checked queries, and the SQL pieces their oracles share."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline import schema as S
from hearthline.operators.models import LinearFormula
from hearthline.operators.preprocess import Preprocessing
from hearthline.operators.scoring import Scorer
from hearthline.operators.split import stratified_split
from hearthline.session import tune
from hearthline.sources.tables import AUDIT_SQL, HOUSES_SQL, LISTINGS_SQL, houses

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = functools.wraps(fn)(lambda spark, folder: fn(tune(spark), folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def over_houses(select: str, *more: str) -> str:
    """SQL over the houses as ``h``."""
    return f"WITH {', '.join([f'h AS ({HOUSES_SQL})', *more])} {select}"


def over_listings(select: str, *more: str) -> str:
    return f"WITH {', '.join([f'l AS ({LISTINGS_SQL})', *more])} {select}"


def over_audit(select: str, *more: str) -> str:
    return f"WITH {', '.join([f'a AS ({AUDIT_SQL})', *more])} {select}"


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.withColumns({c: F.round(c, d) for c, d in digits.items()})


# -- the fit in SQL ------------------------------------------------------------

HF = ("hf AS (SELECT id, price, date, " + ", ".join(
    f"CAST(coalesce({f}, 0) AS DOUBLE) AS {f}" if f in S.NULL_DEFAULTS else f"CAST({f} AS DOUBLE) AS {f}"
    for f in S.FEATURES) + " FROM h)")
MED = "med AS (SELECT " + ", ".join(f"median({f}) AS {f}" for f in S.FEATURES) + " FROM hf)"
HI = "hi AS (SELECT hf.id, hf.price, hf.date, " + ", ".join(
    f"coalesce(hf.{f}, med.{f}) AS {f}" for f in S.FEATURES) + " FROM hf, med)"
STAT = "st AS (SELECT " + ", ".join(
    f"avg({f}) AS m_{f}, stddev_pop({f}) AS s_{f}" for f in S.FEATURES) + " FROM hi)"
HZ = "hz AS (SELECT hi.id, hi.price, hi.date, " + ", ".join(
    f"(hi.{f} - st.m_{f}) / CASE WHEN st.s_{f} = 0 THEN 1 ELSE st.s_{f} END AS {f}" for f in S.FEATURES
) + " FROM hi, st)"
FIT_CTES = (HF, MED, HI, STAT, HZ)
FIT_ROWS = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, {i} AS ordinal, round(med.{f}, 6) AS median, round(st.m_{f}, 6) AS mean, "
    f"round(st.s_{f}, 6) AS std_pop FROM med, st" for i, f in enumerate(S.FEATURES))


# -- the split in SQL ----------------------------------------------------------

def _edges_sql(table: str) -> str:
    probs = ", ".join(str(i / 10) for i in range(11))
    return f"(SELECT list_sort(list_distinct(quantile_cont(price, [{probs}]))) FROM {table})"


def _bin_sql(edges: str) -> str:
    return f"CAST(greatest(len(list_filter({edges}, lambda e: e < price)) - 1, 0) AS INTEGER)"


def _hash_sql(label: str) -> str:
    return f"CAST('0x' || substr(md5('42-{label}-' || CAST(id AS VARCHAR)), 1, 15) AS BIGINT)"


def _stage_sql(source: str, prefix: str, label: str, size: str) -> list[str]:
    """Bins, kept counts by largest remainder, and the rows marked as held out."""
    p = prefix
    return [
        f"{p}e AS (SELECT {_edges_sql(source)} AS edges)",
        f"{p}b AS (SELECT s.*, {_bin_sql('edges')} AS {p}bin FROM {source} s, {p}e)",
        f"{p}n AS (SELECT count(*) AS n, count(*) - CAST(ceil({size}) AS BIGINT) AS rest FROM {source})",
        f"{p}c AS (SELECT {p}bin, count(*) AS c, any_value(n) AS n, any_value(rest) AS rest, "
        f"count(*) * any_value(rest) // any_value(n) AS base, count(*) * any_value(rest) % any_value(n) AS rem "
        f"FROM {p}b, {p}n GROUP BY {p}bin)",
        f"{p}q AS (SELECT {p}bin, c - base - CASE WHEN row_number() OVER (ORDER BY rem DESC, {p}bin) <= "
        f"rest - sum(base) OVER () THEN 1 ELSE 0 END AS quota FROM {p}c)",
        f"{p}s AS (SELECT {p}b.*, row_number() OVER (PARTITION BY {p}b.{p}bin ORDER BY {_hash_sql(label)}, id) <= "
        f"quota AS {p}held FROM {p}b JOIN {p}q ON {p}b.{p}bin = {p}q.{p}bin)",
    ]


SPLIT_CTES = (
    "src AS (SELECT id, price FROM h)",
    *_stage_sql("src", "t", "test", "0.2 * count(*)"),
    "rst AS (SELECT id, price FROM ts WHERE NOT theld)",
    *_stage_sql("rst", "v", "val", "0.125 * count(*)"),
    "sp AS (SELECT ts.id, ts.price, ts.tbin AS bin, CASE WHEN theld THEN 'test' WHEN vheld THEN 'val' "
    "ELSE 'train' END AS split FROM ts LEFT JOIN vs ON ts.id = vs.id)",
)


def split_houses(spark: SparkSession, folder: str) -> DataFrame:
    return stratified_split(houses(spark, folder))


# -- injected predictions ------------------------------------------------------

MODELS = ["linear_regression", "random_forest", "gradient_boosting"]
_RULES = {
    "linear_regression": "0.9D * price + 10 * (id % 1000)",
    "random_forest": "0.85D * price + 20 * (id % 700)",
    "gradient_boosting": "0.95D * price + 5 * (id % 1300)",
}
_SPLIT_RULE = "CASE WHEN id % 10 < 7 THEN 'train' WHEN id % 10 = 7 THEN 'val' ELSE 'test' END"


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions of three models that follow from price and id: one row per model and house."""
    entries = ", ".join(f"'{m}', CAST({r} AS DOUBLE)" for m, r in _RULES.items())
    return houses(spark, folder).selectExpr(
        "id AS row_id", f"{_SPLIT_RULE} AS split", "CAST(id % 5 AS INT) AS fold", "price AS y",
        f"stack({len(_RULES)}, {entries}) AS (model, y_pred)")


PRED = "p AS (" + " UNION ALL ".join(
    f"SELECT '{m}' AS model, id AS row_id, {_SPLIT_RULE} AS split, CAST(id % 5 AS INTEGER) AS fold, price AS y, "
    f"CAST({r.replace('D', '')} AS DOUBLE) AS y_pred FROM h" for m, r in _RULES.items()) + ")"
METRIC = ("m AS (SELECT model, split, count(*) AS n, sqrt(avg((y - y_pred) * (y - y_pred))) AS rmse, "
          "avg(abs(y - y_pred)) AS mae, 1 - sum((y - y_pred) * (y - y_pred)) / (var_pop(y) * count(y)) AS r2, "
          "100 * avg(abs((y - y_pred) / (y + 1e-8))) AS mape FROM p GROUP BY model, split)")
COMPARE = ("c AS (SELECT model, max(r2) FILTER (split = 'train') AS r2_train, max(r2) FILTER (split = 'val') AS r2_val, "
           "max(rmse) FILTER (split = 'train') AS rmse_train, max(rmse) FILTER (split = 'val') AS rmse_val, "
           "max(mae) FILTER (split = 'val') AS mae_val FROM m GROUP BY model)")
EVAL = ("ev AS (SELECT model, max(rmse) FILTER (split = 'test') AS rmse_test, max(mae) FILTER (split = 'test') "
        "AS mae_test, max(r2) FILTER (split = 'test') AS r2_test, max(mape) FILTER (split = 'test') AS mape_test, "
        "max(r2) FILTER (split = 'val') AS r2_val FROM m GROUP BY model)")


# -- a learnable price ---------------------------------------------------------

def learnable(ready: DataFrame) -> DataFrame:
    """Imputed houses with a price that follows from their features, without noise."""
    return ready.withColumn("price", F.expr("50000D + 120D * sqft_living + 9000D * bathrooms - 300D * (2024 - yr_built)"))


LEARNABLE = "50000 + 120 * sqft_living + 9000 * bathrooms - 300 * (2024 - yr_built)"

# -- a scorer with fixed coefficients -------------------------------------------

INTERCEPT = 300000.0
COEFFICIENTS = (4000.0, 30000.0, 90000.0, -2500.0, 8000.0, 60000.0, 20000.0, 12000.0, 35000.0, 7000.0, -15000.0)


def fixed_scorer(fit: Preprocessing) -> Scorer:
    return Scorer("linear_regression", LinearFormula(tuple(S.FEATURES), COEFFICIENTS, INTERCEPT), fit)


PREDICTED = f"{INTERCEPT} + " + " + ".join(f"hz.{f} * {k}" for f, k in zip(S.FEATURES, COEFFICIENTS))
TIER = ("CASE WHEN prediction > 500000 THEN 'Élevée' WHEN prediction > 200000 THEN 'Bonne' ELSE 'Faible' END")


def reasons_sql() -> str:
    """Why a house would be refused as a request, as one text (empty when valid)."""
    parts = []
    for name, whole, low, high in S.REQUEST_BOUNDS:
        extra = f"WHEN h.{name} != floor(h.{name}) THEN '{name} not whole' " if whole else ""
        parts.append(f"CASE WHEN h.{name} IS NULL THEN '{name} missing' WHEN h.{name} < {low} THEN '{name} < {low}' "
                     f"WHEN h.{name} > {high} THEN '{name} > {high}' {extra}END")
    return f"concat_ws('; ', {', '.join(parts)})"


SCORED = (f"sc AS (SELECT hz.id, hz.date, {PREDICTED} AS prediction, {reasons_sql()} AS reasons "
          "FROM hz JOIN h ON hz.id = h.id)")

"""Profiling, cleaning, validation and column selection."""

from __future__ import annotations

import logging
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline import schema as S
from hearthline.functions.columns import quoted, tidy_name
from hearthline.functions.sqltext import name_sql, present_sql, text_sql
from hearthline.operators.ranks import exact_quantiles
from hearthline.session import written

log = logging.getLogger(__name__)


# -- column sets ---------------------------------------------------------------

def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    """Number-typed columns; booleans are not numbers."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def text_columns(df: DataFrame, exclude_prefix: str | None = None) -> list[str]:
    return [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and not (exclude_prefix and f.name.startswith(exclude_prefix))
    ]


def normalize_column_names(df: DataFrame) -> DataFrame:
    names = [tidy_name(c) for c in df.columns]
    clash = sorted({n for n in names if names.count(n) > 1})
    if clash:
        raise ValueError(f"column names collide after tidying: {clash}")
    return df.toDF(*names)


def select_features(df: DataFrame, features: list[str] = S.FEATURES, target: str = S.TARGET) -> DataFrame:
    """The known features that exist, in list order, then the target if there is one."""
    absent = [f for f in features if f not in df.columns]
    if absent:
        log.warning("absent features: %s", absent)
    keep = [f for f in features if f in df.columns] + ([target] if target in df.columns else [])
    return df.select(*[quoted(c) for c in keep])


def drop_columns(df: DataFrame, columns: list[str] = S.DROPPED_COLUMNS) -> DataFrame:
    return df.drop(*columns)


def cast_columns(df: DataFrame, casts: dict[str, str]) -> DataFrame:
    """Casts by name; a missing boolean cast to a number counts as 0."""
    types = {f.name: f.dataType for f in df.schema.fields}

    def cast(name: str, to: str) -> Column:
        out = quoted(name).cast(to)
        return F.coalesce(out, F.lit(0).cast(to)) if isinstance(types[name], T.BooleanType) and to != "string" else out

    return df.withColumns({c: cast(c, to) for c, to in casts.items() if c in types})


def schema_check(spark: SparkSession, actual: list[str], expected: list[str]) -> DataFrame:
    """Expected and actual columns compared as sets: ``(column_name, problem)`` rows."""
    rows = [(c, "missing") for c in sorted(set(expected) - set(actual))]
    rows += [(c, "unexpected") for c in sorted(set(actual) - set(expected))]
    return spark.createDataFrame(rows, "column_name string, problem string")


def variable_catalog(df: DataFrame) -> DataFrame:
    """Columns per family by name fragment; a column may be in several families."""
    rows = [
        (family, i, c)
        for family, parts in S.VARIABLE_FAMILIES.items()
        for i, c in enumerate(df.columns)
        if any(p in c.lower() for p in parts)
    ]
    return df.sparkSession.createDataFrame(rows, "family string, position int, column_name string")


# -- missing values and cleaning ----------------------------------------------

def rewritten(df: DataFrame, made: dict[str, str]) -> DataFrame:
    """``df`` with some columns replaced by SQL expressions, in one projection."""
    return df.selectExpr(*[f"{made.get(c, name_sql(c))} AS {name_sql(c)}" for c in df.columns]) if made else df


def floating_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]


def nan_to_null(df: DataFrame) -> DataFrame:
    return rewritten(df, {c: present_sql(c, df.schema[c].dataType) for c in floating_columns(df)})


def finite_sql(name: str) -> str:
    """The column with NaN and infinities read as missing; NaN compares above infinity."""
    x = name_sql(name)
    return f"(CASE WHEN abs({x}) < double('Infinity') THEN {x} END)"


def replace_inf(df: DataFrame) -> DataFrame:
    """Infinite and NaN values of all floating columns read as missing."""
    return rewritten(df, {c: finite_sql(c) for c in floating_columns(df)})


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Whole-row deduplication; copies collapse map-side before the shuffle."""
    return df.dropDuplicates()


def drop_sparse_rows(df: DataFrame, share: float = 0.5) -> DataFrame:
    """Rows with at least ``share`` of their columns present."""
    return df.dropna(thresh=math.ceil(share * len(df.columns)))


def clean(df: DataFrame) -> DataFrame:
    """Deduplicate, drop sparse rows, tidy the names, in that order."""
    return normalize_column_names(drop_sparse_rows(drop_duplicates(nan_to_null(df))))


def fill_constant(df: DataFrame, fills: dict[str, float] = S.NULL_DEFAULTS) -> DataFrame:
    return df.fillna({c: v for c, v in fills.items() if c in df.columns})


def valid_request(types: dict[str, T.DataType], bounds=S.REQUEST_BOUNDS) -> Column:
    """Whether a request row keeps all bounds: plain comparisons that a scan can use. Null where a value is missing."""
    tests = []
    for name, whole, low, high in bounds:
        c = name_sql(name)
        tests.append(f"{c} >= {low} AND {c} <= {high}")
        if whole and not isinstance(types[name], T.IntegralType):
            tests.append(f"{c} = floor({c})")
    return F.expr(" AND ".join(tests))


def violations(bounds=S.REQUEST_BOUNDS) -> Column:
    """Why a request row is refused: an array, empty for a valid row."""
    reasons = []
    for name, whole, low, high in bounds:
        c = name_sql(name)
        not_whole = f"WHEN {c} != floor({c}) THEN '{name} not whole' " if whole else ""
        reasons.append(
            f"CASE WHEN {c} IS NULL OR isnan(CAST({c} AS DOUBLE)) THEN '{name} missing' "
            f"WHEN {c} < {low} THEN '{name} < {low}' WHEN {c} > {high} THEN '{name} > {high}' {not_whole}END")
    return F.expr(f"array_compact(array({', '.join(reasons)}))")


def validate_ranges(df: DataFrame, bounds=S.REQUEST_BOUNDS) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and refused rows with their ``reasons``."""
    valid = valid_request({f.name: f.dataType for f in df.schema.fields}, bounds)
    refused = df.where(~F.coalesce(valid, F.lit(False)))
    return df.where(valid), refused.withColumn("reasons", violations(bounds))


# -- profiles ------------------------------------------------------------------

def profile_table(df: DataFrame) -> DataFrame:
    """One row per column: type, missing values, and the size of the table; one scan."""
    fields = df.schema.fields
    missing = [f"count_if({present_sql(f.name, f.dataType)} IS NULL) AS n_missing_{i}" for i, f in enumerate(fields)]
    entries = ", ".join(
        f"{i}, {text_sql(f.name)}, {text_sql(f.dataType.simpleString())}, n_missing_{i}" for i, f in enumerate(fields))
    return df.selectExpr("count(1) AS n_rows", *missing).selectExpr(
        "n_rows", f"{len(fields)} AS n_columns",
        f"stack({len(fields)}, {entries}) AS (position, column_name, type, n_missing)")


def describe_numeric(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """count, mean, std (sample), min, quartiles, max per numeric column; quartiles are exact."""
    columns = numeric_columns(df) if columns is None else columns
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs = []
    for i, c in enumerate(columns):
        x = present_sql(c, types[c])
        aggs += [f"avg({x}) AS mean_{i}", f"stddev_samp({x}) AS std_{i}",
                 f"CAST(min({x}) AS DOUBLE) AS min_{i}", f"CAST(max({x}) AS DOUBLE) AS max_{i}"]
    quarts, row = exact_quantiles(df, columns, [0.25, 0.5, 0.75], aggs)
    out = [
        (c, row[f"n_{i}"], row[f"mean_{i}"], row[f"std_{i}"], row[f"min_{i}"], *quarts[c], row[f"max_{i}"])
        for i, c in enumerate(columns)
    ]
    return df.sparkSession.createDataFrame(
        out, "column_name string, count bigint, mean double, std double, min double, "
             "q25 double, q50 double, q75 double, max double")


def count_duplicates(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row, and the rows in all."""
    return (
        df.groupBy(*[quoted(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("__copies"))
        .agg(F.coalesce(F.sum("__copies"), F.lit(0)).alias("n_rows"),
             F.coalesce(F.sum(F.col("__copies") - 1), F.lit(0)).alias("n_duplicates"))
    )


def count_nulls_total(df: DataFrame) -> DataFrame:
    missing = " + ".join(f"int({present_sql(f.name, f.dataType)} IS NULL)" for f in df.schema.fields)
    return df.selectExpr("count(1) AS n_rows", f"coalesce(sum({missing}), 0L) AS n_missing")


def cleaning_report(df: DataFrame) -> DataFrame:
    """Rows before and after cleaning, the duplicates and sparse rows removed: one grouping.

    Presence is counted on the grouped rows, so copies cross the network once per task.
    """
    tidy = nan_to_null(df)
    present = " + ".join(f"int({name_sql(c)} IS NOT NULL)" for c in tidy.columns)
    enough = F.expr(f"{present} >= {math.ceil(0.5 * len(tidy.columns))}")
    return (
        tidy.groupBy(*[quoted(c) for c in tidy.columns]).agg(F.count(F.lit(1)).alias("__copies"))
        .agg(F.coalesce(F.sum("__copies"), F.lit(0)).alias("n_initial"),
             F.count_if(enough).alias("n_final"),
             F.coalesce(F.sum(F.col("__copies") - 1), F.lit(0)).alias("n_duplicates"),
             F.count_if(~enough).alias("n_sparse"))
        .withColumn("n_removed", F.col("n_initial") - F.col("n_final"))
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    c = quoted(column)
    return df.where(c.isNotNull()).groupBy(c.alias(column)).agg(F.count(F.lit(1)).alias("n"))


def value_counts_topk(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The k most frequent values; ties go by name."""
    return value_counts(df, column).orderBy(F.desc("n"), quoted(column)).limit(k)


BUCKETS = 1 << 16  # counted groups of values; their table is broadcast, so its size is fixed


def heavy_hitters(df: DataFrame, column: str, k: int = 10, tracked: int = 10_000) -> DataFrame:
    """The rows of ``value_counts_topk``, without sending every distinct value over the network.

    A summary of ``tracked`` frequent items names candidates. Their exact counts give a floor that the k-th
    count reaches, and the exact count of each bucket of values is no less than that of any value in it.
    So values of buckets below the floor are out; the rest is grouped. Exact on any data: where all
    counts are alike few buckets fall below the floor, and it becomes the full grouping.
    """
    c = quoted(column)
    rows = df.where(c.isNotNull()).select(c.alias(column))
    summary = rows.agg(F.expr(f"approx_top_k({name_sql(column)}, {k}, {max(k, tracked)})")).first()[0]
    items = [r[0] for r in summary or []]
    bucket = F.pmod(F.xxhash64(c), F.lit(BUCKETS)).cast("int")
    item = F.when(c.isin(items), c)
    counts = written(rows.groupBy(bucket.alias("__bucket"), item.alias("__item")).agg(F.count(F.lit(1)).alias("n")), "buckets")
    best = [r["n"] for r in counts.where("__item IS NOT NULL").orderBy(F.desc("n")).limit(k).collect()]
    least = F.lit(best[-1] if len(best) == k else 1)
    hot = counts.groupBy("__bucket").agg(F.sum("n").alias("__rows")).where(F.col("__rows") >= least).select("__bucket")
    kept = rows.withColumn("__bucket", bucket).join(F.broadcast(hot), "__bucket", "left_semi")
    return kept.groupBy(c.alias(column)).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).orderBy(
        F.desc("n"), c).limit(k)


def count_distinct(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[count(quoted(c)).alias(c) for c in columns])


def quantile_edges(df: DataFrame, column: str = S.TARGET, q: int = 10, fallback: int = 5) -> list[float]:
    """Distinct q-quantile edges; the fallback is taken for q below 1."""
    q = q if q >= 1 else fallback
    values = exact_quantiles(df, [column], [i / q for i in range(q + 1)])[0][column]
    return sorted({v for v in values if v is not None})

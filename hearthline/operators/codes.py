"""Label codes: the 0-based rank of each distinct value, and looking them up."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthline.functions.columns import quoted, text_or_missing
from hearthline.operators.ranks import TASK_ROWS
from hearthline.session import discard, written

BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 8 << 20
HOT_SHARE = 1_000


@dataclass(frozen=True)
class LabelCodes:
    """``table`` has (value, code, n); ``small`` says it was seen to fit a broadcast; ``rows`` is the sum of n."""

    table: DataFrame
    small: bool
    rows: int


def fit_label_codes(
    df: DataFrame, column: str, broadcast_rows: int = BROADCAST_ROWS, task_rows: int = TASK_ROWS
) -> LabelCodes:
    """Codes in code-point order of the values as text; missing is a value of its own.

    The distinct values are written once and measured there; only a table that is small in rows and
    in bytes comes to the driver.
    """
    values = written(
        df.groupBy(text_or_missing(quoted(column)).alias("value")).agg(F.count(F.lit(1)).alias("n")), "label-values")
    size = values.agg(F.count(F.lit(1)).alias("values"), F.sum(F.octet_length("value")).alias("bytes"),
                      F.sum("n").alias("rows")).first()
    if size["values"] <= broadcast_rows and (size["bytes"] or 0) <= BROADCAST_BYTES:
        rows = [(value, i, n) for i, (value, n) in enumerate(sorted(map(tuple, values.collect())))]
        table = df.sparkSession.createDataFrame(rows, "value string, code bigint, n bigint")
    else:
        table = None
    codes = LabelCodes(_ranked_by_range(values, size["values"], task_rows) if table is None else table,
                       table is not None, size["rows"] or 0)
    discard(values)
    return codes


def _ranked_by_range(values: DataFrame, count: int, task_rows: int) -> DataFrame:
    """Codes of many values: ranges of them are ranked apart and shifted by the sizes before.

    The ranges are written out first, so that they stay the same when a task is run again.
    """
    parts = max(2, math.ceil(4 * count / task_rows))
    ranged = written(
        values.repartitionByRange(parts, "value").withColumn("part", F.spark_partition_id()), "label-ranges")
    shifts, total = [], 0
    for r in ranged.groupBy("part").count().orderBy("part").collect():
        shifts.append((r["part"], total))
        total += r["count"]
    offsets = values.sparkSession.createDataFrame(shifts, "part int, shift bigint")
    place = F.row_number().over(Window.partitionBy("part").orderBy("value"))
    codes = ranged.join(F.broadcast(offsets), "part").select("value", (F.col("shift") + place - 1).alias("code"), "n")
    stored = written(codes, "label-codes")
    discard(ranged)
    return stored


def lookup_label_codes(
    df: DataFrame, column: str, codes: LabelCodes, output: str, unseen_is_error: bool = True
) -> DataFrame:
    """Left join of the code. A value never seen in the fit is an error, or null if so asked."""
    label = text_or_missing(quoted(column))
    if codes.small:
        table = F.broadcast(codes.table.select(F.col("value").alias("__value"), F.col("code").alias("__code")))
        joined = df.join(table, label == F.col("__value"), "left")
        return joined.withColumn(output, _found(F.col("__code"), label, unseen_is_error)).drop("__value", "__code")

    # Rows with a hot value meet a broadcast and are not shuffled at all; the shuffled join sees only the
    # thin values. Fewer than HOT_SHARE values can each have more than one row in HOT_SHARE.
    every = codes.table.select(F.col("value").alias("__value"), F.col("code").alias("__code"), "n")
    hot = F.broadcast(every.where(F.col("n") * HOT_SHARE > codes.rows).drop("n"))
    every = every.drop("n")
    same = label == F.col("__value")
    thick = df.join(hot, same)
    thin = df.join(hot, same, "left_anti").join(every, same, "left")
    joined = thick.unionByName(thin)
    return joined.withColumn(output, _found(F.col("__code"), label, unseen_is_error)).drop("__value", "__code")


def _found(code: Column, label: Column, unseen_is_error: bool) -> Column:
    if not unseen_is_error:
        return code
    return F.coalesce(code, F.raise_error(F.concat(F.lit("value not seen in the fit: "), label)).cast("bigint"))

"""Column expressions: flags, ratios, right-closed categories, labels and tiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hearthline import schema as S
from hearthline.functions.sqltext import literal_sql, name_sql, text_sql


def quoted(name: str) -> Column:
    """A column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def ratio_or_whole(part: Column, count: Column) -> Column:
    """``part / count`` where the count is positive, else ``part`` itself."""
    return F.when(count > 0, F.try_divide(part, count)).otherwise(part).cast("double")


def right_closed(value: str, edges: list[float], results: list[str], outside: str) -> Column:
    """The result of the bin ``[e0,e1], (e1,e2], ...`` that holds the value; all given as SQL."""
    first, *rest = [literal_sql(float(e)) for e in edges]
    whens = " ".join(f"WHEN {value} <= {e} THEN {r}" for e, r in zip(rest, results))
    return F.expr(
        f"CASE WHEN {value} IS NULL OR isnan(CAST({value} AS DOUBLE)) OR {value} < {first} THEN {outside} "
        f"{whens} ELSE {outside} END")


def age_category(age: str) -> Column:
    return right_closed(name_sql(age), S.AGE_EDGES, [text_sql(x) for x in S.AGE_LABELS], text_sql(S.MISSING_LABEL))


def area_category(area: str) -> Column:
    return right_closed(name_sql(area), S.AREA_EDGES, [text_sql(x) for x in S.AREA_LABELS], text_sql(S.MISSING_LABEL))


def bin_code(column: str, edges: list[float]) -> Column:
    """0-based bin of right-closed edges; the lowest edge belongs to bin 0, outside is null."""
    if len(edges) < 2:
        return F.when(quoted(column).isNotNull(), F.lit(0))
    return right_closed(name_sql(column), edges, [str(i) for i in range(len(edges) - 1)], "CAST(NULL AS INT)")


def text_or_missing(value: Column) -> Column:
    """The value as text, missing as the label that stands for it."""
    return F.coalesce(value.cast("string"), F.lit(S.MISSING_LABEL))


def zip_zone(zipcode: Column) -> Column:
    """Thousands of the zip code, floored, as text."""
    return text_or_missing(F.floor(zipcode / F.lit(1000)).cast("bigint"))


def confidence(prediction: Column) -> Column:
    tiers = [F.when(prediction > limit, F.lit(label)) for limit, label in S.CONFIDENCE_TIERS]
    return F.coalesce(*tiers, F.lit(S.CONFIDENCE_LOWEST))


def scaled_to_ten(value: Column, low: float | None, high: float | None) -> Column:
    """Min-max scaling to 0..10; a constant column has no scale and gives null."""
    if low is None or high is None or low == high:
        return F.lit(None).cast("double")
    return (value - F.lit(low)) / F.lit(high - low) * 10


def tidy_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def display_name(name: Column) -> Column:
    """``random_forest`` as ``Random Forest``."""
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))

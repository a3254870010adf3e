"""SQL text for wide projections and aggregates: one call into the JVM instead of thousands."""

from __future__ import annotations

import math

from pyspark.sql import types as T


def name_sql(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal_sql(value: int | float) -> str:
    """A number as a literal that keeps its exact value."""
    if isinstance(value, int):
        return f"{value}L"
    if isinstance(value, float):
        return f"{value!r}D" if math.isfinite(value) else f"double('{value}')"
    raise TypeError(f"not a number: {value!r}")


def text_sql(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def present_sql(name: str, dtype: T.DataType) -> str:
    """The column with NaN read as missing."""
    c = name_sql(name)
    return f"(CASE WHEN NOT isnan({c}) THEN {c} END)" if isinstance(dtype, (T.FloatType, T.DoubleType)) else c

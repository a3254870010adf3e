"""Audit log analytics: parsing lines, counting events, the tail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline import schema as S

END = "end of line"
COUNTED = ["prediction", "health_check", "error"]


def _json_value(line: Column) -> Column:
    """The JSON value that is the whole line, as text; a null array where the line is none.

    A reader of JSON stops after a value, so the line stands in an array before an end mark: text
    after the value, or a second value, spoils the array or moves the mark.
    """
    found = F.from_json(F.concat(F.lit("["), line, F.lit(f', "{END}"]')), "array<string>", {"allowSingleQuotes": "false"})
    return F.when((F.size(found) == 2) & (F.get(found, F.lit(1)) == END), found)


def parse_audit(lines: DataFrame, line: str = "line") -> DataFrame:
    """Lines with their parsed ``record`` (null unless a JSON object) and ``is_json``.

    Any JSON value counts as JSON, as in the log reader; only objects give a record. Of a repeated
    key the last value counts. Text after the value makes a line no JSON.
    """
    value = _json_value(F.col(line))
    is_object = value.isNotNull() & F.ltrim(F.regexp_replace(F.col(line), r"^[\t\r\n]+", "")).startswith("{")
    return lines.withColumns({
        "is_json": value.isNotNull(),
        "record": F.when(is_object, F.from_json(F.get(value, F.lit(0)), S.AUDIT_SCHEMA)),
    })


def _marked(line: Column) -> Column:
    """A line in an array before a mark, parsed once: whole JSON objects give two elements, the second one the mark.

    The mark is a hash of the line, which no line can foresee.
    """
    return F.from_json(
        F.concat(F.lit("["), line, F.lit(', {"end of line": '), F.xxhash64(line).cast("string"), F.lit("}]")),
        "array<struct<event_type: string, `end of line`: bigint>>", {"allowSingleQuotes": "false"})


def _type_of(found: Column, line: Column) -> Column:
    """The event type of a ``_marked`` line; null where the line is no JSON object or has none."""
    whole = (F.size(found) == 2) & (F.get(found, F.lit(1))["end of line"] == F.xxhash64(line))
    return F.when(whole, F.get(found, F.lit(0))["event_type"])


def event_type(lines: DataFrame, line: str = "line") -> DataFrame:
    """Lines with their event type; null where there is none. The rules are those of ``parse_audit``, in one parse."""
    return lines.withColumn("event_type", _type_of(_marked(F.col(line)), F.col(line)))


def audit_event_counts(lines: DataFrame, line: str = "line") -> DataFrame:
    """One row: predictions (failed ones included), health checks, errors. The rest is not counted."""
    kind = F.col("event_type")
    return event_type(lines, line).agg(
        F.count_if(kind == "prediction").alias("predictions"),
        F.count_if(kind == "health_check").alias("health_checks"),
        F.count_if(kind == "error").alias("errors"),
    )


def audit_tail(
    lines: DataFrame, limit: int = 10, order: tuple[str, ...] = ("ts", "line_no"), line: str = "line"
) -> DataFrame:
    """The last ``limit`` lines in order with the log's size; lines that are not JSON are kept raw."""
    if limit < 1:
        raise ValueError("limit must be at least 1")
    total = lines.count()
    tail = lines.orderBy(*[F.desc(c) for c in order]).limit(limit)
    trimmed, is_json = F.trim(F.col(line)), F.col("is_json")
    return parse_audit(tail, line).select(
        *order,
        F.when(is_json, trimmed).alias("entry"),
        F.when(~is_json, trimmed).alias("raw_message"),
        F.when(~is_json, "raw").alias("type"),
        F.lit(total).cast("bigint").alias("total_logs"),
        F.lit(min(limit, total)).alias("showing"),
    )


def audit_window_counts(lines: DataFrame, ts: str = "ts", line: str = "line", width: str = "1 hour",
                        delay: str | None = None) -> DataFrame:
    """Counted events per tumbling window; with ``delay`` the rows carry a watermark, for streams."""
    # counted types come out of a generator: a filter would be pushed below the parse and repeat it
    types = F.transform(F.array(_marked(F.col(line))), lambda found: _type_of(found, F.col(line)))
    rows = lines.select(ts, F.explode(F.filter(types, lambda kind: kind.isin(COUNTED))).alias("event_type"))
    if delay is not None:
        rows = rows.withWatermark(ts, delay)
    return (
        rows.groupBy(F.window(ts, width), "event_type").agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "event_type", "n")
    )

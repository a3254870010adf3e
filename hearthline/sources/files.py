"""CSV and Parquet tables."""

from __future__ import annotations

import functools
import logging
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.functions.columns import quoted

log = logging.getLogger(__name__)

# Texts that mean a missing value in a CSV cell.
NA_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
_WHOLE = r"^\s*[+-]?\d+\s*$"
_REAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$|^\s*[+-]?(?i:inf|infinity)\s*$"
_BOOL = r"^(True|TRUE|true|False|FALSE|false)$"


EXACT_DOUBLE = 1 << 53


def _raw_facts(spark: SparkSession, path: str) -> dict[tuple[bool, bool], list[str]]:
    """The files by whether all their bytes are UTF-8, and whether a quoted cell runs over a line end. One scan."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    quotes = F.length(F.regexp_replace(F.make_valid_utf8("value"), '[^"]', ""))
    files = lines.groupBy("file").agg(
        F.count_if(~F.is_valid_utf8("value")).alias("bad"),
        F.count_if(quotes % 2 == 1).alias("odd"),
    )
    out: dict[tuple[bool, bool], list[str]] = {}
    for r in files.orderBy("file").collect():
        out.setdefault((r["bad"] == 0, r["odd"] > 0), []).append(unquote(r["file"]))
    return out


def _inferred(df: DataFrame) -> DataFrame:
    """Text columns typed by their content: whole, real, boolean, else text. One scan.

    A whole-number column with missing cells becomes real, as missing is NaN there, unless a double
    cannot hold its numbers. Numbers that no type holds exactly stay text.
    """
    cells = {c: F.when(~quoted(c).isin(NA_TEXTS), quoted(c)) for c in df.columns}
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(cells.values()):
        aggs += [F.count(c).alias(f"n{i}")]
        aggs += [F.count_if(c.rlike(p)).alias(f"{k}{i}") for k, p in (("w", _WHOLE), ("r", _REAL), ("b", _BOOL))]
        whole = F.when(c.rlike(_WHOLE), F.trim(c).try_cast("bigint"))
        aggs += [F.count(whole).alias(f"f{i}"), F.count_if(~whole.between(-EXACT_DOUBLE, EXACT_DOUBLE)).alias(f"l{i}")]
    facts = df.agg(*aggs).first()

    def typed(i: int, c: Column) -> Column:
        n = facts[f"n{i}"]
        if n == 0:
            return F.lit(None).cast("double")
        if facts[f"w{i}"] != facts[f"f{i}"]:
            return c  # whole numbers beyond 64 bits: as doubles, keys would merge
        if facts[f"w{i}"] == n:
            return F.trim(c).cast("bigint" if n == facts["n"] or facts[f"l{i}"] else "double")
        if facts[f"r{i}"] == n and not facts[f"l{i}"]:
            return F.trim(c).cast("double")
        if facts[f"b{i}"] == n == facts["n"]:
            return c.cast("boolean")
        return c

    return df.select(*[typed(i, c).alias(name) for i, (name, c) in enumerate(cells.items())])


def scan_csv_encoded(
    spark: SparkSession, path: str, schema: T.StructType | None = None, encoding: str | None = None,
    multi_line: bool | None = None,
) -> DataFrame:
    """CSV with header: each file as UTF-8 if every byte of it is, else as Latin-1.

    A file stays splittable unless a quoted cell of it holds a line end. Looking for encoding and
    line ends takes one scan, inferring types another; what is given is not looked for.
    """
    if encoding is None or multi_line is None:
        groups = _raw_facts(spark, path) or {(True, False): [path]}
    else:
        groups = {(True, multi_line): [path]}
    parts = []
    for (utf8, broken), files in groups.items():
        used = encoding or ("UTF-8" if utf8 else "ISO-8859-1")
        log.info("reading %s as %s", files if len(files) < 10 else f"{len(files)} files of {path}", used)
        reader = spark.read.option("header", True).option("encoding", used).option("escape", '"').option(
            "multiLine", broken if multi_line is None else multi_line).option("inferSchema", False)
        parts.append((reader if schema is None else reader.schema(schema)).csv(files))
    whole = functools.reduce(DataFrame.unionByName, parts)
    return whole if schema is not None else _inferred(whole)


def scan_raw(spark: SparkSession, path: str, file_format: str = "csv") -> DataFrame:
    if file_format.lower() != "csv":
        raise ValueError(f"unsupported format: {file_format}")
    return scan_csv_encoded(spark, path)


def scan_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A processed table by its extension: .csv or .parquet."""
    if path.endswith(".csv"):
        return scan_csv_encoded(spark, path, schema)
    if path.endswith(".parquet"):
        return spark.read.parquet(path) if schema is None else spark.read.schema(schema).parquet(path)
    raise ValueError(f"unsupported format: {path}")


def sink_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a processed table by its extension: .csv (UTF-8, header) or .parquet."""
    if path.endswith(".csv"):
        df.write.mode(mode).option("header", True).option("encoding", "UTF-8").option("escape", '"').csv(path)
    elif path.endswith(".parquet"):
        df.write.mode(mode).parquet(path)
    else:
        raise ValueError(f"unsupported format: {path}")


def sink_splits(df: DataFrame, path: str) -> None:
    """One dataset partitioned by split, so a reader of one split opens only its files."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def scan_splits(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if split is None else df.where(F.col("split") == split)


LINE_ORDER = ("file_name", "block_start", "seq")


def scan_audit_log(spark: SparkSession, path: str) -> DataFrame:
    """Log files as lines, with the place of each line (``LINE_ORDER``)."""
    return spark.read.text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("seq"),
    )


def sink_audit(records: DataFrame, path: str) -> None:
    """Append one JSON line per record; fields without a value are written as null."""
    line = F.to_json(F.struct(*[quoted(c) for c in records.columns]), {"ignoreNullFields": "false"})
    records.select(line.alias("value")).write.mode("append").text(path)

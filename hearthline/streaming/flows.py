"""The scoring and audit operators over streams of files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hearthline.operators.audit import audit_window_counts
from hearthline.operators.scoring import Scorer, audit_rows, batch_score
from hearthline.functions.columns import quoted


def read_stream(spark: SparkSession, path: str, schema: T.StructType, file_format: str = "parquet",
                max_files: int | None = None, pattern: str | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.format(file_format).load(path)


def stream_score(requests: DataFrame, scorer: Scorer, request_id: Column | None = None, at: Column | None = None,
                 keep: tuple[str, ...] = (), duration_ms: Column | None = None) -> DataFrame:
    """Responses of the valid requests of a stream; stateless, the same expressions as in batch."""
    return batch_score(requests, scorer, request_id, at, keep, duration_ms)[0]


def once(requests: DataFrame, key: str, ts: str, delay: str = "1 hour") -> DataFrame:
    """The requests of a stream without those sent again; state is kept for ``delay`` of event time only.

    A request is known by ``key``, one without a key by all of its columns. Of a request that comes twice
    within ``delay`` the first stays. Requests behind the watermark (the latest ``ts`` less ``delay``) and those
    without a time are refused: whether they are repeats can no longer be told; ``late`` counts the former.
    Scores and log lines made from this stream hold every request once. A time without a zone is judged as one
    of the session's zone and passed on as it came.
    """
    every = F.sha2(F.to_json(F.struct(*[quoted(c) for c in requests.columns]), {"ignoreNullFields": "false"}), 256)
    known = F.coalesce(F.concat(F.lit("k"), quoted(key).cast("string")), F.concat(F.lit("r"), every))
    timed, at = requests.where(quoted(ts).isNotNull()).withColumn("__request", known), ts
    if isinstance(requests.schema[ts].dataType, T.TimestampNTZType):  # which a watermark does not take
        timed, at = timed.withColumn("__time", quoted(ts).cast("timestamp")), "__time"
    return timed.withWatermark(at, delay).dropDuplicatesWithinWatermark(["__request"]).drop("__request", "__time")


def late(query: StreamingQuery) -> int:
    """Rows that the recent batches of a stream refused as too late."""
    return sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)


def write_stream(df: DataFrame, path: str, checkpoint: str, file_format: str = "parquet") -> StreamingQuery:
    """Everything available now, exactly once, to files."""
    return (
        df.writeStream.format(file_format).option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )


def stream_audit_lines(requests: DataFrame, scorer: Scorer, path: str, checkpoint: str, **columns) -> StreamingQuery:
    """One JSON line per request of a stream, appended to a log folder."""
    records = audit_rows(requests, scorer, **columns)
    line = F.to_json(F.struct(*[quoted(c) for c in records.columns]), {"ignoreNullFields": "false"})
    return write_stream(records.select(line.alias("value")), path, checkpoint, "text")


def stream_audit_counts(lines: DataFrame, ts: str = "ts", line: str = "line", width: str = "1 hour",
                        delay: str = "1 hour") -> DataFrame:
    """Counted events per window; the watermark closes windows and frees their state."""
    return audit_window_counts(lines, ts, line, width, delay)


FOLD = 16  # folders of one level that are folded into one of the next
COUNT_KEYS = ("window_start", "window_end", "event_type")


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path as it takes it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, in order; none where it does not exist."""
    files, place = _files(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(place) if f.isDirectory()) if files.exists(place) else []


def _run_number(spark: SparkSession, path: str, checkpoint: str) -> int:
    """The number of the run that a checkpoint belongs to, kept next to it; a renewed checkpoint starts the next run."""
    files, place = _files(spark, f"{checkpoint}/run-number")
    if files.exists(place):
        return int(spark.read.text(f"{checkpoint}/run-number").first()[0])
    number = 1 + max((int(name.split("-")[0]) for level in _folders(spark, path) for name in _folders(spark, f"{path}/{level}")),
                     default=0)
    spark.createDataFrame([(str(number),)], "value string").coalesce(1).write.text(f"{checkpoint}/run-number")
    return number


def _latest(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Of every key the row of the newest run and, within it, of the newest batch."""
    last = F.max_by(F.struct("n", "run", "batch"), F.struct("run", "batch")).alias("last")
    return rows.groupBy(*keys).agg(last).select(*keys, "last.*")


def _fold(spark: SparkSession, path: str, keys: tuple[str, ...], level: int = 0) -> None:
    """Fold ``FOLD`` folders of a level into one of the next, and so on upwards.

    Rows keep their run and batch, so a folder that is still there beside its fold changes no result:
    a crash between writing and deleting is mended by the next fold.
    """
    names = _folders(spark, f"{path}/level={level}")
    if len(names) < FOLD:
        return
    rows = spark.read.option("recursiveFileLookup", True).parquet(*[f"{path}/level={level}/{n}" for n in names])
    _latest(rows, keys).write.mode("overwrite").parquet(f"{path}/level={level + 1}/{names[-1]}")
    for name in names:
        files, place = _files(spark, f"{path}/level={level}/{name}")
        files.delete(place, True)
    _fold(spark, path, keys, level + 1)


def write_counts(counts: DataFrame, path: str, checkpoint: str, keys: tuple[str, ...] = COUNT_KEYS) -> StreamingQuery:
    """Keep window counts (``keys`` and ``n``) current in a table that one stream at a time writes.

    Each batch writes its changed windows to its own folder under the number of its run, so a retried
    batch repeats itself, and a stream that starts again with a renewed checkpoint is a later run whose counts
    replace those of earlier runs, window by window. Windows that it does not see (their input is
    gone) keep their counts. Folders are folded by ``FOLD`` level by level: their number grows with the
    logarithm of the batches, and a count is rewritten once a level.
    """
    run = _run_number(counts.sparkSession, path, checkpoint)

    def upsert(batch: DataFrame, batch_id: int) -> None:
        tagged = batch.withColumns({"run": F.lit(run).cast("bigint"), "batch": F.lit(batch_id).cast("bigint")})
        tagged.write.mode("overwrite").parquet(f"{path}/level=0/{run:06d}-{batch_id:012d}")
        _fold(batch.sparkSession, path, keys)

    return (
        counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
        .foreachBatch(upsert).trigger(availableNow=True).start()
    )


def read_counts(spark: SparkSession, path: str, keys: tuple[str, ...] = COUNT_KEYS) -> DataFrame:
    """The latest count of every window, open ones included."""
    rows = spark.read.option("recursiveFileLookup", True).parquet(path)
    return _latest(rows, keys).drop("run", "batch")

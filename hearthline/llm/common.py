"""Session settings, Arrow helpers and connected components for the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hearthline.session import discard, written

BATCH_CONF, DEFAULT_BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", 1000
BYTES_CONF, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20


def small_batches(spark: SparkSession) -> SparkSession:
    """Send documents to Python in batches of a few MB. A setting made by the user stays."""
    if spark.conf.get(BATCH_CONF) == DEFAULT_BATCH:
        spark.conf.set(BATCH_CONF, BATCH_ROWS)
        spark.conf.set(BYTES_CONF, BATCH_BYTES)
    return spark


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{folder}/documents.parquet")


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | StructType) -> DataFrame:
    """Apply ``fn`` to each Arrow batch; it may return None for nothing."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            if batch.num_rows and (out := fn(batch)) is not None and out.num_rows:
                yield out
    return df.mapInArrow(batches, schema)


PIECE = 2 << 20  # bytes of text that are worked on at once; a longer text is one piece


def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of documents of about ``PIECE`` bytes of text, as words take several times their bytes."""
    size = np.asarray(pc.fill_null(pc.binary_length(batch["text"]), 0), np.int64)
    part = np.cumsum(size) // PIECE
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    return (batch.slice(a, z - a) for a, z in zip(cuts, cuts[1:]) if z > a)


def in_pieces(docs: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``map_batches`` over the pieces of each batch."""
    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for part in pieces(batch):
                if (out := fn(part)) is not None and out.num_rows:
                    yield out
    return docs.mapInArrow(batches, schema)


FOREST_NODES = 1_000_000  # nodes that a task's forest holds before it is passed on and a new one begun
PART_EDGES = 100_000  # written edges a partition


def _dealt(df: DataFrame, edges: int) -> DataFrame:
    """``df``, which comes from so many written edges and has no more rows, in partitions of bounded size."""
    return df.coalesce(max(1, -(-edges // PART_EDGES)))


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one edge, to a node that has none of its own."""
    each = edges.groupBy("a").agg(F.count("*").alias("n"))
    return (each.where("n > 1").isEmpty()
            and edges.select("b").distinct().join(each.select(F.col("a").alias("b")), "b", "left_semi").isEmpty())


def _forest(edges: DataFrame) -> DataFrame:
    """Each partition's edges (a, b) as forests of bounded size: every node to the smallest that it is connected with there."""
    limit = FOREST_NODES

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict = {}

        def root(x):
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = x = parent[up]
            return x

        def forest() -> Iterator[pa.RecordBatch]:
            child = [x for x in parent if root(x) != x]
            if child:
                yield pa.RecordBatch.from_pydict({"a": pa.array(child, kind), "b": pa.array([root(x) for x in child], kind)})
            parent.clear()
        kind = None
        for batch in found:
            kind = batch.schema.field("a").type
            for a, b in zip(batch["a"].to_pylist(), batch["b"].to_pylist()):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
            if len(parent) > limit:
                yield from forest()
        yield from forest()
    return edges.mapInArrow(batches, edges.schema)


def connected(edges: DataFrame, rounds: int = 60, forests: bool = False) -> DataFrame:
    """(node, root): for every node of the edges (a, b) the smallest node that it is connected with.

    First each partition's edges become forests (unless ``forests`` tells that they are, or nearly), made in as many tasks
    as the edges come in and written; only then do fewer partitions hold them, by their count, which no round
    raises. Then large and
    small stars alternate: a round links a node's larger neighbours, then its smaller ones, to the smallest
    of them. Each round's edges are written to the shared folder, so a lost executor costs one round. No
    node's neighbours are ever collected together: the minimum is an aggregate with map-side partial
    minima, and the join back to it can be split where one node is hot.
    """
    edges = edges.select("a", "b").where("a <> b")
    links = written(edges if forests else _forest(edges), "links")
    n = links.count()
    now = written(_dealt(_forest(_dealt(links, n)).distinct(), n), "edges")
    discard(links)
    for _ in range(rounds):
        if _settled(now):
            return now.selectExpr("a AS node", "b AS root").union(now.selectExpr("b AS node", "b AS root").distinct())
        both = now.union(now.selectExpr("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").selectExpr("b AS a", "m AS b")
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(down, "a").where("b <> m").selectExpr("b AS a", "m AS b")
                 .union(down.selectExpr("a", "m AS b")).distinct())
        last, now = now, written(_dealt(small, now.count()), "edges")
        discard(last)
    raise ValueError(f"components did not settle in {rounds} rounds")

"""Shards of near equal bytes by a k-d tree over the documents' metadata.

A node is split along its widest dimension (size, place of the id, source, language), the spread being taken
relative to that of all documents, at the weighted median of the sizes there: for k leaves at k // 2 parts of k.
The median is exact: a histogram of all nodes of a level at once narrows each node's bracket until one row is
left, which goes to the side that it makes more nearly even. Ties in a dimension go by the rows' order by id, so
a value, or a group of copies, that holds a third of all rows is cut like any other range. What is collected is
one row for each node, and of nodes there are at most as many as leaves; histograms stay on the cluster.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthline.operators.codes import fit_label_codes, lookup_label_codes
from hearthline.session import discard, written

DIMENSIONS = ("d_size", "d_place", "d_source", "d_lang")  # of equal spread the first is split
BUCKETS = 4096  # of a node's histogram
BROADCAST_NODES = 100_000  # splits of a level that are broadcast, at most; more are joined
RANGE_ROWS = 1 << 16  # rows that are numbered together
IN_PART = (1 << 33) - 1  # of an increasing id, the number within its partition


@dataclass
class Node:
    """A node to be split, while its weighted median is searched."""

    first: int  # it has the leaves first .. first + leaves - 1
    leaves: int
    dimension: str = ""
    total: int = 0
    low: int = 0  # the bracket: of the value, and once that is known, of the place
    high: int = 0
    before: int = 0  # size of the rows before the bracket
    value: int | None = None
    place: int | None = None  # the last row of the left side

    @property
    def left(self) -> int:
        return self.leaves // 2

    @property
    def need(self) -> int:
        """The size that belongs to the left, rounded up."""
        return -(-self.total * self.left // self.leaves)


def _label(name: str) -> Column:
    """Text that tells a null from every value, and comes before them."""
    return F.when(F.col(name).isNull(), F.lit("")).otherwise(F.concat(F.lit("v"), F.col(name)))


def _value() -> Column:
    """The row's value in its node's dimension."""
    return F.coalesce(*(F.when(F.col("dimension") == d, F.col(d)) for d in DIMENSIONS))


def _facts(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, node and the dimensions), written; d_place ascends with doc_id, nulls first.

    The first step reads the texts, once; all that follows has some 60 bytes a document.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    read = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text).cast("long") + 1).alias("size"),
                               F.crc32(text.cast("binary")).alias("text_crc32"), _label("source").alias("source"),
                               _label("lang").alias("lang"), F.monotonically_increasing_id().alias("input")), "shard-read")
    keys = ["doc_id", "text_crc32", "input"]  # so that even a group of equal rows is dealt over partitions
    rows = written(read.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("row", F.monotonically_increasing_id()),
                   "shard-rows")
    counts = rows.groupBy(F.shiftright("row", 33).alias("part")).count()  # one row a partition
    before = F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = F.broadcast(counts.select("part", F.coalesce(before, F.lit(0)).alias("before")))
    placed = rows.join(offsets, F.shiftright("row", 33) == F.col("part")).withColumn(
        "d_place", F.col("before") + F.col("row").bitwiseAND(IN_PART))
    for name in ("source", "lang"):
        placed = lookup_label_codes(placed, name, fit_label_codes(rows, name), f"d_{name}")
    out = written(placed.select("doc_id", "size", "text_crc32", F.col("size").alias("d_size"), "d_place", "d_source", "d_lang",
                                F.lit(0).alias("node")), "shard-facts")
    discard(read)
    discard(rows)
    return out


def _ranges() -> list[Column]:
    return [f(d).alias(f"{f.__name__}_{d}") for d in DIMENSIONS for f in (F.min, F.max)]


def _measured(rows: DataFrame, nodes: list[Node], spread: dict[str, int]) -> list[Node]:
    """The nodes that have rows, those to be split with their dimension, total and first bracket."""
    found = {r.node: r for r in rows.groupBy("node").agg(F.sum("size").alias("total"), *_ranges()).collect()}
    nodes = [x for x in nodes if x.first in found]
    for x in nodes:
        r = found[x.first]
        if x.leaves > 1:
            width = {d: (r[f"max_{d}"] - r[f"min_{d}"]) / spread[d] if spread[d] else 0.0 for d in DIMENSIONS}
            x.dimension, x.total = max(DIMENSIONS, key=lambda d: width[d]), r["total"]  # of equal ones the first
            x.low, x.high = r[f"min_{x.dimension}"], r[f"max_{x.dimension}"]
    return nodes


def _beside(rows: DataFrame, table: DataFrame, n: int) -> DataFrame:
    """Each row with what the table has for its node."""
    return rows.join(F.broadcast(table) if n <= BROADCAST_NODES else table, "node", "left")


def _narrow(rows: DataFrame, nodes: list[Node], n_rows: int) -> None:
    """One histogram of each node's bracket; the bracket becomes what rows there are in the median's bucket."""
    table = rows.sparkSession.createDataFrame(
        [(x.first, x.dimension, x.value, x.low, x.high, -(-(x.high - x.low + 1) // BUCKETS), x.need - x.before) for x in nodes],
        "node int, dimension string, value long, low long, high long, step long, rest long")
    found = (_beside(rows, table, len(nodes)).withColumn("at", _value()).where("value IS NULL OR at = value")
             .withColumn("key", F.expr("IF(value IS NULL, at, d_place)")).where("key BETWEEN low AND high")
             .withColumn("bucket", F.expr("(key - low) DIV step")).groupBy("node", "bucket")
             .agg(F.sum("size").alias("size"), F.min("key").alias("least"), F.max("key").alias("most"), F.first("rest").alias("rest")))
    upto = F.sum("size").over(Window.partitionBy("node").orderBy("bucket"))  # at most BUCKETS rows
    found = (found.withColumn("upto", upto).where("upto >= rest").groupBy("node")
             .agg(F.min_by(F.struct("size", "least", "most", "upto"), "bucket").alias("found")))
    by = {x.first: x for x in nodes}
    for r in found.collect():
        x, size = by[r.node], r.found.size
        x.before += r.found.upto - size
        x.low, x.high = r.found.least, r.found.most
        if x.low < x.high:
            continue
        if x.value is None and x.dimension != "d_place":
            x.value, x.low, x.high = x.low, 0, n_rows - 1
        else:
            x.value = x.low if x.value is None else x.value
            nearer = (2 * x.before + size) * x.leaves <= 2 * x.total * x.left  # its middle is no farther than the median
            x.place = x.low if nearer else x.low - 1


def _split(rows: DataFrame, nodes: list[Node], n_rows: int) -> tuple[DataFrame, list[Node]]:
    """(rows with their new nodes, written, and these nodes): each node of more than one leaf is split."""
    split = [x for x in nodes if x.leaves > 1]
    while todo := [x for x in split if x.place is None]:
        _narrow(rows, todo, n_rows)
    cuts = rows.sparkSession.createDataFrame([(x.first, x.dimension, x.value, x.place, x.first + x.left) for x in split],
                                             "node int, dimension string, value long, place long, right int")
    at = _value()
    goes = (at > F.col("value")) | ((at == F.col("value")) & (F.col("d_place") > F.col("place")))
    moved = _beside(rows, cuts, len(split)).withColumn("node", F.when(goes, F.col("right")).otherwise(F.col("node")))
    after = [x for x in nodes if x.leaves == 1]
    after += [y for x in split for y in (Node(x.first, x.left), Node(x.first + x.left, x.leaves - x.left))]
    return written(moved.select(rows.columns), "shard-nodes"), after


def _slots(rows: DataFrame) -> DataFrame:
    """The result, rows numbered within ranges of places and shifted by what the node has in ranges before."""
    ranged = rows.withColumn("range", F.expr(f"d_place DIV {RANGE_ROWS}"))
    counts = ranged.groupBy("node", "range").agg(F.count("*").alias("n"))
    shift = F.sum("n").over(Window.partitionBy("node").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("node", "range", F.coalesce(shift, F.lit(0)).alias("shift"))
    own = F.row_number().over(Window.partitionBy("node", "range").orderBy("d_place"))
    return (ranged.withColumn("own", own).join(counts, ["node", "range"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("node").alias("shard"),
                    (F.col("shift") + F.col("own") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard")))


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for each row of ``docs`` (doc_id, text, source, lang).

    The law is ``bytes``: a document's size is its UTF-8 bytes plus one, and shards are near equal in sizes, within
    about half a document for each level of the tree. There are ``shards`` of them, or as many as ``target_bytes``
    asks for. slot counts from 0 in a shard, by doc_id; grown_shard is null, as another number of shards moves any row.
    A null text has size 1 and checksum 0; null sources, languages and ids come before all others; repeated ids and
    rows are documents of their own, in order of checksum. Equal texts may be cut apart, as a group of copies may
    outweigh a shard. With fewer documents than shards some shards are empty. Other columns are ignored.
    """
    if (shards is None) == (target_bytes is None):
        raise ValueError("give either shards or target_bytes")
    rows = _facts(docs.select("doc_id", "text", "source", "lang"))
    whole = rows.agg(F.count("*").alias("n"), F.sum("size").alias("size"), *_ranges()).first()
    spread = {d: (whole[f"max_{d}"] or 0) - (whole[f"min_{d}"] or 0) for d in DIMENSIONS}
    nodes = [Node(0, shards or max(1, -(-(whole["size"] or 0) // target_bytes)))]
    while any(x.leaves > 1 for x in nodes):
        nodes = _measured(rows, nodes, spread)
        if any(x.leaves > 1 for x in nodes):
            last = rows
            rows, nodes = _split(last, nodes, whole["n"])
            discard(last)
    return _slots(rows)

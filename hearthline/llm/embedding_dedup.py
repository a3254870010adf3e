"""Vectors linked by cosine: int8 tile products with error bounds, exact where a pair may pass.

Each normalised vector is x = s q + r with int8 codes q. Then |x.y - s_x s_y q_x.q_y| is at most
e_x + e_y + e_x e_y, where e is the length of r, so a pair whose product lies below the threshold by more
than that is surely no link. The others are computed again in double precision from the given values.
Equal vectors are one node with a count. Nodes are dealt into blocks; a tile is a pair of blocks, and
returns for each of its vectors the number of its links and one neighbour: never the pairs themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import connected, map_batches, small_batches
from hearthline.session import written

BLOCK = 4096  # vectors
STRIPE = 512  # rows of a tile multiplied at once
PAIRS = 100_000  # pairs computed in full precision at once
EXACT_FLOAT32 = (1 << 24) // 127 ** 2  # dimensions up to which products of codes are exact in float32


def _raw(b: pa.RecordBatch) -> pa.RecordBatch:
    """(vec_id, raw): the values' bytes, null unless all are present and finite and some differ from zero."""
    column = b["embedding"]
    values = column.values if not pa.types.is_fixed_size_list(column.type) else column.flatten()
    kind = np.float32 if pa.types.is_float32(column.type.value_type) else np.float64
    numbers = np.asarray(values.cast(pa.float32() if kind is np.float32 else pa.float64()).fill_null(np.nan))
    raw = []
    offsets = np.asarray(column.offsets) if len(column) else []
    for k in range(len(column)):
        x = numbers[offsets[k]:offsets[k + 1]] if column[k].is_valid else numbers[:0]
        fine = len(x) and np.isfinite(x).all() and x.any()
        raw.append((x + kind(0)).tobytes() if fine else None)  # -0.0 and 0.0 are equal
    return pa.RecordBatch.from_pydict({"vec_id": b["vec_id"].cast(pa.int64()), "raw": pa.array(raw, pa.binary())})


def _codes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(normalised rows, int8 codes, scales, lengths of what the codes miss)."""
    peak = np.abs(x).max(1, keepdims=True)
    unit = x / peak
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    scale = np.abs(unit).max(1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    miss = np.linalg.norm(unit - codes * scale[:, None], axis=1) + 1e-9
    return unit, codes, scale, miss


def tile_links(x: np.ndarray, nx: np.ndarray, y: np.ndarray | None, ny: np.ndarray | None, least: float
               ) -> tuple[np.ndarray, np.ndarray]:
    """(links, root) of the vectors x, then y: how many each has (copies counted), and a node that it is connected with.

    With y None the pairs are those within x.
    """
    both = _codes(x) if y is None else tuple(np.concatenate(p) for p in zip(_codes(x), _codes(y)))
    unit, codes, scale, miss = both
    n = np.concatenate([nx] if y is None else [nx, ny])
    links, root = np.zeros(len(unit), np.int64), np.arange(len(unit))
    begin = 0 if y is None else len(x)
    exact = np.float32 if unit.shape[1] <= EXACT_FLOAT32 else np.float64
    right = codes[begin:].astype(exact).T
    worst, largest = miss[begin:].max(), scale[begin:].max()
    for a in range(0, len(x), STRIPE):
        z = min(a + STRIPE, len(x))
        products = codes[a:z].astype(exact) @ right
        bound = least - miss[a:z] - worst - miss[a:z] * worst
        maybe = products >= np.where(bound > 0, bound / (scale[a:z] * largest), -np.inf).astype(exact)[:, None] * (1 - 1e-6)
        i, j = np.nonzero(maybe)
        fine = scale[i + a] * scale[j + begin] * products[i, j] >= (
            least - miss[i + a] - miss[j + begin] - miss[i + a] * miss[j + begin])
        i, j = i[fine] + a, j[fine] + begin
        if y is None:
            i, j = i[i < j], j[i < j]
        for k in range(0, len(i), PAIRS):
            p, q = i[k:k + PAIRS], j[k:k + PAIRS]
            cosine = np.einsum("ij,ij->i", unit[p], unit[q])
            p, q = p[cosine >= least], q[cosine >= least]
            np.add.at(links, p, n[q])
            np.add.at(links, q, n[p])
            while len(p):
                low = np.minimum(root[p], root[q])
                np.minimum.at(root, root[p], low)
                np.minimum.at(root, root[q], low)
                root = root[root]
                apart = root[p] != root[q]
                p, q = p[apart], q[apart]
    while (root[root] != root).any():
        root = root[root]
    return links, root


def _tiles(items: DataFrame, least: float) -> DataFrame:
    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(table: pa.Table) -> pa.RecordBatch | None:
            wide, block = np.asarray(table["wide"])[0], np.asarray(table["block"])
            dim = np.asarray(table["dim"])[0]
            x = np.frombuffer(b"".join(table["raw"].to_pylist()), np.float64 if wide else np.float32)
            x = x.reshape(-1, dim).astype(np.float64)
            n = np.asarray(table["n"])
            i, j = np.asarray(table["i"])[0], np.asarray(table["j"])[0]
            one, two = np.flatnonzero(block == i), np.flatnonzero(block == j)
            if i == j:
                links, root = tile_links(x[one], n[one], None, None, least)
                own = one
            elif len(one) and len(two):
                links, root = tile_links(x[one], n[one], x[two], n[two], least)
                own = np.concatenate([one, two])
            else:
                return None
            keep = np.flatnonzero(links)
            nodes = table["node"].combine_chunks()
            return pa.RecordBatch.from_pydict({"node": nodes.take(pa.array(own[keep])), "links": pa.array(links[keep]),
                                               "root": nodes.take(pa.array(own[root[keep]]))})
        held: list[pa.RecordBatch] = []
        key = None
        for b in batches:
            keys = list(zip(*(b[k].to_pylist() for k in ("dim", "wide", "i", "j"))))
            cuts = [0, *(k for k in range(1, len(keys)) if keys[k] != keys[k - 1]), len(keys)]
            for a, z in zip(cuts, cuts[1:]):
                if held and keys[a] != key and (done := out(pa.Table.from_batches(held))) is not None:
                    yield done
                held = [b.slice(a, z - a)] if keys[a] != key else [*held, b.slice(a, z - a)]
                key = keys[a]
        if held and (done := out(pa.Table.from_batches(held))) is not None:
            yield done
    keys = ["dim", "wide", "i", "j"]
    return items.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(tiles, "node binary, links long, root binary")


def embedding_dedup(vectors: DataFrame, least: float = 0.9) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of ``vectors`` (vec_id, embedding).

    Two vectors link when their cosine in double precision is at least ``least`` (above 0), whatever their
    other columns. n_links counts the other rows that a row links with; component_id is the smallest vec_id
    reachable by links; kept tells vec_id = component_id. A vector that is null, empty or zero, or holds a
    null or non-finite value, links with nothing, and neither do vectors of different lengths. A null vec_id
    never names a component unless all ids of it are null. Rows that repeat a vec_id are vectors of their own.
    """
    small_batches(vectors.sparkSession)
    wide = "double" in vectors.schema["embedding"].dataType.simpleString()
    column = F.col("embedding").cast("array<double>" if wide else "array<float>")
    raw = map_batches(vectors.select("vec_id", column.alias("embedding")), _raw, "vec_id long, raw binary")
    rows = written(raw.withColumn("node", F.unhex(F.md5("raw"))), "vectors")
    nodes = rows.where("node IS NOT NULL").groupBy("node").agg(
        F.first("raw").alias("raw"), F.count("*").alias("n"), F.min("vec_id").alias("least"))
    blocks = max(1, -(-nodes.count() // BLOCK))
    items = (nodes.select("node", "raw", "n", F.expr(f"octet_length(raw) DIV {8 if wide else 4} AS dim"), F.lit(wide).alias("wide"),
                          F.expr(f"cast(pmod(xxhash64(node), {blocks}) AS int) AS block"))
             .withColumn("other", F.expr(f"explode(sequence(0, {blocks - 1}))"))
             .selectExpr("dim", "wide", "least(block, other) AS i", "greatest(block, other) AS j", "block", "node", "raw", "n"))
    found = written(_tiles(items, least), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    groups = connected(found.selectExpr("node AS a", "root AS b"))
    info = nodes.select("node", "n", "least").join(links, "node", "left").join(groups, "node", "left")
    info = info.withColumn("root", F.coalesce("root", "node"))
    info = info.join(info.groupBy("root").agg(F.min("least").alias("component")), "root")
    return (rows.select("vec_id", "node").join(info.select("node", "n", "links", "component"), "node", "left")
            .select("vec_id", F.when(F.col("n").isNull(), 0).otherwise(F.col("n") - 1 + F.coalesce("links", F.lit(0)))
                    .cast("long").alias("n_links"),
                    F.when(F.col("n").isNull(), F.col("vec_id")).otherwise(F.col("component")).alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))

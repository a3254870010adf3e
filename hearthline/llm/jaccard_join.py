"""Documents linked by the Jaccard similarity of their word shingles, and the components of the links.

Prefix filtering: order all shingles, rarest first. Two sets of similarity t share a shingle among the
first ``n - ceil(t n) + 1`` of each. A sketch tells which shingles are rare; one that occurs
once cannot be shared, so most documents send nothing at all. What is shared joins documents to
candidate components (a star for each shingle, no pairs), and only these are verified, in blocks. Shared
shingles travel once, packed, some 18 bytes each.

Verification in a block is adaptive: with a prefix longer by l - 1, linked sets share at least l of its
shingles. Each document takes the l of least estimated cost, from how often its shingles occur in the
block: long lists of candidates are cut down by a longer prefix before exact counting. Pairs that are
already connected are skipped, so a block returns a forest, at most one link for each document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import connected, in_pieces, pieces, small_batches
from hearthline.llm.sketch import count_apart, count_min
from hearthline.llm.words import find_words, hash_words, mix, runs
from hearthline.session import discard, written

BITS = 28  # cells of the sketch of shingles, at most: 64 MB at the driver and in a Python worker
CELLS = 4  # for each word, as far as BITS allows
WORD_BYTES = 6  # of a text with its space, about
NODE_BITS = 24
TOKENS = 1 << 18  # shared shingles that a task holds before it passes them on
PART_TOKENS = 1 << 17  # that are brought together at a time, about
BLOCK_MEMBERS, BLOCK_SHINGLES = 1000, 1_000_000
LEVELS = 8  # longest prefix extension
VERIFY_COST = 4.0  # of counting one shingle exactly, against reading one entry of a list


def shingles(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, hashes): the distinct shingles of each row, ascending, and where each row's begin.

    A text of fewer than n words is one shingle; a text without words has none.
    """
    words = find_words(texts)
    hashes, counts = hash_words(words, lower=True), words.counts()
    whole = runs(hashes, n)
    inside = words.doc[:len(whole)] == words.doc[n - 1:] if len(whole) else np.zeros(0, bool)
    docs, found = [words.doc[:len(whole)][inside]], [whole[inside]]
    for k in range(1, n):
        short = np.flatnonzero(counts == k)
        docs.append(short)
        found.append(mix(runs(hashes, k)[words.first[short]] + np.uint64(k)) if len(short) else np.zeros(0, np.uint64))
    doc, found = np.concatenate(docs), np.concatenate(found)
    order = np.argsort(found)
    order = order[np.argsort(doc[order].astype(np.uint32), kind="stable")]
    doc, found = doc[order], found[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (found[1:] != found[:-1])
    doc, found = doc[new], found[new]
    return np.searchsorted(doc, np.arange(len(texts) + 1)), found


def set_ids(first: np.ndarray, found: np.ndarray) -> pa.Array:
    """16 bytes for each set, equal for equal sets: two sums of mixed hashes."""
    sums = []
    for seed in (0x51ED270B, 0xA0761D65):
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix(found ^ np.uint64(seed)), dtype=np.uint64)])
        sums.append(mix(total[first[1:]] - total[first[:-1]] + np.uint64(seed)))
    raw = np.stack(sums, 1).astype(">u8").tobytes()
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(first) - 1, [None, pa.py_buffer(raw)]).cast(pa.binary())


def needed(n, percent: int):
    """The least overlap that a set of n has with a linked one."""
    return -(-percent * n // 100)


def _profiles(docs: DataFrame, shared: Broadcast, n: int, percent: int) -> DataFrame:
    """(<columns of docs but text>, n_shingles, node, tokens): each document's set and the shared shingles of its prefix."""
    names = [c for c in docs.columns if c != "text"]

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        first, found = shingles(b["text"], n)
        size = np.diff(first)
        doc = np.repeat(np.arange(len(size)), size)
        cls = shared.value.of(found)
        order = np.argsort((doc * 4 + cls).astype(np.uint32), kind="stable")
        place = np.arange(len(found)) - first[doc]
        keep = (place < (size - needed(size, percent) + 1)[doc]) & (cls[order] > 0)
        tokens = found[order][keep].view(np.int64)
        at = np.searchsorted(doc[keep], np.arange(len(size) + 1))
        return pa.RecordBatch.from_pydict({
            **{c: b[c].cast(pa.int64()) for c in names}, "n_shingles": pa.array(size, pa.int64()), "node": set_ids(first, found),
            "tokens": pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(tokens))})
    return in_pieces(docs, batch, ", ".join(f"{c} long" for c in names) + ", n_shingles long, node binary, tokens array<long>")


def _starred(token: np.ndarray, cls: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, ...]:
    """(token, cls, star, a, b): each token and class once with its least node, and edges from the other nodes to that."""
    order = np.lexsort((node, cls, token))
    token, cls, node = token[order], cls[order], node[order]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (cls[1:] != cls[:-1])
    star = node[new]
    return token[new], cls[new], star, node[~new], star[np.cumsum(new) - 1][~new]


def _stars(sets: DataFrame) -> DataFrame:
    """Edges (a, b) that connect the sets (node, class, tokens) that share a token and are of one class or of neighbouring ones.

    A task stars the sets of a token and class that it holds and passes on the least of them, so that a token of very many
    sets comes to the task that brings it together once for each ``TOKENS`` of a task. Its own edges go to any task.
    """
    parts = max(1, -(-(sets.agg(F.sum(F.size("tokens"))).first()[0] or 0) // PART_TOKENS))
    fields = {"token": np.uint64, "cls": np.uint16, "star": np.int64, "a": np.int64, "b": np.int64}

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def out() -> pa.RecordBatch:
            token, cls, star, a, b = _starred(*(np.concatenate(c) for c in zip(*held)))
            held.clear()
            part = (token % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            at = np.searchsorted(part[order], np.arange(parts + 1))
            even = np.arange(parts + 1) * len(a) // parts
            found = {"token": (token[order], at), "cls": (cls[order], at), "star": (star[order], at), "a": (a, even), "b": (b, even)}
            some = np.flatnonzero((np.diff(at) > 0) | (np.diff(even) > 0))
            return pa.RecordBatch.from_pydict({"part": pa.array(some, pa.int32())} | {
                k: pa.array([v[cuts[p]:cuts[p + 1]].astype(fields[k]).tobytes() for p in some], pa.binary()) for k, (v, cuts) in found.items()})
        for b in batches:
            size = np.asarray(b["tokens"].value_lengths())
            held.append((np.asarray(b["tokens"].flatten()).view(np.uint64), np.repeat(np.asarray(b["class"]), size),
                         np.repeat(np.asarray(b["node"]), size)))
            n += int(size.sum())
            if n >= TOKENS:
                yield out()
                n = 0
        if n:
            yield out()

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None

        def out() -> pa.RecordBatch:
            token, cls, node, a, b = (np.concatenate(c) for c in zip(*held))
            held.clear()
            *_, c, d = _starred(np.tile(token, 2), np.concatenate([cls, cls + np.uint16(1)]), np.tile(node, 2))
            a, b = np.unique(np.stack([np.concatenate([a, c]), np.concatenate([b, d])]), axis=1)
            return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
        for batch in batches:
            for row in batch.to_pylist():
                if now is not None and row["part"] != now:
                    yield out()
                now = row["part"]
                held.append([np.frombuffer(row[k], kind) for k, kind in fields.items()])
        if held:
            yield out()
    packed = sets.select("node", "class", "tokens").where(F.size("tokens") > 0).mapInArrow(
        sent, "part int, token binary, cls binary, star binary, a binary, b binary")
    return packed.repartition("part").sortWithinPartitions("part").mapInArrow(met, "a long, b long")


def _node_hash(column) -> np.ndarray:
    return mix(np.frombuffer(b"".join(column.to_pylist()), ">u8").reshape(-1, 2)[:, 0].astype(np.uint64))


def _sets(docs: DataFrame, wanted: Broadcast, n: int) -> DataFrame:
    """(set, shingles) once for each of the ``wanted`` sets, and for few others."""

    def batch(b: pa.RecordBatch) -> pa.RecordBatch | None:
        first, found = shingles(b["text"], n)
        ids = set_ids(first, found)
        keep = np.flatnonzero((wanted.value.of(_node_hash(ids)) > 0) & (np.diff(first) > 0))
        return pa.RecordBatch.from_pydict({
            "set": ids.take(pa.array(keep)),
            "shingles": pa.array([found[first[k]:first[k + 1]].tobytes() for k in keep], pa.binary())})
    found = in_pieces(docs.select("text"), batch, "set binary, shingles binary")
    return found.groupBy("set").agg(F.first("shingles").alias("shingles"))


def link_block(sets: list[np.ndarray], percent: int, split: int | None = None) -> list[tuple[int, int]]:
    """A forest of the links among the sets; with split, of those between the first ``split`` and the rest only."""
    m = len(sets)
    order = np.array(sorted(range(m), key=lambda k: len(sets[k])))
    side = np.zeros(m, bool) if split is None else order >= split
    size = np.array([len(sets[k]) for k in order])
    owner = np.repeat(np.arange(m), size)
    _, token, df = np.unique(np.concatenate([sets[k] for k in order]), return_inverse=True, return_counts=True)
    rank = np.empty(len(df), np.int64)
    rank[np.lexsort((np.arange(len(df)), df))] = np.arange(len(df))
    by = np.lexsort((rank[token], owner))
    owner, token = owner[by], token[by]
    first = np.searchsorted(owner, np.arange(m + 1))
    place = np.arange(len(owner)) - first[owner]
    base = size - needed(size, percent) + 1
    level = np.maximum(place - base[owner] + 2, 1)  # the entry belongs to prefixes extended by level - 1 and more
    lists = np.argsort(token, kind="stable")
    at, items, levels = np.searchsorted(token[lists], np.arange(len(df) + 1)), owner[lists], level[lists]

    parent = np.arange(m)
    links = []

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    def entries(tokens: np.ndarray) -> np.ndarray:
        length = at[tokens + 1] - at[tokens]
        return np.arange(length.sum()) + np.repeat(at[tokens] - np.cumsum(length) + length, length)

    roots = parent.copy()
    for x in range(1, m):
        own = token[first[x]:first[x + 1]]
        reading = np.cumsum(df[own] - 1)
        reach = np.minimum(base[x] + np.arange(LEVELS), size[x])  # prefix lengths
        extension = np.arange(1, LEVELS + 1)
        cost = reading[reach - 1] * (1 + VERIFY_COST / extension)
        cost[reach < base[x] + extension - 1] = np.inf
        least = int(np.argmin(cost)) + 1
        if not reading[reach[least - 1] - 1]:
            continue
        found = entries(own[:reach[least - 1]])
        found = items[found[levels[found] <= least]]
        shared = np.bincount(found[found < x], minlength=x)[:x]
        maybe = (shared >= least) & (size[:x] >= needed(size[x], percent)) & (side[:x] != side[x] if split is not None else True)
        maybe &= roots[:x] != roots[x]
        if not maybe.any():
            continue
        found = items[entries(own)]
        both = np.bincount(found[found < x], minlength=x)[:x]
        for y in np.flatnonzero(maybe & (100 * both >= percent * (size[x] + size[:x] - both))):
            a, b = root(x), root(int(y))
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((int(order[x]), int(order[y])))
        if links:
            roots = np.array([root(k) for k in range(m)]) if both.any() else roots
    return links


def _tiles(candidates: DataFrame) -> DataFrame:
    """(node, set, root, c, i, d, j, second): which tiles each candidate (node, set, root, class, n_shingles) is in.

    A component that fits a block is one tile. A larger one is cut by size class and, within it, by hash;
    its blocks meet the others of their class and of the next ones. Tile (c, i, d, j) compares block i of
    class c with block j of class d; ``second`` marks rows of the latter.
    """
    blocks = F.expr(f"greatest(ceil(count(*) / {BLOCK_MEMBERS}), ceil(sum(n_shingles) / {BLOCK_SHINGLES}))").cast("int")
    large = candidates.groupBy("root").agg(blocks.alias("all"))
    parts = candidates.groupBy("root", "class").agg(blocks.alias("own")).join(large, "root")
    near = {step: parts.select("root", (F.col("class") - step).alias("class"), F.col("own").alias(name))
            for step, name in ((1, "above"), (-1, "below"))}
    parts = parts.join(near[1], ["root", "class"], "left").join(near[-1], ["root", "class"], "left").na.fill(0)
    placed = candidates.join(parts, ["root", "class"]).withColumn("block", F.expr("cast(pmod(xxhash64(node), own) AS int)"))
    tile = "named_struct('c', {}, 'i', {}, 'd', {}, 'j', {}, 'second', {})"
    own = tile.format("class", "least(block, x)", "class", "greatest(block, x)", "x < block")
    above = tile.format("class", "block", "class + 1", "x", "false")
    below = tile.format("class - 1", "x", "class", "block", "true")
    return placed.selectExpr("node", "set", "root", f"""inline(CASE WHEN all = 1 THEN array({tile.format(0, 0, 0, 0, 'false')})
        ELSE concat(transform(sequence(0, own - 1), x -> {own}),
            CASE WHEN above > 0 THEN transform(sequence(0, above - 1), x -> {above}) ELSE array() END,
            CASE WHEN below > 0 THEN transform(sequence(0, below - 1), x -> {below}) ELSE array() END) END)""")


def _verified(items: DataFrame, percent: int) -> DataFrame:
    """A forest (a, b) of the links of each tile."""
    keys = ["root", "c", "i", "d", "j"]

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[dict]) -> pa.RecordBatch:
            rows.sort(key=lambda r: r["second"])
            split = sum(not r["second"] for r in rows)
            alone = (rows[0]["c"], rows[0]["i"]) == (rows[0]["d"], rows[0]["j"])
            links = link_block([np.frombuffer(r["shingles"], np.uint64) for r in rows], percent,
                               None if alone else split) if alone or 0 < split < len(rows) else []
            return pa.RecordBatch.from_pydict({"a": pa.array([rows[a]["node"] for a, _ in links], pa.int64()),
                                               "b": pa.array([rows[b]["node"] for _, b in links], pa.int64())})
        held: list[dict] = []
        for b in batches:
            for row in b.to_pylist():
                if held and any(held[0][k] != row[k] for k in keys):
                    if len(held) > 1:
                        yield out(held)
                    held = []
                held.append(row)
        if len(held) > 1:
            yield out(held)
    return items.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(tiles, "a long, b long")


def _linked(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, sets, linked) of ``docs`` (doc_id, text and other whole numbers).

    ``rows`` has the columns of ``docs`` but text, n_shingles and the set; ``sets`` (node, set, least) each set
    once with its smallest doc_id; ``linked`` (node, root) the components of sets that are linked with others.
    Sketches are given up at the driver and in the executors as soon as what is found with them is written.
    """
    context = docs.sparkSession.sparkContext
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(BITS, max(18, (CELLS * size // WORD_BYTES).bit_length()))
    classes = context.broadcast(count_apart(docs.select("text"), lambda b: np.concatenate(
        [shingles(p["text"], n)[1] for p in pieces(b)]), size // WORD_BYTES, bits=bits))
    rows = written(_profiles(docs, classes, n, percent), "shingle-sets")
    classes.destroy()
    sets = rows.where("n_shingles > 0").groupBy("node").agg(
        F.min("doc_id").alias("least"), F.first("n_shingles").alias("n_shingles"), F.first("tokens").alias("tokens"))
    # a short name for each set; written, so that it stays
    sets = written(sets.withColumnRenamed("node", "set").withColumn("node", F.monotonically_increasing_id()), "sets")
    # linked sets are of the same size class or of neighbouring ones
    sets = sets.withColumn("class", F.expr(f"cast(floor(ln(n_shingles) / -ln({percent} / 100D) + 1e-9) AS int)"))
    candidates = written(connected(_stars(sets), forests=True).join(sets.select("node", "set", "class", "n_shingles"), "node"), "candidates")
    wanted = context.broadcast(count_min(candidates.select("set"), lambda b: _node_hash(b["set"]), bits=NODE_BITS, levels=(1, 2, 3)))
    items = _tiles(candidates).join(_sets(docs, wanted, n), "set").drop("set")
    linked = connected(_verified(items, percent), forests=True)
    wanted.destroy()
    discard(candidates)
    return rows.withColumnRenamed("node", "set").drop("tokens"), sets.select("node", "set", "least"), linked


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of ``docs`` (doc_id, text).

    Two documents link when 100 * |intersection| >= percent * |union| of their distinct n-word shingles,
    words being cut at ASCII white space after lower-casing A-Z. component_id is the smallest doc_id
    reachable by links. A null text, or one without words, has no shingle and links with nothing: its
    component is its own doc_id. Equal sets always link. A null doc_id never names a component unless
    all ids of it are null. Rows that repeat a doc_id are documents of their own. Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    rows, least, linked = _linked(docs.select("doc_id", "text"), n, percent)
    groups = linked.join(least, "node")
    groups = groups.join(groups.groupBy("root").agg(F.min("least").alias("component")), "root").select("node", "component")
    found = least.join(groups, "node", "left").select("set", F.coalesce("component", "least").alias("component_id"))
    rows = rows.select("doc_id", "n_shingles", "set")
    return (rows.join(found.withColumn("some", F.lit(True)), "set", "left")
            .select("doc_id", "n_shingles", F.when(F.col("some"), F.col("component_id")).otherwise(F.col("doc_id"))
                    .alias("component_id")))


def first_of_each(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """Of each component of ``docs`` (doc_id, text and any other columns) exactly one row, that of smallest doc_id.

    A row with a null doc_id stays only for a component whose ids are all null. A text without words links with
    nothing and stays; of such rows that are equal in doc_id and text one does, unless the doc_id is null. Which of
    rows equal in doc_id and text stays is open. A row is known by its doc_id and 128 bits of its text, and rows
    equal in these collapse in each task before the shuffle, so texts are neither written nor sent a second time.
    """
    small_batches(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    key = [F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h1"), F.xxhash64(text, F.lit(1)).alias("h2")]
    rows, sets, linked = _linked(docs.select(*key, "text"), n, percent)
    roots = sets.join(linked, "node", "left").select("set", F.coalesce("root", "node").alias("root"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "h1", "h2")).alias("k")
    own = ["k.doc_id", "k.h1", "k.h2"]
    known = {"id": F.coalesce("doc_id", F.lit(0)), "nameless": F.col("doc_id").isNull()}  # equal for null ids too
    keys = [*known, "h1", "h2"]  # of the grouping and of the join, so that texts are sent once for both
    kept = (rows.join(roots, "set").groupBy("root").agg(first).select(*own)
            .union(rows.where("n_shingles = 0 AND doc_id IS NOT NULL").select("doc_id", "h1", "h2").distinct()))
    kept = kept.withColumns(known).select(*keys)
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), *key)
    words = F.col("row.text").rlike("[^\\x20\\x09-\\x0D]")
    nameless = F.col("doc_id").isNull() & ~F.coalesce(words, F.lit(False))
    single = whole.where(~nameless).withColumns(known).groupBy(*keys).agg(F.first("row").alias("row"))
    found = single.join(kept, keys, "left_semi")
    return found.select("row.*").union(whole.where(nameless).select("row.*"))

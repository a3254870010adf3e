"""Mix overlapping sources to target weights by a min-cost flow over membership patterns.

Documents are aggregated by the set of sources that they belong to (their pattern). The flow sends each
pattern's words to the sources in it until these have their targets; using a pattern's words once is
free, twice costs one, and so on, so repetition is spread evenly before it rises. Only patterns and
sources come to the driver. Which documents carry a pattern's flow is decided by a seeded hash: the hash
at which their sizes add up to the flow is found by counting ever finer ranges of it. As a long document
may lie there, some hundred documents around that hash are then chosen by their sizes instead.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hearthline.llm.common import map_batches, small_batches
from hearthline.llm.words import find_words
from hearthline.session import written

HASH_BITS, STEP_BITS = 40, 10  # of the selecting hash, and of the ranges counted at a time
AROUND = 256  # about so many places around a cut are chosen by size
NEAR = 1000  # a cut is near enough within this fraction of its words
EXACT = 1 << 16  # words that are filled by an exact subset
SMALL_PLAN = 20_000  # rows, of at most some 2 KB each: a plan that is broadcast


def shares(sizes: dict, weights: dict, most: float) -> dict:
    """Targets in proportion to the weights, none above ``most`` times its size; the excess is shared again."""
    total, targets, capped = float(sum(sizes.values())), {}, set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        weight = sum(w for s, w in weights.items() if s not in capped)
        targets = {s: most * sizes[s] if s in capped or not weight else left * weights[s] / weight for s in sizes}
        over = {s for s in sizes if s not in capped and targets[s] > most * sizes[s]}
        if not over:
            return {s: float(t) for s, t in targets.items()}
        capped |= over


def min_cost_flow(patterns: dict[tuple, int], demands: dict, most: int) -> dict[tuple, int]:
    """Words sent (pattern, source): shortest augmenting paths, with node potentials.

    A pattern's words can be used ``most`` times, the k-th time at cost k - 1. Demands that cannot be met
    are met as far as they can be.
    """
    graph: list[list[list]] = []  # of [to, capacity, cost, reverse]
    node: dict = defaultdict(lambda: graph.append([]) or len(graph) - 1)

    def arc(a: int, b: int, capacity: int, cost: int) -> list:
        graph[a].append([b, capacity, cost, len(graph[b])])
        graph[b].append([a, 0, -cost, len(graph[a]) - 1])
        return graph[a][-1]
    begin, end = node["begin"], node["end"]
    sent = {}
    for pattern, size in patterns.items():
        for k in range(most):
            arc(begin, node["p", pattern], size, k)
        for s in pattern:
            sent[pattern, s] = arc(node["p", pattern], node["s", s], size * most, 0)
    for s, demand in demands.items():
        arc(node["s", s], end, demand, 0)
    price = [0] * len(graph)
    while True:
        far, by = [float("inf")] * len(graph), [None] * len(graph)
        far[begin], queue = 0, [(0, begin)]
        while queue:
            d, a = heapq.heappop(queue)
            if d > far[a]:
                continue
            for k, (b, capacity, cost, _) in enumerate(graph[a]):
                if capacity and (e := d + cost + price[a] - price[b]) < far[b]:
                    far[b], by[b] = e, (a, k)
                    heapq.heappush(queue, (e, b))
        if by[end] is None:
            return {k: graph[x[0]][x[3]][1] for k, x in sent.items()}
        price = [p + d if d < float("inf") else p for p, d in zip(price, far)]
        path, at = [], end
        while at != begin:
            path.append(by[at])
            at = by[at][0]
        amount = min(graph[a][k][1] for a, k in path)
        for a, k in path:
            graph[a][k][1] -= amount
            graph[graph[a][k][0]][graph[a][k][3]][1] += amount


def _placed(docs: DataFrame, sources: str, seed: int) -> DataFrame:
    """``docs`` with ``members``, their text as ``pattern``, and ``place``, a seeded hash of the row."""
    named = F.col(sources) if dict(docs.dtypes)[sources].startswith("array") else F.array(F.col(sources))
    place = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id").cast("long"), "text"), 64 - HASH_BITS)
    return docs.withColumn("members", F.array_sort(F.array_distinct(named.cast("array<string>")))).withColumn(
        "pattern", F.to_json(F.struct("members"), {"ignoreNullFields": "false"})).withColumn("place", place)


def _sized(docs: DataFrame) -> DataFrame:
    """(doc_id, members, pattern, place, size) of placed ``docs``."""

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({**{c: b[c] for c in ("doc_id", "members", "pattern", "place")},
                                           "size": pa.array(find_words(b["text"]).counts(), pa.int64())})
    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "members", "pattern", "place", "text"), batch,
                       "doc_id long, members array<string>, pattern string, place long, size long")


def _table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Rows of the driver as a table to join with; broadcast where their number is small."""
    table = spark.createDataFrame(rows, schema)
    return F.broadcast(table) if len(rows) <= SMALL_PLAN else table


def _thresholds(sized: DataFrame, cuts: list[tuple[str, int, int]]) -> dict[tuple[str, int], tuple[int, int]]:
    """For each cut (pattern, number, words) the hash below which the pattern's documents have about so many words.

    Each step counts the words in 2**STEP_BITS ranges of the range that holds the cut, and goes into the
    one where it falls; a few rows a cut come back. At last the nearer end of the range is taken; with it
    comes by how many words it misses the cut.
    """
    spark = sized.sparkSession
    now = [(p, k, words, 0) for p, k, words in cuts]
    for left in range(HASH_BITS - STEP_BITS, -1, -STEP_BITS):
        table = _table(spark, now, "pattern string, cut int, words long, low long")
        inside = sized.join(table, "pattern").where(f"shiftright(place, {left + STEP_BITS}) = low")
        bins = inside.groupBy("pattern", "cut", "words", F.expr(f"shiftright(place, {left}) AS bin")).agg(
            F.sum("size").alias("size"))
        upto = F.sum("size").over(Window.partitionBy("pattern", "cut").orderBy("bin"))
        before = (bins.withColumn("before", upto - F.col("size")).where("before <= words")
                  .groupBy("pattern", "cut", "words").agg(F.max_by(F.struct("bin", "before", "size"), "bin").alias("at")))
        now, sizes = [], {}
        for r in before.collect():
            now.append((r.pattern, r.cut, r.words - r["at"].before, r["at"].bin))
            sizes[r.pattern, r.cut] = r["at"].size
    return {(p, k): (low + (2 * words > sizes[p, k]), min(words, sizes[p, k] - words)) for p, k, words, low in now}


def closest(sizes: Sequence[int], words: int) -> list[int]:
    """Indexes whose sizes add up to nearly ``words``; early ones first where there is a choice.

    While more than EXACT words are open, each size that fits is taken; what is left then gets the subset of
    the others whose sum is nearest (of two the smaller): bit n of ``sums[k]`` says that the first k reach n.
    """
    taken, others = [], []
    for k, size in enumerate(sizes):
        if words > EXACT and 0 < size <= words:
            taken.append(k)
            words -= size
        elif size > 0:
            others.append(k)
    if words > EXACT:
        return taken
    sums = [1]
    for k in others:
        sums.append((sums[-1] | sums[-1] << sizes[k] if sizes[k] <= 2 * words else sums[-1]) & ((2 << 2 * words) - 1))
    at = (sums[-1] & ((2 << words) - 1)).bit_length() - 1
    beyond = sums[-1] >> words
    if beyond and (over := (beyond & -beyond).bit_length() - 1) < words - at:
        at = words + over
    for n in range(len(others) - 1, -1, -1):
        if not sums[n] >> at & 1:
            taken.append(others[n])
            at -= sizes[others[n]]
    return sorted(taken)


def _closed(sized: DataFrame, cuts: list[tuple[str, int, int, int]]) -> dict[str, tuple[int, list[int]]]:
    """For each cut (pattern, words, hash, places of the pattern) a lower hash, and the places beyond it that complete it.

    Of each pattern the words below that lower hash and those of about AROUND places from there on come back.
    """
    rows = []
    for pattern, _, low, places in cuts:
        reach = -(-(AROUND << HASH_BITS) // (2 * max(places, 1)))
        rows.append((pattern, max(0, low - reach), low + reach))
    table = _table(sized.sparkSession, rows, "pattern string, first long, stop long")
    found = (sized.where("size > 0").join(table, "pattern").where("place < stop")
             .groupBy("pattern", F.expr("CASE WHEN place >= first THEN place END AS at")).agg(F.sum("size").alias("size")).collect())
    below: dict = defaultdict(int)
    around = defaultdict(list)
    for r in found:
        if r["at"] is None:
            below[r.pattern] = r["size"]
        else:
            around[r.pattern].append((r["at"], r["size"]))
    out = {}
    for (pattern, words, _, _), (_, first, _) in zip(cuts, rows):
        near = sorted(around[pattern])
        out[pattern] = first, [near[k][0] for k in closest([size for _, size in near], words - below[pattern])]
    return out


def _plan(sized: DataFrame, weights: Sequence[float] | dict | None, most: int) -> DataFrame:
    """(pattern, source_size, target, bounds): how far the uses of a pattern's documents go to each of its sources.

    One row for each pattern; a bound is the turn (of the uses), the place up to which a source reaches, and the
    places beyond it that are in it as well.
    """
    found = sized.where("members IS NOT NULL").groupBy("pattern", "members").agg(
        F.sum("size").alias("size"), F.approx_count_distinct("place").alias("places")).collect()
    places = {r.pattern: r.places for r in found}
    patterns = {tuple(r.members): int(r.size) for r in found}
    written_as = {tuple(r.members): r.pattern for r in found}
    sizes: dict = defaultdict(int)
    for pattern, size in patterns.items():
        for s in pattern:
            sizes[s] += size
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    if not isinstance(weights, dict):
        cycle = list(weights or (1, 2, 3))
        weights = {s: cycle[k % len(cycle)] for k, s in enumerate(names)}
    targets = shares(sizes, weights, most)
    flow = min_cost_flow(patterns, {s: round(t) for s, t in targets.items()}, most)
    plan, cuts = [], []
    for pattern, size in patterns.items():
        upto, bounds = 0, []
        for s in pattern:
            upto += flow[pattern, s]
            bounds.append((upto // size, upto % size) if size else (0, 0))
        plan.append((pattern, bounds))
        cuts += [(written_as[pattern], k, words) for k, (_, words) in enumerate(bounds) if words]
    at = _thresholds(sized, cuts) if cuts else {}
    used = {written_as[p]: flow[p, p[0]] for p in patterns if len(p) == 1}
    wide = [(p, words, at[p, k][0], places[p]) for p, k, words in cuts if p in used and at[p, k][1] * NEAR > used[p]]
    closed = _closed(sized, wide) if wide else {}

    def bound(pattern: str, k: int, turn: int) -> tuple:
        return (turn, *closed[pattern]) if pattern in closed else (turn, at.get((pattern, k), (0, 0))[0], [])
    rows = [(written_as[p], sum(sizes[s] for s in p), float(sum(targets[s] for s in p)),
             [bound(written_as[p], k, turn) for k, (turn, _) in enumerate(bounds)]) for p, bounds in plan]
    return _table(sized.sparkSession, rows, "pattern string, source_size long, target double, "
                  "bounds array<struct<turn:int,place:long,more:array<long>>>")


def _with_uses(placed: DataFrame, plan: DataFrame, most: int) -> DataFrame:
    # in its turn-th use a document belongs to the first source whose bound lies beyond it
    uses = F.expr(f"""filter(transform(sequence(0, {most - 1}), t -> size(filter(bounds,
        b -> t > b.turn OR (t = b.turn AND place >= b.place AND NOT array_contains(b.more, place))))),
        i -> i < size(bounds))""")
    return placed.join(plan, "pattern", "left").withColumn("uses", F.coalesce(
        F.transform(uses, lambda i: F.get("members", i)), F.array().cast("array<string>")))


def mix_sources(docs: DataFrame, weights: Sequence[float] | dict | None = None, most: int = 3, seed: int = 0,
                sources: str = "sources") -> DataFrame:
    """(doc_id, members, size, source_size, target, uses, taken) for each row of ``docs`` (doc_id, text, <sources>).

    ``sources`` is a column of names, or of arrays of names where sources overlap; a null is a source of
    its own, null last. ``weights`` maps names to weights, or is a sequence repeated over the names by
    code point; 1, 2, 3 by default. Size counts runs without ASCII white space, 0 for a null text. Together
    the sources share the words of all their documents by weight, none above ``most`` times its own (those
    of all documents in it). ``uses`` lists the source of each use of the document, at most ``most`` of
    them, and ``taken`` is the words it gives. source_size and target are sums over the document's sources:
    of a single one, its own. A document whose array of sources is null or empty is in no mix. Which
    documents are used depends on doc_id, text and seed, and near a source's cut on sizes; rows that repeat are
    used alike. A source comes within a thousandth of its target if the documents around its cut allow it, and
    as near as they do otherwise; where sources overlap, within a document. Overlapping sources may ask for
    more than their documents have ``most`` times over; they get what there is.
    """
    small_batches(docs.sparkSession)
    sized = written(_sized(_placed(docs, sources, seed)), "sizes")
    found = _with_uses(sized, _plan(sized, weights, most), most)
    return found.select("doc_id", "members", "size", F.coalesce("source_size", F.lit(0).cast("long")).alias("source_size"),
                        F.coalesce("target", F.lit(0.0)).alias("target"), "uses",
                        (F.col("size") * F.size("uses")).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, weights: Sequence[float] | dict | None = None, most: int = 3, seed: int = 0,
                    sources: str = "sources") -> DataFrame:
    """The rows of ``docs`` as often as ``mix_sources`` uses them. No text is shuffled."""
    small_batches(docs.sparkSession)
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("doc_id"), F.col("text"),
                        F.col(f"`{sources}`").alias("sources"))
    placed = _placed(whole, "sources", seed)
    plan = _plan(written(_sized(placed), "sizes"), weights, most)
    used = _with_uses(placed.select("row", "members", "pattern", "place"), plan, most)
    return used.select("row", F.explode("uses")).select("row.*")

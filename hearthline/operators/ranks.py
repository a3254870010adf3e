"""Exact order statistics of whole columns, without a global sort.

``percentile`` keeps every distinct value of a column in the memory of one task.
Here a bounded sketch proposes a bracket around each wanted rank, one scan counts
the rows below and inside it, and only the values inside are ranked: as (bracket, value)
with counts, each bracket by partial sums in a task of its own. Every step is a scan with
map-side aggregation. A bracket is ranked only when a count has shown that it holds at
most ``task_rows`` values, and all that are ranked in one scan hold at most ``LIST_VALUES``
together, however many columns and ranks there are; wider brackets are first narrowed by
a sketch of their inside. The sketch only steers: results come from counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.functions.sqltext import literal_sql, present_sql

ACCURACY = 10_000
SLACK = 5.0  # how far bracket ends lie from a rank, in units of the sketch error
TASK_ROWS = 1_000_000
LIST_VALUES = 4_000_000  # ranked in one scan, of all brackets together
MAX_ROUNDS = 64


@dataclass(frozen=True)
class Ranked:
    """A numeric SQL expression and the 1-based ranks wanted of its non-null values."""

    name: str
    expr: str
    ranks: list[int]
    size: int
    guess: tuple[int, int] | None = None  # where the ranks are expected, instead of a sketch


@dataclass(frozen=True)
class Found:
    """The value at a rank, and how many rows are at or below it."""

    value: Any
    reach: int


@dataclass(eq=False)
class _Bracket:
    """An interval (``None`` is unbounded) tried for ranks of column ``t<slot>``.

    The ranks are known to lie strictly between ``floor`` and ``ceiling``: ``start`` rows
    are at or below the floor, and at most ``bound`` rows lie between the two.
    """

    slot: int
    ranks: list[int]
    low: Any
    high: Any
    bound: int
    start: int = 0
    floor: Any = None
    ceiling: Any = None
    measured: bool = False

    @classmethod
    def known(cls, slot: int, ranks: list[int], low: Any, high: Any, start: int, end: int) -> _Bracket:
        return cls(slot, ranks, low, high, end - start, start, low, high, True)


def _inside(b: _Bracket) -> str:
    ends = [f"t{b.slot} > {literal_sql(b.low)}"] if b.low is not None else []
    ends += [f"t{b.slot} < {literal_sql(b.high)}"] if b.high is not None else []
    return " AND ".join(ends) or f"t{b.slot} IS NOT NULL"


def _sketch(expr: str, points: list[float], accuracy: int, alias: str) -> str:
    return f"percentile_approx({expr}, array({', '.join(map(literal_sql, points))}), {accuracy}) AS {alias}"


def _columns(df: DataFrame, targets: list[Ranked]) -> DataFrame:
    """The targets as t0, t1, ..."""
    return df.selectExpr(*[f"{t.expr} AS t{i}" for i, t in enumerate(targets)])


def _points(shares: Iterable[float], accuracy: int) -> list[float]:
    """Sketch positions a little below and above each share of the rows."""
    slack = SLACK / accuracy
    return sorted({min(max(p, 0.0), 1.0) for s in shares for p in (s - slack, s + slack)})


def _clusters(t: Ranked, accuracy: int) -> list[list[int]]:
    """Ranks so close that one bracket serves them."""
    out: list[list[int]] = []
    for r in sorted(set(t.ranks)):
        if out and (r - out[-1][0] <= 1 or (r - out[-1][0]) * accuracy <= t.size):
            out[-1].append(r)
        else:
            out.append([r])
    return out


def order_statistics(
    df: DataFrame, targets: list[Ranked], accuracy: int = ACCURACY, task_rows: int = TASK_ROWS
) -> dict[str, dict[int, Found]]:
    """``{name: {rank: Found}}`` for every target, exact."""
    for t in targets:
        bad = [r for r in t.ranks if not 1 <= r <= t.size]
        if bad:
            raise ValueError(f"{t.name}: rank {bad[0]} outside 1..{t.size}")
    sketched = {i: t for i, t in enumerate(targets) if t.ranks and t.guess is None}
    if sum(t.size for t in sketched.values()) <= LIST_VALUES and all(t.size <= task_rows for t in sketched.values()):
        sketched = {}
    frame = _columns(df, targets)
    points = {i: _points([c[0] / t.size for c in _clusters(t, accuracy)], accuracy) for i, t in sketched.items()}
    sketches = [_sketch(f"t{i}", p, accuracy, f"p{i}") for i, p in points.items()]
    sketch = frame.selectExpr(*sketches).first() if sketches else None
    return _search(frame, targets, points, sketch, accuracy, task_rows)


def _search(
    frame: DataFrame, targets: list[Ranked], points: dict[int, list[float]], sketch: Row | None,
    accuracy: int, task_rows: int,
) -> dict[str, dict[int, Found]]:
    out: dict[str, dict[int, Found]] = {t.name: {} for t in targets}
    open_: list[_Bracket] = []
    for i, t in enumerate(targets):
        if i not in points:
            if t.ranks:
                low, high = t.guess or (None, None)
                open_.append(_Bracket(i, sorted(set(t.ranks)), low, high, t.size))
            continue
        for ranks in _clusters(t, accuracy):
            # both ends come from the sketch positions nearest the cluster
            share = ranks[0] / t.size
            near = min(points[i], key=lambda p: abs(p - max(share - SLACK / accuracy, 0.0)))
            far = min(points[i], key=lambda p: abs(p - min(share + SLACK / accuracy, 1.0)))
            at = dict(zip(points[i], sketch[f"p{i}"]))
            low = at[near] - _room(abs(at[near])) if near > 0 else None
            high = at[far] + _room(abs(at[far])) if far < 1 else None
            open_.append(_Bracket(i, ranks, low, high, t.size))
    for _ in range(MAX_ROUNDS):
        if not open_:
            return out
        listed = _affordable(open_, task_rows)
        _narrow(frame, [b for b in open_ if b.measured and b not in listed], accuracy)
        open_ = _measure(frame, open_, listed, targets, out)
    raise RuntimeError("rank search did not settle")


def _affordable(brackets: list[_Bracket], task_rows: int) -> list[_Bracket]:
    """The brackets that may be ranked now: the smallest ones that the budget has room for, at least one if any is small."""
    out, room = [], LIST_VALUES
    for b in sorted(brackets, key=lambda b: b.bound):
        if b.bound <= task_rows and (b.bound <= room or not out):
            out.append(b)
            room -= b.bound
    return out


def _ranked(frame: DataFrame, wanted: list[tuple[int, _Bracket, list[int]]]) -> dict[tuple[int, int], tuple[Any, int]]:
    """(position, rank inside) -> (value, how many values inside are at or below it), for brackets (position, bracket, ranks inside).

    Values are counted with map-side partial sums, so hot ones do not travel; a task ranks one bracket's values.
    """
    whole = {f.name: isinstance(f.dataType, T.IntegralType) for f in frame.schema.fields}
    entries = []
    for j, b, _ in wanted:
        kinds = ("CAST({} AS BIGINT)", "CAST(NULL AS DOUBLE)") if whole[f"t{b.slot}"] else ("CAST(NULL AS BIGINT)", "CAST({} AS DOUBLE)")
        l, d = (k.format(f"t{b.slot}") for k in kinds)
        entries.append(f"CASE WHEN {_inside(b)} THEN named_struct('b', {j}, 'l', {l}, 'd', {d}) END")
    counts = frame.selectExpr(f"inline(array_compact(array({', '.join(entries)})))").groupBy("b", "l", "d").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("b").orderBy("l", "d"))
    spots = frame.sparkSession.createDataFrame([(j, r) for j, _, ranks in wanted for r in ranks], "b int, spot bigint")
    found = (counts.withColumn("upto", upto).join(F.broadcast(spots), "b")
             .where("spot <= upto AND spot > upto - n").select("b", "spot", F.expr("l"), F.expr("d"), "upto"))
    return {(r["b"], r["spot"]): (r["d"] if r["l"] is None else r["l"], r["upto"]) for r in found.collect()}


def _measure(
    frame: DataFrame, brackets: list[_Bracket], listed: list[_Bracket], targets: list[Ranked], out: dict
) -> list[_Bracket]:
    """Count around each bracket, rank what lies inside the listed ones; returns what is left open."""
    counts = []
    for j, b in enumerate(brackets):
        for end, x in (("low", b.low), ("high", b.high)):
            if x is not None:
                counts.append(f"count_if(t{b.slot} < {literal_sql(x)}) AS lt_{end}{j}")
                counts.append(f"count_if(t{b.slot} <= {literal_sql(x)}) AS le_{end}{j}")
    row = frame.selectExpr(*counts).first().asDict() if counts else {}
    wanted = []
    for j, b in enumerate(brackets):
        before, until = row.get(f"le_low{j}", 0), row.get(f"lt_high{j}", targets[b.slot].size)
        inside = [r - before for r in b.ranks if before < r <= until]
        if b in listed and inside:
            wanted.append((j, b, inside))
    ranked = _ranked(frame, wanted) if wanted else {}

    left: list[_Bracket] = []
    for j, b in enumerate(brackets):
        size = targets[b.slot].size
        settled = out[targets[b.slot].name]
        lt_low, le_low = row.get(f"lt_low{j}", 0), row.get(f"le_low{j}", 0)
        lt_high, le_high = row.get(f"lt_high{j}", size), row.get(f"le_high{j}", size)
        under, inner, over = [], [], []
        for r in b.ranks:
            if r <= lt_low:
                under.append(r)
            elif r <= le_low:
                settled[r] = Found(b.low, le_low)
            elif r <= lt_high:
                if b in listed:
                    value, upto = ranked[j, r - le_low]
                    settled[r] = Found(value, le_low + upto)
                else:
                    inner.append(r)
            elif r <= le_high:
                settled[r] = Found(b.high, le_high)
            else:
                over.append(r)
        if under:
            left.append(_Bracket.known(b.slot, under, b.floor, b.low, b.start, lt_low))
        if inner:
            left.append(_Bracket.known(b.slot, inner, b.low, b.high, le_low, lt_high))
        if over:
            left.append(_Bracket.known(b.slot, over, b.high, b.ceiling, le_high, b.start + b.bound))
    return left


def _narrow(frame: DataFrame, brackets: list[_Bracket], accuracy: int) -> None:
    """Move the ends of wide brackets inwards by a sketch of the rows inside.

    The sketch works on doubles. Whole numbers are sketched as distances from the lower
    end, so that their digits count more with every narrowing, and the ends get room
    for what the doubles round away.
    """
    if not brackets:
        return
    sketches, wanted = [], []
    for j, b in enumerate(brackets):
        first, last = ((r - b.start) / b.bound for r in (b.ranks[0], b.ranks[-1]))
        points = [max(first - SLACK / accuracy, 0.0), min(last + SLACK / accuracy, 1.0)]
        base = b.low if _spans(b) else 0
        wanted.append((points, base))
        value = f"t{b.slot} - {literal_sql(base)}" if base else f"t{b.slot}"
        sketches.append(_sketch(f"CASE WHEN {_inside(b)} THEN {value} END", points, accuracy, f"p{j}"))
        sketches += [f"{f}(CASE WHEN {_inside(b)} THEN t{b.slot} END) AS {f}{j}" for f in ("min", "max")]
    row = frame.selectExpr(*sketches).first()
    for j, (b, (points, base)) in enumerate(zip(brackets, wanted)):
        low, high = row[f"p{j}"]
        room = _room(b.high - base if _spans(b) else max(abs(low), abs(high)))
        b.low = max(row[f"min{j}"], low + base - room) if points[0] > 0 else row[f"min{j}"]
        b.high = min(row[f"max{j}"], high + base + room) if points[1] < 1 else row[f"max{j}"]


def _spans(b: _Bracket) -> bool:
    """Whole-number ends whose distance fits a long."""
    return isinstance(b.low, int) and isinstance(b.high, int) and b.high - b.low < 2**63


def _room(size: int | float) -> int:
    """How far a whole number of this size may move when it passes through a double."""
    return size >> 52 if isinstance(size, int) else 0


def exact_quantiles(
    df: DataFrame, columns: list[str], probs: list[float], extra: Iterable[str] = (),
    accuracy: int = ACCURACY, task_rows: int = TASK_ROWS,
) -> tuple[dict[str, list[float | None]], dict[str, Any]]:
    """Linearly interpolated quantiles of numeric columns, ``None`` where a column is all missing.

    ``extra`` SQL aggregates of ``df`` ride along in the first scan; their values are
    returned by alias, with the sizes of the columns under ``n_<position>``.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    clean = {c: present_sql(c, types[c]) for c in columns}
    clean = {c: f"CAST({e} AS DOUBLE)" if isinstance(types[c], T.DecimalType) else e for c, e in clean.items()}
    first = df.selectExpr(*[f"count({e}) AS n_{i}" for i, e in enumerate(clean.values())], *extra).first()

    spots: dict[str, list[tuple[int, int, float]]] = {}
    targets = []
    for i, c in enumerate(columns):
        n = first[f"n_{i}"]
        spots[c] = []
        for p in probs if n else ():
            at = (n - 1) * p
            lower = math.floor(at)
            spots[c].append((lower + 1, min(lower + 2, n), at - lower))
        ranks = sorted({r for lo, hi, frac in spots[c] for r in ((lo, hi) if frac else (lo,))})
        targets.append(Ranked(c, clean[c], ranks, n))
    found = order_statistics(df, targets, accuracy, task_rows)

    out: dict[str, list[float | None]] = {}
    for c in columns:
        at = {r: float(f.value) for r, f in found[c].items()}
        out[c] = [at[lo] if not frac else at[lo] + (at[hi] - at[lo]) * frac for lo, hi, frac in spots[c]]
        out[c] = out[c] or [None] * len(probs)
    return out, first.asDict()


def exact_medians(df: DataFrame, columns: list[str]) -> dict[str, float | None]:
    return {c: v[0] for c, v in exact_quantiles(df, columns, [0.5])[0].items()} if columns else {}

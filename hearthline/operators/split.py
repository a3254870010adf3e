"""Stratified splits and contiguous folds, both by exact thresholds instead of sorted windows.

Ranking a stratum in a window would put it into one task. Here the n-th smallest key
of each stratum is found exactly (``ranks``), and every row is then placed by
comparing its own key with that threshold: no shuffle, and the same answer whenever
a task is run again.
"""

from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline import schema as S
from hearthline.functions.columns import bin_code, quoted
from hearthline.functions.sqltext import literal_sql, name_sql, text_sql
from hearthline.operators.ranks import TASK_ROWS, Ranked, exact_quantiles, order_statistics

SPLITS = ["train", "val", "test"]
HASH_SPAN = 1 << 60
MAX_TIES = 10_000  # rows sharing one 60-bit hash; more means the key repeats


def row_hash(key: str, seed: int, label: str) -> str:
    """60 bits of a hash that any SQL engine can repeat, as SQL."""
    text = f"concat({text_sql(f'{seed}-{label}-')}, CAST({name_sql(key)} AS STRING))"
    return f"CAST(conv(substring(md5({text}), 1, 15), 16, 10) AS BIGINT)"


def allocate(counts: list[int], total: int) -> list[int]:
    """``total`` shared out in proportion to ``counts``: floors, then largest remainders.

    Equal remainders go to the earlier stratum.
    """
    whole = sum(counts)
    shares = [c * total // whole for c in counts]
    order = sorted(range(len(counts)), key=lambda i: (-(counts[i] * total % whole), i))
    for i in order[: total - sum(shares)]:
        shares[i] += 1
    return shares


@dataclass(frozen=True)
class HeldOut:
    """Which rows are held out: by stratum those up to a threshold of the hash, but for the keys that stay of its ties."""

    key: str
    stratum: str
    cuts: tuple[int, ...]  # by stratum; -1 holds nothing out
    stay: tuple[tuple[int, int, tuple], ...]  # (stratum, threshold, keys)

    def column(self, hash_sql: str) -> Column:
        cuts = ", ".join(f"{c}L" for c in self.cuts)
        out = F.expr(f"{hash_sql} <= get(array({cuts}), {self.stratum})")
        for s, cut, keys in self.stay:
            out = out & ~(F.expr(f"{self.stratum} = {s} AND {hash_sql} = {cut}L") & quoted(self.key).isin(list(keys)))
        return out


@dataclass(frozen=True)
class SplitRule:
    """What a split was fitted to: it places any row by itself, and can be stored as text."""

    key: str
    target: str
    seed: int
    edges: tuple[float, ...]
    rest_edges: tuple[float, ...]
    test: HeldOut
    val: HeldOut

    def apply(self, df: DataFrame) -> DataFrame:
        """``df`` with ``bin`` (of the target) and ``split``."""
        binned = _binned(_binned(df, self.target, list(self.edges), "bin"), self.target, list(self.rest_edges), "rest_bin")
        test, val = (held.column(row_hash(self.key, self.seed, label)) for held, label in ((self.test, "test"), (self.val, "val")))
        return binned.withColumn("split", F.when(test, "test").when(val, "val").otherwise("train")).drop("rest_bin")

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> SplitRule:
        found = json.loads(text)
        held = {name: HeldOut(h["key"], h["stratum"], tuple(h["cuts"]), tuple((s, c, tuple(k)) for s, c, k in h["stay"]))
                for name, h in ((n, found[n]) for n in ("test", "val"))}
        return cls(found["key"], found["target"], found["seed"], tuple(found["edges"]), tuple(found["rest_edges"]), **held)


def _held_out(df: DataFrame, key: str, stratum: str, mark: str, size: int, task_rows: int) -> HeldOut:
    """In each stratum the rows with the smallest hashes (column ``mark``), so many of them that ``size`` are held out."""
    counts = {r[stratum]: r["count"] for r in df.groupBy(stratum).count().collect()}
    strata = sorted(counts)
    if min(counts.values()) < 2:
        raise ValueError("a stratum has fewer than 2 rows")
    rest = sum(counts.values()) - size
    if size < len(strata) or rest < len(strata):
        raise ValueError("fewer rows on one side of the split than strata")
    kept = allocate([counts[s] for s in strata], rest)
    quotas = {s: counts[s] - k for s, k in zip(strata, kept)}

    found = order_statistics(df, [
        Ranked(str(s), f"CASE WHEN {stratum} = {s} THEN {mark} END", [q], counts[s], _hash_range(q, counts[s]))
        for s, q in quotas.items() if q
    ], task_rows=task_rows)

    reach = {s: found[str(s)][q] for s, q in quotas.items() if q}
    stay = []
    for s, at in reach.items():
        extra = at.reach - quotas[s]
        if extra:
            # Several rows have the hash of the threshold: those with the greatest keys stay.
            stay.append((s, at.value, tuple(_greatest_keys(df, key, F.expr(f"{stratum} = {s} AND {mark} = {at.value}L"), extra))))
    cuts = tuple(reach[s].value if s in reach else -1 for s in range(max(strata) + 1))
    return HeldOut(key, stratum, cuts, tuple(stay))


def _hash_range(rank: int, size: int) -> tuple[int, int]:
    """Where the rank-th smallest of ``size`` hashes lies, up to six standard deviations."""
    share = rank / size
    off = 6 * math.sqrt(share * (1 - share) / size) + 2 / size
    return int(max(share - off, 0.0) * HASH_SPAN), int(min(share + off, 1.0) * HASH_SPAN)


def _greatest_keys(df: DataFrame, key: str, tied: Column, extra: int) -> list:
    if extra > MAX_TIES:
        raise ValueError(f"split key {key!r} is not unique")
    rows = df.where(tied)
    keys = [r[0] for r in rows.select(quoted(key)).distinct().orderBy(F.desc(quoted(key))).limit(extra).collect()]
    if rows.where(quoted(key).isin(keys)).count() != extra:
        raise ValueError(f"split key {key!r} is not unique")
    return keys


def _check_key(df: DataFrame, key: str, what: str) -> None:
    """A key that repeats is an error wherever the thresholds fall; keys are counted with map-side partial sums."""
    repeated = df.groupBy(quoted(key)).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not repeated.isEmpty():
        raise ValueError(f"{what} key {key!r} is not unique")


def stratified_split(df: DataFrame, key: str = "id", target: str = S.TARGET, **options) -> DataFrame:
    """``df`` with ``bin`` (of the target) and ``split``: exact sizes, stratified by target quantiles.

    ``key`` must identify a row; membership follows from a hash of it.
    """
    return fit_split(df, key, target, **options).apply(df)


def fit_split(
    df: DataFrame, key: str = "id", target: str = S.TARGET, test_size: float = 0.2,
    validation_size: float = 0.1, seed: int = 42, task_rows: int = TASK_ROWS,
) -> SplitRule:
    """The bins and thresholds that split ``df`` into parts of exact sizes."""
    marks = {label: row_hash(key, seed, label) for label in ("test", "val")}
    narrow = df.selectExpr(
        name_sql(key), name_sql(target), *[f"{m} AS __{label}" for label, m in marks.items()]).persist()
    try:
        _check_key(narrow, key, "split")
        edges, first = _edges(narrow, target, 10)
        n = first["rows"]
        if first["n_0"] < n:
            raise ValueError(f"target {target!r} has missing values")
        n_test = math.ceil(test_size * n)
        binned = _binned(narrow, target, edges, "bin")
        test = _held_out(binned, key, "bin", "__test", n_test, task_rows)

        rest = binned.where(~test.column("__test")).drop("bin")
        rest_edges, first = _edges(rest, target, 10)
        if first["about"] < 10 * 200:
            few = rest.agg(F.count_distinct(quoted(target))).first()[0] // 20
            rest_edges = rest_edges if few >= 10 else _edges(rest, target, max(1, few))[0]
        n_val = math.ceil(validation_size / (1 - test_size) * (n - n_test))
        val = _held_out(_binned(rest, target, rest_edges, "rest_bin"), key, "rest_bin", "__val", n_val, task_rows)
    finally:
        narrow.unpersist()
    return SplitRule(key, target, seed, tuple(edges), tuple(rest_edges), test, val)


def _binned(df: DataFrame, target: str, edges: list[float], output: str) -> DataFrame:
    return df.withColumn(output, bin_code(target, edges))


def _edges(df: DataFrame, target: str, q: int) -> tuple[list[float], dict]:
    """Distinct q-quantile edges, with the rows and about how many distinct targets there are."""
    extra = ["count(1) AS rows", f"approx_count_distinct({name_sql(target)}) AS about"]
    values, first = exact_quantiles(df, [target], [i / q for i in range(q + 1)], extra)
    return sorted({v for v in values[target] if v is not None}), first


def split_distribution(df: DataFrame, split: str = "split", target: str = S.TARGET) -> DataFrame:
    """Rows, mean, sample std and coefficient of variation of the target per split."""
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("n"), F.avg(target).alias("mean"), F.stddev_samp(target).alias("std"),
    ).withColumn("cv", F.try_divide("std", "mean"))


def split_balance(df: DataFrame, split: str = "split", target: str = S.TARGET, limit: float = 0.2) -> DataFrame:
    """One row: the variation of train, val and test, and whether test and train differ too much."""
    def cv(name: str) -> Column:
        v = F.when(quoted(split) == name, quoted(target))
        return F.try_divide(F.stddev_samp(v), F.avg(v)).alias(f"cv_{name}")

    return df.agg(*[cv(s) for s in SPLITS]).withColumn(
        "unbalanced", F.abs(F.col("cv_test") - F.col("cv_train")) > limit)


def kfold_column(df: DataFrame, key: str = "id", k: int = 5, task_rows: int = TASK_ROWS) -> Column:
    """The fold 0..k-1 of a row of ``df``: contiguous in key order, the first n % k one row longer.

    ``key`` must be numeric and identify a row.
    """
    n = df.count()
    _check_key(df, key, "fold")
    if n < k:
        raise ValueError(f"{n} rows cannot make {k} folds")
    sizes = [n // k + (1 if i < n % k else 0) for i in range(k)]
    ends = [sum(sizes[: i + 1]) for i in range(k - 1)]
    found = order_statistics(df, [Ranked(key, name_sql(key), ends, n)], task_rows=task_rows)[key]
    if any(found[e].reach != e for e in ends):
        raise ValueError(f"fold key {key!r} is not unique")
    cuts = [found[e].value for e in ends]
    whens = " ".join(f"WHEN {name_sql(key)} <= {literal_sql(x)} THEN {i}" for i, x in enumerate(cuts))
    return F.expr(f"CASE {whens} ELSE {k - 1} END")


def kfold_assign(
    df: DataFrame, key: str = "id", k: int = 5, output: str = "fold", task_rows: int = TASK_ROWS
) -> DataFrame:
    return df.withColumn(output, kfold_column(df, key, k, task_rows))

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from hearthline.llm import mixing, packing
from helpers import corpus, table

PATH = public_tokenizers.path("word_bpe_49k.json")


def encoder():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


ODD = [None, "", "a <|endoftext|>b x\x1cy", "İstanbul Σίσυφος don't we'll 12a STRASSE straße É́ é", "words,and...more, of. them.", "<|ENDOFTEXT|> <|startoftext|>"]


def test_word_tokens_are_those_of_whole_texts():
    texts = ODD + [t for _, t in corpus()]
    ids, first = packing.WordTokens(PATH).batch(texts, 1)
    want = [x.ids + [1] for x in encoder().encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [ids[a:z].tolist() for a, z in zip(first, first[1:])] == want


@pytest.mark.parametrize("seed", range(5))
def test_pack_group(seed):
    rng = random.Random(seed)
    sizes = [rng.randint(1, 63) for _ in range(rng.randint(1, 80))]
    done = packing.pack_group(sizes, 64)
    used = sorted(p for x in done for p in x)
    ends = defaultdict(int)
    for k, a, z in used:
        assert a == ends[k] < z
        ends[k] = z
    assert [ends[k] for k in range(len(sizes))] == sizes
    lengths = [sum(z - a for _, a, z in x) for x in done]
    assert all(n == 64 or n & (n - 1) == 0 for n in lengths)
    assert sum(n < 64 for n in lengths) <= 6


def test_first_fit_decreasing():
    sizes = [5, 7, 5, 2, 4, 2, 5, 1, 6]
    bins, room = [], []
    for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        at = next((b for b, r in enumerate(room) if r >= sizes[k]), None)
        if at is None:
            bins.append([])
            room.append(10)
            at = len(bins) - 1
        bins[at].append(k)
        room[at] -= sizes[k]
    assert packing.first_fit_decreasing(sizes, 10) == bins


def test_pack(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_DOCS", 16)
    rows = corpus() + [(1, t) for t in ODD] + [(None, "no id"), (2, "twice"), (2, "twice")]
    found = packing.pack(table(spark, rows), PATH, length=256).collect()
    want = defaultdict(list)
    for (i, _), x in zip(rows, encoder().encode_batch([t or "" for _, t in rows], add_special_tokens=False)):
        want[i].append(np.array(x.ids + [1], "<u4"))
    assert sum(r.length for r in found) == sum(len(x) for y in want.values() for x in y)
    for r in found:
        assert any(len(x) == r.doc_tokens and zlib.crc32(x[r.start:r.start + r.length].tobytes()) == r.ids_crc32 for x in want[r.doc_id])
    for i, x in want.items():
        if len(x) == 1:
            pieces = sorted((r.start, r.length) for r in found if r.doc_id == i)
            assert [s for s, _ in pieces] == [0, *np.cumsum([n for _, n in pieces])[:-1]]
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        total = 0
        for at, n in sorted(pieces):
            assert at == total
            total += n
        assert total == 256 or total & (total - 1) == 0
    assert packing.pack(table(spark, []), PATH).count() == 0
    again = packing.pack(table(spark, rows).repartition(3), PATH, length=256).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_shares():
    assert mixing.shares({"a": 100, "b": 100}, {"a": 1, "b": 3}, 3) == {"a": 50.0, "b": 150.0}
    got = mixing.shares({"a": 10, "b": 100, "c": 100, "d": 0}, {"a": 5, "b": 1, "c": 2, "d": 9}, 3)
    assert got["a"] == 30 and got["d"] == 0 and got["b"] == pytest.approx(60) and got["c"] == pytest.approx(120)


def brute_cost(patterns, demands, most):
    """The least cost by trying every way to deal words (small numbers)."""
    best = {}

    def go(keys, left, used, cost):
        if not keys:
            met = sum(demands.values()) - sum(left.values())
            best[met] = min(best.get(met, 1e9), cost)
            return
        p, s = keys[0]
        for n in range(min(left[s], patterns[p] * most - used[p]) + 1):
            extra = sum((used[p] + k) // patterns[p] for k in range(n))
            go(keys[1:], left | {s: left[s] - n}, used | {p: used[p] + n}, cost + extra)
    go([(p, s) for p in patterns for s in p], dict(demands), {p: 0 for p in patterns}, 0)
    return max(best), best[max(best)]


@pytest.mark.parametrize("seed", range(8))
def test_min_cost_flow(seed):
    rng = random.Random(seed)
    patterns = {("a",): rng.randint(1, 3), ("b",): rng.randint(1, 3), ("a", "b"): rng.randint(1, 3)}
    demands = {"a": rng.randint(0, 5), "b": rng.randint(0, 5)}
    flow = mixing.min_cost_flow(patterns, demands, 2)
    used = {p: sum(flow[p, s] for s in p) for p in patterns}
    cost = sum(k // patterns[p] for p in patterns for k in range(used[p]))
    assert all(used[p] <= 2 * patterns[p] for p in patterns)
    assert (sum(used.values()), cost) == brute_cost(patterns, demands, 2)


def test_mix_sources(spark):
    rng = random.Random(5)
    rows = [(k, " ".join(["w"] * rng.randint(0, 30)), rng.choice("aaaabbc") if k % 40 else None) for k in range(900)]
    rows += [(None, "one two", "b"), (5000, None, "a"), (5001, "x y", "b"), (5001, "x y", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS pattern", "2 AS place", "3 AS members")
    found = mixing.mix_sources(df, sources="source").collect()
    again = mixing.mix_sources(df.repartition(5), sources="source").collect()
    assert sorted(map(str, found)) == sorted(map(str, again))
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    targets = mixing.shares(sizes, {"a": 1, "b": 2, "c": 3, None: 1}, 3)
    taken = defaultdict(int)
    for r in found:
        s = r.members[0]
        taken[s] += r.taken
        assert r.taken == r.size * len(r.uses) <= 3 * r.size and r.source_size == sizes[s] and r.target == pytest.approx(targets[s])
    for s, target in targets.items():
        assert abs(taken[s] - target) <= 30, s
    used = mixing.mixed_documents(df, sources="source")
    assert used.columns == df.columns and used.count() == sum(len(r.uses) for r in found)
    assert mixing.mix_sources(df.limit(0), sources="source").count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_closest(seed):
    rng = random.Random(seed)
    sizes = [rng.randint(0, 40) for _ in range(rng.randint(0, 11))]
    every = [sum(s for k, s in enumerate(sizes) if mask >> k & 1) for mask in range(1 << len(sizes))]
    for words in (0, 1, 7, 50, 111, 10_000):
        got = mixing.closest(sizes, words)
        assert got == sorted(set(got)) and abs(sum(sizes[k] for k in got) - words) == min(abs(e - words) for e in every)


def test_closest_of_long_texts():
    sizes = [300_000, 90_000, 20_000, 500_000] + [7, 11] * 40
    got = mixing.closest(sizes, 410_100)
    assert sum(sizes[k] for k in got) == 410_100
    assert mixing.closest([900_000, 5], 200_000) == [1] and mixing.closest([], 200_000) == []


def test_targets_beside_long_documents(spark):
    rng = random.Random(8)
    rows = [(k, "w " * (rng.choice([900, 4000, 9000]) if k % 9 == 0 else rng.randint(1, 40)), "abc"[k % 3]) for k in range(240)]
    rows += [(1000, "w " * 50, "c")] * 30
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken, target = defaultdict(int), {}
    for r in mixing.mix_sources(df, sources="source").collect():
        taken[r.members[0]] += r.taken
        target[r.members[0]] = r.target
        assert r.taken == r.size * len(r.uses) <= 3 * r.size
    assert len(target) == 3 and all(abs(taken[s] - t) <= max(1, t / 1000) for s, t in target.items())


def test_overlapping_sources(spark):
    rng = random.Random(6)
    rows = [(k, " ".join(["w"] * rng.randint(1, 9)), rng.choice([["a"], ["b"], ["a", "b"], ["b", "a", "b"], [], None])) for k in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, sources array<string>")
    taken, total = defaultdict(int), 0
    for r in mixing.mix_sources(df, weights={"a": 3, "b": 1}).collect():
        total += r.size if r.members else 0
        assert set(r.uses) <= set(r.members or []) and (r.members or not r.uses)
        for s in r.uses:
            taken[s] += r.size
    sizes = {s: sum(len(t.split()) for _, t, m in rows if m and s in m) for s in "ab"}
    targets = mixing.shares(sizes, {"a": 3, "b": 1}, 3)
    for s in "ab":
        assert abs(taken[s] - targets[s]) <= 30


def test_copies_do_not_meet_in_one_group(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_DOCS", 50)
    rows = [(None, None)] * 4000 + [(7, "the same few words")] * 2000
    found = packing.pack(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), public_tokenizers.path("word_bpe_49k.json"), length=64, end=1).collect()
    groups = Counter(r.sequence_id >> 32 for r in found)
    assert sum(r.length for r in found if r.doc_id is None) == 4000 and max(groups.values()) < 150

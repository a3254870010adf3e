import hashlib
import random

import numpy as np
import pytest

from hearthline.llm import common, embedding_dedup, jaccard_join, sketch, substring_dedup
from hearthline.llm.common import connected
from helpers import components, corpus, table, words


def shingle_sets(rows, n):
    out = {}
    for i, text in rows:
        w = words(text, lower=True)
        out[i] = frozenset(tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()
    return out


def jaccard_brute(rows, n, percent):
    sets = shingle_sets(rows, n)
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return {i: (len(sets[i]), c) for i, c in components(sets, links).items()}


@pytest.mark.parametrize("n, percent, members", [(4, 85, 1000), (5, 80, 4)])
def test_jaccard_components(spark, monkeypatch, n, percent, members):
    monkeypatch.setattr(jaccard_join, "BLOCK_MEMBERS", members)  # 4: components are cut into many blocks
    rows = corpus()
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in jaccard_join.jaccard_components(table(spark, rows), n, percent).collect()}
    assert got == jaccard_brute(rows, n, percent)


def test_jaccard_odd_rows(spark):
    rows = [(None, "a b c d e f"), (7, "A b c d e f"), (7, "other words of the same id here"), (7, "a b c d e f"), (3, None), (None, None)]
    got = sorted(map(str, jaccard_join.jaccard_components(table(spark, rows)).collect()))
    assert got == sorted(f"Row(doc_id={i}, n_shingles={n}, component_id={c})" for i, n, c in [
        (None, 2, 7), (7, 2, 7), (7, 3, 7), (7, 2, 7), (3, 0, 3), (None, 0, None)])


def test_one_row_of_each_component(spark):
    import corpus_pipeline
    b = " ".join(f"w{k}" for k in range(30))
    near = b + " end"  # linked with b
    rows = [(None, "a b c d e f"), (7, "A b c d e f"), (7, "other words of the same id here"), (7, "a b c d e f"), (3, None), (3, None),
            (None, None), (None, "no one else has this text"), (None, "no one else has this text"), (4, b), (7, near), (None, near), (4, near)]
    docs = table(spark, rows).selectExpr("*", "9 AS row_number")
    kept = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, "")
    got = sorted((str(r.doc_id), str(r.text).lower()) for r in kept.collect())
    assert [x for x in got if not x[1].startswith("w0")] == sorted([
        ("7", "a b c d e f"), ("7", "other words of the same id here"), ("3", "none"), ("None", "none"), ("None", "no one else has this text")])
    assert [i for i, t in got if t.startswith("w0")] == ["4"]
    assert kept.columns == docs.columns


def test_link_block_finds_the_components():
    rng, random_ = np.random.default_rng(1), random.Random(2)
    for _ in range(60):
        bases = [rng.integers(0, 2 ** 63, rng.integers(1, 60)).astype(np.uint64) for _ in range(4)]
        sets = []
        for _ in range(random_.randint(2, 40)):
            own = random_.choice(bases).copy()
            k = min(random_.randint(0, max(1, len(own) // 6)), len(own))
            own[rng.choice(len(own), k, replace=False)] = rng.integers(0, 2 ** 63, k).astype(np.uint64)
            sets.append(np.unique(own))
        for split in (None, random_.randint(1, len(sets) - 1)):
            links = [(a, b) for a in range(len(sets)) for b in range(a)
                     if (split is None or (a >= split) != (b >= split))
                     and 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))]
            got = jaccard_join.link_block(sets, 80, split)
            assert {(max(x), min(x)) for x in got} <= set(links)
            assert components(range(len(sets)), got) == components(range(len(sets)), links)


def dedup_brute(rows, size=13):
    first, out = {}, {}
    for i, text in rows:
        w = words(text)
        for k in range(len(w) - size + 1):
            key = tuple(w[k:k + size])
            first[key] = min(first.get(key, i), i)
    for i, text in rows:
        w = words(text)
        gone = {j for k in range(len(w) - size + 1) if first[tuple(w[k:k + size])] < i for j in range(k, k + size)}
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot, broadcast", [(1000, 500_000), (3, 500_000), (3, 0)])
def test_substring_dedup(spark, monkeypatch, hot, broadcast):
    levels = (2, min(16, hot), hot)
    monkeypatch.setattr(substring_dedup, "LEVELS", levels)
    monkeypatch.setattr(substring_dedup, "MOST_HOT", broadcast)
    plain = sketch.count_min
    monkeypatch.setattr(substring_dedup, "count_min", lambda *a, **k: plain(*a, levels=levels, **k))
    rows = corpus()
    found = substring_dedup.substring_dedup(table(spark, rows)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found} == dedup_brute(rows)
    assert all(hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256 for r in found)


def test_substring_dedup_odd_ids(spark):
    long = " ".join(f"w{k}" for k in range(15))
    rows = [(None, long), (5, long), (5, long + " and more"), (9, "x " + long), (9, None)]
    got = sorted((str(r.doc_id), r.n_words, r.n_removed) for r in substring_dedup.substring_dedup(table(spark, rows)).collect())
    assert got == [("5", 15, 0), ("5", 17, 0), ("9", 0, 0), ("9", 16, 15), ("None", 15, 0)]


def test_sketch_never_counts_too_low(spark):
    rows = [(i, f"w{i % 50}") for i in range(3000)] + [(i, f"rare{i}") for i in range(500)]
    from hearthline.llm.words import find_words, hash_words
    classes = sketch.count_min(table(spark, rows).select("text"), lambda b: hash_words(find_words(b["text"])), bits=18, rows=2)
    import pyarrow as pa
    for text, least in (("w3", 2), ("rare7", 0)):
        assert classes.of(hash_words(find_words(pa.array([text]))))[0] >= least


def test_hashes_that_occur_once_do_not_fill_the_sketch(spark):
    import pyarrow as pa
    from hearthline.llm.words import find_words, hash_words
    repeated = {"w7": 20, "w8": 2, "w9": 1200}
    rows = [(i, f"once{i}") for i in range(400_000)] + [(i, w) for w, n in repeated.items() for i in range(n)]
    docs, of = table(spark, rows, extra=False).select("text"), lambda b: hash_words(find_words(b["text"]))
    classes = sketch.count_apart(docs, of, len(rows), bits=18)
    got = dict(zip(repeated, classes.of(of({"text": pa.array(list(repeated))}))))
    assert got == {"w7": 2, "w8": 1, "w9": 3}  # never too low
    once = classes.of(of({"text": pa.array([f"once{i}" for i in range(20_000)])}))
    assert np.mean(once > 0) < 0.1  # 0.8 where all of them share 2**18 cells


@pytest.mark.parametrize("held, part", [(1 << 20, 1 << 19), (50, 20)])
def test_stars_connect_sets_by_token_and_class(spark, monkeypatch, held, part):
    monkeypatch.setattr(jaccard_join, "TOKENS", held)
    monkeypatch.setattr(jaccard_join, "PART_TOKENS", part)
    rng = random.Random(5)
    sets = [(k + 10, rng.randrange(6), [rng.randrange(-200, 200) for _ in range(rng.randrange(4))]) for k in range(150)]
    sets = [(k, c, sorted(set(t) | ({7} if k % 3 == 0 else set()))) for k, c, t in sets]  # one token that very many share
    links = [(a, b) for a, c, t in sets for b, d, u in sets if a < b and abs(c - d) <= 1 and set(t) & set(u)]
    df = spark.createDataFrame(sets, "node long, class int, tokens array<long>").repartition(3)
    got = [(r.a, r.b) for r in jaccard_join._stars(df).collect()]
    assert all(a != b for a, b in got)
    assert components([k for k, *_ in sets], got) == components([k for k, *_ in sets], links)
    assert jaccard_join._stars(df.where("node < 0")).count() == 0


def test_jaccard_sends_shared_shingles_once_and_texts_once(spark, monkeypatch):
    """With a sketch that all shingles fill, each token of a set still travels once, packed; and a text only to its key."""
    plans = []
    monkeypatch.setattr(jaccard_join, "connected", lambda e, **k: (plans.append(e._jdf.queryExecution().toString()), connected(e, **k))[1])
    docs = table(spark, corpus()).drop("node", "row", "root", "place", "h1")
    kept = jaccard_join.first_of_each(docs)
    assert "token" in plans[0] and "explode" not in plans[0].lower()
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "<=>" not in plan  # a join on other keys than those of the grouping sends the texts again


def test_connected(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 440)] + [(500, k) for k in range(501, 540)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    assert got == components(nodes, [e for e in edges if e[0] != e[1]])


def test_connected_at_full_parallelism_in_bounded_forests(spark, monkeypatch):
    # each task names its own node: fewer tasks would name fewer
    edges = spark.range(0, 64, 1, 8).selectExpr("id AS a", "cast(1000 + spark_partition_id() AS long) AS b")
    assert len({r.root for r in connected(edges).collect()}) == 8
    monkeypatch.setattr(common, "FOREST_NODES", 1)
    monkeypatch.setattr(common, "PART_EDGES", 50)
    random_ = random.Random(3)
    pairs = [(k, k + 1) for k in range(200)] + [(random_.randrange(1000, 1400), random_.randrange(1000, 1400)) for _ in range(150)]
    parent = {x: x for e in pairs for x in e}
    for a, b in pairs:  # relabelled whole, as no cleverness is needed here
        a, b = parent[a], parent[b]
        parent = {x: min(a, b) if r in (a, b) else r for x, r in parent.items()}
    got = {r.node: r.root for r in connected(spark.createDataFrame(random_.sample(pairs, len(pairs)), "a long, b long")).collect()}
    assert got == {x: r for x, r in parent.items() if any(x in e for e in pairs if e[0] != e[1])}


@pytest.mark.parametrize("kind, block", [("float", 4096), ("double", 7)])
def test_embedding_dedup(spark, monkeypatch, kind, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rng = np.random.default_rng(4)
    base = rng.normal(size=(6, 16))
    rows = [(k, list(map(float, base[k % 6] + rng.normal(0, 0.25, 16)))) for k in range(60)]
    rows += [(100 + k, rows[k % 3][1]) for k in range(9)] + [(200, [2 * x for x in rows[0][1]])]
    rows += [(300, None), (301, []), (302, [0.0] * 16), (303, [None] + [1.0] * 15), (304, [float("nan")] * 16),
             (305, [float("inf")] + [1.0] * 15), (306, [1.0, 2.0]), (None, rows[0][1]), (100, rows[1][1])]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").selectExpr("*", "1 AS node", "'z' AS raw")
    got = embedding_dedup.embedding_dedup(df).collect()

    def vector(x):
        x = np.array([np.nan if v is None else v for v in x or []], np.float32 if kind == "float" else np.float64).astype(float)
        return x if len(x) and np.isfinite(x).all() and x.any() else None
    vectors = [vector(x) for _, x in rows]

    def linked(a, b):
        x, y = vectors[a], vectors[b]
        return x is not None and y is not None and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.9
    n = len(rows)
    links = [(a, b) for a in range(n) for b in range(n) if a != b and linked(a, b)]
    comp = components(range(n), links)
    want = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(n) if comp[j] == comp[k] and rows[j][0] is not None]
        c = min(ids, default=None)
        want.append((i, sum(a == k for a, _ in links), c, i == c))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_empty_tables(spark):
    docs, vectors = table(spark, []), spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert jaccard_join.jaccard_components(docs).count() == 0
    assert substring_dedup.substring_dedup(docs).count() == 0
    assert embedding_dedup.embedding_dedup(vectors).count() == 0

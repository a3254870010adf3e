import random
import zlib

import pytest

from hearthline.llm import kd_shards as kd
from hearthline.llm.kd_shards import kd_shards


def facts(rows):
    ids = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, zlib.crc32((rows[k][1] or "").encode())))
    place = {k: p for p, k in enumerate(ids)}
    rank = lambda c: {v: i for i, v in enumerate(sorted({r[c] for r in rows}, key=lambda v: (v is not None, v or "")))}
    source, lang = rank(2), rank(3)
    return [((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())),
             (len((r[1] or "").encode()) + 1, place[k], source[r[2]], lang[r[3]])) for k, r in enumerate(rows)]


def brute(rows, leaves):
    out, found = [], facts(rows)
    spread = [max(f[1][d] for f in found) - min(f[1][d] for f in found) for d in range(4)]

    def split(items, first, k):
        if k == 1 or not items:
            for slot, (row, _) in enumerate(sorted(items, key=lambda f: f[1][1])):
                out.append((*row, "bytes", first, slot, None))
            return
        width = [(max(f[1][d] for f in items) - min(f[1][d] for f in items)) / spread[d] if spread[d] else 0.0 for d in range(4)]
        d = width.index(max(width))
        total, upto, sides = sum(f[0][1] for f in items), 0, ([], [])
        for f in sorted(items, key=lambda f: (f[1][d], f[1][1])):
            sides[(2 * upto + f[0][1]) * k > 2 * total * (k // 2)].append(f)
            upto += f[0][1]
        split(sides[0], first, k // 2)
        split(sides[1], first + k // 2, k - k // 2)
    split(found, 0, leaves)
    return sorted(out, key=str)


def rows_of(seed=2):
    rng = random.Random(seed)
    rows = [(k, "x é"[:rng.randrange(4)] * rng.randrange(1, 60), rng.choice("aabcd"), rng.choice(["en", "fr", None])) for k in range(300)]
    rows += [(None, None, None, None)] * 150 + [(7, "same text", "hot", "en")] * 100 + [(900, "long " * 900, "a", "fr"), (901, "", "", "en")]
    return rows


@pytest.mark.parametrize("leaves, buckets, nodes", [(8, 4096, 100_000), (5, 3, 0)])
def test_equals_brute_force(spark, monkeypatch, leaves, buckets, nodes):
    monkeypatch.setattr(kd, "BUCKETS", buckets)
    monkeypatch.setattr(kd, "BROADCAST_NODES", nodes)
    monkeypatch.setattr(kd, "RANGE_ROWS", 37)
    rows = rows_of()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").selectExpr("*", "1 AS node", "2 AS size", "'q' AS dimension")
    got = sorted(map(tuple, kd_shards(df.repartition(4), shards=leaves).collect()), key=str)
    assert got == brute(rows, leaves)
    total = [sum(r[1] for r in got if r[4] == s) for s in range(leaves)]
    assert max(total) - min(total) < 4600  # less than the one long document


def test_target_bytes_and_odd_tables(spark):
    schema = "doc_id long, text string, source string, lang string"
    assert kd_shards(spark.createDataFrame([], schema), shards=8).collect() == []
    one = kd_shards(spark.createDataFrame([(3, "abc", None, None)], schema), shards=8).collect()
    assert [(r.doc_id, r.size, r.slot, r.law) for r in one] == [(3, 4, 0, "bytes")]
    many = kd_shards(spark.createDataFrame([(k, "y" * 99, "a", "en") for k in range(40)], schema), target_bytes=1000).collect()
    assert sorted((r.shard, r.slot) for r in many) == [(s, k) for s in range(4) for k in range(10)]
    with pytest.raises(ValueError):
        kd_shards(spark.createDataFrame([], schema))

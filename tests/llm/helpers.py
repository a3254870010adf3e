"""Small tables that hold what real ones hold too: nulls, empty texts, copies, very long texts, odd columns."""

from __future__ import annotations

import random

WORDS = "the of and tree house river stone light under over green seven walk quiet morning paper glass moved often near".split()
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str | None, lower: bool = False) -> list[bytes]:
    return ((text or "").translate(LOWER) if lower else text or "").encode().split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + (str(rng.randrange(40)) if rng.random() < 0.7 else "") for _ in range(n))


def corpus(seed: int = 1) -> list[tuple[int | None, str | None]]:
    rng = random.Random(seed)
    texts: list[str | None] = [None, "", " \n\t ", "one", "One", "two words", "é x y", "\U0001F600 smile \x0b end"]
    passage = prose(rng, 40)
    for _ in range(25):
        texts.append(prose(rng, rng.randrange(20, 120)))
    base = prose(rng, 200)
    for _ in range(20):  # near copies that link by their base more than with each other
        own = base.split()
        for _ in range(rng.randrange(0, 7)):
            own[rng.randrange(len(own))] = f"edit{rng.randrange(1000)}"
        texts.append(" ".join(own))
    texts += [base] * 6 + [prose(rng, 10) + " " + passage + "\n" + prose(rng, 10) for _ in range(8)]
    texts += ["again " * 60, prose(rng, 30_000), "x" * 50_000, " ".join(["line of seven words that comes again"] * 30)]
    order = list(range(100, 100 + len(texts)))
    rng.shuffle(order)
    return list(zip(order, texts))


def table(spark, rows, extra: bool = True):
    """Documents, with columns that have names which operators use inside."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.selectExpr("doc_id", "text", "'a' AS source", "1 AS node", "'x' AS row", "2 AS root", "3 AS place", "4 AS h1") if extra else df


def components(ids, links) -> dict:
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}

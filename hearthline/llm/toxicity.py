"""Toxicity by a weighted grammar of finite-state transducers over clauses.

A clause is read as symbols: insults, threats, targets, negations, reported speech, other words. Four
transducers are composed into one: negation marks an insult soon after a negation, reported speech marks
one after a verb of saying or inside quotation marks, target marks one aimed at somebody, and threat joins
a threatening verb with the target that follows. What the composition writes is weighted and summed over
the matched clauses of a text. Function words are fixed; insults are learned as stems and words, and the
weights of what the grammar writes by logistic regression, both from labelled rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import map_batches, small_batches

SAMPLE = (6000, 12000)  # labelled rows that a fit reads at most: toxic, clean
STEM, LONGEST = 3, 9  # letters of a stem
EVIDENCE = 15.0  # nats by which a part's documents must be toxic more often than others
FOUND = 3000  # stems and words that a fit considers at most, most telling first
HELD_PARTS = 100_000  # stems counted before a task hands them on

# Function words of English, French, German and Spanish, and insults known without labels.
TARGETS = "you your yours he she they him her them tu te toi vous il elle ils elles du dich dir ihr euch er sie usted ustedes vosotros él ella ellos".split()
NEGATIONS = "not no never isn aren don doesn didn wasn n't ne pas jamais nicht kein keine nie niemals nunca jamás tampoco".split()
REPORTS = "said says say wrote writes claimed called quoted reported dit disait écrit appelé sagte sagt schrieb nannte dijo dice escribió llamó".split()
THREATS = "kill hurt destroy beat attack shoot tuer frapper détruire töten schlagen vernichten matar golpear destruir".split()
INSULTS = "idiot moron stupid scum trash loser pathetic disgusting worthless clown imbecile jerk".split()
QUOTES = "\"“”«»„"

NEAR = 3  # words that a negation or a target reaches
WORD = re.compile(rf"[^\W\d_]+|[{QUOTES}]")
CLAUSE_END = re.compile(r"[.!?;\n]")
NO_LETTER = re.compile(r"[^\w ]|[\d_]")  # any but the space; what WORD takes for a letter is neither


class Transducer:
    """Arcs (state, symbol) -> (state, written symbol); a symbol without an arc is copied, from state to ``rest[state]``."""

    def __init__(self, arcs: dict, rest: dict):
        self.arcs, self.rest = arcs, rest

    def step(self, state, symbol: str):
        return self.arcs.get((state, symbol)) or (self.rest.get(state, state), symbol)


class Composed:
    """The composition: each transducer reads what the one before has written. Steps are worked out once."""

    def __init__(self, *parts: Transducer):
        self.parts, self.steps = parts, {}

    def run(self, symbols: list[str]) -> list[str]:
        state, out = (0,) * len(self.parts), []
        for symbol in symbols:
            key = state, symbol
            if key not in self.steps:
                states, written = [], symbol
                for part, s in zip(self.parts, state):
                    s, written = part.step(s, written)
                    states.append(s)
                self.steps[key] = tuple(states), written
            state, written = self.steps[key]
            out.append(written)
        return out


def grammar() -> Composed:
    """Written symbols: I, then n if negated, r if reported, a if aimed; A for a target after an insult; X for a threat."""
    fades = {k: (k + 1) % (NEAR + 1) for k in range(1, NEAR + 1)}
    negation = Transducer({(k, "N"): (1, "N") for k in range(NEAR + 1)} | {(k, "I"): (k, "In") for k in fades}, fades)
    insults = ("I", "In")
    report = Transducer({(0, "R"): (1, "R"), (0, "Q"): (2, "Q"), (2, "Q"): (0, "Q")}
                        | {(k, i): (k, i + "r") for k in (1, 2) for i in insults}, {})
    insults += tuple(i + "r" for i in insults)
    target = Transducer({(k, "T"): (1, "T") for k in range(NEAR + 1)} | {(k, i): (k, i + "a") for k in fades for i in insults}
                        | {(0, i): (-1, i) for i in insults} | {(-k, "T"): (1, "A") for k in range(1, NEAR + 1)}
                        | {(-k, i): (-1, i) for k in range(1, NEAR + 1) for i in insults},
                        fades | {-k: -k - 1 if k < NEAR else 0 for k in range(1, NEAR + 1)})
    threat = Transducer({(k, "H"): (1, "H") for k in range(NEAR + 1)} | {(k, t): (0, "X") for k in fades for t in ("T", "A")}, fades)
    return Composed(negation, report, target, threat)


WRITTEN = [i + n + r + a for i in "I" for n in ("", "n") for r in ("", "r") for a in ("", "a")] + ["A", "X"]
FEATURES = [*WRITTEN, "sum", "most", "hits", "distinct", "rate", "short"]


@dataclass
class Lexicon:
    """Weights of stems (of words that begin so) and of whole words."""

    stems: dict[str, float]
    words: dict[str, float]

    def weight(self, word: str) -> float:
        found = self.words.get(word, 0.0)
        for k in range(STEM, min(len(word), LONGEST) + 1):
            found = max(found, self.stems.get(word[:k], 0.0))
        return found


class Scorer:
    """Features of texts, and scores once it has weights."""

    def __init__(self, lexicon: Lexicon, weights: np.ndarray | None = None):
        self.lexicon, self.weights = lexicon, weights
        self.fixed = {w: s for s, ws in (("T", TARGETS), ("N", NEGATIONS), ("R", REPORTS), ("H", THREATS)) for w in ws}
        self.machine = None

    def _start(self) -> None:
        import ahocorasick
        self.grammar, self.machine = grammar(), ahocorasick.Automaton()
        for stem in {*self.lexicon.stems, *self.lexicon.words, *THREATS}:
            self.machine.add_word(" " + stem, len(stem))
        self.machine.make_automaton()

    def features(self, text: str | None) -> np.ndarray:
        """Counts of what the grammar writes in the clauses with an insult or a threat, and sums of their weights."""
        if self.machine is None:
            self._start()
        out, low, done, weights, words = Counter(), "\n" + (text or "").lower(), -1, [], set()
        for end, size in self.machine.iter(NO_LETTER.sub(" ", low)):  # a word may follow whatever is no letter
            at = end - size + 1
            if at < done:
                continue
            begin = max(low.rfind(c, 0, at) for c in ".!?;\n") + 1
            stop = CLAUSE_END.search(low, at)
            done = stop.start() if stop else len(low)
            tokens = WORD.findall(low, begin, done)
            own = [self.lexicon.weight(t) for t in tokens]
            symbols = ["I" if w > 0 else "Q" if t in QUOTES else self.fixed.get(t, "o") for t, w in zip(tokens, own)]
            if "I" not in symbols and "H" not in symbols:
                continue
            for symbol, t, w in zip(self.grammar.run(symbols), tokens, own):
                if symbol in ("A", "X"):
                    out[symbol] += 1
                elif symbol[0] == "I":
                    out[symbol] += w
                    weights.append(w)
                    words.add(t)
        size = len(low) / 6 + 1
        row = [math.log1p(out[s]) for s in WRITTEN] + [
            math.log1p(sum(weights)), max(weights, default=0.0), math.log1p(len(weights)), math.log1p(len(words)),
            math.log1p(1000 * sum(weights) / size), 1 / math.sqrt(size)]
        return np.array(row)

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.weights[:-1] + self.weights[-1], -30, 30)))


def _parts(text: str | None) -> set[str]:
    """The stems of a text, and its words ending in $."""
    words = set(re.findall(r"[^\W\d_]+", (text or "").lower()))
    return {w + "$" for w in words if len(w) >= STEM} | {w[:k] for w in words for k in range(STEM, min(len(w), LONGEST) + 1)}


def _learn_lexicon(rows: DataFrame) -> Lexicon:
    """Stems and words that tell toxic rows (text, toxic) from clean ones: from document frequencies, counted on the cluster."""

    def counted(n: dict[str, int]) -> pa.RecordBatch:
        both = np.fromiter(n.values(), np.int64, len(n))
        return pa.RecordBatch.from_pydict({"part": pa.array(list(n), pa.string()), "clean": both & 0xFFFFFFFF, "toxic": both >> 32})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[str, int] = {}  # clean ones, and toxic ones from bit 32 on
        for b in batches:
            for text, toxic in zip(b["text"].to_pylist(), b["toxic"].to_pylist()):
                one = 1 << 32 if toxic else 1
                for part in _parts(text):
                    n[part] = n.get(part, 0) + one
                if len(n) >= HELD_PARTS:
                    yield counted(n)
                    n = {}
        yield counted(n)
    totals = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    share, base = (F.col("toxic") + 0.01) / (F.col("toxic") + F.col("clean") + 0.02), (toxic + 1) / (toxic + clean + 2)
    evidence = (F.col("toxic") + F.col("clean")) * (share * F.log(share / base) + (1 - share) * F.log((1 - share) / (1 - base)))
    found = (rows.select("text", "toxic").mapInArrow(count, "part string, clean long, toxic long").groupBy("part")
             .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
             .withColumn("odds", odds).withColumn("evidence", evidence).where((odds > math.log(8)) & (evidence > EVIDENCE))
             .orderBy(F.desc("evidence"), "part").limit(FOUND).collect())
    best = {r.part: (r.toxic, r.odds) for r in found}
    stems: dict[str, float] = {}
    words = {w: 3.0 for w in INSULTS}
    for part in sorted(best, key=lambda p: (len(p), p)):
        n, odds = best[part]
        if part.endswith("$"):
            words[part[:-1]] = max(words.get(part[:-1], 0.0), odds)
            continue
        longer = [p for p in best if len(p) == len(part) + 1 and p.startswith(part) and p[-1] != "$"]
        if not any(best[p][0] >= 0.97 * n for p in longer):  # else the longer stem says as much
            stems[part] = odds
    return Lexicon(stems, words)


def _fit_weights(features: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, both labels with the same total weight, a small ridge."""
    x = np.column_stack([features, np.ones(len(features))])
    share = np.where(toxic == 1, 0.5 / max(1, toxic.sum()), 0.5 / max(1, (1 - toxic).sum())) * len(toxic)
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], 0.1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (share * p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (share * (toxic - p)) - ridge * w)
        w += step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, sample: tuple[int, int] = SAMPLE) -> Scorer:
    """Learn from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic).

    At most ``sample`` toxic and clean ids are taken, by a hash of doc_id, and of each id one text, the least
    of its rows: repeated ids add nothing. Without both kinds of labels the fixed insults and threats
    decide. Rows without text or with another label do not count.
    """
    spark = small_batches(docs.sparkSession)
    known = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    few = None
    for toxic, most in zip((1, 0), sample):
        part = known.where(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        few = part if few is None else few.union(part)
    rows = docs.select("doc_id", "text").join(F.broadcast(few), "doc_id").where("text IS NOT NULL")
    rows = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic")
    lexicon = _learn_lexicon(rows)
    scorer = spark.sparkContext.broadcast(Scorer(lexicon))

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"toxic": b["toxic"], "features": pa.array(
            [scorer.value.features(t) for t in b["text"].to_pylist()], pa.list_(pa.float64()))})
    found = map_batches(rows, batch, "toxic int, features array<double>").collect()  # at most ``sample`` short rows
    toxic = np.array([r.toxic for r in found])
    if len(set(toxic.tolist())) < 2:
        weights = np.zeros(len(FEATURES) + 1)
        weights[[FEATURES.index("hits"), FEATURES.index("X"), -1]] = 4.0, 4.0, -2.0
    else:
        weights = _fit_weights(np.array([r.features for r in found]), toxic)
    return Scorer(lexicon, weights)


def score(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """(doc_id, score) for each row of ``docs`` (doc_id, text), score from 0 to 1.

    A null text counts as empty; texts without a matched clause have the lowest scores. Null and repeated
    ids are kept as they are; other columns are ignored.
    """
    shared = small_batches(docs.sparkSession).sparkContext.broadcast(scorer)

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([shared.value.features(t) for t in b["text"].to_pylist()])
        return pa.RecordBatch.from_pydict({"doc_id": b["doc_id"], "score": shared.value.scores(found)})
    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), batch, "doc_id long, score double")


def below(docs: DataFrame, scorer: Scorer, limit: float) -> DataFrame:
    """The rows of ``docs`` (text and any other columns) that score below ``limit``; only texts go to Python, only scores come back."""
    shared = small_batches(docs.sparkSession).sparkContext.broadcast(scorer)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(shared.value.scores(np.array([shared.value.features(t) for t in texts.to_pylist()])))
    return docs.where(scored("text") < limit)


HELD_OUT = "coalesce(crc32(cast(cast(doc_id AS string) AS binary)) % 3 = 1, false)"


def toxicity(docs: DataFrame, labels: DataFrame, least: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted): fitted without the held-out third of the labels, applied to all of ``docs``.

    A null doc_id is held out of nothing and has no label.
    """
    scorer = fit(docs, labels.where(f"NOT {HELD_OUT}"))
    return score(docs, scorer).select("doc_id", F.expr(HELD_OUT).alias("held_out"), "score",
                                      (F.col("score") >= least).cast("int").alias("predicted"))

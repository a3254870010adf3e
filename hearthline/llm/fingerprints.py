"""Document fingerprints by consistent weighted sampling.

For each term of weight w and each sample there are gamma(2, 1) variates r and c and a uniform b, all
fixed by the term's hash. With t = floor(ln w / r + b) and y = exp(r (t - b)), the sample of a document
is the term (and its t) of least c / (y exp(r)). Two documents have the same sample with the probability
of their generalised Jaccard similarity, sum of least weights by sum of largest weights.

A term's weight is how often it occurs, so values are worked out once for each distinct term and weight of
a batch and then only gathered and compared for each document.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import small_batches
from hearthline.llm.words import find_words, hash_words, mix, stream

SAMPLES = 64
SLICE = 50_000  # distinct terms whose variates are worked out at once
KEPT = 60_000  # terms whose values a Python worker keeps: 4 bytes a sample
EMPTY = 0xFFFF  # the sample of a document without terms


class Sampler:
    """Signatures of texts: 16 bits for each sample."""

    def __init__(self, samples: int = SAMPLES, seed: int = 0):
        self.samples, self.seeds = samples, stream(1000 + seed, 2 * samples).reshape(2, samples)
        self.known = np.zeros(0, np.uint64)
        self.kept = np.zeros((0, samples), np.float32)

    def _shape(self, terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """r, b and t of hashes, a column for each sample; the variates are parts of one mixed hash."""
        bits = mix(terms + self.seeds[0])
        u, v, b = (((bits >> np.uint64(k)) & np.uint64(0x1FFFFF)).astype(np.float32) + np.float32(0.5) for k in (43, 22, 1))
        r = np.float32(42 * math.log(2)) - np.log(u) - np.log(v)
        b *= np.float32(2.0 ** -21)
        return r, b, np.floor(np.log(weights.astype(np.float32)) / r + b)

    def _values(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The logarithm of each sample's value for each term of its weight."""
        r, b, t = self._shape(terms[:, None], weights[:, None])
        bits = mix(terms[:, None] + self.seeds[1])
        u, v = ((x.astype(np.float32) + np.float32(0.5)) for x in (bits >> np.uint64(32), bits & np.uint64(0xFFFFFFFF)))
        c = np.float32(64 * math.log(2)) - np.log(u) - np.log(v)
        return np.log(np.maximum(c, np.float32(1e-30))) - r * (t - b + 1)

    def _looked_up(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        out = np.empty((len(terms), self.samples), np.float32)
        key = mix(terms + weights.astype(np.uint64))
        at = np.minimum(np.searchsorted(self.known, key), max(0, len(self.known) - 1))
        hit = self.known[at] == key if len(self.known) else np.zeros(len(key), bool)
        out[hit] = self.kept[at[hit]]
        new = np.flatnonzero(~hit)
        for k in range(0, len(new), SLICE):
            out[new[k:k + SLICE]] = self._values(terms[new[k:k + SLICE]], weights[new[k:k + SLICE]])
        return out

    def _keep(self, terms: np.ndarray, weights: np.ndarray, values: np.ndarray, uses: np.ndarray) -> None:
        if len(self.known) < KEPT and len(terms):
            most = np.argsort(-uses, kind="stable")[:KEPT]
            key = mix(terms[most] + weights[most].astype(np.uint64))
            order = np.argsort(key)
            self.known, self.kept = key[order], values[most][order]

    def signatures(self, texts: pa.Array) -> np.ndarray:
        words = find_words(texts)
        hashes, n = hash_words(words, lower=True), len(texts)
        order = np.argsort(hashes)
        order = order[np.argsort(words.doc[order].astype(np.uint32), kind="stable")]
        doc, hashes = words.doc[order], hashes[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
        begin = np.flatnonzero(new)
        doc, hashes, weight = doc[begin], hashes[begin], np.diff(begin, append=len(new))
        out = np.full((n, self.samples), EMPTY, np.uint16)
        if not len(doc):
            return out
        key = mix(hashes + weight.astype(np.uint64))
        _, pick, back, uses = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        values = self._looked_up(hashes[pick], weight[pick])
        self._keep(hashes[pick], weight[pick], values, uses)
        first = np.searchsorted(doc, np.arange(n + 1))
        some = np.flatnonzero(np.diff(first))
        least = np.stack([first[k] + np.argmin(values[back[first[k]:first[k + 1]]], axis=0) for k in some])
        # a sample is the term with its t; the weight enters by t only
        _, _, t = self._shape(hashes[least], weight[least])
        names = mix(hashes[least] ^ (t.astype(np.int64).astype(np.uint64) << np.uint64(1)))
        out[some] = (names % np.uint64(EMPTY)).astype(np.uint16)
        return out


@cache
def _sampler(samples: int, seed: int) -> Sampler:
    """One for each Python worker, which keeps it from task to task."""
    return Sampler(samples, seed)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=1)


def _hex(signatures: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in signatures.astype(">u2")]


def fingerprint(docs: DataFrame, samples: int = SAMPLES, seed: int = 0) -> DataFrame:
    """(doc_id, fingerprint) for each row of ``docs`` (doc_id, text); ``samples`` 16-bit samples in hexadecimal.

    Terms are words without ASCII white space, A-Z lower-cased, weighted by how often they occur. Equal
    texts have equal fingerprints; a null text counts as empty, and texts without words have all samples
    ffff. The share of equal samples of two fingerprints estimates their generalised Jaccard similarity.
    Null and repeated ids are kept as they are; other columns are ignored.
    """
    small_batches(docs.sparkSession)

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in found:
            yield pa.RecordBatch.from_pydict({"doc_id": b["doc_id"], "fingerprint": _hex(_sampler(samples, seed).signatures(b["text"]))})
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        batches, "doc_id long, fingerprint string")


def in_order(docs: DataFrame) -> DataFrame:
    """(part, extra, doc_id, text): ranges of ids, each sorted by descending id, and closed by the row that follows it.

    A row with extra only tells what follows the last one of its part. After the smallest id comes the
    largest. Null ids come last, equal ids by descending text. Only the ends of the ranges come to the
    driver, one for each shuffle partition.
    """
    spark, docs = docs.sparkSession, docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ends = docs.agg(F.percentile_approx("doc_id", [k / ranges for k in range(1, ranges)] or [1.0], 100 * ranges)).first()[0]
    ends = ", ".join(f"{x}L" for x in sorted(set(ends or []))) if ranges > 1 else ""
    # part 0 has the largest ids
    after = f"size(filter(array({ends}), x -> x > doc_id))" if ends else "0"
    parted = docs.withColumn("part", F.expr(f"CASE WHEN doc_id IS NULL THEN {ranges} ELSE {after} END"))
    tops = sorted((r.part, r.top) for r in parted.groupBy("part").agg(F.max("doc_id").alias("top")).collect())
    table = spark.createDataFrame([(top, tops[k - 1][0]) for k, (_, top) in enumerate(tops)], "top long, before int")
    extra = parted.join(F.broadcast(table), F.col("doc_id").eqNullSafe(F.col("top"))).selectExpr(
        "before AS part", "true AS extra", "doc_id", "text")
    rows = parted.selectExpr("part", "false AS extra", "doc_id", "text").union(extra)
    return (rows.repartitionById(ranges, F.col("part").cast("int"))  # a range is a partition
            .sortWithinPartitions("part", "extra", F.desc_nulls_last("doc_id"), F.desc_nulls_last("text")))


def edited_likeness(docs: DataFrame, samples: int = SAMPLES, seed: int = 0) -> DataFrame:
    """Fingerprints of each row of ``docs`` (doc_id, text) and of its edited text.

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next). The edited
    text is the text with its last third (rounded down, in code points) replaced by as many code points from
    the beginning of the next document, or all of it if it is shorter. The next document has the next
    smaller doc_id (null ids last; equal ids by descending text), after the last one the first, which may be
    the document itself. near_edited and near_next are the shares of samples equal to those of the edited
    text and of the next document. A null text counts as empty. Other columns are ignored.
    """
    small_batches(docs.sparkSession)

    def rows(found: list[tuple]) -> pa.RecordBatch | None:
        """Of (part, extra, doc_id, text): all but the last, which only follows."""
        texts = [t or "" for _, _, _, t in found]
        own = [k for k in range(len(found) - 1) if not found[k][1]]
        if not own:
            return None
        edited = [texts[k][:len(texts[k]) - len(texts[k]) // 3] + texts[k + 1][:len(texts[k]) // 3] for k in own]
        sampler = _sampler(samples, seed)
        every = sampler.signatures(pa.array(texts + edited, pa.large_string()))
        plain, changed = every[:len(texts)], every[len(texts):]
        here = plain[own]
        return pa.RecordBatch.from_pydict({
            "doc_id": pa.array([found[k][2] for k in own], pa.int64()),
            "n_chars": pa.array([len(texts[k]) for k in own], pa.int64()),
            "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in edited],
            "fingerprint": _hex(here), "edited_fingerprint": _hex(changed),
            "near_edited": likeness(here, changed), "near_next": likeness(here, plain[np.array(own) + 1])})

    def batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for b in batches:
            held += zip(*(b[c].to_pylist() for c in ("part", "extra", "doc_id", "text")))
            if (out := rows(held)) is not None:
                yield out
            held = held[-1:]
    return in_order(docs).mapInArrow(batches, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                     "edited_fingerprint string, near_edited double, near_next double")

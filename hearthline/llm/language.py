"""Language of texts by a convolutional network over bytes, trained in numpy.

Bytes are folded into classes (letters in either case, one class for digits, white space and marks, each
byte of longer UTF-8 characters its own) and embedded. Filters of several widths run over windows of fixed
length; the largest response of each filter in a window goes through a rectifier and a softmax layer. A
text's score is the mean over its windows, weighted by their letters.

To predict, embedding and filters are multiplied out into tables for classes and pairs of classes, so a
filter of width four costs two look-ups at a place.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import map_batches, small_batches
from hearthline.llm.words import stream, text_bytes

WINDOW = 256  # bytes
WIDTHS = (2, 3, 4)
FILTERS = 16  # of each width
EMBEDDED = 8
SAMPLE = 2500  # labelled texts of a language that a fit reads, about
CUTS = (256, 256, 96, 32, 12)  # lengths of the training windows of a text
EPOCHS, BATCH, RATE = 8, 256, 4e-3
SLICE = 512  # windows at once
UNKNOWN = "und"


def _fold() -> tuple[np.ndarray, int]:
    """The class of each byte; class 0 is white space and what lies beyond a text."""
    fold = np.full(256, 2)
    fold[:33] = 0
    fold[48:58] = 1
    fold[65:91] = fold[97:123] = np.arange(3, 29)
    fold[128:] = np.arange(29, 157)
    return fold.astype(np.uint8), 157


CLASS, CLASSES = _fold()
LETTERS = np.array([3 <= c for c in CLASS])


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray  # classes x EMBEDDED
    filters: list[np.ndarray]  # for each width: width x EMBEDDED x FILTERS
    bias: list[np.ndarray]
    out: np.ndarray  # (widths * FILTERS) x languages
    shift: np.ndarray

    def tables(self) -> list[list[np.ndarray]]:
        """For each width the look-up tables: of pairs of classes, then of one class if the width is odd."""
        found = []
        for w in self.filters:
            one = [self.embedding @ w[k] for k in range(len(w))]
            pairs = [(one[k][:, None] + one[k + 1][None]).reshape(-1, w.shape[2]) for k in range(0, len(w) - 1, 2)]
            found.append([x.astype(np.float32) for x in pairs + one[len(one) - len(one) % 2:]])
        return found

    def pooled(self, windows: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
        """The largest response of each filter in windows of classes."""
        pairs = windows[:, :-1].astype(np.int32) * CLASSES + windows[:, 1:]
        out = []
        for w, bias, table in zip(self.filters, self.bias, tables):
            places = windows.shape[1] - len(w) + 1
            total = None
            for k, t in enumerate(table):
                index = (pairs if len(t) > CLASSES else windows)[:, 2 * k:2 * k + places]
                total = t[index] if total is None else np.add(total, t[index], out=total)
            out.append(total.max(1) + bias)
        return np.maximum(np.concatenate(out, 1), 0)

    def probabilities(self, pooled: np.ndarray) -> np.ndarray:
        z = pooled @ self.out + self.shift
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def train(windows: np.ndarray, target: np.ndarray, languages: list[str], seed: int = 0) -> Network:
    """Adam on the cross entropy. Only the places of the largest responses pass a gradient on."""
    rng = np.random.default_rng(seed)
    net = Network(languages, rng.normal(0, 0.5, (CLASSES, EMBEDDED)),
                  [rng.normal(0, (2 / (w * EMBEDDED)) ** 0.5, (w, EMBEDDED, FILTERS)) for w in WIDTHS],
                  [np.zeros(FILTERS) for _ in WIDTHS],
                  rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(languages))), np.zeros(len(languages)))
    values = [net.embedding, *net.filters, *net.bias, net.out, net.shift]
    first, second, step = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(windows))
        for a in range(0, len(order), BATCH):
            x, y = windows[order[a:a + BATCH]], target[order[a:a + BATCH]]
            n, rows = len(x), np.arange(len(x))[:, None]
            embedded = net.embedding[x].astype(np.float32)
            pooled, places = [], []
            for w, bias in zip(net.filters, net.bias):
                size = x.shape[1] - len(w) + 1
                total = sum(embedded[:, k:k + size] @ w[k].astype(np.float32) for k in range(len(w)))
                places.append(total.argmax(1))
                pooled.append(np.take_along_axis(total, places[-1][:, None], 1)[:, 0] + bias)
            hidden = np.maximum(np.concatenate(pooled, 1), 0)
            wrong = net.probabilities(hidden)
            wrong[np.arange(n), y] -= 1
            wrong /= n
            back = (wrong @ net.out.T) * (hidden > 0)
            slopes = [np.zeros_like(net.embedding)]
            for k, w in enumerate(net.filters):
                g = back[:, k * FILTERS:(k + 1) * FILTERS]
                slope = np.zeros_like(w)
                for i in range(len(w)):
                    cls = x[rows, places[k] + i]
                    slope[i] = np.einsum("bfe,bf->ef", net.embedding[cls], g)
                    np.add.at(slopes[0], cls, g[:, :, None] * w[i].T[None])
                slopes.append(slope)
            slopes += [back[:, k * FILTERS:(k + 1) * FILTERS].sum(0) for k in range(len(net.bias))]
            slopes += [hidden.T @ wrong + 1e-4 * net.out, wrong.sum(0)]
            step += 1
            rate = RATE * (1 - step / (EPOCHS * -(-len(order) // BATCH) + 1))
            for v, m, s, g in zip(values, first, second, slopes):
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                v -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-8)
    return net


def _windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(windows of bytes, row of each): all of every text, the last window filled up with spaces."""
    size = np.diff(offsets)
    n = -(-size // WINDOW)
    row = np.repeat(np.arange(len(size)), n)
    begin = offsets[:-1][row] + (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)) * WINDOW
    index = begin[:, None] + np.arange(WINDOW)
    inside = index < offsets[1:][row][:, None]
    found = np.where(inside, data[np.minimum(index, max(0, len(data) - 1))], 32) if len(row) else np.zeros((0, WINDOW), np.uint8)
    return found.astype(np.uint8), row


def fit(docs: DataFrame, sample: int = SAMPLE) -> Network | None:
    """Learn from ``docs`` (doc_id, text, lang), rows without text or lang left out.

    About ``sample`` texts of each language are read, by a hash of doc_id and text, and of each a few
    windows of different lengths; only these windows come to the driver. Rows alike in all three count
    once among them. None where there is nothing to learn from.
    """
    small_batches(docs.sparkSession)
    known = docs.select("doc_id", "text", "lang").where("lang IS NOT NULL AND text IS NOT NULL AND text RLIKE '\\\\p{L}'")
    counts = {r.lang: r["count"] for r in docs.where("lang IS NOT NULL").groupBy("lang").count().collect()}
    if not counts:
        return None
    share = F.create_map(*(x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, sample / n)))))
    place = F.pmod(F.xxhash64("doc_id", F.substring("text", 1, 64)), F.lit(1 << 20)) / (1 << 20)
    few = known.where(place < share[F.col("lang")]).distinct().select("text", "lang")

    def cut(b: pa.RecordBatch) -> pa.RecordBatch:
        out, lang = [], []
        data, offsets = text_bytes(b["text"])
        for k in range(b.num_rows):
            own = data[offsets[k]:offsets[k + 1]]
            where = stream(int(own.sum()) & 0xFFFFFF, len(CUTS)).astype(np.float64) / 2.0 ** 64
            for part, size in zip(where, CUTS):
                at = int(part * max(1, len(own) - size + 1))
                piece = own[at:at + size]
                if LETTERS[piece].sum() >= 3:
                    out.append(piece.tobytes().ljust(WINDOW))
                    lang.append(b["lang"][k].as_py())
        return pa.RecordBatch.from_pydict({"bytes": pa.array(out, pa.binary()), "lang": pa.array(lang, pa.string())})
    found = sorted((r.lang, bytes(r.bytes)) for r in map_batches(few, cut, "bytes binary, lang string").collect())
    if not found:
        return None
    languages = sorted(counts)
    windows = CLASS[np.frombuffer(b"".join(x for _, x in found), np.uint8).reshape(-1, WINDOW)]
    return train(windows, np.array([languages.index(x) for x, _ in found]), languages)


def predict(docs: DataFrame, network: Network | None) -> DataFrame:
    """(doc_id, lang_pred, score) for each row of ``docs`` (doc_id, text), score from 0 to 1.

    All of a text is read. A text that is null or has no letter is ``und`` with score 0. Null and repeated
    ids are kept as they are; other columns are ignored. Without a network every text is ``und``.
    """
    if network is None:
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = small_batches(docs.sparkSession).sparkContext.broadcast(network)
    tables: list = []

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        net = shared.value
        tables[:] = tables or net.tables()
        windows, row = _windows(*text_bytes(b["text"]))
        total, weight = np.zeros((b.num_rows, len(net.languages))), np.zeros(b.num_rows)
        for a in range(0, len(windows), SLICE):
            part, own = windows[a:a + SLICE], row[a:a + SLICE]
            letters = LETTERS[part].sum(1)
            p = net.probabilities(net.pooled(CLASS[part], tables))
            np.add.at(total, own, p * letters[:, None])
            np.add.at(weight, own, letters)
        some = weight > 0
        for k in np.flatnonzero(some):  # bytes of longer characters need not be letters
            some[k] = _has_letter(b["text"][k].as_py())
        best = total.argmax(1)
        score = np.where(some, total[np.arange(len(best)), best] / np.maximum(weight, 1), 0.0)
        return pa.RecordBatch.from_pydict({
            "doc_id": b["doc_id"], "lang_pred": [net.languages[k] if s else UNKNOWN for k, s in zip(best, some)],
            "score": pa.array(np.clip(score, 0, 1))})
    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), batch,
                       "doc_id long, lang_pred string, score double")


def _has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


HELD_OUT = "coalesce(crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0, false)"


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): fitted without a held-out fifth of the ids, applied to all of ``docs``.

    A null doc_id is not held out.
    """
    return predict(docs, fit(docs.where(f"NOT {HELD_OUT}"))).selectExpr("doc_id", f"{HELD_OUT} AS held_out", "lang_pred", "score")

"""Pack token sequences: first-fit decreasing over a tournament tree, in randomised groups of documents.

Whole multiples of the sequence length are sequences of their own as soon as a document is tokenised;
only remainders, each shorter than a sequence, travel to their group. So a group is small however long
its documents are. After first-fit decreasing, the emptiest sequences of a group are cut up to fill the
gaps of the others, and the last one is split at powers of two, which need no padding.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import cache, lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import in_pieces, small_batches
from hearthline.llm.words import mix

GROUP_DOCS = 1024  # documents of a group, about
CACHED_BYTES = 64 << 20  # of distinct words whose ids a Python worker keeps
WORD_BYTES = 200  # that a kept word takes besides its own
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")


def _byte_chars() -> dict[int, int]:
    """The characters that byte-level vocabularies write for bytes: printable ones as they are, the rest from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: 256 + k for k, b in enumerate(hidden)}


BYTE_CHARS = _byte_chars()


class WordTokens:
    """Token ids of texts by a tokenizer that never joins across ASCII white space.

    Each distinct word is encoded once a piece of a batch, the first ``CACHED_BYTES`` of them once a worker.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.encoder = Tokenizer.from_file(path)
        self.mark = lru_cache(10_000)(self._ids)
        self.lower = self._ids("ABC ÉA z") == self._ids("abc Éa z")
        self.plain = self._splits_plainly()
        self.known: dict[bytes, int] = {}
        self.size = 0
        self.ids, self.at = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _ids(self, word: str) -> list[int]:
        return self.encoder.encode(word, add_special_tokens=False).ids

    def _plain_ids(self, word: str) -> list[int]:
        if not word.isascii():
            word = word.lower().encode().decode("latin-1").translate(BYTE_CHARS)
        return [t.id for t in self.encoder.model.tokenize(word)]

    def _splits_plainly(self) -> bool:
        """Whether a Latin word is one unit of the vocabulary model, apart from ASCII marks after it."""
        return self.lower and all(self._ids(w + m) == self._plain_ids(w) + (self._ids(m) if m else [])
                                  for w in ("the", "Éléonore", "ünßþÿ", "straße", "niño", "x") for m in ("", ".", "!?,", "'", "%%%", "_"))

    def _encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found: list[list[int] | None] = []
        for word in words:
            plain = self.plain and PLAIN.fullmatch(word.decode())
            found.append(self._plain_ids(plain[1]) + (self.mark(plain[2]) if plain[2] else []) if plain else None)
        other = [k for k, x in enumerate(found) if x is None]
        for k, x in zip(other, self.encoder.encode_batch_fast([words[k].decode() for k in other], add_special_tokens=False)):
            found[k] = x.ids
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), np.cumsum(sizes)

    def batch(self, texts: list[str | None], end: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first): the ids of all texts with ``end`` after each, and where each text's begin."""
        split = [x.lower().split() if self.lower and b"<|" not in x else x.split() for x in ((t or "").encode() for t in texts)]
        words = [w for x in split for w in x]
        index = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(index < 0)
        lost = [words[k] for k in missing.tolist()]
        ids, at = self.ids, self.at
        if lost:
            new = list(dict.fromkeys(lost))
            more, ends = self._encode(new)
            ids, at = np.concatenate([ids, more]), np.concatenate([at, at[-1] + ends])
            places = {w: len(self.at) - 1 + k for k, w in enumerate(new)}
            size = sum(map(len, new)) + WORD_BYTES * len(new)
            if self.size + size <= CACHED_BYTES:
                self.known.update(places)
                self.ids, self.at, self.size = ids, at, self.size + size
            index[missing] = np.fromiter(map(places.__getitem__, lost), np.int64, len(lost))
        size = at[index + 1] - at[index]
        total = np.cumsum(size)
        flat = ids[np.arange(int(size.sum())) + np.repeat(at[index] - total + size, size)]
        counts = np.fromiter(map(len, split), np.int64, len(split))
        ends = np.concatenate([[0], total])[np.cumsum(counts)]
        return np.insert(flat, ends, end), np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])


@cache
def _word_tokens(path: str) -> WordTokens:
    """One for each Python worker, which keeps it from task to task."""
    return WordTokens(path)


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """The indices of the items of each bin. The tree's nodes hold the most room of any bin below."""
    leaves = 1 << max(0, (len(sizes) - 1).bit_length())
    tree = [capacity] * (2 * leaves)
    bins: list[list[int]] = []
    for item in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] < sizes[item]:
                node += 1
        if node - leaves == len(bins):
            bins.append([])
        bins[node - leaves].append(item)
        tree[node] -= sizes[item]
        while node > 1:
            node //= 2
            tree[node] = max(tree[2 * node], tree[2 * node + 1])
    return bins


def pack_group(sizes: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (item, from, to): all but the last few are full, and those are powers of two long."""
    bins = [[(k, 0, sizes[k]) for k in x] for x in first_fit_decreasing(sizes, capacity)]
    room = [capacity - sum(b - a for _, a, b in x) for x in bins]
    order = sorted(range(len(bins)), key=lambda k: (room[k], k))
    i, j = 0, len(order) - 1
    while i < j:
        into, out = order[i], order[j]
        if not room[into]:
            i += 1
        elif not bins[out]:
            j -= 1
        else:
            k, a, b = bins[out].pop()
            cut = max(a, b - room[into])
            if cut > a:
                bins[out].append((k, a, cut))
            bins[into].append((k, cut, b))
            room[into] -= b - cut
            room[out] += b - cut
    done = [x for x in bins if x]
    last = order[j] if order and bins[order[j]] and room[order[j]] else None
    if last is not None:
        done.remove(bins[last])
        rest, left = list(bins[last]), capacity - room[last]
        while left:
            need, own = 1 << (left.bit_length() - 1), []
            left -= need
            while need:
                k, a, b = rest.pop(0)
                take = min(need, b - a)
                own.append((k, a, a + take))
                need -= take
                if take < b - a:
                    rest.insert(0, (k, a + take, b))
            done.append(own)
    return done


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def pack(docs: DataFrame, tokenizer: str, length: int = 2048, end: int = 1, seed: int = 0) -> DataFrame:
    """One row for each piece of a document: which ids it has and where they stand.

    (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset): the piece has the ids ``start``
    to ``start + length`` of the document, at ``offset`` of its sequence; ids_crc32 is over little-endian
    unsigned 32-bit ids. Each document ends with the id ``end``, so a null or empty text is that id alone.
    Sequences are ``length`` long, or a power of two. A null doc_id is kept; rows that repeat a doc_id are
    documents of their own. Which group a document is in depends on its id, its ids and the seed; copies of a
    row collapse in each task before they are counted, and are dealt by their number as well, so that however many
    they are, they do not meet in one group. Other columns are ignored.
    """
    spark = small_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    groups = max(1, -(-docs.count() // GROUP_DOCS))

    def tokenise(b: pa.RecordBatch) -> pa.RecordBatch:
        ids, first = _word_tokens(tokenizer).batch(b["text"].to_pylist(), end)
        doc, start, size, crc, rest = [], [], [], [], []
        for k in range(len(first) - 1):
            for a in range(int(first[k]), int(first[k + 1]), length):
                z = min(a + length, int(first[k + 1]))
                doc.append(k)
                start.append(a - first[k])
                size.append(z - a)
                crc.append(_crc(ids[a:z]))
                rest.append(None if z - a == length else ids[a:z].astype("<u4").tobytes())
        doc, start, crc = np.array(doc), np.array(start, np.int64), np.array(crc, np.int64)
        known = b["doc_id"].cast(pa.int64())
        key = np.asarray(known.fill_null(0)).astype(np.int64).view(np.uint64)[doc]
        key = mix(mix(key + np.uint64(seed)) + start.astype(np.uint64) + (crc.astype(np.uint64) << np.uint64(20)))
        return pa.RecordBatch.from_pydict({
            "bucket": pa.array((key % np.uint64(groups)).astype(np.int64)), "key": pa.array(key.view(np.int64)),
            "doc_id": known.take(pa.array(doc)), "start": pa.array(start), "length": pa.array(size, pa.int64()),
            "ids_crc32": pa.array(crc), "doc_tokens": pa.array(np.diff(first)[doc]), "ids": pa.array(rest, pa.binary())})

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[dict]) -> pa.RecordBatch:
            found, sequence = [], rows[0]["bucket"] << 32

            def add(row: dict, a: int, z: int, crc: int, offset: int) -> None:
                found.append((row["doc_id"], row["start"] + a, z - a, crc, row["doc_tokens"], sequence, offset))
            for row in (r for r in rows if r["ids"] is None):
                add(row, 0, row["length"], row["ids_crc32"], 0)
                sequence += 1
            rows = [r for r in rows if r["ids"] is not None]
            for pieces in pack_group([r["length"] for r in rows], length):
                offset = 0
                for k, a, z in pieces:
                    whole = z - a == rows[k]["length"]
                    add(rows[k], a, z, rows[k]["ids_crc32"] if whole else
                        _crc(np.frombuffer(rows[k]["ids"], "<u4")[a:z]), offset)
                    offset += z - a
                sequence += 1
            columns = list(zip(*found))
            names = [x.split()[0] for x in PIECES.split(", ")]
            return pa.RecordBatch.from_pydict({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})
        held: list[dict] = []
        for b in batches:
            for row in b.to_pylist():
                if held and held[0]["bucket"] != row["bucket"]:
                    yield out(held)
                    held = []
                held.append(row)
        if held:
            yield out(held)

    tokens = in_pieces(docs, tokenise, "bucket long, key long, doc_id long, start long, length long, ids_crc32 long, "
                         "doc_tokens long, ids binary")
    tokens = tokens.groupBy(*tokens.columns).agg(F.count("*").alias("copies")).withColumn("copy", F.expr("explode(sequence(1L, copies))"))
    dealt = F.when(F.col("copy") == 1, F.col("bucket")).otherwise(F.pmod(F.xxhash64("key", "copy"), F.lit(groups)))
    return (tokens.withColumn("bucket", dealt).drop("copies").repartition("bucket")
            .sortWithinPartitions("bucket", "key", "start", "copy").drop("key", "copy").mapInArrow(place, PIECES))

"""Remove passages that also begin in an earlier document: exact windows behind a count-min prefilter.

A window is a fixed number of consecutive words. Each window is counted under its anchor, the run of
``anchor`` words inside it with the smallest hash: neighbouring windows mostly share one, so a quarter
as many hashes are counted, and an anchor's count is never below that of a window with it. Partition
sketches of the anchors are merged; only windows whose anchor is estimated to occur twice are grouped,
exactly, by a 128-bit hash of their words. No repeated window is lost, as no estimate is too low.

Windows estimated to occur a thousand times or more are counted exactly first, with map-side partial
minima. Those that do are few by that count; with their first document they are broadcast, and never
shuffled. Every other group is small, so no hot passage meets in one task.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearthline.llm.common import map_batches, small_batches
from hearthline.llm.sketch import LEVELS, Classes, count_min
from hearthline.llm.words import Words, find_words, hash_words, runs, text_bytes
from hearthline.session import written

BITS = 27  # cells in each of two rows of the sketch: 64 MB at the driver and in a Python worker
ANCHOR = 7
HOT = 3  # the class of windows that may occur LEVELS[2] times
MOST_HOT = 500_000  # windows that are broadcast, at most: 12 MB; if there are more, hot windows are joined


def _anchors(words: Words, hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows, at, runs): where whole windows begin, where the anchor of each is, and the hashes of all runs."""
    size = min(ANCHOR, window)
    found = runs(hashes, size)
    starts = np.arange(max(0, len(hashes) - window + 1))
    starts = starts[words.doc[starts] == words.doc[starts + window - 1]]
    best, at = found[starts], starts.copy()
    for k in range(1, window - size + 1):
        other = found[starts + k]
        less = other < best
        best = np.where(less, other, best)
        at = np.where(less, starts + k, at)
    return starts, at, found


def _counted(texts: pa.Array, window: int) -> np.ndarray:
    """The anchors of a batch, each once for a document: repeats within one document do not matter."""
    words = find_words(texts)
    _, at, found = _anchors(words, hash_words(words), window)
    at = np.unique(at)
    doc, found = words.doc[at], found[at]
    order = np.argsort(found)
    order = order[np.argsort(doc[order].astype(np.uint32), kind="stable")]
    doc, found = doc[order], found[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (found[1:] != found[:-1])
    return found[new]


def _check(texts: pa.Array) -> np.ndarray:
    """Tells rows with the same doc_id but different texts apart."""
    data, offsets = text_bytes(texts)
    return np.array([zlib.crc32(data[a:z]) >> 1 for a, z in zip(offsets, offsets[1:])], np.int64)


class HotWindows:
    """The first document of each window that occurs very often."""

    def __init__(self, table: pa.Table):
        h1, order = np.asarray(table["h1"]), np.argsort(np.asarray(table["h1"]))
        self.h1, self.h2, self.first = h1[order], np.asarray(table["h2"])[order], np.asarray(table["first"])[order]

    def find(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """For each window its place here, or -1."""
        if not len(self.h1):
            return np.full(len(h1), -1)
        at = np.minimum(np.searchsorted(self.h1, h1), len(self.h1) - 1)
        return np.where((self.h1[at] == h1) & (self.h2[at] == h2), at, -1)


def _flagged(texts: pa.Array, classes: Classes, window: int, least: int) -> tuple:
    """(words, first words, h1, h2) of the windows of at least a class."""
    words = find_words(texts)
    hashes = hash_words(words)
    starts, at, found = _anchors(words, hashes, window)
    places, back = np.unique(at, return_inverse=True)
    starts = starts[classes.of(found[places])[back] >= least]
    if not len(starts):
        return words, starts, np.zeros(0, np.int64), np.zeros(0, np.int64)
    return (words, starts, runs(hashes, window)[starts].view(np.int64),
            runs(hash_words(words, 2), window)[starts].view(np.int64))


def _windows(docs: DataFrame, classes: Broadcast, window: int, least: int, hot: Broadcast | None = None,
             below: int = HOT + 1) -> DataFrame:
    """(h1, h2, doc_id, at): windows of some classes that are not in ``hot``; ``at`` holds the text's check and the first word."""

    def batch(b: pa.RecordBatch) -> pa.RecordBatch | None:
        words, starts, h1, h2 = _flagged(b["text"], classes.value, window, least)
        keep = np.asarray(b["doc_id"].is_valid())[words.doc[starts]]
        if hot is not None:
            keep &= hot.value.find(h1, h2) < 0
        starts, h1, h2 = starts[keep], h1[keep], h2[keep]
        if not len(starts):
            return None
        doc = words.doc[starts]
        return pa.RecordBatch.from_pydict({
            "h1": pa.array(h1), "h2": pa.array(h2), "doc_id": b["doc_id"].cast(pa.int64()).take(pa.array(doc)),
            "at": pa.array((_check(b["text"])[doc] << 32) | (starts - words.first[doc]))})
    return map_batches(docs, batch, "h1 long, h2 long, doc_id long, at long")


def substring_dedup(docs: DataFrame, window: int = 13, texts: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept) for each row of ``docs`` (doc_id, text).

    Words are runs without ASCII white space, unchanged. A word goes if a window that covers it also
    begins in a document with a smaller doc_id; windows are judged on the input. ``kept`` is the rest,
    joined by one space. A null or empty text has no words. A null doc_id is smaller than none: nothing
    is removed from such rows and they remove nothing. Rows that repeat a doc_id do not remove each
    other's words. Other columns are ignored. With texts=False ``kept`` is left out.
    """
    small_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    classes = count_min(docs.select("text"), lambda b: _counted(b["text"], window), bits=BITS, rows=2)
    shared = docs.sparkSession.sparkContext.broadcast(classes)
    often = _windows(docs, shared, window, HOT)
    firsts = written(often.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
                     .where(F.col("n") >= LEVELS[2]), "hot-windows")
    broadcast = firsts.count() <= MOST_HOT
    hot = docs.sparkSession.sparkContext.broadcast(HotWindows((firsts if broadcast else firsts.limit(0)).toArrow()))
    cold = _windows(docs, shared, window, 1, hot)
    if not broadcast:
        firsts = firsts.select("h1", "h2", F.col("first").alias("known"))
        joined = often.join(firsts, ["h1", "h2"]).where("known < doc_id").select("doc_id", "at")
        cold = cold.join(firsts, ["h1", "h2"], "left_anti")
    first = F.min("doc_id").over(Window.partitionBy("h1", "h2"))
    repeated = cold.withColumn("first", first).where("first < doc_id").select("doc_id", "at")
    if not broadcast:
        repeated = repeated.union(joined)
    places = repeated.groupBy("doc_id").agg(F.collect_list("at").alias("places")).withColumnRenamed("doc_id", "id")

    def cut(b: pa.RecordBatch) -> pa.RecordBatch:
        check, n_words, n_removed, kept = _check(b["text"]), [], [], []
        words, starts, h1, h2 = _flagged(b["text"], shared.value, window, HOT)
        doc, ids = words.doc[starts], np.asarray(b["doc_id"].cast(pa.int64()).fill_null(-(1 << 63)))
        if len(hot.value.first):
            at = hot.value.find(h1, h2)
            gone = (at >= 0) & (hot.value.first[at] < ids[doc])
        else:
            gone = np.zeros(len(starts), bool)
        doc, starts = doc[gone], (starts - words.first[doc])[gone]
        begin = np.searchsorted(doc, np.arange(b.num_rows + 1))
        for k, text in enumerate(b["text"]):
            rest = found = (text.as_py() or "").encode().split()
            at = starts[begin[k]:begin[k + 1]]
            if b["places"][k].is_valid:
                more = b["places"][k].values.to_numpy(zero_copy_only=False)
                at = np.concatenate([at, more[more >> 32 == check[k]] & 0xFFFFFFFF])
            if len(at):
                marks = np.zeros(len(found) + 1, np.int64)
                np.add.at(marks, at, 1)
                np.add.at(marks, at + window, -1)
                rest = [w for w, covered in zip(found, np.cumsum(marks[:-1])) if not covered]
            n_words.append(len(found))
            n_removed.append(len(found) - len(rest))
            kept.append(b" ".join(rest))
        out = {"doc_id": b["doc_id"].cast(pa.int64()), "n_words": pa.array(n_words, pa.int64()),
               "n_removed": pa.array(n_removed, pa.int64()), "kept_sha256": [hashlib.sha256(x).hexdigest() for x in kept]}
        return pa.RecordBatch.from_pydict(out | {"kept": pa.array(kept, pa.binary()).cast(pa.string())} if texts else out)
    joined = docs.join(places, F.col("doc_id") == F.col("id"), "left").select("doc_id", "text", "places")
    return map_batches(joined, cut, "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * texts)

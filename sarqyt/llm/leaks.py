"""Problem 9: evaluation texts inside training text, by winnowing.

A text becomes its k-word runs (k = 5); from every window of w = 4 consecutive runs the one with the smallest hash is
kept as a fingerprint. A window spans k + w - 1 = 8 words, so any shared run of eight words is guaranteed to leave a
shared fingerprint. Fingerprints of test items and documents are joined; a pair is a candidate only if the windows of
the item that its shared fingerprints stand for could make up the wanted share (a necessary condition, so nothing is
lost), and candidates are then extended: the runs of eight words in both are counted exactly.

Items with at most ``broadcast_rows`` fingerprints go to the workers as sorted arrays, and join and extension happen where
the text is read: nothing but the result is shuffled. Beyond that both sides' fingerprints are shuffled, and only the
texts of documents in a candidate pair (by a bitmap of fixed size first) move. A stock phrase that very many documents
share costs one small row (document, item) per hit, summed before the shuffle.

Defined results: null and shorter texts have no runs and match nothing; repeated ids count as one text each row, and a
pair is reported once; rows with a null id are left out; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sarqyt.llm.grams import Words, runs
from sarqyt.session import bitmap, cut, in_bitmap, spread

K, W = 5, 4
BITS = 24


def _least(h: np.ndarray, w: int) -> np.ndarray:
    """The smallest hash of each window of w; a text shorter than a window but not than a run is one window."""
    if len(h) == 0:
        return h
    if len(h) < w:
        return h.min(keepdims=True)
    m = h[: len(h) - w + 1]
    for i in range(1, w):
        m = np.minimum(m, h[i : len(h) - w + 1 + i])
    return m


def _lists(columns: list[list[np.ndarray]], names: list[str], first: pa.Array, key: str) -> pa.RecordBatch:
    out = [first]
    for c in columns:
        flat = np.concatenate(c).view(np.int64) if c else np.empty(0, np.int64)
        out.append(pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, c)]).astype(np.int32)), pa.array(flat)))
    return pa.RecordBatch.from_arrays(out, [key, *names])


def fingerprints(df: DataFrame, key: str, text: str = "text", k: int = K, w: int = W) -> DataFrame:
    """``(key, prints)``: the distinct fingerprints of each text."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for b in batches:
            yield _lists([[np.unique(_least(runs(words.hashes(t), k), w)) for t in b.column(1).to_pylist()]], ["prints"], b.column(0), key)

    return spread(df.select(key, text), key).mapInArrow(go, f"`{key}` bigint, prints array<bigint>")


def _items(items: DataFrame, key: str, text: str, k: int, w: int) -> DataFrame:
    """Per item: its distinct runs of k + w - 1 words, and per fingerprint the number of those it stands for."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for b in batches:
            prints, weights, wholes = [], [], []
            for t in b.column(1).to_pylist():
                h = words.hashes(t)
                whole, at = np.unique(runs(h, k + w - 1), return_index=True)
                p, c = np.unique(_least(runs(h, k), w)[at] if len(at) else np.empty(0, np.uint64), return_counts=True)
                prints.append(p)
                weights.append(c.astype(np.uint64))
                wholes.append(whole)
            yield _lists([prints, weights, wholes], ["prints", "weights", "runs"], b.column(0), key)

    return items.select(key, text).mapInArrow(go, f"`{key}` bigint, prints array<bigint>, weights array<bigint>, runs array<bigint>")


def _extended(key_a: str, key_b: str, rows: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], pa.int64()) for j in range(4)], [key_a, key_b, "shared", "runs"])


class Items:
    """The items' fingerprints and runs as flat sorted arrays."""

    def __init__(self, t: pa.Table, key: str) -> None:
        self.keys = t[key].to_numpy()
        p, w, r = (t[c].combine_chunks() for c in ("prints", "weights", "runs"))
        flat = p.flatten().to_numpy().view(np.uint64)
        owner = np.repeat(np.arange(len(p)), p.value_lengths().to_numpy())
        o = np.argsort(flat, kind="stable")
        self.prints, self.owner, self.weight = flat[o], owner[o], w.flatten().to_numpy()[o].astype(np.int64)
        self.sizes = r.value_lengths().to_numpy().astype(np.int64)
        self.runs = np.split(r.flatten().to_numpy().view(np.uint64), np.cumsum(self.sizes)[:-1]) if len(r) else []

    def near(self, prints: np.ndarray, share: float) -> np.ndarray:
        """The items of which a text with these distinct fingerprints may have the share."""
        lo, hi = np.searchsorted(self.prints, prints, "left"), np.searchsorted(self.prints, prints, "right")
        hit = np.flatnonzero(hi > lo)
        if not len(hit):
            return hit
        at = np.concatenate([np.arange(lo[i], hi[i]) for i in hit])
        upper = np.bincount(self.owner[at], weights=self.weight[at], minlength=len(self.keys))
        return np.flatnonzero((upper > 0) & (upper >= self.sizes * share - 1e-9))


def _in_place(docs: DataFrame, doc_key: str, item_key: str, text: str, items, share: float, k: int, w: int) -> DataFrame:
    """Join and extension in the pass that reads the texts; ``items`` are broadcast."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, it = Words(), items.value
        for b in batches:
            rows = []
            for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                h = words.hashes(t)
                near = it.near(np.unique(_least(runs(h, k), w)), share)
                if len(near):
                    have = runs(h, k + w - 1)
                    rows += [(d, int(it.keys[i]), int(np.isin(it.runs[i], have).sum()), int(it.sizes[i])) for i in near]
            yield _extended(doc_key, item_key, rows)

    return spread(docs.select(doc_key, text), doc_key).mapInArrow(go, f"`{doc_key}` bigint, `{item_key}` bigint, shared bigint, runs bigint")


def _by_shuffle(docs: DataFrame, it: DataFrame, doc_key: str, item_key: str, text: str, share: float, k: int, w: int) -> DataFrame:
    """The same by shuffled joins, for more items than a worker should hold."""
    marks = it.select(item_key, F.size("runs").alias("runs"), F.explode(F.arrays_zip("prints", "weights")).alias("p")).select(item_key, "runs", F.col("p.prints").alias("print"), F.col("p.weights").alias("weight"))
    hits = fingerprints(docs, doc_key, text, k, w).select(doc_key, F.explode("prints").alias("print")).join(marks, "print")
    near = cut(hits.groupBy(doc_key, item_key, "runs").agg(F.sum("weight").alias("upper")).where(F.col("upper") >= F.col("runs") * share - 1e-9).select(doc_key, item_key))
    packed = docs.sparkSession.sparkContext.broadcast(bitmap(near.select(F.xxhash64(F.col(doc_key).cast("bigint")).alias("h")), "h", BITS))

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.filter(pa.array(in_bitmap(packed.value, b.column(0).to_numpy().view(np.uint64), BITS)))
            if b.num_rows:
                yield pa.RecordBatch.from_arrays(b.columns[1:], [doc_key, text])

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for b in batches:
            rows = []
            last, have = None, np.empty(0, np.uint64)
            for d, i, t, r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3), strict=True):
                if last is None or t != last:
                    last, have = t, runs(words.hashes(t), k + w - 1)
                own = r.values.to_numpy().view(np.uint64)
                rows.append((d, i, int(np.isin(own, have).sum()), len(own)))
            yield _extended(doc_key, item_key, rows)

    few = docs.where(F.col(text).isNotNull()).select(F.xxhash64(F.col(doc_key).cast("bigint")).alias("h"), F.col(doc_key).cast("bigint").alias(doc_key), text).mapInArrow(some, f"`{doc_key}` bigint, `{text}` string")
    todo = few.join(near, doc_key).join(it.select(item_key, F.col("runs").alias("item_runs")), item_key)
    return todo.select(doc_key, item_key, text, "item_runs").mapInArrow(go, f"`{doc_key}` bigint, `{item_key}` bigint, shared bigint, runs bigint")


def leaks(docs: DataFrame, items: DataFrame, doc_key: str, item_key: str, share: float = 0.2, text: str = "text", k: int = K, w: int = W, broadcast_rows: int = 2_000_000) -> DataFrame:
    """``(doc_key, item_key, shared, runs)``: every document with at least ``share`` of an item's distinct runs of eight
    words, how many of them it has, and how many the item has."""
    it = _items(items.where(F.col(item_key).isNotNull()), item_key, text, k, w).where("size(runs) > 0")
    docs = docs.where(F.col(doc_key).isNotNull())
    # an item has no more distinct fingerprints than distinct windows, so the runs bound both
    size = it.agg(F.sum(F.size("runs")).alias("n")).first()["n"] or 0
    if size <= broadcast_rows:
        held = docs.sparkSession.sparkContext.broadcast(Items(it.toArrow(), item_key))
        exact = _in_place(docs, doc_key, item_key, text, held, share, k, w)
    else:
        exact = _by_shuffle(docs, it, doc_key, item_key, text, share, k, w)
    return exact.where(F.col("shared") >= F.col("runs") * share - 1e-9).groupBy(doc_key, item_key).agg(F.max("shared").alias("shared"), F.max("runs").alias("runs"))


def found(docs: DataFrame, items: DataFrame) -> DataFrame:
    return leaks(docs, items, "doc_id", "item_id").select("doc_id", "item_id")

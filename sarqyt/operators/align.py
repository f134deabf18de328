"""Pairing of documents and sentences: nearest vectors within a document, one-to-one claims, bead alignment, triplets."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sarqyt.functions.rules import word_count
from sarqyt.functions.text import round4
from sarqyt.operators.models import encoded

BLOCK = 4096
MIN_WORDS, MIN_RATIO, MAX_RATIO, MIN_SIMILARITY = 5, 0.3, 3.0, 0.85


def nearest(queries: DataFrame, rows: DataFrame, group: str, key: str, vector: str, block: int = BLOCK) -> DataFrame:
    """``(query, match, similarity)``: for each query the row of its group with the largest inner product (ties: smallest
    key), itself excepted. Both sides of a group are dealt into blocks of about ``block`` rows; each block of queries meets
    each of rows in one matrix product in a task of its own, and the bests are reduced, so no group is gathered and no
    pair is ever a row. Null vectors and groups match nothing."""

    def side(df: DataFrame) -> DataFrame:
        some = df.where(F.col(vector).isNotNull() & F.col(group).isNotNull())
        return some.select(F.col(key).cast("bigint").alias("key"), F.col(group).cast("string").alias("g"), F.col(vector).cast("array<double>").alias("v"))

    q, r = side(queries), side(rows)

    def blocks(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias(name))

    sizes = blocks(q, "qs").join(blocks(r, "rs"), "g")
    own = lambda n: F.pmod(F.xxhash64("key"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = q.join(sizes, "g").select("g", own("qs").alias("a"), every("rs").alias("b"), "key", "v")
    right = r.join(sizes, "g").select("g", own("rs").alias("b"), every("qs").alias("a"), "key", "v")
    kinds = pa.schema([("query", pa.int64()), ("match", pa.int64()), ("similarity", pa.float64())])

    def go(x: pa.Table, y: pa.Table) -> pa.Table:
        if not len(x) or not len(y):
            return kinds.empty_table()
        xk, yk = x["key"].to_numpy(), y["key"].to_numpy()
        matrix = lambda t: t["v"].combine_chunks().flatten().to_numpy().reshape(len(t), -1)
        s = np.round(matrix(x) @ matrix(y).T, 12)
        s[xk[:, None] == yk[None, :]] = -np.inf
        top = s.max(axis=1)
        match = np.where(s == top[:, None], yk[None, :], np.iinfo(np.int64).max).min(axis=1)
        some = np.isfinite(top)
        return pa.table([pa.array(xk[some]), pa.array(match[some]), pa.array(top[some])], schema=kinds)

    out = left.groupBy("g", "a", "b").cogroup(right.groupBy("g", "a", "b")).applyInArrow(go, "query bigint, match bigint, similarity double")
    best = F.max_by(F.struct("match", "similarity"), F.struct("similarity", -F.col("match")))
    return out.groupBy("query").agg(best.alias("b")).select("query", F.col("b.match").alias("match"), F.col("b.similarity").alias("similarity"))


def one_to_one(pairs: DataFrame, source: str, target: str) -> DataFrame:
    """First come, first served: of the pairs that claim a target, the one with the smallest source keeps it."""
    return pairs.groupBy(target).agg(F.min_by(F.struct(*pairs.columns), F.col(source)).alias("r")).select("r.*")


def triplets(rus: DataFrame, eng: DataFrame) -> DataFrame:
    """Triplets of aligned pairs ``(doc, pos, kaz, text, sim, kind)``: per document and Kazakh text the last pair of each
    side wins, both sides are joined in full, and triplets are numbered per document, Russian positions first."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("doc", "kaz").agg(F.min("pos").alias(f"{name}_pos"), F.max_by(F.struct("text", "sim", "kind"), "pos").alias(name))

    both = side(rus, "rus").join(side(eng, "eng"), ["doc", "kaz"], "full_outer")
    w = Window.partitionBy("doc").orderBy(F.col("rus_pos").asc_nulls_last(), F.col("eng_pos").asc_nulls_last())
    n = F.row_number().over(w) - 1
    return both.select("doc", n.cast("bigint").alias("idx"), F.format_string("%s_%04d", "doc", n).alias("id"), "kaz", F.col("rus.text").alias("rus"), F.col("eng.text").alias("eng"), round4(F.col("rus.sim")).alias("similarity_kaz_rus"), round4(F.col("eng.sim")).alias("similarity_kaz_eng"), F.col("rus.kind").alias("alignment_type_kaz_rus"), F.col("eng.kind").alias("alignment_type_kaz_eng"))


def beads(a: np.ndarray, b: np.ndarray, most: int = 5, top_k: int = 3, skip: float = 0.15) -> list[tuple[list[int], list[int]]]:
    """Monotone alignment of two sequences of unit vectors in beads of up to ``most`` sentences together (one side may be
    empty), by dynamic programming on the cosine of the summed vectors, near the ``top_k`` neighbours of each sentence.
    Only the cells near those are kept, with the scores of the last rows and the moves of all."""
    n, m = len(a), len(b)
    if not n or not m:
        return [([i], []) for i in range(n)] + [([], [j]) for j in range(m)]
    spread = [np.empty(0, int)] * n
    for i in range(0, n, 512):
        near = np.argsort(-(a[i : i + 512] @ b.T), axis=1, kind="stable")[:, :top_k]
        for k, row in enumerate(near):
            spread[i + k] = np.append(row, round((i + k) * m / n))
    sa = np.concatenate([np.zeros((1, a.shape[1])), np.cumsum(a, 0)])
    sb = np.concatenate([np.zeros((1, b.shape[1])), np.cumsum(b, 0)])
    # sums of y neighbouring vectors that end before j, and their lengths
    wide = {y: sb[y:] - sb[:-y] for y in range(1, min(most, m + 1))}
    long = {y: np.linalg.norm(v, axis=1) for y, v in wide.items()}
    moves = [(x, y) for x in range(most) for y in range(most) if 0 < x + y <= most and (x > 0 and y > 0 or x + y == 1)]
    rows: list[np.ndarray] = []
    came: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for i in range(n + 1):
        here = np.zeros(m + 1, bool)
        for r in range(max(0, i - most), min(n, i + most + 1)):
            for j in spread[r].tolist():
                here[max(0, j - most) : j + most + 1] = True
        here[0] = here[m] = True
        if i in (0, n):
            here[:] = True
        at = np.flatnonzero(here)
        best, mx, my = np.full(len(at), -np.inf), np.zeros(len(at), np.int8), np.zeros(len(at), np.int8)
        if i == 0:
            best[0] = 0.0
        for x, y in moves:
            if not 0 < x <= i or y > m:
                continue
            old, ok = rows[i - x], at >= y
            score = np.full(len(at), -np.inf)
            j = at[ok] - y
            if y:
                u = sa[i] - sa[i - x]
                gain = wide[y][j] @ u / (np.linalg.norm(u) * long[y][j] + 1e-9) * (x + y) / 2 - 0.05 * (x + y - 2)
            else:
                gain = -skip
            score[ok] = old[j] + gain
            better = score > best
            best[better], mx[better], my[better] = score[better], x, y
        # a target sentence left out: along each run of neighbouring cells of the row
        for run in np.split(np.arange(len(at)), np.flatnonzero(np.diff(at) > 1) + 1):
            lifted = best[run] + skip * at[run]
            top = np.maximum.accumulate(lifted)
            through = np.zeros(len(run), bool)
            through[1:] = (top[:-1] >= lifted[1:]) & np.isfinite(top[:-1])
            best[run] = np.where(through, top - skip * at[run], best[run])
            mx[run[through]], my[run[through]] = 0, 1
        row = np.full(m + 1, -np.inf)
        row[at] = best
        rows.append(row)
        if i >= most:
            rows[i - most] = row[:0]  # no move reaches back so far
        came.append((at, mx, my))
    out = []
    while n or m:
        at, mx, my = came[n]
        k = int(np.searchsorted(at, m))
        x, y = int(mx[k]), int(my[k])
        out.append((list(range(n - x, n)), list(range(m - y, m))))
        n, m = n - x, m - y
    return out[::-1]


def align_documents(source: DataFrame, target: DataFrame, encode) -> DataFrame:
    """``(doc, src, tgt)``: beads per document of rows ``(doc, idx, text)``; ``encode`` maps a list of texts to unit
    vectors. A document is the unit of alignment and is gathered in one task; documents are bounded by nature."""

    def go(key, x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        x, y = x.sort_values(["idx", "text"]), y.sort_values(["idx", "text"])
        if not len(x) or not len(y):
            return pd.DataFrame({"doc": [], "src": [], "tgt": []}, dtype=object)
        got = beads(encode(x.text.fillna("").tolist()), encode(y.text.fillna("").tolist()))
        return pd.DataFrame({"doc": key[0], "src": [p for p, _ in got], "tgt": [q for _, q in got]})

    return source.groupBy("doc").cogroup(target.groupBy("doc")).applyInPandas(go, "doc string, src array<int>, tgt array<int>")


def good_pair(a: Column, b: Column, similarity: Column, least: float = MIN_SIMILARITY) -> Column:
    """Whether two aligned texts may stand as a pair: enough words on both sides, a ratio of words within bounds, and
    similar enough; null is no."""
    x, y = word_count(a), word_count(b)
    return F.coalesce((x >= MIN_WORDS) & (y >= MIN_WORDS) & F.try_divide(x, y).between(MIN_RATIO, MAX_RATIO) & (similarity >= least), F.lit(False))


def pair_filters(pairs: DataFrame, a: str, b: str, similarity: str, least: float = MIN_SIMILARITY) -> DataFrame:
    return pairs.where(good_pair(F.col(a), F.col(b), F.col(similarity), least))


def bead_texts(found: DataFrame, source: DataFrame, target: DataFrame) -> DataFrame:
    """``(doc, pos, kaz, text, kind)`` of beads ``(doc, src, tgt)``: the sentences of both sides, looked up by their place in
    the document and joined by spaces; ``pos`` is the first source place and ``kind`` the numbers of sentences (2:1). Beads
    with an empty side are left out. Sentences are rows ``(doc, idx, text)``; their places are ranks of (idx, text)."""

    def placed(df: DataFrame) -> DataFrame:
        w = Window.partitionBy("doc").orderBy("idx", "text")
        return df.select("doc", (F.row_number().over(w) - 1).cast("int").alias("place"), "text")

    both = found.where((F.size("src") > 0) & (F.size("tgt") > 0)).select("doc", F.array_min("src").alias("pos"), "src", "tgt", F.concat(F.size("src"), F.lit(":"), F.size("tgt")).alias("kind"))

    def side(column: str, df: DataFrame, name: str) -> DataFrame:
        each = both.select("doc", "pos", F.explode(column).alias("place")).join(placed(df), ["doc", "place"])
        # at most as many sentences as a bead has
        return each.groupBy("doc", "pos").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "text"))), lambda x: x["text"]), " ").alias(name))

    return both.select("doc", "pos", "kind").join(side("src", source, "kaz"), ["doc", "pos"]).join(side("tgt", target, "text"), ["doc", "pos"]).select("doc", "pos", "kaz", "text", "kind")


def pair_similarity(a: Column, b: Column, encoder) -> Column:
    """The inner product of the unit vectors of two texts; null if one is."""
    return vector_product(encoded(a, encoder), encoded(b, encoder))


def vector_product(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda t, x: t + x)


def bead_pairs(found: DataFrame, source: DataFrame, target: DataFrame, encoder, least: float = MIN_SIMILARITY) -> DataFrame:
    """``(doc, pos, kaz, text, sim, kind)``: the chain from beads to the pairs that ``triplets`` takes."""
    texts = bead_texts(found, source, target)
    scored = texts.withColumn("sim", pair_similarity(F.col("kaz"), F.col("text"), encoder))
    return pair_filters(scored, "kaz", "text", "sim", least).select("doc", "pos", "kaz", "text", "sim", "kind")


def left_triplets(kaz: DataFrame, rus: DataFrame, eng: DataFrame, key: str) -> DataFrame:
    """Every Kazakh row with what the other two have for its key; rows with neither are left out."""
    return kaz.join(rus, key, "left").join(eng, key, "left").where("rus IS NOT NULL OR eng IS NOT NULL")


def stats(triples: DataFrame) -> DataFrame:
    """One row: pairs per side, merged pairs, full and partial triplets."""
    rus, eng = F.col("rus"), F.col("eng")
    return triples.agg(F.count("rus").alias("kaz_rus_pairs"), F.count("eng").alias("kaz_eng_pairs"), F.count_if(F.col("alignment_type_kaz_rus") != "1:1").alias("kaz_rus_merged"), F.count_if(rus.isNotNull() & eng.isNotNull()).alias("full_triplets"), F.count_if(rus.isNull() != eng.isNull()).alias("partial_triplets"))


THRESHOLDS = (0.8, 0.85, 0.9)
PREFERRED = ("mexma", "sonar", "labse")


def compare_encoders(scores: DataFrame) -> DataFrame:
    """Per model of rows ``(model, similarity)`` the mean, median, deviation, and how many lie above each threshold."""
    s = F.col("similarity")
    above = [F.count_if(s > x).alias(f"above_{int(x * 100)}") for x in THRESHOLDS]
    return scores.where("similarity IS NOT NULL").groupBy("model").agg(F.round(F.avg(s), 6).alias("mean"), F.round(F.median(s), 6).alias("median"), F.round(F.stddev_pop(s), 6).alias("std"), *above)


def winner(scores: DataFrame, threshold: float = 0.85) -> DataFrame:
    """One row: the model with most pairs above the threshold, ties to the preferred one, which also wins without rows."""
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, PREFERRED)), F.col("model")), F.lit(99))
    counted = scores.groupBy("model").agg(F.count_if(F.col("similarity") > threshold).alias("n"))
    return counted.agg(F.coalesce(F.max_by("model", F.struct("n", -rank)), F.lit(PREFERRED[0])).alias("winner"))

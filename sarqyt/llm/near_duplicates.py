"""Problem 7: near-duplicate records by vertical partitioning of the global n-gram order.

1. Every record becomes the set of its distinct word runs (after the repair of problem 2), and is named by the 64-bit
   hash of that set, so exact copies are one record in all that follows and cost nothing.
2. All runs get one global order: rare ones first, by the exact number of records that have them (on a scale of eighths of
   a doubling), then by hash. Records are packed in pages; each page asks, part by part of the runs' range, how often its
   runs occur, and gets one byte back for each. So the order needs no table that some task must hold: what is exchanged is
   six bytes a run there and one back, at any size of the data.
3. The order is cut into ``fragments``: a record becomes one segment per fragment.
4. Two records with Jaccard similarity >= t share SHARED runs among the first n - ceil(t n) + SHARED of each (prefix
   filter), their sizes differ by at most the factor t, and their 128 parity bits by at most the runs they may differ in
   (bitmap filter). Outside their prefixes they can share no more than lies behind one of these, so the prefixes must
   share the rest. Prefix runs that only one record has are dropped before the shuffle. Records in one run's list propose
   pairs. The records of a very long list are
   compared with its first record before anything else; those linked to it are not compared with each other, and the
   others meet all of the list in salted pairs of blocks, by different tasks.
5. For the proposed pairs the overlap is counted in each fragment apart and summed per pair; a pair is kept if
   overlap >= t * (n_a + n_b - overlap).
6. Groups are the connected components of the kept pairs.

Exact but for hashes: no cap on pairs, partners or list lengths. Records are named by 64 bits and runs stored in 48. Two
different runs are taken as one with probability 2**-48, so in 10**9 records of 100 runs (10**11 different ones) some 2 *
10**7 pairs of runs are; a pair of records needs dozens of shared runs, and one or two by chance change no verdict unless
it stands on the threshold.
Defined results: nulls and texts under k words have no runs; a record without any run is in no group, however many
there are; rows repeated with the same key count once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sarqyt.llm import lookalikes
from sarqyt.llm.grams import Words, column_runs, packed, sorted_sets, unpacked
from sarqyt.operators.components import connected_components
from sarqyt.session import bitmap, broadcast_if, cut, free, in_bitmap, spread

SHARED = 4
TASK_ROWS = 500_000
TASK_BYTES = 16 << 20
PAGE_ROWS = 2000
MEMBER_BITS = 25
PAIR_BLOCK = BLOCK = 2000


def _binary(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer((offsets.astype(np.int64) * 6).astype(np.int32)), pa.py_buffer(packed(flat))])


def _runs_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All runs of a column of packed sets, and the size of each set."""
    wide = column.type == pa.large_binary()
    at = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(column.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
    return unpacked(raw), (np.diff(at) // 6).astype(np.int64)


def run_sets(df: DataFrame, key: str, scripts: dict[str, str] | None = None, k: int = 3) -> DataFrame:
    """``(key, grams)``: the sorted distinct run hashes of each record, fields apart and put together."""
    scripts = scripts or lookalikes.SCRIPTS

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        con, words = lookalikes.connect(), Words()
        for b in batches:
            t = lookalikes.repair_table(con, pa.Table.from_batches([b]), scripts, [key])
            parts = [column_runs(*words.column(t[f"{c}__fixed"].to_pylist()), k, salt) for salt, c in enumerate(scripts)]
            flat, at = sorted_sets(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), t.num_rows)
            yield pa.RecordBatch.from_arrays([t[key].combine_chunks(), _binary(flat, at)], [key, "grams"])

    one = df.where(F.col(key).isNotNull()).select(key, *scripts)
    return spread(one, key).mapInArrow(go, f"`{key}` bigint, grams binary")


PAGE = "page bigint, keys binary, of binary, h binary, sizes binary, runs binary"


def _blob(x: np.ndarray) -> pa.Array:
    return pa.array([x.tobytes()], pa.binary())


def _pages(sets: DataFrame, key: str | None = None) -> DataFrame:
    """``PAGE``: ``PAGE_ROWS`` records of (key, h, grams) at a time packed in one row, equal sets once: all keys and the set of
    each, the different sets, their sizes and runs. Pages are told apart by their place, which the caller's cut fixes."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << 32
        for i, b in enumerate(b.slice(k, PAGE_ROWS) for b in batches for k in range(0, b.num_rows, PAGE_ROWS)):
            own = b.column(0).to_numpy()
            h, first = np.unique(own, return_index=True)
            flat, n = _runs_of(b.column(1).take(pa.array(first)))
            keys = b.column(2).to_numpy() if b.num_columns > 2 else own[:0]
            yield pa.RecordBatch.from_arrays([pa.array([place + i]), _blob(keys), _blob(own if len(keys) else own[:0]), _blob(h), _blob(n.astype(np.int32)), _blob(packed(flat))], ["page", "keys", "of", "h", "sizes", "runs"])

    return sets.select("h", "grams", *([key] if key else [])).mapInArrow(go, PAGE)


def _members(pages: DataFrame, key: str) -> DataFrame:
    """``(key, h)`` of all records."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(k, np.int64)), pa.array(np.frombuffer(h, np.int64))], [key, "h"])

    return pages.select("keys", "of").mapInArrow(go, f"`{key}` bigint, h bigint").distinct()


def _part(runs: np.ndarray, parts: int) -> np.ndarray:
    return ((runs >> np.uint64(40)) % np.uint64(parts)).astype(np.int64)


def _levels(pages: DataFrame, parts: int) -> DataFrame:
    """``(page, part, levels)``: how often each run of a page occurs in all of them (0: once), in the order of the page's runs of
    that part."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for page, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                runs = unpacked(np.frombuffer(raw, np.uint8))
                p = _part(runs, parts)
                count = np.bincount(p, minlength=parts)
                some = np.flatnonzero(count)
                ordered = packed(runs[np.argsort(p, kind="stable")])
                end = np.cumsum(count) * 6
                yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(np.full(len(some), page)), pa.array([ordered[end[k] - count[k] * 6 : end[k]].tobytes() for k in some], pa.binary())], ["part", "page", "runs"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, page, raw = [], [], []
        for b in batches:
            part += b.column(0).to_pylist()
            page += b.column(1).to_pylist()
            raw += b.column(2).to_pylist()
        if not part:
            return
        size = np.array([len(r) // 6 for r in raw])
        _, back, count = np.unique(unpacked(np.frombuffer(b"".join(raw), np.uint8)), return_inverse=True, return_counts=True)
        level = np.where(count == 1, 0, np.minimum(255, 1 + 8 * np.log2(count))).astype(np.uint8)[back]
        end = np.cumsum(size)
        yield pa.RecordBatch.from_arrays([pa.array(page), pa.array(part, pa.int32()), pa.array([level[e - n : e].tobytes() for e, n in zip(end, size, strict=True)], pa.binary())], ["page", "part", "levels"])

    asked = pages.select("page", "runs").mapInArrow(ask, "part int, page bigint, runs binary")
    return asked.repartition(parts, "part").mapInArrow(answer, "page bigint, part int, levels binary")


def _level(count: int) -> int:
    return min(255, int(1 + 8 * np.log2(count))) if count > 1 else 0


def _borders(levels: DataFrame, fragments: int) -> np.ndarray:
    """Levels at which the order is cut: the unshared runs first, the others in about equal parts."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(256, np.int64)
        for b in batches:
            for raw in b.column(0).to_pylist():
                n += np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(256, dtype=np.int32)), pa.array(n)], ["level", "n"])

    n = np.zeros(256, np.int64)
    for r in levels.select("levels").mapInArrow(go, "level int, n bigint").groupBy("level").agg(F.sum("n").alias("n")).toArrow().to_pylist():
        n[r["level"]] = r["n"]
    mass = np.cumsum(n[1:])
    if fragments < 2 or not mass[-1]:
        return np.zeros(max(0, fragments - 1), np.uint8)
    return np.array([0] + [1 + int(np.searchsorted(mass, mass[-1] * (i + 1) / (fragments - 1))) for i in range(fragments - 2)], np.uint8)


def _with_levels(pages: DataFrame, levels: DataFrame, parts: int) -> DataFrame:
    """``(h, sizes, runs, parts)``: pages with the levels of their runs (a page has one byte of level for six of a run), met in
    as many tasks as the runs' bytes ask for."""
    own = levels.repartition(parts, "page").groupBy("page").agg(F.collect_list(F.struct("part", "levels")).alias("parts"))
    return pages.select("page", "h", "sizes", "runs").repartition(parts, "page").join(own, "page", "left").select("h", "sizes", "runs", "parts")


def _ordered(h: bytes, sizes: bytes, raw: bytes, parts: list[dict] | None, of: int) -> tuple[np.ndarray, ...]:
    """Of one page: its sets, their sizes, and per run its set's number, hash, level and position, in the global order."""
    n = np.frombuffer(sizes, np.int32).astype(np.int64)
    flat = unpacked(np.frombuffer(raw, np.uint8))
    level = np.zeros(len(flat), np.uint8)
    p = _part(flat, of)
    place = np.argsort(p, kind="stable")
    start = np.concatenate([[0], np.cumsum(np.bincount(p, minlength=of))])
    for x in parts or ():
        level[place[start[x["part"]] : start[x["part"] + 1]]] = np.frombuffer(x["levels"], np.uint8)
    rows = np.repeat(np.arange(len(n)), n)
    # the hashes of a row are sorted already, so a stable sort by (row, level) is the order
    order = np.argsort(level, kind="stable")
    order = order[np.argsort(rows[order].astype(np.uint16 if len(n) <= 65536 else np.int64), kind="stable")]
    return np.frombuffer(h, np.int64), n, rows, flat[order], level[order], np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)


def _parity(rows: np.ndarray, g: np.ndarray, n: int) -> np.ndarray:
    """Per record 128 bits: the parity of its runs in each of 128 cells. Two sets that differ in d runs differ in at most d
    bits, so a pair with more differing bits than similarity allows runs cannot be similar."""
    odd = np.bincount(rows * 128 + ((g >> np.uint64(16)) & np.uint64(127)).astype(np.int64), minlength=n * 128).reshape(n, 128) & 1
    return np.packbits(odd.astype(np.uint8), axis=1).view(np.int64)


def _heads(pages: DataFrame, t: float, parts: int, block: int) -> DataFrame:
    """``(h, n, s1, s2, cold, warm)`` of every record: its size, its parity bits, and its prefix runs that another record has
    too, apart those in so many records that their list may be longer than ``block``."""
    least = _level(block)

    def lists(rows: np.ndarray, g: np.ndarray, n: int) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))]).astype(np.int32)), pa.array(g.view(np.int64)))

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                h, n, rows, g, level, pos = _ordered(*row, parts)
                sign = _parity(rows, g, len(h))
                head = (pos < np.minimum(n, n - np.ceil(t * n - 1e-9).astype(np.int64) + SHARED)[rows]) & (level > 0)
                cold, warm = head & (level < least), head & (level >= least)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n.astype(np.int32)), pa.array(sign[:, 0]), pa.array(sign[:, 1]), lists(rows[cold], g[cold], len(h)), lists(rows[warm], g[warm], len(h))], ["h", "n", "s1", "s2", "cold", "warm"])

    return pages.mapInArrow(go, "h bigint, n int, s1 bigint, s2 bigint, cold array<bigint>, warm array<bigint>")


def _differ(n: np.ndarray, m: np.ndarray, t: float) -> np.ndarray:
    """How many runs two sets of similarity >= t may differ in."""
    return np.floor((n + m) * ((1 - t) / (1 + t)) + 1e-9)


def _meet(post: DataFrame, t: float) -> DataFrame:
    """``(a, b, n_a, n_b)``: pairs of records, once for each list in which they meet. All rows of a run are in one partition;
    no list is longer than a block, and there are partitions enough to hold about ``TASK_ROWS`` rows each."""

    def pairs(cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((cols[1], cols[0]))
        g, h, n, s1, s2 = (c[order] for c in cols)
        new = np.ones(len(g), bool)
        new[1:] = (g[1:] != g[:-1]) | (h[1:] != h[:-1])  # a set that occurs several times
        g, h, n, s1, s2 = (x[new] for x in (g, h, n, s1, s2))
        i, lag = np.arange(len(g)), 0
        while len(i):
            lag += 1
            i = i[i < len(g) - lag]
            i = i[g[i] == g[i + lag]]
            j = i + lag
            x, y = n[i].astype(np.int64), n[j].astype(np.int64)
            near = np.bitwise_count((s1[i] ^ s1[j]).view(np.uint64)).astype(np.int64) + np.bitwise_count((s2[i] ^ s2[j]).view(np.uint64))
            ok = (near <= _differ(x, y, t)) & (x >= y * t - 1e-9) & (y >= x * t - 1e-9)
            if ok.any():
                yield pa.RecordBatch.from_arrays([pa.array(h[i[ok]]), pa.array(h[j[ok]]), pa.array(n[i[ok]]), pa.array(n[j[ok]])], ["a", "b", "n_a", "n_b"])

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[c.to_numpy() for c in b.columns] for b in batches]
        if parts:
            yield from pairs([np.concatenate(c) for c in zip(*parts, strict=True)])

    return post.mapInArrow(go, "a bigint, b bigint, n_a int, n_b int")


def _segments(pages: DataFrame, cuts: np.ndarray, parts: int, member) -> DataFrame:
    """``(h, n, fragment, runs)`` of the records that may be in a proposed pair."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                h, n, rows, g, level, _ = _ordered(*row, parts)
                keep = in_bitmap(member.value, h.view(np.uint64), MEMBER_BITS)
                if not keep.any():
                    continue
                some = keep[rows]
                number = np.cumsum(keep) - 1
                h, n, rows, g, level = h[keep], n[keep], number[rows[some]], g[some], level[some]
                pieces = len(cuts) + 1
                cell = rows * pieces + np.searchsorted(cuts, level, side="left")
                count = np.bincount(cell, minlength=len(h) * pieces)
                who = np.repeat(np.arange(len(h)), pieces)
                yield pa.RecordBatch.from_arrays([pa.array(h[who]), pa.array(n[who].astype(np.int32)), pa.array(np.tile(np.arange(pieces, dtype=np.int32), len(h))), _binary(g, np.concatenate([[0], np.cumsum(count)]))], ["h", "n", "fragment", "runs"])

    return pages.mapInArrow(go, "h bigint, n int, fragment int, runs binary").where("length(runs) > 0")


def _shared_runs(pairs: DataFrame) -> DataFrame:
    """``(a, b, n_a, n_b, c)``: the number of runs in both of two segments x and y."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            (x, nx), (y, ny) = _runs_of(b.column(4)), _runs_of(b.column(5))
            who = np.concatenate([np.repeat(np.arange(len(nx)), nx), np.repeat(np.arange(len(ny)), ny)])
            both = np.concatenate([x, y])
            order = np.lexsort((both, who))
            who, both = who[order], both[order]
            same = (who[1:] == who[:-1]) & (both[1:] == both[:-1])
            c = np.bincount(who[1:][same], minlength=b.num_rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(c)], ["a", "b", "n_a", "n_b", "c"])

    return pairs.mapInArrow(go, "a bigint, b bigint, n_a int, n_b int, c bigint")


def _verified(pages: DataFrame, pairs: DataFrame, cuts: np.ndarray, of: int, t: float) -> DataFrame:
    """``(a, b, n_a, n_b, overlap)`` of the proposed pairs that are similar: overlaps counted per fragment, then summed."""
    sc = pages.sparkSession.sparkContext
    members = sc.broadcast(bitmap(pairs.select(F.explode(F.array("a", "b")).alias("h")), "h", MEMBER_BITS))
    # both joins are on (record, fragment), so the segments are shuffled once
    parts = _segments(pages, cuts, of, members).dropDuplicates(["h", "fragment"])
    each_part = pairs.select("a", "b", F.explode(F.sequence(F.lit(0), F.lit(len(cuts)))).alias("fragment"))
    one = each_part.join(parts.select(F.col("h").alias("a"), "fragment", F.col("n").alias("n_a"), F.col("runs").alias("x")), ["a", "fragment"])
    two = one.join(parts.select(F.col("h").alias("b"), "fragment", F.col("n").alias("n_b"), F.col("runs").alias("y")), ["b", "fragment"])
    partial = _shared_runs(two.select("a", "b", "n_a", "n_b", "x", "y"))
    total = partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("c").alias("overlap"))
    return total.where(F.col("overlap") >= F.lit(t) * (F.col("n_a") + F.col("n_b") - F.col("overlap")) - 1e-9)


def _near(t: float):
    """The size and parity filters on the columns n, s1, s2 and n_, s1_, s2_."""
    near = F.bit_count(F.col("s1").bitwiseXOR(F.col("s1_"))) + F.bit_count(F.col("s2").bitwiseXOR(F.col("s2_")))
    return (F.col("n") >= F.col("n_") * t - 1e-9) & (F.col("n_") >= F.col("n") * t - 1e-9) & (near <= F.floor((F.col("n") + F.col("n_")) * ((1 - t) / (1 + t)) + 1e-9))


def linked_pairs(sets: DataFrame, t: float = 0.6, fragments: int = 4, block: int = 2000) -> DataFrame:
    """``(a, b)``: links between different run sets with Jaccard similarity >= ``t`` that connect whatever all such links
    connect. ``sets`` has ``h`` (hash of the set) and ``grams``; a set that occurs several times is one record.

    All similar pairs are links, except that two records of one long list (of more than ``block``) that are both linked
    to its first record are not compared again, so a group that holds a large share of all rows costs links in
    proportion to its size."""
    return _linked(cut(_pages(sets)), t, fragments, block)


def _linked(pages: DataFrame, t: float, fragments: int, block: int) -> DataFrame:
    sc = pages.sparkSession.sparkContext
    size = pages.agg(F.sum(F.length("runs")).alias("n")).first()["n"] or 0
    of = max(sc.defaultParallelism * 2, -(-size // TASK_BYTES))
    levels = cut(_levels(pages, of))
    cuts = _borders(levels, fragments)
    ranked = _with_levels(pages, levels, of)
    heads = cut(_heads(ranked, t, of, block))
    post = heads.select(F.explode(F.concat("cold", "warm")).alias("g"), "h", "n", "s1", "s2")
    hot = heads.select(F.explode("warm").alias("g"), "h").distinct().groupBy("g").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")).where("blocks > 1")
    rows = heads.agg(F.sum(F.size("cold") + F.size("warm")).alias("n")).first()["n"] or 0
    met, first_links = [], None
    hot = cut(hot)
    if not hot.isEmpty():
        hot = broadcast_if(hot, 100_000)
        long = cut(post.join(hot, "g").distinct())
        post = post.join(hot, "g", "left_anti")
        # every record of a long list against the list's first
        lead = long.groupBy("g").agg(F.min_by(F.struct(*(F.col(c).alias(f"{c}_") for c in ("h", "n", "s1", "s2"))), "h").alias("l")).select("g", "l.*")
        long = long.join(broadcast_if(lead, 100_000), "g")
        asked = cut(long.where("h <> h_").where(_near(t)).select(F.col("h_").alias("a"), F.col("h").alias("b")).distinct())
        first_links = cut(_verified(ranked, asked, cuts, of, t).select("a", "b"))
        led = first_links.select(F.col("a").alias("h_"), F.col("b").alias("h"), F.lit(True).alias("led"))
        salt = F.pmod(F.xxhash64("h"), F.col("blocks")).cast("int")
        long = cut(long.join(led, ["h_", "h"], "left").select("g", "h", "n", "s1", "s2", "blocks", (F.col("led").isNull() & (F.col("h") != F.col("h_"))).alias("open"), salt.alias("s")))
        # the lists are cut into salted blocks, and pairs of blocks go to different tasks; one of a pair must be open
        each = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        left = long.where("open").select("g", "s", each.alias("o"), "h", "n", "s1", "s2")
        right = long.select("g", F.col("s").alias("o"), each.alias("s"), "open", *(F.col(c).alias(f"{c}_") for c in ("h", "n", "s1", "s2")))
        both = left.join(right, ["g", "s", "o"]).where("h < h_ OR (NOT open AND h <> h_)").where(_near(t))
        met.append(both.select(F.least("h", "h_").alias("a"), F.greatest("h", "h_").alias("b"), F.when(F.col("h") < F.col("h_"), F.col("n")).otherwise(F.col("n_")).alias("n_a"), F.when(F.col("h") < F.col("h_"), F.col("n_")).otherwise(F.col("n")).alias("n_b")))
    parts = max(sc.defaultParallelism * 2, -(-rows // TASK_ROWS))
    met.append(_meet(post.repartition(parts, "g"), t))
    pairs = met[0] if len(met) == 1 else met[0].unionByName(met[1])
    need = F.ceil((F.col("n_a") + F.col("n_b")) * (t / (1 + t)) - 1e-9)
    # whatever two sets share outside their prefixes lies behind the prefix of one of them, so the prefixes must share the
    # rest; a pair that misses a long list here is linked through that list's first record
    behind = F.greatest(*(F.greatest(F.ceil(F.col(n) * t - 1e-9) - SHARED, F.lit(0)) for n in ("n_a", "n_b")))
    pairs = cut(pairs.groupBy("a", "b", "n_a", "n_b").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= need - behind).select("a", "b"))
    free(heads)  # the pairs are written, and all else comes from the pages
    links = _verified(ranked, pairs, cuts, of, t).select("a", "b")
    return links if first_links is None else links.unionByName(first_links)


def _classes(df: DataFrame, key: str, scripts: dict[str, str] | None, k: int, t: float, fragments: int) -> tuple[DataFrame, DataFrame]:
    sets = run_sets(df, key, scripts, k).where("length(grams) > 0").select(key, F.xxhash64("grams").alias("h"), "grams")
    pages = cut(_pages(sets, key))
    return cut(_members(pages, key)), cut(_linked(pages, t, fragments, BLOCK))


def groups(df: DataFrame, key: str, scripts: dict[str, str] | None = None, k: int = 3, t: float = 0.6, fragments: int = 4) -> DataFrame:
    """``(key, class_id, class_size)`` for every record that has runs: its class (the smallest key in it) and the number of
    keys in the class. A record alone is its own class."""
    members, pairs = _classes(df, key, scripts, k, t, fragments)
    comp = connected_components(pairs, "a", "b").select(F.col("node").alias("h"), "component")
    named = members.join(comp, "h", "left").select(key, F.coalesce("component", "h").alias("c"))
    first = named.groupBy("c").agg(F.min(key).alias("class_id"), F.countDistinct(key).alias("class_size"))
    return named.join(first, "c").groupBy(key).agg(F.min("class_id").alias("class_id"), F.max("class_size").alias("class_size"))


def found(df: DataFrame, key: str, scripts: dict[str, str] | None = None) -> DataFrame:
    """``(row_a, row_b)`` of all rows in one group."""
    members, pairs = _classes(df, key, scripts, 3, 0.6, 4)
    comp = connected_components(pairs, "a", "b").select(F.col("node").alias("h"), "component")
    g = members.join(comp, "h", "left").select(key, F.coalesce("component", "h").alias("c"))
    # all pairs of a group are the result; a large group is dealt into blocks, and each block meets the group in a task
    some = g.groupBy("c").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("c", F.ceil(F.col("rows") / PAIR_BLOCK).cast("int").alias("blocks"))
    g = cut(g.join(some, "c"))
    one = g.select("c", F.pmod(F.xxhash64(key), F.col("blocks")).cast("int").alias("s"), F.col(key).alias("row_a"))
    other = g.select("c", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("s"), F.col(key).alias("row_b"))
    return one.join(other, ["c", "s"]).where("row_a < row_b").select("row_a", "row_b")

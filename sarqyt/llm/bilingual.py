"""Problem 3: pairs of sentences that translate each other, in documents that are rough translations.

1. Learning. From cells that stand in one row of the corpus (and the glossary) a table says how strongly a frequent word of
   one language speaks for one of the other: p(other | word) over all rows, against how often the other comes anyway.
   Frequent means in at least one row of ``RARE``, so the vocabulary is bounded by ``RARE`` * words per row.
2. Bags. A sentence becomes a weighted bag in the other language: its frequent words are replaced by what they speak
   for; rare words (names) by their spelling in a common alphabet; numbers by their digits. The other side becomes a
   bag of its own words, names and numbers.
3. Retrieval. Bags meet through inverted indexes (document, token), in both directions; the overlap is the sum of the
   smaller weights. A pair is an anchor if it is among the best of both of its sides and covers enough of one of them.
4. Merges grow from anchors: a neighbour of an anchored sentence is added if most of it is found in the same partner,
   or if what the anchors leave unexplained on both sides agrees.

Documents meet in one task, sorted, and are worked off one Arrow batch of whole documents at a time. A document of more
than ``LARGE`` sentences is not gathered: its sentences are dealt into blocks, each block of one side meets each of the
other in a task of its own, with the same rules for anchors, and merges grown by joins on neighbouring positions.

Defined results: null and empty sentences, and rows without a document, pair with nothing; rows loaded twice (same
document, place and text) pair each.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sarqyt.session import cut, spread

RARE = 500
LARGE = 3_000
MOST_TERMS = 100_000
MOST_CELLS = 2_000_000
SPEAKS = 4  # a word of one language is replaced by so many of the other at most, the best first
LIFT, DICE = 3, 0.15
HEAVY = 4_000_000
BLOCK, CELLS = 8192, 1 << 22
ANCHOR, PART, NEAR, LEAST, REST = 0.45, 0.45, 0.8, 3.0, 4.0

TOKEN = re.compile(r"(?<![\w])\d{1,3}(?:[    ]\d{3})+(?:[.,]\d+)?|\d+(?:[.,]\d+)*|[^\W\d_]+")
# Kazakh letters as Russian ones, and the common Latin spelling of the Cyrillic letters
KAZ_RUS = str.maketrans("әғқңөұүһі", "агкноуухи")
LATIN = {"а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "e", "ж": "zh", "з": "z", "и": "i", "й": "i", "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "yu", "я": "ya"}
TO_LATIN = str.maketrans(LATIN)


def spelled(word: str) -> str:
    """A name in the common alphabet."""
    return word.translate(KAZ_RUS).translate(TO_LATIN)


def code(kind: str, token: str) -> int:
    return xxhash.xxh3_64_intdigest(kind + token) >> 1


def _number_weight(digits: str) -> float:
    return (0.8, 1.4, 2.4, 3.2)[min(len(digits), 4) - 1]


NAME = 3.0


class Bags:
    """Bags of one language: ``table`` gives, for a frequent word, the tokens it speaks for and their weights."""

    def __init__(self, table: dict[str, list[tuple[int, float]]]) -> None:
        self.table = table
        self.known: dict[str, list[tuple[int, float]]] = {}

    def word(self, w: str) -> list[tuple[int, float]]:
        if w[0].isdigit():
            d = re.sub(r"\D", "", w)
            return [(code("#", d), _number_weight(d))]
        return [(code("~", spelled(w)), NAME)] if len(w) > 2 else []

    def bag(self, text: str) -> dict[int, float]:
        out: dict[int, float] = {}
        known, table = self.known, self.table
        for w in TOKEN.findall(text.lower()):
            got = table.get(w)
            if got is None:
                got = known.get(w)
                if got is None:
                    if len(known) > 200_000:
                        known.clear()
                    got = known[w] = self.word(w)
            for c, x in got:
                if x > out.get(c, 0.0):
                    out[c] = x
        return out


def _frequent(rows: DataFrame, columns: list[str]) -> tuple[dict[str, dict[str, int]], int]:
    """Words in at least one row of ``RARE``, per column, with their row counts; and the number of rows."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {c: Counter() for c in columns}
        n = 0
        for b in batches:
            n += b.num_rows
            for c in columns:
                for t in b.column(c).to_pylist():
                    if t:
                        total[c].update({w for w in TOKEN.findall(t.lower()) if not w[0].isdigit()})
        flat = [(c, w, k) for c, x in total.items() for w, k in x.items()] + [("", "", n)]
        for i in range(0, len(flat), 50_000):
            part = flat[i : i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in part], k) for j, k in enumerate((pa.string(), pa.string(), pa.int64()))], ["side", "word", "n"])

    counts = cut(rows.select(*columns).mapInArrow(go, "side string, word string, n bigint").groupBy("side", "word").agg(F.sum("n").alias("n")))
    whole = counts.where("side = ''").agg(F.max("n")).first()[0] or 0
    got = counts.where((F.col("side") != "") & (F.col("n") * RARE >= whole) & (F.col("n") > 1)).toArrow()
    out: dict[str, dict[str, int]] = {c: {} for c in columns}
    for s, w, k in zip(*(got[c].to_pylist() for c in ("side", "word", "n")), strict=True):
        out[s][w] = k
    return out, whole


def learn(corpus: DataFrame, glossary: DataFrame, source: str, targets: list[str]) -> dict[str, tuple[dict, dict]]:
    """Per target language the bags' tables: of the source (translated) and of the target (its own words)."""
    columns = [source, *targets]
    rows = spread(corpus.select("row_id", *columns), "row_id").select(*columns)
    frequent, whole = _frequent(rows, columns)
    words = {c: {w: i for i, w in enumerate(sorted(x))} for c, x in frequent.items()}
    shared = rows.sparkSession.sparkContext.broadcast(words)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        cells = {t: (np.empty(0, np.int64), np.empty(0, np.int64)) for t in targets}

        def out(k: int, t: str) -> Iterator[pa.RecordBatch]:
            at, n = cells[t]
            cells[t] = (at[:0], n[:0])
            for i in range(0, len(at), 50_000):
                part = at[i : i + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), k, np.int32)), pa.array(part // len(index[t])), pa.array(part % len(index[t])), pa.array(n[i : i + 50_000])], ["t", "s", "o", "n"])

        for b in batches:
            ids = {}
            for c in columns:
                get = index[c].get
                ids[c] = [np.array(sorted({i for w in TOKEN.findall(t.lower()) if (i := get(w)) is not None}), np.int64) if t else None for t in b.column(c).to_pylist()]
            for k, t in enumerate(targets):
                n = len(index[t])
                flat = [(s[:, None] * n + o).ravel() for s, o in zip(ids[source], ids[t], strict=True) if s is not None and o is not None]
                if flat:
                    # only cells that occur are held
                    one, count = np.unique(np.concatenate(flat), return_counts=True)
                    at, back = np.unique(np.concatenate([cells[t][0], one]), return_inverse=True)
                    cells[t] = at, np.bincount(back, weights=np.concatenate([cells[t][1], count])).astype(np.int64)
                    if len(at) > MOST_CELLS:
                        yield from out(k, t)
        for k, t in enumerate(targets):
            yield from out(k, t)

    both = rows.mapInArrow(go, "t int, s bigint, o bigint, n bigint").groupBy("t", "s", "o").agg(F.sum("n").alias("n"))
    # the word counts are as bounded as the vocabulary; only cells that say something come to the driver
    spark = rows.sparkSession
    sides = [(-1, i, frequent[source][w]) for w, i in words[source].items()] + [(k, i, frequent[t][w]) for k, t in enumerate(targets) for w, i in words[t].items()]
    sizes = spark.createDataFrame(pa.table([pa.array([r[j] for r in sides], k) for j, k in enumerate((pa.int32(), pa.int64(), pa.int64()))], ["t", "i", "c"]))
    got = both.join(F.broadcast(sizes.where("t < 0").select(F.col("i").alias("s"), F.col("c").alias("cs"))), "s").join(F.broadcast(sizes.where("t >= 0").select("t", F.col("i").alias("o"), F.col("c").alias("ct"))), ["t", "o"])
    # how much more often together than apart, and the share of the rarer word's rows
    got = got.withColumns({"dice": 2.0 * F.col("n") / (F.col("cs") + F.col("ct")), "lift": F.col("n").cast("double") * max(1, whole) / (F.col("cs") * F.col("ct"))}).where((F.col("n") >= 3) & (F.col("lift") > LIFT) & (F.col("dice") > DICE)).select("t", "s", "o", "dice").toArrow()
    tt, ss, oo, dd = (got[c].to_numpy() for c in ("t", "s", "o", "dice"))
    terms = glossary.select(*columns).limit(MOST_TERMS + 1).toArrow().to_pylist()
    if len(terms) > MOST_TERMS:
        raise ValueError(f"a glossary of more than {MOST_TERMS} terms")
    out = {}
    for k, t in enumerate(targets):
        sw, tw = sorted(words[source]), sorted(words[t])
        ct = np.array([frequent[t][w] for w in tw], float)
        m = tt == k
        s, o, dice = ss[m], oo[m], dd[m]
        idf_t = np.log(max(2, whole) / ct) / 4
        table: dict[str, list[tuple[int, float]]] = {w: [] for w in sw}
        spoken = np.zeros(len(tw), bool)
        for i in np.lexsort((o, s, -dice)):
            if len(table[sw[s[i]]]) < SPEAKS:
                table[sw[s[i]]].append((code("=", tw[o[i]]), float(min(1.5, idf_t[o[i]]) * min(1.0, 1.5 * dice[i]))))
                spoken[o[i]] = True
        # a frequent target word that no word speaks for would only dilute its bag
        own = {w: [(code("=", w), float(min(1.5, idf_t[i])))] if spoken[i] else [] for i, w in enumerate(tw)}
        for term in terms:
            a, b = term[source], term[t]
            if a and b:
                for x, y in zip(a.lower().split(), b.lower().split(), strict=False) if len(a.split()) == len(b.split()) else ():
                    if x not in table and y not in own and spelled(x) != spelled(y):
                        table[x] = [(code("=", y), 1.5)]
                        own[y] = [(code("=", y), 1.5)]
        out[t] = (table, own)
    return out


def _sums(owner: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner, weights=weight, minlength=n)


class Side:
    """Bags of many sentences as flat arrays sorted by (document, token)."""

    def __init__(self, docs: np.ndarray, bags: list[dict[int, float]]) -> None:
        size = np.array([len(b) for b in bags], np.int64)
        self.owner = np.repeat(np.arange(len(bags)), size)
        self.token = np.fromiter((k for b in bags for k in b), np.int64, int(size.sum()))
        self.weight = np.fromiter((x for b in bags for x in b.values()), np.float64, int(size.sum()))
        with np.errstate(over="ignore"):
            self.place = (docs[self.owner].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ self.token.astype(np.uint64)
        o = np.argsort(self.place, kind="stable")
        self.owner, self.weight, self.place = self.owner[o], self.weight[o], self.place[o]
        self.norm = _sums(self.owner, self.weight, len(bags))


def meet(a: Side, b: Side) -> tuple[np.ndarray, ...]:
    """Token by token: the sentences of both sides that share it, and the smaller weight."""
    lo, hi = np.searchsorted(b.place, a.place, "left"), np.searchsorted(b.place, a.place, "right")
    n = hi - lo
    ia = np.repeat(np.arange(len(n)), n)
    ib = np.arange(len(ia)) - np.repeat(np.cumsum(n) - n, n) + lo[ia]
    return a.owner[ia], b.owner[ib], np.minimum(a.weight[ia], b.weight[ib]), ia, ib


def matches(docs_a: np.ndarray, pos_a: np.ndarray, a: Side, docs_b: np.ndarray, pos_b: np.ndarray, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (index in a, index in b)."""
    x, y, w, ia, ib = meet(a, b)
    if not len(x):
        return x, y
    key = x * len(b.norm) + y
    pair, back = np.unique(key, return_inverse=True)
    s = np.bincount(back, weights=w)
    x2, y2 = pair // len(b.norm), pair % len(b.norm)
    best_a, best_b = np.zeros(len(a.norm)), np.zeros(len(b.norm))
    np.maximum.at(best_a, x2, s)
    np.maximum.at(best_b, y2, s)
    in_a, in_b = s / np.maximum(a.norm[x2], 1e-9), s / np.maximum(b.norm[y2], 1e-9)
    top_a, top_b = s >= NEAR * best_a[x2], s >= NEAR * best_b[y2]
    cover = np.maximum(in_a, in_b)
    anchor = top_a & top_b & (cover >= ANCHOR) & (s >= np.minimum(LEAST, 0.8 * np.minimum(a.norm[x2], b.norm[y2])))
    # merges: a sentence that lies mostly in the partner of a neighbour
    def beside(at: np.ndarray) -> np.ndarray:
        """Whether a pair has a neighbour pair (one sentence shared, the other next to it) in ``at``."""
        place_a = {}
        for i in np.flatnonzero(at):
            place_a.setdefault((0, int(y2[i])), []).append(int(pos_a[x2[i]]))
            place_a.setdefault((1, int(x2[i])), []).append(int(pos_b[y2[i]]))
        out = np.zeros(len(x2), bool)
        for i in np.flatnonzero(~at & (s >= 2.0)):
            p, q = int(pos_a[x2[i]]), int(pos_b[y2[i]])
            out[i] = any(abs(r - p) <= 2 for r in place_a.get((0, int(y2[i])), ())) or any(abs(r - q) <= 2 for r in place_a.get((1, int(x2[i])), ()))
        return out

    inside = ((top_a & (in_a >= PART)) | (top_b & (in_b >= PART))) & (s >= 2.0) & ~anchor
    if inside.any():
        anchor |= inside & (beside(anchor) | (cover >= 0.7))
    # what the anchors leave unexplained on both sides, token by token
    taken = anchor[back]
    used_a, used_b = np.zeros(len(a.weight), bool), np.zeros(len(b.weight), bool)
    used_a[ia[taken]] = True
    used_b[ib[taken]] = True
    free = ~used_a[ia] & ~used_b[ib]
    rest = np.bincount(back[free], weights=w[free], minlength=len(pair))
    left_a = _sums(a.owner, np.where(used_a, 0, a.weight), len(a.norm))
    left_b = _sums(b.owner, np.where(used_b, 0, b.weight), len(b.norm))
    more = (rest >= REST) & (rest >= 0.5 * np.minimum(left_a[x2], left_b[y2])) & ~anchor
    if more.any():
        anchor |= more & beside(anchor)
    return x2[anchor], y2[anchor]


def _gathered(rows: DataFrame, tables, targets: list[str], own_rows: bool) -> DataFrame:
    """Pairs of the documents in each task; rows (doc, side, key, pos, text) come sorted by document."""
    schema = pa.schema([("side", pa.string()), ("kaz_key", pa.int64()), ("other_key", pa.int64())])

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tables.value
        source = {k: Bags(t[k][0]) for k in targets}
        other = {k: Bags(t[k][1]) for k in targets}

        def work(cols: list) -> pa.RecordBatch:
            doc, side, key, pos, text = cols
            sides = np.array(side)
            got: list[tuple[str, np.ndarray, np.ndarray]] = []
            a = np.flatnonzero(sides == "")
            for k in targets:
                b = np.flatnonzero(sides == k)
                if not len(a) or not len(b):
                    continue
                # only documents that have both
                mine = a[np.isin(doc[a], doc[b])]
                left = Side(doc[mine], [source[k].bag(text[i]) for i in mine])
                right = Side(doc[b], [other[k].bag(text[i]) for i in b])
                x, y = matches(doc[mine], pos[mine], left, doc[b], pos[b], right)
                ka, kb = key[mine[x]], key[b[y]]
                if own_rows:
                    keep = ~np.isin(ka, ka[ka == kb])
                    ka, kb = ka[keep], kb[keep]
                got.append((k, ka, kb))
            return pa.RecordBatch.from_arrays([pa.array([k for k, x, _ in got for _ in range(len(x))], pa.string()), pa.array(np.concatenate([x for _, x, _ in got]) if got else [], pa.int64()), pa.array(np.concatenate([y for _, _, y in got]) if got else [], pa.int64())], schema=schema)

        rest: list = []
        for b in batches:
            cols = [b.column(0).to_numpy(), b.column(1).to_pylist(), b.column(2).to_numpy(), b.column(3).to_numpy(), b.column(4).to_pylist()]
            if rest:
                cols = [np.concatenate([x, y]) if isinstance(x, np.ndarray) else x + y for x, y in zip(rest, cols, strict=True)]
            n = len(cols[0])
            end = int(np.flatnonzero(cols[0] != cols[0][-1])[-1]) + 1 if n and (cols[0] != cols[0][-1]).any() else 0
            if end >= 4000:
                yield work([c[:end] for c in cols])
                rest = [c[end:] for c in cols]
            else:
                rest = cols
        if rest and len(rest[0]):
            yield work(rest)

    return rows.mapInArrow(go, "side string, kaz_key bigint, other_key bigint")


SCHEMA = "doc bigint, side string, kaz_key bigint, other_key bigint, p bigint, q bigint, na double, nb double, s double"


def _least(norm: np.ndarray) -> np.ndarray:
    """The least overlap with which a pair counts whose smaller bag has this weight (it grows with the weight)."""
    return np.maximum(PART * norm, np.minimum(2.0, 0.8 * norm)) * (1 - 1e-9)


def _block(t: pa.Table, heavy: int) -> Iterator[tuple]:
    """Of one block of sources and one of targets, (x, y, overlap): the pairs that can count, and (x, -1, best) and
    (-1, y, best) of every sentence. Overlaps are summed in a table of some thousand cells a sentence, from at most
    ``heavy`` shared tokens at a time (or the one of a sentence with more)."""
    src = t["src"].to_numpy()
    size = t["tokens"].combine_chunks().value_lengths().to_numpy()
    first = np.cumsum(size) - size
    token, weight = t["tokens"].combine_chunks().flatten().to_numpy(), t["weights"].combine_chunks().flatten().to_numpy()
    norm = t["norm"].to_numpy()
    a, b = np.flatnonzero(src), np.flatnonzero(~src)
    if not len(a) or not len(b):
        return
    owner = np.repeat(np.arange(len(src)), size)
    place = np.zeros(len(src), np.int64)
    place[b] = np.arange(len(b))
    mine = np.flatnonzero(~src[owner])
    mine = mine[np.argsort(token[mine], kind="stable")]
    tb, wb, ob = token[mine], weight[mine], place[owner[mine]]
    best_b = np.zeros(len(b))
    rows = max(1, CELLS // len(b))
    for i in range(0, len(a), rows):
        x = a[i : i + rows]
        at = np.concatenate([np.arange(first[k], first[k] + size[k]) for k in x])
        who = np.repeat(np.arange(len(x)), size[x])
        lo, hi = np.searchsorted(tb, token[at], "left"), np.searchsorted(tb, token[at], "right")
        n = hi - lo
        table = np.zeros(len(x) * len(b))
        ends = np.cumsum(n)
        k = 0
        while k < len(n):
            e = max(k + 1, int(np.searchsorted(ends, (ends[k - 1] if k else 0) + heavy, "right")))
            ia = np.repeat(np.arange(k, e), n[k:e])
            ib = np.arange(len(ia)) - np.repeat(np.cumsum(n[k:e]) - n[k:e], n[k:e]) + lo[ia]
            if len(ia):
                cell = who[ia] * len(b) + ob[ib]
                w = np.minimum(weight[at[ia]], wb[ib])
                if len(ia) * 4 > len(table):
                    table += np.bincount(cell, weights=w, minlength=len(table))
                else:
                    np.add.at(table, cell, w)
            k = e
        table = table.reshape(len(x), len(b))
        best_a, best = table.max(axis=1), table.max(axis=0)
        best_b = np.maximum(best_b, best)
        good = table >= np.minimum.outer(_least(norm[x]), _least(norm[b]))
        good &= (table >= NEAR * best_a[:, None]) | (table >= NEAR * best[None, :])
        good |= table >= REST * (1 - 1e-9)
        u, v = np.nonzero(good)
        yield x[u], b[v], table[u, v]
        yield x, np.full(len(x), -1), best_a
    yield np.full(len(b), -1), b, best_b


def _overlaps(bags: DataFrame, block: int, heavy: int) -> DataFrame:
    """``SCHEMA``: the pairs that can count, and of every sentence of either side (the other key null) its best overlap with
    any. Both sides of a document are dealt into blocks; each block of sources meets each of targets in one task."""
    sizes = bags.groupBy("doc", "side").agg(F.count_if("src").alias("x"), F.count_if(~F.col("src")).alias("y"))
    sizes = sizes.where("x > 0 AND y > 0").select("doc", "side", *(F.ceil(F.col(c) / block).cast("int").alias(c) for c in "xy"))
    h = F.xxhash64("key")
    own = F.pmod(h, F.when(F.col("src"), F.col("x")).otherwise(F.col("y"))).cast("int")
    dealt = bags.join(sizes, ["doc", "side"]).select("doc", "side", "src", "key", "pos", "tokens", "weights", "norm", own.alias("own"), F.explode(F.sequence(F.lit(0), F.when(F.col("src"), F.col("y")).otherwise(F.col("x")) - 1)).alias("meets"))
    dealt = dealt.withColumns({"bx": F.when(F.col("src"), F.col("own")).otherwise(F.col("meets")), "by": F.when(F.col("src"), F.col("meets")).otherwise(F.col("own"))}).drop("own", "meets")
    schema = pa.schema([("doc", pa.int64()), ("side", pa.string()), ("kaz_key", pa.int64()), ("other_key", pa.int64()), ("p", pa.int64()), ("q", pa.int64()), ("na", pa.float64()), ("nb", pa.float64()), ("s", pa.float64())])

    def go(t: pa.Table) -> pa.Table:
        got = list(_block(t, heavy))
        if not got:
            return schema.empty_table()
        x, y, s = (np.concatenate(c) for c in zip(*got, strict=True))
        key, pos, norm = (t[c].to_numpy() for c in ("key", "pos", "norm"))
        no_x, no_y = x < 0, y < 0
        cols = [pa.array(v[i], mask=m) for v in (key, pos, norm) for i, m in ((x, no_x), (y, no_y))]
        doc, side = t["doc"][0].as_py(), t["side"][0].as_py()
        return pa.Table.from_arrays([pa.array(np.full(len(x), doc, np.int64)), pa.array([side] * len(x), pa.string()), *cols, pa.array(s)], schema=schema)

    return dealt.groupBy("doc", "side", "bx", "by").applyInArrow(go, SCHEMA)


def _joined(rows: DataFrame, tables, targets: list[str], own_rows: bool, heavy: int = HEAVY, block: int = BLOCK) -> DataFrame:
    """The same for documents too large for one task: every pair of blocks of their sentences is summed exactly, common
    words and all, and only the pairs that can count and the best overlap of each sentence leave the task."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tables.value
        source = {k: Bags(t[k][0]) for k in targets}
        other = {k: Bags(t[k][1]) for k in targets}
        for b in batches:
            out = []
            for doc, side, key, pos, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for k in [side] if side else targets:
                    bag = (other if side else source)[k].bag(text)
                    norm = sum(bag.values())
                    if norm > 0:
                        out.append((doc, k, not side, key, pos, list(bag), list(bag.values()), norm))
            kinds = (pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], k) for j, k in enumerate(kinds)], ["doc", "side", "src", "key", "pos", "tokens", "weights", "norm"])

    bags = cut(spread(rows, "key").mapInArrow(go, "doc bigint, side string, src boolean, key bigint, pos bigint, tokens array<bigint>, weights array<double>, norm double"))
    got = cut(_overlaps(bags, block, heavy))
    best = {k: got.where(f"{o} IS NULL").groupBy("doc", "side", k).agg(F.max("s").alias(c)) for k, o, c in (("kaz_key", "other_key", "ba"), ("other_key", "kaz_key", "bb"))}
    pair = got.where("kaz_key IS NOT NULL AND other_key IS NOT NULL").join(best["kaz_key"], ["doc", "side", "kaz_key"]).join(best["other_key"], ["doc", "side", "other_key"])
    top_a, top_b = F.col("s") >= NEAR * F.col("ba"), F.col("s") >= NEAR * F.col("bb")
    cover = F.col("s") / F.least("na", "nb")
    anchor = top_a & top_b & (cover >= ANCHOR) & (F.col("s") >= F.least(F.lit(LEAST), 0.8 * F.least("na", "nb")))
    inside = ((top_a & (F.col("s") >= PART * F.col("na"))) | (top_b & (F.col("s") >= PART * F.col("nb")))) & (F.col("s") >= 2.0)
    grown = _beside(pair.withColumn("at", anchor)).withColumn("at", F.col("at") | (inside & (F.col("beside") | (cover >= 0.7))))
    near = cut(_beside(grown).where(F.col("at") | (F.col("beside") & (F.col("s") >= REST * (1 - 1e-9)))).select("doc", "side", "kaz_key", "other_key", "at"))
    got = near.where("at").unionByName(_left_over(near, bags)).select("side", "kaz_key", "other_key")
    if own_rows:
        own = got.where("kaz_key = other_key").select("side", "kaz_key")
        got = got.join(own, ["side", "kaz_key"], "left_anti")
    return got


def _left_over(near: DataFrame, bags: DataFrame) -> DataFrame:
    """Of the pairs beside others (not ``at``), those that agree in what the pairs ``at`` leave unexplained on both sides."""
    sides = (("kaz_key", "a", bags.where("src")), ("other_key", "b", bags.where("NOT src")))
    sure, maybe = near.where("at"), near.where("NOT at")
    for k, c, of in sides:
        of = of.select("doc", "side", F.col("key").alias(k), F.map_from_arrays("tokens", "weights").alias(f"m{c}"))
        sure, maybe = sure.join(of, ["doc", "side", k]), maybe.join(of, ["doc", "side", k])

    def free(m: str) -> Column:
        return F.array_except(F.map_keys(m), F.coalesce(f"u{m}", F.array().cast("array<bigint>")))

    for k, c, _ in sides:
        used = sure.join(near.where("NOT at").select("doc", "side", k).distinct(), ["doc", "side", k], "left_semi")
        used = used.select("doc", "side", k, F.explode(F.array_intersect(F.map_keys("ma"), F.map_keys("mb"))).alias("token")).distinct().groupBy("doc", "side", k).agg(F.collect_list("token").alias(f"um{c}"))
        maybe = maybe.join(used, ["doc", "side", k], "left")
    def left(m: str) -> Column:
        return F.aggregate(free(m), F.lit(0.0), lambda t, x: t + F.element_at(m, x))

    rest = F.aggregate(F.array_intersect(free("ma"), free("mb")), F.lit(0.0), lambda t, x: t + F.least(F.element_at("ma", x), F.element_at("mb", x)))
    return maybe.select("doc", "side", "kaz_key", "other_key", "at", rest.alias("rest"), F.least(left("ma"), left("mb")).alias("left")).where((F.col("rest") >= REST) & (F.col("rest") >= 0.5 * F.col("left"))).drop("rest", "left")


def _beside(pair: DataFrame) -> DataFrame:
    """Adds whether a pair has a neighbour pair (one sentence shared, the other next to it) in ``at``."""
    near = [F.max(F.col("at").cast("int")).over(Window.partitionBy("doc", "side", k).orderBy(o).rangeBetween(-2, 2)) for k, o in (("other_key", "p"), ("kaz_key", "q"))]
    return pair.withColumn("beside", (near[0] == 1) | (near[1] == 1))


def align(rows: DataFrame, tables: dict, targets: list[str], own_rows: bool = False, large: int = LARGE, heavy: int = HEAVY, block: int = BLOCK) -> DataFrame:
    """``(side, kaz_key, other_key)``: rows (doc bigint, side '' for the source or a target's name, key, pos, text). With
    ``own_rows`` keys of both sides name the same rows, and sources that their own row translates are left out."""
    sc = rows.sparkSession.sparkContext
    shared = sc.broadcast(tables)
    rows = rows.where("doc IS NOT NULL AND key IS NOT NULL AND text IS NOT NULL AND trim(text) <> ''").select("doc", "side", "key", F.coalesce(F.col("pos").cast("bigint"), F.lit(0)).alias("pos"), "text")
    many = rows.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > large).select("doc")
    parts = max(rows.rdd.getNumPartitions(), sc.defaultParallelism * 2)
    if many.isEmpty():
        return _gathered(rows.repartition(parts, "doc").sortWithinPartitions("doc", "side", "pos", "key"), shared, targets, own_rows)
    small = rows.join(many, "doc", "left_anti")
    return _gathered(small.repartition(parts, "doc").sortWithinPartitions("doc", "side", "pos", "key"), shared, targets, own_rows).unionByName(_joined(rows.join(many, "doc", "left_semi"), shared, targets, own_rows, heavy, block))


def sentence_rows(kaz: DataFrame, rus: DataFrame, eng: DataFrame) -> DataFrame:
    def one(df: DataFrame, side: str) -> DataFrame:
        doc = F.xxhash64(F.coalesce("collection", F.lit("\x00")), F.regexp_replace("source_file", r"_[^_]*$", ""))
        return df.select(F.when(F.col("source_file").isNotNull(), doc).alias("doc"), F.lit(side).alias("side"), F.col("sent_id").alias("key"), F.col("sentence_idx").alias("pos"), "text")

    return one(kaz, "").unionByName(one(rus, "rus")).unionByName(one(eng, "eng"))


def cell_rows(corpus: DataFrame) -> DataFrame:
    doc = F.when(F.col("metadata.source_doc").isNotNull(), F.xxhash64("metadata.source_doc")).otherwise(F.when(F.col("id").isNotNull(), F.xxhash64(F.regexp_replace("id", r"_[^_]*$", ""))))
    pos = F.coalesce(F.regexp_extract("id", r"_(\d+)$", 1).try_cast("bigint"), F.lit(0))
    each = F.explode(F.array(*(F.struct(F.lit("" if c == "kaz" else c).alias("side"), F.col(c).alias("text")) for c in ("kaz", "rus", "eng")))).alias("x")
    return corpus.select(doc.alias("doc"), F.col("row_id").alias("key"), pos.alias("pos"), each).select("doc", "x.side", "key", "pos", "x.text")


def found(kaz: DataFrame, rus: DataFrame, eng: DataFrame, corpus: DataFrame, glossary: DataFrame) -> DataFrame:
    """``(field, kaz_key, other_key)`` over both kinds of documents."""
    targets = ["rus", "eng"]
    tables = learn(corpus, glossary, "kaz", targets)
    one = align(sentence_rows(kaz, rus, eng), tables, targets).select(F.concat(F.lit("sentences_"), "side").alias("field"), "kaz_key", "other_key")
    two = align(cell_rows(corpus), tables, targets, own_rows=True).select(F.col("side").alias("field"), "kaz_key", "other_key")
    return one.unionByName(two).distinct()

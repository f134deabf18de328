"""Corpus BLEU and chrF over rows ``(id, hypothesis, reference)``.

``corpus_bleu``: whitespace tokens, orders 1 to 4, clipped counts, brevity penalty, no smoothing (a zero precision gives
0). ``bleu``: the customary defaults, that is the public 13a tokenisation and exponential smoothing of zero counts. chrF:
character runs of 1 to 6 without white space, recall weighted twice. Rows with a null side are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sarqyt.functions.rules import Rule, rules


ORDERS = 4
CHAR_ORDERS = 6


_MULT = np.uint64(0x9E3779B97F4A7C15)


def _bags(rows: np.ndarray, codes: np.ndarray, orders: int) -> list[np.ndarray]:
    """For each order, the (row, hash) of every run of so many codes inside one row."""
    out, h = [], np.zeros(len(codes), np.uint64)
    with np.errstate(over="ignore"):
        for n in range(1, orders + 1):
            h = h[: max(0, len(codes) - n + 1)]
            h = (h ^ codes[n - 1 :]) * _MULT
            h ^= h >> np.uint64(31)
            inside = rows[: len(h)] == rows[n - 1 : n - 1 + len(h)]
            out.append(np.stack([rows[: len(h)][inside].astype(np.uint64), h[inside]]))
    return out


def _matched(x: np.ndarray, y: np.ndarray) -> int:
    """Runs in both bags, each as often as the poorer side has it, summed over rows."""
    both = np.concatenate([x, y], axis=1)
    _, at = np.unique(both[0] * np.uint64(0x100000001B3) ^ both[1], return_inverse=True)
    n = at.max(initial=-1) + 1
    return int(np.minimum(np.bincount(at[: x.shape[1]], minlength=n), np.bincount(at[x.shape[1] :], minlength=n)).sum())


def _word_codes(texts: list[str], seen: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    ws = [t.split() for t in texts]
    flat = [seen.setdefault(w, len(seen) + 1) for x in ws for w in x]
    return np.repeat(np.arange(len(ws)), [len(x) for x in ws]), np.array(flat, np.uint64) * _MULT


def _char_codes(texts: list[str], _: dict) -> tuple[np.ndarray, np.ndarray]:
    bare = ["".join(t.split()) for t in texts]
    return np.repeat(np.arange(len(bare)), [len(t) for t in bare]), np.frombuffer("".join(bare).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _statistics(df: DataFrame, codes, orders: int) -> DataFrame:
    """``(n, hyp, ref, both)``: per order the runs of hypotheses, of references, and matched. Counted per Arrow batch in
    numpy; only sums are shuffled."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((orders, 3), np.int64)
        for b in batches:
            seen: dict[str, int] = {}
            x, y = (_bags(*codes(c.to_pylist(), seen), orders) for c in b.columns)
            for k in range(orders):
                total[k] += (x[k].shape[1], y[k].shape[1], _matched(x[k], y[k]))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(1, orders + 1, dtype=np.int32)), *(pa.array(total[:, i]) for i in range(3))], ["n", "hyp", "ref", "both"])

    rows = df.where("hypothesis IS NOT NULL AND reference IS NOT NULL").select("hypothesis", "reference")
    return rows.mapInArrow(go, "n int, hyp bigint, ref bigint, both bigint").groupBy("n").agg(*(F.sum(c).alias(c) for c in ("hyp", "ref", "both")))


def corpus_bleu(df: DataFrame) -> DataFrame:
    """One row: ``score, p1..p4, bp, ratio``."""
    one = lambda c, n: F.max(F.when(F.col("n") == n, F.col(c)).cast("double"))
    s = _statistics(df, _word_codes, ORDERS).agg(*(F.try_divide(one("both", n), one("hyp", n)).alias(f"q{n}") for n in range(1, ORDERS + 1)), F.try_divide(one("hyp", 1), one("ref", 1)).alias("r"))
    p = [F.col(f"q{n}") for n in range(1, ORDERS + 1)]
    bp = F.when(F.col("r") >= 1, 1.0).otherwise(F.exp(1 - F.try_divide(F.lit(1.0), F.col("r"))))
    some = F.lit(True)
    for q in p:
        some = some & (q > 0)
    score = F.when(some, 100 * bp * F.exp(sum((F.ln(q) for q in p), F.lit(0.0)) / ORDERS)).otherwise(0.0)
    return s.select(F.round(score, 6).alias("score"), *(F.round(100 * q, 6).alias(f"p{i + 1}") for i, q in enumerate(p)), F.round(bp, 6).alias("bp"), F.round("r", 6).alias("ratio"))


# The public 13a tokenisation of machine translation metrics
TOKENS_13A = rules(
    Rule("<skipped>", ""), Rule("-\n", ""), Rule("\n", " "), Rule("&quot;", '"'), Rule("&amp;", "&"), Rule("&lt;", "<"), Rule("&gt;", ">"),
    Rule(r"([\{-\~\[-` -&\(-\+:-@/])", r" \1 "), Rule(r"([^0-9])([.,])", r"\1 \2 "), Rule(r"([.,])([^0-9])", r" \1 \2"), Rule(r"([0-9])(-)", r"\1 \2 "),
)


def tokens_13a(c: Column) -> Column:
    return TOKENS_13A.spark(F.concat(F.lit(" "), c, F.lit(" ")))


def tokens_13a_sql(e: str) -> str:
    return TOKENS_13A.sql(f"(' ' || {e} || ' ')")


def bleu(df: DataFrame) -> DataFrame:
    """One row: ``score, p1..p4, bp, ratio`` with the customary defaults; orders without a match count half a match, a quarter,
    and so on, and without any match at all the score is 0."""
    rows = df.select(tokens_13a(F.col("hypothesis")).alias("hypothesis"), tokens_13a(F.col("reference")).alias("reference"))
    one = lambda c, n: F.coalesce(F.max(F.when(F.col("n") == n, F.col(c))), F.lit(0)).cast("double")
    s = _statistics(rows, _word_codes, ORDERS).agg(*(one("both", n).alias(f"m{n}") for n in range(1, ORDERS + 1)), *(one("hyp", n).alias(f"h{n}") for n in range(1, ORDERS + 1)), one("ref", 1).alias("ref"))
    p, zeros = [], F.lit(0)
    for n in range(1, ORDERS + 1):
        m, h = F.col(f"m{n}"), F.col(f"h{n}")
        zeros = zeros + F.when((m == 0) & (h > 0), 1).otherwise(0)
        p.append(F.when(h == 0, 0.0).when(m == 0, F.try_divide(F.lit(100.0), F.pow(F.lit(2.0), zeros) * h)).otherwise(F.try_divide(100 * m, h)))
    some = sum((F.col(f"m{n}") for n in range(1, ORDERS + 1)), F.lit(0.0)) > 0
    all_orders = F.lit(True)
    for n in range(1, ORDERS + 1):
        all_orders = all_orders & (F.col(f"h{n}") > 0)
    hyp, ref = F.col("h1"), F.col("ref")
    bp = F.when(hyp == 0, 0.0).when(hyp < ref, F.exp(1 - F.try_divide(ref, hyp))).otherwise(1.0)
    score = F.when(some & all_orders, bp * F.exp(sum((F.ln(q) for q in p), F.lit(0.0)) / ORDERS)).otherwise(0.0)
    return s.select(F.round(score, 6).alias("score"), *(F.round(F.when(some, q).otherwise(0.0), 6).alias(f"p{i + 1}") for i, q in enumerate(p)), F.round(bp, 6).alias("bp"), F.round(F.coalesce(F.try_divide(hyp, ref), F.lit(0.0)), 6).alias("ratio"))


def corpus_chrf(df: DataFrame, beta: float = 2.0) -> DataFrame:
    """One row: ``score``."""
    s = _statistics(df, _char_codes, CHAR_ORDERS).where("hyp > 0 AND ref > 0")
    s = s.agg(F.avg(F.col("both") / F.col("hyp")).alias("p"), F.avg(F.col("both") / F.col("ref")).alias("r"))
    f = F.try_divide((1 + beta**2) * F.col("p") * F.col("r"), beta**2 * F.col("p") + F.col("r"))
    return s.select(F.round(100 * F.coalesce(f, F.lit(0.0)), 6).alias("score"))

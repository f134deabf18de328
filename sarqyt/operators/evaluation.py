"""Evaluation of translation models on a test set: eligible rows, answers, scores, examples, and comparisons."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sarqyt.functions.text import clean_generation, prompt
from sarqyt.operators import metrics
from sarqyt.operators.models import Generator, answered
from sarqyt.session import cut

SAMPLES = 5
# a neural metric: lists of sources, hypotheses and references to a score each
Scorer = Callable[[list[str], list[str], list[str]], list[float]]


def eligible(test: DataFrame, direction: str, key: str = "id") -> DataFrame:
    """``(key, source, reference)`` of the rows that have text on both sides; a direction of unknown languages has none."""
    a, _, b = direction.partition("2")
    if a not in test.columns or b not in test.columns:
        return test.select(key, F.lit(None).cast("string").alias("source"), F.lit(None).cast("string").alias("reference")).limit(0)
    return test.where((F.coalesce(a, F.lit("")) != "") & (F.coalesce(b, F.lit("")) != "")).select(key, F.col(a).alias("source"), F.col(b).alias("reference"))


def hypotheses(test: DataFrame, direction: str, generator: Generator, key: str = "id") -> DataFrame:
    """``(key, source, reference, hypothesis)``: the model's cleaned answers to the prompts of a direction."""
    rows = eligible(test, direction, key)
    return rows.withColumn("hypothesis", clean_generation(answered(prompt(direction, F.col("source")), generator)))


def neural_scores(rows: DataFrame, scorer: Scorer) -> Column:
    """A score per row by a neural metric given as a callable, batch by batch; rows with a null side have none."""

    @F.pandas_udf("double")
    def run(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for s, h, r in parts:
            some = s.notna() & h.notna() & r.notna()
            out = pd.Series([None] * len(s), index=s.index, dtype="float64")
            if some.any():
                out[some] = scorer(s[some].tolist(), h[some].tolist(), r[some].tolist())
            yield out

    return run("source", "hypothesis", "reference")


def evaluated(test: DataFrame, direction: str, generator: Generator, key: str = "id", scorer: Scorer | None = None) -> DataFrame:
    """One row: ``direction, num_samples, bleu, chrf, comet, samples``; without eligible rows the scores are null.

    The answers are written once and read by all metrics; ``samples`` are those of the smallest keys."""
    rows = cut(hypotheses(test, direction, generator, key))
    first = rows.orderBy(key).limit(SAMPLES).agg(F.array_sort(F.collect_list(F.struct(key, "source", "reference", "hypothesis"))).alias("samples"))
    n = rows.agg(F.count(F.lit(1)).alias("num_samples"))
    comet = rows.agg(F.avg(neural_scores(rows, scorer)).alias("comet")) if scorer else rows.agg(F.lit(None).cast("double").alias("comet"))
    # tables of one row each
    one = F.lit(1).alias("__one")
    out = n.select("*", one)
    for df in (metrics.bleu(rows).select(F.col("score").alias("bleu"), one), metrics.corpus_chrf(rows).select(F.col("score").alias("chrf"), one), comet.select("*", one), first.select("*", one)):
        out = out.join(df, "__one")
    empty = F.col("num_samples") == 0
    return out.select(F.lit(direction).alias("direction"), "num_samples", *(F.when(~empty, F.col(c)).alias(c) for c in ("bleu", "chrf", "comet")), "samples")


def compared(test: DataFrame, direction: str, models: dict[str, Generator], key: str = "id") -> DataFrame:
    """``(model, bleu, chrf)`` of several models, by their full names, on the same test set."""
    out = None
    for name, generator in models.items():
        one = evaluated(test, direction, generator, key).select(F.lit(name).alias("model"), "bleu", "chrf")
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no models to compare")
    return out

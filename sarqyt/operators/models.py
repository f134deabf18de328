"""Model interfaces, as plain callables on lists, and a deterministic double of an encoder for tests and queries."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

Encoder = Callable[[list[str]], np.ndarray]
Generator = Callable[[list[str]], list[str]]
Judge = Callable[[list[str]], list[str]]
Extractor = Callable[[bytes], list[str]]

DIM = 64


def gram_encoder(texts: list[str]) -> np.ndarray:
    """Unit vectors of hashed letter runs: a pure function of the text."""
    out = np.zeros((len(texts), DIM))
    for i, t in enumerate(texts):
        low = f" {t.lower()} "
        for j in range(len(low) - 2):
            h = xxhash.xxh3_64_intdigest(low[j : j + 3])
            out[i, h % DIM] += 1.0 if h >> 63 else -1.0
    return out / (np.linalg.norm(out, axis=1, keepdims=True) + 1e-8)


def encoded(c: Column, encoder: Encoder | None = None, load: Callable[[], Encoder] | None = None) -> Column:
    """Vectors of a text column; null texts give null. ``load`` makes the encoder once per Python worker's task, for models
    that take long to load; else ``encoder`` is used as it is."""
    make = load or (lambda: encoder or gram_encoder)

    @F.pandas_udf("array<float>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = make()
        for s in parts:
            some = s.notna()
            v = encode(s[some].tolist()) if some.any() else []
            out = pd.Series([None] * len(s), index=s.index, dtype=object)
            out[some] = pd.Series([x.astype(np.float32).tolist() for x in v], index=s.index[some], dtype=object)
            yield out

    return run(c)


def answered(c: Column, model: Generator, load: Callable[[], Generator] | None = None) -> Column:
    """What a model of texts answers to prompts, asked batch by batch; null prompts are not asked and give null."""
    make = load or (lambda: model)

    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        answer = make()
        for s in parts:
            some = s.notna()
            out = pd.Series([None] * len(s), index=s.index, dtype=object)
            if some.any():
                out[some] = pd.Series(answer(s[some].tolist()), index=s.index[some], dtype=object)
            yield out

    return run(c)


generated = answered


def echo_generator(prompts: list[str]) -> list[str]:
    """A deterministic double of a generator: the source text of a translation prompt, given back."""
    return [p.rsplit("\n\n", 2)[-2].split(": ", 1)[-1] if p.count("\n\n") >= 2 else p for p in prompts]


def length_judge(prompts: list[str]) -> list[str]:
    """A deterministic double of a judge: valid if the prompt has an even number of characters, scored by its length."""
    return [f'Answer: {{"is_valid_alignment": {"true" if len(p) % 2 == 0 else "false"}, "is_atomic": true, "quality_score": {(len(p) % 100) / 100:.2f}, "issues": [], "fixed_kaz": null, "fixed_rus": null, "fixed_eng": null}}' for p in prompts]

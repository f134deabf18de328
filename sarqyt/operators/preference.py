"""Preference pairs from triplets: prompts per direction, rejected answers by lookup, resumption."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sarqyt.functions.rules import STRIP
from sarqyt.functions.text import DIRECTIONS, prompt


def directions(triplets: DataFrame, which: tuple[str, ...] = DIRECTIONS) -> DataFrame:
    """One row per triplet and direction with both sides present: ``id, direction, prompt, source_text, chosen``."""
    each = F.array(*(F.struct(F.lit(d).alias("direction"), prompt(d, F.col(d[:3])).alias("prompt"), F.col(d[:3]).alias("source_text"), F.col(d[4:]).alias("chosen")) for d in which))
    x = triplets.select("id", F.explode(each).alias("x")).select("id", "x.*")
    return x.where("source_text IS NOT NULL AND source_text <> '' AND chosen IS NOT NULL AND chosen <> ''")


def examples(asked: DataFrame, rejected: DataFrame) -> DataFrame:
    """Asked rows with their rejected answer ``(id, direction, rejected)``; without one, or with one that equals the chosen
    answer but for case and outer space, a row is no example."""
    x = asked.join(rejected, ["id", "direction"])
    same = F.lower(STRIP.spark(F.col("rejected"))) == F.lower(STRIP.spark(F.col("chosen")))
    x = x.where(F.col("rejected").isNotNull() & (F.col("rejected") != "") & ~same)
    return x.select(F.concat_ws("_", "id", "direction").alias("example_id"), "id", "direction", "prompt", "chosen", "rejected", "source_text")


def resume(todo: DataFrame, done: DataFrame, *keys: str) -> DataFrame:
    """What is not done yet."""
    return todo.join(done.select(*keys).distinct(), list(keys), "left_anti")

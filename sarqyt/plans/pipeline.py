"""The phases of the corpus pipeline, each a function of tables to a table, and all of them together.

Phases: the last extraction of each file, sentences, aligned triplets, cleaned and judged triplets, preference pairs.
Evaluation of models on the result is ``operators.evaluation``. Where a phase's result is read by several others it is cut
(written once); models are callables given by the caller.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sarqyt.functions import text as X
from sarqyt.operators import align, chunk, dedup, preference, quality
from sarqyt.operators.models import Encoder, Generator, Judge, answered, gram_encoder
from sarqyt.session import cut


@dataclass(frozen=True)
class Settings:
    limits: quality.Limits = quality.Limits()
    least_similarity: float = align.MIN_SIMILARITY
    directions: tuple[str, ...] = ("kaz2rus", "kaz2eng")


def documents(extractions: DataFrame) -> DataFrame:
    """The last successful extraction of each file of a collection, with what its name says."""
    last = dedup.keep_last(extractions.where("success AND text_only IS NOT NULL"), F.struct("collection", "filename"), "extract_id")
    name = F.col("filename")
    return last.select("collection", name.alias("source_file"), F.col("text_only").alias("text"), X.language_of(name).alias("language"), F.struct(X.year_of(name).alias("year"), X.first_named(name, X.TYPES).alias("type"), X.language_of(name).alias("language"), X.first_named(name, X.COMPANIES).alias("company")).alias("metadata"))


def sentences(docs: DataFrame) -> DataFrame:
    """``(collection, source_file, language, metadata, sentence_idx, text)``: the valid sentences of all documents."""
    return chunk.sentences(docs, "collection", "source_file", "language", "metadata").withColumnRenamed("sentence", "text").drop("ok")


def triplets(rows: DataFrame, encoder: Encoder = gram_encoder, settings: Settings = Settings()) -> DataFrame:
    """Triplets of the documents that have Kazakh sentences and those of another language, aligned in beads."""
    rows = cut(rows.select(F.concat_ws("/", "collection", X.document_id(F.col("source_file"))).alias("doc"), "language", F.col("sentence_idx").alias("idx"), "text"))
    side = {x: rows.where(F.col("language") == x).drop("language") for x in ("kaz", "rus", "eng")}
    pairs = {x: align.bead_pairs(cut(align.align_documents(side["kaz"], side[x], encoder)), side["kaz"], side[x], encoder, settings.least_similarity) for x in ("rus", "eng")}
    return align.triplets(pairs["rus"], pairs["eng"])


def cleaned(triples: DataFrame, order: str, settings: Settings = Settings(), judge: Judge | None = None) -> DataFrame:
    """Triplets with repaired texts, without those that any rule speaks against (or a judge, where one is given), the first of
    each Kazakh text. All columns are kept."""
    sides = {x: X.clean_text_full(F.col(x)) for x in ("kaz", "rus", "eng")}
    # both are written before they are read on: what reads a text often would repair it as often, and a filter on the
    # reason would be pushed below the facts it is made of
    repaired = cut(triples.withColumns(sides))
    good = cut(quality.with_reason(repaired, settings.limits, "__reason")).where("__reason IS NULL").drop("__reason")
    if judge:
        good = quality.judged(good, judge)
    return dedup.keep_first(good, X.dedup_key(F.col("kaz")), order)


def preferences(clean: DataFrame, generator: Generator, settings: Settings = Settings()) -> DataFrame:
    """Preference pairs: the given translation against what a model makes of the same prompt."""
    asked = cut(preference.directions(clean, settings.directions))
    answers = asked.select("id", "direction", X.clean_generation(answered(F.col("prompt"), generator)).alias("rejected"))
    return preference.examples(asked, answers)


def corpus(extractions: DataFrame, generator: Generator, encoder: Encoder = gram_encoder, settings: Settings = Settings(), judge: Judge | None = None) -> dict[str, DataFrame]:
    """All phases by name; each is made when it is used."""
    rows = sentences(documents(extractions))
    triples = cut(triplets(rows, encoder, settings))
    clean = cut(cleaned(triples, "id", settings, judge))
    return {"sentences": rows, "triplets": triples, "cleaned": clean, "preferences": preferences(clean, generator, settings)}

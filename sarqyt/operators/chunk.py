"""Documents to sentences: cutting, cleaning, judging each sentence, and what to know about the result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sarqyt.functions import text as X


def pieces(df: DataFrame, *keys: str, text: str = "text", compat: str = "fixed") -> DataFrame:
    """``(*keys, sentence_idx, sentence)``: the sentences of each text as they stand; null and short texts have none."""
    cut = X.split_sentences(F.col(text), compat)
    return df.select(*keys, F.posexplode(cut).alias("sentence_idx", "sentence")).select(*keys, F.col("sentence_idx").cast("bigint").alias("sentence_idx"), "sentence")


def sentences(df: DataFrame, *keys: str, text: str = "text", valid: bool = True, compat: str = "fixed") -> DataFrame:
    """``(*keys, sentence_idx, sentence, ok)``: cleaned sentences; ``valid`` leaves out those that are not.

    Cleaning and judging run inside the array of sentences, before it is exploded: a filter above would be pushed below the
    cleaning, and each of its tests would clean the sentence anew."""
    cut = F.transform(X.split_sentences(F.col(text), compat), lambda s, i: F.struct(i.cast("bigint").alias("sentence_idx"), X.CLEAN_SENTENCE.spark(s).alias("sentence")))
    judged = F.transform(cut, lambda s: F.struct(s["sentence_idx"].alias("sentence_idx"), s["sentence"].alias("sentence"), X.valid_sentence(s["sentence"]).alias("ok")))
    if valid:
        judged = F.filter(judged, lambda s: s["ok"])
    return df.select(*keys, F.inline(judged))


def totals(judged: DataFrame, key: str) -> DataFrame:
    """One row over sentences with ``ok``: documents, sentences, valid ones, the others."""
    return judged.agg(F.countDistinct(key).alias("files"), F.count(F.lit(1)).alias("raw"), F.count_if("ok").alias("valid"), F.count_if(~F.col("ok")).alias("filtered"))


def by_language(judged: DataFrame) -> DataFrame:
    return judged.groupBy(F.coalesce("lang", F.lit("unknown")).alias("lang")).agg(F.count(F.lit(1)).alias("sentences"))


def by_document(rows: DataFrame, *keys: str) -> DataFrame:
    """``(*keys, text)``: a document's sentences in order, joined by spaces; a document is gathered, which its nature bounds."""
    ordered = F.array_sort(F.collect_list(F.struct("sentence_idx", "sent_id", "text")))
    return rows.groupBy(*keys).agg(F.concat_ws(" ", F.transform(ordered, lambda x: x["text"])).alias("text"))


def first_metadata(rows: DataFrame, *keys: str) -> DataFrame:
    """``(*keys, year, company, doc_type)`` from the first sentence of each document."""
    m = F.min_by("metadata", F.struct("sentence_idx", "sent_id")).alias("m")
    return rows.groupBy(*keys).agg(m).select(*keys, "m.year", "m.company", F.col("m.type").alias("doc_type"))


def documents_in_both(a: DataFrame, b: DataFrame, names: tuple[str, str]) -> DataFrame:
    """``(collection, document, *names)``: the documents with sentences on both sides, and how many on each."""

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("collection", X.document_id(F.col("source_file")).alias("document")).agg(F.count(F.lit(1)).alias(name))

    return counted(a, names[0]).join(counted(b, names[1]), ["collection", "document"])

"""Text out of PDF bytes, through given extractors; routing between them; totals.

Extractors are plain callables (``models.Extractor``: bytes to the texts of the pages). They run in Arrow batches; what one
raises is kept in ``error`` and costs its own file only.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sarqyt.functions import text as X
from sarqyt.functions.rules import STRIP
from sarqyt.operators.models import Extractor

LEAST_COVERAGE, LEAST_CHARS = 0.5, 100


def enough_text(pages: Column) -> Column:
    """Whether at least half of the pages have text, and a hundred characters a page on average; without pages, no."""
    with_text = F.size(F.filter(pages, lambda x: STRIP.spark(x) != ""))
    chars = F.length(F.array_join(pages, "\n\n"))
    return (F.size(pages) > 0) & (with_text >= F.size(pages) * LEAST_COVERAGE) & (chars >= F.size(pages) * LEAST_CHARS)


def route(pages: Column, ocr: Column) -> Column:
    """The method for a file: its own text if there is enough, else scanning where that is at hand."""
    return F.when(enough_text(pages), "pypdf").when(ocr, "docling_ocr").otherwise("pypdf_partial")


def extracted(pdfs: DataFrame, own_text: Extractor, ocr: Extractor | None = None) -> DataFrame:
    """``(filename, success, markdown, text_only, char_count, method, error, kazakh_ok)`` of rows (path, content).

    A file whose extractor fails has ``success`` false, null texts and the error's message; null content is such a file."""

    def go(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in parts:
            rows = []
            for path, content in zip(df["path"], df["content"], strict=True):
                try:
                    pages = own_text(bytes(content))
                    rows.append((path.rsplit("/", 1)[-1], pages, None))
                except Exception as e:  # noqa: BLE001  (any failure of a foreign extractor belongs to its file)
                    rows.append((str(path).rsplit("/", 1)[-1], None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["filename", "pages", "error"]).assign(content=df["content"].to_numpy())

    def scan(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in parts:
            raw, errors = [], []
            for method, pages, content, error in zip(df["method"], df["pages"], df["content"], df["error"], strict=True):
                text = None if pages is None else "\n\n".join(pages)
                if error is None and method == "docling_ocr" and ocr:
                    try:
                        text = "\n\n".join(ocr(bytes(content)))
                    except Exception as e:  # noqa: BLE001
                        text, error = None, f"{type(e).__name__}: {e}"
                raw.append(text)
                errors.append(error)
            yield pd.DataFrame({"filename": df["filename"], "method": df["method"], "raw": raw, "error": errors})

    first = pdfs.select("path", "content").mapInPandas(go, "filename string, pages array<string>, error string, content binary")
    routed = first.withColumn("method", route(F.col("pages"), F.lit(ocr is not None)))
    texts = routed.mapInPandas(scan, "filename string, method string, raw string, error string")
    cleaned = texts.select("filename", F.col("error").isNull().alias("success"), X.clean_markdown(F.col("raw")).alias("markdown"), F.when(F.col("error").isNull(), F.col("method")).alias("method"), "error")
    out = cleaned.select("*", STRIP.spark(X.without_tables(F.col("markdown"))).alias("text_only"))
    return out.select("filename", "success", "markdown", "text_only", F.coalesce(F.length("text_only"), F.lit(0)).alias("char_count"), "method", "error", X.has_kazakh_letters(F.col("filename"), F.col("text_only")).alias("kazakh_ok"))


def totals(df: DataFrame) -> DataFrame:
    """One row: files, successes, failures, and the characters of the successes."""
    return df.agg(F.count(F.lit(1)).alias("total"), F.count_if("success").alias("ok"), F.count_if(~F.col("success")).alias("failed"), F.sum(F.when(F.col("success"), F.col("char_count"))).alias("chars"))

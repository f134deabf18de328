"""Download manifests: text files of headers, titles and links, in three layouts.

All take rows ``(file, line_no, line)``; the order within a file is ``line_no`` and files are parsed independently of
each other (a file is one window partition; manifests are short by nature). Null lines count as empty.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sarqyt.functions.rules import STRIP, WS

LANGS = (("KAZ", "Казахский (KAZ)"), ("RUS", "Русский (RUS)"), ("ENG", "Английский (ENG)"))
# Words in a title that name a type, in order, per layout
TITLES = {
    "plain": (("Sustainability_Report", ("устойчивом развитии", "Sustainability")), ("Annual_Report", ("Годовой отчет", "Annual Report", "Annual_Report")), ("Financial_Statements", ("Financial Statements",))),
    "integrated": (("Sustainability_Report", ("устойчивом развитии", "Sustainability")), ("Integrated_Annual_Report", ("Интегрирленген", "Интегрированный", "Integrated")), ("Annual_Report", ("Годовой отчет", "Annual Report"))),
}


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, line_no, line)``: whole files split in place, so the numbers follow the lines."""
    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.col("value"))
    return whole.select("file", F.posexplode(F.split("value", "\r?\n")).alias("line_no", "line"))


def title_type(title: Column, layout: str = "plain") -> Column:
    out = None
    for name, words in TITLES[layout]:
        hit = F.lit(False)
        for w in words:
            hit = hit | F.contains(title, F.lit(w))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("Report")


def _bare(rows: DataFrame) -> DataFrame:
    return rows.select("file", "line_no", STRIP.spark(F.coalesce("line", F.lit(""))).alias("line"))


def _lang(line: Column) -> Column:
    out = None
    for code, word in LANGS:
        hit = F.contains(line, F.lit(word))
        out = F.when(hit, code) if out is None else out.when(hit, code)
    return out


def carry_forward(rows: DataFrame, layout: str = "plain") -> DataFrame:
    """A header line sets year and language (or resets the language); a link takes the line before it as its title; links
    without a year or language are skipped."""
    w = Window.partitionBy("file").orderBy("line_no")
    x = _bare(rows)
    year = F.regexp_extract("line", rf"([0-9]{{4}}){WS}+ГОД", 1)
    x = x.withColumn("head", F.when(year != "", F.struct(year.alias("year"), _lang(F.col("line")).alias("lang"))))
    x = x.withColumn("now", F.last("head", ignorenulls=True).over(w)).withColumn("title", F.coalesce(F.lag("line").over(w), F.lit("")))
    x = x.where(F.col("head").isNull() & F.startswith("line", F.lit("http")) & F.col("now.year").isNotNull() & F.col("now.lang").isNotNull())
    return x.select("file", "line_no", F.col("line").alias("url"), F.col("now.year").alias("year"), F.col("now.lang").alias("lang"), title_type(F.col("title"), layout).alias("type"), "title")


def look_ahead(rows: DataFrame, doc_type: str = "Annual_Report") -> DataFrame:
    """A header line with year and language; the next line is its link."""
    w = Window.partitionBy("file").orderBy("line_no")
    x = _bare(rows).withColumn("url", F.lead("line").over(w)).withColumn("year", F.regexp_extract("line", rf"([0-9]{{4}}){WS}+ГОД", 1)).withColumn("lang", _lang(F.col("line")))
    return x.where((F.col("year") != "") & F.col("lang").isNotNull() & F.rlike("url", F.lit("^https?://"))).select("file", "line_no", "url", "year", "lang", F.lit(doc_type).alias("type"))


def prefixed(rows: DataFrame, year_pattern: str = "([0-9]{4})" + WS + "+ГОДОВЫЕ ОТЧЕТЫ", doc_type: str = "Annual_Report") -> DataFrame:
    """A year line, then links with their language in front."""
    w = Window.partitionBy("file").orderBy("line_no")
    x = _bare(rows)
    year = F.regexp_extract("line", year_pattern, 1)
    link = rf"^(KAZ|RUS|ENG):{WS}+(https?://.*)"
    x = x.withColumn("year", F.last(F.when(year != "", year), ignorenulls=True).over(w))
    x = x.where((year == "") & F.rlike("line", F.lit(link)) & F.col("year").isNotNull())
    return x.select("file", "line_no", F.regexp_extract("line", link, 2).alias("url"), "year", F.regexp_extract("line", link, 1).alias("lang"), F.lit(doc_type).alias("type"))


YEAR_RANGE = r"([0-9\-]+)" + WS + "+ГОД"


def file_name(year: Column, doc_type: Column, lang: Column) -> Column:
    return F.regexp_replace(F.concat_ws("_", year, doc_type, F.concat(lang, F.lit(".pdf"))), r'[<>:"/\\|?*]', "_")


def duplicate_links(tasks: DataFrame) -> DataFrame:
    """Tasks with the number of tasks that share their link (one file labelled as several)."""
    return tasks.withColumn("same_url", F.count(F.lit(1)).over(Window.partitionBy("url")))


def fetched(tasks: DataFrame, fetch: Callable[[str], bytes], have: DataFrame | None = None) -> DataFrame:
    """``(filename, url, content, error)`` of rows (url, year, type, lang, position): of the tasks that give one name the first
    is fetched, names in ``have`` not again; ``fetch`` maps a URL to bytes, and what it raises is the row's error."""
    named = tasks.withColumn("filename", file_name(F.col("year"), F.col("type"), F.col("lang")))
    first = named.groupBy("filename").agg(F.min_by("url", "position").alias("url"))
    if have is not None:
        first = first.join(have.select("filename").distinct(), "filename", "left_anti")

    def go(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in parts:
            content, errors = [], []
            for url in df["url"]:
                try:
                    content.append(fetch(url))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001  (a failed download belongs to its row)
                    content.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield pd.DataFrame({"filename": df["filename"], "url": df["url"], "content": content, "error": errors})

    return first.mapInPandas(go, "filename string, url string, content binary, error string")

"""Documents and JSON lines: reading and writing."""

from __future__ import annotations

import json
import os
import uuid
import warnings
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

TRIPLET = (
    "id string, kaz string, rus string, eng string, similarity_kaz_rus double, similarity_kaz_eng double, alignment_type_kaz_rus string, alignment_type_kaz_eng string, "
    "metadata struct<source_doc:string,year:string,company:string,doc_type:string,kaz_idx:int>"
)
SENTENCE = "text string, source_file string, sentence_idx int, language string, metadata struct<year:string,type:string,language:string,company:string>"


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    """``(filename, text)`` of the ``.md`` files under a folder."""
    return spark.read.option("pathGlobFilter", "*.md").text(path, wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("filename"), F.col("value").alias("text"))


def existing(spark: SparkSession, paths: tuple[str, ...]) -> list[str]:
    """The folders that exist, on whatever file system; a warning for each that does not."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        if path.getFileSystem(conf).exists(path):
            out.append(p)
        else:
            warnings.warn(f"no such folder: {p}", stacklevel=3)
    return out


def read_pdf_bytes(spark: SparkSession, *paths: str) -> DataFrame:
    """``(path, content)`` of PDF files, either case of the suffix, for ``extraction.extracted``. Folders that do not exist
    are warned of and left out."""
    paths = existing(spark, paths)
    if not paths:
        return spark.createDataFrame([], "path string, content binary")
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.{pdf,PDF}").load(list(paths)).select("path", "content")


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines under a fixed schema (DDL); a line that does not parse gives nulls, never an error."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def write_jsonl(df: DataFrame, path: str, by: str | None = None, mode: str = "overwrite") -> None:
    """JSON lines, one folder per value of ``by``; values without rows make no folder. ``append`` resumes."""
    w = df.write.mode(mode).option("ignoreNullFields", "false")
    (w.partitionBy(by) if by else w).json(path)


def write_documents(df: DataFrame, folder: str, name: str = "filename", text: str = "markdown", group: str | None = None) -> None:
    """One file per document under a folder that all executors see (by ``group`` in folders of their own, so that equal names
    of different groups do not meet). A file appears whole or not at all; null texts make none."""

    def put(rows: Iterator[Row]) -> None:
        for r in rows:
            place = os.path.join(folder, str(r["group"])) if group else folder
            os.makedirs(place, exist_ok=True)
            part = os.path.join(place, f".{uuid.uuid4().hex}")
            with open(part, "w", encoding="utf-8") as f:
                f.write(r["text"])
            os.replace(part, os.path.join(place, os.path.basename(r["name"])))

    some = df.where(F.col(text).isNotNull() & F.col(name).isNotNull())
    columns = [F.col(name).alias("name"), F.col(text).alias("text"), *([F.coalesce(F.col(group), F.lit("none")).alias("group")] if group else [])]
    some.select(*columns).foreachPartition(put)


def write_stats(one_row: DataFrame, path: str) -> dict:
    """A one-row table of totals as a JSON file beside the data; returns it."""
    rows = one_row.limit(2).collect()
    if len(rows) != 1:
        raise ValueError("totals are one row")
    got = rows[0].asDict(recursive=True)
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "w", encoding="utf-8") as f:
        json.dump(got, f, ensure_ascii=False, default=str)
    os.replace(part, path)
    return got


def resumed(todo: DataFrame, path: str, schema: str, keys: list[str], build: Callable[[DataFrame], DataFrame]) -> int:
    """Builds what a JSON-lines output at ``path`` does not have yet (by ``keys``), appends it, and returns the number of new
    rows. Run again after a failure it goes on where the written rows end."""
    spark = todo.sparkSession
    done = read_jsonl(spark, path, schema).select(*keys).distinct() if existing_quietly(spark, path) else None
    rest = todo.join(done, keys, "left_anti") if done is not None else todo
    new = build(rest)
    before = 0 if done is None else read_jsonl(spark, path, schema).count()
    write_jsonl(new, path, mode="append")
    return read_jsonl(spark, path, schema).count() - before


def existing_quietly(spark: SparkSession, path: str) -> bool:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)

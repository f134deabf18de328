"""Problem 4: lines repeated across the documents of one site.

Within a collection the lines of each file form a path; all paths together are a weighted graph, whose nodes are lines
(weight: distinct files with the line) and whose edges are consecutive lines (weight: distinct files with both). Nodes
with high support are kept, joined by the edges that are as well supported, and the connected components are the
boilerplate blocks. Every occurrence of a kept line is removed.

Which rows are boilerplate is decided by the support of the nodes alone, as the statement of the problem fixes it; the
edges say which lines make up one block, and every occurrence carries its block.

Lines are the same if they differ only in case, digits, spacing, punctuation and symbols. A row is one line, line breaks
inside its text being spacing.

Scale: first distinct (collection, line, file) by partial aggregation, so a line that fills a third of all rows
shrinks to one row per file and task before the shuffle. A kept line fills at least a fixed share of the files of its
collection, so there are at most 1/share * (mean lines per file) of them in a collection.

Defined results: a null text and a text without letters are no line; rows with a null file belong to the collection but
support nothing; a null collection is a collection of its own; rows loaded twice count once as support.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sarqyt.operators.components import connected_components
from sarqyt.session import broadcast_if, cut

LEAST_FILES = 4
LEAST_SHARE = 5  # one file in so many
MOST_BROADCAST = 200_000


def line_key(text: Column) -> Column:
    return F.lower(F.regexp_replace(text, r"[^\p{L}]+", ""))


def _keyed(df: DataFrame, key: str) -> DataFrame:
    return df.select(key, F.coalesce("collection", F.lit("\x00")).alias("c"), "source_file", "sentence_idx", line_key(F.col("text")).alias("line"))


def lines(df: DataFrame, key: str, least_files: int = LEAST_FILES, least_share: int = LEAST_SHARE) -> DataFrame:
    """``(c, line, files)`` of the kept nodes."""
    return _kept(_keyed(df, key), least_files, least_share)


def _kept(rows: DataFrame, least_files: int, least_share: int) -> DataFrame:
    files = rows.where("source_file IS NOT NULL").select("c", "source_file").distinct().groupBy("c").agg(F.count(F.lit(1)).alias("total"))
    node = rows.where("source_file IS NOT NULL AND line <> ''").select("c", "line", "source_file").distinct().groupBy("c", "line").agg(F.count(F.lit(1)).alias("files"))
    return node.where(F.col("files") >= least_files).join(files, "c").where(F.col("files") * least_share >= F.col("total")).select("c", "line", "files", "total")


def blocks(df: DataFrame, key: str, least_files: int = LEAST_FILES, least_share: int = LEAST_SHARE) -> DataFrame:
    """``(collection, line, files, block)``: the kept lines and the block of each, named by its first line."""
    rows = _keyed(df, key)
    kept = cut(_kept(rows, least_files, least_share))
    # only rows of kept lines can be ends of kept edges, so the window runs over these alone; two of them are consecutive
    # if nothing stands between their places
    w = Window.partitionBy("c", "source_file").orderBy("sentence_idx", key)
    own = rows.where("source_file IS NOT NULL AND sentence_idx IS NOT NULL").join(broadcast_if(kept.select("c", "line"), MOST_BROADCAST), ["c", "line"])
    path = own.select("c", "source_file", "line", "sentence_idx", F.lead("line").over(w).alias("next"), F.lead("sentence_idx").over(w).alias("then"))
    edge = path.where("then - sentence_idx <= 1 AND line <> next").select("c", "line", "next", "source_file").distinct().groupBy("c", "line", "next").agg(F.count(F.lit(1)).alias("files"))
    kept_id = kept.withColumn("node", F.xxhash64("c", "line"))
    ends = kept_id.select("c", "line", F.col("node").alias("u"), "total")
    strong = (
        edge.where(F.col("files") >= least_files)
        .join(ends, ["c", "line"])
        .join(kept_id.select("c", F.col("line").alias("next"), F.col("node").alias("v")), ["c", "next"])
        .where(F.col("files") * least_share >= F.col("total"))
    )
    comp = connected_components(strong.select("u", "v"), "u", "v")
    out = kept_id.join(comp, "node", "left").select("c", "line", "files", F.coalesce("component", "node").alias("b"))
    # a block goes by its first line in the order of letters
    name = out.groupBy("c", "b").agg(F.min("line").alias("block"))
    out = out.join(name, ["c", "b"])
    return out.select(F.when(F.col("c") != "\x00", F.col("c")).alias("collection"), "line", "files", "block")


def occurrences(df: DataFrame, key: str) -> DataFrame:
    """``(key, block)`` of every row whose line is in a boilerplate block."""
    rows = _keyed(df, key).where("line <> ''").select(key, "c", "line")
    kept = cut(blocks(df, key).select(F.coalesce("collection", F.lit("\x00")).alias("c"), "line", "block"))
    return rows.join(broadcast_if(kept, MOST_BROADCAST), ["c", "line"]).select(key, "block")


def found(df: DataFrame, key: str) -> DataFrame:
    """Keys of all rows whose line is in a boilerplate block."""
    return occurrences(df, key).select(key).distinct()


def cleaned(df: DataFrame, key: str) -> DataFrame:
    """The rows without the occurrences of boilerplate lines; all columns kept."""
    gone = found(df, key)
    return df.join(gone, key, "left_anti")

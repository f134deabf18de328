"""First-wins and last-wins deduplication by an explicit order, and exact train/test splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, key: Column, order: str) -> DataFrame:
    """The row with the smallest ``order`` per key; as an aggregate, which combines map-side, so a key that a third of all
    rows share is no hot spot. All columns are kept; rows with a null key are one group."""
    cols = df.columns
    row = F.struct(F.col(order).alias("__order"), *(F.col(c) for c in cols))
    return df.groupBy(key.alias("__key")).agg(F.min_by(row, F.col(order)).alias("r")).select(*(F.col(f"r.{c}").alias(c) for c in cols))


def keep_last(df: DataFrame, key: Column, order: str) -> DataFrame:
    cols = df.columns
    row = F.struct(*(F.col(c) for c in cols))
    return df.groupBy(key.alias("__key")).agg(F.max_by(row, F.col(order)).alias("r")).select(*(F.col(f"r.{c}").alias(c) for c in cols))


def split_test(df: DataFrame, id_column: str, share: float = 0.05) -> DataFrame:
    """Adds ``is_test``: exactly ceil(share * n) rows, the smallest by (md5 of the id, id). Counts per 16-bit prefix of the
    hash (at most 65,536 rows) find the one bucket that the border cuts; only that bucket is ordered."""
    h = F.md5(F.col(id_column).cast("string"))
    x = df.withColumn("__h", h).withColumn("__b", F.conv(F.substring(h, 1, 4), 16, 10).cast("int"))
    counts = sorted(x.groupBy("__b").count().toArrow().to_pylist(), key=lambda r: r["__b"])
    take = -(-sum(r["count"] for r in counts) * int(round(share * 10_000)) // 10_000)
    border, before = -1, 0
    for r in counts:
        if before + r["count"] > take:
            border = r["__b"]
            break
        before += r["count"]
    else:
        return x.withColumn("is_test", F.lit(True)).drop("__h", "__b")
    rank = F.row_number().over(Window.partitionBy("__b").orderBy("__h", id_column))
    edge = x.where(F.col("__b") == border).withColumn("is_test", rank <= take - before)
    rest = x.where(F.col("__b") != border).withColumn("is_test", F.col("__b") < border)
    return edge.unionByName(rest).drop("__h", "__b")


def sampled(df: DataFrame, id_column: str, share: float) -> DataFrame:
    """A sample by the hash of the id: the same rows in any run and any partitioning, about ``share`` of them."""
    return df.where(F.conv(F.substring(F.md5(F.col(id_column).cast("string")), 1, 8), 16, 10).cast("bigint") < int(share * 2**32))

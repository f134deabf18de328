"""Session helpers: building a local session, the shared checkpoint folder, checked broadcasts, spreading of small scans."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "sarqyt") -> SparkSession:
    """A local session for tests and benches; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder of ``spark.checkpoint.dir``. Where it is unset, a local session (tests, benches) gets a folder of
    its own, which goes when Python ends; a cluster gets an error, since its executors share no temporary folder."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="sarqyt-ckpt-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    sc.setCheckpointDir(folder)


TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Data frames made and run inside leave no shuffle files behind: without this they stay until the driver happens to
    collect its garbage, which long jobs do late. A later use of the same plan computes it anew."""
    before = spark.conf.get(TIDY, None)
    spark.conf.set(TIDY, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(TIDY)
        else:
            spark.conf.set(TIDY, before)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the lineage ends in files that outlive any executor."""
    ensure_checkpoint_dir(df.sparkSession)
    with tidy(df.sparkSession):
        return df.select("*").checkpoint(True)


def free(df: DataFrame) -> None:
    """Deletes the files of a ``cut`` table that nothing will be computed from any more; long jobs need their room."""
    jvm, rdd = df.sparkSession.sparkContext._jvm, df._jdf.queryExecution().logical().rdd()
    if rdd.getCheckpointFile().isDefined():
        path = jvm.org.apache.hadoop.fs.Path(rdd.getCheckpointFile().get())
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def broadcast_if(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` only after its rows were counted against ``max_rows``; beyond, a shuffled join is left to Catalyst."""
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def spread(df: DataFrame, *keys: str, factor: int = 3) -> DataFrame:
    """Repartition by ``keys`` if the scan has fewer tasks than the cluster has cores (few or large files before CPU-heavy
    Python stages). Hash partitioning on a column is deterministic, so lost executors recompute the same rows. A large
    scan already has enough tasks and is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(factor * cores, *keys)


def bitmap(df: DataFrame, column: str, bits: int) -> np.ndarray:
    """Which hash buckets (the top ``bits`` of the 64-bit hashes in ``column``) occur: ``2**bits`` bits whatever the data's
    size, so it can be broadcast as a first, inexact filter before an exact join."""
    with tidy(df.sparkSession):
        got = df.select(F.shiftrightunsigned(column, 64 - bits).cast("int").alias("b")).distinct().toArrow()["b"].to_numpy()
    out = np.zeros(1 << bits, bool)
    out[got] = True
    return np.packbits(out)


def in_bitmap(packed: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    b = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    return (packed[b >> 3] >> (7 - (b & 7)).astype(np.uint8)) & 1 == 1

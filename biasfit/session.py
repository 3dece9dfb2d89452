"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job in this package relies on.  AQE re-plans joins from
# runtime sizes and splits skewed shuffle partitions; both are safety nets
# behind the explicit size checks and hot-key salting in operators/joins.py.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "biasfit",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure reliable checkpoints have a shared folder.

    The folder comes from ``spark.checkpoint.dir`` as the cluster names it.
    Only when that is unset *and* the master is local (tests, benches) is a
    private temporary folder created.
    """
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="biasfit-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"biasfit-{name}-{uuid.uuid4().hex[:12]}")


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries run inside leave no shuffle files behind.  Spark keeps those of an
    ended query until the driver's JVM happens to collect its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def materialize(df: DataFrame, mode: str = "table", name: str = "table",
                partition_by: list[str] | None = None, lean: bool = False) -> DataFrame:
    """Cut lineage of a table reused by many later jobs.

    ``table`` writes compressed parquet under the shared checkpoint folder and
    reads it back (survives executor loss without recomputation, and later
    scans prune columns, and partitions when ``partition_by`` is given); ``checkpoint`` uses Spark's reliable checkpoint;
    ``persist`` keeps rows in executor memory/disk with the lineage as
    fallback; ``none`` leaves the plan lazy.  A ``lean`` table takes less disk:
    zstd, and the shuffle files that made it go at once.
    """
    if mode == "table":
        path = scratch_path(df.sparkSession, name)
        w = df.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        if lean:
            with shuffles_removed(df.sparkSession):
                w.option("compression", "zstd").parquet(path)
        else:
            w.parquet(path)
        return df.sparkSession.read.parquet(path)
    if mode == "checkpoint":
        ensure_checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    if mode == "persist":
        from pyspark import StorageLevel
        out = df.persist(StorageLevel.MEMORY_AND_DISK)
        out.count()
        return out
    if mode == "none":
        return df
    raise ValueError(f"unknown materialize mode {mode!r}")

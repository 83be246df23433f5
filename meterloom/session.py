"""Session helpers: sensible defaults for a local run and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
import weakref

from pyspark.sql import SparkSession


def local_session(app: str = "meterloom", cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and benches. On a cluster, build the session with spark-submit settings instead."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # windows cost more CPU than bytes: do not merge small shuffle partitions down to a few tasks
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """Folder for reliable checkpoints.

    The cluster names a shared folder in ``spark.checkpoint.dir``. Only a local master may fall back to a
    temporary folder: on a cluster that folder would vanish with its machine.
    """
    current = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        current = tempfile.mkdtemp(prefix="meterloom-checkpoint-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def checkpointed(df):
    """Cut the lineage of ``df`` by writing it to the shared checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df, tidy=False):
    """Write ``df`` as Parquet to the shared checkpoint folder and read it back: lineage cut, columns prunable.

    ``tidy`` has the shuffle files of the write deleted when it is done, not when the driver happens to collect its garbage.
    """
    spark, path = df.sparkSession, f"{checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    before = spark.conf.get(_TIDY, None)
    if tidy:
        spark.conf.set(_TIDY, "true")
    try:
        df.write.parquet(path)
    finally:
        if tidy:
            spark.conf.unset(_TIDY) if before is None else spark.conf.set(_TIDY, before)
    out = spark.read.schema(df.schema).parquet(path)
    _folders[out] = [path]
    return out


_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_folders: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def joined(tables):
    """One table of all rows of tables from ``stored`` that have the same columns."""
    paths = [path for t in tables for path in _folders[t]]
    out = tables[0].sparkSession.read.schema(tables[0].schema).parquet(*paths)
    _folders[out] = paths
    return out


def discard(*tables):
    """Delete what ``stored`` wrote for these tables. Only for tables that no table still to be computed is made from."""
    for t in tables:
        for name in _folders.pop(t):
            path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)

"""Session helpers: a local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "quarry") -> SparkSession:
    """Session for tests and benchmarks on one machine (no UI, UTC, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "16g"))
        .config("spark.sql.variant.allowDuplicateKeys", "true")
        # local test files are single parquet row groups (one scan task each):
        # rebalance base tables into small AQE partitions so all cores work
        .config(REBALANCE_CONF, "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


REBALANCE_CONF = "spark.quarry.rebalanceInputs"


def rebalance_inputs(spark: SparkSession) -> bool:
    """Whether base tables are rebalanced after the scan (off unless configured).

    Useful only when the input has fewer splits than cores (e.g. one large
    parquet row group); on a cluster reading many files it would add a shuffle."""
    return str(spark.conf.get(REBALANCE_CONF, "false")).lower() == "true"


def configure(spark: SparkSession) -> None:
    """Session settings the library relies on; safe to call repeatedly.

    Duplicate JSON keys resolve last-wins, like Python's json module.
    """
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def write_file(spark: SparkSession, path: str, data: bytes) -> str:
    """Write a small file of the driver through Hadoop's file systems; returns its URI."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = files.create(target, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    return files.makeQualified(target).toString()


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables.

    Uses the cluster's ``spark.checkpoint.dir``.  Only a local master without one
    (tests, local runs) gets a private folder: on a cluster, executors could not
    share it, so a missing setting is an error there.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        conf_dir = spark.sparkContext.getCheckpointDir()
    if not conf_dir:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="quarry-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
        spark.sparkContext.setCheckpointDir(conf_dir)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir.rstrip("/")


_open_scopes: list[list[str]] = []


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Tables written inside (``write_through``) are removed at the end of the block, but
    for those written with ``keep=True``, which belong to the block around it, if any.

    What the block returns may read kept tables only; those are complete, so a lost
    executor asks for none of the removed ones."""
    made: list[str] = []
    _open_scopes.append(made)
    try:
        yield
    finally:
        _open_scopes.remove(made)
        for path in made:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def write_through(df: DataFrame, tag: str, keep: bool = False) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back.

    Cuts the lineage with a columnar table that all executors can read, so a lost
    executor costs the tasks it ran, not the stages before the table.  ``keep``: the
    table outlives the innermost ``temporary_tables`` block."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/quarry-{tag}-{uuid.uuid4().hex}"
    scope = len(_open_scopes) - (2 if keep else 1)
    if scope >= 0:
        _open_scopes[scope].append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)

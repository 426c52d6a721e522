"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import scratch_dir, temporary_tables, write_file  # noqa: F401
from quarry.session import write_through as stash  # noqa: F401

BATCH_ROWS = 512  # rows of one Arrow batch: bounds a Python worker's memory on long texts


def configure(spark: SparkSession) -> None:
    """Session settings of the Python stages; safe to call repeatedly."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table."""
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Exactly the named columns, cast (``doc_id="long"``); other columns of the
    input, whatever their names, are left behind before an operator adds its own."""
    return df.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in columns.items()])


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (null ids: crc32 of '')."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def write_shared(spark: SparkSession, name: str, data: bytes) -> str:
    """Write a small file of the driver into the shared folder; returns its URI."""
    return write_file(spark, f"{scratch_dir(spark)}/{name}", data)


def packed(df: DataFrame) -> DataFrame:
    """All columns, whatever their names, in one struct column ``row``."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))

"""Writers: JSONL examples per split, parquet per language, metadata JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_examples(split: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per line, UTF-8 without ASCII escaping, one folder per
    split; null fields are written as null, like Python's json module."""
    (
        split.write.mode(mode)
        .partitionBy("split")
        .option("ignoreNullFields", "false")
        .option("compression", "none")
        .json(path)
    )


def write_parquet_by_language(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One parquet folder per language (``language=<name>``)."""
    df.write.mode(mode).partitionBy("language").parquet(path)


def write_metadata(result, path: str, seed: int, mode: str = "overwrite") -> None:
    """Metadata document: totals, per-processor counts, split sizes, seed.

    One global aggregate over the split examples (partial counts per task),
    written as a single JSON row.
    """
    from ..functions import constants as K

    split = result.split
    meta = split.agg(
        F.count(F.lit(1)).alias("total_examples"),
        F.map_from_arrays(
            F.array(*[F.lit(name) for name, _ in K.PROCESSORS]),
            F.array(*[F.count_if(F.col("source") == tag) for _, tag in K.PROCESSORS]),
        ).alias("sources"),
        F.struct(*[F.count_if(F.col("split") == s).alias(s) for s in ["train", "val", "test"]]).alias("splits"),
    ).withColumn("seed", F.lit(seed).cast("int"))
    meta.coalesce(1).write.mode(mode).json(path)


def write_versioned(df: DataFrame, root: str, version: int, mode: str = "overwrite") -> None:
    """Documented naming {source}_{split}_{version}: folders source=/split= under v{n}."""
    df.write.mode(mode).partitionBy("source", "split").option("compression", "none").json(
        f"{root.rstrip('/')}/v{version}"
    )

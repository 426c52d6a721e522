"""Preprocessing job: raw sources -> instruction examples -> exact splits -> metadata.

Stages (shuffles only of keys, at the cap and the split, and at the small
aggregations):

1. read each processor's raw folder (missing folders contribute nothing);
2. filter, clean and convert each to example rows;
3. optional cap per source (first N in a seeded hash order);
   the converted examples are written once; every later stage reads that table;
4. union and exact train/val/test split in a seeded hash order;
5. metadata: per-processor counts (zeros included), split sizes, seed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.text import preview_if_longer, seeded_key
from ..operators import alpaca
from ..operators.ranking import HASH, NUMBER, cap_per_group, exact_split, numbered
from ..sources import files


def read_sources(spark: SparkSession, raw_dir: str) -> dict[str, DataFrame]:
    raw = raw_dir.rstrip("/")
    return {
        "codesearchnet": files.scan_language_files(spark, f"{raw}/{K.RAW_DIRS['codesearchnet']}"),
        "code_docstring_corpus": files.scan_corpus(spark, f"{raw}/{K.RAW_DIRS['code_docstring_corpus']}"),
        "python_code_instructions": files.scan_instructions(spark, f"{raw}/{K.RAW_DIRS['python_code_instructions']}"),
        "the_stack_smol": files.scan_whole_files(spark, f"{raw}/{K.RAW_DIRS['the_stack_smol']}"),
    }


def convert_sources(sources: dict[str, DataFrame], seed: int = K.DEFAULT_SEED) -> DataFrame:
    """Union of all processors' example rows (5 columns + content key ``_ck``)."""
    parts = []
    if sources.get("codesearchnet") is not None:
        parts.append(alpaca.pairs_to_examples(sources["codesearchnet"], seed))
    if sources.get("code_docstring_corpus") is not None:
        parts.append(alpaca.corpus_to_examples(sources["code_docstring_corpus"], seed))
    if sources.get("python_code_instructions") is not None:
        parts.append(alpaca.instructions_to_examples(sources["python_code_instructions"]))
    if sources.get("the_stack_smol") is not None:
        parts.append(alpaca.files_to_examples(sources["the_stack_smol"], seed))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def effective_cap(max_per_source: int, dry_run: bool) -> int:
    """min(max-per-source, 100 in a dry run); 0 = unlimited."""
    caps = [c for c in [max_per_source if max_per_source > 0 else 0, K.DRY_RUN_LIMIT if dry_run else 0] if c > 0]
    return min(caps) if caps else 0


def cap_sources(examples: DataFrame, cap: int, seed: int) -> DataFrame:
    if cap <= 0:
        return examples
    keyed = examples.withColumn("_kc", seeded_key(seed, "cap", "_ck"))
    return cap_per_group(keyed, "_kc", cap, ["source"]).drop("_kc")


def split_examples(examples: DataFrame, train_ratio: float, val_ratio: float, seed: int) -> DataFrame:
    keyed = examples.withColumn("_ks", seeded_key(seed, "split", "_ck"))
    return exact_split(keyed, "_ks", train_ratio, val_ratio).drop("_ks")


def processor_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(i, name, tag) for i, (name, tag) in enumerate(K.PROCESSORS)], "ord int, name string, source string"
    )


def source_counts(spark: SparkSession, examples: DataFrame) -> DataFrame:
    """Examples per processor, zero for processors that produced nothing."""
    counts = examples.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return processor_table(spark).join(counts, "source", "left").select(
        "name", "source", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    )


def split_counts(split: DataFrame) -> DataFrame:
    return split.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def metadata_row(split: DataFrame, seed: int) -> DataFrame:
    """total_examples, train, val, test, seed as one row (BIGINT)."""
    return split.agg(
        F.count(F.lit(1)).alias("total_examples"),
        F.count_if(F.col("split") == "train").alias("train"),
        F.count_if(F.col("split") == "val").alias("val"),
        F.count_if(F.col("split") == "test").alias("test"),
    ).withColumn("seed", F.lit(seed).cast("bigint"))


@dataclass
class PreprocessResult:
    examples: DataFrame  # capped examples before the split (with _ck)
    split: DataFrame  # examples with a 'split' column
    sources: DataFrame  # per-processor counts
    metadata: DataFrame  # one-row totals


def preprocess(
    spark: SparkSession,
    raw_dir: str | None = None,
    sources: dict[str, DataFrame] | None = None,
    out_dir: str | None = None,
    train_ratio: float = K.DEFAULT_TRAIN_RATIO,
    val_ratio: float = K.DEFAULT_VAL_RATIO,
    seed: int = K.DEFAULT_SEED,
    max_per_source: int = 0,
    dry_run: bool = False,
) -> PreprocessResult:
    """The preprocessing job; writes only when ``out_dir`` is given and not a dry run."""
    if sources is None:
        sources = read_sources(spark, raw_dir)
    # converted once: caps, split and counts read the written examples
    examples = numbered(convert_sources(sources, seed))
    examples = cap_sources(examples, effective_cap(max_per_source, dry_run), seed)
    split = split_examples(examples, train_ratio, val_ratio, seed)
    examples = examples.drop(HASH, NUMBER)
    result = PreprocessResult(
        examples=examples,
        split=split.drop("_ck", HASH, NUMBER),
        sources=source_counts(spark, examples),
        metadata=metadata_row(split, seed),
    )
    if out_dir and not dry_run:
        from ..sources.sinks import write_examples, write_metadata

        write_examples(result.split, f"{out_dir.rstrip('/')}/examples")
        write_metadata(result, f"{out_dir.rstrip('/')}/metadata", seed)
    return result


def dry_run_sample(examples: DataFrame, seed: int) -> DataFrame:
    """One sample row as compact JSON, shown in full up to 600 chars."""
    j = F.to_json(F.struct(*alpaca.EXAMPLE_COLUMNS))
    first = examples.orderBy(seeded_key(seed, "sample", "_ck")).limit(1)
    return first.select(preview_if_longer(j, K.DRY_RUN_PREVIEW_CHARS).alias("sample"))

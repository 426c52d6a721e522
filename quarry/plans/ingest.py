"""Ingest job: landed raw pairs / whole files -> filtered, capped, per-language parquet + stats.

Network downloads are out of scope; the job starts from landed shards
(gzip JSON lines) and whole-file records.  ``ingest_landed`` keeps a manifest of the
files it has finished, so that a later run reads new files only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.quality import has_doc_marker
from ..functions.text import col, py_strip, row_key, seeded_key
from ..operators.ranking import cap_per_group
from ..sources.files import file_inventory, landed_files, scan_whole_files
from ..sources.jsonl import scan_jsonl_pairs
from ..sources.sinks import write_parquet_by_language


def ingest_pair_filter(code: Column | str, docstring: Column | str) -> Column:
    """Keep a raw pair: code and docstring truthy, stripped docstring longer than 10."""
    c, d = col(code), col(docstring)
    ok = c.isNotNull() & (c != "") & d.isNotNull() & (d != "") & (F.length(py_strip(d)) > 10)
    return F.coalesce(ok, F.lit(False))


def language_quota(max_examples: int, n_languages: int) -> int:
    """Per-language quota ``max_examples // n_languages``; 0 means unlimited."""
    return max_examples // max(n_languages, 1)


def cap_per_language(df: DataFrame, quota: int, content_cols: list[str], seed: int = K.DEFAULT_SEED) -> DataFrame:
    """First ``quota`` rows per language in a seeded content-hash order."""
    if quota <= 0:
        return df
    keyed = df.withColumn("_kc", seeded_key(seed, "cap", row_key(*content_cols)))
    return cap_per_group(keyed, "_kc", quota, ["language"]).drop("_kc")


PAIR_COLS = ["code", "docstring", "language", "repo", "path"]
FILE_COLS = ["content", "language", "path"]


def ingest_pairs(pairs: DataFrame, max_examples: int = 0, n_languages: int = len(K.INGEST_LANGUAGES),
                 seed: int = K.DEFAULT_SEED) -> DataFrame:
    kept = pairs.filter(ingest_pair_filter("code", "docstring")).select(*PAIR_COLS)
    return cap_per_language(kept, language_quota(max_examples, n_languages), PAIR_COLS, seed)


def ingest_files(files: DataFrame, max_examples: int = 0, n_languages: int = len(K.INGEST_LANGUAGES),
                 seed: int = K.DEFAULT_SEED) -> DataFrame:
    kept = files.filter(has_doc_marker("content", "language")).select(*FILE_COLS)
    return cap_per_language(kept, language_quota(max_examples, n_languages), FILE_COLS, seed)


def ingest_stats(df: DataFrame) -> DataFrame:
    """Rows per language plus a grand total (language = null), via ROLLUP."""
    return df.rollup("language").agg(F.count(F.lit(1)).alias("n"))


@dataclass
class IngestResult:
    pairs: DataFrame
    stats: DataFrame


def ingest_job(spark: SparkSession, pairs: DataFrame, out_dir: str | None = None, max_examples: int = 0,
               n_languages: int = len(K.INGEST_LANGUAGES)) -> IngestResult:
    out = ingest_pairs(pairs, max_examples, n_languages)
    if out_dir:
        write_parquet_by_language(out, out_dir)
    return IngestResult(pairs=out, stats=ingest_stats(out))


def verify(spark: SparkSession, root: str, datasets: list[str]) -> tuple[DataFrame, DataFrame]:
    """Inventory per dataset folder and the gate: every folder has parquet files
    and at least one file in total (unreadable files still count as files)."""
    inv = file_inventory(spark, root, datasets)
    gate = inv.agg(
        F.coalesce(F.bool_and(F.col("n_files") > 0), F.lit(False)).alias("every_dataset_has_files"),
        F.sum("n_files").cast("bigint").alias("total_files"),
        F.sum("n_rows").cast("bigint").alias("total_rows"),
    ).select(
        (F.col("every_dataset_has_files") & (F.col("total_files") > 0)).alias("all_valid"),
        "total_files", "total_rows",
    )
    return inv, gate


MANIFEST = "run int, kind string, file string, length bigint, modified timestamp"
KINDS = {"pairs": PAIR_COLS, "files": FILE_COLS}


@dataclass
class IngestRun:
    """A run over landed files: its number (0: nothing was new), the files that it read,
    and everything ingested so far."""

    run: int
    read: DataFrame
    pairs: DataFrame
    files: DataFrame
    stats: DataFrame
    inventory: DataFrame
    gate: DataFrame


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def manifest(spark: SparkSession, out_dir: str) -> DataFrame:
    """Files of all finished runs."""
    path = f"{out_dir.rstrip('/')}/manifest"
    if not _exists(spark, path):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(path)


def ingested(spark: SparkSession, out_dir: str, kind: str) -> DataFrame:
    """Rows of a kind (``pairs`` or ``files``) from finished runs; of a file that was
    ingested again after it changed, the rows of its last run."""
    columns = KINDS[kind]
    done = manifest(spark, out_dir).filter(F.col("kind") == kind)
    last = done.agg(F.max("run")).first()[0]
    path = f"{out_dir.rstrip('/')}/{kind}"
    if last is None or not _exists(spark, path):
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in columns))
    schema = ", ".join(f"{c} string" for c in columns) + ", file string, run int"
    rows = spark.read.schema(schema).parquet(path).filter(F.col("run") <= last)  # prunes folders
    newest = done.groupBy("file").agg(F.max("run").alias("newest"))
    stale = done.join(newest, "file").filter("run < newest").select("run", "file")
    return rows.join(stale, ["run", "file"], "left_anti").select(*columns)


def ingest_landed(spark: SparkSession, out_dir: str, pairs_dir: str, files_dir: str, name_contains: str = "train",
                  suffix: str = ".jsonl.gz", language: Column | str | None = None) -> IngestRun:
    """Ingest the pair shards and whole-file records that no earlier run has finished.

    Files are new when the manifest holds none of their path, length and time.  New rows
    are filtered and written by language as a run of their own; the manifest gets the
    run's files last, so a run that dies leaves nothing that is read and is done again
    under its number.  Without new files nothing is written.  One run writes to a folder
    at a time.  Rows are not capped: a cap needs all runs (``cap_per_language`` on the
    result).  Names of new files pass through the driver, as in any Spark scan.
    """
    root = out_dir.rstrip("/")
    done = manifest(spark, root)
    shards = landed_files(spark, pairs_dir, suffix).filter(F.col("file").contains(name_contains))
    landed = shards.withColumn("kind", F.lit("pairs")).unionByName(landed_files(spark, files_dir, ".parquet").withColumn("kind", F.lit("files")))
    new = landed.join(done.select("kind", "file", "length", "modified"), ["kind", "file", "length", "modified"], "left_anti").collect()
    number = 0
    if new:
        number = (done.agg(F.max("run")).first()[0] or 0) + 1
        names = {kind: [r.file for r in new if r.kind == kind] for kind in KINDS}
        if names["pairs"]:
            found = scan_jsonl_pairs(spark, pairs_dir, language, name_contains, suffix, names["pairs"], keep_file=True)
            kept = found.filter(ingest_pair_filter("code", "docstring"))
            write_parquet_by_language(kept.select(*PAIR_COLS, "file"), f"{root}/pairs/run={number}")
        if names["files"]:
            found = scan_whole_files(spark, files_dir, only=set(names["files"]), keep_file=True)
            kept = found.filter(has_doc_marker("content", "language"))
            write_parquet_by_language(kept.select(*FILE_COLS, "file"), f"{root}/files/run={number}")
        rows = [(number, r.kind, r.file, r.length, r.modified) for r in new]
        spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{root}/manifest")
    read = spark.createDataFrame([(r.kind, r.file) for r in new], "kind string, file string")
    pairs, files = ingested(spark, root, "pairs"), ingested(spark, root, "files")
    by_kind = [ingest_stats(df).select(F.lit(kind).alias("kind"), "language", "n") for kind, df in (("pairs", pairs), ("files", files))]
    inventory, gate = verify(spark, root, list(KINDS))
    return IngestRun(number, read, pairs, files, by_kind[0].unionByName(by_kind[1]), inventory, gate)

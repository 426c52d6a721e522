"""Land derived fixtures as raw files, the way the ingest step leaves them.

Files go under the shared scratch folder (``spark.checkpoint.dir``), once per
input folder: a marker table is written last and checked first.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import fixtures as X
from .session import scratch_dir, write_file


LANDING_VERSION = "6"
PAGE_IDS = 100  # ids of one page of search results
RANGE_BYTES = 8 << 20  # input of one range of landed lines, so that a task sorts them in memory


def _tag(spark: SparkSession, sf_dir: str) -> str:
    """Folder tag: input files (path, size, time) and fixture definitions, so that a
    changed input or fixture lands anew."""
    h = hashlib.md5(sf_dir.rstrip("/").encode())
    folder = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(folder, True)
    seen = []
    while files.hasNext():
        f = files.next()
        seen.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    h.update("\n".join(sorted(seen)).encode())
    h.update(LANDING_VERSION.encode())
    for name in sorted(X.FIXTURES):
        h.update(X.FIXTURES[name][0](X.SPARK).encode())
    return h.hexdigest()[:16]


def _done(spark: SparkSession, marker: str) -> bool:
    try:
        spark.read.parquet(marker).limit(1).count()
        return True
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def landed_dir(spark: SparkSession, sf_dir: str, what: str) -> str:
    return f"{scratch_dir(spark)}/quarry-landed/{_tag(spark, sf_dir)}/{what}"


def land_raw(spark: SparkSession, sf_dir: str) -> str:
    """Raw folders of the preprocessing job; returns the raw root."""
    root = landed_dir(spark, sf_dir, "raw")
    marker = f"{root}/_landed"
    if _done(spark, marker):
        return root
    pairs = X.fixture(spark, sf_dir, "fx_pairs")
    for lang in ["python", "javascript", "java", "go", "ruby", "php"]:
        (pairs.filter(F.col("language") == lang)
         .select("code", "docstring", "language", "repo", "path")
         .write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/codesearchnet/{lang}.parquet"))
    (X.fixture(spark, sf_dir, "fx_corpus").select("desc", "decl", "bodies")
     .write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/code_docstring_corpus/train.parquet"))
    (X.fixture(spark, sf_dir, "fx_instr").select("instruction", "input", "output")
     .write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/python_code_instructions/train.parquet"))
    # one unreadable entry: skipped by every reader, still listed by the inventory
    write_file(spark, f"{root}/codesearchnet/broken.parquet", b"not a parquet file")
    filesdf = X.fixture(spark, sf_dir, "fx_files")
    for lang in X.FILE_LANGS:
        (filesdf.filter(F.col("language") == lang).select("content", "path")
         .write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/the_stack_smol/{lang}.parquet"))
    spark.range(1).write.mode("overwrite").parquet(marker)
    return root


def land_lines(spark: SparkSession, sf_dir: str) -> str:
    """JSONL shards of the validator, lines in doc_id order.  A shard is a folder whose files
    hold successive ranges of it, as many as the data needs; their names are in order."""
    root = landed_dir(spark, sf_dir, "lines")
    marker = f"{root}_landed"
    if _done(spark, marker):
        return root
    lines = X.fixture(spark, sf_dir, "fx_lines")
    source = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/documents.parquet")
    size = source.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(source).getLength()
    ranges = [-(-size // RANGE_BYTES)] if size > 8 * RANGE_BYTES else []  # small inputs: as the session has it
    (lines.repartitionByRange(*ranges, "shard", "doc_id").sortWithinPartitions("shard", "doc_id")
     .select("shard", "line").write.mode("overwrite").partitionBy("shard").text(root))
    spark.range(1).write.mode("overwrite").parquet(marker)
    return root


def land_shards(spark: SparkSession, sf_dir: str) -> str:
    """gzip JSON-lines shards of raw pairs: ``language=<l>/split=<train|test>/``.

    Every 5th document uses the alternative keys func_code_string /
    func_documentation_string; every 23rd line is not JSON.  Null fields are
    left out of the JSON object (absent keys)."""
    root = landed_dir(spark, sf_dir, "shards")
    marker = f"{root}_landed"
    if _done(spark, marker):
        return root
    p = X.fixture(spark, sf_dir, "fx_pairs")
    obj = F.when(
        F.col("alt_keys"),
        F.to_json(F.struct(F.col("code").alias("func_code_string"),
                           F.col("docstring").alias("func_documentation_string"), "repo", "path")),
    ).otherwise(F.to_json(F.struct("code", "docstring", "repo", "path")))
    line = F.when(F.col("broken_line"), F.lit("not json")).otherwise(obj)
    (p.select("language", F.col("shard").alias("split"), line.alias("value"))
     .write.mode("overwrite").partitionBy("language", "split").option("compression", "gzip").text(root))
    spark.range(1).write.mode("overwrite").parquet(marker)
    return root


def land_payloads(spark: SparkSession, sf_dir: str) -> str:
    """Repository payloads as JSON lines: hits/ (nested owner), readmes/, trees/."""
    root = landed_dir(spark, sf_dir, "payloads")
    marker = f"{root}_landed"
    if _done(spark, marker):
        return root
    repos = X.fixture(spark, sf_dir, "fx_repos")
    hit = F.struct(F.struct(F.col("owner").alias("login")).alias("owner"), "name", "html_url",
                   F.col("stars").alias("stargazers_count"), "language", "description",
                   F.date_format("pushed_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("pushed_at"))
    # half of the hits as search pages with an ``items`` array, the others one per line;
    # a page holds a fixed range of ids, so pages grow in number and not in size
    paged = repos.filter("doc_id % 2 = 0").groupBy(F.floor(F.col("doc_id") / PAGE_IDS).alias("page")).agg(F.collect_list(hit).alias("items"))
    paged.select(F.size("items").alias("total_count"), "items").write.mode("overwrite").option("compression", "gzip").json(f"{root}/hits")
    repos.filter("doc_id % 2 = 1").select(hit.alias("h")).select("h.*").write.mode("append").option("compression", "gzip").json(f"{root}/hits")
    X.fixture(spark, sf_dir, "fx_readmes").select("owner", "name", "content").write.mode("overwrite").option(
        "compression", "gzip").json(f"{root}/readmes")
    X.fixture(spark, sf_dir, "fx_trees").select("owner", "name", "tree").write.mode("overwrite").option(
        "ignoreNullFields", "false").option("compression", "gzip").json(f"{root}/trees")
    spark.range(1).write.mode("overwrite").parquet(marker)
    return root


def land_contents(spark: SparkSession, sf_dir: str) -> str:
    """Contents of repository files as JSON lines."""
    root = landed_dir(spark, sf_dir, "contents")
    marker = f"{root}_landed"
    if not _done(spark, marker):
        X.fixture(spark, sf_dir, "fx_contents").select("owner", "name", "path", "content").write.mode("overwrite").option("compression", "gzip").json(root)
        spark.range(1).write.mode("overwrite").parquet(marker)
    return root

"""Readers for landed raw files.

A folder holds ``{name}.parquet`` entries, each a file or a directory of part
files.  Files may differ in columns and types: their footers are read first, and
all files of one footer schema are one scan, however many there are; a row's entry
is taken from the path of its file.

A file that cannot be read is left out whole, as the processors skip a file they
fail on: one without a readable footer, or one whose pages give fewer rows than its
footer counts (every page is decoded once for that; ``verify=False`` trusts the
pages).  ``skipped_entries`` names such files.  An absent folder gives an empty
DataFrame of the expected schema.  Any other error is raised.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SUFFIX = ".parquet"
FOOTER_THREADS = 16


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def _string_or_default(df: DataFrame, candidates: list[str], default: str | None = "") -> F.Column:
    """First *present* column among candidates (plan-time choice), else a literal."""
    for c in candidates:
        if c in df.columns:
            return F.col(f"`{c}`").cast("string")
    return F.lit(default).cast("string")


@dataclass(frozen=True)
class PartFile:
    """One file of an entry; ``schema`` is None when its footer cannot be read."""

    path: str
    stem: str
    schema: str | None
    rows: int


def entries(spark: SparkSession, folder: str) -> list[tuple[str, str]]:
    """(path, stem) of the files of the ``*.parquet`` entries of a folder (non-recursive)."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/*{SUFFIX}")
    system = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    out = []
    for found in system.globStatus(pattern) or []:
        stem = found.getPath().getName()[: -len(SUFFIX)]
        parts = system.listStatus(found.getPath()) if found.isDirectory() else [found]
        out += [(p.getPath().toString(), stem) for p in parts if p.isFile() and p.getPath().getName()[0] not in "_."]
    return sorted(out)


def part_files(spark: SparkSession, folder: str) -> list[PartFile]:
    """The files of a folder with schema and row count of their footers."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def footer(entry: tuple[str, str]) -> PartFile:
        path, stem = entry
        try:
            source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(path), conf)
            reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
        except Py4JJavaError as e:
            # what the footer parser reports; a missing or forbidden file is another matter
            if e.java_exception.getClass().getName() in ("java.lang.RuntimeException", "java.io.IOException", "java.io.EOFException"):
                return PartFile(path, stem, None, 0)
            raise
        try:
            return PartFile(path, stem, reader.getFileMetaData().getSchema().toString(), reader.getRecordCount())
        finally:
            reader.close()

    found = entries(spark, folder)
    with ThreadPool(FOOTER_THREADS) as pool:
        return pool.map(footer, found)


def _file(spark: SparkSession, folder: str) -> Column:
    """A row's file, relative to the folder."""
    top = spark._jvm.org.apache.hadoop.fs.Path(folder.rstrip("/"))
    top = top.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(top).toString()
    path = F.regexp_replace(_decoded(F.col("_metadata.file_path")), "^([a-z0-9]+):/+", "$1:/")
    return F.substring(path, len(_one_slash(top)) + 2, 1 << 30)


def _scan(spark: SparkSession, files: list[PartFile]) -> DataFrame:
    return spark.read.option("ignoreCorruptFiles", "true").parquet(*[f.path for f in files])


def _by_schema(files: list[PartFile]) -> list[list[PartFile]]:
    groups: dict[str, list[PartFile]] = {}
    for f in files:
        if f.schema is not None:
            groups.setdefault(f.schema, []).append(f)
    return list(groups.values())


def _damaged(spark: SparkSession, folder: str, files: list[PartFile]) -> set[str]:
    """Paths of the files (of one schema) that give fewer rows than their footers count."""
    df = _scan(spark, files)
    # the hash makes the scan decode every column; one row a file is returned
    seen = df.groupBy(_file(spark, folder).alias("file")).agg(F.count(F.lit(1)).alias("n"), F.max(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])))
    rows = {r["file"]: r["n"] for r in seen.collect()}
    return {f.path for f in files if f.rows > rows.get(_below(f, folder), 0)}


def _below(f: PartFile, folder: str) -> str:
    """A file's path relative to the folder."""
    name = f.path.rsplit("/", 1)[1]
    return name if name == f.stem + SUFFIX and not f.path.rsplit("/", 2)[1] == f.stem + SUFFIX else f"{f.stem}{SUFFIX}/{name}"


def read_entries(spark: SparkSession, folder: str, schema: T.StructType,
                 project: Callable[[DataFrame, Column], DataFrame], verify: bool = True,
                 only: set[str] | None = None) -> DataFrame:
    """Union of ``project(files of one schema, column of their entry's stem)``; ``only``
    names the files to read by their paths below the folder (all, if None)."""
    out = None
    for files in _by_schema([f for f in part_files(spark, folder) if only is None or _below(f, folder) in only]):
        bad = _damaged(spark, folder, files) if verify else set()
        files = [f for f in files if f.path not in bad]
        if files:
            stem = F.regexp_extract(_file(spark, folder), r"^([^/]+)\.parquet(?:/|$)", 1)
            part = project(_scan(spark, files), stem)
            out = part if out is None else out.unionByName(part)
    return _empty(spark, schema) if out is None else out


def skipped_entries(spark: SparkSession, folder: str) -> DataFrame:
    """(entry, file, reason) of the files that the readers leave out: ``footer`` or ``pages``."""
    files = part_files(spark, folder)
    out = [(f.stem, _below(f, folder), "footer") for f in files if f.schema is None]
    for group in _by_schema(files):
        bad = _damaged(spark, folder, group)
        out += [(f.stem, _below(f, folder), "pages") for f in group if f.path in bad]
    return spark.createDataFrame(out, "entry string, file string, reason string")


PAIR_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in
                            ["language", "code", "docstring", "repo", "path"]])


def scan_language_files(spark: SparkSession, path: str, verify: bool = True) -> DataFrame:
    """``{language}.parquet`` files: language is the file stem, not a column."""
    return read_entries(spark, path, PAIR_SCHEMA, lambda df, stem: df.select(
        stem.alias("language"), *[_string_or_default(df, [c]).alias(c) for c in ("code", "docstring", "repo", "path")]), verify)


CORPUS_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ["desc", "decl", "bodies"]])


def scan_corpus(spark: SparkSession, path: str, verify: bool = True) -> DataFrame:
    """Docstring corpus (desc, decl, bodies); a constant language is added later."""
    return read_entries(spark, path, CORPUS_SCHEMA, lambda df, stem: df.select(
        *[_string_or_default(df, [c]).alias(c) for c in ("desc", "decl", "bodies")]), verify)


INSTR_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ["instruction", "input", "output"]])


def resolve_instruction_columns(df: DataFrame) -> DataFrame:
    """instruction <- instruction | prompt | ''; output <- output | response | ''."""
    return df.select(
        _string_or_default(df, ["instruction", "prompt"]).alias("instruction"),
        _string_or_default(df, ["input"]).alias("input"),
        _string_or_default(df, ["output", "response"]).alias("output"),
    )


def scan_instructions(spark: SparkSession, path: str, verify: bool = True) -> DataFrame:
    return read_entries(spark, path, INSTR_SCHEMA, lambda df, stem: resolve_instruction_columns(df), verify)


FILE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ["language", "content", "path"]])


def scan_whole_files(spark: SparkSession, path: str, verify: bool = True, only: set[str] | None = None,
                     keep_file: bool = False) -> DataFrame:
    """``{language}.parquet`` whole-file records (content, path); ``keep_file`` adds the
    path of their file below the folder as ``file``."""
    extra = [_file(spark, path).alias("file")] if keep_file else []
    schema = T.StructType([*FILE_SCHEMA.fields, *([T.StructField("file", T.StringType())] if keep_file else [])])
    return read_entries(spark, path, schema, lambda df, stem: df.select(
        stem.alias("language"), *[_string_or_default(df, [c]).alias(c) for c in ("content", "path")], *extra), verify, only)


def landed_files(spark: SparkSession, root: str, suffix: str) -> DataFrame:
    """(file, length, modified) of the files below a folder, by path below it; no content
    is read.  An absent folder has none."""
    top = spark._jvm.org.apache.hadoop.fs.Path(root.rstrip("/"))
    system = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(top):
        return spark.createDataFrame([], "file string, length bigint, modified timestamp")
    below = len(_one_slash(system.makeQualified(top).toString())) + 2
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).filter(F.col("path").endswith(suffix))
    path = F.regexp_replace("path", "^([a-z0-9]+):/+", "$1:/")
    return found.select(F.substring(path, below, 1 << 30).alias("file"), "length", F.col("modificationTime").alias("modified"))


def _decoded(path: F.Column) -> F.Column:
    """A ``_metadata.file_path`` as a plain path (it is percent-encoded; '+' is not)."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def file_inventory(spark: SparkSession, root: str, datasets: list[str]) -> DataFrame:
    """Per expected dataset folder: ``*.parquet`` entries (recursive) and rows.

    Paths come from the binaryFile source (no content is read), taken relative
    to the qualified root; rows are counted under an empty schema, from footers
    alone, so neither differing schemas nor an unreadable file changes the count
    of the others.  Expected names absent on disk appear with zero files.
    """
    top = spark._jvm.org.apache.hadoop.fs.Path(root.rstrip("/"))
    top = top.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(top).toString()
    plain = lambda c: F.regexp_replace(c, "^([a-z0-9]+):/+", "$1:/")
    below = F.lit(len(_one_slash(top)) + 2)
    names = spark.createDataFrame([(d,) for d in datasets], "dataset string")
    options = {"pathGlobFilter": f"*{SUFFIX}", "recursiveFileLookup": "true"}
    try:
        listed = spark.read.format("binaryFile").options(**options).load(root).select(plain(F.col("path")).alias("path"))
        counted = (
            spark.read.schema("_none boolean").options(ignoreCorruptFiles="true", **options).parquet(root)
            .groupBy(plain(_decoded(F.col("_metadata.file_path"))).alias("path")).agg(F.count(F.lit(1)).alias("rows"))
        )
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        listed = spark.createDataFrame([], "path string")
        counted = spark.createDataFrame([], "path string, rows bigint")
    relative = F.expr("substring(path, _below)")
    files = (
        listed.join(counted, "path", "left").withColumn("_below", below).withColumn("relative", relative)
        .select(
            F.substring_index("relative", "/", 1).alias("dataset"), "rows",
            # a directory of part files is one entry
            F.regexp_extract("relative", r"^(.*?\.parquet)(?:/|$)", 1).alias("entry"),
        )
        .groupBy("dataset").agg(F.countDistinct("entry").alias("n_files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("n_rows"))
    )
    return names.join(files, "dataset", "left").select(
        "dataset",
        F.coalesce("n_files", F.lit(0)).cast("bigint").alias("n_files"),
        F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"),
    )


def _one_slash(uri: str) -> str:
    """A URI with one slash after its scheme, whatever number it was written with."""
    scheme, sep, rest = uri.partition(":")
    return f"{scheme}:/{rest.lstrip('/')}" if sep else uri

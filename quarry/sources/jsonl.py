"""JSON-lines sources.

``scan_lines`` keeps every physical line (blank lines included) with its exact
1-based number inside its file.  The text is read once: each line is written with
its position, the file block it came from and an id.  Within one block the ids of
``monotonically_increasing_id`` are consecutive, so a line's number is its offset
inside the block plus the line counts of the earlier blocks, which come from an
index of one row per block.  Ids are written before they are counted, so a lost
executor or another number of cores cannot change them in between.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import col, let
from ..session import scratch_dir


def _text_files(spark: SparkSession, kind: str, path: str, glob: str | None, recursive: bool) -> DataFrame:
    reader = spark.read.format(kind)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(path)


def scan_positions(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = False,
                   by_folder: bool = False) -> DataFrame:
    """(file, at, line) for every line of the matched text files, in one scan.

    ``at`` is the line's position: part, block and id, made a number by ``number_lines``
    once it is written.  ``by_folder`` makes ``file`` the folder: its files are the parts
    of one long file, in order of their numbered names (shorter names first)."""
    whole = F.col("_metadata.file_path")
    return _text_files(spark, "text", path, glob, recursive).select(
        (F.regexp_extract(whole, "^(.*)/", 1) if by_folder else whole).alias("file"),
        F.struct(whole.alias("part"), F.col("_metadata.file_block_start").alias("block"),
                 F.monotonically_increasing_id().alias("id")).alias("at"),
        F.col("value").alias("line"),
    )


def block_index(table: DataFrame) -> DataFrame:
    """(part, block, first_id, before): one row per file block of a written table with
    ``file`` and ``at``; ``before`` counts the lines of the file's earlier blocks."""
    blocks = table.groupBy("file", F.col("at.part").alias("part"), F.col("at.block").alias("block")).agg(
        F.min("at.id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("file").orderBy(F.length("part"), "part", "block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select("part", "block", "first_id", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))


def number_lines(table: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """A *written* table with ``file`` and ``at`` gets ``line_no`` in place of ``at``.

    It must be written, as ids of a scan that runs twice need not agree.  Spark
    broadcasts the index (one row a block) only while it is small."""
    index = (block_index(table) if index is None else index).select(F.struct("part", "block").alias("_block"), "first_id", "before")
    number = (F.col("before") + F.col("at.id") - F.col("first_id") + 1).alias("line_no")
    kept = [number if c == "at" else F.col(f"`{c}`") for c in table.columns]
    return table.join(index, F.struct("at.part", "at.block") == F.col("_block")).select(*kept)


def _files_digest(spark: SparkSession, path: str, glob: str | None, recursive: bool) -> str:
    """Digest of the matched files' paths, lengths and times; one aggregation, no contents."""
    files = _text_files(spark, "binaryFile", path, glob, recursive)
    r = files.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("a"),
                  F.sum(F.hash("path", "length", "modificationTime").cast("long")).alias("b")).first()
    return f"{r.n}-{(r.a or 0) & (2**64 - 1):016x}-{(r.b or 0) & (2**64 - 1):016x}"


def scan_lines(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = False,
               by_folder: bool = False) -> DataFrame:
    """(file, line_no, line) for every line of the matched text files.

    Lines and block index are written once per state of the files (paths, lengths and
    times) in the shared folder, and read by every later call; ``by_folder`` as in
    ``scan_positions``.  A job that keeps little of each line, such as the validation,
    numbers its own narrow table instead, and writes no copy of the text."""
    home = f"{scratch_dir(spark)}/quarry-lines/{_files_digest(spark, path, glob, recursive)}{'-folders' * by_folder}"
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{home}/index/_SUCCESS")
    lines = scan_positions(spark, path, glob, recursive, by_folder)
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        lines.write.mode("overwrite").parquet(f"{home}/lines")
        block_index(spark.read.schema(lines.schema).parquet(f"{home}/lines")).write.mode("overwrite").parquet(f"{home}/index")
    return number_lines(spark.read.schema(lines.schema).parquet(f"{home}/lines"), spark.read.parquet(f"{home}/index"))


def parse_strict(line: Column | str) -> Column:
    """Variant of a line that holds exactly one JSON document, else null.

    Wrapping the line in brackets rejects trailing junk, blank lines and
    several documents on one line (duplicate keys: last wins)."""
    wrapped = F.try_parse_json(F.concat(F.lit("["), col(line), F.lit("]")))
    return let(wrapped, lambda w: F.when(F.size(w.cast("array<variant>")) == 1,
                                         F.try_variant_get(w, "$[0]", "variant")))


def is_object(v: Column) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(v), F.lit("OBJECT")), F.lit(False))


def field(v: Column, name: str) -> Column:
    """The field as a variant: SQL null when absent, a variant null when JSON null."""
    return F.try_variant_get(v, f"$.{name}", "variant")


def field_is_string(v: Column, name: str) -> Column:
    return F.coalesce(F.schema_of_variant(field(v, name)) == F.lit("STRING"), F.lit(False))


def field_string(v: Column, name: str) -> Column:
    """String value of a field when it is a JSON string, else null."""
    return let(field(v, name), lambda f: F.when(F.schema_of_variant(f) == F.lit("STRING"),
                                                F.try_variant_get(f, "$", "string")))


def field_text_or(v: Column, names: list[str], default: str | None) -> Column:
    """First *present* key among names (JSON null stays null), else the default."""

    def body(vv: Column) -> Column:
        expr = F.lit(default).cast("string")
        for n in reversed(names):
            f = field(vv, n)
            expr = F.when(f.isNotNull(), F.try_variant_get(f, "$", "string")).otherwise(expr)
        return expr

    return let(v, body)


def encoded_root(spark: SparkSession, path: str) -> str:
    """The path of a folder as it appears in ``_metadata.file_path``, without scheme."""
    return spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/")).toUri().getRawPath()


def glob_escaped(path: str) -> str:
    """A path whose glob characters stand for themselves."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def scan_jsonl_pairs(spark: SparkSession, path: str, language: Column | str | None = None,
                     name_contains: str = "train", suffix: str = ".jsonl.gz",
                     files: list[str] | None = None, keep_file: bool = False) -> DataFrame:
    """Code/docstring pairs from gzip JSON-lines shards.

    Only files whose path below the root contains ``name_contains`` and ends with
    ``suffix`` are read (gzip is decoded by the text source, one task per file).  Lines
    that are not one JSON object are skipped.  Fields fall back by key presence:
    code <- code | func_code_string | '', docstring likewise, repo/path <- ''.
    ``files`` (paths below the root, not empty) are read instead of the whole root;
    ``keep_file`` adds the path below the root as ``file``.
    """
    root = encoded_root(spark, path)
    reader = spark.read.option("recursiveFileLookup", "true")
    source = path if files is None else [f"{path.rstrip('/')}/{glob_escaped(f)}" for f in files]
    lines = (
        reader.text(source)
        .select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
        .filter(F.substring_index("file", root + "/", -1).contains(name_contains) & F.col("file").endswith(suffix))
    )
    v = parse_strict("line")
    parsed = lines.select("file", v.alias("v")).filter(is_object(F.col("v")))
    lang = F.lit(language) if isinstance(language, str) else (language if language is not None else F.lit(None))
    return parsed.select(
        field_text_or(F.col("v"), ["code", "func_code_string"], "").alias("code"),
        field_text_or(F.col("v"), ["docstring", "func_documentation_string"], "").alias("docstring"),
        lang.cast("string").alias("language"),
        field_text_or(F.col("v"), ["repo"], "").alias("repo"),
        field_text_or(F.col("v"), ["path"], "").alias("path"),
        *([F.url_decode(F.replace(F.substring_index("file", root + "/", -1), F.lit("+"), F.lit("%2B"))).alias("file")] if keep_file else []),
    )

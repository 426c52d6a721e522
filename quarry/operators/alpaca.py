"""Conversion of raw records to instruction/input/output rows.

Each converter takes a raw DataFrame and returns the five example columns plus
``_ck``, an md5 content key of the row (source, language, native instruction,
input, output).  Template instructions are a deterministic function of
``(seed, _ck)``, so equal keys always mean equal rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.quality import is_quality_doc
from ..functions.text import clean_text, col, fence, hex_int, py_strip, row_key, seeded_key

EXAMPLE_COLUMNS = ["instruction", "input", "output", "source", "language"]


def template_for(task: str, seed: int, key: Column | str) -> Column:
    """Instruction template of ``task`` chosen by md5 of (seed, key)."""
    templates = K.INSTRUCTION_TEMPLATES[task]
    idx = hex_int(seeded_key(seed, "tpl", key)) % F.lit(len(templates))
    return F.element_at(F.array(*[F.lit(t) for t in templates]), (idx + 1).cast("int"))


def _finish(df: DataFrame, task: str | None, seed: int) -> DataFrame:
    """Add the content key and (for template rows) the instruction."""
    native = F.col("instruction") if task is None else F.lit("")
    df = df.withColumn("_ck", row_key("source", "language", native, "input", "output"))
    if task is not None:
        df = df.withColumn("instruction", template_for(task, seed, "_ck"))
    return df.select(*EXAMPLE_COLUMNS, "_ck")


def pair_filter(code: Column | str, doc: Column | str) -> Column:
    """Keep a pair: code non-empty, stripped code >= 20 code points, quality doc."""
    c = col(code)
    ok = c.isNotNull() & (c != "") & (F.length(py_strip(c)) >= 20) & is_quality_doc(doc)
    return F.coalesce(ok, F.lit(False))


def pairs_to_examples(pairs: DataFrame, seed: int = K.DEFAULT_SEED, source: str = "codesearchnet") -> DataFrame:
    """(language, code, docstring) -> examples with a fenced code input."""
    df = pairs.filter(pair_filter("code", "docstring")).select(
        F.lit(None).cast("string").alias("instruction"),
        fence("language", py_strip("code")).alias("input"),
        clean_text("docstring").alias("output"),
        F.lit(source).alias("source"),
        F.col("language").cast("string").alias("language"),
    )
    return _finish(df, "function_doc", seed)


def fence_with_decl(decl: Column | str, bodies: Column | str) -> Column:
    """Python block; a truthy declaration (even whitespace) is prepended on its own line."""
    d = col(decl)
    with_decl = fence(F.lit("python"), F.concat(py_strip(d), F.lit("\n"), py_strip(bodies)))
    return F.when(d.isNotNull() & (d != ""), with_decl).otherwise(fence(F.lit("python"), py_strip(bodies)))


def corpus_to_examples(corpus: DataFrame, seed: int = K.DEFAULT_SEED) -> DataFrame:
    """(desc, decl, bodies) -> python examples."""
    df = corpus.filter(pair_filter("bodies", "desc")).select(
        F.lit(None).cast("string").alias("instruction"),
        fence_with_decl("decl", "bodies").alias("input"),
        clean_text("desc").alias("output"),
        F.lit("code_docstring_corpus").alias("source"),
        F.lit("python").alias("language"),
    )
    return _finish(df, "function_doc", seed)


def instruction_filter(instruction: Column | str, output: Column | str) -> Column:
    """Instruction and output non-empty before cleaning (input may be empty)."""
    i, o = col(instruction), col(output)
    return F.coalesce(i.isNotNull() & (i != "") & o.isNotNull() & (o != ""), F.lit(False))


def instructions_to_examples(instr: DataFrame) -> DataFrame:
    """(instruction, input, output) rows already in instruction format; cleaned."""
    df = instr.filter(instruction_filter("instruction", "output")).select(
        clean_text("instruction").alias("instruction"),
        clean_text("input").alias("input"),
        clean_text("output").alias("output"),
        F.lit("python_code_instructions").alias("source"),
        F.lit("python").alias("language"),
    )
    return _finish(df, None, 0)


def file_filter(content: Column | str) -> Column:
    """Whole files of at least 100 code points."""
    c = col(content)
    return F.coalesce(c.isNotNull() & (F.length(c) >= 100), F.lit(False))


def truncate_fence(language: Column | str, content: Column | str, n: int = 2000) -> Column:
    """First n code points, stripped, fenced."""
    return fence(language, py_strip(F.substring(col(content), 1, n)))


def files_to_examples(files: DataFrame, seed: int = K.DEFAULT_SEED) -> DataFrame:
    """(language, content) -> code-explanation examples with a constant output."""
    df = files.filter(file_filter("content")).select(
        F.lit(None).cast("string").alias("instruction"),
        truncate_fence("language", "content").alias("input"),
        F.lit(K.FILE_EXAMPLE_OUTPUT).alias("output"),
        F.lit("the_stack_smol").alias("source"),
        F.col("language").cast("string").alias("language"),
    )
    return _finish(df, "code_explain", seed)


def documented_pair(code: Column | str, doc: Column | str, language: Column | str = None) -> list[Column]:
    """Documented conversion: fixed instruction, fenced code, documentation."""
    lang = F.lit("python") if language is None else col(language)
    return [
        F.lit(K.DOCUMENTED_PAIR_INSTRUCTION).alias("instruction"),
        fence(lang, col(code)).alias("input"),
        col(doc).alias("output"),
    ]


def prompt_single_file(language: Column | str, filename: Column | str, code: Column | str) -> Column:
    """Single-file prompt: language, file name, fenced code."""
    return F.concat(
        F.lit("Language: "), col(language), F.lit("\nFile: "), col(filename), F.lit("\n\n"),
        fence(language, col(code)),
    )

"""Constraint-driven validation of instruction examples and per-file reports.

A line is first checked to be exactly one JSON document, then an object, then
checked against a bounds table (required fields, string type, min/max code
points; optional string fields).  Errors are stable codes ``field:rule`` in a
fixed order: required (field order), then per property type/minLength/maxLength,
then optional string fields.  Every report is an aggregate or a bounded
per-file window over the lines; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.text import let, preview
from ..sources.jsonl import field, field_string, is_object, parse_strict
from .ranking import top_k_per_group

PARSE_ERROR = "json:parse"
TYPE_ERROR = "$:type"


def error_codes(v: Column, bounds: dict[str, tuple[int, int]] = K.TRAINING_BOUNDS,
                required: list[str] = K.REQUIRED_FIELDS,
                optional: list[str] = K.OPTIONAL_STRING_FIELDS) -> Column:
    """Array of error codes of a parsed document (empty = valid)."""
    checks: list[Column] = []
    obj = is_object(v)
    for f in required:
        checks.append(F.when(obj & field(v, f).isNull(), F.lit(f"{f}:required")))
    for f, (lo, hi) in bounds.items():
        fv = field(v, f)
        is_str = F.schema_of_variant(fv) == F.lit("STRING")
        n = F.length(F.try_variant_get(fv, "$", "string"))
        checks.append(F.when(obj & fv.isNotNull() & ~is_str, F.lit(f"{f}:type")))
        checks.append(F.when(obj & fv.isNotNull() & is_str & (n < lo), F.lit(f"{f}:minLength")))
        checks.append(F.when(obj & fv.isNotNull() & is_str & (n > hi), F.lit(f"{f}:maxLength")))
    for f in optional:
        fv = field(v, f)
        checks.append(F.when(obj & fv.isNotNull() & (F.schema_of_variant(fv) != F.lit("STRING")),
                             F.lit(f"{f}:type")))
    not_obj = F.when(~obj, F.array(F.lit(TYPE_ERROR)))
    return F.coalesce(not_obj, F.array_compact(F.array(*checks)))


def validate_lines(lines: DataFrame, bounds: dict[str, tuple[int, int]] = K.TRAINING_BOUNDS) -> DataFrame:
    """(file, line_no, line) -> + v, parsed, errors, valid, error (first code)."""
    out = lines.withColumn("v", parse_strict("line"))
    errs = let(F.col("v"), lambda v: F.when(v.isNull(), F.array(F.lit(PARSE_ERROR)))
               .otherwise(error_codes(v, bounds)))
    return (
        out.withColumn("errors", errs)
        .withColumn("parsed", F.col("v").isNotNull())
        .withColumn("valid", F.size("errors") == 0)
        .withColumn("error", F.try_element_at("errors", F.lit(1)))
    )


def summary(validated: DataFrame) -> DataFrame:
    """Per file: total, valid, invalid (BIGINT)."""
    return validated.groupBy("file").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("valid").alias("valid"),
        F.count_if(~F.col("valid")).alias("invalid"),
    )


def error_sample(validated: DataFrame, cap: int = 10, shown: int = 3) -> DataFrame:
    """Recorded errors per file: every parse error, plus schema errors while
    fewer than ``cap`` errors are recorded — i.e. the first ``cap`` invalid
    lines and all parse errors.  ``shown`` marks the first 3 recorded."""
    invalid = validated.filter(~F.col("valid")).select("file", "line_no", "error", "parsed")
    first = top_k_per_group(invalid, cap, ["file"], [F.col("line_no")], rank_col="rank")
    parse_later = invalid.filter(~F.col("parsed")).join(first.select("file", "line_no"), ["file", "line_no"],
                                                       "left_anti").withColumn("rank", F.lit(None).cast("int"))
    rec = first.unionByName(parse_later)
    return rec.select("file", "line_no", "error",
                      F.coalesce(F.col("rank") <= shown, F.lit(False)).alias("shown"))


def field_value_or_unknown(v: Column, name: str) -> Column:
    """Absent key -> 'unknown'; JSON null -> null; else the value as text."""
    return let(field(v, name), lambda f: F.when(f.isNull(), F.lit("unknown"))
               .otherwise(F.try_variant_get(f, "$", "string")))


FACTS = ["file", "line_no", "parsed", "valid", "error", "is_object", "input_length", "output_length", "source", "language",
         "instruction_preview", "input_preview", "output_preview"]


def line_facts(validated: DataFrame) -> DataFrame:
    """What the reports need of a validated line: flags, first error, lengths, source,
    language and previews, without the line or its parsed document.  A line not numbered
    yet keeps its position ``at``.  Facts stay as they are."""
    if "input_length" in validated.columns:
        return validated
    v = F.col("v")
    of_object = lambda c: F.when(is_object(v), c)
    return validated.select(
        "file", "at" if "at" in validated.columns else "line_no", "parsed", "valid", "error",
        F.coalesce(is_object(v), F.lit(False)).alias("is_object"),
        F.length(field_string(v, "input")).alias("input_length"), F.length(field_string(v, "output")).alias("output_length"),
        *[of_object(field_value_or_unknown(v, f)).alias(f) for f in ("source", "language")],
        *[preview(field_string(v, f), K.PREVIEW_CHARS[f]).alias(f"{f}_preview") for f in ("instruction", "input", "output")],
    )


def _lengths(measured: Column) -> list[Column]:
    of = lambda c: F.when(measured, F.col(c))
    return [
        F.avg(of("input_length")).cast("double").alias("avg_input_length"), F.avg(of("output_length")).cast("double").alias("avg_output_length"),
        F.min(of("input_length")).cast("bigint").alias("min_input_length"), F.max(of("input_length")).cast("bigint").alias("max_input_length"),
    ]


LENGTHS = ["avg_input_length", "avg_output_length", "min_input_length", "max_input_length"]


def length_stats(validated: DataFrame) -> DataFrame:
    """Per file over objects whose input and output are strings: average input
    and output length, min and max input length."""
    measured = F.col("parsed") & F.col("input_length").isNotNull() & F.col("output_length").isNotNull()
    return line_facts(validated).filter(measured).groupBy("file").agg(*_lengths(F.lit(True)))


def counts(validated: DataFrame) -> DataFrame:
    """Every count of the reports in one aggregation with grouping sets: rows of
    (file), (file, source) and (file, language), told apart by ``level``."""
    measured = F.col("parsed") & F.col("input_length").isNotNull() & F.col("output_length").isNotNull()
    facts = line_facts(validated)
    file, source, language = F.col("file"), F.col("source"), F.col("language")
    return facts.groupingSets([[file], [file, source], [file, language]], file, source, language).agg(
        F.grouping_id().cast("int").alias("level"), F.count(F.lit(1)).alias("total"), F.count_if("valid").alias("valid"),
        F.count_if(~F.col("valid")).alias("invalid"), F.count_if("is_object").alias("objects"), F.count_if(measured).alias("measured"),
        *_lengths(measured),
    )


BY_FILE, BY_SOURCE, BY_LANGUAGE = 3, 1, 2  # levels of ``counts``


def summary_of(counted: DataFrame) -> DataFrame:
    return counted.filter(F.col("level") == BY_FILE).select("file", "total", "valid", "invalid")


def length_stats_of(counted: DataFrame) -> DataFrame:
    return counted.filter((F.col("level") == BY_FILE) & (F.col("measured") > 0)).select("file", *LENGTHS)


def histogram_of(counted: DataFrame) -> DataFrame:
    named = F.when(F.col("level") == BY_SOURCE, F.lit("source")).otherwise(F.lit("language"))
    value = F.when(F.col("level") == BY_SOURCE, F.col("source")).otherwise(F.col("language"))
    kept = counted.filter((F.col("level") != BY_FILE) & (F.col("objects") > 0))
    return kept.select("file", named.alias("field"), value.alias("value"), F.col("objects").alias("n"))


def histogram(validated: DataFrame) -> DataFrame:
    """Per file: counts by source and by language of parsed objects."""
    return histogram_of(counts(validated))


def top_languages(hist: DataFrame, k: int = 5) -> DataFrame:
    """Top k languages per file by count (ties by name)."""
    langs = hist.filter(F.col("field") == "language").select("file", F.col("value").alias("language"), "n")
    return top_k_per_group(langs, k, ["file"], [F.col("n").desc(), F.col("language").asc_nulls_first()],
                           rank_col="rank")


def sample_entries(validated: DataFrame, n: int = 5, seed: int = K.DEFAULT_SEED) -> DataFrame:
    """n parsed objects per file by a seeded hash order (all when fewer), previewed."""
    objs = line_facts(validated).filter("parsed and is_object").withColumn(
        "_ks", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("file"), F.col("line_no").cast("string"))))
    top = top_k_per_group(objs, n, ["file"], [F.col("_ks")])
    return top.select("file", "line_no", "instruction_preview", "input_preview", "output_preview")


def verdict(summ: DataFrame) -> DataFrame:
    """One row: every file valid and at least one file."""
    return summ.agg(
        F.count(F.lit(1)).alias("n_files"),
        F.coalesce(F.bool_and(F.col("invalid") == 0), F.lit(False)).alias("all_valid"),
    ).select("n_files", (F.col("all_valid") & (F.col("n_files") > 0)).alias("all_valid"))

"""Validation job: JSONL files -> per-file counts, error sample, stats, samples, verdict.

The text is scanned once and parsed once: what the reports need of each line is
written, with its position, as a narrow table in the shared folder; line numbers and
all counts (one aggregation with grouping sets) come from that table.  The tables
belong to the caller's ``temporary_tables`` block, if any; nothing is cached in the
session.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..functions import constants as K
from ..operators import validate as V
from ..session import configure, write_through
from ..sources.jsonl import block_index, number_lines, scan_positions


@dataclass
class ValidationReport:
    lines: DataFrame
    summary: DataFrame
    errors: DataFrame
    stats: DataFrame
    histogram: DataFrame
    top_languages: DataFrame
    samples: DataFrame
    verdict: DataFrame


def validate_dir(spark: SparkSession, path: str, glob: str = "*.jsonl", recursive: bool = False,
                 bounds: dict[str, tuple[int, int]] = K.TRAINING_BOUNDS, sample: int = 5,
                 by_folder: bool = False) -> ValidationReport:
    """The reports per file; per folder of part files with ``by_folder``."""
    configure(spark)
    return validate_lines_report(scan_positions(spark, path, glob, recursive, by_folder), bounds, sample)


def validate_lines_report(lines: DataFrame, bounds: dict[str, tuple[int, int]] = K.TRAINING_BOUNDS,
                          sample: int = 5) -> ValidationReport:
    """Reports of (file, line_no, line), or of (file, at, line) as ``scan_positions`` gives."""
    facts = write_through(V.line_facts(V.validate_lines(lines, bounds)), "validated-lines")
    counted = write_through(V.counts(facts), "validated-counts")
    if "at" in facts.columns:
        facts = number_lines(facts, write_through(block_index(facts), "validated-blocks"))
    summ, hist = V.summary_of(counted), V.histogram_of(counted)
    return ValidationReport(
        lines=facts,
        summary=summ,
        errors=V.error_sample(facts),
        stats=V.length_stats_of(counted),
        histogram=hist,
        top_languages=V.top_languages(hist),
        samples=V.sample_entries(facts, sample),
        verdict=V.verdict(summ),
    )

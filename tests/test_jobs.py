"""Job-level invariants: exact split sizes, caps, missing sources, validation totals."""

import math
import tempfile

from pyspark.sql import functions as F

from small_inputs import SMALL_SF
from quarry import fixtures as X
from quarry.plans.preprocess import preprocess
from quarry.plans.validate import validate_lines_report


def test_split_sizes_and_missing_sources(spark):
    raw = tempfile.mkdtemp(prefix="quarry-raw-")
    pairs = X.fixture(spark, SMALL_SF, "fx_pairs")
    for lang in ("python", "go"):
        (pairs.filter(F.col("language") == lang).select("code", "docstring")
         .write.mode("overwrite").parquet(f"{raw}/codesearchnet/{lang}.parquet"))
    res = preprocess(spark, raw_dir=raw)  # other processors' folders are absent
    counts = {r.source: r.n for r in res.sources.collect()}
    assert counts["code_docstring_corpus"] == 0 and counts["the_stack_smol"] == 0
    n = counts["codesearchnet"]
    assert n > 0
    meta = res.metadata.first()
    assert meta.total_examples == n
    assert meta.train == math.floor(n * 0.8) and meta.val == math.floor(n * 0.1)
    assert meta.train + meta.val + meta.test == n
    langs = {r.language for r in res.split.select("language").distinct().collect()}
    assert langs == {"python", "go"}  # language comes from the file stem


def test_cap_and_dry_run(spark):
    from quarry.catalog import fixture_sources

    res = preprocess(spark, sources=fixture_sources(spark, SMALL_SF), max_per_source=7)
    assert all(r.n <= 7 for r in res.sources.collect())
    dry = preprocess(spark, sources=fixture_sources(spark, SMALL_SF), dry_run=True, max_per_source=500)
    assert all(r.n <= 100 for r in dry.sources.collect())


def test_validation_totals(spark):
    lines = X.fixture(spark, SMALL_SF, "fx_lines").select(
        F.col("shard").alias("file"), F.col("doc_id").alias("line_no"), "line")
    rep = validate_lines_report(lines)
    for r in rep.summary.collect():
        assert r.valid + r.invalid == r.total
    errs = rep.errors.groupBy("file").agg(F.count_if("shown").alias("shown")).collect()
    assert all(r.shown <= 3 for r in errs)
    assert rep.verdict.first().all_valid is False


def test_validation_parses_once_and_caches_nothing(spark):
    rows = [("f", i, line) for i, line in enumerate(['{"source": null, "input": "a", "output": "bb"}', '{"source": "s"}', '{"input": "abc", "output": "d", "source": "s"}', "[1]", "no", ""])]
    rep = validate_lines_report(spark.createDataFrame(rows, "file string, line_no int, line string"))
    assert {(r.field, r.value, r.n) for r in rep.histogram.collect()} == {("language", "unknown", 3), ("source", None, 1), ("source", "s", 2)}
    assert tuple(rep.stats.first()) == ("f", 2.0, 1.5, 1, 3)
    assert tuple(rep.summary.first())[:2] == ("f", 6)
    for df in (rep.summary, rep.errors, rep.stats, rep.histogram, rep.top_languages, rep.samples, rep.verdict):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "parse_json" not in plan.lower() and "InMemoryRelation" not in plan
    empty = validate_lines_report(spark.createDataFrame([], "file string, line_no int, line string"))
    assert empty.summary.count() == 0 and tuple(empty.verdict.first()) == (0, False)


def test_exact_dedup_moves_no_texts(spark):
    """One example per normalized content, the smallest key; only keys are shuffled."""
    from quarry.plans.documented import dedup_examples

    rows = [("i", "A  b", "x", "k3"), ("j", "a b", "X ", "k1"), ("j", "a b", "X ", "k1"), ("i", "c", None, "k2"), ("i", "c", None, "k2")]
    ex = spark.createDataFrame(rows, "instruction string, input string, output string, _ck string").repartition(3)
    got = dedup_examples(ex)
    assert sorted(map(tuple, got.collect()), key=str) == sorted([rows[1], rows[3]], key=str) and got.columns == ex.columns
    assert "Exchange hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()

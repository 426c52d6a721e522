"""Registered queries (Spark) and their DuckDB oracles.

Each query takes ``(spark, sf_dir)`` and reads the driver tables under
``sf_dir`` (directly or through fixtures derived from them by Spark).  Every
computed column carries the same alias in the Spark query and in its oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixtures as X
from . import oracle_sql as S
from .functions import constants as K
from .functions.quality import has_doc_marker, is_quality_doc
from .functions.text import clean_text, code_len, fence, preview, py_strip, row_key, seeded_key
from .operators import alpaca, joins
from .plans import preprocess as P
from .session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def fx(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return X.fixture(spark, sf_dir, name)


W = X.with_fixtures
EX5 = "instruction, input, output, source, language"


def fixture_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "codesearchnet": fx(spark, sf_dir, "fx_pairs"),
        "code_docstring_corpus": fx(spark, sf_dir, "fx_corpus"),
        "python_code_instructions": fx(spark, sf_dir, "fx_instr"),
        "the_stack_smol": fx(spark, sf_dir, "fx_files"),
    }


ALL_FX = ("fx_pairs", "fx_corpus", "fx_instr", "fx_files")

# ------------------------------------------------------------------ C: scalar functions


@query("py_strip", W("fx_pairs") + f"""
SELECT doc_id, {S.strip('code')} AS stripped, CAST(length({S.strip('code')}) AS BIGINT) AS stripped_len
FROM fx_pairs""")
def q_py_strip(spark, sf):
    d = fx(spark, sf, "fx_pairs")
    return d.select("doc_id", py_strip("code").alias("stripped"), code_len(py_strip("code")).alias("stripped_len"))


@query("clean_text", W("fx_pairs") + f"SELECT doc_id, {S.clean('docstring')} AS cleaned FROM fx_pairs")
def q_clean_text(spark, sf):
    return fx(spark, sf, "fx_pairs").select("doc_id", clean_text("docstring").alias("cleaned"))


@query("fence_code", W("fx_pairs") + f"""
SELECT doc_id, {S.fence('language', S.strip('code'))} AS input FROM fx_pairs WHERE {S.pair_ok('code', 'docstring')}""")
def q_fence_code(spark, sf):
    d = fx(spark, sf, "fx_pairs").filter(alpaca.pair_filter("code", "docstring"))
    return d.select("doc_id", fence("language", py_strip("code")).alias("input"))


@query("fence_with_decl", W("fx_corpus") + f"SELECT doc_id, {S.fence_decl('decl', 'bodies')} AS input FROM fx_corpus")
def q_fence_with_decl(spark, sf):
    return fx(spark, sf, "fx_corpus").select("doc_id", alpaca.fence_with_decl("decl", "bodies").alias("input"))


@query("truncate_fence", W("fx_files") + f"""
SELECT doc_id, {S.fence('language', S.strip('substring(content, 1, 2000)'))} AS input FROM fx_files""")
def q_truncate_fence(spark, sf):
    return fx(spark, sf, "fx_files").select("doc_id", alpaca.truncate_fence("language", "content").alias("input"))


@query("assign_instruction", W("fx_pairs") + f"""
SELECT doc_id,
  {S.template('function_doc', 'k')} AS function_doc,
  {S.template('readme_gen', 'k')} AS readme_gen,
  {S.template('code_explain', 'k')} AS code_explain
FROM (SELECT doc_id, {S.rowkey('doc_id')} AS k FROM fx_pairs)""")
def q_assign_instruction(spark, sf):
    d = fx(spark, sf, "fx_pairs").select("doc_id", row_key("doc_id").alias("k"))
    return d.select("doc_id", *[alpaca.template_for(t, K.DEFAULT_SEED, "k").alias(t)
                                for t in ["function_doc", "readme_gen", "code_explain"]])


@query("to_alpaca_pairs", W("fx_pairs") + f"SELECT {EX5} FROM ({S.ex_pairs()})")
def q_to_alpaca_pairs(spark, sf):
    return alpaca.pairs_to_examples(fx(spark, sf, "fx_pairs")).select(*alpaca.EXAMPLE_COLUMNS)


@query("to_alpaca_corpus", W("fx_pairs", "fx_corpus") + f"SELECT {EX5} FROM ({S.ex_corpus()})")
def q_to_alpaca_corpus(spark, sf):
    return alpaca.corpus_to_examples(fx(spark, sf, "fx_corpus")).select(*alpaca.EXAMPLE_COLUMNS)


@query("to_alpaca_instructions", W("fx_instr") + f"SELECT {EX5} FROM ({S.ex_instr()})")
def q_to_alpaca_instructions(spark, sf):
    return alpaca.instructions_to_examples(fx(spark, sf, "fx_instr")).select(*alpaca.EXAMPLE_COLUMNS)


@query("to_alpaca_files", W("fx_files") + f"SELECT {EX5} FROM ({S.ex_files()})")
def q_to_alpaca_files(spark, sf):
    return alpaca.files_to_examples(fx(spark, sf, "fx_files")).select(*alpaca.EXAMPLE_COLUMNS)


@query("to_alpaca_fixed", W("fx_pairs") + f"""
SELECT doc_id, {S.q(K.DOCUMENTED_PAIR_INSTRUCTION)} AS instruction, {S.fence("'python'", 'code')} AS input,
       docstring AS output FROM fx_pairs""")
def q_to_alpaca_fixed(spark, sf):
    d = fx(spark, sf, "fx_pairs").select("doc_id", F.col("code").alias("func_code_string"),
                                         F.col("docstring").alias("func_documentation_string"))
    return d.select("doc_id", *alpaca.documented_pair("func_code_string", "func_documentation_string"))


@query("prompt_single_file", W("fx_files") + """
SELECT doc_id, 'Language: ' || language || chr(10) || 'File: ' || path || chr(10) || chr(10) ||
  '```' || language || chr(10) || content || chr(10) || '```' AS prompt FROM fx_files""")
def q_prompt_single_file(spark, sf):
    d = fx(spark, sf, "fx_files")
    return d.select("doc_id", alpaca.prompt_single_file("language", "path", "content").alias("prompt"))


@query("preview_rows", W(*ALL_FX) + f"""
SELECT substring(instruction, 1, 60) || '...' AS instruction_preview,
       substring(input, 1, 100) || '...' AS input_preview,
       substring(output, 1, 100) || '...' AS output_preview
FROM ({S.ex_all()})""")
def q_preview_rows(spark, sf):
    ex = P.convert_sources(fixture_sources(spark, sf))
    return ex.select(preview("instruction", 60).alias("instruction_preview"),
                     preview("input", 100).alias("input_preview"),
                     preview("output", 100).alias("output_preview"))


# ------------------------------------------------------------------------ D: filters


@query("is_quality_doc", W("fx_pairs") + f"SELECT doc_id, {S.quality('docstring')} AS quality FROM fx_pairs")
def q_is_quality_doc(spark, sf):
    return fx(spark, sf, "fx_pairs").select("doc_id", is_quality_doc("docstring").alias("quality"))


@query("filter_pairs", W("fx_pairs") + f"""
SELECT doc_id, language FROM fx_pairs WHERE {S.pair_ok('code', 'docstring')}""")
def q_filter_pairs(spark, sf):
    return fx(spark, sf, "fx_pairs").filter(alpaca.pair_filter("code", "docstring")).select("doc_id", "language")


@query("filter_corpus", W("fx_corpus") + f"""SELECT doc_id FROM fx_corpus WHERE {S.pair_ok('bodies', '"desc"')}""")
def q_filter_corpus(spark, sf):
    return fx(spark, sf, "fx_corpus").filter(alpaca.pair_filter("bodies", "desc")).select("doc_id")


@query("filter_instructions", W("fx_instr") + f"""
SELECT pair_id FROM fx_instr WHERE {S.instr_ok('instruction', 'output')}""")
def q_filter_instructions(spark, sf):
    return fx(spark, sf, "fx_instr").filter(alpaca.instruction_filter("instruction", "output")).select("pair_id")


@query("filter_files", W("fx_files") + """
SELECT doc_id FROM fx_files WHERE coalesce(content IS NOT NULL AND length(content) >= 100, false)""")
def q_filter_files(spark, sf):
    return fx(spark, sf, "fx_files").filter(alpaca.file_filter("content")).select("doc_id")


@query("ingest_filter", W("fx_pairs") + f"""
SELECT doc_id FROM fx_pairs
WHERE coalesce(code IS NOT NULL AND code <> '' AND docstring IS NOT NULL AND docstring <> ''
               AND length({S.strip('docstring')}) > 10, false)""")
def q_ingest_filter(spark, sf):
    from .plans.ingest import ingest_pair_filter

    return fx(spark, sf, "fx_pairs").filter(ingest_pair_filter("code", "docstring")).select("doc_id")


@query("has_doc_marker", W("fx_files") + """
SELECT doc_id, coalesce(CASE
  WHEN language = 'python' THEN contains(content, '\"\"\"') OR contains(content, chr(39) || chr(39) || chr(39))
  WHEN language IN ('javascript', 'typescript') THEN contains(content, '/**') OR contains(content, '///')
  WHEN language IN ('java', 'go') THEN contains(content, '/**')
  ELSE contains(content, '/**') OR contains(content, '///') END, false) AS has_marker
FROM fx_files""".replace('\\"', '"'))
def q_has_doc_marker(spark, sf):
    return fx(spark, sf, "fx_files").select("doc_id", has_doc_marker("content", "language").alias("has_marker"))


# ------------------------------------------------------- A5: schema-fallback projection


@query("resolve_columns", W("fx_instr", "fx_instr_alt") + """
SELECT pair_id, prompt AS instruction, input, response AS output FROM fx_instr_alt""")
def q_resolve_columns(spark, sf):
    from .sources.files import _string_or_default

    d = fx(spark, sf, "fx_instr_alt")
    return d.select("pair_id",
                    _string_or_default(d, ["instruction", "prompt"]).alias("instruction"),
                    _string_or_default(d, ["input"]).alias("input"),
                    _string_or_default(d, ["output", "response"]).alias("output"))


# --------------------------------------------------------- I1 / G1 / H1 / F4 / F5 / B3


@query("union_sources", W(*ALL_FX) + f"SELECT {EX5} FROM ({S.ex_all()})")
def q_union_sources(spark, sf):
    return P.convert_sources(fixture_sources(spark, sf)).select(*alpaca.EXAMPLE_COLUMNS)


CAP_N = 50


@query("cap_per_source", W(*ALL_FX) + f"SELECT {EX5} FROM ({S.cap_sql(S.ex_all(), CAP_N)})")
def q_cap_per_source(spark, sf):
    ex = P.convert_sources(fixture_sources(spark, sf))
    return P.cap_sources(ex, CAP_N, K.DEFAULT_SEED).select(*alpaca.EXAMPLE_COLUMNS)


SPLIT_SQL = S.split_sql(S.ex_all())


@query("split_examples", W(*ALL_FX) + f"SELECT {EX5}, split FROM ({SPLIT_SQL})")
def q_split_examples(spark, sf):
    ex = P.convert_sources(fixture_sources(spark, sf))
    return P.split_examples(ex, 0.8, 0.1, K.DEFAULT_SEED).select(*alpaca.EXAMPLE_COLUMNS, "split")


@query("split_counts", W(*ALL_FX) + f"SELECT split, count(*) AS n FROM ({SPLIT_SQL}) GROUP BY split")
def q_split_counts(spark, sf):
    ex = P.convert_sources(fixture_sources(spark, sf))
    return P.split_counts(P.split_examples(ex, 0.8, 0.1, K.DEFAULT_SEED))


def _processors_sql() -> str:
    rows = ", ".join(f"({S.q(name)}, {S.q(tag)})" for name, tag in K.PROCESSORS)
    return f"(VALUES {rows}) AS p(name, source)"


@query("source_counts", W(*ALL_FX) + f"""
SELECT p.name, p.source, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM {_processors_sql()} LEFT JOIN (SELECT source, count(*) AS n FROM ({S.ex_all()}) GROUP BY source) c
  ON c.source = p.source""")
def q_source_counts(spark, sf):
    return P.source_counts(spark, P.convert_sources(fixture_sources(spark, sf)))


@query("run_metadata", W(*ALL_FX) + f"""
SELECT count(*) AS total_examples, count(*) FILTER (WHERE split = 'train') AS train,
       count(*) FILTER (WHERE split = 'val') AS val, count(*) FILTER (WHERE split = 'test') AS test,
       CAST(42 AS BIGINT) AS seed
FROM ({SPLIT_SQL})""")
def q_run_metadata(spark, sf):
    res = P.preprocess(spark, sources=fixture_sources(spark, sf))
    return res.metadata


@query("dry_run", W(*ALL_FX) + f"""
SELECT p.name, p.source, CAST(least(coalesce(c.n, 0), {K.DRY_RUN_LIMIT}) AS BIGINT) AS n
FROM {_processors_sql()} LEFT JOIN (SELECT source, count(*) AS n FROM ({S.ex_all()}) GROUP BY source) c
  ON c.source = p.source""")
def q_dry_run(spark, sf):
    res = P.preprocess(spark, sources=fixture_sources(spark, sf), dry_run=True)
    return res.sources


_SAMPLE_JSON = "'{' || " + " || ',' || ".join(f"""'"{c}":' || CAST(to_json({c}) AS VARCHAR)""" for c in alpaca.EXAMPLE_COLUMNS) + " || '}'"


@query("dry_run_sample", W(*ALL_FX) + f"""
SELECT CASE WHEN length(j) > {K.DRY_RUN_PREVIEW_CHARS} THEN substring(j, 1, {K.DRY_RUN_PREVIEW_CHARS}) || '...' ELSE j END AS sample
FROM (SELECT {_SAMPLE_JSON} AS j FROM ({S.cap_sql(S.ex_all(), K.DRY_RUN_LIMIT)}) ORDER BY {S.seeded(42, 'sample', 'ck')} LIMIT 1)""")
def q_dry_run_sample(spark, sf):
    """The sample entry of a dry run, shown in full up to 600 characters."""
    res = P.preprocess(spark, sources=fixture_sources(spark, sf), dry_run=True)
    return P.dry_run_sample(res.examples, K.DEFAULT_SEED)


HEAD_N = 100


@query("head_limit", W(*ALL_FX) + f"""
SELECT {EX5} FROM (SELECT *, row_number() OVER (ORDER BY {S.seeded(42, 'head', 'ck')}) AS rn
                   FROM ({S.ex_all()})) WHERE rn <= {HEAD_N}""")
def q_head_limit(spark, sf):
    from .operators.ranking import head_in_order

    ex = P.convert_sources(fixture_sources(spark, sf)).withColumn("_kh", seeded_key(42, "head", "_ck"))
    return head_in_order(ex, "_kh", HEAD_N).select(*alpaca.EXAMPLE_COLUMNS)


# ----------------------------------------------------------------- P3 from landed files


@query("preprocess_job", W(*ALL_FX) + f"SELECT {EX5}, split FROM ({SPLIT_SQL})")
def q_preprocess_job(spark, sf):
    from .landing import land_raw

    configure(spark)
    raw = land_raw(spark, sf)
    return P.preprocess(spark, raw_dir=raw).split


@query("scan_language_files", W("fx_pairs") + "SELECT language, code, docstring, repo, path FROM fx_pairs")
def q_scan_language_files(spark, sf):
    from .landing import land_raw
    from .sources.files import scan_language_files

    configure(spark)
    return scan_language_files(spark, land_raw(spark, sf) + "/codesearchnet")


@query("scan_corpus", W("fx_pairs", "fx_corpus") + 'SELECT "desc", decl, bodies FROM fx_corpus')
def q_scan_corpus(spark, sf):
    from .landing import land_raw
    from .sources.files import scan_corpus

    configure(spark)
    return scan_corpus(spark, land_raw(spark, sf) + "/code_docstring_corpus")




# ------------------------------------------------------------------ P4: validation


def _shard_named(lines):
    return lines.withColumn("file", F.regexp_extract("file", r"shard=([^/]+)$", 1))


def _numbered(spark, sf, of_lines):
    """``of_lines`` of the landed JSONL shards, numbered; ``file`` becomes the shard name.
    What it keeps of a line is written with the line's position, not the text."""
    from .landing import land_lines
    from .session import write_through
    from .sources.jsonl import number_lines, scan_positions

    configure(spark)
    lines = scan_positions(spark, land_lines(spark, sf), glob="*.txt", recursive=True, by_folder=True)
    return _shard_named(number_lines(write_through(of_lines(lines), "lines")))


def _validated(spark, sf, bounds=K.TRAINING_BOUNDS):
    """Verdict of each landed line: parsed, valid, error, n_errors."""
    from .operators import validate as V

    return _numbered(spark, sf, lambda lines: V.validate_lines(lines, bounds).select(
        "file", "at", "parsed", "valid", "error", F.size("errors").cast("bigint").alias("n_errors")))


def _line_facts(spark, sf):
    """What the reports need of each landed line (``line_facts``)."""
    from .operators import validate as V

    return _numbered(spark, sf, lambda lines: V.line_facts(V.validate_lines(lines)))


def _duck_numbered() -> str:
    return ("numbered AS (SELECT shard, doc_id, line, row_number() OVER (PARTITION BY shard ORDER BY doc_id) "
            "AS line_no FROM fx_lines)")


def _duck_checks(bounds) -> str:
    items = []
    for f in K.REQUIRED_FIELDS:
        items.append(f"CASE WHEN json_type(line, '$.{f}') IS NULL THEN '{f}:required' END")
    for f, (lo, hi) in bounds.items():
        t = f"json_type(line, '$.{f}')"
        n = f"length(json_extract_string(line, '$.{f}'))"
        items.append(f"CASE WHEN {t} IS NOT NULL AND {t} <> 'VARCHAR' THEN '{f}:type' END")
        items.append(f"CASE WHEN {t} = 'VARCHAR' AND {n} < {lo} THEN '{f}:minLength' END")
        items.append(f"CASE WHEN {t} = 'VARCHAR' AND {n} > {hi} THEN '{f}:maxLength' END")
    for f in K.OPTIONAL_STRING_FIELDS:
        t = f"json_type(line, '$.{f}')"
        items.append(f"CASE WHEN {t} IS NOT NULL AND {t} <> 'VARCHAR' THEN '{f}:type' END")
    return "list_filter([" + ", ".join(items) + "], lambda x: x IS NOT NULL)"


def _duck_validated(bounds=K.TRAINING_BOUNDS) -> str:
    return (W("fx_lines") + ", " + _duck_numbered() + f""",
parsed AS (SELECT *, coalesce(json_valid(line), false) AS parsed FROM numbered),
validated AS (SELECT *,
  CASE WHEN NOT parsed THEN ['json:parse'] WHEN json_type(line) <> 'OBJECT' THEN ['$:type']
       ELSE {_duck_checks(bounds)} END AS errors FROM parsed),
v AS (SELECT *, len(errors) = 0 AS valid, errors[1] AS error FROM validated)
""")


@query("scan_jsonl_strict", W("fx_lines") + ", " + _duck_numbered() +
       " SELECT shard, line_no, line FROM numbered")
def q_scan_jsonl_strict(spark, sf):
    from .landing import land_lines
    from .sources.jsonl import scan_lines

    configure(spark)
    lines = scan_lines(spark, land_lines(spark, sf), glob="*.txt", recursive=True, by_folder=True)
    return _shard_named(lines).select(F.col("file").alias("shard"), "line_no", "line")


@query("line_numbers", W("fx_lines") + ", " + _duck_numbered() +
       " SELECT shard, line_no, doc_id FROM numbered")
def q_line_numbers(spark, sf):
    """Line numbers recovered from the files, matched to the fixture's doc_id order."""
    from .operators.windows import row_numbers

    v = _numbered(spark, sf, lambda lines: lines.drop("line"))
    expected = row_numbers(fx(spark, sf, "fx_lines").select("shard", "doc_id"), "shard", "doc_id", width=1000)
    return v.select(F.col("file").alias("shard"), "line_no").join(expected, ["shard", "line_no"], "left")


@query("json_parse_check", _duck_validated() + "SELECT shard, line_no, parsed FROM v")
def q_json_parse_check(spark, sf):
    return _validated(spark, sf).select(F.col("file").alias("shard"), "line_no", "parsed")


@query("validate_entries", _duck_validated() +
       "SELECT shard, line_no, valid, error, CAST(len(errors) AS BIGINT) AS n_errors FROM v")
def q_validate_entries(spark, sf):
    return _validated(spark, sf).select(F.col("file").alias("shard"), "line_no", "valid", "error", "n_errors")


@query("validate_documented", _duck_validated(K.DOCUMENTED_BOUNDS) +
       "SELECT shard, line_no, valid, error, CAST(len(errors) AS BIGINT) AS n_errors FROM v")
def q_validate_documented(spark, sf):
    return _validated(spark, sf, K.DOCUMENTED_BOUNDS).select(
        F.col("file").alias("shard"), "line_no", "valid", "error", "n_errors")


@query("validation_summary", _duck_validated() + """
SELECT shard, count(*) AS total, count(*) FILTER (WHERE valid) AS valid, count(*) FILTER (WHERE NOT valid) AS invalid
FROM v GROUP BY shard""")
def q_validation_summary(spark, sf):
    from .operators import validate as V

    return V.summary(_validated(spark, sf)).withColumnRenamed("file", "shard")


@query("error_sample", _duck_validated() + """
SELECT shard, line_no, error, coalesce(rk <= 3, false) AS shown FROM (
  SELECT shard, line_no, error, parsed, row_number() OVER (PARTITION BY shard ORDER BY line_no) AS rk
  FROM v WHERE NOT valid) WHERE rk <= 10 OR NOT parsed""")
def q_error_sample(spark, sf):
    from .operators import validate as V

    return V.error_sample(_validated(spark, sf)).withColumnRenamed("file", "shard")


@query("length_stats", _duck_validated() + """
SELECT shard, avg(li) AS avg_input_length, avg(lo) AS avg_output_length,
       CAST(min(li) AS BIGINT) AS min_input_length, CAST(max(li) AS BIGINT) AS max_input_length
FROM (SELECT shard,
        CASE WHEN json_type(line, '$.input') = 'VARCHAR' THEN length(json_extract_string(line, '$.input')) END AS li,
        CASE WHEN json_type(line, '$.output') = 'VARCHAR' THEN length(json_extract_string(line, '$.output')) END AS lo
      FROM v WHERE parsed)
WHERE li IS NOT NULL AND lo IS NOT NULL GROUP BY shard""")
def q_length_stats(spark, sf):
    from .operators import validate as V

    return V.length_stats(_line_facts(spark, sf)).withColumnRenamed("file", "shard")


_DUCK_HIST = """
hist AS (
  SELECT shard, 'source' AS field,
         CASE WHEN json_type(line, '$.source') IS NULL THEN 'unknown' ELSE json_extract_string(line, '$.source') END
           AS value, count(*) AS n
  FROM v WHERE parsed AND json_type(line) = 'OBJECT' GROUP BY ALL
  UNION ALL
  SELECT shard, 'language' AS field,
         CASE WHEN json_type(line, '$.language') IS NULL THEN 'unknown'
              ELSE json_extract_string(line, '$.language') END AS value, count(*) AS n
  FROM v WHERE parsed AND json_type(line) = 'OBJECT' GROUP BY ALL)
"""


@query("source_language_hist", _duck_validated() + ", " + _DUCK_HIST + "SELECT shard, field, value, n FROM hist")
def q_source_language_hist(spark, sf):
    from .operators import validate as V

    return V.histogram(_line_facts(spark, sf)).withColumnRenamed("file", "shard")


@query("top_languages", _duck_validated() + ", " + _DUCK_HIST + """
SELECT shard, language, n, rank FROM (
  SELECT shard, value AS language, n,
         CAST(row_number() OVER (PARTITION BY shard ORDER BY n DESC, value ASC NULLS FIRST) AS INTEGER) AS rank
  FROM hist WHERE field = 'language') WHERE rank <= 5""")
def q_top_languages(spark, sf):
    from .operators import validate as V

    return V.top_languages(V.histogram(_line_facts(spark, sf))).withColumnRenamed("file", "shard")


@query("sample_n", _duck_validated() + """
SELECT shard, line_no,
  CASE WHEN json_type(line, '$.instruction') = 'VARCHAR'
       THEN substring(json_extract_string(line, '$.instruction'), 1, 60) || '...' END AS instruction_preview,
  CASE WHEN json_type(line, '$.input') = 'VARCHAR'
       THEN substring(json_extract_string(line, '$.input'), 1, 100) || '...' END AS input_preview,
  CASE WHEN json_type(line, '$.output') = 'VARCHAR'
       THEN substring(json_extract_string(line, '$.output'), 1, 100) || '...' END AS output_preview
FROM (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY md5('42:' || shard || ':' || CAST(line_no AS VARCHAR)))
        AS rk FROM v WHERE parsed AND json_type(line) = 'OBJECT') WHERE rk <= 5""")
def q_sample_n(spark, sf):
    from .operators import validate as V

    return V.sample_entries(_line_facts(spark, sf), 5).withColumnRenamed("file", "shard")


@query("all_valid", _duck_validated() + """
SELECT CAST(count(*) AS BIGINT) AS n_files, coalesce(bool_and(invalid = 0), false) AND count(*) > 0 AS all_valid
FROM (SELECT shard, count(*) FILTER (WHERE NOT valid) AS invalid FROM v GROUP BY shard)""")
def q_all_valid(spark, sf):
    from .operators import validate as V

    return V.verdict(V.summary(_validated(spark, sf)))


def _duck_reports() -> str:
    """All reports of the validation job as (report, shard, key, n, value) rows."""
    lengths = ("avg_input_length", "avg_output_length", "min_input_length", "max_input_length")
    parts = [f"SELECT 'lines' AS report, shard, '{c}' AS key, CAST({c} AS BIGINT) AS n, CAST(NULL AS DOUBLE) AS value "
             f"FROM ({ORACLES['validation_summary']})" for c in ("total", "valid", "invalid")]
    parts += [f"SELECT 'length', shard, '{c}', NULL, CAST({c} AS DOUBLE) FROM ({ORACLES['length_stats']})" for c in lengths]
    parts += [
        f"SELECT field, shard, value, CAST(n AS BIGINT), NULL FROM ({ORACLES['source_language_hist']})",
        f"SELECT 'top_language', shard, language, CAST(rank AS BIGINT), NULL FROM ({ORACLES['top_languages']})",
        f"SELECT 'error', shard, error, CAST(line_no AS BIGINT), CAST(shown AS DOUBLE) FROM ({ORACLES['error_sample']})",
        f"SELECT 'sample', shard, input_preview, CAST(line_no AS BIGINT), NULL FROM ({ORACLES['sample_n']})",
        f"SELECT 'verdict', NULL, 'all_valid', n_files, CAST(all_valid AS DOUBLE) FROM ({ORACLES['all_valid']})",
    ]
    return " UNION ALL ".join(parts)


@query("validate_job", _duck_reports())
def q_validate_job(spark, sf):
    """The whole validation job: counts, lengths, histograms, errors, samples, verdict,
    from lines that are scanned and parsed once."""
    from .landing import land_lines
    from .plans.validate import validate_lines_report
    from .sources.jsonl import scan_positions

    configure(spark)
    lines = scan_positions(spark, land_lines(spark, sf), glob="*.txt", recursive=True, by_folder=True)
    rep = validate_lines_report(lines.withColumn("file", F.regexp_extract("file", r"shard=([^/]+)$", 1)))

    def rows(df, report, key, n=None, value=None, shard=F.col("file")):
        return df.select((F.lit(report) if isinstance(report, str) else report).alias("report"), shard.alias("shard"),
                         key.cast("string").alias("key"), (F.lit(None) if n is None else n).cast("bigint").alias("n"),
                         (F.lit(None) if value is None else value).cast("double").alias("value"))

    parts = [rows(rep.summary, "lines", F.lit(c), F.col(c)) for c in ("total", "valid", "invalid")]
    parts += [rows(rep.stats, "length", F.lit(c), value=F.col(c))
              for c in ("avg_input_length", "avg_output_length", "min_input_length", "max_input_length")]
    parts += [
        rows(rep.histogram, F.col("field"), F.col("value"), F.col("n")),
        rows(rep.top_languages, "top_language", F.col("language"), F.col("rank")),
        rows(rep.errors, "error", F.col("error"), F.col("line_no"), F.col("shown").cast("int")),
        rows(rep.samples, "sample", F.col("input_preview"), F.col("line_no")),
        rows(rep.verdict, "verdict", F.lit("all_valid"), F.col("n_files"), F.col("all_valid").cast("int"),
             shard=F.lit(None).cast("string")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ------------------------------------------------------------- P2 / P5: READMEs


def _readme_result(spark, sf, limit=None):
    """Curated READMEs of all selected repositories, or of the top ``limit``."""
    from .plans.readmes import curate_readmes

    return curate_readmes(fx(spark, sf, "fx_repos"), fx(spark, sf, "fx_readmes"), fx(spark, sf, "fx_trees"),
                          limit=limit, with_timestamp=False)


REPO_FX = ("fx_repos", "fx_readme_text", "fx_readmes", "fx_trees")


@query("decode_readme", W("fx_repos", "fx_readme_text", "fx_readmes") +
       f"SELECT doc_id, {S.decode_b64('content')} AS readme FROM fx_readmes")
def q_decode_readme(spark, sf):
    from .operators.repos import decode_base64_text

    return fx(spark, sf, "fx_readmes").select("doc_id", decode_base64_text("content").alias("readme"))


@query("file_tree_depth", W("fx_trees") + f"""
SELECT doc_id, CAST(len({S.tree_kept('tree')}) AS BIGINT) AS n_items, {S.tree_text(S.tree_kept('tree'))} AS tree_text
FROM fx_trees""")
def q_file_tree_depth(spark, sf):
    from .operators.repos import tree_text, tree_within_depth

    t = tree_within_depth("tree")
    return fx(spark, sf, "fx_trees").select(
        "doc_id", F.when(F.col("tree").isNotNull(), F.size(t)).cast("bigint").alias("n_items"),
        tree_text(t).alias("tree_text"))


@query("key_files", W("fx_trees") + f"""
SELECT doc_id, array_to_string(list_sort({S.key_paths('tree')}), '|') AS key_files FROM fx_trees""")
def q_key_files(spark, sf):
    from .operators.repos import key_files

    return fx(spark, sf, "fx_trees").select("doc_id", F.array_join(F.array_sort(key_files("tree")), "|")
                                            .alias("key_files"))


@query("readme_features", W("fx_readme_text") + f"""
SELECT doc_id, {S.sections('readme')} AS sections, contains(readme, '```') AS has_code FROM fx_readme_text""")
def q_readme_features(spark, sf):
    from .operators.repos import readme_features

    return fx(spark, sf, "fx_readme_text").select("doc_id", *readme_features("readme"))


@query("filter_readme", W("fx_readme_text") + f"SELECT doc_id FROM fx_readme_text WHERE {S.readme_ok('readme')}")
def q_filter_readme(spark, sf):
    from .functions.quality import readme_passes

    return fx(spark, sf, "fx_readme_text").filter(readme_passes("readme")).select("doc_id")


@query("select_repos", W("fx_repos") + f"SELECT doc_id, owner, name FROM fx_repos WHERE {S.select_repos_where()}")
def q_select_repos(spark, sf):
    from .operators.repos import select_repos

    return select_repos(fx(spark, sf, "fx_repos")).select("doc_id", "owner", "name")


@query("topk_repos", W("fx_repos") + f"SELECT language, owner, name, stars FROM ({S.top_repos_sql()})")
def q_topk_repos(spark, sf):
    return _readme_result(spark, sf, K.SCRAPE_LIMIT).selected.select("language", "owner", "name", "stars")


@query("join_repo_payloads", W(*REPO_FX) + """
SELECT r.owner, r.name, m.content, CAST(len(t.tree) AS BIGINT) AS tree_items
FROM fx_repos r JOIN fx_readmes m ON m.owner = r.owner AND m.name = r.name
LEFT JOIN fx_trees t ON t.owner = r.owner AND t.name = r.name""")
def q_join_repo_payloads(spark, sf):
    from .operators.repos import join_payloads

    j = join_payloads(fx(spark, sf, "fx_repos"), fx(spark, sf, "fx_readmes"), fx(spark, sf, "fx_trees"))
    return j.select("owner", "name", F.col("readme_b64").alias("content"),
                    F.when(F.col("tree").isNotNull(), F.size("tree")).cast("bigint").alias("tree_items"))


@query("compose_repo_record", W(*REPO_FX) + f"""
SELECT repo_name, url, stars, language, description, readme, {S.tree_text('file_tree')} AS tree_text, status
FROM ({S.records_sql(None)})""")
def q_compose_repo_record(spark, sf):
    from .operators.repos import tree_text

    r = _readme_result(spark, sf).records
    return r.select("repo_name", "url", "stars", "language", "description", "readme",
                    tree_text("file_tree").alias("tree_text"), "status")


@query("readme_funnel", W(*REPO_FX) + f"""
SELECT count(*) AS found, count(*) FILTER (WHERE status = 'scraped') AS scraped,
       count(*) FILTER (WHERE status = 'failed') AS failed, count(*) FILTER (WHERE status = 'filtered') AS filtered
FROM ({S.records_sql()})""")
def q_readme_funnel(spark, sf):
    return _readme_result(spark, sf, K.SCRAPE_LIMIT).funnel


@query("readmes_job", W(*REPO_FX) + f"""
SELECT repo_name, url, stars, language, description, readme, {S.tree_text('file_tree')} AS tree_text
FROM ({S.records_sql()}) WHERE status = 'scraped'""")
def q_readmes_job(spark, sf):
    """README curation from landed JSON payloads."""
    from .landing import land_payloads
    from .operators.repos import tree_text
    from .plans.readmes import curate_readmes
    from .sources import repos as RS

    configure(spark)
    root = land_payloads(spark, sf)
    res = curate_readmes(RS.read_hits(spark, f"{root}/hits"), RS.read_readmes(spark, f"{root}/readmes"),
                         RS.read_trees(spark, f"{root}/trees"), with_timestamp=False)
    s = res.scraped
    return s.select("repo_name", "url", "stars", "language", "description", "readme",
                    tree_text("file_tree").alias("tree_text"))


def _scraped_sql() -> str:
    """Scraped records with the key files that their prompts show."""
    records = f"SELECT * FROM ({S.records_sql(None)}) WHERE status = 'scraped'"
    return f"SELECT r.*, k.shown FROM ({records}) r LEFT JOIN ({S.key_file_rows(records)}) k ON k.repo_name = r.repo_name"


def _contents(spark, sf):
    from .landing import land_contents
    from .sources.repos import read_contents

    return read_contents(spark, land_contents(spark, sf))


@query("prompt_repo_context", W(*REPO_FX, "fx_contents") + f"""
SELECT repo_name, {S.repo_prompt('repo_name', 'file_tree', 'shown')} AS prompt FROM ({_scraped_sql()})""")
def q_prompt_repo_context(spark, sf):
    """Repository prompts with the contents of key files."""
    from .operators.repos import repo_context_prompt, with_key_files

    s = with_key_files(_readme_result(spark, sf).scraped, _contents(spark, sf))
    return s.select("repo_name", repo_context_prompt("repo_name", "file_tree", "key_files").alias("prompt"))


def _readme_examples_sql() -> str:
    return f"""
SELECT {S.template('readme_gen', 'ck')} AS instruction, input, output, source, language FROM (
  SELECT *, {S.rowkey('source', 'language', "''", 'input', 'output')} AS ck FROM (
    SELECT {S.repo_prompt('repo_name', 'file_tree', 'shown')} AS input, readme AS output, 'github_readme' AS source, language
    FROM ({_scraped_sql()})))"""


@query("readme_examples_job", W(*REPO_FX, "fx_contents") + _readme_examples_sql())
def q_readme_examples_job(spark, sf):
    from .plans.readmes import readme_examples

    return readme_examples(_readme_result(spark, sf).scraped, _contents(spark, sf)).select(*alpaca.EXAMPLE_COLUMNS)


# ------------------------------------------------------------------ P1: ingest

PAIR5 = "code, docstring, language, repo, path"
CAP_MAX = 300  # of cap_per_language: 50 per language over 6 languages; the jobs are uncapped


def _shard_pairs(spark, sf):
    from .landing import land_shards
    from .sources.jsonl import scan_jsonl_pairs

    configure(spark)
    root = land_shards(spark, sf)
    lang = F.regexp_extract(F.col("file"), r"language=([^/]+)/", 1)
    return scan_jsonl_pairs(spark, root, language=lang, suffix=".txt.gz")


_DUCK_SHARD_PAIRS = f"""
shard_pairs AS (
  SELECT coalesce(code, '') AS code, coalesce(docstring, '') AS docstring, language,
         coalesce(repo, '') AS repo, coalesce(path, '') AS path
  FROM fx_pairs WHERE shard = 'train' AND NOT broken_line),
ingested AS (
  SELECT {PAIR5} FROM shard_pairs
  WHERE code <> '' AND docstring <> '' AND length({S.strip('docstring')}) > 10),
capped AS (
  SELECT {PAIR5} FROM (
    SELECT *, row_number() OVER (PARTITION BY language ORDER BY
             {S.seeded(42, 'cap', S.rowkey('code', 'docstring', 'language', 'repo', 'path'))}) AS rk
    FROM ingested)
  WHERE rk <= {CAP_MAX // 6})
"""


@query("scan_jsonl_pairs", W("fx_pairs") + ", " + _DUCK_SHARD_PAIRS + f"SELECT {PAIR5} FROM shard_pairs")
def q_scan_jsonl_pairs(spark, sf):
    return _shard_pairs(spark, sf)


@query("ingest_job", W("fx_pairs") + ", " + _DUCK_SHARD_PAIRS + f"SELECT {PAIR5} FROM ingested")
def q_ingest_job(spark, sf):
    from .plans.ingest import ingest_job

    return ingest_job(spark, _shard_pairs(spark, sf)).pairs


_DUCK_DOCUMENTED = """coalesce(CASE
    WHEN language = 'python' THEN contains(content, repeat(chr(34), 3))
                                  OR contains(content, repeat(chr(39), 3))
    WHEN language IN ('javascript', 'typescript') THEN contains(content, '/**') OR contains(content, '///')
    WHEN language IN ('java', 'go') THEN contains(content, '/**')
    ELSE contains(content, '/**') OR contains(content, '///') END, false)"""


@query("ingest_run", W("fx_pairs", "fx_files") + ", " + _DUCK_SHARD_PAIRS + f"""
, documented AS (SELECT content, language, path FROM fx_files WHERE {_DUCK_DOCUMENTED})
SELECT 'pairs' AS part, language AS key, count(*) AS n FROM ingested GROUP BY ROLLUP (language)
UNION ALL SELECT 'files', language, count(*) FROM documented GROUP BY ROLLUP (language)
UNION ALL SELECT 'rows', 'pairs', count(*) FROM ingested UNION ALL SELECT 'rows', 'files', count(*) FROM documented
UNION ALL SELECT 'gate', 'all_valid', CAST(1 AS BIGINT) UNION ALL SELECT 'read again', 'all', CAST(0 AS BIGINT)""")
def q_ingest_run(spark, sf):
    """The ingest job over landed shards and whole files: rows by language, rows of the
    written datasets, the gate, and the files that a second run reads (none)."""
    import uuid

    from .landing import land_raw, land_shards
    from .plans.ingest import ingest_landed
    from .session import scratch_dir

    configure(spark)
    out = f"{scratch_dir(spark)}/quarry-ingest-{uuid.uuid4().hex}"
    lang = F.regexp_extract(F.col("file"), r"language=([^/]+)/", 1)
    run = lambda: ingest_landed(spark, out, land_shards(spark, sf), land_raw(spark, sf) + "/the_stack_smol", suffix=".txt.gz", language=lang)
    run()
    again = run()
    row = lambda df, part, key, n: df.select((F.lit(part) if isinstance(part, str) else part).alias("part"), key.alias("key"), n.cast("bigint").alias("n"))
    parts = [
        row(again.stats, F.col("kind"), F.col("language"), F.col("n")), row(again.inventory, "rows", F.col("dataset"), F.col("n_rows")),
        row(again.gate, "gate", F.lit("all_valid"), F.col("all_valid").cast("int")),
        row(again.read.agg(F.count(F.lit(1)).alias("n")), "read again", F.lit("all"), F.col("n")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("cap_per_language", W("fx_pairs") + ", " + _DUCK_SHARD_PAIRS +
       f"SELECT {PAIR5} FROM capped")
def q_cap_per_language(spark, sf):
    from .plans.ingest import ingest_pairs

    return ingest_pairs(_shard_pairs(spark, sf), max_examples=CAP_MAX)


@query("ingest_stats", W("fx_pairs") + ", " + _DUCK_SHARD_PAIRS +
       "SELECT language, count(*) AS n FROM ingested GROUP BY ROLLUP (language)")
def q_ingest_stats(spark, sf):
    from .plans.ingest import ingest_job

    return ingest_job(spark, _shard_pairs(spark, sf)).stats


@query("sink_parquet_roundtrip", W("fx_pairs") + ", " + _DUCK_SHARD_PAIRS + f"SELECT {PAIR5} FROM ingested")
def q_sink_parquet_roundtrip(spark, sf):
    from .landing import landed_dir
    from .plans.ingest import ingest_job

    out = landed_dir(spark, sf, "out/ingest_parquet")
    ingest_job(spark, _shard_pairs(spark, sf), out_dir=out)
    return spark.read.parquet(out).select("code", "docstring", "language", "repo", "path")


@query("scan_documented_files", W("fx_files") + f"""
SELECT content, language, path FROM fx_files WHERE coalesce(CASE
    WHEN language = 'python' THEN contains(content, repeat(chr(34), 3))
                                  OR contains(content, repeat(chr(39), 3))
    WHEN language IN ('javascript', 'typescript') THEN contains(content, '/**') OR contains(content, '///')
    WHEN language IN ('java', 'go') THEN contains(content, '/**')
    ELSE contains(content, '/**') OR contains(content, '///') END, false)""")
def q_scan_documented_files(spark, sf):
    from .landing import land_raw
    from .plans.ingest import ingest_files
    from .sources.files import scan_whole_files

    configure(spark)
    files = scan_whole_files(spark, land_raw(spark, sf) + "/the_stack_smol")
    return ingest_files(files)


@query("scan_tolerant", W("fx_pairs") + """
SELECT language AS entry, false AS skipped, count(*) AS n FROM fx_pairs GROUP BY language
UNION ALL SELECT 'broken', true, CAST(0 AS BIGINT)""")
def q_scan_tolerant(spark, sf):
    """Rows of each readable entry, and the entries that were left out."""
    from .landing import land_raw
    from .sources.files import scan_language_files, skipped_entries

    configure(spark)
    folder = land_raw(spark, sf) + "/codesearchnet"
    read = scan_language_files(spark, folder).groupBy(F.col("language").alias("entry")).agg(F.count(F.lit(1)).alias("n"))
    left = skipped_entries(spark, folder).select("entry", F.lit(True).alias("skipped"), F.lit(0).cast("long").alias("n"))
    return read.select("entry", F.lit(False).alias("skipped"), "n").unionByName(left)


INVENTORY_SETS = ["codesearchnet", "code_docstring_corpus", "python_code_instructions", "the_stack_smol", "thevault"]


def _duck_inventory() -> str:
    return W("fx_pairs", "fx_corpus", "fx_instr", "fx_files") + """,
inv AS (
  SELECT 'codesearchnet' AS dataset, 7 AS n_files, (SELECT count(*) FROM fx_pairs) AS n_rows
  UNION ALL SELECT 'code_docstring_corpus', 1, (SELECT count(*) FROM fx_corpus)
  UNION ALL SELECT 'python_code_instructions', 1, (SELECT count(*) FROM fx_instr)
  UNION ALL SELECT 'the_stack_smol', """ + str(len(X.FILE_LANGS)) + """, (SELECT count(*) FROM fx_files)
  UNION ALL SELECT 'thevault', 0, CAST(0 AS BIGINT))
"""


@query("file_inventory", _duck_inventory() + "SELECT dataset, CAST(n_files AS BIGINT) AS n_files, CAST(n_rows AS BIGINT) AS n_rows FROM inv")
def q_file_inventory(spark, sf):
    from .landing import land_raw
    from .plans.ingest import verify

    configure(spark)
    inv, _ = verify(spark, land_raw(spark, sf), INVENTORY_SETS)
    return inv


@query("download_gate", _duck_inventory() +
       """SELECT CASE WHEN g THEN 'present' ELSE 'all' END AS datasets, bool_and(n_files > 0) AS all_valid,
  CAST(sum(n_files) AS BIGINT) AS total_files, CAST(sum(n_rows) AS BIGINT) AS total_rows
FROM inv, (VALUES (true), (false)) v(g) WHERE NOT g OR dataset <> 'thevault' GROUP BY g""")
def q_download_gate(spark, sf):
    """The gate over all expected data sets (one is absent) and over those present."""
    from .landing import land_raw
    from .plans.ingest import verify

    configure(spark)
    root = land_raw(spark, sf)
    out = [verify(spark, root, sets)[1].select(F.lit(name).alias("datasets"), "all_valid", "total_files", "total_rows")
           for name, sets in (("all", INVENTORY_SETS), ("present", INVENTORY_SETS[:-1]))]
    return out[0].unionByName(out[1])


# ------------------------------------------------------------------ B: sinks


@query("sink_jsonl_roundtrip", W(*ALL_FX) + f"SELECT {EX5}, split FROM ({SPLIT_SQL})")
def q_sink_jsonl_roundtrip(spark, sf):
    from .landing import landed_dir
    from .sources.sinks import write_examples

    ex = P.convert_sources(fixture_sources(spark, sf))
    out = landed_dir(spark, sf, "out/examples_jsonl")
    write_examples(P.split_examples(ex, 0.8, 0.1, K.DEFAULT_SEED).drop("_ck"), out)
    schema = "instruction string, input string, output string, source string, language string"
    return spark.read.schema(schema).json(out).select(*alpaca.EXAMPLE_COLUMNS, "split")


@query("sink_versioned", W(*ALL_FX) + f"SELECT source, split, count(*) AS n FROM ({SPLIT_SQL}) GROUP BY ALL")
def q_sink_versioned(spark, sf):
    from .landing import landed_dir
    from .sources.sinks import write_versioned

    ex = P.convert_sources(fixture_sources(spark, sf))
    root = landed_dir(spark, sf, "out/versioned")
    write_versioned(P.split_examples(ex, 0.8, 0.1, K.DEFAULT_SEED).drop("_ck"), root, 1)
    back = spark.read.schema("instruction string, input string, output string").json(f"{root}/v1")
    return back.groupBy("source", "split").agg(F.count(F.lit(1)).alias("n"))


@query("metadata_roundtrip", W(*ALL_FX) + f"""
SELECT count(*) AS total_examples, count(*) FILTER (WHERE split = 'train') AS train,
       count(*) FILTER (WHERE split = 'val') AS val, count(*) FILTER (WHERE split = 'test') AS test,
       count(*) FILTER (WHERE source = 'codesearchnet') AS codesearchnet,
       count(*) FILTER (WHERE source = 'the_stack_smol') AS the_stack_smol,
       CAST(42 AS BIGINT) AS seed
FROM ({SPLIT_SQL})""")
def q_metadata_roundtrip(spark, sf):
    from .landing import landed_dir

    out = landed_dir(spark, sf, "out/run")
    P.preprocess(spark, sources=fixture_sources(spark, sf), out_dir=out)
    m = spark.read.json(f"{out}/metadata")
    return m.select(
        F.col("total_examples").cast("bigint").alias("total_examples"),
        F.col("splits.train").cast("bigint").alias("train"), F.col("splits.val").cast("bigint").alias("val"),
        F.col("splits.test").cast("bigint").alias("test"),
        F.col("sources").getField("CodeSearchNet").cast("bigint").alias("codesearchnet"),
        F.col("sources").getField("The Stack Smol").cast("bigint").alias("the_stack_smol"),
        F.col("seed").cast("bigint").alias("seed"))


# ------------------------------------------------------------------ spec tier


def docs(spark, sf):
    configure(spark)
    return X.base_table(spark, sf, "documents")


@query("token_count", f"SELECT doc_id, {S.token_count('text')} AS tokens FROM documents")
def q_token_count(spark, sf):
    from .functions.text import token_count

    return docs(spark, sf).select("doc_id", token_count("text").alias("tokens"))


@query("non_ascii_ratio", f"SELECT doc_id, {S.non_ascii('text')} AS non_ascii_ratio FROM documents")
def q_non_ascii_ratio(spark, sf):
    from .functions.text import non_ascii_ratio

    return docs(spark, sf).select("doc_id", non_ascii_ratio("text").alias("non_ascii_ratio"))


def _filler_sql(x: str) -> str:
    s = S.strip(x)
    return "(" + " OR ".join(f"left({s}, {len(p)}) = {S.q(p)}" for p in K.FILLER_OPENINGS) + ")"


@query("style_flags", W("fx_readme_text") + f"""
SELECT doc_id, coalesce({_filler_sql('readme')}, false) AS filler_opening,
  coalesce(regexp_matches(readme, '(?m)^[ \\t]*(?:[-*]|[0-9]+\\.)[ \\t]'), false) AS has_bullets,
  contains(readme, '```') AS has_code_example,
  coalesce(length({S.strip("split_part(readme, chr(10), 1)")}) BETWEEN 1 AND 120, false) AS short_first_line
FROM fx_readme_text""")
def q_style_flags(spark, sf):
    from .functions.quality import filler_opening_flag, has_bullets, has_code_fence, short_first_line

    d = fx(spark, sf, "fx_readme_text")
    return d.select("doc_id", F.coalesce(filler_opening_flag("readme"), F.lit(False)).alias("filler_opening"),
                    has_bullets("readme").alias("has_bullets"), has_code_fence("readme").alias("has_code_example"),
                    short_first_line("readme").alias("short_first_line"))


@query("detect_license", f"""
SELECT doc_id, license, {S.license_family('license')} AS family
FROM (SELECT doc_id, {S.license_name('text')} AS license FROM documents)""")
def q_detect_license(spark, sf):
    from .functions.quality import license_family, license_name

    d = docs(spark, sf).select("doc_id", license_name("text").alias("license"))
    return d.withColumn("family", license_family("license"))


@query("filter_license", f"""
SELECT doc_id FROM documents WHERE {S.license_family(S.license_name('text'))} = 'permissive'""")
def q_filter_license(spark, sf):
    from .operators.filters import permissive_only

    return permissive_only(docs(spark, sf), "text").select("doc_id")


@query("license_audit", f"""
SELECT source, license, count(*) AS n, {S.license_family('license')} AS family
FROM (SELECT source, {S.license_name('text')} AS license FROM documents) GROUP BY source, license""")
def q_license_audit(spark, sf):
    from .operators.stats import license_audit

    return license_audit(docs(spark, sf)).select("source", "license", "n", "family")


@query("filter_token_length", W(*ALL_FX) + f"""
SELECT {EX5} FROM ({S.ex_all()}) WHERE {S.tokens_ok('input', 'output')}""")
def q_filter_token_length(spark, sf):
    from .operators.filters import token_length_ok

    ex = P.convert_sources(fixture_sources(spark, sf))
    return ex.filter(token_length_ok("input", "output")).select(*alpaca.EXAMPLE_COLUMNS)


@query("boilerplate_ratio", S.boilerplate_sql("documents", "doc_id", "text"))
def q_boilerplate_ratio(spark, sf):
    from .operators.dedup import boilerplate_ratio

    return boilerplate_ratio(docs(spark, sf), "doc_id", "text")


@query("quality_heuristics", f"""
SELECT b.doc_id, {S.reason('d.text', 'b.boilerplate_ratio')} AS reason
FROM ({S.boilerplate_sql("documents", "doc_id", "text")}) b JOIN documents d ON d.doc_id = b.doc_id""")
def q_quality_heuristics(spark, sf):
    from .operators.dedup import boilerplate_ratio
    from .operators.filters import rejection_reason

    d = docs(spark, sf)
    b = boilerplate_ratio(d, "doc_id", "text")
    return d.join(b, "doc_id").select("doc_id", rejection_reason("text", "boilerplate_ratio").alias("reason"))


@query("detect_language", f"SELECT doc_id, lang, {S.detect_language('text')} AS predicted FROM documents")
def q_detect_language(spark, sf):
    from .functions.quality import detect_language

    return docs(spark, sf).select("doc_id", "lang", detect_language("text").alias("predicted"))


@query("filter_english", f"SELECT doc_id FROM documents WHERE {S.detect_language('text')} = 'en'")
def q_filter_english(spark, sf):
    from .operators.filters import english_only

    return english_only(docs(spark, sf), "text").select("doc_id")


@query("filter_readme_strict", W("fx_readme_text") + f"""
SELECT doc_id FROM fx_readme_text
WHERE coalesce(length(readme) > {K.README_MIN_CHARS} AND {S.readme_ok('readme', 3)}
               AND {S.detect_language('readme')} = 'en', false)""")
def q_filter_readme_strict(spark, sf):
    from .operators.filters import readme_strict_ok

    return fx(spark, sf, "fx_readme_text").filter(readme_strict_ok("readme")).select("doc_id")


@query("generated_readmes", W("fx_readme_forms") + S.generated_sql("fx_readme_forms", "doc_id", "readme"))
def q_generated_readmes(spark, sf):
    """READMEs whose skeleton of headings and line shapes recurs over the corpus."""
    from .operators.filters import generated_readmes

    return generated_readmes(fx(spark, sf, "fx_readme_forms"), "doc_id", "readme")


@query("filter_readme_authored", W("fx_readme_forms") + f"""
SELECT doc_id FROM fx_readme_forms
WHERE coalesce(length(readme) > {K.README_MIN_CHARS} AND {S.readme_ok('readme', 3)} AND {S.detect_language('readme')} = 'en', false)
  AND doc_id NOT IN (SELECT doc_id FROM ({S.generated_sql("fx_readme_forms", "doc_id", "readme")}) WHERE generated)""")
def q_filter_readme_authored(spark, sf):
    """The documented README criteria, generated READMEs left out."""
    from .operators.filters import authored_readmes

    return authored_readmes(fx(spark, sf, "fx_readme_forms"), "doc_id", "readme").select("doc_id")


@query("dedup_exact", f"""
SELECT doc_id, lang FROM documents
WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY md5({S.normalized('text')}))""")
def q_dedup_exact(spark, sf):
    from .operators.dedup import dedup_exact

    return dedup_exact(docs(spark, sf), "doc_id", "text").select("doc_id", "lang")


def _diff_prompt_sql(prev: str, code: str, docs_: str) -> str:
    fence_ = lambda x: f"'```python' || chr(10) || {x} || chr(10) || '```,'"
    return (f"('Original Code:' || chr(10) || {fence_(prev)} || chr(10) || chr(10) || 'Updated Code:' || chr(10) || "
            f"{fence_(code)} || chr(10) || chr(10) || 'Current Documentation:' || chr(10) || {docs_})")


@query("prompt_diff", W("fx_versions") + f"""
SELECT repo, path, version, {_diff_prompt_sql('prev_code', 'code', 'docs')} AS prompt FROM (
  SELECT *, lag(code) OVER (PARTITION BY repo, path ORDER BY version) AS prev_code FROM fx_versions)
WHERE prev_code IS NOT NULL""")
def q_prompt_diff(spark, sf):
    from .operators.windows import lag_within

    v = fx(spark, sf, "fx_versions")
    lagged = lag_within(v, ["repo", "path"], "version", ["code"], bucket=2)
    fence_ = lambda x: F.concat(F.lit("```python\n"), F.col(x), F.lit("\n```,"))
    prompt = F.concat(F.lit("Original Code:\n"), fence_("prev_code"), F.lit("\n\nUpdated Code:\n"), fence_("code"),
                      F.lit("\n\nCurrent Documentation:\n"), F.col("docs"))
    return lagged.filter(F.col("prev_code").isNotNull()).select("repo", "path", "version", prompt.alias("prompt"))


@query("curated_semi_join", W("fx_repos") + """
SELECT doc_id, topic FROM fx_repos WHERE topic IN (
  SELECT lower(regexp_replace(regexp_extract(href, '([^/]*)$', 1), '[.,;:!?]+$', ''))
  FROM (SELECT unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS href FROM pages))""")
def q_curated_semi_join(spark, sf):
    from .operators.joins import linked_from_pages

    pages = X.base_table(spark, sf, "pages")
    return linked_from_pages(fx(spark, sf, "fx_repos"), pages, "topic").select("doc_id", "topic")


def _repository_sql(url: str) -> str:
    pattern = S.q(joins.REPOSITORY_URL)
    part = lambda i: f"regexp_extract(lower(trim({url})), {pattern}, {i})"
    return f"{part(1)} AS host, {part(2)} AS owner, regexp_replace({part(3)}, '\\.git$', '') AS name"


@query("curated_repositories", W("fx_repos", "fx_lists") + f"""
SELECT doc_id, html_url FROM (SELECT doc_id, html_url, {_repository_sql('html_url')} FROM fx_repos) r
WHERE host <> '' AND name <> '' AND EXISTS (
  SELECT 1 FROM (SELECT {_repository_sql('url')} FROM (
    SELECT unnest(list_concat(regexp_extract_all(html, {S.q(joins.HREF)}, 1), regexp_extract_all(html, {S.q(joins.MARKDOWN_LINK)}, 1))) AS url
    FROM fx_lists)) l
  WHERE l.host = r.host AND l.owner = r.owner AND l.name = r.name)""")
def q_curated_repositories(spark, sf):
    """Repositories linked from curated lists, by host, owner and name."""
    return joins.curated_repositories(fx(spark, sf, "fx_repos"), fx(spark, sf, "fx_lists"), "html_url").select("doc_id", "html_url")


@query("documented_stats", W(*ALL_FX) + f"""
SELECT count(*) AS total_entries, avg({S.token_count('input')}) AS avg_input_tokens,
       avg({S.token_count('output')}) AS avg_output_tokens FROM ({S.ex_all()})""")
def q_documented_stats(spark, sf):
    from .operators.stats import documented_summary

    return documented_summary(P.convert_sources(fixture_sources(spark, sf)))


@query("language_distribution", W(*ALL_FX) + f"""
SELECT dimension, key, n, 100.0 * n / sum(n) OVER (PARTITION BY dimension) AS pct FROM (
  SELECT 'language' AS dimension, language AS key, count(*) AS n FROM ({S.ex_all()}) GROUP BY language
  UNION ALL
  SELECT 'instruction_type', {S.task_type('source')}, count(*) FROM ({S.ex_all()}) GROUP BY 2)""")
def q_language_distribution(spark, sf):
    from .operators.stats import distribution

    return distribution(P.convert_sources(fixture_sources(spark, sf)))


@query("quality_score", W(*REPO_FX) + f"""
SELECT repo_name, (2.0 * align + 2.0 * concise + 2.0 * lic + 1.0 * recency + 1.0 * (1.0 - share)) / 8.0 AS score
FROM (
  SELECT repo_name,
    CASE WHEN len({S.word_set('description')}) = 0 THEN 0.0
         ELSE CAST(len(list_intersect({S.word_set('description')}, {S.word_set('readme')})) AS DOUBLE)
              / CAST(len({S.word_set('description')}) AS DOUBLE) END AS align,
    least(1.0, 500.0 / CAST(greatest({S.word_count('readme')}, 1) AS DOUBLE)) AS concise,
    CASE {S.license_family(S.license_name('readme'))} WHEN 'permissive' THEN 1.0 WHEN 'unknown' THEN 0.5
         ELSE 0.0 END AS lic,
    1.0 / (1.0 + CAST(date_diff('day', CAST(pushed_at AS DATE), DATE '2026-01-01') AS DOUBLE) / 365.0) AS recency,
    CAST(count(*) OVER (PARTITION BY language) AS DOUBLE) / CAST(count(*) OVER () AS DOUBLE) AS share
  FROM ({S.records_sql(None)}) WHERE readme IS NOT NULL)""")
def q_quality_score(spark, sf):
    from .operators.stats import quality_score

    recs = _readme_result(spark, sf).records.filter(F.col("readme").isNotNull())
    return quality_score(recs)


_STRAT_EX = f"""
SELECT *, {S.length_bucket('output')} AS length_bucket, {S.task_type('source')} AS task_type FROM ({S.ex_all()})"""


@query("stratified_split", W(*ALL_FX) + f"""
SELECT {EX5}, split FROM ({S.split_sql(_STRAT_EX, partition='language, length_bucket, task_type')})""")
def q_stratified_split(spark, sf):
    from .plans.documented import stratified_split

    ex = P.convert_sources(fixture_sources(spark, sf))
    return stratified_split(ex).select(*alpaca.EXAMPLE_COLUMNS, "split")


def _duck_near_pairs(src: str = "kept", id_col: str = "doc_id", text_col: str = "text", p: str = "",
                     kept_sql: str | None = None) -> str:
    """CTEs ending in ``{p}simpairs`` (id_a, id_b, n_inter, n_union) over ``src``."""
    ws = f"[{S.B}]+"
    if kept_sql is None:
        kept_sql = f"""{src} AS (SELECT doc_id, text FROM documents
         WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY md5({S.normalized('text')}))),"""
    return f"""
{kept_sql}
{p}toks AS (SELECT {id_col} AS id, list_filter(string_split_regex(lower(coalesce({text_col}, '')), {S.q(ws)}),
                                           lambda w: w <> '') AS t FROM {src}),
{p}sets AS (SELECT id, list_distinct(list_transform(range(1, len(t) - 1), lambda i: array_to_string(t[i:i + 2], ' ')))
           AS s FROM {p}toks WHERE len(t) >= 3),
{p}rows AS (SELECT id, len(s) AS n, unnest(s) AS sh FROM {p}sets),
{p}inter AS (SELECT a.id AS id_a, b.id AS id_b, count(*) AS n_inter, any_value(a.n) AS na, any_value(b.n) AS nb
          FROM {p}rows a JOIN {p}rows b ON a.sh = b.sh AND a.id < b.id GROUP BY 1, 2),
{p}simpairs AS (SELECT id_a, id_b, n_inter, CAST(na + nb - n_inter AS BIGINT) AS n_union FROM {p}inter
             WHERE {K.JACCARD_DEN} * n_inter >= {K.JACCARD_NUM} * (na + nb - n_inter))
"""


def _documented_sql() -> str:
    ex = S.ex_all()
    # one row per normalized (input, output): the one with the smallest content key
    k1 = f"""k1 AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY md5({S.normalized('input')} || chr(31) || {S.normalized('output')})
                               ORDER BY ck) AS rn FROM ({ex})) WHERE rn = 1),"""
    near = _duck_near_pairs(src="k1", id_col="ck", text_col="(input || chr(10) || output)", p="nd_", kept_sql=k1)
    comps = """,
nd_edges AS (SELECT id_a AS s, id_b AS d FROM nd_simpairs UNION SELECT id_b, id_a FROM nd_simpairs),
nd_reach(s, d) AS (SELECT s, d FROM nd_edges UNION SELECT r.s, e.d FROM nd_reach r JOIN nd_edges e ON e.s = r.d),
nd_dropped AS (SELECT s AS ck FROM nd_reach GROUP BY s HAVING min(d) < s),"""
    k3 = f"""
k3 AS (SELECT * FROM k1 WHERE ck NOT IN (SELECT ck FROM nd_dropped)
         AND {S.detect_language('output')} = 'en' AND {S.tokens_ok('input', 'output')}),
bp AS ({S.boilerplate_sql('k3', 'ck', 'output')}),
k4 AS (SELECT k3.* FROM k3 JOIN bp ON bp.ck = k3.ck WHERE {S.reason('k3.output', 'bp.boilerplate_ratio')} IS NULL)
"""
    strat = f"SELECT *, {S.length_bucket('output')} AS length_bucket, {S.task_type('source')} AS task_type FROM k4"
    return (near + comps + k3 +
            f"SELECT {EX5}, split FROM ({S.split_sql(strat, partition='language, length_bucket, task_type')})")


@query("documented_job", W(*ALL_FX).replace("WITH ", "WITH RECURSIVE ", 1) + ", " + _documented_sql())
def q_documented_job(spark, sf):
    from .plans.documented import documented_preprocess

    ex = P.convert_sources(fixture_sources(spark, sf))
    return documented_preprocess(ex).split.select(*alpaca.EXAMPLE_COLUMNS, "split")


# ------------------------------------------------------------------ I3: near duplicates


@query("near_dup_pairs", "WITH " + _duck_near_pairs() + "SELECT id_a, id_b, n_inter, n_union FROM simpairs")
def q_near_dup_pairs(spark, sf):
    from .operators.dedup import dedup_exact
    from .operators.neardup import shingle_sets, similar_pairs

    kept = dedup_exact(docs(spark, sf), "doc_id", "text")
    return similar_pairs(shingle_sets(kept, "doc_id", "text"))


@query("dedup_near", "WITH RECURSIVE " + _duck_near_pairs() + """,
edges AS (SELECT id_a AS s, id_b AS d FROM simpairs UNION SELECT id_b, id_a FROM simpairs),
reach(s, d) AS (SELECT s, d FROM edges UNION SELECT r.s, e.d FROM reach r JOIN edges e ON e.s = r.d),
dropped AS (SELECT s AS doc_id FROM reach GROUP BY s HAVING min(d) < s)
SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM kept)
  AND doc_id NOT IN (SELECT doc_id FROM dropped)""")
def q_dedup_near(spark, sf):
    from .operators.dedup import dedup_exact
    from .operators.neardup import dedup_near

    kept = dedup_exact(docs(spark, sf), "doc_id", "text")
    return dedup_near(spark, kept, "doc_id", "text").select("doc_id", "lang")


@query("near_dup_groups", "WITH RECURSIVE " + _duck_near_pairs(kept_sql="kept AS (SELECT doc_id, text FROM documents),") + """,
edges AS (SELECT id_a AS s, id_b AS d FROM simpairs UNION SELECT id_b, id_a FROM simpairs),
reach(s, d) AS (SELECT s, d FROM edges UNION SELECT r.s, e.d FROM reach r JOIN edges e ON e.s = r.d),
least AS (SELECT s AS id, min(d) AS d FROM reach GROUP BY s)
SELECT id AS doc_id, min(id) OVER (PARTITION BY list_sort(s)) AS class_id, least(id, coalesce(d, id)) AS component_id
FROM sets LEFT JOIN least USING (id)""")
def q_near_dup_groups(spark, sf):
    """Membership instead of pairs: the class of equal shingle sets and the component of
    similar ones, of every document with a shingle."""
    from .operators.neardup import near_classes

    return near_classes(docs(spark, sf), "doc_id", "text").select(F.col("id").alias("doc_id"), "class_id", "component_id")


@query("scan_repo_payloads", W(*REPO_FX) + """
SELECT r.owner, r.name, CAST(r.stars AS BIGINT) AS stars, r.language, r.pushed_at, m.content IS NOT NULL AS has_readme,
       CAST(len(t.tree) AS BIGINT) AS tree_items
FROM fx_repos r LEFT JOIN fx_readmes m ON m.owner = r.owner AND m.name = r.name
LEFT JOIN fx_trees t ON t.owner = r.owner AND t.name = r.name""")
def q_scan_repo_payloads(spark, sf):
    from .landing import land_payloads
    from .sources import repos as RS

    configure(spark)
    root = land_payloads(spark, sf)
    # what is told of a payload is found where it is read: contents and trees are not joined
    hits = RS.read_hits(spark, f"{root}/hits").select("owner", "name", "stars", "language", "pushed_at")
    readmes = RS.read_readmes(spark, f"{root}/readmes").select("owner", "name", F.col("content").isNotNull().alias("has_readme"))
    trees = RS.read_trees(spark, f"{root}/trees").select(
        "owner", "name", F.when(F.col("tree").isNotNull(), F.size("tree")).cast("bigint").alias("tree_items"))
    j = hits.join(readmes, ["owner", "name"], "left").join(trees, ["owner", "name"], "left")
    return j.select("owner", "name", "stars", "language", "pushed_at",
                    F.coalesce("has_readme", F.lit(False)).alias("has_readme"), "tree_items")


@query("readme_batch_roundtrip", W(*REPO_FX) + f"""
SELECT repo_name, url, stars, language, description, readme, {S.tree_text('file_tree')} AS tree_text
FROM ({S.records_sql(None)}) WHERE status = 'scraped'""")
def q_readme_batch_roundtrip(spark, sf):
    """B4: scraped records written under batch=<timestamp>/ and read back."""
    from .landing import landed_dir
    from .operators.repos import tree_text
    from .plans.readmes import write_batch

    scraped = _readme_result(spark, sf).scraped
    root = landed_dir(spark, sf, "out/readme_batches")
    write_batch(scraped, root, "20260101_000000")
    schema = scraped.schema
    back = spark.read.schema(schema).json(f"{root}/batch=20260101_000000")
    return back.select("repo_name", "url", "stars", "language", "description", "readme",
                       tree_text("file_tree").alias("tree_text"))

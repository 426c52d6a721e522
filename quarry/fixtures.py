"""Test inputs derived from the driver tables.

The driver's ``documents`` hold plain prose (no code, headings, markers), so the
reference's raw record shapes (code/docstring pairs, instruction rows, whole
files, JSONL lines, repository payloads) are *derived* from them with a CASE
over ``doc_id``.  Every fixture keeps all rows and whole texts; it only varies
the shape.  Each is one SQL text rendered for two dialects, so Spark and the
DuckDB oracle start from identical inputs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

AS_OF = "2026-01-01"  # fixed as-of date of repository activity checks


@dataclass(frozen=True)
class Dialect:
    name: str  # 'spark' or 'duckdb'

    def table(self, t: str) -> str:
        return f"__T_{t}__" if self.name == "spark" else t

    def ident(self, name: str) -> str:
        return f"`{name}`" if self.name == "spark" else f'"{name}"'

    def md5int(self, x: str, digits: int = 7) -> str:
        if self.name == "spark":
            return f"CAST(conv(substr(md5({x}), 1, {digits}), 16, 10) AS BIGINT)"
        return f"CAST(('0x' || substr(md5({x}), 1, {digits})) AS BIGINT)"

    def b64(self, x: str) -> str:
        if self.name == "spark":
            # Spark breaks base64 into MIME lines; keep one line like DuckDB
            return f"replace(replace(base64(CAST({x} AS BINARY)), chr(13), ''), chr(10), '')"
        return f"to_base64(encode({x}))"

    def struct(self, **fields: str) -> str:
        if self.name == "spark":
            return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"
        return "{" + ", ".join(f"'{k}': {v}" for k, v in fields.items()) + "}"

    def array(self, items: list[str]) -> str:
        if self.name == "spark":
            return "array(" + ", ".join(items) + ")"
        return "[" + ", ".join(items) + "]"

    def empty_tree(self) -> str:
        if self.name == "spark":
            return "CAST(array() AS ARRAY<STRUCT<path: STRING, type: STRING, size: BIGINT>>)"
        return "CAST([] AS STRUCT(path VARCHAR, type VARCHAR, size BIGINT)[])"

    def ts(self, literal: str) -> str:
        return f"CAST('{literal}' AS TIMESTAMP)" if self.name == "duckdb" else f"CAST('{literal}' AS TIMESTAMP_NTZ)"

    def minus_days(self, ts: str, days: str) -> str:
        if self.name == "spark":
            return f"({ts} - make_dt_interval(CAST({days} AS INT), 0, 0, 0))"
        return f"({ts} - to_days(CAST({days} AS INTEGER)))"


SPARK = Dialect("spark")
DUCK = Dialect("duckdb")

NL = "chr(10)"


def _s(x: str) -> str:
    return f"CAST({x} AS STRING)"


def _json_safe(x: str) -> str:
    # newline, tab, carriage return, quote and backslash become spaces
    return f"translate({x}, chr(10) || chr(9) || chr(13) || chr(34) || chr(92), '     ')"


# --------------------------------------------------------------------------- pairs

def sql_pairs(d: Dialect) -> str:
    return f"""
SELECT doc_id,
  CASE doc_id % 6 WHEN 0 THEN 'python' WHEN 1 THEN 'javascript' WHEN 2 THEN 'java'
                  WHEN 3 THEN 'go' WHEN 4 THEN 'ruby' ELSE 'php' END AS language,
  CASE doc_id % 11
    WHEN 0 THEN CAST(NULL AS STRING)
    WHEN 1 THEN ''
    WHEN 2 THEN concat(repeat(' ', 30), 'x = 1')
    WHEN 3 THEN concat(chr(160), chr(9), 'def g', {_s('doc_id')}, '(a): return a + 1', {NL}, chr(160))
    ELSE concat('def f', {_s('doc_id')}, '(a, b):', {NL}, '    return ', text)
  END AS code,
  CASE doc_id % 17
    WHEN 0 THEN CAST(NULL AS STRING)
    WHEN 1 THEN ''
    WHEN 2 THEN 'short'
    WHEN 3 THEN concat('TODO ', text)
    WHEN 4 THEN concat({NL}, '   fixme later ', text)
    WHEN 5 THEN '@param x the input value'
    WHEN 6 THEN repeat('w', 40)
    WHEN 7 THEN concat('a b c', repeat(' ', 7))
    WHEN 8 THEN concat(text, repeat({NL}, 4), text)
    WHEN 9 THEN concat('Adds    two   numbers. ', text)
    WHEN 10 THEN 'ab cd ef g'
    WHEN 11 THEN '   No description available here'
    WHEN 12 THEN 'one two x'
    WHEN 13 THEN concat('Not a TODO ', text, chr(160))
    WHEN 14 THEN concat('todoist client ', text)
    WHEN 15 THEN concat('...', {NL}, 'three word body')
    ELSE text
  END AS docstring,
  concat('org', {_s('doc_id % 7')}, '/proj', {_s('doc_id % 13')}) AS repo,
  concat('src/mod', {_s('doc_id')}, '.txt') AS path,
  CASE WHEN source IN ('src0', 'src1', 'src2', 'src3', 'src4') THEN 'test' ELSE 'train' END AS shard,
  doc_id % 5 = 0 AS alt_keys,
  doc_id % 23 = 0 AS broken_line
FROM {d.table('documents')}
"""


def sql_corpus(d: Dialect) -> str:
    return f"""
SELECT doc_id, docstring AS {d.ident('desc')},
  CASE doc_id % 4 WHEN 0 THEN CAST(NULL AS STRING) WHEN 1 THEN '' WHEN 2 THEN '   '
                  ELSE concat('def f', {_s('doc_id')}, '(x):') END AS decl,
  code AS bodies
FROM ({sql_pairs(d)}) p
"""


# ---------------------------------------------------------------------- instructions

def sql_instr(d: Dialect) -> str:
    """User turn followed by the assistant turn of the same conversation."""
    return f"""
SELECT u.conv_id * 1000 + u.turn AS pair_id,
  CASE u.conv_id % 5 WHEN 0 THEN '   ' WHEN 1 THEN concat(u.text, repeat({NL}, 3), 'Thanks.') ELSE u.text END
    AS instruction,
  CASE u.conv_id % 3 WHEN 0 THEN CAST(NULL AS STRING) WHEN 1 THEN ''
                     ELSE concat('Context:  turn ', {_s('u.turn')}, '   of ', {_s('u.conv_id')}) END AS input,
  CASE u.conv_id % 7 WHEN 0 THEN '' ELSE a.text END AS output
FROM {d.table('conversations')} u
JOIN {d.table('conversations')} a
  ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
WHERE u.role = 'user' AND a.role = 'assistant'
"""


def sql_instr_alt(d: Dialect) -> str:
    """The same rows with the alternative column names prompt/response."""
    return f"SELECT pair_id, instruction AS prompt, input, output AS response FROM ({sql_instr(d)}) i"


# ----------------------------------------------------------------------------- files

FILE_LANGS = ["python", "javascript", "typescript", "java", "go", "rust"]


def sql_files(d: Dialect) -> str:
    return f"""
SELECT doc_id,
  CASE doc_id % 6 WHEN 0 THEN 'python' WHEN 1 THEN 'javascript' WHEN 2 THEN 'typescript'
                  WHEN 3 THEN 'java' WHEN 4 THEN 'go' ELSE 'rust' END AS language,
  CASE doc_id % 7
    WHEN 0 THEN repeat('x', 99)
    WHEN 1 THEN repeat('y', 100)
    ELSE concat(CASE doc_id % 5 WHEN 0 THEN '\"\"\"' WHEN 1 THEN chr(39) || chr(39) || chr(39)
                                WHEN 2 THEN '/**' WHEN 3 THEN '///' ELSE '' END,
                ' ', text, {NL}, '   ')
  END AS content,
  concat('src/file', {_s('doc_id')}) AS path
FROM {d.table('documents')}
"""


# ----------------------------------------------------------------------------- lines

def sql_lines(d: Dialect) -> str:
    """JSONL lines covering every validation outcome, one per document."""
    t = _json_safe("text")
    valid_head = "'{\"instruction\": \"Explain this code briefly:\", \"input\": \"'"
    return f"""
SELECT doc_id,
  CASE doc_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'val' ELSE 'test' END AS shard,
  CASE doc_id % 15
    WHEN 0 THEN ''
    WHEN 1 THEN 'not json'
    WHEN 2 THEN concat({valid_head}, {t}, '", "output": "', {t}, '"}} junk')
    WHEN 3 THEN '[1, 2, 3]'
    WHEN 4 THEN concat('{{"instruction": "Document this code:", "input": "', {t}, '"}}')
    WHEN 5 THEN concat({valid_head}, {t}, '", "output": 5}}')
    WHEN 6 THEN concat({valid_head}, {t}, '", "output": null}}')
    WHEN 7 THEN concat({valid_head}, {t}, '", "output": "short"}}')
    WHEN 8 THEN '{{"instruction": "short", "input": "tiny", "output": "short"}}'
    WHEN 9 THEN concat({valid_head}, {t}, '", "output": "', {t}, '", "source": null}}')
    WHEN 10 THEN concat({valid_head}, {t}, '", "output": "', {t}, '", "language": 7}}')
    WHEN 11 THEN concat({valid_head}, repeat('x', 10001), '", "output": "', {t}, '"}}')
    WHEN 12 THEN concat({valid_head}, {t}, '", "output": "', {t}, '", "extra": 1}}')
    WHEN 13 THEN concat('{{"instruction": "', repeat('i', 501), '", "input": "', repeat('n', 20),
                        '", "output": "', repeat('o', 10), '"}}')
    ELSE concat({valid_head}, {t}, '", "output": "', {t}, '", "source": "src', {_s('doc_id % 4')},
                '", "language": "', lang, '"}}')
  END AS line
FROM {d.table('documents')}
"""


# ------------------------------------------------------------------------- repositories

REPO_LANGS = ["python", "javascript", "typescript", "go", "rust"]


def sql_repos(d: Dialect) -> str:
    """Search hits: one repository per document."""
    return f"""
SELECT doc_id,
  concat('user', {_s('doc_id % 37')}) AS owner,
  concat('repo', {_s('doc_id')}) AS name,
  concat('https://example.org/user', {_s('doc_id % 37')}, '/repo', {_s('doc_id')}) AS html_url,
  {d.md5int("concat('stars:', " + _s('doc_id') + ")")} % 2000 AS stars,
  CASE doc_id % 5 WHEN 0 THEN 'python' WHEN 1 THEN 'javascript' WHEN 2 THEN 'typescript'
                  WHEN 3 THEN 'go' ELSE 'rust' END AS language,
  {d.minus_days(d.ts(AS_OF + ' 00:00:00'), '(doc_id % 1000)')} AS pushed_at,
  CASE doc_id % 9 WHEN 0 THEN CAST(NULL AS STRING) ELSE concat('Project ', {_s('doc_id')}, ': ', text) END
    AS description,
  lower(regexp_extract(text, '^([^ ,.]+)', 1)) AS topic
FROM {d.table('documents')}
"""


def sql_readme_text(d: Dialect) -> str:
    """Plain README text per repository, before encoding."""
    return f"""
SELECT doc_id,
  CASE doc_id % 13
    WHEN 0 THEN repeat('a', 499)
    WHEN 1 THEN concat(repeat('b', 490), {NL}, '## A', {NL}, '```')
    ELSE concat(
      CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN concat('# Repo ', {_s('doc_id')}, {NL})
                      WHEN 2 THEN concat('## Overview', {NL}) ELSE concat({NL}, '# Top', {NL}) END,
      text,
      CASE doc_id % 5 WHEN 0 THEN ''
                      WHEN 1 THEN concat({NL}, '## Install', {NL}, 'pip install x')
                      WHEN 2 THEN concat({NL}, '## Usage', {NL}, 'run it', {NL}, '# Notes', {NL}, 'none')
                      WHEN 3 THEN concat({NL}, '### Deep', {NL}, 'z', {NL}, '### Deeper')
                      ELSE concat({NL}, '## A', {NL}, '## B', {NL}, '## C') END,
      CASE doc_id % 3 WHEN 0 THEN '' ELSE concat({NL}, '```python', {NL}, 'print(1)', {NL}, '```') END,
      CASE doc_id % 11 WHEN 0 THEN '<!-- PROJECT SHIELDS -->' WHEN 1 THEN '{{{{cookiecutter.name}}}}'
                       WHEN 2 THEN 'REPLACE_ME' WHEN 3 THEN 'TODO: Add tests' WHEN 4 THEN 'todo: add'
                       ELSE '' END)
  END AS readme
FROM {d.table('documents')}
"""


def sql_readmes(d: Dialect) -> str:
    """README payloads (base64), some missing, malformed or not UTF-8."""
    return f"""
SELECT r.doc_id, r.owner, r.name,
  CASE
    WHEN r.doc_id % 29 = 0 THEN CAST(NULL AS STRING)
    WHEN r.doc_id % 23 = 0 THEN '//79'
    WHEN r.doc_id % 19 = 0 THEN concat({d.b64('t.readme')}, 'A')
    WHEN r.doc_id % 17 = 0 THEN concat('!', {d.b64('t.readme')})
    ELSE {d.b64('t.readme')}
  END AS content
FROM ({sql_repos(d)}) r JOIN ({sql_readme_text(d)}) t ON t.doc_id = r.doc_id
"""


def _tree_item(d: Dialect, path: str, typ: str, size: str) -> str:
    return d.struct(path=path, type=typ, size=size)


def sql_trees(d: Dialect) -> str:
    """Recursive trees: depths 0-4, a missing size, empty and missing trees."""
    sid = _s("doc_id")
    items = [
        _tree_item(d, "'README.md'", "'blob'", "CAST(doc_id % 5000 AS BIGINT)"),
        _tree_item(d, "'src'", "'tree'", "CAST(NULL AS BIGINT)"),
        _tree_item(d, f"concat('src/main', {sid}, '.py')", "'blob'", "CAST(100 + doc_id % 50 AS BIGINT)"),
        _tree_item(d, "'src/pkg/mod.py'", "'blob'", "CAST(42 AS BIGINT)"),
        _tree_item(d, "'src/pkg/sub/deep.py'", "'blob'", "CAST(7 AS BIGINT)"),
        _tree_item(d, "'a/b/c/d/e.py'", "'blob'", "CAST(1 AS BIGINT)"),
        _tree_item(d, "CASE doc_id % 2 WHEN 0 THEN 'package.json' ELSE 'pyproject.toml' END", "'blob'",
                   "CAST(doc_id % 300 AS BIGINT)"),
        _tree_item(d, "'docs/index.md'", "'blob'", "CAST(NULL AS BIGINT)"),
    ]
    return f"""
SELECT doc_id, concat('user', {_s('doc_id % 37')}) AS owner, concat('repo', {sid}) AS name,
  CASE doc_id % 10 WHEN 0 THEN NULL WHEN 1 THEN {d.empty_tree()} ELSE {d.array(items)} END AS tree
FROM {d.table('documents')}
"""


def sql_readme_forms(d: Dialect) -> str:
    """READMEs written by hand (headings from the text) and by two tools (headings of
    the tool, with its version and a list or a table)."""
    words = "regexp_extract(text, '^([^ ]+ [^ ]+ [^ ]+)', 1)"
    code = f"{NL}, '```python', {NL}, 'run(', {_s('doc_id')}, ')', {NL}, '```', {NL}"
    return f"""
SELECT doc_id, concat(
  CASE doc_id % 5
    WHEN 0 THEN concat('# API reference v', {_s('doc_id % 10')}, {NL}, text, {NL}, '## Modules', {NL}, '- a', {NL}, '- b', {code}, '## Index', {NL}, text)
    WHEN 1 THEN concat('# Generated client ', {_s('doc_id')}, {NL}, {NL}, '## Models', {NL}, '| a | b |', {NL}, '## Methods', {code}, text)
    WHEN 2 THEN concat('# Notes', {NL}, text, {code}, '## More', {NL}, text)
    ELSE concat('# ', {words}, {NL}, text, {NL}, '## Use of ', {words}, {code}, '## About ', {words}, {NL}, '1. one', {NL}, text, {NL}, '## Contact', {NL}, 'mail') END) AS readme
FROM {d.table('documents')}
"""


def sql_contents(d: Dialect) -> str:
    """Contents of files (base64): manifests, a file that is no key file, some missing,
    malformed or not UTF-8."""
    manifest = "CASE doc_id % 2 WHEN 0 THEN 'package.json' ELSE 'pyproject.toml' END"
    return f"""
SELECT doc_id, concat('user', {_s('doc_id % 37')}) AS owner, concat('repo', {_s('doc_id')}) AS name, path,
  CASE WHEN doc_id % 31 = 0 THEN '//79' WHEN doc_id % 27 = 0 THEN concat({d.b64('text')}, 'A') ELSE {d.b64('text')} END AS content
FROM (SELECT doc_id, text, {manifest} AS path FROM {d.table('documents')} WHERE doc_id % 7 <> 0
      UNION ALL SELECT doc_id, text, 'src/pkg/mod.py' FROM {d.table('documents')} WHERE doc_id % 6 = 0) f
"""


def sql_lists(d: Dialect) -> str:
    """Curated lists: entries of HTML and Markdown with links of every form to
    repositories, to profiles and to sections."""
    url = f"concat('example.org/user', {_s('doc_id % 37')}, '/repo', {_s('doc_id')})"
    return f"""
SELECT doc_id AS page_id, concat('<li><a class="x" ',
  CASE doc_id % 9
    WHEN 0 THEN concat('href="https://', {url}, '"')
    WHEN 1 THEN concat('href="http://www.', {url}, '.git"')
    WHEN 2 THEN concat('HREF = "HTTPS://', upper({url}), '/"')
    WHEN 3 THEN concat('href="//', {url}, '/tree/main#readme"')
    WHEN 4 THEN concat('href="https://example.org/user', {_s('doc_id % 37')}, '"')
    WHEN 5 THEN concat('href="https://elsewhere.net/user', {_s('doc_id % 37')}, '/repo', {_s('doc_id')}, '"')
    WHEN 6 THEN concat('href="#x">x</a> [r](https://', {url}, '?tab=readme) <a href="#y"')
    WHEN 7 THEN concat('href="/user', {_s('doc_id % 37')}, '/repo', {_s('doc_id')}, '"')
    ELSE concat('href="https://', {url}, '-fork"') END,
  '>', text, '</a></li>') AS html
FROM {d.table('documents')}
"""


# ------------------------------------------------------------------------- versions

def sql_versions(d: Dialect) -> str:
    """1-4 versions of a file per document: (repo, path, version, code, docs)."""
    return f"""
SELECT concat('org/repo', {_s('doc_id % 50')}) AS repo,
  concat('src/m', {_s('doc_id % 200')}, '.py') AS path,
  CAST((doc_id - doc_id % 200) / 200 AS BIGINT) AS version,
  concat('def v', {_s('doc_id')}, '():', {NL}, '    return ', {_s('doc_id')}) AS code,
  text AS docs
FROM {d.table('documents')}
"""


FIXTURES = {
    "fx_pairs": (sql_pairs, ["documents"]),
    "fx_corpus": (sql_corpus, ["documents"]),
    "fx_instr": (sql_instr, ["conversations"]),
    "fx_instr_alt": (sql_instr_alt, ["conversations"]),
    "fx_files": (sql_files, ["documents"]),
    "fx_lines": (sql_lines, ["documents"]),
    "fx_repos": (sql_repos, ["documents"]),
    "fx_readme_text": (sql_readme_text, ["documents"]),
    "fx_readmes": (sql_readmes, ["documents"]),
    "fx_trees": (sql_trees, ["documents"]),
    "fx_contents": (sql_contents, ["documents"]),
    "fx_lists": (sql_lists, ["documents"]),
    "fx_readme_forms": (sql_readme_forms, ["documents"]),
    "fx_versions": (sql_versions, ["documents"]),
}


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from .session import rebalance_inputs

    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.hint("rebalance") if rebalance_inputs(spark) else df


def register_base(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Temp view over one driver table; the name is unique per folder."""
    import hashlib

    view = f"quarry_{name}_{hashlib.md5(sf_dir.rstrip('/').encode()).hexdigest()[:10]}"
    base_table(spark, sf_dir, name).createOrReplaceTempView(view)
    return view


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Build a fixture in Spark from the driver tables under ``sf_dir``."""
    builder, tables = FIXTURES[name]
    sql = builder(SPARK)
    for t in tables:
        sql = sql.replace(f"__T_{t}__", register_base(spark, sf_dir, t))
    return spark.sql(sql)


def duck_fixture(name: str) -> str:
    """The fixture's SQL for the DuckDB oracle (driver tables are views)."""
    builder, _ = FIXTURES[name]
    return builder(DUCK)


def with_fixtures(*names: str) -> str:
    """``WITH`` clause defining the named fixtures for an oracle query."""
    return "WITH " + ",\n".join(f"{n} AS ({duck_fixture(n)})" for n in names) + "\n"

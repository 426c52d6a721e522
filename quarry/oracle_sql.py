"""DuckDB SQL snippets used by the oracle queries.

These are independent formulations of the operators' semantics in DuckDB's
dialect (RE2 regexes, 1-based lists, '0x' hex casts); the driver runs them next
to the Spark queries.
"""

from __future__ import annotations

from .functions import constants as K
from .functions.text import PY_WHITESPACE, WS_CLASS_BODY

WS = "(" + " || ".join(f"chr({ord(c)})" for c in PY_WHITESPACE) + ")"
B = WS_CLASS_BODY


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def clean(x: str) -> str:
    inner = f"regexp_replace(coalesce({x}, ''), '\\n{{3,}}', chr(10) || chr(10), 'g')"
    inner = f"regexp_replace({inner}, ' {{2,}}', ' ', 'g')"
    return strip(inner)


def min_words(x: str, n: int) -> str:
    return f"regexp_matches({x}, '^[{B}]*[^{B}]+(?:[{B}]+[^{B}]+){{{n - 1}}}')"


def word_count(x: str) -> str:
    return f"CAST(len(regexp_extract_all({x}, '[^{B}]+')) AS BIGINT)"


def low_quality_re() -> str:
    alts = []
    for o in K.LOW_QUALITY_OPENINGS:
        a = "".join("\\" + ch if ch in ".^$|?*+()[]{}\\" else ch for ch in o)
        alts.append(a + ("$" if o == "..." else ""))
    return "(?i)^(?:" + "|".join(alts) + ")"


def quality(d: str) -> str:
    return (f"coalesce(({d} IS NOT NULL AND length({d}) >= 10 AND NOT regexp_matches({strip(d)}, "
            f"{q(low_quality_re())}) AND {min_words(d, 3)}), false)")


def pair_ok(code: str, doc: str) -> str:
    return (f"coalesce(({code} IS NOT NULL AND {code} <> '' AND length({strip(code)}) >= 20 "
            f"AND {quality(doc)}), false)")


def fence(lang: str, code: str) -> str:
    return f"('```' || {lang} || chr(10) || {code} || chr(10) || '```')"


# a token: an identifier run or one other character that is not a blank
TOKEN_PATTERN = r"[A-Za-z0-9_]+|[^A-Za-z0-9_ \t\n\x0B\f\r]"


def hexint(h: str, digits: int = 7) -> str:
    return f"CAST(('0x' || substr({h}, 1, {digits})) AS BIGINT)"


def rowkey(*xs: str) -> str:
    parts = ", ".join(f"coalesce(CAST({x} AS VARCHAR), chr(30))" for x in xs)
    return f"md5(concat_ws(chr(31), {parts}))"


def seeded(seed: int, salt: str, k: str) -> str:
    return f"md5('{seed}:{salt}:' || {k})"


def template(task: str, k: str, seed: int = K.DEFAULT_SEED) -> str:
    ts = K.INSTRUCTION_TEMPLATES[task]
    lst = "[" + ", ".join(q(t) for t in ts) + "]"
    return f"({lst})[CAST({hexint(seeded(seed, 'tpl', k))} % {len(ts)} AS BIGINT) + 1]"


def fence_decl(decl: str, bodies: str) -> str:
    return (f"CASE WHEN {decl} IS NOT NULL AND {decl} <> '' THEN "
            f"{fence(q('python'), strip(decl) + ' || chr(10) || ' + strip(bodies))} "
            f"ELSE {fence(q('python'), strip(bodies))} END")


def ex_pairs(src: str = "fx_pairs", seed: int = K.DEFAULT_SEED) -> str:
    """Examples of the code/docstring processor from a (language, code, docstring) relation."""
    return f"""
SELECT {template('function_doc', 'ck', seed)} AS instruction, input, output, source, language, ck FROM (
  SELECT *, {rowkey('source', 'language', "''", 'input', 'output')} AS ck FROM (
    SELECT {fence('language', strip('code'))} AS input, {clean('docstring')} AS output,
           'codesearchnet' AS source, language
    FROM {src} WHERE {pair_ok('code', 'docstring')}))"""


def ex_corpus(src: str = "fx_corpus", seed: int = K.DEFAULT_SEED) -> str:
    return f"""
SELECT {template('function_doc', 'ck', seed)} AS instruction, input, output, source, language, ck FROM (
  SELECT *, {rowkey('source', 'language', "''", 'input', 'output')} AS ck FROM (
    SELECT {fence_decl('decl', 'bodies')} AS input, {clean('"desc"')} AS output,
           'code_docstring_corpus' AS source, 'python' AS language
    FROM {src} WHERE {pair_ok('bodies', '"desc"')}))"""


def instr_ok(i: str, o: str) -> str:
    return f"coalesce(({i} IS NOT NULL AND {i} <> '' AND {o} IS NOT NULL AND {o} <> ''), false)"


def ex_instr(src: str = "fx_instr") -> str:
    return f"""
SELECT instruction, input, output, source, language,
       {rowkey('source', 'language', 'instruction', 'input', 'output')} AS ck FROM (
  SELECT {clean('instruction')} AS instruction, {clean('input')} AS input, {clean('output')} AS output,
         'python_code_instructions' AS source, 'python' AS language
  FROM {src} WHERE {instr_ok('instruction', 'output')})"""


def ex_files(src: str = "fx_files", seed: int = K.DEFAULT_SEED) -> str:
    return f"""
SELECT {template('code_explain', 'ck', seed)} AS instruction, input, output, source, language, ck FROM (
  SELECT *, {rowkey('source', 'language', "''", 'input', 'output')} AS ck FROM (
    SELECT {fence('language', strip('substring(content, 1, 2000)'))} AS input,
           {q(K.FILE_EXAMPLE_OUTPUT)} AS output, 'the_stack_smol' AS source, language
    FROM {src} WHERE coalesce(content IS NOT NULL AND length(content) >= 100, false)))"""


def ex_all(seed: int = K.DEFAULT_SEED) -> str:
    return (f"{ex_pairs(seed=seed)}\nUNION ALL {ex_corpus(seed=seed)}\nUNION ALL {ex_instr()}"
            f"\nUNION ALL {ex_files(seed=seed)}")


def split_case(rn: str = "rn", n: str = "n", tr: float = 0.8, vr: float = 0.1) -> str:
    t = f"floor({n} * CAST({tr} AS DOUBLE))"
    v = f"floor({n} * CAST({vr} AS DOUBLE))"
    return f"CASE WHEN {rn} < {t} THEN 'train' WHEN {rn} < {t} + {v} THEN 'val' ELSE 'test' END"


def split_sql(examples: str, seed: int = K.DEFAULT_SEED, partition: str = "", tr: float = 0.8,
              vr: float = 0.1) -> str:
    """Examples relation -> examples + split by row_number over the seeded key."""
    over_p = f"PARTITION BY {partition} " if partition else ""
    return f"""
SELECT instruction, input, output, source, language, ck, {split_case(tr=tr, vr=vr)} AS split FROM (
  SELECT *, row_number() OVER ({over_p}ORDER BY {seeded(seed, 'split', 'ck')}) - 1 AS rn,
         count(*) OVER ({over_p.strip()}) AS n
  FROM ({examples}))"""


def cap_sql(examples: str, cap: int, seed: int = K.DEFAULT_SEED) -> str:
    return f"""
SELECT instruction, input, output, source, language, ck FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY {seeded(seed, 'cap', 'ck')}) AS rn
  FROM ({examples})) WHERE rn <= {cap}"""


# ------------------------------------------------------------------- repositories

def decode_b64(content: str) -> str:
    """Lenient base64 -> UTF-8 (null on failure), as a scalar subquery-free expression."""
    s = f"regexp_replace({content}, '[^A-Za-z0-9+/=]', '', 'g')"
    p = f"strpos({s}, '=')"
    data = f"(CASE WHEN {p} = 0 THEN {s} ELSE substring({s}, 1, {p} - 1) END)"
    m = f"(length({data}) % 4)"
    ok = (f"(CASE WHEN {p} = 0 THEN {m} = 0 ELSE ({m} = 0 OR {m} = 3 OR ({m} = 2 AND "
          f"substring({s}, {p}, 2) = '==')) END)")
    return f"(CASE WHEN {ok} THEN try(decode(from_base64({data} || repeat('=', (4 - {m}) % 4)))) END)"


def count_of(x: str, needle: str) -> str:
    return f"CAST((length({x}) - length(replace({x}, {needle}, ''))) / length({needle}) AS BIGINT)"


def sections(x: str) -> str:
    return f"({count_of(x, 'chr(10) || ' + q('## '))} + {count_of(x, 'chr(10) || ' + q('# '))})"


def readme_ok(x: str, min_sections: int = K.README_MIN_SECTIONS) -> str:
    markers = " OR ".join(f"contains({x}, {q(m)})" for m in K.README_TEMPLATE_MARKERS)
    return f"coalesce((NOT ({markers}) AND {sections(x)} >= {min_sections} AND contains({x}, '```')), false)"


def status(x: str) -> str:
    return (f"CASE WHEN NOT coalesce({x} IS NOT NULL AND length({x}) >= {K.README_MIN_CHARS}, false) THEN 'failed' "
            f"WHEN NOT {readme_ok(x)} THEN 'filtered' ELSE 'scraped' END")


def depth_ok(path: str, d: int = K.TREE_MAX_DEPTH) -> str:
    return f"(length({path}) - length(replace({path}, '/', ''))) <= {d}"


def tree_kept(tree: str) -> str:
    path = "struct_extract(x, 'path')"
    inner = f"list_filter({tree}, lambda x: {depth_ok(path)})"
    return (f"list_transform({inner}, lambda x: {{'path': struct_extract(x, 'path'), "
            f"'type': struct_extract(x, 'type'), 'size': coalesce(struct_extract(x, 'size'), CAST(0 AS BIGINT))}})")


def tree_text(tree: str) -> str:
    return (f"array_to_string(list_transform({tree}, lambda x: concat_ws(':', struct_extract(x, 'path'), "
            f"struct_extract(x, 'type'), CAST(struct_extract(x, 'size') AS VARCHAR))), '|')")


def key_paths(tree: str) -> str:
    names = ", ".join(q(n) for n in K.KEY_FILE_NAMES)
    return (f"list_transform(list_filter({tree}, lambda x: regexp_extract(struct_extract(x, 'path'), "
            f"'([^/]+)$', 1) IN ({names})), lambda x: struct_extract(x, 'path'))")


def select_repos_where(as_of: str = "2026-01-01", min_stars: int = K.SCRAPE_MIN_STARS,
                       languages: list[str] = K.SCRAPE_LANGUAGES, days: int = K.SCRAPE_PUSHED_WITHIN_DAYS) -> str:
    langs = ", ".join(q(x.lower()) for x in languages)
    return (f"stars >= {min_stars} AND lower(language) IN ({langs}) "
            f"AND CAST(pushed_at AS DATE) > DATE '{as_of}' - {days}")


def top_repos_sql(limit: int | None = K.SCRAPE_LIMIT, languages: list[str] = K.SCRAPE_LANGUAGES) -> str:
    if limit is None:
        return f"SELECT * FROM fx_repos WHERE {select_repos_where()}"
    k = limit // len(languages)
    return f"""
SELECT * EXCLUDE (rk) FROM (
  SELECT *, row_number() OVER (PARTITION BY lower(language) ORDER BY stars DESC, owner, name) AS rk
  FROM fx_repos WHERE {select_repos_where()}) WHERE rk <= {k}"""


def records_sql(limit: int | None = K.SCRAPE_LIMIT) -> str:
    return f"""
SELECT *, {status('readme')} AS status FROM (
  SELECT r.owner || '/' || r.name AS repo_name, r.html_url AS url, CAST(r.stars AS BIGINT) AS stars, r.language,
         r.description, r.pushed_at, {decode_b64('m.content')} AS readme, {tree_kept('t.tree')} AS file_tree
  FROM ({top_repos_sql(limit)}) r
  LEFT JOIN fx_readmes m ON m.owner = r.owner AND m.name = r.name
  LEFT JOIN fx_trees t ON t.owner = r.owner AND t.name = r.name)"""


def key_file_rows(records: str) -> str:
    """(repo_name, shown): the key files of each repository as they stand in its prompt."""
    language = " ".join(f"WHEN {q(e)} THEN {q(lang)}" for e, lang in K.FENCE_LANGUAGES.items())
    fenced = (f"k.path || ':' || chr(10) || '```' || (CASE lower(regexp_extract(k.path, '\\.([^./]+)$', 1)) {language} ELSE '' END) "
              f"|| chr(10) || substring(c.text, 1, {K.KEY_FILE_CHARS}) || chr(10) || '```,'")
    depth = "length(path) - length(replace(path, '/', ''))"
    return f"""
SELECT k.repo_name, string_agg(coalesce({fenced}, k.path), chr(10) || chr(10) ORDER BY k.path) AS shown
FROM (SELECT *, row_number() OVER (PARTITION BY repo_name ORDER BY {depth}, path) AS nth
      FROM (SELECT DISTINCT repo_name, unnest({key_paths('file_tree')}) AS path FROM ({records}))) k
LEFT JOIN (SELECT owner || '/' || name AS repo_name, path, {decode_b64('content')} AS text
           FROM (SELECT owner, name, path, max(content) AS content FROM fx_contents GROUP BY ALL)) c
  ON c.repo_name = k.repo_name AND c.path = k.path
WHERE k.nth <= {K.KEY_FILE_LIMIT} GROUP BY k.repo_name"""


def repo_prompt(repo_name: str, tree: str, shown: str) -> str:
    paths = f"list_sort(list_transform({tree}, lambda x: struct_extract(x, 'path')))"
    return (f"('Project: ' || {repo_name} || chr(10) || chr(10) || 'Structure:' || chr(10) || "
            f"coalesce(array_to_string({paths}, chr(10)), '') || chr(10) || chr(10) || 'Key Files:' || chr(10) || "
            f"coalesce({shown}, ''))")


# ------------------------------------------------------------------- spec tier

def token_count(x: str) -> str:

    return f"CAST(len(regexp_extract_all(coalesce({x}, ''), {q(TOKEN_PATTERN)})) AS BIGINT)"


def non_ascii(x: str) -> str:
    t = f"coalesce({x}, '')"
    return (f"(CASE WHEN length({t}) = 0 THEN 0.0 ELSE CAST(length(regexp_replace({t}, '[\\x00-\\x7F]', '', 'g')) "
            f"AS DOUBLE) / CAST(length({t}) AS DOUBLE) END)")


def license_name(x: str) -> str:
    t = f"coalesce({x}, '')"
    parts = " ".join(f"WHEN regexp_matches({t}, {q('(?i)' + pat)}) THEN {q(name)}" for name, _f, pat in K.LICENSE_RULES)
    return f"(CASE {parts} ELSE 'unknown' END)"


def license_family(n: str) -> str:
    parts = " ".join(f"WHEN {n} = {q(name)} THEN {q(fam)}" for name, fam, _p in K.LICENSE_RULES)
    return f"(CASE {parts} ELSE 'unknown' END)"


def generic_flag(x: str) -> str:
    return "(" + " OR ".join(f"contains({x}, {q(p)})" for p in K.GENERIC_PHRASES) + ")"


def template_flag(x: str) -> str:
    return "(" + " OR ".join(f"contains({x}, {q(p)})" for p in K.TEMPLATE_PLACEHOLDERS) + ")"


def reason(x: str, boilerplate: str | None = None) -> str:
    bp = f"WHEN {boilerplate} > {K.MAX_BOILERPLATE_RATIO} THEN 'boilerplate' " if boilerplate else ""
    return (f"(CASE WHEN {generic_flag(x)} THEN 'generic_phrase' WHEN {template_flag(x)} THEN 'template_marker' "
            f"{bp}WHEN {non_ascii(x)} > {K.MAX_NON_ASCII_RATIO} THEN 'non_ascii' END)")


def detect_language(x: str) -> str:
    toks = f"string_split_regex(lower(coalesce({x}, '')), '[^\\p{{L}}]+')"
    hits = {lang: f"len(list_filter({toks}, lambda t: t IN ({', '.join(q(w) for w in K.STOPWORDS[lang])})))"
            for lang in ("en", "de", "fr", "es")}
    best = f"greatest({hits['en']}, {hits['de']}, {hits['fr']}, {hits['es']})"
    return (f"(CASE WHEN {best} = 0 THEN 'unknown' WHEN {hits['en']} = {best} THEN 'en' "
            f"WHEN {hits['de']} = {best} THEN 'de' WHEN {hits['fr']} = {best} THEN 'fr' ELSE 'es' END)")


def skeleton(x: str) -> str:
    from .functions import quality as Q

    shapes = " ".join(f"WHEN regexp_matches(l, {q(p)}) THEN {q(m)}" for m, p in Q.LINE_SHAPES)
    shape = (f"CASE WHEN l = '' THEN '' WHEN regexp_matches(l, {q(Q.HEADING)}) THEN lower(regexp_replace(l, '[0-9]+', '0', 'g')) "
             f"{shapes} ELSE {q(Q.PROSE_SHAPE)} END")
    lines = f"list_transform(string_split({x}, chr(10)), lambda y: trim(regexp_replace(y, '[\t\r]', ' ', 'g')))"
    out = f"(array_to_string(list_filter(list_transform({lines}, lambda l: {shape}), lambda l: l <> ''), chr(10)) || chr(10))"
    for mark in [m for m, _ in Q.LINE_SHAPES] + [Q.PROSE_SHAPE]:
        out = f"regexp_replace({out}, '(?m)(?:^[{mark}]\n)+', '{mark}' || chr(10), 'g')"
    return out


def generated_sql(src: str, id_col: str, text_col: str) -> str:
    from .functions import quality as Q

    forms = f"SELECT {id_col}, {skeleton(text_col)} AS form FROM {src}"
    headed = (f"SELECT DISTINCT {id_col}, CASE WHEN len(regexp_extract_all(form, {q('(?m)' + Q.HEADING)})) >= {K.GENERATED_MIN_HEADINGS} "
              f"THEN form END AS form FROM ({forms})")
    return f"""
SELECT {id_col}, bool_or(n >= {K.GENERATED_MIN_READMES}) AS generated FROM (
  SELECT {id_col}, CASE WHEN form IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY form) END AS n FROM ({headed}))
GROUP BY {id_col}"""


def tokens_ok(i: str, o: str) -> str:
    (ilo, ihi), (olo, ohi) = K.TOKEN_LIMITS["input"], K.TOKEN_LIMITS["output"]
    return f"({token_count(i)} BETWEEN {ilo} AND {ihi} AND {token_count(o)} BETWEEN {olo} AND {ohi})"


def normalized(x: str) -> str:
    return f"lower({strip(f'regexp_replace({x}, {q(chr(91) + B + chr(93) + chr(43))}, {q(chr(32))}, {q(chr(103))})')})"


def boilerplate_sql(src: str, id_col: str, text_col: str, k: int = K.BOILERPLATE_MIN_DOCS) -> str:
    return f"""
SELECT d.{id_col}, CASE WHEN coalesce(s.total, 0) = 0 THEN 0.0
       ELSE CAST(s.common_len AS DOUBLE) / CAST(s.total AS DOUBLE) END AS boilerplate_ratio
FROM {src} d LEFT JOIN (
  SELECT l.{id_col}, sum(length(l.line)) AS total,
         sum(CASE WHEN f.line IS NOT NULL THEN length(l.line) ELSE 0 END) AS common_len
  FROM (SELECT {id_col}, {strip('x')} AS line
        FROM (SELECT {id_col}, unnest(string_split(coalesce({text_col}, ''), chr(10))) AS x FROM {src})) l
  LEFT JOIN (SELECT line FROM (SELECT DISTINCT {id_col}, {strip('x')} AS line
                               FROM (SELECT {id_col}, unnest(string_split(coalesce({text_col}, ''), chr(10))) AS x
                                     FROM {src}))
             WHERE line <> '' GROUP BY line HAVING count(*) >= {k}) f ON f.line = l.line
  WHERE l.line <> '' GROUP BY l.{id_col}) s ON s.{id_col} = d.{id_col}"""


def word_set(x: str) -> str:
    return f"list_distinct(list_filter(string_split_regex(lower(coalesce({x}, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> ''))"


def length_bucket(x: str) -> str:
    a, b = K.LENGTH_BUCKETS
    return f"(CASE WHEN length({x}) < {a} THEN 'short' WHEN length({x}) < {b} THEN 'medium' ELSE 'long' END)"


def task_type(src: str) -> str:
    from .operators.stats import TASK_BY_SOURCE

    parts = " ".join(f"WHEN {src} = {q(s)} THEN {q(t)}" for s, t in TASK_BY_SOURCE.items())
    return f"(CASE {parts} ELSE 'other' END)"

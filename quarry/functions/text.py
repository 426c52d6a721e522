"""String expressions with Python ``str`` semantics, as JVM-side Columns.

Every function maps Column -> Column and stays inside whole-stage codegen
(no Python UDF).  Lengths are Unicode code points, like Python ``len``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 characters for which Python's str.isspace() is true.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "    　"
)
# The same set as a regex class body, valid for Java regex and RE2.
WS_CLASS_BODY = (
    r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
WS = f"[{WS_CLASS_BODY}]"
NON_WS = f"[^{WS_CLASS_BODY}]"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` (a one-element transform).

    Used where an expensive value is referenced several times: the optimizer
    may inline projections into filters and would otherwise copy it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def py_strip(c: Column | str) -> Column:
    """Python ``str.strip()``: remove Unicode whitespace at both ends."""
    return F.trim(col(c), F.lit(PY_WHITESPACE))


def clean_text(c: Column | str) -> Column:
    """Empty/null -> ''; 3+ newlines -> 2; 2+ spaces -> 1; then strip."""
    x = F.coalesce(col(c), F.lit(""))
    x = F.regexp_replace(x, r"\n{3,}", "\n\n")
    x = F.regexp_replace(x, r" {2,}", " ")
    return py_strip(x)


def has_min_words(c: Column | str, n: int) -> Column:
    """True when ``len(s.split()) >= n`` (whitespace-separated words).

    An anchored pattern stops after the n-th word, so long texts are not split.
    """
    if n <= 0:
        return F.lit(True)
    pattern = f"^{WS}*{NON_WS}+(?:{WS}+{NON_WS}+){{{n - 1}}}"
    return col(c).rlike(pattern)


def word_count(c: Column | str) -> Column:
    """``len(s.split())`` as BIGINT."""
    # a split: counting matches takes ten times as long on long texts
    s = py_strip(c)
    return F.when(s == "", F.lit(0)).otherwise(F.size(F.split(s, f"{WS}+"))).cast("bigint")


def one_spaced(c: Column | str) -> Column:
    """Whitespace runs as single spaces (a split and a join, as ``regexp_replace`` takes
    ten times as long on long texts)."""
    return F.array_join(F.split(col(c), f"{WS}+"), " ")


def code_len(c: Column | str) -> Column:
    """Python ``len`` as BIGINT (code points)."""
    return F.length(col(c)).cast("bigint")


def fence(language: Column | str, code: Column) -> Column:
    """Markdown code block: three backticks + language, newline, code, newline, fence."""
    return F.concat(F.lit("```"), col(language), F.lit("\n"), code, F.lit("\n```"))


def hex_int(hex_col: Column, digits: int = 7) -> Column:
    """Integer value of the first ``digits`` hex characters (BIGINT)."""
    return F.conv(F.substring(hex_col, 1, digits), 16, 10).cast("bigint")


NULL_MARK = "\x1e"  # stands for a null field inside a row key
FIELD_SEP = "\x1f"  # separates fields inside a row key


def row_key(*cols: Column | str) -> Column:
    """md5 hex of the fields, null-aware, so equal keys mean equal fields."""
    parts = [F.coalesce(col(c).cast("string"), F.lit(NULL_MARK)) for c in cols]
    return F.md5(F.concat_ws(FIELD_SEP, *parts))


def seeded_key(seed: int, salt: str, key: Column | str) -> Column:
    """md5 hex of ``'{seed}:{salt}:{key}'`` — a reproducible random order."""
    return F.md5(F.concat(F.lit(f"{seed}:{salt}:"), col(key)))


def preview(c: Column | str, n: int) -> Column:
    """First n code points followed by '...' (always appended)."""
    return F.concat(F.substring(col(c), 1, n), F.lit("..."))


def preview_if_longer(c: Column | str, n: int) -> Column:
    """First n code points + '...' only when the text is longer than n."""
    return F.when(F.length(col(c)) > n, preview(c, n)).otherwise(col(c))


def count_occurrences(c: Column | str, needle: str) -> Column:
    """Non-overlapping occurrences of a literal (Python ``str.count``), BIGINT."""
    x = col(c)
    return ((F.length(x) - F.length(F.replace(x, F.lit(needle), F.lit("")))) / F.lit(len(needle))).cast("bigint")


def token_count(c: Column | str) -> Column:
    """[decision] Token-count proxy: identifier runs plus single punctuation marks."""
    # every identifier run becomes one letter and blanks go: what is left are the tokens,
    # counted as characters without an array of strings
    runs = F.regexp_replace(F.coalesce(col(c), F.lit("")), r"[A-Za-z0-9_]+", "w")
    return F.length(F.regexp_replace(runs, r"[ \t\n\x0B\f\r]+", "")).cast("bigint")


def non_ascii_ratio(c: Column | str) -> Column:
    """Share of code points outside ASCII; 0.0 for empty text (DOUBLE)."""
    x = F.coalesce(col(c), F.lit(""))
    n = F.length(x)
    non_ascii = F.length(F.regexp_replace(x, r"[\x00-\x7F]", ""))
    return F.when(n == 0, F.lit(0.0)).otherwise(non_ascii.cast("double") / n.cast("double"))

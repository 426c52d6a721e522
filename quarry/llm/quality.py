"""Quality rules: a threshold table compiled into one projection.

``THRESHOLDS`` names measures (SQL expressions over a text's counts) and the
bounds they must keep.  The table becomes one SELECT of built-in functions: the
words are split once, the counts follow from them, and every rule is a
comparison.  No user function runs and nothing is shuffled.

Repeated windows: each window of five words is hashed; only texts in which a
hash occurs twice sort their windows, so the work stays n log n in the words.

Cases: a null text has no words (and fails the base rule); an empty text
likewise; repeated rows are judged one by one; ratios of empty texts are 0;
extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import common

SPACE = r"[\\x20\\x09-\\x0D]+"
TRIM = r"' \t\n\u000b\f\r'"

# fixed values: frequent function words of the corpus' languages
STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "on", "was", "be", "with", "as", "this", "by",
    "der", "die", "und", "das", "den", "von", "zu", "mit", "ist", "des", "auf", "für", "nicht", "ein", "eine", "dem",
    "le", "la", "les", "de", "et", "des", "un", "une", "en", "que", "est", "pour", "dans", "du", "qui",
    "el", "los", "las", "y", "del", "se", "por", "con", "una", "su", "para", "al", "lo",
)


@dataclass(frozen=True)
class Threshold:
    """A rule: the measure must lie between the bounds (None: open)."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None

    def verdict(self) -> str:
        tests = [f"({self.measure}) >= {self.least}"] * (self.least is not None) + [f"({self.measure}) <= {self.most}"] * (self.most is not None)
        return "(" + " AND ".join(tests or ["true"]) + ")"


THRESHOLDS = (
    Threshold("word_length", "word_chars / greatest(n_words, 1)", 2.0, 20.0),
    Threshold("symbol_ratio", "n_symbols / greatest(n_words, 1)", None, 0.5),
    Threshold("stop_word_ratio", "(n_stop + 1) / greatest(n_words, 1)", 0.02, None),
    Threshold("duplicate_line_ratio", "n_dup_lines / greatest(n_lines, 1)", None, 0.5),
    Threshold("bullet_line_ratio", "n_bullets / greatest(n_lines, 1)", None, 0.9),
    Threshold("ellipsis_line_ratio", "n_ellipses / greatest(n_lines, 1)", None, 0.5),
)

BASE_FAILED = "(n_words < 10 OR 100 * n_repeat_words > 20 * n_words)"

# counts that need only the text, its words and its lines
_COUNTS = {
    "n_words": "cast(size(words) as bigint)",
    "word_chars": "cast(length(array_join(words, '')) as bigint)",
    "n_symbols": r"cast(length(regexp_replace(text, '[^#*$%&|<>]+', '')) as bigint)",
    "n_lines": "cast(size(lines) as bigint)",
    "n_dup_lines": "cast(size(lines) - size(array_distinct(lines)) as bigint)",
    "n_stop": f"cast(size(filter(words, w -> lower(w) IN ({', '.join(repr(w) for w in dict.fromkeys(STOP_WORDS))}))) as bigint)",
    "n_bullets": r"cast(size(filter(lines, l -> l rlike '^[\\x20\\x09]*[-*•]')) as bigint)",
    "n_ellipses": r"cast(size(filter(lines, l -> rtrim(l) like '%...' or rtrim(l) like '%…')) as bigint)",
}


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of every text."""
    split = common.narrow(docs, doc_id="long", text="string").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).selectExpr(
        "doc_id", "text", f"array_remove(split(text, '{SPACE}'), '') AS words",
        rf"filter(split(text, '\n'), l -> trim(BOTH {TRIM} FROM l) <> '') AS lines",
    )
    counted = split.selectExpr(
        "doc_id", *[f"{e} AS {c}" for c, e in _COUNTS.items()],
        "CASE WHEN size(words) < 5 THEN cast(array() as array<bigint>) ELSE transform(sequence(0, size(words) - 5), "
        "i -> xxhash64(words[i], words[i + 1], words[i + 2], words[i + 3], words[i + 4])) END AS windows",
    )
    # windows that occur twice: neighbours of equal hash once sorted, by their places
    sorted_ = counted.selectExpr(
        "doc_id", *_COUNTS,
        "CASE WHEN size(array_distinct(windows)) < size(windows) "
        "THEN sort_array(transform(windows, (h, i) -> struct(h AS h, i AS i))) END AS runs",
    )
    placed = sorted_.selectExpr(
        "doc_id", *_COUNTS,
        "sort_array(transform(filter(runs, (x, k) -> coalesce(x.h = get(runs, k - 1).h, false) OR coalesce(x.h = get(runs, k + 1).h, false)), x -> x.i)) AS at",
    )
    # a repeated window covers five words, or fewer where the next one begins
    return placed.selectExpr(
        "doc_id", *_COUNTS,
        "coalesce(aggregate(zip_with(at, slice(at, 2, greatest(size(at) - 1, 0)), (a, b) -> least(coalesce(b - a, 5), 5)), 0L, (s, x) -> s + x), 0L) AS n_repeat_words",
    )


def judge(docs: DataFrame, thresholds: tuple[Threshold, ...] = THRESHOLDS) -> DataFrame:
    """Counts, base_failed, each rule's verdict (``ok_<name>``) and kept."""
    rules = [t.verdict() for t in thresholds]
    return measure(docs).selectExpr(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", f"{BASE_FAILED} AS base_failed",
        f"NOT {BASE_FAILED} AND " + " AND ".join(rules or ["true"]) + " AS kept",
        *[f"{r} AS ok_{t.name}" for t, r in zip(thresholds, rules, strict=True)],
    )


def oracle_sql(thresholds: tuple[Threshold, ...] = THRESHOLDS) -> str:
    """DuckDB SQL for ``judge``."""
    space = r"[\x20\x09-\x0D]+"
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    rules = [t.verdict() for t in thresholds]
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, t, list_filter(string_split_regex(t, '{space}'), lambda x: x <> '') AS words,
         list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT doc_id, unnest(range(1, len(words) - 3)) AS i, words FROM w WHERE len(words) >= 5),
h AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i:i + 4]) AS n FROM g),
r AS (SELECT doc_id, least(coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 5), 5) AS c FROM h WHERE n > 1),
s AS (SELECT doc_id, sum(c)::BIGINT AS n_repeat_words FROM r GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         len(list_filter(words, lambda x: lower(x) IN ({stop})))::BIGINT AS n_stop,
         len(list_filter(lines, lambda l: regexp_matches(l, '^[\x20\x09]*[-*•]')))::BIGINT AS n_bullets,
         len(list_filter(lines, lambda l: rtrim(l, ' ') LIKE '%...' OR rtrim(l, ' ') LIKE '%…'))::BIGINT AS n_ellipses,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN s USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {BASE_FAILED} AS base_failed,
  NOT {BASE_FAILED} AND {' AND '.join(rules or ['true'])} AS kept,
  {', '.join(f'{r} AS ok_{t.name}' for t, r in zip(thresholds, rules, strict=True))}
FROM m"""

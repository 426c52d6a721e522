"""Quality predicates and text features as Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K
from .text import col, count_occurrences, has_min_words, py_strip


def _java_escape(s: str) -> str:
    return re.sub(r"([\\.^$|?*+()\[\]{}])", r"\\\1", s)


def low_quality_regex() -> str:
    """Case-insensitive (Unicode) pattern for the rejected docstring openings."""
    alts = []
    for opening in K.LOW_QUALITY_OPENINGS:
        alt = _java_escape(opening)
        if opening == "...":
            alt += "$"
        alts.append(alt)
    return "(?iu)^(?:" + "|".join(alts) + ")"


def is_quality_doc(doc: Column | str) -> Column:
    """Docstring quality gate: non-empty, raw length >= 10, no rejected opening
    after stripping, at least 3 words.  Never null."""
    d = col(doc)
    ok = (
        d.isNotNull()
        & (F.length(d) >= 10)
        & ~py_strip(d).rlike(low_quality_regex())
        & has_min_words(d, 3)
    )
    return F.coalesce(ok, F.lit(False))


def has_doc_marker(content: Column | str, language: Column | str) -> Column:
    """Whole-file documentation marker by language (never null)."""
    c, lang = col(content), col(language)
    py = c.contains('"""') | c.contains("'''")
    jsdoc = c.contains("/**")
    slashes = c.contains("///")
    expr = (
        F.when(lang == "python", py)
        .when(lang.isin("javascript", "typescript"), jsdoc | slashes)
        .when(lang.isin("java", "go"), jsdoc)
        .otherwise(jsdoc | slashes)
    )
    return F.coalesce(expr, F.lit(False))


def readme_sections(readme: Column | str) -> Column:
    """Headings after the first line: count of '\\n## ' plus '\\n# ' (BIGINT)."""
    return count_occurrences(readme, "\n## ") + count_occurrences(readme, "\n# ")


def has_code_fence(text: Column | str) -> Column:
    return col(text).contains("```")


def has_template_marker(readme: Column | str) -> Column:
    r = col(readme)
    out = F.lit(False)
    for m in K.README_TEMPLATE_MARKERS:
        out = out | r.contains(m)
    return out


def readme_passes(readme: Column | str, min_sections: int = K.README_MIN_SECTIONS) -> Column:
    """README quality: no template marker, enough sections, a code fence."""
    r = col(readme)
    ok = ~has_template_marker(r) & (readme_sections(r) >= min_sections) & has_code_fence(r)
    return F.coalesce(ok, F.lit(False))


def generic_phrase_flag(text: Column | str) -> Column:
    t = col(text)
    out = F.lit(False)
    for p in K.GENERIC_PHRASES:
        out = out | t.contains(p)
    return out


def template_placeholder_flag(text: Column | str) -> Column:
    t = col(text)
    out = F.lit(False)
    for p in K.TEMPLATE_PLACEHOLDERS:
        out = out | t.contains(p)
    return out


def filler_opening_flag(text: Column | str) -> Column:
    """Starts (after stripping) with a filler phrase."""
    s = py_strip(text)
    out = F.lit(False)
    for p in K.FILLER_OPENINGS:
        out = out | (F.left(s, F.lit(len(p))) == F.lit(p))
    return out


def license_name(text: Column | str) -> Column:
    """First matching license of LICENSE_RULES, else 'unknown'."""
    t = F.coalesce(col(text), F.lit(""))
    expr = None
    for name, _family, pattern in K.LICENSE_RULES:
        cond = t.rlike("(?iu)" + pattern)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit("unknown"))


def license_family(name: Column | str) -> Column:
    """Family of a license name; the name is evaluated once, whatever it is computed from."""
    from .text import let

    def body(n: Column) -> Column:
        expr = None
        for lic, family, _pattern in K.LICENSE_RULES:
            expr = F.when(n == lic, F.lit(family)) if expr is None else expr.when(n == lic, F.lit(family))
        return expr.otherwise(F.lit("unknown"))

    return let(col(name), body)


def has_bullets(text: Column | str) -> Column:
    """A line that starts (after spaces) with '-', '*' or 'N.' followed by a space."""
    return F.coalesce(col(text).rlike(r"(?m)^[ \t]*(?:[-*]|[0-9]+\.)[ \t]"), F.lit(False))


def first_line(text: Column | str) -> Column:
    return F.substring_index(col(text), "\n", 1)


def short_first_line(text: Column | str, max_chars: int = 120) -> Column:
    """[decision] The first line is a one-line description: 1..max_chars code points."""
    n = F.length(py_strip(first_line(text)))
    return F.coalesce((n >= 1) & (n <= max_chars), F.lit(False))


def language_tokens(text: Column | str) -> Column:
    """Lower-cased letter runs (split on anything that is not a letter)."""
    return F.split(F.lower(F.coalesce(col(text), F.lit(""))), r"[^\p{L}]+")


def stopword_hits(tokens: Column, lang: str) -> Column:
    words = K.STOPWORDS[lang]
    return F.size(F.filter(tokens, lambda t: t.isin(words))).cast("bigint")


def stopwords_of(tokens: Column) -> Column:
    """The tokens that are a stopword of any language: the one pass over all tokens (a
    hash set); counts by language then go over these few."""
    words = sorted({w for listed in K.STOPWORDS.values() for w in listed})
    return F.filter(tokens, lambda t: t.isin(words))


def detect_language(text: Column | str) -> Column:
    """[decision] Language with the most stopword hits (en, de, fr, es order on
    ties); 'unknown' without any hit."""
    from .text import let

    def pick(h: Column) -> Column:
        en, de, fr, es = (h[i] for i in range(4))
        best = F.array_max(h)
        return (F.when(best == 0, F.lit("unknown"))
                .when(en == best, F.lit("en")).when(de == best, F.lit("de"))
                .when(fr == best, F.lit("fr")).otherwise(F.lit("es")))

    def body(tokens: Column) -> Column:
        return let(F.array(*(stopword_hits(tokens, x) for x in ("en", "de", "fr", "es"))), pick)

    return let(stopwords_of(language_tokens(text)), body)


# shapes of a line after trimming, in the order they are tried; blank lines have none
HEADING = "^#{1,6}[ \t]"
LINE_SHAPES = [("`", "^```"), ("-", "^(?:[-*+]|[0-9]+[.)])[ \t]"), ("|", "^[|]")]
PROSE_SHAPE = "."


def skeleton(text: Column | str) -> Column:
    """The form of a Markdown text: its headings (lower case, digits as 0) and, between
    them, the shapes of the lines (fence, list, table, prose), each run of one shape
    once; a line each.  Null for null, empty for a text without lines."""

    def shape(line: Column) -> Column:
        expr = F.when(line == "", F.lit("")).when(line.rlike(HEADING), F.lower(F.regexp_replace(line, "[0-9]+", "0")))
        for mark, pattern in LINE_SHAPES:
            expr = expr.when(line.rlike(pattern), F.lit(mark))
        return expr.otherwise(F.lit(PROSE_SHAPE))

    lines = F.transform(F.split(col(text), "\n"), lambda x: F.trim(F.regexp_replace(x, "[\t\r]", " ")))
    shapes = F.filter(F.transform(lines, shape), lambda x: x != "")
    out = F.concat(F.array_join(shapes, "\n"), F.lit("\n"))
    for mark in [m for m, _ in LINE_SHAPES] + [PROSE_SHAPE]:
        out = F.regexp_replace(out, f"(?m)(?:^[{mark}]\n)+", f"{mark}\n")
    return out


def skeleton_headings(form: Column | str) -> Column:
    """Number of headings of a skeleton."""
    return F.regexp_count(col(form), F.lit("(?m)" + HEADING)).cast("bigint")

"""Column functions reproduce Python string semantics (property tests)."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.functions.quality import is_quality_doc
from quarry.functions.text import PY_WHITESPACE, clean_text, has_min_words, py_strip, word_count

ALPHABET = list(PY_WHITESPACE) + list("abcXYZ.@ ") + ["\n", "é", "ſ", "TODO", "..."]
texts = st.lists(st.lists(st.sampled_from(ALPHABET), max_size=25).map("".join), min_size=1, max_size=60)


def test_whitespace_set_is_python_isspace():
    import sys

    assert sorted(PY_WHITESPACE) == sorted(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())


@settings(max_examples=5, deadline=None)
@given(texts)
def test_strip_clean_words(spark, batch):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(batch)], "i int, t string")
    rows = df.select("i", py_strip("t").alias("s"), clean_text("t").alias("c"), word_count("t").alias("w"),
                     has_min_words("t", 3).alias("m3")).collect()
    got = {r.i: r for r in rows}
    for i, t in enumerate(batch):
        r = got[i]
        assert r.s == t.strip()
        # properties of cleaned text: no outer space, no long runs, all words in order
        assert r.c == r.c.strip() and "\n\n\n" not in r.c and "  " not in r.c and r.c.split() == t.split()
        assert r.w == len(t.split())
        assert r.m3 == (len(t.split()) >= 3)


def test_clean_examples(spark):
    cases = {
        None: "", "": "", "  a  b ": "a b", "a\n\n\n\nb": "a\n\nb", "a\n\nb": "a\n\nb", "a\n \n\nb": "a\n \n\nb",
        "x     y\n\n\nz\t": "x y\n\nz", " \n ": "", "a\tb": "a\tb",
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: r.c for r in df.select("t", clean_text("t").alias("c")).collect()} == cases


def test_quality_examples(spark):
    cases = {
        None: False, "": False, "short": False, "TODO later fix this": False, "\n  fixme later x y": False,
        "@param x the input value": False, "a b c       ": True, "ab cd ef g": True, "one two x": False,
        "todoist client app": False, "...\nthree word body": True, "Not a TODO at all": True,
        "   No description available here": False,
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r.t: r.q for r in df.select("t", is_quality_doc("t").alias("q")).collect()}
    assert got == cases


def test_token_and_ratio(spark):
    from quarry.functions.text import non_ascii_ratio, token_count

    df = spark.createDataFrame([("def f(x): return x+1",), ("héllo",), ("",)], "t string")
    rows = df.select(token_count("t").alias("n"), non_ascii_ratio("t").alias("r")).collect()
    assert [r.n for r in rows] == [10, 3, 0]  # "h", "é", "llo": accented letters count alone
    assert [round(r.r, 3) for r in rows] == [0.0, 0.2, 0.0]
    assert F is not None


def test_words_counted_and_base64_cleaned_without_matching(spark):
    """Splits and translations, equal to the patterns they stand for."""
    import random

    from quarry.functions.text import NON_WS, WS, one_spaced, word_count
    from quarry.operators.repos import decode_base64_text

    rng = random.Random(2)
    texts = ["".join(rng.choices("ab \t\n\xa0\u3000\x1c\u200b", k=rng.randint(0, 9))) for _ in range(500)] + ["", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    same = word_count("t").eqNullSafe(F.regexp_count("t", F.lit(f"{NON_WS}+")).cast("bigint")) & one_spaced("t").eqNullSafe(F.regexp_replace("t", f"{WS}+", " "))
    assert df.filter(~same).count() == 0
    plan = df.select(word_count("t"), decode_base64_text("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan

"""Source divergence against a dense computation over every term and pair of sources."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
from llm_cases import SCHEMA, row

from quarry.llm import divergence, registry

SMALL = "/root/testdata/sf0.001"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def dense(docs, top=divergence.TOP_TERMS):
    tf, df, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in docs:
        lang, source = lang or "", source or ""
        terms = [t.translate(FOLD) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        sources[lang].add(source)
        tf[lang, source].update(terms)
        df[lang].update(set(terms))
    out = set()
    for lang, group in sources.items():
        kept = sorted(t for t, n in df[lang].items() if n >= 3)

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // (total + len(kept)) for t in kept}

        p = {s: shares(tf[lang, s]) for s in group}
        whole = shares(sum((tf[lang, s] for s in group), Counter()))
        for s in group:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in group if o != s]
            terms = [(t, (p[s][t] - whole[t]) ** 2 // whole[t]) for t in kept if tf[lang, s][t] and p[s][t] > whole[t]]
            for part, items, last in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:last]
                out |= {(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(ranked)}
    return out


def collected(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def corpus():
    rng = random.Random(5)
    words = ["Aa", "bÉ", "ço", "d", "ee", "Ünd", "zwei", "x1y", "don't", "naïve"] + [f"w{chr(97 + i)}" for i in range(26)]
    rows = [row(i, " ".join(rng.choices(words, k=rng.randint(0, 30))), rng.choice(["en", "de", None]), rng.choice(["s0", "s0", "s1", "S2", None, "é"])) for i in range(120)]
    rows += [row(7, "repeated row here aa", "en", "s1")] * 4 + [row(None, None, "en", "silent"), row(None, "", None, None), row(1, "alone words", "one", "a"), row(2, "", "one", "b")]
    rows += [row(900, "aa " * 3000 + "bb", "en", "long"), row(901, "x" * 100_000 + " aa", "en", "long"), row(902, "x" * 100_000, "en", "s0"), row(903, "x" * 100_000, "de", "s0")]
    return rows


def test_equal_to_the_dense_sum(spark, monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 500)
    monkeypatch.setattr(divergence, "HELD", 50)
    rows = corpus()
    got = collected(divergence.divergence(spark.createDataFrame(rows, SCHEMA).repartition(5)))
    assert got == dense([(r[1], r[2], r[3]) for r in rows])


def test_no_documents_and_short_reports(spark, no_docs):
    assert divergence.divergence(no_docs).collect() == []
    rows = corpus()
    got = collected(divergence.divergence(spark.createDataFrame(rows, SCHEMA), top=2))
    assert got == dense([(r[1], r[2], r[3]) for r in rows], top=2)


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    assert collected(registry.QUERIES["op12_term_rows"](spark, SMALL)) == set(con.execute(divergence.ORACLE_SQL).fetchall())


def test_sums_of_corrections_beyond_64_bits():
    rng = random.Random(8)
    rows = [(rng.randrange(5), rng.randint(-(2**61), 2**61), rng.randint(1, 10**9)) for _ in range(2000)]
    want = Counter()
    for key, value, times in rows:
        want[key] += value * times
    assert dict(divergence._sums(*(np.array(c, np.int64) for c in zip(*rows)))) == dict(want)


def test_tree_is_settled_in_parts(spark, monkeypatch):
    monkeypatch.setattr(divergence, "NODES", 3)
    rows = corpus()
    got = collected(divergence.divergence(spark.createDataFrame(rows, SCHEMA)))
    assert got == dense([(r[1], r[2], r[3]) for r in rows])

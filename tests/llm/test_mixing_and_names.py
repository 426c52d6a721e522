"""The mixing solver against a small problem solved directly; columns of any name."""

from collections import Counter

import numpy as np
import pytest
from llm_cases import SCHEMA, cases, prose, row
from pyspark.sql import functions as F

from quarry.llm import mixing, neardup, secrets

CLASHES = ("_row", "_blob", "_found", "_copies", "_key", "_doc", "_nth", "row", "blob", "found", "place", "number", "copies", "key", "n", "fault", "text_key", "n_tokens", "component_id")


def _problem(seed, n=400):
    rng = np.random.default_rng(seed)
    posterior = rng.dirichlet([0.5, 0.4, 0.2], n)
    return posterior, rng.integers(0, 300, n)


def _direct(posterior, tokens, goal, least, rounds=60_000):
    """Projected gradient over the rates themselves, to the end."""
    a = posterior * tokens[:, None]
    r = np.maximum(1.0, least) * np.ones(len(tokens))
    size = 1.0 / np.linalg.eigvalsh((posterior * tokens[:, None]).T @ posterior).max()
    for _ in range(rounds):
        r = np.maximum(least, r - size * (posterior @ (a.T @ r - goal)))
    return a.T @ r


@pytest.mark.parametrize(("targets", "budget", "least", "reached"), [
    ({"high": 0.5, "low": 0.3, "toxic": 0.2}, 1.0, 0.0, True),
    ({"high": 0.8, "low": 0.15, "toxic": 0.05}, 1.0, 0.0, True),
    ({"high": 0.55, "low": 0.28, "toxic": 0.17}, 1.5, 1.0, True),
    # out of reach: the least distance is approached slowly, by ever larger rates of ever fewer rows
    ({"high": 0.7, "low": 0.2, "toxic": 0.1}, 1.5, 1.0, False),
    ({"high": 0.85, "low": 0.15, "toxic": 0.0}, 1.2, 1.0, False),
])
def test_solver_against_the_direct_solution(spark, targets, budget, least, reached):
    posterior, tokens = _problem(3)
    table = spark.createDataFrame([(int(t), [float(x) for x in p]) for p, t in zip(posterior, tokens)], "n_tokens long, posterior array<double>")
    steps, goal, error = mixing.solve(table, targets, budget, least)
    got = np.array(table.select(mixing._rate(steps, least).alias("r")).toPandas()["r"])
    assert got.min() >= least and len(steps) <= mixing.ROUNDS
    totals, scale = (posterior * tokens[:, None]).T @ got, budget * tokens.sum()
    want = _direct(posterior, tokens, goal, least)
    assert abs(np.linalg.norm(totals - goal) / scale - error) < 1e-9
    if reached:
        assert error < mixing.SETTLED and np.linalg.norm(want - goal) < 1e-3 * scale
    else:
        assert mixing.SETTLED < error <= 1.6 * np.linalg.norm(want - goal) / scale


def test_sampled_features_come_from_whole_texts(spark):
    long_text = prose(5, 9000)
    docs = spark.createDataFrame([row(1, long_text), row(1, "other text of the id"), row(2, "few words")], SCHEMA)
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    for _ in range(2):
        got = mixing.sample_labelled(docs.repartition(3), labels)
        assert [g[0] for g in got] == [0, 1]
        places = mixing._Places()
        assert any(np.array_equal(got[0][1], mixing._counts(t.encode(), places)[0]) for t in (long_text, "other text of the id"))


def test_stages_keep_columns_of_any_name(spark):
    table = spark.createDataFrame(cases()[:20], SCHEMA)
    for i, name in enumerate(CLASHES):
        if name not in table.columns:
            table = table.withColumn(name, F.concat(F.lit(f"{i}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    labels = spark.createDataFrame([(6, 1, 0), (10, 0, 0), (4, 0, 1)], "doc_id long, quality int, toxic int")
    others = [c for c in table.columns if c not in ("text", "n_chars")]
    before = Counter(tuple(r) for r in table.select(*others).collect())
    kept = neardup.keep_one(table)
    assert kept.columns == table.columns and not Counter(tuple(r) for r in kept.select(*others).collect()) - before
    clean = secrets.redact(table)
    assert clean.columns == table.columns and Counter(tuple(r) for r in clean.select(*others).collect()) == before
    mixed = mixing.mix(table, labels, least=1.0)
    assert mixed.columns == table.columns and set(Counter(tuple(r) for r in mixed.select(*others).collect())) == set(before)

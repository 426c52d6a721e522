"""Scoring, classification, encoding and rules against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from llm_cases import SCHEMA, cases, prose, row
from pyspark.sql import functions as F

from quarry.llm import bpe, langid, lm, mixing, quality, toxicity


def remainder(doc_id, m):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % m


def test_deleted_interpolation_matches_brute_force(spark, docs, no_docs, monkeypatch):
    weights = [[0.0, 0.7, 0.3]] + [[0.5, 0.3, 0.2]] * (lm.BUCKETS - 1)
    learned = lm.learn_weights
    seen = []
    monkeypatch.setattr(lm, "learn_weights", lambda *a: seen.append(learned(*a)) or weights)
    got = Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in lm.score(docs).collect())
    one, two = Counter(), Counter()
    texts = [(r[0], ["^", *(r[1] or "").encode().lower().split(), "$"]) for r in cases()]
    for i, t in texts:
        if remainder(i, 7) != 2:
            one.update(t[1:])
            two.update(zip(t, t[1:], strict=False))
    one["^"] = one["$"]
    n, v = sum(c for w, c in one.items() if w != "^"), len(one) - 1
    want = Counter()
    for i, t in texts:
        base = sum(math.log10((one[w] + 1) / (n + v + 1)) for w in t[1:])
        score = 0.0
        for a, b in zip(t, t[1:], strict=False):
            w = weights[1 if one[a] else 0]
            score += math.log10(w[0] * two[a, b] / max(one[a], 1) + w[1] * one[b] / n + w[2] / (v + 1))
        want[i, remainder(i, 7) == 2, len(t) - 1, sum(one[w] > 0 for w in t[1:]), n, round(base, 6), round(score, 6)] += 1
    assert got == want
    for w in seen[0]:
        assert abs(sum(w) - 1) < 0.01 and min(w) >= 0
    assert lm.score(no_docs).count() == 0


def test_toxicity_separates_and_takes_all_cases(spark, docs, no_docs):
    bad = "stupidhead worthlessfool disgustingrat".split()
    rows = [row(1000 + i, prose(i, 60) + (" " + " ".join(bad[(i + k) % 3] for k in range(4)) if i % 4 == 0 else "")) for i in range(160)]
    table = spark.createDataFrame(rows, SCHEMA).unionByName(docs)
    labels = spark.createDataFrame([(r[0], 1, int(i % 4 == 0)) for i, r in enumerate(rows)] + [(None, 1, 1), (1000, 1, None), (1, 1, 0)], "doc_id long, quality int, toxic int")
    model = toxicity.train(table, labels)
    got = toxicity.score(table, model).collect()
    assert len(got) == table.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id >= 1000]
    assert all(r.held_out == (remainder(r.doc_id, 3) == 1) for r in got)
    right = sum(r.predicted == int((r.doc_id - 1000) % 4 == 0) for r in held) / len(held)
    assert right >= 0.95
    kept = toxicity.drop_toxic(table, model)
    assert kept.schema == table.schema and kept.count() == sum(1 - r.predicted for r in got)
    none = toxicity.train(table, labels.filter("toxic = 0"))
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.0}
    assert toxicity.score(no_docs, toxicity.train(no_docs, labels.limit(0))).count() == 0


def test_toxicity_learns_what_follows_a_telling_run(spark):
    # half of the toxic texts hold a word of their own, half use one opening often that
    # over a quarter of the ordinary texts hold too
    rng = random.Random(3)
    parts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(4)) for _ in range(30)]

    def text(kind: int) -> bytes:
        words = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(300)]
        for i in range(0, 300, 25) if kind < 2 else ():
            words[i] = "worthlessfool" if kind else parts[0] + parts[1] + rng.choice(parts)
        return " ".join(words).encode()

    rows = [(i, text(i % 10), int(i % 10 < 2)) for i in range(1500)]
    model = toxicity.fit(spark.createDataFrame(rows[:1200], "doc_id long, text binary, toxic int"))
    windows = toxicity.Windows(model.ordinary, model.toxic, model.gain)
    got = [toxicity.score_text(t, windows, model)[0] >= toxicity.CUTOFF for _, t, _ in rows[1200:]]
    assert sum(g == bool(y) for g, (_, _, y) in zip(got, rows[1200:], strict=True)) >= 290


def test_toxicity_equals_brute_force_and_takes_whole_texts(spark):
    import zstandard as zs

    bad = "stupidhead worthlessfool disgustingrat".split()
    # the marks stand at the very end of texts of 40 KB: no prefix shows them
    rows = [row(i, prose(i, 80 if i % 10 else 7000) + (" " + " ".join(bad[(i + k) % 3] for k in range(5)) if i % 3 == 0 else "")) for i in range(200)]
    again = [row(0, "another text of a labelled id"), row(3, None)]
    table = spark.createDataFrame(rows + again, SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(200)], "doc_id long, toxic int")
    model = toxicity.train(table, labels)
    assert toxicity.train(table.repartition(5), labels) == model
    params = zs.ZstdCompressionParameters(
        window_log=17, hash_log=16, chain_log=16, search_log=6, min_match=toxicity.MIN_MATCH, target_length=64,
        strategy=zs.STRATEGY_LAZY2, write_content_size=False, write_checksum=False, write_dict_id=False)

    def length(content, window):
        held = zs.ZstdCompressionDict(content, dict_type=zs.DICT_TYPE_RAWCONTENT)
        return len(zs.ZstdCompressor(dict_data=held, compression_params=params).compress(window))

    gains = {}

    def toxic_window(w):
        if w not in gains:
            windows = [model.ordinary[-n:] + b" " + w + b" " + toxicity.PAD for n in toxicity.PRIMERS]
            gains[w] = sum(length(model.ordinary, x) - length(model.toxic + model.ordinary, x) for x in windows)
        return gains[w] >= model.gain

    got = sorted((r.doc_id, r.n_windows, r.n_toxic_windows, round(r.score, 9)) for r in toxicity.score(table, model).collect())
    want = []
    for i, text, *_ in rows[1:60] + again:
        words = (text or "").lower().encode().split()
        hits = sum(map(toxic_window, words))
        a, b, c = model.weights
        z = a + b * min(100 * hits / (len(words) + toxicity.SMOOTH), 5) + c * math.log1p(hits)
        want.append((i, len(words), hits, round(1 / (1 + math.exp(-z)), 9)))
    assert not Counter(want) - Counter(got) and len(got) == 202
    long = [r for r in got if r[0] % 10 == 0 and r[1] > 5000]
    assert len(long) == 20 and all((r[2] >= 5) == (r[0] % 3 == 0) for r in long)


def test_encoding_equals_the_tokenizer(spark, docs, no_docs):
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(bpe.default_vocabulary())
    want = Counter()
    for r in cases():
        ids = reference.encode(r[1] or "", add_special_tokens=False).ids
        text = reference.decode(ids, skip_special_tokens=False)
        want[r[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += 1
    for size in (0, 50, 10_000):
        assert Counter(map(tuple, bpe.roundtrip(docs, size=size).collect())) == want
    assert bpe.roundtrip(no_docs).count() == 0


def test_split_patterns_agree_with_the_tokenizer():
    from tokenizers import Tokenizer

    reference, split, vocab = Tokenizer.from_file(bpe.default_vocabulary()), bpe.splitter(), bpe.Vocabulary.load(bpe.default_vocabulary())
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000][:: 37] + list(range(0x300))
    texts = [f"a{chr(c)}b1{chr(c)}2 {chr(c)}!{chr(c)}?" for c in points]
    for text, want in zip(texts, reference.encode_batch(texts, add_special_tokens=False), strict=True):
        packed = b"".join(vocab.merge_all([w.encode() for w in split(text)]))
        assert np.frombuffer(packed, "<u4").tolist() == want.ids


def test_quality_counts(spark, docs, no_docs):
    space = "[\x20\x09-\x0d]+"
    want = Counter()
    for r in cases():
        text = r[1] or ""
        words = [w for w in re.split(space, text) if w]
        lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        often = Counter(windows)
        covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
        n = len(words)
        failed = n < 10 or 100 * len(covered) > 20 * n
        want[r[0], n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed] += 1
    got = quality.judge(docs)
    assert Counter(tuple(r)[:7] for r in got.collect()) == want
    assert got.filter("base_failed and kept").count() == 0
    assert quality.judge(no_docs).count() == 0
    plan = quality.judge(no_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_language_of_held_out_texts(spark, docs, no_docs):
    got = {r.doc_id: r for r in langid.predict(docs, langid.train(docs)).collect()}
    for i in range(60):
        r = got[100 + i]
        assert r.held_out == (remainder(r.doc_id, 5) == 0)
        assert r.lang_pred == ("de" if i % 3 == 0 else "en") and 0 <= r.score <= 1
    assert {got[i].lang_pred for i in (1, 2, 3, 14)} == {"und"}
    assert {r.lang_pred for r in langid.predict(docs, langid.train(no_docs)).collect()} == {"und"}
    assert langid.predict(no_docs, None).count() == 0


def test_mixing_meets_targets(spark, docs, no_docs):
    labels = spark.createDataFrame([(100 + i, i % 2, int(i % 5 == 0)) for i in range(60)] + [(None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    targets = {"high": 0.5, "low": 0.3, "toxic": 0.2}
    rows = mixing.rates(docs, labels, targets).collect()
    assert len(rows) == docs.count() and all(r.rate >= 0 and r.copies in (math.floor(r.rate), math.floor(r.rate) + 1) for r in rows)
    total = sum(r.n_tokens for r in rows)
    for d in mixing.DOMAINS:
        assert abs(sum(r.rate * r.n_tokens * r[f"p_{d}"] for r in rows) / total - targets[d]) < 2e-3
    mixed = mixing.mix(docs, labels, targets, least=1.0)
    assert mixed.columns == docs.columns
    assert {r.doc_id for r in mixed.select("doc_id").collect()} == {r[0] for r in cases()}
    assert mixing.rates(no_docs, labels).count() == 0
    assert mixing.mix(docs, labels.limit(0)).count() > 0


def test_mixing_copies_follow_each_row(spark, monkeypatch):
    texts = [prose(900 + i, 30 + i) for i in range(40)]
    rows = [row(None, t) for t in texts] + [row(7, t + " seven") for t in texts]
    table = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    # copies by a rule on the tokens alone stand for rates of different posteriors
    monkeypatch.setattr(mixing, "solve", lambda *a: ([], None, 0.0))
    monkeypatch.setattr(mixing, "_copies", lambda rate, key: (F.col("n_tokens") % 3 + 1).cast("int"))
    got = Counter((r.doc_id, r.text) for r in mixing.mix(table, labels).collect())
    assert got == Counter({(r[0], r[1]): len(r[1].split()) % 3 + 1 for r in rows})

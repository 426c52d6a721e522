"""Mixing a corpus to target weights with soft domain membership.

A classifier fitted on labelled documents gives each document its posterior
over the domains.  Document rates (expected copies, at least ``least``) are the
result of projected-gradient least squares: they make the expected token totals
of the domains, sum of rate * tokens * posterior, match the target totals.

The classifier is a multinomial logistic regression on hashed words and counts
of marks, fitted on a bounded sample of the labelled rows.  Posteriors of all
documents are written once as a narrow table.  A gradient needs only one sum per
domain from it, and steps are taken in the metric of the documents' tokens, so
that a document's rate depends on its posterior alone: every round recomputes
the rates from the few steps so far, stores nothing per document, and survives a
lost executor like any other job.

A step is scaled by the Gram matrix of the documents that are off their bound
(summed in the same round), which lands on the targets at once if no rate is
clipped; a step that does not lower the error is halved, and where that fails too
a plain gradient step of safe size is taken.  A few rounds settle it; the error
that remains, 0 if the targets can be met, is returned.

Domains are ``high`` (quality 1), ``low`` (quality 0) and ``toxic`` (toxic 1,
whatever the quality), as the labels table marks them.

Cases: a null or empty text has no tokens, and its rate moves no total; without
labelled rows all posteriors are uniform; targets of domains without mass stay
unmet as far as they must (least squares); a repeated row counts as often as it
stands; a null doc_id is a document like any other; of rows that repeat a labelled
doc_id the text of smallest hash is learnt from; texts of any length are read whole,
also in the sample, of which only features travel; extra columns are ignored by
``rates`` and kept by ``mix``, whatever their names.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm import common

DOMAINS = ("high", "low", "toxic")
TARGETS = {"high": 0.80, "low": 0.15, "toxic": 0.05}  # shares of the tokens after mixing
SAMPLE = 2500  # labelled rows of each domain learnt from, at most
FEATURES = 1 << 14
ROUNDS, SETTLED = 20, 1e-4
HALVINGS = 2
MEMO = 300_000
STEP = 0.5
MARKS = b"|#*%$&<>!"

POSTERIOR = "doc_id long, text_key long, n_tokens long, posterior array<double>"


class _Places(dict):
    """Maps a word to its place among the features."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= MEMO:
            self.clear()
        place = self[word] = xxhash.xxh3_64_intdigest(word) % FEATURES
        return place


def _counts(text: bytes | None, places: _Places) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct places, their weights and the number of words of a text."""
    words = (text or b"").lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.int64), np.empty(0), 0
    at, times = np.unique(np.fromiter(map(places.__getitem__, words), np.int64, n), return_counts=True)
    weight = times / np.sqrt(float((times.astype(np.float64) ** 2).sum()))
    marks = np.array([min(text.count(bytes([m])) / n, 1.0) for m in MARKS])
    repeated = 1.0 - len(at) / n
    return np.concatenate([at, FEATURES + np.arange(len(MARKS) + 1)]), np.concatenate([weight, marks, [repeated]]), n


WIDTH = FEATURES + len(MARKS) + 1


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], rounds: int = 50) -> np.ndarray | None:
    """Weights (WIDTH + 1 by domains) of (domain, places, values) rows; None without any."""
    if not rows:
        return None
    at = np.concatenate([r[1] for r in rows])
    value = np.concatenate([r[2] for r in rows])
    row = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
    label = np.array([r[0] for r in rows])
    target = np.eye(len(DOMAINS))[label]
    share = 1.0 / np.maximum(np.bincount(label, minlength=len(DOMAINS)), 1)[label]  # domains count alike
    share /= share.sum()
    w, travelled = np.zeros((WIDTH + 1, len(DOMAINS))), np.full((WIDTH + 1, len(DOMAINS)), 1e-12)
    for _ in range(rounds):  # full-batch gradient with a step of its own for each weight
        z = np.stack([np.bincount(row, value * w[at, k], minlength=len(rows)) for k in range(len(DOMAINS))], axis=1) + w[-1]
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        miss = (p - target) * share[:, None]
        grad = np.vstack([np.stack([np.bincount(at, value * miss[row, k], minlength=WIDTH) for k in range(len(DOMAINS))], axis=1), miss.sum(axis=0)])
        grad += 1e-6 * w
        travelled += grad**2
        w -= STEP * grad / np.sqrt(travelled)
    prior = np.log(np.maximum(np.bincount(label, minlength=len(DOMAINS)), 0.5) / len(label))
    w[-1] += prior - prior.mean()  # back to the domains' own frequencies
    return w


def sample_labelled(docs: DataFrame, labels: DataFrame, each: int = SAMPLE) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """The bounded sample: domain and features (at most ``WIDTH``) of at most ``each`` rows
    of a domain, computed from whole texts where these are."""
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"), F.col("toxic").cast("int").alias("toxic"))
        .groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
        .filter("doc_id is not null and coalesce(toxic, quality) is not null")
        .select("doc_id", F.expr("CASE WHEN toxic = 1 THEN 2 WHEN quality = 1 THEN 0 WHEN quality = 0 THEN 1 END").alias("domain"))
    )
    picked = None
    for k in range(len(DOMAINS)):
        part = marks.filter(F.col("domain") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(each)
        picked = part if picked is None else picked.unionAll(part)
    # at most 3 * each rows of two numbers: small enough to broadcast
    texts = common.narrow(docs, doc_id="long", text="string").join(F.broadcast(picked), "doc_id")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = _Places()
        for b in batches:
            found = [_counts(t, places)[:2] for t in b.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("domain"), b.column("text_key"), pa.array([f[0].astype(np.int32).tobytes() for f in found], pa.binary()),
                 pa.array([f[1].tobytes() for f in found], pa.binary())], ["doc_id", "domain", "text_key", "at", "value"])

    keyed = texts.select("doc_id", "domain", _text_key(F.col("text")).alias("text_key"), "text")
    got = (
        keyed.mapInArrow(features, "doc_id long, domain int, text_key long, at binary, value binary")
        .groupBy("doc_id").agg(F.min_by(F.struct("domain", "at", "value"), "text_key").alias("f")).select("doc_id", "f.*").toArrow().to_pylist()
    )
    return [(r["domain"], np.frombuffer(r["at"], np.int32), np.frombuffer(r["value"], np.float64)) for r in sorted(got, key=lambda r: r["doc_id"])]


def _text_key(text: Column) -> Column:
    return F.xxhash64(text.cast("string"))


def posteriors(docs: DataFrame, weights: np.ndarray | None) -> DataFrame:
    """doc_id, a hash of the text, n_tokens (words) and posterior of every document."""
    held = docs.sparkSession.sparkContext.broadcast(None if weights is None else weights.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, places = held.value, _Places()
        for b in batches:
            texts = b.column("text").cast(pa.binary()).to_pylist()
            out, n = np.full((len(texts), len(DOMAINS)), 1.0 / len(DOMAINS)), []
            for i, text in enumerate(texts):
                at, value, words = _counts(text, places)
                n.append(words)
                if w is not None:
                    z = (value @ w[at] if len(at) else 0.0) + w[-1].astype(np.float64)
                    p = np.exp(z - z.max())
                    out[i] = p / p.sum()
            flat = pa.array(out.ravel())
            ends = pa.array(np.arange(len(texts) + 1, dtype=np.int32) * len(DOMAINS))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_key"), pa.array(n, pa.int64()), pa.ListArray.from_arrays(ends, flat)], ["doc_id", "text_key", "n_tokens", "posterior"],
            )

    return common.narrow(docs, doc_id="long", text="string").withColumn("text_key", _text_key(F.col("text"))).mapInArrow(run, POSTERIOR)


def _rate(steps: list[tuple[float, ...]], least: float) -> Column:
    """The rate after the steps, as one expression of the posterior."""
    rate = F.greatest(F.lit(1.0), F.lit(float(least)))
    for step in steps:
        fall = F.lit(0.0)
        for k, s in enumerate(step):
            fall = fall + F.lit(float(s)) * F.col("posterior")[k]
        rate = F.greatest(F.lit(float(least)), rate - fall)
    return rate


def solve(table: DataFrame, targets: dict[str, float], budget: float, least: float) -> tuple[list[tuple[float, ...]], np.ndarray, float]:
    """Steps of the projected gradient, the target totals and the remaining error: the
    distance of the domains' expected totals from them, as a share of all target tokens.

    Minimises half the squared distance of the domains' expected totals from
    budget * tokens * target share, over rates of at least ``least``."""
    many = range(len(DOMAINS))
    pairs = [(i, j) for i in many for j in range(i, len(DOMAINS))]
    p = [F.col("posterior")[k] for k in many]
    n = F.col("n_tokens").cast("double")

    def measure(steps: list[tuple[float, ...]]) -> tuple[np.ndarray, np.ndarray, tuple[float, float]]:
        """After the steps: totals, the Gram matrix of the documents off their bound, and
        the number of tokens with the largest eigenvalue of the whole Gram matrix."""
        rated = table.select("n_tokens", "posterior", _rate(steps, least).alias("r"))
        free = F.when(F.col("r") > float(least), n).otherwise(0.0)
        at = rated.agg(
            F.sum(n).alias("all"), *[F.sum(n * p[k] * F.col("r")).alias(f"s{k}") for k in many],
            *[F.sum(free * p[i] * p[j]).alias(f"g{i}{j}") for i, j in pairs], *[F.sum(n * p[i] * p[j]).alias(f"h{i}{j}") for i, j in pairs]).first()
        value = {k: float(v or 0.0) for k, v in at.asDict().items()}
        square = lambda c: np.array([[value[f"{c}{min(i, j)}{max(i, j)}"] for j in many] for i in many])
        gram, whole = square("g"), square("h")
        # at first all may stand on their bound: then all are free to rise
        gram = gram if np.trace(gram) > 0 else whole
        return np.array([value[f"s{k}"] for k in many]), gram, (value["all"], float(np.linalg.eigvalsh(whole).max()))

    totals, gram, (tokens, size) = measure([])
    share = np.array([targets.get(d, 0.0) for d in DOMAINS])
    goal = budget * tokens * share / max(share.sum(), 1e-12)
    scale = budget * tokens
    if scale == 0 or size == 0:
        return [], goal, 0.0
    steps: list[tuple[float, ...]] = []
    miss = totals - goal
    error, halved = float(np.linalg.norm(miss)) / scale, 0
    for _ in range(ROUNDS):
        if error < SETTLED:
            break
        if halved <= HALVINGS:
            # directions without mass off the bound move nothing and are left out
            step = np.linalg.pinv(gram, rcond=1e-9, hermitian=True) @ miss / 2**halved
        else:
            step = miss / size
        tried, tried_gram, _ = measure([*steps, tuple(step)])
        new = float(np.linalg.norm(tried - goal)) / scale
        if new >= error * (1 - 1e-3):
            if halved > HALVINGS:
                break  # a safe step no longer helps: the targets are out of reach
            halved += 1
            continue
        steps.append(tuple(step))
        miss, gram, error, halved = tried - goal, tried_gram, new, 0
    return steps, goal, error


def _table(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return common.stash(posteriors(docs, fit(sample_labelled(docs, labels))), "posteriors")


def _copies(rate: Column, key: Column) -> Column:
    """Whole copies: the rate rounded up or down by a hash, true to it on average."""
    draw = F.pmod(F.xxhash64(F.lit("copies"), key), F.lit(1 << 40)) / float(1 << 40)
    return F.floor(rate + draw).cast("int")


def _solved(table: DataFrame, targets: dict[str, float], budget: float, least: float) -> list[tuple[float, ...]]:
    """The steps; targets that stay out of reach are logged."""
    steps, _, error = solve(table, targets, budget, least)
    if error >= SETTLED:
        logging.getLogger(__name__).warning("the mix misses its targets by %.4f of the tokens", error)
    return steps


def rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, budget: float = 1.0, least: float = 0.0) -> DataFrame:
    """doc_id, n_tokens, posterior of each domain, rate and copies of every document."""
    table = _table(docs, labels)
    steps = _solved(table, targets, budget, least)
    rated = table.select("*", _rate(steps, least).alias("rate"))
    return rated.select(
        "doc_id", "n_tokens", *[F.col("posterior")[k].alias(f"p_{d}") for k, d in enumerate(DOMAINS)], "rate",
        _copies(F.col("rate"), F.struct("doc_id", "text_key")).alias("copies"), "text_key",
    )


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, budget: float = 1.0, least: float = 0.0) -> DataFrame:
    """The documents, each as often as its copies say, with all their columns."""
    table = _table(docs, labels)
    steps = _solved(table, targets, budget, least)
    # one line for each document and text: rows of one doc_id, or without any, may differ in text
    plan = (
        table.select("doc_id", "text_key", _copies(_rate(steps, least), F.struct("doc_id", "text_key")).alias("copies"))
        .groupBy("doc_id", "text_key").agg(F.max("copies").alias("copies"))
    )
    rows = common.packed(docs).select("row", F.col("row.doc_id").cast("long").alias("id"), _text_key(F.col("row.text")).alias("key"))
    joined = rows.join(plan.hint("shuffle_hash"), rows["id"].eqNullSafe(plan["doc_id"]) & (rows["key"] == plan["text_key"]))
    return joined.filter("copies > 0").select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")

"""Toxicity by compression distance.

Two Zstandard dictionaries are trained, one on ordinary and one on toxic text.
A text is cut into word windows; a window's *gain* is the number of bytes by
which the toxic dictionary compresses it shorter than the ordinary one.  A
window counts as toxic when its gain reaches a threshold, and a logistic curve
over the share and number of such windows is the text's score.  Threshold and
curve are calibrated with dictionaries of two thirds of the labelled rows on the
other third, and those dictionaries are the ones in use: gains are whole bytes and
shift by one or two between dictionaries, so others would need thresholds of their own.

Details that make window lengths comparable:

* The toxic dictionary holds the ordinary content after its own, so ordinary
  matches cost the same under both and a gain can only come from toxic content.
* Toxic training text is the words of toxic documents that hold a byte run which
  is significantly more frequent there than in ordinary documents; whole words,
  so that what follows the run is learnt as well.  A window is one word.
* Every window is compressed between a primer (the end of the ordinary content)
  and a fixed pad, so a short word meets the block header cost already paid.  Lengths
  are whole bytes; a gain is the sum under primers of several lengths, which end at
  different bits, so that rounding decides less.
* The shortest match is ``MIN_MATCH`` bytes, so a window that shares no run of
  that length with the toxic content has gain 0 and needs no compression.

Learning uses a bounded sample: at most ``max_toxic`` and ``max_ordinary``
labelled documents, those with the smallest id hashes.  Their whole texts stay on
the executors, which count runs, cut dictionary pieces and measure the windows of
the calibration; the driver gets the telling runs (``MAX_RUNS`` with the most
evidence), at most ``PIECES`` pieces of a class (those with the smallest
checksums, no longer than four times a piece's length) and four numbers a sampled
document.  Scoring reads every whole text.

Cases: a null or empty text has no windows and gets the curve's value at zero; a
repeated row is scored like any other; without labels of both classes, every
score is 0.0; conflicting labels of one document count as toxic; of different
texts under one labelled id, the one with the smallest hash teaches; null labels
and rows without an id teach nothing; a very long text is read whole by one task,
word by word; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import common

MAX_TOXIC, MAX_ORDINARY = 2000, 8000
MAX_RUNS, PIECES = 20_000, 20_000
TASKS = 24  # files of the written sample
HELD_RUNS = 500_000  # runs a task counts before it passes them on
# chosen by the loss on folds of learnable rows; both must lie within the match window
ORDINARY_BYTES, TOXIC_BYTES = 48 << 10, 2 << 10
MIN_MATCH, PRIMERS = 5, (24, 48, 100, 200)
EVIDENCE = 20.0  # log-likelihood ratio from which a byte run tells the classes apart
PAD = bytes(range(240, 250))
GAINS = tuple(range(5, 19))  # thresholds tried in calibration, in bytes over all primers
SMOOTH = 30.0  # words added to a text's length, so that short texts need real evidence
MEMO = 400_000  # windows remembered per worker before the memo starts anew
CUTOFF = 0.7


@dataclass
class Model:
    """Raw dictionary contents and the calibrated curve; a few tens of kilobytes."""

    ordinary: bytes
    toxic: bytes
    gain: int
    weights: tuple[float, float, float]  # intercept, share, log count
    known: bool = True


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


class Windows(dict):
    """Maps a word window to 1 if its gain reaches the threshold, else 0."""

    def __init__(self, ordinary: bytes, toxic: bytes, gain: int | None):
        import zstandard as zs

        super().__init__()
        self.limit = gain
        own = toxic + b"  "
        self.runs = {own[i : i + MIN_MATCH] for i in range(len(toxic) - MIN_MATCH + 1)}
        self.primers = [ordinary[-n:] for n in PRIMERS]
        params = zs.ZstdCompressionParameters(
            window_log=17, hash_log=16, chain_log=16, search_log=6, min_match=MIN_MATCH, target_length=64,
            strategy=zs.STRATEGY_LAZY2, write_content_size=False, write_checksum=False, write_dict_id=False,
        )

        def packer(content: bytes):
            held = zs.ZstdCompressionDict(content, dict_type=zs.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(compression_params=params)
            return zs.ZstdCompressor(dict_data=held, compression_params=params).compress

        self.plain, self.toxic = packer(ordinary), packer(toxic + ordinary)

    def gain_of(self, word: bytes) -> int:
        padded = b" " + word + b" "
        runs = self.runs
        if not any(padded[i : i + MIN_MATCH] in runs for i in range(len(padded) - MIN_MATCH + 1)):
            return 0
        windows = [primer + padded + PAD for primer in self.primers]
        return sum(len(self.plain(w)) - len(self.toxic(w)) for w in windows)

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        gain = self.gain_of(word)
        value = self[word] = gain if self.limit is None else int(gain >= self.limit)
        return value


def _sigmoid(z: float) -> float:
    return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, z))))


def _features(hits: int, n: int) -> tuple[float, float]:
    return min(100.0 * hits / (n + SMOOTH), 5.0), math.log1p(hits)


def score_text(text: bytes | None, windows: Windows, model: Model) -> tuple[float, int, int]:
    """(score, windows, toxic windows) of one text."""
    words = words_of(text or b"")
    hits = sum(map(windows.__getitem__, words))
    if not model.known:
        return 0.0, len(words), hits
    share, count = _features(hits, len(words))
    a, b, c = model.weights
    return _sigmoid(a + b * share + c * count), len(words), hits


def _train(samples: list[bytes], size: int, **how: int) -> bytes:
    """Content of a dictionary trained on the samples; too little text is used as it is."""
    import zstandard as zs

    whole = b"".join(samples)
    if len(whole) > 4 * size and len(samples) >= 16:
        try:
            trained = zs.train_dictionary(size, samples, **how).as_bytes()
            # entropy tables come first; only the content serves as match history
            return trained[min(300, len(trained) // 4) :]
        except zs.ZstdError:
            pass
    return whole[-size:]


def _cut(words: list[bytes], size: int) -> Iterator[bytes]:
    """Pieces of at least ``size`` bytes; what is over four times that is cut on."""
    held = b""
    for w in [*words, None]:
        held += b"" if w is None else b" " + w
        if held and (w is None or len(held) >= size):
            yield from (held[i : i + 4 * size] for i in range(0, len(held), 4 * size))
            held = b""


def _likeness(words: list[bytes]) -> int:
    """Least checksum of the five-word runs: equal for most near copies."""
    return min((zlib.crc32(b" ".join(words[i : i + 5])) for i in range(max(1, len(words) - 4))), default=0)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> tuple[float, float, float]:
    """Ridge logistic regression by Newton steps (slopes kept nonnegative)."""
    design = np.column_stack([np.ones(len(x)), x])
    w, pull = np.zeros(design.shape[1]), np.array([1e-4, ridge, ridge])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (p - y) + pull * w
        hess = (design * (p * (1 - p) + 1e-9)[:, None]).T @ design + np.diag(pull)
        step = np.linalg.solve(hess, grad)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    w[1:] = np.maximum(w[1:], 0.0)
    return tuple(float(v) for v in w)


def _runs(word: bytes) -> list[bytes]:
    padded = b" " + word + b" "
    return [padded[i : i + MIN_MATCH] for i in range(len(padded) - MIN_MATCH + 1)]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes, int]]:
    for b in batches:
        yield from zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "toxic")), strict=True)


def _telling(learn: DataFrame, sizes: tuple[int, int]) -> list[bytes]:
    """Runs of bytes that toxic documents hold more often than chance allows.

    The rate counts every occurrence, as long ordinary documents hold most runs
    at least once; the evidence counts documents, so that one alone tells nothing.
    ``sizes``: ordinary and toxic documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list[int]] = defaultdict(lambda: [0, 0, 0, 0])

        def flush() -> pa.RecordBatch:
            counts = [pa.array(c, pa.int64()) for c in zip(*held.values(), strict=True)]
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), *counts], ["run", "docs0", "docs1", "times0", "times1"])
            held.clear()
            return out

        for _, text, toxic in _rows(batches):
            words = words_of(text)
            here: Counter = Counter()
            for w, c in Counter(words).items():
                for run in _runs(w):
                    here[run] += c
            here[b""] = len(words)  # all words, under the empty run
            for run, c in here.items():
                row = held[run]
                row[toxic] += 1
                row[2 + toxic] += c
            if len(held) >= HELD_RUNS:
                yield flush()
        if held:
            yield flush()

    names = ["docs0", "docs1", "times0", "times1"]
    found = learn.mapInArrow(count, "run binary, docs0 long, docs1 long, times0 long, times1 long")
    found = found.groupBy("run").agg(*[F.sum(c).alias(c) for c in names])
    with common.temporary_tables(learn.sparkSession):
        found = common.stash(found.filter("docs1 > 0 or run = X''"), "toxic-runs")
        words = found.filter("run = X''").first()
        n0, n1 = sizes
        both, share = F.col("docs0") + F.col("docs1"), n1 / (n0 + n1)
        odds = F.when(F.col("docs0") > 0, F.col("docs0") * F.log(F.col("docs0") / (both * (1 - share)))).otherwise(0.0)
        evidence = 2 * (F.col("docs1") * F.log(F.col("docs1") / (both * share)) + odds)
        more = (F.col("docs1") / n1 > F.col("docs0") / n0) & (F.col("times1") * words.times0 >= 5 * (F.col("times0") + 0.5) * words.times1)
        telling = found.filter("run <> X''").filter(more).select("run", evidence.alias("evidence")).filter(F.col("evidence") >= EVIDENCE)
        return [bytes(r.run) for r in telling.orderBy(F.desc("evidence"), "run").limit(MAX_RUNS).collect()]


def _pieces(learn: DataFrame, toxic: int, size: int, telling: frozenset[bytes] = frozenset()) -> list[bytes]:
    """At most ``PIECES`` pieces of one class, those with the smallest checksums; of words
    that hold a telling run, if runs are given."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def all_pieces() -> Iterator[tuple[int, bytes]]:
            for _, text, label in _rows(batches):
                if label == toxic:
                    words = words_of(text)
                    for p in _cut([w for w in words if not telling.isdisjoint(_runs(w))] if telling else words, size):
                        yield zlib.crc32(p), p

        least = heapq.nsmallest(PIECES, all_pieces())
        yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in least], pa.int64()), pa.array([p for _, p in least], pa.binary())], ["crc", "piece"])

    return [bytes(r.piece) for r in learn.mapInArrow(cut, "crc long, piece binary").orderBy("crc", "piece").limit(PIECES).collect()]


def _dictionaries(learn: DataFrame, sizes: tuple[int, int]) -> tuple[bytes, bytes]:
    """(ordinary, toxic) dictionary contents of labelled rows of both classes."""
    telling = frozenset(_telling(learn, sizes))
    toxic = _train(_pieces(learn, 1, 64, telling), TOXIC_BYTES, k=16, d=6)
    return _train(_pieces(learn, 0, 128), ORDINARY_BYTES, k=50, d=8), toxic


def _measured(check: DataFrame, ordinary: bytes, toxic: bytes) -> list[tuple[int, int, list[int]]]:
    """(label, windows, windows of each of ``GAINS`` or more) of each document."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains, out = Windows(ordinary, toxic, None), []
        for _, text, label in _rows(batches):
            words = words_of(text)
            by = Counter(map(gains.__getitem__, words))
            out.append((label, len(words), [sum(c for g, c in by.items() if g >= least) for least in GAINS]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.list_(pa.int64()))],
            ["toxic", "n", "hits"],
        )

    rows = check.mapInArrow(measure, "toxic int, n long, hits array<long>").collect()
    return sorted((r.toxic, r.n, list(r.hits)) for r in rows)


def fit(sample: DataFrame) -> Model:
    """A model of labelled rows (doc_id, text binary, toxic 0 or 1) of distinct ids.

    Threshold and curve come from one third of the rows under the dictionaries of the
    others.  Of near copies (equal ``_likeness``) only the first trains a dictionary."""

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            like = [_likeness(words_of(t)) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("toxic"), pa.array(like, pa.int64())], ["doc_id", "toxic", "likeness"])

    # three numbers for each row of the bounded sample
    rows = sorted((r.doc_id, r.toxic, r.likeness) for r in sample.mapInArrow(marks, "doc_id long, toxic int, likeness long").collect())
    if len({r[1] for r in rows}) < 2:
        return Model(b"", b"", 1, (0.0, 0.0, 0.0), known=False)
    first = [r for r in rows if zlib.crc32(b"part%d" % r[0]) % 3]
    second = [r for r in rows if not zlib.crc32(b"part%d" % r[0]) % 3]
    first, second = [part if len({r[1] for r in part}) == 2 else rows for part in (first, second)]

    def chosen(part: list[tuple[int, int, int]]) -> DataFrame:
        ids = sample.sparkSession.createDataFrame([(r[0],) for r in part], "doc_id long")
        return sample.join(F.broadcast(ids), "doc_id").select("doc_id", "text", "toxic")  # ids of the bounded sample

    alone = list({(r[2], r[1]): r for r in reversed(first)}.values())
    n1 = sum(r[1] for r in alone)
    ordinary, toxic = _dictionaries(chosen(alone), (len(alone) - n1, n1))
    found = _measured(chosen(second), ordinary, toxic)
    best: tuple[float, int, tuple[float, float, float]] | None = None
    y = np.array([r[0] for r in found], dtype=float)
    for at, least in enumerate(GAINS):
        x = np.array([_features(hits[at], n) for _, n, hits in found])
        w = _logistic(x, y)
        p = 1 / (1 + np.exp(-np.clip(w[0] + x @ np.array(w[1:]), -30, 30)))
        loss = float(-np.mean(y * np.log(p + 1e-12) + (1 - y) * np.log(1 - p + 1e-12)))
        if best is None or loss < best[0]:
            best = (loss, least, w)
    return Model(ordinary, toxic, best[1], best[2])


def sample_labelled(docs: DataFrame, labels: DataFrame, max_toxic: int, max_ordinary: int) -> DataFrame:
    """The bounded sample of learnable labelled rows: doc_id, whole text in bytes, label."""
    marks = (
        common.narrow(labels, doc_id="long", toxic="int")
        .filter("doc_id is not null and toxic is not null")
        .filter(common.id_remainder("doc_id", 3) != 1)
        .groupBy("doc_id").agg((F.max("toxic") == 1).cast("int").alias("toxic"), F.max("toxic").alias("mark"))
    )
    order = [F.xxhash64("doc_id"), "doc_id"]
    picked = (
        marks.filter("mark = 1").orderBy(*order).limit(max_toxic)
        .unionAll(marks.filter("mark = 0").orderBy(*order).limit(max_ordinary))
    )
    # at most max_toxic + max_ordinary rows of two numbers: small enough to broadcast
    texts = common.narrow(docs, doc_id="long", text="string").join(F.broadcast(picked.select("doc_id", "toxic")), "doc_id")
    text = F.coalesce("text", F.lit(""))
    return texts.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64(text), text.alias("text"))).alias("least"), F.max("toxic").alias("toxic")).select(
        "doc_id", F.col("least.text").cast("binary").alias("text"), "toxic")


def train(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_ordinary: int = MAX_ORDINARY) -> Model:
    """Learn from labelled documents whose crc32(doc_id) mod 3 is not 1."""
    with common.temporary_tables(docs.sparkSession):
        sample = sample_labelled(docs, labels, max_toxic, max_ordinary)
        return fit(common.stash(sample.repartition(TASKS, "doc_id"), "toxic-sample"))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted, n_windows, n_toxic_windows per document."""
    held = docs.sparkSession.sparkContext.broadcast(astuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*held.value)
        windows = Windows(m.ordinary, m.toxic, m.gain)
        for b in batches:
            got = [score_text(t, windows, m) for t in b.column("text").cast(pa.binary()).to_pylist()]
            s = [g[0] for g in got]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(s, pa.float64()), pa.array([int(v >= CUTOFF) for v in s], pa.int32()),
                 pa.array([g[1] for g in got], pa.int64()), pa.array([g[2] for g in got], pa.int64())],
                ["doc_id", "held_out", "score", "predicted", "n_windows", "n_toxic_windows"],
            )

    rows = common.narrow(docs, doc_id="long", text="string").withColumn("held_out", common.id_remainder("doc_id", 3) == 1)
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, n_windows long, n_toxic_windows long")


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The documents the model does not reject, with all their columns."""
    held = docs.sparkSession.sparkContext.broadcast(astuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*held.value)
        windows = Windows(m.ordinary, m.toxic, m.gain)
        for b in batches:
            texts = b.column(b.schema.get_field_index("text")).cast(pa.binary()).to_pylist()
            yield b.filter(pa.array([score_text(t, windows, m)[0] < CUTOFF for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

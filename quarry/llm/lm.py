"""Language-model scores by deleted interpolation.

Bigram and unigram maximum-likelihood estimates and a uniform floor are mixed;
the weights depend on how often the context was seen (buckets by powers of two)
and come from expectation-maximisation on counts of documents that were deleted
from the estimates.  The final estimates count all training documents.

Counting covers the whole corpus and is distributed: documents are packed into
blocks; a block sends its distinct n-grams, as 64-bit keys with counts, to key
ranges (*shards*), whose totals return to the block, which scores its texts.
The number of shards follows the size of the corpus, so neither a block nor a
shard outgrows a task, and no vocabulary is ever broadcast or collected.  A very
frequent n-gram is one entry per block.

Tokens are the words of the ASCII-lower-cased text and one end mark; the
context of the first token is a begin mark, counted like the end mark.

Cases: a null text is the empty text (one token, the end); without training
documents every probability is 1, as in the base; a repeated row counts and is
scored again; a null doc_id counts as the empty id; extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import common

BLOCK_BYTES = 6 << 20  # text of one block
SHARD_BYTES = 16 << 20  # text per shard
BUCKETS = 24
DELETED = 10  # one training document in so many is deleted from the estimates
ROUNDS, SETTLED = 15, 1e-3
BEGIN, END = 0, 1

PACKED = "block long, cut boolean, ids binary, known binary, train binary, sizes binary, texts binary, bytes long"
SENT = "shard long, size long, block long, keys binary, kept binary, cut binary"
BACK = "block long, size long, shard long, kept binary, total binary, kept_tokens long, tokens long, types long"
SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def pack(docs: DataFrame, modulus: int, held_out: int) -> DataFrame:
    """Blocks of documents; deleted training documents fill blocks of their own."""
    rows = common.narrow(docs, doc_id="long", text="string").withColumn("train", common.id_remainder("doc_id", modulus) != held_out)
    rows = rows.withColumn("cut", F.col("train") & (F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(-1))), F.lit(DELETED)) == 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard as zs

        squeeze = zs.ZstdCompressor(level=3).compress
        part, number = TaskContext.get().partitionId(), count()
        held: dict[bool, list[tuple[int | None, bool, bytes]]] = {False: [], True: []}
        size = {False: 0, True: 0}

        def emit(cut: bool) -> pa.RecordBatch:
            found = held[cut]
            values = [
                (part << 24) + next(number), cut, np.array([i or 0 for i, _, _ in found], np.int64).tobytes(),
                np.array([i is not None for i, _, _ in found], np.uint8).tobytes(), np.array([t for _, t, _ in found], np.uint8).tobytes(),
                np.array([len(x) for _, _, x in found], np.int64).tobytes(), squeeze(b"".join(x for _, _, x in found)), size[cut],
            ]
            held[cut], size[cut] = [], 0
            return pa.RecordBatch.from_pylist([dict(zip([c.split()[0] for c in PACKED.split(", ")], values, strict=True))])

        for b in batches:
            texts = b.column("text").cast(pa.binary()).to_pylist()
            for doc, text, train, cut in zip(b.column("doc_id").to_pylist(), texts, b.column("train").to_pylist(), b.column("cut").to_pylist(), strict=True):
                held[cut].append((doc, train, text or b""))
                size[cut] += len(text or b"")
                if size[cut] >= BLOCK_BYTES:
                    yield emit(cut)
        for cut in (False, True):
            if held[cut]:
                yield emit(cut)

    return common.stash(rows.select("doc_id", "text", "train", "cut").mapInArrow(run, PACKED), "lm-blocks")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Block:
    """The tokens of a block, its distinct n-grams and their keys in order."""

    def __init__(self, sizes: bytes, texts: bytes):
        import xxhash
        import zstandard as zs

        whole = zs.ZstdDecompressor().decompress(texts) if texts else b""
        number = count(2)
        ids: dict[bytes, int] = defaultdict(lambda: next(number))
        rows, at = [], 0
        for n in np.frombuffer(sizes, np.int64).tolist():
            words = whole[at : at + n].lower().split()
            rows.append(np.fromiter(map(ids.__getitem__, words), np.int64, len(words)))
            at += n
        self.lengths = np.array([len(r) + 1 for r in rows], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.word = np.full(int(self.lengths.sum()), END, np.int64)
        for start, r in zip(self.starts.tolist(), rows, strict=True):
            self.word[start : start + len(r)] = r
        self.context = np.empty_like(self.word)
        self.context[1:] = self.word[:-1]
        self.context[self.starts] = BEGIN
        hashes = np.array([11, 13, *map(xxhash.xxh3_64_intdigest, ids)], np.uint64)
        pair, self.pair_of = np.unique(self.context * len(hashes) + self.word, return_inverse=True)
        first, second = hashes[pair // len(hashes)], hashes[pair % len(hashes)]
        keys = (_mix(hashes + np.uint64(1))[1:], _mix(_mix(first + np.uint64(0x9E3779B97F4A7C15)) + second))
        self.order = [np.argsort(k) for k in keys]
        self.keys = [k[o] for k, o in zip(keys, self.order, strict=True)]

    def counts(self, docs: np.ndarray) -> list[np.ndarray]:
        """Of each n-gram size, the counts in the chosen documents, by key."""
        token = np.repeat(docs, self.lengths)
        one = np.bincount(self.word[token], minlength=len(self.keys[0]) + 1)[1:]
        two = np.bincount(self.pair_of[token], minlength=len(self.keys[1]))
        return [c[o].astype(np.uint32) for c, o in zip((one, two), self.order, strict=True)]

    def of_tokens(self, ones: np.ndarray, twos: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Counts by key to (pair, context, word) counts of every token."""
        one, two = np.zeros(len(self.keys[0]) + 1, np.int64), np.zeros(len(self.keys[1]), np.int64)
        one[1:][self.order[0]] = ones
        two[self.order[1]] = twos
        one[BEGIN] = one[END]
        return two[self.pair_of], one[self.context], one[self.word]


def _squeeze(x: np.ndarray) -> bytes:
    import zstandard as zs

    return zs.ZstdCompressor(level=1).compress(x.astype(np.uint32).tobytes())


def _loose(x: bytes) -> np.ndarray:
    import zstandard as zs

    return np.frombuffer(zs.ZstdDecompressor().decompress(x), np.uint32)


def count_ngrams(blocks: DataFrame) -> DataFrame:
    """Totals of every block's n-grams, in the block's own order; rows of block -1
    hold a shard's numbers of tokens and of distinct words."""
    size = blocks.agg(F.sum("bytes")).first()[0] or 0
    shards = max(16, -(-size // SHARD_BYTES))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                block, train = Block(r["sizes"], r["texts"]), np.frombuffer(r["train"], np.uint8).astype(bool)
                of_train, none = block.counts(train), [np.zeros(len(k), np.uint32) for k in block.keys]
                kept, cut = (none, of_train) if r["cut"] else (of_train, none)
                for n, keys in enumerate(block.keys):
                    shard = ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
                    ends = np.searchsorted(shard, np.arange(shards + 1)).tolist()
                    out = [
                        {"shard": s, "size": n, "block": r["block"], "keys": keys[lo:hi].tobytes(), "kept": _squeeze(kept[n][lo:hi]), "cut": _squeeze(cut[n][lo:hi])}
                        for s, (lo, hi) in enumerate(zip(ends, ends[1:], strict=False)) if hi > lo
                    ]
                    yield pa.RecordBatch.from_pylist(out)

    def total(group: pd.DataFrame) -> pd.DataFrame:
        rows, sums = [], [0, 0, 0]
        for size, part in group.groupby("size"):
            keys = [np.frombuffer(k, np.uint64) for k in part["keys"]]
            kept, both = [_loose(x) for x in part["kept"]], [_loose(x) for x in part["cut"]]
            both = [a.astype(np.int64) + b for a, b in zip(kept, both, strict=True)]
            _, place = np.unique(np.concatenate(keys), return_inverse=True)
            of_kept = np.bincount(place, np.concatenate(kept)).astype(np.int64)
            of_both = np.bincount(place, np.concatenate(both)).astype(np.int64)
            if size == 0:
                sums = [int(of_kept.sum()), int(of_both.sum()), int((of_both > 0).sum())]
            at = 0
            for block, shard, own in zip(part["block"], part["shard"], keys, strict=True):
                p = place[at : at + len(own)]
                at += len(own)
                rows.append((block, size, shard, _squeeze(of_kept[p]), _squeeze(of_both[p]), 0, 0, 0))
        rows.append((-1, 0, int(group["shard"].iloc[0]), b"", b"", *sums))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in BACK.split(", ")])

    sent = blocks.select("block", "cut", "train", "sizes", "texts").mapInArrow(send, SENT)
    return common.stash(sent.groupBy("shard").applyInPandas(total, BACK), "lm-totals")


def _counts_of(back: pd.DataFrame, column: str, size: int) -> np.ndarray:
    part = back[back["size"] == size].sort_values("shard")
    return np.concatenate([_loose(x) for x in part[column]]).astype(np.int64) if len(part) else np.empty(0, np.int64)


def _bucket(seen: np.ndarray) -> np.ndarray:
    """0 for contexts never seen, else 1 + the power of two of their count."""
    return np.minimum(np.frexp(seen.astype(np.float64))[1], BUCKETS - 1)


def learn_weights(blocks: DataFrame, totals: DataFrame, kept_tokens: int, types: int) -> list[list[float]]:
    """Mixture weights (bigram, unigram, uniform) of each bucket, by EM on the
    deleted documents' counts under the estimates of the documents kept."""

    def held(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for sizes, texts in zip(left["sizes"], left["texts"], strict=True):
            block = Block(sizes, texts)
            pair, context, word = block.of_tokens(_counts_of(right, "kept", 0), _counts_of(right, "kept", 1))
            bucket = _bucket(context)
            rows, n = np.unique(np.stack([bucket, pair, np.where(pair > 0, context, 0), word]), axis=1, return_counts=True)
            parts.append(pd.DataFrame({"bucket": rows[0], "pair": rows[1], "context": rows[2], "word": rows[3], "n": n}))
        return pd.concat(parts) if parts else pd.DataFrame({c: [] for c in ("bucket", "pair", "context", "word", "n")})

    schema = "bucket long, pair long, context long, word long, n long"
    cut = blocks.filter("cut").select("block", "sizes", "texts")
    back = totals.filter("block >= 0").join(cut.select("block"), "block", "left_semi").select("block", "size", "shard", "kept")
    seen = cut.groupBy("block").cogroup(back.groupBy("block")).applyInPandas(held, schema)
    counts = common.stash(
        seen.groupBy("bucket", "pair", "context", "word").agg(F.sum("n").alias("n"))
        .select(
            "bucket", "n", F.when(F.col("pair") > 0, F.col("pair") / F.col("context")).otherwise(0.0).alias("p2"),
            (F.col("word") / max(kept_tokens, 1)).alias("p1"), F.lit(1.0 / (types + 1)).alias("p0"),
        ), "lm-held-counts",
    )
    weights = [[0.0 if b == 0 else 0.4, 0.5, 0.5 if b == 0 else 0.1] for b in range(BUCKETS)]
    for _ in range(ROUNDS):
        own = [F.element_at(F.array(*[F.lit(w[k]) for w in weights]), (F.col("bucket") + 1).cast("int")) for k in range(3)]
        shares = counts.select("bucket", "n", *[(w * F.col(p)).alias(p) for w, p in zip(own, ("p2", "p1", "p0"), strict=True)])
        whole = F.col("p2") + F.col("p1") + F.col("p0")
        sums = shares.groupBy("bucket").agg(*[F.sum(F.col("n") * F.col(p) / whole).alias(p) for p in ("p2", "p1", "p0")], F.sum("n").alias("n")).collect()
        change = 0.0
        for r in sums:
            new = [(r[p] + (0.0 if r["bucket"] == 0 and p == "p2" else 1e-3)) / (r["n"] + (2e-3 if r["bucket"] == 0 else 3e-3)) for p in ("p2", "p1", "p0")]
            change = max(change, *[abs(a - b) for a, b in zip(new, weights[r["bucket"]], strict=True)])
            weights[r["bucket"]] = new
        if change < SETTLED:
            break
    met = sorted({r["bucket"] for r in sums} - {0})
    for b in range(1, BUCKETS):  # a bucket without held-out counts takes its nearest neighbour's weights
        if met and b not in met:
            weights[b] = list(weights[min(met, key=lambda m: abs(m - b))])
    return weights


def score(docs: DataFrame, modulus: int = 7, held_out: int = 2) -> DataFrame:
    """Scores of all documents; those whose crc32(doc_id) mod ``modulus`` is
    ``held_out`` teach nothing."""
    blocks = pack(docs, modulus, held_out)
    totals = count_ngrams(blocks)
    stats = totals.filter("block = -1").agg(*[F.sum(c).alias(c) for c in ("kept_tokens", "tokens", "types")]).first()
    kept_tokens, tokens, types = (stats[c] or 0 for c in ("kept_tokens", "tokens", "types"))
    weights = learn_weights(blocks, totals, kept_tokens, types)

    def judged(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        mix, parts = np.array(weights), []
        for r in left.itertuples():
            block = Block(r.sizes, r.texts)
            pair, context, word = block.of_tokens(_counts_of(right, "total", 0), _counts_of(right, "total", 1))
            w = mix[_bucket(context)]
            if tokens:
                p = w[:, 0] * pair / np.maximum(context, 1) + w[:, 1] * word / tokens + w[:, 2] / (types + 1)
            else:
                p = np.ones(len(word))
            base = np.log10((word + 1.0) / (tokens + types + 1))
            sums = [np.add.reduceat(x, block.starts) for x in (word > 0, base, np.log10(p))]
            known = np.frombuffer(r.known, np.uint8).astype(bool)
            parts.append(pd.DataFrame({
                "doc_id": pd.array(np.frombuffer(r.ids, np.int64), "Int64").copy(), "held_out": ~np.frombuffer(r.train, np.uint8).astype(bool),
                "n_tokens": block.lengths, "n_known": sums[0].astype(np.int64), "train_tokens": tokens, "base_score": sums[1], "score": sums[2],
            }))
            parts[-1].loc[~known, "doc_id"] = pd.NA
        return pd.concat(parts) if parts else pd.DataFrame({c.split()[0]: [] for c in SCORED.split(", ")})

    left = blocks.select("block", "ids", "known", "train", "sizes", "texts").groupBy("block")
    right = totals.filter("block >= 0").select("block", "size", "shard", "total").groupBy("block")
    return left.cogroup(right).applyInPandas(judged, SCORED)

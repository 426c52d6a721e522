"""Byte-level BPE encoding and decoding with a lexicon of frequent words.

The corpus' most frequent words are merged once on the driver and compiled into
a minimal acyclic transducer (``lexicon``) that workers map into memory; it
gives their ids.  Words it has not are merged exactly, lowest rank first.  The
result does not depend on which words the lexicon holds.

Cases: null text is encoded as the empty text (no ids); the special token's
string inside a text becomes its id, as in the tokenizer file's own rules; a
repeated row is encoded like any other; extra columns are ignored by ``encode``.
"""

from __future__ import annotations

import heapq
import json
import re
import uuid
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import common
from quarry.llm.lexicon import Lexicon, compile_words

LEXICON_WORDS = 100_000  # frequent words compiled into the transducer
NONE = 1 << 60  # the rank of pairs that don't merge
LONG = 48  # bytes of a word from which symbols are linked and kept in a heap
LONGEST = 64  # bytes of a lexicon word at most
MEMO = 500_000  # words remembered per worker before the memo starts anew
CHUNK = 1 << 20  # characters whose words are looked up together

# letters, digits, others and spaces, as the tokenizer file's pattern splits them
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# the same for texts of Latin letters only, where the classes of ``re`` agree with it
SPLIT_LATIN = re.compile(r"'(?:[stmd]|re|ve|ll)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
NOT_LATIN = re.compile("[^\x00-\x1b\x20-\x84\x86-\xb1\xb4-\xb8\xba\xbb\xbf-ɏ]")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Merges and token bytes of a byte-level BPE file."""

    def __init__(self, ranks: dict[int, int], made: list[int], tokens: list[bytes], special: dict[str, int]):
        self.ranks, self.made, self.tokens, self.special = ranks, made, tokens, special
        self.of_byte = {t[0]: i for i, t in reversed([*enumerate(tokens)]) if len(t) == 1}
        self.byte_ids = np.array([self.of_byte.get(b, 0) for b in range(256)], np.int64)
        keys, places = np.array([*ranks, -1], np.int64), np.array([*ranks.values(), NONE], np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks, self.made_ids = keys[order], places[order], np.array(made or [0], np.int64)

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens = [b""] * (1 + max([*vocab.values(), *special.values()]))
        for token, i in vocab.items():
            tokens[i] = token.encode() if token in special else bytes(letters[c] for c in token)
        for token, i in special.items():
            tokens[i] = token.encode()
        pairs = [p.split(" ") if isinstance(p, str) else p for p in spec["model"]["merges"]]
        ranks = {vocab[a] << 32 | vocab[b]: rank for rank, (a, b) in enumerate(pairs)}
        return cls(ranks, [vocab[a + b] for a, b in pairs], tokens, special)

    def merge(self, word: bytes) -> list[int]:
        """Exact BPE of one word: the pair of lowest rank first, leftmost on ties."""
        return np.frombuffer(self.merge_all([word])[0], "<u4").tolist()

    def merge_all(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of many words; each round makes one merge in every word."""
        short = [i for i, w in enumerate(words) if len(w) <= LONG]
        out = [b"" if len(w) <= LONG else _pack(self._merge_long([self.of_byte[x] for x in w])) for w in words]
        word = np.repeat(np.array(short, np.int64), [len(words[i]) for i in short])
        ids = self.byte_ids[np.frombuffer(b"".join(words[i] for i in short), np.uint8)]
        rank = self._rank(ids, word, np.arange(len(ids)))
        while len(ids):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            size = np.diff(np.append(first, len(word)))
            least = np.minimum.reduceat(rank, first)
            done = least == NONE
            if done.any():
                gone = np.repeat(done, size)
                packed, at = ids[gone].astype("<u4").tobytes(), 0
                for i, n in zip(word[first[done]].tolist(), size[done].tolist(), strict=True):
                    out[i] = packed[at : at + 4 * n]
                    at += 4 * n
                ids, word, rank = ids[~gone], word[~gone], rank[~gone]
                if not len(ids):
                    break
                size, least = size[~done], least[~done]
            at = np.flatnonzero(rank == np.repeat(least, size))
            at = at[np.concatenate([[True], word[at[1:]] != word[at[:-1]]])]  # leftmost of each word
            ids[at] = self.made_ids[least]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids, word, rank = ids[keep], word[keep], rank[keep]
            at -= np.arange(len(at))
            rank[at] = self._rank(ids, word, at)
            left = at[at > 0] - 1
            rank[left] = self._rank(ids, word, left)
        return out

    def _rank(self, ids: np.ndarray, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rank of the pairs that begin at these symbols; NONE across words."""
        after = np.minimum(at + 1, len(ids) - 1)
        key = ids[at] << 32 | ids[after]
        place = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        fits = (self.pair_keys[place] == key) & (after > at) & (word[at] == word[after])
        return np.where(fits, self.pair_ranks[place], NONE)

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap over linked symbols, for long words."""
        n, get, made = len(ids), self.ranks.get, self.made
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (rank := get(ids[i] << 32 | ids[j], NONE)) != NONE:
                heapq.heappush(heap, (rank, i, ids[i], ids[j]))

        for i in range(n):
            offer(i)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = made[rank], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [i for i in ids if i >= 0]


def splitter() -> Callable[[str], list[str]]:
    """Text to words, by the faster of two equivalent patterns."""
    import regex

    wide, latin, other = regex.compile(SPLIT).findall, SPLIT_LATIN.findall, NOT_LATIN.search
    return lambda text: wide(text) if other(text) else latin(text)


def count_words(docs: DataFrame) -> DataFrame:
    """word (UTF-8), n over all texts; partly counted before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, counts = splitter(), Counter()

        def flush() -> pa.RecordBatch:
            words = [w.encode() for w in counts]
            out = pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return out

        for b in batches:
            for text in b.column("text").to_pylist():
                counts.update(split(text or ""))
                if len(counts) > MEMO:
                    yield flush()
        yield flush()

    parts = common.narrow(docs, text="string").mapInArrow(run, "word binary, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def compile_lexicon(docs: DataFrame, vocabulary: Vocabulary, size: int = LEXICON_WORDS) -> str:
    """Compile the ``size`` most frequent words; returns the name workers find it by."""
    spark = docs.sparkSession
    top = count_words(docs).filter(F.length("word") <= LONGEST).orderBy(F.desc("n"), "word").limit(size)
    words = top.select("word").toArrow().column("word").to_pylist()
    name = f"lexicon-{uuid.uuid4().hex}"
    spark.sparkContext.addFile(common.write_shared(spark, name, compile_words([(w, np.frombuffer(ids, "<u4").tolist()) for w, ids in zip(words, vocabulary.merge_all(words), strict=True)])))
    return name


class Words(dict):
    """Maps words to their packed ids; filled from the lexicon, else by merging."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon):
        super().__init__()
        self.vocabulary, self.lexicon = vocabulary, lexicon

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self]
        if len(self) + len(new) > MEMO:
            self.clear()
            new = list(words)
        raw = [w.encode() for w in new]
        unseen = []
        for word, text, ids in zip(new, raw, self.lexicon.outputs(raw), strict=True):
            if ids is None:
                unseen.append((word, text))
            else:
                self[word] = ids.astype("<u4").tobytes()
        self.update(zip([w for w, _ in unseen], self.vocabulary.merge_all([t for _, t in unseen]), strict=True))


def _pack(ids: list[int]) -> bytes:
    return b"".join([i.to_bytes(4, "little") for i in ids])


def encode(docs: DataFrame, lexicon: str, vocabulary: Vocabulary) -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit integers) of each text."""
    held = docs.sparkSession.sparkContext.broadcast((vocabulary.ranks, vocabulary.made, vocabulary.tokens, vocabulary.special))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = Vocabulary(*held.value)
        words, split = Words(vocab, Lexicon(SparkFiles.get(lexicon))), splitter()
        marks = re.compile("(" + "|".join(map(re.escape, sorted(vocab.special, key=len, reverse=True))) + ")") if vocab.special else None

        def parts(text: str) -> list[list[str] | bytes]:
            """The text's words; between them, packed ids of special tokens."""
            if marks is None or not marks.search(text):
                return [split(text)]
            return [_pack([vocab.special[p]]) if p in vocab.special else split(p) for p in marks.split(text)]

        def ids_of(texts: list[str]) -> list[bytes]:
            cut = [parts(t) for t in texts]
            words.learn({w for found in cut for part in found if isinstance(part, list) for w in part})
            return [b"".join(p if isinstance(p, bytes) else b"".join(map(words.__getitem__, p)) for p in found) for found in cut]

        for b in batches:
            ids, held_texts, size = [], [], 0
            for text in b.column("text").to_pylist():
                held_texts.append(text or "")
                size += len(held_texts[-1])
                if size >= CHUNK:
                    ids += ids_of(held_texts)
                    held_texts, size = [], 0
            ids += ids_of(held_texts)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return common.narrow(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, ids and the decoded text; invalid UTF-8 decodes to U+FFFD."""
    held = encoded.sparkSession.sparkContext.broadcast(vocabulary.tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = held.value.__getitem__
        for b in batches:
            texts = [b"".join(map(token, np.frombuffer(i or b"", "<u4").tolist())).decode("utf-8", "replace") for i in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("ids"), pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return common.narrow(encoded, doc_id="long", ids="binary").mapInArrow(run, "doc_id long, ids binary, text string")


def roundtrip(docs: DataFrame, path: str | None = None, size: int = LEXICON_WORDS) -> DataFrame:
    """Encode and decode whole texts: doc_id, n_tokens and digests of both results."""
    vocabulary = Vocabulary.load(path or default_vocabulary())
    out = decode(encode(docs, compile_lexicon(docs, vocabulary, size), vocabulary), vocabulary)
    return out.select(
        "doc_id", F.expr("cast(length(ids) / 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )

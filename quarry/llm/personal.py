"""Personal data by bootstrapped contextual extraction.

Seeds are what the base rules find (email, ip, card, phone).  A *pattern* is the
word, or the two words, before an entity; an *instance* is the entity's text.
All identifier-like strings (*candidates*: words or runs of number words with
enough digits, or with an ``@``) are unseen instances until a pattern vouches for
them.  Patterns and instances form a graph, written as a table, on which Spark
iterates:

* a pattern's confidence for a kind is the share of all its occurrences in the
  corpus that are followed by instances of the kind, weighted by their scores; it
  is induced by at least ``SUPPORT`` different instances;
* a candidate's score is ``1 - prod(1 - confidence)`` over its patterns; those of
  ``ACCEPT`` or more join the instances of the next round.

The patterns of confidence ``SURE`` then mark the candidates that follow them:
spans of kind ``email_context``, ``ip_context``, ... beside the base ones.

The corpus is read twice: once for entities and candidates, once to count the
contexts that may become patterns.  The second reading sends on only contexts
whose hash is set in a table of fixed size (``MARKS`` places) and joins them
exactly, so nothing that grows with the corpus is broadcast.  Occurrences are
counted per batch before they are shuffled; copies repeat occurrences, never
instances.  Contexts and instances are 64-bit hashes of ASCII-lower-cased text.

Cases: a null text is the empty text; a repeated row is another document; a null
doc_id is returned as such; words with digits or ``@``, words without letters and words of over 250 bytes
are no context; texts of any length are read whole (contexts in pieces that end at
a word's end); extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import common

KINDS = ("email", "ip", "card", "phone")
SUPPORT, SURE, ACCEPT, ROUNDS = 3, 0.5, 0.6, 5
MARKS = 1 << 22
PIECE = 4 << 20  # bytes of a text split into words at once
# what may stand between a context word and the entity
OPENING = " \t\n\r\x0b\x0c\"'([{<"
OUTER = ".,;:!?\"'()[]{}<>"

READ = (
    "row long, doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string,"
    " base array<struct<start:int,rank:int,end:int>>,"
    " found array<struct<start:int,end:int,kind:int,instance:long,near:long,far:long>>"
)


class Finder:
    """Base entities and candidates of a text; every search is linear in its length."""

    def __init__(self) -> None:
        self.domain = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
        # a later start in one run of digits fails where the first one does
        self.ip = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
        self.card = re.compile(r"[0-9](?:[ -]?[0-9])+")
        self.phone = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
        self.sign = re.compile("[0-9@]")
        self.local = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
        self.space = frozenset(" \t\n\x0b\x0c\r")
        self.number = frozenset("0123456789+().-/")

    def emails(self, text: str) -> Iterator[tuple[int, int]]:
        last = 0
        for m in self.domain.finditer(text):
            start = m.start()
            while start > last and text[start - 1] in self.local:
                start -= 1
            if start < m.start():
                last = m.end()
                yield start, last

    def base(self, text: str) -> list[tuple[int, int, int]]:
        """(start, kind, end) in order."""
        out = [(a, 0, b) for a, b in self.emails(text)]
        for m in self.ip.finditer(text):
            if all(len(p) <= 3 and int(p) <= 255 for p in (p.lstrip("0") or "0" for p in m.group().split("."))):
                out.append((m.start(), 1, m.end()))
        for m in self.card.finditer(text):
            if 14 <= m.end() - m.start() <= 37:
                digits = [int(c) for c in m.group() if c.isdigit()]
                if 14 <= len(digits) <= 19 and sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))) % 10 == 0:
                    out.append((m.start(), 2, m.end()))
        for m in self.phone.finditer(text):
            if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append((m.start(), 3, m.end()))
        return sorted(out)

    def words(self, text: str) -> Iterator[tuple[int, int]]:
        """Words that hold a digit or an ``@``; number words one space apart are one."""
        at, run = 0, None
        while m := self.sign.search(text, at):
            start, end = m.start(), m.end()
            while start > at and text[start - 1] not in self.space:
                start -= 1
            while end < len(text) and text[end] not in self.space:
                end += 1
            at = end
            label = max(text.rfind(":", start, end), text.rfind("=", start, end)) + 1
            if start < label < end:
                start = label
            number = all(c in self.number for c in text[start:end])
            if run and number and run[2] and start == run[1] + 1:
                run = (run[0], end, True)
                continue
            if run:
                yield run[:2]
            run = (start, end, number)
        if run:
            yield run[:2]

    def candidates(self, text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
        taken, i = sorted((a, b) for a, _, b in base), 0
        for start, end in self.words(text):
            while start < end and text[start] in OUTER:
                start += 1
            while end > start and text[end - 1] in OUTER:
                end -= 1
            part = text[start:end]
            digits, alnum = sum("0" <= c <= "9" for c in part), sum(c.isascii() and c.isalnum() for c in part)
            if alnum < 5 or (digits < 3 and "@" not in part[1:-1]):
                continue
            while i < len(taken) and taken[i][1] <= start:
                i += 1
            if not any(a < end and start < b for a, b in taken[i:i + 8]):
                yield start, end


def split_words(text: bytes) -> list[bytes]:
    """Words of an ASCII-lower-cased text; a label's ``:`` or ``=`` ends a word."""
    return text.lower().replace(b":", b": ").replace(b"=", b"= ").split()


def is_context(word: bytes) -> bool:
    """Lexical: no digit and no ``@``, but a letter."""
    return not re.search(rb"[0-9@]", word) and re.search(rb"[a-z\x80-\xff]", word) is not None


def read(docs: DataFrame) -> DataFrame:
    """Per document: base entities, and all instances with the hashes of their contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        finder = Finder()

        def hashed(data: bytes) -> int:
            value = xxhash.xxh64_intdigest(data)
            return value - (1 << 64) if value >> 63 else value

        def contexts(text: str, start: int) -> tuple[int | None, int | None]:
            before = text[max(0, start - 256):start].rstrip(OPENING)
            words = split_words(before.encode())
            if start > 256 and len(words) <= 2:
                words = words[1:]  # the first one may be cut
            if not words or not is_context(words[-1]):
                return None, None
            far = len(words) > 1 and is_context(words[-2])
            return hashed(words[-1]), hashed(words[-2] + b" " + words[-1]) if far else None

        for batch in batches:
            rows = []
            for row, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                base = finder.base(text)
                spans = [(a, b, k) for a, k, b in base] + [(a, b, None) for a, b in finder.candidates(text, base)]
                found = []
                for a, b, kind in spans:
                    near, far = contexts(text, a)
                    if near is not None:
                        found.append((a, b, kind, hashed(text[a:b].encode().lower()), near, far))
                counts = [sum(k == i for _, k, _ in base) for i in range(len(KINDS))]
                joined = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in base)
                rows.append((row, doc_id, *counts, hashlib.sha256(joined.encode()).hexdigest(), base, found))
            names = ("row", "doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "base", "found")
            entity = pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("end", pa.int32())])
            instance = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32()), ("instance", pa.int64()), ("near", pa.int64()), ("far", pa.int64())])
            types = [*[pa.int64()] * 6, pa.string(), pa.list_(entity), pa.list_(instance)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    rows = common.narrow(docs, doc_id="long", text="string")
    return rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, READ)


def _parts(text: bytes) -> Iterator[tuple[list[bytes], int]]:
    """The words of a text in pieces that begin with the last two words of the piece
    before, and the number of those that were followed by a word there."""
    gap, at, carry = re.compile(rb"[ \t-\r]"), 0, []
    while at < len(text):
        cut = gap.search(text, at + PIECE)
        end = cut.start() if cut else len(text)
        words = carry + split_words(text[at:end])
        yield words, max(0, len(carry) - 1)
        carry, at = words[-2:], end


def occurrences(docs: DataFrame, marks: np.ndarray) -> DataFrame:
    """(pattern, n) per batch: how often contexts whose hash is marked stand before a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        def marked(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
            hashes = np.array([xxhash.xxh64_intdigest(k) for k in keys], dtype=np.uint64).view(np.int64)
            return hashes, marks[hashes & (MARKS - 1)]

        for batch in batches:
            near: Counter = Counter()
            far: Counter = Counter()
            parts = [p for text in batch.column(0).to_pylist() for p in _parts(text.encode())]
            for words, counted in parts:
                near.update(words[counted:-1])
            singles = [w for w in near if is_context(w)]
            hashes, keep = marked(singles)
            allowed = {w for w, on in zip(singles, keep.tolist()) if on}
            for words, _ in parts:
                far.update([(a, b) for a, b in zip(words[:-2], words[1:-1]) if b in allowed])
            pairs = [p for p in far if is_context(p[0])]
            more, on = marked([a + b" " + b for a, b in pairs])
            counts = [near[w] for w in singles if w in allowed] + [far[p] for p, marks_it in zip(pairs, on.tolist()) if marks_it]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([hashes[keep], more[on]])), pa.array(counts, pa.int64())], names=["pattern", "n"])

    text = common.narrow(docs, text="string").select(F.coalesce("text", F.lit("")).alias("text"))
    return text.mapInArrow(run, "pattern long, n long")


def graph(docs: DataFrame, seen: DataFrame) -> DataFrame:
    """Edges (pattern, instance, kind of a seed, n, total occurrences of the pattern) of
    all patterns that ``SUPPORT`` instances or more follow."""
    met = seen.select(F.explode("found").alias("f")).select("f.kind", "f.instance", F.explode(F.array("f.near", "f.far")).alias("pattern"))
    edges = met.filter("pattern is not null").groupBy("pattern", "instance").agg(F.max("kind").alias("kind"), F.count(F.lit(1)).alias("n"))
    edges = common.stash(edges, "edges")
    may = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("instances"), F.sum("n").alias("followed")).filter(F.col("instances") >= SUPPORT)
    may = common.stash(may.select("pattern", "followed"), "patterns")
    marks = np.zeros(MARKS, dtype=bool)
    # at most MARKS values
    for part in may.select(F.col("pattern").bitwiseAND(F.lit(MARKS - 1)).alias("place")).distinct().toArrow().column("place").chunks:
        marks[part.to_numpy()] = True
    totals = occurrences(docs, marks).groupBy("pattern").agg(F.sum("n").alias("n"))
    may = may.join(totals, "pattern", "left").select("pattern", F.greatest(F.coalesce("n", F.lit(0)), "followed").alias("total"))
    return common.stash(edges.join(may, "pattern"), "graph")


def bootstrap(edges: DataFrame) -> DataFrame:
    """(pattern, kind, confidence) of the patterns sure after the last round."""
    seeds = edges.filter("kind is not null").select("instance", F.col("kind").alias("of"), F.lit(1.0).alias("score")).distinct()
    unseen = edges.filter("kind is null").select("pattern", "instance")
    known, before = common.stash(seeds, "seeds"), -1
    for _ in range(ROUNDS):
        hits = edges.select("pattern", "instance", "n", "total").join(known, "instance").groupBy("pattern", "of").agg(
            F.count(F.lit(1)).alias("support"), F.round(F.sum(F.col("n") * F.col("score")) / F.max("total"), 9).alias("confidence"))
        best = hits.filter((F.col("support") >= SUPPORT) & (F.col("confidence") >= SURE))
        sure = common.stash(best.groupBy("pattern").agg(F.max(F.struct("confidence", (-F.col("of")).alias("of"))).alias("b")).select(
            "pattern", (-F.col("b.of")).alias("of"), F.col("b.confidence").alias("confidence")), "sure")
        doubt = F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-12)))))
        found = unseen.join(sure, "pattern").groupBy("instance", "of").agg(F.round(1 - doubt, 9).alias("score")).filter(F.col("score") >= ACCEPT)
        joined = found.groupBy("instance").agg(F.max(F.struct("score", (-F.col("of")).alias("of"))).alias("b")).select(
            "instance", (-F.col("b.of")).alias("of"), F.col("b.score").alias("score"))
        known = common.stash(seeds.unionByName(joined), "known")
        now = known.count()
        if now == before:
            break
        before = now
    return sure


def extract(docs: DataFrame) -> DataFrame:
    """doc_id, counts and digest of the base spans, and all spans of each document."""
    seen = common.stash(read(docs), "seen")
    sure = bootstrap(graph(docs, seen))
    open_ = seen.select("row", F.explode("found").alias("f")).filter("f.kind is null").select(
        "row", "f.start", "f.end", F.explode(F.array("f.near", "f.far")).alias("pattern"))
    best = F.max(F.struct("confidence", (-F.col("of")).alias("of"))).alias("b")
    spans = (
        open_.join(sure, "pattern").groupBy("row", "start", "end").agg(best)
        .groupBy("row").agg(F.collect_list(F.struct("start", (F.lit(len(KINDS)) - F.col("b.of")).cast("int").alias("rank"), "end")).alias("more"))
    )
    names = F.array(*[F.lit(k) for k in KINDS], *[F.lit(f"{k}_context") for k in KINDS])
    every = F.sort_array(F.concat("base", F.coalesce("more", F.array().cast("array<struct<start:int,rank:int,end:int>>"))))
    joined = F.array_join(F.transform(every, lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["start"], s["end"])), ",")
    return seen.drop("found").join(spans, "row", "left").select(
        "doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", joined.alias("spans"), F.size(F.coalesce("more", F.array())).cast("long").alias("n_context"))

"""Near-duplicate documents by circulant MinHash.

A document's set holds its distinct shingles of five words.  Two permutations
serve all signature coordinates: the first scatters the shingles over the ring
of 2^32 values, the second, circularly shifted by k, ranks them for coordinate
k.  ``BANDS`` bands of ``ROWS`` coordinates give the bucket keys; a pair of
similarity 0.75 shares a bucket with probability 1 - 4e-6.  Every link is
confirmed on the full sets of (64-bit hashes of) shingles.

Steps, none of which lists all pairs of a group of copies:

1. Documents of equal sets form a class, named by its smallest doc_id; only the
   class goes on.
2. Each bucket of two or more classes chooses a hub, the class with most bucket
   mates.  Each class is compared with the one hub that it shares most buckets
   with; the links found join components.  Where a bucket still holds two
   components, its classes are compared with its hub if that is of another one.
3. Pairs of bucket mates of *different* components are all compared, so no link
   between components stays unseen; members of one component need no further
   comparison.

A pair is compared only if a packed sketch (4 bits of every coordinate) agrees
in at least ``AGREE`` places, which a pair of similarity 0.75 misses with
probability 4e-6, about as rarely as the buckets, and if the set sizes and the
parities of the sets allow the similarity.  The latter loses no link: a shingle
flips one of ``PARITY`` bits, shingles of both sets cancel out, so sets differ in at
least as many shingles as their parities in bits.  It keeps texts that resemble each
other without a link from being listed pair by pair; such mates of a bucket are
still compared by their bits, within the join.

Cases: a null or empty text or one without words has no shingles and is linked
with nothing; fewer than five words are one shingle; rows repeating a doc_id are
one document, each row returned; a null doc_id is returned with a null
component and kept; extra columns are ignored by ``near_duplicates`` and kept by
``keep_one``, whatever their names; texts of any length are read whole, in pieces
of shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm import common
from quarry.operators.components import components, join_components

WIDTH = 5
ROWS, BANDS = 6, 64
SIMILAR = 75  # percent
AGREE = 256  # of ROWS * BANDS places: the bands miss as often
PACKS = ROWS * BANDS // 16  # 64-bit integers of a sketch
PARITY = 4096  # bits that the shingles of a set flip
CHUNK = 1 << 16  # shingles hashed at a time
MEMO = 300_000  # word hashes remembered per worker

# odd multipliers of the positions in a shingle, and of the mixing steps
PLACES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _permute32(x: np.ndarray, a: int, b: int) -> np.ndarray:
    """A permutation of the ring of 2^32 values (every step is invertible)."""
    x = x ^ (x >> np.uint32(16))
    x *= np.uint32(a)
    x ^= x >> np.uint32(15)
    x *= np.uint32(b)
    x ^= x >> np.uint32(16)
    return x


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= MEMO:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: bytes | None, hashes: _Hashes) -> np.ndarray:
    """The sorted distinct shingles of a text as 64-bit hashes."""
    words = (text or b"").lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    width = min(n, WIDTH)
    x = np.full(n - width + 1, width, np.uint64)
    for place in range(width):
        x += h[place : n - width + 1 + place] * np.uint64(PLACES[place])
    return np.unique(_mix64(x))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ROWS * BANDS coordinates per nonempty set."""
    k = ROWS * BANDS
    out = np.empty((len(sets), k), np.uint32)
    i = 0
    while i < len(sets):
        j, size = i, 0
        while j < len(sets) and (j == i or size + len(sets[j]) <= CHUNK):
            size += len(sets[j])
            j += 1
        ring = _permute32((np.concatenate(sets[i:j]) >> np.uint64(32)).astype(np.uint32), 0x7FEB352D, 0x846CA68B)
        starts = np.cumsum([0, *map(len, sets[i : j - 1])])
        for shift in range(k):
            out[i:j, shift] = np.minimum.reduceat(_permute32(ring + np.uint32(shift), 0x21F0AAAD, 0xD35A2D97), starts)
        i = j
    return out


def _band_keys(sig: np.ndarray) -> np.ndarray:
    by_band = sig.reshape(len(sig), BANDS, ROWS).astype(np.uint64)
    x = np.arange(BANDS, dtype=np.uint64) * np.uint64(PLACES[0]) + np.zeros((len(sig), 1), np.uint64)
    for r in range(ROWS):
        x = _mix64(x * np.uint64(PLACES[1]) + by_band[:, :, r])
    return x.view(np.int64)


def _sketches(sig: np.ndarray) -> np.ndarray:
    """Four bits of every coordinate, sixteen to a 64-bit integer."""
    bits = (sig >> np.uint32(7) & np.uint32(15)).astype(np.uint64).reshape(len(sig), PACKS, 16)
    return (bits << (np.arange(16, dtype=np.uint64) * np.uint64(4))).sum(axis=2, dtype=np.uint64).view(np.int64)


SIGNED = "doc_id long, n_shingles long, f0 long, f1 long, sketch array<long>, keys array<long>"


def sign(docs: DataFrame) -> DataFrame:
    """Set size, fingerprint, sketch and bucket keys of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for b in batches:
            sets = [shingles(t, hashes) for t in b.column("text").cast(pa.binary()).to_pylist()]
            full = [i for i, s in enumerate(sets) if len(s)]
            sig = signatures([sets[i] for i in full])
            print_ = np.zeros((len(sets), 2), np.int64)
            for i in full:
                mixed = _mix64(sets[i] * np.uint64(PLACES[2]) + np.uint64(PLACES[3]))
                print_[i] = np.array([mixed.sum(dtype=np.uint64), np.bitwise_xor.reduce(mixed)]).view(np.int64)
            columns = [b.column("doc_id"), pa.array([len(s) for s in sets], pa.int64())]
            columns += [pa.array(np.ascontiguousarray(c)) for c in print_.T]
            for width, values in ((PACKS, _sketches), (BANDS, _band_keys)):
                counts = np.zeros(len(sets) + 1, np.int32)
                counts[np.array(full, np.int64) + 1] = width
                flat = values(sig).ravel() if full else np.empty(0, np.int64)
                columns.append(pa.ListArray.from_arrays(pa.array(np.cumsum(counts, dtype=np.int32)), pa.array(flat)))
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in SIGNED.split(", ")])

    return common.narrow(docs, doc_id="long", text="string").mapInArrow(run, SIGNED)


def parity(shingles: np.ndarray) -> np.ndarray:
    """``PARITY`` bits in 64-bit integers, each the parity of its shingles' number."""
    odd = np.bincount((shingles % np.uint64(PARITY)).astype(np.int64), minlength=PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def full_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, n, shingles, parity) of the documents in ``ids``; n is the set's size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for b in batches:
            sets = [shingles(t, hashes) for t in b.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary()),
                 pa.array([parity(s) for s in sets], pa.list_(pa.int64()))],
                ["id", "n", "shingles", "parity"])

    texts = common.narrow(docs, doc_id="long", text="string").withColumnRenamed("doc_id", "id")
    # hash join: the ids are built into a table, the texts stream past unsorted
    return texts.join(ids.hint("shuffle_hash"), "id", "left_semi").mapInArrow(run, "id long, n long, shingles binary, parity array<long>")


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column("left").to_pylist(), b.column("right").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(x) + len(y)
                common_ = both - len(np.unique(np.concatenate([x, y])))
                keep.append(100 * common_ >= SIMILAR * (both - common_))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("right"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(run, "a long, b long")


def _agreement(x: str, y: str) -> Column:
    """Equal 4-bit places of two sketches.

    A fold rather than one long expression: unrolled, the generated method would
    be too large for the JVM to compile."""
    ones = F.lit(0x1111111111111111)

    def add(total: Column, d: Column) -> Column:
        pairs = d.bitwiseOR(F.shiftrightunsigned(d, 1))
        return total + F.bit_count(pairs.bitwiseOR(F.shiftrightunsigned(pairs, 2)).bitwiseAND(ones))

    differ = F.aggregate(F.zip_with(x, y, lambda a, b: a.bitwiseXOR(b)), F.lit(0), add)
    return F.lit(16 * PACKS) - differ


def _sizes_allow(m: str, n: str) -> Column:
    return (F.col(m) * 100 >= F.col(n) * SIMILAR) & (F.col(n) * 100 >= F.col(m) * SIMILAR)


def _parities_allow(m: str, n: str, x: str, y: str) -> Column:
    """Sets of sizes m and n with a link differ in at most (m + n) / 7 shingles."""
    flips = F.aggregate(F.zip_with(x, y, lambda a, b: a.bitwiseXOR(b)), F.lit(0), lambda total, d: total + F.bit_count(d))
    return flips * (100 + SIMILAR) <= (F.col(m) + F.col(n)) * (100 - SIMILAR)


def _may_link() -> Column:
    """Whether the sizes, sketches and parities of sides x and y allow the similarity."""
    alike = _agreement("x_sketch", "y_sketch") >= AGREE
    return _sizes_allow("x_n", "y_n") & alike & _parities_allow("x_n", "y_n", "x_parity", "y_parity")


SPREAD = 8  # places that the members of one class are dealt to


def _members(signed: DataFrame) -> DataFrame:
    """doc_id, n_shingles, id (smallest doc_id of equal sets).

    A class of a third of all documents would be one join key: it is dealt to ``SPREAD``
    places, and classes of one document, which need no join, stay out."""
    same = ["f0", "f1", "n_shingles"]
    classes = signed.filter("n_shingles > 0").groupBy(*same).agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    classes = classes.select(*same, "id", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("place"))
    rows = signed.select("doc_id", *same, F.pmod(F.xxhash64("doc_id"), F.lit(SPREAD)).cast("int").alias("place"))
    return rows.join(classes, [*same, "place"], "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("id", "doc_id")).alias("id"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable), kept."""
    with common.temporary_tables(docs.sparkSession):
        signed = common.stash(sign(docs), "signed")
        member = common.stash(_members(signed), "member", keep=True)
        heads = signed.filter("n_shingles > 0").join(member.filter("doc_id = id").select("doc_id").distinct(), "doc_id", "left_semi")
        final = _components(docs, heads)
    return (
        member.join(final, "id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def _components(docs: DataFrame, heads: DataFrame) -> DataFrame:
    """(id, component) of the classes that are linked, a kept table."""
    sketch = heads.dropDuplicates(["doc_id", "f0", "f1", "n_shingles"]).select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "sketch", "keys")
    rows = sketch.select(F.explode("keys").alias("key"), "id")
    shared = rows.groupBy("key").agg(F.count("*").alias("mates"), F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo < hi")
    mates = common.stash(rows.join(shared.select("key", "mates"), "key"), "mates")
    sets = common.stash(full_sets(docs, mates.select("id").distinct()), "sets")
    # a repeated doc_id may have several sets: the size tells them apart
    known = common.stash(sketch.drop("keys").join(sets.select("id", "n", "parity").distinct(), ["id", "n"]), "sketch")

    weight = mates.groupBy("id").agg(F.sum("mates").alias("weight"))
    hubs = common.stash(
        mates.join(weight, "id").groupBy("key").agg(F.max(F.struct("weight", (-F.col("id")).alias("id"))).alias("hub"))
        .select("key", (-F.col("hub.id")).alias("hub")), "hubs",
    )
    counted = mates.join(hubs, "key").filter("id != hub").groupBy("id", "hub").agg(F.count("*").alias("shared"))
    best = counted.groupBy("id").agg(F.max(F.struct("shared", (-F.col("hub")).alias("hub"))).alias("best"))
    links = common.stash(confirm(_alike(best.select(F.col("id").alias("a"), (-F.col("best.hub")).alias("b")), known), sets), "links-best")
    found = components(links)

    open_ = _open(mates, found)
    place = open_.select("key", F.col("id").alias("a"), F.col("c").alias("ca"))
    centre = open_.join(hubs, "key").filter("id = hub").select("key", F.col("id").alias("b"), F.col("c").alias("cb"))
    more = place.join(centre, "key").filter("ca != cb").select("a", "b").distinct()
    found = join_components(found, common.stash(confirm(_alike(more, known), sets), "links-hubs"))

    placed = _open(mates, found).join(known, "id")
    x = _side(placed, "a", "x", "key", F.col("c").alias("x_c"))
    y = _side(placed, "b", "y", "key", F.col("c").alias("y_c"))
    across = x.join(y, "key").filter((F.col("a") < F.col("b")) & (F.col("x_c") != F.col("y_c")) & _may_link()).select("a", "b").distinct()
    return common.stash(join_components(found, common.stash(confirm(across, sets), "links-across")), "final", keep=True)


def _open(mates: DataFrame, found: DataFrame) -> DataFrame:
    """(key, id, c) of the buckets that hold classes of different components."""
    placed = mates.select("key", "id").join(found, "id", "left").select("key", "id", F.coalesce("component", "id").alias("c"))
    mixed = placed.groupBy("key").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).filter("c0 < c1").select("key")
    return common.stash(placed.join(mixed, "key"), "open")


def _alike(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sizes, sketches and parities allow the similarity."""
    left, right = _side(known, "a", "x"), _side(known, "b", "y")
    met = pairs.join(left, "a").join(right, "b")
    return met.filter(_may_link()).select("a", "b")


def _side(known: DataFrame, name: str, mark: str, *more: str | Column) -> DataFrame:
    """One side of a pair: the id under ``name``, the rest marked."""
    return known.select(F.col("id").alias(name), *more, *[F.col(c).alias(f"{mark}_{c}") for c in ("n", "sketch", "parity")])


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component, with all its columns.

    Rows are told apart by a number of their own, so that repeated rows and rows
    without an id are members like any other; the row of smallest doc_id stays.
    Rows without words, linked with nothing, are one if doc_id and text are equal."""
    with common.temporary_tables(docs.sparkSession):
        rows = common.stash(common.packed(docs).withColumn("number", F.monotonically_increasing_id()), "rows", keep=True)
        text = F.col("row.text").cast("string")
        placed = near_duplicates(rows.select(F.col("number").alias("doc_id"), text.alias("text"))).select(F.col("doc_id").alias("number"), "component_id", "n_shingles")
        blank = F.coalesce(~text.rlike(r"[^ \t\n\x0B\f\r]"), F.lit(True))
        named = rows.select("number", F.col("row.doc_id").cast("long").alias("doc"), F.when(blank, text).alias("blank"))
        lone = F.col("n_shingles") == 0
        first = F.struct(F.col("doc").isNull(), "doc", "number")
        kept = (
            named.join(placed, "number")
            .groupBy(F.when(~lone, F.col("component_id")), F.when(lone, F.col("doc")), F.when(lone, F.col("blank")))
            .agg(F.min(first).alias("first")).select("first.number")
        )
        kept = common.stash(kept, "kept", keep=True)
    return rows.join(kept, "number", "left_semi").select("row.*")


# near_duplicates in DuckDB's SQL: shingles as text, one row for each set, all links, reachability
ORACLE_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_sort(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i : i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END) AS s FROM words),
classes AS (SELECT doc_id, s, CASE WHEN len(s) = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY s) END AS id FROM sets),
shingles AS (SELECT id, len(s) AS n, unnest(s) AS shingle FROM classes WHERE doc_id = id),
links AS (
  SELECT a.id AS a, b.id AS b FROM shingles a JOIN shingles b USING (shingle) WHERE a.id <> b.id
  GROUP BY a.id, b.id HAVING 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))),
reach AS (SELECT DISTINCT a AS id, a AS other FROM links UNION SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other),
components AS (SELECT id, min(other) AS c FROM reach GROUP BY id)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(c, id) AS component_id, doc_id = coalesce(c, id) AS kept
FROM classes LEFT JOIN components USING (id)"""

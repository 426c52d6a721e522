"""Source divergence audit over a frequent-pattern tree of term rows.

Within a language, every source gives each kept term a smoothed share; two sources
diverge by the sum over the terms of ``floor((p - q)^2 / q)``.  Most terms are
absent from most sources, so the sum over all kept terms is built from

* one value for "absent in both", times the number of kept terms;
* corrections for a term present in one source, by (source, share, multiplicity);
* corrections for a term present in both, which the tree collects: a term is the
  path of its (source, share) entries in the order of the sources, equal paths
  and equal beginnings are shared, and a node's correction with each of its
  ancestors is computed once and taken as often as terms pass the node.

Paths are range-partitioned in order, so that each task walks its part of the tree
depth first with the current branch and up to ``NODES`` complete nodes in memory,
which meet their ancestors together, level by level, and sends one sum per pair of
sources.  All sums are exact (no value passes the square of 10^9 + V, which is why
they fit a long).  Terms are counted per batch before they are shuffled, so
neither a frequent term nor a large source is a hot key.

Cases: nulls in text, lang and source are empty strings; every row is a document,
with or without an id and repeated or not; a group without kept terms takes part
with counts of 0; a language without kept terms has values of 0; texts of any
length are read whole, in pieces that end at a word's end; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm import common

LEAST_DOCS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
PIECE = 4 << 20  # bytes of a text that are split into terms at once
HELD = 300_000  # counts that a task holds before it sends them on
NODES = 50_000  # nodes of the tree that a task holds
LIMB = 21  # bits of a correction that are summed at a time
COUNTED = "lang string, source string, term string, n long, docs long"
MEETING = "lang string, source string, other string, value decimal(38,0)"
# letters keep their case-folded value, every other ASCII byte parts terms
FOLD = bytes(b if b >= 0x80 else b | 0x20 if chr(b).isalpha() else 0x20 for b in range(256))


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    at = 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            cut = text.find(b" ", end)
            end = len(text) if cut < 0 else cut
        yield text[at:end].split()
        at = end


def count_terms(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, counted per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple, tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))

        def send() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, docs) in groups.items():
                terms = list(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()), pa.array(terms, pa.binary()).cast(pa.string()),
                     pa.array([n[t] for t in terms], pa.int64()), pa.array([docs[t] for t in terms], pa.int64())],
                    names=["lang", "source", "term", "n", "docs"])
            groups.clear()

        for batch in batches:
            for lang, source, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                n, docs = groups[lang, source]
                words = text.encode().translate(FOLD)
                if len(words) <= PIECE:
                    terms = words.split()
                    n.update(terms)
                    docs.update(set(terms))
                else:
                    met: set[bytes] = set()
                    for terms in _pieces(words):
                        n.update(terms)
                        met.update(terms)
                    docs.update(met)
            if sum(len(n) for n, _ in groups.values()) > HELD:
                yield from send()
        yield from send()

    empty = F.lit("")
    rows = common.narrow(docs, lang="string", source="string", text="string")
    return rows.select(*[F.coalesce(c, empty).alias(c) for c in ("lang", "source", "text")]).mapInArrow(run, COUNTED)


def _share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + terms)), exact."""
    return F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(20,0)"), (total + terms).cast("decimal(20,0)")) + 1


def _part(p: Column | str, q: Column | str) -> Column:
    p, q = F.col(p) if isinstance(p, str) else p, F.col(q) if isinstance(q, str) else q
    return F.call_function("div", (p - q) * (p - q), q)


def _corrections(p: np.ndarray, z: np.ndarray, q: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Of a term present in both sources, whose shares are p and q, and z and y when absent."""

    def part(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) * (p - q) // q

    return part(p, q) - part(p, y) - part(z, q) + part(z, y)


def _sums(keys: np.ndarray, values: np.ndarray, times: np.ndarray) -> Iterator[tuple[int, int]]:
    """The exact sum of values * times of each key: values (below 2^62) go limb by limb,
    so that no sum of fewer than 2^42 times leaves 64 bits."""
    order = np.argsort(keys)
    keys, values, times = keys[order], values[order], times[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    low = (1 << LIMB) - 1
    limbs = (values & low, values >> LIMB & low, values >> 2 * LIMB)
    sums = [np.add.reduceat(x * times, starts).tolist() for x in limbs]
    for key, *parts in zip(keys[starts].tolist(), *sums):
        yield key, sum(x << LIMB * i for i, x in enumerate(parts))


def tree_pairs(paths: DataFrame) -> DataFrame:
    """Corrections of all pairs of sources that share a term: (lang, source, other, value).

    ``paths``: lang, path (array of source, p, zero in the order of the sources), m."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, str, str], int] = defaultdict(int)
        numbers: dict[str, int] = {}  # of the sources
        nodes: list[list[int]] = [[], [], [], [], []]  # source, p, zero, node above, terms that passed
        sources, shares, zeros, above, passed = nodes
        branch: list[int] = []

        def leave(keep: int) -> None:
            """Nodes below depth ``keep`` are complete."""
            while len(branch) > keep:
                n = branch.pop()
                if branch:
                    passed[branch[-1]] += passed[n]

        def settle(lang: str) -> None:
            """Each complete node meets its ancestors once; the branch stays."""
            names = list(numbers)
            source, share, zero, up, m = (np.array(x, np.int64) for x in nodes)
            complete = np.ones(len(up), bool)
            complete[branch] = False
            n = np.flatnonzero(complete)
            a = up[n]
            while (met := a >= 0).any():
                n, a = n[met], a[met]
                mine, theirs = (share[n], zero[n]), (share[a], zero[a])
                for x, y, of, other in ((mine, theirs, n, a), (theirs, mine, a, n)):
                    for key, value in _sums(source[of] << 32 | source[other], _corrections(*x, *y), m[n]):
                        sums[lang, names[key >> 32], names[key & 0xFFFFFFFF]] += value
                a = up[a]
            for x in nodes:
                x[:] = [x[n] for n in branch]
            branch[:] = range(len(branch))
            above[:] = range(-1, len(branch) - 1)

        def send() -> pa.RecordBatch:
            from decimal import Decimal

            keys, values = list(sums), [Decimal(v) for v in sums.values()]
            sums.clear()
            return pa.RecordBatch.from_arrays(
                [*[pa.array([k[i] for k in keys], pa.string()) for i in range(3)], pa.array(values, pa.decimal128(38, 0))],
                names=["lang", "source", "other", "value"])

        at = None
        for batch in batches:
            path = batch.column(1)
            entries = path.flatten()
            source = [numbers.setdefault(x, len(numbers)) for x in entries.field(0).to_pylist()]
            p, zero = entries.field(1).to_pylist(), entries.field(2).to_pylist()
            end = 0
            for lang, length, m in zip(batch.column(0).to_pylist(), path.value_lengths().to_pylist(), batch.column(2).to_pylist()):
                start, end = end, end + length
                if lang != at:
                    leave(0)
                    settle(at)
                    at = lang
                same = 0
                while same < min(len(branch), length) and sources[branch[same]] == source[start + same] and shares[branch[same]] == p[start + same]:
                    same += 1
                leave(same)
                if len(passed) > max(NODES, 2 * len(branch)):
                    settle(lang)
                for i in range(start + same, end):
                    above.append(branch[-1] if branch else -1)
                    branch.append(len(sources))
                    sources.append(source[i])
                    shares.append(p[i])
                    zeros.append(zero[i])
                    passed.append(0)
                passed[branch[-1]] += m
                if len(sums) > HELD:
                    yield send()
        leave(0)
        settle(at)
        yield send()

    in_order = paths.repartitionByRange("lang", "path").sortWithinPartitions("lang", "path").select("lang", "path", "m")
    return in_order.mapInArrow(run, MEETING).groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part (``pair``, ``term``), item, value, rank."""
    terms = (
        count_terms(docs).repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        .groupBy("lang", "term").agg(F.collect_list(F.struct("source", "n")).alias("entries"), F.sum("n").alias("total"), F.sum("docs").alias("docs"))
        .filter(F.col("docs") >= least_docs).drop("docs")
    )
    terms = common.stash(terms, "kept-terms")
    langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("lang_total"))
    entries = terms.select("lang", "term", "total", F.explode("entries").alias("e")).select("lang", "term", "total", "e.source", "e.n")
    occurring = common.narrow(docs, lang="string", source="string").select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    sizes = entries.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    none, zero_count = F.lit(0).cast("long"), F.lit(0).cast("long")
    groups = occurring.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", F.coalesce("size", none).alias("size"), F.coalesce("terms", none).alias("terms"), F.coalesce("lang_total", none).alias("lang_total"))
    groups = common.stash(groups.withColumn("zero", F.when(F.col("terms") > 0, _share(zero_count, F.col("size"), F.col("terms")))), "groups")
    shares = entries.join(groups, ["lang", "source"]).select(
        "lang", "term", "source", "zero", _share(F.col("n"), F.col("size"), F.col("terms")).alias("p"),
        _share(F.col("total"), F.col("lang_total"), F.col("terms")).alias("lang_p"))
    shares = common.stash(shares, "shares")
    return _pairs(groups, shares).unionByName(_terms(shares, top))


def _terms(shares: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
    above = shares.filter("p > lang_p").select("lang", "source", "term", _part("p", "lang_p").alias("value"))
    return above.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")


def _pairs(groups: DataFrame, shares: DataFrame) -> DataFrame:
    g = groups.select("lang", "source", "zero", "terms")
    h = groups.select("lang", F.col("source").alias("other"), F.col("zero").alias("other_zero"))
    # the pairs of sources are the rows of the result
    both = g.join(h, "lang").filter("source <> other")
    base = both.select("lang", "source", "other", F.coalesce(F.col("terms") * _part("zero", "other_zero"), F.lit(0)).cast("decimal(38,0)").alias("value"))
    met = shares.groupBy("lang", "source", "zero", "p").agg(F.count(F.lit(1)).alias("m"))
    zeros = h.groupBy("lang", "other_zero").agg(F.collect_list("other").alias("others"))  # sources of one size are one row
    one = met.join(zeros, "lang")
    times = F.col("m").cast("decimal(20,0)")
    mine = one.groupBy("lang", "source", "others").agg(F.sum(times * (_part("p", "other_zero") - _part("zero", "other_zero"))).alias("value")).select(
        "lang", "source", F.explode("others").alias("other"), "value")
    theirs = one.groupBy("lang", "source", "others").agg(F.sum(times * (_part("other_zero", "p") - _part("other_zero", "zero"))).alias("value")).select(
        "lang", F.explode("others").alias("source"), F.col("source").alias("other"), "value")
    paths = shares.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("source", "p", "zero"))).alias("path"))
    tree = tree_pairs(paths.groupBy("lang", "path").agg(F.count(F.lit(1)).alias("m")))
    parts = [base, *[d.filter("source <> other").select("lang", "source", "other", F.col("value").cast("decimal(38,0)").alias("value")) for d in (mine, theirs, tree)]]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    summed = every.groupBy("lang", "source", "other").agg(F.sum("value").cast("long").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "other")
    return summed.select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value", F.row_number().over(order).alias("rank"))


ORACLE_SQL = rf"""
WITH d AS (SELECT coalesce(text, '') AS t, coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r FROM documents),
w AS (
  SELECT r, lang, source,
    unnest(regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM d),
kept AS (SELECT lang, term, count(*)::HUGEINT AS total FROM w GROUP BY ALL HAVING count(DISTINCT r) >= {LEAST_DOCS}),
n AS (SELECT w.lang, w.source, w.term, count(*)::HUGEINT AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
l AS (SELECT lang, count(*)::HUGEINT AS v, sum(total)::HUGEINT AS total FROM kept GROUP BY lang),
g AS (
  SELECT o.lang, o.source, coalesce(s.size, 0)::HUGEINT AS size, l.v FROM (SELECT DISTINCT lang, source FROM d) o
  LEFT JOIN (SELECT lang, source, sum(n) AS size FROM n GROUP BY ALL) s USING (lang, source) LEFT JOIN l USING (lang)),
p AS (
  SELECT g.lang, g.source, kept.term, coalesce(n.n, 0) AS n, 1 + ({SCALE}::HUGEINT * (coalesce(n.n, 0) + 1)) // (g.size + g.v) AS p,
    1 + ({SCALE}::HUGEINT * (kept.total + 1)) // (l.total + l.v) AS lang_p
  FROM g JOIN kept USING (lang) JOIN l USING (lang) LEFT JOIN n USING (lang, source, term)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p)::BIGINT AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pairs.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - lang_p) * (p - lang_p) // lang_p)::BIGINT FROM p WHERE n > 0 AND p > lang_p)
SELECT lang, source, part, item, value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM every QUALIFY part = 'pair' OR rank <= {TOP_TERMS}"""

"""Exact top-k inner products by dual-tree search over cover trees.

A farthest-first walk over a bounded sample gives a few global centres; vectors go
to the nearest one, and blocks hold neighbours of one centre.  Each block of data and
of queries is indexed once by a cover tree, stored with the block: a farthest-first
walk orders the block's points, the points that stand further than r from all before
them are the centres of radius r, radii fall by ``BASE`` from level to level, and a
node's parent is the nearest centre of the level above.

Query and data trees are walked together, level by level: a pair of nodes goes when
even the best inner product that their covering radii allow is below the worst k-th
score of the queries in the query node; children of the pairs left are next.  A first
round against the block of the nearest centre gives every query a k-th score; block
pairs whose roots cannot reach it are dropped before any vector is sent.

Independent directions in many dimensions have no near neighbours: their trees are
flat, and the bound of a single vector is its score, so one product for each
query and vector remains there.

Components are scaled to integers (floor of 256 times the component), so scores
are exact: products run in float64 where every sum is below 2^52, else in 64-bit
integers (scaled components beyond 64 bits are held at their ends, sums wrap).

Cases: vectors that are null, hold a null or a non-finite component take no
part; vectors of different lengths are not compared; empty vectors score 0; rows
repeating a vec_id are one vector (the greatest, if they differ); a null vec_id takes
no part; ties go to the smaller vec_id; a query with fewer than k candidates returns
them all; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm import common

SCALE, EVERY, K = 256, 50, 5
BLOCK, QUERY_BLOCK = 2048, 1024
BASE, LEAF = 1.3, 8  # radius of a level over the next; mean points of a last node at most
CENTRES, SAMPLE, SAMPLE_BYTES = 64, 2048, 1 << 24  # global centres and the sample they come from
NO_SCORE, NO_ID = np.iinfo(np.int64).min, np.iinfo(np.int64).max

LEVEL = "lo binary, centre binary, radius binary, parent binary"
PACKED = f"dim int, ids binary, width int, vectors binary, levels array<struct<{LEVEL.replace(' binary', ': binary')}>>, root array<double>, reach double"
FOUND = "query_id long, vec_id long, score long"


def farthest_first(points: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, gap): up to ``limit`` rows, each the farthest from those before it, and
    its distance from them.  Copies of chosen rows are never chosen."""
    square = (points * points).sum(axis=1)
    far = np.full(len(points), np.inf)
    order, gap, at = [], [], 0
    while len(order) < limit and far[at] > 0:
        order.append(at)
        gap.append(far[at])
        apart = square + square[at] - 2 * (points @ points[at])
        far = np.minimum(far, np.sqrt(np.maximum(apart, 0.0)))
        far[at] = 0.0
        at = int(far.argmax())
    return np.array(order, np.int64), np.array(gap)


@dataclass
class Level:
    """Nodes of one radius; node i holds the points lo[i] to lo[i + 1]."""

    lo: np.ndarray
    centre: np.ndarray  # point of each node that is its centre
    radius: np.ndarray
    parent: np.ndarray  # node of the level above

    def pack(self) -> dict[str, bytes]:
        return {"lo": self.lo.tobytes(), "centre": self.centre.tobytes(), "radius": self.radius.tobytes(), "parent": self.parent.tobytes()}

    @staticmethod
    def unpack(row: dict) -> Level:
        whole = {n: np.frombuffer(row[n], np.int64) for n in ("lo", "centre", "parent")}
        return Level(radius=np.frombuffer(row["radius"]), **whole)


class CoverTree:
    """A cover tree over the rows of a matrix, whose points stand in the tree's order."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, levels: list[Level] | None = None):
        self.ids, self.whole = ids, vectors.astype(np.int64)
        biggest = float(np.abs(self.whole.astype(np.float64)).max()) if vectors.size else 0.0
        self.wide = biggest**2 * max(vectors.shape[1], 1) >= 2**52
        self.real = self.whole.astype(np.float64)
        if levels is None:
            levels = self._grow()
        self.norm = np.sqrt((self.real * self.real).sum(axis=1))
        self.levels = levels

    def _grow(self) -> list[Level]:
        by_id = np.argsort(self.ids, kind="stable")
        self.ids, self.whole, self.real = self.ids[by_id], self.whole[by_id], self.real[by_id]
        points, n = self.real, len(self.ids)
        order, gap = farthest_first(points, max(1, n // LEAF) + 1)
        rank = [1]  # centres of each level: the first so many of the walk
        reach = gap[1] if len(gap) > 1 else 0.0
        while rank[-1] < len(order):
            reach /= BASE
            inside = int((gap > reach).sum())
            if inside > rank[-1]:
                rank.append(inside)
        square = (points * points).sum(axis=1)
        apart = np.maximum(square[:, None] + square[order] - 2 * (points @ points[order].T), 0.0)
        if self.wide:  # distances that are not exact: never too short
            apart = apart + 1e-9 * (square[:, None] + square[order])
        # nearest last centre of each point, then of each centre one level up
        node_of = [apart.argmin(axis=1)]
        up = []
        for above in reversed(rank[:-1]):
            step = apart[order, :above].argmin(axis=1)
            step[:above] = np.arange(above)
            up.append(step)
            node_of.append(step[node_of[-1]])
        node_of, up = node_of[::-1], up[::-1]
        place = np.lexsort(tuple(reversed(node_of)))
        where = np.empty(n, np.int64)
        where[place] = np.arange(n)
        levels, numbers = [], None
        for i, nodes in enumerate(node_of):
            sorted_nodes = nodes[place]
            lo = np.flatnonzero(np.r_[True, sorted_nodes[1:] != sorted_nodes[:-1]])
            chosen = sorted_nodes[lo]
            far = np.sqrt(np.maximum.reduceat(apart[place, sorted_nodes], lo))
            parent = np.zeros(len(lo), np.int64) if i == 0 else numbers[up[i - 1][chosen]]
            numbers = np.zeros(rank[i], np.int64)
            numbers[chosen] = np.arange(len(lo))
            levels.append(Level(np.r_[lo, n].astype(np.int64), where[order[chosen]], far, parent))
        self.ids, self.whole, self.real = self.ids[place], self.whole[place], self.real[place]
        return levels


class Best:
    """The k best of each query of a tree, in the tree's order."""

    def __init__(self, tree: CoverTree, k: int, floor: np.ndarray):
        self.score = np.full((len(tree.ids), k), NO_SCORE, np.int64)
        self.ids = np.full((len(tree.ids), k), NO_ID, np.int64)
        self.floor = floor  # scores known to be among or below the k best
        self.worst = floor.copy()
        self.bounded = self.scored = 0  # node pairs bounded, vector pairs scored

    def offer(self, lo: int, hi: int, score: np.ndarray, ids: np.ndarray) -> None:
        hit = score >= self.worst[lo:hi, None]
        rows, columns = np.flatnonzero(hit.any(axis=1)), np.flatnonzero(hit.any(axis=0))
        if not len(rows):
            return
        score, ids = score[np.ix_(rows, columns)], ids[columns]
        rows = lo + rows
        all_scores = np.concatenate([self.score[rows], score], axis=1)
        all_ids = np.concatenate([self.ids[rows], np.broadcast_to(ids, score.shape)], axis=1)
        all_ids = np.where(all_scores == NO_SCORE, NO_ID, all_ids)
        first = np.lexsort((all_ids, ~all_scores), axis=-1)  # ~s falls as s rises, without overflow
        first = first[:, : self.score.shape[1]]
        self.score[rows] = np.take_along_axis(all_scores, first, 1)
        self.ids[rows] = np.take_along_axis(all_ids, first, 1)
        self.worst[rows] = np.maximum(self.floor[rows], self.score[rows, -1])


def _bounds(queries: CoverTree, q: Level, data: CoverTree, d: Level) -> np.ndarray:
    """No inner product of a point of a query node and one of a data node exceeds this."""
    q_norm, d_norm = queries.norm[q.centre][:, None], data.norm[d.centre]
    q_far, d_far = q.radius[:, None], d.radius
    best = queries.real[q.centre] @ data.real[d.centre].T
    best += q_far * d_norm + d_far * q_norm + q_far * d_far
    return best + 1e-9 * (q_norm + q_far) * (d_norm + d_far) + 1e-3


def search(queries: CoverTree, data: CoverTree, k: int, floor: np.ndarray) -> Best:
    """The k best of every query, among scores of at least its floor."""
    best = Best(queries, k, floor)
    if not len(queries.ids) or not len(data.ids):
        return best
    wide = queries.wide or data.wide
    depth = max(len(queries.levels), len(data.levels))
    alive = np.ones((1, 1), bool)
    for i in range(depth):
        q, d = queries.levels[min(i, len(queries.levels) - 1)], data.levels[min(i, len(data.levels) - 1)]
        if i:
            rows = q.parent if i < len(queries.levels) else np.arange(len(q.centre))
            columns = d.parent if i < len(data.levels) else np.arange(len(d.centre))
            alive = alive[np.ix_(rows, columns)]
        best.bounded += int(alive.sum())
        least = np.minimum.reduceat(best.worst, q.lo[:-1])
        alive &= _bounds(queries, q, data, d) >= least[:, None]
        if not alive.any():
            return best
    size = np.diff(d.lo)
    for n in np.flatnonzero(alive.any(axis=1)):
        lo, hi = int(q.lo[n]), int(q.lo[n + 1])
        # the bound of each query of the node itself, on the data nodes left
        left = np.flatnonzero(alive[n])
        own = queries.real[lo:hi] @ data.real[d.centre[left]].T + queries.norm[lo:hi, None] * d.radius[left]
        own += 1e-9 * queries.norm[lo:hi, None] * (data.norm[d.centre[left]] + d.radius[left]) + 1e-3
        best.bounded += own.size
        keep = own >= best.worst[lo:hi, None]
        left = left[keep.any(axis=0)]
        if not len(left):
            continue
        ends = np.cumsum(size[left])
        at = np.arange(ends[-1]) + np.repeat(d.lo[left] - (ends - size[left]), size[left])
        best.scored += len(at) * (hi - lo)
        if wide:
            score = queries.whole[lo:hi] @ data.whole[at].T
        else:
            score = (queries.real[lo:hi] @ data.real[at].T).astype(np.int64)
        best.offer(lo, hi, np.where(queries.ids[lo:hi, None] == data.ids[at], NO_SCORE, score), data.ids[at])
    return best


def scaled(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): one scaled vector per id."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    sound = rows.filter("vec_id is not null and v is not null").filter(F.forall("v", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))))
    one = sound.groupBy("vec_id").agg(F.max("v").alias("v"))
    return one.select("vec_id", F.transform("v", lambda x: F.floor(x * SCALE).cast("long")).alias("v"))


def centres(rows: DataFrame) -> dict[int, np.ndarray]:
    """Global centres of each vector length: a farthest-first walk over a sample by
    hash of about ``SAMPLE`` vectors (fewer, if they exceed ``SAMPLE_BYTES``)."""
    counts = {r.dim: r.n for r in rows.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n")).collect()}
    out = {}
    for dim, n in counts.items():
        wanted = min(SAMPLE, SAMPLE_BYTES // (8 * max(dim, 1)) + 1)
        part = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 40)) < int((1 << 40) * min(1.0, wanted / n))
        sample = [r.v for r in rows.filter((F.size("v") == dim) & part).select("v").collect()]
        if sample and dim:
            points = np.array(sample, np.float64)
            out[dim] = points[farthest_first(points, CENTRES)[0]]
    return out


def dealt(rows: DataFrame, near: dict[int, np.ndarray]) -> DataFrame:
    """Rows with their nearest global centre (cell) and the distance from it (far)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = b.column("v")
            sizes = column.value_lengths().to_numpy(zero_copy_only=False)
            cell, far = np.zeros(len(b), np.int32), np.zeros(len(b))
            for dim in np.unique(sizes):
                if int(dim) in near:
                    at = np.flatnonzero(sizes == dim)
                    points = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(at), dim)
                    c = near[int(dim)]
                    apart = (c * c).sum(axis=1) - 2 * (points @ c.T)
                    cell[at] = apart.argmin(axis=1)
                    far[at] = np.sqrt(np.maximum(apart.min(axis=1) + (points * points).sum(axis=1), 0.0))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), column, pa.array(sizes, pa.int32()), pa.array(cell), pa.array(far)], ["vec_id", "v", "dim", "cell", "far"])

    return rows.mapInArrow(run, "vec_id long, v array<long>, dim int, cell int, far double")


def pack(rows: DataFrame, size: int) -> DataFrame:
    """Blocks of at most ``size`` vectors of one length with their trees; rows come in
    the order of their cells, and a block of a quarter of the size ends with its cell."""

    def block(dim: int, held: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
        tree = CoverTree(np.array([i for i, _ in held], np.int64), np.stack([v for _, v in held]))
        kind = next((t for t in (np.int16, np.int32) if not tree.whole.size or (tree.whole.min() >= np.iinfo(t).min and tree.whole.max() <= np.iinfo(t).max)), np.int64)
        root = tree.levels[0]
        row = {
            "dim": dim, "ids": tree.ids.tobytes(), "width": np.dtype(kind).itemsize, "vectors": tree.whole.astype(kind).tobytes(),
            "levels": [x.pack() for x in tree.levels], "root": tree.real[root.centre[0]].tolist(), "reach": float(root.radius[0]),
        }
        nested = pa.list_(pa.struct([(n, pa.binary()) for n in ("lo", "centre", "radius", "parent")]))
        types = [pa.int32(), pa.binary(), pa.int32(), pa.binary(), nested, pa.list_(pa.float64()), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row.values(), types)], list(row))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for b in batches:
            column, cells, dims = b.column("v"), b.column("cell").to_pylist(), b.column("dim").to_pylist()
            for i, vec in enumerate(b.column("vec_id").to_pylist()):
                here = (dims[i], cells[i])
                if held and (len(held) >= size or here[0] != last[0] or (here != last and 4 * len(held) >= size)):
                    yield block(last[0], held)
                    held = []
                held.append((vec, np.asarray(column[i].values, np.int64)))
                last = here
        if held:
            yield block(last[0], held)

    return rows.mapInArrow(run, PACKED)


def blocks(rows: DataFrame, near: dict[int, np.ndarray], size: int, prefix: str) -> DataFrame:
    """Numbered blocks of neighbouring vectors, written once."""
    cells = dealt(rows, near)
    keys = ["dim", "cell", "far", "vec_id"]
    parts = max(1, rows.count() // (4 * size))
    packed = pack(cells.repartitionByRange(parts, *keys).sortWithinPartitions(*keys), size)
    named = packed.select(F.monotonically_increasing_id().alias("block"), *packed.columns)
    named = named.select(*["dim" if c == "dim" else F.col(c).alias(prefix + c) for c in named.columns])
    return common.stash(named, f"{prefix}blocks")


def _tree(r: dict, prefix: str) -> CoverTree:
    ids = np.frombuffer(r[f"{prefix}ids"], np.int64)
    vectors = np.frombuffer(r[f"{prefix}vectors"], f"i{r[f'{prefix}width']}").reshape(len(ids), r["dim"])
    return CoverTree(ids, vectors, [Level.unpack(x) for x in r[f"{prefix}levels"]])


def _meet(pairs: DataFrame, k: int, seeds: bool) -> DataFrame:
    """Search rows of a query block (with floors, if known) and a data block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for n in range(len(b)):
                r = b.slice(n, 1).to_pylist()[0]
                q, d = _tree(r, "q_"), _tree(r, "")
                floor = np.full(len(q.ids), NO_SCORE, np.int64) if seeds else np.frombuffer(r["floors"], np.int64)
                best = search(q, d, k, floor)
                if seeds:
                    yield pa.RecordBatch.from_pylist([{"q_block": r["q_block"], "floors": best.worst.tobytes(), "least": int(best.worst.min())}])
                else:
                    row, column = np.nonzero(best.ids != NO_ID)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(q.ids[row]), pa.array(best.ids[row, column]), pa.array(best.score[row, column])], ["query_id", "vec_id", "score"],
                    )

    return pairs.mapInArrow(run, "q_block long, floors binary, least long" if seeds else FOUND)


def _dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of every query (vec_id divisible by ``every``)."""
    rows = common.stash(scaled(vectors), "vectors")
    near = centres(rows)
    data = blocks(rows, near, BLOCK, "")
    queries = blocks(rows.filter(F.col("vec_id") % every == 0), near, QUERY_BLOCK, "q_")
    # roots of all block pairs: data roots are dealt to groups, and each group gets all
    # query roots (a few numbers a block; no vectors yet)
    groups = max(1, data.count() // 64)
    roots = data.select("dim", "block", "root", "reach", F.pmod(F.xxhash64("block"), F.lit(groups)).alias("group"))
    sent = queries.select("dim", "q_block", "q_root", "q_reach", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("group"))
    met = roots.join(sent, ["dim", "group"])
    norm, q_norm = F.sqrt(_dot("root", "root")), F.sqrt(_dot("q_root", "q_root"))
    bound = _dot("root", "q_root") + F.col("reach") * q_norm + F.col("q_reach") * norm + F.col("reach") * F.col("q_reach")
    slack = (norm + F.col("reach")) * (q_norm + F.col("q_reach")) * 1e-9 + 1e-3
    pairs = common.stash(met.select("q_block", "block", _dot("root", "q_root").alias("close"), (bound + slack).alias("bound")), "block-pairs")
    # the first round: each query block and the data block of the closest root
    first = pairs.groupBy("q_block").agg(F.max_by("block", F.struct("close", -F.col("block"))).alias("block"))
    floors = common.stash(_meet(queries.join(first, "q_block").join(data.drop("dim"), "block"), k, seeds=True), "floors")
    # the second: block pairs that can still reach a query's floor
    left = pairs.join(floors.select("q_block", "least"), "q_block").filter(F.col("bound") >= F.col("least").cast("double")).select("q_block", "block")
    found = _meet(left.join(queries.join(floors, "q_block"), "q_block").join(data.drop("dim"), "block"), k, seeds=False)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def oracle_sql(k: int = K, every: int = EVERY) -> str:
    """DuckDB SQL for ``top_k``."""
    return f"""
WITH v AS (
  SELECT vec_id, max(embedding) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 GROUP BY vec_id),
i AS (SELECT vec_id, list_transform(e, lambda x: floor({SCALE} * x::DOUBLE)::DOUBLE) AS x FROM v),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id, list_dot_product(q.x, d.x)::BIGINT AS score
  FROM i q JOIN i d ON q.vec_id % {every} = 0 AND q.vec_id <> d.vec_id AND len(q.x) = len(d.x)),
r AS (SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {k}"""

"""Exact ranking, caps, splits and samples without a global sort.

``ordered_slices`` is the one custom plan pattern: it gives every row the slice
of its exact position in a hash order (as ``row_number() over (order by key)``
would).  Only the cut points matter:

* the input is computed once and written with a hash and a number of each row, so
  rows of equal keys, and equal rows, have an order of their own (``numbered``);
* counts per (group, key prefix) over the key column of that table name the bucket
  of each cut; only the keys of those buckets are ranked, as counts of equal rows;
  a cut inside a run of equal rows is placed by counts per written part;
* every row is then labelled where it stands, in the one pass that reads the
  content, by comparing (key, hash, number) with the cuts of its group.

So no content column is shuffled, whatever the size of the table or the skew of
its groups, and slices of slices (a cap, then a split) read the same table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import write_through

DIGITS = 4  # leading hex digits of a bucket: 65,536 buckets in a group
LOCAL_CUTS = 40_000  # tables of so many cuts at most are sent to every task
HASH, NUMBER = "_q_h", "_q_rid"
PART_BITS = 33  # monotonically increasing ids: written part above, row in it below


def numbered(df: DataFrame) -> DataFrame:
    """``df`` written once, with a hash of each row and a number that no other row has."""
    if HASH in df.columns and NUMBER in df.columns:
        return df
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return write_through(df.select("*", row.alias(HASH), F.monotonically_increasing_id().alias(NUMBER)), "numbered")


def _same_group(part: list[str], prefix: str) -> Column:
    on = F.lit(True)
    for i, c in enumerate(part):
        on = on & F.col(c).eqNullSafe(F.col(f"{prefix}{i}"))
    return on


def _renamed(df: DataFrame, part: list[str], prefix: str, *more: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}{i}") for i, c in enumerate(part)], *more)


def _crossing(keys: DataFrame, bounds: Callable[[Column], list[Column]], part: list[str]) -> DataFrame:
    """(group, i, key, hash, take): the run of equal rows that holds cut i, and how many
    of its rows come before the cut."""
    counts = keys.groupBy(*part, "_b").agg(F.count(F.lit(1)).alias("_c"))
    # at most 16**digits rows of each group; a window over counts, not over rows
    order = Window.partitionBy(*part).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*part)
    placed = counts.withColumn("_end", F.sum("_c").over(order)).withColumn("_n", F.sum("_c").over(whole))
    ends = F.array(*[b.cast("bigint") for b in bounds(F.col("_n"))])
    wanted = (
        placed.select(*part, "_b", (F.col("_end") - F.col("_c")).alias("_start"), "_end", F.posexplode(ends).alias("_i", "_at"))
        .filter((F.col("_at") >= F.col("_start")) & (F.col("_at") < F.col("_end")))
    )
    held = wanted.groupBy(*part, "_b").agg(F.min("_start").alias("_start"), F.collect_list(F.struct("_i", "_at")).alias("_wanted"))
    held = _renamed(held, part, "_p", "_start", "_wanted", F.col("_b").alias("_hb"))
    runs = keys.groupBy(*part, "_b", "_k", HASH).agg(F.count(F.lit(1)).alias("_c"))
    near = runs.join(held, (F.col("_b") == F.col("_hb")) & _same_group(part, "_p"))
    order = Window.partitionBy(*part, "_b").orderBy("_k", HASH).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = near.withColumn("_to", F.col("_start") + F.sum("_c").over(order)).withColumn("_from", F.col("_to") - F.col("_c"))
    return (
        ranked.select(*part, "_k", HASH, "_from", "_to", F.explode("_wanted").alias("_w"))
        .filter((F.col("_w._at") >= F.col("_from")) & (F.col("_w._at") < F.col("_to")))
        .select(*part, F.col("_w._i").alias("i"), F.col("_k").alias("key"), F.col(HASH).alias("hash"), (F.col("_w._at") - F.col("_from")).alias("take"))
    )


def _inside(keys: DataFrame, cuts: DataFrame, part: list[str]) -> DataFrame:
    """(group, i, number): the first row after a cut that falls inside a run of equal
    rows.  Counts per written part come first, so one part's rows at most are ranked."""
    inner = _renamed(cuts.filter("take > 0"), part, "_p", "i", "key", F.col("hash").alias("_ch"), "take")
    tied = keys.join(inner, (F.col("_k") == F.col("key")) & (F.col(HASH) == F.col("_ch")) & _same_group(part, "_p"))
    tied = tied.select(*part, "i", "take", F.col(NUMBER).alias("number"), F.shiftright(NUMBER, PART_BITS).alias("part"))
    counts = tied.groupBy(*part, "i", "part").agg(F.count(F.lit(1)).alias("_c"), F.min("take").alias("take"))
    order = Window.partitionBy(*part, "i").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = counts.withColumn("_to", F.sum("_c").over(order)).withColumn("_from", F.col("_to") - F.col("_c")).filter("take >= _from and take < _to")
    at = _renamed(at, part, "_p", F.col("i").alias("_i"), F.col("part").alias("_part"), (F.col("take") - F.col("_from")).alias("_nth"))
    rows = tied.join(at, (F.col("i") == F.col("_i")) & (F.col("part") == F.col("_part")) & _same_group(part, "_p"))
    order = Window.partitionBy(*part, "i").orderBy("number")
    return rows.withColumn("_r", F.row_number().over(order)).filter("_r = _nth + 1").select(*part, "i", "number")


def ordered_slices(
    df: DataFrame,
    key: str,
    bounds: Callable[[Column], list[Column]],
    partition_by: Sequence[str] = (),
    keep: Sequence[int] | None = None,
    slice_col: str = "slice",
    digits: int = DIGITS,
) -> DataFrame:
    """Label rows by the slice their rank falls in.

    ``key`` is a hex string column (an md5; null is the empty string); rows are
    ranked by it inside each ``partition_by`` group, rows of one key by a hash of
    their content.  ``bounds(n)`` maps the group size ``n`` to the cumulative slice
    ends ``[b1, b2, ...]``: rank r (0-based) is in slice i when ``b_i <= r < b_{i+1}``
    (b_0 = 0, last slice open).  Only ``keep`` slices are returned.

    The input is written and its cuts are found when this is called.  Up to
    ``LOCAL_CUTS`` cuts go to every task, beyond that they are joined by group.
    """
    spark, part = df.sparkSession, list(partition_by)
    rows = numbered(df)
    k = F.coalesce(F.col(key), F.lit(""))
    keys = rows.select(*part, k.alias("_k"), HASH, NUMBER).withColumn("_b", F.substring("_k", 1, digits))
    crossing = _crossing(keys, bounds, part)
    found = crossing.limit(LOCAL_CUTS + 1).collect()
    small = len(found) <= LOCAL_CUTS
    crossing = spark.createDataFrame(found, T.StructType(crossing.schema.fields)) if small else write_through(crossing, "cuts")
    first = F.lit(-1).cast("bigint").alias("number")  # before every row of the run
    cuts = crossing.filter("take = 0").select(*part, "i", "key", "hash", first)
    if not small or any(r["take"] > 0 for r in found):
        inside = _inside(keys, crossing, part)
        if small:
            inside = spark.createDataFrame(inside.collect(), inside.schema)
        inner = _renamed(inside, part, "_p", F.col("i").alias("_i"), "number")
        cuts = cuts.unionByName(
            crossing.filter("take > 0").join(inner, (F.col("i") == F.col("_i")) & _same_group(part, "_p")).select(*part, "i", "key", "hash", "number"))
    per_group = _renamed(cuts.groupBy(*part).agg(F.collect_list(F.struct("key", "hash", "number")).alias("_cuts")), part, "_g", "_cuts")
    joined = rows.join(F.broadcast(per_group) if small else per_group, _same_group(part, "_g"), "left")
    place = F.struct(k, F.col(HASH), F.col(NUMBER))
    above = F.size(F.filter(
        F.coalesce("_cuts", F.array().cast(per_group.schema["_cuts"].dataType)),
        lambda c: place >= F.struct(c["key"], c["hash"], c["number"])))
    out = joined.withColumn(slice_col, above.cast("int"))
    if keep is not None:
        out = out.filter(F.col(slice_col).isin([int(i) for i in keep]))
    return out.select(*[F.col(f"`{c}`") for c in df.columns], slice_col)


def split_bounds(train_ratio: float, val_ratio: float) -> Callable[[Column], list[Column]]:
    """train = floor(n*tr), val = floor(n*vr), test = the rest (IEEE doubles)."""

    def bounds(n: Column) -> list[Column]:
        nd = n.cast("double")
        train = F.floor(nd * F.lit(float(train_ratio)))
        val = F.floor(nd * F.lit(float(val_ratio)))
        return [train, train + val]

    return bounds


def cap_bounds(n_max: int) -> Callable[[Column], list[Column]]:
    return lambda n: [F.lit(n_max)]


SPLIT_NAMES = ["train", "val", "test"]


def exact_split(
    df: DataFrame,
    key: str,
    train_ratio: float,
    val_ratio: float,
    partition_by: Sequence[str] = (),
    split_col: str = "split",
) -> DataFrame:
    """Exact train/val/test split in ``key`` order (per stratum if given)."""
    out = ordered_slices(df, key, split_bounds(train_ratio, val_ratio), partition_by, slice_col="_q_slice")
    names = F.element_at(F.array(*[F.lit(x) for x in SPLIT_NAMES]), F.col("_q_slice") + 1)
    return out.withColumn(split_col, names).drop("_q_slice")


def cap_per_group(df: DataFrame, key: str, n_max: int, partition_by: Sequence[str] = ()) -> DataFrame:
    """First ``n_max`` rows of each group in ``key`` order; n_max <= 0 = no cap."""
    if n_max <= 0:
        return df
    out = ordered_slices(df, key, cap_bounds(n_max), partition_by, keep=[0], slice_col="_q_slice")
    return out.drop("_q_slice")


def top_k_per_group(df: DataFrame, k: int, partition_by: Sequence[str], order: Sequence[Column],
                    rank_col: str | None = None) -> DataFrame:
    """Top-k per group.  ``row_number() <= k`` lets Spark insert a per-partition
    WindowGroupLimit before the shuffle, so a hot group sends at most k rows per
    map task; k is a small report size."""
    if k <= 0:
        return df.limit(0)
    w = Window.partitionBy(*partition_by).orderBy(*order)
    out = df.withColumn("_q_rn", F.row_number().over(w)).filter(F.col("_q_rn") <= k)
    if rank_col:
        return out.withColumnRenamed("_q_rn", rank_col)
    return out.drop("_q_rn")


REPORT_ROWS = 10_000  # so many rows at most are picked by one task


def head_in_order(df: DataFrame, key: str, n: int) -> DataFrame:
    """First n rows in ``key`` order; n <= 0 = all rows.  A report of few rows is the
    merged top n of every task; a longer one is a slice."""
    if 0 < n <= REPORT_ROWS:
        return df.orderBy(F.col(key)).limit(n)
    return cap_per_group(df, key, n, ())


def sample_n(df: DataFrame, key: str, n: int) -> DataFrame:
    """n rows without replacement by a seeded hash order (all rows when fewer).
    ``orderBy().limit()`` plans as TakeOrderedAndProject: per-partition top-n."""
    if n <= 0:
        return df.limit(0)
    return df.orderBy(F.col(key)).limit(n)

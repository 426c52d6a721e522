"""Previous-row lookups that stay parallel when one key holds most rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def lag_within(df: DataFrame, keys: Sequence[str], order_col: str, value_cols: Sequence[str],
               bucket: int = 4096, prefix: str = "prev_") -> DataFrame:
    """``lag(value) over (partition by keys order by order_col)`` for integer orders.

    Rows are windowed per (keys, order_col // bucket), so one key never lands in
    a single task.  The first row of a bucket takes its previous value from the
    last row of the nearest earlier non-empty bucket: a per-bucket summary (one
    row per key and bucket, built with a map-side-combined max_by) with its own
    small lag.  ``order_col`` must be unique within a key.
    """
    keys = list(keys)
    b = F.floor(F.col(order_col) / F.lit(bucket)).cast("bigint")
    d = df.withColumn("_q_b", b)
    w = Window.partitionBy(*keys, "_q_b").orderBy(order_col)
    inner = d
    for c in [order_col, *value_cols]:
        inner = inner.withColumn(prefix + c, F.lag(c).over(w))
    last = d.groupBy(*keys, "_q_b").agg(
        F.max_by(F.struct(order_col, *value_cols), F.col(order_col)).alias("_q_last"))
    wb = Window.partitionBy(*keys).orderBy("_q_b")
    prev_bucket = last.select(*keys, "_q_b", F.lag("_q_last").over(wb).alias("_q_prev"))
    joined = inner.join(prev_bucket, [*keys, "_q_b"], "left")
    out = joined.withColumn("_q_first", F.col(prefix + order_col).isNull())
    for c in [order_col, *value_cols]:
        out = out.withColumn(prefix + c, F.when(F.col("_q_first"), F.col("_q_prev")[c]).otherwise(F.col(prefix + c)))
    return out.drop("_q_b", "_q_prev", "_q_first")


def row_numbers(df: DataFrame, group: str, order: str, width: int = 10_000, number_col: str = "line_no") -> DataFrame:
    """Exact ``row_number`` per group by an integer column, without a window over a whole
    group: rows are ranked within ranges of ``width`` values, and the counts of earlier
    ranges (one row a range) are added.

    A group of a third of all rows is ranked by many tasks as long as ``order`` is spread
    over many ranges.  Ties get different numbers in any order; nulls come first."""
    ranged = df.withColumn("_range", F.floor(F.col(order) / width))
    sizes = ranged.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col(group).alias("_group"), F.col("_range").alias("_at"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    ranked = ranged.withColumn("_nth", F.row_number().over(Window.partitionBy(group, "_range").orderBy(order)))
    joined = ranked.join(starts, ranked[group].eqNullSafe(starts["_group"]) & ranked["_range"].eqNullSafe(starts["_at"]))
    return joined.withColumn(number_col, (F.col("_before") + F.col("_nth")).cast("bigint")).select(*df.columns, number_col)

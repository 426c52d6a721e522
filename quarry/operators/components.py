"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import temporary_tables, write_through


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in the links (a, b); the component is named by
    its smallest id.

    Alternating large-star and small-star steps: every id is tied to the smallest
    one it sees, first its larger neighbours, then its smaller ones, until every id
    is either tied to one id or has others tied to it.  The number
    of rounds grows with the logarithm of the longest chain; each round's links
    are written to the shared folder, and the driver sees only whether an id is left
    that is neither; tables of earlier rounds are removed.  Minima are combined before the shuffle, and an id with very many
    links is a skewed join key that adaptive execution can split."""
    with temporary_tables(links.sparkSession):
        now = write_through(_ordered(links), "links")
        while not _stars(now):
            both = now.unionAll(now.select(F.col("low").alias("high"), F.col("high").alias("low")))
            least = both.groupBy("high").agg(F.min("low").alias("least")).select("high", F.least("high", "least").alias("least"))
            large = both.join(least, "high").filter("low > high").select(F.col("low").alias("a"), F.col("least").alias("b"))
            large = write_through(_ordered(large), "large-star")
            least = large.groupBy("high").agg(F.min("low").alias("least"))
            small = large.join(least, "high").select(F.col("low").alias("a"), F.col("least").alias("b"))
            now = write_through(_ordered(small.unionAll(least.select(F.col("high").alias("a"), F.col("least").alias("b")))), "small-star")
        ends = now.select("low").distinct()
        named = now.select(F.col("high").alias("id"), F.col("low").alias("component")).unionAll(
            ends.select(F.col("low").alias("id"), F.col("low").alias("component"))
        )
        return write_through(named, "components", keep=True)


def _ordered(links: DataFrame) -> DataFrame:
    """Distinct links as (high, low), none of an id to itself."""
    return links.filter("a != b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct()


def _stars(links: DataFrame) -> bool:
    """Whether each id is the low end of its links or the high end of a single one."""
    ends = links.select(F.col("high").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        links.select(F.col("low").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    met = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not met.agg(F.coalesce(F.max(F.col("up") + F.col("down")), F.lit(0)) > 1).first()[0]


def join_components(found: DataFrame, links: DataFrame) -> DataFrame:
    """``found`` (id, component) after further links (a, b): only components meet."""
    with temporary_tables(links.sparkSession):
        ends = links
        for end in ("a", "b"):
            named = found.select(F.col("id").alias(end), F.col("component").alias("of"))
            ends = ends.join(named, end, "left").withColumn(end, F.coalesce("of", end)).drop("of")
        joined = components(ends)
        every = found.unionAll(joined.select("id", F.col("id").alias("component"))).distinct()
        after = joined.select(F.col("id").alias("component"), F.col("component").alias("after"))
        placed = every.join(after, "component", "left").select("id", F.coalesce("after", "component").alias("component"))
        return write_through(placed, "components", keep=True)

"""Landed repository payloads: search hits, README payloads, recursive trees.

JSON with explicit nested schemas (no inference); the three tables are keyed
by (owner, name).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TREE_ITEM = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("type", T.StringType()),
    T.StructField("size", T.LongType()),
])
HIT = T.StructType([
    T.StructField("owner", T.StructType([T.StructField("login", T.StringType())])),
    T.StructField("name", T.StringType()),
    T.StructField("html_url", T.StringType()),
    T.StructField("stargazers_count", T.LongType()),
    T.StructField("language", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("pushed_at", T.StringType()),
])
# a line is one hit, or a page of search results with an array of hits
HIT_SCHEMA = T.StructType([*HIT.fields, T.StructField("items", T.ArrayType(HIT))])
README_SCHEMA = T.StructType([
    T.StructField("owner", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("content", T.StringType()),
])
TREE_SCHEMA = T.StructType([
    T.StructField("owner", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("tree", T.ArrayType(TREE_ITEM)),
])


CONTENT_SCHEMA = T.StructType([
    T.StructField("owner", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("path", T.StringType()), T.StructField("content", T.StringType()),
])


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    """Search hits flattened to (owner, name, html_url, stars, language, pushed_at, description)."""
    raw = spark.read.schema(HIT_SCHEMA).json(path)
    one = F.struct(*[F.col(f.name) for f in HIT.fields])
    hits = raw.select(F.explode(F.coalesce("items", F.array(one))).alias("h")).select("h.*")
    # the API writes UTC times with a trailing Z
    pushed = F.expr("try_cast(regexp_replace(pushed_at, 'Z$', '') AS timestamp_ntz)")
    return hits.select(F.col("owner.login").alias("owner"), "name", "html_url",
                       F.col("stargazers_count").alias("stars"), "language", pushed.alias("pushed_at"), "description")


def read_readmes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(README_SCHEMA).json(path)


def read_trees(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TREE_SCHEMA).json(path)


def read_contents(spark: SparkSession, path: str) -> DataFrame:
    """Contents of files, one (owner, name, path, base64 content) a line."""
    return spark.read.schema(CONTENT_SCHEMA).json(path)

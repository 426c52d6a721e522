"""Queries of the training-data operators, and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import bpe, common, conversations, covertree, divergence, langid, lm, mixing, neardup, personal, quality, secrets, toxicity, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, common.table(spark, sf_dir, "labels")))


@query
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.roundtrip(common.table(spark, sf_dir, "documents"))


@query
def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(common.table(spark, sf_dir, "documents"))


ORACLES["op7_minhash"] = neardup.ORACLE_SQL


@query
def op10_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(common.table(spark, sf_dir, "documents"))


ORACLES["op10_blob_ledger"] = secrets.oracle_sql()


@query
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.roundtrip(common.table(spark, sf_dir, "pages"))


ORACLES["op9_warc"] = warc.ORACLE_SQL


@query
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(common.table(spark, sf_dir, "documents"))


ORACLES["op4_quality"] = quality.oracle_sql()


@query
def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.train(docs))


@query
def op1_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(common.table(spark, sf_dir, "documents"))


@query
def op8_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.top_k(common.table(spark, sf_dir, "embeddings"))


ORACLES["op8_cover_tree"] = covertree.oracle_sql()


@query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.rates(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))


@query
def op13_four_russians(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.audit(common.table(spark, sf_dir, "conversations"))


@query
def op12_term_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(common.table(spark, sf_dir, "documents"))


ORACLES["op12_term_rows"] = divergence.ORACLE_SQL


@query
def op11_bootstrapped_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.extract(common.table(spark, sf_dir, "documents"))

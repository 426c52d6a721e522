"""Corpus pipeline: five stages over ``documents``.

1. toxicity: documents the compression-distance classifier rejects go.
2. near_duplicates: one document of each group of near copies stays.
3. secrets: findings of the blob ledger's scan are replaced by ``[kind]``.
4. mixing: documents are repeated as often as the mixing rates say; rates are at
   least 1, so every clean document stays.
5. encoding: texts become token ids; a document is returned with its number of
   tokens and the digests of its ids and of their decoding.

Each stage takes (spark, docs, sf_dir) and its result is written before the
next reads it.  An empty table passes through all stages; null texts stay null
until the last, where they are empty; repeated rows leave at stage 2.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import bpe, common, mixing, neardup, secrets, toxicity

# shares of the tokens after mixing, which leaves 1.2 times the tokens: enough for
# every document to stay (rates of at least 1); toxic documents are gone by then
MIX, BUDGET = {"high": 0.85, "low": 0.15, "toxic": 0.0}, 1.2


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.configure(spark)
    return neardup.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, common.table(spark, sf_dir, "labels"), MIX, budget=BUDGET, least=1.0)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.configure(spark)
    return bpe.roundtrip(docs)


STAGES = [
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix),
    ("encoding", encode),
]

# neither the trained classifiers nor the tokenizer can be written in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stash(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

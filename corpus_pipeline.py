"""From raw documents to packed training sequences, in stages that each write what they keep."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import exact, minhash, mixing, packing, toxicity
from millrace.llm.queries import labelled_domains, table
from millrace.session import scratch_root

# Good text over poor, by language; the token total may grow by a tenth. Rates are free from 0 up: a
# domain above its target comes down, one below it is repeated.
MIX = {
    "en-1": 0.55, "en-0": 0.05,
    "de-1": 0.14, "de-0": 0.01,
    "fr-1": 0.14, "fr-0": 0.01,
    "es-1": 0.09, "es-0": 0.01,
}
MIX_BUDGET = 1.1
MIX_SETTINGS = mixing.Settings(strict=False)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model calls clean; it learns from the labels there are.

    Whole texts of any length are scored, NULL as empty; without labels nothing is dropped. Repeated
    rows are scored alike. Columns of any name come through unchanged.
    """
    model = toxicity.train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where("predicted = 0").select(docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the smallest id; a NULL text equals an empty one.

    Rows that repeat id and text are one row. Columns of any name come through unchanged.
    """
    return exact.drop_copies(docs, keep="smallest")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id.

    A text without words (NULL, empty) is near none but stays. Texts of under five words are compared
    as one shingle. Columns of any name come through unchanged.
    """
    return minhash.drop_near(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their fitted rates say, so that the domains reach their target weights.

    A NULL or empty text has no tokens and the rate of its posterior. Rows that repeat an id are
    decided alike; a row without id stays once. Columns of any name come through unchanged. Where no
    label tells domains apart nothing is left out; a domain without any document is a warning.
    """
    labelled = labelled_domains(docs, table(spark, sf_dir, "labels"))
    rates = mixing.mix(docs, labelled, MIX, MIX_BUDGET, MIX_SETTINGS)
    return mixing.apply_rates(docs, rates)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens, NULL texts as empty.

    A row that occurs several times is packed as often. Texts of any length are cut into pieces.
    """
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix),
    ("packing", pack),
]

# A trained classifier, BagMinHash and a tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{scratch_root(spark)}/llm/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        path = f"{folder}/{k}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

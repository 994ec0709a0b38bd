"""The queries of the training-data operators: (spark, sf_dir) -> DataFrame, and SQL oracles."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    centroids,
    language_model,
    main_text,
    minhash,
    mixing,
    packing,
    prefix_trie,
    secrets,
    substrings,
    token_files,
    toxicity,
    vectors,
)
from millrace.llm.exact import exact_groups
from millrace.llm.oracle import LLM_ORACLE
from millrace.llm.scratch import landed
from millrace.session import scratch_root

__all__ = ["LLM_ORACLE", "LLM_QUERIES"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the copy that stays: the largest id of each text."""
    return exact_groups(table(spark, sf_dir, "documents"), keep="largest")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document and its place in a sequence of at most 2048 tokens."""
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer, with_ids=False)


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability, learned outside fold 1 only.

    A document without id belongs to no fold that may be learned from.
    """
    scored = language_model.score(table(spark, sf_dir, "documents"), _remainder() != 1)
    return scored.select(
        "doc_id", (~F.col("trains")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class of equal shingles and its group of near-duplicates."""
    return minhash.near_groups(table(spark, sf_dir, "documents"))


def op5_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding with its links at cosine 0.9 and its group."""
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


# Target weights by language and quality label ("1" is the better one): good text first, and the
# other languages lifted a little against English.
TARGETS = {
    "en-1": 0.50, "en-0": 0.04,
    "de-1": 0.16, "de-0": 0.01,
    "fr-1": 0.16, "fr-0": 0.01,
    "es-1": 0.11, "es-0": 0.01,
}


def labelled_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, domain``: language and quality of the labelled documents."""
    known = labels.where("quality IS NOT NULL").select("doc_id", "quality")
    domain = F.concat_ws("-", "lang", F.col("quality").cast("int").cast("string"))
    return docs.where("lang IS NOT NULL").select("doc_id", "lang").join(known, "doc_id").select(
        "doc_id", domain.alias("domain")
    )


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its tokens, likeliest domain and fitted rate.

    Rates bring the expected tokens of eight domains (language and quality) to ``TARGETS`` at the
    token total there is.
    """
    docs = table(spark, sf_dir, "documents")
    labelled = labelled_domains(docs, table(spark, sf_dir, "labels"))
    names = F.array(*map(F.lit, TARGETS))
    best = F.array_position("p", F.array_max("p")).cast("int")
    return mixing.mix(docs, labelled, TARGETS).select(
        "doc_id", "n_tokens", F.element_at(names, best).alias("domain"), F.array_max("p").alias("posterior"), "rate"
    )


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with what is left of it when windows of smaller documents are taken out."""
    return substrings.drop_repeats(table(spark, sf_dir, "documents"), with_text=False)


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return main_text.extract(pages, main_text.train(pages))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts of the fixed patterns, a digest of them, and all spans.

    A span is the whole match of its pattern, and order is by its start, then by kind as listed.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kinds = F.array(*map(F.lit, [*secrets.PATTERNS, "crf"]))
    rank = lambda s: F.array_position(kinds, s["kind"])
    match = lambda s: F.struct(
        s["match_start"].alias("match_start"), rank(s), s["match_end"].alias("match_end"), s["kind"].alias("kind")
    )
    found = secrets.scan(docs, secrets.train(docs))
    found = found.withColumn("spans", F.array_sort(F.transform("spans", match)))

    def joined(spans: Column) -> Column:
        one = lambda s: F.concat_ws(
            ":", s["kind"], s["match_start"].cast("string"), s["match_end"].cast("string")
        )
        return F.array_join(F.transform(spans, one), ",")

    base = F.filter("spans", lambda s: s["kind"] != "crf")

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [number(kind) for kind in secrets.PATTERNS]
    return found.select(
        "doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )


def _remainder() -> Column:
    """crc32 of the id written as text, modulo 5; NULL for a NULL id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score of every document, learned outside fold 0 only.

    A document without id belongs to no fold that may be learned from.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learn = _remainder() != 0
    model = toxicity.train(docs.where(learn), table(spark, sf_dir, "labels").where(learn))
    held_out = F.coalesce(_remainder() == 0, F.lit(True)).alias("held_out")
    return toxicity.score(docs, model).select("doc_id", held_out, "score", "predicted")


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable embedding with its cluster of eight after ten rounds, in integers."""
    return centroids.with_inertia(*centroids.cluster(table(spark, sf_dir, "embeddings")))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as it is read back from files of token ids: its place, length and checksum."""
    folder = f"{scratch_root(spark)}/llm/token-files-{uuid.uuid4().hex}"
    token_files.write(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"))
    found = token_files.read(spark, folder)
    return found.select("doc_id", "start", "n_tokens", F.crc32("tokens").alias("ids_crc32"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of conversations that begin with up to five turns of another one."""
    turns = landed(prefix_trie.turns_of(table(spark, sf_dir, "conversations")), "trie-turns")
    c = F.col("conv_id")
    heads = F.crc32(c.cast("string").cast("binary")) % 6
    return prefix_trie.trie(prefix_trie.rebuilt(turns, c - c % 100, heads, 5))


LLM_QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_packing": op2_packing,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_minhash": op4_minhash,
    "op5_vectors": op5_vectors,
    "op6_mixing": op6_mixing,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_main_text": op8_main_text,
    "op9_secrets": op9_secrets,
    "op10_toxicity": op10_toxicity,
    "op11_centroids": op11_centroids,
    "op12_token_files": op12_token_files,
    "op13_prefix_trie": op13_prefix_trie,
}

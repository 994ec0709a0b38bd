"""Exact dedup: group by a 128-bit content hash, compare bytes inside groups, keep one id.

DataFrame functions only. Texts travel once, and only one copy of each text and task: the first
aggregation combines copies before the shuffle, so a group that holds a third of all rows costs
one row per task. What is joined back to the documents is two hashes, not texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.scratch import landed


def content_hash(text: Column) -> Column:
    """128 bits of the text's UTF-8 bytes."""
    return F.unhex(F.md5(text))


def text_digest(text: Column) -> Column:
    return F.sha2(text, 256)


def exact_groups(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    hashed: Callable[[Column], Column] = content_hash,
    digest: Callable[[Column], Column] = text_digest,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when their bytes are equal; NULL counts as empty. ``keep`` is ``smallest`` or
    ``largest`` id. Rows that repeat an id and its text are all members of the group: they count
    in ``group_size`` and carry the same ``kept``. A NULL id never stays unless its group has no
    other id; then ``keep_id`` is NULL and ``kept`` true. An empty table gives no rows; columns
    other than id and text are not read.
    """
    best = {"smallest": F.min, "largest": F.max}[keep]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("_text")).withColumn(
        "_hash", hashed(F.col("_text"))
    )
    # grouping by hash and text is the comparison of bytes inside a hash group
    classes = (
        rows.groupBy("_hash", "_text")
        .agg(best("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("_hash", digest(F.col("_text")).alias("text_sha256"), "_text", "keep_id", "group_size")
    )
    light = landed(classes.drop("_text"), "exact-classes")
    keys = ["_hash", "text_sha256"]
    # both hashes equal for different texts: then, and only then, texts take part in the join
    collided = light.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if collided.isEmpty():
        found, members = light, rows.withColumn("text_sha256", digest(F.col("_text"))).drop("_text")
    else:
        found, members = classes, rows.withColumn("text_sha256", digest(F.col("_text")))
        keys = [*keys, "_text"]
    return members.join(found, keys).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, *, keep: str = "smallest") -> DataFrame:
    """The rows of ``docs`` that stay, one for each text; a row that repeats one that stays goes.

    Columns and their order are those of ``docs``, whatever their names.
    """
    groups = exact_groups(docs, keep=keep)
    stay = groups.where("kept").groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("n"))
    stay = landed(stay, "exact-stay")
    held = docs.select(
        "doc_id", text_digest(F.coalesce("text", F.lit(""))).alias("sha"), F.struct(*docs.columns).alias("row")
    )
    ids = stay.select(F.col("doc_id").alias("stay_id"), F.col("text_sha256").alias("stay_sha"))
    same = F.col("doc_id").eqNullSafe(F.col("stay_id")) & (F.col("sha") == F.col("stay_sha"))
    left = held.join(ids, same, "left_semi")
    if not stay.where("n > 1").isEmpty():  # the same row delivered twice
        left = left.dropDuplicates(["doc_id", "sha"])
    return left.select("row.*")

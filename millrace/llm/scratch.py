"""Cutting lineage: results that later jobs read again live in the cluster's shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import scratch_root


def landed(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` written as Parquet below the shared scratch folder and read back.

    Survives the loss of any executor. The caller keeps such tables small; the folder is that of
    ``spark.checkpoint.dir``, whose upkeep belongs to the cluster.
    """
    path = f"{scratch_root(frame.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def only(frame: DataFrame, ids: DataFrame, column: str, *, words: int = 1 << 17) -> DataFrame:
    """Rows of ``frame`` whose ``column`` occurs in the like-named only column of ``ids``.

    An exact semi-join behind a bitmap of fixed size (``words`` times 64 bits, so broadcasting it
    is safe at any size): rows that cannot match are dropped before wide columns are shuffled. The
    more ids there are the less it drops, but what it drops never matches.
    """
    hashed = F.xxhash64(column, F.lit("only"))
    word, bit = F.pmod(hashed, F.lit(words)), F.pmod(F.shiftright(hashed, 32), F.lit(64)).cast("int")
    marks = (
        ids.select(word.alias("_word"), bit.alias("_bit"))
        .groupBy("_word")
        .agg(F.expr("bit_or(shiftleft(1L, _bit))").alias("_bits"))
    )
    near = frame.withColumns({"_word": word, "_bit": bit}).join(F.broadcast(marks), "_word")
    near = near.where(F.expr("getbit(_bits, _bit)") == 1).select(frame.columns)
    return near.join(ids, column, "left_semi")

"""A training-corpus pipeline over ``documents``.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns the next
stage's documents.  All stages but the last keep the columns of ``documents``:

1. quality: documents that the quality classifier rejects go;
2. near_duplicates: one document (the smallest doc_id) of each group of near copies stays, at five
   words a shingle and a similarity of 0.8;
3. decontamination: documents that hold a benchmark item go;
4. secrets: secrets in texts are replaced, and n_chars follows;
5. pieces: the texts are encoded as SentencePiece ids.

Stages judge rows, not ids: rows that share a doc_id are documents of their own, and rows with a null doc_id are
judged like all others.  Null, empty and blank texts are near copies of nothing and hold no item and no secret.  Of rows that
repeat, near_duplicates keeps one.  An empty table gives an empty result.  Extra columns stay as
they are, whatever their names; no stage needs columns besides doc_id and text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuegrid.llm.common import checkpoint_dir, columns, drop_rows, fresh, read_table, scratch, scratch_path, stash, with_row_keys
from cuegrid.llm.decontaminate import find_contamination
from cuegrid.llm.jaccard_join import ngram_jaccard_join
from cuegrid.llm.pieces import encode_pieces
from cuegrid.llm.quality import fit_cotraining, keep_good
from cuegrid.llm.queries import PIECE_MODEL
from cuegrid.llm.secrets import redact_secrets


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that the classifier keeps; all of them if ``labels`` has too few rows of a class."""
    return keep_good(docs, fit_cotraining(docs, read_table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group: that of the smallest doc_id (nulls last), of several such rows one."""
    (row,) = fresh(docs, "row")
    keyed = with_row_keys(docs, row)
    found = ngram_jaccard_join(keyed.select(F.col(row).alias("doc_id"), "text"), n=5, percent=80)
    groups = stash(found.select(F.col("doc_id").alias("row"), F.col("component_id").alias("part")))
    ids = keyed.select(F.col(row).alias("row"), F.col("doc_id").alias("id"))
    places = groups.join(ids, "row").select("part", F.struct(F.col("id").isNull(), "id", "row").alias("place"))
    kept = places.groupBy("part").agg(F.min("place")["row"].alias("row"))  # partial minima: no group meets in one task
    losers = stash(groups.select("row").join(kept, "row", "left_anti").select(F.col("row").alias(row)))
    return drop_rows(keyed, losers, row).select(*columns(docs))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that hold no benchmark item (80 % of its five-word shingles)."""
    (row,) = fresh(docs, "row")
    keyed = with_row_keys(docs, row)
    found = find_contamination(keyed.select(F.col(row).alias("doc_id"), "text"), read_table(spark, sf_dir, "benchmark"), n=5, percent=80)
    losers = stash(found.select(F.col("doc_id").alias(row)).distinct())
    return drop_rows(keyed, losers, row).select(*columns(docs))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with the secrets in their texts replaced."""
    return redact_secrets(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of piece ids a row; see :func:`encode_pieces`."""
    return encode_pieces(docs, PIECE_MODEL)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("pieces", pieces),
]

#: A trained classifier and a tokenizer are beyond SQL: the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written into the shared folder and read again.

    One row a document kept: its piece ids.  What the stages wrote on the way is deleted once the
    last one's result is written; that stays in the shared folder.
    """
    docs, result = read_table(spark, sf_dir, "documents"), f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    with scratch(spark):
        for name, stage in STAGES:
            path = result if stage is STAGES[-1][1] else scratch_path(spark, f"pipeline-{name}")
            stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}

"""The corpus pipeline: five filters and encoders over ``documents``, one after the other.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's ``docs``. Each works on all that its
predecessor kept and reads whole texts. All but the last return the columns of
``documents``. Null texts count as empty; repeated rows are judged one by one;
extra columns pass through the filters; an empty table passes as it is.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsmith.llm import decontaminate, quality_gam, sentencepiece_lattice, simhash, toxicity_pu
from jobsmith.llm.common import Stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score of 0.5 or more)."""
    model = quality_gam.train(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality_gam.score(F.col("text"), model) >= 0.5)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not call toxic (score under 0.7)."""
    model = toxicity_pu.train(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity_pu.score(F.col("text"), model) < 0.7)


ROW = "pipeline row key"


def _keyed(docs: DataFrame) -> DataFrame:
    """The rows with a key of their own, stored with them: ids may be null or repeated."""
    return Stored(docs.withColumn(ROW, F.monotonically_increasing_id()), "pipeline-rows").df


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of SimHash near-duplicates: the one with the smallest id (null ids last)."""
    keyed = _keyed(docs)
    groups = simhash.near_duplicates(keyed, id_col=ROW, shingle=3, max_bits=2, seed=42).select(ROW, "component_id")
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(ROW).alias("row")))
    keep = keyed.select(ROW, "doc_id").join(groups, ROW).groupBy("component_id").agg(first.alias("x"))
    return keyed.join(keep.select(F.col("x.row").alias(ROW)), ROW, "left_semi").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage within the edit distance of a benchmark item."""
    keyed = _keyed(docs)
    leaks = decontaminate.leaks(keyed, table(spark, sf_dir, "benchmark"), id_col=ROW)
    return keyed.join(leaks.select(ROW).distinct(), ROW, "left_anti").select(docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, decoded_crc32): every document as SentencePiece ids, and the CRC-32 of the text decoded
    from them again (of the empty text for an empty or null one)."""
    return sentencepiece_lattice.encode(docs, public_tokenizers.path("piece_bpe_32k.model"), columns=("ids", "decoded_crc32"))


STAGES = [("quality classifier", quality), ("toxicity", toxicity), ("simhash near-dedup", near_duplicates),
          ("benchmark decontamination", decontamination),
          ("sentencepiece encoding and decoding", encoding)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = Stored(stage(spark, docs, sf_dir), "pipeline").df
    return docs


#: classifiers and SimHash are beyond SQL: see tests/llm
ORACLE_SQL = None

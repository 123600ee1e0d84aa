"""A corpus from raw documents to packed sequences.

The stages, each of which works on all that its predecessor kept (written as Parquet and read again):

1. quality classifier: the trees of ``quality_model`` score every text; those under 0.7 go
2. exact dedup: of equal texts the row with the largest doc_id stays
3. near dedup: one document of every class of near copies (5-word shingles, similarity 0.8) stays
4. mixing: sources are brought to their target weights; a document taken twice has two rows
5. packing: token sequences of at most 2048 ids

All but the last return the columns of ``documents``. SQL can express neither the classifier nor the
signatures, so there is no SQL; ``tests/llm`` holds the pipeline against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import exact_dedup, mixing, near_dedup, packing, quality_model
from tidewater.llm.common import documents, saved


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts. It learns from the labelled ones among ``docs``."""
    model = quality_model.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = quality_model.with_score(docs, model, name="_qm_score")
    return out.where(F.col("_qm_score") >= quality_model.ACCEPT).select(*docs.columns)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_copies(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [("quality classifier", quality_stage), ("exact dedup", exact_stage), ("near dedup", near_stage),
          ("mixing", mix_stage), ("packing", pack_stage)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs

"""A training corpus from raw documents: quality, near-duplicates, secrets, mixture, packing."""

from pyspark.sql import DataFrame, SparkSession

from fathomline.llm import mixing, near_dedup, packing, quality, secrets
from fathomline.llm.frames import written


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the quality classifier doesn't reject. Rows with a null id end here: later stages name documents by id. A null text is scored as an empty one; without labels nothing is rejected."""
    return quality.accepted(docs.where("doc_id IS NOT NULL"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates. Null, empty and blank texts are near nothing and stay; of rows that repeat an id the one with the greatest text does."""
    return near_dedup.deduplicated(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced. Null and empty texts stay as they are."""
    return secrets.redacted(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: documents repeated, left out, or cut where a source's budget ends. A null source is one too; documents of no words stay once."""
    return mixing.mixed_rows(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens, with their ids: texts of the stages before are nowhere else. A null or empty text is the end token alone; an empty table gives no piece."""
    return packing.pack(docs)


STAGES = [("quality", good), ("near_duplicates", distinct), ("secrets", clean), ("mixture", mixed), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: Model scores, tokens and sketches have no SQL form; tests/llm/test_pipeline.py holds the stages against plain Python.
ORACLE_SQL = None

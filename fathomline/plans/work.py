"""Tables and files that a chain writes on its way, in a folder that all executors see."""

import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """A new folder in spark.checkpoint.dir, or in the warehouse where that isn't set."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{at.rstrip('/')}/files/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """df as a table: computed once, and not again when an executor is lost."""
    path = folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

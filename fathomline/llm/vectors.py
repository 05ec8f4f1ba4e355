"""What the vector searches share: rows that take part, and distinct vectors with the ids that have them."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .frames import one_per_id


def finite(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and v (array of double) of the rows that take part: an id, a vector that isn't empty, and no null, NaN or infinite component. Of rows repeating an id the greatest vector counts."""
    df = one_per_id(df.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")), "vec_id", "v")
    return df.where((F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))


def distinct(df: DataFrame, k: int) -> DataFrame:
    """cid, v, ids: a row for each vector, with the k + 1 smallest ids that have it; more can't be among any query's best k. cid is the least of them."""
    rank = Window.partitionBy("v").orderBy("vec_id")
    few = df.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k + 1)
    return few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(F.col("ids")[0].alias("cid"), "v", "ids")


def query_vectors(df: DataFrame, classes: DataFrame, every: int) -> DataFrame:
    """query_id and qid, the cid of its vector."""
    queries = df.where(F.pmod("vec_id", F.lit(every)) == 0).withColumnRenamed("vec_id", "query_id")
    return queries.join(classes.select("v", F.col("cid").alias("qid")), "v").select("query_id", "qid")


def ranked(best: DataFrame, classes: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """best: qid, cid, score, with each qid's best k + 1 distinct vectors at least (ties whole or not: ids decide). The best k ids of each query but its own."""
    w = Window.partitionBy("qid").orderBy(F.col("score").desc(), "vec_id")
    lists = best.join(classes.select("cid", "ids"), "cid").select("qid", "score", F.explode("ids").alias("vec_id")).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k + 1)
    own = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    out = queries.join(lists.drop("rank"), "qid").where(F.col("query_id") != F.col("vec_id")).withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

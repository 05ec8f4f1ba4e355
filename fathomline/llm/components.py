"""Connected components of links between long ids, as joins and aggregates over written tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import written


def components(links: DataFrame) -> DataFrame:
    """links: a, b. A written table id, label of all ids that occur in them; ids have one label if links join them.

    Each round takes the least label around an id and then the label of that label, so that chains shorten by half or better.
    """
    edges = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = written(edges.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("label")))
    while True:
        near = edges.join(labels.select(F.col("id").alias("b"), "label"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        new = labels.join(near, "id").select("id", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        jump = labels.select(F.col("id").alias("label"), F.col("label").alias("far"))
        new = written(new.join(jump, "label", "left").select("id", F.least("label", "far").alias("label"), "old"))
        if new.where("label != old").isEmpty():
            return labels
        labels = new.drop("old")

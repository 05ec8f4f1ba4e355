"""Filters and catalogue queries over observation records."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The 30 quadrangles, as id, name, south, north, west, east.
QUADRANGLES = [
    ("MC01", "Mare Boreum", 65, 90, 0, 360), ("MC02", "Diacria", 30, 65, 180, 240), ("MC03", "Arcadia", 30, 65, 240, 300), ("MC04", "Mare Acidalium", 30, 65, 300, 360), ("MC05", "Ismenius Lacus", 30, 65, 0, 60),
    ("MC06", "Casius", 30, 65, 60, 120), ("MC07", "Cebrenia", 30, 65, 120, 180), ("MC08", "Amazonis", 0, 30, 180, 225), ("MC09", "Tharsis", 0, 30, 225, 270), ("MC10", "Lunae Palus", 0, 30, 270, 315),
    ("MC11", "Oxia Palus", 0, 30, 315, 360), ("MC12", "Arabia", 0, 30, 0, 45), ("MC13", "Syrtis Major", 0, 30, 45, 90), ("MC14", "Amenthes", 0, 30, 90, 135), ("MC15", "Elysium", 0, 30, 135, 180),
    ("MC16", "Memnonia", -30, 0, 180, 225), ("MC17", "Phoenicis Lacus", -30, 0, 225, 270), ("MC18", "Coprates", -30, 0, 270, 315), ("MC19", "Margaritifer Sinus", -30, 0, 315, 360), ("MC20", "Sinus Sabaeus", -30, 0, 0, 45),
    ("MC21", "Iapygia", -30, 0, 45, 90), ("MC22", "Mare Tyrrhenum", -30, 0, 90, 135), ("MC23", "Aeolis", -30, 0, 135, 180), ("MC24", "Phaethontis", -65, -30, 180, 240), ("MC25", "Thaumasia", -65, -30, 240, 300),
    ("MC26", "Argyre", -65, -30, 300, 360), ("MC27", "Noachis", -65, -30, 0, 60), ("MC28", "Hellas", -65, -30, 60, 120), ("MC29", "Eridania", -65, -30, 120, 180), ("MC30", "Mare Australe", -90, -65, 0, 360),
]


def quadrangles(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(QUADRANGLES, "quadrangle string, name string, south int, north int, west int, east int")


def open_box(df: DataFrame, conditions: dict[str, tuple[float, float]]) -> DataFrame:
    """Rows strictly within all intervals."""
    for name, (low, high) in conditions.items():
        df = df.where((F.col(name) > low) & (F.col(name) < high))
    return df


def orbits_within(df: DataFrame, conditions: dict[str, tuple[float, float]], orbit: str, order: str) -> DataFrame:
    """Distinct orbits with a row strictly within all intervals, and where each first appears."""
    return open_box(df, conditions).groupBy(orbit).agg(F.min(order).alias("first_seen"))


def in_quadrangles(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Rows with the quadrangle strictly around them; rows on an edge are in none. The 30 rows are a fixed dimension."""
    q = F.broadcast(quadrangles(df.sparkSession))
    return df.join(q, (F.col(lat) > F.col("south")) & (F.col(lat) < F.col("north")) & (F.col(lon) > F.col("west")) & (F.col(lon) < F.col("east")))


def every_nth(df: DataFrame, order: str, n: int) -> DataFrame:
    return df.where(F.col(order) % n == 0)


def profiles_within(df: DataFrame, key: str, box: dict[str, tuple[float, float]], more_than: int) -> DataFrame:
    """Rows within the closed box of profiles that have more than so many of them."""
    for name, (low, high) in box.items():
        df = df.where(F.col(name).between(low, high))
    return df.join(df.groupBy(key).count().where(F.col("count") > more_than).select(key), key, "left_semi")


def segments_within(df: DataFrame, key: str, order: str, conditions: dict[str, tuple[float, float]], more_than: int) -> DataFrame:
    """First and last row of each record strictly within the box, for records with more than so many rows there."""
    return open_box(df, conditions).groupBy(key).agg(F.min(order).alias("first_row"), F.max(order).alias("last_row"), F.count("*").alias("n")).where(F.col("n") > more_than)

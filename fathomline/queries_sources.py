"""Queries of files that Spark derives from the driver's tables and reads again by shares, and the SQL that gives the same rows from the tables."""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import signal
from .operators import terrain
from .plans import incremental
from .plans.work import folder
from .queries import GRAM, query, r6, radargram
from .sources import rasters, splits
from .streaming import channels


def _written(spark: SparkSession, sf_dir: str, made) -> str:
    """A folder of the files (name, content) that made gives for each product: its number and its traces, in order, as a matrix of whole thousandths."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        data = np.floor(1000 * np.stack(pdf.sort_values("trace")["samples"].to_numpy())).astype(int)
        return pd.DataFrame(made(int(pdf["product"].iloc[0]), data), columns=["name", "content"])

    rows = radargram(spark, sf_dir).select("product", "trace", "samples")
    return splits.stored(rows.groupBy("product").applyInPandas(run, "name string, content binary"), folder(spark))


THOUSANDTHS = GRAM.replace(", cells AS", ", whole AS (SELECT product, trace, generate_subscripts(samples, 1) - 1 AS k, floor(1000 * unnest(samples))::BIGINT AS v FROM gram), cells AS")
LAYOUT = [("no", ">u4"), ("v", ">i2", [64])]


@query(THOUSANDTHS + "SELECT product, trace AS record, sum(v)::BIGINT AS total, sum(v * k)::BIGINT AS moment FROM whole WHERE trace BETWEEN 3 AND 30 GROUP BY product, trace")
def records_by_shares(spark, sf_dir):
    def made(product: int, data: np.ndarray):
        rows = np.zeros(len(data), np.dtype([(f[0], f[1], *map(tuple, f[2:])) for f in LAYOUT]))
        rows["no"], rows["v"] = np.arange(len(data)), data
        return [(f"{product}.dat", rows.tobytes() + b"cut")]

    rows = splits.records(spark, _written(spark, sf_dir, made), LAYOUT, "*.dat", split=900, cut="keep").where("record >= 3 AND record <= 30 AND record = no")
    total = F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x)
    moment = F.aggregate(F.transform("v", lambda x, k: x * k.cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)
    return rows.select(F.regexp_extract("file", r"(\d+)\.dat$", 1).cast("long").alias("product"), "record", total.alias("total"), moment.alias("moment"))


@query(THOUSANDTHS + ", records AS (SELECT product, trace, k, v, 12 + trace % 5 AS n, trace < max(trace) OVER (PARTITION BY product) AS kept FROM whole) SELECT product, trace AS record, 1 + k // 32 AS channel, max(n) AS samples, sum(v)::BIGINT AS total FROM records WHERE kept AND k % 32 < n GROUP BY product, trace, k // 32")
def streams_by_shares(spark, sf_dir):
    def made(product: int, data: np.ndarray):
        head = np.zeros(1, splits.STREAMS[0])
        parts = []
        for i, row in enumerate(data):
            n = 12 + i % 5
            head["nsamp"], head["nchan"], head["choff"] = n, 2, 0xFF
            parts.append(head.tobytes() + row[:n].astype(">i2").tobytes() + row[32 : 32 + n].astype(">i2").tobytes())
        return [(f"{product}.str", b"".join(parts)[:-5])]

    shares = splits.stream_shares(spark, _written(spark, sf_dir, made), "*.str", split=500)
    total = F.aggregate("samples", F.lit(0).cast("long"), lambda a, x: a + x)
    return splits.streams(shares).select(F.regexp_extract("file", r"(\d+)\.str$", 1).cast("long").alias("product"), "record", F.col("channel").cast("long").alias("channel"), F.size("samples").cast("long").alias("samples"), total.alias("total"))


def _tile(product: int, data: np.ndarray):
    """A raster of an eighth of a degree a cell that begins in the north at ten degrees for each product, less 50."""
    n, wide = data.shape
    north = 10 * product - 50
    label = f"""OBJECT = IMAGE
  LINES = {n}
  LINE_SAMPLES = {wide}
  SAMPLE_TYPE = MSB_INTEGER
  SAMPLE_BITS = 16
  SCALING_FACTOR = 0.5
END_OBJECT = IMAGE
  MAXIMUM_LATITUDE = {north} <DEGREE>
  MINIMUM_LATITUDE = {north - n / 8} <DEGREE>
  WESTERNMOST_LONGITUDE = 0.0 <DEGREE>
  EASTERNMOST_LONGITUDE = {wide / 8} <DEGREE>
"""
    return [(f"{product}.img", data.astype(">i2").tobytes()), (f"{product}.lbl", label.encode())]


PLACED = THOUSANDTHS + ", placed AS (SELECT product, trace, k, v * 0.5 AS height, 10 * product - 50 - (trace + 0.5) / 8 AS latitude, (k + 0.5) / 8 AS longitude FROM whole) "


@query(PLACED + "SELECT product, trace AS line, k AS sample, round(latitude, 6)::DOUBLE + 0.0 AS latitude, round(longitude, 6)::DOUBLE AS longitude, height::DOUBLE + 0.0 AS height FROM placed WHERE latitude BETWEEN -33.2 AND 22.7 AND longitude BETWEEN 1.1 AND 5.05 AND latitude < 17.4")
def raster_cells_in_box(spark, sf_dir):
    rows = rasters.cells(spark, _written(spark, sf_dir, _tile), box=(-33.2, 22.7, 1.1, 5.05)).where("latitude < 17.4")
    return rows.select(F.regexp_extract("tile", r"(\d+)\.img$", 1).cast("long").alias("product"), F.col("line").cast("long").alias("line"), F.col("sample").cast("long").alias("sample"), r6("latitude").alias("latitude"), r6("longitude").alias("longitude"), (F.col("height") + 0.0).alias("height"))


# Heights between the middles of cells, from rasters put on one grid.
@query(
    PLACED
    + """, points AS (SELECT vec_id, 10 * product - 50 - (trace + 0.8) / 8 AS lat, ((vec_id % 60) + 1.2) / 8 AS lon FROM gram),
around AS (SELECT vec_id, (49.9375 - lat) * 8 AS y, (lon - 0.0625) * 8 AS x, r, c FROM points, range(2) AS a(r), range(2) AS b(c)),
met AS (SELECT vec_id, (1 - sqrt((y - (floor(y) + r)) ** 2 + (x - (floor(x) + c)) ** 2) / sqrt(2)) AS w, height FROM around JOIN placed ON round((49.9375 - latitude) * 8)::BIGINT = (floor(y) + r)::BIGINT AND round((longitude - 0.0625) * 8)::BIGINT = (floor(x) + c)::BIGINT)
SELECT vec_id, round(sum(w * height) / sum(w), 5)::DOUBLE + 0.0 AS height FROM met GROUP BY vec_id"""
)
def heights_from_rasters(spark, sf_dir) -> DataFrame:
    grid = rasters.merged(rasters.cells(spark, _written(spark, sf_dir, _tile)), 8.0, 49.9375, 0.0625)
    points = radargram(spark, sf_dir).select("vec_id", (F.col("product") * 10 - 50 - (F.col("trace") + 0.8) / 8).alias("lat"), ((F.col("vec_id") % 60 + 1.2) / 8).alias("lon"))
    out = terrain.heights(points, grid, "vec_id", "lat", "lon", 49.9375, 0.0625, 0.125).where("height IS NOT NULL")
    return out.select("vec_id", (F.round("height", 5) + 0.0).alias("height"))


# Vectors arrive as records of two channels; three outputs, of one channel and of two.
@query(
    """WITH outs(chanout, a, sa, b, sb) AS (VALUES (1, 1, 1.0, 0, 0.0), (2, 2, 0.5, 0, 0.0), (3, 1, 1.0, 2, -1.0)),
traces AS (SELECT vec_id // 2 AS record, 1 + vec_id % 2 AS channel, generate_subscripts(embedding, 1) - 1 AS k, unnest(embedding)::DOUBLE AS x FROM embeddings),
scaled AS (SELECT chanout, record, k, x * CASE WHEN channel = a THEN sa ELSE sb END AS x, CASE WHEN b = 0 THEN 1 ELSE 2 END AS parts FROM traces JOIN outs ON channel = a OR channel = b),
coherent AS (SELECT chanout, record // 6 AS block, record // 3 AS stack, k, sum(x) AS x, count(*) AS n, any_value(parts) AS parts FROM scaled GROUP BY ALL),
looks AS (SELECT chanout, block, k, avg(abs(x)) AS m FROM coherent GROUP BY chanout, block, k, parts HAVING sum(n) = 6 * parts)
SELECT chanout::INT AS chanout, block, round(sum(m), 5) AS total, round(max(m), 5) AS peak FROM looks GROUP BY chanout, block"""
)
def streamed_channel_looks(spark, sf_dir) -> DataFrame:
    at = folder(spark)
    spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").write.parquet(f"{at}/in")
    stream = spark.readStream.schema("vec_id long, embedding array<float>").option("maxFilesPerTrigger", 2).parquet(f"{at}/in")
    rows = stream.select(F.lit("all").alias("line"), F.floor(F.col("vec_id") / 2).alias("record"), (1 + F.col("vec_id") % 2).cast("int").alias("channel"), "embedding")
    out = channels.looks(rows, "line", "record", "channel", "embedding", signal.channel_specs("[1,1,1,0,0; 2,2,0.5,0,0; 3,1,1,2,-1]"), 3, 2)
    out.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start().awaitTermination()
    total = F.aggregate("magnitude", F.lit(0.0), lambda a, x: a + x)
    done = spark.read.schema("line string, chanout int, block long, magnitude array<double>").parquet(f"{at}/out")
    return done.select("chanout", "block", F.round(total, 5).alias("total"), F.round(F.array_max("magnitude"), 5).alias("peak"))


# Three runs of two stages: all products, none, then those whose version has grown.
@query("WITH p AS (SELECT label AS product, count(*) AS n, sum(embedding[1]) AS x FROM embeddings GROUP BY label), runs AS (SELECT 1 AS run, product FROM p UNION ALL SELECT 3, product FROM p WHERE product % 3 = 1) SELECT run, stage, product::BIGINT AS product, CASE stage WHEN 'sums' THEN round(x, 4) ELSE round(x / n, 4) END + 0.0 AS value FROM runs JOIN p USING (product), (VALUES ('sums'), ('means')) AS s(stage)")
def incremental_runs(spark, sf_dir) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("label").alias("product"), F.col("embedding")[0].cast("double").alias("x"))
    products, at, journals = rows.select("product").distinct(), folder(spark), []
    stages = [
        incremental.Stage("sums", ("rows",), lambda i: i["rows"].groupBy("product").agg(F.sum("x").alias("value"))),
        incremental.Stage("means", ("sums", "rows"), lambda i: i["rows"].groupBy("product").count().join(i["sums"], "product").select("product", (F.col("value") / F.col("count")).alias("value"))),
    ]
    made = spark.createDataFrame([], "run int, stage string, product string")
    for no in (1, 2, 3):
        version = F.when((F.lit(no) == 3) & (F.col("product") % 3 == 1), 2).otherwise(1)
        pipeline = incremental.Pipeline(spark, at, {"rows": rows}, {"rows": products.withColumn("version", version)}, stages)
        pipeline.run().where("error IS NULL").select(F.lit(no).alias("run"), "stage", "product").write.parquet(f"{at}/made/{no}")
        made = made.unionByName(spark.read.schema(made.schema).parquet(f"{at}/made/{no}"))
    values = pipeline.output("sums").withColumn("stage", F.lit("sums")).unionByName(pipeline.output("means").withColumn("stage", F.lit("means")))
    return made.join(values, ["stage", "product"]).select("run", "stage", F.col("product").cast("long").alias("product"), (F.round("value", 4) + 0.0).alias("value"))

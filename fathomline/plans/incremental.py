"""Stages that are run again for just the products whose inputs have changed.

Each stage writes a folder of partitions, one for each product, and a journal of what it was made from: a version for each product, a hash of its inputs' versions. A product is due in a stage where the journal hasn't its present version. Due products are computed together and replace their partitions alone; if that fails, halves are tried until the products at fault are found, and those are left out with their errors.
"""

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

JOURNAL = "stage string, product string, version long, run long, error string"


@dataclass(frozen=True)
class Stage:
    """make(inputs) gives the rows of the products that its inputs hold, with their column `product`; inputs are DataFrames by name of source or stage. code: changes when the stage is to be run anew for all."""

    name: str
    inputs: tuple[str, ...]
    make: Callable[[dict[str, DataFrame]], DataFrame]
    code: str = ""


@dataclass
class Pipeline:
    """sources: rows with a column `product`, by name; versions: product, version (such as a time of change) of each source."""

    spark: SparkSession
    folder: str
    sources: dict[str, DataFrame]
    versions: dict[str, DataFrame]
    stages: list[Stage] = field(default_factory=list)

    def __post_init__(self):
        known = set(self.sources)
        for s in self.stages:
            if missing := set(s.inputs) - known:
                raise ValueError(f"{s.name} comes before its inputs {', '.join(sorted(missing))}")
            known.add(s.name)

    def journal(self) -> DataFrame:
        """The last entry of each stage and product."""
        try:
            rows = self.spark.read.schema(JOURNAL).parquet(f"{self.folder}/_journal")
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], JOURNAL)
        last = Window.partitionBy("stage", "product").orderBy(F.col("run").desc())
        return rows.withColumn("turn_", F.row_number().over(last)).where("turn_ = 1").drop("turn_")

    def output(self, stage: str) -> DataFrame:
        """What a stage has written, product by product."""
        return self.spark.read.option("basePath", f"{self.folder}/{stage}").parquet(f"{self.folder}/{stage}").withColumn("product", F.col("product").cast("string"))

    def _present(self, name: str) -> DataFrame:
        """product, version of a source, or of a stage's products that were made without error."""
        if name in self.versions:
            return self.versions[name].select(F.col("product").cast("string").alias("product"), F.col("version").cast("long").alias("version"))
        return self.journal().where((F.col("stage") == name) & F.col("error").isNull()).select("product", "version")

    def due(self, stage: Stage) -> DataFrame:
        """product, version: products that have all inputs, and that the stage hasn't made from their present versions. A product at fault is due again when its inputs change."""
        rows = self._present(stage.inputs[0]).withColumnRenamed("version", "v0")
        for i, name in enumerate(stage.inputs[1:], 1):
            rows = rows.join(self._present(name).withColumnRenamed("version", f"v{i}"), "product")
        wanted = rows.select("product", F.xxhash64(F.lit(stage.code), *(f"v{i}" for i in range(len(stage.inputs)))).alias("version"))
        return wanted.join(self.journal().where(F.col("stage") == stage.name).select("product", "version"), ["product", "version"], "left_anti")

    def _made(self, stage: Stage, products: DataFrame) -> None:
        inputs = {}
        for name in stage.inputs:
            rows = self.sources[name].withColumn("product", F.col("product").cast("string")) if name in self.sources else self.output(name)
            inputs[name] = rows.join(products.select("product"), "product", "left_semi")
        out = stage.make(inputs)
        out.repartition("product").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("product").parquet(f"{self.folder}/{stage.name}")

    def _tried(self, stage: Stage, due: list[tuple[str, int]]) -> list[tuple[str, int, str | None]]:
        """Makes these products; each with its version and its error, if it has one."""
        try:
            self._made(stage, self.spark.createDataFrame(due, "product string, version long"))
        except Exception as e:
            if len(due) == 1:
                return [(*due[0], f"{type(e).__name__}: {e}"[:2000])]
            half = len(due) // 2
            return self._tried(stage, due[:half]) + self._tried(stage, due[half:])
        return [(*d, None) for d in due]

    def run(self, batch: int = 10_000) -> DataFrame:
        """Runs all stages in order and returns this run's journal entries. Products' names and versions pass through the driver, `batch` at a time; their rows don't."""
        run = (self.journal().agg(F.max("run")).first()[0] or 0) + 1
        for stage in self.stages:
            while due := [tuple(r) for r in self.due(stage).orderBy("product").limit(batch).collect()]:
                made = [(stage.name, p, v, run, error) for p, v, error in self._tried(stage, due)]
                self.spark.createDataFrame(made, JOURNAL).coalesce(1).write.mode("append").parquet(f"{self.folder}/_journal")
        return self.journal().where(F.col("run") == run)

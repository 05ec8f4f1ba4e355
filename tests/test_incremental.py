"""Runs of a pipeline whose inputs change between them."""

import pytest
from pyspark.sql import functions as F

from fathomline.plans.incremental import Pipeline, Stage


def test_only_what_changed_is_made_again(spark, tmp_path):
    rows = spark.createDataFrame([(f"p{i % 6}", i, float(i)) for i in range(60)], "product string, i int, x double")

    def total(inputs):
        return inputs["raw"].groupBy("product").agg(F.sum("x").alias("x"))

    def ratio(inputs):
        shaky = F.when(F.col("product") == "p3", F.raise_error(F.lit("p3 is broken")).cast("double")).otherwise(F.col("x"))
        return inputs["total"].join(inputs["raw"].groupBy("product").count(), "product").select("product", (shaky / F.col("count")).alias("mean"))

    versions = {f"p{i}": 1 for i in range(6)}
    table = lambda: spark.createDataFrame(list(versions.items()), "product string, version long")

    def run(code=""):
        p = Pipeline(spark, str(tmp_path / "out"), {"raw": rows}, {"raw": table()}, [Stage("total", ("raw",), total, code), Stage("ratio", ("total", "raw"), ratio)])
        return p, {(r["stage"], r["product"]): r["error"] for r in p.run(batch=4).collect()}

    files = lambda: {f: f.stat().st_mtime_ns for f in (tmp_path / "out").rglob("*.parquet") if "_journal" not in str(f)}
    p, made = run()
    assert set(made) == {(s, f"p{i}") for s in ("total", "ratio") for i in range(6)}
    assert [k for k, e in made.items() if e] == [("ratio", "p3")] and "p3 is broken" in made["ratio", "p3"]
    assert {r["product"]: r["mean"] for r in p.output("ratio").collect()} == {f"p{i}": i + 27.0 for i in range(6) if i != 3}  # the one at fault leaves the others
    before = files()
    assert run()[1] == {} and files() == before  # nothing is due, nothing is written
    versions["p1"] = 2
    _, made = run()
    assert set(made) == {("total", "p1"), ("ratio", "p1")}
    after = files()
    assert {f.parent.name for f in set(before.items()) ^ set(after.items()) for f in f[:1]} == {"product=p1"}
    del versions["p5"]
    versions["p9"] = 1  # no rows yet: made, of nothing
    assert set(run()[1]) == {("total", "p9"), ("ratio", "p9")}
    _, made = run(code="2")
    assert {k for k in made if k[0] == "total"} == {("total", f"p{i}") for i in (0, 1, 2, 3, 4, 9)}
    with pytest.raises(ValueError, match="comes before"):
        Pipeline(spark, str(tmp_path), {"raw": rows}, {"raw": table()}, [Stage("a", ("b",), total)])

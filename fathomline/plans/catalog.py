"""Product catalogue: index records, paths, freshness and the order of stages."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What each product is made from, and how a product id looks.
PREREQUISITES = {"cmp": ["edr"], "alt": ["cmp", "edr"], "srf": ["cmp", "alt"], "rsr": ["srf"], "foc": ["edr", "cmp"], "clu": ["edr"], "rng": ["edr", "cmp", "clu"]}
PRODUCT_ID = r"e_[0-9]{7}_[0-9]{3}_\w+_[0-9]+_\w"


def product_of(path: Column | str) -> Column:
    """The id of a path to auxiliary data, or the id itself; an error for anything else."""
    path = F.col(path) if isinstance(path, str) else path
    name = F.element_at(F.split(path, "/"), -1)
    return F.when(path.rlike(f"^{PRODUCT_ID}$"), path).when(name.rlike(f"^{PRODUCT_ID}_a\\.dat$"), F.regexp_replace(name, r"_a\.dat$", "")).otherwise(F.raise_error(F.concat(F.lit("not a product: "), path)).cast("string"))


def tracks(lines: DataFrame, col: str = "value") -> DataFrame:
    """First token of each line that is neither blank nor a comment."""
    text = F.trim(F.col(col))
    return lines.where((text != "") & ~text.startswith("#")).select(F.split(text, " ")[0].alias("product"))


def index(records: DataFrame, order: str) -> DataFrame:
    """Product index: trimmed lower-case names, the orbit in them, the last of records with one id. Few records share one, so that they aren't put in order before they are dealt by it."""
    clean = records.select(order, *(F.lower(F.rtrim(c)).alias(c) for c in ("volume_id", "file_specification_name", "product_id")))
    after = F.lead(F.lit(1)).over(Window.partitionBy("product_id").orderBy(order))
    return clean.withColumn("after_", after).where("after_ IS NULL").drop("after_").withColumn("orbit", F.substring("product_id", 3, 7))


def status(files: DataFrame, product: str = "product_id", role: str = "role", mtime: str = "mtime", check_times: bool = True) -> DataFrame:
    """files: one row for each file that a product needs ('in') or gives ('out'), with its time, null if it is missing. Inputs must be strictly older than outputs."""
    t = F.coalesce(F.col(mtime), F.lit(-1))
    one = lambda agg, r: agg(F.when(F.col(role) == r, t))
    rows = files.groupBy(product).agg(one(F.min, "in").alias("in_lo"), one(F.max, "in").alias("in_hi"), one(F.min, "out").alias("out_lo"))
    missing = F.col("in_lo") == -1
    stale = F.lit(False) if not check_times else ~(F.col("in_hi") < F.col("out_lo"))
    out = F.when(F.col("out_lo") == -1, "output_missing").when(missing, "output_exists" if check_times else "output_ok").when(stale, "output_stale").otherwise("output_ok")
    return rows.select(product, F.when(missing, "input_missing").otherwise("input_ok").alias("input_status"), out.alias("output_status"))


def status_table(done: DataFrame, product: str, kind: str, kinds: list[str]) -> DataFrame:
    """A row for each product with a count of files for each kind, and a row of totals under a null product."""
    table = done.groupBy(product).pivot(kind, kinds).agg(F.count(F.lit(1)))
    table = table.na.fill(0, kinds)
    return table.unionByName(table.agg(*(F.sum((F.col(k) > 0).cast("long")).alias(k) for k in kinds)).withColumn(product, F.lit(None).cast(done.schema[product].dataType)))


def stages_for(tasks: list[str]) -> list[str]:
    """The tasks and all that they need, each after what it needs."""
    out: list[str] = []

    def add(task: str) -> None:
        for before in PREREQUISITES.get(task, []):
            add(before)
        if task != "edr" and task not in out:
            out.append(task)

    for task in tasks:
        add(task)
    return out


def processed(files: DataFrame, kind: str = "kind", path: str = "path") -> DataFrame:
    """kind, product: which products have a file of each kind, each once; files with other endings than .txt, .h5 and .dat don't count."""
    name = F.element_at(F.split(F.col(path), "/"), -1)
    return files.where(name.rlike(r"\.(txt|h5|dat)$")).select(kind, F.regexp_extract(name, PRODUCT_ID, 0).alias("product")).where("product <> ''").distinct()

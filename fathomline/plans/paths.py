"""Where a product's files lie, which products an orbit has, and which label describes a file."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Kind of product, name of the file, default folder below the product's own, ending.
FILES = [
    ("edr", "edr_aux", "", "_a.dat"),
    ("edr", "edr_sci", "", "_s.dat"),
    ("cmp", "cmp_rad", "ion", "_s.h5"),
    ("cmp", "cmp_tecu", "ion", "_s_TECU.txt"),
    ("alt", "alt_h5", "beta5", "_a.h5"),
    ("srf", "srf_txt", "cmp", ".txt"),
    ("rsr", "rsr_txt", "cmp", ".txt"),
    ("clu", "clu_rad", "icd", ".npz"),
    ("clu", "clu_json", "icd", ".json"),
    ("rng", "rng_json", "icd", ".json"),
    ("foc", "foc_p0", "5m/5 range lines/6km", "_s.h5"),
]
#: Parameters and units that name the folders of a focuser.
FOCUSED = {
    "Delay Doppler v1": [("ddv1_posting_distance [m]", "m"), ("ddv1_aperture_time [s]", "s"), ("ddv1_bandwidth [Hz]", "Hz")],
    "Matched Filter": [("mf_posting_distance [m]", "m"), ("mf_aperture_time [s]", "s"), ("mf_bandwidth [Hz]", "Hz"), ("mf_Er", "Er")],
    "Delay Doppler v2": [("ddv2_interpolate_dx [m]", "m"), ("ddv2_posting_interval [range lines]", " range lines"), ("ddv2_aperture_dist [km]", "km")],
}


def folder(path: Column | str) -> Column:
    """What stands before the last slash, empty without one."""
    path = F.col(path) if isinstance(path, str) else path
    return F.substring(path, F.lit(1), F.length(path) - F.length(F.substring_index(path, "/", -1)) - 1)


def joined(*parts: Column | str) -> Column:
    """Parts of a path with slashes between those that aren't empty."""
    return F.concat_ws("/", *(F.nullif(F.lit(p) if isinstance(p, str) else p, F.lit("")) for p in parts))


def files(index: DataFrame, raw: str, made: str, kinds: tuple[str, ...] | None = None, variants: dict[str, str] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """product_id, kind, name, path of each file that a product may have. index: of catalog.index. raw and made: roots of raw and of made data; variants: other folders by kind; keep: columns of the index that stay with its files.

    A path is made after its row, so that files that aren't asked for cost none.
    """
    variants, product, label = variants or {}, F.col("product_id"), F.col("file_specification_name")
    one = lambda kind, name, variant, ending: F.struct(F.lit(kind).alias("kind"), F.lit(name).alias("name"), F.lit(variant).alias("variant"), F.lit(ending).alias("ending"))
    all_ = [one("edr", "edr_lbl", "", None), *(one(kind, name, variants.get(kind, default), ending) for kind, name, default, ending in FILES)]
    rows = index.withColumn("below_", folder(label)).withColumn("f_", F.explode(F.array(*all_)))
    base = F.when(F.col("f_.kind") == "edr", joined(raw, "EDR")).otherwise(joined(F.lit(made), F.col("f_.kind")))
    own = joined(F.col("below_"), F.col("f_.variant"), F.concat(product, "f_.ending"))
    path = joined(base, F.col("volume_id"), F.when(F.col("f_.ending").isNull(), label).otherwise(own))
    rows = rows.select("product_id", "f_.kind", "f_.name", path.alias("path"), *keep)
    return rows if kinds is None else rows.where(F.col("kind").isin(*kinds))


def focused(path: Column | str, raw: str, made: str, focuser: str, parameters: dict) -> Column:
    """The focused file of a raw auxiliary file; an error for a path outside the archive."""
    if focuser not in FOCUSED:
        raise ValueError(f"no such focuser: {focuser}")
    path = F.col(path) if isinstance(path, str) else path
    inside = path.rlike(f"^{raw}/EDR/mrosh_00")
    below = F.when(inside, F.substring(folder(path), len(f"{raw}/EDR/") + 1, 4096)).otherwise(F.raise_error(F.concat(F.lit("not in the archive: "), path)).cast("string"))
    product = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"_a\.dat$", "")
    return joined(f"{made}/foc", below, "/".join(f"{parameters[name]}{unit}" for name, unit in FOCUSED[focuser]), F.concat(product, F.lit("_s.h5")))


def by_orbit(index: DataFrame) -> DataFrame:
    """orbit and its products, in order."""
    return index.groupBy("orbit").agg(F.sort_array(F.collect_list("product_id")).alias("products"))


def present(wanted: DataFrame, listing: DataFrame) -> DataFrame:
    """wanted (of files) that the listing of paths holds, by product: product_id, names."""
    return wanted.join(listing.select("path").distinct(), "path", "left_semi").groupBy("product_id").agg(F.sort_array(F.collect_list("name")).alias("names"))


def resolved(asked: DataFrame, index: DataFrame, col: str, single: bool = False) -> DataFrame:
    """asked with the index records that its column names, an orbit of seven digits or a product; null where there is none. single: the least product of several."""
    orbit = F.when(F.col(col).contains("_"), F.split(F.col(col), "_")[1]).otherwise(F.col(col))
    records = index.withColumnRenamed("orbit", "orbit_")
    if single:
        whole = F.col(col).contains("_")
        first = records.groupBy("orbit_").agg(F.min("product_id").alias("product_id"))
        chosen = asked.withColumn("orbit_", orbit).join(first.withColumnRenamed("product_id", "first_"), "orbit_", "left").withColumn("named_", F.when(whole, F.col(col)).otherwise(F.col("first_"))).drop("orbit_", "first_")
        return chosen.join(records.drop("orbit_").withColumnRenamed("product_id", "named_").withColumn("product_id", F.col("named_")), "named_", "left").drop("named_")
    rows = asked.withColumn("asked_orbit_", orbit)
    match = (F.col("asked_orbit_") == F.col("orbit_")) & (~F.col(col).contains("_") | (F.col("product_id") == F.col(col)))
    return rows.join(records, match, "left").drop("asked_orbit_", "orbit_")


def unknown(asked: DataFrame, index: DataFrame, col: str) -> DataFrame:
    """Distinct products asked for that the index doesn't have."""
    return asked.select(F.col(col).alias("product_id")).distinct().join(index.select("product_id"), "product_id", "left_anti")


def required(asked: DataFrame, index: DataFrame, col: str) -> DataFrame:
    """asked, unless it names products that the index doesn't have: an error that lists the first of them."""
    if missing := [r[0] for r in unknown(asked, index, col).orderBy("product_id").limit(20).collect()]:
        raise KeyError(f"unknown products: {', '.join(map(str, missing))}")
    return asked


def labels_of(data: DataFrame, listing: DataFrame, col: str = "path") -> DataFrame:
    """data with label, the path that describes it, and science, whether it is telemetry. The file's own label, else the first in its folder, upper-case endings first; null if there is none. Other names than *_a_s.dat and *_a_a.dat are an error."""
    path = F.col(col)
    science = F.when(path.endswith("_a_s.dat"), True).when(path.endswith("_a_a.dat"), False).otherwise(F.raise_error(F.concat(F.lit("neither telemetry nor auxiliary data: "), path)).cast("boolean"))
    found = listing.where(F.col("path").rlike(r"\.(LBL|lbl)$")).select(folder("path").alias("folder_"), F.col("path").alias("found_"))
    first = found.groupBy("folder_").agg(F.min(F.struct(F.col("found_").endswith(".lbl").alias("late"), F.col("found_").alias("path"))).alias("any_"))
    rows = data.withColumns({"science": science, "own_": F.regexp_replace(path, r"_a_[sa]\.dat$", "_a.lbl"), "folder_": folder(path)})
    rows = rows.join(found.select(F.col("found_").alias("own_"), F.lit(True).alias("there_")).distinct(), "own_", "left").join(first, "folder_", "left")
    return rows.withColumn("label", F.when(F.col("there_"), F.col("own_")).otherwise(F.col("any_.path"))).drop("own_", "folder_", "there_", "any_")


def ranging_tracks(lines: DataFrame, col: str = "value") -> DataFrame:
    """line, pair (consecutive lines form one), product, start and stop of the lines 'product start stop' that are neither blank nor comments. lines: with an order column `line`."""
    text = F.split(F.trim(F.regexp_replace(F.col(col), r"\s+", " ")), " ")
    rows = lines.where((F.trim(col) != "") & ~F.trim(col).startswith("#")).select("line", text[0].alias("product"), text[1].cast("long").alias("start"), text[2].cast("long").alias("stop"))
    order = Window.orderBy("line")  # a list written by hand
    return rows.withColumn("pair", F.floor((F.row_number().over(order) - 1) / 2))

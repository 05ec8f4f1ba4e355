"""Queries on the product catalogue: index records, files and track lists derived from orders."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .plans import catalog, paths
from .queries import query, table

RAW, MADE = "/orig/radar", "/targ/radar"

#: Index records: every third order has a second product of its orbit.
INDEX = "WITH idx AS (SELECT o_orderkey, 'mrosh_000' || (o_custkey % 5)::VARCHAR AS volume_id, 'e_' || orbit || '_00' || part::VARCHAR || '_ss' || lpad((o_custkey % 20)::VARCHAR, 2, '0') || '_700_a' AS product_id, orbit, 'data/edr' || substr(orbit, 1, 2) || 'xxx/edr' || orbit AS below FROM (SELECT *, lpad((o_orderkey % 10000000)::VARCHAR, 7, '0') AS orbit, unnest(range(1, CASE WHEN o_orderkey % 3 = 0 THEN 3 ELSE 2 END)) AS part FROM orders)) "


def index(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").withColumn("orbit", F.lpad((F.col("o_orderkey") % 10000000).cast("string"), 7, "0"))
    o = o.withColumn("part", F.explode(F.sequence(F.lit(1), F.when(F.col("o_orderkey") % 3 == 0, 2).otherwise(1))))
    product = F.format_string("E_%s_00%d_SS%02d_700_A", "orbit", "part", F.col("o_custkey") % 20)
    below = F.concat(F.lit("DATA/EDR"), F.substring("orbit", 1, 2), F.lit("XXX/EDR"), F.col("orbit"), F.lit("/"))
    records = o.select("o_orderkey", F.concat(F.lit("MROSH_000"), (F.col("o_custkey") % 5).cast("string")).alias("volume_id"), F.concat(below, product, F.lit(".LBL  ")).alias("file_specification_name"), product.alias("product_id"))
    return catalog.index(records, "o_orderkey")


@query(INDEX + f"SELECT product_id, kind, name, '{MADE}/' || kind || '/' || volume_id || '/' || below || '/' || variant || '/' || product_id || ending AS path FROM idx, (VALUES ('cmp', 'cmp_rad', 'ion', '_s.h5'), ('cmp', 'cmp_tecu', 'ion', '_s_TECU.txt'), ('alt', 'alt_h5', 'beta5', '_a.h5'), ('srf', 'srf_txt', 'cmp', '.txt'), ('rsr', 'rsr_txt', 'cmp', '.txt'), ('clu', 'clu_rad', 'icd', '.npz'), ('clu', 'clu_json', 'icd', '.json'), ('rng', 'rng_json', 'icd', '.json'), ('foc', 'foc_p0', '5m/5 range lines/6km', '_s.h5')) f(kind, name, variant, ending) UNION ALL SELECT product_id, 'edr', name, '{RAW}/EDR/' || volume_id || '/' || below || '/' || product_id || ending FROM idx, (VALUES ('edr_lbl', '.lbl'), ('edr_aux', '_a.dat'), ('edr_sci', '_s.dat')) f(name, ending)")
def product_files(spark, sf_dir):
    return paths.files(index(spark, sf_dir), RAW, MADE)


@query(INDEX + f"SELECT product_id, '{MADE}/foc/' || volume_id || '/' || below || '/115m/8.774s/0.4Hz/1.0Er/' || product_id || '_s.h5' AS path FROM idx")
def focused_files(spark, sf_dir):
    aux = paths.files(index(spark, sf_dir), RAW, MADE, ("edr",)).where("name = 'edr_aux'")
    parameters = {"mf_posting_distance [m]": 115, "mf_aperture_time [s]": 8.774, "mf_bandwidth [Hz]": 0.4, "mf_Er": 1.0}
    return aux.select("product_id", paths.focused("path", RAW, MADE, "Matched Filter", parameters).alias("path"))


@query(INDEX + "SELECT orbit, count(*) AS n, string_agg(product_id, ' ' ORDER BY product_id) AS products FROM idx GROUP BY orbit")
def products_by_orbit(spark, sf_dir):
    rows = paths.by_orbit(index(spark, sf_dir))
    return rows.select("orbit", F.size("products").cast("long").alias("n"), F.array_join("products", " ").alias("products"))


#: What is asked for: orbits of customers' keys, and for every fourth a whole name.
ASKED = "asked AS (SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'e_' || orbit || '_001_ss' || lpad((c_custkey % 20)::VARCHAR, 2, '0') || '_700_a' ELSE orbit END AS name, orbit FROM (SELECT c_custkey, lpad((c_custkey * 3)::VARCHAR, 7, '0') AS orbit FROM customer)) "


def asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    orbit = F.lpad((F.col("c_custkey") * 3).cast("string"), 7, "0")
    return table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("e_"), orbit, F.format_string("_001_ss%02d_700_a", F.col("c_custkey") % 20))).otherwise(orbit).alias("name"))


@query(INDEX + ", " + ASKED + "SELECT c_custkey, i.product_id, i.volume_id FROM asked a LEFT JOIN idx i ON i.orbit = a.orbit AND (a.name NOT LIKE '%\\_%' ESCAPE '\\' OR i.product_id = a.name)")
def orbit_lookup(spark, sf_dir):
    return paths.resolved(asked(spark, sf_dir), index(spark, sf_dir), "name").select("c_custkey", "product_id", "volume_id")


@query(INDEX + ", " + ASKED + ", least AS (SELECT orbit, min(product_id) AS product_id FROM idx GROUP BY orbit) SELECT c_custkey, i.product_id, i.volume_id FROM asked a LEFT JOIN least l USING (orbit) LEFT JOIN idx i ON i.product_id = CASE WHEN a.name LIKE '%\\_%' ESCAPE '\\' THEN a.name ELSE l.product_id END")
def single_orbit_lookup(spark, sf_dir):
    return paths.resolved(asked(spark, sf_dir), index(spark, sf_dir), "name", single=True).select("c_custkey", "product_id", "volume_id")


@query(INDEX + ", " + ASKED + "SELECT DISTINCT name AS product_id FROM asked WHERE c_custkey % 4 = 0 AND name NOT IN (SELECT product_id FROM idx)")
def unknown_products(spark, sf_dir):
    return paths.unknown(asked(spark, sf_dir).where("c_custkey % 4 = 0"), index(spark, sf_dir), "name")


@query(INDEX + "SELECT product_id, CASE WHEN length(product_id) > 0 AND ((o_orderkey % 2 = 0)::INT + (o_orderkey % 3 = 0)::INT) > 0 THEN CASE WHEN o_orderkey % 6 = 0 THEN 'cmp_rad srf_txt' WHEN o_orderkey % 2 = 0 THEN 'cmp_rad' ELSE 'srf_txt' END END AS names FROM idx WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0")
def files_present(spark, sf_dir):
    wanted = paths.files(index(spark, sf_dir), RAW, MADE, keep=("o_orderkey",))
    there = wanted.where("(name = 'cmp_rad' AND o_orderkey % 2 = 0) OR (name = 'srf_txt' AND o_orderkey % 3 = 0)")
    return paths.present(wanted, there).select("product_id", F.array_join("names", " ").alias("names"))


@query(INDEX + ", files AS (SELECT o_orderkey, product_id, '/d/' || orbit || '/' || product_id AS stem, '/d/' || orbit AS folder FROM idx), labels AS (SELECT CASE o_orderkey % 4 WHEN 0 THEN stem || '.lbl' WHEN 1 THEN folder || '/OTHER.LBL' ELSE folder || '/other.lbl' END AS path, folder FROM files WHERE o_orderkey % 4 < 3), first AS (SELECT folder, arg_min(path, (path LIKE '%.lbl', path)) AS path FROM labels GROUP BY folder) SELECT product_id, science, coalesce(l.path, f.path) AS label FROM files CROSS JOIN (VALUES (true), (false)) s(science) LEFT JOIN labels l ON l.path = stem || '.lbl' LEFT JOIN first f ON f.folder = files.folder")
def labels_of_files(spark, sf_dir):
    rows = index(spark, sf_dir).select("o_orderkey", "product_id", F.concat(F.lit("/d/"), "orbit").alias("folder"))
    data = rows.select("product_id", F.explode(F.array(*(F.concat("folder", F.lit("/"), "product_id", F.lit(x)) for x in ("_s.dat", "_a.dat")))).alias("path"))
    own = F.concat("folder", F.lit("/"), "product_id", F.lit(".lbl"))
    listing = rows.where("o_orderkey % 4 < 3").select(F.when(F.col("o_orderkey") % 4 == 0, own).when(F.col("o_orderkey") % 4 == 1, F.concat("folder", F.lit("/OTHER.LBL"))).otherwise(F.concat("folder", F.lit("/other.lbl"))).alias("path"))
    return paths.labels_of(data, listing.distinct()).select("product_id", "science", "label")


@query("SELECT line, floor((row_number() OVER (ORDER BY line) - 1) / 2)::BIGINT AS pair, 'e_' || s_nationkey::VARCHAR AS product, s_suppkey AS start, s_suppkey + 100 AS stop FROM (SELECT s_suppkey * 2 AS line, * FROM supplier) WHERE s_suppkey % 5 > 0")
def ranging_pairs(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    text = F.when(F.col("s_suppkey") % 5 == 0, F.when(F.col("s_suppkey") % 2 == 0, "   ").otherwise("# a comment")).otherwise(F.format_string(" e_%d   %d\t%d ", "s_nationkey", "s_suppkey", F.col("s_suppkey") + 100))
    return paths.ranging_tracks(s.select((F.col("s_suppkey") * 2).alias("line"), text.alias("value")))


@query(INDEX + "SELECT kind, count(*) AS n, min(product_id) AS least, max(product_id) AS most FROM (SELECT DISTINCT CASE o_orderkey % 4 WHEN 0 THEN 'cmp' WHEN 1 THEN 'srf' WHEN 2 THEN 'clu' ELSE 'alt' END AS kind, product_id FROM idx) WHERE kind <> 'clu' GROUP BY kind")
def processed_products(spark, sf_dir):
    files = paths.files(index(spark, sf_dir), RAW, MADE, keep=("o_orderkey",))
    there = files.where("(name LIKE 'cmp%' AND o_orderkey % 4 = 0) OR (name = 'srf_txt' AND o_orderkey % 4 = 1) OR (kind = 'clu' AND o_orderkey % 4 = 2) OR (name = 'alt_h5' AND o_orderkey % 4 = 3)")
    out = catalog.processed(there.select("kind", "path"))
    return out.groupBy("kind").agg(F.count("*").alias("n"), F.min("product").alias("least"), F.max("product").alias("most"))

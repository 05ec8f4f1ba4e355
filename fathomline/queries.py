"""The radar library's queries over the driver's tables, and the SQL that gives the same rows.

embeddings stand for radargrams (label: product, order of vec_id: trace, components: fast-time samples), events for along-track records (user_id: track), lineitem and orders for observations.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import geometry, signal, time, traces
from .operators import aggregates, clutter, focusing, interferometry, joins, kernels, ranging, selection, terrain, windows
from .plans import catalog
from .sources import labels

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(c) -> F.Column:
    """To six places, zero without a sign."""
    return F.round(c, 6) + 0.0


def radargram(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = windows.numbered(table(spark, sf_dir, "embeddings"), "label", F.floor(F.col("vec_id") / windows.CHUNK), ["vec_id"], "trace")
    return rows.select(F.col("label").alias("product"), "vec_id", "trace", F.transform("embedding", lambda x: x.cast("double")).alias("samples"))


def track(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = windows.numbered(table(spark, sf_dir, "events"), "user_id", F.to_date("ts"), ["ts", "event_id"], "i")
    return rows.select("user_id", "event_id", "ts", "value", "i")


GRAM = "WITH gram AS (SELECT label AS product, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS trace, list_transform(embedding, lambda x: x::DOUBLE) AS samples FROM embeddings), cells AS (SELECT product, trace, generate_subscripts(samples, 1) - 1 AS k, unnest(samples) AS x FROM gram) "
TRACK = "WITH track AS (SELECT user_id, event_id, ts, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i FROM events) "


@query(
    GRAM
    + """, summed AS (SELECT product, trace, k, max(trace) OVER (PARTITION BY product) AS last, x, sum(x) OVER (PARTITION BY product, k ORDER BY trace ROWS BETWEEN 3 PRECEDING AND 2 FOLLOWING) AS s FROM cells),
filtered AS (SELECT product, trace, k, CASE WHEN trace >= 3 AND trace <= last - 3 THEN s ELSE x END AS x FROM summed),
each AS (SELECT product, trace, max(abs(x)) AS peak, sqrt(sum(CASE WHEN k < 16 THEN x * x END) / 16) AS noise FROM filtered GROUP BY product, trace)
SELECT product, count(*) AS traces, round(avg(20 * log10(peak / noise)), 6) AS snr_db FROM each GROUP BY product"""
)
def radargram_snr(spark, sf_dir):
    rows = windows.zero_doppler(radargram(spark, sf_dir), "product", "trace", "samples", 3, 2)
    best = F.array_max(traces.signal_to_noise("samples", 16))
    return rows.groupBy("product").agg(F.count("*").alias("traces"), r6(F.avg(best)).alias("snr_db"))


@query(TRACK + "SELECT user_id, event_id, round(CASE WHEN count(*) OVER w = 5 THEN avg(value) OVER w ELSE 0 END, 6) + 0.0 AS mean FROM track WINDOW w AS (PARTITION BY user_id ORDER BY i ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)")
def running_mean_zero_edges(spark, sf_dir):
    return windows.centred_mean(track(spark, sf_dir), "user_id", "i", "value", 5, "mean").select("user_id", "event_id", r6("mean").alias("mean"))


@query(TRACK + ", n AS (SELECT user_id, max(i) AS last FROM track GROUP BY user_id) SELECT t.user_id, t.event_id, round(avg(u.value), 6) + 0.0 AS mean FROM track t JOIN n USING (user_id), unnest(range(-2, 3)) AS o(d) JOIN track u ON u.user_id = t.user_id AND u.i = greatest(0, least(n.last, t.i + d)) GROUP BY t.user_id, t.event_id")
def running_mean_repeated_edges(spark, sf_dir):
    return windows.centred_mean(track(spark, sf_dir), "user_id", "i", "value", 5, "mean", edge="repeat").select("user_id", "event_id", r6("mean").alias("mean"))


@query(TRACK + "SELECT user_id, event_id, round(m, 6) + 0.0 AS mean FROM (SELECT user_id, event_id, avg(value) OVER w AS m, count(*) OVER w AS n FROM track WINDOW w AS (PARTITION BY user_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING)) WHERE n = 4")
def running_mean_trailing(spark, sf_dir):
    return windows.trailing_mean(track(spark, sf_dir), "user_id", "i", "value", 4, "mean").select("user_id", "event_id", r6("mean").alias("mean"))


@query(TRACK + "SELECT user_id, event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY i ROWS UNBOUNDED PRECEDING), 6) + 0.0 AS total FROM track")
def along_track_prefix_sum(spark, sf_dir):
    return windows.prefix_sum(track(spark, sf_dir), "user_id", "i", "value", "total").select("user_id", "event_id", r6("total").alias("total"))


@query(TRACK + ", held AS (SELECT user_id, i, floor(value / 20) AS v FROM track), marked AS (SELECT *, coalesce((abs(v - lag(v) OVER (PARTITION BY user_id ORDER BY i)) > 0)::INT, 0) AS new FROM held), runs AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS island FROM marked), agg AS (SELECT user_id, island::BIGINT AS island, arg_min(v, i)::BIGINT AS held, count(*) AS n, min(i) AS lo, max(i) AS hi FROM runs GROUP BY user_id, island) SELECT user_id, island, held, n, (lo + hi) / 2.0 AS t FROM agg UNION ALL SELECT user_id, -1, held, n, lo::DOUBLE FROM agg a WHERE (SELECT max(island) FROM agg b WHERE b.user_id = a.user_id) = 0")
def sample_hold_islands(spark, sf_dir):
    held = track(spark, sf_dir).withColumn("held", F.floor(F.col("value") / 20))
    return windows.islands(held, "user_id", "i", "held").select("user_id", "island", F.col("value").alias("held"), "n", "t")


@query(TRACK + ", n AS (SELECT user_id, count(*) AS n FROM track GROUP BY user_id) SELECT user_id, event_id, least(i // 16, CASE WHEN n % 16 < 5 AND n > 16 THEN CASE WHEN n % 16 = 0 THEN n // 16 - 2 ELSE n // 16 - 1 END ELSE (n - 1) // 16 END) AS chunk FROM track JOIN n USING (user_id)")
def fixed_row_chunks(spark, sf_dir):
    return windows.fixed_chunks(track(spark, sf_dir), "user_id", "i", 16, 5).select("user_id", "event_id", F.col("chunk").cast("long").alias("chunk"))


@query(
    TRACK.replace("WITH track", "WITH RECURSIVE track")
    + """, gone AS (SELECT user_id, i, sum(abs(round(value, 3))) OVER (PARTITION BY user_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS km, max(i) OVER (PARTITION BY user_id) AS last FROM track),
walk AS (SELECT user_id, i, km, last, km AS start, 0 AS chunk FROM gone WHERE i = 0 UNION ALL SELECT g.user_id, g.i, g.km, g.last, CASE WHEN g.km > w.start + 300 THEN g.km ELSE w.start END, w.chunk + (g.km > w.start + 300)::INT FROM walk w JOIN gone g ON g.user_id = w.user_id AND g.i = w.i + 1),
ends AS (SELECT user_id, chunk AS most, chunk > 0 AND km - start < 150 AS short FROM walk WHERE i = last)
SELECT user_id, least(chunk, most - short::INT) AS chunk, count(*) AS n, min(i) AS first_row, max(i) AS last_row FROM walk JOIN ends USING (user_id) GROUP BY ALL"""
)
def greedy_distance_chunks(spark, sf_dir):
    metres = F.round(F.abs(F.round("value", 3)) * 1000).cast("long")  # whole, so that sums don't depend on their order where a chunk is exactly full
    gone = windows.prefix_sum(track(spark, sf_dir).withColumn("step", metres), "user_id", "i", "step", "m")
    return windows.distance_chunks(gone, "user_id", "i", "m", 300_000.0).groupBy("user_id", "chunk").agg(F.count("*").alias("n"), F.min("i").alias("first_row"), F.max("i").alias("last_row"))


@query(GRAM + ", stacks AS (SELECT product, trace // 4 AS block, k, sum(x) AS s, count(*) AS n FROM cells GROUP BY ALL) SELECT product, block, count(*) AS samples, round(max(s), 6) + 0.0 AS peak FROM stacks WHERE n = 4 GROUP BY product, block")
def coherent_block_stack(spark, sf_dir):
    out = windows.block_stack(radargram(spark, sf_dir), ["product"], "trace", "samples", 4)
    return out.select("product", "block", F.size("samples").cast("long").alias("samples"), r6(F.array_max("samples")).alias("peak"))


@query(GRAM + ", stacks AS (SELECT product, trace // 5 AS stack, k, sum(x) AS s, count(*) AS n FROM cells WHERE trace % 5 < 4 GROUP BY ALL) SELECT product, stack, k, round(s, 6) + 0.0 AS total FROM stacks WHERE n = 4")
def fresnel_stacks(spark, sf_dir):
    rows = radargram(spark, sf_dir).select("product", "trace", F.posexplode("samples").alias("k", "x"))
    return aggregates.fresnel_stack(rows, ["product", "k"], "trace", "x", 5).select("product", "stack", F.col("k").cast("long").alias("k"), r6("total").alias("total"))


@query("SELECT o_orderkey, round(r * cos(lon) * cos(lat), 3) + 0.0 AS x, round(r * sin(lon) * cos(lat), 3) + 0.0 AS y, round(r * sin(lat), 3) + 0.0 AS z FROM (SELECT o_orderkey, lat, lon, h + 1000 * a * a * c / sqrt(pow(a * a * sin(lat), 2) + pow(a * c * cos(lat) * cos(lon), 2) + pow(a * c * cos(lat) * sin(lon), 2)) AS r FROM (SELECT *, 3396.19::DOUBLE AS a, 3376.2::DOUBLE AS c FROM (SELECT o_orderkey, radians((o_orderkey % 179 - 89)::DOUBLE) AS lat, radians((o_custkey % 360)::DOUBLE) AS lon, (o_orderkey % 1000)::DOUBLE AS h FROM orders)))")
def spherical_to_cartesian(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    x, y, z = geometry.to_cartesian(F.col("o_orderkey") % 179 - 89, F.col("o_custkey") % 360, F.col("o_orderkey") % 1000, axes=(3396.19, 3396.19, 3376.2))
    return o.select("o_orderkey", *((F.round(c, 3) + 0.0).alias(n) for c, n in ((x, "x"), (y, "y"), (z, "z"))))


@query("SELECT o_orderkey, round(degrees(asin(z / r)), 6) + 0.0 AS lat, round(degrees(CASE WHEN a >= 2 * pi() THEN a - 2 * pi() ELSE a END), 6) + 0.0 AS lon, round(r, 6) AS height FROM (SELECT o_orderkey, z, sqrt(x * x + y * y + z * z) AS r, atan2(y, x) + 2 * pi() AS a FROM (SELECT o_orderkey, (o_orderkey % 97 - 48)::DOUBLE AS x, (o_custkey % 89 - 44)::DOUBLE AS y, (o_orderkey % 13 + 1)::DOUBLE AS z FROM orders))")
def cartesian_to_spherical(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    lat, lon, h = geometry.to_spherical(F.col("o_orderkey") % 97 - 48, F.col("o_custkey") % 89 - 44, F.col("o_orderkey") % 13 + 1)
    return o.select("o_orderkey", r6(lat).alias("lat"), r6(lon).alias("lon"), r6(h).alias("height"))


@query("SELECT o_orderkey, round(3389.5 * 2 * atan2(sqrt(h), sqrt(1 - h)), 6) + 0.0 AS km FROM (SELECT o_orderkey, pow(sin(radians(lat2 - lat1) / 2), 2) + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2) AS h FROM (SELECT o_orderkey, (o_orderkey % 179 - 89)::DOUBLE AS lat1, (o_custkey % 360)::DOUBLE AS lon1, (o_custkey % 179 - 89)::DOUBLE AS lat2, (o_orderkey % 360)::DOUBLE AS lon2 FROM orders))")
def great_circle_distance(spark, sf_dir):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, sf_dir, "orders").select("o_orderkey", r6(geometry.haversine_distance(k % 179 - 89, c % 360, c % 179 - 89, k % 360, 3389.5)).alias("km"))


MARS = "(SELECT *, ceil(since / (88775.245 * 668.6))::INT AS my FROM (SELECT *, epoch_us(ts) / 1e6 + 464745600 AS since FROM events))"


@query(f"SELECT event_id, my, round(epoch_us(ts) / 1e6 - 946728000, 3) AS j2000, round(ls, 6) AS ls FROM (SELECT *, list_reduce(list_transform(range(1, 13), lambda i: CASE WHEN sols >= s[i] AND sols < s[i + 1] THEN 30.0 * (i - 1) + 30.0 * ((sols - s[i]) / (s[i + 1] - s[i])) ELSE 0 END), lambda a, b: a + b) AS ls FROM (SELECT *, (since - (my - 1) * (88775.245 * 668.6)) / 88775.245 AS sols, [0.0, 61.2, 126.6, 193.3, 257.8, 317.5, 371.9, 421.6, 468.5, 514.6, 562.0, 612.9, 668.6]::DOUBLE[] AS s FROM {MARS}))")
def martian_time(spark, sf_dir):
    j = time.seconds_since_j2000("ts")
    return table(spark, sf_dir, "events").select("event_id", F.round(j, 3).alias("j2000"), time.mars_year(j).alias("my"), F.round(time.solar_longitude(j), 6).alias("ls"))


@query(GRAM + ", p AS (SELECT product, trace, samples, list_position(samples, list_max(samples)) - 1 AS i FROM gram), y AS (SELECT product, trace, i, samples[i] AS l, samples[i + 1] AS m, samples[i + 2] AS r FROM p WHERE i > 0 AND i < 63) SELECT product, trace, i AS sample, round((r - l) / (2 * (2 * m - r - l)), 6) + 0.0 AS place, round(m - 0.25 * (l - r) * ((r - l) / (2 * (2 * m - r - l))), 6) + 0.0 AS height FROM y")
def parabolic_peaks(spark, sf_dir):
    rows = radargram(spark, sf_dir).withColumn("sample", traces.argmax("samples")).where("sample > 0 AND sample < 63")
    at = lambda k: F.get("samples", F.col("sample") + k)
    return rows.withColumn("p", signal.parabola3(at(-1), at(0), at(1))).select("product", "trace", F.col("sample").cast("long").alias("sample"), r6("p.place").alias("place"), r6("p.height").alias("height"))


@query(GRAM + ", p AS (SELECT product, trace, samples AS s, list_position(samples, list_max(samples)) - 1 AS i FROM gram), f AS (SELECT *, (-6 * s[i - 1] + 24 * s[i] + 34 * s[i + 1] + 24 * s[i + 2] - 6 * s[i + 3]) / 70 AS a, (-2 * s[i - 1] - s[i] + s[i + 2] + 2 * s[i + 3]) / 10 AS b, s[i - 1] + s[i] + s[i + 1] + s[i + 2] + s[i + 3] AS t FROM p WHERE i >= 2 AND i <= 61), g AS (SELECT *, (t - 5 * a) / 10 AS c FROM f) SELECT product, trace, round(-b / (2 * c), 5) + 0.0 AS place, round(c, 6) + 0.0 AS curvature FROM g")
def five_point_peaks(spark, sf_dir):
    rows = radargram(spark, sf_dir).withColumn("i", traces.argmax("samples")).where("i >= 2 AND i <= 61").withColumn("p", signal.peak("samples", "i"))
    return rows.select("product", "trace", (F.round("p.place", 5) + 0.0).alias("place"), r6("p.curvature").alias("curvature"))


@query("SELECT o_orderkey, round(20 * log10(o_totalprice / 250), 6) + 0.0 AS altitude_gain, round(0.41 + 1.62 * x + 1.10 * x * x - 0.65 * x * x * x - 0.66 * x * x * x * x, 6) + 0.0 AS latitude_gain, round(pow(2, ceil(log2(p)) - 8 + 8) / p, 6) AS static_scale FROM (SELECT o_orderkey, o_totalprice, (o_custkey % 181 - 90)::DOUBLE / 90 AS x, [1, 2, 3, 4, 8, 16, 32, 64][o_orderkey % 8 + 1] AS p FROM orders)")
def instrument_gains(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", r6(signal.altitude_gain("o_totalprice")).alias("altitude_gain"), r6(signal.latitude_gain(F.col("o_custkey") % 181 - 90)).alias("latitude_gain"), r6(signal.static_scale(signal.presum_of((F.col("o_orderkey") % 8).cast("int")), 8)).alias("static_scale"))


@query("SELECT l_orderkey AS track, floor((l_linenumber - 1) / 2)::BIGINT AS pair, round(max(CASE WHEN l_linenumber % 2 = 1 THEN l_quantity END) - max(CASE WHEN l_linenumber % 2 = 0 THEN l_quantity END), 6) + 0.0 AS residual FROM (SELECT l_orderkey, l_linenumber, sum(l_quantity) AS l_quantity FROM lineitem GROUP BY ALL) GROUP BY 1, 2 HAVING count(DISTINCT l_linenumber % 2) = 2")
def crossover_residuals(spark, sf_dir):
    one = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.sum("l_quantity").alias("q")).select(F.col("l_orderkey").alias("track"), (F.col("l_linenumber") - 1).alias("i"), "q")
    return joins.crossovers(one, "i", "q", "track").select("track", "pair", r6("residual").alias("residual"))


@query("WITH m AS (SELECT l_suppkey, quantile_cont(l_extendedprice, 0.5) AS med FROM lineitem GROUP BY 1), d AS (SELECT l.l_suppkey, abs(l_extendedprice - med) AS d FROM lineitem l JOIN m USING (l_suppkey)), s AS (SELECT l_suppkey, quantile_cont(d, 0.5) AS mad FROM d GROUP BY 1) SELECT l_suppkey, count(*) AS n, count(*) FILTER (0.6745 * d > 2.0 * mad) AS outliers FROM d JOIN s USING (l_suppkey) GROUP BY l_suppkey")
def mad_outliers(spark, sf_dir):
    rows = aggregates.outliers(table(spark, sf_dir, "lineitem").select("l_suppkey", "l_extendedprice"), ["l_suppkey"], "l_extendedprice", 2.0)
    return rows.groupBy("l_suppkey").agg(F.count("*").alias("n"), F.count_if("outlier").alias("outliers"))


@query(TRACK + "SELECT a.user_id, a.event_id AS event_id, count(*) AS near FROM track a JOIN track b ON a.user_id = b.user_id AND abs(a.i - b.i) <= 5 GROUP BY a.user_id, a.event_id")
def rows_within_reach(spark, sf_dir):
    t = track(spark, sf_dir)
    pairs = joins.within(t.select("user_id", "event_id", "i"), t.select("user_id", F.col("i").alias("j")), ["user_id"], "i", "j", 5)
    return pairs.groupBy("user_id", "event_id").agg(F.count("*").alias("near"))


ASOF = TRACK + ", posts AS (SELECT * FROM track WHERE i % 5 = 0), p AS (SELECT *, epoch_us(ts) / 1e6 AS s FROM track), q AS (SELECT user_id, value AS v, epoch_us(ts) / 1e6 AS s FROM posts) "


@query(ASOF + "SELECT p.user_id, p.event_id, round(a.v + coalesce((p.s - a.s) / nullif(b.s - a.s, 0), 0) * (b.v - a.v), 5) + 0.0 AS at_time FROM p ASOF LEFT JOIN q a ON p.user_id = a.user_id AND p.s >= a.s ASOF LEFT JOIN q b ON p.user_id = b.user_id AND p.s <= b.s WHERE p.i % 5 <> 0")
def interpolated_track(spark, sf_dir):
    t = track(spark, sf_dir).withColumn("s", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)
    posts = t.where("i % 5 = 0").select("user_id", F.col("s").alias("t"), F.col("value").alias("v"))
    return joins.interpolated(t.where("i % 5 <> 0").select("user_id", "event_id", "s"), posts, "user_id", "s", "t", "v", "at_time").select("user_id", "event_id", (F.round("at_time", 5) + 0.0).alias("at_time"))


@query("WITH posts AS (SELECT l_orderkey AS k, l_extendedprice AS p, l_linenumber AS i FROM lineitem WHERE l_linenumber <= 3), asked AS (SELECT l_orderkey AS k, l_linenumber AS n, l_extendedprice AS x FROM lineitem WHERE l_linenumber > 3) SELECT DISTINCT k, n, cell FROM (SELECT k, n, x, arg_min(i, (abs(p - x), i)) AS cell FROM asked JOIN posts USING (k) GROUP BY k, n, x)")
def nearest_cells(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), "l_linenumber", "l_extendedprice")
    posts = li.where("l_linenumber <= 3").select("k", F.col("l_extendedprice").alias("p"), F.col("l_linenumber").alias("cell"))
    asked = li.where("l_linenumber > 3").select("k", F.col("l_linenumber").alias("n"), F.col("l_extendedprice").alias("x"))
    return joins.nearest(asked, posts, "k", "x", "p", "cell").where("cell IS NOT NULL").select("k", "n", "cell").distinct()


PLACE = "SELECT o_orderkey, o_custkey, o_custkey % 200 AS orbit, (o_orderkey * 7 % 181 - 90)::DOUBLE AS lat, (o_custkey * 11 % 361)::DOUBLE AS lon FROM orders"


def places(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", (F.col("o_custkey") % 200).alias("orbit"), (F.col("o_orderkey") * 7 % 181 - 90).cast("double").alias("lat"), (F.col("o_custkey") * 11 % 361).cast("double").alias("lon"))


@query("WITH q(quadrangle, south, north, west, east) AS (VALUES " + ", ".join(f"('{a}', {c}, {d}, {e}, {f})" for a, _, c, d, e, f in selection.QUADRANGLES) + f") SELECT quadrangle, count(*) AS n, count(DISTINCT orbit) AS orbits FROM ({PLACE}) JOIN q ON lat > south AND lat < north AND lon > west AND lon < east GROUP BY quadrangle")
def quadrangle_counts(spark, sf_dir):
    return selection.in_quadrangles(places(spark, sf_dir), "lat", "lon").groupBy("quadrangle").agg(F.count("*").alias("n"), F.countDistinct("orbit").alias("orbits"))


@query(f"SELECT orbit, min(o_orderkey) AS first_seen FROM ({PLACE}) WHERE lat > 0 AND lat < 30 AND lon > 135 AND lon < 180 GROUP BY orbit")
def orbits_in_box(spark, sf_dir):
    return selection.orbits_within(places(spark, sf_dir), {"lat": (0, 30), "lon": (135, 180)}, "orbit", "o_orderkey")


@query(f"WITH p AS (SELECT * FROM ({PLACE}) WHERE lat BETWEEN -30 AND 30 AND lon BETWEEN 0 AND 180) SELECT orbit, count(*) AS n, round(avg(lat), 6) + 0.0 AS lat FROM p GROUP BY orbit HAVING count(*) > 10")
def profiles_in_box(spark, sf_dir):
    rows = selection.profiles_within(places(spark, sf_dir), "orbit", {"lat": (-30, 30), "lon": (0, 180)}, 10)
    return rows.groupBy("orbit").agg(F.count("*").alias("n"), r6(F.avg("lat")).alias("lat"))


@query(f"SELECT orbit, min(o_orderkey) AS first_row, max(o_orderkey) AS last_row, count(*) AS n FROM ({PLACE}) WHERE lat > 0 AND lat < 30 AND lon > 200 AND lon < 300 GROUP BY orbit HAVING count(*) > 2")
def groundtrack_segments(spark, sf_dir):
    return selection.segments_within(places(spark, sf_dir), "orbit", "o_orderkey", {"lat": (0, 30), "lon": (200, 300)}, 2)


@query("SELECT o_orderkey, c_custkey, round(o_totalprice, 2) AS o_totalprice FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = 'BUILDING' AND o_orderstatus <> 'F' AND o_totalprice > 1000 AND o_totalprice < 250000 AND o_orderkey % 3 = 0")
def gathered_datapoints(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_totalprice", "o_orderstatus")
    customers = table(spark, sf_dir, "customer")
    bad = orders.where("o_orderstatus = 'F'").select("o_orderkey")
    rows = selection.every_nth(orders, "o_orderkey", 3).join(customers.where("c_mktsegment = 'BUILDING'").select("c_custkey"), "c_custkey", "left_semi")
    flags = orders.select("c_custkey", "o_orderkey", "o_orderstatus")
    out = joins.gather(rows.drop("o_orderstatus"), orders.select("o_orderkey"), bad, flags, "o_orderkey", "c_custkey", {"o_totalprice": (1000, 250000)})
    return out.select("o_orderkey", "c_custkey", F.round("o_totalprice", 2).alias("o_totalprice"))


@query("SELECT a.i AS price_cell, b.j AS quantity_cell, count(*) AS n, round(avg(l_tax), 9) AS mean, min(l_tax) AS least, max(l_tax) AS most, count(DISTINCT l_suppkey) AS sources FROM lineitem, unnest(range(0, 60)) AS a(i), unnest(range(0, 12)) AS b(j) WHERE l_extendedprice >= a.i * 2000 AND l_extendedprice < a.i * 2000 + 5000 AND l_quantity >= b.j * 5 AND l_quantity < b.j * 5 + 10 GROUP BY 1, 2")
def overlapping_statistics_cube(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("quantity"), "l_tax", "l_suppkey")
    out = aggregates.overlapping_cube(rows, {"price": (0.0, 2000.0, 5000.0), "quantity": (0.0, 5.0, 10.0)}, "l_tax", "l_suppkey")
    return out.where("price_cell < 60 AND quantity_cell < 12").withColumn("mean", F.round("mean", 9))


@query("WITH e AS (SELECT l_returnflag AS flag, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, count(*) AS n FROM lineitem GROUP BY 1), b AS (SELECT flag, lo, (hi - lo) / 50 AS w, n, least(floor((l_extendedprice - lo) / ((hi - lo) / 50)), 49)::BIGINT AS bin FROM lineitem JOIN e ON flag = l_returnflag), c AS (SELECT e.flag, lo, (hi - lo) / 50 AS w, n, i, (SELECT count(*) FROM b WHERE b.flag = e.flag AND b.bin <= i) / n AS share FROM e, unnest(range(0, 50)) AS t(i)) SELECT flag, s AS share, round(arg_min(lo + (i + 0.5) * w, (abs(share - s), i)), 4) AS value FROM c, unnest([0.16, 0.5, 0.84]::DOUBLE[]) AS x(s) GROUP BY flag, s")
def histogram_cdf_quantiles(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("flag"), "l_extendedprice")
    return aggregates.histogram_quantiles(rows, ["flag"], "l_extendedprice").withColumn("value", F.round("value", 4))


@query(GRAM + ", z AS (SELECT product, trace, samples[k + 1] AS re, samples[k + 33] AS im FROM gram, unnest(range(0, 32)) AS t(k)), y AS (SELECT a.product, a.re AS r1, a.im AS i1, b.re AS r2, b.im AS i2 FROM (SELECT product, trace, k, samples[k + 1] AS re, samples[k + 33] AS im FROM gram, unnest(range(0, 32)) AS t(k)) a JOIN (SELECT product, trace, k, samples[k + 1] AS re, samples[k + 33] AS im FROM gram, unnest(range(0, 32)) AS t(k)) b ON a.product = b.product AND a.k = b.k AND b.trace = a.trace + 1) SELECT product, round(sqrt(pow(avg(r1 * r2 + i1 * i2), 2) + pow(avg(i1 * r2 - r1 * i2), 2)) / sqrt(avg(r1 * r1 + i1 * i1) * avg(r2 * r2 + i2 * i2)), 6) AS coherence, round(atan2(avg(i1 * r2 - r1 * i2), avg(r1 * r2 + i1 * i2)), 5) + 0.0 AS phase FROM y GROUP BY product")
def along_track_coherence(spark, sf_dir):
    rows = radargram(spark, sf_dir).withColumn("next", F.lead("samples").over(Window.partitionBy("product").orderBy("trace"))).where("next IS NOT NULL")
    half = lambda c, name: F.transform(F.slice(c, 1, 32), lambda x, i: F.struct(x.alias("re"), F.get(c, i + 32).alias("im"))).alias(name)
    cells = rows.select("product", half("samples", "a"), half("next", "b")).select("product", F.explode(F.arrays_zip("a", "b")).alias("z"))
    flat = cells.select("product", F.col("z.a.re").alias("r1"), F.col("z.a.im").alias("i1"), F.col("z.b.re").alias("r2"), F.col("z.b.im").alias("i2"))
    return aggregates.coherence(flat, ["product"], "r1", "i1", "r2", "i2").select("product", r6("coherence").alias("coherence"), (F.round("phase", 5) + 0.0).alias("phase"))


@query(GRAM + ", d AS (SELECT product, trace, k, abs(x - lag(x) OVER (PARTITION BY product, trace ORDER BY k)) AS d FROM cells), n AS (SELECT product, trace, stddev_pop(d) FILTER (k > 31) * 3 AS noise FROM d GROUP BY ALL), h AS (SELECT d.product, d.trace, l, min(k - 1) AS k FROM d JOIN n USING (product, trace), unnest(range(1, 11)) AS t(l) WHERE d.d > noise * (l / 10.0) AND k - 1 >= 6 AND k - 1 < 46 GROUP BY ALL) SELECT gram.product, gram.trace, arg_max(h.k, l)::INT AS pick FROM gram LEFT JOIN h ON h.product = gram.product AND h.trace = gram.trace GROUP BY ALL")
def coarse_surface_picks(spark, sf_dir):
    return radargram(spark, sf_dir).select("product", "trace", traces.coarse_pick("samples", 2, noise_scale=3.0, skip=4, reach=40, tail=32).alias("pick"))


@query(GRAM + ", d AS (SELECT product, trace, k - 1 AS k, abs(x - lag(x) OVER (PARTITION BY product, trace ORDER BY k)) AS d FROM cells), n AS (SELECT product, trace, stddev_pop(d) FILTER (k < 16) * 2.5 AS lim FROM d WHERE k >= 0 GROUP BY ALL) SELECT product, trace, coalesce(min(k) FILTER (d > lim), arg_min(k, (-d, k)))::INT AS pick FROM d JOIN n USING (product, trace) WHERE k >= 16 GROUP BY ALL")
def threshold_surface_picks(spark, sf_dir):
    return radargram(spark, sf_dir).select("product", "trace", traces.threshold_pick("samples", 16, 16, 2.5).alias("pick"))


@query(GRAM + ", m AS (SELECT product, trace, max(abs(x)) AS top, arg_min(k, (-abs(x), k)) AS k, avg(abs(x)) FILTER (k < 16) AS noise FROM cells GROUP BY ALL) SELECT product, trace, CASE WHEN top >= 3 * noise THEN k END::INT AS pick FROM m")
def amplitude_surface_picks(spark, sf_dir):
    return radargram(spark, sf_dir).select("product", "trace", traces.surface_pick("samples", 3.0, 0, 16).alias("pick"))


@query(GRAM + ", n AS (SELECT a.product, a.trace, lag_ AS lag, avg(abs(a.x - b.x)) AS mad FROM cells a, unnest(range(0, 9)) AS t(lag_) JOIN cells b ON b.product = a.product AND b.trace = a.trace AND b.k = (a.k - lag_ + 64) % 64 WHERE lag_ > 0 GROUP BY ALL) SELECT product, trace, lag, round(mad, 6) AS mad FROM n")
def rolled_differences(spark, sf_dir):
    rows = radargram(spark, sf_dir)
    lags = F.array(*(F.struct(F.lit(k).cast("long").alias("lag"), F.round(traces.shifted_difference("samples", "samples", k, True), 6).alias("mad")) for k in range(1, 9)))
    return rows.select("product", "trace", F.explode(lags).alias("x")).select("product", "trace", "x.*")


@query(GRAM + ", r AS (SELECT product, trace, k, x, row_number() OVER (PARTITION BY product, trace ORDER BY abs(x) DESC, k) AS rank FROM cells) SELECT product, trace, k, rank FROM r WHERE rank <= round_even(64 * 0.2, 0)")
def strongest_facets(spark, sf_dir):
    rows = radargram(spark, sf_dir).select("product", "trace", F.posexplode("samples").alias("k", "x")).withColumn("power", F.abs("x"))
    return aggregates.strongest(rows, ["product", "trace"], "power", "k").select("product", "trace", F.col("k").cast("long").alias("k"), F.col("rank").cast("long").alias("rank"))


@query("SELECT o_orderkey, round(atan2(im, re), 5) + 0.0 AS phase, round(10 * log10(re * re + im * im), 5) + 0.0 AS level FROM (SELECT o_orderkey, pow(10, db / 20) * cos(ph) AS re, pow(10, db / 20) * sin(ph) AS im FROM (SELECT o_orderkey, (o_custkey % 60)::DOUBLE AS db, (o_orderkey % 628)::DOUBLE / 100 AS ph FROM orders))")
def complex_round_trip(spark, sf_dir):
    re, im = signal.to_complex(F.col("o_custkey") % 60, (F.col("o_orderkey") % 628).cast("double") / 100)
    level, phase = signal.to_polar(re, im)
    return table(spark, sf_dir, "orders").select("o_orderkey", (F.round(phase, 5) + 0.0).alias("phase"), (F.round(level, 5) + 0.0).alias("level"))


FILES = "SELECT l_orderkey AS product_id, CASE WHEN l_linenumber % 3 = 0 THEN 'out' ELSE 'in' END AS role, CASE WHEN l_quantity < 3 THEN NULL ELSE epoch(l_shipdate)::BIGINT END AS mtime FROM lineitem"


@query(f"SELECT product_id, CASE WHEN lo = -1 THEN 'input_missing' ELSE 'input_ok' END AS input_status, CASE WHEN out = -1 THEN 'output_missing' WHEN lo = -1 THEN 'output_exists' WHEN NOT hi < out THEN 'output_stale' ELSE 'output_ok' END AS output_status FROM (SELECT product_id, min(coalesce(mtime, -1)) FILTER (role = 'in') AS lo, max(coalesce(mtime, -1)) FILTER (role = 'in') AS hi, min(coalesce(mtime, -1)) FILTER (role = 'out') AS out FROM ({FILES}) GROUP BY 1 HAVING count(DISTINCT role) = 2)")
def product_freshness(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    files = li.select(F.col("l_orderkey").alias("product_id"), F.when(F.col("l_linenumber") % 3 == 0, "out").otherwise("in").alias("role"), F.when(F.col("l_quantity") >= 3, F.unix_seconds(F.col("l_shipdate").cast("timestamp"))).alias("mtime"))
    both = files.groupBy("product_id").agg(F.countDistinct("role").alias("n")).where("n = 2").select("product_id")
    return catalog.status(files.join(both, "product_id", "left_semi"))


@query("SELECT o_custkey AS product, count(*) FILTER (o_orderstatus = 'F') AS \"F\", count(*) FILTER (o_orderstatus = 'O') AS \"O\", count(*) FILTER (o_orderstatus = 'P') AS \"P\" FROM orders GROUP BY 1 UNION ALL SELECT NULL, count(DISTINCT o_custkey) FILTER (o_orderstatus = 'F'), count(DISTINCT o_custkey) FILTER (o_orderstatus = 'O'), count(DISTINCT o_custkey) FILTER (o_orderstatus = 'P') FROM orders")
def product_status_table(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("product"), "o_orderstatus")
    return catalog.status_table(o, "product", "o_orderstatus", ["F", "O", "P"])


@query("SELECT o_orderkey, lower(rtrim('E_' || lpad((o_orderkey % 10000000)::VARCHAR, 7, '0') || '_001_SS' || lpad((o_custkey % 20)::VARCHAR, 2, '0') || '_700_A  ')) AS product, lpad((o_orderkey % 10000000)::VARCHAR, 7, '0') AS orbit FROM orders")
def product_names(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    orbit = F.lpad((F.col("o_orderkey") % 10000000).cast("string"), 7, "0")
    path = F.concat(F.lit("/data/e_"), orbit, F.lit("_001_ss"), F.lpad((F.col("o_custkey") % 20).cast("string"), 2, "0"), F.lit("_700_a_a.dat"))
    product = catalog.product_of(path)
    return o.select("o_orderkey", product.alias("product"), F.substring(product, 3, 7).alias("orbit"))


#: The chirp's spectrum over 64 samples; the window of its band; the two as a filter in time.
CHIRP = """, chirp AS (SELECT 63 - j AS j, -sin(a) AS re, cos(a) AS im FROM (SELECT j, 2 * pi() * (15e6 * j * 0.0375e-6 + 1e7 / 85.05e-6 / 2 * pow(j * 0.0375e-6, 2)) AS a FROM unnest(range(64)) t(j))),
spectrum AS (SELECT k, sum(re * cos(w) + im * sin(w)) AS re, sum(im * cos(w) - re * sin(w)) AS im FROM (SELECT k, re, im, 2 * pi() * (j * k % 64) / 64 AS w FROM chirp, unnest(range(64)) t(k)) GROUP BY k) """
FILTER = """, filter AS (SELECT d, sum(b * (re * cos(w) + im * sin(w))) / 64 AS re, sum(b * (re * sin(w) - im * cos(w))) / 64 AS im FROM (SELECT k, d, re, im, 2 * pi() * (k * d % 64) / 64 AS w, CASE WHEN 63 - k BETWEEN 36 AND 60 THEN sin(pi() * (63 - k - 36) / 24) ELSE 0 END AS b FROM spectrum, unnest(range(64)) t(d)) GROUP BY d) """


@query(GRAM + CHIRP + FILTER + ", out AS (SELECT product, trace, n, round(1000 * sum(x * re)) AS re, round(1000 * sum(x * im)) AS im FROM cells, unnest(range(64)) t(n), filter WHERE d = (n - k + 64) % 64 GROUP BY ALL) SELECT product, trace, max(re) AS re_peak, max(im) AS im_peak, 0.0::DOUBLE AS tec FROM out GROUP BY ALL")
def night_range_compression(spark, sf_dir):
    rows = windows.fixed_chunks(radargram(spark, sf_dir), "product", "trace", 512).withColumn("sza", F.lit(120.0)).withColumn("samples", F.transform("samples", lambda x: x * 1000))
    out = kernels.range_compress(rows, "product", "chunk", "trace", "samples", "sza")
    return out.select("product", "trace", (F.array_max("re") + 0.0).alias("re_peak"), (F.array_max("im") + 0.0).alias("im_peak"), "tec")


@query()
def range_compression(spark, sf_dir):
    rows = windows.fixed_chunks(radargram(spark, sf_dir), "product", "trace", 512).withColumn("sza", 80.0 + F.pmod(F.hash("product", "chunk"), F.lit(5)) * 10).withColumn("samples", F.transform("samples", lambda x: x * 1000))
    out = kernels.range_compress(rows, "product", "chunk", "trace", "samples", "sza")
    return out.select("product", "trace", F.array_max("re").alias("re_peak"), F.array_max("im").alias("im_peak"), "tec")


@query(GRAM + ", kernel AS (SELECT o, d, (1 + 2 * sum(cos(2 * pi() * f * (d - o / 7.0::DOUBLE) / 64))) / 64 AS w FROM unnest(range(7)) a(o), unnest(range(64)) b(d), unnest(range(1, 32)) c(f) GROUP BY o, d), out AS (SELECT product, trace, n, sum(x * w) AS re FROM cells, unnest(range(64)) t(n), kernel WHERE d = (n - k + 64) % 64 AND o = trace % 7 GROUP BY ALL) SELECT product, trace, round(sum(re), 6) + 0.0 AS total, round(max(re), 6) + 0.0 AS peak FROM out GROUP BY ALL")
def fractional_shifts(spark, sf_dir):
    rows = radargram(spark, sf_dir).withColumn("offset", F.col("trace") % 7 / 7.0)
    return kernels.shift(rows, ["product", "trace"], "samples", "offset").select("product", "trace", r6(traces.total("re")).alias("total"), r6(F.array_max("re")).alias("peak"))


@query()
def beta5_retracking(spark, sf_dir):
    rows = radargram(spark, sf_dir).withColumn("power", F.transform("samples", lambda x: x * x + 1e-4)).withColumn("first", F.lit(0))
    return kernels.retrack(rows, ["product", "trace"], "power", "first").withColumns({"delta": F.round("delta", 3), "snr": F.round("snr", 3)})


#: Apertures of 1000 m, 200 m apart, over traces 50 m apart; what a trace so many places from the middle is turned by.
APERTURES = """, ends AS (SELECT product, max(trace) AS last FROM gram GROUP BY product),
members AS (SELECT product, posting, trace, trace - greatest(0, least(last, 4 * posting)) AS off FROM gram JOIN ends USING (product), unnest(range(-5, 200)) t(posting) WHERE posting >= ceil((trace * 50.0 - 500) / 200) AND posting <= floor((trace * 50.0 + 500) / 200)),
weighed AS (SELECT *, CASE WHEN m = 1 THEN 1 ELSE 0.5 - 0.5 * cos(2 * pi() * r / nullif(m - 1, 0)) END AS weight FROM (SELECT *, count(*) OVER (PARTITION BY product, posting) AS m, row_number() OVER (PARTITION BY product, posting ORDER BY trace) - 1 AS r FROM members)),
turns AS (SELECT off, d, (sum(cos(a)) * cos(p) + sum(sin(a)) * sin(p)) / 64 AS re, (sum(sin(a)) * cos(p) - sum(cos(a)) * sin(p)) / 64 AS im FROM (SELECT off, d, 4 * pi() * 25e6::DOUBLE / 299792458 * away AS p, 2 * pi() * f * (d + 2 * away / 299792458 / 0.0375e-6::DOUBLE) / 64 AS a FROM (SELECT off, sqrt(9e10::DOUBLE + pow(off / 70.0::DOUBLE * 3400, 2)) - 3e5 AS away FROM unnest(range(-40, 41)) t(off)), unnest(range(64)) u(d), unnest(range(-32, 32)) v(f)) GROUP BY off, d, p) """


@query(GRAM + APERTURES + ", out AS (SELECT product, posting, any_value(m) AS traces, n, sum(weight * x * re) AS re, sum(weight * x * im) AS im FROM weighed JOIN cells USING (product, trace), unnest(range(64)) t(n), turns WHERE turns.off = weighed.off AND d = (n - k + 64) % 64 GROUP BY product, posting, n) SELECT product, posting, any_value(traces) AS traces, round(max(sqrt(re * re + im * im)), 6) + 0.0 AS peak FROM out GROUP BY product, posting")
def delay_doppler_focus(spark, sf_dir):
    rows = radargram(spark, sf_dir).withColumns({"along": F.col("trace") * 50.0, "t": F.col("trace") / 70.0, "r": F.lit(3.0e5), "v": F.lit(3400.0), "delay": F.lit(0.0)})
    return kernels.focus(rows, "product", "trace", "samples", "along", "t", "r", "v", "delay", 200.0, 1000.0).select("product", "posting", "traces", r6(F.array_max("sar")).alias("peak"))


SURFACE = GRAM + """, grid AS (SELECT product, trace, k, k * 10.0::DOUBLE AS x, trace * 10.0::DOUBLE AS y, x AS z FROM cells),
steps AS (SELECT *, coalesce(lead(x) OVER r, x) - coalesce(lag(x) OVER r, x) AS ax, coalesce(lead(z) OVER r, z) - coalesce(lag(z) OVER r, z) AS az, coalesce(lead(y) OVER c, y) - coalesce(lag(y) OVER c, y) AS byy, coalesce(lead(z) OVER c, z) - coalesce(lag(z) OVER c, z) AS bz FROM grid WINDOW r AS (PARTITION BY product, trace ORDER BY k), c AS (PARTITION BY product, k ORDER BY trace)),
facets AS (SELECT product, trace, k, x, y, z, sqrt(ax * ax + az * az) AS la, sqrt(byy * byy + bz * bz) AS lb, -az * byy / n AS nx, -ax * bz / n AS ny, ax * byy / n AS nz FROM (SELECT *, nullif(sqrt(az * byy * az * byy + ax * bz * ax * bz + ax * byy * ax * byy), 0) AS n FROM steps)) """


def surface(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = radargram(spark, sf_dir).select("product", "trace", F.posexplode("samples").alias("k", "z"))
    grid = cells.select("product", "trace", F.col("k").cast("long").alias("k"), (F.col("k") * 10.0).alias("x"), (F.col("trace") * 10.0).alias("y"), "z")
    return clutter.facets(grid, ["product"], "trace", "k", "x", "y", "z")


@query(SURFACE + "SELECT product, trace, k, round(la, 6) + 0.0 AS la, round(lb, 6) + 0.0 AS lb, round(nx, 6) + 0.0 AS nx, round(ny, 6) + 0.0 AS ny, round(nz, 6) + 0.0 AS nz FROM facets")
def facet_geometry(spark, sf_dir):
    return surface(spark, sf_dir).select("product", "trace", "k", *[r6(c).alias(c) for c in ("la", "lb", "nx", "ny", "nz")])


@query(
    SURFACE
    + """, pairs AS (SELECT product, s.trace, la, lb, sqrt(dx * dx + dy * dy + dz * dz) AS r, abs(nx * dx + ny * dy + nz * dz) / sqrt(dx * dx + dy * dy + dz * dz) AS u FROM (SELECT f.product, g.trace, la, lb, nx, ny, nz, 315.0 - f.x AS dx, g.trace * 10.0 - f.y AS dy, 300.0 - f.z AS dz FROM (SELECT DISTINCT product, trace FROM gram) g JOIN facets f USING (product) WHERE nx IS NOT NULL) s WHERE dx * dx + dy * dy <= 14400.0)
SELECT product, trace, floor(2 * r / 299792458.0 * 1e8)::BIGINT AS sample, round(1e6 * sum(pow(coalesce(la * lb * exp(-(1 - u * u) / nullif(u * u, 0) / 0.16) / (sqrt(2) * 0.2 * u * u * r * r), 0), 2)), 4) + 0.0 AS power FROM pairs GROUP BY ALL"""
)
def surface_clutter(spark, sf_dir):
    seen = radargram(spark, sf_dir).select("product", "trace", F.lit(315.0).alias("sx"), (F.col("trace") * 10.0).alias("sy"), F.lit(300.0).alias("sz"))
    out = clutter.echoes(seen, surface(spark, sf_dir), ["product"], "trace", 120.0, 0.2, 1e8)
    return out.select("product", "trace", "sample", (F.round(F.col("power") * 1e6, 4) + 0.0).alias("power"))


@query(
    GRAM
    + """, pairs AS (SELECT product, trace, samples AS a, lead(samples) OVER (PARTITION BY product ORDER BY trace) AS b FROM gram),
diffs AS (SELECT product, trace, lag, k, a[k + 1] - b[((k - lag) % 64 + 64) % 64 + 1] AS d FROM pairs, unnest(range(-3, 4)) AS l(lag), unnest(range(64)) AS o(k) WHERE b IS NOT NULL),
residuals AS (SELECT product, trace, lag, round(mad(d), 6) + 0.0 AS residual FROM diffs GROUP BY ALL)
SELECT product, trace, min(residual) AS residual FROM residuals GROUP BY ALL"""
)
def range_offsets(spark, sf_dir):
    rows = radargram(spark, sf_dir).withColumn("other", F.lead("samples").over(Window.partitionBy("product").orderBy("trace"))).where("other IS NOT NULL")
    return rows.select("product", "trace", r6(traces.best_lag("samples", "other", 3)["residual"]).alias("residual"))


@query(
    "SELECT c_custkey, round(((w * w + 0.09 - 0.01 - 0.04) * x + 2 * (0.03 - w * 0.2) * y + 2 * (0.06 + w * 0.1) * z) / n, 6) + 0.0 AS x, round((2 * (0.03 + w * 0.2) * x + (w * w - 0.09 + 0.01 - 0.04) * y + 2 * (0.02 - w * 0.3) * z) / n, 6) + 0.0 AS y, round((2 * (0.06 - w * 0.1) * x + 2 * (0.02 + w * 0.3) * y + (w * w - 0.09 - 0.01 + 0.04) * z) / n, 6) + 0.0 AS z FROM (SELECT c_custkey, x, y, z, w, sqrt(w * w + 0.14) AS n FROM (SELECT c_custkey, (c_custkey % 7)::DOUBLE AS x, (c_custkey % 11)::DOUBLE AS y, (c_custkey % 13)::DOUBLE AS z, 1 + (c_custkey % 5)::DOUBLE / 10 AS w FROM customer))"
)
def quaternion_rotation(spark, sf_dir):
    part = lambda n: (F.col("c_custkey") % n).cast("double")
    turned = geometry.rotated((1 + part(5) / 10, F.lit(0.3), F.lit(0.1), F.lit(0.2)), part(7), part(11), part(13))
    return table(spark, sf_dir, "customer").select("c_custkey", *[r6(c).alias(n) for n, c in zip("xyz", turned, strict=True)])


def vincenty(rounds: int) -> str:
    """The inverse iteration, a subquery for each round; a and b are the half-axes, f the flattening."""
    state = "l, sqrt(pow(c2 * sin(l), 2) + pow(c1 * s2 - s1 * c2 * cos(l), 2)) AS sn, s1 * s2 + c1 * c2 * cos(l) AS cs"
    sql = f"SELECT *, {state} FROM (SELECT *, span AS l FROM (SELECT *, sin(u1) AS s1, cos(u1) AS c1, sin(u2) AS s2, cos(u2) AS c2, radians(lon - lon0) AS span FROM (SELECT *, atan((1 - f) * tan(radians(lat0))) AS u1, atan((1 - f) * tan(radians(lat))) AS u2 FROM placed)))"
    angles = "SELECT *, atan2(sn, cs) AS sigma, 1 - z * z AS sq, cs - coalesce(2 * s1 * s2 / nullif(1 - z * z, 0), 0) AS mid FROM (SELECT *, coalesce(c1 * c2 * sin(l) / nullif(sn, 0), 0) AS z FROM ({}))"
    for _ in range(rounds):
        turned = f"SELECT user_id, a, b, f, s1, c1, s2, c2, span, span + (1 - c) * f * z * (sigma + c * sn * (mid + c * cs * (2 * mid * mid - 1))) AS l FROM (SELECT *, f / 16 * sq * (4 + f * (4 - 3 * sq)) AS c FROM ({angles.format(sql)}))"
        sql = f"SELECT *, {state.removeprefix('l, ')} FROM ({turned})"
    bent = f"SELECT *, 1 + u / 16384 * (4096 + u * (u * (320 - 175 * u) - 768)) AS big, u / 1024 * (256 + u * (u * (74 - 47 * u) - 128)) AS small FROM (SELECT *, sq * (a * a - b * b) / (b * b) AS u FROM ({angles.format(sql)}))"
    return f"SELECT user_id, b * big * (sigma - small * sn * (mid + small / 4 * (cs * (2 * mid * mid - 1) - small / 6 * mid * (4 * sn * sn - 3) * (4 * mid * mid - 3)))) AS m FROM ({bent})"


@query(TRACK + ", spots AS (SELECT user_id, i, (event_id * 7 % 120 - 60)::DOUBLE AS lat, (event_id * 13 % 90)::DOUBLE AS lon FROM track), placed AS (SELECT *, 1 - b / a AS f FROM (SELECT user_id, lat, lon, lag(lat) OVER w AS lat0, lag(lon) OVER w AS lon0, 3396190.0::DOUBLE AS a, 3376200.0::DOUBLE AS b FROM spots WINDOW w AS (PARTITION BY user_id ORDER BY i)) WHERE lat0 IS NOT NULL) SELECT user_id, round(sum(m) / 1000, 3) AS km FROM (" + vincenty(8) + ") GROUP BY user_id")
def groundtrack_lengths(spark, sf_dir):
    before = Window.partitionBy("user_id").orderBy("i")
    rows = track(spark, sf_dir).withColumns({"lat": F.pmod(F.col("event_id") * 7, F.lit(120)) - 60.0, "lon": F.pmod(F.col("event_id") * 13, F.lit(90)) + 0.0})
    rows = rows.withColumns({"lat0": F.lag("lat", 1).over(before), "lon0": F.lag("lon", 1).over(before)}).where("lat0 IS NOT NULL")
    step = geometry.ellipsoidal_distance("lat0", "lon0", "lat", "lon", 3396190.0, 3376200.0)
    return rows.groupBy("user_id").agg(F.round(F.sum(step) / 1000, 3).alias("km"))


def antennas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each trace and the next as two antennas: first halves of the samples are real parts."""
    rows = radargram(spark, sf_dir).withColumn("next", F.lead("samples").over(Window.partitionBy("product").orderBy("trace"))).where("next IS NOT NULL")
    half = lambda c, i: F.slice(c, i, 32)
    return rows.select("product", "trace", half("samples", 1).alias("ar"), half("samples", 33).alias("ai"), half("next", 1).alias("br"), half("next", 33).alias("bi"))


LOOKS = (
    GRAM
    + """, pairs AS (SELECT product, trace, samples AS a, lead(samples) OVER (PARTITION BY product ORDER BY trace) AS b FROM gram),
z AS (SELECT product, trace, k, a[k + 1] AS ar, a[k + 33] AS ai, b[k + 1] AS br, b[k + 33] AS bi FROM pairs, unnest(range(0, 32)) AS t(k) WHERE b IS NOT NULL),
m AS (SELECT product, trace, k, count(*) OVER w AS n, avg(ar * br + ai * bi) OVER w AS re, avg(ai * br - ar * bi) OVER w AS im, avg(ar * ar + ai * ai) OVER w AS pa, avg(br * br + bi * bi) OVER w AS pb FROM z WINDOW w AS (PARTITION BY product, trace ORDER BY k ROWS BETWEEN CURRENT ROW AND 1 FOLLOWING)),
looks AS (SELECT product, trace // 3 AS look, k, atan2(avg(im), avg(re)) AS phase, avg(sqrt(re * re + im * im) / sqrt(pa * pb)) AS correlation FROM m WHERE n = 2 GROUP BY ALL HAVING count(*) = 3) """
)


def looked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interferometry.looks(antennas(spark, sf_dir), "product", "trace", ("ar", "ai"), ("br", "bi"), 4)


@query(LOOKS + "SELECT product, look, k, round(phase, 5) + 0.0 AS phase, round(correlation, 6) AS correlation FROM looks")
def multilook_interferogram(spark, sf_dir):
    return looked(spark, sf_dir).select("product", "look", F.col("k").cast("long").alias("k"), (F.round("phase", 5) + 0.0).alias("phase"), F.round("correlation", 6).alias("correlation"))


@query(
    LOOKS
    + """, places AS (SELECT DISTINCT product, look FROM looks), posts AS (SELECT product, look, (look * 7 % 31)::DOUBLE AS y FROM places WHERE look % 3 = 1),
spots AS (SELECT c.product, c.look, floor(coalesce(lo.y, hi.y) + coalesce((c.look - lo.look) / nullif(hi.look - lo.look, 0), 0) * (coalesce(hi.y, lo.y) - coalesce(lo.y, hi.y)))::BIGINT AS k FROM places c ASOF LEFT JOIN posts lo ON c.product = lo.product AND c.look >= lo.look ASOF LEFT JOIN posts hi ON c.product = hi.product AND c.look <= hi.look)
SELECT p.product, p.look, p.k, round(p.phase - s.phase, 5) + 0.0 AS phase FROM looks p JOIN spots USING (product, look) JOIN looks s ON s.product = spots.product AND s.look = spots.look AND s.k = spots.k"""
)
def surface_normalised_phase(spark, sf_dir):
    phases = looked(spark, sf_dir).select("product", "look", F.col("k").cast("long").alias("k"), "phase")
    surface = phases.where("look % 3 = 1").select("product", "look", (F.col("look") * 7 % 31).alias("k")).distinct()
    return interferometry.normalised(phases, surface, "product").select("product", "look", "k", (F.round("phase", 5) + 0.0).alias("phase"))


@query("SELECT o_orderkey, round(-2 * pi() * 5 / 2.5 * sin(acos(s / f) - r), 5) + 0.0 AS phase FROM (SELECT o_orderkey, (100 + o_custkey % 50)::DOUBLE AS s, (151 + o_orderkey % 97)::DOUBLE AS f, (o_orderkey % 21 - 10)::DOUBLE / 100 AS r FROM orders)")
def off_nadir_phases(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", (100 + F.col("o_custkey") % 50).alias("s"), (151 + F.col("o_orderkey") % 97).alias("f"), ((F.col("o_orderkey") % 21 - 10) / 100.0).alias("r"))
    return o.select("o_orderkey", (F.round(interferometry.off_nadir_phase("s", "f", "r", 5.0, 2.5), 5) + 0.0).alias("phase"))


@query(GRAM + "SELECT product, trace, (trace % 9 - 4)::DOUBLE AS shift FROM gram")
def planted_shifts(spark, sf_dir):
    """Pulses amid zeros against themselves, rolled by as many samples as the trace's number says."""
    back = (F.col("trace") % 9 - 4).cast("int")
    pulse = F.concat(F.array_repeat(F.lit(0.0), 28), F.slice("samples", 1, 8), F.array_repeat(F.lit(0.0), 28))
    rows = radargram(spark, sf_dir).select("product", "trace", pulse.alias("ar"), F.array_repeat(F.lit(0.0), 64).alias("ai")).withColumns({"br": traces.roll("ar", -back), "bi": F.col("ai")})
    out = interferometry.coregister(rows, "product", "trace", ("ar", "ai"), ("br", "bi"), factor=4, reach=24)
    return out.select("product", "trace", F.round("shift", 3).alias("shift"))


@query()
def coregistered_traces(spark, sf_dir):
    out = interferometry.coregister(antennas(spark, sf_dir), "product", "trace", ("ar", "ai"), ("br", "bi"), factor=4, reach=16, subsample=True, adaptive=True, most=3)
    return out.select("product", "trace", F.round("shift", 3).alias("shift"), F.round("quality", 3).alias("quality"), r6(F.array_max("b_re")).alias("peak"))


RANGED = (
    GRAM
    + """, pairs AS (SELECT product, trace, samples AS a, coalesce(lag(samples) OVER (PARTITION BY product ORDER BY trace), samples) AS b FROM gram),
ends AS (SELECT product, max(trace) AS last, max(list_max(a)) AS ta, max(list_max(b)) AS tb, greatest(max(list_max(a)) - 0.4, min(list_min(a))) AS fa, greatest(max(list_max(b)) - 0.5, min(list_min(b))) AS fb FROM pairs GROUP BY product),
s AS (SELECT product, trace, last, k, (greatest(a[k + 1], fa) - fa) / (ta - fa) AS a, (greatest(b[k + 1], fb) - fb) / (tb - fb) AS b FROM pairs JOIN ends USING (product), unnest(range(0, 64)) AS t(k)),
m AS (SELECT product, trace, last, k, avg(a) OVER w AS a, avg(b) OVER w AS b FROM s WINDOW w AS (PARTITION BY product, k ORDER BY trace ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)),
i AS (SELECT * FROM m WHERE trace >= 3 AND trace <= last - 3),
r AS (SELECT p.product, lag_ AS lag, avg(abs(p.a - q.b)) AS residual FROM i p, unnest(range(-4, 4)) AS l(lag_) JOIN i q ON q.product = p.product AND q.trace = p.trace AND q.k = p.k + greatest(lag_, 0) AND p.k < 64 - abs(lag_) GROUP BY ALL) """
)


@query(RANGED + "SELECT product, lag, round(residual, 6) AS residual FROM r")
def clutter_residuals(spark, sf_dir):
    rows = simulated(spark, sf_dir)
    rows = ranging.scaled(ranging.scaled(rows, "product", "a", 0.4), "product", "b", 0.5)
    a, b = (ranging.smoothed(rows.select("product", "trace", c), "product", "trace", c, 3) for c in "ab")
    return ranging.residuals(a.join(b, ["product", "trace"]), "product", "a", "b", 4).select("product", F.col("lag").cast("long").alias("lag"), F.round("residual", 6).alias("residual"))


def simulated(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = Window.partitionBy("product").orderBy("trace")
    return radargram(spark, sf_dir).select("product", "trace", F.col("samples").alias("a"), F.coalesce(F.lag("samples").over(before), "samples").alias("b"))


@query(
    RANGED.replace("greatest(max(list_max(a)) - 0.4, min(list_min(a))) AS fa", "greatest(max(list_max(a)) - setting, min(list_min(a))) AS fa, setting").replace("FROM pairs GROUP BY product)", "FROM pairs, unnest([0.2, 0.4]::DOUBLE[]) AS u(setting) GROUP BY product, setting)").replace("SELECT product, trace, last, k,", "SELECT product, setting, trace, last, k,").replace("PARTITION BY product, k", "PARTITION BY product, setting, k").replace("SELECT p.product, lag_", "SELECT p.product, p.setting, lag_").replace("ON q.product = p.product", "ON q.product = p.product AND q.setting = p.setting")
    + """, curves AS (SELECT product, setting, list(-residual ORDER BY lag) AS y FROM r GROUP BY product, setting), tops AS (SELECT *, list_position(y, list_max(y)) - 1 AS i FROM curves),
fits AS (SELECT *, CASE WHEN i BETWEEN 2 AND 5 THEN (-6 * y[i - 1] + 24 * y[i] + 34 * y[i + 1] + 24 * y[i + 2] - 6 * y[i + 3]) / 70 END AS e, CASE WHEN i BETWEEN 2 AND 5 THEN (-2 * y[i - 1] - y[i] + y[i + 2] + 2 * y[i + 3]) / 10 END AS g, CASE WHEN i BETWEEN 2 AND 5 THEN y[i - 1] + y[i] + y[i + 1] + y[i + 2] + y[i + 3] END AS t FROM tops),
peaks AS (SELECT *, (t - 5 * e) / 10 AS h FROM fits), places AS (SELECT *, CASE WHEN i BETWEEN 2 AND 5 THEN -g / nullif(2 * h, 0) WHEN i IN (1, 6) THEN (y[i + 2] - y[i]) / nullif(2 * (2 * y[i + 1] - y[i + 2] - y[i]), 0) ELSE 0 END AS p FROM peaks),
heights AS (SELECT product, setting, i - 4 + coalesce(p, 0) AS delta, -CASE WHEN i BETWEEN 2 AND 5 THEN e + g * p + h * p * p WHEN i IN (1, 6) THEN y[i + 1] - 0.25 * (y[i] - y[i + 2]) * p ELSE y[i + 1] END AS residual FROM places)
SELECT product, (x).setting AS setting, round((x).delta, 4) AS delta, round((x).delta * 0.0375e-6::DOUBLE * 299792458 / 2, 4) AS dz, round((x).residual, 4) AS residual FROM (SELECT product, min({'residual': residual, 'setting': setting, 'delta': delta}) AS x FROM heights GROUP BY product)"""
)
def clutter_ranging(spark, sf_dir):
    out = ranging.best_setting(simulated(spark, sf_dir), "product", "trace", "a", "b", [0.2, 0.4], 0.5, 3, 4)
    return out.select("product", "setting", *(F.round(c, 4).alias(c) for c in ("delta", "dz", "residual")))


@query(GRAM + ", g AS (SELECT product, trace AS row_, k AS col_, x AS z FROM cells), p AS (SELECT o_orderkey, o_custkey % 10 AS product, (o_orderkey % 150)::DOUBLE / 4 AS y, (o_custkey % 250)::DOUBLE / 4 AS x FROM orders), q AS (SELECT DISTINCT o_orderkey, p.product, y, x, r, c FROM p, unnest([floor(y), ceil(y)]) AS a(r), unnest([floor(x), ceil(x)]) AS b(c)), w AS (SELECT o_orderkey, z, 1 - CASE WHEN floor(y) = y OR floor(x) = x THEN abs(y - r) + abs(x - c) ELSE sqrt(pow(y - r, 2) + pow(x - c, 2)) / sqrt(2) END AS w FROM q JOIN g ON g.product = q.product AND g.row_ = r AND g.col_ = c) SELECT o_orderkey, round(h, 6) + 0.0 AS height FROM orders LEFT JOIN (SELECT o_orderkey, sum(w * z) / sum(w) AS h FROM w GROUP BY 1) USING (o_orderkey)")
def grid_heights(spark, sf_dir):
    grid = radargram(spark, sf_dir).select(F.col("product").cast("long").alias("product"), F.col("trace").alias("row"), F.posexplode("samples").alias("col", "z"))
    at = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 10).alias("product"), (40.0 - F.col("o_orderkey") % 150 / 4.0).alias("lat"), (F.col("o_custkey") % 250 / 4.0).alias("lon"))
    return terrain.heights(at, grid, "o_orderkey", "lat", "lon", 40.0, 0.0, 1.0, keys=("product",)).select("o_orderkey", r6("height").alias("height"))


@query("SELECT o_orderkey, round(3396190.0::DOUBLE * p / sqrt(pow(3396190.0::DOUBLE * sin(t), 2) + pow(p * cos(t), 2)), 3) AS radius FROM (SELECT o_orderkey, radians((o_orderkey % 181 - 90)::DOUBLE) AS t, CASE WHEN o_orderkey % 181 < 90 THEN 3373190.0 ELSE 3376200.0 END::DOUBLE AS p FROM orders)")
def reference_radii(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", F.round(terrain.reference_radius(F.col("o_orderkey") % 181 - 90, south_pole=3373190.0), 3).alias("radius"))


@query(GRAM + ", d AS (SELECT product, trace, trace * 1.75::DOUBLE AS x, list_sum(samples) AS v FROM gram), n AS (SELECT product, x, v, lead(x) OVER w AS x1, lead(v) OVER w AS v1 FROM d WINDOW w AS (PARTITION BY product ORDER BY trace)) SELECT product, line, round(v + (line - x) / (x1 - x) * (v1 - v), 6) + 0.0 AS total FROM n, unnest(range(ceil(x)::BIGINT, ceil(x1)::BIGINT)) AS t(line) WHERE x1 IS NOT NULL")
def even_spacing(spark, sf_dir):
    rows = radargram(spark, sf_dir).withColumn("x", F.col("trace") * 1.75)
    return windows.resampled(rows, "product", "trace", "x", 1.0, arrays=["samples"]).select("product", "line", r6(traces.total("samples")).alias("total"))


@query(GRAM + ", s AS (SELECT product, trace, avg(x) AS m, stddev_pop(x) AS s FROM cells GROUP BY ALL) SELECT product, trace, round(max((x - m) / s), 6) AS most, round(min((x - m) / s), 6) AS least FROM cells JOIN s USING (product, trace) GROUP BY ALL")
def standardised_traces(spark, sf_dir):
    rows = radargram(spark, sf_dir).withColumn("z", traces.standardised("samples"))
    return rows.select("product", "trace", F.round(F.array_max("z"), 6).alias("most"), F.round(F.array_min("z"), 6).alias("least"))


@query("SELECT doc_id, (v >> 20) & 4095 AS early, CASE WHEN (v >> 7) & 31 > 15 THEN ((v >> 7) & 31) - 32 ELSE (v >> 7) & 31 END AS late FROM (SELECT doc_id, ('0x' || substr(md5(text), 1, 8))::BIGINT AS v FROM documents)")
def bit_string_fields(spark, sf_dir):
    packed = F.unhex(F.md5(F.col("text").cast("binary")))
    return table(spark, sf_dir, "documents").select("doc_id", labels.bits(packed, 0, 12).alias("early"), labels.bits(packed, 20, 5, signed=True).alias("late"))


@query("SELECT doc_id, list_transform(range(0, 16), lambda i: CASE WHEN (v >> (90 - 6 * i)) & 63 > 31 THEN ((v >> (90 - 6 * i)) & 63)::INT - 64 ELSE ((v >> (90 - 6 * i)) & 63)::INT END) AS samples FROM (SELECT doc_id, (('0x' || substr(md5(text), 1, 12))::HUGEINT << 48) + ('0x' || substr(md5(text), 13, 12))::HUGEINT AS v FROM documents)")
def packed_samples(spark, sf_dir):
    packed = F.substring(F.unhex(F.md5(F.col("text").cast("binary"))), 1, 12)
    return table(spark, sf_dir, "documents").select("doc_id", traces.unpack6(packed).alias("samples"))


def aperture_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = F.col("trace") * 50.0
    rows = radargram(spark, sf_dir).select("product", "trace", F.slice("samples", 1, 32).alias("re"), F.slice("samples", 33, 32).alias("im"), place.alias("along"))
    return rows.withColumns({"delay": 1e-3 + F.col("trace") % 5 * 1e-8, "lat": F.col("along") / 59160.0, "lon": F.lit(0.0), "radius": F.lit(3.69e6) + F.col("trace"), "ground": F.lit(3.39e6)})


@query()
def matched_filter_focus(spark, sf_dir):
    out = focusing.matched_filter(aperture_rows(spark, sf_dir), "product", "trace", "re", "im", "along", "delay", 200.0, 1000.0, permittivity=3.1, every=4)
    return out.select("product", "posting", "traces", r6(F.array_max("sar")).alias("peak"))


@query(
    GRAM
    + """, fine AS (SELECT product, line, k, a.re + line % 2 / 2.0::DOUBLE * (b.re - a.re) AS re, a.im + line % 2 / 2.0::DOUBLE * (b.im - a.im) AS im FROM (SELECT product, trace, unnest([2 * trace, 2 * trace + 1]) AS line, k, samples[k + 1] AS re, samples[k + 33] AS im FROM gram, unnest(range(32)) t(k)) a JOIN (SELECT product, trace - 1 AS trace, k, samples[k + 1] AS re, samples[k + 33] AS im FROM gram, unnest(range(32)) t(k)) b USING (product, trace, k)),
wide AS (SELECT product, max(line) AS last FROM fine GROUP BY product),
members AS (SELECT product, posting, j, 8 * posting + j - 20 AS line FROM wide, unnest(range(200)) t(posting), unnest(range(41)) u(j) WHERE 8 * posting - 20 >= 0 AND 8 * posting + 20 <= last),
ways AS (SELECT *, sqrt(r * r + 3.39e6::DOUBLE * 3.39e6 - 2 * r * 3.39e6 * (cos(p) * cos(q) + sin(p) * sin(q))) AS way FROM (SELECT *, 3.69e6::DOUBLE + line / 2.0::DOUBLE AS r, radians(line * 25 / 59160.0::DOUBLE) AS p, radians(posting * 200 / 59160.0::DOUBLE) AS q FROM members)),
bins AS (SELECT product, posting, arg_min(f, (abs(CASE WHEN f <= 20 THEN f ELSE f - 41 END * 175 / 41.0::DOUBLE - shift), f)) AS bin FROM (SELECT product, posting, -2 * 25e6::DOUBLE / 299792458 * (max(way) FILTER (j = 22) - max(way) FILTER (j = 21)) * 175 AS shift FROM ways GROUP BY product, posting), unnest(range(41)) t(f) GROUP BY product, posting),
away AS (SELECT w.product, posting, j, line, way - max(way) FILTER (j = 21) OVER (PARTITION BY w.product, posting) AS away, (41 - bin) % 41 AS bin FROM ways w JOIN bins USING (product, posting)),
turns AS (SELECT product, posting, line, d, any_value(2 * pi() * (j * bin % 41) / 41 + 4 * pi() * 25e6::DOUBLE / 299792458 * away) AS p, any_value(0.5 - 0.5 * cos(2 * pi() * ((bin + 20) % 41) / 40)) AS h, sum(cos(2 * pi() * f * (d + 2 * away / 299792458 / 0.0375e-6::DOUBLE) / 32)) / 32 AS re, sum(sin(2 * pi() * f * (d + 2 * away / 299792458 / 0.0375e-6::DOUBLE) / 32)) / 32 AS im FROM away, unnest(range(32)) t(d), unnest(range(-16, 16)) u(f) GROUP BY product, posting, line, d),
kernel AS (SELECT product, posting, line, d, h * (re * cos(p) + im * sin(p)) / sqrt(41) AS re, h * (im * cos(p) - re * sin(p)) / sqrt(41) AS im FROM turns),
out AS (SELECT product, posting, n, sum(x.re * t.re - x.im * t.im) AS re, sum(x.re * t.im + x.im * t.re) AS im FROM kernel t JOIN fine x USING (product, line), unnest(range(32)) u(n) WHERE t.d = (n - x.k + 32) % 32 GROUP BY product, posting, n)
SELECT product, posting, 41 AS traces, round(max(re), 6) + 0.0 AS re, round(max(im), 6) + 0.0 AS im FROM out GROUP BY product, posting"""
)
def spherical_delay_doppler(spark, sf_dir):
    even = windows.resampled(aperture_rows(spark, sf_dir), "product", "trace", "along", 25.0, ["lat", "lon", "radius", "ground"], ["re", "im"])
    out = focusing.delay_doppler(even, "product", "line", "re", "im", "along", "lat", "lon", "radius", "ground", 200.0, 1000.0)
    return out.select("product", "posting", "traces", r6(F.array_max("re")).alias("re"), r6(F.array_max("im")).alias("im"))


TONES = "(13, 52, 26, 39)"


@query(
    GRAM
    + CHIRP
    + f""", peaks AS (SELECT product, trace, list_position(samples, list_max(samples)) - 1 AS top FROM gram), rolled AS (SELECT product, trace, (k - top + 64) % 64 AS n, x FROM cells JOIN peaks USING (product, trace)),
trend AS (SELECT product, trace, avg(x) AS m, sum(x * (n - 31.5)) / 21840 AS slope FROM rolled GROUP BY ALL), flat AS (SELECT product, trace, n, x - m - slope * (n - 31.5) AS x FROM rolled JOIN trend USING (product, trace)),
f AS (SELECT product, trace, q, sum(x * cos(2 * pi() * (n * q % 64) / 64)) AS re, -sum(x * sin(2 * pi() * (n * q % 64) / 64)) AS im FROM flat, unnest(range(64)) t(q) GROUP BY ALL),
near AS (SELECT product, trace, q, sqrt(pow(lag(re) OVER w, 2) + pow(lag(im) OVER w, 2)) AS ma, sqrt(pow(lead(re) OVER w, 2) + pow(lead(im) OVER w, 2)) AS mb, atan2(lag(im) OVER w, lag(re) OVER w) AS pa, atan2(lead(im) OVER w, lead(re) OVER w) AS pb, re, im FROM f WINDOW w AS (PARTITION BY product, trace ORDER BY q)),
clean AS (SELECT product, trace, q, CASE WHEN q IN {TONES} THEN (ma + mb) / 2 * cos(p) ELSE re END AS re, CASE WHEN q IN {TONES} THEN (ma + mb) / 2 * sin(p) ELSE im END AS im FROM (SELECT *, (CASE WHEN abs(pa - pb) > pi() THEN pa + 2 * pi() ELSE pa END + pb) / 2 AS p FROM near)),
times AS (SELECT product, trace, q, c.re * s.re - c.im * s.im AS re, c.re * s.im + c.im * s.re AS im FROM clean c JOIN spectrum s ON s.k = q),
out AS (SELECT product, trace, n, sum(re * cos(2 * pi() * (n * q % 64) / 64) - im * sin(2 * pi() * (n * q % 64) / 64)) / 64 AS re, sum(im * cos(2 * pi() * (n * q % 64) / 64) + re * sin(2 * pi() * (n * q % 64) / 64)) / 64 AS im FROM times, unnest(range(64)) t(n) GROUP BY ALL)
SELECT product, trace, round(max(re), 6) + 0.0 AS re, round(max(im), 6) + 0.0 AS im FROM out GROUP BY ALL"""
)
def dechirped_traces(spark, sf_dir):
    rows = kernels.dechirp(radargram(spark, sf_dir), ["product", "trace"], "samples", kernels.chirp_spectrum(64))
    return rows.select("product", "trace", r6(F.array_max("re")).alias("re"), r6(F.array_max("im")).alias("im"))

"""Queries on echoes: the surface chain, electron content of two sounders, statistics over circles, stacks and coherence of two antennas. Radargrams are derived as in queries.py."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import geometry, rotation, signal
from .operators import aggregates, altimetry, focusing, interferometry, ionosphere, joins, surface, terrain, windows
from .plans import chains
from .queries import CHIRP, FILTER, GRAM, MARS, TRACK, query, r6, radargram, table, track
from .sources import products

#: Half a radargram's components are real parts; altimetry and auxiliary data follow from the trace's number.
SURFACE = (
    GRAM
    + """, parts AS (SELECT product, trace, k, samples[k + 1] * samples[k + 1] + samples[k + 33] * samples[k + 33] AS p, (trace * 7) % 40 - 3 AS fine FROM gram, unnest(range(32)) AS r(k)),
places AS (SELECT *, CASE WHEN fine < 0 OR fine > 32 THEN 0 ELSE fine END AS at_place FROM parts),
steps AS (SELECT *, p * (lead(p) OVER (PARTITION BY product, trace ORDER BY k) - p) AS s FROM places),
picked AS (SELECT product, trace, arg_max(k, (s, -k)) AS k FROM steps WHERE k >= at_place - 5 AND k < least(31, at_place + 5) GROUP BY product, trace),
echoes AS (SELECT g.product, g.trace, k.k AS surf_y, coalesce(sqrt(p.p), 0) * pow(10, (1.5 + 20 * log10((250 + g.trace % 60) / 250) - (0.0423 * abs(g.trace % 50) + 0.0274 * abs(g.trace % 30 - 15) - 0.0056 * abs(g.trace % 20))) / 20) AS surf_amp, (g.trace % 4 = 0)::INT AS flag, ((g.trace % 9) - 4)::DOUBLE / 5 + CASE WHEN g.trace % 2 = 0 THEN 180 ELSE 0 END AS roll, (g.trace * 13 % 101)::DOUBLE / 10 AS lon, (g.trace * 29 % 101)::DOUBLE / 10 AS lat FROM gram g LEFT JOIN picked k USING (product, trace) LEFT JOIN parts p ON p.product = g.product AND p.trace = g.trace AND p.k = k.k) """
)


def echoes(spark: SparkSession, sf_dir: str) -> DataFrame:
    gram = radargram(spark, sf_dir)
    compressed = gram.select("product", "trace", F.slice("samples", 1, 32).alias("re"), F.slice("samples", 33, 32).alias("im"))
    trace = F.col("trace")
    altimetry = gram.select("product", "trace", (trace * 7 % 40 - 3).cast("double").alias("idx_fine"), (trace % 4 == 0).cast("int").alias("flag"))
    fields = {"EPHEMERIS_TIME": trace * 0.5, "SUB_SC_PLANETOCENTRIC_LATITUDE": trace * 29 % 101 / 10, "SUB_SC_EAST_LONGITUDE": trace * 13 % 101 / 10, "SOLAR_ZENITH_ANGLE": F.lit(100.0), "SOLAR_LONGITUDE": F.lit(10.0), "SPACECRAFT_ALTITUDE": 250 + trace % 60, "SC_ROLL_ANGLE": (trace % 9 - 4) / 5 + F.when(trace % 2 == 0, 180).otherwise(0), "MRO_SAMX_INNER_GIMBAL_ANGLE": trace % 50, "MRO_SAPX_INNER_GIMBAL_ANGLE": trace % 30 - 15, "MRO_HGA_OUTER_GIMBAL_ANGLE": trace % 20}
    auxiliary = gram.select("product", "trace", *(c.cast("double").alias(n) for n, c in fields.items()))
    return surface.surfaces(compressed, altimetry, auxiliary, "product", "trace", width=10, gain=1.5)


@query(SURFACE + "SELECT product, trace, surf_y, round(surf_amp, 6) + 0.0 AS surf_amp, round(20 * log10(surf_amp), 5) + 0.0 AS surf_pow, flag FROM echoes WHERE surf_amp > 0")
def surface_echoes(spark, sf_dir):
    rows = echoes(spark, sf_dir).where("surf_amp > 0")
    return rows.select("product", "trace", F.col("surf_y").cast("long").alias("surf_y"), r6("surf_amp").alias("surf_amp"), (F.round("surf_pow", 5) + 0.0).alias("surf_pow"), "flag")


CIRCLES = ", usable AS (SELECT * FROM echoes WHERE surf_amp > 0 AND flag = 0 AND (roll > -0.5 AND roll < 0.5 OR roll > 179.5 AND roll < 180.5)) SELECT c AS col, r AS row, count(*) AS n, round(avg(surf_amp), 6) + 0.0 AS mean, round(stddev_pop(surf_amp), 6) + 0.0 AS deviation, round(avg(surf_amp * surf_amp), 6) + 0.0 AS power FROM usable, unnest(range({cols})) AS x(c), unnest(range({rows})) AS y(r) WHERE (lon - {west} - c * {step}) ** 2 + (lat - {south} - r * {step}) ** 2 <= {step} * {step} GROUP BY ALL HAVING count(*) >= 3"


@query(SURFACE + CIRCLES.format(cols=11, rows=11, west=0.0, south=0.0, step="1.0::DOUBLE"))
def circle_statistics(spark, sf_dir):
    out = surface.circles(surface.usable(echoes(spark, sf_dir)), "SUB_SC_EAST_LONGITUDE", "SUB_SC_PLANETOCENTRIC_LATITUDE", "surf_amp", 1.0, (0.0, 10.0, 0.0, 10.0), 3)
    return out.select("col", "row", "n", *(r6(c).alias(c) for c in ("mean", "deviation", "power")))


#: Two sounders: parts of events by type and number; groups are days of the month.
TWO = """WITH picks AS (SELECT event_id, event_type, extract(day FROM ts)::INT AS g, CASE WHEN event_id % 7 > 0 THEN event_id % 900 END AS pick, (event_id % 4)::INT AS band, 250 + event_id % 60 AS alt, (event_id % 4000 - 2000)::DOUBLE AS h FROM events),
high AS (SELECT * FROM (SELECT *, (1400 + pick)::DOUBLE * 0.0375e-6::DOUBLE + 1e-3::DOUBLE AS t FROM picks WHERE event_type = (SELECT min(event_type) FROM events) AND event_id % 37 = 1) WHERE pick IS NOT NULL),
low AS (SELECT * FROM (SELECT *, 3000 / 2.8e6::DOUBLE + pick / 1.4e6::DOUBLE AS t, ([4e6, 1.8e6, 3e6, 5e6]::DOUBLE[])[band + 1] AS f FROM picks WHERE event_type = (SELECT max(event_type) FROM events) AND event_id % 37 = 2) WHERE pick IS NOT NULL AND band IN (0, 3)) """


def sounders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    e = table(spark, sf_dir, "events")
    i = F.col("event_id")
    ends = e.agg(F.min("event_type").alias("first"), F.max("event_type").alias("last"))
    picks = e.crossJoin(F.broadcast(ends)).select("event_type", "first", "last", i.alias("id"), F.dayofmonth("ts").alias("g"), F.when(i % 7 > 0, i % 900).alias("pick"), (i % 4).cast("int").alias("band"), (250 + i % 60).alias("altitude"), (i % 4000 - 2000).cast("double").alias("height"))  # one row of two names
    high = picks.where("event_type = first AND id % 37 = 1").withColumn("time", ionosphere.high_time(F.lit(1e-3), 1400 + F.col("pick")))
    low = picks.where("event_type = last AND id % 37 = 2").withColumn("pick", ionosphere.muted("pick", "band", (4.0, 5.0), "1")).withColumn("time", ionosphere.low_time(F.lit(3000), "pick", "1"))
    return high, low


@query(TWO + "SELECT l.g, h.event_id AS high_id, l.event_id AS low_id, round((l.t - h.t - 2 / 299792458.0::DOUBLE * (l.h - h.h + 1000 * (l.alt - h.alt))) / (1 / (f * f) - 1 / 4e14::DOUBLE) * (2 * pi() / 1.69e-6::DOUBLE) / 1e16 - 0.5, 6) + 0.0 AS tec FROM high h JOIN low l USING (g)")
def electron_contents(spark, sf_dir):
    high, low = sounders(spark, sf_dir)
    return ionosphere.electron_content(high, low, "g", "1", known=5e15).select("g", "high_id", "low_id", r6(F.col("tec") / 1e16).alias("tec"))


@query(TWO + "SELECT event_id, round(alt - h / 1000 - 299792458.0::DOUBLE * (t - 1.69e-6::DOUBLE * 3e15 / (2 * pi() * f * f)) / 2000, 6) + 0.0 AS error FROM low")
def altimetry_errors(spark, sf_dir):
    low = sounders(spark, sf_dir)[1].where("time IS NOT NULL")
    error = ionosphere.altimetry_error("altitude", "height", "time", ionosphere.frequency_hz("band", "1"), 0.3)
    return low.select(F.col("id").alias("event_id"), r6(error).alias("error"))


@query(TWO + "SELECT g, least(3, count(*)) AS n FROM high GROUP BY g")
def sampled_picks(spark, sf_dir):
    return ionosphere.sampled(sounders(spark, sf_dir)[0], "g", "pick", 3).groupBy("g").agg(F.count("*").alias("n"))


@query(GRAM + ", pairs AS (SELECT product, trace, k, x + lead(x) OVER (PARTITION BY product, k ORDER BY trace) AS db FROM cells) SELECT product, trace // 5 AS stack, k, round(sum(db) / 5, 6) + 0.0 AS power FROM pairs WHERE db IS NOT NULL AND trace % 5 < 4 GROUP BY ALL HAVING count(*) = 4")
def power_images(spark, sf_dir):
    rows = radargram(spark, sf_dir).withColumn("next", F.lead("samples").over(Window.partitionBy("product").orderBy("trace"))).where("next IS NOT NULL")
    out = interferometry.power_image(rows, "product", "trace", ("samples", "samples"), ("next", "next"), 6)
    return out.select("product", "stack", F.col("k").cast("long").alias("k"), r6("power").alias("power"))


COHERENCE = GRAM + ", z AS (SELECT product, trace, k, samples[k + 1] AS re, samples[k + 33] AS im, count(*) OVER (PARTITION BY product, k) AS n FROM gram, unnest(range(4)) AS r(k)) "


def four_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = F.arrays_zip(F.slice("samples", 1, 4).alias("re"), F.slice("samples", 33, 4).alias("im"))
    return radargram(spark, sf_dir).select("product", "trace", F.posexplode(both).alias("k", "z")).select("product", "trace", "k", "z.re", "z.im")


@query(COHERENCE + "SELECT a.product, a.k, lag, round(sqrt(avg(a.re * b.re + a.im * b.im) ** 2 + avg(a.im * b.re - a.re * b.im) ** 2) / sqrt(avg(a.re * a.re + a.im * a.im) * avg(b.re * b.re + b.im * b.im)), 6) + 0.0 AS coherence FROM z a, unnest(range(5)) AS l(lag), z b WHERE b.product = a.product AND b.k = a.k AND a.trace = (b.trace + lag) % b.n GROUP BY ALL")
def pixel_coherences(spark, sf_dir):
    out = interferometry.pixel_coherence(four_rows(spark, sf_dir), "product", "trace", "re", "im", 4)
    return out.select("product", F.col("k").cast("long").alias("k"), F.col("lag").cast("long").alias("lag"), r6("coherence").alias("coherence"))


@query(COHERENCE + "SELECT product, k, trace // 6 AS block, round(avg(sqrt(re * re + im * im)), 6) + 0.0 AS magnitude, round(max(CASE WHEN trace % 6 = 2 THEN atan2(im, re) END), 6) + 0.0 AS phase FROM z GROUP BY ALL HAVING count(*) = 6")
def incoherent_stacks(spark, sf_dir):
    out = aggregates.incoherent_stack(four_rows(spark, sf_dir), ["product"], "trace", "re", "im", 6)
    return out.select("product", F.col("k").cast("long").alias("k"), "block", r6("magnitude").alias("magnitude"), r6("phase").alias("phase"))


@query(GRAM + ", w AS (SELECT trace AS block, product + 1 AS channel, samples FROM gram), spec(o, a, sa, b, sb) AS (VALUES (1, 1, 0.5, 2, 0.25), (2, 3, 2.0, 0, 0.0), (3, 2, 1.0, 4, -1.0)) SELECT o AS chanout, x.block, round((x.samples[1] * sa + coalesce(y.samples[1], 0) * sb) / 10, 6) + 0.0 AS first, round((x.samples[64] * sa + coalesce(y.samples[64], 0) * sb) / 10, 6) + 0.0 AS last FROM spec JOIN w x ON x.channel = a LEFT JOIN w y ON y.channel = b AND y.block = x.block WHERE b = 0 OR y.block IS NOT NULL")
def paired_channel_stacks(spark, sf_dir):
    stacks = radargram(spark, sf_dir).select(F.col("trace").alias("block"), (F.col("product") + 1).alias("channel"), "samples")
    specs = spark.createDataFrame(signal.channel_specs("[1,1,0.5,2,0.25; 2,3,2,0,0; 3,2,1,4,-1]"), "chanout int, chan0in int, scalef0 double, chan1in int, scalef1 double")
    out = aggregates.paired_stacks(stacks, specs, "block", "samples", 10)
    return out.select("chanout", "block", r6(F.get("samples", F.lit(0))).alias("first"), r6(F.get("samples", F.lit(63))).alias("last"))


@query(GRAM + ", shifts AS (SELECT product, trace, samples[1] AS s FROM gram) SELECT a.product, round(quantile_cont(abs(a.s - b.s), 0.5), 6) + 0.0 AS difference FROM shifts a JOIN shifts b ON b.product = 0 AND b.trace = a.trace WHERE a.product <> 0 GROUP BY a.product")
def shift_differences(spark, sf_dir):
    rows = radargram(spark, sf_dir).select("product", "trace", F.get("samples", F.lit(0)).alias("s"))
    return aggregates.shift_differences(rows, "product", 0, ["trace"], "s").select("product", r6("difference").alias("difference"))


@query(GRAM + ", p AS (SELECT product, trace, 4 * samples[1] AS phase FROM gram WHERE product < 4) SELECT a.product AS first, b.product AS second, a.trace, round(d - 2 * pi() * floor((d + pi()) / (2 * pi())), 6) + 0.0 AS difference FROM (SELECT a.product, a.trace, b.product AS other, b.phase - a.phase AS d FROM p a JOIN p b USING (trace) WHERE a.product < b.product) a JOIN (SELECT DISTINCT product FROM p) b ON b.product = a.other")
def phase_differences(spark, sf_dir):
    rows = radargram(spark, sf_dir).where("product < 4").select("product", "trace", (4 * F.get("samples", F.lit(0))).alias("phase"))
    return interferometry.phase_differences(rows, "product", ["trace"], "phase").select("first", "second", "trace", r6("difference").alias("difference"))


@query(GRAM + "SELECT product, count(DISTINCT trace) AS length, count(*) AS cells, round(sum(x), 6) + 0.0 AS total FROM cells WHERE x > 0.2 GROUP BY product")
def picked_features(spark, sf_dir):
    cells = radargram(spark, sf_dir).select("product", "trace", F.posexplode("samples").alias("k", "x"))
    mask = cells.withColumn("on", (F.col("x") > 0.2).cast("int"))
    inside = interferometry.feature(cells, mask, ["product", "trace", "k"], "on").groupBy("product").agg(F.count("*").alias("cells"), r6(F.sum("x")).alias("total"))
    return interferometry.picked_length(mask, "product", "trace", "on").join(inside, "product")


@query(GRAM + ", n AS (SELECT product, max(trace) AS last FROM gram GROUP BY product) SELECT product, i AS trace, round(g.samples[1], 6) + 0.0 AS first FROM n, unnest(range(last + 1 + 5)) AS r(i) JOIN gram g ON g.product = n.product AND g.trace = greatest(0, least(last, i - 3))".replace("SELECT product, i", "SELECT n.product, i"))
def padded_radargrams(spark, sf_dir):
    out = windows.padded(radargram(spark, sf_dir), "product", "trace", "samples", 3, 2)
    return out.select("product", "trace", r6(F.get("samples", F.lit(0))).alias("first"))


@query(GRAM + ", n AS (SELECT product, max(trace) AS last FROM gram GROUP BY product) SELECT product, trace, round(samples[((trace * 3 - 7) % 64 * -1 + 128) % 64 + 1], 6) + 0.0 AS first FROM gram JOIN n USING (product) WHERE trace >= 2 AND trace <= last - 1 AND trace < 12")
def aligned_traces(spark, sf_dir):
    from .functions import traces

    rows = windows.region(windows.skipped(radargram(spark, sf_dir), "product", "trace", 2, 1), "trace", 0, 100, 12)
    return rows.select("product", "trace", r6(F.get(traces.roll("samples", (F.col("trace") * 3 - 7).cast("int")), F.lit(0))).alias("first"))


PRI = "([1428.0, 1429.0, 1290.0, 2856.0, 2984.0, 2580.0]::DOUBLE[])"


@query(f"WITH o AS (SELECT o_orderkey, o_custkey % 10 AS track, o_orderkey % 5000 AS rx, o_orderkey % 8 AS code, (o_totalprice / 1000)::DOUBLE AS radius FROM orders), t AS (SELECT *, rx * 0.0375e-6::DOUBLE + coalesce({PRI}[code], 0) / 1e6 - 11.98e-6::DOUBLE AS s, radius - min(radius) OVER (PARTITION BY track) AS climb FROM o) SELECT o_orderkey, round((s - 2000 * climb / 299792458.0::DOUBLE) * 1e6, 6) + 0.0 AS opening_us, round(s * 299792458.0::DOUBLE / 2 - climb * 1000, 4) + 0.0 AS metres FROM t")
def window_openings(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 10).alias("track"), (F.col("o_orderkey") % 5000).alias("rx"), (F.col("o_orderkey") % 8).cast("int").alias("code"), (F.col("o_totalprice") / 1000).alias("radius"))
    rows = geometry.change_of_radius(o, "track", "radius", "climb")
    return rows.select("o_orderkey", r6(signal.window_opening("rx", "code", "climb") * 1e6).alias("opening_us"), (F.round(signal.distance_to_window("rx", "code", F.col("climb") * 1000), 4) + 0.0).alias("metres"))


@query("WITH p AS (SELECT o_orderkey, (o_orderkey * 7 % 179 - 89)::DOUBLE AS lat, (o_custkey % 360)::DOUBLE AS lon, 300.0::DOUBLE / 3389.5 AS a FROM orders) SELECT o_orderkey, round(CASE WHEN polar THEN 0 ELSE lon - span END, 6) + 0.0 AS west, round(CASE WHEN polar THEN 360 ELSE lon + span END, 6) + 0.0 AS east, round(greatest(lat - degrees(a), -90), 6) + 0.0 AS south, round(least(lat + degrees(a), 90), 6) + 0.0 AS north FROM (SELECT *, abs(lat) + degrees(a) >= 90 AS polar, CASE WHEN abs(lat) + degrees(a) < 90 THEN degrees(asin(sin(a) / sin(radians(90 - abs(lat))))) END AS span FROM p)")
def boxes_around_points(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("b", geometry.box_around(F.col("o_custkey") % 360, F.col("o_orderkey") * 7 % 179 - 89, 300.0, 3389.5))
    return o.select("o_orderkey", *(r6(f"b.{c}").alias(c) for c in ("west", "east", "south", "north")))


@query("SELECT o_orderkey, round((88 - lat) * 128, 5) + 0.0 AS line, round((lon + 0.5) * 128, 5) + 0.0 AS sample, round(r * cos(radians(lon)) * cos(radians(lat)), 3) + 0.0 AS x, round(r * sin(radians(lon)) * cos(radians(lat)), 3) + 0.0 AS y, round(r * sin(radians(lat)), 3) + 0.0 AS z FROM (SELECT o_orderkey, (o_orderkey % 176 - 88)::DOUBLE AS lat, (o_custkey % 350 + 1)::DOUBLE AS lon, 3396000.0 + o_orderkey % 1000 AS r FROM orders)")
def raster_coordinates(spark, sf_dir):
    grid = {"top": 88.0, "left": -0.5, "per_degree": 128.0}
    o = table(spark, sf_dir, "orders")
    line, sample, height = geometry.to_line_sample(F.col("o_orderkey") % 176 - 88, F.col("o_custkey") % 350 + 1, F.col("o_orderkey") % 1000, **grid)
    rows = o.select("o_orderkey", line.alias("line"), sample.alias("sample"), height.alias("height"))
    x, y, z = geometry.line_sample_to_cartesian("line", "sample", "height", **grid, radius=3396.0)
    rows = rows.withColumns({"x": x, "y": y, "z": z})
    back = geometry.cartesian_to_line_sample("x", "y", "z", **grid, radius=3396.0)
    return rows.select("o_orderkey", (F.round(back[0], 5) + 0.0).alias("line"), (F.round(back[1], 5) + 0.0).alias("sample"), *((F.round(c, 3) + 0.0).alias(c) for c in "xyz"))


@query("SELECT c_custkey, round(abs(w) * s, 6) + 0.0 AS w, round(i * sign(w) * s, 6) + 0.0 AS i, round(j * sign(w) * s, 6) + 0.0 AS j, round(k * sign(w) * s, 6) + 0.0 AS k FROM (SELECT *, 1.5::DOUBLE / sqrt(w * w + i * i + j * j + k * k) AS s FROM (SELECT c_custkey, (c_custkey % 9 - 4.5)::DOUBLE AS w, (c_custkey % 5 - 2.2)::DOUBLE AS i, (c_custkey % 7 - 3.3)::DOUBLE AS j, (c_custkey % 11 - 5.4)::DOUBLE AS k FROM customer))")
def quaternions_of_matrices(spark, sf_dir):
    c = F.col("c_custkey")
    q = table(spark, sf_dir, "customer").select("c_custkey", *((c % n - d).cast("double").alias(x) for x, n, d in (("w", 9, 4.5), ("i", 5, 2.2), ("j", 7, 3.3), ("k", 11, 5.4))))
    w, i, j, k = (F.col(x) for x in "wijk")
    s = F.lit(1.5) / (w * w + i * i + j * j + k * k)  # a rotation, stretched by 1.5
    rows = ((w * w + i * i - j * j - k * k, 2 * (i * j - w * k), 2 * (i * k + w * j)), (2 * (i * j + w * k), w * w - i * i + j * j - k * k, 2 * (j * k - w * i)), (2 * (i * k - w * j), 2 * (j * k + w * i), w * w - i * i - j * j + k * k))
    out = geometry.quaternion(tuple(tuple(s * x for x in row) for row in rows))
    return q.select("c_custkey", *(r6(x).alias(n) for n, x in zip("wijk", out, strict=True)))


@query("SELECT event_id, event_id % 1000000 AS whole, (event_id % 60000)::INT AS frac, event_id * 1000 - 5 AS et, left(event_type || '-2026', 23) AS epoch, round(value, 6) + 0.0 AS longitude, (event_id % 300 - 150)::INT AS orbit, round((event_id % 997 / 8.0)::DOUBLE, 6) AS temperature, (event_id % 200)::INT AS flag FROM events")
def auxiliary_records(spark, sf_dir):
    """Records packed as the archive has them, and read again."""
    i = F.col("event_id")
    fields = {"SCET_BLOCK_WHOLE": i % 1000000, "SCET_BLOCK_FRAC": (i % 60000).cast("int"), "EPHEMERIS_TIME": i * 1000 - 5, "GEOMETRY_EPOCH": F.substring(F.concat("event_type", F.lit("-2026")), 1, 23), "SOLAR_LONGITUDE": F.col("value"), "ORBIT_NUMBER": (i % 300 - 150).cast("int"), "DES_TEMP": (i % 997 / 8).cast("float"), "CORRUPTED_DATA_FLAG2": (i % 200).cast("int")}
    packed = products.encoded(table(spark, sf_dir, "events").select("event_id", *(c.alias(n) for n, c in fields.items())), ["event_id"], "packed", products.AUXILIARY)
    out = products.decoded(packed, ["event_id"], "packed", products.AUXILIARY)
    return out.select("event_id", F.col("SCET_BLOCK_WHOLE").alias("whole"), F.col("SCET_BLOCK_FRAC").alias("frac"), F.col("EPHEMERIS_TIME").alias("et"), F.col("GEOMETRY_EPOCH").alias("epoch"), r6("SOLAR_LONGITUDE").alias("longitude"), F.col("ORBIT_NUMBER").alias("orbit"), F.round(F.col("DES_TEMP").cast("double"), 6).alias("temperature"), F.col("CORRUPTED_DATA_FLAG2").alias("flag"))


DAYS = "(epoch_us(ts) / 1e6 - 946728000) / 86400.0::DOUBLE"


def terms(s: rotation.Series, t: str, wave: str) -> str:
    return " + ".join(f"{a!r}::DOUBLE * {wave}(radians({p!r}::DOUBLE + {r!r}::DOUBLE * {t}))" for a, p, r in zip(s.amplitude, s.phase, s.rate, strict=True))


def euler(m: rotation.Rotation) -> str:
    power = lambda x, t: " + ".join(f"{c!r}::DOUBLE * pow({t}, {i})" for i, c in enumerate(x))
    plus = lambda s, t, wave: f" + {terms(s, t, wave)}" if s.amplitude else ""
    return f"{power(m.ascension, 't / 36525')}{plus(m.ascension_terms, 't / 36525', 'sin')} + 90 AS alpha, 90 - ({power(m.declination, 't / 36525')}{plus(m.declination_terms, 't / 36525', 'cos')}) AS delta, {power(m.meridian, 't')}{plus(m.meridian_terms, 't', 'sin')} AS omega"


KUCHYNKA, IAU = rotation.MODELS["Kuchynka2014"], rotation.MODELS["IAU2000"]


def days(c: str = "ts"):
    return (F.unix_micros(F.col(c).cast("timestamp")) / 1e6 - 946728000) / 86400.0


@query(f"SELECT event_id, round(alpha, 6) + 0.0 AS alpha, round(delta, 6) + 0.0 AS delta, round(omega, 4) + 0.0 AS omega FROM (SELECT event_id, {euler(KUCHYNKA)} FROM (SELECT event_id, {DAYS} AS t FROM events))")
def pole_and_meridian(spark, sf_dir):
    alpha, delta, omega = rotation.angles("t", KUCHYNKA)
    return table(spark, sf_dir, "events").withColumn("t", days()).select("event_id", r6(alpha).alias("alpha"), r6(delta).alias("delta"), (F.round(omega, 4) + 0.0).alias("omega"))


@query(f"SELECT event_id, round(cos(w) * u + sin(w) * cos(d) * v + sin(w) * sin(d) * z, 4) + 0.0 AS x, round(-sin(w) * u + cos(w) * cos(d) * v + cos(w) * sin(d) * z, 4) + 0.0 AS y, round(-sin(d) * v + cos(d) * z, 4) + 0.0 AS z FROM (SELECT *, cos(a) * x + sin(a) * y AS u, -sin(a) * x + cos(a) * y AS v FROM (SELECT event_id, x, y, z, radians(alpha) AS a, radians(delta) AS d, radians(omega) AS w FROM (SELECT *, {euler(IAU)} FROM (SELECT event_id, {DAYS} AS t, (event_id % 97 - 48)::DOUBLE AS x, (event_id % 89 - 44)::DOUBLE AS y, value AS z FROM events))))")
def body_fixed_places(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", days().alias("t"), (F.col("event_id") % 97 - 48).cast("double").alias("x"), (F.col("event_id") % 89 - 44).cast("double").alias("y"), F.col("value").alias("z"))
    out = rotation.to_body("t", "x", "y", "z", IAU)
    return rows.select("event_id", *((F.round(c, 4) + 0.0).alias(n) for n, c in zip("xyz", out, strict=True)))


ROLLS = TRACK + """, spots AS (SELECT user_id, epoch_us(ts) / 1e6 AS s, i * 1.7::DOUBLE AS d FROM track WHERE i % 3 = 1), nav AS (SELECT user_id, epoch_us(ts) / 1e6 AS s, value AS v FROM track WHERE i % 7 = 0),
rolls AS (SELECT p.user_id, d, coalesce(a.v + coalesce((p.s - a.s) / nullif(b.s - a.s, 0), 0) * (b.v - a.v), a.v, b.v) AS v FROM spots p ASOF LEFT JOIN nav a ON p.user_id = a.user_id AND p.s >= a.s ASOF LEFT JOIN nav b ON p.user_id = b.user_id AND p.s <= b.s),
metres AS (SELECT user_id, unnest(range(lo, hi)) AS metre FROM (SELECT user_id, floor(min(d))::BIGINT AS lo, ceil(max(d))::BIGINT AS hi FROM rolls GROUP BY user_id)) """


@query(ROLLS + "SELECT m.user_id, metre, round(radians(coalesce(a.v + coalesce((metre - a.d) / nullif(b.d - a.d, 0), 0) * (b.v - a.v), a.v, b.v) + 0.5), 6) + 0.0 AS roll FROM metres m ASOF LEFT JOIN rolls a ON m.user_id = a.user_id AND metre >= a.d ASOF LEFT JOIN rolls b ON m.user_id = b.user_id AND metre <= b.d")
def roll_at_metres(spark, sf_dir):
    t = track(spark, sf_dir).withColumn("s", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)
    spots = t.where("i % 3 = 1").select("user_id", "s", (F.col("i") * 1.7).alias("d"))
    out = interferometry.roll_along(spots, t.where("i % 7 = 0").select("user_id", "s", "value"), "user_id", "s", "d", "value", 0.5)
    return out.select("user_id", "metre", r6("roll").alias("roll"))


@query(GRAM + ", db AS (SELECT product, trace, k, 20 * log10(abs(x)) AS v FROM cells), fits AS (SELECT b.product, b.trace, lag, abs(corr(a.v, b.v)) AS c FROM db b, unnest(range(-3, 3)) AS l(lag), db a WHERE a.product = b.product AND a.trace = 0 AND a.k = (b.k + lag + 64) % 64 GROUP BY ALL) SELECT product, trace, arg_max(lag, (c, -lag))::BIGINT AS lag FROM fits GROUP BY product, trace")
def chirp_stabilities(spark, sf_dir):
    out = interferometry.chirp_stability(radargram(spark, sf_dir), "product", "trace", "samples", 3)
    return out.select("product", "trace", F.col("lag").cast("long").alias("lag"))


#: 32 complex samples of each trace; the lower sounder's chirp, 12 samples long.
HALVES = GRAM + ", z AS (SELECT product, trace, k, samples[k + 1] AS re, samples[k + 33] AS im FROM gram, unnest(range(32)) AS r(k)) "
LOW_CHIRP = ionosphere.Chirp(4e6, 1.4e6, 12 / 1.4e6, 1e6, early=False)


def halves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return radargram(spark, sf_dir).select("product", "trace", F.slice("samples", 1, 32).alias("re"), F.slice("samples", 33, 32).alias("im"), (F.col("trace") % 5 * 1e-6).alias("delay"))


def ends(out: DataFrame) -> DataFrame:
    """The first sample, the last and the largest parts of each trace."""
    at = lambda c, i: r6(F.get(c, F.lit(i)))
    return out.select("product", "trace", at("re", 0).alias("first_re"), at("im", 31).alias("last_im"), r6(F.array_max("re")).alias("most_re"), r6(F.array_min("im")).alias("least_im"))


ENDS = " SELECT product, trace, round(max(CASE WHEN n = 0 THEN re END), 6) + 0.0 AS first_re, round(max(CASE WHEN n = 31 THEN im END), 6) + 0.0 AS last_im, round(max(re), 6) + 0.0 AS most_re, round(min(im), 6) + 0.0 AS least_im FROM out GROUP BY product, trace"


@query(
    HALVES
    + """, c AS (SELECT k, sum(cos(p - 2 * pi() * k * (11 - t) / 32)) / sqrt(32) AS re, sum(sin(p - 2 * pi() * k * (11 - t) / 32)) / sqrt(32) AS im FROM (SELECT t, 2 * pi() * (3.5e6::DOUBLE * (t / 1.4e6::DOUBLE) + 1e6::DOUBLE / (12 / 1.4e6::DOUBLE) / 2 * pow(t / 1.4e6::DOUBLE, 2)) AS p FROM unnest(range(12)) a(t)), unnest(range(32)) b(k) GROUP BY k),
y AS (SELECT product, trace, k, z.re * c.re + z.im * c.im AS re, z.im * c.re - z.re * c.im AS im FROM z JOIN c USING (k)),
out AS (SELECT product, trace, n, sum(re * cos(2 * pi() * (k * n % 32) / 32) - im * sin(2 * pi() * (k * n % 32) / 32)) / sqrt(32) AS re, sum(im * cos(2 * pi() * (k * n % 32) / 32) + re * sin(2 * pi() * (k * n % 32) / 32)) / sqrt(32) AS im FROM y, unnest(range(32)) a(n) GROUP BY ALL)"""
    + ENDS
)
def spectra_compressed(spark, sf_dir):
    return ends(ionosphere.compressed(halves(spark, sf_dir), ["product", "trace"], "re", "im", LOW_CHIRP))


#: Circular convolution of each trace with a kernel h of a lag d, and of a trace's own number o.
CONVOLVED = ", out AS (SELECT product, trace, n, sum(z.re * h.re - z.im * h.im) AS re, sum(z.re * h.im + z.im * h.re) AS im FROM z, unnest(range(32)) a(n), h WHERE d = (n - k + 32) % 32 AND o = trace % 5 GROUP BY ALL)"


@query(HALVES + ", h AS (SELECT o, d, sum(cos(2 * pi() * (k * d % 32) / 32 - p)) / 32 AS re, sum(sin(2 * pi() * (k * d % 32) / 32 - p)) / 32 AS im FROM (SELECT k, CASE WHEN k >= 20 THEN -1.69e-6::DOUBLE * 2e12 / (4.5e6::DOUBLE - 1e6::DOUBLE / (12 / 1.4e6::DOUBLE) * ((k - 20) / 1.4e6::DOUBLE)) ELSE 0 END AS p FROM unnest(range(32)) a(k)), unnest(range(32)) b(d), unnest(range(5)) c(o) GROUP BY o, d)" + CONVOLVED + ENDS)
def ionosphere_corrections(spark, sf_dir):
    return ends(ionosphere.corrected(halves(spark, sf_dir), ["product", "trace"], "re", "im", LOW_CHIRP, 2e12))


@query(HALVES + ", h AS (SELECT o, d, sum(cos(2 * pi() * f * (d - o * 1e-6::DOUBLE * 1.4e6) / 32)) / 32 AS re, sum(sin(2 * pi() * f * (d - o * 1e-6::DOUBLE * 1.4e6) / 32)) / 32 AS im FROM unnest(range(-16, 16)) a(f), unnest(range(32)) b(d), unnest(range(5)) c(o) GROUP BY o, d)" + CONVOLVED + ENDS)
def aligned_windows(spark, sf_dir):
    return ends(ionosphere.aligned(halves(spark, sf_dir), ["product", "trace"], "re", "im", "delay", 1 / 1.4e6))


@query(f"SELECT event_id, round(value * 0.29, 6) + 0.0 AS tecu, my AS mars_year, round(ls, 6) AS ls FROM (SELECT *, list_reduce(list_transform(range(1, 13), lambda i: CASE WHEN sols >= s[i] AND sols < s[i + 1] THEN 30.0 * (i - 1) + 30.0 * ((sols - s[i]) / (s[i + 1] - s[i])) ELSE 0 END), lambda a, b: a + b) AS ls FROM (SELECT *, (since - (my - 1) * (88775.245 * 668.6)) / 88775.245 AS sols, [0.0, 61.2, 126.6, 193.3, 257.8, 317.5, 371.9, 421.6, 468.5, 514.6, 562.0, 612.9, 668.6]::DOUBLE[] AS s FROM {MARS} WHERE event_id * 7 % 181 - 90 >= -30 AND event_id * 7 % 181 - 90 < 30))")
def contents_by_martian_time(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("lat", F.col("event_id") * 7 % 181 - 90)
    out = ionosphere.by_martian_time(rows, "lat", "value", "ts", -30, 30)
    return out.select("event_id", r6("tecu").alias("tecu"), "mars_year", F.round("solar_longitude", 6).alias("ls"))


@query(
    GRAM
    + """, kept AS (SELECT product, trace, samples[1] AS first, samples[64] AS last FROM gram WHERE trace % 11 NOT IN (4, 5, 6, 7, 8) AND trace % 17 <> 9), edges AS (SELECT *, lead(trace) OVER w AS nxt, lead(first) OVER w AS first1, lead(last) OVER w AS last1 FROM kept WINDOW w AS (PARTITION BY product ORDER BY trace)),
gaps AS (SELECT *, nxt - trace - 1 AS n, unnest(range(1, nxt - trace)) AS d FROM edges WHERE nxt > trace + 1), weighed AS (SELECT *, CASE WHEN n < 3 THEN d / n ELSE 0.5 * cos(pi() / 3 * least(d, 3)) + 0.5 END AS u, CASE WHEN n < 3 THEN (n + 1 - d) / n ELSE 0.5 * cos(pi() / 3 * least(n + 1 - d, 3)) + 0.5 END AS v FROM gaps)
SELECT product, trace, round(first, 6) + 0.0 AS first, round(last, 6) + 0.0 AS last, false AS filled FROM kept UNION ALL SELECT product, trace + d, round(first * u + first1 * v, 6) + 0.0, round(last * u + last1 * v, 6) + 0.0, true FROM weighed"""
)
def gaps_filled(spark, sf_dir):
    kept = radargram(spark, sf_dir).where("trace % 11 NOT IN (4, 5, 6, 7, 8) AND trace % 17 <> 9")
    out = windows.gap_filled(kept, "product", "trace", "samples", 3)
    return out.select("product", "trace", r6(F.get("samples", F.lit(0))).alias("first"), r6(F.get("samples", F.lit(63))).alias("last"), "filled")


@query(GRAM + ", echoes AS (SELECT product, trace, unnest([0.05, 0.15]::DOUBLE[]) AS echo FROM gram), gaps AS (SELECT c.product, c.trace, echo, k, abs(x - echo) AS gap FROM cells c JOIN echoes e ON e.product = c.product AND e.trace = c.trace) SELECT product, trace, echo, k FROM gaps QUALIFY rank() OVER (PARTITION BY product, trace, echo ORDER BY gap) = 1")
def nearest_echo_cells(spark, sf_dir):
    gram = radargram(spark, sf_dir)
    cells = gram.select("product", "trace", F.posexplode("samples").alias("k", "x"))
    echoes_ = gram.select("product", "trace", F.explode(F.array(F.lit(0.05), F.lit(0.15))).alias("echo"))
    return terrain.echo_cells(cells, echoes_, ["product", "trace"], "x", "echo").select("product", "trace", "echo", F.col("k").cast("long").alias("k"))


@query("SELECT o_orderkey, trunc(20000 * log10(o_totalprice))::INT AS magnitude, trunc(x * 16777216)::INT AS phase, round(trunc(20000 * log10(o_totalprice)) / 10000, 6) + 0.0 AS db, round(trunc(x * 16777216) / 65536, 6) + 0.0 AS radians FROM (SELECT o_orderkey, o_totalprice, (o_custkey % 629 - 314)::DOUBLE / 100 AS x FROM orders)")
def line_integers(spark, sf_dir):
    magnitude, phase = signal.written_integers("o_totalprice", (F.col("o_custkey") % 629 - 314) / 100, 20000.0)
    rows = table(spark, sf_dir, "orders").select("o_orderkey", magnitude.alias("magnitude"), phase.alias("phase"))
    db, radians = signal.read_integers("magnitude", "phase")
    return rows.withColumns({"db": r6(db), "radians": r6(radians)})


@query(
    GRAM
    + """, geo AS (SELECT product, trace, 3696 + trace % 7 / 100.0::DOUBLE AS sc, 1100 + trace * 3 % 50 AS rx, trace % 8 AS code, trace % 10 / 10.0::DOUBLE AS tecu, trace % 10 = 3 AS corrupted FROM gram),
phases AS (SELECT *, rx - floor(2000 * sc / 299792458 / 0.0375e-6::DOUBLE)::BIGINT AS phase FROM geo), lags AS (SELECT *, min(phase) OVER (PARTITION BY product) AS tx0, max(trace) OVER (PARTITION BY product) AS last FROM phases),
rolled AS (SELECT product, trace, (k + phase - tx0) % 64 AS k, abs(x) AS x FROM cells JOIN lags USING (product, trace)),
means AS (SELECT l.product, l.trace, (phase - tx0) % 64 AS shift, k, avg(x) AS x FROM lags l, unnest(range(-1, 2)) t(o), rolled r WHERE r.product = l.product AND r.trace = greatest(0, least(last, l.trace + o)) GROUP BY ALL),
d AS (SELECT product, trace, shift, k, abs(x - lag(x) OVER (PARTITION BY product, trace ORDER BY k)) AS d FROM means), n AS (SELECT product, trace, stddev_pop(d) FILTER (k > 31) * 2 AS noise FROM d GROUP BY ALL),
h AS (SELECT d.product, d.trace, l, min(k - 1) AS k FROM d JOIN n USING (product, trace), unnest(range(1, 11)) AS t(l) WHERE d.d > noise * (l / 10.0) AND k - 1 >= shift + 2 AND k - 1 < shift + 42 GROUP BY ALL),
picks AS (SELECT product, trace, arg_max(k, l) AS k FROM h GROUP BY ALL)
SELECT product, trace, round(CASE WHEN corrupted THEN -1 ELSE sc - ((rx + c - phase + tx0) * 0.0375e-6::DOUBLE + coalesce("""
    + PRI
    + """[code], 1428) / 1e6 - 11.98e-6 - 1.69e-6 * tecu * 1e16 / 20e6 / (2 * pi() * 20e6)) * 299792458 / 2000 END, 5) + 0.0 AS spot_radius, CASE WHEN corrupted THEN -1 ELSE c - (phase - tx0) % 64 END::DOUBLE AS idx_coarse FROM (SELECT *, coalesce(k, 0) AS c FROM lags LEFT JOIN picks USING (product, trace))"""
)
def altimetry_spots(spark, sf_dir):
    gram, trace = radargram(spark, sf_dir), F.col("trace")
    geometry_ = gram.select("product", "trace", trace.cast("double").alias("et"), F.lit(0.0).alias("latitude"), F.lit(0.0).alias("longitude"), (3696 + trace % 7 / 100).alias("radius_km"), (1100 + trace * 3 % 50).alias("window"), (trace % 8).cast("int").alias("pri_code"), (trace % 10 / 10).alias("tecu"), (trace % 10 == 3).alias("corrupted"))
    rows = gram.withColumn("im", F.array_repeat(F.lit(0.0), 64))
    out = altimetry.spots(rows, geometry_, "product", "trace", "samples", "im", 3, smooth=None, noise_scale=2.0, fine=False, skip=2, reach=40, tail=32)
    return out.select("product", "trace", (F.round("spot_radius", 5) + 0.0).alias("spot_radius"), "idx_coarse")


@query(TRACK + ", pairs AS (SELECT o_orderkey, o_custkey % 50 + 1 AS user_id1, o_orderkey % 40 AS i1, o_custkey % 37 + 1 AS user_id2, o_orderkey % 30 AS i2 FROM orders) SELECT o_orderkey, round(a.value, 6) + 0.0 AS value1, round(b.value, 6) + 0.0 AS value2 FROM pairs JOIN track a ON a.user_id = user_id1 AND a.i = i1 JOIN track b ON b.user_id = user_id2 AND b.i = i2 WHERE a.value > 30 AND b.value > 30")
def dark_crossings(spark, sf_dir):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    pairs = table(spark, sf_dir, "orders").select("o_orderkey", (c % 50 + 1).alias("user_id1"), (k % 40).alias("i1"), (c % 37 + 1).alias("user_id2"), (k % 30).alias("i2"))
    return joins.crossings(pairs, track(spark, sf_dir), "user_id", "i", "value", 30.0).select("o_orderkey", r6("value1").alias("value1"), r6("value2").alias("value2"))


@query(
    TRACK
    + """, held AS (SELECT user_id, event_id, i, floor(value / 20) AS v FROM track), marked AS (SELECT *, coalesce((v <> lag(v) OVER (PARTITION BY user_id ORDER BY i))::INT, 0) AS new FROM held), runs AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS island FROM marked),
posts AS (SELECT user_id, island, (min(i) + max(i)) / 2.0::DOUBLE AS t, arg_min(v, i)::DOUBLE AS v FROM runs GROUP BY user_id, island), sloped AS (SELECT *, (v - lag(v) OVER w) / (t - lag(t) OVER w) AS behind, (lead(v) OVER w - v) / (lead(t) OVER w - t) AS ahead FROM posts WINDOW w AS (PARTITION BY user_id ORDER BY t))
SELECT h.user_id, event_id, round(coalesce(a.v + coalesce((h.i - a.t) / nullif(b.t - a.t, 0), 0) * (b.v - a.v), b.v + coalesce(b.ahead, 0) * (h.i - b.t), a.v + coalesce(a.behind, 0) * (h.i - a.t)), 6) + 0.0 AS smooth FROM (SELECT *, i::DOUBLE AS x FROM held) h ASOF LEFT JOIN sloped a ON h.user_id = a.user_id AND h.x >= a.t ASOF LEFT JOIN sloped b ON h.user_id = b.user_id AND h.x <= b.t"""
)
def smoothed_holds(spark, sf_dir):
    held = track(spark, sf_dir).withColumn("held", F.floor(F.col("value") / 20))
    return joins.smoothed_hold(held, "user_id", "i", "held", "smooth").select("user_id", "event_id", r6("smooth").alias("smooth"))


@query(GRAM + ", places AS (SELECT product, trace, trace * 47.0::DOUBLE + trace % 3 AS d, max(trace * 47.0::DOUBLE + trace % 3) OVER (PARTITION BY product) AS last FROM gram), inner_ AS (SELECT *, min(trace) OVER (PARTITION BY product) AS lo, max(trace) OVER (PARTITION BY product) AS hi FROM places WHERE d >= 250 AND d - last <= -250), middles AS (SELECT product, trace AS middle, d FROM inner_ WHERE trace < hi AND (trace - lo) % 3 = 0) SELECT product, middle, (SELECT arg_min(p.trace, (abs(p.d - (m.d - 250)), p.trace)) FROM places p WHERE p.product = m.product) AS first, (SELECT arg_min(p.trace, (abs(p.d - (m.d + 250)), p.trace)) FROM places p WHERE p.product = m.product) AS last FROM middles m")
def aperture_bounds(spark, sf_dir):
    rows = radargram(spark, sf_dir).withColumn("d", F.col("trace") * 47.0 + F.col("trace") % 3)
    return focusing.apertures(rows, "product", "trace", "d", 3, 500.0)


@query("SELECT o_orderkey, greatest(0, least(360, ceil((45 - lat) / 0.25 - 0.5)))::INT AS row, greatest(0, least(1440, ceil(lon / 0.25 - 0.5)))::INT AS col FROM (SELECT o_orderkey, (o_orderkey % 9700 - 4850)::DOUBLE / 100 AS lat, (o_custkey * 37 % 36100)::DOUBLE / 100 AS lon FROM orders)")
def nearest_grid_cells(spark, sf_dir):
    row, column = terrain.nearest_cell((F.col("o_orderkey") % 9700 - 4850) / 100, F.col("o_custkey") * 37 % 36100 / 100, (-45, 45, 0, 360), 361, 1441)
    return table(spark, sf_dir, "orders").select("o_orderkey", row.alias("row"), column.alias("col"))


@query(GRAM + ", long AS (SELECT product, trace, samples, list_position(samples, list_max(samples)) - 1 AS pick FROM gram), short AS (SELECT product, trace, list_transform(samples, lambda x, i: x * (1 + i / 64.0)) AS samples FROM gram WHERE trace % 3 = 0), picked AS (SELECT *, list_position(samples, list_max(samples)) - 1 AS pick FROM short) SELECT s.product, s.trace, CASE WHEN abs(s.pick - l.pick) <= 5 THEN round(s.samples[s.pick + 1] / l.samples[s.pick + 1], 6) END AS specularity FROM picked s JOIN long l USING (product, trace)")
def specularities(spark, sf_dir):
    from .functions import traces

    long = radargram(spark, sf_dir).withColumn("pick", traces.argmax("samples"))
    short = radargram(spark, sf_dir).where("trace % 3 = 0").withColumn("samples", F.transform("samples", lambda x, i: x * (1 + (i + 1) / 64.0))).withColumn("pick", traces.argmax("samples"))
    return surface.specularity(short, long, "product", "trace", "samples", "pick").select("product", "trace", F.round("specularity", 6).alias("specularity"))


@query(GRAM + CHIRP + FILTER + ", scales AS (SELECT product, pow(2, ceil(log2(p))) / p AS scale FROM (SELECT DISTINCT product, ([1, 2, 3, 4, 8, 16, 32, 64]::DOUBLE[])[product % 8 + 1] AS p FROM gram)), out AS (SELECT product, trace, n, round(sum(x * re) * 1000 * any_value(scale)) AS re, round(sum(x * im) * 1000 * any_value(scale)) AS im FROM cells JOIN scales USING (product), unnest(range(64)) t(n), filter WHERE d = (n - k + 64) % 64 GROUP BY product, trace, n) SELECT product, trace, least(trace // 5, any_value(last) // 5 - (any_value(last) % 5 <= 2 AND any_value(last) >= 5)::INT) AS chunk, max(re) AS re_peak, min(im) AS im_least FROM out JOIN (SELECT product, max(trace) AS last FROM gram GROUP BY product) USING (product) GROUP BY product, trace")
def telemetry_compressed(spark, sf_dir):
    """Traces 7 km apart, so that five make a chunk of more than 30 km; a short last chunk would join the one before."""
    trace = F.col("trace")
    rows = radargram(spark, sf_dir).select("product", "trace", F.transform("samples", lambda x: x * 1000).alias("samples"), F.lit(120.0).alias("sza"), F.when(trace == 0, 0).otherwise(1).alias("kind"), F.when(trace == 0, F.col("product") % 8).otherwise(7).alias("code"), (trace * 7.0).alias("km"))
    out = chains.compressed(rows, "product", "trace", "samples", "sza", "kind", "code", "km")
    return out.select("product", "trace", F.col("chunk").cast("long").alias("chunk"), (F.array_max("re") + 0.0).alias("re_peak"), (F.array_min("im") + 0.0).alias("im_least"))


KONOPLIV = rotation.MODELS["Konopliv2016"]


@query(f"SELECT event_id, round(alpha, 6) + 0.0 AS alpha, round(delta, 6) + 0.0 AS delta, round(omega, 4) + 0.0 AS omega FROM (SELECT event_id, {euler(KONOPLIV)} FROM (SELECT event_id, {DAYS} AS t FROM events))")
def pole_and_meridian_2016(spark, sf_dir):
    alpha, delta, omega = rotation.angles("t", KONOPLIV)
    return table(spark, sf_dir, "events").withColumn("t", days()).select("event_id", r6(alpha).alias("alpha"), r6(delta).alias("delta"), (F.round(omega, 4) + 0.0).alias("omega"))

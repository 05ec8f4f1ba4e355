"""Queries of resampled lines, derivatives of rotations, bounded searches and statistics of phases, and the SQL that gives the same rows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from . import queries_echoes
from .functions import rotation, traces
from .operators import across, focusing, interferometry, optimisation, phases, resampling
from .plans import interferometer
from .queries import GRAM, query, r6, radargram, table
from .queries_echoes import COHERENCE

# Places that advance unevenly, in two segments of a product with a gap between them.
LINES = (
    GRAM
    + """, placed AS (SELECT product, trace, samples, trace // 25 AS seg, trace * 2.0::DOUBLE + (trace % 3) * 0.4 + (trace // 25) * 17 AS x FROM gram),
trends AS (SELECT product, trace, seg, x, k, v, regr_slope(v, k) OVER w AS slope, regr_intercept(v, k) OVER w AS start FROM (SELECT product, trace, seg, x, generate_subscripts(samples, 1) - 1 AS k, unnest(samples) AS v FROM placed) WINDOW w AS (PARTITION BY product, trace)),
response AS (SELECT f, CASE WHEN least(f, 64 - f) BETWEEN 3 AND 22 THEN sin(pi() * (least(f, 64 - f) - 3) / 19.0) ELSE 0 END AS r FROM range(64) AS t(f)),
pulse AS (SELECT m, sum(r * cos(2 * pi() * f * m / 64)) / 64 AS h FROM response, range(64) AS t(m) GROUP BY m),
flat AS (SELECT product, trace, seg, x, k, v - start - slope * k AS v FROM trends),
ranged AS (SELECT product, seg, trace, any_value(x) AS x, k + m AS lag, k, m, sum(v * h) AS part FROM flat, pulse GROUP BY product, seg, trace, k, m),
passed AS (SELECT product, seg, trace, any_value(x) AS x, (k + m) % 64 AS k, sum(part) AS v FROM ranged GROUP BY product, seg, trace, (k + m) % 64),
raw AS (SELECT m, CASE WHEN m = 0 THEN 0.3 ELSE (sin(0.2 * pi() * m) + sin(0.4 * pi() * m)) / (2 * pi() * m) / (1 - (0.2 * m) ** 2) END AS c FROM range(-4, 5) AS t(m)),
taps AS (SELECT m, CASE WHEN abs(m) = 5 THEN 0 ELSE c END / sum(c) OVER () AS c FROM raw),
ends AS (SELECT product, seg, min(trace) AS lo, max(trace) AS hi, arg_min(x, trace) AS x0, arg_max(x, trace) AS x1 FROM placed GROUP BY product, seg),
smooth AS (SELECT e.product, e.seg, t.trace, p.k, sum(p.v * c) AS v FROM ends e, unnest(range(e.lo, e.hi + 1)) AS t(trace), taps JOIN passed p ON p.product = e.product AND p.seg = e.seg AND p.trace = greatest(e.lo, least(e.hi, t.trace + m)) GROUP BY e.product, e.seg, t.trace, p.k),
lines AS (SELECT e.product, e.seg, lo, hi, line, line * 3.0 AS place FROM ends e, unnest(range(floor(x0 / 3 + 0.99999)::BIGINT, floor(x1 / 3)::BIGINT + 1)) AS t(line)),
nearest AS (SELECT l.product, l.seg, line, place, greatest(lo + 1, least(hi - 1, arg_min(trace, (abs(x - place), trace)))) AS mid FROM lines l JOIN placed p ON p.product = l.product AND p.seg = l.seg GROUP BY l.product, l.seg, line, place, lo, hi HAVING hi - lo >= 2),
parabola AS (SELECT n.product, n.seg, line, a.k, a.v * (place - q.x) * (place - r.x) / ((p.x - q.x) * (p.x - r.x)) + b.v * (place - p.x) * (place - r.x) / ((q.x - p.x) * (q.x - r.x)) + c.v * (place - p.x) * (place - q.x) / ((r.x - p.x) * (r.x - q.x)) AS v
 FROM nearest n JOIN placed p ON p.product = n.product AND p.trace = mid - 1 JOIN placed q ON q.product = n.product AND q.trace = mid JOIN placed r ON r.product = n.product AND r.trace = mid + 1
 JOIN smooth a ON a.product = n.product AND a.trace = mid - 1 JOIN smooth b ON b.product = n.product AND b.trace = mid AND b.k = a.k JOIN smooth c ON c.product = n.product AND c.trace = mid + 1 AND c.k = a.k)
"""
)


def _placed(spark, sf_dir):
    x = F.col("trace") * 2.0 + (F.col("trace") % 3) * 0.4 + F.floor(F.col("trace") / 25) * 17
    return radargram(spark, sf_dir).withColumns({"seg": F.floor(F.col("trace") / 25), "x": x})


@query(LINES + "SELECT product, line, count(*) AS samples, round(sum(v * v), 6) + 0.0 AS energy, round(max(v), 6) + 0.0 AS peak FROM parabola GROUP BY product, line")
def doppler_filtered_lines(spark, sf_dir):
    rows = _placed(spark, sf_dir)
    longer = rows.groupBy("product", "seg").count().where("count > 2").drop("count")
    out = resampling.filtered_lines(rows.join(longer, ["product", "seg"], "left_semi"), "product", "seg", "trace", "x", "samples", 3.0, half=4, full=0.1, none=0.2, low=3 / 64, high=22 / 64)
    energy = F.aggregate("samples", F.lit(0.0), lambda a, v: a + v * v)
    return out.where("NOT filled").select("product", "line", F.size("samples").cast("long").alias("samples"), r6(energy).alias("energy"), r6(F.array_max("samples")).alias("peak"))


@query(GRAM.replace(", cells AS", ", placed AS (SELECT product, trace // 25 AS seg, trace, trace * 2.0::DOUBLE + (trace % 3) * 0.4 + (trace // 25) * 17 AS x FROM gram), cells AS") + "SELECT product, max(b) - min(a) + 1 AS lines FROM (SELECT product, floor(arg_min(x, trace) / 3 + 0.99999)::BIGINT AS a, floor(arg_max(x, trace) / 3)::BIGINT AS b FROM placed GROUP BY product, seg) WHERE b >= a GROUP BY product")
def doppler_filtered_line_counts(spark, sf_dir):
    return resampling.line_counts(_placed(spark, sf_dir), "product", "seg", "trace", "x", 3.0)


# Partial derivatives of turned places with the IAU model: a turned vector's derivative by its last angle is the vector turned on by a right angle.
PARTIALS = """WITH rows_ AS (SELECT event_id, event_id % 4000 AS t, (event_id % 97 - 48)::DOUBLE AS x, (event_id % 89 - 44)::DOUBLE AS y, value AS z FROM events),
angles AS (SELECT *, radians(317.68143 - 0.1061 * t / 36525 + 90) AS a, radians(90 - 52.88650 + 0.0609 * t / 36525) AS d, radians(176.630 + 350.89198226 * t) AS w FROM rows_),
node AS (SELECT *, cos(a) * x + sin(a) * y AS u, cos(a) * y - sin(a) * x AS v FROM angles),
tilt AS (SELECT *, cos(d) * v + sin(d) * z AS p, cos(d) * z - sin(d) * v AS q, cos(d) * -u AS ap, -sin(d) * -u AS aq FROM node)
SELECT event_id, """ + ", ".join(
    f"round({factor} * ({part}), 4) + 0.0 AS d{axis}_d{name}"
    for name, factor, parts in (
        ("ascension0", "pi() / 180", ("cos(w) * v + sin(w) * ap", "cos(w) * ap - sin(w) * v", "aq")),
        ("declination1", "-pi() / 180 * t / 36525", ("sin(w) * q", "cos(w) * q", "-p")),
        ("meridian1", "pi() / 180 * t / 1000", ("cos(w) * p - sin(w) * u", "-sin(w) * p - cos(w) * u", "0")),
    )
    for axis, part in zip("xyz", parts, strict=True)
) + " FROM tilt"


@query(PARTIALS)
def rotation_partials(spark, sf_dir):
    e = F.col("event_id")
    rows = table(spark, sf_dir, "events").select("event_id", (e % 4000).alias("t"), (e % 97 - 48).cast("double").alias("x"), (e % 89 - 44).cast("double").alias("y"), F.col("value").alias("z"))
    out = rotation.body_partials("t", "x", "y", "z", rotation.MODELS["IAU2000"], ["ascension0", "declination1", "meridian1"])
    return rows.select("event_id", *((F.round(c / (1000 if n.endswith("meridian1") else 1), 4) + 0.0).alias(n) for n, c in out.items()))


@query(
    """WITH q AS (SELECT c_custkey, 1 + (c_custkey % 5)::DOUBLE / 10 AS w, (c_custkey % 7)::DOUBLE + 0.5 AS x, (c_custkey % 11)::DOUBLE - 1 AS y, (c_custkey % 13)::DOUBLE + 2 AS z FROM customer),
m AS (SELECT *, sqrt(w * w + 0.14) AS n, (w * w + 0.04) * x + 2 * (0.03 - w * 0.2) * y + 2 * (0.06 + w * 0.1) * z AS mx, 2 * (0.03 + w * 0.2) * x + (w * w - 0.12) * y + 2 * (0.02 - w * 0.3) * z AS my, 2 * (0.06 - w * 0.1) * x + 2 * (0.02 + w * 0.3) * y + (w * w - 0.06) * z AS mz FROM q)
SELECT c_custkey, round((2 * w * x - 0.4 * y + 0.2 * z) / n - mx * w / n ** 3, 6) + 0.0 AS dx_dq0, round((0.4 * x + 2 * w * y - 0.6 * z) / n - my * w / n ** 3, 6) + 0.0 AS dy_dq0, round((0.6 * y - 0.2 * x + 2 * w * z) / n - mz * w / n ** 3, 6) + 0.0 AS dz_dq0,
round((w * w + 0.04) / n, 6) AS dx_doffset_x, round(2 * (0.03 + w * 0.2) / n, 6) AS dy_doffset_x, round(2 * (0.06 - w * 0.1) / n, 6) + 0.0 AS dz_doffset_x FROM m"""
)
def helmert_partials(spark, sf_dir):
    part = lambda n: (F.col("c_custkey") % n).cast("double")
    out = rotation.helmert_partials((1 + part(5) / 10, F.lit(0.3), F.lit(0.1), F.lit(0.2)), (0.5, -1.0, 2.0), part(7), part(11), part(13), ["q0", "offset_x"])
    return table(spark, sf_dir, "customer").select("c_custkey", *(r6(c).alias(n) for n, c in out.items()))


# Spectra whose bins an ionosphere of a known content has turned: it is found, and the pulse is as high as it can be.
@query(GRAM + "SELECT product, trace, ((any_value(vec_id) % 97) * 0.5 + 0.25)::DOUBLE AS dispersion, round(sum(abs(x)), 4) AS peak FROM cells JOIN gram USING (product, trace) GROUP BY product, trace")
def planted_dispersions(spark, sf_dir):
    planted = (F.col("vec_id") % 97) * 0.5 + 0.25
    bins = [6.0 * (1 + k / 64) ** -1.93 for k in range(64)]
    turn = lambda wave, sign: F.zip_with("samples", F.array(*map(F.lit, bins)), lambda x, p: sign * F.abs(x) * wave(planted * p))
    rows = radargram(spark, sf_dir).withColumns({"chunk": F.floor(F.col("trace") / 64), "re": turn(F.cos, 1), "im": turn(F.sin, -1)})
    out = optimisation.undispersed(rows, "product", "chunk", "trace", "re", "im", bins, 0.0, 50.0)
    return out.select("product", "trace", (F.round("dispersion", 4) + 0.0).alias("dispersion"), F.round("peak", 4).alias("peak"))


# Rows of pixels, summed over four traces, so that neighbours are alike.
ALIKE = (
    COHERENCE
    + """, sums AS (SELECT product, k, trace, n, sum(re) OVER w AS re, sum(im) OVER w AS im FROM z WINDOW w AS (PARTITION BY product, k ORDER BY trace ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)),
rolled AS (SELECT a.product, a.k, lag, any_value(a.n) AS n, sqrt(avg(a.re * b.re + a.im * b.im) ** 2 + avg(a.im * b.re - a.re * b.im) ** 2) / sqrt(avg(a.re * a.re + a.im * a.im) * avg(b.re * b.re + b.im * b.im)) AS c FROM sums a, unnest(range(7)) AS l(lag), sums b WHERE b.product = a.product AND b.k = a.k AND a.trace = (b.trace + lag) % b.n GROUP BY a.product, a.k, lag),
steps AS (SELECT *, lag(c) OVER (PARTITION BY product, k ORDER BY lag) AS c0 FROM rolled),
falls AS (SELECT product, k, any_value(n) AS n, min(CASE WHEN c < 0.4 AND c0 >= 0.4 THEN greatest(lag - 1 + (c0 - 0.4) / (c0 - c), 1) END) AS spacing FROM steps GROUP BY product, k) """
)


@query(ALIKE + "SELECT product, k, n, round(spacing, 5) + 0.0 AS spacing, round(greatest(coalesce(n / spacing, 1), 1), 5) AS looks FROM falls")
def independent_azimuth_samples(spark, sf_dir):
    frame = Window.partitionBy("product", "k").orderBy("trace").rowsBetween(-3, 0)
    rows = queries_echoes.four_rows(spark, sf_dir)
    rows = rows.withColumns({"re4": F.sum("re").over(frame), "im4": F.sum("im").over(frame)})
    coherences = interferometry.pixel_coherence(rows.select("product", "trace", "k", F.col("re4").alias("re"), F.col("im4").alias("im")), "product", "trace", "re", "im", 6)
    out = phases.independent_samples(coherences, rows.groupBy("product", "k").agg(F.count("*").alias("n")), ["product", "k"], level=0.4)
    return out.select("product", F.col("k").cast("long").alias("k"), "n", (F.round("spacing", 5) + 0.0).alias("spacing"), F.round("looks", 5).alias("looks"))


# The density of one look has a closed form; its distribution is summed by trapezoids.
DRAWS = """WITH grid AS (SELECT i, -pi() + i * (2 * pi() / 10000) AS phase FROM range(10001) AS t(i)),
beta AS (SELECT *, 0.7 * cos(phase - radians(20)) AS b FROM grid),
density AS (SELECT *, 0.51 / (2 * pi()) / (1 - b * b) * (1 + b * acos(-b) / sqrt(1 - b * b)) AS f FROM beta),
distribution AS (SELECT i, phase, coalesce(sum(f + f0) OVER (ORDER BY i), 0) AS c FROM (SELECT *, lag(f) OVER (ORDER BY i) AS f0 FROM density)),
shares AS (SELECT i, phase, c / max(c) OVER () AS c, lead(phase) OVER (ORDER BY i) AS phase1, lead(c) OVER (ORDER BY i) / max(c) OVER () AS c1 FROM distribution),
parts AS (SELECT part, phase + ((part + 0.5) / 16384 - c) / (c1 - c) * (phase1 - phase) AS phase FROM (SELECT part::INT AS part, (part + 0.5) / 16384 AS u FROM range(16384) AS t(part)) ASOF JOIN (SELECT * FROM shares WHERE c1 > c) ON u >= c),
draws AS (SELECT c_custkey, floor(('0x' || substr(md5('1:' || c_custkey || ':' || draw), 1, 13))::BIGINT / (2.0 ** 52 / 16384))::INT AS part FROM customer, range(1, 9) AS t(draw)) """


@query(DRAWS + "SELECT c_custkey, round(avg(phase), 6) + 0.0 AS mean FROM draws JOIN parts USING (part) GROUP BY c_custkey")
def drawn_phase_means(spark, sf_dir):
    return phases.drawn_means(table(spark, sf_dir, "customer"), "c_custkey", 8, 0.7, 1, 20.0).select("c_custkey", r6("mean").alias("mean"))


# Places to both sides of a curved track, and the nearest customers on a sphere.
SIDES = (
    GRAM
    + """, ups AS (SELECT product, trace, [cos(la) * cos(lo), cos(la) * sin(lo), sin(la)] AS up FROM (SELECT product, trace, radians(-60 + (trace * 7 + product * 11) % 120 * 0.9 + trace * 0.1) AS la, radians(trace * 1.3 + product * 7) AS lo FROM gram)),
steps AS (SELECT product, trace, up, coalesce(lead(up) OVER w, up) AS b, coalesce(lag(up) OVER w, up) AS a FROM ups WINDOW w AS (PARTITION BY product ORDER BY trace)),
level AS (SELECT product, trace, up, list_transform(range(1, 4), lambda i: b[i] - a[i] - (list_inner_product(b, up) - list_inner_product(a, up)) * up[i]) AS l FROM steps),
alongs AS (SELECT product, trace, up, list_transform(l, lambda x: x / sqrt(list_inner_product(l, l))) AS g FROM level),
sides AS (SELECT product, trace, o AS side, up, [up[2] * g[3] - up[3] * g[2], up[3] * g[1] - up[1] * g[3], up[1] * g[2] - up[2] * g[1]] AS c FROM alongs, range(-1, 2) AS t(o)),
points AS (SELECT product, trace, side, list_transform(range(1, 4), lambda i: cos(side * 0.02) * up[i] + sin(side * 0.02) * c[i]) AS p FROM sides) """
)


def _sides(spark, sf_dir):
    lat = (F.pmod(F.col("trace") * 7 + F.col("product") * 11, F.lit(120)) * 9 + F.col("trace") - 600) / 10  # whole tenths, as in the SQL's decimals: 90 is the pole, not a place beyond it
    rows = radargram(spark, sf_dir).select("product", "trace", lat.alias("lat"), ((F.col("trace") * 13 + F.col("product") * 70) / 10).alias("lon"))
    return across.places(across.frames(rows, "product", "trace", "lat", "lon"), 20_000.0, 1, 1_000_000.0)


@query(SIDES + "SELECT product, trace, side::BIGINT AS side, round(degrees(asin(p[3])), 6) + 0.0 AS lat, round((degrees(atan2(p[2], p[1])) + 360) % 360, 6) % 360 AS lon, round(sqrt(1e12 + 2.25e12 - 3e12 * list_inner_product(p, u.up)), 2) AS metres FROM points JOIN ups u USING (product, trace)")
def places_across_track(spark, sf_dir):
    away = across.distance(F.lit(1_500_000.0), "lat", "lon", F.lit(1_000_000.0), "side_lat", "side_lon")
    return _sides(spark, sf_dir).select("product", "trace", F.col("offset").cast("long").alias("side"), r6("side_lat").alias("lat"), (F.round("side_lon", 6) % 360).alias("lon"), F.round(away, 2).alias("metres"))


@query(
    SIDES
    + """, grid AS (SELECT c_custkey, [cos(la) * cos(lo), cos(la) * sin(lo), sin(la)] AS q FROM (SELECT c_custkey, radians((c_custkey * 37 % 1601) / 1601.0 * 150 - 75) AS la, radians((c_custkey * 91 % 2003) / 2003.0 * 360) AS lo FROM customer)),
ranked AS (SELECT product, trace, side, c_custkey, d, row_number() OVER (PARTITION BY product, trace, side ORDER BY d, c_custkey) AS rank FROM (SELECT product, trace, side, c_custkey, sqrt((p[1] - q[1]) ** 2 + (p[2] - q[2]) ** 2 + (p[3] - q[3]) ** 2) AS d FROM points, grid))
SELECT product, trace, side::BIGINT AS side, rank, c_custkey, round(d, 7) AS distance FROM ranked WHERE rank <= 2"""
)
def nearest_cells_across_track(spark, sf_dir):
    xyz = lambda lat, lon: dict(zip("xyz", across.direction(lat, lon), strict=True))
    points = _sides(spark, sf_dir).withColumns(xyz("side_lat", "side_lon"))
    key = F.col("c_custkey")
    grid = table(spark, sf_dir, "customer").select("c_custkey", ((key * 37 % 1601) / 1601.0 * 150 - 75).alias("lat"), ((key * 91 % 2003) / 2003.0 * 360).alias("lon")).withColumns(xyz("lat", "lon"))
    out = across.nearest_cells(points, grid, ["product", "trace", "offset"], "c_custkey", ("x", "y", "z"), 2, 0.05)
    return out.select("product", "trace", F.col("offset").cast("long").alias("side"), F.col("rank").cast("long").alias("rank"), "c_custkey", F.round("distance", 7).alias("distance"))


# Two antennas that differ by a planted shift, roll and unsteady chirps: with these taken off again the phase is 0 everywhere.
@query(GRAM + ", n AS (SELECT product, trace // 5 AS look, count(*) AS n FROM gram GROUP BY product, trace // 5 HAVING count(*) = 5) SELECT product, look, k::BIGINT AS k, 0.0::DOUBLE AS phase, 1.0::DOUBLE AS correlation, 2.0::DOUBLE AS shift FROM n, range(63) AS t(k)")
def interferometer_phases(spark, sf_dir):
    own = interferometer.Antennas(19.0, 5.0, loopback_reach=3, reach=30, look=5)
    t = F.col("trace")
    rows = radargram(spark, sf_dir)
    mixed = lambda by: F.transform(F.sequence(F.lit(0), F.lit(63)), lambda k: F.element_at("samples", (k + by) % 64 + 1) + F.element_at("samples", (k + by + 1) % 64 + 1))
    rows = rows.withColumns({"re": mixed(0), "im": mixed(19)})  # no energy at the highest frequency, which shifts leave out
    rolls = rows.select("product", "trace", F.radians((F.floor(t / 5) % 7 - 3) * 0.5).alias("roll"))
    turn = interferometer.roll_phase(F.radians((F.floor(t / 5) % 7 - 3) * 0.5), own)
    rolled = lambda x, by: traces.roll(x, by)
    chirp = F.array(*(F.lit(float(1 + (k * k * 7) % 23)) for k in range(40)))
    late_a, late_b = F.when(t == 0, 0).otherwise(t % 3 - 1).cast("int"), F.when(t == 0, 0).otherwise(t % 5 - 2).cast("int")
    other = lambda p, q, s: F.zip_with(p, q, lambda x, y: x * F.cos(turn) + s * y * F.sin(turn))
    both = rows.select(
        "product", "trace",
        rolled(F.col("re"), late_a).alias("ar"), rolled(F.col("im"), late_a).alias("ai"), rolled(chirp, late_a).alias("loop_a"),
        rolled(other("re", "im", -1), late_b - 2).alias("br"), rolled(other("im", "re", 1), late_b - 2).alias("bi"), rolled(chirp, late_b).alias("loop_b"),
    )
    table_ = interferometer.registered(both, rolls, "product", "trace", own)
    out = interferometer.interferogram(table_, "product", "trace", own)
    shifts = table_.groupBy("product", F.floor(F.col("trace") / 5).alias("look")).agg(F.round(F.avg("shift"), 6).alias("shift"))
    return out.join(shifts, ["product", "look"]).select("product", "look", F.col("k").cast("long").alias("k"), (F.round("phase", 5) + 0.0).alias("phase"), F.round("correlation", 5).alias("correlation"), "shift")


@query(
    GRAM
    + """, placed AS (SELECT product, trace, samples, 3.69e6::DOUBLE + trace AS x, trace * 300.0::DOUBLE AS y, product * 1000.0::DOUBLE AS z, trace % 3 AS o FROM gram),
pairs AS (SELECT a.product, a.trace, b.trace - a.trace + 2 AS j, b.samples, sqrt(a.x * a.x + a.y * a.y + a.z * a.z) AS r, a.x, a.y, a.z, b.x AS bx, b.y AS b_y, b.z AS bz, a.o - b.o AS o FROM placed a JOIN placed b ON a.product = b.product AND b.trace BETWEEN a.trace - 2 AND a.trace + 2),
late AS (SELECT product, trace, j, samples, o + abs(sqrt((bx - x * 3.39e6 / r) ** 2 + (b_y - y * 3.39e6 / r) ** 2 + (bz - z * 3.39e6 / r) ** 2) - (r - 3.39e6)) / 299792458 / 0.0375e-6 AS late FROM pairs),
lies AS (SELECT product, trace, j, k, samples[s + 1] AS re, samples[s + 33] AS im FROM (SELECT product, trace, j, k, samples, trunc(k + late)::INT AS s FROM late, unnest(range(32)) AS t(k)) WHERE s BETWEEN 0 AND 31),
bins AS (SELECT product, trace, bin, k, sum(re * cos(p) - im * sin(p)) AS re, sum(re * sin(p) + im * cos(p)) AS im FROM (SELECT *, -2 * pi() * bin * j / 5 AS p FROM lies, unnest(range(-1, 2)) AS t(bin)) GROUP BY product, trace, bin, k)
SELECT product, trace, bin, round(sum(sqrt(re * re + im * im)), 5) AS total, round(max(sqrt(re * re + im * im)), 5) AS peak FROM bins GROUP BY product, trace, bin"""
)
def doppler_looks(spark, sf_dir):
    t = F.col("trace").cast("double")
    rows = radargram(spark, sf_dir).select("product", "trace", F.slice("samples", 1, 32).alias("re"), F.slice("samples", 33, 32).alias("im"), (3.69e6 + t).alias("x"), (t * 300).alias("y"), (F.col("product") * 1000.0).alias("z"), F.lit(3.39e6).alias("ground"), (F.col("trace") % 3).alias("opening"))
    out = focusing.doppler_looks(rows, "product", "trace", "re", "im", ("x", "y", "z"), "ground", "opening", 4, 1)
    total = F.aggregate("magnitude", F.lit(0.0), lambda a, x: a + x)
    return out.select("product", "trace", F.col("bin").cast("long").alias("bin"), F.round(total, 5).alias("total"), F.round(F.array_max("magnitude"), 5).alias("peak"))

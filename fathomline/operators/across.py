"""Places across the track: local frames along it, points to either side, their distances, and the nearest cells of a grid."""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import number
from ..plans.work import written
from .terrain import echo_cells
from .windows import sliding


def direction(lat, lon) -> list[Column]:
    """Unit vector to a place on a sphere, of degrees."""
    a, o = F.radians(number(lat)), F.radians(number(lon))
    return [F.cos(a) * F.cos(o), F.cos(a) * F.sin(o), F.sin(a)]


def frames(track: DataFrame, key: str, order: str, lat: str, lon: str) -> DataFrame:
    """track with up, along and across (arrays of three): unit vectors at each trace, along from the trace before to the one after it (or itself at the ends), across to the left of it. Null where these don't move, or stand opposite each other."""
    rows = track.withColumn("up", F.array(*direction(lat, lon)))
    rows = sliding(rows, key, order, 1, 1, from_=F.first("up"), to_=F.last("up")).drop("frame_rows")
    part = lambda c, i: F.col(c)[i]
    step = [part("to_", i) - part("from_", i) for i in range(3)]
    rise = sum(step[i] * part("up", i) for i in range(3))
    level = [step[i] - rise * part("up", i) for i in range(3)]
    size = F.sqrt(sum(x * x for x in level))
    rows = rows.withColumn("along", F.when(size > 1e-15, F.array(*(x / size for x in level))))
    cross = F.array(*(part("up", (i + 1) % 3) * part("along", (i + 2) % 3) - part("up", (i + 2) % 3) * part("along", (i + 1) % 3) for i in range(3)))
    return rows.withColumn("across", F.when(F.col("along").isNotNull(), cross)).drop("from_", "to_")


def places(framed: DataFrame, spacing_m: float, count: int, radius_m: float) -> DataFrame:
    """framed (of frames) with offset, from -count to count, and side_lat, side_lon: places so many spacings to the left of the track, or to the right where negative, on a great circle. Longitudes from 0 to 360. Traces without a frame have none."""
    rows = framed.where("across IS NOT NULL").withColumn("offset", F.explode(F.sequence(F.lit(-count), F.lit(count))))
    angle = F.col("offset") * (spacing_m / radius_m)
    v = [F.cos(angle) * F.col("up")[i] + F.sin(angle) * F.col("across")[i] for i in range(3)]
    return rows.withColumns({"side_lat": F.degrees(F.asin(F.least(F.greatest(v[2], F.lit(-1.0)), F.lit(1.0)))), "side_lon": F.pmod(F.degrees(F.atan2(v[1], v[0])), F.lit(360.0))})


def distance(radius, lat, lon, other_radius, other_lat, other_lon) -> Column:
    """Between two places given by radius and degrees, by the law of cosines."""
    a, b = number(radius), number(other_radius)
    cosine = sum(p * q for p, q in zip(direction(lat, lon), direction(other_lat, other_lon), strict=True))
    return F.sqrt(F.greatest(a * a + b * b - 2 * a * b * cosine, F.lit(0.0)))


#: Rows of the grid in a cube, on average over rows, below which cubes aren't cut further; cubes at the top.
FULL, TOP = 16, 64


def _cubes(cells: DataFrame, size: float) -> tuple[DataFrame, float]:
    """Cells with q0, q1, q2, the cube that each is in, and the cubes' edge: `size`, or less where cubes of it are too full. Rows of one place can't be told apart by cubes."""
    cut = lambda edge: cells.withColumns({f"q{i}": F.floor(F.col(c) / edge) for i, c in enumerate("xyz")})
    full, before = float("inf"), None
    while True:
        n = cut(size).groupBy("q0", "q1", "q2").count()
        got = n.agg(F.sum(F.col("count").cast("double") * F.col("count")) / F.sum("count")).first()[0] or 0.0
        if got > 0.7 * full:
            return cut(before), before
        if got <= FULL:
            return cut(size), size
        full, before = got, size
        size /= 2 ** max(1, math.floor(math.log2(got / FULL) / 2))


def _boxes(rows: DataFrame, low: dict, high: dict, n) -> DataFrame:
    return rows.groupBy("q0", "q1", "q2").agg(*(f(c).alias(name) for f, cols in ((F.min, low), (F.max, high)) for name, c in cols.items()), n.alias("n"))


def nearest_cells(points: DataFrame, grid: DataFrame, ids: list[str], cell: str, x: tuple[str, str, str], k: int = 1, size: float = 1.0) -> DataFrame:
    """ids, cell, distance, rank (from 1): for each point the k nearest rows of the grid (all, if it has fewer), of equally near ones those of least `cell`. x: names of the three coordinates, the same on both sides; rows with one that is null or not finite take no part.

    Space is cut into cubes of `size`, or smaller where these hold many rows, these are put together by four on a side to larger ones, and so on. A point goes down from the few largest: of a cube only the box around its rows and their number is known, which gives the least and the greatest distance of any of them. Cubes whose least distance is beyond the greatest one of a cube with k rows are left out, so that points far from the grid meet no more rows than points on it.
    """
    there = F.lit(True)
    for c in x:
        there = there & (F.abs(F.col(c).cast("double")) < float("inf"))
    number_ = lambda df, columns, names: df.where(there).select(*columns, *(F.col(c).cast("double").alias(n) for c, n in zip(x, names, strict=True)))
    asks = number_(points, ids, [f"{c}p" for c in "xyz"])
    cells = written(number_(grid, [F.col(cell).alias("cell_")], "xyz"))
    placed, _ = _cubes(cells, size)
    levels = [written(_boxes(placed, {f"{c}l": c for c in "xyz"}, {f"{c}h": c for c in "xyz"}, F.count(F.lit(1))))]
    ends = {f"{c}{e}": f"{c}{e}" for c in "xyz" for e in "lh"}
    while levels[-1].count() > TOP:
        up = levels[-1].withColumns({f"q{i}": F.floor(F.col(f"q{i}") / 4) for i in range(3)})
        levels.append(written(_boxes(up, {n: c for n, c in ends.items() if n[1] == "l"}, {n: c for n, c in ends.items() if n[1] == "h"}, F.sum("n"))))
    q, p = ["q0", "q1", "q2"], [f"{c}p" for c in "xyz"]
    square = lambda d: sum(v * v for v in d)
    near = square([F.greatest(F.col(f"{c}l") - F.col(f"{c}p"), F.col(f"{c}p") - F.col(f"{c}h"), F.lit(0.0)) for c in "xyz"])
    far = square([F.greatest(F.abs(F.col(f"{c}p") - F.col(f"{c}l")), F.abs(F.col(f"{c}h") - F.col(f"{c}p"))) for c in "xyz"])
    mine, slack = Window.partitionBy(*ids), 1 + 1e-9
    top = [F.struct(*(F.lit(v).alias(n) for n, v in r.asDict().items())) for r in levels[-1].collect()]
    if not top:
        return asks.limit(0).select(*ids, F.lit(None).cast(cells.schema["cell_"].dataType).alias(cell), F.lit(0.0).alias("distance"), F.lit(0).alias("rank"))
    open_ = asks.withColumn("most_", F.lit(float("inf")))
    for no, boxes in enumerate(reversed(levels)):
        if no == 0:
            met = open_.select("*", F.inline(F.array(*top)))
        else:
            met = open_.withColumnsRenamed({c: f"u{c}" for c in q}).join(boxes.withColumns({f"u{c}": F.floor(F.col(c) / 4) for c in q}), [f"u{c}" for c in q])
        met = met.withColumn("near_", near).where(F.col("near_") <= F.col("most_") * slack)
        met = met.withColumn("most_", F.least("most_", F.min(F.when(F.col("n") >= k, far)).over(mine)))
        open_ = met.where(F.col("near_") <= F.col("most_") * slack).select(*ids, *p, *q, "most_")
    d2 = square([F.col(f"{c}p") - F.col(c) for c in "xyz"])
    found = open_.join(placed, q).where(d2 <= F.col("most_") * slack).select(*ids, "cell_", F.sqrt(sum((F.col(f"{c}p") - F.col(c)) ** 2 for c in "xyz")).alias("distance"))
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy(*ids).orderBy("distance", "cell_"))).where(F.col("rank") <= k)
    return ranked.withColumnRenamed("cell_", cell)


def side_echoes(cells: DataFrame, echoes: DataFrame, keys: list[str], distance_: str, echo: str) -> DataFrame:
    """echoes with side, -1, 0 or 1: on which side of the track the cells lie whose distance comes nearest to the echo's, and with these cells; of equally near ones all. cells: keys, offset, distance_."""
    return echo_cells(cells, echoes, keys, distance_, echo).withColumn("side", F.signum("offset").cast("int"))


def spacing_of(cells_per_degree: float, radius_m: float) -> float:
    """A grid's spacing along a meridian."""
    return math.radians(1 / cells_per_degree) * radius_m

"""Simulated surface clutter: facets of a terrain grid, seen from a track."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LIGHT = 299792458.0


def facets(grid: DataFrame, keys: list[str], row: str, col: str, x: str, y: str, z: str) -> DataFrame:
    """The columns of grid and, for each node, la and lb, the lengths of the steps between its neighbours along a row and along a column, and the unit normal nx, ny, nz.

    A node at the edge is its own neighbour there. Without any extent the normal is null.
    """
    across = Window.partitionBy(*keys, row).orderBy(col)
    down = Window.partitionBy(*keys, col).orderBy(row)

    def step(c: str, w) -> Column:
        return F.coalesce(F.lead(c).over(w), F.col(c)) - F.coalesce(F.lag(c).over(w), F.col(c))

    out = grid.withColumns({f"__a{i}": step(c, across) for i, c in enumerate((x, y, z))}).withColumns({f"__b{i}": step(c, down) for i, c in enumerate((x, y, z))})
    a, b = [[F.col(f"__{s}{i}") for i in range(3)] for s in "ab"]
    cross = [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]
    length = lambda v: F.sqrt(v[0] * v[0] + v[1] * v[1] + v[2] * v[2])
    normal = {n: F.try_divide(c, length(cross)) for n, c in zip(("nx", "ny", "nz"), cross, strict=True)}
    return out.select(*grid.columns, length(a).alias("la"), length(b).alias("lb"), *[c.alias(n) for n, c in normal.items()])


def field_strength(la, lb, cosine, distance, slope: float) -> Column:
    """Geometric optics of a facet whose slopes have deviation `slope`; 0 for a facet seen edge-on."""
    la, lb, cosine, distance = (F.col(c) if isinstance(c, str) else c for c in (la, lb, cosine, distance))
    u = cosine * cosine
    tangent = F.try_divide(1 - u, u)
    return F.coalesce(F.try_divide(la * lb * F.exp(-tangent / (4 * slope * slope)), (2**0.5) * slope * u * distance * distance), F.lit(0.0))


def echoes(track: DataFrame, surface: DataFrame, keys: list[str], order: str, reach: float, slope: float, rate: float, delay: float = 0.0) -> DataFrame:
    """keys, order, sample and power: the summed squares of the field strengths of all facets within `reach` of a trace in the plane x, y, by the sample that their two-way delay less `delay` falls into.

    track: keys, order, sx, sy, sz; surface: keys, x, y, z and the columns of facets(). Traces meet the facets of their own and the eight surrounding squares of side reach, which Spark shuffles by square, so that the work is the number of pairs in reach and no side is broadcast by hand. Facets before `delay` are left out.
    """
    square = lambda c: F.floor(F.col(c) / reach)
    offsets = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    near = track.select(*keys, order, "sx", "sy", "sz", F.explode(offsets).alias("o")).select("*", (square("sx") + F.col("o.i")).alias("__i"), (square("sy") + F.col("o.j")).alias("__j")).drop("o")
    seen = surface.where("nx IS NOT NULL").withColumns({"__i": square("x"), "__j": square("y")}).select(*keys, "__i", "__j", "x", "y", "z", "la", "lb", "nx", "ny", "nz")
    dx, dy, dz = F.col("sx") - F.col("x"), F.col("sy") - F.col("y"), F.col("sz") - F.col("z")
    pairs = near.join(seen, [*keys, "__i", "__j"]).where(dx * dx + dy * dy <= reach * reach)
    pairs = pairs.withColumn("__r", F.sqrt(dx * dx + dy * dy + dz * dz)).withColumn("__u", F.try_divide(F.abs(F.col("nx") * dx + F.col("ny") * dy + F.col("nz") * dz), F.col("__r")))
    field = field_strength("la", "lb", "__u", "__r", slope)
    sample = F.floor((2 * F.col("__r") / LIGHT - delay) * rate)
    return pairs.select(*keys, order, sample.alias("sample"), (field * field).alias("power")).where("sample >= 0").groupBy(*keys, order, "sample").agg(F.sum("power").alias("power"))

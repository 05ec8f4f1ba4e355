"""Heights from terrain grids: a row for each cell, by row and column."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import number

#: Half-axes of the reference ellipsoid in metres, and the radius that the grids' heights count from.
EQUATOR_M, POLE_M, GRID_RADIUS_M = 3396.19e3, 3376.20e3, 3396.0e3


def reference_radius(lat, equator: float = EQUATOR_M, pole: float = POLE_M, south_pole: float | None = None) -> Column:
    """Radius of the reference ellipsoid at a geocentric latitude; the southern half may have its own polar half-axis."""
    x = F.radians(number(lat))
    p = F.when(number(lat) < 0, F.lit(float(south_pole if south_pole is not None else pole))).otherwise(F.lit(float(pole)))
    s, c = equator * F.sin(x), p * F.cos(x)
    return equator * p / F.sqrt(s * s + c * c)


def above_reference(radius_m, lat) -> Column:
    """Height over the ellipsoid of a measured radius."""
    return number(radius_m) - reference_radius(lat)


def from_grid_radius(height_m, lat) -> Column:
    """Height over the ellipsoid of a height over the sphere."""
    return number(height_m) + GRID_RADIUS_M - reference_radius(lat)


def within_box(grid: DataFrame, box: dict[str, tuple[float, float]]) -> DataFrame:
    """Cells inside the box, edges included."""
    for name, (low, high) in box.items():
        grid = grid.where(F.col(name).between(low, high))
    return grid


def heights(points: DataFrame, grid: DataFrame, id_col: str, lat: str, lon: str, north: float, west: float, step: float, out: str = "height", keys: tuple[str, ...] = ()) -> DataFrame:
    """points with the height at their place: of the cells around it, each weighing 1 - distance / sqrt(2) (1 - distance, where the place lies on a row or column), in cells.

    grid: row (from the north), col (from the west), z, and keys where there are many grids. The cells are met by row and column; those without a height, or outside the grid, take no part, and a place without any has null. id_col names points.
    """
    y, x = (F.lit(north) - number(lat)) / step, (number(lon) - F.lit(west)) / step
    around = lambda v: F.array_distinct(F.array(F.floor(v), F.ceil(v)))
    cells = F.flatten(F.transform(around(y), lambda r: F.transform(around(x), lambda c: F.struct(r.alias("row"), c.alias("col")))))
    asked = points.select(*keys, id_col, y.alias("y_"), x.alias("x_"), F.explode(cells).alias("c_")).select(*keys, id_col, "y_", "x_", "c_.row", "c_.col")
    met = asked.join(grid.select(*keys, F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), number("z").alias("z_")).where("z_ IS NOT NULL"), [*keys, "row", "col"])
    dy, dx = F.abs(F.col("y_") - F.col("row")), F.abs(F.col("x_") - F.col("col"))
    onto = (F.floor("y_") == F.col("y_")) | (F.floor("x_") == F.col("x_"))
    weight = 1 - F.when(onto, dy + dx).otherwise(F.hypot(dy, dx) / F.sqrt(F.lit(2.0)))
    value = met.withColumn("w_", weight).groupBy(*keys, id_col).agg(F.try_divide(F.sum(F.col("w_") * F.col("z_")), F.sum("w_")).alias(out))
    return points.join(value, [*keys, id_col], "left")


def echo_cells(cells: DataFrame, echoes: DataFrame, keys: list[str], distance: str, echo: str) -> DataFrame:
    """echoes with the cells of the same keys whose distance comes nearest to the echo's; all of equally near ones. Each range line has its own few cells across track."""
    gap = F.abs(F.col(distance) - F.col(echo))
    least = echoes.join(cells.select(*keys, distance), keys).groupBy(*keys, echo).agg(F.min(gap).alias("least_"))
    return echoes.join(least, [*keys, echo]).join(cells, keys).where(gap == F.col("least_")).drop("least_")


def nearest_cell(lat, lon, area: tuple[float, float, float, float], rows: int, columns: int):
    """Row and column of the cell nearest to a point on a grid over area (south, north, west, east) whose rows begin in the north; the lower of two as near, the edge for points outside."""
    south, north, west, east = map(float, area)
    index = lambda x, step, n: F.least(F.greatest(F.ceil(x / step - 0.5), F.lit(0)), F.lit(n - 1)).cast("int")
    return index(north - number(lat), (north - south) / (rows - 1), rows), index(number(lon) - west, (east - west) / (columns - 1), columns)

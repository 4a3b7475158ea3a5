"""Join of points to a table of latitude/longitude boxes.

The range condition alone would be a nested-loop join. Every box is registered
in the grid cells it touches, and a point looks into its own cell, which makes
it an equality join that Spark may hash, sort or broadcast. There are two grids:
a box goes to the fine one unless it would touch more than ``max_cells`` of its
cells, so the number of cells per box is bounded whatever its size.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.operators.joins import fits_broadcast, sized_join_side

FINE_DEGREES = 0.1
COARSE_DEGREES = 5.0
MAX_CELLS = 4096
# Boxes are broadcast if they touch at most this many cells together.
BROADCAST_CELLS = 500_000
# Positions are clamped to this range before the cell is taken. Clamping keeps
# order, so no match is lost, and a box with absurd borders stays affordable.
CLAMP_DEGREES = 360.0


def _cell(degrees: Column, size: Column | float) -> Column:
    clamped = F.greatest(F.least(degrees, F.lit(CLAMP_DEGREES)), F.lit(-CLAMP_DEGREES))
    return F.floor(clamped / size).cast("int")


def _zone_cells(zones: DataFrame, fine: float, coarse: float, max_cells: int) -> DataFrame:
    """One row per box and grid cell it touches."""

    def span(low: str, high: str) -> Column:
        return (_cell(F.col(high), fine) - _cell(F.col(low), fine) + 1).cast("bigint")

    def cells(low: str, high: str) -> Column:
        return F.sequence(_cell(F.col(low), F.col("_size")), _cell(F.col(high), F.col("_size")))

    touched = span("min_lat", "max_lat") * span("min_lon", "max_lon")
    return (
        zones.filter("min_lat <= max_lat AND min_lon <= max_lon")
        .withColumn("_size", F.when(touched <= max_cells, F.lit(fine)).otherwise(F.lit(coarse)))
        .withColumn("_cell_lat", F.explode(cells("min_lat", "max_lat")))
        .withColumn("_cell_lon", F.explode(cells("min_lon", "max_lon")))
    )


def match_zones(points: DataFrame, zones: DataFrame, fine: float = FINE_DEGREES,
                coarse: float = COARSE_DEGREES, max_cells: int = MAX_CELLS) -> DataFrame:
    """Each point (lat, lon) with each box that contains it, borders included.

    ``zones`` has min_lat, max_lat, min_lon, max_lon and any other columns; the
    result has the columns of both sides.
    """
    keys = ["_size", "_cell_lat", "_cell_lon"]
    cells = _zone_cells(zones, fine, coarse, max_cells)
    # a grid without a box is not looked into; there are two grids at most
    sizes = [row[0] for row in cells.select("_size").distinct().collect()] or [fine]
    size = F.explode(F.array(*map(F.lit, sizes))) if len(sizes) > 1 else F.lit(sizes[0])
    located = (
        points.withColumn("_size", size)
        .withColumn("_cell_lat", _cell(F.col("lat"), F.col("_size")))
        .withColumn("_cell_lon", _cell(F.col("lon"), F.col("_size")))
    )
    within = (F.col("lat").between(F.col("min_lat"), F.col("max_lat"))
              & F.col("lon").between(F.col("min_lon"), F.col("max_lon")))
    boxes = sized_join_side(cells, BROADCAST_CELLS)
    return located.join(boxes, keys).filter(within).drop(*keys)


def flag_zones(points: DataFrame, zones: DataFrame, output: str = "restricted_zone_flag",
               fine: float = FINE_DEGREES, coarse: float = COARSE_DEGREES,
               max_cells: int = MAX_CELLS, broadcast_cells: int | None = None) -> DataFrame:
    """Every point once, with 1 in ``output`` if any box contains it, else 0.

    Boxes are broadcast up to ``broadcast_cells`` cells, if given, else ``BROADCAST_CELLS``.
    """
    boxes = _zone_cells(zones, fine, coarse, max_cells)
    if fits_broadcast(boxes, BROADCAST_CELLS if broadcast_cells is None else broadcast_cells):
        return _flag_by_lookup(points, F.broadcast(boxes), output, (fine, coarse))
    return _flag_by_halves(points, boxes.hint("merge"), output, (fine, coarse))


def _contained(lat: Column, lon: Column, size: float) -> Column:
    """Whether a box of grid ``size`` contains the position."""
    return ((F.col("_size") == size)
            & (F.col("_cell_lat") == _cell(lat, size)) & (F.col("_cell_lon") == _cell(lon, size))
            & lat.between(F.col("min_lat"), F.col("max_lat"))
            & lon.between(F.col("min_lon"), F.col("max_lon")))


def _flag_by_lookup(points: DataFrame, boxes: DataFrame, output: str, sizes) -> DataFrame:
    """One pass over the points: each grid is an existence join with a broadcast."""
    lat, lon = F.col("_p.lat").outer(), F.col("_p.lon").outer()
    hits = [boxes.where(_contained(lat, lon, size)).exists() for size in sizes]
    flag = F.when(reduce(or_, hits), 1).otherwise(0)
    return points.alias("_p").select("_p.*", flag.alias(output))


def _flag_by_halves(points: DataFrame, boxes: DataFrame, output: str, sizes) -> DataFrame:
    """Points in a box (semi join) and the others (anti join), grid by grid.

    Unlike an existence join, adaptive execution can split these where a large
    part of the points shares a cell.
    """
    inside, rest = [], points.alias("_p")
    for size in sizes:
        hit = _contained(F.col("_p.lat"), F.col("_p.lon"), size)
        inside.append(rest.join(boxes, hit, "left_semi").withColumn(output, F.lit(1)))
        rest = rest.join(boxes, hit, "left_anti")
    return reduce(DataFrame.unionByName, inside, rest.withColumn(output, F.lit(0)))

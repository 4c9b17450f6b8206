"""Land areas: convex parts of polygons as rows, grid cells that they touch, and the tiles that an area keeps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermaquilt.functions import geometry as GE

#: Metres of a degree on the sphere that web maps use.
MERCATOR_METRES = 111319.49079327358


def read_polygons(spark, path: str) -> DataFrame:
    """Rows (id, part, rank, x: array, y: array) from JSON lines; each part is a convex ring without its closing point."""
    return spark.read.schema("id string, part int, rank int, x array<double>, y array<double>").json(path)


def ring_area(x: Column, y: Column) -> Column:
    """Area of a ring in square units, by the shoelace rule, whatever its direction."""
    n = F.size(x)
    cross = F.transform(F.sequence(F.lit(1), n), lambda i: F.element_at(x, i) * F.element_at(y, i % n + 1) - F.element_at(x, i % n + 1) * F.element_at(y, i))
    return F.abs(F.aggregate(cross, F.lit(0.0), lambda a, v: a + v)) / 2


def drop_placeholders(parts: DataFrame, most_rank: int = 9) -> DataFrame:
    """Parts with an area and a rank of most_rank at most; an unknown rank is kept."""
    return parts.where((F.size("x") > 2) & (ring_area(F.col("x"), F.col("y")) > 0) & (F.col("rank").isNull() | (F.col("rank") <= most_rank)))


def buffered_box(west: Column, south: Column, east: Column, north: Column, metres: float) -> tuple[Column, Column, Column, Column, Column]:
    """A box widened by so many metres of the Mercator plane, and whether it now crosses the seam; the edges stay in their own frame, uncut."""
    d = metres / MERCATOR_METRES
    up = lambda lat: F.degrees(F.log(F.tan(F.radians(lat) / 2 + 0.7853981633974483)))
    down = lambda y: F.degrees(F.atan(F.exp(F.radians(y))) * 2 - 1.5707963267948966)
    return west - d, down(up(south) - d), east + d, down(up(north) + d), (west - d < -180) | (east + d > 180)


def cells_touching(quads: DataFrame, size: float, lat_limit: float) -> DataFrame:
    """(west, south) of the cells of `size` degrees that a convex quad (x0..x3, y0..y3) touches, inside the latitude limit.

    Each quad is laid on the cells of its box, so cells need no table and no
    join; a quad past 180 degrees is laid on the other side.
    """
    x, y = [F.col(f"x{i}") for i in range(4)], [F.col(f"y{i}") for i in range(4)]
    # A box that ends on a line touches the cell beyond it and the one before it.
    low = lambda v: (F.ceil(F.least(*v) / size) - 1).cast("long")
    high = lambda v: F.floor(F.greatest(*v) / size).cast("long")
    laid = quads.withColumn("_c", F.explode(F.sequence(low(x), high(x)))).withColumn("_r", F.explode(F.sequence(low(y), high(y))))
    west, south = F.col("_c") * size, F.col("_r") * size
    laid = laid.where((south >= -lat_limit) & (south + size <= lat_limit)).where(GE.convex_quad_touches(x, y, (west.cast("double"), south.cast("double"), (west + size).cast("double"), (south + size).cast("double"))))
    return laid.select((F.pmod(west + 180, F.lit(360)) - 180).cast("int").alias("west"), south.cast("int").alias("south")).distinct()


def dissolve(parts: DataFrame, continent: str) -> DataFrame:
    """The parts of one continent's countries, without regard to case or outer blanks; an unknown continent has none."""
    return parts.where(F.lower(F.trim("continent")) == continent.strip().lower())


def select_tiles(planned: DataFrame, land: DataFrame, excluded: DataFrame, least_km2: float) -> DataFrame:
    """(tile_id, land_km2, verdict) of every planned tile: excluded, off, sliver or kept, in this order.

    land: (tile_id, km2), a row for each part inside a tile. Each tile has one verdict.
    """
    area = land.groupBy("tile_id").agg(F.sum("km2").alias("land_km2"))
    out = planned.select("tile_id").distinct().join(excluded.select("tile_id", F.lit(True).alias("_out")).distinct(), "tile_id", "left").join(area, "tile_id", "left")
    verdict = F.when(F.col("_out"), "excluded").when(F.col("land_km2").isNull(), "off").when(F.col("land_km2") < least_km2, "sliver").otherwise("kept")
    return out.select("tile_id", F.when(F.coalesce("_out", F.lit(False)), None).otherwise(F.col("land_km2")).alias("land_km2"), verdict.alias("verdict"))


def disc_reach(tiles: DataFrame, metres: float, half: float = 0.0045) -> DataFrame:
    """Tiles (tile_id, west, south, east, north) that a square of 2 * half degrees at the origin reaches, widened by so many metres."""
    d = half + metres / MERCATOR_METRES
    away = lambda low, high: F.greatest(low - half, F.lit(-half) - high, F.lit(0.0))
    dx, dy = away(F.col("west"), F.col("east")), away(F.col("south"), F.col("north"))
    return tiles.where((F.hypot(dx, dy) <= d - half) & (dx <= d) & (dy <= d))


def block_holding(points: DataFrame, blocks: DataFrame, bbox: tuple[float, float, float, float], per_degree: int, chunk: int) -> DataFrame:
    """points (lat, lon) with the block (brow, bcol) that holds them; no block: left out. Pixels are rounded, not cut off."""
    west, _, _, north = bbox
    row, col = F.rint((north - F.col("lat")) * per_degree), F.rint((F.col("lon") - west) * per_degree)
    at = points.withColumn("brow", F.floor(row / chunk).cast("int")).withColumn("bcol", F.floor(col / chunk).cast("int"))
    return at.join(blocks.select("brow", "bcol"), ["brow", "bcol"], "left_semi")

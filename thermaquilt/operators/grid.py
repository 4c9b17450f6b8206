"""Grid operators over tables with row and col: stretch, dilate, coarsen, block plans, weights between swaths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from thermaquilt.functions.text import tile_name


def iter_grid(spark: SparkSession, lat_limit: int = 60, size: int = 5) -> DataFrame:
    """(tile_id, north, west) of all tiles within +-lat_limit."""
    norths = spark.range(1).select(F.explode(F.sequence(F.lit(lat_limit), F.lit(size - lat_limit), F.lit(-size))).alias("north"))
    both = norths.select("north", F.explode(F.sequence(F.lit(-180), F.lit(180 - size), F.lit(size))).alias("west"))
    return both.select(tile_name(F.col("north"), F.col("west")).alias("tile_id"), "north", "west")


def plan_blocks(spark: SparkSession, height: int, width: int, chunk: int) -> DataFrame:
    """(brow, bcol, y0, x0, y1, x1): the blocks that tile a raster, the last ones clipped."""
    rows = spark.range((height + chunk - 1) // chunk).select(F.col("id").cast("int").alias("brow"))
    both = rows.select("brow", F.explode(F.sequence(F.lit(0), F.lit((width - 1) // chunk))).alias("bcol"))
    edge = lambda c, n: F.least((F.col(c) + 1) * chunk, F.lit(n)).cast("int")
    return both.select("brow", "bcol", (F.col("brow") * chunk).alias("y0"), (F.col("bcol") * chunk).alias("x0"), edge("brow", height).alias("y1"), edge("bcol", width).alias("x1"))


def block_plan(blocks: DataFrame, scenes: DataFrame, *, chunk: int) -> DataFrame:
    """blocks with the time-ordered scenes whose boxes (x0, y0, x1, y1 in pixels) overlap them strictly; empty blocks stay.

    A scene is laid on the blocks that its rows and columns reach, so the join is
    on (brow, bcol); touching an edge is no overlap.
    """
    span = lambda lo, hi: F.sequence(F.floor(F.col(lo) / chunk).cast("int"), F.greatest(F.floor(F.col(lo) / chunk), F.ceil(F.col(hi) / chunk) - 1).cast("int"))
    # Boxes are clipped to the raster before they are laid out.
    laid = scenes.where("sx1 > sx0 and sy1 > sy0").withColumn("brow", F.explode(span("sy0", "sy1"))).withColumn("bcol", F.explode(span("sx0", "sx1")))
    listed = laid.groupBy("brow", "bcol").agg(F.transform(F.sort_array(F.collect_list(F.struct("ts", "ord", "scene_id"))), lambda s: s["scene_id"]).alias("scenes"))
    return blocks.join(listed, ["brow", "bcol"], "left").withColumn("scenes", F.coalesce("scenes", F.array().cast("array<bigint>"))).withColumn("depth", F.size("scenes"))


def time_order(rows: DataFrame, by: str, tie: str, partition: list[str] | None = None) -> DataFrame:
    """rows with `position`, their stable order by time."""
    return rows.withColumn("position", F.row_number().over(Window.partitionBy(*(partition or [])).orderBy(by, tie)) - 1)


def stretch(cells: DataFrame, pixels: DataFrame, shape: tuple[int, int], target: tuple[int, int]) -> DataFrame:
    """pixels (y, x) with the columns of the cell (row, col) under them, nearest, as an equi join; a cell that is not there gives nulls."""
    index = lambda c, n, m: F.floor(F.col(c) * n / m).cast("int")
    own = pixels.withColumn("row", index("y", shape[0], target[0])).withColumn("col", index("x", shape[1], target[1]))
    return own.join(cells, ["row", "col"], "left")


def dilate(cells: DataFrame, radius: int, rows: int, cols: int) -> DataFrame:
    """Cells (row, col) and their neighbours within `radius` on both axes, inside the grid, without wrapping."""
    shifts = F.sequence(F.lit(-radius), F.lit(radius))
    rows_out = cells.select("row", "col", F.explode(shifts).alias("_d")).select((F.col("row") + F.col("_d")).alias("row"), "col")
    out = rows_out.select("row", "col", F.explode(shifts).alias("_d")).select("row", (F.col("col") + F.col("_d")).alias("col"))
    return out.where(F.col("row").between(0, rows - 1) & F.col("col").between(0, cols - 1)).distinct()


def coarsen_any(cells: DataFrame, flag: str, factor: int) -> DataFrame:
    """(row, col, flag) on a grid coarser by factor: true where any cell is; ragged edges are their own cells."""
    return cells.groupBy(F.floor(F.col("row") / factor).cast("int").alias("row"), F.floor(F.col("col") / factor).cast("int").alias("col")).agg(F.bool_or(flag).alias(flag))


def overview(pixels: DataFrame, value: str, factor: int, levels: int) -> DataFrame:
    """(level, y, x, mean, n): averages of valid pixels on ever coarser grids, each level from sums of the one below."""
    at = pixels.groupBy(F.floor(F.col("y") / factor).cast("int").alias("y"), F.floor(F.col("x") / factor).cast("int").alias("x")).agg(F.sum(value).alias("s"), F.count(value).alias("n"))
    out = at.withColumn("level", F.lit(1))
    for k in range(2, levels + 1):
        at = at.groupBy(F.floor(F.col("y") / factor).cast("int").alias("y"), F.floor(F.col("x") / factor).cast("int").alias("x")).agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
        out = out.unionByName(at.withColumn("level", F.lit(k)))
    return out.select("level", "y", "x", F.try_divide(F.col("s"), F.col("n")).alias("mean"), "n")


def place_granules(granules: DataFrame, lat_limit: int = 60, per_degree: int = 100) -> DataFrame:
    """(row, col, count, covered): granule cells (north, west, r, c, count) on the global grid; fill is 0, counts stop at 255."""
    fits = granules.where(F.col("north").between(1 - lat_limit, lat_limit) & F.col("west").between(-180, 179))
    count = F.least(F.greatest(F.when(F.col("count") == -9999, 0).otherwise(F.col("count")), F.lit(0)), F.lit(255))
    return fits.select(((lat_limit - F.col("north")) * per_degree + F.col("r")).cast("int").alias("row"), ((F.col("west") + 180) * per_degree + F.col("c")).cast("int").alias("col"), count.cast("int").alias("count"), F.lit(True).alias("covered"))


def swath_cells(coverage: DataFrame, share: float) -> DataFrame:
    """(wrs_path, row, col) where a quad of the path reaches the cell in `share` of its scenes, and once at least.

    coverage: wrs_path, wrs_row, row, col, n (scenes that reach it), scenes (of the quad).
    """
    return coverage.where(F.col("n") >= F.greatest(F.col("scenes") * share, F.lit(1))).select("wrs_path", "row", "col").distinct()


def boundary_segments(cells: DataFrame, path: str, rows: int, cols: int) -> DataFrame:
    """(path, ax, ay, bx, by): cell edges between a swath and what is not in it; edges of the grid itself are left out."""
    side = F.array(*[F.struct(F.lit(dr).alias("dr"), F.lit(dc).alias("dc")) for dr, dc in ((-1, 0), (1, 0), (0, -1), (0, 1))])
    out = cells.select(path, "row", "col", F.explode(side).alias("s")).withColumn("nr", F.col("row") + F.col("s.dr")).withColumn("nc", F.col("col") + F.col("s.dc"))
    out = out.where(F.col("nr").between(0, rows - 1) & F.col("nc").between(0, cols - 1))
    inside = cells.select(F.col(path).alias("_p"), F.col("row").alias("_r"), F.col("col").alias("_c"))
    out = out.join(inside, (F.col(path) == F.col("_p")) & (F.col("nr") == F.col("_r")) & (F.col("nc") == F.col("_c")), "left_anti")
    flat = F.col("s.dr") != 0
    y = F.col("row") + F.greatest(F.col("s.dr"), F.lit(0))
    x = F.col("col") + F.greatest(F.col("s.dc"), F.lit(0))
    return out.select(path, x.cast("double").alias("ax"), y.cast("double").alias("ay"), F.when(flat, x + 1).otherwise(x).cast("double").alias("bx"), F.when(flat, y).otherwise(y + 1).cast("double").alias("by"))


def edge_distances(cells: DataFrame, segments: DataFrame, path: str, diagonal: float) -> DataFrame:
    """cells with `distance` from their centre to their path's nearest boundary segment; the grid's diagonal where it has none.

    The join is on the path over a coarse swath grid, whose size is fixed by the
    tile and not by the observations.
    """
    px, py = F.col("col") + 0.5, F.col("row") + 0.5
    clamp = lambda v, a, b: F.greatest(F.least(a, b), F.least(F.greatest(a, b), v))
    d = F.hypot(px - clamp(px, F.col("ax"), F.col("bx")), py - clamp(py, F.col("ay"), F.col("by")))
    near = cells.join(segments, path).groupBy(path, "row", "col").agg(F.min(d).alias("distance"))
    return cells.join(near, [path, "row", "col"], "left").withColumn("distance", F.coalesce("distance", F.lit(float(diagonal))))


def blend_weights(distances: DataFrame) -> DataFrame:
    """(wrs_path, row, col, weight): each path's share of the distances at a cell; alone 1, all 0 equal shares."""
    w = Window.partitionBy("row", "col")
    total, k = F.sum("distance").over(w), F.count(F.lit(1)).over(w)
    return distances.select("wrs_path", "row", "col", F.when(k == 1, F.lit(1.0)).otherwise(F.coalesce(F.try_divide(F.col("distance"), total), 1.0 / k)).alias("weight"))


def bilinear(cells: DataFrame, pixels: DataFrame, value: str, factor: int, rows: int, cols: int, keys: list[str]) -> DataFrame:
    """pixels (y, x) x keys with `value` between the four cell centres around them, held at the edges."""
    fy, fx = (F.col("y") + 0.5) / factor - 0.5, (F.col("x") + 0.5) / factor - 0.5
    corner = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (0, 1) for b in (0, 1)])
    p = pixels.withColumn("_fy", fy).withColumn("_fx", fx).withColumn("_k", F.explode(corner))
    part = lambda f, s: F.when(F.col(s) == 1, F.col(f) - F.floor(f)).otherwise(1 - (F.col(f) - F.floor(f)))
    held = lambda f, s, n: F.least(F.greatest(F.floor(f) + F.col(s), F.lit(0)), F.lit(n - 1)).cast("int")
    p = p.withColumn("row", held("_fy", "_k.a", rows)).withColumn("col", held("_fx", "_k.b", cols)).withColumn("_w", part("_fy", "_k.a") * part("_fx", "_k.b"))
    return p.join(cells, ["row", "col"]).groupBy("y", "x", *keys).agg(F.sum(F.col("_w") * F.col(value)).alias(value))


def neighbour_weights(weights: DataFrame, rows: int, cols: int) -> DataFrame:
    """(wrs_path, row, col, around): a cell's own and its eight neighbours' weights, row by row; 0 where the path has no cell, the nearest cell's beyond the grid's edge."""
    steps = F.array(*[F.struct(F.lit(a).alias("dr"), F.lit(b).alias("dc")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
    held = lambda c, d, n: F.least(F.greatest(F.col(c) + F.col(d), F.lit(0)), F.lit(n - 1))
    asked = weights.select("wrs_path", "row", "col", F.explode(steps).alias("s")).withColumn("_r", held("row", "s.dr", rows)).withColumn("_c", held("col", "s.dc", cols))
    known = weights.select(F.col("wrs_path").alias("_p"), F.col("row").alias("_kr"), F.col("col").alias("_kc"), "weight")
    both = asked.join(known, (F.col("wrs_path") == F.col("_p")) & (F.col("_r") == F.col("_kr")) & (F.col("_c") == F.col("_kc")), "left")
    return both.groupBy("wrs_path", "row", "col").agg(F.sort_array(F.collect_list(F.struct("s.dr", "s.dc", F.coalesce("weight", F.lit(0.0)).alias("w"))))["w"].alias("around"))


def ramp_at(y: Column, x: Column, row: Column, col: Column, around: Column, factor: tuple[int, int]) -> Column:
    """The weight at a pixel's centre between the four cell centres around it. row, col: the pixel's own cell, around: neighbour_weights of it."""
    fy, fx = (y + 0.5) / factor[0] - 0.5, (x + 0.5) / factor[1] - 0.5
    ty, tx = fy - F.floor(fy), fx - F.floor(fx)
    # The upper left of the four cells is the own one or the one before it.
    first = ((F.floor(fy) - row + 1) * 3 + F.floor(fx) - col + 1 + 1).cast("int")
    at = lambda k: F.element_at(around, first + k)
    return (1 - ty) * ((1 - tx) * at(0) + tx * at(1)) + ty * ((1 - tx) * at(3) + tx * at(4))


def shift_scan(missing: DataFrame, gaps: DataFrame, reach: int) -> DataFrame:
    """(dy, dx, hits, share): for each shift within reach, the share of missing pixels that a gap cell covers."""
    steps = F.sequence(F.lit(-reach), F.lit(reach))
    moved = missing.select("row", "col", F.explode(steps).alias("dy")).select("row", "col", "dy", F.explode(steps).alias("dx"))
    g = gaps.select(F.col("row").alias("_r"), F.col("col").alias("_c"), F.lit(1).alias("hit")).distinct()
    both = moved.join(g, (F.col("row") + F.col("dy") == F.col("_r")) & (F.col("col") + F.col("dx") == F.col("_c")), "left")
    return both.groupBy("dy", "dx").agg(F.count("hit").alias("hits"), F.count(F.lit(1)).alias("n")).withColumn("share", F.try_divide(F.col("hits").cast("double"), F.col("n").cast("double"))).drop("n")


def ray_crossings(x: Column, y: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Whether a ray from (x, y) to the right crosses an edge; an odd number of crossings is inside."""
    return ((y0 > y) != (y1 > y)) & (x < (x1 - x0) * (y - y0) / F.nullif(y1 - y0, F.lit(0.0)) + x0)


def rasterize(pixels: DataFrame, edges: DataFrame, step: float = 1.0) -> DataFrame:
    """pixels (y, x, px, py: centres) inside the rings of `edges` (x0, y0, x1, y1), by the pixel-centre rule.

    Edges are laid on the bands of `step` that they span, about a pixel row
    high, so pixel rows meet edges by band and pixels their row's edges by row.
    """
    band = lambda v: F.floor(v / step)
    rows = pixels.groupBy("y").agg(F.first("py").alias("_py")).withColumn("_band", band(F.col("_py")))
    laid = edges.withColumn("_band", F.explode(F.sequence(band(F.least("y0", "y1")), band(F.greatest("y0", "y1")))))
    at = rows.join(laid, "_band").where((F.least("y0", "y1") <= F.col("_py")) & (F.greatest("y0", "y1") > F.col("_py"))).select(F.col("y").alias("_y"), "x0", "y0", "x1", "y1")
    hit = pixels.join(at, F.col("y") == F.col("_y")).where(ray_crossings(F.col("px"), F.col("py"), F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")))
    return hit.groupBy("y", "x").count().where("count % 2 = 1").select("y", "x")

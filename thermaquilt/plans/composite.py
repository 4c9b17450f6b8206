"""Prep and composite as one declarative plan over the long observation table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermaquilt import constants as K
from thermaquilt.functions import quality as Q
from thermaquilt.operators import aggregates as A
from thermaquilt.operators import grid as G


def valid_observations(obs: DataFrame, extra: Column | None = None) -> DataFrame:
    """obs with c, valid rows only; the range check comes before any offset."""
    c = Q.to_celsius(F.col("dn"))
    ok = Q.valid_observation(F.col("dn"), F.col("qa"), c)
    return obs.where(ok if extra is None else ok & extra).withColumn("c", c)


def prep_offsets(valid: DataFrame, *, floor: int, cap: float = K.MAX_OFFSET, exact: bool = True) -> DataFrame:
    """(scene_id, offset, n_valid, keep): each scene's median difference from its pixels' months."""
    ref = A.month_climatology(valid)
    off = A.exact_offsets(valid, ref) if exact else A.offsets_from_histogram(A.anomaly_histogram(valid, ref))
    return off.withColumn("keep", Q.keep_mask(F.col("offset"), F.col("n_valid"), floor, cap))


def debias(valid: DataFrame, offsets: DataFrame) -> DataFrame:
    """valid less its scene's offset; a rejected scene leaves the percentile and the counts alike."""
    return valid.join(offsets.where("keep").select("scene_id", "offset"), "scene_id").withColumn("c", F.col("c") - F.col("offset"))


def swath_weights(valid: DataFrame, *, factor: tuple[int, int], share: float, rows: int, cols: int) -> DataFrame:
    """(wrs_path, row, col, weight) on the coarse swath grid: shares of the distances to each swath's edge."""
    cell = valid.withColumn("row", F.floor(F.col("y") / factor[0]).cast("int")).withColumn("col", F.floor(F.col("x") / factor[1]).cast("int"))
    reached = cell.groupBy("wrs_path", "wrs_row", "row", "col").agg(F.count_distinct("scene_id").alias("n"))
    scenes = cell.groupBy("wrs_path", "wrs_row").agg(F.count_distinct("scene_id").alias("scenes"))
    swaths = G.swath_cells(reached.join(scenes, ["wrs_path", "wrs_row"]), share)
    segments = G.boundary_segments(swaths, "wrs_path", rows, cols)
    return G.blend_weights(G.edge_distances(swaths, segments, "wrs_path", (rows**2 + cols**2) ** 0.5))


def feathered_p95(cor: DataFrame, weights: DataFrame, *, factor: tuple[int, int], shape: tuple[int, int], least: int = K.MIN_PATH_OBSERVATIONS) -> DataFrame:
    """(y, x, p95, fallback): percentile per path where it has enough observations, blended by weight; else the pooled one.

    A path takes part where its own swath cell covers the pixel; its weight is
    then interpolated between the four cell centres around the pixel, so that
    neighbouring pixels change smoothly. The pooled percentile is taken only over
    pixels without a blend.
    """
    per_path = cor.groupBy("y", "x", "wrs_path").agg(A.percentile95(F.col("c")).alias("p"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    around = G.neighbour_weights(weights.select("wrs_path", "row", "col", "weight"), *shape)
    at = per_path.withColumn("row", F.floor(F.col("y") / factor[0]).cast("int")).withColumn("col", F.floor(F.col("x") / factor[1]).cast("int"))
    # A row for each path and cell of the coarse swath grid, whose size the tile fixes.
    ramp = at.join(around, ["wrs_path", "row", "col"]).withColumn("weight", G.ramp_at(F.col("y"), F.col("x"), F.col("row"), F.col("col"), F.col("around"), factor))
    blend = ramp.groupBy("y", "x").agg(F.sum(F.col("weight") * F.col("p")).alias("wp"), F.sum("weight").alias("w")).where("w > 0").select("y", "x", (F.col("wp") / F.col("w")).alias("p95"), F.lit(False).alias("fallback"))
    pooled = cor.join(blend, ["y", "x"], "left_anti").groupBy("y", "x").agg(A.percentile95(F.col("c")).alias("p95")).withColumn("fallback", F.lit(True))
    return blend.unionByName(pooled)


def pixel_counts(cor: DataFrame) -> DataFrame:
    """(y, x, clear, water, m01..m12): unsaturated counts and saturated months."""
    return cor.groupBy("y", "x").agg(F.count(F.lit(1)).alias("clear"), F.count_if(Q.qa_water(F.col("qa"))).alias("water"), *Q.month_counts(F.col("month")))


def reduce_pixels(cor: DataFrame, percentile: DataFrame | None = None) -> DataFrame:
    """(y, x, dn, observed, total, m01..m12, p95, water_class, fallback): support rule, encoding and water rule, in this order.

    Without `percentile` the pooled one is taken in the same aggregation. The
    support rule sums the saturated months; the water rule has the full counts
    and the percentile, not the encoded number.
    """
    if percentile is None:
        px = cor.groupBy("y", "x").agg(F.count(F.lit(1)).alias("clear"), F.count_if(Q.qa_water(F.col("qa"))).alias("water"), *Q.month_counts(F.col("month")), A.percentile95(F.col("c")).alias("p95")).withColumn("fallback", F.lit(True))
    else:
        px = pixel_counts(cor).join(percentile, ["y", "x"], "left")
    px = px.withColumn("total", Q.month_total())
    dn = F.when(Q.supported_output(F.col("p95"), F.col("total")), Q.encode_celsius(F.col("p95"))).otherwise(F.lit(K.NODATA))
    return px.withColumn("dn", dn.cast("int")).withColumn("water_class", Q.observed_water(F.col("water"), F.col("clear"), F.col("p95")))


def finalize_pixels(px: DataFrame, keep: Column) -> DataFrame:
    """Nodata where the geometry or the water class says so; each pixel is credited to one rule, geometry first."""
    had = F.col("dn") > 0
    return px.withColumn("by_geometry", had & ~keep).withColumn("by_water", had & keep & F.col("water_class")).withColumn("dn", F.when(keep & ~F.col("water_class"), F.col("dn")).otherwise(F.lit(K.NODATA)).cast("int"))


def composite(obs: DataFrame, *, floor: int, factor: tuple[int, int], share: float, shape: tuple[int, int], keep: Column, footprint: Column | None = None, least: int = K.MIN_PATH_OBSERVATIONS) -> DataFrame:
    """The whole product: rules, offsets, cross-faded percentiles, counts, support, encoding, water and land."""
    valid = valid_observations(obs, footprint)
    cor = debias(valid, prep_offsets(valid, floor=floor))
    weights = swath_weights(valid, factor=factor, share=share, rows=shape[0], cols=shape[1])
    return finalize_pixels(reduce_pixels(cor, feathered_p95(cor, weights, factor=factor, shape=shape, least=least)), keep)

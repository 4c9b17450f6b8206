"""A synthetic source: scenes on a walk with a reproducible field, by hashes on spark.range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def noise(*parts: Column, seed: int) -> Column:
    """About normal, mean 0, deviation 1: four uniform numbers from a hash of the parts, the same on every run."""
    total = F.lit(0.0)
    for k in range(4):
        total = total + F.pmod(F.xxhash64(F.lit(seed), F.lit(k), *parts), F.lit(1 << 40)) / float(1 << 40) - 0.5
    return total * (3.0**0.5)


def rehearsal_scenes(spark: SparkSession, n: int, west: float, south: float, *, edge: float = 1.7) -> DataFrame:
    """n scenes on a 7 by 7 walk: scene_id, month, wrs_path, wrs_row, box."""
    k = F.col("id")
    s = spark.range(n)
    x, y = west + (k % 7) * 0.55, south + F.floor(k / 7) % 7 * 0.55
    return s.select(k.alias("scene_id"), (k % 12 + 1).cast("int").alias("month"), (220 + k % 6).cast("int").alias("wrs_path"), (80 + k % 3).cast("int").alias("wrs_row"), x.alias("west"), y.alias("south"), (x + edge).alias("east"), (y + edge).alias("north"))


def rehearsal_observations(scenes: DataFrame, *, per_degree: int = 60, mean: float = 45.0, deviation: float = 6.0, water: tuple[float, float, float, float] | None = None, seed: int = 0) -> DataFrame:
    """scene_id, month, wrs_path, wrs_row, y, x, dn, qa over each scene's pixels; inside the water box cool, with the water bit."""
    cells = lambda lo, hi: F.explode(F.sequence(F.ceil(F.col(lo) * per_degree).cast("int"), F.floor(F.col(hi) * per_degree).cast("int") - 1))
    px = scenes.withColumn("x", cells("west", "east")).withColumn("y", cells("south", "north"))
    lon, lat = (F.col("x") + 0.5) / per_degree, (F.col("y") + 0.5) / per_degree
    wet = F.lit(False) if water is None else lon.between(water[0], water[2]) & lat.between(water[1], water[3])
    z = noise(F.col("scene_id"), F.col("x"), F.col("y"), seed=seed)
    c = F.when(wet, 26.0 + z).otherwise(mean + deviation * z)
    return px.select("scene_id", "month", "wrs_path", "wrs_row", "y", "x", F.rint((c - 149.0 + 273.15) / 0.00341802).cast("int").alias("dn"), F.when(wet, 192).otherwise(64).alias("qa"))


def mosaic(tiles: DataFrame, per_degree: int, tile_degrees: int = 5) -> DataFrame:
    """Tiles' pixels (tile north and west, y, x, ...) at their rows and columns of the whole grid; a view, nothing is copied."""
    return tiles.withColumn("row", (F.lit(60) - F.col("north")) * per_degree + F.col("y")).withColumn("column", (F.col("west") + 180) * per_degree + F.col("x"))


def verify_written(df: DataFrame, path: str, value: str, low: float, high: float) -> None:
    """Reads a written table again: as many rows and values as were sent, none out of range."""
    back = df.sparkSession.read.parquet(path)
    a, b = (t.agg(F.count(F.lit(1)), F.count(value), F.sum(F.xxhash64(value).cast("decimal(38,0)"))).head() for t in (df, back))
    if a != b or back.where((F.col(value) < low) | (F.col(value) > high)).head(1):
        raise ValueError(f"{path} does not hold what was written")

"""Scene inventory: scan, exact window, footprints, tiles, clustered write, guarded reads."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from thermaquilt import constants as K
from thermaquilt.functions import geometry as G
from thermaquilt.functions import text as T
from thermaquilt.operators.joins import assign_tiles


class ManifestError(ValueError):
    """A stored table does not say what the caller needs."""


#: Columns of the bulk metadata that the inventory reads; fixed values.
BULK_COLUMNS = (
    "Display ID", "Landsat Scene Identifier", "Date Acquired", "Start Time", "Stop Time", "Satellite", "Data Type L2", "Collection Category", "WRS Path", "WRS Row", "Scene Cloud Cover L1", "Product Map Projection L1", "UTM Zone",
    "Corner Upper Left Latitude", "Corner Upper Left Longitude", "Corner Upper Right Latitude", "Corner Upper Right Longitude", "Corner Lower Left Latitude", "Corner Lower Left Longitude", "Corner Lower Right Latitude", "Corner Lower Right Longitude",
)
_RING = ("Upper Left", "Upper Right", "Lower Right", "Lower Left")


def scan_bulk(bulk: DataFrame, start: str, end: str, satellites: tuple[int, ...] = (8, 9), cloud_lt: float = K.CLOUD_LT, lat_limit: float = K.LAT_LIMIT) -> DataFrame:
    """The needed columns of scenes that can be in the window: a day more on both sides, exact later.

    Dates are YYYY/MM/DD text, compared as such text so the filter reaches the scan.
    """
    lats = [F.col(f"Corner {c} Latitude") for c in _RING]
    day = lambda s, d: F.date_format(F.date_add(F.to_date(F.lit(s[:10])), d), "yyyy/MM/dd")
    return bulk.select(*[F.col(f"`{c}`") for c in BULK_COLUMNS]).where(
        F.col("Date Acquired").between(day(start, -1), day(end, 1)) & F.col("Satellite").isin(*satellites) & (F.col("Scene Cloud Cover L1") < cloud_lt) & (F.least(*lats) <= lat_limit) & (F.greatest(*lats) >= -lat_limit)
    )


def filter_to_window(rows: DataFrame, centre: Column, start: str, end: str) -> DataFrame:
    return rows.where(centre.between(F.to_timestamp(F.lit(start)), F.to_timestamp(F.lit(end))))


def scene_centre(start: Column, stop: Column) -> Column:
    return F.timestamp_micros(F.floor((F.unix_micros(start) + F.unix_micros(stop)) / 2).cast("long"))


def near_month_boundary(centre: Column, guard: int = K.MONTH_GUARD_SECONDS) -> Column:
    """Whether a centre is so near a month's turn that its month is not certain."""
    return F.month(centre - F.expr(f"INTERVAL {guard} SECONDS")) != F.month(centre + F.expr(f"INTERVAL {guard} SECONDS"))


def build_inventory(bulk: DataFrame, tiles: DataFrame, root: str, start: str = K.WINDOW_START, end: str = K.WINDOW_END) -> DataFrame:
    """One row per tile and scene. Tiles are assigned before anything is derived, so a scene outside all tiles costs nothing more."""
    s = scan_bulk(bulk, start, end)
    s = s.withColumn("datetime", scene_centre(F.to_timestamp("Start Time"), F.to_timestamp("Stop Time")))
    s = filter_to_window(s, F.col("datetime"), start, end)
    for i, c in enumerate(_RING):
        s = s.withColumn(f"corner_lon{i}", F.col(f"Corner {c} Longitude")).withColumn(f"corner_lat{i}", F.col(f"Corner {c} Latitude"))
    lons, lats = F.array(*[f"corner_lon{i}" for i in range(4)]), F.array(*[f"corner_lat{i}" for i in range(4)])
    s = s.withColumn("crosses_antimeridian", G.crosses_antimeridian(lons))
    s = assign_tiles(s, tiles)
    west, south, east, north = G.footprint_box(lons, lats)
    thermal, qa = T.asset_hrefs(root, F.col("Display ID"), F.col("WRS Path"), F.col("WRS Row"), F.col("Data Type L2"))
    return s.select(
        "tile_id", T.item_id_of(F.col("Display ID")).alias("item_id"), F.col("Display ID").alias("display_id"), F.col("Landsat Scene Identifier").alias("scene_id"), "datetime", F.concat(F.lit("landsat-"), F.col("Satellite").cast("string")).alias("platform"),
        F.col("Collection Category").alias("collection_category"), F.col("Data Type L2").alias("data_type"), F.col("WRS Path").cast("int").alias("wrs_path"), F.col("WRS Row").cast("int").alias("wrs_row"), F.col("Scene Cloud Cover L1").alias("cloud_cover"),
        west.alias("bbox_west"), south.alias("bbox_south"), east.alias("bbox_east"), north.alias("bbox_north"), "crosses_antimeridian", thermal.alias("thermal_href"), qa.alias("qa_href"), *[f"corner_lon{i}" for i in range(4)], *[f"corner_lat{i}" for i in range(4)],
    )


def derive_projection(scenes: DataFrame, *, step: float = 30.0, phase: float = 15.0) -> DataFrame:
    """scenes (corners, utm_zone) with proj_epsg, origin and shape of their snapped grid, and the drift from it; column arithmetic only."""
    south = F.col("corner_lat0") < 0
    epsg = F.when(south, F.lit(32700)).otherwise(F.lit(32600)) + F.col("utm_zone")
    xy = [G.utm_forward(F.col(f"corner_lon{i}"), F.col(f"corner_lat{i}"), F.col("utm_zone")) for i in range(4)]
    left, right = F.least(*[x for x, _ in xy]), F.greatest(*[x for x, _ in xy])
    low, high = F.least(*[y for _, y in xy]), F.greatest(*[y for _, y in xy])
    x0, y0 = G.snap(left, phase, step), G.snap(high, phase, step)
    return scenes.select("*", epsg.alias("proj_epsg"), x0.alias("proj_origin_x"), y0.alias("proj_origin_y"), F.rint((right - x0) / step).cast("int").alias("proj_shape_x"), F.rint((y0 - low) / step).cast("int").alias("proj_shape_y"), F.greatest(F.abs(left - x0), F.abs(high - y0)).alias("drift"))


def write_inventory(rows: DataFrame, path: str, manifest: dict) -> None:
    """Rows clustered by tile and time, one folder a tile, so a tile's read is pruned to it; the manifest is a one-row table beside."""
    rows.repartitionByRange(F.col("tile_id")).sortWithinPartitions("tile_id", "datetime", "item_id").write.mode("errorifexists").partitionBy("tile_id").option("compression", "zstd").parquet(f"{path}/rows")
    write_manifest(rows.sparkSession, f"{path}/manifest", manifest)


def write_manifest(spark: SparkSession, path: str, manifest: dict) -> None:
    spark.createDataFrame([(json.dumps(manifest, sort_keys=True),)], "manifest string").coalesce(1).write.parquet(path)


def read_manifest(spark: SparkSession, path: str) -> dict:
    rows = spark.read.schema("manifest string").parquet(path).head(2)
    if len(rows) != 1:
        raise ManifestError(f"{path} holds {len(rows)} manifests, not one")
    return json.loads(rows[0][0])


def check_manifest(manifest: dict, **wanted: object) -> None:
    """Refuses a manifest that differs from what is wanted in any field."""
    wrong = {k: (manifest.get(k), v) for k, v in wanted.items() if manifest.get(k) != v}
    if wrong:
        raise ManifestError("; ".join(f"{k} is {a!r}, wanted {b!r}" for k, (a, b) in sorted(wrong.items())))


def items_for_tile(spark: SparkSession, path: str, tile: str) -> DataFrame:
    """One tile's scenes in time order with their boxes trimmed to its side of the antimeridian; refuses a tile without scenes."""
    rows = spark.read.parquet(f"{path}/rows").where(F.col("tile_id") == tile)
    if not rows.head(1):
        raise ManifestError(f"no scene of tile {tile}")
    north, west = T.tile_corner(F.lit(tile))
    box = (F.col("bbox_west"), F.col("bbox_south"), F.col("bbox_east"), F.col("bbox_north"))
    local = G.tile_local_box(box, F.col("crosses_antimeridian"), (west, north - K.TILE_DEGREES, west + K.TILE_DEGREES, north))
    return rows.select("*", *[c.alias(f"local_{n}") for c, n in zip(local, ("west", "south", "east", "north"), strict=True)]).orderBy("datetime", "item_id")


def tile_counts(inventory: DataFrame) -> DataFrame:
    """(tile_id, scenes, thermal): scenes and those with a thermal band."""
    return inventory.groupBy("tile_id").agg(F.count(F.lit(1)).alias("scenes"), F.count("thermal_href").alias("thermal"))


def item_struct(collection: str) -> Column:
    """A row as a nested catalogue item."""
    box = (F.col("bbox_west"), F.col("bbox_south"), F.col("bbox_east"), F.col("bbox_north"))
    assets = F.map_filter(F.create_map(F.lit("lwir11"), F.col("thermal_href"), F.lit("qa_pixel"), F.col("qa_href")), lambda _, v: v.isNotNull())
    return F.struct(
        F.lit("Feature").alias("type"), F.col("item_id").alias("id"), F.lit(collection).alias("collection"), F.array(*box).alias("bbox"),
        F.struct(F.lit("Polygon").alias("type"), F.array(G.ring(box)).alias("coordinates")).alias("geometry"),
        F.struct(F.date_format("datetime", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("datetime"), F.col("platform").alias("platform"), F.col("cloud_cover").alias("cloud_cover")).alias("properties"),
        F.transform_values(assets, lambda _, v: F.struct(v.alias("href"))).alias("assets"),
    )


def search_items(items: DataFrame, box: tuple[float, float, float, float], start: str, end: str, platforms: tuple[str, ...] | None = K.PLATFORMS, cloud_lt: float = K.CLOUD_LT) -> DataFrame:
    own = (F.col("bbox_west"), F.col("bbox_south"), F.col("bbox_east"), F.col("bbox_north"))
    hit = G.touching_overlap(own, tuple(F.lit(v) for v in box)) & F.col("datetime").between(F.to_timestamp(F.lit(start)), F.to_timestamp(F.lit(end))) & (F.col("cloud_cover") < cloud_lt)
    return items.where(hit if platforms is None else hit & F.col("platform").isin(*platforms))


def thermal_only(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Items with a thermal band, and how many there are without."""
    return items.where("thermal_href is not null"), items.agg(F.count_if(F.col("thermal_href").isNull()).alias("dropped"))


def staging_manifest(items: DataFrame) -> DataFrame:
    """Each object once, by item and band."""
    both = F.explode(F.array(F.struct(F.lit("lwir11").alias("band"), F.col("thermal_href").alias("href")), F.struct(F.lit("qa_pixel").alias("band"), F.col("qa_href").alias("href"))))
    return items.select("item_id", both.alias("o")).select("item_id", "o.band", "o.href").where("href is not null").dropDuplicates(["item_id", "band"]).orderBy("item_id", "band")

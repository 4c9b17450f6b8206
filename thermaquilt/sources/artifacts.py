"""Tables that stages hand to each other: prep, land, cells, coverage, logs and the catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermaquilt.functions import text as T
from thermaquilt.operators.inventory import ManifestError, check_manifest, read_manifest, write_manifest

PREP_VERSION = 3


def write_prep(path: str, offsets: DataFrame, weights: DataFrame, meta: dict) -> None:
    """Offsets and weights as Parquet, what they hold for as a one-row manifest."""
    offsets.write.parquet(f"{path}/offsets")
    weights.write.parquet(f"{path}/weights")
    write_manifest(offsets.sparkSession, f"{path}/meta", meta | {"schema_version": PREP_VERSION})


def load_prep(spark: SparkSession, path: str, **wanted: object) -> tuple[DataFrame, DataFrame, dict]:
    """Prep tables whose manifest agrees with `wanted`; a partial one, or one for another tile, grid or scene list, is refused."""
    meta = read_manifest(spark, f"{path}/meta")
    check_manifest(meta, schema_version=PREP_VERSION, **wanted)
    if meta.get("partial"):
        raise ManifestError(f"{path} covers a part of its tile only")
    return spark.read.parquet(f"{path}/offsets"), spark.read.parquet(f"{path}/weights"), meta


def write_cells(path: str, cells: DataFrame, manifest: dict, *, tile_cells: int = 500) -> None:
    """Cell counts (row, col, count, covered) by 5-degree tile, so a box reads its own tiles only."""
    tiled = cells.withColumn("trow", F.floor(F.col("row") / tile_cells).cast("int")).withColumn("tcol", F.floor(F.col("col") / tile_cells).cast("int"))
    tiled.repartition("trow", "tcol").write.partitionBy("trow", "tcol").parquet(f"{path}/cells")
    write_manifest(cells.sparkSession, f"{path}/manifest", manifest)


def cells_for_window(spark: SparkSession, path: str, rows: tuple[int, int], cols: tuple[int, int], pad: int = 0, *, tile_cells: int = 500) -> DataFrame:
    """All cells of a padded window, those that were not stored with count 0 and not covered. Folders outside the window are not read."""
    r0, r1, c0, c1 = rows[0] - pad, rows[1] + pad, cols[0] - pad, cols[1] + pad
    own = spark.read.parquet(f"{path}/cells").where(F.col("trow").between(r0 // tile_cells, r1 // tile_cells) & F.col("tcol").between(c0 // tile_cells, c1 // tile_cells) & F.col("row").between(r0, r1) & F.col("col").between(c0, c1))
    grid = spark.range(r0, r1 + 1).select(F.col("id").cast("int").alias("row"), F.explode(F.sequence(F.lit(c0), F.lit(c1))).alias("col"))
    return grid.join(own.select("row", "col", "count", "covered"), ["row", "col"], "left").select("row", "col", F.coalesce("count", F.lit(0)).alias("count"), F.coalesce("covered", F.lit(False)).alias("covered"))


def missing_granules(wanted: DataFrame, have: DataFrame) -> DataFrame:
    """Cells wanted that no granule name is of. have: (name)."""
    ns, ew = T.granule_cell(F.col("name"))
    return wanted.join(have.select(ns.alias("north"), ew.alias("west")).distinct(), ["north", "west"], "left_anti")


def write_coverage(path: str, rows: DataFrame) -> None:
    """JSON lines in tile order with the columns in order of name: one small file that is the same for the same rows."""
    rows.select(*sorted(rows.columns)).orderBy("tile_id").coalesce(1).write.mode("overwrite").json(path)


def coverage_rows(lists: list[DataFrame], plan: DataFrame, attributes: DataFrame) -> DataFrame:
    """(tile_id, attributes, runnable): all tiles of the lists; those not in the plan have null attributes."""
    tiles = lists[0]
    for other in lists[1:]:
        tiles = tiles.union(other)
    planned = plan.select("tile_id").withColumn("_in", F.lit(True))
    return tiles.distinct().join(planned, "tile_id", "left").join(attributes, "tile_id", "left").withColumn("runnable", F.col("_in").isNotNull()).drop("_in")


def read_run_log(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Markers (file, phase, rc, ts) and the last heartbeat (file, beat) of text logs."""
    lines = spark.read.text(path).withColumn("file", F.input_file_name())
    markers = lines.select("file", T.marker_fields(F.col("value")).alias("m")).where("m is not null").select("file", "m.*")
    return markers, lines.select("file", T.beat_time(F.col("value")).alias("b")).groupBy("file").agg(F.max("b").alias("beat"))


def read_status_log(spark: SparkSession, path: str, day: str) -> tuple[DataFrame, DataFrame]:
    """Snapshots in order, days counted on where the clock turns back, and the counts of failure and throttle lines."""
    from pyspark.sql import Window

    lines = spark.read.text(path).withColumn("n", F.monotonically_increasing_id())
    shots = lines.select("n", T.status_fields(F.col("value"), F.lit(day)).alias("s")).where("s is not null").select("n", "s.*")
    w = Window.partitionBy(F.lit(0)).orderBy("n")  # one driver's log
    back = shots.withColumn("_b", F.coalesce((F.col("at") < F.lag("at").over(w)).cast("int"), F.lit(0)))
    days = back.withColumn("_d", F.sum("_b").over(w)).withColumn("at", F.timestamp_seconds(F.unix_seconds("at") + F.col("_d") * 86400)).drop("_b", "_d", "n")
    counts = lines.agg(F.count_if(F.col("value").contains("FAILED")).alias("failures"), F.count_if(F.col("value").rlike("SlowDown|Throttl")).alias("throttles"))
    return days, counts


def read_items(spark: SparkSession, pattern: str) -> DataFrame:
    """Catalogue items whose file bears its folder's name, features only."""
    rows = spark.read.option("multiLine", True).json(pattern).withColumn("file", F.input_file_name())
    stem, folder = F.regexp_extract("file", r"([^/]+)\.json$", 1), F.regexp_extract("file", r"([^/]+)/[^/]+$", 1)
    return rows.where((F.col("type") == "Feature") & (stem == folder)).drop("file")


def publishable(files: DataFrame, suffixes: tuple[str, ...]) -> DataFrame:
    """files (key), all of an allowed kind; any other refuses the whole list."""
    ok = F.lit(False)
    for s in suffixes:
        ok = ok | F.col("key").endswith(s)
    bad = files.where(~ok).head(1)
    if bad:
        raise ManifestError(f"{bad[0]['key']} is not of a kind that is published")
    return files


def tile_tokens(spark: SparkSession, text: str) -> DataFrame:
    """(tile_id) of a list with commas, spaces and # comments; refuses a bad name, one off the 5-degree grid, or a repeat."""
    words = spark.createDataFrame([(line.split("#")[0],) for line in text.splitlines()] or [("",)], "line string").select(F.explode(F.split(F.upper("line"), r"[,\s]+")).alias("tile_id")).where("tile_id <> ''")
    north, west = T.tile_corner(F.col("tile_id"))
    bad = words.where(~F.col("tile_id").rlike("^[NS]\\d{2}[EW]\\d{3}$")).head(1)
    if bad:
        raise ManifestError(f"{bad[0][0]} is no tile name")
    odd = words.where((F.pmod(north, F.lit(5)) != 0) | (F.pmod(west, F.lit(5)) != 0)).head(1) or words.groupBy("tile_id").count().where("count > 1").head(1)
    if odd:
        raise ManifestError(f"{odd[0][0]} is off the grid or given twice")
    return words


def rebuild_collection(items: DataFrame) -> DataFrame:
    """(collection, extent, interval, items): the collection derived from all of its items, never patched."""
    box = lambda i: F.col("bbox")[i]
    own = F.sort_array(F.collect_list("bbox"))
    stamp = F.col("properties.datetime")
    return items.groupBy("collection").agg(F.concat(F.array(F.array(F.min(box(0)), F.min(box(1)), F.max(box(2)), F.max(box(3)))), own).alias("extent"), F.array(F.min(stamp), F.max(stamp)).alias("interval"), F.count(F.lit(1)).alias("items"))


def refuse_clash(items: DataFrame) -> DataFrame:
    """items, unless one id has two boxes."""
    clash = items.groupBy("id").agg(F.count_distinct("bbox").alias("n")).where("n > 1").head(1)
    if clash:
        raise ManifestError(f"item {clash[0]['id']} has two boxes")
    return items

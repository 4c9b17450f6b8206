"""Accounts of runs and tiles: listings, coverage reports, threshold sweeps, claims, states and deadlines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thermaquilt.operators import fleet as E

QUANTILES = (1, 5, 25, 50, 75, 90, 95, 99)


def source_key(url: Column, modified: Column, etag: Column, length: int = 16) -> Column:
    """The identity of a source's version: a digest of its address, time and tag, so that versions never overwrite each other."""
    return F.substring(F.sha2(F.concat_ws("|", url, F.coalesce(modified, F.lit("")), F.coalesce(etag, F.lit(""))), 256), 1, length)


def by_ids(items: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The items of a list of ids; ids without an item are simply absent."""
    return items.join(ids.select(key).distinct(), key, "left_semi")


def clean_counts(value: Column, fill: int = -9999, most: int = 255) -> Column:
    """A count from a source grid: the fill is 0, the rest is held between 0 and `most`."""
    return F.least(F.greatest(F.when(value == fill, 0).otherwise(value), F.lit(0)), F.lit(most))


def tokens_of(lines: DataFrame, column: str) -> DataFrame:
    """(token): words of comma and blank separated lists in capitals; what follows a # is a comment."""
    bare = F.upper(F.regexp_replace(F.col(column), "#.*", ""))
    return lines.select(F.explode(F.split(bare, "[,\\s]+")).alias("token")).where("token <> ''")


def listing_totals(objects: DataFrame, prefix: str, depth: int) -> DataFrame:
    """(prefix, objects, bytes) by the first `depth` segments of the keys that begin with `prefix`, in order."""
    own = objects.where(F.col("key").startswith(prefix))
    rest = F.substring(F.col("key"), F.lit(len(prefix) + 1), F.length("key"))
    return own.groupBy(F.concat(F.lit(prefix), F.substring_index(rest, "/", depth)).alias("prefix")).agg(F.count(F.lit(1)).alias("objects"), F.sum("size").alias("bytes")).orderBy("prefix")


def scene_counts(plan: DataFrame) -> DataFrame:
    """(tile_id, scenes) in order of tile, from a plan document with an array `tiles` of (tile_id, scenes)."""
    return plan.select(F.explode("tiles").alias("t")).select("t.tile_id", "t.scenes").orderBy("tile_id")


def interval_union(items: DataFrame, by: str, start: str, end: str) -> DataFrame:
    """By collection: the earliest start and the latest end, with the number of intervals."""
    return items.groupBy(by).agg(F.min(start).alias("start"), F.max(end).alias("end"), F.count(F.lit(1)).alias("n"))


def centre_gaps(scenes: DataFrame, published: DataFrame, key: str) -> DataFrame:
    """One row: how far computed centres (start, stop) are from published times, in seconds, and how many have none.

    scenes: key, start, stop, sub_second; published: key, at. The worst gap is
    given for rows with and without a fraction of a second apart.
    """
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    centre = micros("start") + F.floor((micros("stop") - micros("start")) / 2)
    both = scenes.join(published.select(key, "at"), key, "left").withColumn("gap", (centre - micros("at")) / F.lit(1e6))
    there, size = F.col("at").isNotNull(), F.abs("gap")
    return both.agg(
        F.count_if(there).alias("compared"), F.count_if(~there).alias("not_found"), F.max(size).alias("worst"), F.median(size).alias("median"), F.avg("gap").alias("mean_signed"),
        F.count_if(there & F.col("sub_second")).alias("sub_second"), F.max(F.when(F.col("sub_second"), size)).alias("worst_sub_second"), F.max(F.when(~F.col("sub_second"), size)).alias("worst_whole_second"),
    )


def tile_claim(cells: DataFrame, top: int = 20) -> DataFrame:
    """The `top` tiles without thermal scenes by the share of their land cells with emissivity.

    cells: tile_id, thermal, land, covered, count; a row for each cell. Land without a granule has no emissivity.
    """
    land = F.col("land")
    rows = cells.groupBy("tile_id").agg(
        F.max("thermal").alias("thermal"), F.count_if(land).alias("land_cells"), F.count_if(land & F.col("covered")).alias("with_granule"), F.count_if(land & F.col("covered") & (F.col("count") > 0)).alias("with_emissivity")
    ).where("thermal = 0")
    share = F.coalesce(F.try_divide(F.col("with_emissivity").cast("double"), F.col("land_cells").cast("double")), F.lit(0.0))
    return rows.drop("thermal").withColumn("share", share).orderBy(F.desc("share"), "tile_id").limit(top)


def tile_coverage(pixels: DataFrame) -> DataFrame:
    """(tile_id, land, gap, gap_share): strict land of a tile and the part of it without emissivity; no land has no share.

    pixels: tile_id, strict (on land), gap.
    """
    rows = pixels.groupBy("tile_id").agg(F.count_if(F.col("strict")).alias("land"), F.count_if(F.col("strict") & F.col("gap")).alias("gap"))
    return rows.withColumn("gap_share", F.try_divide(F.col("gap").cast("double"), F.col("land").cast("double")))


def coverage_report(rows: DataFrame, low: float = 0.05, mid: float = 0.20, heavy: float = 0.40) -> DataFrame:
    """One row over tile_coverage's rows: tiles, those without land, shares under two limits, the upper median, and the land in tiles above `heavy`."""
    share, n = F.col("gap_share"), F.count("gap_share")
    ranked = rows.withColumn("_place", F.row_number().over(Window.partitionBy(F.isnull("gap_share")).orderBy("gap_share", "tile_id")) - 1).crossJoin(F.broadcast(rows.agg(F.floor(n / 2).alias("_middle"))))
    under = lambda limit: F.try_divide(F.count_if(share < limit).cast("double"), n.cast("double"))
    return ranked.agg(
        F.count(F.lit(1)).alias("tiles"), F.count_if(F.col("land") == 0).alias("bare"), under(low).alias("under_low"), under(mid).alias("under_mid"),
        F.max(F.when(share.isNotNull() & (F.col("_place") == F.col("_middle")), share)).alias("p50"), F.count_if(share > heavy).alias("heavy"),
        F.try_divide(F.sum(F.when(share > heavy, F.col("land")).otherwise(0)).cast("double"), F.sum("land").cast("double")).alias("heavy_land"),
    )


def water_summary(pixels: DataFrame, thresholds: tuple[float, ...]) -> DataFrame:
    """One row over pixels (water, clear, published): eight quantiles of depth and share, and for each threshold the pixels it takes and the published ones among them."""
    known = F.col("clear") > 0
    share = F.when(known, F.col("water").cast("double") / F.col("clear"))
    at = F.array(*[F.lit(q / 100) for q in QUANTILES])
    hits = []
    for i, t in enumerate(thresholds):
        hit = known & (share >= t)
        hits += [F.count_if(hit).alias(f"hit{i}"), F.count_if(hit & F.col("published")).alias(f"withdrawn{i}")]
    return pixels.agg(F.count(F.lit(1)).alias("pixels"), F.count_if(~known).alias("unobserved"), F.percentile(F.when(known, F.col("clear")), at).alias("depths"), F.percentile(share, at).alias("shares"), *hits)


def pooled_share(fallback: Column, retained: Column) -> Column:
    """The part of the retained pixels that took the pooled percentile; 0 where none is retained."""
    return F.coalesce(F.try_divide(fallback.cast("double"), retained.cast("double")), F.lit(0.0))


def reapable(instances: DataFrame, states: DataFrame, reaped: DataFrame) -> DataFrame:
    """Instances (tile, name, instance_id) whose tile has finished its upload and that are not reaped yet."""
    proven = states.where((F.col("status") == "finished") & (F.col("phase") == "uploaded")).select("tile").distinct()
    return instances.where("instance_id IS NOT NULL").join(proven, "tile", "left_semi").join(reaped.select("name").distinct(), "name", "left_anti")


def overdue(rows: DataFrame, now: Column, deadline: str) -> DataFrame:
    """Rows whose deadline has passed; none is no deadline."""
    return rows.where(F.col(deadline).isNotNull() & (now >= F.col(deadline)))


def poll_states(instances: DataFrame, markers: DataFrame, beats: DataFrame, manifests: DataFrame, alive: DataFrame, now: Column) -> DataFrame:
    """(tile, state) of every instance of a run: its last marker and heartbeat, whether its manifest is there, whether it lives.

    instances: tile, name, instance_id; markers: name, phase, rc, at; beats:
    name, at; manifests: name; alive: instance_id, alive. All are joined by their
    own key from the left, so an instance without any of them is starting.
    """
    last = E.latest_per_key(markers, "name", "at", "phase").select("name", "phase", "rc")
    beat = beats.groupBy("name").agg(F.max("at").alias("beat"))
    done = manifests.select("name", F.lit(True).alias("_done")).distinct()
    both = instances.join(last, "name", "left").join(beat, "name", "left").join(done, "name", "left").join(alive, "instance_id", "left")
    age = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("beat").cast("timestamp"))) / F.lit(60000000.0)
    return both.select("tile", E.run_state(F.col("phase"), F.col("rc"), age, F.col("alive"), F.coalesce("_done", F.lit(False))).alias("state"))


def progress(snapshots: DataFrame, now: Column, stale_minutes: float) -> DataFrame:
    """One row over snapshots (at, done, total): the first and last counts, the percentage, and whether the log is stale."""
    s = snapshots.agg(F.min_by("done", "at").alias("first"), F.max_by("done", "at").alias("last"), F.max_by("total", "at").alias("total"), F.max("at").alias("at"))
    minutes = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("at").cast("timestamp"))) / F.lit(60000000.0)
    return s.select("first", "last", "total", (F.lit(100.0) * F.try_divide(F.col("last").cast("double"), F.col("total").cast("double"))).alias("percent"), (minutes > stale_minutes).alias("stale"))

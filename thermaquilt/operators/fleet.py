"""Analytics over run logs, plans and prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thermaquilt import constants as K


def latest_per_key(rows: DataFrame, key: str, stamp: str, tie: str) -> DataFrame:
    """One row per key, the latest; of equal stamps the one with the least `tie`."""
    w = Window.partitionBy(key).orderBy(F.desc(stamp), tie)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def run_state(last_phase: Column, last_rc: Column, beat_age_minutes: Column, alive: Column, complete: Column, stall: float = K.STALL_MINUTES) -> Column:
    """State of a run by its last marker, heartbeat and liveness; unknown liveness (null) is not dead."""
    return (
        F.when(complete, "done")
        .when(last_rc != 0, F.concat(F.lit("failed:"), last_phase))
        .when(~F.coalesce(alive, F.lit(True)), "died")
        .when(last_phase.isNull(), "starting")
        .when(beat_age_minutes > stall, "stalled")
        .otherwise(F.concat(F.lit("running:"), last_phase))
    )


def trailing_rate(shots: DataFrame, key: str, stamp: str, done: str, minutes: int = K.RATE_WINDOW_MINUTES) -> DataFrame:
    """shots with rate_per_hour over the trailing window; the last two shots where it holds one only."""
    secs = F.col(stamp).cast("timestamp").cast("long")
    w = Window.partitionBy(key).orderBy("_t").rangeBetween(-minutes * 60, 0)
    prev = Window.partitionBy(key).orderBy("_t", done)
    s = shots.withColumn("_t", secs).withColumn("_n", F.count(F.lit(1)).over(w))
    t0 = F.when(F.col("_n") > 1, F.min("_t").over(w)).otherwise(F.lag("_t").over(prev))
    d0 = F.when(F.col("_n") > 1, F.min(done).over(w)).otherwise(F.lag(done).over(prev))
    hours = (F.col("_t") - t0) / 3600.0
    return s.withColumn("rate_per_hour", F.try_divide((F.col(done) - d0).cast("double"), hours)).drop("_t", "_n")


def eta(at: Column, done: Column, total: Column, per_hour: Column) -> Column:
    return F.timestamp_seconds(at.cast("timestamp").cast("long") + F.try_divide((total - done).cast("double"), per_hour) * 3600)


def run_lengths(rows: DataFrame, partition: str, order: list[str], value: str) -> DataFrame:
    """(partition, run, value, n, first): stretches of equal consecutive values."""
    w = Window.partitionBy(partition).orderBy(*order)
    marked = rows.withColumn("_new", F.coalesce((F.lag(value).over(w) != F.col(value)).cast("int"), F.lit(1)))
    return marked.withColumn("run", F.sum("_new").over(w)).groupBy(partition, "run").agg(F.first(value).alias(value), F.count(F.lit(1)).alias("n"), F.min(order[0]).alias("first"))


def project_cost(tiles: DataFrame, scenes: str, width: int) -> DataFrame:
    """Hours, price and wall time of all tiles; a tile of unknown depth counts as the mean of the known."""
    secs = F.sum(F.lit(K.COST_BASE) + F.lit(K.COST_PER_SCENE) * F.coalesce(F.col(scenes).cast("double"), F.col("_mean")))
    mean = tiles.agg(F.coalesce(F.avg(scenes), F.lit(0.0)).alias("_mean"))
    hours = secs / 3600
    # The mean is one row.
    return tiles.crossJoin(F.broadcast(mean)).agg(F.count(F.lit(1)).alias("tiles"), hours.alias("hours"), (hours * K.COST_RATE_HOUR).alias("price"), (hours / width).alias("wall_hours"))


def snapshot_total(snapshots: DataFrame, instance: str, seconds: str, kind: str, rates: DataFrame) -> DataFrame:
    """Price from overlapping snapshots: the most seconds of each instance, by its type's hourly rate."""
    return snapshots.groupBy(instance, kind).agg(F.max(seconds).alias("s")).join(rates, kind).agg(F.sum(F.col("s") / 3600.0 * F.col("rate")).alias("price"), F.count(F.lit(1)).alias("instances"))


def cost_by_type(rows: DataFrame, kind: str, seconds: str, rates: DataFrame) -> DataFrame:
    """(kind, hours, price): a type without a rate has a null price, not 0."""
    return rows.groupBy(kind).agg((F.sum(seconds) / 3600.0).alias("hours")).join(rates, kind, "left").select(kind, "hours", (F.col("hours") * F.col("rate")).alias("price"))


def peaks(samples: DataFrame, series: str, stamp: str, counter: str, lo: Column, hi: Column) -> DataFrame:
    """By series: extremes, first-to-last change and fastest step of a counter between two times."""
    s = samples.where(F.col(stamp).between(lo, hi))
    w = Window.partitionBy(series).orderBy(stamp)
    step = F.try_divide((F.col(counter) - F.lag(counter).over(w)).cast("double"), (F.col(stamp).cast("double") - F.lag(stamp).over(w).cast("double")))
    return s.withColumn("_r", step).groupBy(series).agg(F.max(counter).alias("peak"), F.min(counter).alias("low"), F.count(F.lit(1)).alias("n"), (F.max_by(counter, stamp) - F.min_by(counter, stamp)).alias("change"), F.max("_r").alias("fastest"))


def settle_uploads(statuses: DataFrame, now: Column, grace: int = K.UPLOAD_GRACE_MINUTES) -> DataFrame:
    """statuses (tile, at, phase) in their current phase; `uploading` for longer than the grace becomes `upload_lost`.

    `since` is the first time after the last other phase. Two sums by tile, no
    list of a tile's history.
    """
    last = statuses.groupBy("tile").agg(F.max_by("phase", "at").alias("_last"))
    own = statuses.join(last, "tile")
    changed = own.groupBy("tile", "_last").agg(F.max(F.when(F.col("phase") != F.col("_last"), F.col("at"))).alias("_o"))
    since = statuses.join(changed, "tile").where(F.col("_o").isNull() | (F.col("at") > F.col("_o"))).groupBy("tile", "_last").agg(F.min("at").alias("since"))
    minutes = (now.cast("timestamp").cast("double") - F.col("since").cast("timestamp").cast("double")) / 60
    return since.select("tile", F.when((F.col("_last") == "uploading") & (minutes > grace), "upload_lost").otherwise(F.col("_last")).alias("state"), "since")


def sort_wave(batch: DataFrame, retries: int) -> DataFrame:
    """batch (tile, status, attempts) with its fate: settled, requeue or given_up."""
    return batch.withColumn("fate", F.when(F.col("status") == "done", "settled").when(F.col("attempts") < retries, "requeue").otherwise("given_up"))


def room(width: Column, ceiling: Column, live: Column, hold: Column) -> Column:
    """Places free for new instances; none while a hold lasts."""
    return F.when(hold, F.lit(0)).otherwise(F.greatest(F.least(width, F.coalesce(ceiling, width)) - live, F.lit(0)))


def retire(states: DataFrame, elapsed: Column, timeout: float, retries: int) -> DataFrame:
    """states with their verdict: keep, finished, retry or fail."""
    over = elapsed > timeout
    return states.withColumn("verdict", F.when(F.col("state") == "done", "finished").when(F.col("state").startswith("failed") | over | (F.col("state") == "died"), F.when(F.col("attempts") < retries, "retry").otherwise("fail")).otherwise("keep"))


def classify_tiles(tiles: DataFrame, counts: DataFrame) -> DataFrame:
    """(tile_id, scenes, thermal, class): runnable, no_thermal or no_scenes."""
    j = tiles.join(counts, "tile_id", "left").select("tile_id", F.coalesce("scenes", F.lit(0)).alias("scenes"), F.coalesce("thermal", F.lit(0)).alias("thermal"))
    return j.withColumn("class", F.when(F.col("scenes") == 0, "no_scenes").when(F.col("thermal") == 0, "no_thermal").otherwise("runnable"))


def span_summary(spans: DataFrame, name: str, ms: str, top: int = 20) -> DataFrame:
    """The `top` names by total time."""
    return spans.groupBy(name).agg(F.count(F.lit(1)).alias("n"), F.sum(ms).alias("total"), F.avg(ms).alias("mean"), F.max(ms).alias("longest")).orderBy(F.desc("total"), name).limit(top)


def extent_union(items: DataFrame, by: str, box: list[str]) -> DataFrame:
    """Union box of each collection."""
    return items.groupBy(by).agg(F.min(box[0]).alias("west"), F.min(box[1]).alias("south"), F.max(box[2]).alias("east"), F.max(box[3]).alias("north"), F.count(F.lit(1)).alias("items"))


def render_range(bands: DataFrame, by: str) -> DataFrame:
    """Least and largest value over bands with valid pixels; the encodable range where there are none."""
    some = F.col("valid_percent") > 0
    return bands.groupBy(by).agg(F.coalesce(F.min(F.when(some, F.col("min"))), F.lit(K.ENCODE_ZERO)).alias("low"), F.coalesce(F.max(F.when(some, F.col("max"))), F.lit(K.LAST_DN * K.ENCODE_STEP + K.ENCODE_ZERO)).alias("high"))

"""Aggregations: climatologies, histograms, percentiles, waterfalls, censuses, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thermaquilt import constants as K
from thermaquilt.functions import quality as Q


def count_if(**flags: Column) -> list[Column]:
    return [F.count_if(c).alias(k) for k, c in flags.items()]


def month_climatology(valid: DataFrame) -> DataFrame:
    """(y, x, month, ref): median of a pixel's month over all years."""
    return valid.groupBy("y", "x", "month").agg(F.median("c").alias("ref"))


def anomaly_histogram(valid: DataFrame, reference: DataFrame) -> DataFrame:
    """(scene_id, bin, n): differences from the pixel's own month, in bins of one output step; sums of parts are the whole."""
    bin_of = F.least(F.greatest(F.floor((F.col("c") - F.col("ref") - F.lit(K.ANOMALY_LOW)) / F.lit(K.ANOMALY_STEP)), F.lit(0)), F.lit(K.ANOMALY_BINS - 1))
    return valid.join(reference, ["y", "x", "month"]).groupBy("scene_id", bin_of.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def offsets_from_histogram(hist: DataFrame) -> DataFrame:
    """(scene_id, offset, n_valid): the median of each scene's histogram, the mean of the two middle ones if even."""
    w = Window.partitionBy("scene_id").orderBy("bin")
    h = hist.withColumn("cum", F.sum("n").over(w)).withColumn("total", F.sum("n").over(Window.partitionBy("scene_id")))
    centre = F.lit(K.ANOMALY_LOW) + (F.col("bin") + 0.5) * F.lit(K.ANOMALY_STEP)
    low = F.min(F.when(F.col("cum") >= F.floor((F.col("total") + 1) / 2), centre))
    high = F.min(F.when(F.col("cum") >= F.floor(F.col("total") / 2) + 1, centre))
    return h.groupBy("scene_id").agg(((low + high) / 2).alias("offset"), F.max("total").alias("n_valid"))


def exact_offsets(valid: DataFrame, reference: DataFrame) -> DataFrame:
    """(scene_id, offset, n_valid) by the exact median of the differences."""
    return valid.join(reference, ["y", "x", "month"]).groupBy("scene_id").agg(F.median(F.col("c") - F.col("ref")).alias("offset"), F.count(F.lit(1)).alias("n_valid"))


def offset_diagnostics(offsets: DataFrame, kept: str = "keep") -> DataFrame:
    o = F.when(F.col(kept), F.col("offset"))
    p = F.percentile(o, F.array(F.lit(0.01), F.lit(0.5), F.lit(0.99)))
    return offsets.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(kept)).alias("kept"), (F.count_if(~F.col(kept)) / F.count(F.lit(1))).alias("rejected_share"), F.stddev_pop(o).alias("std"), F.min(o).alias("min"), F.max(o).alias("max"), p[0].alias("p01"), p[1].alias("p50"), p[2].alias("p99"))


def percentile95(c: Column) -> Column:
    """Exact percentile with linear interpolation over values that are not null."""
    return F.percentile(c, F.lit(K.PERCENTILE))


def band_statistics(rows: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """min, max, mean, population std, kept and total; zeros where nothing is valid."""
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    aggs = [zero(F.min(value).cast("double")).alias("min"), zero(F.max(value).cast("double")).alias("max"), zero(F.avg(value)).alias("mean"), zero(F.stddev_pop(value)).alias("std"), F.count(value).alias("kept"), F.count(F.lit(1)).alias("total")]
    return rows.groupBy(*by).agg(*aggs) if by else rows.agg(*aggs)


def rejection_waterfall(obs: DataFrame, dn: str = "dn", qa: str = "qa") -> DataFrame:
    """Counts of what each rule rejects after those before it, and of each excluded bit by itself."""
    d, q = F.col(dn), F.col(qa)
    c = Q.to_celsius(d)
    fill, bad = ~Q.not_fill(d), ~Q.qa_clear(q)
    low, high = c < K.OBSERVED_RANGE[0], c > K.OBSERVED_RANGE[1]
    flags = {"total": F.lit(True), "fill": fill, "qa": ~fill & bad, "too_low": ~fill & ~bad & low, "too_high": ~fill & ~bad & high, "accepted": Q.valid_observation(d, q, c)}
    flags |= {f"bit{b}": Q.qa_bit(q, b) & ~fill for b in K.EXCLUDED_BITS}
    return obs.agg(*count_if(**flags))


def share_histogram(shares: DataFrame, share: str, width: float, by: DataFrame) -> DataFrame:
    """(bin, n) over [0, 1], the last bin closed; `by` has every bin, so empty ones are 0."""
    last = round(1 / width) - 1
    found = shares.where(F.col(share).isNotNull()).groupBy(F.least(F.floor(F.col(share) / width + 1e-9), F.lit(last)).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return by.join(found, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


def tier_of(count: Column, most: int = 3) -> Column:
    return F.least(count, F.lit(most + 1))


def tier_crosstab(pixels: DataFrame, count: str, valid: Column, seen: Column) -> DataFrame:
    t = pixels.groupBy(tier_of(F.col(count)).alias("tier")).agg(F.count(F.lit(1)).alias("pixels"), *count_if(valid=valid, missing=~valid, seen=seen))
    return t.withColumn("missing_share", F.try_divide(F.col("missing").cast("double"), F.col("pixels").cast("double")))


def temperature_census(pixels: DataFrame, tier: str, c: str, hot: float) -> DataFrame:
    """Per tier: n, percentiles, the hot pixels' rate, its enrichment over all tiers and the tier's share of the hot."""
    p = F.percentile(c, F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99)))
    t = pixels.where(F.col(c).isNotNull()).groupBy(tier).agg(F.count(F.lit(1)).alias("n"), p[0].alias("p50"), p[1].alias("p95"), p[2].alias("p99"), F.max(c).alias("max"), F.count_if(F.col(c) > hot).alias("hot"))
    everything = Window.partitionBy()  # a row per tier
    rate, all_rate = F.col("hot") / F.col("n"), F.sum("hot").over(everything) / F.sum("n").over(everything)
    return t.withColumn("rate", rate).withColumn("enrichment", F.try_divide(rate, all_rate)).withColumn("tail_share", F.try_divide(F.col("hot").cast("double"), F.sum("hot").over(everything).cast("double")))


def rule_pricing(pixels: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, pixels): all rules counted in one pass, then turned to rows."""
    one = pixels.agg(*count_if(**rules))
    return one.select(F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), F.col(k).alias("pixels")) for k in rules])).alias("r")).select("r.rule", "r.pixels")


def two_level_cells(pixels: DataFrame, factor: int, flag: str) -> DataFrame:
    """Cells, those with the flag anywhere, and those with it everywhere."""
    cells = pixels.groupBy(F.floor(F.col("y") / factor), F.floor(F.col("x") / factor)).agg(F.count_if(F.col(flag)).alias("k"), F.count(F.lit(1)).alias("n"))
    return cells.agg(F.count(F.lit(1)).alias("cells"), F.count_if(F.col("k") > 0).alias("touched"), F.count_if(F.col("k") == F.col("n")).alias("full"))


def compare_encodings(pairs: DataFrame, old: str, new: str) -> DataFrame:
    """How two encoded outputs differ, pixel by pixel."""
    d = F.when((F.col(old) > 0) & (F.col(new) > 0), (F.col(new) - F.col(old)) * F.lit(K.ENCODE_STEP))
    p = F.percentile(d, F.array(F.lit(0.05), F.lit(0.5), F.lit(0.95)))
    return pairs.agg(F.count(F.lit(1)).alias("n"), *count_if(gained=(F.col(old) == 0) & (F.col(new) > 0), lost=(F.col(old) > 0) & (F.col(new) == 0), changed=(F.col(old) != F.col(new)) & (F.col(old) > 0) & (F.col(new) > 0)), p[0].alias("p05"), p[1].alias("p50"), p[2].alias("p95"))

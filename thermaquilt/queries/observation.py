"""Rules, censuses and statistics over observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermaquilt.functions import quality as Q
from thermaquilt.operators import aggregates as A
from thermaquilt.plans import composite as P
from thermaquilt.queries import query
from thermaquilt.sources.mapping import CELLS_SQL, FOOTPRINT_SQL, LAND_SQL, OBS_SQL, cells, footprint, land, observations, table


@query(f"WITH {OBS_SQL} SELECT scene_id, x, y, dn, qa, round(c, 6) AS c, (qa & 128) <> 0 AS water FROM valid")
def qa_decode_valid(spark: SparkSession, d: str) -> DataFrame:
    v = P.valid_observations(observations(spark, d))
    return v.select("scene_id", "x", "y", "dn", "qa", F.round("c", 6).alias("c"), Q.qa_water(F.col("qa")).alias("water"))


@query(f"""WITH {OBS_SQL} SELECT scene_id, x, y, dn,
  CASE WHEN dn <> 0 AND (qa & 62) = 0 AND c BETWEEN -50 AND 80 THEN round(c, 6) END AS c,
  CASE WHEN dn <> 0 AND (qa & 24) = 0 THEN round(c, 6) END AS legacy_c,
  CAST(CASE WHEN round_even((c+50)/CAST(0.01 AS DOUBLE), 0) BETWEEN 2 AND 65535 THEN round_even((c+50)/CAST(0.01 AS DOUBLE), 0) ELSE 0 END AS INTEGER) AS encoded,
  CAST(CASE WHEN round_even((c+50)/CAST(0.01 AS DOUBLE), 0) BETWEEN 1 AND 65535 THEN round_even((c+50)/CAST(0.01 AS DOUBLE), 0) ELSE 0 END AS INTEGER) AS legacy_encoded FROM dec""")
def masked_and_encoded(spark: SparkSession, d: str) -> DataFrame:
    o, c = observations(spark, d), Q.to_celsius(F.col("dn"))
    return o.select("scene_id", "x", "y", "dn", F.round(Q.masked_celsius(F.col("dn"), F.col("qa")), 6).alias("c"), F.round(Q.legacy_masked_celsius(F.col("dn"), F.col("qa")), 6).alias("legacy_c"), Q.encode_celsius(c).alias("encoded"), Q.legacy_encode(c).alias("legacy_encoded"))


@query(f"""WITH {OBS_SQL} SELECT count(*) AS total, count(*) FILTER (dn = 0) AS fill, count(*) FILTER (dn <> 0 AND (qa & 62) <> 0) AS qa,
  count(*) FILTER (dn <> 0 AND (qa & 62) = 0 AND c < -50) AS too_low, count(*) FILTER (dn <> 0 AND (qa & 62) = 0 AND c > 80) AS too_high,
  count(*) FILTER (dn <> 0 AND (qa & 62) = 0 AND c BETWEEN -50 AND 80) AS accepted,
  count(*) FILTER (dn <> 0 AND (qa & 2) <> 0) AS bit1, count(*) FILTER (dn <> 0 AND (qa & 4) <> 0) AS bit2, count(*) FILTER (dn <> 0 AND (qa & 8) <> 0) AS bit3,
  count(*) FILTER (dn <> 0 AND (qa & 16) <> 0) AS bit4, count(*) FILTER (dn <> 0 AND (qa & 32) <> 0) AS bit5 FROM dec""")
def rejection_waterfall(spark: SparkSession, d: str) -> DataFrame:
    return A.rejection_waterfall(observations(spark, d))


@query(f"WITH {OBS_SQL} SELECT b AS bit, count(*) FILTER ((qa & (1 << b)) <> 0) AS n FROM dec, range(0, 8) t(b) GROUP BY b")
def qa_bits_census(spark: SparkSession, d: str) -> DataFrame:
    one = observations(spark, d).agg(*[F.count_if(Q.qa_bit(F.col("qa"), b)).alias(f"b{b}") for b in range(8)])
    return one.select(F.posexplode(F.array(*[f"b{b}" for b in range(8)])).alias("bit", "n")).select(F.col("bit").cast("long").alias("bit"), "n")


@query(f"""WITH {OBS_SQL},
  a AS (SELECT y, x, quantile_cont(c, 0.95) AS p, count(*) AS n FROM valid GROUP BY y, x),
  b AS (SELECT y, x, quantile_cont(c, 0.95) AS p FROM dec WHERE dn <> 0 AND (qa & 24) = 0 GROUP BY y, x),
  e AS (SELECT b.y, b.x, CAST(round_even((b.p+50)/0.01::DOUBLE, 0) AS INTEGER) AS old_dn, coalesce(CAST(CASE WHEN a.n >= 5 THEN round_even((a.p+50)/0.01::DOUBLE, 0) END AS INTEGER), 0) AS new_dn FROM b LEFT JOIN a USING (y, x)),
  f AS (SELECT *, CASE WHEN old_dn > 0 AND new_dn > 0 THEN (new_dn - old_dn)*0.01::DOUBLE END AS d FROM e)
  SELECT count(*) AS n, count(*) FILTER (old_dn = 0 AND new_dn > 0) AS gained, count(*) FILTER (old_dn > 0 AND new_dn = 0) AS lost, count(*) FILTER (old_dn <> new_dn AND old_dn > 0 AND new_dn > 0) AS changed,
    round(quantile_cont(d, 0.05), 6) AS p05, round(quantile_cont(d, 0.5), 6) AS p50, round(quantile_cont(d, 0.95), 6) AS p95 FROM f""")
def legacy_vs_current_mask(spark: SparkSession, d: str) -> DataFrame:
    o = observations(spark, d)
    new = P.valid_observations(o).groupBy("y", "x").agg(A.percentile95(F.col("c")).alias("p"), F.count(F.lit(1)).alias("n")).select("y", "x", F.when(F.col("n") >= 5, Q.encode_celsius(F.col("p"))).alias("new_dn"))
    old = o.withColumn("c", Q.legacy_masked_celsius(F.col("dn"), F.col("qa"))).where("c is not null").groupBy("y", "x").agg(Q.legacy_encode(A.percentile95(F.col("c"))).alias("old_dn"))
    out = A.compare_encodings(old.join(new, ["y", "x"], "left").na.fill(0, ["new_dn"]), "old_dn", "new_dn")
    return out.select("n", "gained", "lost", "changed", *[F.round(c, 6).alias(c) for c in ("p05", "p50", "p95")])


@query(f"WITH {OBS_SQL} SELECT y, x, month, round(median(c), 6) AS ref FROM valid GROUP BY y, x, month")
def month_climatology(spark: SparkSession, d: str) -> DataFrame:
    return A.month_climatology(P.valid_observations(observations(spark, d))).withColumn("ref", F.round("ref", 6))


_REF = "ref AS (SELECT y, x, month, median(c) AS ref FROM valid GROUP BY y, x, month)"
_HIST = """hist AS (SELECT scene_id, CAST(least(greatest(floor((c - ref + 130)/0.01::DOUBLE), 0), 25999) AS INTEGER) AS bin, count(*) AS n FROM valid JOIN ref USING (y, x, month) GROUP BY 1, 2)"""
_OFF = "off AS (SELECT scene_id, median(c - ref) AS o, count(*) AS n_valid FROM valid JOIN ref USING (y, x, month) GROUP BY scene_id)"


@query(f"WITH {OBS_SQL}, {_REF}, {_HIST} SELECT * FROM hist")
def scene_anomaly_histogram(spark: SparkSession, d: str) -> DataFrame:
    v = P.valid_observations(observations(spark, d))
    return A.anomaly_histogram(v, A.month_climatology(v))


@query(f"WITH {OBS_SQL}, {_REF}, {_OFF} SELECT scene_id, round(o, 6) AS offset, n_valid FROM off".replace("AS offset", 'AS "offset"'))
def scene_offsets_exact(spark: SparkSession, d: str) -> DataFrame:
    v = P.valid_observations(observations(spark, d))
    return A.exact_offsets(v, A.month_climatology(v)).withColumn("offset", F.round("offset", 6))


@query(f"""WITH {OBS_SQL}, {_REF}, {_HIST},
  h AS (SELECT *, sum(n) OVER (PARTITION BY scene_id ORDER BY bin) AS cum, sum(n) OVER (PARTITION BY scene_id) AS total FROM hist)
  SELECT scene_id, round((min(-130 + (bin + 0.5::DOUBLE)*0.01::DOUBLE) FILTER (cum >= (total + 1)//2) + min(-130 + (bin + 0.5::DOUBLE)*0.01::DOUBLE) FILTER (cum >= total//2 + 1))/2, 6) AS "offset", CAST(max(total) AS BIGINT) AS n_valid
  FROM h GROUP BY scene_id""")
def scene_offsets_histogram(spark: SparkSession, d: str) -> DataFrame:
    v = P.valid_observations(observations(spark, d))
    return A.offsets_from_histogram(A.anomaly_histogram(v, A.month_climatology(v))).withColumn("offset", F.round("offset", 6))


@query(f"""WITH {OBS_SQL}, {_REF}, {_OFF} SELECT scene_id, coalesce(n_valid >= 10 AND abs(o) <= 2, false) AS keep, n_valid FROM off""")
def keep_mask(spark: SparkSession, d: str) -> DataFrame:
    return P.prep_offsets(P.valid_observations(observations(spark, d)), floor=10, cap=2.0).select("scene_id", "keep", "n_valid")


@query(f"""WITH {OBS_SQL}, {_REF}, {_OFF}, k AS (SELECT *, n_valid >= 10 AND abs(o) <= 15 AS keep FROM off), g AS (SELECT keep, CASE WHEN keep THEN o END AS o FROM k)
  SELECT count(*) AS n, count(*) FILTER (keep) AS kept, round(count(*) FILTER (NOT keep)::DOUBLE/count(*), 6) AS rejected_share, round(stddev_pop(o), 6) AS std, round(min(o), 6) AS min, round(max(o), 6) AS max,
   round(quantile_cont(o, 0.01), 6) AS p01, round(quantile_cont(o, 0.5), 6) AS p50, round(quantile_cont(o, 0.99), 6) AS p99 FROM g""")
def offset_diagnostics(spark: SparkSession, d: str) -> DataFrame:
    out = A.offset_diagnostics(P.prep_offsets(P.valid_observations(observations(spark, d)), floor=10))
    return out.select("n", "kept", *[F.round(c, 6).alias(c) for c in ("rejected_share", "std", "min", "max", "p01", "p50", "p99")])


@query(f"""WITH {OBS_SQL} SELECT wrs_path, round(min(c), 6) AS min, round(max(c), 6) AS max, round(avg(c), 6) AS mean, round(stddev_pop(c), 5) AS std, count(c) AS kept, count(*) AS total
  FROM (SELECT wrs_path, CASE WHEN dn <> 0 AND (qa & 62) = 0 AND c BETWEEN -50 AND 80 THEN c END AS c FROM dec) GROUP BY wrs_path""")
def band_statistics(spark: SparkSession, d: str) -> DataFrame:
    o = observations(spark, d).withColumn("c", Q.masked_celsius(F.col("dn"), F.col("qa")))
    return A.band_statistics(o, "c", ["wrs_path"]).select("wrs_path", *[F.round(c, 6).alias(c) for c in ("min", "max", "mean")], F.round("std", 5).alias("std"), "kept", "total")


_PX = "px AS (SELECT y, x, count(*) AS clear, count(*) FILTER ((qa & 128) <> 0) AS water, quantile_cont(c, 0.95) AS p FROM valid GROUP BY y, x)"


def _pixels(spark: SparkSession, d: str) -> DataFrame:
    return P.valid_observations(observations(spark, d)).groupBy("y", "x").agg(F.count(F.lit(1)).alias("clear"), F.count_if(Q.qa_water(F.col("qa"))).alias("water"), A.percentile95(F.col("c")).alias("p"))


@query(f"WITH {OBS_SQL}, {_PX}, s AS (SELECT CAST(least(floor(water::DOUBLE/clear/0.05::DOUBLE + 1e-9), 19) AS BIGINT) AS bin FROM px) SELECT b AS bin, count(s.bin) AS n FROM range(0, 20) t(b) LEFT JOIN s ON s.bin = b GROUP BY b")
def water_share_histogram(spark: SparkSession, d: str) -> DataFrame:
    shares = _pixels(spark, d).withColumn("share", Q.share_of(F.col("water"), F.col("clear")))
    bins = spark.range(20).select(F.col("id").cast("int").alias("bin"))
    return A.share_histogram(shares, "share", 0.05, bins).select(F.col("bin").cast("long").alias("bin"), "n")


@query(f"""WITH {OBS_SQL}, {_PX} SELECT CAST(least(floor(water::DOUBLE/clear*4), 3) AS BIGINT) AS band, count(*) AS n, round(quantile_cont(p, 0.25), 6) AS p25, round(quantile_cont(p, 0.5), 6) AS p50, round(quantile_cont(p, 0.75), 6) AS p75 FROM px GROUP BY 1""")
def temperature_by_share_band(spark: SparkSession, d: str) -> DataFrame:
    band = F.least(F.floor(Q.share_of(F.col("water"), F.col("clear")) * 4), F.lit(3)).cast("long").alias("band")
    q = F.percentile("p", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return _pixels(spark, d).groupBy(band).agg(F.count(F.lit(1)).alias("n"), *[F.round(q[i], 6).alias(f"p{n}") for i, n in enumerate((25, 50, 75))])


@query(f"""WITH {OBS_SQL}, {_PX}, {CELLS_SQL}, t AS (SELECT least(count, 4) AS tier, px.*, clear >= 5 AS ok FROM px JOIN cells ON row = y AND col = x//5)
  SELECT tier, count(*) AS pixels, count(*) FILTER (ok) AS valid, count(*) FILTER (NOT ok) AS missing, count(*) FILTER (clear > 0) AS seen, round(count(*) FILTER (NOT ok)::DOUBLE/count(*), 6) AS missing_share FROM t GROUP BY tier""")
def tier_crosstab(spark: SparkSession, d: str) -> DataFrame:
    px = _pixels(spark, d).withColumn("row", F.col("y")).withColumn("col", F.floor(F.col("x") / 5).cast("int")).join(cells(spark, d), ["row", "col"])
    return A.tier_crosstab(px, "count", F.col("clear") >= 5, F.col("clear") > 0).withColumn("missing_share", F.round("missing_share", 6))


@query(f"""WITH {OBS_SQL}, {_PX}, {CELLS_SQL}, t AS (SELECT count AS tier, p FROM px JOIN cells ON row = y AND col = x//5),
  g AS (SELECT tier, count(*) AS n, quantile_cont(p, 0.5) AS p50, quantile_cont(p, 0.95) AS p95, quantile_cont(p, 0.99) AS p99, max(p) AS max, count(*) FILTER (p > 45) AS hot FROM t GROUP BY tier)
  SELECT tier, n, round(p50, 6) AS p50, round(p95, 6) AS p95, round(p99, 6) AS p99, round(max, 6) AS max, hot, round(hot/n, 6) AS rate, round((hot/n)/(sum(hot) OVER ()/sum(n) OVER ()), 6) AS enrichment, round(hot/sum(hot) OVER (), 6) AS tail_share FROM g""")
def temperature_census(spark: SparkSession, d: str) -> DataFrame:
    px = _pixels(spark, d).withColumn("row", F.col("y")).withColumn("col", F.floor(F.col("x") / 5).cast("int")).join(cells(spark, d), ["row", "col"]).withColumnRenamed("count", "tier")
    out = A.temperature_census(px, "tier", "p", 45.0)
    return out.select("tier", "n", *[F.round(c, 6).alias(c) for c in ("p50", "p95", "p99", "max")], "hot", *[F.round(c, 6).alias(c) for c in ("rate", "enrichment", "tail_share")])


@query(f"""WITH {OBS_SQL}, {_PX} SELECT 'depth' AS rule, count(*) FILTER (clear < 100) AS pixels FROM px UNION ALL SELECT 'water', count(*) FILTER (water >= 0.9::DOUBLE*clear) FROM px
  UNION ALL SELECT 'water_cool', count(*) FILTER (water >= 0.9::DOUBLE*clear AND NOT p > 34) FROM px UNION ALL SELECT 'sea', count(*) FILTER (NOT {LAND_SQL}) FROM px UNION ALL SELECT 'hot', count(*) FILTER (p > 45) FROM px
  UNION ALL SELECT 'any', count(*) FILTER (clear < 100 OR p > 45 OR NOT {LAND_SQL}) FROM px""")
def rule_pricing(spark: SparkSession, d: str) -> DataFrame:
    shallow, wet, hot = F.col("clear") < 100, F.col("water") >= F.lit(0.9) * F.col("clear"), F.col("p") > 45
    return A.rule_pricing(_pixels(spark, d), {"depth": shallow, "water": wet, "water_cool": Q.observed_water(F.col("water"), F.col("clear"), F.col("p")), "sea": ~land(), "hot": hot, "any": shallow | hot | ~land()})


@query(f"""WITH {OBS_SQL}, {_PX}, c AS (SELECT y//2 AS r, x//5 AS k, count(*) FILTER (clear < 110) AS k1, count(*) AS n FROM px GROUP BY 1, 2)
  SELECT count(*) AS cells, count(*) FILTER (k1 > 0) AS touched, count(*) FILTER (k1 = n) AS "full" FROM c""")
def gap_cell_census(spark: SparkSession, d: str) -> DataFrame:
    px = _pixels(spark, d).withColumn("shallow", F.col("clear") < 110)
    cell = px.groupBy(F.floor(F.col("y") / 2), F.floor(F.col("x") / 5)).agg(F.count_if("shallow").alias("k"), F.count(F.lit(1)).alias("n"))
    return cell.agg(F.count(F.lit(1)).alias("cells"), F.count_if(F.col("k") > 0).alias("touched"), F.count_if(F.col("k") == F.col("n")).alias("full"))


@query(f"""WITH {OBS_SQL}, o AS (SELECT scene_id, median(c) AS o FROM valid WHERE x < 25 GROUP BY 1), p AS (SELECT scene_id, median(c) AS p FROM valid WHERE x >= 25 GROUP BY 1)
  SELECT scene_id, round(abs(o - p), 6) AS diff FROM o JOIN p USING (scene_id) ORDER BY abs(o - p) DESC, scene_id LIMIT 5""")
def adjacent_seam_compare(spark: SparkSession, d: str) -> DataFrame:
    v = P.valid_observations(observations(spark, d))
    side = lambda keep, n: v.where(keep).groupBy("scene_id").agg(F.median("c").alias(n))
    both = side(F.col("x") < 25, "o").join(side(F.col("x") >= 25, "p"), "scene_id")
    return both.withColumn("d", F.abs(F.col("o") - F.col("p"))).orderBy(F.desc("d"), "scene_id").limit(5).select("scene_id", F.round("d", 6).alias("diff"))


@query(f"""WITH {OBS_SQL} SELECT scene_id, any_value(month) AS month, any_value(wrs_path) AS wrs_path, any_value(wrs_row) AS wrs_row, count(*) AS n FROM obs GROUP BY scene_id""")
def scene_inventory_sorted(spark: SparkSession, d: str) -> DataFrame:
    return observations(spark, d).groupBy("scene_id").agg(*[F.first(c).alias(c) for c in ("month", "wrs_path", "wrs_row")], F.count(F.lit(1)).alias("n")).orderBy("wrs_path", "scene_id")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0 ORDER BY (o_orderkey*7919 + 13) % 10007, o_orderkey LIMIT 100")
def hash_sample_n(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").where("o_orderkey % 3 = 0")
    return o.orderBy((F.col("o_orderkey") * 7919 + 13) % 10007, "o_orderkey").limit(100).select("o_orderkey")


@query(f"""WITH {OBS_SQL}, c AS (SELECT wrs_path, wrs_row, y//4 AS row, x//5 AS col, count(DISTINCT scene_id) AS n FROM valid WHERE {FOOTPRINT_SQL} GROUP BY ALL),
  q AS (SELECT wrs_path, wrs_row, count(DISTINCT scene_id) AS scenes FROM valid WHERE {FOOTPRINT_SQL} GROUP BY ALL)
  SELECT wrs_path, wrs_row, row, col, n, scenes FROM c JOIN q USING (wrs_path, wrs_row)""")
def quad_coverage(spark: SparkSession, d: str) -> DataFrame:
    v = P.valid_observations(observations(spark, d), footprint())
    cell = v.groupBy("wrs_path", "wrs_row", F.floor(F.col("y") / 4).cast("int").alias("row"), F.floor(F.col("x") / 5).cast("int").alias("col")).agg(F.count_distinct("scene_id").alias("n"))
    return cell.join(v.groupBy("wrs_path", "wrs_row").agg(F.count_distinct("scene_id").alias("scenes")), ["wrs_path", "wrs_row"])


@query(f"""WITH {OBS_SQL}, s AS (SELECT DISTINCT scene_id, wrs_path FROM obs), w AS (SELECT DISTINCT wrs_path FROM valid WHERE {FOOTPRINT_SQL} AND x < 20)
  SELECT wrs_path, count(*) AS scenes FROM s WHERE wrs_path NOT IN (SELECT wrs_path FROM w) GROUP BY wrs_path""")
def paths_without_swath(spark: SparkSession, d: str) -> DataFrame:
    o = observations(spark, d)
    swaths = P.valid_observations(o, footprint() & (F.col("x") < 20)).select("wrs_path").distinct()
    return o.select("scene_id", "wrs_path").distinct().join(swaths, "wrs_path", "left_anti").groupBy("wrs_path").agg(F.count(F.lit(1)).alias("scenes"))



"""Percentile composites from the minimum to the whole product."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermaquilt.functions import quality as Q
from thermaquilt.operators import aggregates as A
from thermaquilt.operators import grid as G
from thermaquilt.operators import masks as M
from thermaquilt.plans import composite as P
from thermaquilt.queries import query
from thermaquilt.queries.observation import _OFF, _REF
from thermaquilt.sources.mapping import FOOTPRINT_SQL, LAND_SQL, OBS_SQL, footprint, land, observations

#: Shape of the coarse swath grid, its cells in pixels, and the scene floor that suits tables of this size.
SHAPE, FACTOR, FLOOR = (2, 10), (4, 5), 5

_ENC = "CAST(CASE WHEN round_even((p95+50)/0.01::DOUBLE, 0) BETWEEN 2 AND 65535 THEN round_even((p95+50)/0.01::DOUBLE, 0) ELSE 0 END AS INTEGER)"
_MONTHS = ", ".join(f"least(count(*) FILTER (month = {m}), 255) AS m{m:02d}" for m in range(1, 13))
_TOTAL = " + ".join(f"m{m:02d}" for m in range(1, 13))


@query(f"WITH {OBS_SQL} SELECT y, x, round(quantile_cont(c, 0.95), 6) AS p95, count(*) AS n FROM valid GROUP BY y, x")
def p95_pooled(spark: SparkSession, d: str) -> DataFrame:
    return P.valid_observations(observations(spark, d)).groupBy("y", "x").agg(F.round(A.percentile95(F.col("c")), 6).alias("p95"), F.count(F.lit(1)).alias("n"))


@query(f"WITH {OBS_SQL} SELECT y, x, {_MONTHS} FROM valid GROUP BY y, x")
def monthly_counts_pivot(spark: SparkSession, d: str) -> DataFrame:
    return P.valid_observations(observations(spark, d)).groupBy("y", "x").agg(*Q.month_counts(F.col("month")))


@query(f"""WITH {OBS_SQL}, px AS (SELECT y, x, quantile_cont(c, 0.95) AS p95, count(*) AS clear, count(*) FILTER ((qa & 128) <> 0) AS water, {_MONTHS} FROM valid GROUP BY y, x)
  SELECT y, x, {_TOTAL} AS total, CASE WHEN {_TOTAL} >= 5 AND p95 BETWEEN -20 AND 80 THEN {_ENC} ELSE 0 END AS dn, clear >= 5 AND water >= 0.9::DOUBLE*clear AND NOT coalesce(p95 > 34, false) AS water_class FROM px""")
def composite_minimum(spark: SparkSession, d: str) -> DataFrame:
    return P.reduce_pixels(P.valid_observations(observations(spark, d))).select("y", "x", "total", "dn", "water_class")


_FOOT = f"fv AS (SELECT * FROM valid WHERE {FOOTPRINT_SQL})"


@query(f"WITH {OBS_SQL}, {_FOOT} SELECT y, x, wrs_path, round(quantile_cont(c, 0.95), 6) AS p95, count(*) AS n FROM fv GROUP BY ALL HAVING count(*) >= 5")
def p95_per_path(spark: SparkSession, d: str) -> DataFrame:
    v = P.valid_observations(observations(spark, d), footprint())
    return v.groupBy("y", "x", "wrs_path").agg(F.round(A.percentile95(F.col("c")), 6).alias("p95"), F.count(F.lit(1)).alias("n")).where("n >= 5")


def _weights_sql(share: float) -> str:
    return f"""
  cv AS (SELECT *, y//4 AS row, x//5 AS col FROM fv),
  cq AS (SELECT wrs_path, wrs_row, row, col, count(DISTINCT scene_id) AS n FROM cv GROUP BY ALL),
  qs AS (SELECT wrs_path, wrs_row, count(DISTINCT scene_id) AS scenes FROM cv GROUP BY ALL),
  sw AS (SELECT DISTINCT wrs_path, row, col FROM cq JOIN qs USING (wrs_path, wrs_row) WHERE n >= greatest(scenes*{share}::DOUBLE, 1)),
  dirs AS (SELECT * FROM (VALUES (-1, 0), (1, 0), (0, -1), (0, 1)) t(dr, dc)),
  sg AS (SELECT s.wrs_path, s.col + greatest(dc, 0) AS ax, s.row + greatest(dr, 0) AS ay, CASE WHEN dr <> 0 THEN 1 ELSE 0 END AS flat FROM sw s, dirs
    WHERE s.row + dr BETWEEN 0 AND 1 AND s.col + dc BETWEEN 0 AND 9 AND NOT EXISTS (SELECT 1 FROM sw o WHERE o.wrs_path = s.wrs_path AND o.row = s.row + dr AND o.col = s.col + dc)),
  ds AS (SELECT s.wrs_path, s.row, s.col, coalesce(min(sqrt(pow(s.col + 0.5::DOUBLE - greatest(ax, least(ax + flat, s.col + 0.5::DOUBLE)), 2) + pow(s.row + 0.5::DOUBLE - greatest(ay, least(ay + 1 - flat, s.row + 0.5::DOUBLE)), 2))), sqrt(104::DOUBLE)) AS dist
    FROM sw s LEFT JOIN sg USING (wrs_path) GROUP BY ALL),
  wt AS (SELECT wrs_path, row, col, CASE WHEN count(*) OVER w = 1 THEN 1.0::DOUBLE WHEN sum(dist) OVER w = 0 THEN 1.0::DOUBLE/count(*) OVER w ELSE dist/sum(dist) OVER w END AS weight FROM ds WINDOW w AS (PARTITION BY row, col))"""


@query(f"WITH {OBS_SQL}, {_FOOT}, {_weights_sql(0.5)} SELECT wrs_path, row, col FROM sw")
def swath_cells(spark: SparkSession, d: str) -> DataFrame:
    return _weights(spark, d).select("wrs_path", "row", "col")


def _weights(spark: SparkSession, d: str, share: float = 0.5) -> DataFrame:
    return P.swath_weights(P.valid_observations(observations(spark, d), footprint()), factor=FACTOR, share=share, rows=SHAPE[0], cols=SHAPE[1])


@query(f"WITH {OBS_SQL}, {_FOOT}, {_weights_sql(0.5)} SELECT wrs_path, row, col, round(weight, 6) AS weight FROM wt")
def path_weights_share(spark: SparkSession, d: str) -> DataFrame:
    return _weights(spark, d).withColumn("weight", F.round("weight", 6))


@query(f"WITH {OBS_SQL}, {_FOOT}, {_weights_sql(0.5)} SELECT wrs_path, row, col, round(dist, 6) AS distance FROM ds")
def swath_edge_distance(spark: SparkSession, d: str) -> DataFrame:
    v = P.valid_observations(observations(spark, d), footprint())
    cell = v.withColumn("row", F.floor(F.col("y") / 4).cast("int")).withColumn("col", F.floor(F.col("x") / 5).cast("int"))
    n = cell.groupBy("wrs_path", "wrs_row", "row", "col").agg(F.count_distinct("scene_id").alias("n"))
    swaths = G.swath_cells(n.join(cell.groupBy("wrs_path", "wrs_row").agg(F.count_distinct("scene_id").alias("scenes")), ["wrs_path", "wrs_row"]), 0.5)
    segments = G.boundary_segments(swaths, "wrs_path", *SHAPE)
    return G.edge_distances(swaths, segments, "wrs_path", 104**0.5).select("wrs_path", "row", "col", F.round("distance", 6).alias("distance"))


def _feathered_sql(source: str, share: float, least: int) -> str:
    return f"""{_weights_sql(share)},
  pp AS (SELECT y, x, wrs_path, quantile_cont(c, 0.95) AS p, count(*) AS n FROM {source} GROUP BY ALL HAVING count(*) >= {least}),
  ip AS (SELECT pp.*, (y + 0.5::DOUBLE)/4 - 0.5::DOUBLE AS fy, (x + 0.5::DOUBLE)/5 - 0.5::DOUBLE AS fx FROM pp SEMI JOIN wt ON pp.wrs_path = wt.wrs_path AND row = y//4 AND col = x//5),
  ic AS (SELECT *, CASE WHEN a = 1 THEN fy - floor(fy) ELSE 1 - (fy - floor(fy)) END * CASE WHEN b = 1 THEN fx - floor(fx) ELSE 1 - (fx - floor(fx)) END AS k, CAST(least(greatest(floor(fy) + a, 0), 1) AS INTEGER) AS cr, CAST(least(greatest(floor(fx) + b, 0), 9) AS INTEGER) AS cc FROM ip, range(0, 2) s(a), range(0, 2) t(b)),
  ir AS (SELECT y, x, ic.wrs_path, any_value(p) AS p, sum(k*coalesce(weight, 0)) AS r FROM ic LEFT JOIN wt ON ic.wrs_path = wt.wrs_path AND cr = wt.row AND cc = wt.col GROUP BY y, x, ic.wrs_path),
  bl AS (SELECT y, x, sum(r*p)/sum(r) AS p95 FROM ir GROUP BY y, x HAVING sum(r) > 0),
  po AS (SELECT y, x, quantile_cont(c, 0.95) AS p95 FROM {source} GROUP BY y, x),
  fe AS (SELECT y, x, coalesce(bl.p95, po.p95) AS p95, bl.p95 IS NULL AS fallback FROM po LEFT JOIN bl USING (y, x))"""


@query(f"WITH {OBS_SQL}, {_FOOT}, {_feathered_sql('fv', 0.5, 5)} SELECT y, x, {_ENC} AS dn, fallback FROM fe")
def p95_feathered(spark: SparkSession, d: str) -> DataFrame:
    v = P.valid_observations(observations(spark, d), footprint())
    return P.feathered_p95(v, _weights(spark, d), factor=FACTOR, shape=SHAPE).select("y", "x", Q.encode_celsius(F.col("p95")).alias("dn"), "fallback")


@query(f"WITH {OBS_SQL}, {_FOOT}, {_feathered_sql('fv', 0.9, 30)} SELECT y, x, {_ENC} AS dn, fallback FROM fe")
def p95_feathered_fallback(spark: SparkSession, d: str) -> DataFrame:
    """A higher share and floor, so the pooled fallback is taken."""
    v = P.valid_observations(observations(spark, d), footprint())
    return P.feathered_p95(v, _weights(spark, d, 0.9), factor=FACTOR, shape=SHAPE, least=30).select("y", "x", Q.encode_celsius(F.col("p95")).alias("dn"), "fallback")


_COR = f"""{_FOOT}, ref AS (SELECT y, x, month, median(c) AS ref FROM fv GROUP BY y, x, month),
  off AS (SELECT scene_id, median(c - ref) AS o, count(*) AS n_valid FROM fv JOIN ref USING (y, x, month) GROUP BY scene_id),
  cor AS (SELECT fv.* REPLACE (c - o AS c) FROM fv JOIN off USING (scene_id) WHERE n_valid >= {FLOOR} AND abs(o) <= 15)"""
_FULL = f"""WITH {OBS_SQL}, {_COR}, {_feathered_sql('cor', 0.5, 5)},
  ct AS (SELECT y, x, count(*) AS clear, count(*) FILTER ((qa & 128) <> 0) AS water, {_MONTHS} FROM cor GROUP BY y, x),
  px AS (SELECT *, {_TOTAL} AS total FROM ct JOIN fe USING (y, x)),
  en AS (SELECT *, CASE WHEN total >= 5 AND p95 BETWEEN -20 AND 80 THEN {_ENC} ELSE 0 END AS dn0, clear >= 5 AND water >= 0.9::DOUBLE*clear AND NOT coalesce(p95 > 34, false) AS water_class FROM px),
  fin AS (SELECT *, CASE WHEN {LAND_SQL} AND NOT water_class THEN dn0 ELSE 0 END AS dn, dn0 > 0 AND NOT {LAND_SQL} AS by_geometry, dn0 > 0 AND {LAND_SQL} AND water_class AS by_water FROM en)"""


def _composite(spark: SparkSession, d: str) -> DataFrame:
    return P.composite(observations(spark, d), floor=FLOOR, factor=FACTOR, share=0.5, shape=SHAPE, keep=land(), footprint=footprint())


@query(f"{_FULL} SELECT y, x, dn, total, fallback, water_class, by_geometry, by_water FROM fin")
def composite_full(spark: SparkSession, d: str) -> DataFrame:
    return _composite(spark, d).select("y", "x", "dn", "total", "fallback", "water_class", "by_geometry", "by_water")


@query(f"{_FULL} SELECT count(*) AS pixels, count(*) FILTER (dn > 0) AS valid, count(*) FILTER (by_geometry) AS by_geometry, count(*) FILTER (by_water) AS by_water, count(*) FILTER (by_geometry AND by_water) AS both_rules FROM fin")
def disjoint_mask_flags(spark: SparkSession, d: str) -> DataFrame:
    return _composite(spark, d).agg(F.count(F.lit(1)).alias("pixels"), *A.count_if(valid=F.col("dn") > 0, by_geometry=F.col("by_geometry"), by_water=F.col("by_water"), both_rules=F.col("by_geometry") & F.col("by_water")))


@query(f"WITH {OBS_SQL}, {_REF}, {_OFF}, k AS (SELECT scene_id, o FROM off WHERE n_valid >= 10 AND abs(o) <= 15) SELECT y, x, round(quantile_cont(c - o, 0.95), 6) AS p95, count(*) AS n FROM valid JOIN k USING (scene_id) GROUP BY y, x")
def p95_debiased(spark: SparkSession, d: str) -> DataFrame:
    v = P.valid_observations(observations(spark, d))
    return P.debias(v, P.prep_offsets(v, floor=10)).groupBy("y", "x").agg(F.round(A.percentile95(F.col("c")), 6).alias("p95"), F.count(F.lit(1)).alias("n"))


@query(f"WITH {OBS_SQL}, px AS (SELECT y, x, count(*) AS clear, count(*) FILTER ((qa & 128) <> 0) AS water, quantile_cont(c, 0.95) AS p95 FROM valid GROUP BY y, x) SELECT y, x, clear, water, clear >= 5 AND water >= 0.9::DOUBLE*clear AND NOT p95 > 34 AS water_class, clear >= 5 AND water >= 0.9::DOUBLE*clear AS wet FROM px")
def observed_water(spark: SparkSession, d: str) -> DataFrame:
    px = P.reduce_pixels(P.valid_observations(observations(spark, d)))
    return px.select("y", "x", "clear", "water", "water_class", Q.observed_water(F.col("water"), F.col("clear"), F.lit(None).cast("double")).alias("wet"))


_PX = "px AS (SELECT y, x, count(*) AS n, quantile_cont(c, 0.95) AS p95 FROM valid GROUP BY y, x)"


@query(f"""WITH {OBS_SQL}, {_PX}, r AS (SELECT count(*) FILTER (p95 < 35) AS valid, count(*) FILTER (p95 < 35 AND {LAND_SQL}) AS valid_land, count(*) FILTER ({LAND_SQL}) AS strict_land, count(*) AS retained FROM px)
  SELECT *, round(valid/retained, 6) AS valid_share, round(valid_land/strict_land, 6) AS land_share, valid <= retained AND valid_land <= strict_land AS consistent FROM r""")
def coverage_block(spark: SparkSession, d: str) -> DataFrame:
    px = P.valid_observations(observations(spark, d)).groupBy("y", "x").agg(A.percentile95(F.col("c")).alias("p95"))
    ok = F.col("p95") < 35
    counts = px.agg(*A.count_if(valid=ok, valid_land=ok & land(), strict_land=land(), retained=F.lit(True)))
    return M.coverage(counts).withColumn("valid_share", F.round("valid_share", 6)).withColumn("land_share", F.round("land_share", 6))


@query(f"WITH {OBS_SQL}, {_PX} SELECT count(*) FILTER (p95 < 35 AND {LAND_SQL}) AS land, count(*) FILTER (p95 < 35 AND x < 10) AS coast, count(*) FILTER (p95 < 35 AND y = 3) AS row3, count(*) FILTER (p95 < 35) AS total FROM px")
def region_counts_one_pass(spark: SparkSession, d: str) -> DataFrame:
    px = P.valid_observations(observations(spark, d)).groupBy("y", "x").agg(A.percentile95(F.col("c")).alias("p95"))
    return M.region_counts(px, F.col("p95") < 35, land=land(), coast=F.col("x") < 10, row3=F.col("y") == 3)


@query(f"WITH {OBS_SQL}, p AS (SELECT DISTINCT y, x, {LAND_SQL} AS pr, {LAND_SQL} AND x < 40 AS st FROM obs) SELECT count(*) FILTER (st AND pr) AS strict_land, count(*) FILTER (pr AND NOT st) AS buffer, count(*) FILTER (pr) AS total, count(*) FILTER (st AND NOT pr) AS broken FROM p")
def land_split(spark: SparkSession, d: str) -> DataFrame:
    px = observations(spark, d).select("y", "x").distinct().withColumn("pr", land()).withColumn("st", land() & (F.col("x") < 40))
    return M.land_split(px, "pr", "st")

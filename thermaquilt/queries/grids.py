"""Grid operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermaquilt.functions import geometry as GE
from thermaquilt.functions import quality as Q
from thermaquilt.operators import fleet as E
from thermaquilt.operators import grid as G
from thermaquilt.operators import masks as M
from thermaquilt.plans import composite as P
from thermaquilt.queries import query
from thermaquilt.sources.mapping import CELLS_SQL, LAND_SQL, OBS_SQL, cells, observations, table


@query(f"WITH {CELLS_SQL}, g AS (SELECT row, col FROM cells WHERE count = 0), s AS (SELECT DISTINCT row + a AS row, col + b AS col FROM g, range(-1, 2) x(a), range(-1, 2) y(b)) SELECT * FROM s WHERE row BETWEEN 0 AND 7 AND col BETWEEN 0 AND 9")
def dilate_cells(spark: SparkSession, d: str) -> DataFrame:
    return M.gap_cells(cells(spark, d), 1, 8, 10).select(F.col("row").cast("long"), F.col("col").cast("long"))


@query(f"WITH {CELLS_SQL}, {OBS_SQL}, px AS (SELECT DISTINCT y, x FROM obs) SELECT y, x, count AS numobs FROM px LEFT JOIN cells ON row = (y*8)//8 AND col = (x*10)//50")
def stretch_cells(spark: SparkSession, d: str) -> DataFrame:
    px = observations(spark, d).select("y", "x").distinct()
    return G.stretch(cells(spark, d), px, (8, 10), (8, 50)).select("y", "x", F.col("count").alias("numobs"))


@query(f"WITH {CELLS_SQL} SELECT row//3 AS row, col//3 AS col, bool_or(count = 0) AS gap FROM cells GROUP BY ALL")
def coarsen_any(spark: SparkSession, d: str) -> DataFrame:
    return G.coarsen_any(cells(spark, d).withColumn("gap", F.col("count") == 0), "gap", 3)


@query(f"""WITH {OBS_SQL}, px AS (SELECT y, x, quantile_cont(c, 0.95) AS v FROM valid GROUP BY y, x),
  a AS (SELECT 1 AS level, y//2 AS y, x//2 AS x, sum(v) AS s, count(v) AS n FROM px GROUP BY ALL), b AS (SELECT 2 AS level, y//2 AS y, x//2 AS x, sum(s) AS s, sum(n) AS n FROM a GROUP BY ALL)
  SELECT level, y, x, round(s/n, 6) AS mean, CAST(n AS BIGINT) AS n FROM (SELECT * FROM a UNION ALL SELECT * FROM b)""")
def overview_average(spark: SparkSession, d: str) -> DataFrame:
    px = P.valid_observations(observations(spark, d)).groupBy("y", "x").agg(F.percentile("c", F.lit(0.95)).alias("v"))
    return G.overview(px, "v", 2, 2).withColumn("mean", F.round("mean", 6))


@query(f"""WITH {CELLS_SQL}, g AS (SELECT row, col FROM cells WHERE count = 0), m AS (SELECT row, col FROM cells WHERE count <= 1), sh AS (SELECT dy, dx FROM range(-2, 3) a(dy), range(-2, 3) b(dx))
  SELECT dy, dx, count(g.row) AS hits, round(count(g.row)::DOUBLE/count(*), 6) AS share FROM m CROSS JOIN sh LEFT JOIN g ON g.row = m.row + dy AND g.col = m.col + dx GROUP BY ALL""")
def shift_scan(spark: SparkSession, d: str) -> DataFrame:
    c = cells(spark, d)
    out = G.shift_scan(c.where("count <= 1").select("row", "col"), c.where("count = 0"), 2)
    return out.select(F.col("dy").cast("long").alias("dy"), F.col("dx").cast("long").alias("dx"), "hits", F.round("share", 6).alias("share"))


@query(f"""WITH {CELLS_SQL}, g AS (SELECT row, col FROM cells WHERE count = 0), m AS (SELECT row, col FROM cells WHERE count <= 1), sh AS (SELECT dy, dx FROM range(-2, 3) a(dy), range(-2, 3) b(dx)),
  t AS (SELECT dy, dx, count(g.row)::DOUBLE/count(*) AS share FROM m CROSS JOIN sh LEFT JOIN g ON g.row = m.row + dy AND g.col = m.col + dx GROUP BY ALL)
  SELECT dy, dx, round(share, 6) AS share FROM t ORDER BY share DESC, abs(dy) + abs(dx), dy, dx LIMIT 1""")
def shift_scan_argmax(spark: SparkSession, d: str) -> DataFrame:
    return shift_scan(spark, d).orderBy(F.desc("share"), F.abs("dy") + F.abs("dx"), "dy", "dx").limit(1).select("dy", "dx", "share")


@query("SELECT 5*CAST(12 - i AS INTEGER) AS north, CAST(-180 + 5*j AS INTEGER) AS west, (CASE WHEN i <= 12 THEN 'N' ELSE 'S' END) || lpad(abs(60 - 5*i)::VARCHAR, 2, '0') || (CASE WHEN j >= 36 THEN 'E' ELSE 'W' END) || lpad(abs(-180 + 5*j)::VARCHAR, 3, '0') AS tile_id FROM range(0, 24) a(i), range(0, 72) b(j)")
def tile_grid(spark: SparkSession, d: str) -> DataFrame:
    return G.iter_grid(spark).select("north", "west", "tile_id")


@query("SELECT CAST(r AS INTEGER) AS brow, CAST(c AS INTEGER) AS bcol, CAST(r*360 AS INTEGER) AS y0, CAST(c*360 AS INTEGER) AS x0, CAST(least(r*360+360, 1000) AS INTEGER) AS y1, CAST(least(c*360+360, 1500) AS INTEGER) AS x1 FROM range(0, 3) a(r), range(0, 5) b(c)")
def plan_blocks(spark: SparkSession, d: str) -> DataFrame:
    return G.plan_blocks(spark, 1000, 1500, 360)


@query("SELECT DISTINCT CAST((60 - (n_nationkey*5 - 60))*10 + i AS INTEGER) AS row, CAST((n_nationkey*7 - 80 + 180)*10 + i AS INTEGER) AS col, CAST(CASE WHEN i = 3 THEN 0 ELSE least(greatest(i*40, 0), 255) END AS INTEGER) AS count, true AS covered FROM nation, range(0, 10) t(i) WHERE n_nationkey*5 - 60 BETWEEN -59 AND 60")
def place_granules(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation").select((F.col("n_nationkey") * 5 - 60).alias("north"), (F.col("n_nationkey") * 7 - 80).alias("west"), F.explode(F.sequence(F.lit(0), F.lit(9))).alias("r"))
    g = n.select("north", "west", "r", F.col("r").alias("c"), F.when(F.col("r") == 3, -9999).otherwise(F.col("r") * 40).alias("count"))
    return G.place_granules(g, per_degree=10)


@query(f"WITH {OBS_SQL}, sc AS (SELECT scene_id, min(x) AS w, min(y) AS s, max(x) + 1 AS e, max(y) + 1 AS n, any_value(wrs_path) AS wrs_path FROM obs GROUP BY scene_id) SELECT wrs_path, CAST(min(w) AS BIGINT) AS west, CAST(min(s) AS BIGINT) AS south, CAST(max(e) AS BIGINT) AS east, CAST(max(n) AS BIGINT) AS north, count(*) AS items FROM sc GROUP BY wrs_path")
def extent_union(spark: SparkSession, d: str) -> DataFrame:
    sc = observations(spark, d).groupBy("scene_id").agg(F.min("x").alias("w"), F.min("y").alias("s"), (F.max("x") + 1).alias("e"), (F.max("y") + 1).alias("n"), F.first("wrs_path").alias("wrs_path"))
    out = E.extent_union(sc, "wrs_path", ["w", "s", "e", "n"])
    return out.select("wrs_path", *[F.col(c).cast("long").alias(c) for c in ("west", "south", "east", "north")], "items")


@query(f"WITH {OBS_SQL}, p AS (SELECT DISTINCT y, x FROM obs), b AS (SELECT y, x, {LAND_SQL} AS keep, x >= 45 AS wet, y*1000 + x AS dn FROM p) SELECT y, x, CAST(CASE WHEN keep AND NOT wet THEN dn ELSE 0 END AS INTEGER) AS dn FROM b")
def apply_mask_twice(spark: SparkSession, d: str) -> DataFrame:
    from thermaquilt.sources.mapping import land

    px = observations(spark, d).select("y", "x").distinct().withColumn("dn", (F.col("y") * 1000 + F.col("x")).cast("int"))
    once = M.apply_mask(px, "dn", land(), F.col("x") >= 45)
    return M.apply_mask(once, "dn", land(), F.col("x") >= 45).select("y", "x", "dn")


_POLY = "(VALUES (5.2::DOUBLE, 1.1::DOUBLE, 40.3::DOUBLE, 0.7::DOUBLE), (40.3, 0.7, 47.9, 6.4), (47.9, 6.4, 20.1, 3.2), (20.1, 3.2, 8.8, 7.7), (8.8, 7.7, 5.2, 1.1)) e(x0, y0, x1, y1)"


@query(f"WITH {OBS_SQL}, p AS (SELECT DISTINCT y, x, y + 0.5::DOUBLE AS py, x + 0.5::DOUBLE AS px FROM obs) SELECT y, x FROM p, {_POLY} WHERE (y0 > py) <> (y1 > py) AND px < (x1 - x0)*(py - y0)/(y1 - y0) + x0 GROUP BY y, x HAVING count(*) % 2 = 1")
def rasterize_polygon(spark: SparkSession, d: str) -> DataFrame:
    ring = [(5.2, 1.1), (40.3, 0.7), (47.9, 6.4), (20.1, 3.2), (8.8, 7.7), (5.2, 1.1)]
    edges = spark.createDataFrame([(*a, *b) for a, b in zip(ring, ring[1:], strict=False)], "x0 double, y0 double, x1 double, y1 double")
    px = observations(spark, d).select("y", "x").distinct().withColumn("px", F.col("x") + F.lit(0.5)).withColumn("py", F.col("y") + F.lit(0.5))
    return G.rasterize(px, edges).select("y", "x")


@query("""SELECT s_suppkey, round(greatest(w - 1, -180), 6) AS west, round(least(w + 6, 180), 6) AS east, round(rint((s_suppkey - 15)/30.0::DOUBLE)*30 + 15, 6) AS snapped, round(radians(5::DOUBLE)*(sin(radians(n)) - sin(radians(n - 5)))*6371.0072::DOUBLE*6371.0072::DOUBLE, 3) AS km2
  FROM (SELECT s_suppkey, CAST(s_suppkey % 360 - 180 AS DOUBLE) AS w, CAST(s_suppkey % 100 - 40 AS DOUBLE) AS n FROM supplier)""".replace("rint(", "round_even(").replace("/30.0::DOUBLE)*30", "/30.0::DOUBLE, 0)*30"))
def box_arithmetic(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier").select("s_suppkey", (F.col("s_suppkey") % 360 - 180).cast("double").alias("w"), (F.col("s_suppkey") % 100 - 40).cast("double").alias("n"))
    box = (F.col("w"), F.col("n") - 5, F.col("w") + 5, F.col("n"))
    padded = GE.prep_box(box)
    return s.select("s_suppkey", F.round(padded[0], 6).alias("west"), F.round(padded[2], 6).alias("east"), F.round(GE.snap(F.col("s_suppkey"), 15.0), 6).alias("snapped"), F.round(GE.box_area_km2(box), 3).alias("km2"))


@query("""WITH w AS (SELECT c_custkey, CAST((c_custkey*17) % 360 - 180 AS DOUBLE) AS a, c_custkey % 50 AS lat FROM customer), r AS (SELECT c_custkey, lat, a AS l0, CASE WHEN a + 4 > 180 THEN a + 4 - 360 ELSE a + 4 END AS l1 FROM w)
  SELECT c_custkey, greatest(l0, l1) - least(l0, l1) > 180 AS crossing, CASE WHEN greatest(l0, l1) - least(l0, l1) > 180 THEN greatest(l0, l1) ELSE least(l0, l1) END AS west, CASE WHEN greatest(l0, l1) - least(l0, l1) > 180 THEN least(l0, l1) ELSE greatest(l0, l1) END AS east,
   CASE WHEN greatest(l0, l1) - least(l0, l1) > 180 THEN -180 ELSE least(l0, l1) END AS local_west FROM r""")
def antimeridian_boxes(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", ((F.col("c_custkey") * 17) % 360 - 180).cast("double").alias("a"), (F.col("c_custkey") % 50).cast("double").alias("lat"))
    lons = F.array(F.col("a"), F.when(F.col("a") + 4 > 180, F.col("a") + 4 - 360).otherwise(F.col("a") + 4))
    lats = F.array(F.col("lat"), F.col("lat") + 2)
    box, wrapped = GE.footprint_box(lons, lats), GE.crosses_antimeridian(lons)
    local = GE.tile_local_box(box, wrapped, (F.lit(-180.0), F.lit(0.0), F.lit(-175.0), F.lit(5.0)))
    return c.select("c_custkey", wrapped.alias("crossing"), box[0].alias("west"), box[2].alias("east"), local[0].alias("local_west"))


@query(f"""WITH {CELLS_SQL}, v AS (SELECT row, col, CAST(count AS DOUBLE) AS v FROM cells), p AS (SELECT y, x, (y + 0.5)/2 - 0.5 AS fy, (x + 0.5)/2 - 0.5 AS fx FROM range(2, 16) a(y), range(0, 20) b(x)),
  k AS (SELECT y, x, CAST(least(greatest(floor(fy) + a, 0), 7) AS BIGINT) AS row, CAST(least(greatest(floor(fx) + b, 0), 9) AS BIGINT) AS col, (CASE WHEN a = 1 THEN fy - floor(fy) ELSE 1 - (fy - floor(fy)) END)*(CASE WHEN b = 1 THEN fx - floor(fx) ELSE 1 - (fx - floor(fx)) END) AS w FROM p, range(0, 2) s(a), range(0, 2) t(b))
  SELECT y, x, round(sum(w*v), 6) AS v FROM k JOIN v USING (row, col) GROUP BY y, x""")
def bilinear_ramp(spark: SparkSession, d: str) -> DataFrame:
    v = cells(spark, d).select("row", "col", F.col("count").cast("double").alias("v"))
    px = spark.range(2, 16).select(F.col("id").alias("y")).select("y", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(19).cast("long"))).alias("x"))
    return G.bilinear(v, px, "v", 2, 8, 10, []).withColumn("v", F.round("v", 6))


@query("SELECT l_partkey % 50 AS x, CAST(least(n, 255) AS BIGINT) AS kept, round(n::DOUBLE/nullif(wet, 0), 6) AS share FROM (SELECT l_partkey, count(*) AS n, count(*) FILTER (l_orderkey % 3 = 0) AS wet FROM lineitem GROUP BY l_partkey)")
def saturated_and_guarded(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_orderkey") % 3 == 0).alias("wet"))
    return t.select((F.col("l_partkey") % 50).alias("x"), Q.saturated(F.col("n")).alias("kept"), F.round(Q.share_of(F.col("n"), F.col("wet")), 6).alias("share"))

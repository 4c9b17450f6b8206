"""Land areas, cells and tile selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermaquilt.functions import geometry as GE
from thermaquilt.operators import areas as L
from thermaquilt.operators import grid as G
from thermaquilt.queries import query
from thermaquilt.sources.mapping import table

_QUADS = """qd AS (SELECT s_suppkey, n_name, CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE s_suppkey % 12 END AS rank, CAST((s_suppkey*37) % 3500 AS DOUBLE)/10 - 175 AS lon, CAST((s_suppkey*53) % 1100 AS DOUBLE)/10 - 56 AS lat, CASE WHEN s_suppkey % 17 = 0 THEN 0.0::DOUBLE ELSE 1 + s_suppkey % 4 END AS k FROM supplier JOIN nation ON s_nationkey = n_nationkey),
  qr AS (SELECT *, lon AS x0, lat + 0.5*k AS y0, lon + 0.6*k AS x1, lat + 0.4*k AS y1, lon + 0.5*k AS x2, lat AS y2, lon - 0.2*k AS x3, lat + 0.1*k AS y3 FROM qd)"""
_RING = ((0.0, 0.5), (0.6, 0.4), (0.5, 0.0), (-0.2, 0.1))


def _quads(spark: SparkSession, d: str) -> DataFrame:
    """A quad of land for each supplier: some without an area, some of an unknown rank."""
    k = F.col("s_suppkey")
    s = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    s = s.select(k, "n_name", F.when(k % 5 != 0, k % 12).cast("int").alias("rank"), (((k * 37) % 3500).cast("double") / 10 - 175).alias("lon"), (((k * 53) % 1100).cast("double") / 10 - 56).alias("lat"), F.when(k % 17 == 0, 0.0).otherwise((k % 4 + 1).cast("double")).alias("k"))
    return s.select("*", *[(F.col("lon") + dx * F.col("k")).alias(f"x{i}") for i, (dx, _) in enumerate(_RING)], *[(F.col("lat") + dy * F.col("k")).alias(f"y{i}") for i, (_, dy) in enumerate(_RING)])


def _parts(spark: SparkSession, d: str) -> DataFrame:
    return _quads(spark, d).withColumn("x", F.array("x0", "x1", "x2", "x3")).withColumn("y", F.array("y0", "y1", "y2", "y3"))


_AREA = "abs((x0*y1 - x1*y0) + (x1*y2 - x2*y1) + (x2*y3 - x3*y2) + (x3*y0 - x0*y3))/2"


@query(f"WITH {_QUADS} SELECT s_suppkey, rank, round({_AREA}, 6) AS area FROM qr WHERE {_AREA} > 1e-9 AND (rank IS NULL OR rank <= 9)")
def drop_placeholder_parts(spark: SparkSession, d: str) -> DataFrame:
    kept = L.drop_placeholders(_parts(spark, d).where(L.ring_area(F.col("x"), F.col("y")) > 1e-9))
    return kept.select("s_suppkey", "rank", F.round(L.ring_area(F.col("x"), F.col("y")), 6).alias("area"))


def _touch_sql(size: int) -> str:
    parts = []
    for i in range(4):
        j = (i + 1) % 4
        nx, ny = f"(y{j}-y{i})", f"(x{i}-x{j})"
        own = ", ".join(f"{nx}*x{k}+{ny}*y{k}" for k in range(4))
        box = ", ".join(f"{nx}*{x}+{ny}*{y}" for x in ("w", f"(w+{size})") for y in ("s", f"(s+{size})"))
        parts.append(f"least({own}) <= greatest({box}) AND least({box}) <= greatest({own})")
    return f"least(x0,x1,x2,x3) <= w + {size} AND greatest(x0,x1,x2,x3) >= w AND least(y0,y1,y2,y3) <= s + {size} AND greatest(y0,y1,y2,y3) >= s AND " + " AND ".join(parts)


def _cells_sql(size: int) -> str:
    return f"WITH {_QUADS}, g AS (SELECT CAST(-180 + {size}*i AS DOUBLE) AS w, CAST(-60 + {size}*j AS DOUBLE) AS s FROM range(0, {360 // size}) a(i), range(0, {120 // size}) b(j)) SELECT DISTINCT CAST(w AS INTEGER) AS west, CAST(s AS INTEGER) AS south FROM qr JOIN g ON {_touch_sql(size)}"


@query(_cells_sql(5))
def land_tiles_semi_join(spark: SparkSession, d: str) -> DataFrame:
    return L.cells_touching(_quads(spark, d), 5, 60)


@query(_cells_sql(1))
def land_cells_semi_join(spark: SparkSession, d: str) -> DataFrame:
    return L.cells_touching(_quads(spark, d), 1, 60)


@query(f"WITH {_QUADS} SELECT s_suppkey, round(lon - 25000/111319.49079327358, 6) AS west, round(lon + 0.6*k + 25000/111319.49079327358, 6) AS east, round(degrees(2*atan(exp(radians(degrees(ln(tan(pi()/4 + radians(lat)/2))) - 25000/111319.49079327358))) - pi()/2), 6) AS south, lon - 25000/111319.49079327358 < -180 OR lon + 0.6*k + 25000/111319.49079327358 > 180 AS crosses FROM qr")
def buffered_boxes(spark: SparkSession, d: str) -> DataFrame:
    west, south, east, _, crosses = L.buffered_box(F.col("lon"), F.col("lat"), F.col("x1"), F.col("y0"), 25000.0)
    return _quads(spark, d).select("s_suppkey", F.round(west, 6).alias("west"), F.round(east, 6).alias("east"), F.round(south, 6).alias("south"), crosses.alias("crosses"))


@query("SELECT n_nationkey, n_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE lower(trim(r_name)) = 'asia'")
def continent_parts(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).withColumn("continent", F.col("r_name"))
    return L.dissolve(n, " Asia ").select("n_nationkey", "n_name")


@query("""WITH a AS (SELECT c_nationkey AS tile_id, sum(abs(c_acctbal)) AS km2 FROM customer WHERE c_nationkey % 6 <> 1 GROUP BY 1),
  m AS (SELECT avg(km2) AS least FROM a)
  SELECT n_nationkey AS tile_id, CASE WHEN n_nationkey % 8 = 2 THEN NULL ELSE round(km2, 2) END AS land_km2, CASE WHEN n_nationkey % 8 = 2 THEN 'excluded' WHEN km2 IS NULL THEN 'off' WHEN km2 < 250000 THEN 'sliver' ELSE 'kept' END AS verdict FROM nation LEFT JOIN a ON n_nationkey = tile_id""")
def select_tiles_four_way(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("tile_id"))
    land = table(spark, d, "customer").where("c_nationkey % 6 <> 1").select(F.col("c_nationkey").alias("tile_id"), F.abs("c_acctbal").alias("km2"))
    return L.select_tiles(n, land, n.where("tile_id % 8 = 2"), 250000.0).withColumn("land_km2", F.round("land_km2", 2))


@query("WITH t AS (SELECT CAST(-180 + 5*i AS DOUBLE) AS w, CAST(-60 + 5*j AS DOUBLE) AS s FROM range(0, 72) a(i), range(0, 24) b(j)) SELECT CAST(w AS INTEGER) AS west, CAST(s AS INTEGER) AS south FROM t WHERE sqrt(greatest(w - 0.0045, -0.0045 - (w + 5), 0)**2 + greatest(s - 0.0045, -0.0045 - (s + 5), 0)**2) <= 25000/111319.49079327358")
def origin_disc_reach(spark: SparkSession, d: str) -> DataFrame:
    t = spark.range(0, 72 * 24).select((F.floor(F.col("id") / 24) * 5 - 180).cast("double").alias("west"), (F.col("id") % 24 * 5 - 60).cast("double").alias("south"))
    t = t.withColumn("east", F.col("west") + 5).withColumn("north", F.col("south") + 5)
    return L.disc_reach(t, 25000.0).select(F.col("west").cast("int").alias("west"), F.col("south").cast("int").alias("south"))


@query("WITH p AS (SELECT c_custkey, CAST((c_custkey*37) % 1200 AS DOUBLE)/200 + 9.5 AS lon, CAST((c_custkey*53) % 1200 AS DOUBLE)/200 + 19.5 AS lat FROM customer), r AS (SELECT *, CAST(round_even((25 - lat)*100, 0) AS BIGINT) AS y, CAST(round_even((lon - 10)*100, 0) AS BIGINT) AS x FROM p) SELECT c_custkey, CAST(y//128 AS INTEGER) AS brow, CAST(x//128 AS INTEGER) AS bcol FROM r WHERE y >= 0 AND y < 500 AND x >= 0 AND x < 500")
def point_in_block(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    p = table(spark, d, "customer").select(k, (((k * 37) % 1200).cast("double") / 200 + 9.5).alias("lon"), (((k * 53) % 1200).cast("double") / 200 + 19.5).alias("lat"))
    row, col = F.rint((25 - F.col("lat")) * 100), F.rint((F.col("lon") - 10) * 100)
    inside = p.where((row >= 0) & (row < 500) & (col >= 0) & (col < 500))
    return L.block_holding(inside, G.plan_blocks(spark, 500, 500, 128), (10.0, 20.0, 15.0, 25.0), 100, 128).select("c_custkey", "brow", "bcol")


@query("SELECT s_suppkey, CAST(round_even((k + 1)*100, 0) AS INTEGER) AS rows, CAST(round_even(0.8*k*100, 0) AS INTEGER) AS cols, round(lon + 0.03, 6) AS west, round(lat - 0.02, 6) AS south FROM (WITH " + _QUADS + " SELECT * FROM qd)")
def box_shapes_and_shifts(spark: SparkSession, d: str) -> DataFrame:
    q = _quads(spark, d)
    box = (F.col("lon"), F.col("lat"), F.col("lon") + 0.8 * F.col("k"), F.col("lat") + F.col("k") + 1)
    rows, cols = GE.raster_shape((F.lit(0.0), F.lit(0.0), 0.8 * F.col("k"), F.col("k") + 1), 100)
    moved = GE.shifted_box(box, 2, 3)
    return q.select("s_suppkey", rows.cast("int").alias("rows"), cols.cast("int").alias("cols"), F.round(moved[0], 6).alias("west"), F.round(moved[1], 6).alias("south"))

"""Scene inventory queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermaquilt.functions import text as T
from thermaquilt.operators import inventory as I
from thermaquilt.operators.grid import iter_grid
from thermaquilt.queries import query
from thermaquilt.sources.mapping import table

_START, _END = "1993-01-01T00:00:00Z", "1996-12-31T23:59:59Z"


def bulk(spark: SparkSession, d: str) -> DataFrame:
    """orders as the bulk scene metadata, under its own names."""
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    lon, lat = ((k * 37) % 3600).cast("double") / 10 - 180, ((F.col("o_custkey") * 53) % 1400).cast("double") / 10 - 70
    wrap = lambda c: F.when(c > 180, c - 360).otherwise(c)
    day = F.date_format("o_orderdate", "yyyy/MM/dd")
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    corners = {"Upper Left": (0.0, 1.8), "Upper Right": (1.9, 1.5), "Lower Right": (1.5, 0.0), "Lower Left": (-0.4, 0.3)}
    return o.select(
        F.concat(F.lit("LC08_L2SP_"), F.lpad((k % 233).cast("string"), 3, "0"), F.lpad((k % 248).cast("string"), 3, "0"), F.lit("_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_20240101_02_T1")).alias("Display ID"), k.cast("string").alias("Landsat Scene Identifier"),
        day.alias("Date Acquired"), stamp.alias("Start Time"), F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 30 SECONDS"), "yyyy-MM-dd HH:mm:ss").alias("Stop Time"), (7 + k % 3).cast("int").alias("Satellite"),
        F.when(k % 13 == 0, "OLI_TIRS_L2SR").otherwise("OLI_TIRS_L2SP").alias("Data Type L2"), F.lit("T1").alias("Collection Category"), (k % 233).cast("int").alias("WRS Path"), (k % 248).cast("int").alias("WRS Row"), (k % 120).cast("double").alias("Scene Cloud Cover L1"),
        F.lit("UTM").alias("Product Map Projection L1"), (k % 60 + 1).cast("int").alias("UTM Zone"), *[c for n, (dx, dy) in corners.items() for c in ((lat + dy).alias(f"Corner {n} Latitude"), wrap(lon + dx).alias(f"Corner {n} Longitude"))],
    )


_SCAN = """FROM (SELECT *, CAST((o_custkey*53) % 1400 AS DOUBLE)/10 - 70 AS lat FROM orders) WHERE strftime(o_orderdate, '%Y/%m/%d') BETWEEN '1992/12/31' AND '1997/01/01' AND 7 + o_orderkey % 3 IN (8, 9) AND o_orderkey % 120 < 100 AND lat <= 60 AND lat + 1.8 >= -60"""


@query(f"SELECT CAST(o_orderkey AS VARCHAR) AS scene, strftime(o_orderdate, '%Y/%m/%d') AS day {_SCAN}")
def scan_bulk_window(spark: SparkSession, d: str) -> DataFrame:
    return I.scan_bulk(bulk(spark, d), _START, _END).select(F.col("Landsat Scene Identifier").alias("scene"), F.col("Date Acquired").alias("day"))


@query("SELECT count(*) AS n FROM orders")
def count_bulk_rows(spark: SparkSession, d: str) -> DataFrame:
    return bulk(spark, d).agg(F.count(F.lit(1)).alias("n"))


def _inventory(spark: SparkSession, d: str) -> DataFrame:
    return I.build_inventory(bulk(spark, d), iter_grid(spark), "s3://scenes/collection02", _START, _END)


_FOOT = """s AS (SELECT *, CAST((o_orderkey*37) % 3600 AS DOUBLE)/10 - 180 AS lon, o_orderdate + INTERVAL 15 SECONDS AS dt {scan}),
  w AS (SELECT * FROM s WHERE dt BETWEEN TIMESTAMP '1993-01-01 00:00:00' AND TIMESTAMP '1996-12-31 23:59:59'),
  r AS (SELECT *, lon - 0.4 AS x3, lat + 0.3 AS y3, lon AS x0, lat + 1.8 AS y0, lon + 1.9 AS x1, lat + 1.5 AS y1, lon + 1.5 AS x2, lat AS y2 FROM w),
  tl AS (SELECT CAST(60 - 5*i AS DOUBLE) AS n, CAST(-180 + 5*j AS DOUBLE) AS w FROM range(0, 24) a(i), range(0, 72) b(j))""".format(scan=_SCAN)


def _axes() -> str:
    from thermaquilt.queries.joins import _axis_sql

    return _axis_sql()


@query(f"""WITH {_FOOT}, lay AS (SELECT r.*, n, CASE WHEN x1 > 180 AND w < 0 THEN w + 360 ELSE w END AS w, w AS name_w FROM r JOIN tl ON n >= lat - 6 AND n <= lat + 8)
  SELECT (CASE WHEN n >= 0 THEN 'N' ELSE 'S' END) || lpad(abs(n)::INTEGER::VARCHAR, 2, '0') || (CASE WHEN name_w >= 0 THEN 'E' ELSE 'W' END) || lpad(abs(name_w)::INTEGER::VARCHAR, 3, '0') AS tile_id, count(*) AS scenes, count(*) FILTER (o_orderkey % 13 <> 0) AS thermal
  FROM lay WHERE lon > -179 AND least(x0,x1,x2,x3) <= w + 5 AND greatest(x0,x1,x2,x3) >= w AND least(y0,y1,y2,y3) <= n AND greatest(y0,y1,y2,y3) >= n - 5 AND {_axes()} GROUP BY 1""")
def tile_scene_counts(spark: SparkSession, d: str) -> DataFrame:
    b = bulk(spark, d)
    inner = b.where((F.col("Landsat Scene Identifier").cast("long") * 37) % 3600 > 10)
    return I.tile_counts(I.build_inventory(inner, iter_grid(spark), "s3://scenes/collection02", _START, _END))


@query()
def inventory_rows(spark: SparkSession, d: str) -> DataFrame:
    return _inventory(spark, d).orderBy("tile_id", "datetime", "item_id")


@query()
def inventory_items_json(spark: SparkSession, d: str) -> DataFrame:
    return _inventory(spark, d).select("tile_id", "item_id", F.to_json(I.item_struct("c2l2-st")).alias("item"))


@query()
def derive_projection(spark: SparkSession, d: str) -> DataFrame:
    b = bulk(spark, d)
    ring = ("Upper Left", "Upper Right", "Lower Right", "Lower Left")
    centre = (F.col("Corner Upper Left Longitude") + 180) / 6
    s = b.select(F.col("Landsat Scene Identifier").alias("scene"), (F.floor(centre).cast("int") % 60 + 1).alias("utm_zone"), *[F.col(f"Corner {c} {k}").alias(f"corner_{n}{i}") for i, c in enumerate(ring) for k, n in (("Longitude", "lon"), ("Latitude", "lat"))])
    return I.derive_projection(s.where("abs(corner_lon0 - corner_lon1) < 10")).select("scene", "proj_epsg", "proj_origin_x", "proj_origin_y", "proj_shape_x", "proj_shape_y")


@query("SELECT o_orderkey, month(o_orderdate - INTERVAL 30 SECONDS) <> month(o_orderdate + INTERVAL 30 SECONDS) AS ambiguous FROM orders")
def month_boundary_guard(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", I.near_month_boundary(F.col("o_orderdate")).alias("ambiguous"))


@query("""SELECT DISTINCT l_orderkey AS item_id, b AS band, 's3://b/' || l_orderkey || '/' || b AS href FROM lineitem, (VALUES ('lwir11'), ('qa_pixel')) t(b) WHERE NOT (b = 'lwir11' AND l_orderkey % 80 = 0)""")
def staging_manifest(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("l_orderkey")
    href = lambda b: F.concat(F.lit("s3://b/"), k.cast("string"), F.lit(f"/{b}"))
    items = table(spark, d, "lineitem").select(k.alias("item_id"), F.when(k % 80 != 0, href("lwir11")).alias("thermal_href"), href("qa_pixel").alias("qa_href"))
    return I.staging_manifest(items)


@query("SELECT 'LC08_L2SP_' || lpad((o_orderkey % 233)::VARCHAR, 3, '0') || lpad((o_orderkey % 248)::VARCHAR, 3, '0') || '_' || strftime(o_orderdate, '%Y%m%d') || '_02_T1' AS item_id, count(*) AS n FROM orders GROUP BY 1")
def display_id_parse(spark: SparkSession, d: str) -> DataFrame:
    return bulk(spark, d).groupBy(T.item_id_of(F.col("Display ID")).alias("item_id")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT o_orderkey::VARCHAR AS scene, CASE WHEN o_orderkey % 13 <> 0 THEN b || '_ST_B10.TIF' END AS thermal, b || '_QA_PIXEL.TIF' AS qa FROM (SELECT o_orderkey, 's3://scenes/' || lpad((o_orderkey % 233)::VARCHAR, 3, '0') || '/' || lpad((o_orderkey % 248)::VARCHAR, 3, '0') || '/' || id || '/' || id AS b
  FROM (SELECT *, 'LC08_L2SP_' || lpad((o_orderkey % 233)::VARCHAR, 3, '0') || lpad((o_orderkey % 248)::VARCHAR, 3, '0') || '_' || strftime(o_orderdate, '%Y%m%d') || '_20240101_02_T1' AS id FROM orders))""")
def asset_href_template(spark: SparkSession, d: str) -> DataFrame:
    thermal, qa = T.asset_hrefs("s3://scenes", F.col("Display ID"), F.col("WRS Path"), F.col("WRS Row"), F.col("Data Type L2"))
    return bulk(spark, d).select(F.col("Landsat Scene Identifier").alias("scene"), thermal.alias("thermal"), qa.alias("qa"))

"""The driver's tables seen as scenes, observations and cells: whole-number arithmetic only, so any engine gets the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PIXELS_X, PIXELS_Y = 50, 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """scene_id, month, wrs_path, wrs_row, x, y, dn, qa from lineitem."""
    flag = lambda c: F.when(c, 1).otherwise(0)
    t = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", F.month("l_shipdate").alias("month"))
    x = (F.col("l_partkey") % 50).cast("int")
    t = t.withColumn("x", x)
    dn = F.when(F.col("l_orderkey") % 29 == 0, 0).otherwise(41000 + F.floor(F.col("l_extendedprice") / 10) + (F.col("l_suppkey") % 7) * 300 - 9000 * flag(F.col("l_suppkey") % 23 == 0) - 6000 * flag(F.col("x").between(45, 47)))
    qa = 64 + 8 * flag(F.col("l_orderkey") % 5 == 0) + 4 * flag(F.col("l_orderkey") % 17 == 0) + 128 * flag((F.col("x") >= 45) & (F.col("l_orderkey") % 20 != 0))
    return t.select((F.col("l_suppkey") * 100 + F.col("month")).alias("scene_id"), "month", (F.col("l_suppkey") % 6).cast("int").alias("wrs_path"), (F.col("l_suppkey") % 3).cast("int").alias("wrs_row"), "x", F.col("l_linenumber").alias("y"), dn.cast("int").alias("dn"), qa.cast("int").alias("qa"))


#: The same as a common table expression.
OBS_SQL = """
obs AS (
  SELECT l_suppkey*100 + month(l_shipdate) AS scene_id, CAST(month(l_shipdate) AS INTEGER) AS month, CAST(l_suppkey % 6 AS INTEGER) AS wrs_path, CAST(l_suppkey % 3 AS INTEGER) AS wrs_row,
    CAST(l_partkey % 50 AS INTEGER) AS x, l_linenumber AS y,
    CAST(CASE WHEN l_orderkey % 29 = 0 THEN 0 ELSE 41000 + floor(l_extendedprice/10) + (l_suppkey % 7)*300 - CASE WHEN l_suppkey % 23 = 0 THEN 9000 ELSE 0 END
      - CASE WHEN l_partkey % 50 BETWEEN 45 AND 47 THEN 6000 ELSE 0 END END AS INTEGER) AS dn,
    CAST(64 + CASE WHEN l_orderkey % 5 = 0 THEN 8 ELSE 0 END + CASE WHEN l_orderkey % 17 = 0 THEN 4 ELSE 0 END
      + CASE WHEN l_partkey % 50 >= 45 AND l_orderkey % 20 <> 0 THEN 128 ELSE 0 END AS INTEGER) AS qa
  FROM lineitem),
dec AS (SELECT *, dn*CAST(0.00341802 AS DOUBLE) + CAST(149.0 AS DOUBLE) - CAST(273.15 AS DOUBLE) AS c FROM obs),
valid AS (SELECT * FROM dec WHERE dn <> 0 AND (qa & 62) = 0 AND c BETWEEN -50 AND 80)"""


def footprint() -> Column:
    """Each path's own columns of pixels, so that swaths overlap in part."""
    return F.col("x").between(F.col("wrs_path") * 8 - 4, F.col("wrs_path") * 8 + 14)


FOOTPRINT_SQL = "x BETWEEN wrs_path*8-4 AND wrs_path*8+14"


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """row, col, count, covered: suppliers seen over a cell of five columns, count in 0..3."""
    t = table(spark, sf_dir, "lineitem")
    row, col = F.col("l_linenumber").alias("row"), F.floor((F.col("l_partkey") % 50) / 5).cast("int").alias("col")
    return t.groupBy(row, col).agg((F.count_distinct("l_suppkey") % 4).cast("int").alias("count"), F.lit(True).alias("covered"))


CELLS_SQL = "cells AS (SELECT l_linenumber AS row, CAST((l_partkey % 50)//5 AS INTEGER) AS col, CAST(count(DISTINCT l_suppkey) % 4 AS INTEGER) AS count, true AS covered FROM lineitem GROUP BY 1, 2)"


def land() -> Column:
    return (F.col("x") * 7 + F.col("y")) % 11 != 0


LAND_SQL = "((x*7 + y) % 11 <> 0)"

"""Land, gap and coverage accounting over pixel tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermaquilt.functions.quality import share_of
from thermaquilt.operators.aggregates import count_if
from thermaquilt.operators.grid import dilate


def gap_cells(cells: DataFrame, buffer_cells: int, rows: int, cols: int) -> DataFrame:
    """(row, col) of cells read with count 0, widened on the cell grid; a cell that was never read is no gap."""
    return dilate(cells.where("covered AND count = 0").select("row", "col"), buffer_cells, rows, cols)


def region_counts(pixels: DataFrame, valid: Column, **regions: Column) -> DataFrame:
    """Valid pixels of any number of regions and in all, in one pass."""
    return pixels.agg(*count_if(**{k: valid & c for k, c in regions.items()}, total=valid))


def land_split(pixels: DataFrame, processing: str, strict: str) -> DataFrame:
    """Strict, buffer and total counts; strict outside processing is counted as `broken`."""
    p, s = F.col(processing), F.col(strict)
    return pixels.agg(*count_if(strict_land=s & p, buffer=p & ~s, total=p, broken=s & ~p))


def coverage(counts: DataFrame) -> DataFrame:
    """valid_share of the pixels that the mask keeps and land_share of strict land; null where there is none, never over 1."""
    ok = F.col("valid") <= F.col("retained")
    return counts.withColumn("valid_share", F.when(ok, share_of(F.col("valid"), F.col("retained")))).withColumn("land_share", share_of(F.col("valid_land"), F.col("strict_land"))).withColumn("consistent", ok & (F.col("valid_land") <= F.col("strict_land")))


def apply_mask(pixels: DataFrame, dn: str, keep: Column, water: Column) -> DataFrame:
    """dn 0 outside keep or on observed water; doing it twice changes nothing."""
    return pixels.withColumn(dn, F.when(keep & ~water, F.col(dn)).otherwise(F.lit(0)).cast("int"))

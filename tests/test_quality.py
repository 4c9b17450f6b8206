"""Truth tables of the observation rules."""

import pytest
from pyspark.sql import functions as F

from thermaquilt.functions import quality as Q


def one(spark, column, **values):
    kinds = {int: "int", float: "double", bool: "boolean", str: "string"}
    schema = ", ".join(f"{k} {kinds.get(type(v), 'double')}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("v")).head()[0]


@pytest.mark.parametrize("bit", range(8))
def test_each_bit(spark, bit):
    assert one(spark, Q.qa_clear(F.col("qa")), qa=1 << bit) is (bit not in (1, 2, 3, 4, 5))
    assert one(spark, Q.qa_water(F.col("qa")), qa=1 << bit) is (bit == 7)


@pytest.mark.parametrize(("c", "ok"), [(-50.0, True), (80.0, True), (-50.001, False), (80.001, False), (float("nan"), False)])
def test_range_is_closed(spark, c, ok):
    assert one(spark, Q.in_trusted_range(F.col("c")), c=c) is ok


@pytest.mark.parametrize(("c", "dn"), [(-50.0, 0), (-49.99, 0), (-49.98, 2), (0.0, 5000), (605.35, 65535), (605.36, 0), (0.005, 5000), (0.015, 5002)])
def test_encode(spark, c, dn):
    assert one(spark, Q.encode_celsius(F.col("c")), c=c) == pytest.approx(dn, abs=1 if c in (0.005, 0.015) else 0)


@pytest.mark.parametrize(("water", "clear", "c", "want"), [(9, 10, 20.0, True), (8, 10, 20.0, False), (4, 4, 20.0, False), (5, 5, 34.0, True), (5, 5, 34.1, False), (5, 5, None, True), (18, 20, 20.0, True)])
def test_water(spark, water, clear, c, want):
    df = spark.createDataFrame([(water, clear, c)], "w int, n int, c double")
    assert df.select(Q.observed_water(F.col("w"), F.col("n"), F.col("c"))).head()[0] is want


@pytest.mark.parametrize(("o", "n", "want"), [(15.0, 200, True), (15.01, 200, False), (-15.0, 200, True), (0.0, 199, False), (None, 500, False)])
def test_keep(spark, o, n, want):
    assert spark.createDataFrame([(o, n)], "o double, n int").select(Q.keep_mask(F.col("o"), F.col("n"))).head()[0] is want


def test_share_of_nothing_is_null(spark):
    assert one(spark, Q.share_of(F.col("a"), F.col("b")), a=1, b=0) is None

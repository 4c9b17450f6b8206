"""Checks before a run, count grids and weights, without the driver's tables."""

import pytest
from pyspark.sql import functions as F

from thermaquilt.operators import areas as L
from thermaquilt.operators import grid as G
from thermaquilt.plans import checks as C
from thermaquilt.plans import sizing as Z

BOX = (10.0, 20.0, 15.0, 25.0)
META = {"bbox": BOX, "crs": "EPSG:4326", "end": "2024-01-01", "pixels_per_degree": 100, "raster": (500, 500), "start": "2014-01-01", "tile": "N25E010"}
PREP = {"schema_version": 3, "tile": "N25E010", "pixels_per_degree": 100, "digest": "d", "inventory": "i"}


def test_catalog_and_masks():
    assert C.check_catalog_inputs(META)["tile"] == "N25E010"
    for bad in ({"crs": "EPSG:3857"}, {"raster": (500, 501)}, {"end": None}):
        with pytest.raises(Z.SetupError):
            C.check_catalog_inputs(META | bad)
    with pytest.raises(Z.SetupError, match="crs, raster"):
        C.catalog_provenance({k: v for k, v in META.items() if k not in ("crs", "raster")})
    C.check_mask_inputs({"land": {"buffer": 25000}}, {"land": {"buffer": 25000}})
    for found in ({}, {"land": None}, {"land": {"buffer": 0}}):
        with pytest.raises(Z.SetupError):
            C.check_mask_inputs(found, {"land": {"buffer": 25000}})


def test_prep_is_refused_for_each_of_six_reasons():
    run = {"version": 3, "tile": "N25E010", "per_degree": 100, "digest": "d", "inventory": "i"}
    C.check_prep(PREP, **run)
    for bad in ({"partial": True}, {"schema_version": 2}, {"tile": "N30E010"}, {"pixels_per_degree": 50}, {"digest": "e"}, {"inventory": "j"}):
        with pytest.raises(Z.SetupError):
            C.check_prep(PREP | bad, **run)


def test_grids_and_boxes():
    with pytest.raises(Z.SetupError):
        Z.check_grid(3604, 4, 8)
    C.check_bbox_inside((-180, -60, 180, 60), BOX)
    for bad in ((-181, 0, 0, 5), (0, 55, 5, 61)):
        with pytest.raises(Z.SetupError):
            C.check_bbox_inside((-180, -60, 180, 60), bad)
    edges = C.geographic_block_edges((0.01, 0, 10.0, 0, -0.01, 25.0), (500, 500), 300)
    assert len(edges) == 4 and edges[-1][:2] == (1, 1) and edges[-1][2:] == pytest.approx((13.0, 20.0, 15.0, 22.0))
    with pytest.raises(Z.SetupError):
        C.geographic_block_edges((0.01, 0.1, 10.0, 0, -0.01, 25.0), (500, 500), 300)
    with pytest.raises(Z.SetupError):
        C.geographic_block_edges((0.01, 0, 10.0, 0, -0.01, 25.0), (500, 500), 300, geographic=False)
    assert C.swath_transform(BOX, 3600, 16) == (1 / 225, 0.0, 10.0, 0.0, -1 / 225, 25.0)
    assert C.spatial_dims(True) == ("latitude", "longitude") and C.spatial_dims(False) == ("y", "x")


def test_names_and_bands():
    one = C.items_cache_name(BOX, "2014", "2024", "c", "all", 80)
    assert one == C.items_cache_name(BOX, "2014", "2024", "c", "all", 80) != C.items_cache_name(BOX, "2014", "2024", "c", "all", 70)
    assert C.band_config({"lst": {"bands": [{"scale": 0.01, "offset": -100.0, "nodata": 0}]}}, "lst") == {"scale": 0.01, "offset": -100.0, "nodata": 0, "unit": None}
    with pytest.raises(Z.SetupError):
        C.band_config({}, "lst")
    assert C.stac_bands([{"band": "p95", "min": 1, "max": 2, "scale": 0.01, "offset": -100.0, "nodata": 0}], "degC", "x")[0]["statistics"] == {"minimum": 1, "maximum": 2}
    assert C.item_for_files("s", {"qa": "q", "lwir": "t"}, "2021-01-01T00:00:00Z", 7, 81)["properties"]["wrs_path"] == "007"


def test_weights_change_smoothly(spark):
    """Across a border of swath cells the ramp moves in steps of a cell's difference over its pixels, not at once."""
    w = spark.createDataFrame([(1, 0, c, c / 3) for c in range(4)], "wrs_path int, row int, col int, weight double")
    around = G.neighbour_weights(w, 1, 4)
    px = spark.range(40).select(F.lit(0).alias("y"), F.col("id").cast("int").alias("x")).withColumn("row", F.lit(0)).withColumn("col", F.floor(F.col("x") / 10).cast("int"))
    rows = px.join(around, ["row", "col"]).select("x", G.ramp_at(F.col("y"), F.col("x"), F.col("row"), F.col("col"), F.col("around"), (1, 10)).alias("v")).orderBy("x").collect()
    v = [r.v for r in rows]
    assert len(v) == 40 and v[0] == 0 and v[-1] == 1 and max(b - a for a, b in zip(v, v[1:], strict=False)) < 0.034 and v == sorted(v)


def test_polygons_from_files(spark, tmp_path):
    (tmp_path / "land.json").write_text('{"id": "a", "part": 0, "rank": 1, "x": [0, 2, 2, 0], "y": [0, 0, 2, 2]}\n{"id": "b", "part": 0, "rank": 10, "x": [0, 2, 2, 0], "y": [0, 0, 2, 2]}\n{"id": "c", "part": 0, "rank": null, "x": [0, 1, 2], "y": [0, 1, 2]}\n')
    kept = L.drop_placeholders(L.read_polygons(spark, str(tmp_path))).collect()
    assert [r.id for r in kept] == ["a"]


def test_upload_lost_after_the_grace(spark):
    from thermaquilt.operators import fleet as E

    rows = [("a", "2024-01-01 00:00:00", "compute"), ("a", "2024-01-01 01:00:00", "uploading"), ("a", "2024-01-01 01:30:00", "uploading"), ("b", "2024-01-01 02:59:00", "uploading"), ("c", "2024-01-01 01:00:00", "uploading"), ("c", "2024-01-01 02:00:00", "done")]
    s = spark.createDataFrame(rows, "tile string, at string, phase string").withColumn("at", F.col("at").cast("timestamp"))
    got = {r.tile: (r.state, str(r.since)) for r in E.settle_uploads(s, F.lit("2024-01-01 03:00:00"), 30).collect()}
    assert got == {"a": ("upload_lost", "2024-01-01 01:00:00"), "b": ("uploading", "2024-01-01 02:59:00"), "c": ("done", "2024-01-01 02:00:00")}


def test_box_join_does_not_shuffle_the_cells_of_the_large_side(spark, monkeypatch):
    from thermaquilt.operators import joins

    k = F.col("id")
    left = spark.range(500).select(k.alias("l"), (k % 60).alias("w"), (k % 40).alias("s"), (k % 60 + 5 + k % 13).alias("e"), (k % 40 + 4 + k % 9).alias("n"))
    right = spark.range(300).select(k.alias("r"), (k % 70).alias("w2"), (k % 50).alias("s2"), (k % 70 + 6).alias("e2"), (k % 50 + 3).alias("n2"))
    join = lambda: joins.box_join(left, right, ["w", "s", "e", "n"], ["w2", "s2", "e2", "n2"], step=8.0).select("l", "r")
    want = {(a.l, b.r) for a in left.collect() for b in right.collect() if a.w < b.e2 and b.w2 < a.e and a.s < b.n2 and b.s2 < a.n}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = join()
        assert "hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()
        rows = got.collect()
        assert len(rows) == len(want) and {(x.l, x.r) for x in rows} == want
        monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
        rows = join().collect()
        assert len(rows) == len(want) and {(x.l, x.r) for x in rows} == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_box_join_makes_its_pairs_list_by_list(spark, tmp_path):
    """A file of pairs takes a fraction of a byte for each; in the left side's order it takes bytes."""
    from thermaquilt.operators import joins

    k = F.col("id")
    h = lambda n: F.pmod(F.xxhash64("id"), F.lit(n))
    left = spark.range(30_000).select((k * 7).alias("l"), h(60).alias("w"), h(40).alias("s"), (h(60) + 5 + h(13)).alias("e"), (h(40) + 4 + h(9)).alias("n")).repartition(2, "l")
    right = spark.range(9_000).select(k.alias("r"), (k % 70).alias("w2"), (k % 50).alias("s2"), (k % 70 + 6).alias("e2"), (k % 50 + 3).alias("n2"))
    got = joins.box_join(left, right, ["w", "s", "e", "n"], ["w2", "s2", "e2", "n2"], step=8.0).select("l", "r")
    got.write.parquet(str(tmp_path / "pairs"), compression="snappy")
    size = sum(p.stat().st_size for p in (tmp_path / "pairs").glob("*.parquet"))
    x, y = (df.groupBy(*b).agg(F.count("*").alias(n)) for df, b, n in ((left, "wsen", "a"), (right, ("w2", "s2", "e2", "n2"), "b")))
    want = x.join(y, F.expr("w < e2 AND w2 < e AND s < n2 AND s2 < n")).agg(F.sum(F.col("a") * F.col("b"))).first()[0]
    pairs = spark.read.parquet(str(tmp_path / "pairs"))
    assert want > 5_000_000 and pairs.count() == want
    assert size < want / 2


def test_box_join_keeps_each_row_and_column(spark, monkeypatch):
    """Equal rows, nulls beside the box, boxes that only touch, and boxes with a null side."""
    from thermaquilt.operators import joins

    left = spark.createDataFrame([(1, 0.0, 0.0, 9.0, 9.0), (1, 0.0, 0.0, 9.0, 9.0), (2, -20.0, -9.5, -8.0, 0.5), (None, 8.0, 8.0, 16.0, 16.0), (3, None, 0.0, 9.0, 9.0)], "l int, w double, s double, e double, n double")
    rows = [("a", -0.0, 0.0, 1.0, 1.0, [1]), ("a", 0.0, 0.0, 1.0, 1.0, [1]), (None, 0.0, 0.0, 1.0, 1.0, None), ("t", 9.0, 0.0, 10.0, 9.0, []), ("c", -30.0, -30.0, 30.0, 30.0, None), ("d", 0.0, None, 1.0, 1.0, [])]
    right = spark.createDataFrame(rows, "r string, w2 double, s2 double, e2 double, n2 double, more array<int>")
    want = sorted(map(str, ((*a, *b) for a in left.collect() for b in right.collect() if None not in (*a[1:], *b[1:5]) and a.w < b.e2 and b.w2 < a.e and a.s < b.n2 and b.s2 < a.n)))
    assert len(want) == 11
    for most in (joins.BROADCAST_ROWS, 0):
        monkeypatch.setattr(joins, "BROADCAST_ROWS", most)
        got = joins.box_join(left, right, ["w", "s", "e", "n"], ["w2", "s2", "e2", "n2"], step=8.0)
        assert got.columns == [*left.columns, *right.columns]
        assert sorted(str(tuple(x)) for x in got.collect()) == want

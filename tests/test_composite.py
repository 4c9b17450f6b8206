"""Injected faults are found, weights add up, rules claim a pixel once, and stages survive a round trip."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from thermaquilt.operators import grid as G
from thermaquilt.operators import inventory as I
from thermaquilt.operators import joins as J
from thermaquilt.plans import composite as P
from thermaquilt.queries.inventory import _inventory
from thermaquilt.sources import artifacts as S


@pytest.fixture(scope="module")
def stack(spark):
    rng = np.random.default_rng(3)
    rows = []
    for s in range(24):
        bias = {5: 6.0, 17: -4.0}.get(s, 0.0)
        for y in range(4):
            for x in range(12):
                c = 25 + 0.1 * x + 12 * np.cos((s % 12) * np.pi / 6) + rng.normal(0, 0.2) + bias
                rows.append((s, s % 12 + 1, s % 2, 0, x, y, int(round((c - 149.0 + 273.15) / 0.00341802)), 64))
    # Each month is seen by two scenes only, so half of a bias would be in the reference: two more clean years.
    for s in range(24, 72):
        for y in range(4):
            for x in range(12):
                c = 25 + 0.1 * x + 12 * np.cos((s % 12) * np.pi / 6) + rng.normal(0, 0.2)
                rows.append((s, s % 12 + 1, s % 2, 0, x, y, int(round((c - 149.0 + 273.15) / 0.00341802)), 64))
    return spark.createDataFrame(rows, "scene_id long, month int, wrs_path int, wrs_row int, x int, y int, dn int, qa int")


@pytest.mark.parametrize("exact", [True, False])
def test_bias_is_recovered(stack, exact):
    off = {r.scene_id: r.offset for r in P.prep_offsets(P.valid_observations(stack), floor=10, exact=exact).collect()}
    assert off[5] == pytest.approx(6.0, abs=0.15) and off[17] == pytest.approx(-4.0, abs=0.15)
    assert max(abs(v) for k, v in off.items() if k not in (5, 17)) < 0.15


def test_rejected_scene_leaves_counts(stack):
    v = P.valid_observations(stack)
    off = P.prep_offsets(v, floor=10, cap=5.0)
    px = P.reduce_pixels(P.debias(v, off))
    assert {r.total for r in px.collect()} == {71}


def test_weights_sum_to_one_and_alone_is_one(spark):
    cells = spark.createDataFrame([(0, r, c) for r in range(4) for c in range(6)] + [(1, r, c) for r in range(4) for c in range(4, 10)], "wrs_path int, row int, col int")
    w = G.blend_weights(G.edge_distances(cells, G.boundary_segments(cells, "wrs_path", 4, 10), "wrs_path", 116**0.5)).collect()
    sums = {}
    for r in w:
        sums[r.row, r.col] = sums.get((r.row, r.col), 0) + r.weight
    assert all(v == pytest.approx(1) for v in sums.values())
    at = {(r.wrs_path, r.row, r.col): r.weight for r in w}
    assert at[0, 0, 0] == 1.0 and at[0, 1, 4] > at[0, 1, 5]


def test_rules_claim_a_pixel_once(stack):
    px = P.finalize_pixels(P.reduce_pixels(P.valid_observations(stack)).withColumn("water_class", F.col("x") < 6), F.col("y") > 0)
    rows = px.collect()
    assert not any(r.by_geometry and r.by_water for r in rows)
    assert all((r.dn == 0) == (r.y == 0 or r.x < 6) for r in rows)


def test_guarded_join_refuses(spark):
    rows = spark.createDataFrame([(1,), (2,)], "k int")
    assert J.align_to_time(rows, spark.createDataFrame([(1, 5.0), (1, 5.0), (2, 6.0)], "k int, v double"), "k", "v").count() == 2
    for bad in ([(1, 5.0), (1, 7.0), (2, 6.0)], [(1, 5.0)]):
        with pytest.raises(J.JoinIntegrityError):
            J.align_to_time(rows, spark.createDataFrame(bad, "k int, v double"), "k", "v")


def test_interval_join_is_no_nested_loop(spark):
    a = spark.range(100).selectExpr("id AS i", "double(id) AS lo", "id + 1.5D AS hi")
    b = spark.range(100).selectExpr("id AS j", "id + 0.5D AS l2", "id + 0.75D AS h2")
    out = J.interval_join(a, b, "lo", "hi", "l2", "h2", step=4.0)
    assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()
    assert {(r.i, r.j) for r in out.collect()} == {(i, j) for i in range(100) for j in range(100) if i < j + 0.75 and j + 0.5 < i + 1.5}


def test_antimeridian_footprint(spark):
    lon, lat = (178.0, -178.0, -178.5, 177.5), (11.0, 11.0, 9.0, 9.0)
    s = spark.createDataFrame([(1, True, *lon, *lat)], "id int, crosses_antimeridian boolean, " + ", ".join(f"corner_lon{i} double" for i in range(4)) + ", " + ", ".join(f"corner_lat{i} double" for i in range(4)))
    assert {r.tile_id for r in J.assign_tiles(s, G.iter_grid(spark)).collect()} == {"N15E175", "N15W180", "N10E175", "N10W180"}


def test_block_plan_keeps_empty_blocks_and_time_order(spark):
    sc = spark.createDataFrame([(7, 0, 200, 0, 0, 16, 16), (8, 1, 100, 0, 0, 17, 5)], "scene_id long, ord int, ts int, sx0 int, sy0 int, sx1 int, sy1 int")
    plan = {(r.brow, r.bcol): r.scenes for r in G.block_plan(G.plan_blocks(spark, 32, 48, 16), sc, chunk=16).collect()}
    assert len(plan) == 6 and plan[0, 0] == [8, 7] and plan[0, 1] == [8] and plan[1, 2] == []


def test_inventory_round_trip(spark, sf, tmp_path):
    rows = _inventory(spark, sf)
    I.write_inventory(rows, str(tmp_path / "inv"), {"schema_version": 1, "start": "a"})
    I.check_manifest(I.read_manifest(spark, str(tmp_path / "inv" / "manifest")), schema_version=1)
    with pytest.raises(I.ManifestError):
        I.check_manifest({"start": "a"}, start="b")
    tile = rows.first().tile_id
    items = I.items_for_tile(spark, str(tmp_path / "inv"), tile)
    assert items.count() == rows.where(F.col("tile_id") == tile).count()
    assert "PartitionFilters: [isnotnull(tile_id" in items._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(I.ManifestError):
        I.items_for_tile(spark, str(tmp_path / "inv"), "N00E000")


def test_prep_round_trip_and_refusals(spark, stack, tmp_path):
    v = P.valid_observations(stack)
    S.write_prep(str(tmp_path / "p"), P.prep_offsets(v, floor=10), P.swath_weights(v, factor=(2, 3), share=0.5, rows=2, cols=4), {"tile": "S30W065", "partial": False})
    off, _, meta = S.load_prep(spark, str(tmp_path / "p"), tile="S30W065")
    assert off.count() == 72 and meta["schema_version"] == S.PREP_VERSION
    with pytest.raises(I.ManifestError):
        S.load_prep(spark, str(tmp_path / "p"), tile="S30W060")


def test_cells_window(spark, tmp_path):
    cells = spark.createDataFrame([(r, c, 3, True) for r in range(10) for c in range(10)], "row int, col int, count int, covered boolean")
    S.write_cells(str(tmp_path / "c"), cells, {}, tile_cells=4)
    w = S.cells_for_window(spark, str(tmp_path / "c"), (7, 11), (3, 5), tile_cells=4)
    assert w.count() == 15 and w.where("covered").count() == 9 and w.where("NOT covered AND count = 0").count() == 6


def test_logs_and_lists(spark, tmp_path):
    (tmp_path / "a.log").write_text("MARKER prep rc=0 2024-01-01T00:00:00Z\nnoise\nMARKER bad\nBEAT 2024-01-01T00:05:00Z\nBEAT x\n")
    markers, beats = S.read_run_log(spark, str(tmp_path / "a.log"))
    assert markers.count() == 1 and beats.head().beat.minute == 5
    (tmp_path / "s.log").write_text("23:59:00 live=1 queued=2 done=3/9 peak=1 condemned=0\n00:01:00 live=1 queued=2 done=4/9 peak=1 condemned=0\nFAILED x\nSlowDown\n")
    shots, counts = S.read_status_log(spark, str(tmp_path / "s.log"), "2024-01-01")
    assert [r.at.day for r in shots.orderBy("at").collect()] == [1, 2] and tuple(counts.head()) == (1, 1)
    assert {r[0] for r in S.tile_tokens(spark, "n05w075, S30E010 # two\n\n").collect()} == {"N05W075", "S30E010"}
    for bad in ("N07W075", "N05W075 N05W075", "hello"):
        with pytest.raises(I.ManifestError):
            S.tile_tokens(spark, bad)

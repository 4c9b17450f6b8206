"""Checks before a run, and the synthetic source through the whole plan."""

import pytest
from pyspark.sql import functions as F

from thermaquilt.plans import composite as P
from thermaquilt.plans import sizing as Z
from thermaquilt.sources import rehearsal as R


def test_guards():
    Z.check_grid(3600)
    for bad in ({"per_degree": 3602}, {"per_degree": 3600, "prep_factor": 3}, {"per_degree": 3600, "block": 513}):
        with pytest.raises(Z.SetupError):
            Z.check_grid(**bad)
    with pytest.raises(Z.SetupError):
        Z.check_swath_grid(10, 11, 2)
    with pytest.raises(Z.SetupError):
        Z.resolve_area((0, 0, 5, 5), (4, 4, 6, 5))
    assert Z.grid_of(1 / 3600) == 3600 and Z.cells_per_pixel_block(3600) == (36, 1) and Z.raster_shape((0, 0, 5, 5), 3600) == (18000, 18000)
    with pytest.raises(Z.SetupError):
        Z.memory_guard(9 << 30, 10 << 30)
    assert len(Z.setting_matrix(a=[1, 2], b=[3, 4, 5])) == 6


def test_rehearsal_through_the_composite(spark, tmp_path):
    scenes = R.rehearsal_scenes(spark, 24, 10.0, 10.0)
    obs = R.rehearsal_observations(scenes, per_degree=6, water=(11.0, 11.0, 12.0, 12.0), seed=4)
    assert R.rehearsal_observations(scenes, per_degree=6, seed=4).agg(F.sum("dn")).head() == R.rehearsal_observations(scenes.repartition(7), per_degree=6, seed=4).agg(F.sum("dn")).head()
    px = P.reduce_pixels(P.valid_observations(obs))
    wet = px.where("water_class").collect()
    assert wet and all(66 <= r.x < 72 and 66 <= r.y < 72 for r in wet)
    dry = px.where("NOT water_class AND dn > 0").agg(F.avg(F.col("p95"))).head()[0]
    assert 49 < dry < 60
    px.select("y", "x", "dn").write.parquet(str(tmp_path / "px"))
    R.verify_written(px.select("y", "x", "dn"), str(tmp_path / "px"), "dn", 0, 65535)

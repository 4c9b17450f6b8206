"""Grid checks and memory arithmetic before a run: refuse a set-up that can't work instead of finding out late."""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermaquilt import constants as K

#: Resident bytes per pixel and scene of a block.
BYTES_PER_PIXEL_SCENE = 13


class SetupError(ValueError):
    """The settings don't fit together."""


def raster_shape(bbox: tuple[float, float, float, float], per_degree: int) -> tuple[int, int]:
    west, south, east, north = bbox
    return round((north - south) * per_degree), round((east - west) * per_degree)


def check_grid(per_degree: int, prep_factor: int = K.PREP_FACTOR, swath_factor: int = K.SWATH_FACTOR, block: int = K.PREP_BLOCK) -> None:
    """The prep grid must divide the output grid, the swath grid the prep grid, and a block hold whole swath cells."""
    ratio = swath_factor // prep_factor
    for ok, what in ((per_degree % prep_factor == 0, "prep grid"), (per_degree % swath_factor == 0 and swath_factor % prep_factor == 0, "swath grid"), (ratio and block % ratio == 0, "block")):
        if not ok:
            raise SetupError(f"the {what} does not divide {per_degree} pixels a degree evenly")


def check_swath_grid(height: int, width: int, ratio: int) -> None:
    if height % ratio or width % ratio:
        raise SetupError(f"{height} x {width} leaves a ragged edge of swath cells of {ratio}")


def cells_per_pixel_block(per_degree: int, cells_per_degree: int = 100) -> tuple[int, int]:
    """The least whole pixels and cells that cover the same ground."""
    from math import gcd

    g = gcd(per_degree, cells_per_degree)
    return per_degree // g, cells_per_degree // g


def resolve_area(tile: tuple[float, float, float, float], window: tuple[float, float, float, float] | None) -> tuple[float, float, float, float]:
    """The tile, or a window that lies inside it."""
    if window is None:
        return tile
    if not (tile[0] <= window[0] < window[2] <= tile[2] and tile[1] <= window[1] < window[3] <= tile[3]):
        raise SetupError(f"{window} is not inside {tile}")
    return window


def grid_of(pixel_size: float) -> int:
    """Pixels a degree of a pixel size; refuses what is no whole number."""
    n = 1 / pixel_size
    if abs(n - round(n)) > 1e-6:
        raise SetupError(f"{pixel_size} is no whole number of pixels a degree")
    return round(n)


def block_bytes(chunk: int, depth: int) -> int:
    return chunk * chunk * depth * BYTES_PER_PIXEL_SCENE


def memory_demand(plan: DataFrame, chunk: int, slots: int) -> int:
    """Bytes of the `slots` deepest blocks of a block plan, which may run at once."""
    deepest = plan.orderBy(F.desc("depth")).limit(slots).agg(F.coalesce(F.sum("depth"), F.lit(0))).head()[0]
    return block_bytes(chunk, int(deepest))


def memory_guard(demand: int, total: int, headroom: float = 0.8) -> None:
    if demand > headroom * total:
        raise SetupError(f"{demand / 2**30:.1f} GiB of blocks do not fit into {headroom:.0%} of {total / 2**30:.1f} GiB")


def memory_model(block: int, scenes_per_block: int, scenes: int, quads: int, swath_cells: int, slots: int) -> dict[str, int]:
    """Resident bytes of a prep run by part: blocks, histograms, their totals, quad coverage, results in flight."""
    hist = scenes * K.ANOMALY_BINS * 4
    return {"blocks": slots * block_bytes(block, scenes_per_block), "partials": slots * scenes_per_block * K.ANOMALY_BINS * 4, "totals": hist, "coverage": quads * swath_cells * 4, "in_flight": 2 * scenes_per_block * K.ANOMALY_BINS * 4}


def estimated_bytes(manifest: DataFrame, present: DataFrame, thermal: int, quality: int, margin: float = 1.15) -> DataFrame:
    """Bytes of the objects that aren't there yet, by a mean for each band and a margin."""
    size = F.when(F.col("band") == "lwir11", thermal).otherwise(quality)
    return manifest.join(present, ["item_id", "band"], "left_anti").agg((F.coalesce(F.sum(size), F.lit(0)) * margin).alias("bytes"), F.count(F.lit(1)).alias("objects"))


def setting_matrix(**choices: list) -> list[dict]:
    """Every combination of the settings, in order."""
    return [dict(zip(choices, values, strict=True)) for values in product(*choices.values())]

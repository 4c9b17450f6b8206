"""What must hold before a run spends any time: shapes, boxes, grids, metadata and the prep's provenance."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from thermaquilt.plans.sizing import SetupError, raster_shape

Bbox = tuple[float, float, float, float]
#: Keys that a run's metadata must have before its catalogue can be written; fixed values.
CATALOG_KEYS = ("bbox", "crs", "end", "pixels_per_degree", "raster", "start", "tile")


@dataclass(frozen=True)
class TileState:
    """A row of status output."""

    tile: str
    status: str
    phase: str | None = None
    minutes: float | None = None


def spatial_dims(geographic: bool) -> tuple[str, str]:
    """Names of a grid's rows and columns: degrees, or a projection's own axes."""
    return ("latitude", "longitude") if geographic else ("y", "x")


def swath_transform(bbox: Bbox, per_degree: int, swath_factor: int) -> tuple[float, float, float, float, float, float]:
    """(step x, 0, west, 0, -step y, north) of the coarse swath grid."""
    west, _, _, north = bbox
    step = 1 / (per_degree // swath_factor)
    return step, 0.0, west, 0.0, -step, north


def geographic_block_edges(transform: tuple[float, float, float, float, float, float], shape: tuple[int, int], chunk: int, geographic: bool = True) -> list[tuple[int, int, float, float, float, float]]:
    """(block row, block column, west, south, east, north) of every block of a north-up grid in degrees; others are refused."""
    a, b, c, d, e, f = transform
    if b or d:
        raise SetupError(f"the grid is rotated ({b}, {d}); blocks need north-up")
    if not geographic:
        raise SetupError("blocks compare footprints in degrees; composite on a geographic grid")
    rows, cols = ([*range(0, n, chunk), n] for n in shape)
    return [(i, j, c + a * cols[j], f + e * rows[i + 1], c + a * cols[j + 1], f + e * rows[i]) for i in range(len(rows) - 1) for j in range(len(cols) - 1)]


def check_raster_shape(shape: tuple[int, int], bbox: Bbox, per_degree: int) -> None:
    if tuple(shape) != raster_shape(bbox, per_degree):
        raise SetupError(f"{shape} is not the shape of {bbox} at {per_degree} pixels a degree, {raster_shape(bbox, per_degree)}")


def check_bbox_inside(whole: Bbox, bbox: Bbox) -> None:
    for axis, low, high in (("longitude", 0, 2), ("latitude", 1, 3)):
        if bbox[low] < whole[low] or bbox[high] > whole[high]:
            raise SetupError(f"{bbox} runs outside the {axis} span {whole[low]} to {whole[high]}")


def catalog_provenance(meta: dict) -> dict:
    """The metadata that a catalogue is written from; names every key that is missing."""
    missing = [k for k in CATALOG_KEYS if meta.get(k) is None]
    if missing:
        raise SetupError(f"the run's metadata lacks {', '.join(missing)}")
    return {k: meta[k] for k in CATALOG_KEYS}


def check_catalog_inputs(meta: dict, crs: str = "EPSG:4326") -> dict:
    """Provenance that the catalogue's writer will accept: complete, in degrees, and of the raster's shape."""
    own = catalog_provenance(meta)
    if own["crs"] != crs:
        raise SetupError(f"the degree grid needs {crs}, got {own['crs']}")
    check_raster_shape(tuple(own["raster"]), tuple(own["bbox"]), own["pixels_per_degree"])
    return own


def check_mask_inputs(manifests: dict[str, dict | None], wanted: dict[str, dict]) -> None:
    """Every mask artifact is there and was made with the parameters that this run wants."""
    for name, parameters in wanted.items():
        found = manifests.get(name)
        if found is None:
            raise SetupError(f"{name} is not there")
        for key, value in parameters.items():
            if found.get(key) != value:
                raise SetupError(f"{name} was made with {key} {found.get(key)!r}, this run wants {value!r}")


def check_prep(meta: dict, *, version: int, tile: str, per_degree: int, digest: str, inventory: str | None = None) -> None:
    """Six checks of a prep against the run: whole, of this version, tile and grid, over these scenes, from this inventory."""
    if meta.get("partial"):
        raise SetupError("the prep covers a part of its tile only")
    for key, value in (("schema_version", version), ("tile", tile), ("pixels_per_degree", per_degree), ("digest", digest)):
        if meta.get(key) != value:
            raise SetupError(f"the prep has {key} {meta.get(key)!r}, this run has {value!r}")
    if inventory and meta.get("inventory") and meta["inventory"] != inventory:
        raise SetupError(f"the prep is from inventory {meta['inventory']!r}, this run uses {inventory!r}")


def items_cache_name(bbox: Bbox, start: str, end: str, collection: str, platforms: str, cloud_lt: int) -> str:
    """The name under which a catalogue search is kept; another query has another one."""
    text = "|".join([",".join(f"{v:.6f}" for v in bbox), start, end, collection, platforms, str(cloud_lt)])
    return f"items-{hashlib.sha256(text.encode()).hexdigest()[:16]}.json"


def band_config(assets: dict[str, dict], asset: str) -> dict:
    """A band's scale, offset, nodata and unit as its asset names them; an asset without bands is refused."""
    bands = assets.get(asset, {}).get("bands") or []
    if not bands:
        raise SetupError(f"{asset} names no band")
    return {k: bands[0].get(k) for k in ("scale", "offset", "nodata", "unit")}


def stac_bands(rows: list[dict], unit: str, description: str) -> list[dict]:
    """Band entries of an asset from statistics rows (band, min, max, scale, offset, nodata)."""
    return [{"name": r["band"], "description": description, "unit": unit, "nodata": r["nodata"], "scale": r["scale"], "offset": r["offset"], "statistics": {"minimum": r["min"], "maximum": r["max"]}} for r in rows]


def item_for_files(scene: str, bands: dict[str, str], when: str, path: int, row: int) -> dict:
    """A catalogue item of one local scene."""
    return {"type": "Feature", "id": scene, "properties": {"datetime": when, "wrs_path": f"{path:03d}", "wrs_row": f"{row:03d}"}, "assets": {k: {"href": v} for k, v in sorted(bands.items())}}

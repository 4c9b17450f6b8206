"""Names, identifiers, digests and templates as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def path_of(path: Column) -> Column:
    return F.lpad(path.cast("string"), 3, "0")


def quad_of(path: Column, row: Column) -> Column:
    return F.struct(path_of(path).alias("path"), path_of(row).alias("row"))


def item_id_of(display_id: Column) -> Column:
    """A display id without its fifth part, the processing date."""
    parts = F.split(display_id, "_")
    return F.array_join(F.concat(F.slice(parts, 1, 4), F.slice(parts, 6, 99)), "_")


def asset_hrefs(root: str, display_id: Column, path: Column, row: Column, data_type: Column) -> tuple[Column, Column]:
    """Thermal and quality addresses; products without surface temperature have no thermal one."""
    base = F.concat(F.lit(root.rstrip("/") + "/"), path_of(path), F.lit("/"), path_of(row), F.lit("/"), display_id, F.lit("/"), display_id)
    return F.when(~data_type.endswith("SR"), F.concat(base, F.lit("_ST_B10.TIF"))), F.concat(base, F.lit("_QA_PIXEL.TIF"))


def tile_name(north: Column, west: Column) -> Column:
    ns, ew = F.when(north >= 0, "N").otherwise("S"), F.when(west >= 0, "E").otherwise("W")
    return F.concat(ns, F.lpad(F.abs(north).cast("int").cast("string"), 2, "0"), ew, F.lpad(F.abs(west).cast("int").cast("string"), 3, "0"))


def tile_corner(name: Column) -> tuple[Column, Column]:
    """North and west edge of a tile by its name."""
    north = F.substring(name, 2, 2).cast("int") * F.when(F.substring(name, 1, 1) == "S", -1).otherwise(1)
    west = F.substring(name, 5, 3).cast("int") * F.when(F.substring(name, 4, 1) == "W", -1).otherwise(1)
    return north, west


def edge_label(value: Column, positive: str, negative: str, width: int) -> Column:
    """One edge of a box, with its fraction if it has one, never rounded."""
    size = F.abs(value)
    whole = F.floor(size).cast("string")
    fraction = F.regexp_replace(F.regexp_extract(size.cast("string"), r"\.(\d+)$", 1), "0+$", "")
    return F.concat(F.when(value >= 0, positive).otherwise(negative), F.lpad(whole, width, "0"), F.when(fraction != "", F.concat(F.lit("."), fraction)).otherwise(F.lit("")))


def tile_id(north: Column, west: Column) -> Column:
    return F.concat(edge_label(north, "N", "S", 2), edge_label(west, "E", "W", 3))


def granule_cell(name: Column) -> tuple[Column, Column]:
    """The two signed whole numbers of a granule's name."""
    return tuple(F.regexp_extract(name, r"(-?\d+)\.(-?\d+)\.\w+$", i).try_cast("int") for i in (1, 2))


def rfc3339(value: Column) -> Column:
    timed = F.when(value.contains("T"), value).otherwise(F.concat(value, F.lit("T00:00:00")))
    return F.when(F.regexp_like(timed, F.lit(r"T.*(Z|[+-]\d\d:\d\d)$")), timed).otherwise(F.concat(timed, F.lit("Z")))


def window_label(start: Column, end: Column) -> Column:
    a, b = F.substring(start, 1, 4), F.substring(end, 1, 4)
    return F.when(a == b, a).otherwise(F.concat(a, F.lit("-"), b))


def datetime_range(start: Column, end: Column) -> Column:
    return F.concat_ws("/", start, end)


def multihash_sha256(content: Column) -> Column:
    return F.concat(F.lit("1220"), F.sha2(content, 256))


def short_digest(parts: list[Column], length: int) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, length)


def scene_digest(scene: Column, window: dict[str, str]) -> Column:
    """Aggregate: 16 hex digits over the window's settings and the sorted distinct scene ids."""
    head = [f"{k}={v}" for k, v in sorted(window.items())]
    return F.substring(F.sha2(F.array_join(F.concat(F.array(*map(F.lit, head)), F.sort_array(F.collect_set(scene.cast("string")))), "\n"), 256), 1, 16)


def split_uri(uri: Column) -> tuple[Column, Column]:
    """Bucket and key of an object's address; null for any other scheme."""
    found = F.regexp_like(uri, F.lit("^s3://[^/]+/.+"))
    return F.when(found, F.regexp_extract(uri, "^s3://([^/]+)/", 1)), F.when(found, F.regexp_extract(uri, "^s3://[^/]+/(.+)$", 1))


def staged_path(root: str, item: Column, band: Column, key: Column) -> Column:
    return F.concat_ws("/", F.lit(root.rstrip("/")), item, F.concat(band, F.lit("_"), F.regexp_extract(key, "([^/]+)$", 1)))


def https_url(bucket: Column, key: Column, region: str) -> Column:
    return F.concat(F.lit("https://"), bucket, F.lit(f".s3.{region}.amazonaws.com/"), key)


def parse_settings(text: Column) -> Column:
    return F.str_to_map(text, F.lit(","), F.lit("="))


def progress_bar(fraction: Column, width: int = 20) -> Column:
    n = F.floor(fraction * width).cast("int")
    return F.concat(F.repeat(F.lit("#"), n), F.repeat(F.lit("."), F.lit(width) - n))


def link_targets(markdown: Column) -> Column:
    """Targets of relative links."""
    return F.filter(F.regexp_extract_all(markdown, F.lit(r"\]\(([^)\s]+)\)"), 1), lambda t: ~F.regexp_like(t, F.lit("^([a-z]+:|#|/)")))


def error_code(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"\(([A-Za-z]+)\) when calling", 1), F.lit(""))


def status_fields(line: Column, day: Column) -> Column:
    """A status line `HH:MM:SS live=a queued=b done=c/d peak=e condemned=f` as a struct; null if it is none."""
    pattern = r"^(\d\d:\d\d:\d\d) live=(\d+) queued=(\d+) done=(\d+)/(\d+) peak=(\d+) condemned=(\d+)"
    part = lambda i: F.regexp_extract(line, pattern, i)
    numbers = [part(i + 2).try_cast("int").alias(n) for i, n in enumerate(("live", "queued", "done", "total", "peak", "condemned"))]
    return F.when(F.regexp_like(line, F.lit(pattern)), F.struct(F.try_to_timestamp(F.concat_ws(" ", day, part(1))).alias("at"), *numbers))


def marker_fields(line: Column) -> Column:
    """`MARKER phase rc=n time` as a struct; null for any other line."""
    pattern = r"^MARKER (\S+) rc=(-?\d+) (\S+)$"
    part = lambda i: F.regexp_extract(line, pattern, i)
    return F.when(F.regexp_like(line, F.lit(pattern)), F.struct(part(1).alias("phase"), part(2).try_cast("int").alias("rc"), F.try_to_timestamp(part(3)).alias("ts")))


def beat_time(line: Column) -> Column:
    return F.try_to_timestamp(F.nullif(F.regexp_extract(line, r"^BEAT (\S+)$", 1), F.lit("")))


def listing_fields(line: Column) -> Column:
    """`date time size key` of an object listing as (key, size); null for a malformed line."""
    pattern = r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d +(\d+) (.+)$"
    return F.when(F.regexp_like(line, F.lit(pattern)), F.struct(F.regexp_extract(line, pattern, 2).alias("key"), F.regexp_extract(line, pattern, 1).try_cast("long").alias("size")))


def coverage_properties(**columns: Column) -> Column:
    """JSON of the given columns: doubles to six places, nulls left out."""
    return F.to_json(F.struct(*[c.alias(k) for k, c in columns.items()]))


def multiline(*parts: Column) -> Column:
    """Paragraph of the parts that are not null."""
    return F.concat_ws(" ", *parts)


def fallback_sentence(share: Column) -> Column:
    return F.when(share > 0, F.format_string("%.1f%% of the valid pixels take the pooled percentile.", share * 100))


def correction_text(rejected: Column, cap: Column, share: Column) -> Column:
    return multiline(F.format_string("Scenes are corrected by one offset each; %d beyond %.0f degrees are left out.", rejected, cap), fallback_sentence(share))


def mask_text(scope: Column, buffer_cells: Column, digest: Column) -> Column:
    return multiline(F.when(scope == "land", F.lit("Pixels outside the land geometry are nodata.")), F.when(buffer_cells > 0, F.format_string("Gaps are widened by %d cells.", buffer_cells)), F.when(digest.isNotNull(), F.concat(F.lit("Strict land: "), F.substring(digest, 1, 12), F.lit("."))))


def seam_verdict(mean_diff: Column, worst: Column) -> Column:
    return F.when(mean_diff.isNull(), "no shared scenes").when((mean_diff < 0.1) & (worst < 0.5), "agree").when(mean_diff < 0.5, "close").otherwise("differ")

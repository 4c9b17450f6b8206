"""Fixed values that define the product's semantics."""

# Decoding of the thermal band: celsius = dn * SCALE + OFFSET - KELVIN.
SCALE, OFFSET, KELVIN = 0.00341802, 149.0, 273.15
FILL = 0
EXCLUDED_BITS = (1, 2, 3, 4, 5)
EXCLUDED_MASK = 62
LEGACY_MASK = 24
WATER_BIT = 7
OBSERVED_RANGE = (-50.0, 80.0)
OUTPUT_RANGE = (-20.0, 80.0)
# Encoding of the output: dn = rint((celsius - ENCODE_ZERO) / ENCODE_STEP), valid from FIRST_DN to LAST_DN, else NODATA.
ENCODE_ZERO, ENCODE_STEP = -50.0, 0.01
FIRST_DN, LAST_DN, NODATA = 2, 65535, 0
MIN_OBSERVATIONS = 5
WATER_SHARE, WATER_FLOOR, WATER_CEILING = 0.90, 5, 34.0
MAX_OFFSET, MIN_SAMPLES, MIN_PATH_OBSERVATIONS = 15.0, 200, 5
ANOMALY_LOW, ANOMALY_HIGH, ANOMALY_STEP, ANOMALY_BINS = -130.0, 130.0, 0.01, 26000
SWATH_FACTOR, QUAD_SHARE, WEIGHT_FACTOR = 8, 0.5, 4
PERCENTILE = 0.95
PREP_FACTOR, PREP_MARGIN, PREP_BLOCK, COMPOSITE_BLOCK = 4, 1.0, 512, 360
WINDOW_START, WINDOW_END = "2021-01-01T00:00:00Z", "2025-12-31T23:59:59Z"
PLATFORMS, CLOUD_LT, MONTH_GUARD_SECONDS = ("landsat-8", "landsat-9"), 100, 30
TILE_DEGREES, LAT_LIMIT, BUFFER_METERS = 5, 60, 25000
SATURATED = 255
# Cost model of a tile: seconds = COST_BASE + COST_PER_SCENE * scenes.
COST_BASE, COST_PER_SCENE, COST_RATE_HOUR = 816.6, 0.29843, 3.7968
STALL_MINUTES, UPLOAD_GRACE_MINUTES, RATE_WINDOW_MINUTES = 5, 12, 30
PUBLISHED_SUFFIXES = (".tif", ".json", ".parquet", ".png", ".md", ".txt")
EARTH_RADIUS_KM = 6371.0072

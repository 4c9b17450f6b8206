"""Accounts of runs and tiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermaquilt import constants as K
from thermaquilt.functions import quality as Q
from thermaquilt.functions import text as T
from thermaquilt.operators import accounts as N
from thermaquilt.operators import fleet as E
from thermaquilt.operators import inventory as I
from thermaquilt.queries import query
from thermaquilt.sources import artifacts as S
from thermaquilt.sources.mapping import CELLS_SQL, LAND_SQL, OBS_SQL, cells, land, observations, table


def _r(*names: str, digits: int = 6) -> list:
    return [F.round(n, digits).alias(n) for n in names]


@query("SELECT p_partkey, substr(sha256(p_name || '|' || coalesce(CASE WHEN p_size % 3 <> 0 THEN p_type END, '') || '|' || coalesce(CASE WHEN p_size % 4 <> 0 THEN p_brand END, '')), 1, 16) AS version FROM part")
def source_version_key(spark: SparkSession, d: str) -> DataFrame:
    some = lambda n, c: F.when(F.col("p_size") % n != 0, F.col(c))
    return table(spark, d, "part").select("p_partkey", N.source_key(F.col("p_name"), some(3, "p_type"), some(4, "p_brand")).alias("version"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def items_by_id_list(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return N.by_ids(table(spark, d, "customer").select("c_custkey", "c_name"), ids, "c_custkey")


@query("SELECT DISTINCT c_nationkey AS tile_id FROM customer")
def tile_id_listing(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("tile_id")).distinct().orderBy("tile_id")


@query("SELECT p_partkey, CAST(least(greatest(CASE WHEN v = -9999 THEN 0 ELSE v END, 0), 255) AS INTEGER) AS count FROM (SELECT p_partkey, CAST(CASE WHEN p_partkey % 11 = 0 THEN -9999 ELSE p_size*9 - 40 END AS INTEGER) AS v FROM part)")
def count_grid_cleaning(spark: SparkSession, d: str) -> DataFrame:
    v = F.when(F.col("p_partkey") % 11 == 0, -9999).otherwise(F.col("p_size") * 9 - 40).cast("int")
    return table(spark, d, "part").select("p_partkey", N.clean_counts(v).cast("int").alias("count"))


_GRANULE = "gn AS (SELECT p_partkey, 'AG100.v003.' || CASE WHEN p_partkey % 3 = 0 THEN '-' ELSE '' END || lpad((p_partkey % 59)::VARCHAR, 2, '0') || '.' || CASE WHEN p_partkey % 2 = 0 THEN '-' ELSE '' END || lpad((p_partkey % 179)::VARCHAR, 3, '0') || '.h5' AS name, (p_partkey % 59)*CASE WHEN p_partkey % 3 = 0 THEN -1 ELSE 1 END AS north, (p_partkey % 179)*CASE WHEN p_partkey % 2 = 0 THEN -1 ELSE 1 END AS west FROM part)"


def _granules(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    sign = lambda n: F.when(k % n == 0, "-").otherwise("")
    return table(spark, d, "part").select(k, F.concat(F.lit("AG100.v003."), sign(3), F.lpad((k % 59).cast("string"), 2, "0"), F.lit("."), sign(2), F.lpad((k % 179).cast("string"), 3, "0"), F.lit(".h5")).alias("name"))


@query(f"WITH {_GRANULE} SELECT p_partkey, CAST(north AS INTEGER) AS north, CAST(west AS INTEGER) AS west FROM gn")
def granule_names(spark: SparkSession, d: str) -> DataFrame:
    north, west = T.granule_cell(F.col("name"))
    return _granules(spark, d).select("p_partkey", north.cast("int").alias("north"), west.cast("int").alias("west"))


@query(f"WITH {_GRANULE}, w AS (SELECT CAST(s_suppkey % 59 AS INTEGER) AS north, CAST(-(s_suppkey % 179) AS INTEGER) AS west FROM supplier) SELECT DISTINCT north, west FROM w WHERE (north, west) NOT IN (SELECT (CAST(north AS INTEGER), CAST(west AS INTEGER)) FROM gn)")
def missing_granule_cells(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    wanted = table(spark, d, "supplier").select((k % 59).cast("int").alias("north"), (-(k % 179)).cast("int").alias("west")).distinct()
    return S.missing_granules(wanted, _granules(spark, d).select("name"))


@query("SELECT upper(token) AS token, count(*) AS n FROM (SELECT unnest(string_split_regex(regexp_replace(p_name || ', ' || p_brand || CASE WHEN p_size % 4 = 0 THEN ' # ' || p_type ELSE ' ' || p_type END, '#.*', ''), '[,\\s]+')) AS token FROM part) WHERE token <> '' GROUP BY 1")
def exclusion_tokens(spark: SparkSession, d: str) -> DataFrame:
    line = F.concat("p_name", F.lit(", "), "p_brand", F.when(F.col("p_size") % 4 == 0, F.lit(" # ")).otherwise(F.lit(" ")), "p_type")
    return N.tokens_of(table(spark, d, "part").select(line.alias("line")), "line").groupBy("token").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_acctbal >= 0 AND c_custkey % 3 <> 0 AND c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_custkey % 100 < 20 AND c_nationkey + 2 >= 4 AND c_nationkey <= 15")
def catalogue_search(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").where("c_acctbal >= 0")
    n = F.col("c_nationkey").cast("double")
    items = c.select("c_custkey", "c_name", n.alias("bbox_west"), F.lit(0.0).alias("bbox_south"), (n + 2).alias("bbox_east"), F.lit(1.0).alias("bbox_north"), F.when(F.col("c_custkey") % 3 != 0, F.lit("2021-05-01")).otherwise(F.lit("2019-05-01")).cast("timestamp").alias("datetime"), (F.col("c_custkey") % 100).cast("double").alias("cloud_cover"), F.col("c_mktsegment").alias("platform"))
    return I.search_items(items, (4.0, 0.0, 15.0, 1.0), "2021-01-01", "2022-01-01", ("BUILDING", "MACHINERY"), 20).select("c_custkey", "c_name")


@query("SELECT count(*) FILTER (l_orderkey % 7 = 0) AS dropped, count(*) FILTER (l_orderkey % 7 <> 0) AS kept FROM lineitem")
def scenes_without_thermal(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "lineitem").select(F.when(F.col("l_orderkey") % 7 != 0, F.lit("s3://b/t")).alias("thermal_href"))
    kept, dropped = I.thermal_only(items)
    return dropped.crossJoin(F.broadcast(kept.agg(F.count(F.lit(1)).alias("kept")))).select("dropped", "kept")  # one row each


@query(f"WITH {OBS_SQL} SELECT scene_id, y, x, round(dn*{K.ENCODE_STEP}::DOUBLE + {K.ENCODE_ZERO}::DOUBLE, 6) AS c FROM (SELECT scene_id, y, x, dn // 4 AS dn FROM obs)")
def decoded_output(spark: SparkSession, d: str) -> DataFrame:
    o = observations(spark, d).select("scene_id", "y", "x", F.floor(F.col("dn") / 4).cast("int").alias("dn"))
    return o.select("scene_id", "y", "x", F.round(Q.decode(F.col("dn")), 6).alias("c"))


@query("SELECT o_orderkey, CASE WHEN rate > 0 THEN o_orderdate + to_seconds(round((total - done)/rate*3600)) END AS eta FROM (SELECT *, CAST(o_orderkey % 50 AS DOUBLE) AS done, 60.0::DOUBLE AS total, CAST(o_custkey % 5 AS DOUBLE) AS rate FROM orders)")
def run_eta(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate", (F.col("o_orderkey") % 50).cast("double").alias("done"), F.lit(60.0).alias("total"), (F.col("o_custkey") % 5).cast("double").alias("rate"))
    return o.select("o_orderkey", E.eta(F.col("o_orderdate"), F.col("done"), F.col("total"), F.col("rate")).cast("timestamp_ntz").alias("eta"))


_OBJECTS = "ob AS (SELECT 'runs/' || c_mktsegment || '/' || (c_nationkey % 3) || '/' || c_custkey || '.tif' AS key, CAST(floor(abs(c_acctbal)) AS BIGINT) AS size FROM customer UNION ALL SELECT 'other/' || c_custkey, 1 FROM customer)"


def _objects(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    own = c.select(F.concat_ws("/", F.lit("runs"), "c_mktsegment", (F.col("c_nationkey") % 3).cast("string"), F.concat(F.col("c_custkey").cast("string"), F.lit(".tif"))).alias("key"), F.floor(F.abs("c_acctbal")).cast("long").alias("size"))
    return own.unionByName(c.select(F.concat(F.lit("other/"), F.col("c_custkey").cast("string")).alias("key"), F.lit(1).cast("long").alias("size")))


@query(f"WITH {_OBJECTS} SELECT 'runs/' || split_part(key, '/', 2) || '/' || split_part(key, '/', 3) AS prefix, count(*) AS objects, CAST(sum(size) AS BIGINT) AS bytes FROM ob WHERE key LIKE 'runs/%' GROUP BY 1")
def prefix_totals(spark: SparkSession, d: str) -> DataFrame:
    return N.listing_totals(_objects(spark, d), "runs/", 2)


@query(f"WITH {_OBJECTS} SELECT DISTINCT 'runs/' || split_part(key, '/', 2) AS prefix FROM ob WHERE key LIKE 'runs/%'")
def run_prefixes(spark: SparkSession, d: str) -> DataFrame:
    return N.listing_totals(_objects(spark, d), "runs/", 1).select("prefix")


@query("SELECT c_nationkey AS tile_id, count(*) AS scenes FROM customer GROUP BY 1")
def planned_scene_counts(spark: SparkSession, d: str) -> DataFrame:
    """The plan as one document with an array of tiles, a row a nation."""
    tiles = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("tile_id")).agg(F.count(F.lit(1)).alias("scenes"))
    return N.scene_counts(tiles.agg(F.collect_list(F.struct("tile_id", "scenes")).alias("tiles")))


@query("SELECT o_orderpriority AS collection, min(o_orderdate) AS start, max(o_orderdate + to_days(CAST(o_custkey % 9 AS INTEGER))) AS end, count(*) AS n FROM orders GROUP BY 1")
def temporal_extent(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(F.col("o_orderpriority").alias("collection"), F.col("o_orderdate").alias("a"), (F.col("o_orderdate") + F.make_dt_interval(F.col("o_custkey").cast("int") % 9)).alias("b"))
    return N.interval_union(o, "collection", "a", "b")


@query("""WITH s AS (SELECT o_orderkey, epoch_us(o_orderdate) + (o_orderkey % 30)*1000000 + CASE WHEN o_orderkey % 4 = 0 THEN 250000 ELSE 0 END AS a, 20000000 + (o_orderkey % 7)*1000001 AS len, o_orderkey % 4 = 0 AS sub FROM orders),
  g AS (SELECT *, CASE WHEN o_orderkey % 9 <> 0 THEN (a + len//2 - (a + 10000000))/1e6 END AS gap FROM s)
  SELECT count(gap) AS compared, count(*) FILTER (gap IS NULL) AS not_found, round(max(abs(gap)), 6) AS worst, round(median(abs(gap)), 6) AS median, round(avg(gap), 6) AS mean_signed, count(*) FILTER (gap IS NOT NULL AND sub) AS sub_second, round(max(abs(gap)) FILTER (sub), 6) AS worst_sub_second, round(max(abs(gap)) FILTER (NOT sub), 6) AS worst_whole_second FROM g""")
def scene_centre_gaps(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    base = F.unix_micros(F.col("o_orderdate").cast("timestamp")) + (k % 30) * 1000000 + F.when(k % 4 == 0, 250000).otherwise(0)
    o = table(spark, d, "orders").withColumn("a", base)
    scenes = o.select(k, F.timestamp_micros("a").alias("start"), F.timestamp_micros(F.col("a") + 20000000 + (k % 7) * 1000001).alias("stop"), (k % 4 == 0).alias("sub_second"))
    published = o.where(k % 9 != 0).select(k, F.timestamp_micros(F.col("a") + 10000000).alias("at"))
    return N.centre_gaps(scenes, published, "o_orderkey").select("compared", "not_found", *_r("worst", "median", "mean_signed"), "sub_second", *_r("worst_sub_second", "worst_whole_second"))


_CLAIM = "cl AS (SELECT l_suppkey % 40 AS tile_id, CASE WHEN l_suppkey % 4 = 0 THEN 1 ELSE 0 END AS thermal, l_partkey % 3 <> 0 AS land, l_partkey % 5 <> 0 AS covered, l_linenumber % 4 AS count FROM lineitem)"


@query(f"WITH {_CLAIM}, t AS (SELECT tile_id, max(thermal) AS thermal, count(*) FILTER (land) AS land_cells, count(*) FILTER (land AND covered) AS with_granule, count(*) FILTER (land AND covered AND count > 0) AS with_emissivity FROM cl GROUP BY 1) SELECT tile_id, land_cells, with_granule, with_emissivity, round(coalesce(with_emissivity::DOUBLE/nullif(land_cells, 0), 0), 6) AS share FROM t WHERE thermal = 0 ORDER BY with_emissivity::DOUBLE/nullif(land_cells, 0) DESC NULLS LAST, tile_id LIMIT 20")
def tile_emissivity_claim(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("l_suppkey")
    c = table(spark, d, "lineitem").select((k % 40).alias("tile_id"), F.when(k % 4 == 0, 1).otherwise(0).alias("thermal"), (F.col("l_partkey") % 3 != 0).alias("land"), (F.col("l_partkey") % 5 != 0).alias("covered"), (F.col("l_linenumber") % 4).alias("count"))
    return N.tile_claim(c).withColumn("share", F.round("share", 6))


_TILES = "tp AS (SELECT l_suppkey % 60 AS tile_id, l_suppkey % 60 <> 7 AND l_partkey % 3 <> 0 AS strict, l_partkey % (2 + l_suppkey % 9) = 0 AS gap FROM lineitem), tc AS (SELECT tile_id, count(*) FILTER (strict) AS land, count(*) FILTER (strict AND gap) AS gap, count(*) FILTER (strict AND gap)::DOUBLE/nullif(count(*) FILTER (strict), 0) AS gap_share FROM tp GROUP BY 1)"


def _tile_pixels(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("l_suppkey")
    return table(spark, d, "lineitem").select((k % 60).alias("tile_id"), ((k % 60 != 7) & (F.col("l_partkey") % 3 != 0)).alias("strict"), (F.col("l_partkey") % (k % 9 + 2) == 0).alias("gap"))


@query(f"WITH {_TILES} SELECT tile_id, land, gap, round(gap_share, 6) AS gap_share FROM tc")
def tile_coverage_rows(spark: SparkSession, d: str) -> DataFrame:
    return N.tile_coverage(_tile_pixels(spark, d)).withColumn("gap_share", F.round("gap_share", 6))


@query(f"WITH {_TILES}, k AS (SELECT *, row_number() OVER (ORDER BY gap_share NULLS LAST, tile_id) - 1 AS place, count(gap_share) OVER () AS n FROM tc) SELECT count(*) AS tiles, count(*) FILTER (land = 0) AS bare, round(count(*) FILTER (gap_share < 0.05)/max(n)::DOUBLE, 6) AS under_low, round(count(*) FILTER (gap_share < 0.2)/max(n)::DOUBLE, 6) AS under_mid, round(max(gap_share) FILTER (place = n//2), 6) AS p50, count(*) FILTER (gap_share > 0.4) AS heavy, round(coalesce(sum(land) FILTER (gap_share > 0.4), 0)/sum(land)::DOUBLE, 6) AS heavy_land FROM k")
def coverage_report(spark: SparkSession, d: str) -> DataFrame:
    return N.coverage_report(N.tile_coverage(_tile_pixels(spark, d))).select("tiles", "bare", *_r("under_low", "under_mid", "p50"), "heavy", *_r("heavy_land"))


@query("SELECT n_nationkey AS tile_id, CASE WHEN n_nationkey % 3 <> 0 THEN n_name END AS name, n_nationkey % 3 <> 0 AS runnable FROM nation")
def coverage_plan_rows(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("tile_id"), F.col("n_name").alias("name"))
    plan = n.where("tile_id % 3 <> 0")
    lists = [n.where(f"tile_id % 2 = {i}").select("tile_id") for i in (0, 1)]
    return S.coverage_rows(lists, plan, plan).select("tile_id", "name", "runnable")


_WET = f"{OBS_SQL}, px AS (SELECT y, x, count(*) FILTER (dn <> 0 AND (qa & 62) = 0 AND c BETWEEN -50 AND 80) AS clear, count(*) FILTER (dn <> 0 AND (qa & 62) = 0 AND c BETWEEN -50 AND 80 AND (qa & 128) <> 0) AS water, {LAND_SQL} AS published FROM dec GROUP BY y, x)"
_THRESHOLDS = (0.25, 0.5, 0.75, 0.9)


@query(f"WITH {_WET}, s AS (SELECT *, water::DOUBLE/nullif(clear, 0) AS share FROM px) SELECT count(*) AS pixels, count(*) FILTER (share IS NULL) AS unobserved, " + ", ".join(f"round(quantile_cont(clear, {q / 100}) FILTER (share IS NOT NULL), 6) AS depth_{q}, round(quantile_cont(share, {q / 100}), 6) AS share_{q}" for q in N.QUANTILES) + ", " + ", ".join(f"count(*) FILTER (share >= {t}) AS hit{i}, count(*) FILTER (share >= {t} AND published) AS withdrawn{i}" for i, t in enumerate(_THRESHOLDS)) + " FROM s")
def water_share_summary(spark: SparkSession, d: str) -> DataFrame:
    ok = Q.valid_observation(F.col("dn"), F.col("qa"), Q.to_celsius(F.col("dn")))
    px = observations(spark, d).groupBy("y", "x").agg(F.count_if(ok).alias("clear"), F.count_if(ok & Q.qa_water(F.col("qa"))).alias("water")).withColumn("published", land())
    s = N.water_summary(px, _THRESHOLDS)
    at = [F.round(F.col(f"{c}s")[i], 6).alias(f"{c}_{q}") for i, q in enumerate(N.QUANTILES) for c in ("depth", "share")]
    return s.select("pixels", "unobserved", *at, *[f"{c}{i}" for i in range(len(_THRESHOLDS)) for c in ("hit", "withdrawn")])


@query("SELECT s_nationkey, round(coalesce(count(*) FILTER (s_suppkey % 4 = 0 AND s_acctbal > 0)::DOUBLE/nullif(count(*) FILTER (s_acctbal > 0), 0), 0), 6) AS pooled FROM supplier GROUP BY 1")
def pooled_fallback_share(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier").groupBy("s_nationkey").agg(F.count_if((F.col("s_suppkey") % 4 == 0) & (F.col("s_acctbal") > 0)).alias("f"), F.count_if(F.col("s_acctbal") > 0).alias("r"))
    return s.select("s_nationkey", F.round(N.pooled_share(F.col("f"), F.col("r")), 6).alias("pooled"))


@query("SELECT 'i' || c_custkey AS name, c_nationkey AS tile FROM customer WHERE c_custkey % 6 <> 0 AND c_nationkey % 4 = 1 AND c_custkey % 10 <> 3")
def reapable_instances(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    i = table(spark, d, "customer").select(F.col("c_nationkey").alias("tile"), F.concat(F.lit("i"), k.cast("string")).alias("name"), F.when(k % 6 != 0, k.cast("string")).alias("instance_id"), (k % 10 == 3).alias("gone"))
    n = F.col("n_nationkey")
    states = table(spark, d, "nation").select(n.alias("tile"), F.when(n % 2 == 1, "finished").otherwise("running").alias("status"), F.when(n % 4 == 1, "uploaded").otherwise("publish").alias("phase"))
    return N.reapable(i.drop("gone"), states, i.where("gone").select("name")).select("name", "tile")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderdate <= TIMESTAMP '1996-01-01'")
def overdue_rows(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderdate")).alias("deadline"))
    return N.overdue(o, F.lit("1996-01-01").cast("timestamp_ntz"), "deadline").select("o_orderkey")


@query("""WITH mk AS (SELECT user_id, event_type, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_type) AS r FROM (SELECT user_id, event_type, max(event_id) AS event_id, ts FROM events WHERE event_type <> 'view' GROUP BY user_id, event_type, ts)) WHERE r = 1),
  u AS (SELECT user_id, max(ts) AS beat FROM events GROUP BY 1), n AS (SELECT max(ts) AS now FROM events)
  SELECT u.user_id AS tile, CASE WHEN u.user_id % 10 = 0 THEN 'done' WHEN event_id % 8 = 5 THEN 'failed:' || event_type WHEN u.user_id % 7 = 0 THEN 'died' WHEN event_type IS NULL THEN 'starting' WHEN (epoch_us(TIMESTAMP '2100-01-01') - epoch_us(CASE WHEN u.user_id % 3 = 0 THEN TIMESTAMP '2100-01-01' ELSE beat END))/60000000.0::DOUBLE > 600 THEN 'stalled' ELSE 'running:' || event_type END AS state FROM u LEFT JOIN mk USING (user_id)""")
def poll_run_states(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    name = F.concat(F.lit("r"), F.col("user_id").cast("string"))
    runs = e.select(F.col("user_id").alias("tile"), name.alias("name"), F.concat(F.lit("i"), F.col("user_id").cast("string")).alias("instance_id")).distinct()
    marks = e.where("event_type <> 'view'").groupBy(name.alias("name"), F.col("event_type").alias("phase"), F.col("ts").alias("at")).agg((F.max("event_id") % 8 == 5).cast("int").alias("rc"))
    now = F.lit("2100-01-01").cast("timestamp_ntz")
    beats = e.groupBy(name.alias("name"), "user_id").agg(F.max("ts").alias("b")).select("name", F.when(F.col("user_id") % 3 == 0, now).otherwise(F.col("b")).alias("at"))
    manifests = runs.where("tile % 10 = 0").select("name")
    alive = runs.where("tile % 7 <> 1").select("instance_id", (F.col("tile") % 7 != 0).alias("alive"))
    # Lateness is counted from a fixed time, so that some of the runs stall.
    return N.poll_states(runs, marks, beats, manifests, alive, now).select("tile", "state")


@query("WITH s AS (SELECT date_trunc('day', ts) AS stamp, count(*) AS done FROM events GROUP BY 1), c AS (SELECT stamp, sum(done) OVER (ORDER BY stamp) AS done, (SELECT count(*) FROM events)*2 AS total FROM s) SELECT CAST(min_by(done, stamp) AS BIGINT) AS first, CAST(max_by(done, stamp) AS BIGINT) AS last, CAST(max_by(total, stamp) AS BIGINT) AS total, round(100.0::DOUBLE*max_by(done, stamp)/max_by(total, stamp), 6) AS percent, true AS stale FROM c")
def run_progress(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    e = table(spark, d, "events")
    days = e.groupBy(F.date_trunc("day", F.col("ts")).alias("at")).agg(F.count(F.lit(1)).alias("n"))
    shots = days.select("at", F.sum("n").over(Window.orderBy("at")).alias("done"))  # a row a day
    total = e.agg((F.count(F.lit(1)) * 2).alias("total"))
    s = N.progress(shots.crossJoin(F.broadcast(total)), F.lit("2100-01-01").cast("timestamp"), 30.0)
    return s.withColumn("percent", F.round("percent", 6))


@query("SELECT c_custkey, 'a' || c_custkey || '.md' AS target FROM customer UNION ALL SELECT c_custkey, '../b.md' FROM customer WHERE c_custkey % 2 = 0")
def markdown_link_targets(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    text = F.concat(F.lit("See [x](a"), k.cast("string"), F.lit(".md) and [site](https://example.org/y) "), F.when(k % 2 == 0, "[up](../b.md)").otherwise(""))
    return table(spark, d, "customer").select("c_custkey", F.explode(T.link_targets(text)).alias("target"))


@query("SELECT s_suppkey, lpad((s_suppkey % 233)::VARCHAR, 3, '0') AS path, lpad((s_suppkey % 233)::VARCHAR, 3, '0') || lpad((s_suppkey % 248)::VARCHAR, 3, '0') AS quad FROM supplier")
def path_and_quad(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    return table(spark, d, "supplier").select("s_suppkey", T.path_of((k % 233).cast("int")).alias("path"), F.concat(T.quad_of((k % 233).cast("int"), (k % 248).cast("int"))["path"], T.quad_of((k % 233).cast("int"), (k % 248).cast("int"))["row"]).alias("quad"))


@query(f"WITH {CELLS_SQL} SELECT row, col, count FROM cells WHERE count >= 0 AND covered")
def covered_cells(spark: SparkSession, d: str) -> DataFrame:
    return cells(spark, d).where("covered").select("row", "col", "count")

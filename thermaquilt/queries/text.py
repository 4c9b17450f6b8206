"""Names, digests, log lines and texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermaquilt.functions import text as T
from thermaquilt.queries import query
from thermaquilt.sources.mapping import OBS_SQL, observations, table


@query("WITH t AS (SELECT s_suppkey, CAST(s_suppkey % 24 * 5 - 55 AS INTEGER) AS n, CAST(s_suppkey % 72 * 5 - 180 AS INTEGER) AS w FROM supplier) SELECT s_suppkey, (CASE WHEN n >= 0 THEN 'N' ELSE 'S' END) || lpad(abs(n)::VARCHAR, 2, '0') || (CASE WHEN w >= 0 THEN 'E' ELSE 'W' END) || lpad(abs(w)::VARCHAR, 3, '0') AS name, n AS north, w AS west FROM t")
def tile_name_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier").select("s_suppkey", T.tile_name(F.col("s_suppkey") % 24 * 5 - 55, F.col("s_suppkey") % 72 * 5 - 180).alias("name"))
    north, west = T.tile_corner(F.col("name"))
    return s.select("s_suppkey", "name", north.alias("north"), west.alias("west"))


@query("SELECT s_suppkey, 'N' || lpad((s_suppkey % 60)::VARCHAR, 2, '0') || CASE WHEN s_suppkey % 2 = 1 THEN '.5' ELSE '' END || 'W' || lpad((s_suppkey % 170 + 1)::VARCHAR, 3, '0') || CASE WHEN s_suppkey % 4 = 1 THEN '.25' ELSE '' END AS id FROM supplier")
def tile_id_fraction(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    north = k % 60 + F.when(k % 2 == 1, 0.5).otherwise(0.0)
    west = -(k % 170 + 1 + F.when(k % 4 == 1, 0.25).otherwise(0.0))
    return table(spark, d, "supplier").select("s_suppkey", T.tile_id(north, west).alias("id"))


@query(f"WITH {OBS_SQL} SELECT wrs_path, substr(sha256('collection=c2' || chr(10) || 'end=2025' || chr(10) || 'start=2021' || chr(10) || string_agg(DISTINCT scene_id::VARCHAR, chr(10) ORDER BY scene_id::VARCHAR)), 1, 16) AS digest FROM obs GROUP BY wrs_path")
def scene_digest(spark: SparkSession, d: str) -> DataFrame:
    return observations(spark, d).groupBy("wrs_path").agg(T.scene_digest(F.col("scene_id"), {"start": "2021", "end": "2025", "collection": "c2"}).alias("digest"))


@query("SELECT doc_id, '1220' || sha256(text) AS checksum, substr(sha256(source || '|' || lang || '|' || doc_id::VARCHAR), 1, 12) AS short FROM documents")
def multihash(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", T.multihash_sha256(F.col("text").cast("binary")).alias("checksum"), T.short_digest([F.col("source"), F.col("lang"), F.col("doc_id").cast("string")], 12).alias("short"))


@query("SELECT page_id, len(regexp_extract_all(html, 'href=')) AS links, len(regexp_extract_all(html, '<p')) AS paragraphs, regexp_extract(url, '^(\\w+)://', 1) AS scheme, regexp_extract(url, '://([^/]+)', 1) AS host FROM pages")
def page_pattern_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", F.regexp_count("html", F.lit("href=")).cast("long").alias("links"), F.regexp_count("html", F.lit("<p")).cast("long").alias("paragraphs"), F.regexp_extract("url", r"^(\w+)://", 1).alias("scheme"), F.regexp_extract("url", "://([^/]+)", 1).alias("host"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00Z' ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || 'Z' END AS stamp, CASE WHEN year(o_orderdate) = 1995 THEN '1995' ELSE year(o_orderdate)::VARCHAR || '-1995' END AS label, strftime(o_orderdate, '%Y-%m-%d') || '/1995-12-31' AS span FROM orders")
def stamps_and_labels(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    day, full = F.date_format("o_orderdate", "yyyy-MM-dd"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    return o.select("o_orderkey", T.rfc3339(F.when(F.col("o_orderkey") % 2 == 0, day).otherwise(full)).alias("stamp"), T.window_label(day, F.lit("1995-12-31")).alias("label"), T.datetime_range(day, F.lit("1995-12-31")).alias("span"))


@query("SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN event_type END AS phase, CASE WHEN event_id % 5 <> 0 THEN CAST(event_id % 3 AS INTEGER) END AS rc, CASE WHEN event_id % 5 <> 0 THEN epoch_us(ts)//1000000 END AS at FROM events")
def parse_markers(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    line = F.when(F.col("event_id") % 5 == 0, "MARKER broken").otherwise(F.concat(F.lit("MARKER "), F.col("event_type"), F.lit(" rc="), (F.col("event_id") % 3).cast("string"), F.lit(" "), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")))
    m = e.select("event_id", T.marker_fields(line).alias("m"))
    return m.select("event_id", F.col("m.phase").alias("phase"), F.col("m.rc").alias("rc"), F.unix_seconds("m.ts").alias("at"))


@query("SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN CAST(user_id AS INTEGER) END AS live, CASE WHEN event_id % 4 <> 0 THEN CAST(event_id % 100 AS INTEGER) END AS done, CASE WHEN event_id % 4 <> 0 THEN hour(ts) END AS hour FROM events")
def parse_status_lines(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    s = lambda c: c.cast("string")
    line = F.when(F.col("event_id") % 4 == 0, "garbage").otherwise(F.concat(F.date_format("ts", "HH:mm:ss"), F.lit(" live="), s(F.col("user_id")), F.lit(" queued=3 done="), s(F.col("event_id") % 100), F.lit("/120 peak=9 condemned=0")))
    p = e.select("event_id", T.status_fields(line, F.date_format("ts", "yyyy-MM-dd")).alias("p"))
    return p.select("event_id", F.col("p.live").alias("live"), F.col("p.done").alias("done"), F.hour("p.at").cast("long").alias("hour"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 <> 0 THEN 'runs' END AS bucket, CASE WHEN p_partkey % 3 <> 0 THEN p_brand || '/' || p_partkey::VARCHAR || '.tif' END AS key, CASE WHEN p_partkey % 3 <> 0 THEN p_partkey::VARCHAR || '.tif' END AS name, CASE WHEN p_partkey % 3 <> 0 THEN 'https://runs.s3.us-west-2.amazonaws.com/' || p_brand || '/' || p_partkey::VARCHAR || '.tif' END AS url FROM part")
def uri_parts(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey").cast("string")
    uri = F.concat(F.when(F.col("p_partkey") % 3 == 0, "http://").otherwise("s3://"), F.lit("runs/"), F.col("p_brand"), F.lit("/"), k, F.lit(".tif"))
    p = table(spark, d, "part").select("p_partkey", *[c.alias(n) for c, n in zip(T.split_uri(uri), ("bucket", "key"), strict=True)])
    return p.select("*", F.nullif(F.regexp_extract(F.col("key"), "([^/]+)$", 1), F.lit("")).alias("name"), T.https_url(F.col("bucket"), F.col("key"), "us-west-2").alias("url"))


@query("SELECT p_partkey, p_size::VARCHAR AS threads, p_brand AS brand, repeat('#', CAST(floor(p_size/50.0::DOUBLE*20) AS INTEGER)) || repeat('.', 20 - CAST(floor(p_size/50.0::DOUBLE*20) AS INTEGER)) AS bar FROM part")
def settings_and_bars(spark: SparkSession, d: str) -> DataFrame:
    m = T.parse_settings(F.concat(F.lit("threads="), F.col("p_size").cast("string"), F.lit(",brand="), F.col("p_brand")))
    return table(spark, d, "part").select("p_partkey", m["threads"].alias("threads"), m["brand"].alias("brand"), T.progress_bar(F.col("p_size") / F.lit(50.0)).alias("bar"))


@query("SELECT n_nationkey, 'Scenes are corrected by one offset each; ' || n_nationkey || ' beyond 15 degrees are left out.' || CASE WHEN n_nationkey % 3 <> 0 THEN ' ' || printf('%.1f', n_nationkey % 3 * 12.5) || '% of the valid pixels take the pooled percentile.' ELSE '' END AS correction, CASE WHEN n_nationkey % 2 = 0 THEN 'Pixels outside the land geometry are nodata.' ELSE '' END || CASE WHEN n_nationkey % 2 = 0 AND n_nationkey % 4 > 0 THEN ' ' ELSE '' END || CASE WHEN n_nationkey % 4 > 0 THEN 'Gaps are widened by ' || n_nationkey % 4 || ' cells.' ELSE '' END AS mask FROM nation")
def lineage_text(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("n_nationkey")
    share = k % 3 * F.lit(0.125)
    return table(spark, d, "nation").select("n_nationkey", T.correction_text(k, F.lit(15.0), share).alias("correction"), T.mask_text(F.when(k % 2 == 0, "land").otherwise("none"), k % 4, F.lit(None).cast("string")).alias("mask"))


@query()
def item_struct_json(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    return n.select("n_nationkey", T.coverage_properties(name=F.col("n_name"), share=F.round(F.col("n_nationkey") / F.lit(7.0), 6), gap=F.when(F.col("n_nationkey") % 2 == 0, F.col("n_nationkey"))).alias("properties"))


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 5 = 0 THEN 'no shared scenes' WHEN n_nationkey % 5*0.05::DOUBLE < 0.1 AND n_nationkey*0.03::DOUBLE < 0.5 THEN 'agree' WHEN n_nationkey % 5*0.05::DOUBLE < 0.5 THEN 'close' ELSE 'differ' END AS verdict FROM nation")
def seam_verdict(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("n_nationkey")
    return table(spark, d, "nation").select("n_nationkey", T.seam_verdict(F.when(k % 5 != 0, k % 5 * F.lit(0.05)), k * F.lit(0.03)).alias("verdict"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'SlowDown' END AS code, CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_type || '/' || event_id END AS key, CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_id*10 END AS size FROM events")
def listing_and_errors(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("event_id")
    err = F.when(k % 3 == 0, "An error occurred (SlowDown) when calling the GetObject operation").otherwise("ok")
    line = F.when(k % 7 == 0, "PRE runs/").otherwise(F.concat(F.lit("2024-01-01 00:00:00  "), (k * 10).cast("string"), F.lit(" "), F.col("event_type"), F.lit("/"), k.cast("string")))
    e = table(spark, d, "events").select("event_id", T.error_code(err).alias("code"), T.listing_fields(line).alias("l"))
    return e.select("event_id", "code", F.col("l.key").alias("key"), F.col("l.size").alias("size"))

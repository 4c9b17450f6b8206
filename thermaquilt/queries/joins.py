"""Interval, spatial, guarded, anti and set joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermaquilt.operators import fleet as E
from thermaquilt.operators import grid as G
from thermaquilt.operators import joins as J
from thermaquilt.queries import query
from thermaquilt.sources.mapping import table

_BANDS = "bands AS (SELECT s_suppkey, CAST(s_suppkey % 40 * 25 AS DOUBLE) + 900 AS lo, CAST(s_suppkey % 40 * 25 + 10 + s_suppkey % 7 * 5 AS DOUBLE) + 900 AS hi FROM supplier), ivs AS (SELECT p_partkey, p_retailprice AS a, p_retailprice + p_size % 4 AS b FROM part)"


@query(f"WITH {_BANDS} SELECT p_partkey, s_suppkey FROM ivs JOIN bands ON a < hi AND lo < b")
def interval_join_bands(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    bands = table(spark, d, "supplier").select("s_suppkey", ((k % 40 * 25).cast("double") + 900).alias("lo"), ((k % 40 * 25 + 10 + k % 7 * 5).cast("double") + 900).alias("hi"))
    parts = table(spark, d, "part").select("p_partkey", F.col("p_retailprice").alias("a"), (F.col("p_retailprice") + F.col("p_size") % 4).alias("b"))
    return J.interval_join(parts, bands, "a", "b", "lo", "hi", step=25.0).select("p_partkey", "s_suppkey")


_SCENES = """sc AS (SELECT l_orderkey*10 + l_linenumber AS scene_id, min(l_shipdate) AS ts, min(l_partkey) % 60 AS sx0, min(l_partkey) % 60 + 5 + min(l_suppkey) % 13 AS sx1, min(l_suppkey) % 40 AS sy0, min(l_suppkey) % 40 + 4 + min(l_partkey) % 9 AS sy1 FROM lineitem GROUP BY 1),
  bk AS (SELECT CAST(r AS INTEGER) AS brow, CAST(c AS INTEGER) AS bcol, c*16 AS x0, least(c*16 + 16, 80) AS x1, r*16 AS y0, least(r*16 + 16, 56) AS y1 FROM range(0, 4) a(r), range(0, 5) b(c))"""


def _scenes(spark: SparkSession, d: str, *, per_task: int = 0) -> DataFrame:
    """per_task: about so many scenes for a task, else as Spark deals them."""
    li = table(spark, d, "lineitem").withColumn("scene_id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    if per_task:
        li = li.repartition(-(-li.count() // per_task) or 1, "scene_id")
    li = li.groupBy("scene_id").agg(F.min("l_shipdate").alias("ts"), F.min("l_partkey").alias("p"), F.min("l_suppkey").alias("s"))
    p, s = F.col("p"), F.col("s")
    return li.select("scene_id", F.col("scene_id").alias("ord"), "ts", (p % 60).cast("int").alias("sx0"), (p % 60 + 5 + s % 13).cast("int").alias("sx1"), (s % 40).cast("int").alias("sy0"), (s % 40 + 4 + p % 9).cast("int").alias("sy1"))


@query(f"WITH {_SCENES}, h AS (SELECT brow, bcol, scene_id, ts FROM bk JOIN sc ON sx0 < x1 AND x0 < sx1 AND sy0 < y1 AND y0 < sy1) SELECT bk.brow, bk.bcol, count(scene_id) AS depth, coalesce(string_agg(scene_id::VARCHAR, ',' ORDER BY ts, scene_id), '') AS scenes FROM bk LEFT JOIN h USING (brow, bcol) GROUP BY ALL")
def block_plan_interval_join(spark: SparkSession, d: str) -> DataFrame:
    plan = G.block_plan(G.plan_blocks(spark, 56, 80, 16), _scenes(spark, d), chunk=16)
    return plan.select("brow", "bcol", F.col("depth").cast("long").alias("depth"), F.array_join(F.col("scenes").cast("array<string>"), ",").alias("scenes"))


@query(f"WITH {_SCENES}, dp AS (SELECT brow, bcol, count(scene_id) AS depth FROM bk LEFT JOIN sc ON sx0 < x1 AND x0 < sx1 AND sy0 < y1 AND y0 < sy1 GROUP BY ALL) SELECT CAST(sum(depth) AS BIGINT) AS demand, max(depth) AS deepest FROM (SELECT * FROM dp ORDER BY depth DESC LIMIT 8)")
def deepest_blocks_topk(spark: SparkSession, d: str) -> DataFrame:
    plan = G.block_plan(G.plan_blocks(spark, 56, 80, 16), _scenes(spark, d), chunk=16)
    return plan.orderBy(F.desc("depth"), "brow", "bcol").limit(8).agg(F.sum("depth").alias("demand"), F.max("depth").cast("long").alias("deepest"))


@query(f"WITH {_SCENES}, q AS (SELECT s_suppkey, s_suppkey % 70 AS a, s_suppkey % 50 AS b FROM supplier) SELECT scene_id, s_suppkey FROM sc JOIN q ON sx0 < a + 6 AND a < sx1 AND sy0 < b + 3 AND b < sy1")
def box_join_cells(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    q = table(spark, d, "supplier").select("s_suppkey", (k % 70).alias("a0"), (k % 50).alias("b0"), (k % 70 + 6).alias("a1"), (k % 50 + 3).alias("b1"))
    # A file's dictionary holds 131,072 scenes; beyond it each pair's scene is written out.
    return J.box_join(_scenes(spark, d, per_task=100_000), q, ["sx0", "sy0", "sx1", "sy1"], ["a0", "b0", "a1", "b1"], step=8.0).select("scene_id", "s_suppkey")


_FOOT = """fp AS (SELECT o_orderkey, CAST((o_orderkey*37) % 3600 AS DOUBLE)/10 - 180 AS lon, CAST((o_custkey*53) % 1160 AS DOUBLE)/10 - 58 AS lat FROM orders),
  fq AS (SELECT o_orderkey, lon AS x0, lat + 1.8 AS y0, lon + 1.9 AS x1, lat + 1.5 AS y1, lon + 1.5 AS x2, lat AS y2, lon - 0.4 AS x3, lat + 0.3 AS y3 FROM fp)"""


def _axis_sql() -> str:
    parts = []
    for i in range(4):
        j = (i + 1) % 4
        nx, ny = f"(y{j}-y{i})", f"(x{i}-x{j})"
        own = ", ".join(f"{nx}*x{k}+{ny}*y{k}" for k in range(4))
        box = ", ".join(f"{nx}*{x}+{ny}*{y}" for x in ("w", "(w+5)") for y in ("(n-5)", "n"))
        parts.append(f"least({own}) <= greatest({box}) AND least({box}) <= greatest({own})")
    return " AND ".join(parts)


@query(f"""WITH {_FOOT}, tl AS (SELECT CAST(60 - 5*i AS DOUBLE) AS n, CAST(-180 + 5*j AS DOUBLE) AS w FROM range(0, 24) a(i), range(0, 73) b(j))
  SELECT o_orderkey, (CASE WHEN n >= 0 THEN 'N' ELSE 'S' END) || lpad(abs(n)::INTEGER::VARCHAR, 2, '0') || (CASE WHEN w >= 0 AND w < 180 THEN 'E' ELSE 'W' END) || lpad((CASE WHEN w >= 180 THEN 360 - w ELSE abs(w) END)::INTEGER::VARCHAR, 3, '0') AS tile_id
  FROM fq JOIN tl ON least(x0,x1,x2,x3) <= w + 5 AND greatest(x0,x1,x2,x3) >= w AND least(y0,y1,y2,y3) <= n AND greatest(y0,y1,y2,y3) >= n - 5 AND {_axis_sql()}""")
def tile_footprint_join(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    lon = ((F.col("o_orderkey") * 37) % 3600).cast("double") / 10 - 180
    lat = ((F.col("o_custkey") * 53) % 1160).cast("double") / 10 - 58
    o = o.select("o_orderkey", lon.alias("lon"), lat.alias("lat"))
    ring = ((0.0, 1.8), (1.9, 1.5), (1.5, 0.0), (-0.4, 0.3))
    s = o.select("o_orderkey", F.lit(False).alias("crosses_antimeridian"), *[(F.col("lon") + dx).alias(f"corner_lon{i}") for i, (dx, _) in enumerate(ring)], *[(F.col("lat") + dy).alias(f"corner_lat{i}") for i, (_, dy) in enumerate(ring)])
    return J.assign_tiles(s, G.iter_grid(spark)).select("o_orderkey", "tile_id")


_CLASS = "tl AS (SELECT n_nationkey, count(o_orderkey) AS scenes, count(CASE WHEN o_orderstatus = 'F' AND n_nationkey % 7 <> 3 THEN 1 END) AS thermal FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey AND n_nationkey % 5 <> 0 LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1)"


@query(f"WITH {_CLASS} SELECT n_nationkey AS tile_id, scenes, thermal, CASE WHEN scenes = 0 THEN 'no_scenes' WHEN thermal = 0 THEN 'no_thermal' ELSE 'runnable' END AS class FROM tl")
def tile_classify_three_way(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    c = table(spark, d, "customer").where("c_nationkey % 5 <> 0")
    counts = o.join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_nationkey").alias("tile_id")).agg(F.count(F.lit(1)).alias("scenes"), F.count_if((F.col("o_orderstatus") == "F") & (F.col("c_nationkey") % 7 != 3)).alias("thermal"))
    return E.classify_tiles(table(spark, d, "nation").select(F.col("n_nationkey").alias("tile_id")), counts)


@query("SELECT n_nationkey, n_name FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9000)")
def tile_semi_join(spark: SparkSession, d: str) -> DataFrame:
    rich = table(spark, d, "customer").where("c_acctbal > 9000")
    return table(spark, d, "nation").join(rich, F.col("n_nationkey") == F.col("c_nationkey"), "left_semi").select("n_nationkey", "n_name")


@query("SELECT c_custkey AS k, 'missing' AS fault FROM customer WHERE c_custkey % 2 = 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders) UNION ALL SELECT DISTINCT o_custkey, 'extra' FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0)")
def orphans_anti_join(spark: SparkSession, d: str) -> DataFrame:
    wanted = table(spark, d, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k"))
    return J.missing_and_extra(wanted, table(spark, d, "orders").select(F.col("o_custkey").alias("k")).distinct(), "k")


@query("""WITH a AS (SELECT c_custkey AS key, CAST(floor(c_acctbal) AS BIGINT) AS size, md5(c_name) AS etag FROM customer WHERE c_custkey % 5 <> 0),
  b AS (SELECT c_custkey AS key, CAST(floor(c_acctbal) AS BIGINT) + CASE WHEN c_custkey % 7 = 0 THEN 1 ELSE 0 END AS size, CASE WHEN c_custkey % 3 = 0 THEN md5(c_name) || '-2' WHEN c_custkey % 13 = 0 THEN 'x' ELSE md5(c_name) END AS etag FROM customer WHERE c_custkey % 4 <> 0)
  SELECT coalesce(a.key, b.key) AS key, CASE WHEN a.key IS NULL THEN 'orphan' WHEN a.size = b.size AND (contains(b.etag, '-') OR a.etag = b.etag) THEN 'unchanged' ELSE 'upload' END AS action FROM a FULL JOIN b ON a.key = b.key""")
def published_diff_full_outer(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    k, size, tag = F.col("c_custkey"), F.floor("c_acctbal").cast("long"), F.md5(F.col("c_name").cast("binary"))
    a = c.where(k % 5 != 0).select(k.alias("key"), size.alias("size"), tag.alias("etag"))
    b = c.where(k % 4 != 0).select(k.alias("key"), (size + F.when(k % 7 == 0, 1).otherwise(0)).alias("size"), F.when(k % 3 == 0, F.concat(tag, F.lit("-2"))).when(k % 13 == 0, "x").otherwise(tag).alias("etag"))
    return J.published_diff(a, b)


@query("SELECT event_id, CAST(ts AS DATE) AS ts_day, day(ts) AS v FROM events")
def time_join_guarded(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", F.to_date("ts").alias("ts_day"))
    values = e.select("ts_day", F.dayofmonth("ts_day").cast("long").alias("v"))
    return J.align_to_time(e, values, "ts_day", "v").select("event_id", "ts_day", "v")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN coalesce(m.x, o_totalprice) ELSE o_totalprice END AS o_totalprice, o_orderkey % 10 = 0 AND m.x IS NULL AS unresolved FROM orders LEFT JOIN (SELECT l_orderkey, CAST(max(l_linenumber) AS DOUBLE) AS x FROM lineitem WHERE l_linenumber >= 4 GROUP BY 1) m ON l_orderkey = o_orderkey")
def lookup_coalesce(spark: SparkSession, d: str) -> DataFrame:
    exact = table(spark, d, "lineitem").where("l_linenumber >= 4").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_linenumber").cast("double").alias("o_totalprice"))
    return J.resolve_exact(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), exact, "o_orderkey", "o_totalprice", F.col("o_orderkey") % 10 == 0)


@query("SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_mktsegment END AS seg FROM customer WHERE c_custkey % 6 = 0")
def changed_rows_only(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey", F.col("c_mktsegment").alias("seg"))
    return J.changed_only(c, c.withColumn("seg", F.when(F.col("c_custkey") % 6 != 0, F.col("seg"))), "c_custkey", ["c_nationkey", "seg"])


@query("SELECT k, string_agg(DISTINCT src, ',' ORDER BY src) AS sources FROM (SELECT c_nationkey AS k, 'customer' AS src FROM customer UNION ALL SELECT s_nationkey, 'supplier' FROM supplier UNION ALL SELECT n_nationkey, 'nation' FROM nation) GROUP BY k")
def tagged_union(spark: SparkSession, d: str) -> DataFrame:
    parts = [table(spark, d, t).select(F.col(c).alias("k"), F.lit(t).alias("src")) for t, c in (("customer", "c_nationkey"), ("supplier", "s_nationkey"), ("nation", "n_nationkey"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("k").agg(F.array_join(F.sort_array(F.collect_set("src")), ",").alias("sources"))


@query("SELECT n_nationkey FROM nation EXCEPT SELECT s_nationkey FROM supplier WHERE s_suppkey % 3 = 0")
def variant_difference(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation").select("n_nationkey").exceptAll(table(spark, d, "supplier").where("s_suppkey % 3 = 0").select("s_nationkey").distinct())

"""Run-log, cost and catalogue analytics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from thermaquilt.operators import fleet as E
from thermaquilt.queries import query
from thermaquilt.sources.mapping import table


def _events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS r FROM events) WHERE r = 1")
def latest_run_per_key(spark: SparkSession, d: str) -> DataFrame:
    return E.latest_per_key(_events(spark, d), "user_id", "ts", "event_id").select("user_id", "event_id", "event_type")


_STATE = """l AS (SELECT user_id, event_type, CAST(round_even(value, 0) AS INTEGER) % 4 AS rc, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS r FROM events WHERE event_type <> 'view') WHERE r = 1),
  b AS (SELECT user_id, max(ts) AS beat FROM events GROUP BY 1), m AS (SELECT max(ts) AS now FROM events)"""


@query(f"""WITH {_STATE} SELECT b.user_id, CASE WHEN b.user_id % 10 = 0 THEN 'done' WHEN rc <> 0 THEN 'failed:' || event_type WHEN NOT coalesce(CASE WHEN b.user_id % 7 = 0 THEN false WHEN b.user_id % 7 = 1 THEN NULL ELSE true END, true) THEN 'died' WHEN event_type IS NULL THEN 'starting'
   WHEN (epoch_us(now) - epoch_us(beat))/60000000.0::DOUBLE > 600 THEN 'stalled' ELSE 'running:' || event_type END AS state FROM b LEFT JOIN l USING (user_id), m""")
def marker_state(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d)
    last = E.latest_per_key(e.where("event_type <> 'view'"), "user_id", "ts", "event_id").select("user_id", "event_type", (F.rint("value").cast("int") % 4).alias("rc"))
    beats = e.groupBy("user_id").agg(F.max("ts").alias("beat"))
    now = e.agg(F.max("ts").alias("now"))
    age = (F.unix_micros(F.col("now").cast("timestamp")) - F.unix_micros(F.col("beat").cast("timestamp"))) / F.lit(60000000.0)
    alive = F.when(F.col("user_id") % 7 == 0, False).when(F.col("user_id") % 7 == 1, None).otherwise(True)
    # `now` is one row.
    return beats.join(last, "user_id", "left").crossJoin(F.broadcast(now)).select("user_id", E.run_state(F.col("event_type"), F.col("rc"), age, alive, F.col("user_id") % 10 == 0, stall=600).alias("state"))


_RATE = "s AS (SELECT user_id, event_id, epoch_us(ts)//1000000 AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS done FROM events), w AS (SELECT *, count(*) OVER r AS k, min(t) OVER r AS t0, min(done) OVER r AS d0, lag(t) OVER p AS lt, lag(done) OVER p AS ld FROM s WINDOW r AS (PARTITION BY user_id ORDER BY t RANGE BETWEEN 43200 PRECEDING AND CURRENT ROW), p AS (PARTITION BY user_id ORDER BY t, done))"


@query(f"WITH {_RATE} SELECT event_id, round(CAST(CASE WHEN k > 1 THEN done - d0 ELSE done - ld END AS DOUBLE)/nullif((t - CASE WHEN k > 1 THEN t0 ELSE lt END)/3600.0::DOUBLE, 0), 6) AS rate_per_hour FROM w")
def rate_trailing_window(spark: SparkSession, d: str) -> DataFrame:
    shots = _events(spark, d).withColumn("done", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    return E.trailing_rate(shots, "user_id", "ts", "done", minutes=720).select("event_id", F.round("rate_per_hour", 6).alias("rate_per_hour"))


@query("WITH m AS (SELECT *, CASE WHEN lag(event_type) OVER w = event_type THEN 0 ELSE 1 END AS nw FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), g AS (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM m) SELECT user_id, CAST(run AS BIGINT) AS run, any_value(event_type) AS event_type, count(*) AS n FROM g GROUP BY user_id, run")
def run_length_boundaries(spark: SparkSession, d: str) -> DataFrame:
    return E.run_lengths(_events(spark, d), "user_id", ["ts", "event_id"], "event_type").select("user_id", "run", "event_type", "n")


@query("WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderkey % 4000 END AS scenes FROM orders), s AS (SELECT sum(816.6::DOUBLE + 0.29843::DOUBLE*coalesce(scenes, (SELECT avg(scenes) FROM t)))/3600 AS h, count(*) AS n FROM t) SELECT n AS tiles, round(h, 4) AS hours, round(h*3.7968::DOUBLE, 4) AS price, round(h/12, 4) AS wall_hours FROM s")
def cost_projection(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "orders").select(F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderkey") % 4000).alias("scenes"))
    return E.project_cost(t, "scenes", 12).select("tiles", *[F.round(c, 4).alias(c) for c in ("hours", "price", "wall_hours")])


_RATES = [("AIR", 0.5), ("MACHINERY", 1.25), ("BUILDING", 2.0)]


@query("WITH m AS (SELECT c_custkey, c_mktsegment, max(o_totalprice) AS s FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2), r AS (SELECT * FROM (VALUES ('AIR', 0.5::DOUBLE), ('MACHINERY', 1.25), ('BUILDING', 2.0)) t(c_mktsegment, rate)) SELECT round(sum(s/3600*rate), 4) AS price, count(*) AS instances FROM m JOIN r USING (c_mktsegment)")
def snapshot_dedupe_cost(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    rates = spark.createDataFrame(_RATES, "c_mktsegment string, rate double")
    return E.snapshot_total(s, "c_custkey", "o_totalprice", "c_mktsegment", rates).select(F.round("price", 4).alias("price"), "instances")


@query("WITH r AS (SELECT * FROM (VALUES ('AIR', 0.5::DOUBLE), ('MACHINERY', 1.25), ('BUILDING', 2.0)) t(c_mktsegment, rate)), h AS (SELECT c_mktsegment, sum(c_acctbal)/3600 AS hours FROM customer GROUP BY 1) SELECT c_mktsegment, round(hours, 5) AS hours, round(hours*rate, 5) AS price FROM h LEFT JOIN r USING (c_mktsegment)")
def cost_by_type(spark: SparkSession, d: str) -> DataFrame:
    rates = spark.createDataFrame(_RATES, "c_mktsegment string, rate double")
    return E.cost_by_type(table(spark, d, "customer"), "c_mktsegment", "c_acctbal", rates).select("c_mktsegment", F.round("hours", 5).alias("hours"), F.round("price", 5).alias("price"))


@query("WITH s AS (SELECT *, (value - lag(value) OVER w)/nullif((epoch_us(ts) - epoch_us(lag(ts) OVER w))/1000000.0::DOUBLE, 0) AS r FROM (SELECT user_id, ts, max(value) AS value FROM events GROUP BY 1, 2) WINDOW w AS (PARTITION BY user_id ORDER BY ts)) SELECT user_id, max(value) AS peak, min(value) AS low, count(*) AS n, round(max_by(value, ts) - min_by(value, ts), 4) AS change, round(max(r), 4) AS fastest FROM s GROUP BY user_id")
def peak_between(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d).groupBy("user_id", F.col("ts").cast("timestamp").alias("t")).agg(F.max("value").alias("value"))
    p = E.peaks(e, "user_id", "t", "value", F.lit("1900-01-01").cast("timestamp"), F.lit("2200-01-01").cast("timestamp"))
    return p.select("user_id", "peak", "low", "n", F.round("change", 4).alias("change"), F.round("fastest", 4).alias("fastest"))


@query("WITH b AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'done' WHEN 1 THEN 'died' ELSE 'stalled' END AS status, c_custkey % 5 AS attempts FROM customer) SELECT *, CASE WHEN status = 'done' THEN 'settled' WHEN attempts < 3 THEN 'requeue' ELSE 'given_up' END AS fate FROM b")
def wave_fates(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    b = table(spark, d, "customer").select("c_custkey", F.when(k % 4 == 0, "done").when(k % 4 == 1, "died").otherwise("stalled").alias("status"), (k % 5).alias("attempts"))
    return E.sort_wave(b, 3)


@query("WITH b AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'done' WHEN 1 THEN 'died' WHEN 2 THEN 'failed:prep' ELSE 'running' END AS state, c_custkey % 5 AS attempts, c_custkey % 100 AS el FROM customer) SELECT c_custkey, CASE WHEN state = 'done' THEN 'finished' WHEN state IN ('died', 'failed:prep') OR el > 80 THEN CASE WHEN attempts < 2 THEN 'retry' ELSE 'fail' END ELSE 'keep' END AS verdict, CASE WHEN c_custkey % 6 = 0 THEN 0 ELSE greatest(least(10, c_custkey % 15) - c_custkey % 8, 0) END AS room FROM b")
def retire_and_room(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    b = table(spark, d, "customer").select("c_custkey", F.when(k % 4 == 0, "done").when(k % 4 == 1, "died").when(k % 4 == 2, "failed:prep").otherwise("running").alias("state"), (k % 5).alias("attempts"), (k % 100).alias("el"))
    return E.retire(b, F.col("el"), 80, 2).select("c_custkey", "verdict", E.room(F.lit(10).cast("long"), k % 15, k % 8, k % 6 == 0).alias("room"))


@query("SELECT event_type, count(*) AS n, round(sum(value), 3) AS total, round(avg(value), 5) AS mean, max(value) AS longest FROM events GROUP BY 1 ORDER BY sum(value) DESC, 1 LIMIT 20")
def span_summary(spark: SparkSession, d: str) -> DataFrame:
    return E.span_summary(_events(spark, d), "event_type", "value").select("event_type", "n", F.round("total", 3).alias("total"), F.round("mean", 5).alias("mean"), "longest")


@query("SELECT c_nationkey, coalesce(min(CASE WHEN c_custkey % 3 = 0 THEN c_acctbal END), -50.0::DOUBLE) AS low, coalesce(max(CASE WHEN c_custkey % 3 = 0 THEN c_acctbal END), 605.35::DOUBLE) AS high FROM customer GROUP BY 1")
def render_range(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "customer").select("c_nationkey", F.when(F.col("c_custkey") % 3 == 0, 50).otherwise(0).alias("valid_percent"), F.col("c_acctbal").alias("min"), F.col("c_acctbal").alias("max"))
    return E.render_range(b, "c_nationkey")


@query("""WITH u AS (SELECT user_id, event_type, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS r FROM events), l AS (SELECT user_id, event_type AS last FROM u WHERE r = 1),
  o AS (SELECT user_id, max(ts) FILTER (event_type <> last) AS o, last FROM events JOIN l USING (user_id) GROUP BY user_id, last), s AS (SELECT e.user_id, any_value(last) AS last, min(ts) AS since FROM events e JOIN o ON o.user_id = e.user_id WHERE o.o IS NULL OR ts > o.o GROUP BY 1)
  SELECT user_id AS tile, CASE WHEN last = 'uploading' THEN 'upload_lost' ELSE last END AS state FROM s""")
def settle_uploads(spark: SparkSession, d: str) -> DataFrame:
    s = _events(spark, d).select(F.col("user_id").alias("tile"), F.col("ts").alias("at"), F.col("event_type").alias("phase"))
    return E.settle_uploads(s, F.lit("2030-01-01").cast("timestamp")).select("tile", "state")

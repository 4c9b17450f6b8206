"""Streams over files give what the batch gives."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from thermaquilt.streaming import monitor as M


@pytest.fixture(scope="module")
def events(spark, sf, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("events"))
    e = spark.read.parquet(f"{sf}/events.parquet").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    e.coalesce(1).write.mode("append").parquet(path)
    e.limit(100).coalesce(1).write.mode("append").parquet(path)
    return path


def run(spark, df, tmp_path, mode="append"):
    q = M.start(df, str(tmp_path / "out"), str(tmp_path / "check"), mode)
    q.awaitTermination(120)
    assert q.exception() is None
    return spark.read.parquet(str(tmp_path / "out"))


def test_duplicates_land_once(spark, events, tmp_path):
    out = run(spark, M.first_landed(M.event_stream(spark, events), late="4000 days"), tmp_path)
    assert out.count() == out.select("event_id").distinct().count() == 1000


def test_windows_close_behind_the_watermark(spark, events, tmp_path):
    out = run(spark, M.trailing_counts(M.event_stream(spark, events)), tmp_path)
    first = out.orderBy("start").first()
    assert out.count() > 0 and first.end - first.start == dt.timedelta(minutes=30)


def test_sessions(spark, events, tmp_path):
    assert run(spark, M.beat_sessions(M.event_stream(spark, events)), tmp_path).where("beats >= 1").count() > 0


def test_state_machine_sees_changes_only(spark, events, tmp_path):
    out = run(spark, M.run_phases(M.event_stream(spark, events)), tmp_path).where("state = 'running'").orderBy("user_id", "since").collect()
    assert out
    for a, b in zip(out, out[1:], strict=False):
        assert a.user_id != b.user_id or a.phase != b.phase or a.since != b.since

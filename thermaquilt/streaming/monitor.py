"""The run monitor as streams: trailing rates, stalls by session, and a keyed state machine for runs."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from thermaquilt import constants as K

EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double"


def event_stream(spark: SparkSession, path: str, *, files_per_trigger: int = 100) -> DataFrame:
    """Events from Parquet files as they arrive: (event_id, ts, user_id, event_type, value)."""
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def trailing_counts(events: DataFrame, *, late: str = "5 minutes", window: str = f"{K.RATE_WINDOW_MINUTES} minutes", slide: str = "10 minutes") -> DataFrame:
    """(user_id, start, end, n, per_hour) over sliding windows; rows later than the watermark are dropped by the engine."""
    w = F.window("ts", window, slide)
    return events.withWatermark("ts", late).groupBy("user_id", w).agg(F.count(F.lit(1)).alias("n")).select("user_id", F.col("window.start").alias("start"), F.col("window.end").alias("end"), "n", (F.col("n") * 60.0 / K.RATE_WINDOW_MINUTES).alias("per_hour"))


def beat_sessions(events: DataFrame, *, late: str = "5 minutes", gap: str = f"{K.STALL_MINUTES} minutes") -> DataFrame:
    """(user_id, start, end, beats): a session ends where no beat comes for the stall time."""
    s = F.session_window("ts", gap)
    return events.withWatermark("ts", late).groupBy("user_id", s).agg(F.count(F.lit(1)).alias("beats")).select("user_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "beats")


def first_landed(events: DataFrame, *, late: str = "1 hour") -> DataFrame:
    """Each event once, however often it is delivered within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])


def run_phases(events: DataFrame, *, late: str = "5 minutes", grace_minutes: int = K.UPLOAD_GRACE_MINUTES) -> DataFrame:
    """(user_id, phase, since, state) at each change of phase; a phase without change for the grace becomes lost.

    State per run is one row: its phase and when it began. Events older than the
    state's are ignored, so late delivery can't turn a run back.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        out = []
        if state.hasTimedOut:
            phase, since, _ = state.get
            out.append((key[0], phase, pd.Timestamp(since, unit="us"), "lost"))
            state.remove()
        else:
            phase, since, last = state.get if state.exists else (None, 0, -1)
            for f in frames:
                for r in f.sort_values(["ts", "event_id"]).itertuples():
                    at = r.ts.value // 1000
                    if at < last:
                        continue
                    last = at
                    if r.event_type != phase:
                        phase, since = r.event_type, at
                        out.append((key[0], phase, r.ts, "running"))
            if phase is not None:
                state.update((phase, since, last))
                # The watermark may have gone on; a timeout must be after it.
                state.setTimeoutTimestamp(max(last // 1000, state.getCurrentWatermarkMs()) + grace_minutes * 60_000)
        yield pd.DataFrame(out, columns=["user_id", "phase", "since", "state"])

    keyed = events.withWatermark("ts", late).groupBy("user_id")
    return keyed.applyInPandasWithState(step, "user_id long, phase string, since timestamp, state string", "phase string, since long, last long", "append", GroupStateTimeout.EventTimeTimeout)


def start(df: DataFrame, path: str, checkpoint: str, mode: str = "append"):
    """Runs a stream over what is there, to Parquet, restartable from its checkpoint."""
    return df.writeStream.outputMode(mode).format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

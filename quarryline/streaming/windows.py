"""Windowed counts, for batch tables and streams alike, and stall detection with state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def windowed_counts(events: DataFrame, size: str, slide: str | None = None, late: str | None = None) -> DataFrame:
    """Counts and successes by window and type. On a stream, ``late`` is the watermark's delay."""
    if late and events.isStreaming:
        events = events.withWatermark("ts", late)
    window = F.window("ts", size, slide) if slide else F.window("ts", size)
    counted = events.groupBy(window, "event_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") != "error").alias("ok"))
    return counted.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "event_type", "n", "ok")


def sessions(events: DataFrame, gap: str, late: str | None = None) -> DataFrame:
    """Sessions of a user: events less than ``gap`` apart."""
    if late and events.isStreaming:
        events = events.withWatermark("ts", late)
    counted = events.groupBy(F.session_window("ts", gap), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("user_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def stalls(progress: DataFrame, quiet_s: int, late: str = "1 hour") -> DataFrame:
    """job, at, done, verdict of a stream (job, ts, done): advancing, stalled (no change for ``quiet_s``), reset.

    The state of a job is the last value and when it changed; it goes a day after the job's last event.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        value, since = state.get if state.exists else (None, None)
        rows = pd.concat(list(batches)).sort_values("ts", kind="stable")
        out = []
        for ts, done in zip(rows["ts"], rows["done"]):
            at = int(pd.Timestamp(ts).timestamp())
            if value is None or done > value:
                verdict, value, since = "advancing", int(done), at
            elif done < value:
                verdict, value, since = "reset", int(done), at
            else:
                verdict = "stalled" if at - since >= quiet_s else "waiting"
            out.append((key[0], ts, int(done), verdict))
        state.update((value, since))
        state.setTimeoutTimestamp(max(state.getCurrentWatermarkMs(), int(pd.Timestamp(rows["ts"].iloc[-1]).timestamp() * 1000)) + 86_400_000)
        yield pd.DataFrame(out, columns=["job", "at", "done", "verdict"])

    return progress.withWatermark("ts", late).groupBy("job").applyInPandasWithState(step, "job string, at timestamp, done long, verdict string", "value long, since long", "append", GroupStateTimeout.EventTimeTimeout)

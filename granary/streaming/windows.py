"""Streaming variants of group counts and runs; each also takes a batch table."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(events: DataFrame, width: str, late: str = "10 minutes", by: str = "event_type", value: str = "value") -> DataFrame:
    """start, by, n, total for tumbling windows of event time ts; later rows than the watermark are dropped on a stream."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if e.isStreaming:
        e = e.withWatermark("ts", late)
    return e.groupBy(F.window("ts", width).alias("w"), by).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("start"), by, "n", "total")


def stream_runs(events: DataFrame) -> DataFrame:
    """user_id, event_type, start, end, n of every run of equal types that has ended, by arrival inside a user; state is one open run a user."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        kind, start, end, n = state.get if state.exists else (None, 0, 0, 0)
        out = []
        rows = pd.concat(list(batches)).sort_values(["ts", "event_id"])
        for r in rows.itertuples(index=False):
            if n and r.event_type == kind:
                end, n = int(r.event_id), n + 1
                continue
            if n:
                out.append((key[0], kind, start, end, n))
            kind, start, end, n = r.event_type, int(r.event_id), int(r.event_id), 1
        state.update((kind, start, end, n))
        yield pd.DataFrame(out, columns=["user_id", "event_type", "start", "end", "n"])

    return events.groupBy("user_id").applyInPandasWithState(step, "user_id long, event_type string, start long, end long, n int", "kind string, start long, end long, n int", "append", "NoTimeout")

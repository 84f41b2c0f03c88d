"""Streaming forms of the feeds: parsing, duplicate messages, counts and readmissions."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from carelattice.operators.hl7 import parse_adt, parse_messages
from carelattice.sources.files import split_messages
from carelattice.sources.writers import append

DAYS = 30


def hl7_stream(spark: SparkSession, path: str, default_tenant: str | None = None, files_per_trigger: int = 1000) -> DataFrame:
    """Parsed messages of files as they arrive; no state."""
    files = spark.readStream.format("text").option("wholetext", True).option("maxFilesPerTrigger", files_per_trigger).load(path)
    return parse_adt(parse_messages(split_messages(files), default_tenant))


def distinct_messages(messages: DataFrame, delay: str = "1 day") -> DataFrame:
    """Without repeats of a control id that come within the delay."""
    return messages.withWatermark("message_datetime", delay).dropDuplicatesWithinWatermark(["message_control_id"])


def event_counts(messages: DataFrame, width: str = "1 hour", delay: str = "2 hours") -> DataFrame:
    """Messages by event and time window; windows close when the watermark passes them."""
    return messages.withWatermark("message_datetime", delay).groupBy(F.window("message_datetime", width), "message_event").agg(F.count("*").alias("messages")).select(F.col("window.start").alias("start"), "message_event", "messages")


def readmission_stream(events: DataFrame, delay: str = "30 days") -> DataFrame:
    """events (umpi, event_type, event_datetime) with is_readmission_30d and prior_discharge.

    State: a patient's discharges of the last 30 days before their latest event; it goes when the watermark has passed
    them. Events of one patient are taken in the order of their times within a batch.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held = list(state.get[0]) if state.exists else []
        rows: list[tuple[Any, ...]] = []
        span = DAYS * 86_400_000_000
        times = pd.concat(list(batches)).sort_values("event_datetime", kind="stable")
        for r in times.itertuples(index=False):
            now = int(r.event_datetime.value // 1000)
            prior = max((t for t in held if t < now), default=None)
            hit = r.event_type == "A01" and prior is not None and now - prior <= span
            rows.append((key[0], r.event_type, r.event_datetime, hit, pd.Timestamp(prior * 1000) if hit else pd.NaT))
            if r.event_type == "A03":
                held.append(now)
        newest = int(times["event_datetime"].max().value // 1000)
        held = [t for t in held if t >= newest - span]
        state.update((held,))
        state.setTimeoutTimestamp(max(newest // 1000 + DAYS * 86_400_000, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(rows, columns=["umpi", "event_type", "event_datetime", "is_readmission_30d", "prior_discharge"])

    return events.withWatermark("event_datetime", delay).groupBy("umpi").applyInPandasWithState(
        step, "umpi string, event_type string, event_datetime timestamp, is_readmission_30d boolean, prior_discharge timestamp", "held array<long>", "append", GroupStateTimeout.EventTimeTimeout
    )


def append_stream(df: DataFrame, table: str, checkpoint_path: str) -> StreamingQuery:
    """Append every batch to a table, once each for a given checkpoint folder."""
    return df.writeStream.foreachBatch(lambda batch, _: append(batch, table)).option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start()

"""Continuous forms of the batch operators: exactly-once delivery, corrected windows, and state per source."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidewire.operators.delivery import SeenStore
from tidewire.operators.health import BACKOFF_MOST_MS, BACKOFF_MS
from tidewire.operators.lateness import PeriodFigures


def deliver_once(messages: DataFrame, store: SeenStore, out: str, checkpoint: str, key: str = "event_id", order: str = "created_at_ms", delivery: str = "delivery_id", retain: int | None = None, compact_every: int = 32) -> StreamingQuery:
    """Writes each message of a stream once, below out/batch=N. A micro-batch that is run again finds its own batch in the store and
    overwrites its own folder, so a restart neither loses nor repeats a message. With `retain` a message is remembered for that many
    further batches only. Bitmaps are merged every compact_every batches. Runs over what is there and stops."""

    def one(batch: DataFrame, number: int) -> None:
        if retain is not None and number > retain:
            store.forget(f"b{number - retain - 1:09d}")
        if number % compact_every == compact_every - 1:
            store.compact()
        kept = store.accept(batch, f"b{number:09d}", key, order, delivery).select(F.col("delivery").alias("__kept"))
        batch.join(kept, F.col(delivery) == F.col("__kept"), "left_semi").write.mode("overwrite").parquet(f"{out}/batch={number}")

    return messages.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def corrected_figures(events: DataFrame, store: PeriodFigures, key: str, published: str, arrived: str, checkpoint: str, out: str, value: str | None = None) -> StreamingQuery:
    """Figures by period of event time, corrected as late events come until the cut-off: each micro-batch writes the figures that it
    changed below out/batch=N. Open periods are kept in the store. Runs over what is there and stops."""

    def one(batch: DataFrame, number: int) -> None:
        store.take(batch, f"b{number:09d}", key, published, arrived, value).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return events.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str, width: str, lateness: str, keys: list[str]) -> DataFrame:
    """Counts per window of event time and keys; corrected while rows are at most `lateness` behind the newest, then final."""
    return events.withWatermark(time, lateness).groupBy(F.window(time, width).alias("window"), *keys).agg(F.count(F.lit(1)).alias("n"))


STATE_OUT = "source_id string, at_ms bigint, failure_count bigint, unchanged_count bigint, last_success_at_ms bigint, backoff_until_ms bigint"
STATE = "failure_count bigint, unchanged_count bigint, last_success_at_ms bigint"


def _fold(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    failures, unchanged, success = state.get if state.exists else (0, 0, None)
    rows = pd.concat(list(frames)).sort_values("at_ms")  # one source's attempts of one micro-batch
    out = []
    for r in rows.itertuples():
        until = None
        if r.outcome == "failure":
            failures += 1
            until = r.at_ms + min(BACKOFF_MS * 2 ** min(failures - 1, 8), BACKOFF_MOST_MS)
        else:
            failures, success = 0, r.at_ms
            unchanged = unchanged + 1 if r.outcome == "not_modified" else 0 if r.items_seen else unchanged
        out.append((key[0], r.at_ms, failures, unchanged, success, until))
    state.update((int(failures), int(unchanged), None if success is None else int(success)))
    yield pd.DataFrame(out, columns=["source_id", "at_ms", "failure_count", "unchanged_count", "last_success_at_ms", "backoff_until_ms"]).astype({"last_success_at_ms": "Int64", "backoff_until_ms": "Int64"})


def fetch_states(attempts: DataFrame) -> DataFrame:
    """State of each source after each attempt of a stream (source_id, at_ms, outcome success | not_modified | failure, items_seen).
    The state of a source is three numbers; attempts of one micro-batch are taken in order of time."""
    return attempts.groupBy("source_id").applyInPandasWithState(_fold, STATE_OUT, STATE, "append", GroupStateTimeout.NoTimeout)

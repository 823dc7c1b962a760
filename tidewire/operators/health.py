"""Attempts at sources: failure runs, back-off, cadence, error classes."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewire.functions.text import short_hash

BACKOFF_MS, BACKOFF_MOST_MS = 60_000, 1_800_000
CADENCE_MS = {"high": 900_000, "medium": 1_800_000, "low": 21_600_000}


def failure_runs(attempts: DataFrame, key: str, at_ms: str, order: list[str], failed: Column) -> DataFrame:
    """Adds failure_count (failures since the last success) and backoff_until_ms (doubling from a minute to half an hour; null after
    a success), by gaps and islands."""
    by = Window.partitionBy(key).orderBy(*order)
    rows = attempts.withColumn("__fail", F.coalesce(failed, F.lit(False)))
    rows = rows.withColumn("__run", F.sum((~F.col("__fail")).cast("int")).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    count = F.sum(F.col("__fail").cast("int")).over(Window.partitionBy(key, "__run").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("failure_count", count.cast("bigint"))
    step = F.least(F.lit(BACKOFF_MS) * F.pow(F.lit(2.0), F.least(F.col("failure_count") - 1, F.lit(8))).cast("bigint"), F.lit(BACKOFF_MOST_MS))
    return rows.withColumn("backoff_until_ms", F.when(F.col("__fail"), F.col(at_ms) + step)).drop("__fail", "__run")


def cadence_ms(tier: Column) -> Column:
    return F.when(tier == "medium", CADENCE_MS["medium"]).when(tier == "low", CADENCE_MS["low"]).otherwise(CADENCE_MS["high"])


def cadence_admitted(attempts: DataFrame, key: str, at_ms: str, interval_ms: int) -> DataFrame:
    """key, at_ms and admitted: an attempt is admitted when none was within interval_ms before it. This depends on the last admitted
    one, so attempts stream by in order of source and time, and a task only holds the time last admitted."""
    schema = f"`{key}` {attempts.schema[key].dataType.simpleString()}, `{at_ms}` bigint, admitted boolean"

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        source, last = object(), None
        for pdf in batches:
            out = []
            for s, t in zip(pdf[key], pdf[at_ms]):
                if s != source:
                    source, last = s, None
                ok = last is None or t >= last + interval_ms
                last = t if ok else last
                out.append(ok)
            yield pdf.assign(admitted=out)[[key, at_ms, "admitted"]]

    rows = attempts.select(key, at_ms).where(F.col(key).isNotNull() & F.col(at_ms).isNotNull())
    return rows.repartition(key).sortWithinPartitions(key, at_ms).mapInPandas(fold, schema)


def failure_type(error: Column) -> Column:
    """Class of an error message; the first that fits."""
    e = F.lower(error)
    has = lambda *words: e.rlike("|".join(words))
    return (
        F.when(has("429", "rate", "too many requests"), "rate_limited").when(has("timeout", "timed out"), "timeout")
        .when(has("did not return an xml feed", "parse", "expected value", "invalid json"), "parse_failed").when(has("challenge", "auth"), "auth_not_supported")
        .when(has("no usable", "no_items"), "content_empty").otherwise("source_unreachable")
    )


def retryable(error: Column) -> Column:
    return F.lower(error).rlike(r"timed out|connection|request timeout|http (?:408|425|429|500|502|503|504)")


def health_level(status: Column) -> Column:
    return F.when(status.isin("ok", "not_modified", "skipped_cadence"), "healthy").when(status.isin("no_items", "skipped_backoff"), "degraded").otherwise("blocked")


def heal_records(failures: DataFrame, source: str, at_ms: str, error: str, interval_ms: int | None) -> DataFrame:
    """One record of a scheduled retry per failure; the next one is due after interval_ms, or is null where runs are not scheduled."""
    kind = failure_type(F.col(error))
    return failures.select(
        F.lit("source_heal_event_v1").alias("schema_version"), F.concat(F.lit("src_heal_"), short_hash(F.concat_ws(":", F.col(source), F.col(at_ms).cast("string"), kind))).alias("heal_event_id"),
        F.col(source).alias("source_id"), F.col(at_ms).alias("observed_at_ms"), kind.alias("failure_type"), F.lit("retry_with_backoff").alias("heal_action"), F.lit(1).cast("bigint").alias("attempt_count"),
        (F.col(at_ms) + F.lit(interval_ms).cast("bigint")).alias("next_retry_at_ms"), F.lit("scheduled").alias("heal_status"),
    )

"""Pointers to stored events, and the outbox of their publication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.sources.layout import object_key

POINTER_SCHEMA = "raw_intel_event_created_v2"
POINTER_FIELDS = ("event_id", "source_id", "source_category", "fetched_at_ms", "published_at_ms", "content_hash", "dedup_key", "dedup_decision", "duplicate_of_event_id", "symbol_candidates", "top50_relevance")


def created_pointers(located: DataFrame, bucket: str, created_at_ms: Column, kind: str = "jsonl_record", alias: str = "primary") -> DataFrame:
    """One pointer per event that locate() has placed (with dt, hour, run_id, part and the locators)."""
    key = object_key("raw-intel-events", "raw_intel_event_v1", F.col("dt"), F.col("hour"), [(n, F.col(n)) for n in ("source_category", "source_id", "run_id")], F.col("part"))
    ref = F.struct(F.lit(kind).alias("kind"), F.lit(alias).alias("endpoint_alias"), F.lit(bucket).alias("bucket"), key.alias("key"), "line_number", "byte_offset", "byte_length", "content_sha256")
    return located.select(F.lit(POINTER_SCHEMA).alias("schema_version"), *POINTER_FIELDS, created_at_ms.cast("bigint").alias("created_at_ms"), ref.alias("storage_ref"))


def outbox(pointers: DataFrame, acknowledged: DataFrame, key: str = "event_id") -> DataFrame:
    """Pointers with status published or pending, by the identifiers that were acknowledged."""
    acks = acknowledged.select(F.col(key).alias("__ack")).distinct()
    return pointers.join(acks, F.col(key) == F.col("__ack"), "left").withColumn("status", F.when(F.col("__ack").isNull(), "pending").otherwise("published")).drop("__ack")


def to_replay(pending: DataFrame, published: DataFrame, key: str = "event_id") -> DataFrame:
    """Pending pointers that no later run has published, each once."""
    return pending.dropDuplicates([key]).join(published.select(key).distinct(), key, "left_anti")

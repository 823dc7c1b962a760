"""Readers of the dedup index: date pruning, shard pruning, tolerant JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions.text import hash_prefix

INDEX_SCHEMA = "schema_version string, dedup_key string, event_id string, source_id string, content_hash string, exact_source_key string, canonical_url_hash string, normalized_content_hash string, simhash64 string, dedup_decision string, duplicate_of_event_id string, observed_at_ms bigint"


def simhash_of(text: Column) -> Column:
    """Bit pattern of a 16-digit (or shorter) hex text; null for anything else."""
    return F.when(text.rlike("^[0-9a-fA-F]{1,16}$"), F.conv(text, 16, -10).cast("bigint"))


def known(index: DataFrame) -> DataFrame:
    """Index records as known keys: dedup_key always; the rest only with an event id; content falls back to an old record's hash."""
    has = F.col("event_id").isNotNull()
    return index.where(F.col("dedup_key").isNotNull()).select(
        "dedup_key", "event_id", F.when(has, F.col("exact_source_key")).alias("exact_source_key"),
        F.when(has, F.coalesce("normalized_content_hash", "content_hash")).alias("content"), F.when(has, simhash_of(F.col("simhash64"))).alias("bits"), "observed_at_ms",
    )


def read_index(spark: SparkSession, path: str, dates: list[str] | None = None) -> DataFrame:
    """JSON lines under dt= folders; blank and damaged lines are skipped; only the dates given are read."""
    df = spark.read.schema(INDEX_SCHEMA + ", dt string, _corrupt string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    df = df.where(F.col("dt").isin(dates)) if dates else df
    return df.where("_corrupt is null and dedup_key is not null").drop("_corrupt")


def candidate_shards(events: DataFrame) -> DataFrame:
    """Distinct two-digit prefixes that events' lookups need: at most 256 rows."""
    cols = [hash_prefix(F.col(c)) for c in ("exact_source_key", "canonical_url_hash", "normalized_content_hash")]
    return events.select(F.explode(F.array(*cols)).alias("hash_prefix")).where("hash_prefix is not null").distinct()


def pruned(sharded_index: DataFrame, events: DataFrame) -> DataFrame:
    """The index shards that events need; the list of prefixes is at most 256 rows, so it is broadcast and prunes partitions."""
    return sharded_index.join(F.broadcast(candidate_shards(events)), "hash_prefix", "left_semi")


def recent_dates(today: Column, lookback: int) -> Column:
    """ISO dates from today back, lookback + 1 of them, the latest first."""
    return F.transform(F.sequence(F.lit(0), F.lit(lookback)), lambda i: F.date_sub(today, i).cast("string"))


def read_recent(spark: SparkSession, path: str, today: str, lookback: int = 14) -> DataFrame:
    """The index records of today (ISO) and the lookback days before it: older dates are out of retention, and their folders unread."""
    dates = [r[0] for r in spark.range(1).select(F.explode(recent_dates(F.lit(today).cast("date"), lookback))).collect()]
    return read_index(spark, path, dates)


def candidate_partitions(events: DataFrame, today: str, lookback: int = 14) -> DataFrame:
    """dt and hash_prefix of the index partitions that events' lookups need: at most 256 prefixes for each date."""
    return candidate_shards(events).select(F.explode(recent_dates(F.lit(today).cast("date"), lookback)).alias("dt"), "hash_prefix")

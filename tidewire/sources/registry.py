"""The source registry: read from JSON, and which sources a run takes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ALL = "all_major_50"
MANUAL_ADAPTERS = ("perp_funding_history",)
_ASSET = "struct<asset:string,reference_symbol_native:string,rss_seed_status:string>"
_SOURCE = (
    "struct<source_id:string,source_category:string,source_name:string,source_url:string,fetch_method:string,adapter:string,max_items_per_run:bigint,trust_tier:string,cadence_tier:string,"
    "language_hint:string,enabled:boolean,source_state:string,activation_blocker:string,top50_relevance_mode:string,applies_to_assets:variant>"
)


def read_registry(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(assets, sources) of a registry document; applies_to_assets, a word or a list, becomes applies_mode and applies_assets."""
    doc = spark.read.option("multiLine", True).schema(f"universe_assets array<{_ASSET}>, sources array<{_SOURCE}>").json(path)
    assets = doc.select(F.inline("universe_assets"))
    src = doc.select(F.inline("sources"))
    words = F.try_variant_get("applies_to_assets", "$", "array<string>")
    word = F.when(words.isNull(), F.try_variant_get("applies_to_assets", "$", "string"))
    return assets, src.withColumns({"applies_mode": F.when(word == ALL, ALL).when(words.isNotNull(), "list").otherwise(word), "applies_assets": words}).drop("applies_to_assets")


def manual_backfill() -> Column:
    """Sources that only run when asked for by name."""
    return ~F.col("enabled") & (F.col("source_state") == "available_disabled") & F.coalesce(F.col("adapter").isin(*MANUAL_ADAPTERS), F.lit(False))


def selected_sources(sources: DataFrame, source_id: str | None = None) -> DataFrame:
    """The enabled sources, or the one asked for if it is enabled or a manual backfill."""
    if source_id is None:
        return sources.where("enabled")
    return sources.where((F.col("source_id") == source_id) & (F.col("enabled") | manual_backfill()))


def required_source(sources: DataFrame, source_id: str) -> DataFrame:
    """The one source asked for; an error if the registry has none that may run."""
    found = selected_sources(sources, source_id)
    if found.isEmpty():
        raise ValueError(f"source {source_id} is not enabled or does not exist")
    return found


def due_sources(sources: DataFrame, states: DataFrame, now_ms: Column, manual: bool = False) -> DataFrame:
    """Adds gate: skip_backoff while a source backs off (also in a manual run), skip_cadence before its interval is over, else due.
    States (source_id, backoff_until_ms, last_success_at_ms) are one row a source; sources without one are due."""
    from tidewire.operators.health import cadence_ms

    s = states.select("source_id", "backoff_until_ms", "last_success_at_ms")
    waits = F.coalesce(F.col("backoff_until_ms") > now_ms, F.lit(False))
    early = F.lit(False) if manual else F.coalesce(now_ms < F.col("last_success_at_ms") + cadence_ms(F.col("cadence_tier")), F.lit(False))
    return sources.join(s, "source_id", "left").withColumn("gate", F.when(waits, "skip_backoff").when(early, "skip_cadence").otherwise("due"))

"""From feed items to events: identity, classification and scores as one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.instants import parse_published_at_ms
from tidewire.functions.text import clean_text, hash_hex, normalize_text, short_hash, simhash64, simhash_hex
from tidewire.functions.urls import canonical_url
from tidewire.operators.symbols import haystack, symbol_matcher

#: Fixed values of the event contract.
EVENT_SCHEMA = "raw_intel_event_v1"
ANNOUNCEMENTS = "notice_cms_list"
FUNDING, FUNDING_HISTORY = "perp_funding_latest", "perp_funding_history"
INTEREST, INTEREST_RECENT = "perp_open_interest", "perp_open_interest_recent"
HINTS = {"governance": "governance_update", "developer_activity": "developer_release", "project_notice": "project_notice", "social": "community_reaction", "news": "news_article", "exchange_notice": "exchange_notice", "funding": "derivatives_snapshot"}
KINDS = {"governance": "governance_update", "developer_activity": "developer_activity", "project_notice": "project_notice", "social": "community_reaction", "news": "news_article", "exchange_notice": "exchange_notice", "funding": "derivatives_snapshot"}
SHORT_CHARS = 120
#: The fields of an event, in order.
EVENT_FIELDS = (
    "event_id", "source_id", "source_category", "source_name", "fetched_at_ms", "published_at_ms", "observed_at_ms", "language", "title", "body", "url", "author_or_channel", "trust_tier", "cadence_tier", "content_hash", "dedup_key",
    "exact_source_key", "canonical_url", "canonical_url_hash", "normalized_content_hash", "simhash64", "dedup_decision", "duplicate_of_event_id", "symbol_candidates", "event_category_hint", "top50_relevance", "content_kind",
    "content_quality", "content_quality_score", "source_quality", "source_relevance_scope", "direct_asset_count", "matched_asset_count", "historical_source_depth", "backfill_window_start_ms", "backfill_window_end_ms",
    "source_time_range_verified", "schema_version",
)


def _cases(of: Column, table: dict[str, str], other: str) -> Column:
    out = F.lit(other)
    for k, v in table.items():
        out = F.when(of == k, v).otherwise(out)
    return out


def category_hint(adapter: Column, source_id: Column, category: Column) -> Column:
    announced = (
        F.when(source_id.contains("listing") & ~source_id.contains("delisting"), "exchange_listing")
        .when(source_id.contains("delisting"), "exchange_delisting").when(source_id.contains("maintenance"), "exchange_maintenance")
    )
    by_adapter = F.when(adapter == ANNOUNCEMENTS, announced)
    for name, hint in ((FUNDING, "funding_rate_snapshot"), (FUNDING_HISTORY, "funding_rate_history"), (INTEREST, "open_interest_snapshot"), (INTEREST_RECENT, "open_interest_snapshot_recent")):
        by_adapter = by_adapter.when(adapter == name, hint)
    return F.coalesce(by_adapter, _cases(category, HINTS, "raw_intel_observation"))


def content_kind(category: Column) -> Column:
    return _cases(category, KINDS, "raw_intel_observation")


def source_depth(adapter: Column, method: Column) -> Column:
    return (
        F.when(adapter == FUNDING_HISTORY, "range_queryable").when(adapter == INTEREST_RECENT, "recent_1m").when(adapter.isin(FUNDING, INTEREST), "live_only")
        .when(adapter == ANNOUNCEMENTS, "feed_retained").when(method == "rss", "feed_retained").otherwise("unknown")
    )


def source_quality(category: Column, tier: Column, direct: Column, matched: Column) -> Column:
    return (
        F.when(category == "funding", "market_snapshot").when(category == "social", "community_reaction")
        .when((tier == "T0") & (direct > 0), "trusted_direct").when(tier == "T0", "trusted_official")
        .when((tier == "T1") & (matched > 0), "trusted_symbol_match").otherwise("general_context")
    )


def relevance_scope(mode: Column, direct: Column, matched: Column) -> Column:
    return F.when(direct > 0, "direct_asset").when(matched > 0, "symbol_alias_match").when(mode == "symbol_alias_match", "global_symbol_scan").otherwise("unknown")


def content_quality(category: Column, body: Column) -> Column:
    t = F.trim(body)
    return (
        F.when(category == "funding", "numeric_observation").when(t == "", "title_only")
        .when(t.startswith("{") & t.endswith("}"), "metadata_fallback").when(F.length(t) < SHORT_CHARS, "short_text").otherwise("full_text")
    )


def quality_score(quality: Column, tier: Column, direct: Column, matched: Column) -> Column:
    base = F.when(quality == "full_text", 70).when(quality == "numeric_observation", 55).when(quality == "short_text", 50).when(quality == "metadata_fallback", 40).when(quality == "title_only", 25).otherwise(35)
    return F.least(base + F.when(tier == "T0", 15).when(tier == "T1", 8).otherwise(0) + F.when(direct > 0, 10).when(matched > 0, 5).otherwise(0), F.lit(100)).cast("int")


def fingerprint(title: Column, body: Column, url: Column) -> dict[str, Column]:
    """Columns by name; the simhash of a text is a bit pattern, in simhash_bits."""
    normal = normalize_text(F.concat(F.coalesce(title, F.lit("")), F.lit("\n"), F.coalesce(body, F.lit(""))))
    canonical = canonical_url(url)
    return {"canonical_url": canonical, "canonical_url_hash": hash_hex(canonical), "normalized_content_hash": hash_hex(normal), "simhash_bits": simhash64(normal)}


def identity(df: DataFrame) -> DataFrame:
    """Adds exact_source_key, content_hash, dedup_key and event_id to rows with id, source_id and a fingerprint."""
    basis = F.coalesce(F.when(F.trim("id") != "", F.col("id")), F.col("canonical_url"))
    exact = hash_hex(F.concat("source_id", F.lit(":"), normalize_text(basis)))
    df = df.withColumns({"exact_source_key": exact, "content_hash": hash_hex(F.concat("normalized_content_hash", F.lit("\n"), "canonical_url_hash"))})
    df = df.withColumn("dedup_key", F.concat_ws(":", "source_id", "exact_source_key", "normalized_content_hash"))
    return df.withColumn("event_id", F.concat(F.lit("intel_evt_"), short_hash(F.col("dedup_key"))))


def build_events(items: DataFrame, sources: DataFrame, universe: DataFrame, fetched_at_ms: Column | int | None = None) -> DataFrame:
    """One event per feed item of a known source. Title and body lose their tags before they are hashed and matched; the sources
    are a registry, joined by their id. Items of unknown sources give no event; null texts count as empty. An event is observed
    when it was published, else when it was fetched; items may lack published_at and author, which then are null."""
    src = sources.select("source_id", "source_category", "source_name", "fetch_method", "adapter", "trust_tier", "cadence_tier", "language_hint", "top50_relevance_mode", "applies_mode", "applies_assets")
    given = lambda c: F.col(c) if c in items.columns else F.lit(None).cast("string")
    fetched = fetched_at_ms if isinstance(fetched_at_ms, Column) else F.lit(fetched_at_ms)
    window = {c: (F.col(c) if c in items.columns else F.lit(None)).cast("bigint") for c in ("backfill_window_start_ms", "backfill_window_end_ms")}
    verified = F.coalesce(F.col("source_time_range_verified"), F.lit(False)) if "source_time_range_verified" in items.columns else F.lit(False)
    items = items.withColumns(window | {"source_time_range_verified": verified, "dedup_decision": F.lit("new"), "duplicate_of_event_id": F.lit(None).cast("string")})
    items = items.withColumns({"published_at_ms": parse_published_at_ms(given("published_at")), "author_or_channel": given("author"), "fetched_at_ms": fetched.cast("bigint")})
    df = items.withColumns({"title": clean_text(F.coalesce("title", F.lit(""))), "body": clean_text(F.coalesce("body", F.lit("")))}).join(src, "source_id")
    match = symbol_matcher(universe)
    direct = F.when(F.col("applies_mode") == "list", F.coalesce("applies_assets", F.array().cast("array<string>"))).otherwise(F.array().cast("array<string>"))
    df = df.withColumns({"matched": match(haystack(F.col("title"), F.col("body"), F.coalesce("url", F.lit("")))), "direct": direct})
    df = identity(df.withColumns(fingerprint(F.col("title"), F.col("body"), F.coalesce("url", F.lit("")))))
    d, m = F.size("direct"), F.size("matched")
    quality = content_quality(F.col("source_category"), F.col("body"))
    return df.withColumns({
        "simhash64": simhash_hex(F.col("simhash_bits")), "symbol_candidates": F.array_sort(F.array_union("direct", "matched")),
        "event_category_hint": category_hint(F.col("adapter"), F.col("source_id"), F.col("source_category")), "content_kind": content_kind(F.col("source_category")),
        "content_quality": quality, "content_quality_score": quality_score(quality, F.col("trust_tier"), d, m),
        "source_quality": source_quality(F.col("source_category"), F.col("trust_tier"), d, m), "source_relevance_scope": relevance_scope(F.col("top50_relevance_mode"), d, m),
        "historical_source_depth": F.coalesce("historical_source_depth", source_depth(F.col("adapter"), F.col("fetch_method"))),
        "direct_asset_count": d.cast("bigint"), "matched_asset_count": m.cast("bigint"), "schema_version": F.lit(EVENT_SCHEMA),
        "observed_at_ms": F.coalesce("published_at_ms", "fetched_at_ms"), "language": F.col("language_hint"),
    }).withColumn("top50_relevance", F.when(F.size("symbol_candidates") > 0, "relevant").otherwise("unknown")).drop("simhash_bits", "direct", "matched", "applies_mode", "applies_assets", "top50_relevance_mode")

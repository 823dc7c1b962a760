"""Which assets the sources of a registry cover."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def applies(assets: DataFrame, sources: DataFrame) -> DataFrame:
    """asset, source rows and direct (the source names the asset). Two equi-joins in place of a theta join: sources that apply to all
    are paired by a constant key (registry size), the others by the names they list."""
    src = sources.select("source_id", "source_category", "enabled", "source_state", "applies_mode", "applies_assets")
    listed = src.where("applies_mode = 'list'").withColumn("asset", F.explode(F.array_distinct("applies_assets"))).join(assets.select("asset"), "asset").withColumn("direct", F.lit(True))
    everyone = assets.select("asset", F.lit("all_major_50").alias("applies_mode")).join(src, "applies_mode").withColumn("direct", F.lit(False))
    return listed.select("asset", "source_id", "source_category", "enabled", "source_state", "direct").unionByName(everyone.select("asset", "source_id", "source_category", "enabled", "source_state", "direct"))


def coverage(assets: DataFrame, sources: DataFrame) -> DataFrame:
    """One row per asset: counts of enabled and available disabled sources, direct and global; sorted ids; a histogram of enabled
    categories; status and gaps. Assets without a source stay."""
    x = applies(assets, sources)
    on, off = F.col("enabled"), ~F.col("enabled") & (F.col("source_state") == "available_disabled")
    agg = x.groupBy("asset").agg(
        F.count_if(on & F.col("direct")).alias("enabled_direct"), F.count_if(on & ~F.col("direct")).alias("enabled_global"),
        F.count_if(off & F.col("direct")).alias("disabled_direct"), F.count_if(off & ~F.col("direct")).alias("disabled_global"),
        F.array_sort(F.collect_set(F.when(on & F.col("direct"), F.col("source_id")))).alias("direct_source_ids"),
        F.count_if(on & (F.col("source_category") == "news")).alias("news"), F.count_if(on & (F.col("source_category") == "social")).alias("social"),
    )
    hist = x.where(on).groupBy("asset", "source_category").agg(F.count(F.lit(1)).alias("n")).groupBy("asset").agg(F.array_sort(F.collect_list(F.struct("source_category", "n"))).alias("h"))
    out = assets.select("asset").join(agg, "asset", "left").join(hist, "asset", "left")
    n = lambda c: F.coalesce(c, F.lit(0))
    status = F.when(n("enabled_direct") > 0, "asset_specific_enabled").when(n("disabled_direct") > 0, "asset_specific_available_disabled").when(n("enabled_global") > 0, "global_symbol_match_only").otherwise("missing_enabled_source")
    gaps = F.array(
        F.when(n("enabled_direct") == 0, "missing_enabled_asset_specific_source"),
        F.when((n("disabled_direct") + n("disabled_global") == 0) & (n("social") == 0), "missing_community_reaction_inventory"),
        F.when(n("news") == 0, "missing_global_news_source"),
    )
    counts = {c: n(c) for c in ("enabled_direct", "enabled_global", "disabled_direct", "disabled_global")}
    return out.withColumns(counts).select(
        "asset", *counts, F.coalesce("direct_source_ids", F.array().cast("array<string>")).alias("direct_source_ids"),
        F.map_from_entries(F.coalesce("h", F.array().cast("array<struct<source_category:string,n:bigint>>"))).alias("enabled_category_counts"),
        status.alias("coverage_status"), F.filter(gaps, lambda g: g.isNotNull()).alias("quality_gaps"),
    )


def histogram(df: DataFrame, column: str) -> DataFrame:
    """column, n ordered by falling count, then value."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)


def registry_violations(assets: DataFrame, sources: DataFrame) -> DataFrame:
    """rule and subject of every breach of the registry's shape; empty for a sound one. Tables of registry size."""
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    categories = ("news", "exchange_notice", "funding", "project_notice", "social", "governance", "developer_activity")
    s = F.coalesce("source_id", F.lit(""))
    checks = [
        ("blank_source_id", blank("source_id")), ("unknown_category", ~F.coalesce(F.col("source_category").isin(*categories), F.lit(False))),
        ("unknown_trust_tier", ~F.coalesce(F.col("trust_tier").isin("T0", "T1", "T2"), F.lit(False))), ("unknown_cadence", ~F.coalesce(F.col("cadence_tier").isin("high", "medium", "low"), F.lit(False))),
        ("unknown_mode", ~F.coalesce(F.col("top50_relevance_mode").isin("symbol_alias_match", "direct_asset"), F.lit(False))),
        ("unknown_state", F.col("source_state").isNotNull() & ~F.col("source_state").isin("enabled", "available_disabled", "blocked", "unsupported")),
        ("state_not_aligned", F.col("source_state").isNotNull() & (F.col("enabled") != (F.col("source_state") == "enabled"))),
        ("disabled_without_blocker", F.col("source_state").isNotNull() & ~F.col("enabled") & blank("activation_blocker")),
        ("unfetchable", F.col("enabled") & ~F.coalesce(F.col("fetch_method").isin("rss", "rest_api", "html_crawl"), F.lit(False))),
        ("rest_without_adapter", (F.col("fetch_method") == "rest_api") & blank("adapter")),
        ("zero_items", F.coalesce(F.col("max_items_per_run") == 0, F.lit(False))), ("not_https", ~F.coalesce(F.col("source_url").startswith("https://"), F.lit(False))),
        ("unknown_applies", ~F.coalesce(F.col("applies_mode").isin("all_major_50", "list"), F.lit(False))),
        ("all_not_by_alias", (F.col("applies_mode") == "all_major_50") & (F.col("top50_relevance_mode") != "symbol_alias_match")),
        ("list_not_direct", (F.col("applies_mode") == "list") & ((F.coalesce(F.size("applies_assets"), F.lit(0)) < 1) | (F.col("top50_relevance_mode") != "direct_asset"))),
    ]
    row = sources.select(F.explode(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.struct(F.lit(r).alias("rule"), s.alias("subject"))) for r, c in checks])).alias("v")).where("v is not null").select("v.rule", "v.subject")
    again = lambda df, c, rule: df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.lit(rule).alias("rule"), F.col(c).alias("subject"))
    none = lambda df, rule: df.agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(F.lit(rule).alias("rule"), F.lit("").alias("subject"))
    named = sources.where("enabled and applies_mode = 'list'").select(F.explode("applies_assets").alias("asset")).distinct()
    return (
        row.unionByName(again(sources, "source_id", "source_id_twice")).unionByName(again(assets, "asset", "asset_twice")).unionByName(again(assets, "reference_symbol_native", "symbol_twice"))
        .unionByName(named.join(assets.select("asset"), "asset", "left_anti").select(F.lit("asset_not_in_universe").alias("rule"), F.coalesce("asset", F.lit("")).alias("subject")))
        .unionByName(assets.where(blank("asset")).select(F.lit("blank_asset").alias("rule"), F.lit("").alias("subject")))
        .unionByName(assets.where(blank("reference_symbol_native")).select(F.lit("blank_symbol").alias("rule"), F.coalesce("asset", F.lit("")).alias("subject")))
        .unionByName(none(assets, "no_assets")).unionByName(none(sources, "no_sources"))
    )


def focus_symbols(gap: DataFrame) -> DataFrame:
    """Distinct canonical symbols of a candidate-gap document (one JSON text per row, `doc`), whichever of its known shapes it has."""
    from tidewire.functions.text import canonical_symbol

    v = F.try_parse_json("doc")
    shapes = [F.try_variant_get(v, path, "array<string>") for path in ("$.gaps.approved_symbols_without_candidate", "$.approved_symbols_without_candidate")]
    listed = F.transform(F.try_variant_get(v, "$.symbols", "array<struct<symbol:string>>"), lambda s: s.symbol)
    return gap.select(F.explode(F.coalesce(listed, *shapes)).alias("s")).where("s is not null").select(canonical_symbol(F.col("s")).alias("asset")).where("asset <> ''").distinct()


def diagnosis(covered: DataFrame, focus: DataFrame) -> DataFrame:
    """One row: how many focus symbols are outside the universe, directly covered, only available, or without inventory; and the
    verdict, the first of the ladder that applies. Registry-sized tables."""
    f = focus.select("asset").distinct().withColumn("focus", F.lit(True))
    x = covered.join(f, "asset", "full_outer")
    inside = F.col("coverage_status").isNotNull()
    asked = F.coalesce("focus", F.lit(False))
    n = lambda c: F.count_if(c)
    none = (F.col("enabled_direct") == 0) & (F.col("disabled_direct") == 0)
    out = x.agg(
        n(inside).alias("assets"), n(asked).alias("focus_symbols"), n(asked & ~inside).alias("outside_universe"),
        n(asked & (F.col("enabled_direct") > 0)).alias("focus_direct"), n(asked & (F.col("enabled_direct") == 0) & (F.col("disabled_direct") > 0)).alias("focus_available"),
        n(asked & none).alias("focus_without_inventory"), n(inside & (F.col("enabled_direct") == 0)).alias("assets_without_direct"),
    )
    verdict = (
        F.when(F.col("outside_universe") > 0, "RECONCILE_CANDIDATE_GAP_UNIVERSE").when(F.col("focus_symbols") == 0, "PASS_CANDIDATE_GAP_DIAGNOSIS")
        .when(F.col("focus_available") > 0, "INSPECT_CANDIDATE_SOURCE_ACTIVATION_BLOCKERS").when(F.col("focus_without_inventory") > 0, "ADD_CANDIDATE_DIRECT_SOURCE_INVENTORY")
        .when(F.col("assets_without_direct") > 0, "EXPAND_MAJOR50_DIRECT_SOURCE_COVERAGE").otherwise("NO_SOURCE_COVERAGE_GAP_DETECTED")
    )
    return out.withColumn("verdict", verdict)


DETAIL = ("source_id", "source_name", "source_url", "source_category", "fetch_method", "trust_tier", "activation_blocker")


def available_sources(assets: DataFrame, sources: DataFrame) -> DataFrame:
    """asset, available_ids (of all available disabled sources that apply) and available_direct (details of those that name the asset,
    by id; of equal ids, which a sound registry has not, the greatest row), sorted. Assets without any have empty arrays."""
    off = applies(assets, sources).where("not enabled and source_state = 'available_disabled'")
    detail = sources.groupBy("source_id").agg(F.max(F.struct(*DETAIL)).alias("d"))
    by = off.join(detail, "source_id").groupBy("asset").agg(F.array_sort(F.collect_set("source_id")).alias("ids"), F.array_sort(F.collect_set(F.when(F.col("direct"), F.col("d")))).alias("own"))
    none = F.array().cast("array<string>")
    own = F.array().cast(f"array<struct<{','.join(f'{c}:string' for c in DETAIL)}>>")
    return assets.select("asset").join(by, "asset", "left").select("asset", F.coalesce("ids", none).alias("available_ids"), F.coalesce("own", own).alias("available_direct"))


def diagnosis_records(covered: DataFrame) -> DataFrame:
    """The records of coverage() with the gaps that a diagnosis looks for: no enabled direct source, no available direct one, no
    enabled global one."""
    gaps = F.array(
        F.when(F.col("enabled_direct") == 0, "missing_enabled_asset_specific_source"), F.when(F.col("disabled_direct") == 0, "missing_available_disabled_asset_source_inventory"),
        F.when(F.col("enabled_global") == 0, "missing_global_news_source"),
    )
    return covered.withColumn("quality_gaps", F.array_compact(gaps))


def activation_review(assets: DataFrame, sources: DataFrame, focus: DataFrame) -> DataFrame:
    """asset and details of each available source of focus symbols that no enabled source names: what is to be probed first."""
    covered = coverage(assets, sources).where("enabled_direct = 0 and disabled_direct > 0").join(focus.select("asset").distinct(), "asset", "left_semi").select("asset")
    return available_sources(assets, sources).join(covered, "asset", "left_semi").select("asset", F.inline("available_direct"))

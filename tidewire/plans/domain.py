"""Queries of sources, matching, classification, quotas, coverage, health and storage layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions.text import utc_date
from tidewire.operators.admission import STANDARD, admit, balance_class, first_items, item_limit, rotated_priority, run_caps, selection_seed
from tidewire.operators.coverage import coverage, diagnosis, histogram, registry_violations
from tidewire.operators.events import category_hint, content_kind, content_quality, quality_score, relevance_scope, source_depth, source_quality
from tidewire.operators.health import cadence_admitted, failure_runs, failure_type, heal_records, health_level, retryable
from tidewire.operators.symbols import haystack, symbol_matcher
from tidewire.plans.ingest import Run, ingest
from tidewire.sources.feeds import feed_items
from tidewire.sources.index import known, recent_dates
from tidewire.sources.layout import event_partitions, locate, manifest, replay
from tidewire.sources.payloads import announcements, in_range, latest_per_key, rest_items, rich_text_column
from tidewire.sources.pointers import created_pointers
from tidewire.sources.registry import manual_backfill
from tidewire.session import read, spread


def symbol_match(spark: SparkSession, d: str) -> DataFrame:
    match = symbol_matcher(read(spark, d, "universe_asset"))
    return spread(read(spark, d, "raw_intel_event").select("event_ord", "title", "body", "url")).select("event_ord", F.array_join(match(haystack(F.col("title"), F.col("body"), F.col("url"))), ",").alias("assets"))


def event_classification(spark: SparkSession, d: str) -> DataFrame:
    src = read(spark, d, "intel_source").select("source_id", "adapter", "fetch_method", "top50_relevance_mode", F.col("trust_tier").alias("tier"), F.col("source_category").alias("category"))
    df = read(spark, d, "raw_intel_event").join(src, "source_id")
    direct, matched = F.col("direct_asset_count"), F.col("matched_asset_count")
    quality = content_quality(F.col("category"), F.coalesce("body", F.lit("")))
    return df.select(
        "event_ord", category_hint(F.col("adapter"), F.col("source_id"), F.col("category")).alias("hint"), content_kind(F.col("category")).alias("kind"), source_depth(F.col("adapter"), F.col("fetch_method")).alias("depth"),
        source_quality(F.col("category"), F.col("tier"), direct, matched).alias("source_quality"), relevance_scope(F.col("top50_relevance_mode"), direct, matched).alias("scope"),
        quality.alias("quality"), quality_score(quality, F.col("tier"), direct, matched).alias("score"),
    )


def topk_per_source(spark: SparkSession, d: str) -> DataFrame:
    src = read(spark, d, "intel_source").select("source_id", F.least(F.coalesce("max_items_per_run", F.lit(50)), F.lit(50)).alias("k"))
    items = read(spark, d, "feed_item").select("item_key", "source_id", "run_id", "item_ord").withColumn("feed", F.concat_ws("/", "run_id", "source_id")).join(src, "source_id")
    return first_items(items, "feed", ["item_ord", "item_key"], F.col("k")).select("item_key", "source_id", "run_id", "item_ord")


CAPS = run_caps()


def _classed(spark: SparkSession, d: str) -> DataFrame:
    """Events with the class of their source; those of sources that the registry lacks are standard."""
    src = read(spark, d, "intel_source").select("source_id", balance_class(F.col("source_category"), F.col("fetch_method"), manual_backfill()).alias("kind"))
    rows = read(spark, d, "raw_intel_event").select("event_ord", "run_id", "source_id").join(src, "source_id", "left")
    return rows.withColumn("kind", F.coalesce("kind", F.lit(STANDARD)))


def balance_admission(spark: SparkSession, d: str) -> DataFrame:
    return admit(_classed(spark, d), "run_id", "kind", ["event_ord"], CAPS).select("event_ord", "kind", "admitted", "suppression_reason")


def asset_coverage(spark: SparkSession, d: str) -> DataFrame:
    c = coverage(read(spark, d, "universe_asset"), read(spark, d, "intel_source"))
    cats = F.array_join(F.transform(F.array_sort(F.map_keys("enabled_category_counts")), lambda k: F.concat(k, F.lit("="), F.element_at(F.col("enabled_category_counts"), k).cast("string"))), ",")
    return c.select("asset", "enabled_direct", "enabled_global", "disabled_direct", "disabled_global", F.array_join("direct_source_ids", ",").alias("direct"), cats.alias("categories"), "coverage_status", F.array_join("quality_gaps", ",").alias("gaps"))


def category_histogram(spark: SparkSession, d: str) -> DataFrame:
    return histogram(read(spark, d, "raw_intel_event"), "source_category")


def registry_violations_q(spark: SparkSession, d: str) -> DataFrame:
    return registry_violations(read(spark, d, "universe_asset"), read(spark, d, "intel_source"))


#: One breach for each source, chosen by the last letter of its id, and some of assets: the same in the query and its SQL.
_BROKEN = """src AS (SELECT source_id, CASE WHEN n = 0 THEN 'weather' ELSE source_category END AS source_category, CASE WHEN n = 1 THEN NULL ELSE trust_tier END AS trust_tier, CASE WHEN n = 2 THEN 'hourly' ELSE cadence_tier END AS cadence_tier,
  CASE WHEN n = 3 THEN 'other' ELSE top50_relevance_mode END AS top50_relevance_mode, CASE WHEN n = 4 THEN 'paused' ELSE source_state END AS source_state, CASE WHEN n = 5 THEN 'ftp' WHEN n = 6 THEN 'rest_api' ELSE fetch_method END AS fetch_method,
  CASE WHEN n = 6 THEN ' ' ELSE adapter END AS adapter, CASE WHEN n = 7 THEN 0 ELSE max_items_per_run END AS max_items_per_run, CASE WHEN n = 8 THEN 'http://plain.test' ELSE source_url END AS source_url,
  CASE WHEN n = 9 THEN 'some' WHEN n = 10 THEN 'list' ELSE applies_mode END AS applies_mode, CASE WHEN n = 10 THEN {array}('ZZZ', NULL) ELSE applies_assets END AS applies_assets, CASE WHEN n = 11 THEN NOT enabled ELSE enabled END AS enabled,
  CASE WHEN n = 12 THEN ' ' ELSE activation_blocker END AS activation_blocker FROM (SELECT *, ascii(right(source_id, 1)) % 13 AS n FROM intel_source)
  UNION ALL SELECT source_id, source_category, trust_tier, cadence_tier, top50_relevance_mode, source_state, fetch_method, adapter, max_items_per_run, source_url, applies_mode, applies_assets, enabled, activation_blocker FROM intel_source WHERE fetch_method = 'rest_api'
  UNION ALL SELECT CAST(NULL AS STRING), source_category, trust_tier, cadence_tier, top50_relevance_mode, 'available_disabled', fetch_method, adapter, max_items_per_run, source_url, 'list', {array}(), false, NULL FROM intel_source WHERE fetch_method = 'rss'),
ast AS (SELECT asset, reference_symbol_native FROM universe_asset UNION ALL SELECT asset, CASE WHEN asset < 'F' THEN ' ' ELSE reference_symbol_native END FROM universe_asset WHERE asset < 'M' UNION ALL SELECT ' ', NULL FROM universe_asset WHERE asset < 'C')"""


def registry_breaches(spark: SparkSession, d: str) -> DataFrame:
    """The checks on a registry that breaks each rule."""
    views = {t: read(spark, d, t) for t in ("intel_source", "universe_asset")}
    text = _BROKEN.format(array="array").replace("FROM intel_source", "FROM {intel_source}").replace("FROM universe_asset", "FROM {universe_asset}")
    assets, sources = (spark.sql(f"WITH {text} SELECT * FROM {t}", **views) for t in ("ast", "src"))
    return registry_violations(assets, sources)


def _attempts(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "events").select("event_id", "user_id", F.expr("timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', ts)").alias("at_ms"), "event_type", "value")


def failure_backoff(spark: SparkSession, d: str) -> DataFrame:
    out = failure_runs(_attempts(spark, d), "user_id", "at_ms", ["at_ms", "event_id"], F.col("event_type") == "error")
    return out.select("event_id", "failure_count", "backoff_until_ms")


def cadence_admission(spark: SparkSession, d: str) -> DataFrame:
    return cadence_admitted(_attempts(spark, d), "user_id", "at_ms", 21_600_000)


def _error() -> F.Column:
    n = F.col("event_id") % 7
    return F.when(n == 0, "returned HTTP 429").when(n == 1, "operation timed out").when(n == 2, "did not return an XML feed").when(n == 3, "Challenge page").when(n == 4, "no usable items").when(n == 5, "connection reset").otherwise("returned HTTP 404")


def health_records(spark: SparkSession, d: str) -> DataFrame:
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "view", "not_modified").when(F.col("value") < 5, "no_items").otherwise("ok")
    rows = _attempts(spark, d).withColumns({"status": status, "error": F.when(F.col("event_type") == "error", _error())})
    return rows.select("event_id", "status", health_level(F.col("status")).alias("level"), F.when(F.col("error").isNotNull(), failure_type(F.col("error"))).alias("failure_type"), retryable(F.col("error")).alias("retryable"))


def heal_records_q(spark: SparkSession, d: str) -> DataFrame:
    rows = _attempts(spark, d).where("event_type = 'error'").select(F.col("user_id").cast("string").alias("source"), "at_ms", _error().alias("error"))
    return heal_records(rows, "source", "at_ms", "error", 900_000).select("heal_event_id", "source_id", "observed_at_ms", "failure_type", "attempt_count", "next_retry_at_ms")


def item_limits(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "intel_source").select("source_id", item_limit(F.col("max_items_per_run"), F.col("source_category"), F.col("fetch_method"), manual_backfill()).alias("item_limit"))


def selection_seeds(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "intel_source").select("source_id", selection_seed(F.col("source_id"), F.lit(1_767_225_600_000)).cast("string").alias("seed"))


def index_dates(spark: SparkSession, d: str) -> DataFrame:
    """The dates of the index that an event fetched on its day looks back on, by day."""
    days = read(spark, d, "raw_intel_event").select(utc_date(F.col("fetched_at_ms")).alias("day")).distinct()
    return days.withColumn("x", recent_dates(F.col("day").cast("date"), 14)).select("day", F.posexplode("x").alias("place", "dt"))


def rest_payload_items(spark: SparkSession, d: str) -> DataFrame:
    """Payloads made of registry sources and assets, each source's adapter chosen by its id; some payloads are no JSON."""
    src = read(spark, d, "intel_source").withColumn("n", F.pmod(F.crc32(F.col("source_id").cast("binary")), F.lit(4)))
    src = src.withColumn("adapter", F.when(F.col("n") == 0, "perp_funding_latest").when(F.col("n") == 1, "perp_funding_history").when(F.col("n") == 2, "perp_open_interest").otherwise("notice_cms_list"))
    assets = read(spark, d, "universe_asset").where("reference_symbol_native is not null")
    symbol, t = F.col("reference_symbol_native"), 1_767_225_600_000
    rate = lambda at: F.concat(F.lit('{"symbol":"'), symbol, F.lit(f'","fundingRate":"0.0001","fundingTime":{at},"markPrice":"12.5"}}'))
    rates = F.concat(F.lit("["), rate(t - 28_800_000), F.lit(","), rate(t), F.lit(","), rate(t + 28_800_000), F.lit("]"))
    interest = F.concat(F.lit('{"symbol":"'), symbol, F.lit(f'","openInterest":"77.1","time":{t}}}'))
    pairs = src.where("n < 3").crossJoin(F.broadcast(assets))
    payload = F.when(symbol.startswith("B"), "oops").when(F.col("n") == 2, interest).otherwise(rates)
    paid = pairs.select("source_id", symbol.alias("symbol"), F.concat("source_url", F.lit("?symbol="), symbol).alias("url"), payload.alias("payload"))
    article = F.concat(F.lit('{"code":"000000","data":{"catalogs":[{"catalogId":1,"catalogName":"n","articles":[{"id":1,"code":"c-'), "source_id", F.lit('","title":"t","releaseDate":1700000000000}]}]}}'))
    lists = src.where("n = 3").select("source_id", F.lit(None).cast("string").alias("symbol"), F.col("source_url").alias("url"), article.alias("payload"))
    limit = item_limit(F.col("max_items_per_run"), F.col("source_category"), F.col("fetch_method"), manual_backfill())
    return rest_items(paid.unionByName(lists), src, assets, F.coalesce(F.col("rss_seed_status") == "verified", F.lit(False)), limit, t, (t, t + 28_800_000))[0]


def asset_rotation(spark: SparkSession, d: str) -> DataFrame:
    return rotated_priority(read(spark, d, "universe_asset").select("asset", "rss_seed_status"), "asset", F.coalesce(F.col("rss_seed_status") == "verified", F.lit(False)), 7).select("asset", F.col("priority").cast("bigint").alias("priority"))


def range_backfill(spark: SparkSession, d: str) -> DataFrame:
    """A backfill's own limit of 500 records over a closed range."""
    o = read(spark, d, "orders")
    return in_range(o, "o_orderdate", F.expr("timestamp_ntz'1995-01-01 00:00:00'"), F.expr("timestamp_ntz'1996-12-31 00:00:00'"), ["o_custkey", "o_orderkey"], 500).select("o_custkey", "o_orderkey")


def latest_rates(spark: SparkSession, d: str) -> DataFrame:
    return latest_per_key(_attempts(spark, d).select("user_id", "at_ms", "event_id"), "user_id", "at_ms")


def _lines(spark: SparkSession, d: str) -> DataFrame:
    rows = event_partitions(read(spark, d, "raw_intel_event"), "fetched_at_ms")
    line = F.concat(F.lit('{"event_id":"'), "event_id", F.lit('","title":"'), F.regexp_replace(F.coalesce("title", F.lit("")), r'["\\\n\r\t]', " "), F.lit('"}'))
    return rows.select("event_ord", "dt", "hour", "source_category", "source_id", line.alias("line"))


def jsonl_locators(spark: SparkSession, d: str) -> DataFrame:
    return locate(_lines(spark, d), ["dt", "hour", "source_category", "source_id"], "event_ord", "line", 3).select("event_ord", "part", "line_number", "byte_offset", "byte_length", "content_sha256")


def created_pointers_q(spark: SparkSession, d: str) -> DataFrame:
    rows = event_partitions(read(spark, d, "raw_intel_event"), "fetched_at_ms").withColumn("line", F.concat(F.lit('{"event_id":"'), "event_id", F.lit('"}')))
    p = created_pointers(locate(rows, ["dt", "hour", "source_category", "source_id", "run_id"], "event_ord", "line"), "bucket", F.col("fetched_at_ms") + 1)
    return p.select("event_id", "created_at_ms", "content_hash", F.array_join("symbol_candidates", ",").alias("symbols"), "storage_ref.key", "storage_ref.line_number", "storage_ref.byte_offset", "storage_ref.content_sha256")


def coverage_diagnosis(spark: SparkSession, d: str) -> DataFrame:
    """The focus is the universe's own verified assets."""
    assets = read(spark, d, "universe_asset")
    return diagnosis(coverage(assets, read(spark, d, "intel_source")), assets.where("rss_seed_status = 'verified'").select("asset"))


def ingest_run(spark: SparkSession, d: str) -> DataFrame:
    run = Run("intel-crawl-20260101T000000000000000Z", 1_767_225_600_000, "bucket", CAPS)
    _, pointers = ingest(read(spark, d, "feed_item"), read(spark, d, "intel_source"), read(spark, d, "universe_asset"), known(read(spark, d, "dedup_index_v2")), run)
    return pointers.select("event_id", "source_id", "published_at_ms", "dedup_decision", "duplicate_of_event_id", "storage_ref.key", "storage_ref.line_number", "storage_ref.byte_offset")


def partition_manifest(spark: SparkSession, d: str) -> DataFrame:
    """The objects of a run with their counts, as one manifest row that is opened again for comparison."""
    placed = locate(_lines(spark, d), ["dt", "hour", "source_category", "source_id"], "event_ord", "line", 1000)
    objects = placed.groupBy(F.lit("raw_intel_events").alias("object_family"), F.concat_ws("/", "dt", "hour", "source_category", "source_id", F.col("part").cast("string")).alias("object_key")).agg(F.count(F.lit(1)).alias("record_count"), F.sum(F.col("byte_length") + 1).alias("byte_count"))
    return manifest(objects, "run").select(F.explode("uploaded_objects").alias("o"), "uploaded_object_count").select("o.object_key", "o.record_count", "o.byte_count", "uploaded_object_count")


def outbox_replay(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("event_id")
    line = F.when(n % 11 == 0, "").when(n % 11 == 1, F.concat(F.lit('{"event_id": '), n.cast("string"))).when(n % 11 == 2, F.col("props")).otherwise(F.concat(F.lit('{"event_id": "e'), n.cast("string"), F.lit('"}')))
    return replay(read(spark, d, "events").select("event_id", line.alias("line")), "line").select("event_id", "status", "replayed_event_id")


def _xml(c: str) -> F.Column:
    return F.replace(F.replace(F.coalesce(F.col(c), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def feed_parse(spark: SparkSession, d: str) -> DataFrame:
    src = read(spark, d, "intel_source")
    rss = F.concat(F.lit('<?xml version="1.0"?><rss xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><title>x</title><item><title> '), _xml("source_name"), F.lit("  feed</title><link>"), _xml("source_url"), F.lit("</link><dc:creator>desk</dc:creator><guid> </guid><description>"), _xml("source_category"), F.lit("</description><pubDate>Mon, 06 Jan 2025 10:00:00 GMT</pubDate></item></channel></rss>"))
    atom = F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>'), _xml("source_id"), F.lit("</id><title>"), _xml("source_name"), F.lit('</title><link/><link href="'), _xml("source_url"), F.lit('"/><summary>s</summary><author><name>n</name></author><updated>2025-01-06T10:00:00Z</updated></entry></feed>'))
    rows = src.select(F.concat(F.lit("r:"), "source_id").alias("k"), rss.alias("p")).unionByName(src.select(F.concat(F.lit("a:"), "source_id").alias("k"), atom.alias("p")))
    return feed_items(rows, "k", "p")


def rich_text_flatten(spark: SparkSession, d: str) -> DataFrame:
    tree = F.concat(F.lit('{"node":"root","child":[{"node":"text","text":"  '), "source_id", F.lit('  one"},{"tag":"p","child":[{"node":"text","text":"two"},{"node":"image","text":"no"}]}],"zz":{"node":"text","text":"'), "source_category", F.lit('"}}'))
    return read(spark, d, "intel_source").select("source_id", rich_text_column(tree).alias("flat"))


def announcement_items(spark: SparkSession, d: str) -> DataFrame:
    s = read(spark, d, "supplier")
    article = lambda i: f'{{"id":{i},"code":"c{i}-'
    payload = F.concat(F.lit('{"code":"'), F.when(F.col("s_suppkey") % 5 == 0, "000001").otherwise("000000"), F.lit('","data":{"catalogs":[{"catalogId":1,"catalogName":"n","articles":['), F.lit(article(1)), F.col("s_suppkey").cast("string"), F.lit('","title":"'), "s_name", F.lit('","releaseDate":1700000000000},'), F.lit(article(2)), F.col("s_suppkey").cast("string"), F.lit('","title":"second","releaseDate":null}]}]}}'))
    return announcements(s.select("s_suppkey", payload.alias("p")), "s_suppkey", "p")


QUERIES = {
    "symbol_match": symbol_match, "event_classification": event_classification, "topk_per_source": topk_per_source, "balance_admission": balance_admission,
    "asset_coverage": asset_coverage, "category_histogram": category_histogram, "registry_violations": registry_violations_q, "registry_breaches": registry_breaches, "failure_backoff": failure_backoff, "cadence_admission": cadence_admission,
    "health_records": health_records, "asset_rotation": asset_rotation, "range_backfill": range_backfill, "latest_rates": latest_rates, "jsonl_locators": jsonl_locators, "created_pointers": created_pointers_q, "coverage_diagnosis": coverage_diagnosis, "ingest_run": ingest_run, "partition_manifest": partition_manifest,
    "outbox_replay": outbox_replay, "feed_parse": feed_parse, "rich_text_flatten": rich_text_flatten, "announcement_items": announcement_items,
    "heal_records": heal_records_q, "item_limits": item_limits, "selection_seeds": selection_seeds, "index_dates": index_dates, "rest_payload_items": rest_payload_items,
}

_AT = "epoch_us(ts) // 1000"
_ADMIT = """c AS (SELECT source_id AS id, CASE WHEN source_category = 'funding' AND fetch_method = 'rest_api' AND NOT coalesce(NOT enabled AND source_state = 'available_disabled' AND adapter = 'perp_funding_history', false) THEN 'derivatives_snapshot'
  WHEN source_category = 'social' THEN 'community_reaction' ELSE 'standard_source' END AS kind FROM intel_source),
r AS (SELECT event_ord, run_id, source_id, coalesce(kind, 'standard_source') AS kind, row_number() OVER (PARTITION BY run_id, coalesce(kind, 'standard_source') ORDER BY event_ord) AS n FROM raw_intel_event LEFT JOIN c ON id = source_id),
a AS (SELECT *, CASE kind WHEN 'community_reaction' THEN n <= 30 WHEN 'derivatives_snapshot' THEN n <= 12 ELSE true END AS admitted FROM r)"""
_LINE = """l AS (SELECT event_ord, strftime(make_timestamp(fetched_at_ms * 1000), '%Y-%m-%d') AS dt, strftime(make_timestamp(fetched_at_ms * 1000), '%H') AS hour, source_category, source_id,
'{"event_id":"' || event_id || '","title":"' || regexp_replace(coalesce(title, ''), '["\\\\\\n\\r\\t]', ' ', 'g') || '"}' AS line FROM raw_intel_event)"""


def _located(chunk: int) -> str:
    return f"""{_LINE}, n AS (SELECT *, row_number() OVER (PARTITION BY dt, hour, source_category, source_id ORDER BY event_ord) - 1 AS rn FROM l),
p AS (SELECT *, (rn // {chunk} + 1)::INTEGER AS part, rn % {chunk} + 1 AS line_number, strlen(line)::BIGINT AS byte_length FROM n),
q AS (SELECT *, coalesce(sum(byte_length + 1) OVER (PARTITION BY dt, hour, source_category, source_id, part ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS byte_offset FROM p)"""


def _violations(src: str, ast: str, ctes: str = "") -> str:
    ctes = ctes.replace("{array}(", "list_value(").replace("list_value()", "[]::VARCHAR[]")
    return f"""WITH {ctes}s AS (SELECT *, coalesce(source_id, '') AS subject FROM {src}), r AS (SELECT subject, unnest([
CASE WHEN coalesce(trim(source_id), '') = '' THEN 'blank_source_id' END, CASE WHEN coalesce(source_category, '') NOT IN ('news', 'exchange_notice', 'funding', 'project_notice', 'social', 'governance', 'developer_activity') THEN 'unknown_category' END,
CASE WHEN coalesce(trust_tier, '') NOT IN ('T0', 'T1', 'T2') THEN 'unknown_trust_tier' END, CASE WHEN coalesce(cadence_tier, '') NOT IN ('high', 'medium', 'low') THEN 'unknown_cadence' END,
CASE WHEN coalesce(top50_relevance_mode, '') NOT IN ('symbol_alias_match', 'direct_asset') THEN 'unknown_mode' END, CASE WHEN source_state NOT IN ('enabled', 'available_disabled', 'blocked', 'unsupported') THEN 'unknown_state' END,
CASE WHEN source_state IS NOT NULL AND enabled <> (source_state = 'enabled') THEN 'state_not_aligned' END, CASE WHEN source_state IS NOT NULL AND NOT enabled AND coalesce(trim(activation_blocker), '') = '' THEN 'disabled_without_blocker' END,
CASE WHEN enabled AND coalesce(fetch_method, '') NOT IN ('rss', 'rest_api', 'html_crawl') THEN 'unfetchable' END, CASE WHEN fetch_method = 'rest_api' AND coalesce(trim(adapter), '') = '' THEN 'rest_without_adapter' END,
CASE WHEN max_items_per_run = 0 THEN 'zero_items' END, CASE WHEN coalesce(source_url, '') NOT LIKE 'https://%' THEN 'not_https' END, CASE WHEN coalesce(applies_mode, '') NOT IN ('all_major_50', 'list') THEN 'unknown_applies' END,
CASE WHEN applies_mode = 'all_major_50' AND top50_relevance_mode <> 'symbol_alias_match' THEN 'all_not_by_alias' END,
CASE WHEN applies_mode = 'list' AND (coalesce(len(applies_assets), 0) < 1 OR top50_relevance_mode <> 'direct_asset') THEN 'list_not_direct' END]) AS rule FROM s)
SELECT rule, subject FROM r WHERE rule IS NOT NULL
UNION ALL SELECT 'source_id_twice', source_id FROM {src} WHERE source_id IS NOT NULL GROUP BY 2 HAVING count(*) > 1
UNION ALL SELECT 'asset_twice', asset FROM {ast} WHERE asset IS NOT NULL GROUP BY 2 HAVING count(*) > 1
UNION ALL SELECT 'symbol_twice', reference_symbol_native FROM {ast} WHERE reference_symbol_native IS NOT NULL GROUP BY 2 HAVING count(*) > 1
UNION ALL SELECT DISTINCT 'asset_not_in_universe', coalesce(a, '') FROM (SELECT unnest(applies_assets) AS a FROM {src} WHERE enabled AND applies_mode = 'list') WHERE a IS NULL OR a NOT IN (SELECT asset FROM {ast} WHERE asset IS NOT NULL)
UNION ALL SELECT 'blank_asset', '' FROM {ast} WHERE coalesce(trim(asset), '') = ''
UNION ALL SELECT 'blank_symbol', coalesce(asset, '') FROM {ast} WHERE coalesce(trim(reference_symbol_native), '') = ''
UNION ALL SELECT 'no_assets', '' WHERE NOT EXISTS (FROM {ast}) UNION ALL SELECT 'no_sources', '' WHERE NOT EXISTS (FROM {src})"""


SQL = {
    "symbol_match": """WITH u AS (SELECT asset, upper(asset) AS a, upper(reference_symbol_native) AS r FROM universe_asset),
al AS (SELECT asset, unnest([CASE WHEN a NOT IN ('BIO','CHIP','DASH','DOGS','HIVE','MEGA','NEAR','NOT','TON','TRUMP') THEN a END, r, replace(r, 'USDT', '-USDT'), '$' || a, '(' || a || ')', '[' || a || ']']) AS alias FROM u),
e AS (SELECT event_ord, upper(concat_ws(chr(10), title, body, url)) AS h FROM raw_intel_event),
m AS (SELECT DISTINCT event_ord, asset FROM e JOIN al ON strlen(alias) >= 3 AND contains(h, alias) AND regexp_matches(h, '(^|[^0-9A-Z])' || regexp_escape(alias) || '([^0-9A-Z]|$)'))
SELECT e.event_ord, coalesce(string_agg(asset, ',' ORDER BY asset), '') AS assets FROM e LEFT JOIN m USING (event_ord) GROUP BY 1""",
    "event_classification": """WITH x AS (SELECT e.event_ord, e.source_id, coalesce(body, '') AS body, direct_asset_count AS dc, matched_asset_count AS mc, s.adapter, s.fetch_method, s.top50_relevance_mode AS md, s.trust_tier AS tier, s.source_category AS cat FROM raw_intel_event e JOIN intel_source s USING (source_id)),
y AS (SELECT *, CASE WHEN cat = 'funding' THEN 'numeric_observation' WHEN trim(body) = '' THEN 'title_only' WHEN trim(body) LIKE '{%' AND trim(body) LIKE '%}' THEN 'metadata_fallback' WHEN length(trim(body)) < 120 THEN 'short_text' ELSE 'full_text' END AS quality FROM x)
SELECT event_ord, coalesce(CASE WHEN adapter = 'notice_cms_list' AND contains(source_id, 'listing') AND NOT contains(source_id, 'delisting') THEN 'exchange_listing' WHEN adapter = 'notice_cms_list' AND contains(source_id, 'delisting') THEN 'exchange_delisting'
  WHEN adapter = 'notice_cms_list' AND contains(source_id, 'maintenance') THEN 'exchange_maintenance' WHEN adapter = 'perp_funding_latest' THEN 'funding_rate_snapshot' END,
  CASE cat WHEN 'governance' THEN 'governance_update' WHEN 'developer_activity' THEN 'developer_release' WHEN 'social' THEN 'community_reaction' WHEN 'news' THEN 'news_article' WHEN 'funding' THEN 'derivatives_snapshot' WHEN 'project_notice' THEN 'project_notice' WHEN 'exchange_notice' THEN 'exchange_notice' ELSE 'raw_intel_observation' END) AS hint,
CASE cat WHEN 'governance' THEN 'governance_update' WHEN 'social' THEN 'community_reaction' WHEN 'news' THEN 'news_article' WHEN 'funding' THEN 'derivatives_snapshot' WHEN 'developer_activity' THEN cat WHEN 'project_notice' THEN cat WHEN 'exchange_notice' THEN cat ELSE 'raw_intel_observation' END AS kind,
CASE WHEN adapter = 'perp_funding_latest' THEN 'live_only' WHEN adapter = 'notice_cms_list' OR fetch_method = 'rss' THEN 'feed_retained' ELSE 'unknown' END AS depth,
CASE WHEN cat = 'funding' THEN 'market_snapshot' WHEN cat = 'social' THEN 'community_reaction' WHEN tier = 'T0' AND dc > 0 THEN 'trusted_direct' WHEN tier = 'T0' THEN 'trusted_official' WHEN tier = 'T1' AND mc > 0 THEN 'trusted_symbol_match' ELSE 'general_context' END AS source_quality,
CASE WHEN dc > 0 THEN 'direct_asset' WHEN mc > 0 THEN 'symbol_alias_match' WHEN md = 'symbol_alias_match' THEN 'global_symbol_scan' ELSE 'unknown' END AS scope, quality,
least(100, CASE quality WHEN 'full_text' THEN 70 WHEN 'numeric_observation' THEN 55 WHEN 'short_text' THEN 50 WHEN 'metadata_fallback' THEN 40 ELSE 25 END + CASE tier WHEN 'T0' THEN 15 WHEN 'T1' THEN 8 ELSE 0 END + CASE WHEN dc > 0 THEN 10 WHEN mc > 0 THEN 5 ELSE 0 END)::INTEGER AS score FROM y""",
    "topk_per_source": """SELECT item_key, source_id, run_id, item_ord FROM (SELECT f.*, least(coalesce(max_items_per_run, 50), 50) AS k, row_number() OVER (PARTITION BY run_id, f.source_id ORDER BY item_ord, item_key) AS n
FROM feed_item f JOIN intel_source s USING (source_id)) WHERE n <= k""",
    "balance_admission": f"WITH {_ADMIT} SELECT event_ord, kind, admitted, CASE WHEN NOT admitted THEN CASE kind WHEN 'community_reaction' THEN 'community_reaction_run_cap' ELSE 'derivatives_snapshot_run_cap' END END AS suppression_reason FROM a",
    "asset_coverage": """WITH x AS (SELECT a.asset, s.source_id, source_category AS cat, enabled, coalesce(NOT enabled AND source_state = 'available_disabled', false) AS off, applies_mode = 'list' AS direct
  FROM universe_asset a JOIN intel_source s ON applies_mode = 'all_major_50' OR (applies_mode = 'list' AND list_contains(applies_assets, a.asset))),
g AS (SELECT asset, count(*) FILTER (enabled AND direct) AS enabled_direct, count(*) FILTER (enabled AND NOT direct) AS enabled_global, count(*) FILTER (off AND direct) AS disabled_direct, count(*) FILTER (off AND NOT direct) AS disabled_global,
  coalesce(string_agg(DISTINCT source_id, ',' ORDER BY source_id) FILTER (enabled AND direct), '') AS direct, count(*) FILTER (enabled AND cat = 'news') AS news, count(*) FILTER (enabled AND cat = 'social') AS social FROM x GROUP BY 1),
h AS (SELECT asset, string_agg(cat || '=' || n, ',' ORDER BY cat) AS categories FROM (SELECT asset, cat, count(*) AS n FROM x WHERE enabled GROUP BY ALL) GROUP BY 1)
SELECT a.asset, coalesce(enabled_direct, 0) AS enabled_direct, coalesce(enabled_global, 0) AS enabled_global, coalesce(disabled_direct, 0) AS disabled_direct, coalesce(disabled_global, 0) AS disabled_global,
coalesce(direct, '') AS direct, coalesce(categories, '') AS categories,
CASE WHEN enabled_direct > 0 THEN 'asset_specific_enabled' WHEN disabled_direct > 0 THEN 'asset_specific_available_disabled' WHEN enabled_global > 0 THEN 'global_symbol_match_only' ELSE 'missing_enabled_source' END AS coverage_status,
array_to_string(list_filter([CASE WHEN coalesce(enabled_direct, 0) = 0 THEN 'missing_enabled_asset_specific_source' END,
  CASE WHEN coalesce(disabled_direct, 0) + coalesce(disabled_global, 0) = 0 AND coalesce(social, 0) = 0 THEN 'missing_community_reaction_inventory' END, CASE WHEN coalesce(news, 0) = 0 THEN 'missing_global_news_source' END], lambda v: v IS NOT NULL), ',') AS gaps
FROM universe_asset a LEFT JOIN g USING (asset) LEFT JOIN h USING (asset)""",
    "category_histogram": "SELECT source_category, count(*) AS n FROM raw_intel_event GROUP BY 1",
    "registry_violations": _violations("intel_source", "universe_asset"),
    "registry_breaches": _violations("src", "ast", f"{_BROKEN}, "),
    "failure_backoff": f"""WITH x AS (SELECT event_id, user_id, {_AT} AS t, event_type = 'error' AS f FROM events),
y AS (SELECT *, sum((NOT f)::INT) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS g FROM x),
z AS (SELECT *, sum(f::INT) OVER (PARTITION BY user_id, g ORDER BY t, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS failure_count FROM y)
SELECT event_id, failure_count, CASE WHEN f THEN t + least(60000 * (2 ** least(failure_count - 1, 8))::BIGINT, 1800000) END AS backoff_until_ms FROM z""",
    "cadence_admission": f"""WITH RECURSIVE x AS (SELECT user_id, {_AT} AS at_ms, row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id) AS k FROM events WHERE ts IS NOT NULL),
nx AS (SELECT a.user_id, a.at_ms, min(b.at_ms) AS n FROM (SELECT DISTINCT user_id, at_ms FROM x) a LEFT JOIN (SELECT DISTINCT user_id, at_ms FROM x) b ON a.user_id = b.user_id AND b.at_ms >= a.at_ms + 21600000 GROUP BY ALL),
r AS (SELECT user_id, min(at_ms) AS at_ms FROM x GROUP BY 1 UNION ALL SELECT nx.user_id, nx.n FROM r JOIN nx ON nx.user_id = r.user_id AND nx.at_ms = r.at_ms WHERE nx.n IS NOT NULL)
SELECT x.user_id, x.at_ms, r.at_ms IS NOT NULL AND k = 1 AS admitted FROM x LEFT JOIN r ON x.user_id = r.user_id AND x.at_ms = r.at_ms""",
    "health_records": """WITH x AS (SELECT event_id, CASE WHEN event_type = 'error' THEN 'failed' WHEN event_type = 'view' THEN 'not_modified' WHEN value < 5 THEN 'no_items' ELSE 'ok' END AS status, event_id % 7 AS n FROM events)
SELECT event_id, status, CASE WHEN status IN ('ok', 'not_modified') THEN 'healthy' WHEN status = 'no_items' THEN 'degraded' ELSE 'blocked' END AS level,
CASE WHEN status = 'failed' THEN ['rate_limited', 'timeout', 'parse_failed', 'auth_not_supported', 'content_empty', 'source_unreachable', 'source_unreachable'][n + 1] END AS failure_type,
CASE WHEN status = 'failed' THEN n IN (0, 1, 5) END AS retryable FROM x""",
    "asset_rotation": """WITH x AS (SELECT asset, CASE WHEN rss_seed_status = 'verified' THEN 0 ELSE 1 END AS o FROM universe_asset),
y AS (SELECT *, row_number() OVER (PARTITION BY o ORDER BY asset) - 1 AS i, count(*) OVER (PARTITION BY o) AS n FROM x)
SELECT asset, row_number() OVER (ORDER BY (((i - 7) % n) + n) % n, o) AS priority FROM y""",
    "range_backfill": "SELECT o_custkey, o_orderkey FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1996-12-31' ORDER BY o_custkey, o_orderkey, o_orderdate LIMIT 500",
    "latest_rates": f"SELECT DISTINCT ON (user_id) user_id, {_AT} AS at_ms, event_id FROM events ORDER BY user_id, ts DESC, event_id DESC",
    "jsonl_locators": f"WITH {_located(3)} SELECT event_ord, part, line_number, byte_offset, byte_length, 'sha256:' || sha256(line) AS content_sha256 FROM q",
    "created_pointers": """WITH l AS (SELECT *, strftime(make_timestamp(fetched_at_ms * 1000), '%Y-%m-%d') AS dt, strftime(make_timestamp(fetched_at_ms * 1000), '%H') AS hour, '{"event_id":"' || event_id || '"}' AS line FROM raw_intel_event),
n AS (SELECT *, row_number() OVER (PARTITION BY dt, hour, source_category, source_id, run_id ORDER BY event_ord) - 1 AS rn FROM l),
p AS (SELECT *, rn // 1000 + 1 AS part FROM n)
SELECT event_id, fetched_at_ms + 1 AS created_at_ms, content_hash, array_to_string(symbol_candidates, ',') AS symbols,
'raw-intel-events/schema=raw_intel_event_v1/dt=' || dt || '/hour=' || hour || '/source_category=' || regexp_replace(source_category, '[^A-Za-z0-9._-]', '_', 'g') || '/source_id=' || regexp_replace(source_id, '[^A-Za-z0-9._-]', '_', 'g') || '/run_id=' || regexp_replace(run_id, '[^A-Za-z0-9._-]', '_', 'g') || '/part-' || lpad(part::VARCHAR, 6, '0') || '.jsonl' AS "key",
rn % 1000 + 1 AS line_number, coalesce(sum(strlen(line) + 1) OVER (PARTITION BY dt, hour, source_category, source_id, run_id, part ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS byte_offset, 'sha256:' || sha256(line) AS content_sha256 FROM p""",
    "coverage_diagnosis": """WITH x AS (SELECT a.asset, a.rss_seed_status = 'verified' AS focus, count(s.source_id) FILTER (s.enabled) AS ed, count(s.source_id) FILTER (NOT s.enabled AND s.source_state = 'available_disabled') AS dd
  FROM universe_asset a LEFT JOIN intel_source s ON s.applies_mode = 'list' AND list_contains(s.applies_assets, a.asset) GROUP BY ALL),
y AS (SELECT count(*) AS assets, count(*) FILTER (focus) AS focus_symbols, 0::BIGINT AS outside_universe, count(*) FILTER (focus AND ed > 0) AS focus_direct, count(*) FILTER (focus AND ed = 0 AND dd > 0) AS focus_available,
  count(*) FILTER (focus AND ed = 0 AND dd = 0) AS focus_without_inventory, count(*) FILTER (ed = 0) AS assets_without_direct FROM x)
SELECT *, CASE WHEN focus_symbols = 0 THEN 'PASS_CANDIDATE_GAP_DIAGNOSIS' WHEN focus_available > 0 THEN 'INSPECT_CANDIDATE_SOURCE_ACTIVATION_BLOCKERS'
  WHEN focus_without_inventory > 0 THEN 'ADD_CANDIDATE_DIRECT_SOURCE_INVENTORY' WHEN assets_without_direct > 0 THEN 'EXPAND_MAJOR50_DIRECT_SOURCE_COVERAGE' ELSE 'NO_SOURCE_COVERAGE_GAP_DETECTED' END AS verdict FROM y""",
    "partition_manifest": f"""WITH {_located(1000)}, o AS (SELECT dt || '/' || hour || '/' || source_category || '/' || source_id || '/' || part AS object_key, count(*) AS record_count, sum(byte_length + 1)::BIGINT AS byte_count FROM q GROUP BY 1)
SELECT *, (SELECT count(*) FROM o) AS uploaded_object_count FROM o""",
    "outbox_replay": """SELECT event_id, CASE event_id % 11 WHEN 0 THEN 'blank' WHEN 1 THEN 'invalid_json' WHEN 2 THEN 'missing_event_id' ELSE 'payload' END AS status, CASE WHEN event_id % 11 > 2 THEN 'e' || event_id END AS replayed_event_id FROM events""",
    "feed_parse": """SELECT 'r:' || source_id AS k, 0 AS item_ord, NULL::VARCHAR AS id, trim(coalesce(source_name, '')) || ' feed' AS title, source_category AS body, source_url AS url, 'desk' AS author, 'Mon, 06 Jan 2025 10:00:00 GMT' AS published_at FROM intel_source
UNION ALL SELECT 'a:' || source_id, 0, source_id, coalesce(source_name, ''), 's', source_url, 'n', '2025-01-06T10:00:00Z' FROM intel_source""",
    "rich_text_flatten": "SELECT source_id, source_id || ' one two ' || source_category AS flat FROM intel_source",
    "announcement_items": """WITH s AS (SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey % 5 <> 0)
SELECT s_suppkey, 0 AS item_ord, 'c1-' || s_suppkey AS id, s_name AS title, '{"catalogId":1,"catalogName":"n","code":"c1-' || s_suppkey || '","id":1,"releaseDate":1700000000000}' AS body, '1700000000000' AS published_at FROM s
UNION ALL SELECT s_suppkey, 1, 'c2-' || s_suppkey, 'second', '{"catalogId":1,"catalogName":"n","code":"c2-' || s_suppkey || '","id":2,"releaseDate":null}', NULL FROM s""",
    "item_limits": """SELECT source_id, CASE WHEN source_category = 'funding' AND fetch_method = 'rest_api' AND NOT coalesce(NOT enabled AND source_state = 'available_disabled' AND adapter = 'perp_funding_history', false) THEN least(coalesce(max_items_per_run, 50), 6)
WHEN source_category = 'social' THEN least(coalesce(max_items_per_run, 50), 5) ELSE least(coalesce(max_items_per_run, 50), 50) END AS item_limit FROM intel_source""",
    "selection_seeds": """SELECT source_id, ((list_reduce(list_concat([0::UHUGEINT], list_transform(string_split(source_id, ''), lambda c: ascii(c)::UHUGEINT)), lambda a, b: (a * 31 + b) % 18446744073709551616) + (1767225600000 // 1800000)::UHUGEINT) % 18446744073709551616::UHUGEINT)::VARCHAR AS seed FROM intel_source""",
    "index_dates": """WITH d AS (SELECT DISTINCT make_timestamp(fetched_at_ms * 1000)::DATE AS day FROM raw_intel_event) SELECT day::VARCHAR AS day, k::INTEGER AS place, (day - k::INTEGER)::VARCHAR AS dt FROM d, range(0, 15) r(k)""",
    "heal_records": """WITH e AS (SELECT user_id::VARCHAR AS source_id, epoch_us(ts) // 1000 AS t, CASE event_id % 7 WHEN 0 THEN 'rate_limited' WHEN 1 THEN 'timeout' WHEN 2 THEN 'parse_failed' WHEN 3 THEN 'auth_not_supported' WHEN 4 THEN 'content_empty' ELSE 'source_unreachable' END AS f FROM events WHERE event_type = 'error')
SELECT 'src_heal_' || left(sha256(source_id || ':' || t || ':' || f), 24) AS heal_event_id, source_id, t AS observed_at_ms, f AS failure_type, 1::BIGINT AS attempt_count, t + 900000 AS next_retry_at_ms FROM e""",
}

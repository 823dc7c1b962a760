"""Queries of what a run records: answers and pages of sources, health, states, balance, summaries, keys of stored objects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.operators.admission import admit, run_caps, static_priority
from tidewire.operators.coverage import activation_review, available_sources, coverage, diagnosis_records
from tidewire.operators.events import build_events
from tidewire.operators.runs import balance_records, fetch_states, health_records, run_summary
from tidewire.plans.domain import _ADMIT, _AT, _attempts, _classed
from tidewire.plans.texts import sql_clean, sql_decode, sql_squeeze
from tidewire.session import read
from tidewire.sources.fetched import answers, page_items
from tidewire.sources.layout import stored_keys, valid_key
from tidewire.sources.payloads import notice_items


def source_health(spark: SparkSession, d: str) -> DataFrame:
    """Visits made of the attempt log: errors failed, views are unchanged, clicks and signups were skipped, purchases fetched."""
    kind, n = F.col("event_type"), F.col("event_id")
    outcome = F.when(kind == "error", "failed").when(kind == "view", "not_modified").when(kind == "click", "skipped_backoff").when(kind == "signup", "skipped_cadence").otherwise("fetched")
    visits = _attempts(spark, d).select(
        "event_id", F.col("user_id").cast("string").alias("source_id"), F.lit("news").alias("source_category"), F.lit("rss").alias("fetch_method"), F.lit(None).cast("string").alias("adapter"), outcome.alias("outcome"),
        F.col("at_ms").alias("checked_at_ms"), (F.col("at_ms") + n % 1000).alias("observed_at_ms"), (n % 5).alias("items_seen"), (n % 3).alias("events_written"), (n % 2).alias("duplicates"),
        F.concat(F.lit("returned HTTP 50"), (n % 4).cast("string")).alias("error"), (F.col("at_ms") + 60_000).alias("until_ms"),
    )
    cols = ("health_event_id", "source_id", "checked_at_ms", "status", "health_level", "backoff_state", "latency_ms", "items_fetched", "items_emitted", "dedup_dropped", "error")
    return health_records(visits).select(*cols)


def fetch_state_log(spark: SparkSession, d: str) -> DataFrame:
    kind, n = F.col("event_type"), F.col("event_id")
    outcome = F.when(kind == "error", "failure").when(kind == "view", "not_modified").otherwise("success")
    rows = _attempts(spark, d).select(
        "event_id", F.col("user_id").cast("string").alias("source_id"), "at_ms", outcome.alias("outcome"), F.when(kind == "error", F.lit(None)).when(kind == "view", 304).otherwise(200).cast("int").alias("http_status"),
        F.when(n % 3 == 0, F.concat(F.lit("e"), n.cast("string"))).alias("etag"), F.when(n % 4 == 0, F.concat(F.lit("m"), n.cast("string"))).alias("last_modified"), (n % 2).alias("items_seen"), F.lit("gone").alias("error"),
    )
    cols = ("event_id", "failure_count", "backoff_until_ms", "state_etag", "state_last_modified", "last_http_status", "last_success_at_ms", "unchanged_count", "last_error")
    return fetch_states(rows, ["at_ms", "event_id"]).select(*cols)


def _decided(spark: SparkSession, d: str) -> DataFrame:
    """Events with a plain decision: rows of an event_id after the first are exact duplicates; the rest is admitted by run."""
    rows = _classed(spark, d).join(read(spark, d, "raw_intel_event").select("event_ord", "event_id"), "event_ord")
    first = rows.groupBy("event_id").agg(F.min("event_ord").alias("first"))
    rows = rows.join(first, "event_id").withColumn("dedup_decision", F.when(F.col("event_ord") == F.col("first"), "new").otherwise("exact_duplicate"))
    fresh = admit(rows.where("dedup_decision = 'new'"), "run_id", "kind", ["event_ord"], run_caps())
    rest = rows.where("dedup_decision <> 'new'").withColumns({"admitted": F.lit(None).cast("boolean"), "suppression_reason": F.lit(None).cast("string")})
    return fresh.unionByName(rest)


def balance_records_q(spark: SparkSession, d: str) -> DataFrame:
    out = balance_records(read(spark, d, "intel_source"), _decided(spark, d), 1_767_225_600_000)
    why = F.array_join(F.transform(F.array_sort(F.map_keys("suppression_reasons")), lambda k: F.concat(k, F.lit("="), F.element_at("suppression_reasons", k).cast("string"))), ",")
    return out.select("source_id", "balance_class", "items_seen", "candidates_after_dedup", "events_emitted", "duplicates_skipped", "suppressed_by_balance", why.alias("reasons"))


def run_summaries(spark: SparkSession, d: str) -> DataFrame:
    events = _decided(spark, d)
    visits = events.select("run_id", "source_id").distinct().withColumn("outcome", F.when(F.ascii(F.right("source_id", F.lit(1))) % 7 == 0, "failed").otherwise("fetched"))
    pointers = events.where("admitted").select("run_id", F.when(F.col("event_ord") % 9 == 0, "pending").otherwise("published").alias("status"))
    return run_summary(visits, events, pointers, ("run_id",))


def object_keys(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "raw_intel_event").select("event_ord", "run_id", "fetched_at_ms", "canonical_url_hash")
    keys = stored_keys(F.col("fetched_at_ms"), F.col("run_id"), F.left("canonical_url_hash", F.lit(2)))
    return rows.select("event_ord", F.explode(F.map_from_entries(F.array(*[F.struct(F.lit(f).alias("k"), k.alias("v")) for f, k in keys.items()]))).alias("family", "key"))


def key_checks(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("event_ord") % 8
    key = F.when(n == 0, F.concat(F.lit("/"), "url")).when(n == 1, F.concat("event_id", F.lit("/../x"))).when(n == 2, F.concat("event_id", F.lit("/./x"))).when(n == 3, F.lit("  ")).when(n == 4, F.repeat("event_id", F.lit(60))).when(n == 5, F.concat("event_id", F.lit("\n"))).otherwise(F.concat("event_id", F.lit("/a..b.jsonl")))
    return read(spark, d, "raw_intel_event").select("event_ord", valid_key(key).alias("valid"))


def source_answers(spark: SparkSession, d: str) -> DataFrame:
    n = F.ascii(F.right("source_id", F.lit(1))) % 6
    status = F.when(n == 0, 304).when(n == 1, 503).otherwise(200)
    body = F.when(n == 2, "<html>Just a moment ... Cloudflare</html>").when(n == 3, "  <rss/>").otherwise("<html>page</html>")
    rows = read(spark, d, "intel_source").select("source_id", "fetch_method", status.alias("status"), F.when(n == 4, "text/xml").otherwise("text/html").alias("content_type"), body.alias("body"))
    return answers(rows).select("source_id", "status", "outcome", "error")


def page_items_q(spark: SparkSession, d: str) -> DataFrame:
    """Pages with a description in either quote and four links; two items each, of which the first is the page's own where its
    source names assets."""
    src = read(spark, d, "intel_source").select("source_id", (F.col("applies_mode") == "list").alias("direct"))
    items = read(spark, d, "feed_item").where("title is not null and url is not null").dropDuplicates(["item_key"]).join(src, "source_id")
    told = F.concat(F.lit("What the desk has to say of "), "item_key", F.lit(" takes more than forty characters."))
    quote = F.when(F.col("direct"), "'").otherwise('"')
    page = F.concat(F.lit("<html><head><title> "), "item_key", F.lit(" </title><meta name="), quote, F.lit("description"), quote, F.lit(" content="), quote, told, quote, F.lit('></head><body><a class="x" href="'), "url", F.lit('"><b>'), "title", F.lit('</b></a><a href="/more/of/this">All the older items</a><a href="/last/of/this">All the other items</a></body></html>'))
    rows = items.select("item_key", F.lit("https://host.invalid/news/").alias("base"), F.lit("desk").alias("name"), page.alias("page"), "direct")
    out = page_items(rows, "item_key", "base", "name", "page", F.col("direct"), 2)
    return out.select("item_key", "item_ord", "id", "title", F.when(F.col("id").endswith("#page-summary"), F.col("body")).alias("body"), "url")


def notice_details(spark: SparkSession, d: str) -> DataFrame:
    s = read(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("source_id"), "s_name", "s_suppkey")
    article = F.concat(F.lit('{"id":1,"code":"c1-'), "source_id", F.lit('","title":"'), "s_name", F.lit('","releaseDate":1700000000000},{"id":2,"code":"c2-'), "source_id", F.lit('","title":"second","releaseDate":5}'))
    lists = s.select("source_id", F.concat(F.lit('{"code":"000000","data":{"catalogs":[{"catalogId":9,"catalogName":"n","articles":['), article, F.lit("]}]}}")).alias("payload"))
    n = F.col("s_suppkey") % 4
    text = F.when(n == 0, F.lit('{\\"node\\":\\"root\\",\\"child\\":[{\\"node\\":\\"text\\",\\"text\\":\\"the  first\\"},{\\"node\\":\\"text\\",\\"text\\":\\"and second\\"}]}')).when(n == 1, F.lit("no json")).otherwise(F.lit('{\\"node\\":\\"text\\",\\"text\\":\\" \\"}'))
    code = F.when(n == 3, "000009").otherwise("000000")
    details = s.select(F.concat(F.lit("c1-"), "source_id").alias("article_code"), F.concat(F.lit('{"code":"'), code, F.lit('","data":{"body":"'), text, F.lit('"}}')).alias("detail"))
    return notice_items(lists, details, "source_id", "payload").select("source_id", "item_ord", "id", "title", "body", "url", "author", "published_at")


def asset_priority(spark: SparkSession, d: str) -> DataFrame:
    verified = F.coalesce(F.col("rss_seed_status") == "verified", F.lit(False))
    return static_priority(read(spark, d, "universe_asset").select("asset", "rss_seed_status"), "asset", verified).select("asset", F.col("priority").cast("bigint").alias("priority"))


def coverage_details(spark: SparkSession, d: str) -> DataFrame:
    assets, sources = read(spark, d, "universe_asset"), read(spark, d, "intel_source")
    own = F.array_join(F.transform("available_direct", lambda x: F.concat_ws(":", x.source_id, x.fetch_method, F.coalesce(x.activation_blocker, F.lit("unknown")))), ",")
    gaps = diagnosis_records(coverage(assets, sources)).select("asset", F.array_join("quality_gaps", ",").alias("gaps"))
    return available_sources(assets, sources).select("asset", F.array_join("available_ids", ",").alias("available"), own.alias("direct")).join(gaps, "asset")


def activation_review_q(spark: SparkSession, d: str) -> DataFrame:
    """The focus is the whole universe."""
    assets = read(spark, d, "universe_asset")
    return activation_review(assets, read(spark, d, "intel_source"), assets.select("asset")).select("asset", "source_id", "source_url", "fetch_method", "activation_blocker")


def event_fields(spark: SparkSession, d: str) -> DataFrame:
    """Fields of built events that come from the source, the item or the run."""
    items = read(spark, d, "feed_item").dropDuplicates(["item_key"])
    out = build_events(items, read(spark, d, "intel_source"), read(spark, d, "universe_asset"), 1_767_225_600_000)
    cols = ("item_key", "source_category", "source_name", "fetched_at_ms", "language", "author_or_channel", "trust_tier", "cadence_tier", "dedup_decision", "duplicate_of_event_id", "direct_asset_count", "historical_source_depth", "backfill_window_start_ms", "backfill_window_end_ms", "source_time_range_verified", "schema_version")
    return out.select(*cols)


QUERIES = {
    "source_health": source_health, "fetch_state_log": fetch_state_log, "balance_records": balance_records_q, "run_summaries": run_summaries, "object_keys": object_keys, "key_checks": key_checks, "source_answers": source_answers,
    "page_items": page_items_q, "notice_details": notice_details, "asset_priority": asset_priority, "coverage_details": coverage_details, "activation_review": activation_review_q, "event_fields": event_fields,
}

_KINDS = _ADMIT[: _ADMIT.index("r AS (")].rstrip().rstrip(",")
_DECIDED = f"""{_KINDS}, y AS (SELECT event_ord, run_id, source_id, coalesce(kind, 'standard_source') AS kind, event_ord > min(event_ord) OVER (PARTITION BY event_id) AS dup FROM raw_intel_event LEFT JOIN c ON id = source_id),
z AS (SELECT *, row_number() OVER (PARTITION BY run_id, kind, dup ORDER BY event_ord) AS n FROM y),
x AS (SELECT *, NOT dup AND CASE kind WHEN 'community_reaction' THEN n > 30 WHEN 'derivatives_snapshot' THEN n > 12 ELSE false END AS held FROM z)"""
_HOUR = "strftime(make_timestamp(fetched_at_ms * 1000), '%Y-%m-%d') AS dt, strftime(make_timestamp(fetched_at_ms * 1000), '%H') AS hour"
_SEGMENT = "regexp_replace(run_id, '[^A-Za-z0-9._-]', '_', 'g')"

SQL = {
    "source_health": f"""WITH x AS (SELECT event_id AS n, user_id::VARCHAR AS source_id, {_AT} AS t, CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'not_modified' WHEN 'click' THEN 'skipped_backoff' WHEN 'signup' THEN 'skipped_cadence' ELSE CASE WHEN event_id % 5 = 0 THEN 'no_items' ELSE 'ok' END END AS status FROM events),
y AS (SELECT *, status IN ('ok', 'no_items') AS got FROM x)
SELECT 'src_health_' || left(sha256(source_id || ':' || t || ':' || status || ':' || CASE WHEN got THEN n % 2 ELSE 0 END), 24) AS health_event_id, source_id, t AS checked_at_ms, status,
CASE WHEN status IN ('ok', 'not_modified', 'skipped_cadence') THEN 'healthy' WHEN status = 'failed' THEN 'blocked' ELSE 'degraded' END AS health_level, CASE status WHEN 'failed' THEN 'scheduled' WHEN 'skipped_backoff' THEN 'active' ELSE 'none' END AS backoff_state,
CASE WHEN status LIKE 'skipped%' THEN 0 ELSE n % 1000 END::BIGINT AS latency_ms, CASE WHEN got THEN n % 5 ELSE 0 END::BIGINT AS items_fetched, CASE WHEN got THEN n % 3 ELSE 0 END::BIGINT AS items_emitted, CASE WHEN got THEN n % 2 ELSE 0 END::BIGINT AS dedup_dropped,
CASE status WHEN 'failed' THEN 'returned HTTP 50' || (n % 4) WHEN 'skipped_backoff' THEN 'backoff_until_ms=' || (t + 60000) WHEN 'skipped_cadence' THEN 'next_due_at_ms=' || (t + 60000) END AS error FROM y""",
    "fetch_state_log": f"""WITH x AS (SELECT event_id, user_id, {_AT} AS t, event_type = 'error' AS f, event_type = 'view' AS u, event_id % 2 AS items, CASE WHEN event_id % 3 = 0 THEN 'e' || event_id END AS e, CASE WHEN event_id % 4 = 0 THEN 'm' || event_id END AS m FROM events),
y AS (SELECT *, sum((NOT f)::INT) OVER w AS g, sum((NOT f AND NOT u AND items > 0)::INT) OVER w AS s, last_value(CASE WHEN NOT f THEN e END IGNORE NULLS) OVER w AS state_etag, last_value(CASE WHEN NOT f THEN m END IGNORE NULLS) OVER w AS state_last_modified,
  last_value(CASE WHEN NOT f THEN CASE WHEN u THEN 304 ELSE 200 END END IGNORE NULLS) OVER w AS last_http_status, last_value(CASE WHEN NOT f THEN t END IGNORE NULLS) OVER w AS last_success_at_ms FROM x WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING)),
z AS (SELECT *, sum(f::INT) OVER (PARTITION BY user_id, g ORDER BY t, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS failure_count, sum(u::INT) OVER (PARTITION BY user_id, s ORDER BY t, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS unchanged_count FROM y)
SELECT event_id, failure_count, CASE WHEN f THEN t + least(60000 * (2 ** least(failure_count - 1, 8))::BIGINT, 1800000) END AS backoff_until_ms, state_etag, state_last_modified, last_http_status::INTEGER AS last_http_status, last_success_at_ms, unchanged_count, CASE WHEN f THEN 'gone' END AS last_error FROM z""",
    "balance_records": f"""WITH {_DECIDED}, g AS (SELECT source_id, count(*) AS items_seen, count(*) FILTER (NOT dup) AS candidates_after_dedup, count(*) FILTER (NOT dup AND NOT held) AS events_emitted, count(*) FILTER (dup) AS duplicates_skipped, count(*) FILTER (held) AS suppressed_by_balance,
  any_value(CASE WHEN held THEN kind || '_run_cap' END) AS why FROM x GROUP BY 1)
SELECT id AS source_id, kind AS balance_class, coalesce(items_seen, 0) AS items_seen, coalesce(candidates_after_dedup, 0) AS candidates_after_dedup, coalesce(events_emitted, 0) AS events_emitted, coalesce(duplicates_skipped, 0) AS duplicates_skipped, coalesce(suppressed_by_balance, 0) AS suppressed_by_balance,
coalesce(why || '=' || suppressed_by_balance, '') AS reasons FROM c LEFT JOIN g ON g.source_id = c.id""",
    "run_summaries": f"""WITH {_DECIDED}, v AS (SELECT run_id, count(DISTINCT source_id) AS sources_selected, count(DISTINCT source_id) FILTER (ascii(right(source_id, 1)) % 7 <> 0) AS sources_ok, count(DISTINCT source_id) FILTER (ascii(right(source_id, 1)) % 7 = 0) AS sources_failed,
  count(*) AS items_seen, count(*) FILTER (NOT dup AND NOT held) AS events_written, count(*) FILTER (dup) AS events_skipped_duplicate, count(*) FILTER (held) AS events_suppressed_by_balance,
  count(*) FILTER (NOT dup AND NOT held AND event_ord % 9 <> 0) AS events_published, count(*) FILTER (NOT dup AND NOT held AND event_ord % 9 = 0) AS pointer_publish_pending FROM x GROUP BY 1) SELECT * FROM v""",
    "object_keys": f"""WITH x AS (SELECT event_ord, {_HOUR}, {_SEGMENT} AS run, left(canonical_url_hash, 2) AS p FROM raw_intel_event),
k AS (SELECT event_ord, unnest([{{'family': 'source_health', 'f': 'source-health/schema=source_health_v1'}}, {{'family': 'source_heal', 'f': 'source-heal/schema=source_heal_event_v1'}}, {{'family': 'source_coverage', 'f': 'source-coverage/schema=source_coverage_v1'}}, {{'family': 'source_balance', 'f': 'source-balance/schema=source_balance_v1'}},
  {{'family': 'dedup_index', 'f': 'dedup-index/schema=dedup_index_v1'}}, {{'family': 'publish_outbox_published', 'f': 'publish-outbox/status=published/schema=raw_intel_event_created_v2'}}, {{'family': 'publish_outbox_pending', 'f': 'publish-outbox/status=pending/schema=raw_intel_event_created_v2'}}]) AS u, dt, hour, run FROM x)
SELECT event_ord, u.family AS family, u.f || '/dt=' || dt || '/hour=' || hour || '/run_id=' || run || '/part-000001.jsonl' AS "key" FROM k
UNION ALL SELECT event_ord, 'dedup_index_v2', 'dedup-index-v2/schema=dedup_index_v2/dt=' || dt || '/hash_prefix=' || regexp_replace(p, '[^A-Za-z0-9._-]', '_', 'g') || '/hour=' || hour || '/run_id=' || run || '/part-000001.jsonl' FROM x
UNION ALL SELECT event_ord, 'manifest', 'manifests/schema=intel_l0_manifest_v1/dt=' || dt || '/hour=' || hour || '/run_id=' || run || '.json' FROM x""",
    "key_checks": "SELECT event_ord, event_ord % 8 >= 6 AS valid FROM raw_intel_event",
    "source_answers": """WITH x AS (SELECT source_id, fetch_method AS m, ascii(right(source_id, 1)) % 6 AS n FROM intel_source),
e AS (SELECT *, CASE WHEN n = 0 THEN NULL WHEN n = 1 THEN source_id || ' returned HTTP 503' WHEN m = 'rss' AND n NOT IN (3, 4) THEN source_id || ' did not return an XML feed' WHEN m = 'html_crawl' AND n = 2 THEN source_id || ' returned a bot challenge page' END AS error FROM x)
SELECT source_id, CASE n WHEN 0 THEN 304 WHEN 1 THEN 503 ELSE 200 END::INTEGER AS status, CASE WHEN n = 0 THEN 'not_modified' WHEN error IS NOT NULL THEN 'failed' ELSE 'fetched' END AS outcome, error FROM e""",
    "asset_priority": "SELECT asset, row_number() OVER (ORDER BY CASE WHEN rss_seed_status = 'verified' THEN 0 ELSE 1 END, asset) AS priority FROM universe_asset",
    "coverage_details": """WITH p AS (SELECT a.asset, s.*, s.applies_mode = 'list' AS direct FROM universe_asset a JOIN intel_source s ON s.applies_mode = 'all_major_50' OR (s.applies_mode = 'list' AND list_contains(s.applies_assets, a.asset))),
g AS (SELECT asset, string_agg(DISTINCT source_id, ',' ORDER BY source_id) FILTER (NOT enabled AND source_state = 'available_disabled') AS available, string_agg(source_id || ':' || fetch_method || ':' || coalesce(activation_blocker, 'unknown'), ',' ORDER BY source_id) FILTER (NOT enabled AND source_state = 'available_disabled' AND direct) AS direct,
  count(*) FILTER (enabled AND direct) AS ed, count(*) FILTER (NOT enabled AND source_state = 'available_disabled' AND direct) AS dd, count(*) FILTER (enabled AND NOT direct) AS eg FROM p GROUP BY 1)
SELECT a.asset, coalesce(available, '') AS available, coalesce(direct, '') AS direct, array_to_string(list_filter([CASE WHEN coalesce(ed, 0) = 0 THEN 'missing_enabled_asset_specific_source' END, CASE WHEN coalesce(dd, 0) = 0 THEN 'missing_available_disabled_asset_source_inventory' END, CASE WHEN coalesce(eg, 0) = 0 THEN 'missing_global_news_source' END], lambda v: v IS NOT NULL), ',') AS gaps
FROM universe_asset a LEFT JOIN g USING (asset)""",
    "activation_review": """WITH p AS (SELECT a.asset, s.* FROM universe_asset a JOIN intel_source s ON s.applies_mode = 'list' AND list_contains(s.applies_assets, a.asset))
SELECT asset, source_id, source_url, fetch_method, activation_blocker FROM p WHERE NOT enabled AND source_state = 'available_disabled' AND asset NOT IN (SELECT asset FROM p WHERE enabled)""",
    "notice_details": """WITH s AS (SELECT s_suppkey, s_suppkey::VARCHAR AS source_id, s_name FROM supplier)
SELECT source_id, 0 AS item_ord, 'c1-' || source_id AS id, s_name AS title, CASE WHEN s_suppkey % 4 = 0 THEN 'the first and second' ELSE '{"article_code":"c1-' || source_id || '","article_id":1,"catalog_id":9,"catalog_name":"n","source_id":"' || source_id || '"}' END AS body,
'https://www.binance.com/en/support/announcement/detail/c1-' || source_id AS url, 'Binance' AS author, '1700000000000' AS published_at FROM s
UNION ALL SELECT source_id, 1, 'c2-' || source_id, 'second', '{"article_code":"c2-' || source_id || '","article_id":2,"catalog_id":9,"catalog_name":"n","source_id":"' || source_id || '"}', 'https://www.binance.com/en/support/announcement/detail/c2-' || source_id, 'Binance', '5' FROM s""",
    "event_fields": """WITH items AS (SELECT DISTINCT ON (item_key) * FROM feed_item)
SELECT item_key, s.source_category, source_name, 1767225600000::BIGINT AS fetched_at_ms, language_hint AS language, author AS author_or_channel, trust_tier, cadence_tier, 'new' AS dedup_decision, NULL::VARCHAR AS duplicate_of_event_id, CASE WHEN applies_mode = 'list' THEN coalesce(len(applies_assets), 0) ELSE 0 END::BIGINT AS direct_asset_count,
coalesce(historical_source_depth, CASE WHEN adapter = 'perp_funding_history' THEN 'range_queryable' WHEN adapter = 'perp_open_interest_recent' THEN 'recent_1m' WHEN adapter IN ('perp_funding_latest', 'perp_open_interest') THEN 'live_only' WHEN adapter = 'notice_cms_list' OR fetch_method = 'rss' THEN 'feed_retained' ELSE 'unknown' END) AS historical_source_depth,
backfill_window_start_ms, backfill_window_end_ms, coalesce(source_time_range_verified, false) AS source_time_range_verified, 'raw_intel_event_v1' AS schema_version FROM items JOIN intel_source s USING (source_id)""",
    "page_items": f"""WITH items AS (SELECT DISTINCT ON (item_key) f.*, s.applies_mode = 'list' AS direct FROM feed_item f JOIN intel_source s USING (source_id) WHERE title IS NOT NULL AND url IS NOT NULL),
x AS (SELECT item_key, direct, {sql_squeeze(sql_decode(sql_clean('title')))} AS t, CASE WHEN regexp_matches(trim(url), '^https?://') THEN trim(url) ELSE 'https://host.invalid/news/' || trim(url) END AS u FROM items),
r AS (SELECT item_key, 0 AS k, 'https://host.invalid/news/#page-summary' AS id, item_key AS title, 'What the desk has to say of ' || item_key || ' takes more than forty characters.' AS body, 'https://host.invalid/news/' AS url FROM x WHERE direct
  UNION ALL SELECT item_key, 1, u, t, NULL, u FROM x WHERE length(t) >= 8
  UNION ALL SELECT item_key, 2, 'https://host.invalid/more/of/this', 'All the older items', NULL, 'https://host.invalid/more/of/this' FROM x UNION ALL SELECT item_key, 3, 'https://host.invalid/last/of/this', 'All the other items', NULL, 'https://host.invalid/last/of/this' FROM x),
n AS (SELECT *, (row_number() OVER (PARTITION BY item_key ORDER BY k) - 1)::INTEGER AS item_ord FROM r)
SELECT item_key, item_ord, id, title, body, url FROM n WHERE item_ord < 2""",
}

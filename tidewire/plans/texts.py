"""Queries of text, URLs, fingerprints, duplicates and index shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions.html import anchor_items, looks_blocked, page_summary, page_title
from tidewire.functions.instants import parse_notation, parse_published_at_ms
from tidewire.functions.text import canonical_symbol, clean_html_text, clean_text, first_u64_hash, hash_hex, normalize_text, path_segment, short_hash, shingles, simhash64, simhash_hex, source_offset, utc_date, utc_hour, visible_text
from tidewire.functions.urls import absolute_url, canonical_url, with_query
from tidewire.operators.decisions import decide, near_links
from tidewire.operators.events import build_events, fingerprint
from tidewire.sources.index import known, pruned, simhash_of
from tidewire.sources.layout import shards
from tidewire.session import read, spread


def normalize_text_q(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", normalize_text(F.col("text")).alias("normalized"))


def _title_body() -> F.Column:
    return F.concat(F.coalesce("title", F.lit("")), F.lit("\n"), F.coalesce("body", F.lit("")))


def content_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    fp = fingerprint(F.col("title"), F.col("body"), F.col("url"))
    return read(spark, d, "raw_intel_event").select("event_ord", *[fp[c].alias(c) for c in ("canonical_url", "canonical_url_hash", "normalized_content_hash")])


def event_identity(spark: SparkSession, d: str) -> DataFrame:
    content = hash_hex(F.concat("normalized_content_hash", F.lit("\n"), "canonical_url_hash"))
    return read(spark, d, "raw_intel_event").select("event_ord", content.alias("content_hash"), F.concat(F.lit("intel_evt_"), short_hash(F.col("dedup_key"))).alias("event_id"))


def simhash(spark: SparkSession, d: str) -> DataFrame:
    return spread(read(spark, d, "raw_intel_event").select("event_ord", "title", "body")).select("event_ord", simhash_hex(simhash64(normalize_text(_title_body()))).alias("simhash"))


def shingle_heads(spark: SparkSession, d: str) -> DataFrame:
    """Number of an event's shingles, and the xor of their hashes."""
    parts = shingles(normalize_text(_title_body()))
    heads = F.aggregate(F.transform(parts, first_u64_hash), F.lit(0).cast("bigint"), lambda a, h: a.bitwiseXOR(h))
    return spread(read(spark, d, "raw_intel_event").select("event_ord", "title", "body")).select("event_ord", F.size(parts).cast("bigint").alias("shingles"), simhash_hex(heads).alias("heads"))


def near_duplicate_links(spark: SparkSession, d: str) -> DataFrame:
    return near_links(read(spark, d, "raw_intel_event").select(F.col("event_ord").alias("ord"), simhash_of(F.col("simhash64")).alias("bits")))


def first_of_kind(spark: SparkSession, d: str) -> DataFrame:
    """The first event with the same key and with the same content, for every event; by two aggregations joined back. A null key or
    content is like no other."""
    rows = read(spark, d, "raw_intel_event").select("event_ord", "dedup_key", "normalized_content_hash")
    key = rows.groupBy("dedup_key").agg(F.min("event_ord").alias("first_same_key"))
    content = rows.groupBy("normalized_content_hash").agg(F.min("event_ord").alias("first_same_content"))
    return rows.join(key, "dedup_key", "left").join(content, "normalized_content_hash", "left").select("event_ord", "first_same_key", "first_same_content")


def dedup_decisions(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "raw_intel_event").select("event_ord", "event_id", "dedup_key", "exact_source_key", "normalized_content_hash", simhash_of(F.col("simhash64")).alias("bits"))
    return decide(rows, "event_ord", "bits").withColumnRenamed("ord", "event_ord")


def decisions_against_index(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "raw_intel_event").select("event_ord", "event_id", "dedup_key", "exact_source_key", "normalized_content_hash", simhash_of(F.col("simhash64")).alias("bits"))
    return decide(rows, "event_ord", "bits", known=known(read(spark, d, "dedup_index_v2"))).withColumnRenamed("ord", "event_ord")


def dedup_shards(spark: SparkSession, d: str) -> DataFrame:
    return shards(read(spark, d, "raw_intel_event")).select("event_ord", "hash_prefix")


def shard_pruned_lookup(spark: SparkSession, d: str) -> DataFrame:
    index = shards(read(spark, d, "dedup_index_v2").where("event_id is not null"))
    return pruned(index, read(spark, d, "created_pointer").select(F.col("content_hash").alias("exact_source_key"), F.col("content_hash").alias("canonical_url_hash"), F.col("content_hash").alias("normalized_content_hash"))).groupBy("hash_prefix").agg(F.count(F.lit(1)).alias("records"))


def known_index(spark: SparkSession, d: str) -> DataFrame:
    return known(read(spark, d, "dedup_index_v2")).select("dedup_key", "event_id", "content", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("bits"))


def canonical_url_q(spark: SparkSession, d: str) -> DataFrame:
    urls = read(spark, d, "raw_intel_event").select("url").unionByName(read(spark, d, "feed_item").select("url"))
    return urls.where("url is not null").distinct().select("url", canonical_url(F.col("url")).alias("canonical"))


def _page() -> F.Column:
    wrap = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    title, body = F.coalesce("title", F.lit("")), F.coalesce("body", F.lit(""))
    return wrap("<html><head><title> ", title, "</title><meta name=\"description\" content=\"\"></head><body><script>var a = '<p>';</script><p>", title, "</p><div>", body, " &amp;lt; &ldquo;end&rdquo;</div><svg><g></svg></body></html>")


def clean_html(spark: SparkSession, d: str) -> DataFrame:
    items = read(spark, d, "feed_item").dropDuplicates(["item_key"])
    return items.select("item_key", clean_text(_page()).alias("plain"), clean_html_text(_page()).alias("decoded"), visible_text(_page()).alias("visible"), looks_blocked(_page()).alias("blocked"))


def page_title_summary(spark: SparkSession, d: str) -> DataFrame:
    items = read(spark, d, "feed_item").dropDuplicates(["item_key"]).select("item_key", _page().alias("page"))
    items = items.withColumn("page_title", page_title(F.col("page"), F.lit("untitled")))
    return items.select("item_key", "page_title", page_summary(F.col("page"), F.col("page_title")).alias("summary"))


def anchor_titles(spark: SparkSession, d: str) -> DataFrame:
    items = read(spark, d, "feed_item").where("title is not null and url is not null").dropDuplicates(["item_key"])
    page = F.concat(F.lit('<ul><li><a href="/about">Home</a></li><li><a class="x" href="'), F.col("url"), F.lit('"><b>'), F.col("title"), F.lit('</b></a> : Notes on '), F.col("item_key"), F.lit(' that run to more than forty characters in all</li><li><a href="/pic.png">A picture of it</a></li><li><a href="javascript:go()">Run the script</a></li><li><a href="/more/of/this">All the older items</a></li></ul>'))
    return anchor_items(items.select("item_key", F.lit("https://host.invalid/news/").alias("base"), page.alias("page")), "item_key", "base", "page").select("item_key", "item_ord", "title", "url", "body")


def url_forms(spark: SparkSession, d: str) -> DataFrame:
    src = read(spark, d, "intel_source")
    return src.select(
        "source_id", absolute_url(F.col("source_url"), F.lit("/a/b")).alias("rooted"), absolute_url(F.col("source_url"), F.col("source_id")).alias("below"),
        with_query(F.col("source_url"), [("symbol", F.col("source_id")), ("limit", F.lit(1))]).alias("queried"), path_segment(F.col("source_name")).alias("segment"),
        source_offset(F.col("source_id")).cast("string").alias("offset"), canonical_symbol(F.col("source_id")).alias("symbol"),
    )


def event_partitions_q(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "raw_intel_event").select(utc_date(F.col("fetched_at_ms")).alias("dt"), utc_hour(F.col("fetched_at_ms")).alias("hour"), "source_id")
    return rows.groupBy("dt", "hour", "source_id").agg(F.count(F.lit(1)).alias("events"))


def written_zone_times(spark: SparkSession, d: str) -> DataFrame:
    """Integers and ISO times with seconds and a zone, others left out; published_at_parse has all items and notations."""
    rows = read(spark, d, "feed_item").select("item_key", "published_at").dropDuplicates(["item_key"])
    p = parse_notation(rows, "published_at", F.lit(False))
    ms = F.when(F.col("published_at").rlike(r"^[+-]?\d{1,18}$"), F.col("published_at").try_cast("bigint")).otherwise((F.col("__local_s") - F.col("__offset_s")) * 1000 + F.col("__ms"))
    iso = F.col("published_at").rlike(r"^[+-]?\d{1,18}$|^\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:[Zz]|[+-]\d{2}:\d{2})$")
    # exploding keeps the filter from being pushed into the parser, which would repeat all of it
    return p.select("item_key", F.explode(F.array_compact(F.array(F.when(iso, ms)))).alias("published_at_ms"))


def published_at_parse(spark: SparkSession, d: str) -> DataFrame:
    """The published time of every item; null where it is none of the three notations."""
    return read(spark, d, "feed_item").dropDuplicates(["item_key"]).select("item_key", parse_published_at_ms(F.col("published_at")).alias("published_at_ms"))


def build_events_q(spark: SparkSession, d: str) -> DataFrame:
    items = read(spark, d, "feed_item").dropDuplicates(["item_key"])
    out = build_events(items, read(spark, d, "intel_source"), read(spark, d, "universe_asset"))
    return out.select("item_key", "event_id", "exact_source_key", "content_hash", "content_quality", "content_kind", F.array_join("symbol_candidates", ",").alias("symbols"))


QUERIES = {
    "normalize_text": normalize_text_q, "content_fingerprint": content_fingerprint, "event_identity": event_identity, "simhash64": simhash, "shingle_heads": shingle_heads, "near_duplicate_links": near_duplicate_links,
    "first_of_kind": first_of_kind, "dedup_decisions": dedup_decisions, "decisions_against_index": decisions_against_index, "dedup_shards": dedup_shards, "shard_pruned_lookup": shard_pruned_lookup, "known_index": known_index,
    "canonical_url": canonical_url_q, "clean_html": clean_html, "page_title_summary": page_title_summary, "anchor_titles": anchor_titles, "url_forms": url_forms,
    "event_partitions": event_partitions_q, "written_zone_times": written_zone_times, "published_at_parse": published_at_parse, "build_events": build_events_q,
}

# White space and combining letters that RE2's classes leave out are written as ranges.
_UWS = r"\s\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_ALPHA = r"\p{L}\p{N}\x{0345}\x{0903}\x{093A}-\x{093B}\x{093E}-\x{094C}\x{094E}-\x{094F}\x{0900}-\x{0902}"


def sql_squeeze(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '[{_UWS}]+', ' ', 'g'), '^ | $', '', 'g')"


def sql_norm(x: str) -> str:
    return sql_squeeze(f"lower(regexp_replace({x}, '[^{_ALPHA}{_UWS}]', ' ', 'g'))")


def sql_canonical(u: str) -> str:
    """A scalar expression over a column u."""
    t = f"trim(string_split({u}, '#')[1])"
    base = f"regexp_replace(trim(string_split({t}, '?')[1]), '/+$', '')"
    lowered = f"CASE WHEN contains({base}, '://') THEN lower(regexp_extract({base}, '^.*?://[^/]*')) || regexp_replace({base}, '^.*?://[^/]*', '') ELSE {base} END"
    query = f"CASE WHEN contains({t}, '?') THEN substr({t}, instr({t}, '?') + 1) ELSE '' END"
    key = "lower(string_split(p, '=')[1])"
    parts = f"list_sort(list_filter(list_transform(string_split({query}, '&'), lambda q: trim(q)), lambda p: p <> '' AND {key} NOT IN ('fbclid','gclid','mc_cid','mc_eid','igshid','ref','ref_src') AND NOT starts_with({key}, 'utm_')))"
    return f"({lowered}) || CASE WHEN len({parts}) > 0 THEN '?' || array_to_string({parts}, '&') ELSE '' END"


def sql_clean(x: str) -> str:
    return f"regexp_replace({x}, '<[^>]*(>|\\z)|>', '', 'g')"


def sql_decode(x: str) -> str:
    for entity, char in (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&rsquo;", "’"), ("&ldquo;", "“"), ("&rdquo;", "”"), ("&#x27;", "''")):
        x = f"replace({x}, '{entity}', '{char}')"
    return x


_T, _B = "coalesce(title, '')", "coalesce(body, '')"
_PAGE = f"""('<html><head><title> ' || {_T} || '</title><meta name="description" content=""></head><body><script>var a = ''<p>'';</script><p>' || {_T} || '</p><div>' || {_B} || ' &amp;lt; &ldquo;end&rdquo;</div><svg><g></svg></body></html>')"""
_ITEMS = "items AS (SELECT DISTINCT ON (item_key) * FROM feed_item)"


def _visible(x: str) -> str:
    for tag in ("script", "style", "svg", "noscript"):
        x = f"regexp_replace({x}, '(?s)<{tag}.*?(</{tag}>|\\z)', ' ', 'g')"
    return sql_squeeze(sql_decode(sql_clean(x)))


_NOTE = r"\((?:[^()\\]|\\.)*\)"
for _ in range(3):
    _NOTE = rf"\((?:[^()\\]|\\.|{_NOTE})*\)"
_MAIL_TIME = rf"(?is)^[{_UWS}]*(?:(sun|mon|tue|wed|thu|fri|sat),)?[{_UWS}]*(\d{{1,2}})[{_UWS}]+(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[{_UWS}]+(\d{{2,4}})[{_UWS}]+(\d{{2}})[{_UWS}]*:[{_UWS}]*(\d{{2}})(?:[{_UWS}]*:[{_UWS}]*(\d{{2}}))?[{_UWS}]+(gmt|ut|[ecmp][sd]t|[a-ik-z]|[+-]\d{{4}})(?:[{_UWS}]*{_NOTE})*\z"
_ISO_TIME = r"^(\d{4})-(\d{2})-(\d{2})[Tt ](\d{2}):(\d{2}):(\d{2})(?:\.(\d+))?([Zz]|[+\-\x{2212}]\d{2}:\d{2})\z"

_FP = f"{sql_norm(_T + ' || chr(10) || ' + _B)}"

SQL = {
    "normalize_text": f"SELECT doc_id, {sql_norm('text')} AS normalized FROM documents",
    "content_fingerprint": f"SELECT event_ord, {sql_canonical('url')} AS canonical_url, sha256({sql_canonical('url')}) AS canonical_url_hash, sha256({_FP}) AS normalized_content_hash FROM raw_intel_event",
    "event_identity": "SELECT event_ord, sha256(normalized_content_hash || chr(10) || canonical_url_hash) AS content_hash, 'intel_evt_' || left(sha256(dedup_key), 24) AS event_id FROM raw_intel_event",
    "simhash64": f"""WITH n AS (SELECT event_ord, list_filter(string_split({_FP}, ' '), lambda w: w <> '') AS w FROM raw_intel_event),
s AS (SELECT event_ord, unnest(CASE WHEN len(w) < 4 THEN w ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' ')) END) AS sh FROM n),
h AS (SELECT event_ord, ('0x' || left(sha256(sh), 16))::UBIGINT AS x FROM s),
b AS (SELECT event_ord, k, sum(CASE WHEN (x >> k) & 1 = 1 THEN 1 ELSE -1 END) AS v FROM h, (SELECT unnest(range(0, 64))::UBIGINT AS k) GROUP BY ALL),
t AS (SELECT event_ord, bit_or(CASE WHEN v > 0 THEN 1::UBIGINT << k ELSE 0::UBIGINT END) AS bits FROM b GROUP BY event_ord)
SELECT n.event_ord, format('{{:016x}}', coalesce(bits, 0::UBIGINT)) AS simhash FROM n LEFT JOIN t USING (event_ord)""",
    "shingle_heads": f"""WITH n AS (SELECT event_ord, list_filter(string_split({_FP}, ' '), lambda w: w <> '') AS w FROM raw_intel_event),
s AS (SELECT event_ord, unnest(CASE WHEN len(w) < 4 THEN w ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' ')) END) AS sh FROM n),
h AS (SELECT event_ord, count(*) AS k, bit_xor(('0x' || left(sha256(sh), 16))::UBIGINT) AS x FROM s GROUP BY 1)
SELECT n.event_ord, coalesce(k, 0)::BIGINT AS shingles, format('{{:016x}}', coalesce(x, 0::UBIGINT)) AS heads FROM n LEFT JOIN h USING (event_ord)""",
    "near_duplicate_links": """WITH r AS (SELECT event_ord AS o, ('0x' || simhash64)::UBIGINT AS x FROM raw_intel_event WHERE regexp_full_match(simhash64, '[0-9a-f]{1,16}') AND simhash64 <> '0000000000000000'),
f AS (SELECT x, min(o) AS o FROM r GROUP BY x)
SELECT f.o AS a, r.o AS b FROM r JOIN f USING (x) WHERE r.o > f.o
UNION ALL SELECT p.o AS a, q.o AS b FROM f p, f q WHERE p.o < q.o AND bit_count(xor(p.x, q.x)) <= 4""",
    "first_of_kind": "SELECT event_ord, CASE WHEN dedup_key IS NOT NULL THEN min(event_ord) OVER (PARTITION BY dedup_key) END AS first_same_key, CASE WHEN normalized_content_hash IS NOT NULL THEN min(event_ord) OVER (PARTITION BY normalized_content_hash) END AS first_same_content FROM raw_intel_event",
    "dedup_shards": "SELECT DISTINCT event_ord, unnest([left(exact_source_key, 2), left(canonical_url_hash, 2), left(normalized_content_hash, 2)]) AS hash_prefix FROM raw_intel_event",
    "shard_pruned_lookup": """WITH i AS (SELECT rowid AS r, unnest(list_distinct(list_filter([left(exact_source_key, 2), left(canonical_url_hash, 2), left(normalized_content_hash, 2)], lambda x: x IS NOT NULL))) AS hash_prefix
  FROM (SELECT row_number() OVER () AS rowid, * FROM dedup_index_v2 WHERE event_id IS NOT NULL))
SELECT hash_prefix, count(*) AS records FROM i WHERE hash_prefix IN (SELECT left(content_hash, 2) FROM created_pointer WHERE content_hash IS NOT NULL) GROUP BY 1""",
    "known_index": """SELECT dedup_key, event_id, CASE WHEN event_id IS NOT NULL THEN coalesce(normalized_content_hash, content_hash) END AS content,
CASE WHEN event_id IS NOT NULL AND regexp_full_match(simhash64, '[0-9a-fA-F]{1,16}') THEN lpad(lower(simhash64), 16, '0') END AS bits FROM dedup_index_v2 WHERE dedup_key IS NOT NULL""",
    "canonical_url": f"SELECT url, {sql_canonical('url')} AS canonical FROM (SELECT url FROM raw_intel_event UNION SELECT url FROM feed_item) WHERE url IS NOT NULL",
    "clean_html": f"""WITH {_ITEMS} SELECT item_key, {sql_squeeze(sql_clean(_PAGE))} AS plain, {sql_squeeze(sql_decode(sql_clean(_PAGE)))} AS decoded, {_visible(_PAGE)} AS visible,
contains(lower({_PAGE}), 'just a moment') AND contains(lower({_PAGE}), 'cloudflare') AS blocked FROM items""",
    "anchor_titles": f"""WITH {_ITEMS}, x AS (SELECT item_key, {sql_squeeze(sql_decode(sql_clean('title')))} AS t, CASE WHEN regexp_matches(trim(url), '^https?://') THEN trim(url) ELSE 'https://host.invalid/news/' || trim(url) END AS u FROM items WHERE title IS NOT NULL AND url IS NOT NULL)
SELECT item_key, 0 AS item_ord, t AS title, u AS url, 'Notes on ' || item_key || ' that run to more than forty characters in all' AS body FROM x WHERE length(t) >= 8
UNION ALL SELECT item_key, CASE WHEN length(t) >= 8 THEN 1 ELSE 0 END, 'All the older items', 'https://host.invalid/more/of/this', '' FROM x""",
    "url_forms": """SELECT source_id, regexp_extract(source_url, '^[^:/]+://[^/]+') || '/a/b' AS rooted, regexp_replace(source_url, '/+$', '') || '/' || source_id AS below,
source_url || CASE WHEN contains(source_url, '?') THEN '&' ELSE '?' END || 'symbol=' || source_id || '&limit=1' AS queried, regexp_replace(source_name, '[^A-Za-z0-9._-]', '_', 'g') AS segment,
list_reduce(list_concat([0::UHUGEINT], list_transform(string_split(source_id, ''), lambda c: ascii(c)::UHUGEINT)), lambda a, b: (a * 31 + b) % 18446744073709551616)::VARCHAR AS "offset",
regexp_replace(upper(source_id), '[^A-Z0-9]', '', 'g') AS symbol FROM intel_source""",
    "page_title_summary": f"""WITH {_ITEMS}, p AS (SELECT item_key, {_PAGE} AS page FROM items),
v AS (SELECT item_key, coalesce(nullif({sql_squeeze(sql_decode(sql_clean("regexp_extract(page, '(?s)<title[^>]*>(.*?)</title>', 1)")))}, ''), 'untitled') AS page_title, regexp_extract(page, '(?s)<body[^>]*>(.*?)</body>', 1) AS inside FROM p),
w AS (SELECT item_key, page_title, {_visible('inside')} AS vis FROM v),
r AS (SELECT *, trim(CASE WHEN starts_with(vis, page_title) THEN substr(vis, length(page_title) + 1) ELSE vis END, '-|:· ' || chr(9) || chr(10)) AS rest FROM w),
c AS (SELECT *, CASE WHEN length(rest) >= 40 THEN rest WHEN vis <> page_title AND length(vis) >= 40 THEN vis ELSE '' END AS chosen FROM r),
k AS (SELECT *, list_min(list_filter(list_transform(['how to buy', 'where to buy', 'buy now', 'start trading'], lambda m: instr(lower(chosen), m)), lambda x: x - 1 >= 40)) AS pos FROM c),
t AS (SELECT *, trim(CASE WHEN pos IS NOT NULL THEN left(chosen, pos - 1) ELSE chosen END) AS text FROM k)
SELECT item_key, page_title, CASE WHEN text = '' THEN NULL WHEN length(text) <= 1200 THEN text ELSE left(text, 1200) || '...' END AS summary FROM t""",
    "build_events": f"""WITH {_ITEMS}, a AS (SELECT i.item_key, i.id, {sql_squeeze(sql_clean("coalesce(i.title, '')"))} AS t, {sql_squeeze(sql_clean("coalesce(i.body, '')"))} AS b, coalesce(i.url, '') AS url, s.* EXCLUDE (adapter) FROM items i JOIN intel_source s USING (source_id)),
f AS (SELECT *, {sql_canonical('url')} AS cu, sha256({sql_norm('t || chr(10) || b')}) AS nh FROM a),
g AS (SELECT *, CASE WHEN trim(id) <> '' THEN id ELSE cu END AS basis FROM f),
k AS (SELECT *, sha256(source_id || ':' || {sql_norm('basis')}) AS exact_source_key FROM g),
u AS (SELECT asset, upper(asset) AS x, upper(reference_symbol_native) AS r FROM universe_asset),
al AS (SELECT asset, unnest([CASE WHEN x NOT IN ('BIO','CHIP','DASH','DOGS','HIVE','MEGA','NEAR','NOT','TON','TRUMP') THEN x END, r, replace(r, 'USDT', '-USDT'), '$' || x, '(' || x || ')', '[' || x || ']']) AS alias FROM u),
h AS (SELECT item_key, upper(t || chr(10) || b || chr(10) || url) AS hay FROM a),
m AS (SELECT item_key, asset FROM h JOIN al ON strlen(alias) >= 3 AND contains(hay, alias) AND regexp_matches(hay, '(^|[^0-9A-Z])' || regexp_escape(alias) || '([^0-9A-Z]|$)')
  UNION SELECT item_key, unnest(applies_assets) FROM a WHERE applies_mode = 'list'),
y AS (SELECT item_key, string_agg(asset, ',' ORDER BY asset) AS symbols FROM m GROUP BY 1)
SELECT item_key, 'intel_evt_' || left(sha256(source_id || ':' || exact_source_key || ':' || nh), 24) AS event_id, exact_source_key, sha256(nh || chr(10) || sha256(cu)) AS content_hash,
CASE WHEN source_category = 'funding' THEN 'numeric_observation' WHEN trim(b) = '' THEN 'title_only' WHEN trim(b) LIKE '{{%' AND trim(b) LIKE '%}}' THEN 'metadata_fallback' WHEN length(trim(b)) < 120 THEN 'short_text' ELSE 'full_text' END AS content_quality,
CASE source_category WHEN 'governance' THEN 'governance_update' WHEN 'social' THEN 'community_reaction' WHEN 'news' THEN 'news_article' WHEN 'funding' THEN 'derivatives_snapshot' WHEN 'developer_activity' THEN source_category WHEN 'project_notice' THEN source_category WHEN 'exchange_notice' THEN source_category ELSE 'raw_intel_observation' END AS content_kind,
coalesce(symbols, '') AS symbols FROM k LEFT JOIN y USING (item_key)""",
    "event_partitions": """SELECT strftime(make_timestamp(fetched_at_ms * 1000), '%Y-%m-%d') AS dt, strftime(make_timestamp(fetched_at_ms * 1000), '%H') AS hour, source_id, count(*) AS events FROM raw_intel_event GROUP BY ALL""",
    "written_zone_times": f"""WITH {_ITEMS}, x AS (SELECT item_key, published_at AS p FROM items WHERE published_at IS NOT NULL)
SELECT item_key, p::BIGINT AS published_at_ms FROM x WHERE regexp_full_match(p, '[+-]?\\d{{1,18}}')
UNION ALL SELECT item_key, epoch_ms(strptime(substr(upper(p), 1, 19), '%Y-%m-%dT%H:%M:%S')) + CASE WHEN substr(p, 20, 1) = '.' THEN left(rpad(regexp_extract(p, '\\.(\\d+)', 1), 3, '0'), 3)::BIGINT ELSE 0 END
  - CASE WHEN upper(right(p, 1)) = 'Z' THEN 0 ELSE (CASE WHEN substr(p, length(p) - 5, 1) = '-' THEN -1 ELSE 1 END) * (substr(p, length(p) - 4, 2)::BIGINT * 3600000 + right(p, 2)::BIGINT * 60000) END
FROM x WHERE regexp_full_match(p, '\\d{{4}}-\\d{{2}}-\\d{{2}}[Tt]\\d{{2}}:\\d{{2}}:\\d{{2}}(\\.\\d+)?([Zz]|[+-]\\d{{2}}:\\d{{2}})') AND try_strptime(substr(upper(p), 1, 19), '%Y-%m-%dT%H:%M:%S') IS NOT NULL""",
    "published_at_parse": f"""WITH {_ITEMS}, r AS (SELECT item_key, published_at AS p, regexp_extract(published_at, '{_MAIL_TIME}', ['wd', 'd', 'mo', 'y', 'h', 'mi', 's', 'z']) AS a, regexp_extract(published_at, '{_ISO_TIME}', ['y', 'mo', 'd', 'h', 'mi', 's', 'f', 'z']) AS b FROM items),
c AS (SELECT item_key, p, lower(a.wd) AS wd, CASE WHEN a.d <> '' THEN a.d ELSE b.d END AS d, CASE WHEN a.d <> '' THEN ((instr('janfebmaraprmayjunjulaugsepoctnovdec', lower(a.mo)) + 2) // 3)::VARCHAR ELSE b.mo END AS mo,
  CASE WHEN length(a.y) = 2 AND a.y < '50' THEN (try_cast(a.y AS BIGINT) + 2000)::VARCHAR WHEN length(a.y) IN (2, 3) THEN (try_cast(a.y AS BIGINT) + 1900)::VARCHAR WHEN a.d <> '' THEN a.y ELSE b.y END AS y,
  CASE WHEN a.d <> '' THEN a.h ELSE b.h END AS h, CASE WHEN a.d <> '' THEN a.mi ELSE b.mi END AS mi, coalesce(try_cast(CASE WHEN a.d <> '' THEN a.s ELSE b.s END AS BIGINT), 0) AS s, CASE WHEN b.f <> '' THEN try_cast(left(rpad(b.f, 3, '0'), 3) AS BIGINT) END AS f, lower(CASE WHEN a.d <> '' THEN a.z ELSE b.z END) AS z FROM r),
t AS (SELECT *, CASE WHEN s <= 60 THEN try_strptime(y || '-' || lpad(mo, 2, '0') || '-' || lpad(d, 2, '0') || ' ' || h || ':' || mi || ':' || lpad(least(s, 59)::VARCHAR, 2, '0'), '%Y-%m-%d %H:%M:%S') END AS w,
  CASE WHEN length(z) < 5 THEN CASE z WHEN 'edt' THEN -240 WHEN 'est' THEN -300 WHEN 'cdt' THEN -300 WHEN 'cst' THEN -360 WHEN 'mdt' THEN -360 WHEN 'mst' THEN -420 WHEN 'pdt' THEN -420 WHEN 'pst' THEN -480 ELSE 0 END
    WHEN substr(z, 2, 2) < '24' AND right(z, 2) < '60' THEN (CASE WHEN left(z, 1) = '+' THEN 1 ELSE -1 END) * (try_cast(substr(z, 2, 2) AS BIGINT) * 60 + try_cast(right(z, 2) AS BIGINT)) END AS o FROM c)
SELECT item_key, CASE WHEN regexp_full_match(p, '[+-]?[0-9]+') THEN try_cast(p AS BIGINT) WHEN wd = '' OR wd = lower(left(dayname(w), 3)) THEN epoch_ms(w) + (s - least(s, 59) - o * 60) * 1000 + coalesce(f, 0) END AS published_at_ms FROM t""",
}

"""Records of runs, answers of sources and stored objects, by hand-made cases."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidewire.operators.admission import item_limit, run_caps, static_priority
from tidewire.operators.coverage import activation_review, available_sources, coverage, diagnosis
from tidewire.operators.events import EVENT_FIELDS, build_events
from tidewire.operators.runs import balance_records, conditional_headers, current_states, fetch_states, health_records, latest_states, retry_delays_ms, run_id, run_summary
from tidewire.session import read, scratch
from tidewire.sources.fetched import answers, fetched_feeds, page_items
from tidewire.sources.layout import index_v1, manifest, state_key, stored_keys, valid_key, write_diagnostics, write_single
from tidewire.sources.registry import required_source

SMALL = "/root/testdata/sf0.001"
VISIT = "source_id string, source_category string, fetch_method string, adapter string, outcome string, checked_at_ms bigint, observed_at_ms bigint, items_seen int, events_written int, duplicates int, error string, until_ms bigint"


def test_small_rules():
    assert run_id(datetime(2031, 2, 3, 4, 5, 6, 789, tzinfo=timezone.utc)) == "intel-crawl-20310203T040506000789000Z"
    assert conditional_headers(None, None, None) and not conditional_headers("s", None, None) and not conditional_headers(None, 1, 2)
    assert retry_delays_ms() == [750, 1500]
    assert run_caps(99, 7) == {"derivatives_snapshot": 12, "community_reaction": 7} and run_caps(2, 1)["derivatives_snapshot"] == 2


def test_health(spark):
    rows = [("s", "news", "rss", None, o, 100, 130, n, 1, 1, "gone", 500) for o, n in (("fetched", 3), ("fetched", 0), ("failed", 3), ("not_modified", None), ("skipped_backoff", 0), ("skipped_cadence", 0))]
    got = [(r.status, r.health_level, r.backoff_state, r.latency_ms, r.items_fetched, r.error) for r in health_records(spark.createDataFrame(rows, VISIT)).collect()]
    assert got == [
        ("ok", "healthy", "none", 30, 3, None), ("no_items", "degraded", "none", 30, 0, None), ("failed", "blocked", "scheduled", 30, 0, "gone"), ("not_modified", "healthy", "none", 30, 0, None),
        ("skipped_backoff", "degraded", "active", 0, 0, "backoff_until_ms=500"), ("skipped_cadence", "healthy", "none", 0, 0, "next_due_at_ms=500"),
    ]
    assert health_records(spark.createDataFrame([], VISIT)).count() == 0


def test_states(spark):
    schema = "source_id string, at_ms bigint, outcome string, http_status int, etag string, last_modified string, items_seen int, error string"
    rows = [("s", 1000, "failure", 503, "x", None, None, "e1"), ("s", 2000, "failure", None, None, None, 0, "e2"), ("s", 3000, "success", 200, "v1", "m1", 4, None), ("s", 4000, "not_modified", 304, None, None, 0, None), ("s", 5000, "success", 200, "v2", None, 0, None), ("s", 6000, "failure", 500, None, None, 0, "e3"), ("s", 7000, "success", 200, None, "m2", 1, None)]
    after = fetch_states(spark.createDataFrame(rows, schema), ["at_ms"])
    got = [(r.failure_count, r.backoff_until_ms, r.state_etag, r.state_last_modified, r.last_http_status, r.last_success_at_ms, r.unchanged_count, r.last_error) for r in after.orderBy("at_ms").collect()]
    assert got == [
        (1, 61000, None, None, None, None, 0, "e1"), (2, 122000, None, None, None, None, 0, "e2"), (0, None, "v1", "m1", 200, 3000, 0, None), (0, None, "v1", "m1", 304, 4000, 1, None),
        (0, None, "v2", "m1", 200, 5000, 1, None), (1, 66000, "v2", "m1", 200, 5000, 1, "e3"), (0, None, "v2", "m2", 200, 7000, 0, None),
    ]
    kept = latest_states(after, ["at_ms"])
    assert kept.count() == 1 and kept.first().etag == "v2" and kept.first().state_id.startswith("source_fetch_state_")
    sources = spark.createDataFrame([("s",), ("t",)], "source_id string")
    now = {r.source_id: (r.etag, r.failure_count) for r in current_states(kept, sources).collect()}
    assert now == {"s": ("v2", 0), "t": (None, 0)}
    assert {r.etag for r in current_states(kept.withColumn("schema_version", F.lit("old")), sources).collect()} == {None}


def test_balance_and_summary(spark):
    src = spark.createDataFrame([("f", "funding", "rest_api", "perp_funding_latest", True, None), ("h", "funding", "rest_api", "perp_funding_history", False, "available_disabled"), ("c", "social", "rss", None, True, None), ("n", "news", "rss", None, True, None)], "source_id string, source_category string, fetch_method string, adapter string, enabled boolean, source_state string")
    ev = spark.createDataFrame([("f", "new", True, None), ("f", "new", False, "derivatives_snapshot_run_cap"), ("f", "exact_duplicate", None, None), ("c", "update_of_existing", True, None)], "source_id string, dedup_decision string, admitted boolean, suppression_reason string")
    got = {r.source_id: r for r in balance_records(src, ev, 5).collect()}
    assert {k: r.balance_class for k, r in got.items()} == {"f": "derivatives_snapshot", "h": "standard_source", "c": "community_reaction", "n": "standard_source"}
    f = got["f"]
    assert (f.items_seen, f.candidates_after_dedup, f.events_emitted, f.duplicates_skipped, f.suppressed_by_balance, f.suppression_reasons) == (3, 2, 1, 1, 1, {"derivatives_snapshot_run_cap": 1})
    assert got["n"].items_seen == 0 and got["n"].suppression_reasons == {} and f.derivatives_max_events_per_run == 12
    visits = spark.createDataFrame([("f", "fetched"), ("c", "not_modified"), ("n", "failed"), ("h", "skipped_cadence")], "source_id string, outcome string")
    s = run_summary(visits, ev).first()
    assert (s.sources_selected, s.sources_ok, s.sources_failed, s.items_seen, s.events_written, s.events_skipped_duplicate, s.events_suppressed_by_balance) == (4, 2, 1, 4, 2, 1, 1)
    limits = src.select("source_id", item_limit(F.lit(40), F.col("source_category"), F.col("fetch_method"), F.col("source_id") == "h").alias("k"))
    assert {r.source_id: r.k for r in limits.collect()} == {"f": 6, "h": 40, "c": 5, "n": 40}
    order = static_priority(spark.createDataFrame([("a", None), ("b", True), ("c", True)], "asset string, v boolean"), "asset", F.coalesce("v", F.lit(False)))
    assert [r.asset for r in order.orderBy("priority").collect()] == ["b", "c", "a"]


def test_answers_and_pages(spark):
    rows = [("a", "rss", 304, None, None), ("b", "rss", 404, "text/xml", "x"), ("c", "rss", 200, None, " <rss><item><title>t</title></item></rss>"), ("d", "rss", 200, "text/html", "<p>"), ("e", "html_crawl", 200, None, "JUST A MOMENT cloudflare"), ("f", "html_crawl", 200, None, None), ("g", "ftp", 200, None, "x"), ("h", "rss", None, None, None)]
    df = spark.createDataFrame(rows, "source_id string, fetch_method string, status int, content_type string, body string")
    got = {r.source_id: (r.outcome, r.error) for r in answers(df).collect()}
    assert got == {
        "a": ("not_modified", None), "b": ("failed", "b returned HTTP 404"), "c": ("fetched", None), "d": ("failed", "d did not return an XML feed"), "e": ("failed", "e returned a bot challenge page"),
        "f": ("fetched", None), "g": ("failed", "g unsupported fetch_method ftp"), "h": ("failed", "h returned HTTP "),
    }
    assert [r.source_id for r in fetched_feeds(df)[1].collect()] == ["c"]
    told = "a description of this page that is longer than forty characters"
    page = f"<title>T</title><meta name='description' content='{told}'><a href='/one'>The first of all</a><a href='/two'>The second of all</a>"
    pages = spark.createDataFrame([("k", "https://h.x/n", "N", page, True), ("l", "https://h.x/n", "N", page, False), ("m", "https://h.x/n", "N", None, True), ("o", "https://h.x/n", "N", "<b>", True)], "k string, u string, n string, h string, d boolean")
    got = [(r.k, r.item_ord, r.id, r.title) for r in page_items(pages, "k", "u", "n", "h", F.col("d"), 2).orderBy("k", "item_ord").collect()]
    assert got == [("k", 0, "https://h.x/n#page-summary", "T"), ("k", 1, "https://h.x/one", "The first of all"), ("l", 0, "https://h.x/one", "The first of all"), ("l", 1, "https://h.x/two", "The second of all")]


def test_stored_objects(spark):
    keys = spark.range(1).select(*[k.alias(f) for f, k in stored_keys(F.lit(3_600_000 * 7), F.lit("r 1"), F.lit("ab")).items()]).first().asDict()
    assert keys["source_heal"] == "source-heal/schema=source_heal_event_v1/dt=1970-01-01/hour=07/run_id=r_1/part-000001.jsonl" and keys["manifest"].endswith("hour=07/run_id=r_1.json") and len(keys) == 9
    assert spark.range(1).select(state_key(F.lit("a b"))).first()[0] == "source-fetch-state/schema=source_fetch_state_v1/source_id=a_b/state.json"
    checks = ["a/b.c", "", " ", "/a", "a//b", "a/../b", "..", "a\n", "x" * 1025, None, "a..b"]
    assert [r[0] for r in spark.createDataFrame([(i, c) for i, c in enumerate(checks)], "i int, c string").orderBy("i").select(valid_key(F.col("c"))).collect()] == [True] + [False] * 9 + [True]
    at = scratch(spark, "objects")
    one = spark.createDataFrame([(1, None), (2, "é")], "a int, b string")
    assert write_single(one, at, "source_health", "k/part.jsonl") == ("source_health", "k/part.jsonl", 2, len('{"a":1,"b":null}\n') + len('{"a":2,"b":"é"}\n'.encode()))
    assert sorted(r.value for r in spark.read.text(f"{at}/k/part.jsonl").collect()) == ['{"a":1,"b":null}', '{"a":2,"b":"é"}'] and write_single(one.limit(0), at, "f", "none") is None
    done = write_diagnostics(at, "r", 0, {"source_balance": one, "source_heal": one.limit(0), "source_health": one})
    assert [d[0] for d in done] == ["source_health", "source_balance"]
    empty = spark.createDataFrame([], "object_family string, object_key string, record_count bigint, byte_count bigint")
    assert manifest(empty, "r").first().status == "success" and manifest(empty, "r", "broker away").first().status == "publish_failed"


def test_diagnosis_ladder(spark):
    assets = spark.createDataFrame([(a,) for a in "ABC"], "asset string")
    cols = "source_id string, source_name string, source_url string, source_category string, fetch_method string, trust_tier string, activation_blocker string, enabled boolean, source_state string, applies_mode string, applies_assets array<string>"
    row = lambda i, on, state, who: (i, "n", "u", "news", "rss", "T0", None, on, state, "list" if who else "all_major_50", who)
    src = spark.createDataFrame([row("s1", True, "enabled", ["A"]), row("s2", False, "available_disabled", ["B", "A"]), row("s3", False, "available_disabled", None), row("s4", True, "enabled", None)], cols)
    said = lambda *focus: diagnosis(coverage(assets, src), spark.createDataFrame([(f,) for f in focus], "asset string")).first().verdict
    assert said() == "PASS_CANDIDATE_GAP_DIAGNOSIS" and said("A", "Z") == "RECONCILE_CANDIDATE_GAP_UNIVERSE" and said("B") == "INSPECT_CANDIDATE_SOURCE_ACTIVATION_BLOCKERS"
    assert said("C") == "ADD_CANDIDATE_DIRECT_SOURCE_INVENTORY" and said("A") == "EXPAND_MAJOR50_DIRECT_SOURCE_COVERAGE"
    only = diagnosis(coverage(assets.where("asset = 'A'"), src), assets.where("asset = 'A'")).first().verdict
    assert only == "NO_SOURCE_COVERAGE_GAP_DETECTED"
    assert [(r.asset, r.source_id) for r in activation_review(assets, src, assets).collect()] == [("B", "s2")]
    got = {r.asset: (r.available_ids, [x.source_id for x in r.available_direct]) for r in available_sources(assets, src).collect()}
    assert got == {"A": (["s2", "s3"], ["s2"]), "B": (["s2", "s3"], ["s2"]), "C": (["s3"], [])}


def test_event_fields_and_single_sources(spark):
    sources = read(spark, SMALL, "intel_source")
    out = build_events(read(spark, SMALL, "feed_item"), sources, read(spark, SMALL, "universe_asset"), 7)
    assert set(EVENT_FIELDS) <= set(out.columns) and len(EVENT_FIELDS) == 38
    stored = {f.name: f.dataType for f in read(spark, SMALL, "raw_intel_event").schema}
    assert {c: out.schema[c].dataType for c in EVENT_FIELDS if out.schema[c].dataType != stored[c]} == {}
    assert index_v1(out).columns == ["schema_version", "dedup_key", "event_id", "source_id", "content_hash", "observed_at_ms"]
    known = sources.where("enabled").first().source_id
    assert required_source(sources, known).count() == 1
    with pytest.raises(ValueError):
        required_source(sources, "no such source")

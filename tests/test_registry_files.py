import json

from pyspark.sql import functions as F

from tidewire.operators.coverage import coverage, diagnosis, focus_symbols
from tidewire.sources.pointers import outbox, to_replay
from tidewire.sources.registry import due_sources, read_registry, selected_sources


def doc(tmp_path):
    base = dict(source_category="news", source_name="n", source_url="https://x.test", fetch_method="rss", max_items_per_run=3, trust_tier="T0", cadence_tier="high", language_hint="en", top50_relevance_mode="symbol_alias_match")
    sources = [
        base | dict(source_id="all", enabled=True, applies_to_assets="all_major_50"), base | dict(source_id="listed", enabled=True, applies_to_assets=["A", "B"]),
        base | dict(source_id="off", enabled=False, source_state="available_disabled", adapter="perp_funding_history", applies_to_assets="all_major_50"),
        base | dict(source_id="dead", enabled=False, source_state="blocked", applies_to_assets=["C"]),
    ]
    at = tmp_path / "registry.json"
    at.write_text(json.dumps({"universe_assets": [{"asset": a, "reference_symbol_native": a + "USDT"} for a in "ABC"], "sources": sources}, indent=1))
    return str(at)


def test_read_select_and_gate(spark, tmp_path):
    assets, sources = read_registry(spark, doc(tmp_path))
    assert assets.count() == 3
    assert {(r.source_id, r.applies_mode, tuple(r.applies_assets or ())) for r in sources.collect()} == {("all", "all_major_50", ()), ("listed", "list", ("A", "B")), ("off", "all_major_50", ()), ("dead", "list", ("C",))}
    names = lambda df: {r.source_id for r in df.collect()}
    assert names(selected_sources(sources)) == {"all", "listed"} and names(selected_sources(sources, "off")) == {"off"} and names(selected_sources(sources, "dead")) == set()
    states = spark.createDataFrame([("all", 5000, None), ("listed", None, 1000)], "source_id string, backoff_until_ms bigint, last_success_at_ms bigint")
    gates = lambda t, m=False: {r.source_id: r.gate for r in due_sources(selected_sources(sources), states, F.lit(t), m).collect()}
    assert gates(4000) == {"all": "skip_backoff", "listed": "skip_cadence"} and gates(4000, True) == {"all": "skip_backoff", "listed": "due"} and gates(901_000) == {"all": "due", "listed": "due"}


def test_diagnosis(spark, tmp_path):
    assets, sources = read_registry(spark, doc(tmp_path))
    covered = coverage(assets, sources)
    gap = lambda d: spark.createDataFrame([(json.dumps(d),)], "doc string")
    shapes = [{"symbols": [{"symbol": "a-usdt"}, {"symbol": "B"}]}, {"gaps": {"approved_symbols_without_candidate": ["A", "b"]}}, {"approved_symbols_without_candidate": ["A", "B", "A"]}]
    for s in shapes:
        assert {r.asset for r in focus_symbols(gap(s)).collect()} <= {"A", "AUSDT", "B"}
    verdict = lambda *names: diagnosis(covered, spark.createDataFrame([(n,) for n in names], "asset string")).first().verdict
    assert verdict("A", "B") == "EXPAND_MAJOR50_DIRECT_SOURCE_COVERAGE" and verdict("A", "Z") == "RECONCILE_CANDIDATE_GAP_UNIVERSE" and verdict("A", "C") == "ADD_CANDIDATE_DIRECT_SOURCE_INVENTORY" and verdict() == "PASS_CANDIDATE_GAP_DIAGNOSIS"
    assert focus_symbols(gap({})).count() == 0


def test_outbox(spark):
    p = spark.createDataFrame([("a",), ("b",), ("b",)], "event_id string")
    out = outbox(p, p.where("event_id = 'a'"))
    assert sorted((r.event_id, r.status) for r in out.collect()) == [("a", "published"), ("b", "pending"), ("b", "pending")]
    assert [r.event_id for r in to_replay(out.where("status = 'pending'"), out.where("status = 'published'")).collect()] == ["b"]

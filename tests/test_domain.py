import random
import sys

import pytest
from pyspark.sql import functions as F

from tidewire.operators import symbols
from tidewire.operators.admission import admit, first_items, rotated_priority
from tidewire.operators.coverage import coverage, registry_violations
from tidewire.operators.decisions import MAX_BITS, components, decide
from tidewire.operators.events import build_events
from tidewire.operators.health import cadence_admitted, failure_runs, failure_type
from tidewire.operators.symbols import haystack, symbol_matcher
from tidewire.session import read, scratch
from tidewire.sources.feeds import feed_items, parse_feed
from tidewire.sources.index import candidate_partitions, read_index, read_recent
from tidewire.sources.layout import locate, manifest, replay, shards, write_json_lines
from tidewire.sources.payloads import rich_text

SMALL = "/root/testdata/sf0.001"


def sequential(rows, before=()):
    keys, source, content, kept, out = set(), {}, {}, [], {}
    for key, event, exact, norm, bits, _ in sorted(before, key=lambda x: x[5]):
        keys.add(key)
        if event is not None:
            if exact is not None:
                source[exact] = (event, norm)
            if norm is not None:
                content[norm] = event
            if bits:
                kept.append((event, bits))
    for ord_, event, key, exact, norm, bits in sorted(rows):
        bits = bits or 0
        d, of = "new", None
        if key in keys:
            d = "exact_duplicate"
        elif exact in source:
            d, of = ("exact_duplicate", source[exact][0]) if source[exact][1] == norm else ("update_of_existing", source[exact][0])
        elif norm in content:
            d, of = "content_duplicate", content[norm]
        elif bits:
            of = next((e for e, b in kept if ((b ^ bits) & (2**64 - 1)).bit_count() <= MAX_BITS), None)
            d = "near_duplicate" if of else "new"
        out[ord_] = (d, of)
        if d in ("new", "update_of_existing"):
            keys.add(key)
            source[exact], content[norm] = (event, norm), event
            if bits:
                kept.append((event, bits))
    return out


def test_decisions_against_one_pass(spark):
    r = random.Random(6)
    bases = [r.getrandbits(62) for _ in range(15)]
    rows = []
    for i in range(500):
        exact, norm = f"x{r.randrange(220)}", f"n{r.randrange(300)}"
        if i % 9 == 0 and rows:
            exact, norm = rows[r.randrange(len(rows))][3:5]
        bits = r.choice([None, 0, r.getrandbits(62), r.choice(bases) ^ sum(1 << b for b in r.sample(range(62), r.randrange(0, 4)))])
        rows.append((i * 3, f"e{i}", f"{exact}:{norm}", exact, norm, bits))
    df = spark.createDataFrame(rows, "event_ord bigint, event_id string, dedup_key string, exact_source_key string, normalized_content_hash string, bits bigint")
    got = {x.ord: (x.dedup_decision, x.duplicate_of_event_id) for x in decide(df, "event_ord", "bits").collect()}
    assert got == sequential(rows)
    assert {d for d, _ in got.values()} == {"new", "exact_duplicate", "content_duplicate", "near_duplicate", "update_of_existing"}
    assert decide(df.limit(0), "event_ord", "bits").count() == 0
    before = []
    for i in range(300):
        exact, norm = rows[r.randrange(len(rows))][3:5] if i % 3 else (r.choice([None, f"x{i + 900}"]), r.choice([None, f"n{i + 900}"]))
        before.append((f"{exact}:{norm}:{i % 2}" if i % 4 else rows[i][2], r.choice([None, f"k{i}"]), exact, norm, r.choice([None, 0, r.choice(bases) ^ (1 << r.randrange(62)), r.getrandbits(62)]), 1000 + i))
    known = spark.createDataFrame(before, "dedup_key string, event_id string, exact_source_key string, content string, bits bigint, observed_at_ms bigint").repartition(3)
    got = {x.ord: (x.dedup_decision, x.duplicate_of_event_id) for x in decide(df, "event_ord", "bits", known=known).collect()}
    assert got == sequential(rows, before)


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 102), (103, 103)], "a bigint, b bigint")
    got = {x.node: x.label for x in components(links).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100, 103: 103}
    r = random.Random(3)
    pairs = [(r.randrange(300), r.randrange(300)) for _ in range(170)] + [(5, 5)]
    root = {n: n for p in pairs for n in p}
    for _ in root:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    assert {x.node: x.label for x in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()} == root
    assert components(links.limit(0)).count() == 0


@pytest.mark.parametrize("way", ["automaton", "no library", "blocks"])
def test_symbols(spark, monkeypatch, way):
    if way == "no library":
        monkeypatch.setitem(sys.modules, "ahocorasick", None)
        find = symbols._finder([("KELP", "KELP"), ("KELP", "KELP-USDT"), ("CHIP", "(CHIP)"), ("Q", "$Q")])
        assert [find(t) for t in ("A KELP-USDT", "KELPS $Q", "3KELP", "X(CHIP)", " (CHIP)!", "")] == [["KELP"], ["Q"], [], [], ["CHIP"], []]
        return
    if way == "blocks":
        monkeypatch.setattr(symbols, "BLOCK_ALIASES", 4)
    u = spark.createDataFrame([("KELP", "KELPUSDT"), ("HIVE", "HIVEUSDT"), ("CHIP", "CHIPUSDT"), ("Q", "QUSDT")], "asset string, reference_symbol_native string")
    match = symbol_matcher(u)
    texts = ["Divers gather kelp.", "quay, Q and A", "a hive of bees", "one chip (CHIP) more", "$hive", "CHIPUSDT,KELP-USDT", "kelps", "3kelp", "KELP비트", "[q] beside $Q", "", None]
    got = [r[0] for r in spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i").select(match(haystack(F.col("t")))).collect()]
    assert got == [["KELP"], [], [], ["CHIP"], ["HIVE"], ["CHIP", "KELP"], [], [], ["KELP"], ["Q"], [], []]


def test_built_events_agree_with_the_table(spark):
    """Items made from stored events give those stored fields again that do not depend on the lost items."""
    stored = read(spark, SMALL, "raw_intel_event").dropDuplicates(["event_id"])
    items = stored.select("event_id", F.lit(None).cast("string").alias("id"), "title", "body", "url", F.lit(None).cast("string").alias("historical_source_depth"), "source_id").withColumnRenamed("event_id", "was")
    built = build_events(items, read(spark, SMALL, "intel_source"), read(spark, SMALL, "universe_asset")).withColumnRenamed("source_category", "cat")
    same = ["event_category_hint", "content_kind", "direct_asset_count", "canonical_url_hash", "historical_source_depth"]
    both = built.select("was", *same).join(stored.select(F.col("event_id").alias("was"), *[F.col(c).alias(f"w_{c}") for c in same]), "was").toPandas()
    assert len(both) == stored.count()
    for c in same:
        bad = [(a, b) for a, b in zip(both[c], both[f"w_{c}"]) if (list(a) if hasattr(a, "__len__") and not isinstance(a, str) else a) != (list(b) if hasattr(b, "__len__") and not isinstance(b, str) else b)]
        assert not bad, (c, bad[:3])


def test_quotas(spark):
    rows = [(i, f"r{i % 2}", "hot" if i % 5 else "free") for i in range(400)]
    df = spark.createDataFrame(rows, "o int, run string, kind string")
    got = admit(df, "run", "kind", ["o"], {"hot": 7})
    assert {r[0] for r in got.where("not admitted").select("suppression_reason").distinct().collect()} == {"hot_run_cap"}
    got = {r.o for r in got.where("admitted").collect()}
    want = {o for o, _, k in rows if k == "free"}
    for run in ("r0", "r1"):
        want |= set(sorted(o for o, x, k in rows if x == run and k == "hot")[:7])
    assert got == want
    assert {r.o for r in first_items(df, "run", ["o"], F.lit(3)).collect()} == {0, 2, 4, 1, 3, 5}
    assets = spark.createDataFrame([(c, c in "ace") for c in "abcdef"], "asset string, v boolean")
    order = [r.asset for r in rotated_priority(assets, "asset", F.col("v"), 1).orderBy("priority").collect()]
    assert order == ["c", "d", "e", "f", "a", "b"]


def test_health(spark):
    rows = [("s", 1000, "f"), ("s", 2000, "f"), ("s", 3000, "ok"), ("s", 4000, "f"), ("t", 1, "ok")]
    df = spark.createDataFrame(rows, "s string, at bigint, x string")
    got = {(r.s, r["at"]): (r.failure_count, r.backoff_until_ms) for r in failure_runs(df, "s", "at", ["at"], F.col("x") == "f").collect()}
    assert got == {("s", 1000): (1, 61000), ("s", 2000): (2, 122000), ("s", 3000): (0, None), ("s", 4000): (1, 64000), ("t", 1): (0, None)}
    got = sorted((r["at"], r.admitted) for r in cadence_admitted(df.where("s = 's'"), "s", "at", 2000).collect())
    assert got == [(1000, True), (2000, False), (3000, True), (4000, False)]
    errors = [("HTTP 429", "rate_limited"), ("timed out", "timeout"), ("did not return an XML feed", "parse_failed"), ("auth needed", "auth_not_supported"), ("no usable items", "content_empty"), ("gone", "source_unreachable")]
    assert [r[0] for r in spark.createDataFrame([(i, e) for i, (e, _) in enumerate(errors)], "i int, e string").orderBy("i").select(failure_type(F.col("e"))).collect()] == [t for _, t in errors]


def test_registry(spark):
    assets = spark.createDataFrame([("A", "AUSDT"), ("B", "BUSDT"), ("B", "CUSDT"), ("D", "DUSDT")], "asset string, reference_symbol_native string")
    base = dict(source_id="s", source_category="news", source_name="n", source_url="https://x.test", fetch_method="rss", adapter=None, max_items_per_run=3, trust_tier="T0", cadence_tier="high", enabled=True, source_state="enabled", activation_blocker=None, top50_relevance_mode="symbol_alias_match", applies_mode="all_major_50", applies_assets=None)
    bad = [base, base | dict(source_id="d", enabled=False, source_state="available_disabled"), base | dict(source_id="e", source_url="http://x"), base | dict(source_id="f", applies_mode="list", applies_assets=["A", "Z"], top50_relevance_mode="direct_asset"), base | dict(source_id="s")]
    schema = "source_id string, source_category string, source_name string, source_url string, fetch_method string, adapter string, max_items_per_run bigint, trust_tier string, cadence_tier string, enabled boolean, source_state string, activation_blocker string, top50_relevance_mode string, applies_mode string, applies_assets array<string>"
    sources = spark.createDataFrame([tuple(b.values()) for b in bad], schema)
    got = sorted((r.rule, r.subject) for r in registry_violations(assets, sources).collect())
    assert got == [("asset_not_in_universe", "Z"), ("asset_twice", "B"), ("disabled_without_blocker", "d"), ("not_https", "e"), ("source_id_twice", "s")]
    off = base | dict(enabled=False, source_state=None)
    more = [off | dict(source_id="r", fetch_method="rest_api", adapter=" "), off | dict(source_id="q", fetch_method="ftp"), base | dict(source_id="l", applies_mode="list", applies_assets=["A", None], top50_relevance_mode="direct_asset"), off | dict(source_id="m", applies_mode="some")]
    got = sorted((r.rule, r.subject) for r in registry_violations(spark.createDataFrame([("A", " "), ("C", None)], assets.schema), spark.createDataFrame([tuple(b.values()) for b in more], schema)).collect())
    assert got == [("asset_not_in_universe", ""), ("blank_symbol", "A"), ("blank_symbol", "C"), ("rest_without_adapter", "r"), ("unknown_applies", "m")]
    got = sorted((r.rule, r.subject) for r in registry_violations(assets.limit(0), sources.limit(0)).collect())
    assert got == [("no_assets", ""), ("no_sources", "")]
    c = {r.asset: r for r in coverage(assets.dropDuplicates(["asset"]), sources.dropDuplicates(["source_id"])).collect()}
    assert c["A"].coverage_status == "asset_specific_enabled" and c["A"].direct_source_ids == ["f"] and c["D"].coverage_status == "global_symbol_match_only"
    assert c["D"].enabled_category_counts == {"news": 2} and c["D"].disabled_global == 1


def test_feeds(spark):
    rss = "<rss xmlns:c='x'><channel><item><title> A  b </title><c:encoded/><description>late</description><guid> </guid><link>u</link></item><item><title>2</title></item></channel></rss>"
    assert parse_feed(rss, 5)[0] == (None, "A b", "", "u", None, None) and len(parse_feed(rss, 1)) == 1
    assert parse_feed("no xml", 5) == [] == parse_feed("", 5)
    assert feed_items(spark.createDataFrame([("k", rss), ("n", None)], "k string, p string"), "k", "p").count() == 2
    assert rich_text('{"z":{"node":"text","text":"last"},"child":[{"node":"text","text":" a  b ","child":[{"node":"text","text":"c"}]}]}') == "a b c last" and rich_text("{") is None and rich_text(None) is None


def test_layout(spark):
    rows = [(i, "g", line) for i, line in enumerate(["aaaa", "é", "", "bb"])]
    got = {r.i: (r.part, r.line_number, r.byte_offset, r.byte_length) for r in locate(spark.createDataFrame(rows, "i int, g string, line string"), ["g"], "i", "line", 3).collect()}
    assert got == {0: (1, 1, 0, 4), 1: (1, 2, 5, 2), 2: (1, 3, 8, 0), 3: (2, 1, 0, 2)}
    lines = spark.createDataFrame([(0, '{"event_id":"a"}'), (1, '{"x":1}'), (2, "{"), (3, "  "), (4, None)], "i int, line string")
    assert [r.status for r in replay(lines, "line").orderBy("i").collect()] == ["payload", "missing_event_id", "invalid_json", "blank", "blank"]
    s = shards(spark.createDataFrame([(1, "aa1", "ab2", "aa3"), (2, None, None, None)], "i int, exact_source_key string, canonical_url_hash string, normalized_content_hash string"))
    assert sorted((r.i, r.hash_prefix) for r in s.collect()) == [(1, "aa"), (1, "ab")]
    m = manifest(spark.createDataFrame([], "object_family string, object_key string, record_count bigint, byte_count bigint"), "r").collect()
    assert len(m) == 1 and m[0].uploaded_object_count == 0


def test_index_round_trip(spark):
    at = scratch(spark, "index")
    df = spark.createDataFrame([("2025-01-01", "k1", "e1"), ("2025-01-02", "k2", None)], "dt string, dedup_key string, event_id string")
    write_json_lines(df, at, ["dt"])
    write_json_lines(df, at, ["dt"])
    spark.createDataFrame([("not json",), ("",)], "value string").write.mode("append").text(f"{at}/dt=2025-01-02")
    got = {r.dedup_key for r in read_index(spark, at).collect()}
    assert got == {"k1", "k2"} and {r.dedup_key for r in read_index(spark, at, ["2025-01-01"]).collect()} == {"k1"}
    assert {r.dedup_key for r in read_recent(spark, at, "2025-01-15").collect()} == {"k1", "k2"} and {r.dedup_key for r in read_recent(spark, at, "2025-01-16").collect()} == {"k2"} and read_recent(spark, at, "2025-01-02", 0).count() == 1
    hashes = spark.createDataFrame([("aa1", "ab2", None), ("aa9", None, None)], "exact_source_key string, canonical_url_hash string, normalized_content_hash string")
    assert sorted(tuple(r) for r in candidate_partitions(hashes, "2025-03-01", 1).collect()) == [("2025-02-28", "aa"), ("2025-02-28", "ab"), ("2025-03-01", "aa"), ("2025-03-01", "ab")]

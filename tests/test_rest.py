import json
from datetime import date

from pyspark.sql import functions as F

from tidewire.functions.text import short_hash
from tidewire.operators.admission import item_limit, selection_seed
from tidewire.operators.health import heal_records
from tidewire.plans.domain import CAPS
from tidewire.plans.ingest import Run, ingest
from tidewire.session import read
from tidewire.sources.index import recent_dates
from tidewire.sources.payloads import rest_items

SMALL = "/root/testdata/sf0.001"


def offset(text):
    h = 0
    for b in text.encode():
        h = (h * 31 + b) % 2**64
    return h


def rate(symbol, at):
    return {"symbol": symbol, "fundingRate": "0.1", "fundingTime": at, "markPrice": "9"}


def test_rest_items(spark):
    assets = spark.createDataFrame([(a, a + "USDT", "verified" if a in "ace" else None) for a in "abcdef"], "asset string, reference_symbol_native string, rss_seed_status string")
    kinds = {"r": "perp_funding_latest", "h": "perp_funding_history", "o": "perp_open_interest", "l": "notice_cms_list", "x": "other", "n": None, "bad": "perp_open_interest"}
    sources = spark.createDataFrame([(s, a) for s, a in kinds.items()], "source_id string, adapter string")
    rows = []
    for a in "abcdef":
        s = a + "USDT"
        rows += [("r", s, "u" + a, json.dumps([rate(s, 50), rate(s, 90)])), ("h", s, "v" + a, json.dumps([rate(s, t) for t in (30, 10, 20, 41)])), ("o", s, "w" + a, json.dumps({"symbol": s, "openInterest": "5", "time": 7})), ("bad", s, "w", None if a < "c" else "[oops")]
    rows += [("l", None, "list", json.dumps({"code": "000000", "data": {"catalogs": [{"catalogId": 1, "catalogName": "n", "articles": [{"id": i, "code": f"c{i}", "title": "t", "releaseDate": 3} for i in range(5)]}]}})), ("x", "aUSDT", "u", "[]"), ("n", "aUSDT", "u", "[]")]
    payloads = spark.createDataFrame(rows, "source_id string, symbol string, url string, payload string")
    at = 1_800_000 * 3 + 5
    ask = lambda window: rest_items(payloads, sources, assets, F.coalesce(F.col("rss_seed_status") == "verified", F.lit(False)), F.lit(4), at, window)
    items, errors = ask((10, 30))
    got = {}
    for r in items.orderBy("source_id", "item_ord").collect():
        got.setdefault(r.source_id, []).append(r)
    assert {k: [r.item_ord for r in v] for k, v in got.items()} == {k: [0, 1, 2, 3] for k in ("r", "h", "o", "l")}

    def live(source):
        seed = (offset(source) + 3) % 2**64
        turned = [x[seed % 3 :] + x[: seed % 3] for x in (list("ace"), list("bdf"))]
        return [y for pair in zip(*turned) for y in pair][:4]

    assert [r.id for r in got["r"]] == [f"{a}USDT:50" for a in live("r")] and [r.id for r in got["o"]] == [f"{a}USDT:7" for a in live("o")]
    assert [r.id for r in got["h"]] == ["aUSDT:10", "aUSDT:20", "aUSDT:30", "cUSDT:10"]
    first = got["h"][0]
    assert first.body == '{"backfill_window_end_ms":30,"backfill_window_start_ms":10,"funding_rate":"0.1","funding_time_ms":10,"historical_source_depth":"range_queryable","mark_price":"9","source_time_range_verified":true,"symbol":"aUSDT"}'
    assert (first.title, first.url, first.author, first.published_at, first.historical_source_depth, first.backfill_window_start_ms, first.source_time_range_verified) == ("Binance USD-M funding rate history aUSDT", "va", "Binance Futures", "10", "range_queryable", 10, True)
    assert json.loads(got["r"][0].body).keys() == {"funding_rate", "funding_time_ms", "mark_price", "symbol"} and got["o"][0].body.startswith('{"event_time_ms":7,"open_interest":"5"') and got["o"][0].historical_source_depth is None
    assert [r.id for r in got["l"]] == ["c0", "c1", "c2", "c3"]
    want = {"x rest_api unknown", "n rest_api adapter is missing", "bad returned no usable open interest records after 4 failed asset requests"}
    assert {r.error for r in errors.collect()} == (want - {"x rest_api unknown"}) | {"x unknown rest_api adapter other"}
    items, errors = ask((None, None))
    assert "h" not in {r.source_id for r in items.collect()} and "h requires --backfill-start-ms" in {r.error for r in errors.collect()}


def test_limits_seeds_dates_and_heal_records(spark):
    rows = [(None, "funding", "rest_api", False, 6), (3, "funding", "rest_api", False, 3), (20, "funding", "rest_api", True, 20), (20, "social", "rss", None, 5), (80, "news", "rss", None, 50), (2, "social", "rss", False, 2)]
    df = spark.createDataFrame(rows, "m bigint, c string, f string, b boolean, w bigint")
    assert all(r.w == r.n for r in df.select("w", item_limit(F.col("m"), F.col("c"), F.col("f"), F.col("b")).alias("n")).collect())
    one = spark.createDataFrame([("aé" * 30, date(2024, 3, 1))], "s string, d date")
    seed, early, dates = one.select(selection_seed(F.col("s"), F.lit(1_800_000 * 9)), selection_seed(F.col("s"), F.lit(-5)), recent_dates(F.col("d"), 2)).first()
    assert (int(seed), int(early)) == ((offset("aé" * 30) + 9) % 2**64, offset("aé" * 30)) and dates == ["2024-03-01", "2024-02-29", "2024-02-28"]
    failed = spark.createDataFrame([("s", 5, "HTTP 429")], "s string, t bigint, e string")
    (x,), (y,) = (heal_records(failed, "s", "t", "e", i).collect() for i in (10, None))
    key = failed.select(short_hash(F.lit("s:5:rate_limited"))).first()[0]
    assert (x.heal_event_id, x.attempt_count, x.next_retry_at_ms, y.next_retry_at_ms) == ("src_heal_" + key, 1, 15, None)


def test_a_run_takes_the_limit_of_each_feed(spark):
    sources = read(spark, SMALL, "intel_source").withColumn("max_items_per_run", F.when(F.col("source_category") == "news", 1).cast("bigint"))
    items = read(spark, SMALL, "feed_item").withColumn("run_id", F.lit("one"))
    events, _ = ingest(items, sources, read(spark, SMALL, "universe_asset"), None, Run("r", 1_767_225_600_000, "bucket", CAPS))
    most = {r.source_category: r.n for r in events.groupBy("source_category", "source_id").count().groupBy("source_category").agg(F.max("count").alias("n")).collect()}
    assert most["news"] == 1 and most["social"] <= 5
    had = items.dropDuplicates(["item_key"]).join(sources, "source_id").where("source_category = 'news'").groupBy("source_id").count().agg(F.max("count")).first()[0]
    assert had > 1

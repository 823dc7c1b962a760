"""JSON payloads of REST sources to items: announcement lists, rich-text details, rates and their ranges."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from tidewire.operators.admission import first_items, rotated_priority, selection_seed, static_priority

LIST_SCHEMA = "code string, data struct<catalogs: array<struct<catalogId: bigint, catalogName: string, articles: array<struct<id: bigint, code: string, title: string, releaseDate: bigint>>>>>"
RATE_SCHEMA = "symbol string, fundingRate string, fundingTime bigint, markPrice string"
INTEREST_SCHEMA = "symbol string, openInterest string, time bigint"


def announcements(payloads: DataFrame, key: str, payload: str, most: int = 50) -> DataFrame:
    """Articles of list payloads whose code is "000000", in order, up to `most` a payload, with a metadata body."""
    rows = payloads.select(key, F.from_json(payload, LIST_SCHEMA).alias("p")).where("p.code = '000000'")
    rows = rows.select(key, F.posexplode("p.data.catalogs").alias("c_ord", "c")).select(key, "c_ord", "c", F.posexplode("c.articles").alias("a_ord", "a"))
    flat = rows.select(key, "c_ord", "a_ord", "a.*", "c.catalogId", "c.catalogName")
    body = F.to_json(F.struct(F.col("catalogId").alias("catalogId"), F.col("catalogName").alias("catalogName"), F.col("code").alias("code"), F.col("id").alias("id"), F.col("releaseDate").alias("releaseDate")), {"ignoreNullFields": "false"})
    place = F.struct("c_ord", "a_ord")
    listed = flat.groupBy(key).agg(F.slice(F.array_sort(F.collect_list(F.struct(place.alias("o"), F.struct(F.col("code").alias("id"), "title", body.alias("body"), F.col("releaseDate").cast("string").alias("published_at")).alias("i")))), 1, most).alias("x"))
    return listed.select(key, F.posexplode("x").alias("item_ord", "x")).select(key, "item_ord", "x.i.*")


#: Fixed values of items made of announcements.
NOTICE_AUTHOR, NOTICE_URL = "Binance", "https://www.binance.com/en/support/announcement/detail/"
DETAIL_SCHEMA = "code string, data struct<body: string>"


def notice_items(payloads: DataFrame, details: DataFrame, key: str, payload: str, most: int = 50) -> DataFrame:
    """`key` and item fields of announcement lists: the body is the text of the article's detail (article_code, detail), and where
    that is missing, damaged or blank, the article's own data. Details are joined by code; lists that failed have no items."""
    rows = payloads.select(key, F.from_json(payload, LIST_SCHEMA).alias("p")).where("p.code = '000000'")
    rows = rows.select(key, F.posexplode("p.data.catalogs").alias("c_ord", "c")).select(key, "c_ord", "c", F.posexplode("c.articles").alias("a_ord", "a"))
    own = F.to_json(F.struct(F.col("a.code").alias("article_code"), F.col("a.id").alias("article_id"), F.col("c.catalogId").alias("catalog_id"), F.col("c.catalogName").alias("catalog_name"), F.col(key).alias("source_id")), {"ignoreNullFields": "false"})
    d = F.from_json("detail", DETAIL_SCHEMA)
    texts = details.select(F.col("article_code").alias("__code"), rich_text_column(F.when(d.code == "000000", d.data.body)).alias("__text")).where("__text is not null").groupBy("__code").agg(F.min("__text").alias("__text"))
    listed = rows.join(texts, F.col("a.code") == F.col("__code"), "left").withColumn("item_ord", F.row_number().over(Window.partitionBy(key).orderBy("c_ord", "a_ord")) - 1).where(F.col("item_ord") < most)
    return listed.select(key, "item_ord", F.col("a.code").alias("id"), F.col("a.title").alias("title"), F.coalesce("__text", own).alias("body"), F.concat(F.lit(NOTICE_URL), "a.code").alias("url"), F.lit(NOTICE_AUTHOR).alias("author"), F.col("a.releaseDate").cast("string").alias("published_at"))


def rich_text(body: str | None) -> str | None:
    """The text nodes of a JSON document joined in order: a node before its children, children by key, lists as they stand."""
    try:
        tree = json.loads(body) if body else None
    except ValueError:
        return None
    parts: list[str] = []

    def walk(x) -> None:
        if isinstance(x, dict):
            if x.get("node") == "text" and isinstance(x.get("text"), str) and (t := " ".join(x["text"].split())):
                parts.append(t)
            for k in sorted(x):
                walk(x[k])
        elif isinstance(x, list):
            for y in x:
                walk(y)

    walk(tree)
    return " ".join(parts) or None


@F.pandas_udf(StringType())
def rich_text_column(bodies: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in bodies:
        yield s.map(rich_text)


def latest_per_key(rows: DataFrame, key: str, time: str) -> DataFrame:
    """The row with the greatest time of each key; of equals the greatest row."""
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max(F.struct(F.col(time).alias("__t"), *rest)).alias("x")).select(key, *[F.col(f"x.{c}").alias(c) for c in rest])


def in_range(rows: DataFrame, time: str, start: Column | int, end: Column | int, rank: list, most: int) -> DataFrame:
    """Rows with start <= time <= end, by rank and time, at most `most` (a backfill's own limit); the scan is pruned by the range."""
    t = F.col(time)
    return rows.where((t >= start) & (t <= end)).orderBy(*rank, time).limit(most)


#: Fixed values of items made of rates and open interest.
AUTHOR, TITLES = "Binance Futures", {"rate": "Binance USD-M funding rate ", "history": "Binance USD-M funding rate history ", "interest": "Binance USD-M open interest "}
ADAPTERS = {"notice_cms_list": "list", "perp_funding_latest": "rate", "perp_funding_history": "history", "perp_open_interest": "interest"}
ITEM = ("id", "title", "body", "url", "author", "published_at", "historical_source_depth", "backfill_window_start_ms", "backfill_window_end_ms", "source_time_range_verified")


def _item(rows: DataFrame, kind: str, time: str, body: dict[str, Column], *keep: str, depth: Column | None = None, window: tuple[Column, Column] | None = None) -> DataFrame:
    """Items of record columns r.*; the keys of a body stand in order of their names."""
    t = F.col(f"r.{time}")
    start, end = window or (F.lit(None), F.lit(None))
    verified = (t >= start) & (t <= end) if window else F.lit(None).cast("boolean")
    extra = {"historical_source_depth": depth, "backfill_window_start_ms": start, "backfill_window_end_ms": end, "source_time_range_verified": verified} if window else {}
    fields = dict(sorted((body | {"symbol": F.col("r.symbol")} | extra).items()))
    return rows.select(
        *keep, F.concat("r.symbol", F.lit(":"), t.cast("string")).alias("id"), F.concat(F.lit(TITLES[kind]), "r.symbol").alias("title"), F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()])).alias("body"), "url",
        F.lit(AUTHOR).alias("author"), t.cast("string").alias("published_at"), (depth if window else F.lit(None)).cast("string").alias("historical_source_depth"),
        start.cast("bigint").alias("backfill_window_start_ms"), end.cast("bigint").alias("backfill_window_end_ms"), verified.alias("source_time_range_verified"),
    )


def _rate_body() -> dict[str, Column]:
    return {"funding_rate": F.col("r.fundingRate"), "funding_time_ms": F.col("r.fundingTime"), "mark_price": F.col("r.markPrice")}


def rate_items(rows: DataFrame, *keep: str) -> DataFrame:
    return _item(rows, "rate", "fundingTime", _rate_body(), *keep)


def history_items(rows: DataFrame, start_ms: int, end_ms: int, *keep: str) -> DataFrame:
    return _item(rows, "history", "fundingTime", _rate_body(), *keep, depth=F.lit("range_queryable"), window=(F.lit(start_ms).cast("bigint"), F.lit(end_ms).cast("bigint")))


def interest_items(rows: DataFrame, *keep: str) -> DataFrame:
    return _item(rows, "interest", "time", {"open_interest": F.col("r.openInterest"), "event_time_ms": F.col("r.time")}, *keep)


def _whole(record: Column, schema: str) -> Column:
    """Whether no field of a record is missing; a payload with one that is not counts as a failed request."""
    out = record.isNotNull()
    for field in schema.split(", "):
        out = out & record[field.split()[0]].isNotNull()
    return out


def rest_items(payloads: DataFrame, sources: DataFrame, assets: DataFrame, preferred: Column, limit: Column, at_ms: int, window: tuple[int | None, int | None] = (None, None)) -> tuple[DataFrame, DataFrame]:
    """(items with source_id and item_ord, errors of sources): payloads (source_id, symbol, url, payload) by the adapter of their
    source, each source up to its limit (a column of sources).

    A payload that is null or no such JSON is a failed request. Latest rates and open interest take the first `limit` assets in the
    order that rotates with at_ms, and the first record of each; ranges take the assets as preferred and ordered, and their records
    within the closed window. A source has an error if its adapter is missing or unknown, if it needs a window and has none, or if
    requests failed and no item came. Assets (asset, reference_symbol_native) and sources are registries."""
    start, end = window
    src = sources.select("source_id", "adapter", limit.cast("int").alias("__limit"))
    kind = F.try_element_at(F.create_map(*[F.lit(x) for kv in ADAPTERS.items() for x in kv]), F.col("adapter"))
    bounded = start is not None and end is not None and start < end
    missing = "requires --backfill-start-ms" if start is None else "requires --backfill-end-ms" if end is None else "requires backfill_start_ms < backfill_end_ms"
    refused = (
        F.when(F.col("adapter").isNull(), "rest_api adapter is missing").when(kind.isNull(), F.concat(F.lit("unknown rest_api adapter "), F.col("adapter")))
        .when((kind == "history") & F.lit(not bounded), missing)
    )
    src = src.withColumns({"__kind": F.when(refused.isNull(), kind), "__refused": refused})

    live = src.where("__kind in ('rate', 'interest')").select("source_id", selection_seed(F.col("source_id"), F.lit(at_ms)).alias("__seed"))
    live = rotated_priority(live.crossJoin(F.broadcast(assets)), "asset", preferred, F.col("__seed"), ("source_id",))
    fixed = src.where("__kind = 'history'").select("source_id").crossJoin(F.broadcast(static_priority(assets, "asset", preferred)))
    cols = ["source_id", F.col("reference_symbol_native").alias("symbol"), "priority"]
    ranks = live.select(*cols).unionByName(fixed.select(*cols))
    asked = payloads.join(F.broadcast(src), "source_id").join(ranks, ["source_id", "symbol"]).where((F.col("__kind") == "history") | (F.col("priority") <= F.col("__limit")))

    rates = F.when(F.col("__kind").isin("rate", "history"), F.from_json("payload", f"array<struct<{RATE_SCHEMA.replace(' ', ':').replace(',:', ',')}>>"))
    rates = F.when(F.forall(rates, lambda r: _whole(r, RATE_SCHEMA)), rates)
    interest = F.when(F.col("__kind") == "interest", F.from_json("payload", INTEREST_SCHEMA))
    read = asked.select("source_id", "symbol", "url", "priority", "__kind", "__limit", rates.alias("__rates"), F.when(_whole(interest, INTEREST_SCHEMA), interest).alias("__interest"))
    failed = F.col("__rates").isNull() & F.col("__interest").isNull()

    keep = ("source_id", "__limit", "__order")
    latest = read.where("__kind = 'rate'").withColumns({"r": F.get("__rates", F.lit(0)), "__order": F.struct("priority", F.lit(0).cast("bigint").alias("t"))}).where("r is not null")
    single = read.withColumns({"r": F.col("__interest"), "__order": F.struct("priority", F.lit(0).cast("bigint").alias("t"))}).where("r is not null")
    ranged = read.where("__kind = 'history'").withColumn("r", F.explode("__rates")).withColumn("__order", F.struct("priority", F.col("r.fundingTime").alias("t"))).where((F.col("r.fundingTime") >= F.lit(start)) & (F.col("r.fundingTime") <= F.lit(end)))
    listed = announcements(payloads.join(F.broadcast(src.where("__kind = 'list'").select("source_id", "__limit")), "source_id"), "source_id", "payload")
    listed = listed.join(F.broadcast(src.select("source_id", "__limit")), "source_id").withColumn("__order", F.struct(F.col("item_ord").alias("priority"), F.lit(0).cast("bigint").alias("t")))
    none = {c: F.lit(None).cast("bigint" if c.endswith("_ms") else "boolean" if c.endswith("verified") else "string") for c in ITEM if c not in listed.columns}
    items = rate_items(latest, *keep).unionByName(interest_items(single, *keep)).unionByName(listed.withColumns(none).select(*keep, *ITEM))
    if bounded:
        items = items.unionByName(history_items(ranged, start, end, *keep))
    items = first_items(items, "source_id", ["__order", "id"], F.col("__limit")).withColumn("item_ord", F.row_number().over(Window.partitionBy("source_id").orderBy("__order", "id")) - 1)
    items = items.select("source_id", "item_ord", *ITEM)

    misses = read.where(failed).groupBy("source_id").agg(F.countDistinct("symbol").alias("__n"), F.first("__kind").alias("__k"))
    what = F.when(F.col("__k") == "rate", "funding").when(F.col("__k") == "interest", "open interest").otherwise("funding history")
    empty = misses.join(items.select("source_id").distinct(), "source_id", "left_anti").select("source_id", F.concat(F.lit("returned no usable "), what, F.lit(" records after "), F.col("__n").cast("string"), F.lit(" failed asset requests")).alias("error"))
    errors = src.where("__refused is not null").select("source_id", F.col("__refused").alias("error")).unionByName(empty)
    return items, errors.select("source_id", F.concat_ws(" ", "source_id", "error").alias("error"))

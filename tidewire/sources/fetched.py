"""Answers of sources to items: what came back, read by the source's method. The network is outside; an answer is a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.html import anchor_items, looks_blocked, page_summary, page_title
from tidewire.sources.feeds import feed_items, looks_like_feed

PAGE_ITEM = "#page-summary"


def answers(payloads: DataFrame) -> DataFrame:
    """Adds outcome (fetched, not_modified, failed) and error to answers (source_id, fetch_method, status, content_type, body)."""
    status, said = F.col("status"), lambda text: F.concat("source_id", F.lit(f" {text}"))
    error = (
        F.when(status == 304, F.lit(None)).when(~F.coalesce(status.between(200, 299), F.lit(False)), F.concat(said("returned HTTP "), F.coalesce(status.cast("string"), F.lit(""))))
        .when((F.col("fetch_method") == "rss") & ~F.coalesce(looks_like_feed(F.col("body"), F.col("content_type")), F.lit(False)), said("did not return an XML feed"))
        .when((F.col("fetch_method") == "html_crawl") & F.coalesce(looks_blocked(F.col("body")), F.lit(False)), said("returned a bot challenge page"))
        .when(~F.coalesce(F.col("fetch_method").isin("rss", "html_crawl", "rest_api"), F.lit(False)), F.concat(said("unsupported fetch_method "), F.coalesce("fetch_method", F.lit(""))))
    )
    rows = payloads.withColumn("error", error)
    return rows.withColumn("outcome", F.when(F.col("status") == 304, "not_modified").when(F.col("error").isNotNull(), "failed").otherwise("fetched"))


def page_items(pages: DataFrame, key: str, url: str, name: str, html: str, direct: Column, most: int = 50) -> DataFrame:
    """`key`, item_ord, id, title, body and url of the items of pages: of sources that name assets (`direct`) the page's own summary
    first, then its linked items, `most` in all. A page that says nothing of itself has no summary; null pages have no items."""
    own = pages.select(key, F.col(url).alias("__u"), F.col(html).alias("__h"), direct.alias("__d"), page_title(F.col(html), F.col(name)).alias("title"))
    own = own.where("__d").withColumn("body", page_summary(F.col("__h"), F.col("title"))).where("body is not null")
    own = own.select(key, F.lit(-1).alias("item_ord"), F.concat("__u", F.lit(PAGE_ITEM)).alias("id"), "title", "body", F.col("__u").alias("url"))
    linked = anchor_items(pages, key, url, html, most).select(key, "item_ord", F.col("url").alias("id"), "title", "body", "url")
    # linked items are numbered from 0 already, so where there is a summary they move up by one
    shift = own.select(key, F.lit(1).alias("__by"))
    out = own.unionByName(linked).join(shift, key, "left").withColumn("item_ord", F.col("item_ord") + F.coalesce("__by", F.lit(0)))
    return out.where(F.col("item_ord") < most).drop("__by")


def fetched_feeds(payloads: DataFrame, most: int = 50) -> tuple[DataFrame, DataFrame]:
    """(answers with outcome and error, items of the feeds among the fetched ones)."""
    read = answers(payloads)
    return read, feed_items(read.where("outcome = 'fetched' and fetch_method = 'rss'"), "source_id", "body", most)

"""Queries of page text (p3) and reading level (p10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm.page_content import one_row, template_lines
from tidewire.llm.reading_level import learn, reading_levels
from tidewire.llm.repeated_lines import without_lines
from tidewire.session import read, spread


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    crawled = read(spark, sf_dir, "intel_source").where("fetch_method = 'html_crawl'").select("source_id").distinct()
    events = read(spark, sf_dir, "raw_intel_event").select(F.col("event_id").alias("rec_id"), "source_id", "body", F.col("event_ord").alias("o"))
    items = read(spark, sf_dir, "feed_item").select(F.col("item_key").alias("rec_id"), "source_id", "body", F.lit(0).cast("bigint").alias("o"))
    rows = events.unionByName(items).join(crawled, "source_id", "left_semi").where("body is not null")
    return one_row(rows, "rec_id", "o", ["source_id", "body"])


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template_lines(_pages(spark, sf_dir), "rec_id", "source_id", "body").select("rec_id", F.col("line_no").alias("line_no"))


def p3_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _pages(spark, sf_dir)
    return without_lines(pages, template_lines(pages, "rec_id", "source_id", "body"), "rec_id", "body")


def _levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(read(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    grader = learn(docs, "doc_id", "text", "source", read(spark, sf_dir, "reading_label"), "doc_id", "reading_level")
    return reading_levels(docs, "doc_id", "text", grader)


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _levels(spark, sf_dir).where("level = 3").select("doc_id")


def p10_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _levels(spark, sf_dir).select("doc_id", F.round("grade", 6).alias("grade"), "level")


QUERIES = {"p3_found": p3_found, "p3_articles": p3_articles, "p10_found": p10_found, "p10_levels": p10_levels}
SQL: dict[str, str] = {}

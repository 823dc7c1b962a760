"""One ingest run as one plan: items to events, decisions against the index, quotas, stored lines with locators, pointers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewire.operators.admission import admit, balance_class, first_items, item_limit
from tidewire.operators.decisions import decide, skipped
from tidewire.operators.events import build_events
from tidewire.session import cut
from tidewire.sources.index import simhash_of
from tidewire.sources.layout import event_partitions, json_line, locate
from tidewire.sources.pointers import POINTER_FIELDS, created_pointers
from tidewire.sources.registry import manual_backfill


@dataclass(frozen=True)
class Run:
    """What a run is given. caps: events admitted of a class of sources; chunk: records of one stored object; in a dry run
    every event counts as new."""

    run_id: str
    now_ms: int
    bucket: str
    caps: dict[str, int]
    chunk: int = 1000
    dry: bool = False


def ingest(items: DataFrame, sources: DataFrame, universe: DataFrame, known: DataFrame | None, run: Run) -> tuple[DataFrame, DataFrame]:
    """(decided events, pointers of the stored ones). Of each source's feed (one for each run_id of the items) only as many items as
    the source's limit are taken. Items are taken in order of source_ord, item_ord and item_key, one row for each
    item_key; their number in that order is counted per source, so no task sorts the whole run. Events are checkpointed once, since
    decisions and storage both read them."""
    limits = sources.select("source_id", item_limit(F.col("max_items_per_run"), F.col("source_category"), F.col("fetch_method"), manual_backfill()).alias("__limit"))
    # ranked by keys alone, so that texts are not shuffled for it
    feed = [c for c in ("source_id", "run_id") if c in items.columns]
    places = items.groupBy("item_key").agg(F.min(F.struct(*feed, "item_ord")).alias("__at")).select("item_key", "__at.item_ord", "__at.source_id", F.struct(*[F.col(f"__at.{c}") for c in feed]).alias("__feed"))
    taken = first_items(places.join(limits, "source_id"), "__feed", ["item_ord", "item_key"], F.col("__limit"))
    items = items.dropDuplicates(["item_key"]).join(taken.select("item_key"), "item_key", "left_semi")
    events = build_events(items, sources, universe, run.now_ms)
    place = F.row_number().over(Window.partitionBy("source_ord", "source_id").orderBy("item_ord", "item_key"))
    part = F.dense_rank().over(Window.orderBy("source_ord", "source_id"))
    turns = events.select("source_ord", "source_id").distinct().withColumn("turn", part)  # a registry's sources
    events = events.withColumn("place", place).join(turns, ["source_ord", "source_id"])
    events = events.withColumn("event_ord", F.col("turn").cast("bigint") * (1 << 32) + F.col("place")).drop("turn", "place")
    events = cut(events)
    new = events.select(F.col("event_ord").alias("ord"), F.lit("new").alias("dedup_decision"), F.lit(None).cast("string").alias("duplicate_of_event_id"))
    decided = new if run.dry else decide(events.withColumn("bits", simhash_of(F.col("simhash64"))), "event_ord", "bits", known=known)
    events = events.drop("run_id", "dedup_decision", "duplicate_of_event_id").withColumn("run_id", F.lit(run.run_id)).join(decided.withColumnRenamed("ord", "event_ord"), "event_ord")
    classes = sources.select("source_id", balance_class(F.col("source_category"), F.col("fetch_method"), manual_backfill()).alias("balance_class"))
    events = events.join(classes, "source_id")
    passed = admit(events.where(~skipped(F.col("dedup_decision"))), "run_id", "balance_class", ["event_ord"], run.caps)
    stored = event_partitions(passed.where("admitted"), "fetched_at_ms")
    stored = stored.withColumn("line", json_line(*POINTER_FIELDS, "observed_at_ms", "language", "author_or_channel", "title", "body", "url", "run_id"))
    placed = locate(stored, ["dt", "hour", "source_category", "source_id", "run_id"], "event_ord", "line", run.chunk)
    return events, created_pointers(placed, run.bucket, F.lit(run.now_ms))

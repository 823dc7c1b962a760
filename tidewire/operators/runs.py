"""Records of a run: visits to sources, their health, states, balance and the run's summary."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewire.functions.text import short_hash
from tidewire.operators.admission import COMMUNITY_ITEMS, DERIVATIVES_CEILING, DERIVATIVES_ITEMS, RUN_CAPS, balance_class
from tidewire.operators.decisions import skipped
from tidewire.operators.health import failure_runs, health_level
from tidewire.sources.registry import manual_backfill

#: Fixed values of the records' contracts.
HEALTH_SCHEMA, BALANCE_SCHEMA, STATE_SCHEMA = "source_health_v1", "source_balance_v1", "source_fetch_state_v1"
RETRIES, RETRY_MS = 3, 750


def run_id(at: datetime | None = None) -> str:
    """Name of a run by its start in UTC, to the nanosecond."""
    at = (at or datetime.now(timezone.utc)).astimezone(timezone.utc)
    return f"intel-crawl-{at:%Y%m%dT%H%M%S}{at.microsecond:06d}000Z"


def conditional_headers(source_id: str | None, backfill_start_ms: int | None, backfill_end_ms: int | None) -> bool:
    """Whether a run asks for changes only: a run for one source or a range asks for everything."""
    return source_id is None and backfill_start_ms is None and backfill_end_ms is None


def retry_delays_ms() -> list[int]:
    """Waits before the second and each later attempt at a source."""
    return [RETRY_MS * n for n in range(1, RETRIES)]


def health_records(visits: DataFrame) -> DataFrame:
    """One record a visit (source_id, source_category, fetch_method, adapter, outcome, checked_at_ms, observed_at_ms, items_seen,
    events_written, duplicates, error, until_ms).

    outcome: fetched, not_modified, failed, skipped_backoff or skipped_cadence; a fetch without items is degraded. A skipped visit
    took no time and names the moment until which it was skipped. Null counts are 0.
    """
    n = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    fetched, waits = F.col("outcome") == "fetched", F.col("outcome").isin("skipped_backoff", "skipped_cadence")
    status = F.when(fetched & (n("items_seen") == 0), "no_items").when(fetched, "ok").otherwise(F.col("outcome"))
    count = lambda c: F.when(fetched, n(c)).otherwise(F.lit(0).cast("bigint"))
    until = F.when(F.col("outcome") == "skipped_backoff", F.concat(F.lit("backoff_until_ms="), F.col("until_ms").cast("string"))).when(F.col("outcome") == "skipped_cadence", F.concat(F.lit("next_due_at_ms="), F.col("until_ms").cast("string")))
    error = F.when(F.col("outcome") == "failed", F.col("error")).otherwise(until)
    state = F.when(F.col("outcome") == "failed", "scheduled").when(F.col("outcome") == "skipped_backoff", "active").otherwise("none")
    basis = F.concat_ws(":", "source_id", F.col("checked_at_ms").cast("string"), status, count("duplicates").cast("string"))
    return visits.select(
        F.lit(HEALTH_SCHEMA).alias("schema_version"), F.concat(F.lit("src_health_"), short_hash(basis)).alias("health_event_id"), "source_id", "source_category", "fetch_method", "adapter",
        "checked_at_ms", "observed_at_ms", status.alias("fetch_status"), error.alias("http_status_or_error"), F.when(waits, F.lit(0).cast("bigint")).otherwise(F.col("observed_at_ms") - F.col("checked_at_ms")).alias("latency_ms"),
        count("items_seen").alias("items_fetched"), count("events_written").alias("items_emitted"), count("duplicates").alias("dedup_dropped"), state.alias("backoff_state"), health_level(status).alias("health_level"),
        status.alias("status"), count("items_seen").alias("items_seen"), count("events_written").alias("events_written"), count("duplicates").alias("duplicate_events_skipped"), error.alias("error"),
    )


def fetch_states(attempts: DataFrame, order: list[str]) -> DataFrame:
    """Adds to each attempt (source_id, at_ms, outcome success | not_modified | failure, http_status, etag, last_modified, items_seen,
    error) the state of its source after it, by windows over the source's attempts in order.

    A success or an unchanged answer ends failures, back-off and error; validators change only where new ones are given; unchanged
    answers are counted until one brings items. A failure leaves the last status and success as they were.
    """
    failed = ~F.coalesce(F.col("outcome").isin("success", "not_modified"), F.lit(False))
    rows = failure_runs(attempts, "source_id", "at_ms", order, failed).withColumn("__ok", ~failed)
    upto = Window.partitionBy("source_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    last = lambda c: F.last(F.when(F.col("__ok"), F.col(c)), ignorenulls=True).over(upto)
    fresh = F.when((F.col("outcome") == "success") & (F.coalesce(F.col("items_seen"), F.lit(0)) > 0), 1).otherwise(0)
    rows = rows.withColumn("__since", F.sum(fresh).over(upto))
    since = Window.partitionBy("source_id", "__since").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    unchanged = F.sum(F.when(F.col("outcome") == "not_modified", 1).otherwise(0)).over(since)
    return rows.withColumns({
        "state_etag": last("etag"), "state_last_modified": last("last_modified"), "last_http_status": last("http_status"), "last_checked_at_ms": F.col("at_ms"), "last_success_at_ms": last("at_ms"),
        "unchanged_count": unchanged.cast("bigint"), "last_error": F.when(~F.col("__ok"), F.col("error")),
    }).drop("__ok", "__since")


def current_states(states: DataFrame, sources: DataFrame) -> DataFrame:
    """The state of every source as a run loads it: fresh where none was kept, or one of another schema. `states` is what
    latest_states gives, one row a source."""
    fields = [c for c in states.columns if c not in ("source_id", "schema_version")]
    kept = states.where(F.col("schema_version") == STATE_SCHEMA).select("source_id", *fields)
    counts = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("failure_count", "unchanged_count") if c in fields}
    return sources.select("source_id").distinct().join(kept, "source_id", "left").withColumns(counts | {"schema_version": F.lit(STATE_SCHEMA)})


def latest_states(after: DataFrame, order: list[str]) -> DataFrame:
    """One state a source: that after its last attempt, as it is kept between runs (write it over the table that held the last)."""
    fields = ["last_http_status", "last_checked_at_ms", "last_success_at_ms", "failure_count", "unchanged_count", "backoff_until_ms", "last_error"]
    x = F.struct(F.col("state_etag").alias("etag"), F.col("state_last_modified").alias("last_modified"), *fields)
    out = after.groupBy("source_id").agg(F.max_by(x, F.struct(*order)).alias("x"))
    return out.select(F.lit(STATE_SCHEMA).alias("schema_version"), "source_id", F.concat(F.lit("source_fetch_state_"), short_hash(F.col("source_id"))).alias("state_id"), "x.*")


def balance_records(sources: DataFrame, events: DataFrame, observed_at_ms: Column | int, derivatives: int = RUN_CAPS["derivatives_snapshot"], community: int = RUN_CAPS["community_reaction"]) -> DataFrame:
    """One record for every selected source, those without events too. events: source_id, dedup_decision, admitted and
    suppression_reason of all items seen; sources are a registry."""
    dropped = skipped(F.col("dedup_decision"))
    held = ~dropped & ~F.coalesce("admitted", F.lit(True))
    by = events.groupBy("source_id").agg(F.count(F.lit(1)).alias("items_seen"), F.count_if(~dropped).alias("candidates_after_dedup"), F.count_if(~dropped & ~held).alias("events_emitted"), F.count_if(dropped).alias("duplicates_skipped"), F.count_if(held).alias("suppressed_by_balance"))
    why = events.where(held).groupBy("source_id", "suppression_reason").agg(F.count(F.lit(1)).alias("n")).groupBy("source_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("suppression_reason", "n")))).alias("suppression_reasons"))
    kind = balance_class(F.col("source_category"), F.col("fetch_method"), manual_backfill())
    out = sources.select("source_id", "source_category", "fetch_method", "adapter", kind.alias("balance_class")).join(by, "source_id", "left").join(why, "source_id", "left")
    counts = ("items_seen", "candidates_after_dedup", "events_emitted", "duplicates_skipped", "suppressed_by_balance")
    at = observed_at_ms if isinstance(observed_at_ms, Column) else F.lit(observed_at_ms)
    limits = {"derivatives_max_events_per_run": min(derivatives, DERIVATIVES_CEILING), "derivatives_max_events_per_source": DERIVATIVES_ITEMS, "community_max_events_per_run": community, "community_max_events_per_source": COMMUNITY_ITEMS}
    return out.select(
        F.lit(BALANCE_SCHEMA).alias("schema_version"), at.cast("bigint").alias("observed_at_ms"), "source_id", "source_category", "fetch_method", "adapter", "balance_class",
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in counts], F.coalesce("suppression_reasons", F.create_map().cast("map<string,bigint>")).alias("suppression_reasons"), *[F.lit(v).alias(k) for k, v in limits.items()],
    )


def run_summary(visits: DataFrame, events: DataFrame, pointers: DataFrame | None = None, run: tuple[str, ...] = ()) -> DataFrame:
    """Counters of a run, or of each by the columns of `run`. visits: source_id and outcome; events: dedup_decision and admitted of all
    items; pointers: status (published or pending); all with the run's columns. A visit counts as ok unless it failed."""
    dropped = skipped(F.col("dedup_decision"))
    held = ~dropped & ~F.coalesce("admitted", F.lit(True))
    v = visits.groupBy(*run).agg(F.count(F.lit(1)).alias("sources_selected"), F.count_if(F.col("outcome").isin("fetched", "not_modified")).alias("sources_ok"), F.count_if(F.col("outcome") == "failed").alias("sources_failed"))
    e = events.groupBy(*run).agg(F.count(F.lit(1)).alias("items_seen"), F.count_if(~dropped & ~held).alias("events_written"), F.count_if(dropped).alias("events_skipped_duplicate"), F.count_if(held).alias("events_suppressed_by_balance"))
    parts = [v, e]
    if pointers is not None:
        parts.append(pointers.groupBy(*run).agg(F.count_if(F.col("status") == "published").alias("events_published"), F.count_if(F.col("status") == "pending").alias("pointer_publish_pending")))
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, list(run), "full_outer") if run else out.crossJoin(p)  # without columns each is one row
    return out.na.fill(0)

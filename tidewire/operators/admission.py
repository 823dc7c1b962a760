"""Quotas: top items of a source, caps of a class in a run, and rotating priority."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewire.functions.text import source_offset

#: Items of a source taken by default, and at most of one of derivatives snapshots and of a community.
ITEMS, DERIVATIVES_ITEMS, COMMUNITY_ITEMS = 50, 6, 5


#: Classes of sources that share quotas, and the events admitted of one in a run at most.
SNAPSHOT, COMMUNITY, STANDARD = "derivatives_snapshot", "community_reaction", "standard_source"
DERIVATIVES_CEILING = 12
RUN_CAPS = {SNAPSHOT: 12, COMMUNITY: 30}


def balance_class(category: Column, method: Column, backfill: Column) -> Column:
    """Class of a source; backfill tells one that only runs on demand, which is no snapshot. Nulls are standard."""
    snapshot = (category == "funding") & (method == "rest_api") & ~F.coalesce(backfill, F.lit(False))
    return F.when(snapshot, SNAPSHOT).when(category == "social", COMMUNITY).otherwise(STANDARD)


def run_caps(derivatives: int = RUN_CAPS[SNAPSHOT], community: int = RUN_CAPS[COMMUNITY]) -> dict[str, int]:
    """Caps by class; that of snapshots can be lowered but not raised above its ceiling."""
    return {SNAPSHOT: min(derivatives, DERIVATIVES_CEILING), COMMUNITY: community}


def item_limit(most: Column, category: Column, method: Column, backfill: Column) -> Column:
    """Items taken of a source in a run."""
    limit, kind = F.least(F.coalesce(most, F.lit(ITEMS)), F.lit(ITEMS)), balance_class(category, method, backfill)
    return F.when(kind == SNAPSHOT, F.least(limit, F.lit(DERIVATIVES_ITEMS))).when(kind == COMMUNITY, F.least(limit, F.lit(COMMUNITY_ITEMS))).otherwise(limit)


def first_items(items: DataFrame, source: str, order: list[str], limit: Column) -> DataFrame:
    """The first `limit` items of each source in order (a rank within the source, not a global sort)."""
    rank = F.row_number().over(Window.partitionBy(source).orderBy(*order))
    return items.withColumn("__rank", rank).where(F.col("__rank") <= limit).drop("__rank")


def admit(events: DataFrame, run: str, kind: str, order: list[str], caps: dict[str, int]) -> DataFrame:
    """Adds admitted and suppression_reason: of each run and class that has a cap, the first `cap` events in order are admitted.

    Only classes with a cap are ranked, and a row can only be within the cap if it is within the cap of its salt, so a hot class is
    ranked in 32 parts first and only the parts' heads (32 caps at most) are ranked together."""
    capped = F.create_map(*[F.lit(x) for kv in caps.items() for x in kv])
    cap = F.try_element_at(capped, F.col(kind))
    rows = events.withColumns({"__cap": cap, "__salt": F.pmod(F.xxhash64(*order), F.lit(32))})
    part = F.row_number().over(Window.partitionBy(run, kind, "__salt").orderBy(*order))
    heads = rows.where("__cap is not null").withColumn("__r", part)
    heads = heads.withColumn("__head", F.col("__r") <= F.col("__cap"))
    # rows beyond their part's head are never admitted and stay out of the final ranking
    final = F.row_number().over(Window.partitionBy(run, kind).orderBy(*order))
    ranked = heads.where("__head").withColumn("admitted", final <= F.col("__cap"))
    rest = heads.where("not __head").withColumn("admitted", F.lit(False))
    free = rows.where("__cap is null").withColumn("admitted", F.lit(True))
    cols = [*events.columns, "admitted"]
    out = ranked.select(*cols).unionByName(rest.select(*cols)).unionByName(free.select(*cols))
    return out.withColumn("suppression_reason", F.when(~F.col("admitted"), F.concat(F.col(kind), F.lit("_run_cap"))))


def selection_seed(source_id: Column, at_ms: Column) -> Column:
    """Offset of the source plus the half hours since 1970, modulo 2^64, as decimal."""
    slot = F.floor(F.greatest(at_ms, F.lit(0)) / F.lit(1_800_000)).cast("decimal(20,0)")
    return ((source_offset(source_id) + slot) % F.lit("18446744073709551616").cast("decimal(38,0)")).cast("decimal(20,0)")


def static_priority(assets: DataFrame, order: str, preferred: Column) -> DataFrame:
    """Adds priority from 1: preferred assets first, each kind in order. Assets are a registry, sorted in one task."""
    return assets.withColumn("priority", F.row_number().over(Window.orderBy(F.when(preferred, 0).otherwise(1), order)))


def rotated_priority(assets: DataFrame, order: str, preferred: Column, seed: Column | int, each: tuple[str, ...] = ()) -> DataFrame:
    """Adds priority from 1: preferred and other assets, each in order and turned left by seed, taken in turn, within the groups of
    `each`. Assets are a registry."""
    rows = assets.withColumn("__other", F.when(preferred, 0).otherwise(1))
    by = Window.partitionBy(*each, "__other")
    seed = seed if isinstance(seed, Column) else F.lit(seed)
    place = F.pmod(F.row_number().over(by.orderBy(order)) - 1 - seed, F.count(F.lit(1)).over(by))
    return rows.withColumn("__place", place).withColumn("priority", F.row_number().over(Window.partitionBy(*each).orderBy("__place", "__other"))).drop("__other", "__place")

"""Queries of the general data problems: lateness (p4), mixed times (p6), redelivery (p7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions.instants import ZONE_MINUTES, epoch_bigint_ms, to_instants
from tidewire.operators.delivery import SeenStore, redeliveries
from tidewire.operators.lateness import event_fates, period_figures
from tidewire.session import read, scratch


def _published_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, published_ms and arrival of each event whose published time can be determined."""
    rows = read(spark, sf_dir, "raw_intel_event").select("event_id", epoch_bigint_ms(F.col("published_at_ms")).alias("published_ms"), "fetched_at_ms", "content_quality_score")
    return rows.groupBy("event_id").agg(F.min("published_ms").alias("published_ms"), F.min("fetched_at_ms").alias("arrived_ms"), F.max("content_quality_score").alias("score"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_fates(_published_events(spark, sf_dir), "event_id", "published_ms", "arrived_ms").where("fate <> 'on_time'").select("event_id", "fate")


def p4_hourly_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return period_figures(_published_events(spark, sf_dir), "event_id", "published_ms", "arrived_ms", "score")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    clock = read(spark, sf_dir, "source_clock").groupBy("source_id").agg(F.min("clock_zone").alias("clock_zone"), F.min("day_first").alias("day_first"))
    items = read(spark, sf_dir, "feed_item").select(F.col("item_key").alias("rec_id"), "source_id", "published_at")
    # one row per source: what it reads is joined as a small dimension whose size AQE checks
    items = to_instants(items.join(clock, "source_id", "left"), "published_at", "clock_zone", "day_first").select("rec_id", "published_ms")
    events = read(spark, sf_dir, "raw_intel_event").select(F.col("event_id").alias("rec_id"), epoch_bigint_ms(F.col("published_at_ms")).alias("published_ms"))
    # filtered after the aggregation: a filter below it would be pushed into the parser and repeat all of it
    return items.unionByName(events).groupBy("rec_id").agg(F.min("published_ms").alias("published_ms")).where("published_ms is not null and rec_id is not null")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three stretches of creation time, each decided by the bits that the ones before have set: the copy created first stays, in
    whichever batch it came."""
    rows = read(spark, sf_dir, "created_pointer").select("delivery_id", "event_id", "created_at_ms")
    return redeliveries(rows, SeenStore(spark, scratch(spark, "seen")), "all", stretches=3).select("delivery_id")


QUERIES = {"p4_found": p4_found, "p4_hourly_figures": p4_hourly_figures, "p6_found": p6_found, "p7_found": p7_found}

_PUBLISHED = """
pub AS (SELECT event_id, min(CASE
    WHEN published_at_ms >= 946684800 AND published_at_ms < 4102444800 THEN published_at_ms * 1000
    WHEN published_at_ms >= 946684800000 AND published_at_ms < 4102444800000 THEN published_at_ms
    WHEN published_at_ms >= 946684800000000 AND published_at_ms < 4102444800000000 THEN published_at_ms // 1000
    WHEN published_at_ms >= 946684800000000000 AND published_at_ms < 4102444800000000000 THEN published_at_ms // 1000000 END) AS pub,
    min(fetched_at_ms) AS came, max(content_quality_score) AS score FROM raw_intel_event GROUP BY event_id),
timed AS (SELECT *, pub // 3600000 * 3600000 AS start, pub // 3600000 * 3600000 + 3600000 AS fin FROM pub WHERE pub IS NOT NULL)"""


_Z = r"[A-Za-z]{1,5}|[+-]\d{1,2}(?::?\d{2})?"
#: What is written in the tables: notation, and its groups in order.
_WRITTEN = {
    "a": (rf"^(\d{{4}})-(\d{{1,2}})-(\d{{1,2}})(?:[Tt ](\d{{1,2}}):(\d{{2}})(?::(\d{{2}})(?:[.,](\d+))?)?)?(?: ?({_Z}))?$", "y mo d h mi s f z"),
    "b": (rf"^(\d{{4}})(\d{{2}})(\d{{2}})[Tt](\d{{2}})(\d{{2}})(\d{{2}})({_Z})?$", "y mo d h mi s z"),
    "c": (rf"^(?:[A-Za-z]{{3}}, )?(\d{{1,2}}) ([A-Za-z]{{3}}) (\d{{4}}|\d{{2}}) (\d{{2}}):(\d{{2}}):(\d{{2}})(?: ({_Z}))?$", "d mo y h mi s z"),
    "e": (r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})(?: (\d{1,2}):(\d{2})(?::(\d{2}))?(?: (AM|PM))?)?$", "n1 n2 y h mi s half"),
    "g": (rf"^([A-Za-z]{{3,9}}) (\d{{1,2}}), (\d{{4}}) (?:at )?(\d{{1,2}}):(\d{{2}})(?::(\d{{2}}))?(?: (AM|PM))?(?: ({_Z}))?$", "mo d y h mi s half z"),
}


def _part(name: str) -> str:
    return "coalesce(" + ", ".join(f"nullif({k}.{name}, '')" for k, (_, groups) in _WRITTEN.items() if name in groups.split()) + ")"


_UNITS = " ".join(f"WHEN {{0}} >= 946684800{zeros} AND {{0}} < 4102444800{zeros} THEN {ms}" for zeros, ms in (("", "{0} * 1000"), ("000", "{0}"), ("000000", "{0} // 1000"), ("000000000", "{0} // 1000000")))
_INSTANTS = f"""
item AS (SELECT item_key, f.source_id, regexp_replace(published_at, '^[\\s\\x{{A0}}]+|[\\s\\x{{A0}}]+$', '', 'g') AS p, day_first, clock_zone FROM feed_item f LEFT JOIN (SELECT source_id, min(clock_zone) AS clock_zone, min(day_first) AS day_first FROM source_clock GROUP BY 1) USING (source_id)),
parts AS (SELECT *, {", ".join(f"regexp_extract(p, '{pattern}', [" + ", ".join(f"'{g}'" for g in groups.split()) + f"]) AS {k}" for k, (pattern, groups) in _WRITTEN.items())} FROM item),
named AS (SELECT item_key, p, clock_zone, {", ".join(f"{_part(x)} AS {x}" for x in ("y", "h", "mi", "s", "f", "half", "z"))},
  coalesce({_part("mo")}, CASE WHEN coalesce(day_first, false) THEN nullif(e.n2, '') ELSE nullif(e.n1, '') END) AS mo, coalesce({_part("d")}, CASE WHEN coalesce(day_first, false) THEN nullif(e.n1, '') ELSE nullif(e.n2, '') END) AS d FROM parts),
wall AS (SELECT *, try_strptime(CASE WHEN length(y) = 2 THEN '20' || y ELSE y END || '-' || CASE WHEN regexp_matches(mo, '^\\d') THEN mo ELSE ((instr('janfebmaraprmayjunjulaugsepoctnovdec', lower(left(mo, 3))) + 2) // 3)::VARCHAR END || '-' || d || ' ' ||
    (coalesce(h::INTEGER, 0) + CASE WHEN half = 'PM' AND h::INTEGER < 12 THEN 12 WHEN half = 'AM' AND h::INTEGER = 12 THEN -12 ELSE 0 END) || ':' || coalesce(mi, '00') || ':' || coalesce(s, '00'), '%Y-%m-%d %H:%M:%S') AS w, coalesce(left(rpad(f, 3, '0'), 3)::BIGINT, 0) AS ms FROM named),
off AS (SELECT *, CASE WHEN z IS NULL THEN NULL WHEN z[1] IN ('+', '-') THEN (CASE WHEN z[1] = '-' THEN -1 ELSE 1 END) * (regexp_extract(z, '^.(\\d{{1,2}})', 1)::INTEGER * 60 + coalesce(try_cast(regexp_extract(z, '^.\\d{{1,2}}:?(\\d{{2}})$', 1) AS INTEGER), 0))
    ELSE map {{{", ".join(f"'{k}': {v}" for k, v in ZONE_MINUTES.items())}}}[upper(z)] END AS o, timezone(clock_zone, w) AS t FROM wall),
inst AS (SELECT item_key AS rec_id, CASE WHEN regexp_full_match(p, '\\d{{1,19}}') THEN (CASE {_UNITS.format("p::HUGEINT")} END)::BIGINT WHEN o IS NOT NULL THEN epoch_ms(w) - o * 60000 + ms WHEN z IS NOT NULL THEN NULL
    WHEN timezone(clock_zone, t - INTERVAL 1 HOUR) = w THEN epoch_ms(t - INTERVAL 1 HOUR) + ms WHEN h IS NULL OR timezone(clock_zone, t) = w THEN epoch_ms(t) + ms END AS ms FROM off
  UNION ALL SELECT event_id, CASE {_UNITS.format("published_at_ms")} END FROM raw_intel_event)"""

SQL = {
    "p4_found": f"WITH {_PUBLISHED} SELECT event_id, CASE WHEN came <= fin + 86400000 THEN 'corrects' ELSE 'too_late' END AS fate FROM timed WHERE came > fin + 900000",
    "p4_hourly_figures": f"""WITH {_PUBLISHED}
SELECT start AS period_start_ms, count(*) FILTER (came <= fin + 900000) AS n_first,
  coalesce(sum(score) FILTER (came <= fin + 900000), 0)::BIGINT AS v_first, count(*) FILTER (came <= fin + 86400000) AS n_final,
  coalesce(sum(score) FILTER (came <= fin + 86400000), 0)::BIGINT AS v_final, count(*) FILTER (came > fin + 86400000) AS n_too_late
FROM timed GROUP BY start""",
    "p6_found": f"WITH {_INSTANTS} SELECT rec_id, min(ms) AS published_ms FROM inst WHERE rec_id IS NOT NULL GROUP BY 1 HAVING min(ms) IS NOT NULL",
    "p7_found": """SELECT delivery_id FROM (
  SELECT delivery_id, row_number() OVER (PARTITION BY lower(regexp_replace(event_id, '^\\s+|\\s+$', '', 'g'))
    ORDER BY created_at_ms NULLS LAST, delivery_id) AS rn
  FROM created_pointer WHERE regexp_replace(event_id, '^\\s+|\\s+$', '', 'g') <> '') WHERE rn > 1""",
}

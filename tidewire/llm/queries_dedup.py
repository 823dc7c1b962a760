"""Queries of near-duplicates (p1), history (p2) and repeated lines (p5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm.history import HistoryRuns
from tidewire.llm.near_duplicates import NearDuplicates
from tidewire.llm.repeated_lines import repeated_lines, without_lines
from tidewire.session import read, scratch, spread

_HASHES = ("normalized_content_hash", "canonical_url_hash", "simhash64")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index is the history, filed as the store's first run; the events are one new batch."""
    store = HistoryRuns(spark, scratch(spark, "history"))
    store.append(read(spark, sf_dir, "dedup_index_v2").select(*_HASHES), "index", *_HASHES)
    return store.match(read(spark, sf_dir, "raw_intel_event").select("event_id", *_HASHES), "event_id", *_HASHES)


def _sourced(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "raw_intel_event").where("source_category <> 'funding' or source_category is null")
    return rows.select("event_id", "event_ord", "source_id", "body")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_lines(_sourced(spark, sf_dir), "event_id", "source_id", "body", "event_ord")


def p5_clean_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _sourced(spark, sf_dir)
    drop = repeated_lines(rows, "event_id", "source_id", "body", "event_ord")
    return without_lines(rows.select("event_ord", "event_id", "body"), drop, "event_id", "body")


def _stories(spark: SparkSession, sf_dir: str) -> NearDuplicates:
    rows = read(spark, sf_dir, "raw_intel_event").where("source_category <> 'funding' or source_category is null").select("event_id", "event_ord", "title", "body")
    return NearDuplicates(spread(rows), "event_id", "event_ord", F.concat_ws("\n", "title", "body"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stories(spark, sf_dir).all_pairs()


def p1_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stories(spark, sf_dir).classes()


QUERIES = {"p1_found": p1_found, "p1_groups": p1_groups, "p2_found": p2_found, "p5_found": p5_found, "p5_clean_bodies": p5_clean_bodies}

_BARE = "lower(regexp_replace({0}, '^\\s+|\\s+$', '', 'g'))"
_HEX = f"regexp_replace({_BARE}, '^((sha256:)|(0x))?0*', '')"
_OK = f"regexp_full_match({_BARE}, '(sha256:|0x)?[0-9a-f]+')"
_EMPTY = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def _norm(col: str) -> str:
    return f"CASE WHEN {_OK.format(col)} THEN {_HEX.format(col)} END"


_LINES = """
ev AS (SELECT event_id, any_value(source_id) AS source_id, any_value(body) AS body FROM raw_intel_event
  WHERE coalesce(source_category, '') <> 'funding' AND body IS NOT NULL AND source_id IS NOT NULL GROUP BY event_id),
ln AS (SELECT event_id, source_id, unnest(string_split(body, chr(10))) AS line, unnest(range(1, len(string_split(body, chr(10))) + 1)) AS line_no FROM ev),
k AS (SELECT event_id, source_id, line_no, lower(regexp_replace(line, '[^\\p{L}]+', '', 'g')) AS key FROM ln),
often AS (SELECT source_id, key FROM k WHERE key <> '' GROUP BY ALL HAVING count(DISTINCT event_id) >= 5),
hit AS (SELECT event_id, line_no::INTEGER AS line_no FROM k JOIN often USING (source_id, key))"""

SQL = {
    "p2_found": f"""WITH ev AS (SELECT event_id, {_norm('normalized_content_hash')} AS c, {_norm('canonical_url_hash')} AS u, {_norm('simhash64')} AS s FROM raw_intel_event),
ix AS (SELECT {_norm('normalized_content_hash')} AS c, {_norm('canonical_url_hash')} AS u, {_norm('simhash64')} AS s FROM dedup_index_v2),
sa AS (SELECT DISTINCT s, ('0x' || s)::UBIGINT AS b FROM ev WHERE s <> '' AND length(s) <= 16),
sb AS (SELECT DISTINCT ('0x' || s)::UBIGINT AS b FROM ix WHERE s <> '' AND length(s) <= 16),
near AS (SELECT DISTINCT sa.s FROM sa, sb WHERE bit_count(xor(sa.b, sb.b)) <= 4)
SELECT event_id FROM ev JOIN (SELECT DISTINCT c FROM ix WHERE c <> '{_EMPTY}') USING (c)
UNION SELECT event_id FROM ev JOIN (SELECT DISTINCT u FROM ix) USING (u)
UNION SELECT event_id FROM ev JOIN near USING (s)""",
    "p5_found": f"WITH {_LINES} SELECT event_id, line_no FROM hit",
    "p5_clean_bodies": f"""WITH {_LINES}, d AS (SELECT event_id, list(line_no) AS gone FROM hit GROUP BY event_id)
SELECT event_ord, e.event_id, CASE WHEN gone IS NULL THEN body ELSE coalesce(array_to_string(list_filter(list_transform(range(1, len(string_split(body, chr(10))) + 1),
  lambda i: CASE WHEN list_contains(gone, i) THEN NULL ELSE string_split(body, chr(10))[i] END), lambda x: x IS NOT NULL), chr(10)), '') END AS body
FROM raw_intel_event e LEFT JOIN d USING (event_id) WHERE coalesce(source_category, '') <> 'funding'""",
}

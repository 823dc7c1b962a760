"""How events lie in storage: partitioned JSON lines with locators, index shards, manifest, outbox and its replay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewire.functions.text import hash_prefix, path_segment, utc_date, utc_hour

CHUNK = 1000


def json_line(*columns: str) -> Column:
    """One JSON object with nulls written out and keys in the order given."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def object_key(family: str, schema: str, date: Column, hour: Column, parts: list[tuple[str, Column]], part: Column) -> Column:
    middle = [x for name, value in parts for x in (F.lit(f"/{name}="), path_segment(value))]
    return F.concat(F.lit(f"{family}/schema={schema}/dt="), date, F.lit("/hour="), hour, *middle, F.lit("/part-"), F.lpad(part.cast("string"), 6, "0"), F.lit(".jsonl"))


#: Schemas in the keys of stored objects.
RAW, DEDUP_V1, DEDUP_V2, HEALTH, HEAL, COVERAGE, BALANCE, POINTER, MANIFEST, STATE = (
    "raw_intel_event_v1", "dedup_index_v1", "dedup_index_v2", "source_health_v1", "source_heal_event_v1", "source_coverage_v1", "source_balance_v1", "raw_intel_event_created_v2", "intel_l0_manifest_v1", "source_fetch_state_v1",
)
DIAGNOSTICS = {"source_health": ("source-health", HEALTH), "source_heal": ("source-heal", HEAL), "source_coverage": ("source-coverage", COVERAGE), "source_balance": ("source-balance", BALANCE)}


def stored_keys(ms: Column, run_id: Column, prefix: Column) -> dict[str, Column]:
    """Keys of a run's single objects by family; prefix is the shard of the index's second form."""
    first, date, hour = F.lit(1), utc_date(ms), utc_hour(ms)
    keys = {f: object_key(folder, schema, date, hour, [("run_id", run_id)], first) for f, (folder, schema) in (DIAGNOSTICS | {"dedup_index": ("dedup-index", DEDUP_V1)}).items()}
    keys |= {f"publish_outbox_{s}": object_key(f"publish-outbox/status={s}", POINTER, date, hour, [("run_id", run_id)], first) for s in ("published", "pending")}
    tail = F.concat(F.lit("/hour="), hour, F.lit("/run_id="), path_segment(run_id))
    keys["dedup_index_v2"] = F.concat(F.lit(f"dedup-index-v2/schema={DEDUP_V2}/dt="), date, F.lit("/hash_prefix="), path_segment(prefix), tail, F.lit("/part-000001.jsonl"))
    return keys | {"manifest": F.concat(F.lit(f"manifests/schema={MANIFEST}/dt="), date, tail, F.lit(".json"))}


def state_key(source_id: Column) -> Column:
    return F.concat(F.lit(f"source-fetch-state/schema={STATE}/source_id="), path_segment(source_id), F.lit("/state.json"))


def valid_key(key: Column) -> Column:
    """Whether a key can be stored under: not blank, no leading slash, no empty or dotted part, no control character, 1024 bytes at most."""
    return F.coalesce((F.trim(key) != "") & (F.octet_length(key) <= 1024) & ~key.startswith("/") & ~key.rlike(r"[\x00-\x1F\x7F]|//|(?:^|/)\.\.?(?:/|$)"), F.lit(False))


def write_single(df: DataFrame, path: str, family: str, key: str) -> tuple[str, str, int, int] | None:
    """One JSON-lines object below path/key, for records of bounded number (of sources or assets); (family, key, records, bytes) for
    the manifest, or nothing, and no object, where there are no records. Written again it replaces what was there."""
    lines = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))
    n, size = lines.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("value") + 1), F.lit(0))).first()
    if not n:
        return None
    lines.coalesce(1).write.mode("overwrite").text(f"{path}/{key}")
    return family, key, n, size


def write_diagnostics(path: str, run_id: str, at_ms: int, records: dict[str, DataFrame]) -> list[tuple[str, str, int, int]]:
    """Objects of health, heal, coverage and balance records, written in this order; families without records have none."""
    spark = next(iter(records.values())).sparkSession
    keys = spark.range(1).select(*[k.alias(f) for f, k in stored_keys(F.lit(at_ms), F.lit(run_id), F.lit("")).items()]).first()
    done = [write_single(records[f], path, f, keys[f]) for f in DIAGNOSTICS if f in records]
    return [d for d in done if d]


def index_v1(events: DataFrame) -> DataFrame:
    """Records of the index's first form, one an event."""
    return events.select(F.lit(DEDUP_V1).alias("schema_version"), "dedup_key", "event_id", "source_id", "content_hash", "observed_at_ms")


def locate(lines: DataFrame, groups: list[str], order: str, line: str, chunk: int = CHUNK) -> DataFrame:
    """Adds part (from 1), line_number, byte_offset, byte_length and content_sha256 of each line, lines of a group in order, `chunk`
    to an object. Groups are as many as dates, hours and sources; each is sorted within its partition, not gathered in memory."""
    by = Window.partitionBy(*groups).orderBy(order)
    df = lines.withColumn("__rn", F.row_number().over(by) - 1)
    df = df.withColumns({"part": (F.floor(F.col("__rn") / chunk) + 1).cast("int"), "line_number": (F.col("__rn") % chunk + 1).cast("bigint"), "byte_length": F.octet_length(line).cast("bigint")})
    before = Window.partitionBy(*groups, "part").orderBy("__rn").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum(F.col("byte_length") + 1).over(before), F.lit(0).cast("bigint"))
    return df.withColumns({"byte_offset": offset, "content_sha256": F.concat(F.lit("sha256:"), F.sha2(line, 256))}).drop("__rn")


def event_partitions(df: DataFrame, ms: str) -> DataFrame:
    return df.withColumns({"dt": utc_date(F.col(ms)), "hour": utc_hour(F.col(ms))})


def write_json_lines(df: DataFrame, path: str, partitions: list[str], per_file: int = CHUNK) -> None:
    """Partitioned JSON lines, at most per_file records a file; a run that is repeated replaces the partitions it writes."""
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", per_file).option("ignoreNullFields", "false").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partitions).json(path)


def shards(df: DataFrame, exact: str = "exact_source_key", url: str = "canonical_url_hash", content: str = "normalized_content_hash") -> DataFrame:
    """One copy of an index record for each distinct two-digit prefix of its three hashes; null hashes have none."""
    prefixes = F.array_distinct(F.filter(F.array(*[hash_prefix(F.col(c)) for c in (exact, url, content)]), lambda x: x.isNotNull()))
    return df.withColumn("hash_prefix", F.explode(prefixes))


def manifest(objects: DataFrame, run_id: str, publish_error: str | None = None) -> DataFrame:
    """One row: the run's status, counts and uploaded objects (family, key, records, bytes) in order of key; zero objects give one too.
    A run whose pointers could not be published has a manifest that says so."""
    x = F.struct("object_family", "object_key", "record_count", "byte_count")
    return objects.agg(
        F.lit(run_id).alias("run_id"), F.lit("success" if publish_error is None else "publish_failed").alias("status"), F.count(F.lit(1)).alias("uploaded_object_count"), F.coalesce(F.sum("record_count"), F.lit(0)).alias("record_count"),
        F.array_sort(F.collect_list(x)).alias("uploaded_objects"),
    )


def replay(lines: DataFrame, line: str) -> DataFrame:
    """Adds status to outbox lines: blank, invalid_json, missing_event_id or payload, and event_id of the last."""
    event_id = F.get_json_object(line, "$.event_id")
    parsed = F.try_parse_json(line)
    status = F.when(F.trim(line) == "", "blank").when(F.col(line).isNull(), "blank").when(parsed.isNull(), "invalid_json").when(F.coalesce(F.trim(event_id), F.lit("")) == "", "missing_event_id").otherwise("payload")
    return lines.withColumns({"status": status, "replayed_event_id": F.when(status == "payload", event_id)})

"""Nulls in any column, empty tables, repeated rows and extra columns whose names the operators also use."""

from pyspark.sql import functions as F

from tidewire.functions.instants import to_instants
from tidewire.operators.decisions import decide
from tidewire.operators.delivery import SeenStore, redeliveries
from tidewire.operators.lateness import event_fates, period_figures
from tidewire.session import scratch


def clashing(df, *names):
    return df.withColumns({n: F.lit(7) for n in names})


def test_instants(spark):
    df = spark.createDataFrame([("2024-01-01", "UTC"), (None, "UTC"), ("2024-01-01", None), ("2024-01-01", "UTC")], "t string, z string")
    df = clashing(df, "__t", "__p", "__y", "__local_s", "__ms", "__z", "__zone", "__held", "x", "__row")
    out = to_instants(df, "t", "z", None)
    assert out.columns == [*df.columns, "published_ms", "published_ms_status"]
    assert sorted((r.published_ms or 0, r["__t"], r["__local_s"]) for r in out.collect()) == [(0, 7, 7), (0, 7, 7), (1704067200000, 7, 7), (1704067200000, 7, 7)]


def test_lateness(spark):
    df = clashing(spark.createDataFrame([("a", 0, 1, None), (None, 0, 1, 5), ("b", None, 1, 5), ("c", 0, None, 5), ("a", 0, 1, None)], "k string, p bigint, a bigint, v int"), "__key", "__at", "fate", "period_start_ms")
    assert sorted((str(r.k), r.fate) for r in event_fates(df, "k", "p", "a").collect()) == [("None", "on_time"), ("a", "on_time"), ("a", "on_time")]
    assert [(r.n_first, r.v_first) for r in period_figures(df, "k", "p", "a", "v").collect()] == [(3, 5)]


def test_delivery(spark):
    df = clashing(spark.createDataFrame([(1, "a", None), (2, "a", None), (3, None, None)], "delivery_id bigint, event_id string, created_at_ms bigint"), "id", "delivery", "shard", "code", "a")
    assert [r.delivery_id for r in redeliveries(df, SeenStore(spark, scratch(spark, "t")), "b").collect()] == [2]


def test_decisions(spark):
    rows = [(1, "e1", None, None, None, None), (2, "e2", None, None, None, None), (3, None, "k", "x", "n", 5), (4, "e4", "k", "x", "n", 5)]
    df = clashing(spark.createDataFrame(rows, "o bigint, event_id string, dedup_key string, exact_source_key string, normalized_content_hash string, bits bigint"), "ord", "content", "at", "fresh", "label")
    assert sorted((r.ord, r.dedup_decision) for r in decide(df, "o", "bits").collect()) == [(1, "new"), (2, "new"), (3, "new"), (4, "exact_duplicate")]

import pandas as pd
from pyspark.sql import functions as F

from tidewire.operators.delivery import SeenStore
from tidewire.operators.lateness import PeriodFigures
from tidewire.session import scratch
from tidewire.streaming.pipeline import corrected_figures, deliver_once, fetch_states, windowed_counts


def test_deliver_once_over_restarts(spark, tmp_path):
    src, out, check = (str(tmp_path / x) for x in ("src", "out", "check"))
    store = SeenStore(spark, scratch(spark, "stream"), shards=2)
    schema = "delivery_id bigint, event_id string, created_at_ms bigint"
    spark.createDataFrame([(1, "a", 1), (2, "A", 2), (3, "b", 1)], schema).write.parquet(src)
    deliver_once(spark.readStream.schema(schema).parquet(src), store, out, check).awaitTermination()
    spark.createDataFrame([(4, "a", 0), (5, "c", 1)], schema).write.mode("append").parquet(src)
    deliver_once(spark.readStream.schema(schema).parquet(src), store, out, check).awaitTermination()
    assert sorted(r.delivery_id for r in spark.read.parquet(out).collect()) == [1, 3, 5]


def test_retention(spark, tmp_path):
    src, out, check = (str(tmp_path / x) for x in ("src", "out", "check"))
    store = SeenStore(spark, scratch(spark, "stream"), shards=2)
    schema = "delivery_id bigint, event_id string, created_at_ms bigint"
    for n, ids in enumerate(("ab", "ac", "cb")):
        spark.createDataFrame([(10 * n + i, k, i) for i, k in enumerate(ids)], schema).write.mode("append").parquet(src)
        deliver_once(spark.readStream.schema(schema).parquet(src), store, out, check, retain=1, compact_every=2).awaitTermination()
    assert sorted(r.delivery_id for r in spark.read.parquet(out).collect()) == [0, 1, 11, 21]  # b comes again after its batch was forgotten


def test_corrected_figures(spark, tmp_path):
    src, out, check = (str(tmp_path / x) for x in ("src", "out", "check"))
    store, schema, hour = PeriodFigures(spark, scratch(spark, "figures")), "id string, p bigint, a bigint", 3_600_000
    for rows in ([("x", 5, 10), ("y", hour + 5, hour + 9)], [("z", 7, 3 * hour), ("w", 8, 40 * hour)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        corrected_figures(spark.readStream.schema(schema).parquet(src), store, "id", "p", "a", check, out).awaitTermination()
    got = {(r.batch, r.period_start_ms): (r.n_first, r.n_final, r.n_too_late) for r in spark.read.parquet(out).collect()}
    assert got == {(0, 0): (1, 1, 0), (0, hour): (1, 1, 0), (1, 0): (1, 2, 1)}


def run(spark, df, mode, name):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.sql(f"select * from {name}").collect()


def test_states(spark, tmp_path):
    src = str(tmp_path / "attempts")
    schema = "source_id string, at_ms bigint, outcome string, items_seen bigint"
    spark.createDataFrame([("s", 2000, "failure", 0), ("s", 1000, "failure", 0), ("s", 3000, "not_modified", 0), ("s", 4000, "success", 2), ("t", 5, "success", 0)], schema).coalesce(1).write.parquet(src)
    got = {(r.source_id, r.at_ms): (r.failure_count, r.unchanged_count, r.last_success_at_ms, r.backoff_until_ms) for r in run(spark, fetch_states(spark.readStream.schema(schema).parquet(src)), "append", "states")}
    assert got == {("s", 1000): (1, 0, None, 61000), ("s", 2000): (2, 0, None, 122000), ("s", 3000): (0, 1, 3000, None), ("s", 4000): (0, 0, 4000, None), ("t", 5): (0, 0, 5, None)}


def test_windows(spark, tmp_path):
    src = str(tmp_path / "w")
    df = spark.createDataFrame(pd.DataFrame({"t": pd.to_datetime(["2025-01-01 00:10", "2025-01-01 00:50", "2025-01-01 01:10"]), "k": ["a", "a", "a"]}))
    df.write.parquet(src)
    got = run(spark, windowed_counts(spark.readStream.schema(df.schema).parquet(src), "t", "1 hour", "2 hours", ["k"]).select(F.hour("window.start").alias("h"), "n"), "complete", "wins")
    assert {(r.h, r.n) for r in got} == {(0, 2), (1, 1)}

import random

from tidewire.operators.delivery import SeenStore, redeliveries
from tidewire.session import scratch

SCHEMA = "delivery_id bigint, event_id string, created_at_ms bigint, id string, bits int"


def test_one_batch(spark):
    rows = [(1, "A", 5, "x", 1), (2, " a ", 3, "x", 1), (3, "a", 3, "x", 1), (4, None, 1, "x", 1), (5, "  ", 1, "x", 1), (6, "b", None, "x", 1), (7, "B", 9, "x", 1), (8, "c", None, "x", 1), (9, "c", None, "x", 1)]
    store = SeenStore(spark, scratch(spark, "t"), shards=3)
    drop = redeliveries(spark.createDataFrame(rows, SCHEMA), store, "one")
    assert sorted(r.delivery_id for r in drop.collect()) == [1, 3, 6, 9]
    assert drop.columns == ["delivery_id", "event_id", "created_at_ms", "id", "bits"]
    assert store.seen_count() == 3


def test_batches_restart_and_hot_message(spark):
    store = SeenStore(spark, scratch(spark, "t"), shards=4)
    first = [(i, f"m{i % 50}", i, "", 0) for i in range(500)] + [(1000 + i, "hot", i, "", 0) for i in range(300)]
    second = [(5000 + i, f"m{i}", i, "", 0) for i in range(40, 70)] + [(6000, "hot", 0, "", 0)]
    a = redeliveries(spark.createDataFrame(first, SCHEMA), store, "a")
    kept_a = {r[0] for r in first} - {r.delivery_id for r in a.collect()}
    assert kept_a == {*range(50), 1000}
    b = redeliveries(spark.createDataFrame(second, SCHEMA), store, "b")
    kept_b = {r[0] for r in second} - {r.delivery_id for r in b.collect()}
    assert kept_b == {5000 + i for i in range(50, 70)}
    assert store.seen_count() == 71
    # the same batch again is answered as before
    again = redeliveries(spark.createDataFrame(second, SCHEMA), store, "b")
    assert {r.delivery_id for r in again.collect()} == {r.delivery_id for r in b.collect()}
    assert store.seen_count() == 71


def test_stretches_are_decided_by_the_bits_of_those_before(spark):
    r = random.Random(4)
    rows = [(i, f" M{r.randrange(60)} " if i % 3 else "hot", r.choice([None, 5, *range(200)]), "", 0) for i in range(900)]
    best = {}
    for d, k, o, *_ in rows:
        k = k.strip().lower()
        best[k] = min(best.get(k, (2**63, 0)), ((2**63 - 1) if o is None else o, d))
    want = {d for d, *_ in rows} - {d for _, d in best.values()}
    df = spark.createDataFrame(rows, SCHEMA)
    store = SeenStore(spark, scratch(spark, "t"), shards=3)
    got = {x.delivery_id for x in redeliveries(df, store, "all", stretches=4).collect()}
    assert got == want and store.seen_count() == 61

    class Blind(SeenStore):
        """A store whose bitmaps are always empty."""

        def bitmaps(self):
            return super().bitmaps().where("false")

    blind = {x.delivery_id for x in redeliveries(df, Blind(spark, scratch(spark, "t"), shards=3), "all", stretches=4).collect()}
    assert blind < want  # without them copies of later stretches are taken again
    same = spark.createDataFrame([(d, k, 7, "", 0) for d, k, *_ in rows], SCHEMA)
    assert redeliveries(same, SeenStore(spark, scratch(spark, "t")), "x", stretches=4).count() == 900 - 61


def test_compaction_and_retention(spark):
    store = SeenStore(spark, scratch(spark, "t"), shards=2)
    batch = lambda *ids: spark.createDataFrame([(i, f"m{i % 100}", i, "", 0) for i in ids], SCHEMA)
    taken = lambda df, b: {r.delivery for r in store.accept(df, b).collect()}
    assert taken(batch(1, 2), "a") == {1, 2} and taken(batch(102, 3), "b") == {3}
    store.compact()
    assert store.seen_count() == 3 and taken(batch(203, 4), "c") == {4}
    store.forget("a")
    assert store.seen_count() == 2 and taken(batch(101, 103), "d") == {101}
    store.compact()
    assert store.seen_count() == 3 and taken(batch(301, 304, 302), "e") == {302}


def test_a_batch_that_failed_leaves_no_trace(spark):
    store = SeenStore(spark, scratch(spark, "t"), shards=2)
    store.accept(spark.createDataFrame([(1, "x", 1, "", 0)], SCHEMA), "a")
    spark.createDataFrame([("y", 0, 99)], "id string, shard int, code bigint").write.parquet(f"{store.path}/codes/b")  # written, never put into effect
    spark.createDataFrame([(0, 99, 7)], "shard int, code bigint, delivery bigint").write.parquet(f"{store.path}/taken/b")
    got = store.accept(spark.createDataFrame([(2, "y", 1, "", 0), (3, "x", 1, "", 0)], SCHEMA), "b")
    assert [r.delivery for r in got.collect()] == [2]


def test_empty(spark):
    for stretches in (1, 4):
        store = SeenStore(spark, scratch(spark, "t"))
        assert redeliveries(spark.createDataFrame([], SCHEMA), store, "a", stretches=stretches).count() == 0
        assert store.seen_count() == 0

import glob
import random

import pytest
from pyspark.sql import functions as F

from tidewire.llm import history
from tidewire.llm.history import ARRANGEMENTS, BLOCKS, EMPTY_SHA256, HistoryRuns, hex_number
from tidewire.session import scratch

SCHEMA = "event_id string, c string, u string, s string, kind int, value int"
HEX = "ab" * 32


def test_numbers(spark):
    cases = [("00AB", "ab"), (" 0xAb\n", "ab"), ("sha256:00ab", "ab"), ("SHA256:AB", "ab"), ("0", "0"), ("0x000", "0"), ("", None), (None, None), ("-", None), ("nan", None), ("zz12", None), ("12 34", None), ("xyz:12", "12")]
    got = [r[0] for r in spark.createDataFrame([(i, a) for i, (a, _) in enumerate(cases)], "i int, a string").orderBy("i").select(hex_number(F.col("a"))).collect()]
    assert got == [b for _, b in cases]
    df = spark.createDataFrame([("ffffffffffffffff",), ("0",), ("1" + "0" * 16,), ("000000000000000000001",)], "s string").selectExpr("s", "cast(null as string) c", "cast(null as string) u")
    assert [r[0] for r in history.keyed(history.values(df, "c", "u", "s"), {}).where("kind = 2").select("bits").collect()] == [-1, 1]


def test_blocks_cover_all_bits():
    assert sum(n for _, n in BLOCKS) == 64 and len(ARRANGEMENTS) == 15


def simhashes(spark, values):
    return spark.createDataFrame([(f"{x:x}", None, None, f"{x:016x}", 0, 0) for x in sorted(set(values))], SCHEMA)


@pytest.mark.parametrize("hot", [20_000, 3])
def test_near_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(history, "HOT", hot)
    rnd = random.Random(5)
    old = [rnd.getrandbits(64) | 1 for _ in range(300)] + [(0xABC << 52 | 0x123 << 30) ^ rnd.getrandbits(28) for _ in range(60)]
    new = [o ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(0, 8))) for o in old] + [rnd.getrandbits(64) for _ in range(200)]
    store = HistoryRuns(spark, scratch(spark, "runs"), ranges=3)
    store.append(simhashes(spark, old[:150]), "a", "c", "u", "s")
    store.append(simhashes(spark, old[150:]), "b", "c", "u", "s")
    for most in (4, 0):
        want = {f"{a:x}" for a in set(new) if any((a ^ b).bit_count() <= most for b in old)}
        assert {r[0] for r in store.match(simhashes(spark, new), "event_id", "c", "u", "s", most).collect()} == want
    with pytest.raises(ValueError):
        store.match(simhashes(spark, new), "event_id", "c", "u", "s", 5)


def batches():
    old = [("h1", HEX, "aa", "ff00ff00ff00ff00", 0, 0), ("h2", "sha256:" + "CD" * 32, None, "0x0F0F0F0F0F0F0F0F", 0, 0), ("h3", EMPTY_SHA256, "", "0", 0, 0), ("h4", None, "-", "nan", 0, 0)]
    new = [("same", HEX.upper(), None, None, 0, 0), ("url", "11", "0xAA", "", 0, 0), ("near", None, None, "ff00ff00ff00ff0f", 0, 0), ("far", None, None, "ff00ff00ff00ff3f", 0, 0), ("empty", EMPTY_SHA256, None, "0000000000000000", 0, 0),
           ("other", "cd" * 32, None, None, 0, 0), ("none", None, "-", "nan", 0, 0), (None, HEX, None, None, 0, 0), ("same", HEX, None, None, 0, 0)]
    return old, new


def test_windows_that_go_over_arrow_batches():
    import pyarrow as pa

    rnd = random.Random(1)
    rows = sorted((k, 0, rnd.randrange(40) << 55 | rnd.getrandbits(14), rnd.random() < 0.3) for k in (2, 5) for _ in range(400))
    batch = lambda part: pa.record_batch([pa.array([r[0] for r in part], pa.int32()), pa.array([r[1] for r in part], pa.int32()), pa.array([r[2] for r in part]), pa.array([None] * len(part), pa.string()), pa.array([r[2] if r[3] else None for r in part], pa.int64()), pa.array([r[3] for r in part])], names=["kind", "salt", "key", "value", "bits", "fresh"])
    want = {(k, str(a)) for k, _, a, f in rows if f and any(k == q and not g and (a ^ b).bit_count() <= 4 and a >> 42 == b >> 42 for q, _, b, g in rows)}
    for size, most in ((800, 10**6), (7, 50), (64, 1)):
        found = history._compare(iter(batch(rows[i : i + size]) for i in range(0, len(rows), size)), 4, most)
        assert {x for b in found for x in zip(b.column(0).to_pylist(), b.column(1).to_pylist())} == want and len(want) > 20


def match(store, df):
    return sorted(r[0] for r in store.match(df, "event_id", "c", "u", "s").collect())


def test_matches(spark):
    old, new = (spark.createDataFrame(x, SCHEMA) for x in batches())
    store = HistoryRuns(spark, scratch(spark, "runs"))
    assert match(store, new) == []
    store.append(old.limit(0), "none", "c", "u", "s")
    assert match(store, new) == [] == match(store, new.limit(0))
    store.append(old, "all", "c", "u", "s")
    assert match(store, new) == ["near", "other", "same", "url"] and match(store, new.limit(0)) == []


def test_runs(spark):
    old, new = (spark.createDataFrame(x, SCHEMA) for x in batches())
    store = HistoryRuns(spark, scratch(spark, "runs"), ranges=2, compact_after=4)
    store.append(old.where("event_id in ('h1', 'h4')"), "r1", "c", "u", "s")
    assert match(store, new) == ["near", "same", "url"]
    store._write(history.keyed(history.values(old, "c", "u", "s"), store._bounds()), "r2")  # broken off before its marker
    assert match(store, new) == ["near", "same", "url"]
    store.append(old, "r2", "c", "u", "s")
    store.append(old, "r2", "c", "u", "s")
    assert match(store, new) == ["near", "other", "same", "url"] and store.runs() == ["r1", "r2"]
    many = store.table().count()
    store.compact()
    assert match(store, new) == ["near", "other", "same", "url"] and store.table().count() < many and len(store.runs()) == 1
    for r in ("r3", "r4", "r5"):
        store.append(simhashes(spark, [int(r[1]) << 60 | 5]), r, "c", "u", "s")
    assert len(store.runs()) == 1  # merged when four had come together
    assert match(store, simhashes(spark, [3 << 60 | 7, 9 << 60 | 3 << 20])) == [f"{3 << 60 | 7:x}"]


def test_a_batch_opens_only_its_ranges(spark):
    rnd = random.Random(2)
    store = HistoryRuns(spark, scratch(spark, "runs"), ranges=4)
    store.append(simhashes(spark, [rnd.getrandbits(64) | 1 for _ in range(400)]), "a", "c", "u", "s")
    ranges = store.table().select("range").distinct().count()
    one = [r[0] for r in history.keyed(history.values(simhashes(spark, [12345]), "c", "u", "s"), store._bounds()).select("range").collect()]
    assert ranges == 60 and len(one) == 15
    for folder in glob.glob(f"{store.path.removeprefix('file:')}/runs/a/range=*"):
        if int(folder.split("=")[1]) not in one:
            for f in glob.glob(f"{folder}/*.parquet"):
                open(f, "w").write("not to be read")
    assert match(store, simhashes(spark, [12345])) == []
    assert all(len(v) == 3 for k, v in store._bounds().items())


def test_batches_are_taken_in_turn(spark):
    rnd = random.Random(9)
    store, before = HistoryRuns(spark, scratch(spark, "runs"), ranges=2, compact_after=2), []
    for name in "abc":
        now = [rnd.choice(before) ^ (1 << rnd.randrange(64)) if before and rnd.random() < 0.5 else rnd.getrandbits(64) | 1 for _ in range(30)]
        want = {f"{x:x}" for x in now if any((x ^ b).bit_count() <= 4 for b in before)}
        for _ in range(2):  # a batch that is taken again finds what it found, not itself
            assert {r[0] for r in store.take(simhashes(spark, now), name, "event_id", "c", "u", "s").collect()} == want
        before += now
    assert want

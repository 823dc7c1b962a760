import random

from tidewire.llm import repeated_lines as module
from tidewire.llm.repeated_lines import CONTAINER, LineBitmaps, repeated_lines, without_lines
from tidewire.session import scratch

SCHEMA = "event_id string, source_id string, body string, event_ord bigint, line_no int"


def brute(rows, least):
    first = {}
    for e, s, b, o, _ in rows:
        if e is not None and s is not None and b is not None and (e not in first or o < first[e][2]):
            first[e] = (s, b, o)
    at = {}
    for e, (s, b, _) in first.items():
        for i, line in enumerate(b.split("\n"), 1):
            key = "".join(c for c in line if c.isalpha()).lower()
            if key:
                at.setdefault((s, key), []).append((e, i))
    return {x for v in at.values() if len({e for e, _ in v}) >= least for x in v}


def test_against_brute_force(spark):
    rnd = random.Random(2)
    pool = ["Share this", "share THIS!!", "— Share this —", "Legal notice 1", "legal notice 22", "", "   ", "12:30", "Über uns", "über-uns", "저작권", "x" * 5000]
    rows = []
    for i in range(400):
        body = "\n".join(rnd.choice(pool) if rnd.random() < 0.3 else f"unique {i} {''.join(rnd.choice('abcdefgh') for _ in range(12))}" for _ in range(rnd.randrange(0, 9)))
        rows.append((f"e{i}", rnd.choice(["a", "b", None]) if i % 7 else "c", body if i % 31 else None, i * (CONTAINER // 3), 0))
    rows += [(rows[3][0], rows[3][1], rows[3][2], 10**9, 0), (None, "a", "Share this", 10**9 + 1, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = [(r.event_id, r.line_no) for r in repeated_lines(df, "event_id", "source_id", "body", "event_ord").collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows, 5)


def test_hot_line_dense_container(spark):
    rows = [(f"e{i}", "s", f"hot line\nown {'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyzabcd'[i // 100 % 10]}{'efghijklmn'[i // 1000]}", i, 0) for i in range(3000)]
    got = repeated_lines(spark.createDataFrame(rows, SCHEMA), "event_id", "source_id", "body", "event_ord")
    assert {(r.event_id, r.line_no) for r in got.collect()} == {(f"e{i}", 1) for i in range(3000)}


def test_bodies_and_empty(spark):
    rows = [(f"e{i}", "s", f"same\n\nown {'abcdefg'[i]}\r", i, 0) for i in range(5)] + [("n", "s", None, 9, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = without_lines(df, repeated_lines(df, "event_id", "source_id", "body", "event_ord"), "event_id", "body")
    assert {(r.event_id, r.body) for r in out.collect()} == {(f"e{i}", f"\nown {'abcdefg'[i]}\r") for i in range(5)} | {("n", None)}
    assert repeated_lines(df.limit(0), "event_id", "source_id", "body", "event_ord").count() == 0


def test_variants_unite_and_batches_add_up(spark, monkeypatch):
    # two variants in one document are one document; five documents over two batches are enough
    rows = [(f"e{i}", "s", "Share this\nSHARE, this!\nown " + "abcdefgh"[i], i, 0) for i in range(4)] + [("e4", "s", "share 4 this", 4, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    store = LineBitmaps(spark, scratch(spark, "lines"))
    store.add(df.where("event_ord < 4"), "a", "event_id", "source_id", "body", "event_ord")
    assert store.find(5, "event_id").count() == 0  # eight occurrences in four documents
    store.add(df.where("event_ord = 4"), "b", "event_id", "source_id", "body", "event_ord")
    got = {(r.event_id, r.line_no) for r in store.find(5, "event_id").collect()}
    assert got == {(f"e{i}", n) for i in range(4) for n in (1, 2)} | {("e4", 1)}
    assert {tuple(r) for r in store.find(5, "event_id", ["b"]).collect()} == {("e4", 1)}
    # the bitmaps decide: without their bits nothing is deleted
    monkeypatch.setattr(module, "united", lambda boxes, real=module.united: real(boxes.where("false")))
    assert store.find(5, "event_id").count() == 0

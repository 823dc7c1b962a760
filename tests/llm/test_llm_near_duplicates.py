import random
from collections import Counter
import re

import numpy as np
from pyspark.sql import functions as F

from tidewire.llm import near_duplicates as module
from tidewire.llm.near_duplicates import NearDuplicates, WordHashes, _elements, most_differing

WORDS = [f"w{i}" for i in range(900)]


def jaccard(a: str, b: str) -> float:
    x, y = (Counter(re.findall(r"[^\W_]+", t.lower())) for t in (a, b))
    return sum((x & y).values()) / sum((x | y).values())


def corpus(seed=1, families=25, per=4):
    rnd, out = random.Random(seed), []
    for f in range(families):
        base = [rnd.choice(WORDS) for _ in range(rnd.randrange(60, 160))]
        for k in range(per):
            text = base[:]
            for _ in range(rnd.choice([0, 1, 3, 6])):
                text[rnd.randrange(len(text))] = rnd.choice(WORDS)
            if k % 2:
                rnd.shuffle(text)
            out.append((f"d{f}_{k}", len(out), " ".join(text)))
    return out


def pairs_of(spark, rows, **kw):
    df = spark.createDataFrame(rows, "k string, o bigint, t string, id int" if len(rows) and len(rows[0]) == 4 else "k string, o bigint, t string")
    return {(r[0], r[1]) for r in NearDuplicates(df, "k", "o", F.col("t"), **kw).all_pairs().collect()}


def test_against_brute_force(spark):
    rows = corpus()
    want = {(min(a[0], b[0]), max(a[0], b[0])) for i, a in enumerate(rows) for b in rows[:i] if jaccard(a[2], b[2]) >= 0.75}
    got = pairs_of(spark, rows)
    assert got <= want  # candidates are verified exactly
    assert len(got) >= 0.97 * len(want) and len(want) > 60


def test_copies_hot_group_nulls_repeats_and_extra_columns(spark):
    same = " ".join(WORDS[:50])
    rows = [(f"c{i:03d}", i, same, 0) for i in range(40)] + [("c000", 100, same, 0), (None, 101, same, 0), ("n", 102, None, 0), ("e", 103, "", 0), ("short", 104, "a b c", 0), ("long", 105, "long word " * 20_000, 0)]
    got = pairs_of(spark, rows)
    assert got == {(f"c{i:03d}", f"c{j:03d}") for j in range(40) for i in range(j)}
    assert pairs_of(spark, [])  == set()


def test_a_big_bucket_is_whole(spark):
    rnd = random.Random(4)
    base = [rnd.choice(WORDS) for _ in range(100)]
    rows = [(f"v{i:02d}", i, " ".join(base + [f"x{i}"])) for i in range(30)]
    assert len(pairs_of(spark, rows)) == 30 * 29 // 2


def test_elements_are_multiset_elements():
    h, n = _elements(["b a b", "a b b b", ""], WordHashes())
    assert n.tolist() == [3, 4, 0]
    first, second = set(h[:3].tolist()), set(h[3:].tolist())
    assert len(first) == 3 and len(second) == 4 and first <= second
    assert 20 < most_differing(0.75) < 40 and isinstance(most_differing(0.9), int) and np.isfinite(most_differing(1.0)) and most_differing(0.8, None) == 64


def test_groups(spark):
    rnd = random.Random(9)
    base = [rnd.choice(WORDS) for _ in range(100)]
    steps = [base]
    for k in range(3):
        steps.append(steps[-1][:])
        for i in range(9):
            steps[-1][k * 20 + i] = f"new{k}{i}"
    rows = [(f"s{i}", i, " ".join(t)) for i, t in enumerate(steps)] + [("copy", 10, " ".join(reversed(base))), ("alone", 11, " ".join(rnd.choice(WORDS) for _ in range(80)))]
    df = spark.createDataFrame(rows, "k string, o bigint, t string")
    got = {r.k: r.class_id for r in NearDuplicates(df, "k", "o", F.col("t")).classes().collect()}
    assert got == {"s0": 0, "s1": 0, "s2": 0, "s3": 0, "copy": 0, "alone": 11}
    assert NearDuplicates(df.limit(0), "k", "o", F.col("t")).classes().count() == 0


def test_classes_are_those_of_all_links(spark):
    rows = corpus(seed=5, families=20, per=6)
    found = NearDuplicates(spark.createDataFrame(rows, "k string, o bigint, t string"), "k", "o", F.col("t"))
    root = {o: o for _, o, _ in rows}
    links = [(r.no_a, r.no_b) for r in found.links().collect()]
    for _ in range(8):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    rep = {r.no: r.rep for r in found.members.collect()}
    assert {r.k: r.class_id for r in found.classes().collect()} == {k: root[rep[o]] for k, o, _ in rows}


def test_a_third_of_all_records_in_one_class(spark, monkeypatch):
    monkeypatch.setattr(module, "HOT", 100)
    monkeypatch.setattr(module, "WIDE", 20)
    rnd = random.Random(6)
    base = [rnd.choice(WORDS) for _ in range(80)]
    rows = []
    for i in range(1200):
        text = base[:] if i % 3 == 0 else [rnd.choice(WORDS) for _ in range(80)]
        if i % 3 == 0:
            text[rnd.randrange(80)] = f"own{i}"
        rows.append((f"d{i}", i, " ".join(text)))
    found = NearDuplicates(spark.createDataFrame(rows, "k string, o bigint, t string"), "k", "o", F.col("t"))
    stars = found._candidates.stars().count()
    assert stars < 20 * 400  # all pairs are 79 800
    got = {r.k: r.class_id for r in found.classes().collect()}
    assert got == {f"d{i}": 0 if i % 3 == 0 else i for i in range(1200)}
    one = __import__("tidewire.operators.decisions", fromlist=["components"]).components(found._verified(found._candidates.stars()).selectExpr("no_a as a", "no_b as b"))
    assert found._candidates.across(one).count() < 400
    small = spark.createDataFrame(rows[:300], "k string, o bigint, t string")
    want = {(min(a[0], b[0]), max(a[0], b[0])) for i, a in enumerate(rows[:300]) for b in rows[:i] if jaccard(a[2], b[2]) >= 0.75}
    assert {tuple(r) for r in NearDuplicates(small, "k", "o", F.col("t")).all_pairs().collect()} == want and len(want) == 4950

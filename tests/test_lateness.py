import random

from hypothesis import given, settings
from hypothesis import strategies as st

from tidewire.operators import lateness
from tidewire.operators.lateness import CORRECTION, FIRST, REFUSED, FingerTree, PeriodFigures, event_fates, period_figures
from tidewire.session import scratch

H = 3_600_000


def held(tree, node=None):
    """Whether every partial that a node holds is that of its subtree, and the spine leads to the last leaf."""
    node = node or tree.root
    assert all(a.kids[-1] is b for a, b in zip(tree.spine, tree.spine[1:])) and tree.spine[-1].leaf
    for key, kid, agg in zip(node.keys, node.kids, node.aggs):
        assert kid.keys[0] == key and len(kid.keys) <= lateness.ARITY and (agg is None or agg == tree._sum(kid))
        held(tree, kid)


@given(st.lists(st.tuples(st.integers(0, 900), st.integers(-5, 5)), max_size=700), st.booleans(), st.lists(st.integers(0, 920), max_size=4), st.integers(0, 900), st.integers(0, 900))
@settings(max_examples=120, deadline=None)
def test_tree_against_a_dictionary(adds, rising, cuts, low, high):
    tree, want, floor = FingerTree(2), {}, None
    cuts = sorted(cuts)
    for i, (key, v) in enumerate(sorted(adds) if rising else adds):
        if cuts and i * (len(cuts) + 1) > len(adds):
            floor = cuts.pop(0)
            assert dict(tree.evict_below(floor)) == {k: x for k, x in want.items() if k < floor}
            tree.issue_below(floor + 50)
            want = {k: x for k, x in want.items() if k >= floor}
        fate = REFUSED if floor is not None and key < floor else CORRECTION if floor is not None and key < floor + 50 else FIRST
        assert tree.add(key, (v, 1), (v, 100)) == fate
        if fate != REFUSED:
            a = want.get(key, (0, 0))
            want[key] = (a[0] + v, a[1] + (100 if fate == CORRECTION else 1))
    held(tree)
    assert list(tree.items()) == sorted(want.items())
    inside = [x for k, x in want.items() if low <= k < high]
    assert tree.total(low, high) == (sum(a for a, _ in inside), sum(b for _, b in inside))


def test_an_insert_at_the_finger_touches_one_leaf():
    tree = FingerTree(1)
    for k in range(2000):
        tree.add(k, (1,))
    assert len(tree.spine) > 2
    inner = [n for n in tree.spine if not n.leaf]
    before = [list(n.aggs) for n in inner]
    tree.add(1999, (5,))
    assert [list(n.aggs) for n in inner] == before and all(n.aggs[-1] is None for n in inner)
    tree.add(3, (5,))
    assert inner[0].aggs[0] != before[0][0] and tree.total(0, 2000) == (2010,)


def test_fates_are_the_answers_of_the_tree(monkeypatch):
    import pyarrow as pa

    rows = [pa.record_batch([pa.array(["a", "b", "c", "d"]), pa.array([0, 0, 0, 30 * H]), pa.array([H, 3 * H, 30 * H, 30 * H]), pa.array([1, 1, 1, 1])], names=["k", "p", "a", "v"])]
    fates = lambda: [f for b in lateness._run(iter(rows), "fates", H, 900_000, 24 * H) for f in b.column(2).to_pylist()]
    assert fates() == [FIRST, CORRECTION, REFUSED, FIRST]
    monkeypatch.setattr(FingerTree, "evict_below", lambda self, key: [])
    assert fates() == [FIRST, CORRECTION, CORRECTION, FIRST]
    monkeypatch.setattr(FingerTree, "issue_below", lambda self, key: None)
    assert fates() == [FIRST] * 4


def test_fates_and_figures(spark):
    rnd = random.Random(3)
    rows = [(f"e{i}", rnd.choice([None, 10 * H + rnd.randrange(40 * H)]), 0, 1) for i in range(3000)]
    rows = [(k, p, None if rnd.random() < 0.02 else (p or 0) + rnd.choice([-H, 0, 5 * 60_000, H, 2 * H, 20 * H, 26 * H]), v) for k, p, _, v in rows]
    rows += [("edge_on", 10 * H, 11 * H + 900_000, 1), ("edge_late", 10 * H, 11 * H + 900_001, 1), ("edge_last", 10 * H, 35 * H, 1), ("edge_out", 10 * H, 35 * H + 1, 1)]
    df = spark.createDataFrame(rows, "id string, p bigint, a bigint, v int").repartition(4)

    def fate(p, a):
        end = p // H * H + H
        return "on_time" if a <= end + 900_000 else "corrects" if a <= end + 24 * H else "too_late"

    want = {k: fate(p, a) for k, p, a, _ in rows if p is not None and a is not None}
    assert {r.id: r.fate for r in event_fates(df, "id", "p", "a").collect()} == want
    assert [want[k] for k in ("edge_on", "edge_late", "edge_last", "edge_out")] == ["on_time", "corrects", "corrects", "too_late"]
    hours = {}
    for k, p, a, v in rows:
        if k in want:
            h = hours.setdefault(p // H * H, [0, 0, 0])
            h[0] += want[k] == "on_time"
            h[1] += want[k] != "too_late"
            h[2] += want[k] == "too_late"
    got = {r.period_start_ms: [r.n_first, r.n_final, r.n_too_late] for r in period_figures(df, "id", "p", "a", "v").collect()}
    assert got == hours
    assert all(r.v_first == r.n_first and r.v_final == r.n_final for r in period_figures(df, "id", "p", "a", "v").collect())


def test_empty(spark):
    df = spark.createDataFrame([], "id string, p bigint, a bigint")
    assert event_fates(df, "id", "p", "a").count() == 0
    assert period_figures(df, "id", "p", "a").count() == 0


def test_figures_carried_over_batches(spark):
    r = random.Random(8)
    rows = sorted([(f"e{i}", p := 10 * H + r.randrange(90 * H), p + r.choice([0, 5 * 60_000, 2 * H, 20 * H, 26 * H, 40 * H]), r.randrange(9)) for i in range(1500)], key=lambda x: x[2])
    df = lambda part: spark.createDataFrame(part, "id string, p bigint, a bigint, v int")
    store = PeriodFigures(spark, scratch(spark, "figures"))
    for n, at in enumerate(range(0, 1500, 500)):
        changed = store.take(df(rows[at : at + 500]), f"b{n}", "id", "p", "a", "v")
        sofar = {x.period_start_ms: x for x in period_figures(df(rows[: at + 500]), "id", "p", "a", "v").collect()}
        touched = {p // H * H for _, p, *_ in rows[at : at + 500]}
        assert {x.period_start_ms: x for x in changed.collect()} == {k: sofar[k] for k in touched}
    assert {x.period_start_ms: x for x in store.figures().collect()} == sofar
    assert {x.period_start_ms for x in store.take(df([]), "b2", "id", "p", "a", "v").collect()} == touched  # answered as before
    assert store.take(df([]), "b3", "id", "p", "a", "v").count() == 0 and store.figures().count() == len(sofar)
    assert store._open("open", ["b2"]).count() < len(sofar)  # closed periods are not carried on

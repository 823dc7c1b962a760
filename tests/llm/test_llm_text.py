import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewire.llm.byte_bpe import Codec, default_vocabulary, encode_texts, read_ranks, serialise
from tidewire.session import scratch
from tidewire.llm.leakage import CorpusIndex, FMIndex, PHRASE, leaks, plain_words, suffix_order
from tidewire.llm.reading_level import labelled_features, nested_error, Trees, best_cut, features, fit_grader, isotonic, learn, reading_levels


@pytest.fixture(scope="module")
def codec():
    return Codec(serialise(read_ranks(default_vocabulary())))


@pytest.fixture(scope="module")
def reference():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(default_vocabulary().replace(".tiktoken", ".json"))
    t.encode_special_tokens = True
    return t


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_codec_equals_the_library_and_inverts(codec, reference, text):
    ids = codec.encode(text)
    assert ids == reference.encode(text, add_special_tokens=False).ids
    assert codec.decode(ids) == text


@pytest.mark.parametrize("text", ["", " ", "<|endoftext|>", "a\x1c b\x85c d", "x" * 3000, "ab" * 3000, "I'VE don't 've", "नमस्ते 🙂👩‍👩‍👧", "\r\n\r\n\t x"])
def test_codec_odd_texts(codec, reference, text):
    assert codec.encode(text) == reference.encode(text, add_special_tokens=False).ids and codec.decode(codec.encode(text)) == text


def test_encode_rows(spark, codec):
    rows = [(1, "hello world", 0), (2, None, 0), (3, "", 0), (3, "hello", 0)]
    got = sorted((r.doc_id, list(r.ids)) for r in encode_texts(spark.createDataFrame(rows, "doc_id bigint, text string, ids int"), "doc_id", "text").collect())
    assert got == sorted([(1, codec.encode("hello world")), (2, []), (3, []), (3, codec.encode("hello"))])


@given(st.lists(st.integers(0, 5), min_size=1, max_size=300), st.booleans(), st.lists(st.lists(st.integers(1, 5), min_size=3, max_size=3), min_size=1, max_size=8))
@settings(max_examples=150, deadline=None)
def test_fm_index_against_scan(words, twice, phrases):
    text = np.array((words + [0]) * (1 + twice), dtype=np.int64)
    ends = np.flatnonzero(text == 0)
    end = lambda i: int(ends[np.searchsorted(ends, i)])
    suffixes = [([int(x) + len(ends) for x in text[i : end(i)]] + [int(np.searchsorted(ends, i))], i) for i in range(len(text))]
    assert suffix_order(text).tolist() == [i for _, i in sorted(suffixes)]
    index = FMIndex(*FMIndex.parts_of(text))
    phrases = [p for p in phrases if max(p) <= text.max()]
    low, high = index.search(np.array(phrases, dtype=np.int64).reshape(-1, 3))
    which, at = index.locate(low, high)
    want = {(k, i) for k, p in enumerate(phrases) for i in range(len(text) - 2) if text[i : i + 3].tolist() == p}
    assert len(which) == len(want) and set(zip(which.tolist(), at.tolist())) == want


def test_plain_words():
    assert plain_words("<p>A&nbsp;b&eacute;<b>C</b> a&lt;d 1 < 2</p>") == ["a", "bé", "c", "a", "d", "1", "2"]
    assert plain_words(None) == plain_words("") == []


def test_leaks_against_brute_force(spark):
    rnd = random.Random(8)
    vocabulary = [f"v{i}" for i in range(60)]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([4, 8, 30, 50])))) for i in range(40)]
    items += [(98, None), (99, ""), (100, items[7][1]), (101, "again and again and again and again and again and again and again and again and again and again")]
    docs = []
    for d in range(200):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randrange(5, 60))]
        if rnd.random() < 0.5:
            source = rnd.choice([t for _, t in items if t]).split()
            a = rnd.randrange(0, max(1, len(source) - 6))
            words[3:3] = source[a : a + rnd.randrange(6, 60)]
        docs.append((d, rnd.choice([" ", ", ", "\n"]).join(w.upper() if rnd.random() < 0.1 else w for w in words)))
    docs += [(1000, None), (1001, ""), (1002, items[3][1] * 1 + " " + "filler " * 30_000 + items[4][1])]
    want = {}
    for d, text in docs:
        w = plain_words(text)
        grams = {tuple(w[k : k + PHRASE]) for k in range(len(w) - PHRASE + 1)}
        for i, t in items:
            v = plain_words(t)
            held = {p for k in range(len(v) - PHRASE + 1) if tuple(v[k : k + PHRASE]) in grams for p in range(k, k + PHRASE)}
            if held:
                want[d, i] = (len(held), len(v))
    df, it = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    for kw in ({}, {"block_bytes": 1500, "shard_words": 200}):
        found = leaks(df, "doc_id", "text", it, "item_id", "text", **kw).collect()
        assert {(r.doc_id, r.item_id): (r.held_words, r.item_words) for r in found} == want
        for r in found[:50]:
            w = plain_words(dict(docs)[r.doc_id])
            inside = plain_words(dict(items)[r.item_id])
            for s in r.spans:
                span = w[s.from_word : s.to_word]
                assert any(span[:PHRASE] == inside[k : k + PHRASE] for k in range(len(inside)))
    # another set of items is searched in the same index, without the corpus; longer phrases too
    index = CorpusIndex(spark, scratch(spark, "corpus")).build(df, "doc_id", "text", 500)
    gone = spark.createDataFrame([(7, " ".join(docs[5][1].split()[:20]))], "n bigint, x string")
    assert 5 in {r.doc_id for r in index.search(gone, "n", "x", "doc_id").collect()}
    assert {(r.doc_id, r.item_id) for r in index.search(it, "item_id", "text", "doc_id", phrase=30).collect()} < set(want)
    assert leaks(df, "doc_id", "text", it.limit(0), "item_id", "text").count() == 0
    assert leaks(df.limit(0), "doc_id", "text", it, "item_id", "text").count() == 0


def test_scripts_without_spaces(spark):
    passage = "".join(chr(0x4E00 + i * 37 % 900) for i in range(60))
    df = spark.createDataFrame([(1, "前文" + passage + "后文"), (2, "无关")], "d bigint, t string")
    it = spark.createDataFrame([(5, passage)], "i bigint, t string")
    assert leaks(df, "d", "t", it, "i", "t").count() == 0  # by words a clause is one word
    assert [(r.d, r.held_words) for r in leaks(df, "d", "t", it, "i", "t", phrase=20, unit="characters").collect()] == [(1, 60)]


EASY, PLAIN, HARD = (
    lambda r: " ".join(f"The {r.choice(['cat', 'dog', 'hen'])} {r.choice(['sat', 'ran', 'ate'])} on the {r.choice(['mat', 'hill', 'box'])}." for _ in range(12)),
    lambda r: " ".join(f"The {r.choice(['council', 'market', 'village'])} reported {r.randrange(99)} {r.choice(['changes', 'results'])} in the first quarter of the year, and prices stayed open." for _ in range(8)),
    lambda r: " ".join(f"Notwithstanding the {r.choice(['institutional', 'jurisdictional'])} codification of {r.choice(['interoperability', 'capitalization'])}, which the {r.choice(['administration', 'constitution'])} had, in consideration of its materiality, systematically marginalized, the proposal presupposes decentralization." for _ in range(6)),
)


def labelled(n=240):
    r = random.Random(1)
    return [(i, (EASY, PLAIN, HARD)[i % 3](r), f"s{i % 9}", i % 3 + 1) for i in range(n)]


def test_levels_for_held_out_documents(spark):
    rows = labelled()
    docs = spark.createDataFrame([x[:3] for x in rows] + [(1000, None, "s"), (1001, "", "s"), (1002, "Der Hund und die Katze sind nicht auf dem Haus, aber das ist auch gut für den Mann.", "s"), (1003, HARD(random.Random(2)) * 200, None)], "doc_id bigint, text string, source string")
    r = random.Random(7)
    labels = spark.createDataFrame([(i, "g", r.choice([1, 2, 3]) if r.random() < 0.05 else lv) for i, _, _, lv in rows if i % 2] + [(1, "h", None), (None, "g", 3)], "doc_id bigint, grader string, reading_level int")
    grader = learn(docs, "doc_id", "text", "source", labels, "doc_id", "reading_level")
    assert grader.labelled == 120
    error, wrong = nested_error(*labelled_features(docs, "doc_id", "text", "source", labels, "doc_id", "reading_level"))
    assert error < 0.3 and wrong < 0.2
    got = {x.doc_id: x.level for x in reading_levels(docs, "doc_id", "text", grader).collect()}
    assert not {1000, 1001, 1002} & set(got) and got[1003] == 3
    held_out = [(i, lv) for i, _, _, lv in rows if i % 2 == 0]
    assert sum(got[i] == lv for i, lv in held_out) >= 0.97 * len(held_out)
    assert learn(docs, "doc_id", "text", "source", labels.limit(0), "doc_id", "reading_level") is None
    assert reading_levels(docs, "doc_id", "text", None).count() == 0
    assert reading_levels(docs.limit(0), "doc_id", "text", grader).count() == 0


def test_parts_of_the_grader():
    x, y = isotonic(np.array([1.0, 2, 3, 4]), np.array([1.0, 3, 2, 4]), np.ones(4))
    assert y.tolist() == [1, 2.5, 4] and x.tolist() == [1, 2.5, 4]
    assert 2 < best_cut(np.array([1, 2, 3, 4.0]), np.array([False, False, True, True]), np.ones(4)) < 3
    rng = np.random.default_rng(0)
    a = rng.normal(size=(400, 3))
    b = (a[:, 1] > 0) * 2.0
    assert np.abs(Trees().fit(a, b, np.ones(400)).predict(a) - b).mean() < 0.1
    assert features("") is None and features("a b") is None
    tiny = fit_grader(np.zeros((2, 2)), np.array([1.0, 3.0]), np.ones(2), np.array(["a", "b"]))
    assert np.isfinite(tiny.grade(np.zeros((1, 2)))).all() and tiny.level(tiny.grade(np.zeros((1, 2))))[0] in (1, 2, 3)

"""Near-duplicate records by the words they share, counted with repeats, in any order.

The multiset of a record's words becomes a set of (word, occurrence) elements, so Jaccard similarity of the sets is that of the
multisets. Tensored banding: two small collections of `halves` half-keys are made, each of `rows` minhashes; every pair of a
half-key of the one and a half-key of the other is a table key. So halves squared tables of 2 * rows minhashes each cost only
2 * halves * rows minhashes. Rows are shuffled by their first half-key alone, and the pairs with the second are formed where they
then lie; half-keys that very many records share are spread by their whole keys. Candidates pass a sketch test that loses one pair in
some ten million (five standard deviations; it can be turned off) and then an exact one.

Recall of a pair of similarity s is (1 - (1 - s^rows)^halves)^2: with the defaults 0.9955 at 0.75, 0.9997 at 0.8, 0.99999 at 0.85.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.bitmaps import bitmap_of, marked
from tidewire.operators.decisions import components
from tidewire.session import cut

_WORD = re.compile(r"[^\W_]+")
_U = np.uint64
_GOLD = _U(0x9E3779B97F4A7C15)
SKETCH_HASHES = 64  # minhashes of which two bits each make up the sketch


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit integers (splitmix64's finish)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class WordHashes:
    """64-bit hashes of words, remembered up to a number of words."""

    def __init__(self, most: int = 500_000):
        self.known: dict[str, int] = {}
        self.most = most

    def of(self, words: list[str]) -> list[int]:
        import xxhash

        if len(self.known) > self.most:
            self.known.clear()
        known, one = self.known, xxhash.xxh3_64_intdigest
        out = []
        for w in words:
            h = known.get(w)
            if h is None:
                h = known[w] = one(w)
            out.append(h)
        return out


def _elements(texts: list[str], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """(elements of all texts, number of each): an element is a hash of word and occurrence."""
    sizes, flat = [], []
    for t in texts:
        words = _WORD.findall(t.lower())
        sizes.append(len(words))
        flat += hashes.of(words)
    n = np.array(sizes, dtype=np.int64)
    h = np.array(flat, dtype=np.uint64)
    doc = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    if len(h):
        new = np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])]
        start = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
        h = _mix(h + (np.arange(len(h)) - start).astype(np.uint64) * _GOLD)
    return h, n


def _i64(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _signatures(batches: Iterator[pa.RecordBatch], least: int, halves: int, rows: int, chunk: int = 512) -> Iterator[pa.RecordBatch]:
    """id, number, text -> id, number, n, fp1, fp2, s1, s2, a (half-keys), b; only texts with at least `least` words."""
    rng = np.random.default_rng(20_240_601)
    m = max(2 * halves * rows, SKETCH_HASHES)
    mul, add = rng.integers(1, 1 << 63, m, dtype=np.uint64) * _U(2) + _U(1), rng.integers(0, 1 << 63, m, dtype=np.uint64)
    hashes = WordHashes()
    for batch in batches:
        for at in range(0, batch.num_rows, chunk):
            part = batch.slice(at, chunk)
            h, n = _elements([t or "" for t in part.column(2).to_pylist()], hashes)
            keep = n >= least
            if not keep.any():
                continue
            h, size = h[np.repeat(keep, n)], n[keep]
            starts = np.r_[0, np.cumsum(size)[:-1]]
            fp1, fp2 = np.add.reduceat(h, starts), np.add.reduceat(_mix(h ^ _GOLD), starts)
            sig = np.empty((m, len(size)), dtype=np.uint64)
            for i in range(m):
                sig[i] = np.minimum.reduceat((h * mul[i] + add[i]) >> _U(32), starts)
            bits = [np.bitwise_or.reduce([(_mix(sig[32 * k + i]) & _U(3)) << _U(2 * i) for i in range(32)]) for k in (0, 1)]
            keys = np.zeros((2 * halves, len(size)), dtype=np.uint64)
            for j in range(2 * halves):
                for r in range(rows):
                    keys[j] = _mix(keys[j] + sig[j * rows + r] + _GOLD)
            keys >>= _U(33)  # 31 bits: an int
            lists = lambda k: pa.FixedSizeListArray.from_arrays(pa.array(k.T.reshape(-1).astype(np.int32)), halves).cast(pa.list_(pa.int32()))
            mask = pa.array(keep)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).filter(mask), part.column(1).filter(mask), pa.array(size.astype(np.int32)), _i64(fp1), _i64(fp2), _i64(bits[0]), _i64(bits[1]), lists(keys[:halves]), lists(keys[halves:])],
                names=["id", "no", "n", "fp1", "fp2", "s1", "s2", "a", "b"],
            )


def _element_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """no, text -> no, elements."""
    hashes = WordHashes()
    for batch in batches:
        h, n = _elements([t or "" for t in batch.column(1).to_pylist()], hashes)
        offsets = pa.array(np.r_[0, np.cumsum(n)].astype(np.int32))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, _i64(h))], names=["no", "elements"])


def _differing(a: Column) -> Column:
    """How many two-bit cells of a xor'ed sketch are not zero."""
    return F.bit_count(a.bitwiseOR(F.shiftrightunsigned(a, 1)).bitwiseAND(F.lit(0x5555555555555555)))


def most_differing(similarity: float, sigmas: float | None = 5.0) -> int:
    """Sketch cells in which a pair of that similarity differs, but for a chance of some 1e-7, at most; all cells if sigmas is None."""
    p = (1 - similarity) * 0.75
    return SKETCH_HASHES if sigmas is None else int(np.ceil(SKETCH_HASHES * p + sigmas * np.sqrt(SKETCH_HASHES * p * (1 - p))))


def signatures(df: DataFrame, key: str, order: str, text: Column, least_words: int, halves: int, rows: int) -> DataFrame:
    """One row per key with at least least_words words: of a key's rows the one smallest in `order`, a unique bigint."""
    cols = f"id {df.schema[key].dataType.simpleString()}, no bigint, n int, fp1 bigint, fp2 bigint, s1 bigint, s2 bigint, a array<int>, b array<int>"
    src = df.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.col(order).cast("bigint").alias("no"), text.alias("text"))
    sig = src.mapInArrow(lambda it: _signatures(it, least_words, halves, rows), cols)
    return sig.groupBy("id").agg(F.min_by(F.struct("no", "n", "fp1", "fp2", "s1", "s2", "a", "b"), "no").alias("x")).select("id", "x.*")


HOT = 1000  # records with one first half-key, by a sample of a hundredth, from which on they are spread by their whole keys
WIDE = 200  # rows of a bucket from which on its pairs are made in parts
PARTS = 16
_BUCKET = ["i", "ka", "j", "kb"]


class Candidates:
    """Records that share a table key: `two`, the pairs of buckets of two, and `many`, the rows of larger buckets with their size."""

    def __init__(self, reps: DataFrame, least: float, sigmas: float | None):
        self.least, self.far = least, most_differing(least, sigmas)
        first = reps.select("no", "n", "s1", "s2", "b", F.posexplode("a").alias("i", "ka"))
        first = first.withColumn("slot", F.pmod(F.xxhash64("i", "ka"), F.lit(1 << 22)))
        # half-keys that very many records share, as a set of hashes in half a MB; a key that falls in by chance only takes the other way
        sampled = first.where(F.pmod(F.xxhash64("no"), F.lit(100)) == 0).groupBy("slot").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= HOT / 100)
        first = marked(first, bitmap_of(sampled, "slot"), "slot", "hot").drop("slot")
        cold = first.where("not hot").drop("hot").repartition("i", "ka")  # pairs with second half-keys are formed where the rows then lie
        spread = first.where("hot").select("no", "n", "s1", "s2", "i", "ka", F.posexplode("b").alias("j", "kb"))
        cells = cold.select("no", "n", "s1", "s2", "i", "ka", F.posexplode("b").alias("j", "kb"))
        by = self._buckets(cells).withColumn("hot", F.lit(False)).unionByName(self._buckets(spread).withColumn("hot", F.lit(True)))
        alike = self._fit(F.col("n_lo"), F.col("n_hi")) & (_differing(F.col("x1")) + _differing(F.col("x2")) <= self.far)
        by = cut(by.where((F.col("c") > 2) | ((F.col("c") == 2) & alike)).select(*_BUCKET, "c", "hot", "no_a", "no_b"))
        rows, large = ["no", "n", "s1", "s2", *_BUCKET, "c"], by.where("c > 2").select(*_BUCKET, "c", "hot")
        many = cold.join(large.where("not hot").hint("merge"), ["i", "ka"]).where(F.element_at("b", F.col("j") + 1) == F.col("kb")).select(*rows)
        self.many = cut(many.unionByName(spread.join(large.where("hot"), _BUCKET).select(*rows)))
        self.two = by.where("c = 2").select("no_a", "no_b").distinct()

    @staticmethod
    def _buckets(cells: DataFrame) -> DataFrame:
        """A bucket of two, which is nearly every one, is told by its least and greatest number and the xor of its sketches."""
        return cells.groupBy(*_BUCKET).agg(F.count(F.lit(1)).alias("c"), F.min("no").alias("no_a"), F.max("no").alias("no_b"), F.bit_xor("s1").alias("x1"), F.bit_xor("s2").alias("x2"), F.min("n").alias("n_lo"), F.max("n").alias("n_hi"))

    def _fit(self, low: Column, high: Column) -> Column:
        return low >= F.lit(self.least) * high

    def _near(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose lengths and sketches allow the similarity."""
        alike = _differing(F.col("s1_a").bitwiseXOR(F.col("s1_b"))) + _differing(F.col("s2_a").bitwiseXOR(F.col("s2_b"))) <= self.far
        return pairs.where((F.col("no_a") < F.col("no_b")) & self._fit(F.least("n_a", "n_b"), F.greatest("n_a", "n_b")) & alike)

    @staticmethod
    def _side(rows: DataFrame, side: str, *keys: str) -> DataFrame:
        return rows.select(*keys, *[F.col(c).alias(f"{c}_{side}") for c in ("no", "n", "s1", "s2")])

    def pairs(self) -> DataFrame:
        """All pairs (no_a < no_b); those of a wide bucket are made in PARTS parts."""
        wide, every = F.col("c") > WIDE, F.array(*map(F.lit, range(PARTS)))
        left = self.many.withColumn("part", F.when(wide, F.pmod("no", F.lit(PARTS)).cast("int")).otherwise(0))
        right = self.many.withColumn("part", F.explode(F.when(wide, every).otherwise(F.array(F.lit(0)))))
        more = self._near(self._side(left, "a", *_BUCKET, "part").join(self._side(right, "b", *_BUCKET, "part"), [*_BUCKET, "part"]))
        return self.two.unionByName(more.select("no_a", "no_b")).distinct()

    def stars(self) -> DataFrame:
        """In place of all pairs of a bucket, those of its least record with each other: as many as there are rows."""
        least = self.many.groupBy(*_BUCKET).agg(F.min(F.struct("no", "n", "s1", "s2")).alias("x")).select(*_BUCKET, "x.*")
        more = self._near(self._side(least, "a", *_BUCKET).join(self._side(self.many, "b", *_BUCKET), _BUCKET))
        return self.two.unionByName(more.select("no_a", "no_b")).distinct()

    def across(self, labels: DataFrame) -> DataFrame:
        """Pairs of a bucket whose records have different labels (node, label; a record without one is its own), with these. Only
        buckets that hold several labels give any, and pairs within a label are not formed at all."""
        rows = cut(self.many.join(labels.select(F.col("node").alias("no"), "label"), "no", "left").withColumn("label", F.coalesce("label", "no")))
        held = rows.select(*_BUCKET, "label").distinct()
        several = held.groupBy(*_BUCKET).agg(F.count(F.lit(1)).alias("k")).where("k > 1").drop("k")
        held = held.join(several, _BUCKET)
        both = held.withColumnRenamed("label", "x").join(held.withColumnRenamed("label", "y"), _BUCKET).where("x <> y")
        of = lambda side, label: self._side(rows.withColumnRenamed("label", label), side, *_BUCKET, label)
        return self._near(both.join(of("a", "x"), [*_BUCKET, "x"]).join(of("b", "y"), [*_BUCKET, "y"])).select("no_a", "no_b", "x", "y").distinct()


class NearDuplicates:
    """Records by `key` with at least least_words words, and what is alike among them.

    members: `key`, no and rep, the number of the first record with the same words; one row per key. Copies are never paired with
    each other, so a group of copies costs one record. Null keys are left out, null texts have no words; an empty table gives empty
    results; whole texts are read; other columns are left out. sigmas: see most_differing; None takes every candidate.
    """

    def __init__(self, df: DataFrame, key: str, order: str, text: Column, similarity: float = 0.75, least_words: int = 40, halves: int = 16, rows: int = 4, sigmas: float | None = 5.0):
        self.key, self.similarity = key, similarity
        self._texts = df.select(F.col(order).cast("bigint").alias("no"), text.alias("text"))
        sig = cut(signatures(df, key, order, text, least_words, halves, rows))
        reps = cut(sig.groupBy("fp1", "fp2", "n").agg(F.min_by(F.struct("no", "s1", "s2", "a", "b"), "no").alias("x")).select("fp1", "fp2", "n", "x.*"))
        self.members = sig.select("id", "no", "fp1", "fp2", "n").join(reps.select("fp1", "fp2", "n", F.col("no").alias("rep")), ["fp1", "fp2", "n"]).select(F.col("id").alias(key), "no", "rep")
        self._candidates = Candidates(reps, similarity, sigmas)

    def _verified(self, pairs: DataFrame) -> DataFrame:
        """Adds similarity and keeps the pairs that reach it."""
        pairs = cut(pairs)
        wanted = pairs.select(F.explode(F.array("no_a", "no_b")).alias("no")).distinct()
        elements = self._texts.join(wanted.hint("merge"), "no", "left_semi").mapInArrow(_element_rows, "no bigint, elements array<bigint>")
        a = elements.select(F.col("no").alias("no_a"), F.col("elements").alias("ea"))
        b = elements.select(F.col("no").alias("no_b"), F.col("elements").alias("eb"))
        shared = F.size(F.array_intersect("ea", "eb"))
        s = shared / (F.size("ea") + F.size("eb") - shared)
        return pairs.join(a.hint("merge"), "no_a").join(b.hint("merge"), "no_b").select(*pairs.columns, s.alias("similarity")).where(F.col("similarity") >= self.similarity)

    def links(self) -> DataFrame:
        """no_a < no_b and similarity of all representatives that reach it, each pair once: as many as there are."""
        return self._verified(self._candidates.pairs())

    def classes(self) -> DataFrame:
        """`key` and class_id, one row per member. A class holds all that links and copies join; its id is the least number in it.

        Its work grows with the records, not with the pairs of a class: in each bucket all are compared with the least first, and then
        only those that are not yet in one class. The classes are those that all links of the buckets would give.
        """
        one = components(self._verified(self._candidates.stars()).select(F.col("no_a").alias("a"), F.col("no_b").alias("b")))
        more = self._verified(self._candidates.across(one)).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        two = components(more).select(F.col("node").alias("label"), F.col("label").alias("top"))
        final = one.unionByName(more.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(one.select("node"), "node", "left_anti").withColumn("label", F.col("node")))
        final = final.join(two, "label", "left").select(F.col("node").alias("rep"), F.coalesce("top", "label").alias("class"))
        return self.members.join(final, "rep", "left").select(self.key, F.coalesce("class", "rep").alias("class_id"))

    def all_pairs(self) -> DataFrame:
        """Every pair of keys (`key`_a < `key`_b) that are copies of each other or whose representatives are linked. The result
        itself is as large as the groups of copies make it; use members and links, or classes, where that is not wanted."""
        key = self.key
        m = lambda s: self.members.select(F.col("rep").alias(f"rep_{s}"), F.col(key).alias(f"k_{s}"))
        copies = m("a").join(m("b"), (F.col("rep_a") == F.col("rep_b")) & (F.col("k_a") < F.col("k_b"))).select("k_a", "k_b")
        across = self.links().select(F.col("no_a").alias("rep_a"), F.col("no_b").alias("rep_b")).join(m("a"), "rep_a").join(m("b"), "rep_b")
        across = across.select(F.least("k_a", "k_b").alias("k_a"), F.greatest("k_a", "k_b").alias("k_b"))
        return copies.unionByName(across).select(F.col("k_a").alias(f"{key}_a"), F.col("k_b").alias(f"{key}_b"))

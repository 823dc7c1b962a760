"""Evaluation passages inside a training corpus.

The corpus is cut into shards of a bounded number of words. Each shard gets an FM-index over all its words: the order of its suffixes,
the Burrows-Wheeler transform of that order in a wavelet matrix of packed bits, and the positions of every SAMPLE-th suffix of the text.
Indexes lie in a table on shared storage; later sets of test items search that table and do not read the corpus again. All phrases
of a block of items are searched backward at once through wavelet ranks; an occurrence is located by walking backward to the next sampled
suffix; occurrences are gathered by document and item, and overlapping spans merged. Nothing is shuffled.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.session import scratch

PHRASE = 8
SHARD_WORDS = 1 << 18
SAMPLE = 16
BLOCK_BYTES = 4_000_000  # text of the items searched in one pass over the indexes; it goes to the workers

_WORD = {"words": re.compile(r"[^\W_]+"), "characters": re.compile(r"[^\W_]")}
_TAG = re.compile(r"</?[A-Za-z][^<>]*>|<!--.*?-->|<[!?][^<>]*>", re.S)


def plain_words(text: str | None, unit: str = "words") -> list[str]:
    """Lower-cased words; tags and character references, punctuation and white space only part them. With unit "characters" each
    letter and digit counts by itself, for scripts that are written without spaces."""
    if not text:
        return []
    if "<" in text:
        text = _TAG.sub(" ", text)
    if "&" in text:
        text = html.unescape(text)
    return _WORD[unit].findall(text.lower())


class Bits:
    """A packed bit string and its counts of ones before any place."""

    def __init__(self, words: np.ndarray):
        self.words = np.append(words, np.uint64(0))
        self.before = np.r_[0, np.cumsum(np.bitwise_count(words), dtype=np.int64)]

    @staticmethod
    def pack(bits: np.ndarray) -> np.ndarray:
        raw = np.packbits(bits, bitorder="little")
        return np.pad(raw, (0, -len(raw) % 8)).view("<u8")

    def rank(self, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1)))

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


def suffix_order(words: np.ndarray) -> np.ndarray:
    """Places of the suffixes in their order. Words are numbers from 1, and 0 ends each document; ends are told apart by their place,
    so that no comparison goes beyond a document. Groups of equal heads are sorted by ever longer heads until none is left."""
    n, end = len(words), words == 0
    rank = words.astype(np.int64) + int(end.sum())
    rank[end] = np.arange(int(end.sum()))
    most = int(rank.max(initial=0)) + 1
    nxt = np.r_[rank[1:], 0]
    key, h = (rank * most + nxt) * most + np.r_[nxt[1:], 0], 3  # below 2^63 for shards of up to 2^20 words
    order, todo = np.arange(n), np.arange(n)
    while len(todo):
        own = order[todo]
        by = np.argsort(key, kind="stable")
        own, key = own[by], key[by]
        order[todo] = own
        new = np.r_[True, key[1:] != key[:-1]]
        rank[own] = np.maximum.accumulate(np.where(new, todo, 0))  # a group's rank is the place of its first
        alone = new & np.r_[new[1:], True]
        todo = todo[~alone]
        own = order[todo]
        key = rank[own] * n + rank[np.minimum(own + h, n - 1)]
        h *= 2
    return order


class FMIndex:
    """Over word numbers, 0 at the end of each document."""

    def __init__(self, size: int, levels: int, matrix: np.ndarray, before: np.ndarray, sampled: np.ndarray, places: np.ndarray):
        self.size, self.levels, self.before, self.places = size, levels, before, places
        self.planes = [Bits(m) for m in matrix.reshape(levels, -1)]
        self.zeros = [size - int(b.before[-1]) for b in self.planes]
        self.sampled = Bits(sampled)

    @classmethod
    def parts_of(cls, words: np.ndarray) -> tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        order = suffix_order(words)
        levels = max(1, int(words.max(initial=0)).bit_length())
        symbols, planes = words[order - 1], []  # the word before each suffix
        for level in range(levels - 1, -1, -1):
            bit = (symbols >> level & 1).astype(bool)
            planes.append(Bits.pack(bit))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])
        before = np.r_[0, np.cumsum(np.bincount(words))].astype(np.int32)
        kept = (order % SAMPLE == 0) | (words[order - 1] == 0)  # and the first of each document, where walks must end
        return len(words), levels, np.stack(planes), before, Bits.pack(kept), order[kept].astype(np.int32)

    def _rank(self, symbol: np.ndarray, *places: np.ndarray) -> list[np.ndarray]:
        """For each of the places: how often the symbol stands before it."""
        at = [np.zeros_like(symbol), *places]
        for k, level in enumerate(range(self.levels - 1, -1, -1)):
            one = (symbol >> level & 1).astype(bool)
            ranks = [self.planes[k].rank(p) for p in at]
            at = [np.where(one, self.zeros[k] + r, p - r) for p, r in zip(at, ranks)]
        return [p - at[0] for p in at[1:]]

    def _back(self, row: np.ndarray) -> np.ndarray:
        """The row of the suffix that starts one word earlier."""
        symbol, at = np.zeros_like(row), row
        for k in range(self.levels):
            one, r = self.planes[k].get(at), self.planes[k].rank(at)
            symbol, at = symbol * 2 + one, np.where(one, self.zeros[k] + r, at - r)
        return self.before[symbol] + at - self._first(symbol)

    def _first(self, symbol: np.ndarray) -> np.ndarray:
        """Where the symbol's run begins below the last plane."""
        at = np.zeros_like(symbol)
        for k, level in enumerate(range(self.levels - 1, -1, -1)):
            one, r = (symbol >> level & 1).astype(bool), self.planes[k].rank(at)
            at = np.where(one, self.zeros[k] + r, at - r)
        return at

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """phrases: one per row, no word of them 0. Begin and end of each one's range of suffixes."""
        low, high = np.zeros(len(phrases), dtype=np.int64), np.full(len(phrases), self.size, dtype=np.int64)
        live = np.arange(len(phrases))
        for column in phrases.T[::-1]:
            c = column[live].astype(np.int64)
            a, b = self._rank(c, low[live], high[live])
            low[live], high[live] = self.before[c] + a, self.before[c] + b
            live = live[b > a]
        return low, np.maximum(low, high)

    def locate(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the phrase, position) of each occurrence."""
        n = high - low
        which = np.repeat(np.arange(len(n)), n)
        row = np.repeat(low, n) + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        at, steps = np.zeros(len(row), dtype=np.int64), 0
        live = np.arange(len(row))
        while len(live):
            there = self.sampled.get(row)
            at[live[there]] = self.places[self.sampled.rank(row[there])] + steps
            live, row, steps = live[~there], self._back(row[~there]), steps + 1
        return which, at


class Phrases:
    """The test items of one block, as phrases of word numbers; sent to the workers."""

    def __init__(self, items: list[tuple[int, str]], phrase: int = PHRASE, unit: str = "words"):
        texts = [(i, plain_words(t, unit)) for i, t in items]
        self.size = phrase
        self.vocabulary = sorted({w for _, ws in texts for w in ws})
        number = {w: k for k, w in enumerate(self.vocabulary)}
        self.ids = np.array([i for i, _ in texts], dtype=np.int64)
        self.sizes = np.array([len(ws) for _, ws in texts], dtype=np.int64)
        flat = np.array([number[w] for _, ws in texts for w in ws], dtype=np.int32)
        item = np.repeat(np.arange(len(texts)), self.sizes)
        offset = np.arange(len(flat)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        starts = np.flatnonzero(offset + phrase <= self.sizes[item]) if len(flat) else np.zeros(0, dtype=np.int64)
        rows = flat[starts[:, None] + np.arange(phrase)].reshape(-1, phrase)
        self.rows, which, self.uses = np.unique(rows, axis=0, return_inverse=True, return_counts=True) if len(rows) else (rows, starts, starts)
        by = starts[np.argsort(which, kind="stable")]
        self.where = np.stack([item[by], offset[by]], axis=1)  # (item, offset), by phrase


def _search_shard(p: Phrases, docs: list, starts: np.ndarray, vocabulary: list[str], index: FMIndex) -> pa.RecordBatch | None:
    number = {w: k for k, w in enumerate(vocabulary, 1)}
    numbers = np.array([number.get(w, 0) for w in p.vocabulary], dtype=np.int64)[p.rows]
    whole = np.flatnonzero((numbers > 0).all(axis=1))
    which, at = index.locate(*index.search(numbers[whole]))
    if not len(which):
        return None
    which = whole[which]
    doc = np.searchsorted(starts, at, side="right") - 1
    place = at - starts[doc]
    n = p.uses[which]  # a phrase may stand in several items or places
    first = np.repeat((np.cumsum(p.uses) - p.uses)[which], n)
    use = p.where[first + np.arange(len(first)) - np.repeat(np.cumsum(n) - n, n)]
    doc, spot = np.repeat(doc, n), np.repeat(place, n)
    # item words held: the union of the phrases' offsets, each once
    held = np.unique(np.stack([doc, use[:, 0], use[:, 1]], axis=1), axis=0)
    pair = np.r_[True, (held[1:, :2] != held[:-1, :2]).any(axis=1)]
    gap = np.minimum(p.size, np.r_[held[1:, 2] - held[:-1, 2], p.size])
    gap[np.r_[pair[1:], True]] = p.size
    head = np.flatnonzero(pair)
    covered = np.add.reduceat(gap, head)
    key = held[head, 0] * len(p.ids) + held[head, 1]
    # removal spans in the document's words: merged where they touch
    mine = np.unique(np.stack([doc * len(p.ids) + use[:, 0], spot], axis=1), axis=0)
    fresh = np.r_[True, (mine[1:, 0] != mine[:-1, 0]) | (mine[1:, 1] > mine[:-1, 1] + p.size)]
    begin = np.flatnonzero(fresh)
    spans = np.stack([mine[begin, 0], mine[begin, 1], mine[np.r_[begin[1:], len(mine)] - 1, 1] + p.size], axis=1)
    offsets = np.searchsorted(spans[:, 0], np.r_[key, np.iinfo(np.int64).max])
    span = pa.StructArray.from_arrays([pa.array(spans[:, 1].astype(np.int32)), pa.array(spans[:, 2].astype(np.int32))], names=["from_word", "to_word"])
    return pa.RecordBatch.from_arrays(
        [pa.array([docs[d] for d in held[head, 0]]), pa.array(p.ids[held[head, 1]]), pa.array(covered.astype(np.int32)), pa.array(p.sizes[held[head, 1]].astype(np.int32)), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), span)],
        names=["doc", "item_id", "held_words", "item_words", "spans"],
    )


def _build(batches: Iterator[pa.RecordBatch], shard_words: int, unit: str) -> Iterator[pa.RecordBatch]:
    """key, text -> one row a shard."""
    kind = None

    def shard(docs: list, sizes: list[int], words: list[str]) -> pa.RecordBatch:
        held = pa.array(words, pa.string()).dictionary_encode()
        starts = np.r_[0, np.cumsum(np.array(sizes, dtype=np.int64) + 1)]
        numbers = np.zeros(int(starts[-1]), dtype=np.int64)
        inside = np.ones(len(numbers), dtype=bool)
        inside[starts[1:] - 1] = False
        numbers[inside] = held.indices.to_numpy().astype(np.int64) + 1
        size, levels, matrix, before, sampled, places = FMIndex.parts_of(numbers)
        raw = lambda x: pa.array([x.tobytes()], pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array([docs], pa.list_(kind)), raw(starts[:-1]), pa.array([" ".join(held.dictionary.to_pylist())]), pa.array([size]), pa.array([levels], pa.int32()), raw(matrix), raw(before), raw(sampled), raw(places)],
            names=["docs", "starts", "vocabulary", "size", "levels", "matrix", "before", "sampled", "places"],
        )

    docs, sizes, words = [], [], []
    for batch in batches:
        kind = batch.schema.field(0).type
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = plain_words(text, unit)
            if own:
                docs.append(doc)
                sizes.append(len(own))
                words += own
            if len(words) >= shard_words:
                yield shard(docs, sizes, words)
                docs, sizes, words = [], [], []
    if docs:
        yield shard(docs, sizes, words)


def _search(batches: Iterator[pa.RecordBatch], p: Phrases) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            r = batch.slice(k, 1).to_pylist()[0]
            raw = lambda name, kind: np.frombuffer(r[name], dtype=kind)
            index = FMIndex(r["size"], r["levels"], raw("matrix", "<u8"), raw("before", np.int32), raw("sampled", "<u8"), raw("places", np.int32))
            found = _search_shard(p, r["docs"], raw("starts", np.int64), r["vocabulary"].split(" "), index)
            if found is not None:
                yield found


class CorpusIndex:
    """FM-indexes of a corpus below one shared path."""

    def __init__(self, spark: SparkSession, path: str, unit: str = "words"):
        self.spark, self.path, self.unit = spark, path, unit

    def build(self, docs: DataFrame, key: str, text: str, shard_words: int = SHARD_WORDS) -> "CorpusIndex":
        """Indexes whole texts; null and blank ones hold nothing, and several rows of one key count each. One pass, no shuffle."""
        kind, unit = docs.schema[key].dataType.simpleString(), self.unit
        schema = f"docs array<{kind}>, starts binary, vocabulary string, size bigint, levels int, matrix binary, before binary, sampled binary, places binary"
        built = docs.select(F.col(key), F.col(text)).mapInArrow(lambda it: _build(it, shard_words, unit), schema)
        built.write.mode("overwrite").option("compression", "zstd").parquet(self.path)
        return self

    def search(self, items: DataFrame, item: str, item_text: str, key: str, phrase: int = PHRASE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
        """As leaks(), of the corpus that was indexed. Items are searched in blocks of about block_bytes of text, so what is sent to
        the workers is bounded (to a block or the longest item); each further block is one more pass over the indexes."""
        spark, unit = self.spark, self.unit
        table = spark.read.parquet(self.path)
        kind = table.schema["docs"].dataType.elementType.simpleString()
        schema = f"`doc` {kind}, item_id bigint, held_words int, item_words int, spans array<struct<from_word:int,to_word:int>>"
        chosen = items.where(F.col(item).isNotNull() & F.col(item_text).isNotNull()).select(F.col(item).cast("bigint").alias("i"), F.col(item_text).alias("t"))
        size = chosen.agg(F.sum(F.octet_length("t"))).first()[0] or 0
        blocks, out, at = -(-size // block_bytes), None, scratch(spark, "leaks")
        ranked = chosen.withColumn("b", F.pmod(F.xxhash64("i"), F.lit(max(1, blocks))))
        for b in range(blocks):
            phrases = spark.sparkContext.broadcast(Phrases([(r.i, r.t) for r in ranked.where(F.col("b") == b).collect()], phrase, unit))
            out = table.mapInArrow(lambda it, p=phrases: _search(it, p.value), schema)
            if blocks > 1:
                out.write.parquet(f"{at}/block={b}")
                phrases.destroy()
        out = spark.createDataFrame([], schema) if out is None else spark.read.schema(schema).parquet(at) if blocks > 1 else out
        return out.select(F.col("doc").alias(key), "item_id", "held_words", "item_words", "spans")


def leaks(docs: DataFrame, key: str, text: str, items: DataFrame, item: str, item_text: str, phrase: int = PHRASE, unit: str = "words", block_bytes: int = BLOCK_BYTES, shard_words: int = SHARD_WORDS) -> DataFrame:
    """`key`, item_id, held_words, item_words and spans (merged word ranges of the document, for removal) of every document that holds
    a run of at least `phrase` consecutive words of an item; held_words counts the item's words in such runs, each once.

    Null and blank texts, and items with fewer words, have no phrases; several rows of one key give a row each. The corpus is
    indexed in the shared folder first (see CorpusIndex, whose index can be searched again).
    """
    index = CorpusIndex(docs.sparkSession, scratch(docs.sparkSession, "corpus"), unit).build(docs, key, text, shard_words)
    return index.search(items, item, item_text, key, phrase, block_bytes)

"""Duplicates and near-duplicates of a new batch in all that was accepted before.

Sorted neighbourhoods under several keys: every record is filed under its content hash, its URL hash and fifteen arrangements of
its simhash. An arrangement puts two of six blocks of bits in front; two simhashes that differ in at most four bits agree in two
whole blocks under at least one arrangement, so the window of a new record is all that shares its leading blocks, and nothing is
lost. History lies in runs that are sorted, in key ranges whose bounds are sampled from the first batch. A new batch is sorted into
the same ranges; only ranges that it has keys in are read, and of these only records in some window of the batch are moved, told by
a bitmap of windows (at most 9 MB whatever the data). They are merged with the batch in order of key, and each new record is compared
with the old ones of its window. Then the batch can be filed as a run of its own; runs are merged from time to time.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions.bitmaps import bitmap_of, marked
from tidewire.marks import Marks
from tidewire.session import scratch

#: Fixed value: SHA-256 of the empty string.
EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
BLOCKS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))  # (lowest bit, bits)
ARRANGEMENTS = list(itertools.combinations(range(len(BLOCKS)), 2))
MAX_BITS = len(BLOCKS) - 2


_NUMBER = r"^[\p{IsWhite_Space}\"']*(?:[a-z][a-z0-9]*(?:-\d+)?[:=]\s*)?(?:0x|\\x)?(?=[0-9a-f])0*([0-9a-f]*)h?[\p{IsWhite_Space}\"']*$"


def hex_number(text: Column) -> Column:
    """The hexadecimal number a text denotes, lower-case without leading zeros ("0" for zero); null if it denotes none. White space
    around it, case, a prefix 0x or the name of a hash with a colon or equals sign, and quotes are notation."""
    marked = F.regexp_replace(F.lower(text), _NUMBER, "\u0001$1")  # a text that is no number stays as it is
    return F.when(marked == "\u0001", "0").when(marked.rlike("^\u0001[0-9a-f]+$"), F.substr(marked, F.lit(2)))


#: Kinds of keys: content hash, URL hash, arrangements of the simhash.
CONTENT, URL, SIMHASH = 0, 1, 2
KINDS = SIMHASH + len(ARRANGEMENTS)
WINDOW_BITS = 22  # leading bits that tell a window in the bitmap; no arrangement has more in front
HOT = 20_000  # old records of one window from which on it is split


def _front_bits(kind: int) -> int:
    return 64 if kind < SIMHASH else sum(BLOCKS[i][1] for i in ARRANGEMENTS[kind - SIMHASH])


def _arranged(bits: np.ndarray, pair: tuple[int, int]) -> np.ndarray:
    """All 64 bits in another order of blocks: those of the pair first. As signed integers."""
    out = np.zeros(len(bits), dtype=np.uint64)
    for b in [*pair, *[i for i in range(len(BLOCKS)) if i not in pair]]:
        low, n = BLOCKS[b]
        out = out << np.uint64(n) | bits >> np.uint64(low) & np.uint64((1 << n) - 1)
    return out.view(np.int64)


def values(df: DataFrame, content: str, url: str, simhash: str, *keep: Column) -> DataFrame:
    """kind and value of each hash and simhash of the rows that denotes a number and is not that of an empty text."""
    bits = hex_number(F.col(simhash))
    own = {CONTENT: F.nullif(hex_number(F.col(content)), F.lit(EMPTY_SHA256)), URL: hex_number(F.col(url)), SIMHASH: F.when((F.length(bits) <= 16) & (bits != "0"), bits)}
    rows = df.select(*keep, F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("value")) for k, v in own.items()])).alias("__p"))
    return rows.select("*", "__p.*").drop("__p").where("value is not null")


def _keys(batches: Iterator[pa.RecordBatch], bounds: dict[int, list[int]]) -> Iterator[pa.RecordBatch]:
    """kind, value -> kind, range, key, of hashes value and of simhashes bits. A hash is sorted by its first 16 of 64 digits. The
    ranges of a kind follow those of the kinds before it."""
    of = {k: np.array(bounds.get(k, []), dtype=np.int64) for k in range(KINDS)}
    first = np.cumsum([0, *[len(of[k]) + 1 for k in range(KINDS)]])
    for batch in batches:
        kinds, texts = batch.column(0).to_numpy(), batch.column(1)
        parts = []
        for kind in (CONTENT, URL):
            value = texts.filter(pa.array(kinds == kind))
            key = np.array([int(v.zfill(64)[:16], 16) for v in value.to_pylist()], dtype=np.uint64).view(np.int64)
            parts.append((kind, key, value, pa.nulls(len(key), pa.int64())))
        bits = np.array([int(v, 16) for v in texts.filter(pa.array(kinds == SIMHASH)).to_pylist()], dtype=np.uint64)
        kept = pa.array(bits.view(np.int64))
        parts += [(SIMHASH + i, _arranged(bits, pair), pa.nulls(len(bits), pa.string()), kept) for i, pair in enumerate(ARRANGEMENTS)]
        for kind, key, value, own in parts:
            if len(key):
                at = first[kind] + np.searchsorted(of[kind], key, side="right")
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), kind, dtype=np.int32)), pa.array(at.astype(np.int32)), pa.array(key), value, own], names=["kind", "range", "key", "value", "bits"])


def keyed(filed: DataFrame, bounds: dict[int, list[int]]) -> DataFrame:
    """kind, range, key, value and bits of values: seventeen kinds of records in one table."""
    return filed.select("kind", "value").mapInArrow(lambda it: _keys(it, bounds), "kind int, range int, key bigint, value string, bits bigint")


def _slot(kind: Column, key: Column) -> Column:
    """Number of a record's place in the bitmap of windows: records of one window have the same."""
    front = F.element_at(F.array(*[F.lit(64 - min(WINDOW_BITS, _front_bits(k))) for k in range(KINDS)]), kind + 1)
    return F.call_function("shiftleft", kind.cast("bigint"), F.lit(WINDOW_BITS)).bitwiseOR(F.call_function("shiftrightunsigned", key, front))


def _compare(batches: Iterator[pa.RecordBatch], max_bits: int, most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """kind, salt, key, value, bits, fresh in order of range, salt and key -> kind and value (bits as text) of new records that have
    an old one in their window that equals them or differs in at most max_bits. Pairs are made `most` at a time."""
    shift = np.array([0 if k < SIMHASH else 64 - _front_bits(k) for k in range(KINDS)], dtype=np.int64)
    rest = None
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            table = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch])
            if not table.num_rows:
                continue
        elif rest is None or not rest.num_rows:
            return
        else:
            table = rest
        kind, salt, key = (table.column(c).to_numpy() for c in ("kind", "salt", "key"))
        window = key >> shift[kind]
        new_window = np.r_[True, (kind[1:] != kind[:-1]) | (salt[1:] != salt[:-1]) | (window[1:] != window[:-1])]
        end = len(kind) if batch is None else int(np.flatnonzero(new_window)[-1])  # the last window may go on in the next batch
        rest = table.slice(end) if batch is not None else None
        if not end:
            continue
        group, fresh = np.cumsum(new_window[:end]), table.column("fresh").to_numpy()[:end]
        new, old = np.flatnonzero(fresh), np.flatnonzero(~fresh)
        low, high = (np.searchsorted(group[old], group[new], side) for side in ("left", "right"))
        new, low, high = (x[high > low] for x in (new, low, high))
        reach, hit = np.cumsum(high - low), np.zeros(len(new), dtype=bool)
        at = 0
        while at < len(new):
            to = max(at + 1, int(np.searchsorted(reach, (reach[at - 1] if at else 0) + most, "right")))
            n = high[at:to] - low[at:to]
            mine = np.repeat(np.arange(at, to), n)
            i, j = new[mine], old[np.repeat(low[at:to], n) + np.arange(len(mine)) - np.repeat(np.cumsum(n) - n, n)]
            alike = np.bitwise_count((key[i] ^ key[j]).view(np.uint64)) <= np.where(kind[i] < SIMHASH, 0, max_bits)
            same = np.flatnonzero(alike & (kind[i] < SIMHASH))
            if len(same):  # equal heads of hashes; the whole hash decides
                text = table.column("value").combine_chunks()
                alike[same] = [a == b for a, b in zip(text.take(pa.array(i[same])).to_pylist(), text.take(pa.array(j[same])).to_pylist())]
            hit[mine[alike]] = True
            at = to
        found = table.take(pa.array(new[hit]))
        if found.num_rows:
            value = [v if b is None else str(b) for v, b in zip(found.column("value").to_pylist(), found.column("bits").to_pylist())]
            yield pa.RecordBatch.from_arrays([found.column("kind").combine_chunks().cast(pa.int32()), pa.array(value, pa.string())], names=["kind", "value"])


class HistoryRuns:
    """Persisted runs below one shared path: runs/NAME/range=N with sorted files, a marker for each run that is complete and each
    merging of runs. `ranges` of each kind of key; their bounds are sampled from the first batch and kept for the life of a store."""

    def __init__(self, spark: SparkSession, path: str, ranges: int = 4, compact_after: int = 8):
        self.spark, self.path, self.ranges, self.compact_after = spark, path.rstrip("/"), ranges, compact_after
        self._runs, self._merged = Marks(spark, f"{self.path}/marks-runs"), Marks(spark, f"{self.path}/marks-merged")

    def _bounds(self) -> dict[int, list[int]]:
        out: dict[int, list[int]] = {}
        for r in self.spark.read.schema("kind int, bound bigint").parquet(f"{self.path}/bounds").collect():  # at most KINDS * ranges rows
            out.setdefault(r.kind, []).append(r.bound)
        return {k: sorted(v) for k, v in out.items()}

    def _sample_bounds(self, filed: DataFrame) -> None:
        rows = []
        if self.ranges > 1:
            share = F.array(*[F.lit(i / self.ranges) for i in range(1, self.ranges)])
            for r in keyed(filed, {}).groupBy("kind").agg(F.percentile_approx("key", share, 1000).alias("b")).collect():  # one row a kind
                below = 64 - _front_bits(r.kind)
                rows += [(r.kind, b) for b in sorted({b >> below << below for b in r.b})]  # no bound parts a window
        self.spark.createDataFrame(rows, "kind int, bound bigint").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/bounds")

    def runs(self) -> list[str]:
        """Names of the runs to be read: the last merging and what came after it."""
        runs, merged = self._runs.names(), self._merged.names()
        return [f"merged-{merged[-1]}", *runs[int(merged[-1].split("~")[0]) :]] if merged else runs

    def _write(self, rows: DataFrame, name: str) -> None:
        out = rows.select("range", "kind", "key", "value").repartition("range").sortWithinPartitions("range", "key")
        out.write.mode("overwrite").partitionBy("range").parquet(f"{self.path}/runs/{name}")

    def _filed(self, rows: DataFrame) -> DataFrame:
        """Each value once, however often it occurs, written and read again."""
        at = scratch(self.spark, "values")
        rows.select("kind", "value").distinct().write.parquet(at)
        return self.spark.read.schema("kind int, value string").parquet(at)

    def append(self, batch: DataFrame, run: str, content: str, url: str, simhash: str) -> None:
        """Files a batch as a new sorted run, all of it or, if it fails, nothing; a run that is there already is left as it is. Runs
        are merged when compact_after of them have come together."""
        if run in self._runs.names():
            return
        filed = self._filed(values(batch, content, url, simhash))
        if not self._runs.names():
            self._sample_bounds(filed)
        self._write(keyed(filed, self._bounds()), run)
        self._runs.add(run)
        if len(self.runs()) >= self.compact_after:
            self.compact()

    def table(self, ranges: list[int] | None = None) -> DataFrame:
        """range, kind, key and value of all runs, or of some ranges, whose folders alone are then opened."""
        schema = "kind int, key bigint, value string, range int"
        if not self.runs():
            return self.spark.createDataFrame([], schema)
        parts = [self.spark.read.schema(schema).parquet(f"{self.path}/runs/{n}") for n in self.runs()]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out if ranges is None else out.where(F.col("range").isin(ranges))

    def match(self, batch: DataFrame, key: str, content: str, url: str, simhash: str, max_bits: int = MAX_BITS, salts: int = 8) -> DataFrame:
        """The distinct `key` of batch rows that equal a record in content or URL hash or differ from one in at most max_bits of 64
        bits of simhash (no more than 4: the windows find no more).

        Null keys give no row; null, blank or damaged values match nothing; an empty batch or store gives no row. A window in which
        more than HOT old records lie is split by its old records, and the new ones meet each part; rows that share a value are
        found by salted copies of the few values that matched.
        """
        if max_bits > MAX_BITS:
            raise ValueError(f"the windows find differences of at most {MAX_BITS} bits")
        if not self.runs():
            return batch.select(key).where("false")
        at = scratch(self.spark, "batch")
        read = values(batch.where(F.col(key).isNotNull()), content, url, simhash, F.col(key).alias("__key"))
        read.write.parquet(f"{at}/rows")
        rows = self.spark.read.schema(read.schema).parquet(f"{at}/rows")
        keyed(self._filed(rows), self._bounds()).withColumn("slot", _slot(F.col("kind"), F.col("key"))).write.parquet(f"{at}/keys")
        new = self.spark.read.schema("kind int, range int, key bigint, value string, bits bigint, slot bigint").parquet(f"{at}/keys")
        need = [r[0] for r in new.select("range").distinct().collect()]  # at most KINDS * ranges numbers
        old = self.table(need).withColumn("slot", _slot(F.col("kind"), F.col("key")))
        old = marked(old, bitmap_of(new, "slot"), "slot", "near").where("near").drop("near")  # KINDS * 2^22 bits: 9 MB at most
        hot = bitmap_of(old.groupBy("slot").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT), "slot")
        every = F.array(*map(F.lit, range(salts)))
        old = marked(old, hot, "slot", "hot").withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("key"), F.lit(salts)).cast("int")).otherwise(0))
        new = marked(new, hot, "slot", "hot").withColumn("salt", F.explode(F.when(F.col("hot"), every).otherwise(F.array(F.lit(0)))))
        cols = ["kind", "range", "salt", "key", "value", "bits", "fresh"]
        old, new = old.withColumns({"bits": F.lit(None).cast("bigint"), "fresh": F.lit(False)}).select(*cols), new.withColumn("fresh", F.lit(True)).select(*cols)
        merged = old.unionByName(new).repartition("range", "salt").sortWithinPartitions("range", "salt", "key")
        found = merged.select("kind", "salt", "key", "value", "bits", "fresh").mapInArrow(lambda it: _compare(it, max_bits), "kind int, value string")
        own = F.when(F.col("kind") < SIMHASH, F.col("value")).otherwise(F.lower(F.hex(F.col("value").try_cast("bigint"))))
        found = found.select(F.least("kind", F.lit(SIMHASH)).alias("kind"), own.alias("value")).distinct().withColumn("__salt", F.explode(every))
        rows = rows.withColumn("__salt", F.pmod(F.xxhash64("__key"), F.lit(salts)).cast("int"))
        return rows.join(found, ["kind", "value", "__salt"], "left_semi").select(F.col("__key").alias(key)).distinct()

    def take(self, batch: DataFrame, run: str, key: str, content: str, url: str, simhash: str) -> DataFrame:
        """What match() finds of a new batch in all runs before it; then the batch is filed. Taken again under its name, as after a
        failure, it is answered from what was found the first time."""
        at = f"{self.path}/matched/{run}"
        if run not in self._runs.names():
            self.match(batch, key, content, url, simhash).write.mode("overwrite").parquet(at)
            self.append(batch, run, content, url, simhash)
        return self.spark.read.schema(batch.select(key).schema).parquet(at)

    def compact(self) -> None:
        """Merges the runs in effect into one without repeats; it takes effect when its marker is written, and a run that is
        appended meanwhile stays a run of its own."""
        done, names = len(self._runs.names()), self.runs()
        if len(names) < 2:
            return
        name = f"{done}~{len(self._merged.names())}"
        self._write(self.table().distinct(), f"merged-{name}")
        self._merged.add(name)

"""Per-period aggregates by event time over late and out-of-order arrivals.

Each task keeps a finger B-tree of partial aggregates keyed by period. A subtree's partial is held in its parent, but not along the
right spine, where it would change with every arrival: an arrival near the newest period starts at the finger, the rightmost leaf, and
touches that leaf alone; a late one climbs the spine as far as it must, descends, and brings the partials of its ancestors up to the
spine up to date, which is logarithmic. As time goes on, periods are issued (their figures come out) and, past the cut-off, subtrees
are evicted in bulk. What becomes of a row is what the tree answers to its insertion: first, a correction of an issued figure, or
refused. Partials can be merged, so rows may be spread over tasks in any way: no key or period is gathered in one task, and a tree
holds only the periods that are still open. PeriodFigures carries open periods from batch to batch.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.marks import Marks

ARITY = 16
FATES = ("on_time", "corrects", "too_late")
FIRST, CORRECTION, REFUSED = range(3)


def _plus(a: tuple, b: tuple) -> tuple:
    return tuple(x + y for x, y in zip(a, b))


class _Node:
    __slots__ = ("keys", "kids", "aggs", "leaf")

    def __init__(self, leaf: bool, keys: list, kids: list, aggs: list):
        self.leaf, self.keys, self.kids, self.aggs = leaf, keys, kids, aggs  # keys: the least key of each entry

    def halve(self) -> "_Node":
        """Cuts off the right half and returns it."""
        m = len(self.keys) // 2
        right = _Node(self.leaf, self.keys[m:], self.kids[m:], self.aggs[m:])
        del self.keys[m:], self.kids[m:], self.aggs[m:]
        return right


class FingerTree:
    """B-tree from a period's key to a partial aggregate (a tuple of sums), with a finger at the right end."""

    def __init__(self, width: int = 2):
        self.zero = (0,) * width
        self.spine = [_Node(True, [], [], [])]  # from the root to the rightmost leaf
        self.issued_below: int | None = None
        self.evicted_below: int | None = None

    @property
    def root(self) -> _Node:
        return self.spine[0]

    def _replant(self, root: _Node) -> None:
        self.spine = [root]
        while not self.spine[-1].leaf:
            self.spine.append(self.spine[-1].kids[-1])

    def _sum(self, node: _Node) -> tuple:
        acc = self.zero
        for i, agg in enumerate(node.aggs):
            acc = _plus(acc, self._sum(node.kids[i]) if agg is None else agg)  # None: on the spine, not held
        return acc

    def add(self, key: int, part: tuple, correction: tuple | None = None) -> int:
        """FIRST; CORRECTION if the key's figure was issued, and then `correction` is added in place of part; REFUSED, and nothing is
        added, if its subtree was evicted."""
        if self.evicted_below is not None and key < self.evicted_below:
            return REFUSED
        fate = FIRST
        if self.issued_below is not None and key < self.issued_below:
            fate, part = CORRECTION, part if correction is None else correction
        up = len(self.spine) - 1
        while up and key < self.spine[up].keys[0]:
            up -= 1
        node, path = self.spine[up], [(n, len(n.kids) - 1) for n in self.spine[:up]]
        while not node.leaf:
            at = max(0, bisect_right(node.keys, key) - 1)
            path.append((node, at))
            node = node.kids[at]
        at = bisect_left(node.keys, key)
        if at < len(node.keys) and node.keys[at] == key:
            node.aggs[at] = _plus(node.aggs[at], part)
        else:
            node.keys.insert(at, key)
            node.aggs.insert(at, part)
        split = False
        for parent, i in reversed(path):
            held, full = parent.aggs[i], len(node.keys) > ARITY
            if held is None and not full and parent.keys[i] <= key:
                break  # on the spine: nothing further up has changed
            parent.keys[i] = min(parent.keys[i], key)
            if full:
                right, split = node.halve(), True
                parent.aggs[i] = self._sum(node)
                parent.keys.insert(i + 1, right.keys[0])
                parent.kids.insert(i + 1, right)
                parent.aggs.insert(i + 1, None if held is None else self._sum(right))
            elif held is not None:
                parent.aggs[i] = _plus(held, part)
            node = parent
        if len(self.root.keys) > ARITY:
            left, split = self.root, True
            right = left.halve()
            self.spine = [_Node(False, [left.keys[0], right.keys[0]], [left, right], [self._sum(left), None])]
        if split:
            self._replant(self.root)
        return fate

    def issue_below(self, key: int) -> None:
        """Figures of periods below key have come out; what is added to them from now on are corrections."""
        self.issued_below = key if self.issued_below is None else max(key, self.issued_below)

    def evict_below(self, key: int) -> list[tuple[int, tuple]]:
        """Cuts off all entries below key, whole subtrees at once, and returns them in order."""
        if self.evicted_below is not None and key <= self.evicted_below:
            return []
        self.evicted_below = key
        out: list[tuple[int, tuple]] = []

        def cut(node: _Node) -> None:
            n = bisect_left(node.keys, key) if node.leaf else max(0, bisect_right(node.keys, key) - 1)
            for kid in node.kids[:n]:
                out.extend(_entries(kid))
            if node.leaf:
                out.extend(zip(node.keys[:n], node.aggs[:n]))
            del node.keys[:n], node.kids[:n], node.aggs[:n]
            if node.kids:
                first = node.kids[0]
                cut(first)
                if first.keys:
                    node.keys[0] = first.keys[0]
                    node.aggs[0] = None if node.aggs[0] is None else self._sum(first)
                else:
                    del node.keys[0], node.kids[0], node.aggs[0]

        root = self.root
        cut(root)
        while not root.leaf and len(root.kids) == 1:
            root = root.kids[0]
        self._replant(root if root.keys else _Node(True, [], [], []))
        return out

    def items(self) -> Iterator[tuple[int, tuple]]:
        yield from _entries(self.root)

    def total(self, low: int, high: int) -> tuple:
        """The aggregate over low <= key < high from the partials of whole subtrees."""

        def of(node: _Node, end: float) -> tuple:
            acc = self.zero
            for i, k in enumerate(node.keys):
                stop, agg = node.keys[i + 1] if i + 1 < len(node.keys) else end, node.aggs[i]
                if node.leaf:
                    acc = _plus(acc, agg) if low <= k < high else acc
                elif agg is not None and low <= k and stop <= high:
                    acc = _plus(acc, agg)
                elif k < high and stop > low:
                    acc = _plus(acc, of(node.kids[i], stop))
            return acc

        return of(self.root, float("inf"))


def _entries(node: _Node) -> Iterator[tuple[int, tuple]]:
    if node.leaf:
        yield from zip(node.keys, node.aggs)
    else:
        for kid in node.kids:
            yield from _entries(kid)


def _run(batches: Iterator[pa.RecordBatch], emit: str, period: int, grace: int, cutoff: int) -> Iterator[pa.RecordBatch]:
    """Rows of a task in order of arrival -> each row's fate, or the partial figures of its periods. Rows that arrive between two
    moments at which something is issued or evicted are put into the tree together, one insertion a period."""
    tree = FingerTree(width=4)
    late: dict[int, int] = {}
    up = lambda x: -(-x // period) * period
    for batch in batches:
        at, came, value = (np.asarray(batch.column(i).to_numpy(zero_copy_only=False)) for i in (1, 2, 3))
        start = at // period * period
        issued, cut_off = up(came - grace - period), up(came - cutoff - period)  # periods below have come out, or are closed, at that arrival
        moments = np.flatnonzero(np.r_[True, (issued[1:] != issued[:-1]) | (cut_off[1:] != cut_off[:-1])]) if len(came) else []
        fate, gone = np.zeros(len(came), dtype=np.int32), []
        for a, b in zip(moments, [*moments[1:], len(came)]):
            gone += tree.evict_below(int(cut_off[a]))
            tree.issue_below(int(issued[a]))
            keys, where = np.unique(start[a:b], return_inverse=True)
            sums = np.zeros(len(keys), dtype=np.int64)
            np.add.at(sums, where, value[a:b])
            said = []
            for key, n, v in zip(keys.tolist(), np.bincount(where, minlength=len(keys)).tolist(), sums.tolist()):
                said.append(tree.add(key, (n, v, 0, 0), (0, 0, n, v)))
                if said[-1] == REFUSED:
                    late[key] = late.get(key, 0) + n
            fate[a:b] = np.array(said, dtype=np.int32)[where]
        if emit == "fates":
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(start), pa.array(fate)], names=["__key", "__start", "__fate"])
        elif gone:
            yield _figures(gone, {})
    if emit == "figures":
        yield _figures(list(tree.items()), late)


def _figures(items: list[tuple[int, tuple]], late: dict[int, int]) -> pa.RecordBatch:
    rows = [(k, *p, 0) for k, p in items] + [(k, 0, 0, 0, 0, n) for k, n in late.items()]
    cols = list(zip(*rows)) or [()] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["period_start_ms", "n_first", "v_first", "n_corr", "v_corr", "n_too_late"])


def _ordered(events: DataFrame, key: str, published: str, arrived: str, value: str | None) -> DataFrame:
    v = F.coalesce(F.col(value).cast("bigint"), F.lit(0)) if value else F.lit(0).cast("bigint")
    rows = events.select(F.col(key).alias("__key"), F.col(published).cast("bigint").alias("__at"), F.col(arrived).cast("bigint").alias("__came"), v.alias("__v"))
    return rows.where("__at is not null and __came is not null").sortWithinPartitions("__came")


def event_fates(events: DataFrame, key: str, published: str, arrived: str, period_ms: int = 3_600_000, grace_ms: int = 900_000, cutoff_ms: int = 86_400_000) -> DataFrame:
    """`key`, period_start_ms and fate of each row: on_time (it arrives until grace_ms after the end of its period, when the
    period's figures come out), corrects (later, until cutoff_ms after the end) or too_late.

    Rows whose published or arrival time is null have no period and give no row; rows are not made unique here; an empty table
    gives an empty one; other columns are left out.
    """
    kind = events.schema[key].dataType.simpleString()
    out = _ordered(events, key, published, arrived, None).mapInArrow(lambda it: _run(it, "fates", period_ms, grace_ms, cutoff_ms), f"__key {kind}, __start bigint, __fate int")
    fate = F.element_at(F.array(*map(F.lit, FATES)), F.col("__fate") + 1)
    return out.select(F.col("__key").alias(key), F.col("__start").alias("period_start_ms"), fate.alias("fate"))


_SUMS = ("n_first", "v_first", "n_corr", "v_corr", "n_too_late")
_PARTS = "period_start_ms bigint, " + ", ".join(f"{c} bigint" for c in _SUMS)


def _partials(events: DataFrame, key: str, published: str, arrived: str, value: str | None, period_ms: int, grace_ms: int, cutoff_ms: int) -> DataFrame:
    parts = _ordered(events, key, published, arrived, value).mapInArrow(lambda it: _run(it, "figures", period_ms, grace_ms, cutoff_ms), _PARTS)
    return parts.groupBy("period_start_ms").agg(*[F.sum(c).alias(c) for c in _SUMS])


def _final(parts: DataFrame) -> DataFrame:
    final = [F.col("n_first"), F.col("v_first"), (F.col("n_first") + F.col("n_corr")).alias("n_final"), (F.col("v_first") + F.col("v_corr")).alias("v_final")]
    return parts.select("period_start_ms", *final, "n_too_late")


def period_figures(events: DataFrame, key: str, published: str, arrived: str, value: str | None = None, period_ms: int = 3_600_000, grace_ms: int = 900_000, cutoff_ms: int = 86_400_000) -> DataFrame:
    """Figures of each period: n_first and v_first as they first come out, n_final and v_final after all corrections before
    the cut-off, n_too_late of rows refused. Null values count as 0; nulls in times as in event_fates."""
    return _final(_partials(events, key, published, arrived, value, period_ms, grace_ms, cutoff_ms))


class PeriodFigures:
    """Figures below one shared path, corrected batch by batch. The open periods (at most those between the cut-off and the newest)
    are carried from one batch to the next; closed ones are written once. A batch takes effect by the renaming of one marker; run
    again under its id it is answered from what was written."""

    def __init__(self, spark: SparkSession, path: str, period_ms: int = 3_600_000, grace_ms: int = 900_000, cutoff_ms: int = 86_400_000):
        self.spark, self.path, self._times = spark, path.rstrip("/"), (period_ms, grace_ms, cutoff_ms)
        self._marks = Marks(spark, f"{self.path}/marks")

    def _open(self, what: str, names: list[str]) -> DataFrame:
        return self.spark.read.schema(_PARTS).parquet(*[f"{self.path}/{what}/{n}" for n in names]) if names else self.spark.createDataFrame([], _PARTS)

    def take(self, events: DataFrame, batch_id: str, key: str, published: str, arrived: str, value: str | None = None) -> DataFrame:
        """The figures that the batch changes, as they stand after it: of open periods, and of closed ones that refused rows of it.
        A row's fate goes by its own arrival, so batches may come in any order and a late batch is judged as it would have been."""
        done = self._marks.names()
        if batch_id not in done:
            period, _, cutoff = self._times
            parts = _partials(events, key, published, arrived, value, *self._times)
            now = events.where(F.col(published).isNotNull()).agg(F.max(F.col(arrived).cast("bigint"))).first()[0]
            was = self._open("open", done[-1:])
            change = parts.withColumn("changed", F.lit(True)).unionByName(was.withColumn("changed", F.lit(False)))
            all_ = change.groupBy("period_start_ms").agg(*[F.sum(c).alias(c) for c in _SUMS], F.max("changed").alias("changed"))
            all_.write.mode("overwrite").parquet(f"{self.path}/all/{batch_id}")
            all_ = self.spark.read.schema(f"{_PARTS}, changed boolean").parquet(f"{self.path}/all/{batch_id}")
            closed = F.lit(False) if now is None else F.col("period_start_ms") < -(-(now - cutoff - period) // period) * period
            all_.where(~closed).drop("changed").write.mode("overwrite").parquet(f"{self.path}/open/{batch_id}")
            all_.where(closed).drop("changed").write.mode("overwrite").parquet(f"{self.path}/closed/{batch_id}")
            self._marks.add(batch_id)
        changed = self.spark.read.schema(f"{_PARTS}, changed boolean").parquet(f"{self.path}/all/{batch_id}").where("changed").select("period_start_ms")
        upto = self._marks.names()
        return self._upto(upto[: upto.index(batch_id) + 1]).join(changed, "period_start_ms", "left_semi")

    def _upto(self, names: list[str]) -> DataFrame:
        parts = self._open("closed", names).unionByName(self._open("open", names[-1:]))
        return _final(parts.groupBy("period_start_ms").agg(*[F.sum(c).alias(c) for c in _SUMS]))

    def figures(self) -> DataFrame:
        """All periods as they stand."""
        return self._upto(self._marks.names())

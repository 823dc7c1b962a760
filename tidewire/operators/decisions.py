"""The ordered decision on each event: new, exact, content or near duplicate, or update of an existing one.

What is decided of an event depends only on earlier ones that share its source key, its content hash, or nearly its simhash. So
such events are linked, links are closed to components by repeated least labels (lineage cut by checkpoints), and each component is
decided in order by itself; events without a link, nearly all, are decided by expressions alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.session import cut

MAX_BITS = 4
_CUTS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))  # five bands: two that differ in four bits share one


def bands(bits: Column) -> Column:
    """Five keys: band number and its bits."""
    return F.array(*[F.shiftrightunsigned(bits, low).bitwiseAND(F.lit((1 << n) - 1).cast("bigint")).bitwiseOR(F.lit(i << 16).cast("bigint")) for i, (low, n) in enumerate(_CUTS)])


def near_links(df: DataFrame, ord_: str = "ord", bits: str = "bits") -> DataFrame:
    """(a, b): b the later; representatives of equal simhashes that differ in at most four bits, and each event to its
    representative (the first with its simhash). Zero, the simhash of an empty text, links nothing."""
    rows = df.where(F.col(bits) != 0).select(F.col(ord_).alias("o"), F.col(bits).alias("x"))
    first = rows.groupBy("x").agg(F.min("o").alias("o"))
    same = rows.join(first.select("x", F.col("o").alias("f")), "x").where("o > f").select(F.col("f").alias("a"), F.col("o").alias("b"))
    keyed = first.select("o", "x", F.explode(bands(F.col("x"))).alias("k"))
    other = keyed.select(F.col("o").alias("p"), F.col("x").alias("y"), "k")
    near = keyed.join(other, "k").where((F.col("o") < F.col("p")) & (F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= MAX_BITS)).select(F.col("o").alias("a"), F.col("p").alias("b")).distinct()
    return same.unionByName(near)


def star_links(df: DataFrame, key: str, ord_: str = "ord") -> DataFrame:
    """(a, b): each event to the first with its key."""
    first = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(ord_).alias("a"))
    return df.select(key, F.col(ord_).alias("b")).join(first, key).where("a < b").select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """node, label: the least node linked to it through any number of links. In each round every label is hooked to the least label
    around it, the trees that this makes are folded onto their roots by doubling, and links are moved to the roots; links within a
    tree are gone then. So labels at least halve, a chain takes one round, and the rounds go on until no link is left."""
    labels = links.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("label", F.col("node"))
    edges, rounds = cut(links.select("a", "b").where("a <> b").distinct()), []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = cut(both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("x"), F.least("a", "low").alias("y")))
        while True:
            twice = up.join(up.select(F.col("x").alias("y"), F.col("y").alias("z")), "y")
            if twice.where("z <> y").isEmpty():
                break
            up = cut(twice.select("x", F.col("z").alias("y")))
        rounds.append(up)
        moved = edges.join(up.select(F.col("x").alias("a"), F.col("y").alias("p")), "a").join(up.select(F.col("x").alias("b"), F.col("y").alias("q")), "b")
        edges = cut(moved.where("p <> q").select(F.col("p").alias("a"), F.col("q").alias("b")).distinct())
    for up in rounds:
        labels = labels.join(up.select(F.col("x").alias("label"), F.col("y").alias("to")), "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    return cut(labels)


_ALL = (1 << 64) - 1


def _bands_of(bits: int) -> list[tuple[int, int]]:
    return [(i, (bits & _ALL) >> low & ((1 << n) - 1)) for i, (low, n) in enumerate(_CUTS)]


class _Store:
    """What is known while one component is decided."""

    def __init__(self) -> None:
        self.keys, self.by_source, self.by_content, self.near, self.kept = set(), {}, {}, {}, 0

    def keep(self, r) -> None:
        self.keys.add(r.dedup_key)
        if r.event_id is not None:
            if r.exact_source_key is not None:
                self.by_source[r.exact_source_key] = (r.event_id, r.content)
            if r.content is not None:
                self.by_content[r.content] = r.event_id
            if r.bits:
                for band in _bands_of(r.bits):
                    self.near.setdefault(band, []).append((self.kept, r.bits, r.event_id))
                self.kept += 1

    def decide(self, r) -> tuple[str, str | None]:
        if r.dedup_key in self.keys:
            return "exact_duplicate", None
        if r.exact_source_key in self.by_source:
            was, content = self.by_source[r.exact_source_key]
            return ("exact_duplicate" if content == r.content else "update_of_existing"), was
        if r.content in self.by_content:
            return "content_duplicate", self.by_content[r.content]
        near = [x for band in _bands_of(r.bits) for x in self.near.get(band, ()) if ((x[1] ^ r.bits) & _ALL).bit_count() <= MAX_BITS] if r.bits else []
        return ("near_duplicate", min(near)[2]) if near else ("new", None)


def _decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by component, known records first, then order: streamed, so that a task holds what a component kept, not its rows."""
    label, store = None, _Store()
    for pdf in batches:
        out = []
        for r in pdf.itertuples():
            if r.label != label:
                label, store = r.label, _Store()
            if not r.fresh:
                store.keep(r)
                continue
            decision, of = store.decide(r)
            out.append((r.ord, decision, of))
            if decision in ("new", "update_of_existing"):
                store.keep(r)
        yield pd.DataFrame(out, columns=["ord", "dedup_decision", "duplicate_of_event_id"])


_KEYS = ("event_id", "dedup_key", "exact_source_key", "content", "bits")


def _touched(known: DataFrame, rows: DataFrame) -> DataFrame:
    """The known records that share a key with an event or nearly its simhash; the others cannot matter to any decision."""
    x = known.withColumn("n", F.monotonically_increasing_id())
    ids = [x.join(rows.select(k).where(F.col(k).isNotNull()).distinct(), k, "left_semi").select("n") for k in ("dedup_key", "exact_source_key", "content")]
    new = rows.where("bits <> 0").select("bits").distinct().select(F.col("bits").alias("y"), F.explode(bands(F.col("bits"))).alias("k"))
    old = x.where("bits <> 0").select("n", "bits", F.explode(bands(F.col("bits"))).alias("k"))
    ids.append(old.join(new, "k").where(F.bit_count(F.col("bits").bitwiseXOR(F.col("y"))) <= MAX_BITS).select("n"))
    every = ids[0]
    for i in ids[1:]:
        every = every.unionByName(i)
    return x.join(every.distinct(), "n", "left_semi")


def decide(events: DataFrame, ord_: str, bits: str, content: str = "normalized_content_hash", known: DataFrame | None = None) -> DataFrame:
    """ord, dedup_decision, duplicate_of_event_id of every event, as one pass in order of `ord_` (a unique bigint) would decide.

    1 a known dedup_key is an exact duplicate (of nothing named); 2 a known source key is exact with the same content, else an
    update of the latest; 3 known content is a content duplicate; 4 a simhash within four bits of a kept one is a near duplicate of
    the first such; 5 the rest is new. New events and updates are kept, others leave no trace. Null simhashes count as zero.
    known: records accepted before (as sources.index.known gives them), taken first, in order of observed_at_ms.
    A component is the unit of work: linked events are decided one after another by definition.
    """
    rows = events.select(F.col(ord_).cast("bigint").alias("ord"), "event_id", "dedup_key", "exact_source_key", F.col(content).alias("content"), F.coalesce(bits, F.lit(0)).cast("bigint").alias("bits"))
    rows = rows.withColumns({"at": F.col("ord"), "fresh": F.lit(True)})
    if known is not None:
        old = cut(known.select(*_KEYS, F.col("observed_at_ms").alias("at")).withColumn("bits", F.coalesce("bits", F.lit(0))))  # numbered below: must not be read anew
        old = _touched(old, rows).select((F.col("n") - (1 << 62)).alias("ord"), *_KEYS, F.coalesce("at", F.lit(0)).alias("at"), F.lit(False).alias("fresh"))
        rows = cut(rows.unionByName(old))
    links = star_links(rows, "dedup_key").unionByName(star_links(rows, "exact_source_key")).unionByName(star_links(rows, "content")).unionByName(near_links(rows)).distinct()
    label = components(links)
    tied = rows.join(label, rows["ord"] == label["node"]).drop("node")
    ordered = tied.repartition("label").sortWithinPartitions("label", "fresh", "at", "ord")
    done = ordered.mapInPandas(_decide, "ord bigint, dedup_decision string, duplicate_of_event_id string")
    free = rows.where("fresh").join(label, rows["ord"] == label["node"], "left_anti").select("ord", F.lit("new").alias("dedup_decision"), F.lit(None).cast("string").alias("duplicate_of_event_id"))
    return done.unionByName(free)


def skipped(decision: Column) -> Column:
    return decision.isin("exact_duplicate", "content_duplicate", "near_duplicate")


"""Exactly one copy of each message out of an at-least-once delivery.

Identifiers are dictionary-encoded exactly, each shard of them densely. What was seen is a bitmap per shard and range of 32768 codes,
kept apart from the dictionary: an identifier may have a code and not have been seen. Of a batch, one arrival per bit that is not yet
set is taken; then the new bits are united with the old ones, which takes effect by the renaming of one marker file. A batch that
fails before that leaves the store as it was, and one that is run again after it is answered from what was written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewire.functions.bitmaps import bit_at
from tidewire.functions.instants import tidy
from tidewire.marks import Marks
from tidewire.session import scratch

SHARDS = 256
_LAST = (1 << 63) - 1
_CODES, _BITS, _TAKEN = "id string, shard int, code bigint", "shard int, bucket bigint, bits binary", "shard int, code bigint, delivery bigint"


def message_id(text: Column) -> Column:
    """White space around it and case disregarded; null for a blank one."""
    return F.nullif(F.lower(tidy(text)), F.lit(""))


class SeenStore:
    """Dictionary and seen-bitmaps below one shared path. Each batch adds files of its own: codes of ids that are new, bits that it set
    and the arrivals it took; nothing old is rewritten but by compact(). A task numbers the new ids of a batch in one shard, so
    `shards` (fixed for the life of a store) goes by the size of batches, not of the history."""

    def __init__(self, spark: SparkSession, path: str, shards: int = SHARDS):
        self.spark, self.path, self.shards = spark, path.rstrip("/"), shards
        self._coded, self._seen, self._bases, self._forgotten = (Marks(spark, f"{self.path}/marks-{x}") for x in ("coded", "seen", "base", "forgotten"))

    def _open(self, what: str, names: list[str], schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{what}/{n}" for n in names]) if names else self.spark.createDataFrame([], schema)

    def encode(self, rows: DataFrame, batch_id: str) -> DataFrame:
        """rows with shard and code of their `id`; ids that have none yet get the next codes of their shard."""
        done = self._coded.names()
        if batch_id not in done:
            ids = rows.select("id").distinct().withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(self.shards)).cast("int"))
            base = F.lit(0).cast("bigint")
            if done:
                known = self._open("codes", done, _CODES)
                ids = ids.join(known.select("id"), "id", "left_anti").join(known.groupBy("shard").agg((F.max("code") + 1).alias("base")), "shard", "left")
                base = F.coalesce("base", base)
            code = F.row_number().over(Window.partitionBy("shard").orderBy("id")) - 1 + base
            ids.select("id", "shard", code.cast("bigint").alias("code")).write.mode("overwrite").parquet(f"{self.path}/codes/{batch_id}")
            self._coded.add(batch_id)
        return rows.join(self._open("codes", self._coded.names(), _CODES), "id")

    def _live(self) -> list[str]:
        """Batches whose bits count: all after the last that was forgotten."""
        seen, gone = self._seen.names(), self._forgotten.names()
        return seen[seen.index(gone[-1]) + 1 :] if gone else seen

    def bitmaps(self) -> DataFrame:
        """shard, bucket and the united bits of all batches that count."""
        live, base = self._live(), self._bases.names()
        first, last = base[-1].split("~") if base else ("", "")
        if live and first == live[0] and last in live:
            parts = self._open("base", [base[-1]], _BITS).unionByName(self._open("bits", live[live.index(last) + 1 :], _BITS))
        else:
            parts = self._open("bits", live, _BITS)
        return parts.groupBy("shard", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))

    def take(self, coded: DataFrame, batch_id: str) -> DataFrame:
        """shard, code and delivery of one arrival per unset bit, of several of a batch the least in (o, d); then their bits are set.
        coded: shard, code and the struct a (o, d)."""
        if batch_id not in self._seen.names():
            one = coded.groupBy("shard", "code").agg(F.min("a").alias("a")).withColumn("bucket", F.bitmap_bucket_number("code"))
            if self._live():
                set_ = bit_at(F.col("bits"), F.bitmap_bit_position("code"))
                one = one.join(self.bitmaps(), ["shard", "bucket"], "left").where(~set_)
            one.select("shard", "code", F.col("a.d").alias("delivery")).write.mode("overwrite").parquet(f"{self.path}/taken/{batch_id}")
            new = self._open("taken", [batch_id], _TAKEN)
            bits = new.groupBy("shard", F.bitmap_bucket_number("code").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("code")).alias("bits"))
            bits.write.mode("overwrite").parquet(f"{self.path}/bits/{batch_id}")
            self._seen.add(batch_id)
        return self._open("taken", [batch_id], _TAKEN)

    def accept(self, batch: DataFrame, batch_id: str, key: str = "event_id", order: str = "created_at_ms", delivery: str = "delivery_id") -> DataFrame:
        """delivery ids taken of this batch: of each message not seen in earlier batches the arrival smallest in (order, delivery);
        nulls in order come last. Rows with a null or blank id are no messages and are not in it."""
        if batch_id in self._seen.names():
            return self._open("taken", [batch_id], _TAKEN)
        return self.take(self.encode(_arrivals(batch, key, order, delivery).groupBy("id").agg(F.min("a").alias("a")), batch_id), batch_id)

    def compact(self) -> None:
        """One bitmap per shard and bucket in place of one a batch."""
        live = self._live()
        if live:
            self.bitmaps().write.mode("overwrite").parquet(f"{self.path}/base/{live[0]}~{live[-1]}")
            self._bases.add(f"{live[0]}~{live[-1]}")

    def forget(self, batch_id: str) -> None:
        """Ends the retention of that batch and all before it: their messages count as new if they come again."""
        if batch_id in self._live():
            self._forgotten.add(batch_id)

    def seen_count(self) -> int:
        """Messages seen, from the bitmaps alone."""
        return self.bitmaps().agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0))).first()[0]


def _arrivals(rows: DataFrame, key: str, order: str, delivery: str) -> DataFrame:
    a = F.struct(F.coalesce(F.col(order).cast("bigint"), F.lit(_LAST)).alias("o"), F.col(delivery).cast("bigint").alias("d"))
    return rows.select(message_id(F.col(key)).alias("id"), a.alias("a")).where("id is not null")


def redeliveries(rows: DataFrame, store: SeenStore, batch_id: str, key: str = "event_id", order: str = "created_at_ms", delivery: str = "delivery_id", stretches: int = 1) -> DataFrame:
    """The rows to drop: all of a message but the one taken (see SeenStore.accept). All columns are kept.

    With several stretches the rows are taken in that many stretches of `order`, one after the other, each as a batch of its own: a
    message is new in a stretch if no earlier stretch set its bit. Arrivals of one message and stretch are reduced to the least
    before anything is shuffled, and rows are matched by their unique delivery id, so a message delivered very many times burdens
    no task. Equal values of `order` are never parted; where all are equal one stretch holds everything.
    """
    arrivals = _arrivals(rows, key, order, delivery)
    if stretches <= 1:
        taken = store.accept(rows, batch_id, key, order, delivery)
    else:
        share = F.array(*[F.lit(i / stretches) for i in range(1, stretches)])
        bounds = sorted(set(arrivals.agg(F.percentile_approx(F.col("a.o"), share)).first()[0] or []))  # at most stretches - 1 numbers
        stretch = F.lit(0)
        for b in bounds:
            stretch = stretch + (F.col("a.o") > b).cast("int")
        best = arrivals.withColumn("s", stretch).groupBy("id", "s").agg(F.min("a").alias("a"))
        at = scratch(rows.sparkSession, "coded")
        store.encode(best, batch_id).select("shard", "code", "s", "a").write.partitionBy("s").parquet(at)
        coded = rows.sparkSession.read.schema("shard int, code bigint, a struct<o:bigint,d:bigint>, s int").parquet(at)
        taken = None
        for s in range(len(bounds) + 1):
            part = store.take(coded.where(F.col("s") == s), f"{batch_id}-{s}")
            taken = part if taken is None else taken.unionByName(part)
    kept = taken.select(F.col("delivery").alias("__kept"))
    return rows.where(message_id(F.col(key)).isNotNull()).join(kept, F.col(delivery) == F.col("__kept"), "left_anti")

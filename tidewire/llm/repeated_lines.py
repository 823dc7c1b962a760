"""Lines that stand in many documents of one source.

Of each line of a source, as it is written, the documents holding it are kept as a compressed bitmap: containers of 32768 document
numbers each, an array of positions while sparse and a bit string once dense. The bitmaps of a line's variants (case, spacing,
punctuation, numbers, decoration) are united into one: a document that holds two of them counts once. Cardinalities of the union are
exact. A line of a document is deleted if the document's bit is set in the united bitmap of a line that is repeated often enough.
Containers bound every group: a line that stands in a third of all documents is spread over as many groups as there are containers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions.bitmaps import bit_at
from tidewire.marks import Marks
from tidewire.session import scratch

CONTAINER = 1 << 15
DENSE = 2048  # occurrences of a line from which its containers are bit strings (4096 bytes either way)


def line_letters(line: Column) -> Column:
    """The letters of a line, lower-cased, in order; null if there are none."""
    return F.nullif(F.lower(F.regexp_replace(line, r"[^\p{L}]+", "")), F.lit(""))


def numbered(df: DataFrame, doc: str, source: str, body: str, order: str) -> DataFrame:
    """One row per document (of its rows the one smallest in `order`, a unique bigint that then numbers the document)."""
    rows = df.where(F.col(doc).isNotNull() & F.col(body).isNotNull() & F.col(source).isNotNull())
    first = F.min_by(F.struct(F.col(source).alias("s"), F.col(body).alias("b")), F.col(order))
    return rows.groupBy(F.col(doc).alias("__doc")).agg(F.min(order).cast("bigint").alias("__no"), first.alias("x")).select("__doc", "__no", F.col("x.s").alias("__source"), F.col("x.b").alias("__body"))


def keyed_lines(docs: DataFrame) -> DataFrame:
    """Each line that has letters: its document, number, two independent 64-bit hashes that stand for (source, letters), and one of
    the line as it is written, which parts its variants."""
    line = docs.select("__doc", "__no", "__source", F.posexplode(F.split("__body", "\n", -1)).alias("__i", "__line"))
    keyed = line.select("__doc", "__no", (F.col("__i") + 1).alias("__line_no"), "__source", line_letters(F.col("__line")).alias("__l"), F.xxhash64("__line").alias("__x")).where("__l is not null")
    return keyed.select("__doc", "__no", "__line_no", F.xxhash64("__source", "__l").alias("__k1"), F.xxhash64("__l", F.lit(17), "__source").alias("__k2"), "__x")


def containers(lines: DataFrame) -> DataFrame:
    """Of keyed lines with __bucket, __pos and __dense: the container of each line as written, as __few (positions) or __bits."""
    group = ["__k1", "__k2", "__x", "__bucket"]
    few = lines.where("not __dense").groupBy(*group).agg(F.collect_set("__pos").alias("__few"))
    many = lines.where("__dense").groupBy(*group).agg(F.bitmap_construct_agg(F.col("__pos").cast("bigint")).alias("__bits"))
    return few.withColumn("__bits", F.lit(None).cast("binary")).unionByName(many.withColumn("__few", F.lit(None).cast("array<int>")))


def united(boxes: DataFrame) -> DataFrame:
    """The containers of a line's variants as one, and its exact cardinality __n."""
    group = ["__k1", "__k2", "__bucket"]
    few = boxes.where("__few is not null").groupBy(*group).agg(F.array_distinct(F.flatten(F.collect_list("__few"))).alias("__few"))  # fewer than DENSE positions
    many = boxes.where("__bits is not null").groupBy(*group).agg(F.bitmap_or_agg("__bits").alias("__bits"))
    few = few.select(*group, "__few", F.lit(None).cast("binary").alias("__bits"), F.size("__few").cast("bigint").alias("__n"))
    return few.unionByName(many.select(*group, F.lit(None).cast("array<int>").alias("__few"), "__bits", F.bitmap_count("__bits").alias("__n")))


class LineBitmaps:
    """Lines of documents below one shared path, batch by batch; a batch counts once its marker is there. Documents are numbered by
    `order`, unique over all batches."""

    def __init__(self, spark: SparkSession, path: str, salts: int = 8):
        self.spark, self.path, self.salts = spark, path.rstrip("/"), salts
        self._marks = Marks(spark, f"{self.path}/marks")

    def add(self, df: DataFrame, batch_id: str, doc: str, source: str, body: str, order: str) -> None:
        if batch_id not in self._marks.names():
            keyed_lines(numbered(df, doc, source, body, order)).write.mode("overwrite").parquet(f"{self.path}/lines/{batch_id}")
            self._marks.add(batch_id)

    def _lines(self, batches: list[str]) -> DataFrame:
        rows = self.spark.read.parquet(*[f"{self.path}/lines/{b}" for b in batches])
        return rows.withColumns({"__bucket": F.shiftright("__no", 15), "__pos": F.pmod("__no", F.lit(CONTAINER)).cast("int"), "__salt": F.pmod("__no", F.lit(self.salts)).cast("int")})

    def _often(self, min_docs: int) -> DataFrame:
        """Lines with at least min_docs occurrences: these bound cardinalities from above, so no other line needs a bitmap. Salted."""
        n = self._lines(self._marks.names()).groupBy("__k1", "__k2").agg(F.count(F.lit(1)).alias("__c")).where(F.col("__c") >= min_docs)
        return n.select("__k1", "__k2", (F.col("__c") >= DENSE).alias("__dense"), F.explode(F.array(*map(F.lit, range(self.salts)))).alias("__salt"))

    def repeated(self, min_docs: int, often: DataFrame) -> DataFrame:
        """The united bitmaps of lines that stand in at least min_docs documents."""
        boxes = united(containers(self._lines(self._marks.names()).join(often, ["__k1", "__k2", "__salt"])))
        enough = boxes.groupBy("__k1", "__k2").agg(F.sum("__n").alias("__all")).where(F.col("__all") >= min_docs).select("__k1", "__k2")
        return boxes.join(enough, ["__k1", "__k2"], "left_semi")

    def find(self, min_docs: int, doc: str, batches: list[str] | None = None) -> DataFrame:
        """`doc` and line_no of the lines to delete, of all documents or of some batches: what was repeated over all batches."""
        often = self._often(min_docs)
        held = F.coalesce(F.array_contains("__few", F.col("__pos")), F.lit(False)) | bit_at(F.col("__bits"), F.col("__pos"))
        lines = self._lines(batches or self._marks.names()).join(often, ["__k1", "__k2", "__salt"])
        found = lines.join(self.repeated(min_docs, often), ["__k1", "__k2", "__bucket"]).where(held)
        return found.select(F.col("__doc").alias(doc), F.col("__line_no").alias("line_no"))


def repeated_lines(df: DataFrame, doc: str, source: str, body: str, order: str, min_docs: int = 5, salts: int = 8) -> DataFrame:
    """`doc` and line_no (from 1, blank lines counted) of every line whose letters stand in at least min_docs documents of its source.

    Rows of one document count once. Null documents, sources and bodies have no lines; lines without a letter are none; an empty
    table gives an empty one. Lines are split at \\n only. Whole bodies are read whatever their length; other columns are left out.
    """
    store = LineBitmaps(df.sparkSession, scratch(df.sparkSession, "lines"), salts)
    store.add(df, "all", doc, source, body, order)
    return store.find(min_docs, doc)


def without_lines(df: DataFrame, drop: DataFrame, doc: str, body: str) -> DataFrame:
    """df with the lines listed in drop (`doc`, line_no) taken out of body; all other rows and columns as they are."""
    by = drop.groupBy(F.col(doc).alias("__d")).agg(F.collect_set("line_no").alias("__drop"))  # at most the lines of one document
    kept = F.array_join(F.filter(F.split(body, "\n", -1), lambda x, i: ~F.array_contains(F.col("__drop"), i + 1)), "\n")
    out = df.join(by, F.col(doc) == F.col("__d"), "left")
    return out.withColumn(body, F.when(F.col("__drop").isNull(), F.col(body)).otherwise(kept)).drop("__d", "__drop")

"""Queries of encoding (p8) and leakage (p9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm.byte_bpe import encode_texts
from tidewire.llm.leakage import leaks
from tidewire.session import read, spread


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(spread(read(spark, sf_dir, "documents").select("doc_id", "text")), "doc_id", "text")


def _leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(spread(read(spark, sf_dir, "documents").select("doc_id", "text")), "doc_id", "text", read(spark, sf_dir, "eval_item"), "item_id", "text")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.col("held_words") * 5 >= F.col("item_words") * 2  # at least 0.4, in whole numbers
    return _leaks(spark, sf_dir).where(held).select("doc_id", "item_id").distinct()


def p9_leaked_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each leaked item with the number of documents that hold it."""
    return p9_found(spark, sf_dir).groupBy("item_id").agg(F.count(F.lit(1)).alias("documents"))


QUERIES = {"p8_ids": p8_ids, "p9_found": p9_found, "p9_leaked_items": p9_leaked_items}

def _words(table: str, key: str) -> str:
    """Words of texts without tags; the character references that occur in the tables stand for no letters."""
    plain = r"regexp_replace(regexp_replace(text, '(?s)</?[A-Za-z][^<>]*>|<!--.*?-->|<[!?][^<>]*>', ' ', 'g'), '&(?:nbsp|[lr][sd]quo|quot|amp|lt|gt|apos|#x27|#39);', ' ', 'g')"
    return rf"SELECT {key}, regexp_extract_all(lower({plain}), '[\p{{L}}\p{{N}}]+') AS w FROM {table} WHERE text IS NOT NULL"


_LEAKS = f"""WITH d AS ({_words('documents', 'doc_id')}), i AS ({_words('eval_item', 'item_id')}),
dg AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 6), lambda k: array_to_string(w[k:k+7], ' '))) AS g FROM d WHERE len(w) >= 8),
ig AS (SELECT item_id, len(w) AS n, unnest(range(1, len(w) - 6)) AS k, unnest(list_transform(range(1, len(w) - 6), lambda k: array_to_string(w[k:k+7], ' '))) AS g FROM i WHERE len(w) >= 8),
hit AS (SELECT DISTINCT doc_id, item_id, n, k FROM dg JOIN ig USING (g)),
held AS (SELECT DISTINCT doc_id, item_id, n, unnest(range(k, k + 8)) AS p FROM hit),
found AS (SELECT doc_id, item_id FROM held GROUP BY doc_id, item_id, n HAVING count(*) * 5 >= n * 2)"""

SQL = {
    "p9_found": f"{_LEAKS} SELECT doc_id, item_id FROM found",
    "p9_leaked_items": f"{_LEAKS} SELECT item_id, count(*) AS documents FROM found GROUP BY 1",
}

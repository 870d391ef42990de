"""Exact duplicates by sorting contents: no Python code runs on the executors.

1. Copies inside one input partition are combined before anything is shuffled, so that a text which makes up a
   third of the corpus becomes one row per partition.
2. Sampled splitters range-partition the combined rows by the head of the normalised text and its digest. The head
   keeps the splitters short; the digest separates different texts with one long common head.
3. An external sort puts equal texts next to each other and whole texts are compared between neighbours.
4. Each document reads its group by digest; that join is one adaptive execution can split at a busy group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgemart.llm.common import WHITE_SPACE

HEAD_CHARS = 48

ORACLE_SQL = r"""
    WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS chars,
                      regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
               FROM documents)
    SELECT doc_id, first_value(doc_id) OVER best AS keep_id,
           count(*) OVER (PARTITION BY body) AS group_size,
           first_value(doc_id) OVER best = doc_id AS kept, sha256(body) AS text_sha256
    FROM n WINDOW best AS (PARTITION BY body ORDER BY chars DESC, doc_id)"""


def normalised(text: Column) -> Column:
    """The text without ASCII white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


def copies(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the one with most code points stays, then the smallest doc_id. Null and empty texts form one
    group. A repeated doc_id with an equal text counts in group_size and each such row says kept when that id
    stays; a null doc_id is larger than all others. Other columns are not read.
    """
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    base = base.select("doc_id", F.char_length("text").alias("chars"), normalised(F.col("text")).alias("body"))
    base = base.withColumn("text_sha256", F.sha2("body", 256))
    rank = F.struct((-F.col("chars")).alias("less"), F.col("doc_id").isNull().alias("unnamed"), "doc_id")
    combined = (
        base.withColumn("part", F.spark_partition_id())
        .groupBy(F.substring("body", 1, HEAD_CHARS).alias("head"), "text_sha256", "body", "part")
        .agg(F.count(F.lit(1)).alias("rows"), F.min(rank).alias("best"))
    )
    same = Window.partitionBy("head", "text_sha256", "body")
    groups = (
        combined.repartitionByRange("head", "text_sha256")
        .withColumn("place", F.row_number().over(same.orderBy("best")))
        .withColumn("group_size", F.sum("rows").over(same))
        .filter("place = 1")
        .select("text_sha256", F.col("best.doc_id").alias("keep_id"), "group_size")
    )
    return base.select("doc_id", "text_sha256").join(groups, "text_sha256").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns; of rows repeating the id that stays, all stay."""
    kept = copies(docs).filter("kept").select(F.col("doc_id").alias("__keep")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["__keep"]), "left_semi")

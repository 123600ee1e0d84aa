"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

Texts are equal when identical after no change; null counts as empty. Of equal
texts the row with the largest doc_id stays (a null doc_id is the smallest; of
repeated rows with the same doc_id one stays). Empty tables give empty results.
Columns other than the key and the text are carried by :func:`drop_copies` as they
are; :func:`copy_report` does not look at them, so clashing names are harmless.

Each round only looks at what the round before left over: lengths are counted by
a partial + final aggregate; prefix hashes are taken only of texts whose length
occurs again; full hashes only of texts whose (length, prefix hash) occurs again.
No text is shuffled to find the groups; the hot groups are combined on the map side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import saved, whole, whole_row

#: code points hashed in the second round
PREFIX = 256
#: a set of (length, prefix hash) keys up to this many rows (16 bytes each) may be broadcast
BROADCAST_KEYS = 500_000

LEN, PRE, SHA, RID = "_xd_len", "_xd_prefix", "_xd_sha", "_xd_row"


def _suspects(docs: DataFrame, text: str, prefix_chars: int) -> DataFrame:
    """(length, prefix hash) of which there are two or more, as a written table."""
    length = F.octet_length(whole(text))
    again = saved(docs.select(length.alias(LEN)).groupBy(LEN).count().where("count > 1").select(LEN), "lengths")
    if again.count() <= BROADCAST_KEYS:      # one row per length in use: few, however many documents
        again = F.broadcast(again)
    some = docs.select(length.alias(LEN), F.xxhash64(F.left(whole(text), F.lit(prefix_chars))).alias(PRE))
    some = some.join(again, LEN, "left_semi")
    return saved(some.groupBy(LEN, PRE).count().where("count > 1").select(LEN, PRE), "suspects")


def copy_report(docs: DataFrame, key: str = "doc_id", text: str = "text", prefix_chars: int = PREFIX,
                digest_all: bool = True) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    ``digest_all`` also fills ``text_sha256`` of texts that no later round needs to
    look at; otherwise theirs is null.
    """
    narrow = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    suspects = _suspects(narrow, "text", prefix_chars)
    few = suspects.count() <= BROADCAST_KEYS
    keyed = narrow.select("doc_id", F.monotonically_increasing_id().alias(RID), F.octet_length(whole("text")).alias(LEN),
                          F.xxhash64(F.left(whole("text"), F.lit(prefix_chars))).alias(PRE),
                          *([F.col("text")] if few and not digest_all else [F.sha2(whole("text"), 256).alias(SHA)]))
    right = suspects.withColumn("_xd_again", F.lit(True))
    rows = keyed.join(F.broadcast(right) if few else right, [LEN, PRE], "left")
    if few and not digest_all:
        rows = rows.withColumn(SHA, F.when(F.col("_xd_again"), F.sha2(whole("text"), 256))).drop("text")
    rows = saved(rows, "hashed")
    groups = (rows.where("_xd_again").groupBy(SHA, LEN)
              .agg(F.max(F.struct("doc_id", RID)).alias("_xd_keep"), F.count(F.lit(1)).alias("_xd_n")))
    groups = saved(groups, "groups")        # a plain join of two tables: the rows of a hot group are split
    survivors = rows.where("_xd_again").join(groups, [SHA, LEN])
    rest = rows.where("_xd_again is null")
    out = survivors.select("doc_id", F.col("_xd_keep.doc_id").alias("keep_id"), F.col("_xd_n").alias("group_size"),
                           (F.col("_xd_keep." + RID) == F.col(RID)).alias("kept"), F.col(SHA).alias("text_sha256"))
    return out.unionAll(rest.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                                    F.lit(True).alias("kept"), F.col(SHA).alias("text_sha256")))


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", prefix_chars: int = PREFIX) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns unchanged.

    Rows whose (length, prefix hash) is unique pass without a shuffle; the others are
    grouped by full hash and the largest (doc_id, remaining columns) stays.
    """
    suspects = _suspects(docs, text, prefix_chars)
    few = suspects.count() <= BROADCAST_KEYS
    right = suspects.withColumn("_xd_again", F.lit(True))
    row, order = whole_row(docs, key)
    keyed = docs.select(row.alias("row"), order.alias("order"), whole(text).alias("_xd_text"), F.octet_length(whole(text)).alias(LEN),
                        F.xxhash64(F.left(whole(text), F.lit(prefix_chars))).alias(PRE))
    flagged = keyed.join(F.broadcast(right) if few else right, [LEN, PRE], "left")
    kept = (flagged.where("_xd_again").withColumn(SHA, F.sha2("_xd_text", 256))
            .groupBy(SHA, LEN).agg(F.max_by("row", "order").alias("row")))
    return flagged.where("_xd_again is null").select("row").unionAll(kept.select("row")).select("row.*")


def op9_exact_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return copy_report(docs)


SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""

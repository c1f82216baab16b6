"""Exact deduplication with a heavy-hitter split, in DataFrame operations only.

Texts are equal when they are equal without the characters 0x20 and 0x09 to 0x0D. Of equal texts the
row with most code points stays, then the smallest doc_id, then the first row.

1. One pass over the text writes a row per document: row number, id, SHA-256 digest, code points.
2. A frequent-items sketch (Misra-Gries counters with bulk decrements) over the digests' hashes, built in
   parts and merged, names at most ``HEAVY`` candidates; every digest of more than a fixed share of
   all rows is among them. Their exact groups are counted, with map-side combination, and the winners
   found: false candidates drop out here, so the split never decides what is equal.
3. The winners, at most ``HEAVY`` rows, are broadcast: rows of heavy digests are settled where they are.
4. All other digests, none of them frequent, are grouped by an ordinary shuffle.

Defined results: null counts as empty text; rows without doc_id come after all others of their group; of
fully equal rows one stays. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.llm.textbatch import prepare
from rankloom.session import staged

#: Winners that may be broadcast.
HEAVY = 4096
#: Counters of a sketch; a digest of more than 1 / 8192 of the rows is always found.
COUNTERS = 32768
#: Parts in which sketches are merged before the last merge.
PARTS = 32


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.translate(F.coalesce(text, F.lit("")), " \t\n\x0b\x0c\r", "").cast("binary"), 256))


def heavy_hashes(rows: DataFrame, column: str) -> DataFrame:
    """At most ``HEAVY`` values of a long column, the frequent ones among them."""
    parts = rows.groupBy(F.pmod(F.spark_partition_id(), F.lit(PARTS)).alias("part")).agg(
        F.expr(f"approx_top_k_accumulate({column}, {COUNTERS})").alias("sketch")
    )
    # grouped, as the sketch of an empty partition cannot be merged
    merged = parts.groupBy(F.lit(0).alias("all")).agg(F.expr(f"approx_top_k_combine(sketch, {COUNTERS})").alias("sketch"))
    top = merged.select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {HEAVY})")).alias("top"))
    return top.select(F.col("top.item").alias(column)).filter(F.col("top.count") > 1)


def _order() -> list[Column]:
    return [F.col("chars").desc(), F.col("doc_id").asc_nulls_last(), F.col("row").asc()]


def exact_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row."""
    prepare(docs.sparkSession)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"),
        digest(F.col(text)).alias("digest"), F.char_length(F.coalesce(F.col(text), F.lit(""))).alias("chars"),
    )
    rows = staged(rows, "digests").withColumn("hash", F.xxhash64("digest"))

    candidates = staged(heavy_hashes(rows, "hash"), "heavy")
    suspects = rows.join(F.broadcast(candidates), "hash")
    best = F.min_by(F.struct("doc_id", "row"), F.struct(-F.col("chars"), F.col("doc_id").isNull(), "doc_id", "row"))
    winners = staged(
        suspects.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), best.alias("best"))
        .select("digest", "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row")),
        "winners",
    )
    settled = rows.join(F.broadcast(winners), "digest")
    rest = rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    ranked = Window.partitionBy("digest").orderBy(*_order()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ordinary = rest.select(
        "*", F.count(F.lit(1)).over(ranked).alias("group_size"), F.first("doc_id").over(ranked).alias("keep_id"),
        F.first("row").over(ranked).alias("keep_row"),
    )
    names = ["doc_id", "keep_id", "group_size", "row", "keep_row", "digest"]
    return settled.select(*names).unionByName(ordinary.select(*names)).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


#: The same rows in SQL, for unique ids.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), g AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY length(text) DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""

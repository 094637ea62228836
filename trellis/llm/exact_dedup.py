"""Exact duplicates by sorting the content.

Texts are range-partitioned by sampled splitters over their content and sorted externally, so that equal ones
are adjacent, and each is compared in full with its neighbour; of equal texts the smallest id stays. The
splitters are bounded: the first characters of the normalised text, then its SHA-256 in place of
the rest, so the sample that the driver takes of them stays small however long the texts are.

A text with more copies than ``hot`` rows would fill one range. Such texts are counted exactly beforehand, on
digests only, with map-side combining; there are at most ``MOST_HOT`` of them, which bounds their table. Their
copies get a salt behind the digest, so they are sorted and compared in many ranges, and
the count over all ranges comes from that table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trellis.llm.common import SPACE, body, whole_rows
from trellis.session import Scratch

HEAD = 16  # characters of the text that lead the sort key
MOST_HOT = 1000
HOT_ROWS = 200  # texts with fewer copies are never split
SALTS = 512


def normalised(text):
    return F.regexp_replace(body(text), SPACE, " ")


def exact_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """For every row ``row`` (a struct of all its columns), ``doc_id, keep_id, group_size, kept, text_sha256``.

    Null texts count as empty. Of equal texts the row with the smallest id is kept, null ids last; of rows that also
    share the id, one. ``keep_id`` is the kept row's id, ``group_size`` counts all rows of the text. Nothing is cut or
    dropped, and an empty table gives no rows."""
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark)
    plain = F.col("row")[text]
    rows = whole_rows(docs).select("row", F.col("row")[id].alias("doc_id"), normalised(plain).alias("content")).select(
        "row", "doc_id", F.substring("content", 1, HEAD).alias("head"), F.sha2(F.col("content").cast("binary"), 256).alias("digest")
    )
    rows = scratch.put(rows, "digests")
    hot = (
        rows.groupBy("digest").agg(F.count("*").alias("hot_size"), F.min("doc_id").alias("hot_keep"))
        .filter(F.col("hot_size") > F.greatest(F.lit(HOT_ROWS), F.lit(rows.count() // MOST_HOT)))
    )
    hot = scratch.put(hot, "hot")
    salt = F.when(F.col("hot_size").isNotNull(), F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).otherwise(F.lit(0))
    keyed = rows.join(F.broadcast(hot), "digest", "left").select(
        "row", "doc_id", "head", "digest", "hot_size", "hot_keep", salt.alias("salt")
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = keyed.repartitionByRange(parts, "head", "digest", "salt").withColumn("content", normalised(plain))
    # The range partitioning already holds these windows' rows together: the window adds the sort only, and
    # finds where a text ends by comparing neighbours' whole content.
    same = Window.partitionBy("head", "digest", "salt", "content")
    order = same.orderBy(F.col("doc_id").asc_nulls_last())
    found = sorted_rows.select(
        "row", "doc_id", "digest", "hot_size", "hot_keep", F.row_number().over(order).alias("place"),
        F.first("doc_id").over(order).alias("first_id"), F.count("*").over(same).alias("copies"),
    )
    is_hot = F.col("hot_size").isNotNull()
    keep_id = F.when(is_hot, F.col("hot_keep")).otherwise(F.col("first_id"))
    return found.select(
        "row", "doc_id", keep_id.alias("keep_id"), F.coalesce("hot_size", "copies").alias("group_size"),
        ((F.col("place") == 1) & F.col("doc_id").eqNullSafe(keep_id)).alias("kept"), F.col("digest").alias("text_sha256"),
    )


def keep_first(docs: DataFrame, id: str = "doc_id", text: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    return exact_duplicates(docs, id, text, scratch).filter("kept").select("row.*")

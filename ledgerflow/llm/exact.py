"""Operator 10: exact deduplication by two-pass Bloom filtering.

Pass 1 marks each text digest in a two-level Bloom filter ("seen", "seen again") built per task
and merged segment by segment in Spark. Pass 2 probes every row: a digest whose cells were all
hit at least twice is *possibly* repeated; only those rows shuffle (map-side combined, so a group
holding a third of the table sends one row per task), the others pass straight through. A false
positive only shuffles one more row; results are exact.

The filter's size is bounded (see ``bloom``): at most 32 MB are broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.bloom import numbered, remove_rows, repeat_filter
from ledgerflow.llm.common import stored

SPACES = r"[\x20\x09-\x0D]+"


def normalised(text):
    """Null counts as empty; every run of ASCII white space becomes one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def _digest(text_col: str):
    return F.unhex(F.sha2(normalised(F.col(text_col)).cast("binary"), 256))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return numbered(docs, id_col, text_col).select("doc_id", _digest("text").alias("digest"), "rid")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Equal texts (after white-space normalisation; null counts as empty) form a group. The row with
    the smallest doc_id stays; a null doc_id sorts after all others, and of rows tied on the smallest
    doc_id exactly one stays. An empty table gives an empty result. Columns other than the two named
    are ignored, whatever their names.
    """
    rows = _keyed(docs, id_col, text_col)
    rows = stored(rows.withColumn("h", F.xxhash64("digest")), "exact-digests")
    maybe_repeated = repeat_filter(rows.select("h"))
    rows = stored(rows.withColumn("maybe", maybe_repeated("h")).drop("h"), "exact-flagged")
    alone = rows.where(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest"
    )
    maybe = rows.where("maybe")
    groups = stored(_groups(maybe), "exact-groups")  # a table of its own, so Spark can split a hot digest's side of the join
    together = maybe.join(groups, "digest").select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("rid") == F.col("best.rid")).alias("kept"), "digest"
    )
    return alone.unionByName(together).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def _groups(rows: DataFrame) -> DataFrame:
    """Per digest: the row that stays (smallest doc_id, nulls last) and the number of rows."""
    first = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "rid")
    return rows.groupBy("digest").agg(F.min(first).alias("best"), F.count(F.lit(1)).alias("group_size"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (a stored table) that stay, with its columns; ties and nulls as in :func:`exact_groups`."""
    keys = _keyed(docs, id_col, text_col)
    keys = stored(keys.withColumn("h", F.xxhash64("digest")), "exact-keys")
    maybe = keys.where(repeat_filter(keys.select("h"))("h"))
    groups = stored(_groups(maybe).where("group_size > 1"), "exact-groups")
    dropped = maybe.join(groups, "digest").where(F.col("rid") != F.col("best.rid")).select("rid")
    return remove_rows(docs, stored(dropped, "exact-dropped"))

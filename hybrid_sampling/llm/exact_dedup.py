"""Exact deduplication by skew-safe combining, in DataFrame operations only.

Copies meet in three steps, each comparing whole texts (the text itself is a
grouping key; the digest only routes):

1. local: every task folds its copies of a text into one row (the map side of the first aggregation);
2. salted: those rows merge by (digest, salt, text), the salt being dealt out by task, so that a
   text with copies in every task meets in several groups;
3. global: the salt winners merge by (digest, text).

Rows then find their group by digest, and only where one digest covers several
texts also by the text. A group with a third of all rows costs one row a task in
step 1, ``salts`` rows in step 2, and a broadcast entry in the last join.

Defined cases: a null text counts as empty; a null id is smaller than any other
(a group of null ids only has a null ``keep_id``); repeated rows with the same
id and text count each, and one of them stays; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import attach, stage


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _winners(rows: DataFrame, salts: int) -> DataFrame:
    """One row for each distinct (digest, text): the largest id and the count."""
    salted = (
        rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        .groupBy("digest", "salt", "text")
        .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    )
    return salted.groupBy("digest", "text").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, digest.

    ``digest`` routes equal texts together; it need not be free of collisions.
    """
    texts = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    rows = texts.withColumn("digest", digest(F.col("text")))
    groups = stage(_winners(rows, salts).select("digest", "keep_id", "group_size"), "exact-groups")
    shared = groups.groupBy("digest").count().filter("count > 1").select("digest")
    slim = rows.select("id", "digest")
    if shared.isEmpty():
        out = attach(slim, groups, "digest", "group_size", F.col("id"))
    else:  # one digest, several texts: those rows are told apart by the text
        alone = attach(slim.join(shared, "digest", "left_anti"), groups.join(shared, "digest", "left_anti"), "digest", "group_size", F.col("id"))
        mixed = rows.join(shared, "digest", "left_semi")
        out = alone.unionByName(mixed.join(_winners(mixed, salts), ["digest", "text"]).select("id", "digest", "keep_id", "group_size"))
    # of repeated rows (same id, same text) one stays
    twin = F.row_number().over(W.partitionBy("digest", "keep_id", "id").orderBy("id"))
    return out.select("id", "keep_id", "group_size", (F.col("id").eqNullSafe(F.col("keep_id")) & (twin == 1)).alias("kept"), "digest")

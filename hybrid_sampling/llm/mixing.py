"""Mixing sources to target weights by repetition rates.

Tokens (words) are counted per source, each source gets a target by its weight
(a target stops at ``max_rate`` times the source; what is over is shared again
by weight), and a source's rate is target / size. Every document is then emitted
floor(rate) times, and once more if its hash falls below the fraction. The hash
takes the seed and the document id (without one the text), so any rerun decides alike and a lost task
repeats its rows.

Defined cases: a null text has no words; a null source is a source of its own,
last in order; a source without words has target 0 and gives none; repeated rows
(same id, or no id and the same text) fall alike; an empty table gives no rows; very long texts are only counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import WORD, attach, packed, stage

#: 13 hexadecimal digits of a digest as a fraction of one.
_HEX13 = float(16**13)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, max_rate: float = 2.0) -> DataFrame:
    """``sizes`` (source, n, source_size; one row a source) with the target and rate of each.

    Sources by code point, null last, take ``weights`` in turn. The sources stand in the order of the level
    at which they fill up (cap / weight); the level that all others share is the first that fills none of them.
    One row a source goes through a window here, after the aggregation of the documents.
    """
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    s = sizes.withColumn("weight", weight).withColumn("cap", F.lit(float(max_rate)) * F.col("source_size").cast("double"))
    s = s.withColumn("full_at", F.col("cap") / F.col("weight"))
    order = W.orderBy("full_at", F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(W.currentRow, W.unboundedFollowing)
    total = F.lit(float(share)) * F.sum(F.col("source_size")).over(W.partitionBy()).cast("double")
    s = s.withColumn("level", (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    level = F.min_by(F.when(F.col("level") <= F.col("full_at"), F.col("level")), F.when(F.col("level") <= F.col("full_at"), F.col("full_at"))).over(W.partitionBy())
    s = s.withColumn("target", F.least(F.col("cap"), F.coalesce(level * F.col("weight"), F.col("cap"))))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size").cast("double")).otherwise(0.0)
    return s.withColumn("rate", rate).select("source", "n", "source_size", "target", "rate")


def _copies(id_: Column, text: Column, rate: Column, seed: int) -> Column:
    own = F.when(id_.isNotNull(), id_.cast("string")).otherwise(F.concat(F.lit(":"), F.sha2(F.coalesce(text, F.lit("")), 256)))
    key = F.concat(F.lit(f"{seed}:"), own)
    u = F.conv(F.substring(F.sha2(key, 256), 1, 13), 16, 10).cast("double") / F.lit(_HEX13)
    whole = F.floor(rate)
    return whole.cast("long") + F.when(u < rate - whole.cast("double"), 1).otherwise(0).cast("long")


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, max_rate: float = 2.0, seed: int = 17) -> DataFrame:
    """Every row of ``docs`` (as struct ``row``) with id, source, size, source_size, target, rate, copies."""
    rows = packed(docs, id=docs[id_col], source=docs[source_col], size=word_count(docs[text_col]))
    sizes = stage(rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size")), "mix-sources")
    targets = stage(source_targets(sizes, weights, share, max_rate), "mix-targets")
    out = attach(rows, targets, "source", "n", F.col("id"))
    return out.withColumn("copies", _copies(F.col("id"), F.col("row").getField(text_col), F.col("rate"), seed)).drop("n")


def mixed(docs: DataFrame, **kw) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as planned, with its own columns."""
    plan = mix_plan(docs, **kw)
    plan = plan.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy"))
    return plan.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])

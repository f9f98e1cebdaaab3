"""Sharding by Karmarkar-Karp differencing: near equal bytes from indivisible groups.

Rows with equal texts are one item, weighed by their bytes. A partial partition
is a list of part sums; the two of largest spread are combined in opposite order
(largest part to smallest) until one is left. What is differenced are units: an
item with more than 1 / ``units`` of all bytes stands for itself (so fewer than
``units`` do), the others are dealt by hash into ``units`` bundles, each as
indivisible as an item. So there are at most twice ``units`` numbers to difference
at any size of the input, and they are fine enough to fill the gaps beside the
largest item.

Defined cases: a null text has no bytes and stands with the empty texts; repeated
rows are a group; a group larger than a shard's share stays whole; null ids come first among the slots of
their piece and are dealt by their text; a very long text is only measured; an empty table
gives no rows.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import attach, stage


def differencing(sums: list[list[int]], parts: int) -> tuple[list[list[int]], list[int]]:
    """Combine partial partitions (each a list of at most ``parts`` sums).

    Returns for each one the part that each of its sums went to, and the sums of the parts, largest first.
    """
    n, heap, nodes = len(sums), [], {}
    for k, own in enumerate(sums):
        own = own + [0] * (parts - len(own))
        order = sorted(range(parts), key=lambda i: (-own[i], i))
        nodes[k] = [order.index(i) for i in range(parts)]
        heap.append((own[order[-1]] - own[order[0]], k, [own[i] for i in order]))
    heapq.heapify(heap)
    tree: list[tuple[int, list[int], int, list[int]]] = []  # of each step: both nodes and where their parts went
    while len(heap) > 1:
        _, a, x = heapq.heappop(heap)
        _, b, y = heapq.heappop(heap)
        both = [p + q for p, q in zip(x, reversed(y), strict=True)]
        order = sorted(range(parts), key=lambda i: (-both[i], i))
        place = [0] * parts
        for j, i in enumerate(order):
            place[i] = j
        tree.append((a, place, b, place[::-1]))
        heapq.heappush(heap, (both[order[-1]] - both[order[0]], n + len(tree) - 1, [both[i] for i in order]))
    final = {n + len(tree) - 1: list(range(parts))} if tree else {0: list(range(parts))}
    for t in range(len(tree) - 1, -1, -1):  # from the last step back to the items
        a, pa, b, pb = tree[t]
        top = final.pop(n + t)
        final[a], final[b] = [top[j] for j in pa], [top[j] for j in pb]
    return [[final[k][j] for j in nodes[k]] for k in range(n)], (heap[0][2] if heap else [])


def kk_partition(items: DataFrame, parts: int, units: int = 8192) -> DataFrame:
    """items (node, weight, ...; distinct nodes, staged) with the column part."""
    total = items.agg(F.sum("weight")).first()[0] or 0
    own, bundle = F.concat(F.lit("item "), F.col("node")), F.concat(F.lit("bundle "), F.pmod(F.xxhash64("node"), F.lit(units)).cast("string"))
    dealt = items.withColumn("unit", F.when(F.col("weight") * units > total, own).otherwise(bundle))

    def combine(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["weight", "unit"], ignore_index=True)
        places, _ = differencing([[int(w)] for w in pdf["weight"]], parts)
        return pd.DataFrame({"unit": pdf["unit"], "part": [p[0] for p in places]})

    sums = dealt.groupBy("unit").agg(F.sum("weight").alias("weight")).withColumn("all", F.lit(0))  # 2 * units rows at most
    placed = stage(sums.groupBy("all").applyInPandas(combine, "unit string, part int"), "kk-parts")
    return dealt.join(F.broadcast(placed), "unit").drop("unit")


def kk_shards(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", units: int = 8192, slot_rows: int = 65_536) -> DataFrame:
    """One row per row of ``docs``: id, size, text_crc32, shard, slot (gapless from 0 in each shard)."""
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(docs[id_col].alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.sha2(text, 256).alias("node"))
    items = stage(rows.groupBy("node").agg(F.sum("size").alias("weight"), F.count(F.lit(1)).alias("n")), "kk-items")
    placed = stage(kk_partition(items, shards, units).select("node", "n", F.col("part").alias("shard")), "kk-shards")
    dealt = attach(rows, placed, "node", "n", F.col("id"))
    # slots: numbered within pieces of a shard, each piece starting where those before it end
    pieces = max(1, -(-(items.agg(F.sum("n")).first()[0] or 0) // (slot_rows * shards)))
    dealt = stage(dealt.select("id", "size", "text_crc32", "shard", F.pmod(F.xxhash64("id", "text_crc32"), F.lit(pieces)).alias("piece")), "kk-rows")
    held = dealt.groupBy("shard", "piece").agg(F.count(F.lit(1)).alias("held"))
    before = W.partitionBy("shard").orderBy("piece").rowsBetween(W.unboundedPreceding, -1)
    start = held.select("shard", "piece", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("start"))
    nth = F.row_number().over(W.partitionBy("shard", "piece").orderBy("id", "text_crc32")) - 1
    out = dealt.withColumn("nth", nth).join(start, ["shard", "piece"])
    return out.select("id", "size", "text_crc32", "shard", (F.col("start") + F.col("nth")).alias("slot"))

"""SimHash near-duplicates: 64-bit fingerprints compared exactly in tiles.

Fingerprints come from shingle hashes in a pandas UDF. The distinct ones are
dealt into tiles of at most about ``tile_rows``; a tile holds fingerprints with
the same population counts in the upper and in the lower half. Two tiles whose
counts differ by more than the radius are never paired (a bit count bounds the
distance from below); every other pair is compared by numpy exclusive-or and bit
counts. A tile pair returns a spanning forest of its links, so thousands of near
copies cost a row each, not a row a pair. Components then grow by contraction,
each round a written table.

Defined cases: a null or empty text has fingerprint zero, linked like any other;
fewer words than the shingle length make one shingle; null ids count as larger
than any id (a component of null ids only has a null id); repeated rows link to
each other; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import attach, packed, stage

_BLOCK = 65_536  # shingles whose bits are counted at once
_CELLS = 1 << 20  # distances held at once


def simhash(text: str | None, width: int, seed: int = 42) -> int:
    """Fingerprint of one text as an unsigned number."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if n > width:
        starts, ends = starts[: n - width + 1], ends[width - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), _BLOCK):
        digests = b"".join([xxhash.xxh64_digest(joined[a:b], seed) for a, b in zip(starts[at : at + _BLOCK].tolist(), ends[at : at + _BLOCK].tolist(), strict=True)])
        counts += np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * counts > len(starts)).tobytes(), "big")


def fingerprint_udf(width: int):
    @F.pandas_udf("long")
    def fingerprint(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            yield pd.Series(np.fromiter((simhash(t, width) for t in part), np.uint64, len(part)).view(np.int64))

    return fingerprint


def _forest(n: int, u: np.ndarray, v: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Labels of nodes 0..n-1 after the links u-v: the smallest node of each component."""
    while True:
        a, b = label[u], label[v]
        if (a == b).all():
            return label
        low, high = np.minimum(a, b), np.maximum(a, b)
        np.minimum.at(label, high, low)
        while (label != label[label]).any():
            label = label[label]


def compare_tiles(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (as two arrays of fingerprints) of all pairs within the radius of two tiles, or inside one."""
    nodes = left if right is None else np.concatenate((left, right))
    other, shift = (left, 0) if right is None else (right, len(left))
    label = np.arange(len(nodes))
    step = max(1, _CELLS // max(len(other), 1))
    for at in range(0, len(left), step):
        near = np.bitwise_count(left[at : at + step, None] ^ other[None, :]) <= radius
        i, j = np.nonzero(near)
        label = _forest(len(nodes), i + at, j + shift, label)
    linked = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[linked], nodes[label[linked]]


def _tile_pairs(prints: DataFrame, radius: int, tile_rows: int) -> DataFrame:
    """Rows (ta, tb, side, fps): both tiles of each pair that the population counts allow."""
    prints = prints.select("fp", F.bit_count(F.shiftrightunsigned("fp", 32)).alias("hi"), F.bit_count(F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))).alias("lo"))
    classes = {(r.hi, r.lo): -(-r.n // tile_rows) for r in prints.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("n")).collect()}  # 33 * 33 rows at most
    spark = prints.sparkSession
    # tiles by number; the partners of a class stand in a table of at most 33 * 33 rows
    first, at = {}, 0
    for c in sorted(classes):
        first[c], at = at, at + classes[c]
    near = [(h, low, classes[h, low], first[h, low], [(first[h + a, low + b], classes[h + a, low + b]) for a in range(-radius, radius + 1) for b in range(abs(a) - radius, radius - abs(a) + 1) if (h + a, low + b) in classes]) for h, low in sorted(classes)]
    plan = spark.createDataFrame(near, "hi int, lo int, tiles int, first long, partners array<struct<first: long, tiles: long>>")
    dealt = prints.join(F.broadcast(plan.select("hi", "lo", "tiles", "first")), ["hi", "lo"])
    tiles = dealt.select("hi", "lo", (F.col("first") + F.pmod(F.xxhash64("fp", F.lit(1)), F.col("tiles"))).alias("tile"), "fp")
    tiles = tiles.groupBy("hi", "lo", "tile").agg(F.collect_list("fp").alias("fps"))  # about tile_rows each
    tiles = tiles.join(F.broadcast(plan.select("hi", "lo", "partners")), ["hi", "lo"])
    ranges = tiles.select("tile", "fps", F.explode("partners").alias("p"))
    pairs = ranges.select("tile", "fps", F.explode(F.sequence(F.col("p.first"), F.col("p.first") + F.col("p.tiles") - 1)).alias("mate"))
    return pairs.select(F.least("tile", "mate").alias("ta"), F.greatest("tile", "mate").alias("tb"), (F.col("tile") > F.col("mate")).alias("second"), "fps")


def links(prints: DataFrame, radius: int, tile_rows: int) -> DataFrame:
    """Spanning links (u, v) between the distinct fingerprints ``fp`` that are at most ``radius`` bits apart."""

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        tiles = {bool(s): np.asarray(f, np.int64).view(np.uint64) for s, f in zip(pdf["second"], pdf["fps"], strict=True)}
        u, v = compare_tiles(tiles[False], tiles.get(True), radius)
        return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

    return _tile_pairs(prints, radius, tile_rows).groupBy("ta", "tb").applyInPandas(compare, "u long, v long")


def components(edges: DataFrame) -> DataFrame | None:
    """(node, root) for every node of the links (u, v) by contraction; None without links.

    Each round every node takes the name of its neighbour of lowest hash, itself included; links between equal
    names go and the others connect the names. No node of locally highest hash gives its name, and the hash
    changes by round, so a share of the names goes each time.
    """
    rounds: list[DataFrame] = []
    edges = stage(edges.filter("u <> v").distinct(), "simhash-links")
    while not edges.isEmpty():
        place = lambda c, k=len(rounds): F.xxhash64(F.lit(k), F.col(c))
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        best = both.groupBy("u").agg(F.min(F.struct(place("v").alias("h"), F.col("v").alias("v"))).alias("b"), F.count(F.lit(1)).alias("degree"))
        parent = stage(best.select(F.col("u").alias("node"), F.when(place("u") < F.col("b.h"), F.col("u")).otherwise(F.col("b.v")).alias("parent"), "degree"), "simhash-parents")
        rounds.append(parent.select("node", "parent"))
        up = attach(edges.withColumnRenamed("u", "node"), parent, "node", "degree", F.col("v")).select(F.col("parent").alias("u"), F.col("v").alias("node"))
        up = attach(up, parent, "node", "degree", F.col("u")).select("u", F.col("parent").alias("v"))
        edges = stage(up.filter("u <> v").distinct(), "simhash-links")
    if not rounds:
        return None
    root = rounds[0].withColumnRenamed("parent", "root")
    for parent in rounds[1:]:
        counts = root.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
        up = stage(counts.join(parent.select(F.col("node").alias("root"), F.col("parent").alias("up")), "root"), "simhash-up")
        root = stage(attach(root, up, "root", "n", F.col("node")).select("node", F.coalesce("up", "root").alias("root")), "simhash-roots")
    return root


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, radius: int = 4, tile_rows: int = 32_768) -> DataFrame:
    """Every row of ``docs`` (as struct ``row``) with id, fp (long), group (a fingerprint), component_id and size of its group."""
    rows = stage(packed(docs, id=docs[id_col].cast("long"), fp=fingerprint_udf(width)(docs[text_col])), "simhash-rows")
    prints = stage(rows.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")), "simhash-prints")
    roots = components(links(prints.select("fp"), radius, tile_rows))
    if roots is None:
        groups = prints.select("fp", "n", F.col("fp").alias("group"), F.col("least").alias("component_id"))
    else:
        rooted = prints.join(roots, prints.fp == roots.node, "left").select("fp", "least", "n", F.coalesce("root", "fp").alias("group"))
        heads = rooted.groupBy("group").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("members"))
        groups = stage(attach(stage(rooted, "simhash-rooted"), stage(heads, "simhash-heads"), "group", "members", F.col("fp")).select("fp", "n", "group", "component_id"), "simhash-groups")
    return attach(rows, groups, "fp", "n", F.col("id")).drop("n")


def one_of_each(docs: DataFrame, **kw) -> DataFrame:
    """The row of lowest id of every group, with the columns of ``docs``; of repeated rows the one of lowest text digest."""
    groups = simhash_groups(docs, **kw).filter(F.col("id").eqNullSafe(F.col("component_id")))
    text = F.sha2(F.coalesce(F.col("row").getField(kw.get("text_col", "text")), F.lit("")), 256)
    first = F.row_number().over(W.partitionBy("group", "id").orderBy(text))
    kept = groups.withColumn("_nth", first).filter("_nth = 1")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])

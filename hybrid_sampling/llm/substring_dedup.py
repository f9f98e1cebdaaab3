"""Substring deduplication: repeated word windows, pre-filtered by a count-min sketch.

Pass 1 hashes every window of every text (two 64-bit lanes from 128-bit word
hashes), keeps the first of equal windows of a chunk, and counts those in a
count-min sketch: each chunk sends its counter positions by slice, and the slices
merge by key. Counters only overestimate, so a window seen in two chunks has a
count of two or more in every row of the sketch. Pass 2 hashes again and sends
on only the chunk firsts whose estimate is two or more; they are grouped exactly by the
full 128 bits in hash buckets, which report every window that starts earlier
elsewhere. What repeats inside a chunk is known at once and is not sent.

Chunks hold at most about ``chunk_words`` words (one text more), buckets about
``bucket_windows`` windows, the broadcast bitmaps ``depth`` * ``max_width`` bits.
With more windows than counters the filter passes more windows, never fewer.
Both passes must cut the same chunks, so what is not a plain scan of files (whose
rows come in one order however often it is read) is staged first.

Defined cases: a null or empty text has no words; texts shorter than the window
lose nothing; a null id is smaller than any other; rows that share an id are one
document to the rule (equal starts of the same id keep each other); an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage
from .word_windows import NULL_ID, SENT_AT_ONCE, SLICE, Sketch, chunks, counter, covered_runs, equal_runs, first_of, forget_bitmaps, pack, pair_bytes, record_batch, text_bytes, unpack

def count_windows(docs: DataFrame, window: int, depth: int, width: int, chunk_words: int) -> Sketch:
    """Pass 1."""
    part = min(width, SLICE)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_bitmaps()  # a worker that has served another sketch
        held, size = [[] for _ in range(depth)], 0

        def send() -> pa.RecordBatch:
            out = []
            for j, own in enumerate(held):
                at = np.concatenate(own)
                own.clear()
                at.sort()
                cuts = np.searchsorted(at, np.arange(0, width + 1, part, dtype=np.uint32))
                out += [(j, s, pack(at[a:b] - np.uint32(s * part))) for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
            return record_batch(out, [("depth", pa.int32()), ("slice", pa.int32()), ("counters", pa.binary())])

        for c in chunks(batches, window, chunk_words):
            for j in range(depth):
                held[j].append(counter(c.h1[c.firsts], c.h2[c.firsts], j, width))
            size += len(c.firsts)
            if size >= SENT_AT_ONCE:
                yield send()
                size = 0
        if held[0]:
            yield send()

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(part, np.uint8)
        for batch in batches:
            for blob in batch.column("counters"):
                at, n = np.unique(unpack(blob.as_py()), return_counts=True)
                counts[at] = np.minimum(counts[at] + np.minimum(n, 2), 2)  # two or more is all that is asked
        bits = zlib.compress(np.packbits(counts >= 2, bitorder="little").tobytes(), 1)
        yield record_batch([(key[0].as_py(), key[1].as_py(), bits)], [("depth", pa.int32()), ("slice", pa.int32()), ("bits", pa.binary())])

    sent = docs.mapInArrow(count, "depth int, slice int, counters binary")
    merged = sent.groupBy("depth", "slice").applyInArrow(merge, "depth int, slice int, bits binary")
    return Sketch(uuid.uuid4().hex, depth, width, [(r.depth, r.slice, bytes(r.bits)) for r in merged.collect()])  # depth * width bits at most


_SENT = [("bucket", pa.int64()), ("chunk", pa.int64()), ("ids", pa.binary()), ("windows", pa.binary()), ("starts", pa.binary())]
_PIECES = [("chunk", pa.int64()), ("ids", pa.binary()), ("starts", pa.binary())]
_RUNS = [("id", pa.int64()), ("row", pa.int64()), ("runs", pa.binary())]


def repeated_windows(docs: DataFrame, window: int, sketch: Sketch, buckets: int, chunk_words: int) -> DataFrame:
    """Pass 2. (chunk, ids, starts): documents of a chunk and the starts of their repeated windows, in pieces."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, depth, width = shared.value.bitmaps(), shared.value.depth, shared.value.width
        for c in chunks(batches, window, chunk_words):
            keep = c.firsts
            for j in range(depth):
                at = counter(c.h1[keep], c.h2[keep], j, width)
                keep = keep[(bits[j][at >> np.uint32(3)] >> (at & np.uint32(7)).astype(np.uint8)) & 1 == 1]
            chunk = xxhash.xxh3_64_intdigest(c.ids.tobytes() + c.rows.tobytes()) >> 1
            at = np.flatnonzero(c.later)
            out = [(-1 - chunk % buckets, chunk, c.ids.tobytes() + c.rows.tobytes(), b"", pair_bytes(c.doc[at], c.start[at]))]
            bucket = c.h2[keep] % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
            for b in np.flatnonzero(np.diff(cuts)):
                at = keep[order[cuts[b] : cuts[b + 1]]]
                docs_in, own = np.unique(c.doc[at], return_inverse=True)
                out.append((int(b), chunk, c.ids[docs_in].tobytes() + c.rows[docs_in].tobytes(), np.stack((c.h1[at], c.h2[at])).tobytes(), pair_bytes(own, c.start[at])))
            yield record_batch(out, _SENT)

    def group(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_bitmaps()
        pieces = [r for b in batches for r in zip(b.column("chunk").to_pylist(), b.column("ids").to_pylist(), b.column("windows").to_pylist(), b.column("starts").to_pylist(), strict=True)]
        if key[0].as_py() < 0:  # what its chunk has settled already
            out = [(k, ids, starts) for k, ids, _, starts in pieces]
        else:
            heads = [np.frombuffer(ids, np.int64).reshape(2, -1) for _, ids, _, _ in pieces]
            own = [np.frombuffer(s, np.int32).reshape(2, -1) for *_, s in pieces]
            h1, h2 = np.concatenate([np.frombuffer(w, np.uint64).reshape(2, -1) for _, _, w, _ in pieces], axis=1)
            _, rank = np.unique(np.concatenate([h[0] for h in heads]), return_inverse=True)
            base = np.cumsum([0] + [h.shape[1] for h in heads])
            place = np.concatenate([(rank[base[k] + d[0]].astype(np.int64) << 32) | d[1] for k, d in enumerate(own)])
            later = place > first_of(*equal_runs(h1, h2), place)
            out, at = [], 0
            for k, d in enumerate(own):
                mine = later[at : at + d.shape[1]]
                at += d.shape[1]
                if mine.any():
                    docs_in, new = np.unique(d[0][mine], return_inverse=True)
                    out.append((pieces[k][0], heads[k][:, docs_in].tobytes(), pair_bytes(new, d[1][mine])))
        yield record_batch(out, _PIECES)

    sent = docs.mapInArrow(send, "bucket long, chunk long, ids binary, windows binary, starts binary")
    return sent.groupBy("bucket").applyInArrow(group, "chunk long, ids binary, starts binary")


def _per_document(pieces: DataFrame, window: int) -> DataFrame:
    """(id, row, runs): for every document that loses words its covered ranges."""

    def gather(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, starts = [], []
        for b in batches:
            for i, s in zip(b.column("ids").to_pylist(), b.column("starts").to_pylist(), strict=True):
                head, own = np.frombuffer(i, np.int64).reshape(2, -1), np.frombuffer(s, np.int32).reshape(2, -1)
                ids.append(head[:, own[0]])
                starts.append(own[1])
        ids, starts = np.concatenate(ids, axis=1), np.concatenate(starts)
        order = np.lexsort((starts, ids[1], ids[0]))
        ids, starts = ids[:, order], starts[order]
        cuts = np.flatnonzero(np.concatenate((np.ones(min(len(starts), 1), bool), (ids[:, 1:] != ids[:, :-1]).any(axis=0))))
        runs = [covered_runs(np.unique(x), window).astype("<i4").tobytes() for x in np.split(starts, cuts[1:])] if len(starts) else []
        yield record_batch(list(zip(ids[0][cuts].tolist(), ids[1][cuts].tolist(), runs, strict=True)), _RUNS)

    return pieces.groupBy("chunk").applyInArrow(gather, "id long, row long, runs binary")


def _cut(text: str | None, runs: bytes | None) -> tuple[int, int, str]:
    words = text_bytes(text).split()
    keep = np.ones(len(words), bool)
    if runs is not None:
        for a, b in np.frombuffer(runs, "<i4").reshape(2, -1).T:
            keep[a:b] = False
    kept = words if keep.all() else [words[i] for i in np.flatnonzero(keep)]
    return len(words), len(words) - len(kept), b" ".join(kept).decode("utf-8", "surrogatepass")


def _steady(docs: DataFrame) -> bool:
    """Whether the rows are those of a scan of files, in the same order at each evaluation."""
    todo = [docs._jdf.queryExecution().optimizedPlan()]
    if not todo[0].deterministic():
        return False
    while todo:
        plan = todo.pop()
        kind = plan.getClass().getSimpleName()
        if kind == "LogicalRelation":
            if plan.relation().getClass().getSimpleName() != "HadoopFsRelation":
                return False
        elif kind not in ("Project", "Filter"):
            return False
        todo += [plan.children().apply(i) for i in range(plan.children().size())]
    return True


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, depth: int = 2, max_width: int = 1 << 29, chunk_words: int = 1 << 18, bucket_windows: int = 1 << 20, keep_text: bool = True) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_removed, kept_sha256 and, if asked for, kept_text (single-spaced)."""
    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    if not _steady(rows):
        rows = stage(rows, "substring-docs")
    size = rows.agg(F.sum(F.octet_length("text")).alias("b"), F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("d"), F.count_if(F.col("id").isNull()).alias("z")).first()
    windows = max((size.b or 0) // 6, 1)
    width = min(max(1 << (4 * windows - 1).bit_length(), 1 << 16), max_width)
    # rows of one id are told apart by the hash of their text; ids that are distinct need none
    row = F.lit(0).cast("long") if size.d + size.z == size.n and size.z <= 1 else F.xxhash64("text")
    keyed = rows.select(F.coalesce("id", F.lit(NULL_ID)).alias("id"), row.alias("row"), "text")
    sketch = count_windows(keyed, window, depth, width, chunk_words)
    pieces = repeated_windows(keyed, window, sketch, -(-windows // bucket_windows), chunk_words)
    # a chunk and its row are the same text, so repeated rows may report twice: the ranges are merged as a set
    runs = _per_document(pieces, window).groupBy("id", "row").agg(F.collect_set("runs").alias("runs"))
    runs = runs.select(F.col("id").alias("rid"), F.col("row").alias("rrow"), F.col("runs")[0].alias("runs"))

    @F.pandas_udf("n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * keep_text)
    def cut(texts: pd.Series, runs: pd.Series) -> pd.DataFrame:
        out = []
        for t, r in zip(texts, runs, strict=True):
            n, gone, kept = _cut(t, r)
            out.append((n, gone, hashlib.sha256(kept.encode("utf-8", "surrogatepass")).hexdigest(), kept)[: 3 + keep_text])
        return pd.DataFrame(out, columns=["n_words", "n_removed", "kept_sha256", "kept_text"][: 3 + keep_text])

    source = rows.select("id", "text", row.alias("row"), F.coalesce("id", F.lit(NULL_ID)).alias("key"))
    joined = source.join(runs, (F.col("key") == F.col("rid")) & (F.col("row") == F.col("rrow")), "left")
    return joined.select("id", cut("text", "runs").alias("o")).select("id", "o.*")

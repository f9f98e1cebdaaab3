"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts are compared lower-cased with single spaces, as UTF-8 bytes. An item of m
bytes may be found with at most k = floor(max_edits * m) edits. By the q-gram
lemma a region within k edits of the item shares at least m - q + 1 - k * q
q-grams with it, all on diagonals (place in the text less place in the item) at
most k apart. Shared q-grams are counted per item in bands of 2w diagonals that
overlap by w > k, so every such region lies whole in some band; bands that meet
the bound are verified by alignment inside the band. Where k * q is too much for
a short item, k is the largest number of edits for which the bound holds.

The items are the query set: they are taken in blocks of at most about
``block_bytes``, and some ``BLOCKS_A_PASS`` of them are broadcast and held against all texts in
one pass. A task indexes one block at a time and goes through a batch of texts with each.

Defined cases: null or empty texts and items match nothing; an item shorter than
q must occur exactly; repeated rows are judged each; of equal items each reports;
an empty table on either side gives no hits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed, unpacked

Q = 8
_HASH = np.uint64(0x9E3779B97F4A7C15)
_BITS = 22
_SPAN = 1 << 20  # bytes of text whose q-grams are counted at once
_CELL = 4096  # diagonals of a cell of the first count, or what the widest band has
_SLOTS = (1 << 18) - 1

#: Blocks broadcast together, as plain texts.
BLOCKS_A_PASS = 16

HIT = "array<struct<item_id: long, at: long, length: int, edits: int>>"


def normalised(text: str | None) -> bytes:
    return b" ".join(text.lower().encode("utf-8", "surrogatepass").split()) if text else b""


def grams(data: bytes | np.ndarray) -> np.ndarray:
    """The q-gram at each place as one number."""
    raw = np.frombuffer(data, np.uint8)
    return np.ndarray(max(len(raw) - Q + 1, 0), "<u8", raw, 0, (1,)) if len(raw) >= Q else np.empty(0, "<u8")


def edit_budget(m: int, max_edits: float) -> int:
    """The edits allowed in an item of m bytes, such that the lemma asks for one shared q-gram at least."""
    return max(min(int(max_edits * m), (m - Q) // Q), 0)


class Index:
    """Items of a block, with the places of their q-grams."""

    def __init__(self, items: list[tuple[int, str | None]], max_edits: float):
        texts = [(i, normalised(t)) for i, t in items]
        self.items = [(i, t) for i, t in texts if t]
        long = [k for k, (_, t) in enumerate(self.items) if len(t) >= Q]
        self.short = [k for k, (_, t) in enumerate(self.items) if len(t) < Q]
        m = np.array([len(t) for _, t in self.items], np.int64)
        self.budget = np.array([edit_budget(x, max_edits) for x in m], np.int64)
        self.least = m - Q + 1 - self.budget * Q
        self.width = self.budget + 1
        own = [grams(self.items[k][1]) for k in long]
        all_grams = np.concatenate(own) if own else np.empty(0, np.uint64)
        item = np.repeat(np.array(long, np.int64), [len(g) for g in own])
        offset = np.concatenate([np.arange(len(g)) for g in own]) if own else np.empty(0, np.int64)
        order = np.argsort(all_grams, kind="stable")
        self.keys, self.first, self.count = np.unique(all_grams[order], return_index=True, return_counts=True)
        self.item, self.offset = item[order], offset[order]
        self.seen = np.zeros(1 << _BITS, bool)
        self.seen[(self.keys * _HASH) >> np.uint64(64 - _BITS)] = True
        self.longest = int(m.max()) if len(m) else 0
        self.cell = max([_CELL, *(2 * self.width).tolist()])

    def shared(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each q-gram that the text shares with an item: place, item, diagonal (shifted to be positive)."""
        g = grams(text)
        at = np.flatnonzero(self.seen[(g * _HASH) >> np.uint64(64 - _BITS)])
        g = g[at]
        k = np.searchsorted(self.keys, g)
        k[k == len(self.keys)] = 0
        same = self.keys[k] == g
        at, k = at[same], k[same]
        n = self.count[k]
        own = np.repeat(self.first[k] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum()) if len(n) else np.empty(0, np.int64)
        return np.repeat(at, n), self.item[own], np.repeat(at, n) - self.offset[own] + self.longest

    def regions(self, text: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, lowest diagonal, highest) of each band that holds enough shared q-grams."""
        if not len(self.keys):
            return
        at, item, diagonal = self.shared(text)
        # a first count in wide cells, hashed: bands are narrower, so it can only be larger
        for _ in range(2):
            cell = diagonal // self.cell
            slot = lambda c: ((item * 0x9E3779B1 + c * 0x85EBCA77) >> 7) & _SLOTS  # noqa: B023, E731
            held = np.bincount(slot(cell), minlength=_SLOTS + 1)
            enough = held[slot(cell)] + np.maximum(held[slot(cell - 1)], held[slot(cell + 1)]) >= self.least[item]
            at, item, diagonal = at[enough], item[enough], diagonal[enough]
        order = np.lexsort((diagonal, item))
        item, diagonal, offset = item[order], diagonal[order], (at[order] - diagonal[order] + self.longest)
        hits = (item << 40) | diagonal
        band = diagonal // self.width[item]
        key, n = np.unique(np.concatenate(((item << 40) | band, (item << 40) | np.maximum(band - 1, 0))), return_counts=True)
        key = key[n >= self.least[key >> 40]]
        for i, b in zip((key >> 40).tolist(), (key & ((1 << 40) - 1)).tolist(), strict=True):
            w, k = int(self.width[i]), int(self.budget[i])
            own = slice(*np.searchsorted(hits, ((i << 40) | b * w, (i << 40) | (b + 2) * w)))
            if self._bound_met(diagonal[own], offset[own], k, int(self.least[i])):
                yield i, b * w - self.longest, (b + 2) * w - 1 - self.longest

    @staticmethod
    def _bound_met(diagonal: np.ndarray, offset: np.ndarray, k: int, least: int) -> bool:
        """The lemma asks for so many q-grams of the item, each counted once, on diagonals at most k apart."""
        last = np.searchsorted(diagonal, diagonal + k, "right")
        begins = np.flatnonzero(last - np.arange(len(diagonal)) >= least)
        begins = begins[np.diff(last[begins], prepend=-1) > 0]  # of those with one end the first holds the others
        return any(len(np.unique(offset[a : last[a]])) >= least for a in begins)


def banded_distance(item: np.ndarray, text: np.ndarray, low: int, high: int, limit: int) -> tuple[int, int, int] | None:
    """Least edits of ``item`` against any stretch of ``text`` on the diagonals low..high: (edits, from, to), None beyond the limit.

    Row i of the table holds the cells of text place i + low + j, j = 0..high-low; the first row is free, so a
    match may begin at any diagonal of the band, and end at any.
    """
    width, far, n = high - low + 1, 1 << 20, len(text)
    j = np.arange(width)
    place = low + j
    inside = (place >= 0) & (place <= n)
    cost = np.where(inside, 0, far)
    begin = place.copy()
    for i in range(1, len(item) + 1):
        place = i + low + j
        char = np.where((place >= 1) & (place <= n), text[np.clip(place - 1, 0, n - 1)], 256)
        best, start = cost + (char != item[i - 1]), begin
        best = np.where(char == 256, far, best)
        gone = np.append(cost[1:], far) + 1  # a byte of the item left out: from the diagonal above
        take = gone < best
        best, start = np.where(take, gone, best), np.where(take, np.append(begin[1:], 0), start)
        best = np.where((place >= 0) & (place <= n), best, far)
        # a byte of the text left out: along the row, the least of best[h] + (j - h)
        run = np.minimum.accumulate(best - j) + j
        source = np.maximum.accumulate(np.where(best == run, j, 0))
        cost, begin = run, start[source]
        if cost.min() > limit:
            return None
    end = int(np.argmin(cost))
    if cost[end] > limit:
        return None
    return int(cost[end]), int(begin[end]), len(item) + low + end


def _spans(texts: list[bytes], margin: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Stretches (text, place of its first byte, bytes) of about _SPAN bytes together; what a cut parts stands whole in the next stretch."""
    span, size = [], 0
    for k, text in enumerate(texts):
        for at in range(0, len(text), _SPAN):
            base = max(at - margin, 0)
            span.append((k, base, text[base : at + _SPAN]))
            size += len(span[-1][2])
            if size >= _SPAN:
                yield span
                span, size = [], 0
    if span:
        yield span


def matches(index: Index, texts: list[bytes]) -> list[list[tuple[int, int, int, int]]]:
    """For each normalised text the best match of each item found: (item position, from, length, edits)."""
    found: list[dict[int, tuple[int, int, int]]] = [{} for _ in texts]
    gap = b"\0" * (index.longest + Q)  # keeps the diagonals of neighbours apart
    for span in _spans(texts, 2 * index.longest + Q):
        starts = np.cumsum([0] + [len(data) + len(gap) for *_, data in span])[:-1]
        for i, low, high in index.regions(np.frombuffer(gap.join(data for *_, data in span), np.uint8)):
            item = index.items[i][1]
            first, last = np.searchsorted(starts, (max(low, 0), max(high + len(item), 0)), "right") - 1
            for (k, base, data), start in zip(span[first : last + 1], starts[first : last + 1].tolist(), strict=True):
                if found[k].get(i, (1,))[0] == 0:
                    continue
                wide = high - low  # a neighbouring band may hold it whole
                exact = data.find(item, max(low - wide - start, 0), max(high + wide - start + len(item), 0))
                if exact >= 0:
                    got = (0, base + exact, len(item))
                elif d := banded_distance(np.frombuffer(item, np.uint8), np.frombuffer(data, np.uint8), low - start, high - start, int(index.budget[i])):
                    got = (d[0], base + d[1], d[2] - d[1])
                else:
                    continue
                found[k][i] = min(got, found[k].get(i, got))
    for i in index.short:
        for k, text in enumerate(texts):
            exact = (b" " + text + b" ").find(b" " + index.items[i][1] + b" ")  # as whole words
            if exact >= 0:
                found[k][i] = (0, exact, len(index.items[i][1]))
    return [[(i, s, n, e) for i, (e, s, n) in sorted(own.items())] for own in found]


Block = list[tuple[int, str | None]]


def _passes(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list[Block]]:
    """The query set in blocks, as many as one pass takes."""
    held: list[Block] = []
    for block in _blocks(items, id_col, text_col, block_bytes):
        held.append(block)
        if len(held) == BLOCKS_A_PASS:
            yield held
            held = []
    if held:
        yield held


def _blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[Block]:
    """The query set in blocks, in order of id."""
    block, size = [], 0
    for r in items.select(items[id_col].cast("long").alias("i"), items[text_col].alias("t")).filter("t is not null").orderBy("i", "t").toLocalIterator():
        block.append((r.i, r.t))
        size += len(r.t)
        if size >= block_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


def _hits(texts: DataFrame, blocks: list[Block], max_edits: float):
    shared = texts.sparkSession.sparkContext.broadcast((blocks, max_edits))

    @F.pandas_udf(HIT)
    def hits(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        blocks, max_edits = shared.value
        only = Index(blocks[0], max_edits) if len(blocks) == 1 else None
        for part in parts:
            ready = [normalised(t) for t in part]
            out: list[list[dict]] = [[] for _ in ready]
            for block in blocks:
                index = only or Index(block, max_edits)
                for told, own in zip(out, matches(index, ready), strict=True):
                    told += [{"item_id": index.items[i][0], "at": s, "length": n, "edits": e} for i, s, n, e in own]
            yield pd.Series(out)

    return hits


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", max_edits: float = 0.1, block_bytes: int = 4 << 20) -> DataFrame:
    """One row for each text and item found in it: id, item_id, at, length (bytes of the normalised text), edits."""
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    parts = [rows.select("id", F.explode(_hits(docs, blocks, max_edits)("text")).alias("h")).select("id", "h.*") for blocks in _passes(items, item_id, item_text, block_bytes)]
    none = "item_id long, at long, length int, edits int"
    return reduce(DataFrame.unionByName, parts) if parts else docs.sparkSession.createDataFrame([], f"id {docs.schema[id_col].dataType.simpleString()}, {none}")


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", max_edits: float = 0.1, block_bytes: int = 4 << 20) -> DataFrame:
    """The rows of ``docs`` in which no item is found."""
    rows = packed(docs, text=docs[text_col])
    for blocks in _passes(items, item_id, item_text, block_bytes):
        rows = rows.filter(F.size(_hits(docs, blocks, max_edits)("text")) == 0)
    return unpacked(rows, docs.columns)

"""Word windows of documents in chunks, and their count-min sketch: what a task of substring deduplication holds."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

_MUL = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
NULL_ID = -(1 << 63)
SLICE = 1 << 22  # counters of a slice
SENT_AT_ONCE = 1 << 22  # windows counted before their counters are sent


def text_bytes(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def lanes(data: bytes, window: int) -> np.ndarray:
    """Two 64-bit hashes of each window of ``window`` words, as an array (2, windows)."""
    words = data.split()
    n = len(words) - window + 1
    if n <= 0:
        return np.empty((2, 0), np.uint64)
    w = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), "<u8").reshape(-1, 2).T
    out = np.empty((2, n), np.uint64)
    for lane in (0, 1):
        h, own = np.zeros(n, np.uint64), np.ascontiguousarray(w[lane])
        for j in range(window):
            h *= _MUL[lane]
            h += own[j : j + n]
        h ^= h >> np.uint64(29)
        h *= _MIX[lane]
        h ^= h >> np.uint64(32)
        out[lane] = h
    return out


def equal_runs(h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal windows together, and where its runs start."""
    order = np.argsort(h1, kind="stable")
    a, b = h1[order], h2[order]
    new = np.concatenate((np.ones(min(len(a), 1), bool), a[1:] != a[:-1]))
    if len(a) and ((b[1:] != b[:-1]) & ~new[1:]).any():  # one lane equal, the other not
        order = np.lexsort((h2, h1))
        a, b = h1[order], h2[order]
        new = np.concatenate((np.ones(1, bool), (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
    return order, np.flatnonzero(new)


def first_of(order: np.ndarray, starts: np.ndarray, place: np.ndarray) -> np.ndarray:
    """For each window the smallest ``place`` among its equals."""
    low = np.empty(len(place), place.dtype)
    if len(place):
        low[order] = np.repeat(np.minimum.reduceat(place[order], starts), np.diff(np.append(starts, len(place))))
    return low


class Chunk:
    """Some documents' windows: lanes, the document of each (by position in ``ids``) and its start."""

    def __init__(self, ids: list[int], rows: list[int], texts: list[bytes], window: int):
        own = [lanes(t, window) for t in texts]
        sizes = np.array([x.shape[1] for x in own])
        self.ids, self.rows = np.array(ids, np.int64), np.array(rows, np.int64)
        self.h1, self.h2 = np.concatenate(own, axis=1)
        del own
        self.doc = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)
        self.start = np.concatenate([np.arange(n, dtype=np.int32) for n in sizes])
        _, rank = np.unique(self.ids, return_inverse=True)
        place = (rank[self.doc].astype(np.int64) << 32) | self.start  # orders as (id, start)
        self.later = place > first_of(*equal_runs(self.h1, self.h2), place)
        self.firsts = np.flatnonzero(~self.later).astype(np.int32)


def chunks(batches: Iterator[pa.RecordBatch], window: int, chunk_words: int) -> Iterator[Chunk]:
    for batch in batches:
        ids, rows, texts, held = [], [], [], 0
        columns = [batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)]
        for k in range(batch.num_rows):
            ids.append(columns[0][k]), rows.append(columns[1][k]), texts.append(text_bytes(columns[2][k].as_py()))
            held += len(texts[-1])
            if held >= 6 * chunk_words:
                yield Chunk(ids, rows, texts, window)
                ids, rows, texts, held = [], [], [], 0
        del batch, columns  # before the next one comes
        if ids:
            yield Chunk(ids, rows, texts, window)
        pa.default_memory_pool().release_unused()


def counter(h1: np.ndarray, h2: np.ndarray, j: int, width: int) -> np.ndarray:
    """The counter of each window in row ``j`` of the sketch; ``width`` is a power of two."""
    return ((h1 + np.uint64(j) * h2) >> np.uint64(64 - (width.bit_length() - 1))).astype(np.uint32)


def pack(sorted_numbers: np.ndarray) -> bytes:
    """Sorted numbers below 2**32 by their differences."""
    return zlib.compress(np.diff(sorted_numbers.astype(np.uint32), prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpack(blob: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(zlib.decompress(blob), np.uint8).reshape(4, -1).T).view("<u4").ravel(), dtype=np.int64)


@dataclass
class Sketch:
    """The merged sketch as far as it is asked: which counters of each row are two or more, in packed slices."""

    name: str
    depth: int
    width: int
    slices: list[tuple[int, int, bytes]]

    def bitmaps(self) -> list[np.ndarray]:
        """A bitmap for each row; a worker keeps the last one."""
        if self.name not in _BITMAPS:
            maps = [np.zeros(self.width // 8, np.uint8) for _ in range(self.depth)]
            for j, s, blob in self.slices:
                bits = np.frombuffer(zlib.decompress(blob), np.uint8)
                maps[j][s * len(bits) : (s + 1) * len(bits)] = bits
            _BITMAPS.clear()
            _BITMAPS[self.name] = maps
        return _BITMAPS[self.name]


_BITMAPS: dict[str, list[np.ndarray]] = {}


def forget_bitmaps() -> None:
    """For a worker that goes on to other work."""
    _BITMAPS.clear()


def record_batch(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def pair_bytes(doc: np.ndarray, start: np.ndarray) -> bytes:
    return np.stack((doc, start)).astype(np.int32).tobytes()


def covered_runs(starts: np.ndarray, window: int) -> np.ndarray:
    """Word ranges [from, to) that the windows at the sorted, distinct ``starts`` cover, as an array (2, runs)."""
    cut = np.flatnonzero(np.diff(starts) > window)
    return np.stack((starts[np.append(0, cut + 1)], starts[np.append(cut, len(starts) - 1)] + window))

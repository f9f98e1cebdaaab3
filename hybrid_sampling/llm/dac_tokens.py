"""Token ids in files of directly addressable codes (DAC).

A file holds the ids of some consecutive documents as chunks of ``bits`` bits in
levels: level 0 has the lowest chunk of every id, level 1 the next chunk of those
ids that need one, and so on. Each level has a bitmap that says which of its ids
go on, and a rank directory with the number of set bits before each block of
512, so any id is read with one rank a level, without decoding a block.

    magic "DAC1", bits u32, levels u32, ids u64, documents u64,
    document ids i64[documents], starts u64[documents + 1],
    each level: n u64, chunks u8[n], bitmap u64[ceil(n / 64)], rank u64[ceil(n / 512) + 1]

The documents are dealt by range of id and sorted, each task writes files of at
most about ``file_ids`` ids (one document more), under a name of its partition and
a number, first beside and then moved to its place: a task that runs again writes
the same file. A manifest table has a row a file. The files stand in the shared
folder (or any folder that pyarrow's file systems reach from the executors).

Defined cases: the string of an added token (``<|endoftext|>``) in a text is that
token, as the library has it by default, unless ``plain_added`` makes it ordinary
text; a null text is empty (the end id alone); repeated rows are written
each, in the order of their texts; null ids come first; a very long text is encoded whole by its
task and makes a long file of its own; an empty table writes no
file and gives no rows.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from hybrid_sampling.session import scratch_path

from .common import stage

_MAGIC = b"DAC1"
_HEAD = struct.Struct("<4sIIQQ")
_BLOCK = 512
_NULL = -(1 << 63)
MANIFEST = "part int, number int, path string, documents long, ids long, bytes long"


# --- the code ---------------------------------------------------------------------------------------------------


def dac_bytes(doc_ids: np.ndarray, starts: np.ndarray, ids: np.ndarray, bits: int = 8) -> bytes:
    """One file: ``ids`` (unsigned) of documents ``doc_ids``, the k-th from ``starts[k]`` to ``starts[k + 1]``."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest >> np.uint32(bits)
        on = more > 0
        bitmap = np.zeros(-(-len(rest) // 64) * 8, np.uint8)
        packed = np.packbits(on, bitorder="little")
        bitmap[: len(packed)] = packed
        ones = np.bitwise_count(bitmap).astype(np.uint64)
        ones = np.append(ones, np.zeros(-len(ones) % (_BLOCK // 8), np.uint64)).reshape(-1, _BLOCK // 8).sum(axis=1, dtype=np.uint64)
        levels += [struct.pack("<Q", len(rest)), (rest & np.uint32((1 << bits) - 1)).astype(np.uint8).tobytes(), bitmap.tobytes(), np.append(np.uint64(0), np.cumsum(ones, dtype=np.uint64)).astype("<u8").tobytes()]
        if not on.any():
            break
        rest = more[on]
    head = _HEAD.pack(_MAGIC, bits, len(levels) // 4, len(ids), len(doc_ids))
    return b"".join([head, doc_ids.astype("<i8").tobytes(), starts.astype("<u8").tobytes(), *levels])


class DacFile:
    """Reader of one file's bytes."""

    def __init__(self, data: bytes):
        magic, self.bits, levels, self.n, docs = _HEAD.unpack_from(data)
        if magic != _MAGIC:
            raise ValueError("not a DAC file")
        at = _HEAD.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        self.doc_ids, self.starts, self.levels = take("<i8", docs), take("<u8", docs + 1).astype(np.int64), []
        for _ in range(levels):
            n = int(take("<u8", 1)[0])
            self.levels.append((take("u1", n), take("<u8", -(-n // 64)), take("<u8", -(-n // _BLOCK) + 1)))

    def get(self, i: int) -> int:
        """The id at place ``i``: a chunk, and a rank to the next level while its bit is set."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        out, shift = 0, 0
        for chunks, bitmap, rank in self.levels:
            out |= int(chunks[i]) << shift
            word, bit = divmod(i, 64)
            if not int(bitmap[word]) >> bit & 1:
                break
            block = i // _BLOCK
            whole = np.bitwise_count(bitmap[block * (_BLOCK // 64) : word]).sum()
            i = int(rank[block]) + int(whole) + (int(bitmap[word]) & ((1 << bit) - 1)).bit_count()
            shift += self.bits
        return out

    def all(self) -> np.ndarray:
        """All ids in order."""
        out, places = np.zeros(self.n, np.uint32), None
        for k, (chunks, bitmap, _) in enumerate(self.levels):
            part = chunks.astype(np.uint32) << np.uint32(k * self.bits)
            if places is None:
                out |= part
            else:
                out[places] |= part
            on = np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), count=len(chunks), bitorder="little"))
            places = on if places is None else places[on]
        return out


# --- the tokenizer ----------------------------------------------------------------------------------------------

#: Tokens of the pre-tokenizer whose ids a worker keeps.
CACHE = 300_000

# The pre-tokenizer's pattern, its classes spelt out below U+0250, where they are settled.
_LOW = [chr(c) for c in range(0x250)]
_L = "".join(c for c in _LOW if unicodedata.category(c)[0] == "L")
_N = "".join(c for c in _LOW if unicodedata.category(c)[0] == "N")
_S = "\t\n\v\f\r \x85\xa0"
_HIGH = re.compile("[^\0-\u024f]")
_TOKEN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")


# The letter that stands for each byte in a byte-level vocabulary (printable bytes for themselves, the others from U+0100 on).
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_LETTERS = {b: chr(b) for b in _PLAIN} | {b: chr(256 + k) for k, b in enumerate(sorted(set(range(256)).difference(_PLAIN)))}


class _Ids(dict):
    """Ids by token. A token missed is asked of the library; one missed again while still remembered is kept."""

    def __init__(self, tokenizer):
        self.tokenizer, self.model, self.recent = tokenizer, tokenizer.model, {}
        self.whole = _HIGH  # what this finds in goes to the tokenizer, all else to its model

    def __missing__(self, token: str) -> bytes:
        ids = self.recent.get(token)
        if ids is not None:
            if len(self) < CACHE:
                self[token] = ids
            return ids
        if self.whole.search(token):  # a piece or a whole text
            own = self.tokenizer.encode(token, add_special_tokens=False).ids
        else:
            own = [t.id for t in self.model.tokenize(token.encode().decode("latin-1").translate(_LETTERS))]
        ids = struct.pack(f"<{len(own)}I", *own)
        if len(token) <= 100:
            if len(self.recent) >= CACHE // 4:
                self.recent.clear()
            self.recent[token] = ids
        return ids


# What a file's steps must be for its texts to be cut as above; other files are asked whole texts.
_STEPS = {"normalizer": None, "post_processor": None, "truncation": None, "padding": None}
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
_MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None, "byte_fallback": False, "ignore_merges": False}


def cut_as_expected(path: str) -> bool:
    """Whether the tokenizer file has no steps but the byte-level pre-tokenizer and a plain byte-pair model."""
    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    pre, model = told.get("pre_tokenizer") or {}, told.get("model") or {}
    added = [t for t in told.get("added_tokens") or () if t.get("single_word") or t.get("lstrip") or t.get("rstrip") or t.get("normalized")]
    steps = all(told.get(k) == v for k, v in _STEPS.items()) and {k: pre.get(k) for k in _BYTE_LEVEL} == _BYTE_LEVEL
    return steps and all(model.get(k, v) == v for k, v in _MODEL.items()) and not added


class Encoder:
    """Ids of whole texts from the tokenizers library, which is asked once for what recurs.

    A text's ids are those of its tokens under the pre-tokenizer's pattern, and the model gives those; texts
    with characters from U+0250 on are first cut at single spaces between two other characters, where a token always begins, and their
    pieces with such characters (or all of a text that has other white space at a space) go to the tokenizer.
    So does all of a text that holds the string of an added token, unless these are ordinary text (``plain_added``).
    A file whose normalizer, pre-tokenizer or model is another one (``cut_as_expected``) gets every text whole.
    """

    def __init__(self, path: str, plain_added: bool = True):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.known, self.added = _Ids(tokenizer), None
        self.whole = None if cut_as_expected(path) else tokenizer
        if plain_added:
            tokenizer.encode_special_tokens = True
        elif added := [re.escape(t.content) for t in tokenizer.get_added_tokens_decoder().values()]:
            self.added = re.compile("|".join(added))
            self.known.whole = re.compile("|".join([_HIGH.pattern, *added]))

    def _cut(self, text: str) -> list[str]:
        """The tokens and pieces of a text."""
        if self.added and self.added.search(text):
            return [text]
        if not _HIGH.search(text):
            return _TOKEN.findall(text)
        own = text.split(" ")
        if any(not p or p[0].isspace() or p[-1].isspace() for p in own):
            return [text]
        own[1:] = [" " + p for p in own[1:]]
        return [t for p in own for t in ([p] if _HIGH.search(p) else _TOKEN.findall(p))]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The little-endian 32-bit ids of each text."""
        if self.whole is not None:
            return [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in self.whole.encode_batch(texts, add_special_tokens=False)]
        ids = self.known.__getitem__
        return [b"".join(map(ids, self._cut(text))) for text in texts]


@lru_cache(maxsize=2)
def encoder(path: str, plain_added: bool) -> Encoder:
    return Encoder(path, plain_added)


# --- files by Spark tasks -----------------------------------------------------------------------------------------


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def write_dac(docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, bits: int = 8, file_ids: int = 1 << 22, partitions: int | None = None, plain_added: bool = False) -> DataFrame:
    """Write all documents in ascending order of id; the manifest, a staged table."""
    rows = docs.select(F.coalesce(docs[id_col].cast("long"), F.lit(_NULL)).alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(n, "id").sortWithinPartitions("id", "text")
    end = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held = TaskContext.get().partitionId(), 0, 0
        ids: list[int] = []
        codes: list[bytes] = []

        def flush() -> pa.RecordBatch:
            starts = np.cumsum([0] + [len(c) // 4 for c in codes])
            data = dac_bytes(np.array(ids, np.int64), starts, np.frombuffer(b"".join(codes), "<u4"), bits)
            path = f"{folder}/part-{part:06d}-{number:06d}.dac"
            where, at = _place(path)
            beside = f"{at}.{uuid.uuid4().hex}"
            with where.open_output_stream(beside) as f:
                f.write(data)
            where.move(beside, at)
            return pa.RecordBatch.from_pylist([{"part": part, "number": number, "path": path, "documents": len(ids), "ids": int(starts[-1]), "bytes": len(data)}], schema)

        schema = pa.schema([("part", pa.int32()), ("number", pa.int32()), ("path", pa.string()), ("documents", pa.int64()), ("ids", pa.int64()), ("bytes", pa.int64())])
        coder = encoder(tokenizer, plain_added)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                for i, code in zip(some.column(0).to_pylist(), coder.encode(some.column(1).to_pylist()), strict=True):
                    ids.append(i), codes.append(code + end)
                    held += len(code) // 4 + 1
                    if held >= file_ids:
                        yield flush()
                        ids.clear(), codes.clear()
                        held, number = 0, number + 1
        if ids:
            yield flush()

    where, at = _place(folder)
    where.create_dir(at, recursive=True)
    return stage(rows.mapInArrow(write, MANIFEST), "dac-manifest")


def read_dac(manifest: DataFrame) -> DataFrame:
    """From the files: id, start (ids of all documents before it), n_tokens, ids_crc32 of every document."""
    order = W.orderBy("part", "number").rowsBetween(W.unboundedPreceding, -1)  # a row a file
    files = manifest.select("path", F.coalesce(F.sum("ids").over(order), F.lit(0)).alias("base"))
    schema = pa.schema([("id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                where, at = _place(path)
                with where.open_input_stream(at) as f:
                    file = DacFile(f.read())
                raw, s = file.all().astype("<u4").tobytes(), file.starts
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(s[:-1].tolist(), s[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(file.doc_ids), pa.array(s[:-1] + base), pa.array(np.diff(s)), pa.array(crc, pa.int64())], schema=schema)

    tasks = max(files.sparkSession.sparkContext.defaultParallelism, -(-manifest.count() // 16))
    out = files.repartition(tasks, "path").mapInArrow(read, "id long, start long, n_tokens long, ids_crc32 long")
    return out.withColumn("id", F.nullif("id", F.lit(_NULL)))


def token_files(spark: SparkSession) -> str:
    """A new folder for token files in the shared folder."""
    return scratch_path(spark, "dac-files")

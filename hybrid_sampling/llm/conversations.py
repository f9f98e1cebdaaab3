"""Repair of conversations: the cheapest edits that make the roles alternate.

A conversation is repaired when its role initials read ``(s?(ua)+)?``. Rows may be kept,
given the role user or assistant, or deleted, and empty user or assistant rows inserted; a
blank row and one whose role and text stand earlier must go, and a truncated one costs extra unless
it goes. Rows are dealt out by conversation and sorted by turn, last turn first; one pass over the
Arrow batches carries the cost that remains from each of the four states of the pattern, whatever
the batch borders, and leaves one byte a row: the least letter of a cheapest edit in each state.
At the first turn these bytes are read back in the order of the turns and spell the edits. So ties fall to
the audit that is least in ASCII, as the letter alone tells what an edit does in a state. The rows and
bytes of a conversation that outgrow ``hold_bytes`` are written to the shared folder piece by piece
and taken back last piece first, so a task holds one piece of a conversation of any length.

Rows of the same turn stand by role, then text. Duplicates are told by a window that shares the
shuffle by conversation.

Defined cases: null turns come first; a null conversation id is a conversation of its own; null roles
and texts are one space; an empty role has no initial and cannot be kept; a conversation
whose rows are all dropped has zeros, an empty audit and no rows; an empty
table gives no rows; repeated rows are duplicates; very long texts pass through one batch.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from hybrid_sampling.session import scratch_path

from .common import WORD

SPACE = "\t\n\v\f\r "

# Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

# Letters in ASCII order, two bits each.
_LETTERS = "DIKR"
_D, _I, _K, _R = range(4)
# States of (s?(ua)+)?: nothing yet, s, u (an a must follow), a.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_KEEP = {(_START, "s"): _SYSTEM, (_START, "u"): _USER, (_SYSTEM, "u"): _USER, (_USER, "a"): _ASSISTANT, (_ASSISTANT, "u"): _USER}
#: The state after an inserted row or a new role: the one role that may stand there.
_NEW = (_USER, _USER, _ASSISTANT, _USER)
_ROLE = {_USER: "user", _ASSISTANT: "assistant"}
_NEVER = 1 << 60

# Faults of a row; GONE marks a row dropped before the repair, which tells only that its conversation exists.
GONE, WHOLE, BLANK, DUPLICATE, CUT = -1, 0, 1, 2, 3


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows (conv, turn, role, text, gone) with faults by the checksum of ``conv:turn``: 0 drops a row, 1 empties its
    text, 2 takes its ends of sentences, 3 repeats it, 4 makes its role user, up to 19 nothing. Nulls count as one space."""
    text_of = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(text_of(rows[conv_col]), F.lit(":"), text_of(rows[turn_col])).cast("binary")) % 20
    out = rows.select(rows[conv_col].alias("conv"), rows[turn_col].alias("turn"), text_of(rows[role_col]).alias("role"), text_of(rows[text_col]).alias("text"), fault.alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(0))).otherwise(F.array(F.lit(0)))
    out = out.select("conv", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("fault") == 0).alias("gone"), F.explode(copies).alias("copy"))
    return out.drop("copy")


def _sorted_rows(rows: DataFrame) -> DataFrame:
    """(key, turn, role, text, fault) by conversation, last turn first. ``key`` and ``turn`` are strings without nulls."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    gone: Column = F.col("gone") if "gone" in rows.columns else F.lit(False)
    key = F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit(""))
    dealt = rows.select(key.alias("key"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), gone.alias("gone")).repartition("key")
    seen = F.row_number().over(W.partitionBy("key", "gone", "role", "text").orderBy(F.col("turn").asc_nulls_first())) > 1
    ended = F.substring(F.rtrim("text", F.lit(SPACE)), -1, 1).isin(".", "!", "?")
    fault = F.when(F.col("gone"), GONE).when(~F.col("text").rlike(WORD), BLANK).when(seen, DUPLICATE).when(~ended, CUT).otherwise(WHOLE)
    marked = dealt.withColumn("fault", fault)
    order = [F.col("key"), F.col("turn").desc_nulls_last(), F.col("role").desc(), F.col("text").desc(), (F.col("fault") == DUPLICATE).desc()]
    return marked.sortWithinPartitions(*order).select("key", F.coalesce(F.col("turn").cast("string"), F.lit("")).alias("turn"), "role", "text", "fault")


def _settled(base: list[int]) -> tuple[tuple[int, ...], list[bool]]:
    """The least cost from each state, given the least without an insertion first; and where an insertion attains it."""
    user = min(base[_USER], INSERT + base[_ASSISTANT])
    assistant = min(base[_ASSISTANT], INSERT + user)
    cost = (min(base[_START], INSERT + user), min(base[_SYSTEM], INSERT + user), user, assistant)
    return cost, [cost[s] == INSERT + cost[_NEW[s]] for s in range(4)]


#: At the end: nothing is left to do in the two states that accept.
_END, _END_INSERTS = _settled([0, _NEVER, _NEVER, 0])


class Steps(dict):
    """(remaining costs, less the least of them; initial; fault) -> (the same before the row, what to add, letters a byte)."""

    def __missing__(self, at: tuple[tuple[int, ...], str, int]) -> tuple[tuple[int, ...], int, int]:
        cost, initial, fault = at
        stays = TRUNCATED if fault == CUT else 0
        choices = []
        for s in range(4):
            own = {_D: DELETE + cost[s]}
            if fault not in (BLANK, DUPLICATE):
                if (s, initial) in _KEEP:
                    own[_K] = stays + cost[_KEEP[s, initial]]
                own[_R] = REROLE + stays + cost[_NEW[s]]
            choices.append(own)
        before, inserts = _settled([min(own.values()) for own in choices])
        letters = 0
        for s, own in enumerate(choices):
            least = min([k for k, c in own.items() if c == before[s]] + [_I] * inserts[s])
            letters |= least << 2 * s
        low = min(before)
        self[at] = out = (tuple(c - low for c in before), low, letters)
        return out


class Stack:
    """Rows (role, text, letters) put on one after the other and taken back last first; what outgrows memory lies in files."""

    def __init__(self, folder: str, hold_bytes: int):
        self.folder, self.hold_bytes = folder, hold_bytes
        self.rows: list[tuple[str, str, int]] = []
        self.size, self.files = 0, []

    def push(self, role: str, text: str, letters: int) -> None:
        self.rows.append((role, text, letters))
        self.size += len(role) + len(text) + 200
        if self.size > self.hold_bytes:
            where, at = fs.FileSystem.from_uri(self.folder)
            where.create_dir(at, recursive=True)
            path = f"{at}/{uuid.uuid4().hex}.arrow"
            roles, texts, marks = zip(*self.rows, strict=True)
            batch = pa.RecordBatch.from_arrays([pa.array(roles, pa.large_string()), pa.array(texts, pa.large_string()), pa.array(marks, pa.uint8())], names=["role", "text", "letters"])
            self.files.append((where, path))
            with where.open_output_stream(path) as f, pa.ipc.new_stream(f, batch.schema) as writer:
                writer.write_batch(batch)
            self.rows, self.size = [], 0

    def pop_all(self) -> Iterator[tuple[str, str, int]]:
        yield from reversed(self.rows)
        self.rows, self.size = [], 0
        while self.files:
            where, path = self.files[-1]
            with where.open_input_stream(path) as f, pa.ipc.open_stream(f) as reader:
                rows = list(zip(*[c.to_pylist() for c in reader.read_all().columns], strict=True))
            self.drop_last()
            yield from reversed(rows)

    def drop_last(self) -> None:
        where, path = self.files.pop()
        where.delete_file(path)

    def close(self) -> None:
        while self.files:
            self.drop_last()


class Conversation:
    """What one pass carries: remaining costs, the stack, and counts."""

    def __init__(self, key: str, steps: Steps, stack: Stack):
        self.key, self.steps, self.stack = key, steps, stack
        self.cost, self.added = _END, 0
        self.faults = [0, 0, 0, 0]
        self.illegal = self.gaps = self.rows = 0
        self.later_turn: int | None = None
        self.later_initial = ""

    def row(self, turn: str, role: str, text: str, fault: int) -> None:
        """The row before all those given so far."""
        initial = role[:1]
        if self.rows and initial + self.later_initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.rows += 1
        self.later_initial = initial
        if turn:
            here = int(turn)
            if self.later_turn is not None and self.later_turn - here > 1:
                self.gaps += self.later_turn - here - 1
            self.later_turn = here
        self.faults[fault] += 1
        self.cost, low, letters = self.steps[self.cost, initial, fault]
        self.added += low
        self.stack.push(role, text, letters)

    def edits(self) -> Iterator[tuple[str, str | None, str]]:
        """(letter, role, text) in the order of the turns; a deleted row has no role."""
        state = _START
        for role, text, letters in self.stack.pop_all():
            while (letter := letters >> 2 * state & 3) == _I:
                state = _NEW[state]
                yield "I", _ROLE[state], ""
            if letter == _K:
                state = _KEEP[state, role[:1]]
                yield "K", role, text
            elif letter == _R:
                state = _NEW[state]
                yield "R", _ROLE[state], text
            else:
                yield "D", None, text
        while state not in (_START, _ASSISTANT):
            state = _NEW[state]
            yield "I", _ROLE[state], ""

    def summary(self) -> Iterator[tuple]:
        audit, digest, first = [], hashlib.sha256(), True
        cost = self.added + self.cost[_START]
        for letter, role, text in self.edits():
            audit.append(letter)
            if role is not None:
                digest.update(f"{'' if first else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
                first = False
        yield (self.key, self.gaps, *self.faults[1:], self.illegal, cost, "".join(audit), digest.hexdigest())

    def repaired(self) -> Iterator[tuple]:
        place = 0
        for letter, role, text in self.edits():
            if role is not None:
                yield (self.key, place, role, text, letter)
                place += 1


_SUMMARY = ("key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")
_REPAIRED = "key string, place long, role string, text string, edit string"


def _pass(rows: DataFrame, ends: Callable[[Conversation], Iterator[tuple]], schema: str, hold_bytes: int) -> DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]
    folder = scratch_path(rows.sparkSession, "conversations")

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        steps, stack, out, size = Steps(), Stack(folder, hold_bytes), [], 0
        now: Conversation | None = None

        def told(rows: Iterator[tuple]) -> Iterator[pd.DataFrame]:
            nonlocal out, size
            for r in rows:
                out.append(r)
                size += 200 + len(r[-2])
                if size > 1 << 24:
                    yield pd.DataFrame(out, columns=names)
                    out, size = [], 0

        try:
            for batch in batches:
                for key, turn, role, text, fault in zip(*[batch[c].tolist() for c in ("key", "turn", "role", "text", "fault")], strict=True):
                    if now is None or key != now.key:
                        if now is not None:
                            yield from told(ends(now))
                        now = Conversation(key, steps, stack)
                    if fault != GONE:
                        now.row(turn, role, text, fault)
            if now is not None:
                yield from told(ends(now))
            if out:
                yield pd.DataFrame(out, columns=names)
        finally:
            stack.close()

    out = _sorted_rows(rows).mapInPandas(walk, schema)
    kind = rows.schema["conv"].dataType
    conv = F.when(F.col("key") != "", F.substring("key", F.lit(2), F.char_length("key"))).cast(kind).alias("conv")
    return out.select(conv, *names[1:])


def repair_summary(rows: DataFrame, hold_bytes: int = 32 << 20) -> DataFrame:
    """A row a conversation of ``rows`` (conv, turn, role, text and, where there is one, gone): its faults as found, the
    cost and letters of the cheapest edits, and the digest of the repaired rows ``role:text``, one a line."""
    return _pass(rows, Conversation.summary, _SUMMARY, hold_bytes)


def repaired_rows(rows: DataFrame, hold_bytes: int = 32 << 20) -> DataFrame:
    """The repaired conversations: conv, place, role, text and the edit (K, R or I) that each row comes from."""
    return _pass(rows, Conversation.repaired, _REPAIRED, hold_bytes)

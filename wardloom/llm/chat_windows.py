r"""Chat formatting: conversations as training windows of a token budget, with a loss mask on the assistant's turns.

Budgeted windows: prefix sums of the turns' tokens choose turn-aligned spans. A window holds the system turn of
its conversation, as much of the turns before as fits ``history`` tokens, then new turns while the sum stays
within ``window`` tokens. Every turn is new in exactly one window; turns that are repeated (system and history)
are masked, so each assistant turn is learned once. A turn longer than a window has one of its own, whole; a
system turn longer than half a window is not repeated.

A turn is written ``<turn role>\n text </turn>\n``. Inside texts, ``<`` before ``turn`` or ``/turn`` gets a backslash
after it (one more where backslashes stand there already), so no text can hold a marker and the way
back is exact. Roles are written percent-encoded.

Spans restart at fixed multiples of ``BLOCK_WINDOWS`` windows of a conversation's tokens. That cuts a very long
conversation into blocks that different tasks format; the turns just before a block, and the system turn, are
copied to it. Conversations that are too short for a second block go through one shuffle.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from urllib.parse import quote, unquote

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardloom.llm.common import table
from wardloom.operators.numbering import running_offsets
from wardloom.session import broadcast_if_small, materialize

WINDOW = 2048
HISTORY = 512
BLOCK_WINDOWS = 16
PIECE = 4096  # characters counted at once; a longer turn is the sum of its pieces
BATCH_CHARS = 4 << 20

OPEN, CLOSE = "<turn ", "</turn>\n"
SYSTEM, REPEATED, NEW = 0, 1, 2  # what a turn is to its block
_MARKER = re.compile(r"<(\\*)(/?turn)")
_ESCAPED = re.compile(r"<\\(\\*)(/?turn)")


def escape(text: str) -> str:
    return _MARKER.sub(r"<\\\1\2", text) if "<" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1\2", text) if "<" in text else text


def render(role: str, text: str) -> tuple[str, str]:
    """The marker that opens a turn, and its escaped text; ``CLOSE`` ends it."""
    return f"{OPEN}{quote(role, safe='')}>\n", escape(text)


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """``(role, text)`` of every turn of a window."""
    at = 0
    while at < len(formatted):
        head = formatted.index(">\n", at)
        end = formatted.index(CLOSE, head + 2)
        yield unquote(formatted[at + len(OPEN) : head]), unescape(formatted[head + 2 : end])
        at = end + len(CLOSE)


@lru_cache(maxsize=4)
def _encoding(vocabulary: str) -> tiktoken.Encoding:
    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("turns", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(vocabulary: str):
    """A function of batches ``(conv_id, turn, role, text)`` that appends the tokens of each turn as it is written."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(vocabulary)
        for batch in batches:
            tokens = []
            for role, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                whole = "".join((*render(role, text), CLOSE))
                tokens.append(sum(len(encoding.encode_ordinary(whole[i : i + PIECE])) for i in range(0, len(whole), PIECE)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tokens, pa.int64())], names=["conv_id", "turn", "role", "text", "tokens"])

    return count


# -- choosing and writing windows ------------------------------------------------------------


@dataclass(frozen=True)
class Turn:
    role: str
    text: str
    at: int  # tokens of the conversation before it
    tokens: int


class Block:
    """The windows of one block, from its turns in order."""

    def __init__(self, window: int, history: int):
        self.window, self.history = window, history
        self.system: Turn | None = None
        self.past: deque[Turn] = deque()
        self.past_tokens = 0
        self.lead: list[Turn] = []
        self.new: list[Turn] = []
        self.tokens = 0

    def remember(self, turn: Turn) -> None:
        """Make ``turn`` the last of the turns before; only what adjoins it and fits the history stays."""
        if self.past and self.past[-1].at + self.past[-1].tokens != turn.at:
            self.past.clear()
            self.past_tokens = 0
        self.past.append(turn)
        self.past_tokens += turn.tokens
        while self.past_tokens > self.history:
            self.past_tokens -= self.past.popleft().tokens

    def add(self, turn: Turn) -> list[Turn] | None:
        """Add a new turn; returns whether a window had to be closed before it."""
        closed = None
        if self.new and self.tokens + turn.tokens > self.window:
            closed = self.close()
        if not self.new:
            self.lead = [self.system] if self.system else []
            room = self.window - turn.tokens - sum(t.tokens for t in self.lead)
            adjoining = list(self.past) if self.past and self.past[-1].at + self.past[-1].tokens == turn.at else []
            size = sum(t.tokens for t in adjoining)
            while adjoining and size > room:
                size -= adjoining.pop(0).tokens
            self.lead += adjoining
            self.tokens = sum(t.tokens for t in self.lead)
        self.new.append(turn)
        self.tokens += turn.tokens
        if turn.at == 0 and turn.role == "system" and turn.tokens <= self.window // 2:
            self.system = turn
        else:
            self.remember(turn)
        return closed

    def close(self) -> tuple[str, int, int, list[int], list[int]] | None:
        """``(text, tokens, repeated turns, starts and ends of the loss)`` of the open window."""
        if not self.new:
            return None
        parts, size, starts, ends = [], 0, [], []
        for place, turn in enumerate([*self.lead, *self.new]):
            head, body = render(turn.role, turn.text)
            if place >= len(self.lead) and turn.role == "assistant":
                starts.append(size + len(head))
                ends.append(size + len(head) + len(body))
            parts += [head, body, CLOSE]
            size += len(head) + len(body) + len(CLOSE)
        out = ("".join(parts), self.tokens, len(self.lead), starts, ends)
        self.lead, self.new, self.tokens = [], [], 0
        return out


WINDOW_COLUMNS = "block long, window int, text string, tokens long, repeated int, loss_start array<int>, loss_end array<int>"
_WINDOW_TYPES = [pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32())]


def _writer(window: int, history: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by ``(conv_id, block, kind)`` and place; ``at`` is null where the sums start here."""
        here, state, number, running = None, None, 0, 0
        rows, chars, id_type = [], 0, None

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            arrays = [pa.array(columns[0], id_type), *(pa.array(c, t) for c, t in zip(columns[1:], _WINDOW_TYPES, strict=True))]
            return pa.RecordBatch.from_arrays(arrays, names=["conv_id", "block", "window", "text", "tokens", "repeated", "loss_start", "loss_end"])

        def put(closed: tuple | None) -> None:
            nonlocal number, chars
            if closed:
                rows.append((*here, number, *closed))
                chars += len(closed[0])
                number += 1

        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                conv_id, block, kind, at, role, text, tokens = row
                if (conv_id, block) != here:
                    if state:
                        put(state.close())
                    here, state, number, running = (conv_id, block), Block(window, history), 0, 0
                turn = Turn(role, text, running if at is None else at, tokens)
                running = turn.at + tokens
                if kind == SYSTEM:
                    state.system = turn
                elif kind == REPEATED:
                    state.remember(turn)
                else:
                    put(state.add(turn))
                if chars > BATCH_CHARS:
                    yield out()
                    rows, chars = [], 0
        if state:
            put(state.close())
        if rows:
            yield out()

    return write


def _formatted(turns: DataFrame, window: int, history: int) -> DataFrame:
    ordered = turns.sortWithinPartitions("conv_id", "block", "kind", "at", "turn", "role", "text")
    id_type = turns.schema["conv_id"].dataType.simpleString()
    return ordered.select("conv_id", "block", "kind", "at", "role", "text", "tokens").mapInArrow(_writer(window, history), f"conv_id {id_type}, {WINDOW_COLUMNS}")


def _blocks(turns: DataFrame, window: int, history: int, block: int) -> DataFrame:
    """The turns of long conversations dealt to their blocks, with the copies that each block needs."""
    summed = running_offsets(turns, ["conv_id", "turn", "role", "text"], count="tokens", name="at")
    spans = summed.groupBy("conv_id").agg(F.min("at").alias("_begin"), F.max("at").alias("_last")).withColumnRenamed("conv_id", "_conv")
    placed = summed.join(broadcast_if_small(spans), F.col("conv_id").eqNullSafe(F.col("_conv")))
    placed = placed.withColumn("at", F.col("at") - F.col("_begin")).withColumn("block", F.floor(F.col("at") / block))
    leads = (F.col("at") == 0) & (F.col("role") == "system") & (F.col("tokens") <= window // 2)
    copied = F.floor((F.col("at") + history) / block)
    columns = ["conv_id", "turn", "role", "text", "tokens", "at"]
    new = placed.select(*columns, "block", F.lit(NEW).alias("kind"))
    before = placed.filter((copied > F.col("block")) & (F.col("tokens") <= history) & ~leads).select(*columns, copied.alias("block"), F.lit(REPEATED).alias("kind"))
    last = F.floor((F.col("_last") - F.col("_begin")) / block)
    system = placed.filter(leads & (last > 0)).select(*columns, F.explode(F.sequence(F.lit(1).cast("long"), last)).alias("block"), F.lit(SYSTEM).alias("kind"))
    return new.unionByName(before).unionByName(system).repartition("conv_id", "block")


def windows(
    conversations: DataFrame, window: int = WINDOW, history: int = HISTORY, block_windows: int = BLOCK_WINDOWS, vocabulary: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Windows of ``(conv_id, turn, role, text)`` without null roles and texts: those of short conversations, where each
    conversation lies in one partition in order, and those of long ones, dealt by block.

    Columns: ``conv_id, block, window`` (their order), ``text``, its ``tokens``, the number of leading turns that are
    ``repeated``, and the spans of the loss mask in characters. ``vocabulary`` is a file of byte-pair ranks.
    """
    if not 0 <= history < window:
        raise ValueError("the history must be smaller than the window")
    counter = count_tokens(vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken"))
    rows = conversations.select("conv_id", "turn", "role", "text")
    block = window * block_windows
    # A token is a byte at least, so this bounds the tokens of a turn from above.
    most = 2 * F.octet_length("text").cast("long") + 3 * F.octet_length("role") + len(OPEN) + len(CLOSE) + 2
    long_ones = rows.groupBy(F.col("conv_id").alias("_conv")).agg(F.sum(most).alias("_most")).filter(F.col("_most") > block).select("_conv")
    long_ones = broadcast_if_small(materialize(long_ones, "long-conversations"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", tokens long"

    short = rows.join(long_ones, same, "left_anti").mapInArrow(counter, schema).repartition("conv_id")
    short = short.select("*", F.lit(0).cast("long").alias("block"), F.lit(NEW).alias("kind"), F.lit(None).cast("long").alias("at"))
    long = _blocks(rows.join(long_ones, same, "left_semi").mapInArrow(counter, schema), window, history, block)
    return _formatted(short, window, history), _formatted(long, window, history)


# -- reading windows back --------------------------------------------------------------------

DIGESTS = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation, from its windows in order; a conversation is streamed through, never held."""
    here, started, id_type = None, False, None
    turns, loss = hashlib.sha256(), hashlib.sha256()
    n_turns = loss_chars = formatted = 0
    done: list[tuple] = []

    def row() -> tuple:
        return here, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), formatted

    def out() -> pa.RecordBatch:
        columns = list(zip(*done, strict=True))
        types = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    for batch in batches:
        id_type = batch.schema.field("conv_id").type
        for values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            conv_id, text, repeated, starts, ends = values
            if not started or conv_id != here:
                if started:
                    done.append(row())
                here, started = conv_id, True
                turns, loss = hashlib.sha256(), hashlib.sha256()
                n_turns = loss_chars = formatted = 0
            for place, (role, said) in enumerate(parse(text)):
                if place >= repeated:
                    turns.update(f"{role}\n{said}\n".encode())
                    n_turns += 1
            for start, end in zip(starts, ends, strict=True):
                learned = unescape(text[start:end])
                loss.update(learned.encode())
                loss_chars += len(learned)
            formatted += len(text)
        if len(done) > 10_000:
            yield out()
            done = []
    if started:
        done.append(row())
        yield out()


def read_back(formatted: DataFrame, in_order: bool = False) -> DataFrame:
    """Counts and digests of the conversations that ``formatted`` windows hold, read from their texts and masks.

    ``in_order``: each conversation lies in one partition already. A digest of a whole conversation needs its windows
    in order, so a long conversation passes through one task, as a stream.
    """
    if not in_order:
        formatted = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "block", "window")
    id_type = formatted.schema["conv_id"].dataType.simpleString()
    return formatted.select("conv_id", "text", "repeated", "loss_start", "loss_end").mapInArrow(_digests, f"conv_id {id_type}, {DIGESTS}")


#: Its texts hold an escape, a marker of another template and the marker that ends a turn in this one.
PROBE = r"\### Assistant: </turn> ok"


def chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    r"""Contract query: all ``conversations`` and conversation -7 formatted, then read back.

    NULL text and role count as empty strings. Turns are taken by ``turn``, NULL first; rows of one turn number by
    role, then text, and equal rows are all kept. Rows without ``conv_id`` make up one conversation. Texts of any
    length stay whole. Of an empty table, only conversation -7 is left. Other columns are not read.
    """
    given = table(spark, sf_dir, "conversations")
    columns = [F.col("conv_id"), F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")]
    probe = spark.range(2).select(F.lit(-7).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    kinds = given.schema
    probe = probe.withColumns({"conv_id": F.col("conv_id").cast(kinds["conv_id"].dataType), "turn": F.col("turn").cast(kinds["turn"].dataType)})
    short, long = windows(given.select(*columns).unionByName(probe))
    return read_back(short, in_order=True).unionByName(read_back(long))

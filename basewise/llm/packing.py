"""Vector bin packing for instruction data (operator 5).

Sequences have simultaneous limits: tokens, segments and loss-bearing tokens.
An example is a vector of those sizes.  The open sequence has a vector of what
is left; the dot-product heuristic takes, among the pooled examples that fit,
the one whose vector has the greatest dot product with what is left (both
measured in parts of the limits).  If none fits and cutting is allowed, the
example with the greatest product is cut to fill the sequence.  What a task has
left at its end is cut into sequences whose lengths are powers of two, which
need no padding.

pack takes examples made of parts, each of which bears loss or doesn't, and
gives each piece with its ids and loss marks; conversations makes such examples
of chat turns, where the assistant's words bear loss.  The query packs plain
documents under the limits of DOCUMENTS: a document's own tokens bear loss, its
end mark doesn't, and a sequence has at most SEGMENTS pieces.

A task packs the rows it reads, a pool at a time: no shuffle, and memory is
bounded by the pool and one text.  sequence_id holds the partition's number
above bit 33, as monotonically_increasing_id does.

Defined results: a null or empty text, and an example without parts, is the end
mark alone; a null part is an empty one and a null loss mark bears none; a long
text is cut into pieces, however long its runs of white space; repeated rows and
doc_ids are packed as they come; a null doc_id stays null; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TOKENS, END, SEGMENTS = 1024, 0, 128
#: Pooled examples.
POOL = 128
#: Turns of a conversation that make one example at most.
TURNS = 1024
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


@dataclass(frozen=True)
class Limits:
    """What one sequence holds at most; None: no limit but tokens."""

    tokens: int = TOKENS
    segments: int | None = None
    loss: int | None = None


#: The limits of a sequence of plain documents.
DOCUMENTS = Limits(TOKENS, SEGMENTS, TOKENS)


@dataclass
class Example:
    """A run of tokens still to place; loss marks those that bear loss."""

    key: object
    ids: np.ndarray
    loss: np.ndarray
    start: int = 0

    @property
    def left(self) -> int:
        return len(self.ids) - self.start


@dataclass(frozen=True)
class Piece:
    key: object
    start: int
    ids: np.ndarray
    loss: np.ndarray
    total: int
    sequence: int
    offset: int


class Packer:
    """Places examples; call add for each, then finish."""

    def __init__(self, limits: Limits = Limits(), pool: int = POOL):
        self.limits, self.size, self.sequence = limits, pool, 0
        self.caps = np.array([limits.tokens, limits.segments or limits.tokens, limits.loss or limits.tokens], float)
        self.pool: list[Example] = []
        #: A row per pooled example: its tokens, 1, its loss-bearing tokens.
        self.need = np.ones((max(pool, limits.tokens) + 1, 3))

    def add(self, example: Example) -> Iterator[Piece]:
        self.need[len(self.pool)] = len(example.ids), 1, int(example.loss.sum())
        self.pool.append(example)
        while len(self.pool) > self.size and self.need[: len(self.pool), 0].sum() >= self.limits.tokens:
            yield from self._fill()

    def finish(self) -> Iterator[Piece]:
        """The rest: whole sequences first, then powers of two."""
        while self.pool and (total := int(self.need[: len(self.pool), 0].sum())):
            yield from self._fill(min(self.limits.tokens, 1 << (total.bit_length() - 1)))

    def _room(self, e: Example, left: np.ndarray) -> int:
        """How many of the example's next tokens all limits let in."""
        most = int(min(e.left, left[0]))
        bears = np.flatnonzero(e.loss[e.start : e.start + most])
        return int(bears[int(left[2])]) if len(bears) > left[2] else most

    def _fill(self, size: int | None = None) -> Iterator[Piece]:
        """One sequence of at most size tokens."""
        left, offset = self.caps.copy(), 0
        left[0] = min(left[0], size or left[0])
        need = self.need[: len(self.pool)]
        parts, shut = need / self.caps, np.zeros(len(need), bool)
        while left[0] > 0 and left[1] >= 1 and not shut.all():
            product = parts @ (left / self.caps)
            product[shut] = -1
            fits = np.where((need <= left).all(axis=1), product, -1)
            at = int(fits.argmax())
            if fits[at] < 0:
                at = int(product.argmax())
            shut[at] = True  # what is left of a cut example goes to a later sequence
            example = self.pool[at]
            n = self._room(example, left)
            if not n:
                continue
            run = slice(example.start, example.start + n)
            yield Piece(example.key, example.start, example.ids[run], example.loss[run], len(example.ids), self.sequence, offset)
            took = np.array([n, 1, int(example.loss[run].sum())])
            left -= took
            need[at] -= took * (1, 0, 1)
            offset, example.start = offset + n, example.start + n
        kept = need[:, 0] > 0
        self.need[: int(kept.sum())] = need[kept]
        self.pool = [e for e, keep in zip(self.pool, kept, strict=True) if keep]
        self.sequence += 1


def encoder(path: str, pattern: str) -> Callable[[str], np.ndarray]:
    """The ids of a byte-level tokenizer file, by tiktoken.

    The file's merges stand in the order of their ids, so its vocabulary is the
    merge ranks as well, and the ids are those of the tokenizers library at a
    seventh of its time (the tests compare them).  A text that tiktoken can't
    split, as its expressions fail on a run of about a million white spaces, is
    encoded by the tokenizers library itself.
    """
    import tiktoken
    from tokenizers import Tokenizer

    from basewise.llm.token_counts import byte_symbols

    with open(path, encoding="utf-8") as f:
        held = json.load(f)
    symbols, special = byte_symbols(), {t["content"]: t["id"] for t in held["added_tokens"]}
    ranks = {bytes(symbols[c] for c in piece): i for piece, i in held["model"]["vocab"].items() if piece not in special}
    encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)

    def encode(text: str) -> np.ndarray:
        try:
            return encoding.encode_to_numpy(text, allowed_special="all")
        except ValueError:
            return np.array(Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids, np.uint32)

    return encode


def _example(key: object, parts: list[tuple[str | None, bool | None]], encode: Callable[[str], np.ndarray]) -> Example:
    """An example of parts and the end mark, which bears no loss."""
    told = [(encode(text or ""), bool(loss)) for text, loss in parts]
    loss = np.repeat(np.array([*(mark for _, mark in told), False], np.int8), [*(len(ids) for ids, _ in told), 1])
    return Example(key, np.concatenate([*(ids for ids, _ in told), [END]]).astype("<u4"), loss)


def _placed(rows: DataFrame, limits: Limits, tokenizer: str, pattern: str, of: Callable[[pa.RecordBatch], Iterator[tuple]], emit: Callable[[list[Piece]], list[pa.Array]], schema: str) -> DataFrame:
    """The pieces of all rows, which of turns into keys and parts, by emit."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, encode = TaskContext.get(), encoder(tokenizer, pattern)
        base = (context.partitionId() if context else 0) << 33
        packer, out = Packer(limits), []

        def told() -> pa.RecordBatch:
            where = [pa.array([base + p.sequence for p in out], pa.int64()), pa.array([p.offset for p in out], pa.int64())]
            batch = pa.RecordBatch.from_arrays([*emit(out), *where], [c.split()[0] for c in schema.split(", ")])
            out.clear()
            return batch

        for batch in batches:
            for key, parts in of(batch):
                out.extend(packer.add(_example(key, parts, encode)))
                if len(out) >= 10_000:
                    yield told()
        out.extend(packer.finish())
        yield told()

    return rows.mapInArrow(place, schema)


def _longs(values: list[int | None]) -> pa.Array:
    return pa.array(values, pa.int64())


def pack(examples: DataFrame, limits: Limits, tokenizer: str, pattern: str) -> DataFrame:
    """(key long, parts array<struct<text, loss>>) -> pieces with ids and marks:
    key, start, length, ids, loss, tokens, sequence_id, offset."""

    def of(batch: pa.RecordBatch) -> Iterator[tuple]:
        for key, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            yield key, [(p["text"], p["loss"]) if p else (None, None) for p in parts or []]

    def emit(out: list[Piece]) -> list[pa.Array]:
        ids = pa.array([p.ids.astype(np.int32) for p in out], pa.list_(pa.int32()))
        loss = pa.array([p.loss.astype(bool) for p in out], pa.list_(pa.bool_()))
        return [_longs([p.key for p in out]), _longs([p.start for p in out]), _longs([len(p.ids) for p in out]), ids, loss, _longs([p.total for p in out])]

    parts = F.transform("parts", lambda p: F.struct(p["text"].cast("string").alias("text"), p["loss"].cast("boolean").alias("loss")))
    rows = examples.select(F.col("key").cast("long").alias("key"), parts.alias("parts"))
    return _placed(rows, limits, tokenizer, pattern, of, emit, "key long, start long, length long, ids array<int>, loss array<boolean>, tokens long, sequence_id long, offset long")


def conversations(turns: DataFrame, bears: str = "assistant") -> DataFrame:
    """(conv_id, turn, role, text) -> (key, parts) for pack, a row a conversation.

    Turns in order, each led by its role; only the text of the role named bears
    loss.  Repeated turns stay, ordered by their text; a null turn comes first,
    and turns without a conv_id are one conversation.  A conversation of over
    TURNS turns makes several examples, so that no row is unbounded.
    """
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    block = F.floor((F.row_number().over(w) - 1) / TURNS).alias("block")
    held = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    told = held.select("conv_id", block, F.row_number().over(w).alias("at"), "role", "text").groupBy("conv_id", "block")
    ordered = told.agg(F.array_sort(F.collect_list(F.struct("at", "role", "text"))).alias("turns"))
    led = F.transform("turns", lambda t: F.array(F.struct(F.concat(t["role"], F.lit(": ")).alias("text"), F.lit(False).alias("loss")), F.struct(F.concat(t["text"], F.lit("\n")).alias("text"), (t["role"] == bears).alias("loss"))))
    return ordered.select(F.col("conv_id").alias("key"), F.flatten(led).alias("parts"))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op5_pack(docs: DataFrame, tokenizer: str | None = None, limits: Limits = DOCUMENTS) -> DataFrame:
    """One row per piece of every document."""
    import public_tokenizers

    def of(batch: pa.RecordBatch) -> Iterator[tuple]:
        for key, text in zip(batch.column(0), batch.column(1), strict=True):
            yield key.as_py(), [(text.as_py(), True)]

    def emit(out: list[Piece]) -> list[pa.Array]:
        digest = _longs([zlib.crc32(p.ids.tobytes()) for p in out])
        return [_longs([p.key for p in out]), _longs([p.start for p in out]), _longs([len(p.ids) for p in out]), digest, _longs([p.total for p in out])]

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _placed(rows, limits, tokenizer or default_tokenizer(), public_tokenizers.PATTERN, of, emit, SCHEMA)

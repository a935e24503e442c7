"""Vector bin packing of token segments by the dot-product heuristic.

A sequence has several capacities at once: tokens, number of segments, and tokens that bear loss. Items wait in a pool;
the open sequence takes, again and again, the fitting item with the largest dot product of its demands with what the
sequence has left, both as shares of the capacities, until nothing fits. If tokens are left then, the largest item
is cut to fill them (``cut=True``). A sequence that stays below the token limit, because another limit binds or the task ends, is dealt
to sequences of a power of two tokens, which need no padding.

Packing runs inside the tasks that read the texts, over pools of at most ``pool`` items; items longer than a sequence first
give off whole sequences. Sequence numbers are the task's number and a counter, so a task that runs again packs alike and
nothing is shuffled. A task holds its pool and one text, whatever the size of the table or of a group of copies.

Instruction examples have a prompt column beside the text, which is the answer: the prompt's ids come first and bear no loss, the
answer's and the closing id do, and the limit on loss-bearing tokens counts them. Special tokens of the vocabulary are recognized in texts as
the tokenizer's own library does by default.

Defined results: a null or empty text is one token, the closing id 0; repeated rows are packed as often as they occur; a
null id stays null; further columns are ignored; an empty table gives no piece. Without ``cut`` an item above any capacity
raises ``ValueError``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.tokens import ids as token_ids
from tallyloom.llm.tokens import special_ids as specials  # noqa: F401

CLOSING = b"\0\0\0\0"
POOL = 512
TASK_SHIFT = 38


@dataclass(frozen=True)
class Limits:
    """Capacities of a sequence."""

    tokens: int = 1024
    segments: int = 128
    loss: int = 1024

    def array(self) -> np.ndarray:
        return np.array([self.tokens, self.segments, self.loss], float)


class Packer:
    """Packs items ``(key, tokens, loss)`` into sequences; yields lists of ``(key, start, length)`` per sequence.

    ``loss`` counts the trailing tokens of an item that bear loss (an answer after its prompt), at most ``tokens``.
    """

    def __init__(self, limits: Limits, cut: bool = True, pool: int = POOL):
        self.limits, self.cut, self.pool = limits, cut, pool
        self.full = limits.array()
        self.keys, self.starts, self.tokens, self.loss = [None] * pool, np.zeros(pool, int), np.zeros(pool, int), np.zeros(pool, int)
        self.n = 0

    def _reach(self, tokens: int, loss: int, room: np.ndarray) -> int:
        """Leading tokens of an item that fit into ``room``."""
        if room[1] < 1:
            return 0
        take = min(tokens, int(room[0]))
        silent = tokens - loss
        return take if take <= silent else min(take, silent + int(room[2]))

    def add(self, key, tokens: int, loss: int) -> Iterator[list[tuple]]:
        """Take one item; yields the sequences that this completes."""
        if not self.cut and (tokens > self.full[0] or loss > self.full[2]):
            raise ValueError("an item is larger than a sequence")
        start = 0
        while tokens > self.full[0] or loss > self.full[2]:
            take = self._reach(tokens, loss, self.full)
            yield [(key, start, take)]
            start, tokens = start + take, tokens - take
            loss = min(loss, tokens)
        if tokens:
            i = self.n
            self.keys[i], self.starts[i], self.tokens[i], self.loss[i] = key, start, tokens, loss
            self.n += 1
            if self.n == self.pool:
                yield self._sequence()

    def drain(self) -> Iterator[list[tuple]]:
        while self.n:
            yield self._sequence()

    def _remove(self, i: int) -> None:
        last = self.n - 1
        self.keys[i], self.starts[i], self.tokens[i], self.loss[i] = self.keys[last], self.starts[last], self.tokens[last], self.loss[last]
        self.keys[last], self.n = None, last

    def _sequence(self) -> list[tuple]:
        room, out = self.full.copy(), []
        while self.n and room[0] >= 1 and room[1] >= 1:
            tokens, loss = self.tokens[:self.n], self.loss[:self.n]
            fits = (tokens <= room[0]) & (loss <= room[2])
            left = room / self.full
            value = np.where(fits, tokens * (left[0] / self.full[0]) + loss * (left[2] / self.full[2]) + left[1] / self.full[1], -1.0)
            i = int(value.argmax())
            if value[i] >= 0:
                take = int(tokens[i])
                out.append((self.keys[i], int(self.starts[i]), take))
                room -= (take, 1, loss[i])
                self._remove(i)
                continue
            i = int(tokens.argmax())
            take = self._reach(int(tokens[i]), int(loss[i]), room) if self.cut else 0
            if not take:
                break
            out.append((self.keys[i], int(self.starts[i]), take))
            break_at = int(tokens[i]) - take
            room -= (take, 1, max(0, int(loss[i]) - break_at))
            self.starts[i] += take
            self.tokens[i], self.loss[i] = break_at, min(int(loss[i]), break_at)
        return out


def _powers(sequence: list[tuple]) -> Iterator[list[tuple]]:
    """The pieces of one sequence, dealt to sequences whose lengths are powers of two, the largest first."""
    left = sum(length for _, _, length in sequence)
    pieces = iter(sequence)
    key, start, length = next(pieces)
    while left:
        size, out = 1 << left.bit_length() - 1, []
        left -= size
        while size:
            if not length:
                key, start, length = next(pieces)
            take = min(size, length)
            out.append((key, start, take))
            start, length, size = start + take, length - take, size - take
        yield out


def pack_documents(docs: DataFrame, vocabulary: str, special: dict[str, int] | None = None, id_col: str = "doc_id", text_col: str = "text",
                   prompt_col: str | None = None, limits: Limits = Limits()) -> DataFrame:
    """Pieces of all documents with their place: id, ``start``, ``length``, ``ids`` (packed little-endian integers), ``doc_tokens``,
    ``loss`` (tokens of the piece that bear loss: all, or those after the document's prompt), ``sequence_id``, ``offset``."""
    prompt = F.col(prompt_col).cast("string") if prompt_col else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), prompt.alias("prompt"))
    kind_of_id = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind_of_id}, start bigint, length bigint, ids binary, doc_tokens bigint, loss bigint, sequence_id bigint, offset bigint"
    arrow = pa.schema([("id", pa.null()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                       ("doc_tokens", pa.int64()), ("loss", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, packer, out = TaskContext.get().partitionId() << TASK_SHIFT, Packer(limits), []
        kind = None

        def place(sequence: list[tuple]) -> None:
            nonlocal number
            offset = 0
            for (doc, ids, silent), start, length in sequence:
                loss = max(0, start + length - max(start, silent))
                out.append((doc, start, length, ids[4 * start:4 * (start + length)], len(ids) // 4, loss, number, offset))
                offset += length
            number += 1

        def deal(sequence: list[tuple]) -> None:
            full = sum(length for _, _, length in sequence) == limits.tokens
            for part in [sequence] if full else _powers(sequence):
                place(part)

        def batch() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c, kind if f.name == "id" else f.type) for c, f in zip(zip(*out), arrow)], arrow.names)
            out.clear()
            return made

        for b in batches:
            kind = b.column(0).type
            for doc, text, prompt in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                first = token_ids(prompt.as_py(), vocabulary, special)
                ids = first + token_ids(text.as_py(), vocabulary, special) + CLOSING
                silent, n = len(first) // 4, len(ids) // 4
                for sequence in packer.add((doc, ids, silent), n, n - silent):
                    deal(sequence)
                if len(out) >= 2000:
                    yield batch()
        for sequence in packer.drain():
            deal(sequence)
        if out:
            yield batch()

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: all documents in sequences of 1024 tokens, with the checksum of each piece's ids."""
    pieces = pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), "byte_bpe_50k.tiktoken", specials("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")

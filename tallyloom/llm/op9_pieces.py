"""SentencePiece BPE encoding and decoding through a table of each prefix's last token.

In a merge-type vocabulary a text has one encoding, and so has each of its prefixes. The encoding of a prefix ends in one
token, and a token that ends there is that last token exactly if it is compatible with the last token of the prefix before
it: the pair, merged on its own, stays a pair. An automaton over all pieces gives the tokens that end at each position; the
table keeps the one that passes the test; ids are recovered from the end backwards. The work is linear in the text.

Compatibility is decided once per pair of tokens by merging their joined text (at most two pieces long), and remembered.
No piece of such a model has a word mark after another character, so a text is cut before each run of word marks that
follows another character and the parts' ids are remembered too; both memories are bounded and are emptied when full.

Normalization is the model's own where it is "identity" with a word mark put before the text; other models are refused.
Characters without a piece become the byte pieces of their UTF-8; bytes that are not UTF-8 decode to U+FFFD.

Defined results: a null or empty text has no ids and decodes to the empty text; a repeated row is encoded as often as it
occurs; a null id stays null; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.tokens import packed

MARK = "▁"
PARTS = 1_000_000
PAIRS = 2_000_000
LONGEST = 64
_PART = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class PrefixTable:
    """Encoder and decoder of one model file."""

    def __init__(self, model_file: str):
        library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        if library.normalize(" a  ﬁ ") != f"{MARK}{MARK}a{MARK}{MARK}ﬁ{MARK}":
            raise ValueError("the model's normalization is not identity with a leading word mark")
        size = library.get_piece_size()
        special = [library.is_control(i) or library.is_unknown(i) or library.is_unused(i) for i in range(size)]
        self.byte = [0] * 256
        self.raw = [b""] * size
        self.score, self.number, self.text = {}, {}, {}
        for i in range(size):
            piece = library.id_to_piece(i)
            if library.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                self.raw[i] = bytes([int(piece[3:5], 16)])
            elif not special[i]:
                self.score[piece], self.number[piece], self.text[i] = library.get_score(i), i, piece
                self.raw[i] = piece.replace(MARK, " ").encode()
            elif library.is_unknown(i):
                self.raw[i] = " ⁇ ".encode()
        if any(MARK in p.lstrip(MARK) for p in self.score):
            raise ValueError("a piece has a word mark after another character")
        self.is_byte = np.zeros(size, bool)
        self.is_byte[self.byte] = True
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.number.items():
            if self._merged(piece) == [piece]:  # others never come out of merging
                self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.parts = _Parts(self)

    def _merged(self, text: str) -> list[str]:
        """Pieces of a short text by merging the best adjacent pair, the leftmost of equals, until none is left."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _compatible(self, a: int, b: int) -> bool:
        key = a << 32 | b
        known = self.pairs.get(key)
        if known is None:
            left, right = self.text[a], self.text[b]
            known = self._merged(left + right) == [left, right]
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            self.pairs[key] = known
        return known

    def part_ids(self, part: str) -> list[int]:
        """Ids of a part in which every space is a word mark."""
        n = len(part)
        last, length = [-1] * (n + 1), [1] * (n + 1)  # -1: a character without a piece
        settled = 0
        for end, (size, token) in self.automaton.iter(part):
            end += 1
            if settled == end:
                continue
            before = last[end - size]
            if before < 0 or self._compatible(before, token):
                last[end], length[end], settled = token, size, end
        out, end = [], n
        while end:
            if last[end] >= 0:
                out.append(last[end])
            else:
                out += [self.byte[x] for x in reversed(part[end - 1].encode())]
            end -= length[end]
        out.reverse()
        return out

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as packed 32-bit integers."""
        if not text:
            return b""
        words = text.replace(MARK, " ").split(" ")
        if "" in words:
            marked = MARK + MARK.join(words)
            return b"".join(self.parts[p] for p in _PART.findall(marked))
        return b"".join(map(self.parts.__getitem__, words))

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids: without the leading word mark, byte pieces joined to characters."""
        raw = b"".join(map(self.raw.__getitem__, ids.tolist()))
        if raw[:1] == b" " and len(ids) and not self.is_byte[ids[0]]:
            raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return _lenient(raw)


class _Parts(dict):
    """Word (without its mark) or marked part -> packed ids."""

    def __init__(self, table: PrefixTable):
        super().__init__()
        self.table = table

    def __missing__(self, part: str) -> bytes:
        ids = packed(self.table.part_ids(part if part[0] == MARK else MARK + part))
        if len(self) >= PARTS:
            self.clear()
        if len(part) <= LONGEST:
            self[part] = ids
        return ids


def _lenient(raw: bytes) -> str:
    """UTF-8 with U+FFFD for each byte that belongs to no character."""
    out, at = [], 0
    while at < len(raw):
        try:
            out.append(raw[at:].decode())
            break
        except UnicodeDecodeError as e:
            out.append(raw[at:at + e.start].decode() + "�")
            at += e.start + 1
    return "".join(out)


@functools.cache
def _table(model: str) -> PrefixTable:
    return PrefixTable(public_tokenizers.path(model))


def encode(docs: DataFrame, model: str, text_col: str = "text", id_col: str = "doc_id", decode_too: bool = False) -> DataFrame:
    """``(id, ids)``, and with ``decode_too`` the text ``decoded`` from these ids in the same pass."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>" + ", decoded string" * decode_too

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(model)
        for whole in batches:
            for batch in _bounded(whole):
                found = [np.frombuffer(table.encode(x.as_py()), "<i4") for x in batch.column(1)]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found)))
                columns = [batch.column(0), lists]
                if decode_too:
                    columns.append(pa.array([table.decode(x) for x in found], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, ["id", "ids", "decoded"][:len(columns)])

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, model: str, ids_col: str = "ids", id_col: str = "doc_id") -> DataFrame:
    """``(id, decoded)``: the text of every row's ids; a null list decodes to the empty text, ids outside the model fail."""
    rows = encoded.select(F.col(id_col).alias("id"), F.coalesce(F.col(ids_col).cast("array<int>"), F.array().cast("array<int>")).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(model)
        for batch in batches:
            texts = [table.decode(np.asarray(x.values, np.int32)) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "decoded"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, decoded string").withColumnRenamed("id", id_col)


def _bounded(batch: pa.RecordBatch, rows: int = 500) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: number and digest of every document's ids, and the digest of the text decoded from them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    coded = encode(docs, "piece_bpe_32k.model", decode_too=True)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))

"""Token ids of byte-level BPE vocabularies, with a bounded memory of pieces already encoded.

A space followed by a non-space always begins a new pretoken, so a text can be cut there and each part encoded on its
own: parts repeat far more often than texts. Where several white-space characters meet around a space the cut would not be
safe, and the whole text is encoded at once.
"""

from __future__ import annotations

import base64
import functools
import json
import re
import sys
from array import array

import public_tokenizers
import tiktoken

PARTS = 200_000
LONGEST = 64


class _Unsafe(Exception):
    """White space follows a space."""


class _Parts(dict):
    """Part without its leading space -> ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, part: str) -> bytes:
        if not part or part[0].isspace():
            raise _Unsafe
        ids = packed(self.encode(" " + part))
        if len(self) >= PARTS:
            self.clear()
        if len(part) <= LONGEST:
            self[part] = ids
        return ids


@functools.cache
def _ranked(name: str) -> tuple[tiktoken.Encoding, _Parts]:
    with open(public_tokenizers.path(name), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoding = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return encoding, _Parts(encoding.encode_ordinary)


def packed(numbers: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    out = array("I", numbers)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


@functools.cache
def _splitter(strings: tuple[str, ...]) -> re.Pattern:
    return re.compile("|".join(map(re.escape, sorted(strings, key=len, reverse=True))))


def special_ids(name: str) -> dict[str, int]:
    """Special tokens of a tokenizer file and their ids, all of the plain kind that matches anywhere in a text."""
    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        added = json.load(f)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
        raise ValueError("special tokens with conditions are not served")
    return {t["content"]: t["id"] for t in added}


def ids(text: str | None, vocabulary: str, special: dict[str, int] | None = None) -> bytes:
    """Ids of a whole text by a rank file, packed; strings of ``special`` get their own id, and what lies between is encoded apart."""
    if not text:
        return b""
    if special and any(s in text for s in special):
        pattern, out, end = _splitter(tuple(special)), [], 0
        for m in pattern.finditer(text):
            out += [ids(text[end:m.start()], vocabulary), packed([special[m.group()]])]
            end = m.end()
        return b"".join(out) + ids(text[end:], vocabulary)
    encoding, parts = _ranked(vocabulary)
    first, *rest = text.split(" ")
    try:
        return (packed(encoding.encode_ordinary(first)) if first else b"") + b"".join(map(parts.__getitem__, rest))
    except _Unsafe:
        return packed(encoding.encode_ordinary(text))

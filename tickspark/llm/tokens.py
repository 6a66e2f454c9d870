"""Token ids of whole texts by a byte-level BPE vocabulary file, fast enough for a corpus."""

from __future__ import annotations

import json
import re
import sys
from array import array
from functools import lru_cache

import tiktoken
from tokenizers import Tokenizer

#: Fixed value: the published split pattern of this family of vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Letters up to here are letters in every Unicode version, so both libraries split alike.
SETTLED = "ɏ"
#: Pieces each of the two caches of an encoder holds, and the longest ones kept: together below 250 MB. They stay for later
#: tasks of a worker, as a piece met for the first time costs far more than the rest of its text.
CACHED = 500_000
LONGEST = 48


def _bytes(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


class _Odd(Exception):
    """A piece that a cut at blanks must not make."""


class _Known(dict):
    def __init__(self, owner: "Encoder", before: str):
        self.owner, self.before = owner, before

    def __missing__(self, piece: str) -> bytes:
        if self.before and (not piece or piece[0].isspace()):
            raise _Odd
        made = self.owner.chunk(self.before + piece)
        if len(piece) <= LONGEST:
            self[piece] = made
        return made


class Encoder:
    """Ids as ``tokenizers`` gives them with ``add_special_tokens=False``, as little-endian 32-bit bytes.

    No token spans a blank that stands before a visible character, so a text is cut there and the parts
    are looked up in a cache. Parts met for the first time are encoded by the same merges in
    ``tiktoken`` where both libraries split alike, by ``tokenizers`` elsewhere. The cache is emptied
    when full; it changes no result.
    """

    def __init__(self, path: str):
        self.full = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"] for t in spec.get("added_tokens", [])}
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        hidden = [b for b in range(256) if b not in set(shown)]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.fast = tiktoken.Encoding("parts", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.first, self.later = _Known(self, ""), _Known(self, " ")

    def chunk(self, text: str) -> bytes:
        if not text:
            return b""
        if max(text) <= SETTLED:
            return _bytes(self.fast.encode_ordinary(text))
        return self.whole(text)

    def whole(self, text: str) -> bytes:
        return _bytes(self.full.encode(text, add_special_tokens=False).ids)

    def encode(self, text: str) -> bytes:
        if self.special and self.special.search(text):
            return self.whole(text)
        if len(self.later) > CACHED:
            self.later.clear()
        if len(self.first) > CACHED:
            self.first.clear()
        head, *rest = text.split(" ")
        try:
            later = self.later
            return self.first[head] + b"".join([later[p] for p in rest])
        except _Odd:
            first = self.first
            return b"".join([first[p] for p in re.split(r"(?= \S)", text)])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)

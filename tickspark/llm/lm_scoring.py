"""Language-model scoring by online logistic context mixing over bits.

A text is the sequence of its words, in lower case, and an end. With ``unit="grams"``, as the query has it, and ``"bytes"``
the bits are those of the text: each word is its bytes and a blank, the end a blank alone, and all eight bits of each byte are
predicted from the bits before them in the byte and from contexts. The probability of a text is the product of those of its bits.

The contexts of ``"grams"`` are none and the 1 to 5 bytes before, across words. A byte and the five before it, a gram, settle
all of them, so each distinct gram of ``CHUNK_BYTES`` of text is predicted once, with the number of times it stands there: when
learning, from the counts of everything so far and of the chunk without one time of the gram itself; when scoring, for all places.
The contexts of ``"bytes"`` are none, the bytes of the word so far, and these and the word before. Bytes of the same word
after the same word share them, so a chunk's distinct pairs of words are predicted once as they come first and once for all
their repeats. Most pairs are rare, which makes it many times slower.

With ``unit="words"``, a shorter form, each word has a class of ``CODE_BITS`` bits, taken from its hash, whose bits are
predicted (contexts: none, the word before, the two words before). Within its class a word has the probability of its
count plus one, and words that were never seen share one event per class, as in the base score. So

    p(word | before) = product of p(bit | contexts) * (c + 1) / (class count + class words + 1)

Each context is a table of bit counts, looked up by hash. A mixer adds up the predictions in the logistic domain with weights
that a gate selects by bit position and by how often the contexts were seen; an adaptive table then refines the mixed probability.

Learning is online: each task runs through its documents, predicts some symbols, moves the weights along
the gradient, and counts them. Bit counts of all tasks are added up and their weights averaged; the model
has a fixed size, ``2 ** table_bits`` slots per hashed context, that a larger corpus may raise. Word counts are
exact and grow with the corpus: they stay distributed, meet the words of blocks of documents in a join (the few
thousand most frequent ones by a broadcast), and only sums per document come back. Words are told apart by 64-bit hashes.

Defined cases: a null text is empty; an empty text is its end. Rows with equal key and text get the same scores, and
each counts when learning. Without training rows every word is unknown. Empty tables give empty tables.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickspark.llm.common import give_back, map_batches, stored

CODE_BITS = 6
CLASSES = 1 << CODE_BITS
HASHED = 2  # contexts with hashed tables
BYTE_BITS = 8
ORDERS = (1, 2, 3, 4, 5)  # contexts of grams, in bytes before; the first has a slot for each node, the others are hashed
UNITS = {"grams": BYTE_BITS, "bytes": BYTE_BITS, "words": CODE_BITS}  # bits of a symbol
STEPS = 33
CHUNK = 32_768
# Bytes predicted together; some 64 KB for each array over them.
STEP_BYTES = 1 << 13
# Bytes of text whose equal grams are predicted together, bytes looked up together, and slots to look them up.
CHUNK_BYTES = 1 << 23
LOOK_BYTES = 1 << 17
LOOK_BITS = 21
SUM_BYTES = 1 << 20
NO_GRAM = np.iinfo(np.uint64).max
SLOTS_PER_ROW = 4096
# A row's numbers are added up in so many parts first; each part is shuffled again.
SALTS = 4
BLOCK_PAIRS = 2_000_000
BLOCK_DOCS = 50_000
# A place is a document of the block and a count, in 31 bits.
COUNT_BITS = 12
MOST = (1 << COUNT_BITS) - 1
# At most so many words, those with the most places, are joined by a broadcast.
FREQUENT = 20_000
END = b""
# Share of the step to the weights that a stretch of grams would like best, and what its curvature is at least.
NEAR, FLAT, LEAST = 0.5, 0.1, 0.01
POWER = 0x9E3779B97F4A7C15


class _Ids(dict):
    """Words to consecutive numbers; ``hashes`` has the hash of each."""

    def __init__(self):
        self.found: list[int] = []
        self.words: list[bytes] = []
        self.ready = np.zeros(1 << 16, np.uint64)
        self.done = 0

    def __missing__(self, word: bytes) -> int:
        i = self[word] = len(self.found)
        self.words.append(word)
        self.found.append(xxhash.xxh3_64_intdigest(word))
        return i

    def of(self, text: str | None) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
        words.append(END)
        return np.array([self[w] for w in words], np.int64)

    def hashes(self) -> np.ndarray:
        n = len(self.found)
        if n > len(self.ready):
            self.ready = np.concatenate([self.ready, np.zeros(max(n, len(self.ready)), np.uint64)])
        self.ready[self.done: n] = self.found[self.done:]
        self.done = n
        return self.ready[:n]


class Spelling:
    """The distinct pairs of neighbouring words of some texts, byte by byte."""

    def __init__(self, docs: list[np.ndarray], ids: _Ids, table_bits: int):
        now, hashes = np.concatenate(docs), ids.hashes()
        self.table_bits = table_bits
        self.firsts = np.cumsum([0, *map(len, docs[:-1])])
        before = np.empty_like(now)
        before[1:] = now[:-1] + 1
        before[self.firsts] = 0
        pairs, found, self.pair, self.times = np.unique(
            before << 32 | now, return_index=True, return_inverse=True, return_counts=True)
        order = np.argsort(found)  # as they come in the texts
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        pairs, self.pair, self.times = pairs[order], place[self.pair], self.times[order]
        before, now = pairs >> 32, pairs & 0xFFFFFFFF
        self.before = np.where(before > 0, hashes[before - 1] >> np.uint64(32), 0).astype(np.uint32)
        kinds, at = np.unique(now, return_inverse=True)
        named = [ids.words[i] + b" " for i in kinds.tolist()]
        sizes = np.array([len(w) for w in named])
        self.bytes = np.frombuffer(b"".join(named), np.uint8)
        starts = np.cumsum(sizes) - sizes
        self.prefix = self.prefixes(self.bytes, starts, sizes)
        self.word = starts[at]
        self.sizes = sizes[at]

    def __len__(self) -> int:
        return len(self.times)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """The values of its pairs added up for each text."""
        return np.add.reduceat(values[self.pair], self.firsts)

    @staticmethod
    def prefixes(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """For each byte a hash of the bytes of its word before it."""
        powers = np.full(int(sizes.max()), POWER, np.uint64)
        powers[0] = 1
        powers = np.cumprod(powers, dtype=np.uint64)
        nth = np.arange(len(flat)) - np.repeat(starts, sizes)
        sums = np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * powers[nth], dtype=np.uint64)
        before = np.append(np.uint64(0), sums[:-1])
        h = before - np.repeat(before[starts], sizes)
        h = (h ^ h >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
        return (h >> np.uint64(32)).astype(np.uint32)

    def steps(self, pairs: np.ndarray | None = None) -> Iterator[tuple[Contexts, np.ndarray]]:
        """Contexts of the bytes of ``pairs`` (or all), some bytes at a time, and the number of the pair each byte is of."""
        pairs = np.arange(len(self.times)) if pairs is None else pairs
        ends = np.cumsum(self.sizes[pairs])
        starts = ends - self.sizes[pairs]
        for a in range(0, int(ends[-1]) if len(ends) else 0, STEP_BYTES):
            b = min(a + STEP_BYTES, int(ends[-1]))
            lo, hi = np.searchsorted(ends, [a, b - 1], "right")
            nth = np.repeat(np.arange(lo, hi + 1), np.minimum(ends[lo: hi + 1], b) - np.maximum(starts[lo: hi + 1], a))
            pair = pairs[nth]
            at = self.word[pair] + np.arange(a, b) - starts[nth]
            yield Contexts.of(self.bytes[at].astype(np.int64), self.prefix[at], self.before[pair], self.table_bits), pair


def spelled(text: str | None) -> bytes:
    """The bytes of a text: each word and a blank, then a blank as its end."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    words.append(END)
    return b" ".join(words) + b" "


class Grams:
    """The distinct bytes with the ``ORDERS[-1]`` bytes before them of some texts, in the order they come first. Few grams
    that share their slots with others may be held more than once, with their times divided among them."""

    def __init__(self, docs: list[bytes], table_bits: int):
        self.table_bits, most = table_bits, ORDERS[-1]
        sizes = np.array([len(d) for d in docs])
        self.firsts = np.cumsum(sizes) - sizes
        n = int(sizes.sum())
        self.tables = [np.zeros(1 << min(LOOK_BITS, n.bit_length() + 1), np.int32) for _ in range(2)]
        self.keys, self.count = np.full(1 << 12, NO_GRAM, np.uint64), 1  # number 0 is no gram
        self.gram = np.empty(n, np.int32)
        done, held, size = 0, [], 0
        for d in docs:
            for a in range(0, len(d), LOOK_BYTES):
                held += [d[a - most: a] if a else bytes(most), d[a: a + LOOK_BYTES]]
                size += len(held[-1])
                if size >= LOOK_BYTES:
                    self._take(held, done)
                    done, held, size = done + size, [], 0
        if held:
            self._take(held, done)
        self.keys = self.keys[:self.count]
        del self.tables

    def __len__(self) -> int:
        return self.count

    @cached_property
    def times(self) -> np.ndarray:
        return sum(np.bincount(self.gram[a: a + SUM_BYTES], minlength=self.count) for a in range(0, len(self.gram), SUM_BYTES))

    def sums(self, values: np.ndarray) -> np.ndarray:
        """The values of its grams added up for each text."""
        out, ends = np.empty(len(self.firsts)), np.append(self.firsts[1:], len(self.gram))
        lo = 0
        while lo < len(out):
            a = self.firsts[lo]
            hi = max(int(np.searchsorted(ends, a + SUM_BYTES, "right")), lo + 1)
            out[lo: hi] = np.add.reduceat(values[self.gram[a: ends[hi - 1]]], self.firsts[lo: hi] - a)
            lo = hi
        return out

    def _take(self, pieces: list[bytes], done: int) -> None:
        """Numbers of the grams of pieces, each after the bytes before it."""
        most = ORDERS[-1]
        flat = bytes(7 - most) + b"".join(pieces)
        sizes = np.array([len(p) for p in pieces])
        inside = np.repeat(np.arange(len(pieces)) % 2 == 1, sizes)
        keys = np.ndarray((len(flat) - 7,), ">u8", flat, 0, (1,)).astype(np.uint64)[inside[most:]] & np.uint64((1 << 8 * most + 8) - 1)
        (table, slots), (other, others) = self._slots(keys)
        at = table[slots]
        missed = np.flatnonzero(self.keys[at] != keys)
        at[missed] = again = other[others[missed]]
        missed = missed[self.keys[again] != keys[missed]]
        if len(missed):
            new, first, which = np.unique(keys[missed], return_index=True, return_inverse=True)
            order = np.argsort(first)
            number = np.empty_like(order)
            number[order] = np.arange(len(order))
            at[missed] = self.count + number[which]
            self._add(new[order])
        self.gram[done: done + len(at)] = at

    def _slots(self, keys: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        return [(t, (keys * np.uint64(odd) >> np.uint64(65 - len(t).bit_length())).view(np.int64))
                for t, odd in zip(self.tables, (POWER, 0xD6E8FEB86659FD93))]

    def _add(self, new: np.ndarray) -> None:
        total = self.count + len(new)
        if total > len(self.keys):
            self.keys = np.append(self.keys, np.full(max(total, 2 * len(self.keys)) - len(self.keys), NO_GRAM, np.uint64))
        self.keys[self.count: total] = new
        number = np.arange(self.count, total, dtype=np.int32)
        for k in range(2):  # into the first table, what finds its slot taken into the second
            table, slots = self._slots(new)[k]
            free = table[slots] == 0
            table[slots[free]] = number[free]
            left = table[slots] != number
            new, number = new[left], number[left]
        self.count = total

    def steps(self, grams: np.ndarray | None = None) -> Iterator[tuple[Contexts, np.ndarray]]:
        """Contexts of the last bytes of ``grams`` (or all), some at a time, and the numbers of these."""
        grams = np.arange(1, self.count) if grams is None else grams
        for a in range(0, len(grams), STEP_BYTES):
            some = grams[a: a + STEP_BYTES]
            yield Contexts.after(self.keys[some], self.table_bits), some


class Contexts:
    """Slots of the bits of a stretch of symbols."""

    direct = 0  # contexts that are the high bits of their slots

    def __init__(self, hashes: np.ndarray, first: np.ndarray, table_bits: int):
        """Symbols whose contexts are the one and the two symbols before. The low bits of ``hashes`` are a symbol's code.
        ``first``: whether a symbol is the first of its text."""
        h = (hashes >> np.uint64(32)).astype(np.uint32)
        one, two = np.zeros_like(h), np.zeros_like(h)
        one[1:] = h[:-1]
        one[first] = 0
        two[1:] = one[:-1]
        two[first] = 0
        self._set((hashes & np.uint64(CLASSES - 1)).astype(np.int64), one, two, table_bits, CODE_BITS)

    @classmethod
    def of(cls, code: np.ndarray, one: np.ndarray, two: np.ndarray, table_bits: int) -> Contexts:
        """Bytes with given contexts: ``one``, and ``one`` and ``two`` together."""
        new = cls.__new__(cls)
        new._set(code, one, two, table_bits, BYTE_BITS)
        return new

    @classmethod
    def after(cls, keys: np.ndarray, table_bits: int) -> Contexts:
        """Bytes, the low ones of ``keys``, after the bytes above them."""
        new = cls.__new__(cls)
        new.code, new.code_bits, new.shift, new.direct = (keys & np.uint64(255)).astype(np.int64), BYTE_BITS, np.uint32(32 - table_bits), 1
        new.base = [(keys & np.uint64(0xFF00)).astype(np.int64)]
        for order in ORDERS[1:]:
            before = keys >> np.uint64(8) & np.uint64((1 << 8 * order) - 1)
            new.base.append((before * np.uint64(POWER) >> np.uint64(32)).astype(np.uint32))
        return new

    def _set(self, code: np.ndarray, one: np.ndarray, two: np.ndarray, table_bits: int, code_bits: int) -> None:
        self.code, self.code_bits = code, code_bits
        self.base = (one * np.uint32(0x9E3779B1), (one * np.uint32(0x85EBCA6B)) ^ (two * np.uint32(0xC2B2AE35)))
        self.shift = np.uint32(32 - table_bits)

    def bit(self, j: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """The bit, its node in the code tree and its slot in each hashed table."""
        node = (self.code >> (self.code_bits - j)) | 1 << j
        salt = node.astype(np.uint32) * np.uint32(0x27D4EB2F)
        return self.code >> (self.code_bits - 1 - j) & 1, node, [
            b | node if k < self.direct else (((b ^ salt) * np.uint32(0x165667B1)) >> self.shift).astype(np.int64)
            for k, b in enumerate(self.base)]


def stretch(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return np.log((n1 + np.float32(0.4)) / (n0 + np.float32(0.4)))


def confidence(n: np.ndarray) -> np.ndarray:
    return (n > 0).astype(np.int64) + (n > 8)


def step_of(z: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(z * 2).astype(np.int64) + STEPS // 2, 0, STEPS - 1)


def sizes_of(unit: str, table_bits: int) -> list[int]:
    """Bits of a slot's number in each context's table."""
    return [16] + [table_bits] * (len(ORDERS) - 1) if unit == "grams" else [table_bits] * HASHED


def packed(numbers: np.ndarray, kind: str) -> bytes:
    """Numbers as bytes; those of equal weight stand together, which makes most of them equal."""
    flat = np.ascontiguousarray(numbers, kind).reshape(-1)
    return zlib.compress(flat.view(np.uint8).reshape(-1, flat.itemsize).T.tobytes(), 1)


def unpacked(numbers: bytes, kind: str) -> np.ndarray:
    flat = np.frombuffer(zlib.decompress(numbers), np.uint8)
    return np.ascontiguousarray(flat.reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1)


class Learner:
    """Counts, mixing weights and refinement of one task. ``sizes``: of the tables, if not those of ``HASHED`` contexts."""

    def __init__(self, table_bits: int, rate: float = 0.3, code_bits: int = CODE_BITS, sizes: list[int] | None = None):
        self.table_bits, self.rate, self.seen, self.code_bits = table_bits, rate, 0, code_bits
        sizes = sizes or [table_bits] * HASHED
        self.gates, classes = code_bits * 9, 1 << code_bits
        self.root = np.zeros((2, classes), np.uint32)
        self.tables = [np.zeros((2, 1 << b), np.uint32) for b in sizes]
        self.weights = np.full((self.gates, 1 + len(sizes)), 1.2 / (1 + len(sizes)))
        self.refined = np.zeros((2, classes * STEPS))

    def learn(self, hashes: np.ndarray, first: np.ndarray) -> None:
        self.step(Contexts(hashes, first, self.table_bits), np.ones(len(hashes), np.int64))

    def read(self, spelling: Spelling) -> None:
        """Each pair of words as it comes first, then its repeats."""
        for where, pair in spelling.steps():
            self.step(where, np.ones(len(pair), np.int64))
        for where, pair in spelling.steps(np.flatnonzero(spelling.times > 1)):
            self.step(where, spelling.times[pair] - 1)

    def read_grams(self, grams: Grams) -> None:
        """All grams counted, then each predicted, as often as it stands there, from the counts of all but one time of it."""
        self.seen += len(grams.gram)
        for where, at in grams.steps():
            added = grams.times[at].astype(np.uint32)
            for j in range(self.code_bits):
                bit, node, slots = where.bit(j)
                for t, s in zip([self.root, *self.tables], [node, *slots]):
                    np.add.at(t.reshape(-1), bit * t.shape[1] + s, added)
        # In the order they come first the last steps would have rare grams only, and the weights would follow them.
        for where, at in grams.steps(1 + np.argsort(grams.keys[1:] * np.uint64(POWER))):
            self.weigh(where, grams.times[at])

    def weigh(self, where: Contexts, times: np.ndarray) -> None:
        """Weights and refinement moved by symbols that are in the counts already, each ``times`` times, as predicted without one of these."""
        cells = self.refined.shape[1]
        often = times.astype(np.float32)
        for j in range(self.code_bits):
            bit, node, slots = where.bit(j)
            one, none = bit.astype(np.uint32), (1 - bit).astype(np.uint32)
            counts = [(t[0].take(s) - none, t[1].take(s) - one) for t, s in zip([self.root, *self.tables], [node, *slots])]
            inputs = [stretch(a.astype(np.float32), b.astype(np.float32)) for a, b in counts]
            gate = confidence(counts[-2][0] + counts[-2][1]) * 3 + confidence(counts[-1][0] + counts[-1][1])
            own = self.weights[j * 9: j * 9 + 9]
            w = own.T.astype(np.float32)
            z = sum(w[k].take(gate) * x for k, x in enumerate(inputs))
            p = 1 / (1 + np.exp(-z))
            wrong = often * (one.astype(np.float32) - p)
            # A few symbols may stand for most of the text: no step is longer than the curvature allows.
            curve = often * (p * (1 - p) + LEAST) * sum(x * x for x in inputs) + FLAT * often
            sums = np.stack([curve, *[wrong * x for x in inputs]]) @ np.eye(9, dtype=np.float32)[gate]
            own += NEAR * (sums[1:] / np.maximum(sums[0], FLAT)).T
            self.refined += np.bincount(bit * cells + node * STEPS + step_of(z), times, 2 * cells).reshape(2, cells)

    def step(self, where: Contexts, times: np.ndarray) -> None:
        """Symbols predicted together, each ``times`` times, then learned."""
        self.seen += int(times.sum())
        added = times.astype(np.uint32)
        cells = self.refined.shape[1]
        for j in range(self.code_bits):
            bit, node, slots = where.bit(j)
            places = list(zip([self.root, *self.tables], [node, *slots]))
            counts = [(t[0].take(s), t[1].take(s)) for t, s in places]
            inputs = [stretch(c[0].astype(np.float32), c[1].astype(np.float32)) for c in counts]
            gate = j * 9 + confidence(counts[-2][0] + counts[-2][1]) * 3 + confidence(counts[-1][0] + counts[-1][1])
            w = self.weights.T.copy()
            z = sum(w[k].take(gate) * x for k, x in enumerate(inputs))
            wrong = times * (bit - 1 / (1 + np.exp(-z)))
            n = np.maximum(np.bincount(gate, times, self.gates), 1)
            for k, x in enumerate(inputs):
                self.weights[:, k] += self.rate * np.bincount(gate, wrong * x, self.gates) / n
            self.refined += np.bincount(bit * cells + node * STEPS + step_of(z), times, 2 * cells).reshape(2, cells)
            for t, s in places:
                np.add.at(t.reshape(-1), bit * t.shape[1] + s, added)

    def rows(self) -> Iterator[tuple[int, bytes]]:
        """(row number, numbers) of the model's state; numbers of one row number are added up over tasks."""
        yield -1, packed(np.append(self.weights.ravel() * self.seen, self.seen), "<f8")
        yield -2, packed(self.refined, "<f8")
        yield -3, packed(self.root, "<f8")
        for k, t in enumerate(self.tables):
            for c in range(0, t.shape[1], SLOTS_PER_ROW):
                part = t[:, c: c + SLOTS_PER_ROW]
                if part.any():
                    yield k << 32 | c, packed(part, "<f4")


class Model:
    """The frozen model: predictions are looked up."""

    def __init__(self, state: dict[int, bytes], table_bits: int, code_bits: int = CODE_BITS, sizes: list[int] | None = None):
        self.table_bits, self.code_bits = table_bits, code_bits
        sizes = sizes or [table_bits] * HASHED
        inputs = 1 + len(sizes)
        gates, classes = code_bits * 9, 1 << code_bits
        w = unpacked(state[-1], "<f8") if state else np.zeros(gates * inputs + 1)
        self.weights = (w[:-1] / max(w[-1], 1.0)).reshape(gates, inputs).astype(np.float32)
        if not w[-1]:
            self.weights[:] = 1.2 / inputs
        refined = (unpacked(state[-2], "<f8") if state else np.zeros(2 * classes * STEPS)).reshape(2, -1)
        middle = 1 / (1 + np.exp(-(np.arange(STEPS) - STEPS // 2) / 2.0))
        prior = np.tile(middle, classes)
        # of a 0 and of a 1, each by itself: what is left of a probability near one would be lost in 32 bits
        self.refined = ((refined + 8 * np.stack([1 - prior, prior])) / (refined.sum(axis=0) + 8)).astype(np.float32).ravel()
        root = (unpacked(state[-3], "<f8") if state else np.zeros(2 * classes)).reshape(2, -1).astype(np.float32)
        self.root = stretch(*root)
        self.tables, self.trust = [], []
        for k, bits in enumerate(sizes):
            t = np.zeros((2, 1 << bits), np.float32)
            for row, numbers in state.items():
                if row >= 0 and row >> 32 == k:
                    part = unpacked(numbers, "<f4").reshape(2, -1)
                    c = row & 0xFFFFFFFF
                    t[:, c: c + part.shape[1]] = part
            self.tables.append(stretch(*t))
            if k >= len(sizes) - 2:
                self.trust.append(confidence(t.sum(axis=0)).astype(np.uint8))

    def log10(self, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """log10 of the probability of each symbol."""
        return self.judge(Contexts(hashes, first, self.table_bits))

    def texts(self, spelling: Spelling | Grams) -> np.ndarray:
        """log10 of the probability of each text."""
        each = np.zeros(len(spelling))
        for where, at in spelling.steps():
            np.add.at(each, at, self.judge(where))
        return spelling.sums(each)

    def judge(self, where: Contexts) -> np.ndarray:
        out, columns, cells = np.ones(len(where.code)), self.weights.T.copy(), len(self.refined) // 2
        for j in range(self.code_bits):
            bit, node, slots = where.bit(j)
            gate = j * 9 + self.trust[0][slots[-2]].astype(np.int64) * 3 + self.trust[1][slots[-1]]
            z = sum(w.take(gate) * t.take(s) for w, t, s in zip(columns, [self.root, *self.tables], [node, *slots]))
            out *= (1 / (1 + np.exp(np.where(bit == 1, -z, z))) + self.refined.take(bit * cells + node * STEPS + step_of(z))) / 2
        return np.log10(out)


def _chunks(texts: list[str | None], ids: Callable[[], _Ids]) -> Iterator[tuple[list[np.ndarray], range]]:
    """Numbers of the words of texts, some texts at a time."""
    held: list[np.ndarray] = []
    begin = n = 0
    for i, t in enumerate(texts):
        held.append(ids().of(t))
        n += len(held[-1])
        if n >= CHUNK:
            yield held, range(begin, i + 1)
            held, begin, n = [], i + 1, 0
    if held:
        yield held, range(begin, len(texts))


def _spelled_chunks(texts: list[str | None]) -> Iterator[tuple[list[bytes], range]]:
    """Bytes of texts, some texts at a time."""
    held: list[bytes] = []
    begin = n = 0
    for i, t in enumerate(texts):
        held.append(spelled(t))
        n += len(held[-1])
        if n >= CHUNK_BYTES:
            yield held, range(begin, i + 1)
            held, begin, n = [], i + 1, 0
    if held:
        yield held, range(begin, len(texts))


def _joined(docs: list[np.ndarray], hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.zeros(sum(map(len, docs)), bool)
    first[np.cumsum([0, *map(len, docs[:-1])])] = True
    return hashes[np.concatenate(docs)], first


def gather(docs: DataFrame, key: str, text: str, train: str, table_bits: int, unit: str) -> DataFrame:
    """What scoring needs of the corpus: per document its length, per block of documents where each word
    stands, per task the state of its learner."""
    kind = docs.schema[key].dataType.simpleString()
    schema = (f"kind int, block bigint, `{key}` {kind}, h bigint, idx int, n_tokens bigint, word bigint, "
              "places array<int>, trained bigint, row bigint, numbers binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        learner, number, pairs = Learner(table_bits, code_bits=UNITS[unit], sizes=sizes_of(unit, table_bits)), 0, 0
        unread, size = [], 0
        task = TaskContext.get().partitionId()
        ids, key_type = _Ids(), None
        words, docs_at, counts, is_train = [], [], [], []

        def frame(n: int, **columns) -> pa.RecordBatch:
            types = {"kind": pa.int32(), "block": pa.int64(), key: key_type or pa.int64(), "h": pa.int64(), "idx": pa.int32(),
                     "n_tokens": pa.int64(), "word": pa.int64(), "places": pa.list_(pa.int32()), "trained": pa.int64(),
                     "row": pa.int64(), "numbers": pa.binary()}
            return pa.RecordBatch.from_arrays(
                [columns[c] if isinstance(columns.get(c), pa.Array) else pa.array(columns[c], t) if c in columns else pa.nulls(n, t)
                 for c, t in types.items()], list(types))

        def flush() -> Iterator[pa.RecordBatch]:
            """Where each word of the block stands: one row per word, with document and count."""
            w, d, c = np.concatenate(words), np.concatenate(docs_at), np.concatenate(counts)
            order = np.argsort(w, kind="stable")
            w, d, c = w[order], d[order], c[order]
            if c.max() > MOST:  # a count too large for its bits is split
                times = -(-c // MOST)
                nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                w, d, c = np.repeat(w, times), np.repeat(d, times), np.minimum(np.repeat(c, times) - nth * MOST, MOST)
            starts = np.flatnonzero(np.append(True, w[1:] != w[:-1]))
            trained = np.add.reduceat(np.where(np.array(is_train)[d], c, 0), starts)
            h = ids.hashes()[w[starts]].view(np.int64)
            ends = np.append(starts[1:], len(w))
            for a in range(0, len(starts), 20_000):
                b = min(a + 20_000, len(starts))
                lo, hi = starts[a], ends[b - 1]
                offsets = pa.array(np.append(starts[a:b], hi) - lo, pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array((d[lo:hi] << COUNT_BITS | c[lo:hi]).astype(np.int32)))
                n = b - a
                yield frame(n, kind=np.ones(n, np.int32), block=np.full(n, task << 24 | number), word=h[a:b], places=lists, trained=trained[a:b])

        for batch in batches:
            key_type = batch.column(0).type
            train_now = batch.column(3).to_pylist()
            lengths, at = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int32)
            blocks = np.zeros(batch.num_rows, np.int64)
            texts = batch.column(1).to_pylist()
            if unit == "grams":
                for t in (spelled(t) for t, now in zip(texts, train_now) if now):
                    unread.append(t)
                    size += len(t)
                    if size >= CHUNK_BYTES:
                        learner.read_grams(Grams(unread, table_bits))
                        unread, size = [], 0
                        give_back()
            for chunk, rows in _chunks(texts, lambda: ids):
                learned = [d for d, i in zip(chunk, rows) if train_now[i] and unit != "grams"]
                if learned and unit == "bytes":
                    learner.read(Spelling(learned, ids, table_bits))
                elif learned:
                    learner.learn(*_joined(learned, ids.hashes()))
                for d, i in zip(chunk, rows):
                    w, c = np.unique(d, return_counts=True)
                    words.append(w)
                    counts.append(c)
                    docs_at.append(np.full(len(w), len(is_train)))
                    lengths[i], at[i], blocks[i] = len(d), len(is_train), task << 24 | number
                    is_train.append(bool(train_now[i]))
                pairs += sum(len(w) for w in words[-len(chunk):])
                if len(is_train) >= BLOCK_DOCS or pairs >= BLOCK_PAIRS:
                    yield from flush()
                    number, pairs = number + 1, 0
                    ids, words, docs_at, counts, is_train = _Ids(), [], [], [], []
            n = batch.num_rows
            yield frame(n, kind=np.zeros(n, np.int32), block=blocks, **{key: batch.column(0)}, h=batch.column(2), idx=at, n_tokens=lengths)
        if is_train:
            yield from flush()
        ids, words, docs_at, counts = _Ids(), [], [], []
        if unread:
            learner.read_grams(Grams(unread, table_bits))
        state = list(learner.rows()) if learner.seen else []
        if state:
            n = len(state)
            yield frame(n, kind=np.full(n, 2, np.int32), block=np.full(n, task), row=[r for r, _ in state], numbers=[b for _, b in state])

    rows = docs.select(key, text, F.xxhash64(text).alias("h"), F.coalesce(F.col(train), F.lit(False)).alias("train"))
    return map_batches(rows, run, schema)


def _summed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Numbers of equal keys added up, row by row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None

        def out() -> pa.RecordBatch:
            kind = "<f8" if now[-1] < 0 else "<f4"
            return pa.RecordBatch.from_pydict({**{k: [v] for k, v in zip(keys, now)}, "numbers": [packed(total, kind)]})

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for *k, numbers in zip(*columns):
                part = unpacked(numbers, "<f8" if k[-1] < 0 else "<f4").astype(np.float64)
                if k == now:
                    total += part
                else:
                    if now is not None:
                        yield out()
                    now, total = k, part
        if now is not None:
            yield out()

    cols = [*keys, "numbers"]
    schema = ", ".join(f"{k} bigint" for k in keys) + ", numbers binary"
    return map_batches(rows.select(*cols).repartition(*keys).sortWithinPartitions(*keys), run, schema)


def score(docs: DataFrame, train: str, key: str = "doc_id", text: str = "text", table_bits: int = 18,
          unit: str = "words") -> DataFrame:
    """``key``, ``h`` (xxhash64 of the text), ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` and
    ``bits_per_byte`` of each row of ``docs``; ``train`` is a boolean column that tells which rows to learn from.
    ``unit``: whether the bits of the text's bytes (``"grams"`` or ``"bytes"``, by their contexts) or of codes of its words are predicted."""
    held = stored(gather(docs, key, text, train, table_bits, unit), "gathered", "zstd")
    tokens = held.where("kind = 1").select("block", "word", "places", "trained")
    vocabulary = stored(tokens.where("trained > 0").groupBy("word").agg(
        F.sum("trained").alias("c"), F.sum(F.size("places")).alias("n")), "vocabulary")
    per_class = vocabulary.groupBy(F.col("word").bitwiseAND(F.lit(CLASSES - 1)).alias("k")).agg(
        F.sum("c"), F.count("*"), F.sum("n")).collect()  # one row per class
    counted, distinct, all_places = (sum(r[i] for r in per_class) for i in (1, 2, 3))
    share = np.zeros(CLASSES)
    for r in per_class:
        share[r[0]] = r[1] + r[2]
    share = np.log10(share + 1)
    states = held.where("kind = 2").select("row", F.pmod("block", F.lit(SALTS)).alias("salt"), "numbers")
    merged = _summed(_summed(states, ["salt", "row"]), ["row"])
    model = Model({r["row"]: bytes(r["numbers"]) for r in merged.collect()}, table_bits, UNITS[unit], sizes_of(unit, table_bits))  # the model's fixed size

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _Ids()
        for batch in batches:
            out, size = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            texts = batch.column(1).to_pylist()
            if unit == "grams":
                for chunk, rows in _spelled_chunks(texts):
                    out[rows.start: rows.stop] = model.texts(Grams(chunk, table_bits))
            for chunk, rows in _chunks(texts, lambda: ids) if unit != "grams" else ():
                if unit == "bytes":
                    out[rows.start: rows.stop] = model.texts(Spelling(chunk, ids, table_bits))
                else:
                    hashes, first = _joined(chunk, ids.hashes())
                    each = model.log10(hashes, first) - share[(hashes & np.uint64(CLASSES - 1)).astype(np.int64)]
                    out[rows.start: rows.stop] = np.add.reduceat(each, np.flatnonzero(first))
                if len(ids) > 500_000:
                    ids = _Ids()
            for i, t in enumerate(texts):
                size[i] = len(t.encode("utf-8", "surrogatepass")) if t else 0
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(out), pa.array(size)], ["key2", "h2", "model", "bytes"])

    kind = docs.schema[key].dataType.simpleString()
    judged = stored(map_batches(docs.select(key, text, F.xxhash64(text).alias("h")), judge,
                                f"key2 {kind}, h2 bigint, model double, bytes bigint"), "judged").dropDuplicates(["key2", "h2"])

    def per_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            places = batch.column(1)
            sizes = np.diff(places.offsets.to_numpy())
            flat = places.flatten().to_numpy()
            block = np.repeat(batch.column(0).to_numpy(), sizes)
            c = np.repeat(batch.column(2).to_numpy(), sizes)
            doc, n = flat >> COUNT_BITS, flat & MOST
            for b in np.unique(block):
                here = block == b
                rows = int(doc[here].max()) + 1
                add = np.stack([np.bincount(doc[here], n[here] * np.log10(c[here] + 1.0), rows),
                                np.bincount(doc[here], np.where(c[here] > 0, n[here], 0), rows)])
                old = logs.get(b)
                if old is None:
                    logs[b] = add
                else:
                    if old.shape[1] < rows:
                        old = np.pad(old, ((0, 0), (0, rows - old.shape[1])))
                    old[:, :rows] += add
                    logs[b] = old
        for b, (log, known) in logs.items():
            yield pa.RecordBatch.from_pydict({"block": np.full(len(log), b), "idx": np.arange(len(log), dtype=np.int32),
                                              "log": log, "n_known": np.rint(known).astype(np.int64)})

    # No more than FREQUENT words can each have that share of all places. They hold most of the places, which then
    # stay where they are, and no other word can make a large task.
    is_frequent = F.col("n") > all_places // FREQUENT
    frequent = F.broadcast(vocabulary.where(is_frequent).select("word", "c"))
    where = tokens.select("block", "word", "places")
    counted_words = where.join(frequent, "word").unionByName(
        where.join(frequent, "word", "left_anti").join(vocabulary.where(~is_frequent).select("word", "c"), "word", "left")
    ).select("block", "places", F.coalesce("c", F.lit(0)).alias("c"))
    sums = map_batches(counted_words.repartition("block"), per_document, "block bigint, idx int, log double, n_known bigint")
    rows = held.where("kind = 0").select("block", "idx", key, "h", "n_tokens").join(sums, ["block", "idx"])
    joined = rows.join(judged, F.col(key).eqNullSafe(F.col("key2")) & F.col("h").eqNullSafe(F.col("h2")))
    total = math.log10(counted + distinct + 1)
    scored = joined.select(
        key, "h", "n_tokens", "n_known", F.lit(counted).cast("bigint").alias("train_tokens"),
        (F.col("log") - F.col("n_tokens") * F.lit(total)).alias("base_score"), (F.col("model") + F.col("log") if unit == "words" else F.col("model")).alias("score"), "bytes")
    return scored.withColumn("bits_per_byte", -F.col("score") * math.log2(10) / F.greatest("bytes", F.lit(1))).drop("bytes")

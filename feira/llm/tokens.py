"""Token ids of whole texts with a public tokenizer file, computed once per distinct word.

The tokenizer drops white space and never joins what stands on both sides of it, nor an ASCII letter with an ASCII
mark next to it (an apostrophe apart), so a text's ids are the ids of such units in order. A batch of texts is cut
into units with numpy, units are told apart by a 64-bit hash, and only units that the task's process has not met yet
go through the tokenizer. A text that may hold one of the tokenizer's added tokens is encoded whole.
"""

from __future__ import annotations

import os
import re

import numpy as np

_SPACE, _LETTER, _MARK, _OTHER = 0, 1, 2, 3


def _kinds() -> np.ndarray:
    kinds = np.full(256, _OTHER, np.uint8)
    kinds[[9, 10, 13, 32]] = _SPACE
    for first, last in ((65, 90), (97, 122)):
        kinds[first : last + 1] = _LETTER
    for mark in "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~":
        kinds[ord(mark)] = _MARK
    return kinds


KINDS = _kinds()
_rng = np.random.default_rng(20_240_501)
_MIX = _rng.integers(1, 2**63, 256, dtype=np.uint64)
# Upper and lower case of an ASCII letter are one unit, as the tokenizer lower-cases.
_MIX[65:91] = _MIX[97:123]
_MIX[KINDS == _SPACE] = 0
# ASCII letters and precomposed lower-case letters of Western European languages.
_PLAIN = re.compile("[A-Za-z\u00df-\u00f6\u00f8-\u00ff]+").fullmatch
_POWERS = np.cumprod(np.full(1 << 12, 0x9E3779B97F4A7C15, np.uint64))


class WordTokenizer:
    """Encodes batches of texts. ``limit`` bounds the number of remembered units; beyond it the memory starts anew."""

    def __init__(self, path: str, limit: int = 1_500_000):
        # A task has one core; the library would start a thread for each core of the machine.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.plain = self._plain_words()
        self.limit = limit
        self._forget()

    def _plain_words(self):
        """The tokenizer without its normaliser and splitter, which leave lower-case Latin words as they are."""
        from tokenizers import Tokenizer, pre_tokenizers

        plain = Tokenizer.from_str(self.tokenizer.to_str())
        plain.normalizer = None
        plain.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        return plain

    def _ids(self, units: list[str]) -> list[list[int]]:
        matched = [_PLAIN(unit) is not None for unit in units]
        plain = [i for i, m in enumerate(matched) if m]
        rest = [i for i, m in enumerate(matched) if not m]
        out: list[list[int]] = [[]] * len(units)
        for encode, where, words in (
            (self.plain.encode_batch_fast, plain, [units[i].lower() for i in plain]),
            (self.tokenizer.encode_batch_fast, rest, [units[i] for i in rest]),
        ):
            for i, found in zip(where, encode(words, add_special_tokens=False), strict=True):
                out[i] = found.ids
        return out

    def _forget(self) -> None:
        self.tables: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.pool = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def _learn(self, hashes: np.ndarray, units: list[str]) -> None:
        ids = self._ids(units)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((i for x in ids for i in x), np.uint32, int(sizes.sum()))
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used : self.used + len(flat)] = flat
        starts = self.used + np.cumsum(sizes) - sizes
        self.used += len(flat)
        self.tables.append((hashes, starts, sizes))
        # Sorted tables of falling size: a table is merged into the one before it when it is half as large.
        while len(self.tables) > 1 and 2 * len(self.tables[-1][0]) >= len(self.tables[-2][0]):
            joined = [np.concatenate(x) for x in zip(self.tables.pop(-2), self.tables.pop(), strict=True)]
            order = np.argsort(joined[0], kind="stable")
            self.tables.append(tuple(x[order] for x in joined))

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and size of each unit's ids, and which units are known."""
        starts, sizes = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        known = np.zeros(len(hashes), bool)
        for table, begin, size in self.tables:
            at = np.minimum(np.searchsorted(table, hashes), len(table) - 1)
            hit = table[at] == hashes
            starts[hit], sizes[hit] = begin[at[hit]], size[at[hit]]
            known |= hit
        return starts, sizes, known

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids (uint32) of each text, without special tokens."""
        whole = [i for i, t in enumerate(texts) if any(a in t for a in self.added)]
        for_units = [t.encode() for t in texts]
        for i in whole:
            for_units[i] = b""
        out = self._encode_units(for_units)
        for i in whole:
            out[i] = np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, np.uint32)
        return out

    def _encode_units(self, texts: list[bytes]) -> list[np.ndarray]:
        data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        kind = KINDS[data]
        first = np.empty(len(data), bool)
        first[0] = True
        before, here = kind[:-1], kind[1:]
        # A unit starts behind white space and where letter and mark meet.
        first[1:] = (before != here) & ((before == _SPACE) | (here == _SPACE) | (before + here == _LETTER + _MARK))
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], len(data))
        filled = kind[starts] != _SPACE
        lengths = (ends - starts)[filled]
        starts = starts[filled]
        if not len(starts):
            return [np.zeros(0, np.uint32) for _ in texts]
        hashes = self._hashes(data, kind, starts, lengths)
        distinct, at, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if sum(len(x[0]) for x in self.tables) > self.limit:
            self._forget()
        begin, size, known = self._find(distinct)
        if not known.all():
            raw = data.tobytes()
            new = np.flatnonzero(~known)
            where = zip(starts[at[new]].tolist(), lengths[at[new]].tolist(), strict=True)
            self._learn(distinct[new], [raw[s : s + n].decode() for s, n in where])
            begin[new], size[new], _ = self._find(distinct[new])
        begin, size = begin[inverse], size[inverse]
        total = np.cumsum(size)
        ids = self.pool[np.arange(total[-1]) + np.repeat(begin - (total - size), size)]
        text_ends = np.cumsum([len(t) + 1 for t in texts])
        units = np.searchsorted(starts, text_ends)
        cuts = np.concatenate([[0], total])[units]
        return np.split(ids, cuts[:-1])

    @staticmethod
    def _hashes(data: np.ndarray, kind: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        # White space counts as zero, so a sum may run from one unit's start to the next.
        runs = np.diff(np.concatenate([[0], starts, [len(data)]]))
        place = np.arange(len(data), dtype=np.int32) - np.repeat(np.append(0, starts).astype(np.int32), runs)
        mixed = _MIX[data] * _POWERS[place & (len(_POWERS) - 1)]
        if int(lengths.max()) > len(_POWERS):
            mixed ^= (place >> 12).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) * (kind != _SPACE)
        hashes = np.add.reduceat(mixed, starts)
        return (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


_encoders: dict[str, WordTokenizer] = {}


def encoder(path: str) -> WordTokenizer:
    """The process's encoder of a tokenizer file; a worker process serves many tasks with it."""
    if path not in _encoders:
        _encoders[path] = WordTokenizer(path)
    return _encoders[path]

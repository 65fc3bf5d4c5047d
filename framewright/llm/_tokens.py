"""Token ids of whole texts with a tokenizer file of the tokenizers library.

Where the tokenizer drops ASCII white space and never looks across it, a text's
ids are its words' ids in a row, and each distinct word goes to the library
once.  Words are looked up by hash in numpy arrays, without a Python step for
each.  Where it also ignores the case of A-Z, sets a full stop or comma after
letters apart, and marks word ends with ``</w>``, runs of letters share an
entry whatever their case and trailing mark, and many go to the library in one
text.  Both properties are tried on probe texts when a file is loaded; a file
without them gets whole texts, or whole words.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from framewright.llm._text import LOWER, Words, mix, string_parts, spans_of, words_of

WORD_LIMIT = 1 << 20  # remembered words per Python worker: some 60 MB of arrays
_LOADED: dict[str, "WordEncoder"] = {}
_U = np.uint64

PROBES = ("Aé Zürich, the.\n\tword,word  x1 3.5. don't it's, ÀÉ. ÇA ß, \x0b\x0c\r…", "a.b c,, d.. e., 'f' (g) h-i", "ﬁ, Åb. ｘ. 中文, ª.")


def word_encoder(path: str) -> "WordEncoder":
    if path not in _LOADED:
        _LOADED[path] = WordEncoder(path)
    return _LOADED[path]


def release() -> None:
    """Forget all encoders of this process."""
    _LOADED.clear()


class HashIndex:
    """Slots of 64-bit hashes by linear probing, many at once."""

    def __init__(self, bits: int = 14):
        self.bits, self.n = bits, 0
        self.keys = np.zeros(1 << bits, _U)
        self.slots = np.full(1 << bits, -1, np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of each hash, or -1."""
        mask = (1 << self.bits) - 1
        at = (hashes & _U(mask)).astype(np.int64)
        out = self.slots[at]
        left = np.flatnonzero((self.keys[at] != hashes) & (out >= 0))
        at = at[left]
        while len(left):
            at = (at + 1) & mask
            got = self.slots[at]
            out[left] = got
            more = (self.keys[at] != hashes[left]) & (got >= 0)
            left, at = left[more], at[more]
        return out

    def add(self, hashes: np.ndarray, slots: np.ndarray) -> None:
        """Distinct hashes that aren't there yet."""
        while (self.n + len(hashes)) * 2 > 1 << self.bits:
            used = self.slots >= 0
            old = self.keys[used], self.slots[used]
            self.__init__(self.bits + 1)
            self.add(*old)
        self.n += len(hashes)
        mask = (1 << self.bits) - 1
        at = (hashes & _U(mask)).astype(np.int64)
        while len(at):
            free = np.flatnonzero(self.slots[at] < 0)
            _, one = np.unique(at[free], return_index=True)
            put = free[one]
            self.keys[at[put]] = hashes[put]
            self.slots[at[put]] = slots[put]
            rest = np.ones(len(at), bool)
            rest[put] = False
            at, hashes, slots = (at[rest] + 1) & mask, hashes[rest], slots[rest]


class WordEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.closes = np.zeros(size, bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.closes[i] = token.endswith("</w>")
        self.by_word = all(np.array_equal(self._whole([p])[0], self._joined(p.encode().split())) for p in PROBES)
        self.by_letters = self.by_word and bool(self.closes.any()) and all(self._letters_apart(p) for p in PROBES)
        self.marks = np.full(256, -1, np.int32)
        if self.by_letters:
            self.marks[list(b".,")] = [int(x[0]) for x in self._whole([".", ","])]
        self._forget()

    def _joined(self, words: list[bytes]) -> np.ndarray:
        return np.concatenate(self._whole([w.decode() for w in words]) or [np.zeros(0, self.dtype)])

    def _letters_apart(self, probe: str) -> bool:
        for word in probe.split():
            base, mark = (word[:-1], word[-1]) if word[-1] in ".," else (word, "")
            raw = base.encode().lower()  # A-Z alone
            if _plain(np.frombuffer(raw, np.uint8), np.array([0]), np.array([len(raw)]))[0]:
                parts = self._whole([raw.decode()] + [mark] * bool(mark))
                if not np.array_equal(np.concatenate(parts), self._whole([word])[0]) or self.closes[parts[0]].sum() != 1 or not self.closes[parts[0][-1]]:
                    return False
                if mark and len(parts[1]) != 1:
                    return False
        return True

    def _forget(self) -> None:
        self.index = HashIndex()
        self.ids = np.zeros(1 << 16, self.dtype)
        self.at = np.zeros(1 << 12, np.int64)
        self.size = np.zeros(1 << 12, np.int32)
        self.count = self.used = 0

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, self.dtype) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _remember(self, hashes: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        n, m = self.count + len(hashes), self.used + len(ids)
        while n > len(self.at):
            self.at, self.size = np.resize(self.at, 2 * len(self.at)), np.resize(self.size, 2 * len(self.size))
        while m > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.ids[self.used : m] = ids
        self.size[self.count : n] = sizes
        self.at[self.count : n] = self.used + np.cumsum(sizes) - sizes
        self.index.add(hashes, np.arange(self.count, n, dtype=np.int32))
        self.count, self.used = n, m

    def _learn(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray, plain: np.ndarray) -> None:
        """Words by their bytes; those that are ``plain`` are letters only."""
        some = np.flatnonzero(plain)
        for low in range(0, len(some), 20_000):
            part = some[low : low + 20_000]
            size = end[part] - start[part] + 1
            stop = np.cumsum(size)
            line = np.full(stop[-1], 32, np.uint8)
            line_at = np.arange(stop[-1]) - np.repeat(stop - size, size)
            inside = line_at < np.repeat(size - 1, size)
            line[inside] = LOWER[raw[(np.repeat(start[part], size) + line_at)[inside]]]
            cuts = stop[499::500].tolist()
            texts = [line[a:b].tobytes().decode() for a, b in zip([0, *cuts], [*cuts, int(stop[-1])], strict=True) if a < b]
            found = self._whole(texts)
            ids = np.concatenate(found)
            ends = np.flatnonzero(self.closes[ids]) + 1
            whole = len(ends) == len(part) and ends[-1] == len(ids)
            if whole:  # and each text has its own words' ends
                have = np.searchsorted(ends, np.cumsum([len(x) for x in found]), "right")
                whole = np.array_equal(have, np.minimum(np.arange(1, len(found) + 1) * 500, len(part)))
            if whole:
                sizes = np.diff(ends, prepend=0)
            else:
                words = [line[b - n : b - 1].tobytes().decode() for b, n in zip(stop.tolist(), size.tolist(), strict=True)]
                found = self._whole(words)
                ids, sizes = np.concatenate(found), np.array([len(x) for x in found])
            self._remember(hashes[part], sizes, ids)
        odd = np.flatnonzero(~plain)
        for low in range(0, len(odd), 1000):
            part = odd[low : low + 1000]
            found = self._whole([raw[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(start[part].tolist(), end[part].tolist(), strict=True)])
            self._remember(hashes[part], np.array([len(x) for x in found]), np.concatenate(found))

    def _slots(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Each word's slot, and the id of the mark set apart from it, or -1."""
        raw, start, end = words.data, words.start, words.end
        mark = np.full(len(start), -1, np.int32)
        plain = np.zeros(len(start), bool)
        hashes = mix(words.hash, words.hash)
        if self.by_letters:
            last = self.marks[raw[end - 1]]
            marked = (last >= 0) & (end - start > 1)
            base = end - marked
            plain = _plain(raw, start, base)
            mark[plain & marked] = last[plain & marked]
            end = np.where(plain, base, end)
            hashes[plain] = words.span_hash(start, end)[plain]
        if self.count > WORD_LIMIT:
            self._forget()
        slots = self.index.find(hashes)
        if (missing := np.flatnonzero(slots < 0)).size:
            new, first = np.unique(hashes[missing], return_index=True)
            first = missing[first]
            self._learn(raw, start[first], end[first], new, plain[first])
            slots[missing] = self.index.find(hashes[missing])
        return slots, mark

    def encode(self, texts: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, offsets, ids) for ranges of rows; the ids of row
        first + i are ids[offsets[i]:offsets[i + 1]]."""
        if not self.by_word:
            data, cuts = string_parts(texts)
            for low, high in spans_of(cuts):
                found = self._whole([data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(cuts[low:high].tolist(), cuts[low + 1 : high + 1].tolist(), strict=True)])
                yield low, np.cumsum([0, *map(len, found)]), np.concatenate(found)
            return
        for words in words_of(texts):
            if not len(words.start):
                yield words.low, np.zeros(words.high - words.low + 1, np.int64), np.zeros(0, self.dtype)
                continue
            slots, mark = self._slots(words)
            marked = mark >= 0
            size = self.size[slots].astype(np.int64)
            ends = np.zeros(len(size) + 1, np.int64)
            np.cumsum(size + marked, out=ends[1:])
            token = np.repeat(self.at[slots] - ends[:-1], size + marked)
            token += np.arange(ends[-1])
            ids = self.ids[np.minimum(token, self.used - 1)]
            ids[ends[1:][marked] - 1] = mark[marked]
            yield words.low, ends[words.first], ids


def _plain(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether each range holds letters only, of ASCII and Latin-1."""
    odd = ~_ASCII_LETTER[raw]
    lead = np.flatnonzero(raw[:-1] == 0xC3) if len(raw) else np.zeros(0, np.int64)
    lead = lead[_LATIN_TAIL[raw[lead + 1]]]
    odd[lead] = odd[lead + 1] = False
    total = np.zeros(len(raw) + 1, np.int32)
    np.cumsum(odd, out=total[1:])
    return (total[end] == total[start]) & (end > start)


_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True
_LATIN_TAIL = np.zeros(256, bool)
_LATIN_TAIL[[x for x in range(0x80, 0xC0) if x not in (0x97, 0xB7)]] = True

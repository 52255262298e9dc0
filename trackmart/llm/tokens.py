"""BPE token ids of whole texts.

The vocabulary's splitter never lets a token cross white space and it
lower-cases, so a text's ids are those of its white-space separated words one
after another. Words repeat, so each worker has a word encoded once by the
tokenizer and looks it up afterwards, all words of some megabytes of text
together: words are hashed to 64 bits and found in an open-addressing table
of arrays. The table is emptied when it has ``KNOWN_WORDS`` words, which costs
time only.
"""

from __future__ import annotations

import os
from collections.abc import Callable

import numpy as np

from trackmart.llm.common import chunks, words

WORD_BPE = "word_bpe_49k.json"
KNOWN_WORDS = 2_000_000
PUNCTUATION = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # ASCII, without the apostrophe of contractions
_MARK = b"<|"  # the vocabulary's special tokens start so and are looked for before lower-casing


def vocabulary(name: str = WORD_BPE) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _grown(x: np.ndarray, n: int) -> np.ndarray:
    while n > len(x):
        x = np.concatenate([x, np.zeros_like(x)])
    return x


def _hashes(single: list[bytes]) -> np.ndarray:
    data = np.frombuffer(b" ".join(single), np.uint8)
    return _filled(words(data, np.array([0, len(data)]))[3])


def _filled(hashes: np.ndarray) -> np.ndarray:
    return np.where(hashes == 0, np.uint64(1), hashes)  # 0 is an empty slot


class WordIds:
    """Ids of texts under a vocabulary file of the ``tokenizers`` library whose
    tokens never cross white space and that lower-cases."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self._clear()

    def _clear(self) -> None:
        self.known, self.used = 0, 0
        self.keys, self.slots = np.zeros(1 << 16, np.uint64), np.zeros(1 << 16, np.int32)
        self.flat, self.start, self.size = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int32)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Places of words, -1 for unknown ones."""
        mask = np.uint64(len(self.keys) - 1)
        at = (hashes & mask).astype(np.int64)
        there = self.keys[at]
        out = np.where(there == hashes, self.slots[at], -1)
        open_ = np.flatnonzero((there != hashes) & (there != 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self.keys) - 1)
            there = self.keys[at[open_]]
            hit = there == hashes[open_]
            out[open_[hit]] = self.slots[at[open_[hit]]]
            open_ = open_[~hit & (there != 0)]
        return out

    def _put(self, hashes: np.ndarray, places: np.ndarray) -> None:
        """Insert distinct hashes that the table has not."""
        at, rest = (hashes & np.uint64(len(self.keys) - 1)).astype(np.int64), np.arange(len(hashes))
        while len(rest):
            free = rest[self.keys[at[rest]] == 0]
            _, one = np.unique(at[free], return_index=True)  # of several for a slot, one
            won = free[one]
            self.keys[at[won]], self.slots[at[won]] = hashes[won], places[won]
            rest = rest[self.keys[at[rest]] != hashes[rest]]
            at[rest] = (at[rest] + 1) & (len(self.keys) - 1)

    def _add(self, hashes: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        first, n = self.known, self.known + len(hashes)
        self.flat = _grown(self.flat, self.used + len(ids))
        self.start, self.size = _grown(self.start, n), _grown(self.size, n)
        self.flat[self.used:self.used + len(ids)] = ids
        self.start[first:n], self.size[first:n] = self.used + np.cumsum(sizes) - sizes, sizes
        self.used, self.known = self.used + len(ids), n
        if 2 * n > len(self.keys):
            old = self.keys != 0
            keys, slots, wide = self.keys[old], self.slots[old], len(self.keys)
            while 2 * n > wide:
                wide *= 4
            self.keys, self.slots = np.zeros(wide, np.uint64), np.zeros(wide, np.int32)
            self._put(keys, slots)
        self._put(hashes, np.arange(first, n, dtype=np.int32))

    def _learn(self, fresh: list[bytes], hashes: np.ndarray) -> None:
        """Add words. Letters and the punctuation after them never share a
        token, so such a word is put together from its two parts."""
        joined, parts, whole = [], [], []
        for k, w in enumerate(fresh):
            core = w.rstrip(PUNCTUATION)
            if core != w and (core.isalpha() or core.decode().isalpha()):
                joined.append(k)
                parts += [core, w[len(core):]]
            else:
                whole.append(k)
        plain, plain_hashes = [fresh[k] for k in whole], hashes[whole]
        part_hashes = _hashes(parts) if parts else np.zeros(0, np.uint64)
        if parts:
            some, at = np.unique(part_hashes, return_index=True)
            missing = (self._find(some) < 0) & ~np.isin(some, plain_hashes)
            plain += [parts[k] for k in at[missing]]
            plain_hashes = np.concatenate([plain_hashes, some[missing]])
        if plain:
            code = self.tokenizer.encode([w.decode() for w in plain], is_pretokenized=True, add_special_tokens=False)
            self._add(plain_hashes, np.array(code.ids, np.uint32), np.bincount(np.array(code.word_ids, np.int64), minlength=len(plain)))
        if joined:
            ids, sizes = self._gather(self._find(part_hashes))
            self._add(hashes[joined], ids, sizes.reshape(-1, 2).sum(axis=1))

    def _gather(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words one after another, and how many each has."""
        sizes = self.size[places]
        ends = np.cumsum(sizes, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.start[places] - ends + sizes, sizes) + np.arange(total)], sizes

    def _places(self, part: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the words of some rows, and where each row's words begin."""
        if self.known > KNOWN_WORDS:
            self._clear()
        starts, ends, row, hashes = words(part, offsets)
        hashes = _filled(hashes)
        places = self._find(hashes)
        missed = np.flatnonzero(places < 0)
        if len(missed):
            new, at = np.unique(hashes[missed], return_index=True)
            first, data = missed[at], part.tobytes()
            self._learn([data[a:b].lower() for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)], new)
            places[missed] = self._find(hashes[missed])
        return places, np.searchsorted(row, np.arange(len(offsets)))

    def _marked(self, data: np.ndarray, offsets: np.ndarray) -> dict[int, np.ndarray]:
        """Ids of the rows with special tokens, straight from the tokenizer."""
        raw = data.tobytes()
        if _MARK not in raw:
            return {}
        texts = {k: raw[a:b] for k, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)) if raw.find(_MARK, a, b) >= 0}
        return {k: np.array(self.tokenizer.encode(t.decode(), add_special_tokens=False).ids, np.uint32) for k, t in texts.items()}

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Each row's ids, of rows laid end to end."""
        out = []
        for _, _, part, offs in chunks(data, offsets):
            places, cuts = self._places(part, offs)
            ids, sizes = self._gather(places)
            ends = np.append(0, np.cumsum(sizes, dtype=np.int64))[cuts]
            out += [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        for k, own in self._marked(data, offsets).items():
            out[k] = own
        return out

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many ids, and how many words, each row has."""
        tokens, n_words = [], []
        for _, _, part, offs in chunks(data, offsets):
            places, cuts = self._places(part, offs)
            tokens.append(np.diff(np.append(0, np.cumsum(self.size[places], dtype=np.int64))[cuts]))
            n_words.append(np.diff(cuts))
        total = np.concatenate(tokens) if tokens else np.zeros(0, np.int64)
        for k, own in self._marked(data, offsets).items():
            total[k] = len(own)
        return total, np.concatenate(n_words) if n_words else np.zeros(0, np.int64)


def encoder(path: str) -> Callable[[], WordIds]:
    """One encoder per worker and file, made when first needed."""
    def get() -> WordIds:
        if path not in _MADE:
            _MADE[path] = WordIds(path)
        return _MADE[path]
    return get


_MADE: dict[str, WordIds] = {}

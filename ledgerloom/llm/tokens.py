"""Token ids of whole texts, with the ids of words that were seen before kept by the worker.

The tokenizer splits a text at white space and between letters and signs before it merges anything, so the ids of a
text are those of its words. Most words of a corpus repeat: each task hashes its words in bulk and has the tokenizer
encode only new ones.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from .bytehash import LOWER_VALUES, range_hashes, row_of, text_bytes, word_ranges

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 13, 32]] = True
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True
#: ASCII signs that the tokenizer never joins to a letter. The apostrophe starts suffixes such as 's and is left out.
SIGN = np.zeros(256, bool)
SIGN[33:48] = SIGN[58:65] = SIGN[91:97] = SIGN[123:127] = True
SIGN[39] = False
#: Words kept by a worker before it starts over.
KEPT_WORDS = 2_000_000

_WORKERS: dict[str, "WordIds"] = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def shared(path: str) -> "WordIds":
    if path not in _WORKERS:
        _WORKERS[path] = WordIds(path)
    return _WORKERS[path]


class WordIds:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.kind = np.uint32 if self.tokenizer.get_vocab_size() > 1 << 16 else np.uint16
        self._clear()

    def _clear(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.slot = np.zeros(0, np.int64)
        self.first = np.zeros(1, np.int64)
        self.pool = np.zeros(0, self.kind)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words and how many each has. Words are joined by a special token, which ends them like a text."""
        if not self.special or any(s in b" ".join(words) for s in self.special):
            found = self.encode([w.decode() for w in words])
            return np.array([i for ids in found for i in ids], self.kind), np.fromiter(map(len, found), np.int64, len(found))
        mark, step = self.special[-1], 500
        joined = [(mark.join(words[i: i + step]) + mark).decode() for i in range(0, len(words), step)]
        ids = np.concatenate([np.array(e, self.kind) for e in self.encode(joined)])
        ends = np.flatnonzero(ids == self.tokenizer.token_to_id(mark.decode()))
        return np.delete(ids, ends), np.diff(ends, prepend=-1) - 1

    def _learn(self, keys: np.ndarray, words: list[bytes]) -> None:
        pool, lengths = self._encode_words(words)
        slot = np.arange(len(words)) + len(self.first) - 1
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(lengths)])
        self.pool = np.concatenate([self.pool, pool])
        at = np.searchsorted(self.known, keys)
        self.known, self.slot = np.insert(self.known, at, keys), np.insert(self.slot, at, slot)

    def of(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after the other, and the limits of the rows in them. The column has no nulls."""
        data, limits = text_bytes(column)
        cut = np.zeros(len(data), bool)
        if len(data):
            letter, sign = LETTER[data], SIGN[data]
            cut[1:] = (letter[:-1] & sign[1:]) | (sign[:-1] & letter[1:])
        starts, ends = word_ranges(data, limits, ~SPACE, cut)
        keys, back = np.unique(range_hashes(data, starts, ends, LOWER_VALUES), return_inverse=True)
        if len(self.known) > KEPT_WORDS:
            self._clear()
        at = np.searchsorted(self.known, keys)
        new = np.ones(len(keys), bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != keys[inside]
        if new.any():
            one = np.zeros(len(keys), np.int64)
            one[back] = np.arange(len(starts))
            raw = data.tobytes()
            self._learn(keys[new], [raw[i:j] for i, j in zip(starts[one[new]].tolist(), ends[one[new]].tolist())])
            at = np.searchsorted(self.known, keys)
        slot = self.slot[at][back] if len(keys) else np.zeros(0, np.int64)
        lengths = self.first[slot + 1] - self.first[slot]
        upto = np.concatenate([[0], np.cumsum(lengths)])
        shift = (self.first[slot] - upto[:-1]).astype(np.int32)  # a batch and the pool have fewer than 2**31 ids
        ids = self.pool[np.repeat(shift, lengths) + np.arange(upto[-1], dtype=np.int32)]
        bounds = upto[row_of(starts, limits)]
        return self._with_special(column, data, ids, bounds)

    def _with_special(self, column, data, ids, bounds):
        """Texts that hold a special token's own string are encoded whole."""
        raw = data.tobytes()
        if not any(s in raw for s in self.special):
            return ids, bounds
        parts = []
        for i, text in enumerate(column.to_pylist()):
            odd = any(s.decode() in text for s in self.special)
            parts.append(np.array(self.encode([text])[0], np.int64) if odd else ids[bounds[i]: bounds[i + 1]])
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

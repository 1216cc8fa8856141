"""Token ids of whole texts with a byte-level tokenizer, slice by slice.

Byte-level pre-tokenizers never join a word (with the space before it) to the next one, so a text is cut into pieces
(a word with that space, the ASCII signs after it, or a run of white space) and each different piece of a slice is encoded once. Texts that the cut
can't treat alike (white space beyond ASCII, some control characters, the tokenizer's special strings) are encoded whole.
"""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from panelwright.llm.common import per_worker
from panelwright.llm.words import PLAIN, hash_runs, slices

VOCABULARY = "byte_bpe_50k.json"
REMEMBERED = 600_000     # pieces a worker remembers before it starts over; bounds its memory, not its result
SLICE = 2 << 20
JOINED = 128             # new words that the library gets as one text

_SPACE = PLAIN == 0
_ODD = np.zeros(256, bool)
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_SIGN = np.zeros(256, bool)
_SIGN[33:127] = ~_ALNUM[33:127]
_ODD[[*range(0x1C, 0x20), 0xC2, 0xE1, 0xE2, 0xE3]] = True


def odd_places(raw: np.ndarray) -> np.ndarray:
    """Where a character may be white space to one library and not to another, or white space beyond ASCII."""
    at = np.flatnonzero(_ODD[raw])
    if not len(at):
        return at
    ext = np.append(raw, np.zeros(2, np.uint8))
    b0, b1, b2 = ext[at], ext[at + 1], ext[at + 2]
    return at[(b0 < 0x20) | (b0 == 0xC2) & ((b1 == 0x85) | (b1 == 0xA0)) | (b0 == 0xE1) & ((b1 == 0x9A) | (b1 == 0xA0)) & ((b2 == 0x80) | (b2 == 0x8E))
              | (b0 == 0xE2) & ((b1 == 0x80) | (b1 == 0x81)) & ((b2 <= 0x8A) | (b2 == 0xA8) | (b2 == 0xA9) | (b2 == 0xAF) | (b2 == 0x9F))
              | (b0 == 0xE3) & (b1 == 0x80) & (b2 == 0x80)]


def piece_starts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """First bytes of the pieces. Before a word, a run of white space gives up its last character: a space starts the
    word's piece, any other stands alone."""
    n = len(raw)
    space = np.append(_SPACE[raw], False)
    text = np.zeros(n + 1, bool)
    text[offsets] = True
    word = ~space[:-1]
    start = text[:-1].copy()
    begins = word & np.append(True, space[:-2] | text[1:-1])[:n] if n else word      # first byte of a word
    at = np.flatnonzero(begins & ~text[:-1])                                         # with white space before it
    start[at - 1] = True
    start[at[raw[at - 1] != 0x20]] = True
    gap = space[:-1].copy()
    gap[1:] &= ~space[:-2] | text[1:-1]                                              # first byte of white space
    start |= gap
    start[1:] |= _ALNUM[raw[:-1]] & _SIGN[raw[1:]]                                   # signs never share a token with what precedes
    return np.flatnonzero(start)


class PieceCache:
    """Ids of the pieces met so far, found by the hash of their bytes and length."""

    def __init__(self):
        self.reset()

    def reset(self) -> None:
        self.key, self.size, self.begin = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0

    def find(self, key: np.ndarray, encode_new) -> np.ndarray:
        """Places in the cache of sorted, distinct keys. ``encode_new(i)`` gives (ids, sizes) of the pieces of key[i]."""
        if len(self.key) > REMEMBERED:
            self.reset()
        at = np.searchsorted(self.key, key)
        new = np.ones(len(key), bool)
        inside = at < len(self.key)
        new[inside] = self.key[at[inside]] != key[inside]
        fresh = np.flatnonzero(new)
        if len(fresh):
            ids, size = encode_new(fresh)
            if self.used + len(ids) > len(self.flat):
                self.flat = np.resize(self.flat, max(2 * len(self.flat), self.used + len(ids)))
            self.flat[self.used:self.used + len(ids)] = ids
            self.key = np.insert(self.key, at[fresh], key[fresh])
            self.size = np.insert(self.size, at[fresh], size)
            self.begin = np.insert(self.begin, at[fresh], self.used + np.cumsum(size) - size)
            self.used += len(ids)
            at = np.searchsorted(self.key, key)
        return at


class TextEncoder:
    """``encode_pieces`` turns a list of new pieces into (ids, number of ids of each), ``encode_whole`` a text the cut doesn't suit."""

    def __init__(self, encode_pieces, encode_whole, special: tuple[str, ...] = ()):
        self.cache, self.encode_pieces = PieceCache(), encode_pieces
        self.encode_whole, self.special = encode_whole, [s.encode() for s in special]

    def _slice(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        start = piece_starts(raw, offsets)
        end = np.append(start[1:], len(raw))
        key, first, inverse = np.unique(hash_runs(raw, start, end), return_index=True, return_inverse=True)
        data = raw.tobytes()

        def new(i: np.ndarray):
            at = first[i]
            return self.encode_pieces([data[a:b] for a, b in zip(start[at].tolist(), end[at].tolist(), strict=True)])

        at = self.cache.find(key, new)[inverse]
        size = self.cache.size[at]
        to = np.cumsum(size)
        total = int(to[-1]) if len(to) else 0
        ids = self.cache.flat[np.repeat(self.cache.begin[at] - to + size, size) + np.arange(total)]
        edge = np.append(0, to)[np.searchsorted(start, offsets)]
        whole = set((np.searchsorted(offsets, odd_places(raw), "right") - 1).tolist())
        for s in self.special:
            spot = data.find(s)
            while spot >= 0:
                whole.add(int(np.searchsorted(offsets, spot, "right")) - 1)
                spot = data.find(s, spot + 1)
        if not whole:
            return ids, np.diff(edge)
        parts = [self.encode_whole(data[offsets[k]:offsets[k + 1]]) if k in whole else ids[edge[k]:edge[k + 1]]
                 for k in range(len(offsets) - 1)]
        return np.concatenate(parts), np.array([len(p) for p in parts])

    def __call__(self, column: pa.Array):
        """(first row, end row, ids, number of ids of each row) per slice of a text column; null is the empty text."""
        for a, e, raw, offsets in slices(column, SLICE):
            yield a, e, *self._slice(raw, offsets)


class LibraryEncoder(TextEncoder):
    """Encodes with the tokenizers library and a vocabulary file of it."""

    def __init__(self, path: str | None = None):
        self.tokenizer = Tokenizer.from_file(path or public_tokenizers.path(VOCABULARY))
        vocabulary = self.tokenizer.get_vocab()
        self.width = np.zeros(max(vocabulary.values()) + 1, np.int64)      # byte-level: a character of the entry is a byte
        for token, i in vocabulary.items():
            self.width[i] = len(token)
        special = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        super().__init__(self._pieces, lambda text: np.array(self._encode(text.decode()), np.uint32), special)

    def _encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Words go joined: each starts with its own space, so the library parts them again; the ids' byte lengths tell whose
        an id is. Pieces cut inside a character (only in texts that go whole anyway) get no ids."""
        word = np.array([len(p) > 1 and p[0] == 32 and p[1] not in b" \t\n\x0b\x0c\r" for p in pieces], bool)
        order = np.concatenate([np.flatnonzero(word), np.flatnonzero(~word)])
        words = int(word.sum())
        texts = [b"".join([pieces[i] for i in order[k:min(k + JOINED, words)]]).decode(errors="replace") for k in range(0, words, JOINED)]
        texts += [pieces[i].decode(errors="replace") for i in order[words:]]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([np.array(x.ids, np.uint32) for x in found])
        edge = np.append(0, np.cumsum(self.width[ids]))
        length = np.fromiter((len(pieces[i]) for i in order), np.int64, len(order))
        cut = np.searchsorted(edge, np.append(0, np.cumsum(length)))
        size = np.diff(cut)
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        out = size[back]
        to = np.cumsum(out)
        return ids[np.repeat(cut[:-1][back] - to + out, out) + np.arange(len(ids))], out


def encoder() -> LibraryEncoder:
    """One encoder per Python worker, so what it remembers serves all of the worker's tasks."""
    return per_worker("library_encoder", LibraryEncoder)


def with_end(ids: np.ndarray, n: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with the id ``end`` after each text."""
    return np.insert(ids, np.cumsum(n), np.uint32(end)), n + 1

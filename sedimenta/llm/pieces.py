"""Splitting texts as byte-level BPE vocabularies expect it, and remembering pieces."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence

import numpy as np
import public_tokenizers
import regex

from sedimenta.llm.common import mix

#: Pieces a worker remembers; beyond that it starts anew, so memory is bounded.
REMEMBERED = 1_000_000
#: Longer pieces are not remembered.
LONGEST = 64

_EXACT = regex.compile(public_tokenizers.PATTERN)
# For texts of these characters only, the standard module's classes mean the same and
# are several times as fast: ASCII without odd control characters, and the letters of
# Latin-1, Latin Extended-A and Latin Extended-B.
_ODD = re.compile("[^\t\n\r\x20-\x7eÀ-ÖØ-öø-ɏ]")
_LETTER = "A-Za-zÀ-ÖØ-öø-ɏ"
_PLAIN = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?[^ \t\n\r0-9{_LETTER}]+"
    r"|[ \t\n\r]+(?![^ \t\n\r])|[ \t\n\r]+"
)


def split(text: str) -> list[str]:
    """The matches of ``public_tokenizers.PATTERN``; together they are the whole text."""
    return _EXACT.findall(text) if _ODD.search(text) else _PLAIN.findall(text)


class Remembered:
    """Packed ids of pieces, worked out by ``encode`` for many new pieces at a time."""

    def __init__(self, encode: Callable[[list[str]], Iterable[bytes]]):
        self.encode, self.known = encode, {}

    def texts(self, texts: list[str]) -> list[bytes]:
        split_texts = [split(x) for x in texts]
        new = set()
        for pieces in split_texts:
            new.update(pieces)
        if len(self.known) > REMEMBERED:
            self.known = {}
        known = self.known
        missing = [x for x in new if x not in known]
        extra = {}
        for piece, ids in zip(missing, self.encode(missing), strict=True):
            (known if len(piece) <= LONGEST else extra)[piece] = ids
        if not extra:
            return [b"".join(map(known.__getitem__, pieces)) for pieces in split_texts]
        return [
            b"".join([known[x] if len(x) <= LONGEST else extra[x] for x in pieces])
            for pieces in split_texts
        ]


# --- many texts at once, as bytes ---------------------------------------------------

_SPACE, _LETTERS, _DIGITS, _OTHER = range(4)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[9, 10, 13, 32]] = _SPACE
_CLASS[48:58] = _DIGITS
_CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = _LETTERS
# bytes that texts of the characters above never have, and leads that need a look at the next byte
_STRANGE = np.ones(256, bool)
_STRANGE[[9, 10, 13, *range(32, 127), *range(128, 192), *range(0xC3, 0xCA)]] = False
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Bytes that two 64-bit numbers hold.
_HELD = 16
#: Ids kept in memory for remembered pieces.
_POOL = 1 << 23


def strange_texts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each text whether it has a character that ``cuts`` does not know."""
    at = np.flatnonzero(_STRANGE[data])
    after = np.append(data[1:], np.uint8(0))
    sign = np.flatnonzero((data == 0xC3) & ((after == 0x97) | (after == 0xB7)))
    late = np.flatnonzero((data == 0xC9) & (after > 0x8F))
    out = np.zeros(len(offsets) - 1, bool)
    for places in (at, sign, late):
        out[np.searchsorted(offsets, places, side="right") - 1] = True
    return out


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the pieces of all texts begin; the texts are not strange."""
    n = len(data)
    kind = _CLASS[data]
    space = kind == _SPACE
    ends = np.zeros(n + 1, bool)
    ends[offsets] = True
    before, blank_before = np.empty(n, np.uint8), np.empty(n, bool)
    if n:
        before[0], blank_before[0] = _OTHER, False
        before[1:], blank_before[1:] = kind[:-1], data[:-1] == 32
    # a run of one class, with the blank before it; of white space, the last one is apart
    start = (kind != before) & ~blank_before
    start[1:] |= space[1:] & ~space[:-1]
    start[:-1] |= space[:-1] & ~space[1:] & ~ends[1:-1]
    # blank and then white space: one run
    start[1:] &= ~(space[1:] & space[:-1]) | np.append(~space[2:] & ~ends[2:n], False)
    start |= ends[:n]
    quotes = np.flatnonzero((data == 39) & start)
    if len(quotes):
        # endings such as 's: within the text, the letters go with the quote, what follows is apart
        stop = offsets[np.searchsorted(offsets, quotes, side="right")]
        padded = np.append(data, np.zeros(2, np.uint8))
        room = stop - quotes
        a, b = padded[quotes + 1], padded[quotes + 2]
        one = np.isin(a, np.frombuffer(b"stmd", np.uint8)) & (room > 1)
        two = (((a == 114) | (a == 118)) & (b == 101)) | ((a == 108) & (b == 108))
        two &= room > 2
        for found, size in ((one, 2), (two, 3)):
            at = quotes[found]
            start[at + 1] = False
            rest = at[at + size < n] + size
            start[rest] = start[rest] | (kind[rest] != _SPACE)
    return np.flatnonzero(start)


class Pieces:
    """Ids of texts, a batch at a time: pieces are cut and looked up as numpy vectors.

    ``encode`` gives the packed ids of new pieces, many at a time, ``odd`` those of whole
    texts with unusual characters. Pieces of up to 16 bytes are found by those bytes themselves, in
    a table with open addressing, longer ones in a dictionary. Memory is bounded: beyond
    ``REMEMBERED`` pieces, or 8 million ids, all are forgotten.
    """

    def __init__(self, encode: Callable[[list[str]], Iterable[bytes]], odd: Callable[[list[str]], Sequence[bytes]]):
        self.encode, self.odd = encode, odd
        self._forget()

    def _forget(self) -> None:
        self.bits, self.n, self.used = 16, 0, 0
        self.keys, self.value = np.zeros((1 << self.bits, 2), np.uint64), np.zeros(1 << self.bits, np.int64)
        self.long: dict[bytes, int] = {}
        self.first, self.count = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.pool = np.zeros(1 << 14, np.uint32)

    def texts(self, data: np.ndarray, offsets: np.ndarray, whole: np.ndarray | None = None) -> list[bytes]:
        """Packed ids of each text; texts marked in ``whole`` are left to ``odd``, too."""
        odd = strange_texts(data, offsets)
        if whole is not None:
            odd |= whole
        if not odd.any():
            return self._plain(data, offsets)
        size = np.diff(offsets)
        kept = data[np.repeat(~odd, size)]
        plain = iter(self._plain(kept, np.concatenate([[0], np.cumsum(size[~odd])])))
        strings = [data[offsets[i] : offsets[i + 1]].tobytes().decode() for i in np.flatnonzero(odd)]
        rest = iter(self.odd(strings))
        return [next(rest) if o else next(plain) for o in odd.tolist()]

    def _plain(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        if self.n > REMEMBERED or self.used > _POOL:
            self._forget()
        start = cuts(data, offsets)
        which = self._numbers(data, start, np.append(start[1:], len(data)) - start)
        count = self.count[which]
        ends = np.cumsum(count)
        place = np.repeat(self.first[which] - (ends - count), count)
        place += np.arange(len(place))
        packed = self.pool[place].tobytes()
        edges = (4 * np.concatenate([[0], ends])[np.searchsorted(start, offsets)]).tolist()
        return [packed[a:b] for a, b in zip(edges, edges[1:], strict=False)]

    def _numbers(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        padded = np.concatenate([data, np.zeros(_HELD, np.uint8)])
        eight = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
        keys = np.empty((len(start), 2), np.uint64)
        keys[:, 0] = eight[start] & _MASK[np.minimum(size, 8)]
        keys[:, 1] = eight[start + 8] & _MASK[np.clip(size - 8, 0, 8)]
        which = np.full(len(start), -1, np.int64)
        short = size <= _HELD
        self._find(keys, np.flatnonzero(short), which)
        raw = data.tobytes()
        for i in np.flatnonzero(~short).tolist():
            which[i] = self.long.get(raw[start[i] : start[i] + size[i]], -1)
        missing = np.flatnonzero(which < 0)
        if len(missing):
            a, b = start[missing].tolist(), (start + size)[missing].tolist()
            new: dict[bytes, int] = {}
            for i, x, y in zip(missing.tolist(), a, b, strict=True):
                new.setdefault(raw[x:y], i)
            number = dict(zip(new, range(self.n, self.n + len(new)), strict=True))
            self._remember(self.encode([x.decode() for x in new]))
            which[missing] = [number[raw[x:y]] for x, y in zip(a, b, strict=True)]
            at = np.array(list(new.values()))
            at = at[size[at] <= _HELD]
            self._insert(keys[at], which[at])
            self.long.update((x, i) for x, i in number.items() if len(x) > _HELD)
        return which

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys[:, 0] + keys[:, 1] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _find(self, keys: np.ndarray, rows: np.ndarray, which: np.ndarray) -> None:
        """Numbers of the remembered pieces, put at their rows."""
        keys = keys[rows]
        slot = self._slots(keys)
        while len(rows):
            found = self.keys[slot]
            hit = (found[:, 0] == keys[:, 0]) & (found[:, 1] == keys[:, 1])
            which[rows[hit]] = self.value[slot[hit]]
            go = ~hit & (found[:, 0] != 0)
            rows, keys, slot = rows[go], keys[go], (slot[go] + 1) & ((1 << self.bits) - 1)

    def _remember(self, found: Iterable[bytes]) -> None:
        found = list(found)
        ids = np.frombuffer(b"".join(found), "<u4")
        count = np.array([len(x) // 4 for x in found], np.int64)
        n, used = self.n + len(found), self.used + len(ids)
        while len(self.count) < n:
            self.count = np.concatenate([self.count, np.zeros_like(self.count)])
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
        while len(self.pool) < used:
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used : used] = ids
        self.count[self.n : n] = count
        self.first[self.n : n] = self.used + np.cumsum(count) - count
        self.n, self.used = n, used

    def _insert(self, keys: np.ndarray, which: np.ndarray) -> None:
        """Pieces that are not in the table; it is kept at most half full."""
        if 2 * self.n > 1 << self.bits:
            held = np.flatnonzero(self.keys[:, 0])
            keys = np.concatenate([self.keys[held], keys])
            which = np.concatenate([self.value[held], which])
            while 2 * self.n > 1 << self.bits:
                self.bits += 1
            self.keys, self.value = np.zeros((1 << self.bits, 2), np.uint64), np.zeros(1 << self.bits, np.int64)
        slot = self._slots(keys)
        while len(keys):
            free = self.keys[slot, 0] == 0
            # of several that want a place the last one gets it, key and number from the same row
            self.value[slot[free]] = which[free]
            self.keys[slot[free]] = keys[free]
            own = (self.keys[slot] == keys).all(axis=1)
            keys, which, slot = keys[~own], which[~own], (slot[~own] + 1) & ((1 << self.bits) - 1)

"""Byte-level BPE by merging all rows of padded matrices at once, and its inverse.

The new pieces of a batch are put in matrices by length, a row of byte ids each, padded
with -1. In every round each row merges its leftmost pair of the lowest rank: ranks of
adjacent pairs come from a hash table over pairs, the merged cell replaces its left half,
and the cells to the right move up by one. Rows without a pair left to merge leave.
"""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column
from pyspark.sql import functions as F

from sedimenta.llm.common import SLICE_BYTES, binary_array, slices, utf8
from sedimenta.llm.pieces import Pieces, Remembered

#: Widths of the matrices; a longer piece is merged on its own, by a heap.
WIDTHS = (4, 8, 12, 16, 24, 32, 64, 128)
#: Rows of a matrix.
ROWS = 1 << 14

_NONE = np.iinfo(np.int32).max
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


class Vocabulary:
    """Ranks of byte strings, as arrays: pairs of ids to the id of their union."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [
            ((ranks[x[:k]] << 32) | ranks[x[k:]], rank)
            for x, rank in ranks.items()
            for k in range(1, len(x))
            if x[:k] in ranks and x[k:] in ranks
        ]
        self.pair = dict(pairs)
        bits = max(4, (4 * len(pairs)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, _NONE, np.int32)
        left = np.array([x for x, _ in pairs], np.int64)
        value = np.array([x for _, x in pairs], np.int32)
        slot = self._slots(left)
        self.probes = 0
        while len(left):  # open addressing: one key takes each free slot, the rest move on
            self.probes += 1
            free = self.keys[slot] == -1
            self.keys[slot[free]] = left[free]
            own = self.keys[slot] == left
            self.values[slot[own]] = value[own]
            left, value, slot = left[~own], value[~own], (slot[~own] + 1) & (len(self.keys) - 1)
        size = max(ranks.values()) + 1
        self.bytes_of = [b""] * size
        for x, rank in ranks.items():
            self.bytes_of[rank] = x

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _FACTOR) >> self.shift).astype(np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id of each pair's union, which is its rank; ``_NONE`` if there is none."""
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        keys[(left < 0) | (right < 0)] = -2
        slot = self._slots(keys)
        at = self.keys[slot]
        out = np.where(at == keys, self.values[slot], _NONE)
        open_ = np.flatnonzero((at != keys) & (at != -1))
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & (len(self.keys) - 1)
            at = self.keys[slot[open_]]
            hit = at == keys[open_]
            out[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (at != -1)]
        return out

    # --- encoding -------------------------------------------------------------------

    def merge_matrix(self, cells: np.ndarray) -> np.ndarray:
        """Rows of ids, padded with -1, with all merges done."""
        done = cells.copy()
        rows = np.arange(len(cells))
        rank = self.merged(cells[:, :-1].ravel(), cells[:, 1:].ravel()).reshape(len(cells), -1)
        while len(rows):
            at = rank.argmin(axis=1)
            line = np.arange(len(rows))
            best = rank[line, at]
            go = best != _NONE
            if not go.all():
                done[rows[~go]] = cells[~go]
                rows, cells, rank, at, best = rows[go], cells[go], rank[go], at[go], best[go]
                line = line[: len(rows)]
                if not len(rows):
                    break
            width = cells.shape[1]
            column = np.arange(width)
            source = np.minimum(column + (column > at[:, None]), width - 1)
            cells = np.take_along_axis(cells, source, axis=1)
            cells[:, -1] = -1
            cells[line, at] = best
            source = np.minimum(column[:-1] + (column[:-1] > at[:, None]), width - 2)
            rank = np.take_along_axis(rank, source, axis=1)
            rank[:, -1] = _NONE
            inner = at < width - 1
            rank[line[inner], at[inner]] = self.merged(cells[line[inner], at[inner]], cells[line[inner], at[inner] + 1])
            inner = at > 0
            rank[line[inner], at[inner] - 1] = self.merged(cells[line[inner], at[inner] - 1], cells[line[inner], at[inner]])
        return done

    def merge_long(self, piece: bytes) -> list[int]:
        """The same for one long piece, by a heap over its pairs."""
        ids = [int(self.byte[b]) for b in piece]
        before, after = list(range(-1, len(ids) - 1)), list(range(1, len(ids) + 1))
        heap = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < len(ids):
                rank = self.pair.get((ids[i] << 32) | ids[after[i]])
                if rank is not None:
                    heap.append((rank, i, ids[i], ids[after[i]])) if building else heapq.heappush(
                        heap, (rank, i, ids[i], ids[after[i]])
                    )

        building = True
        for i in range(len(ids) - 1):
            offer(i)
        heapq.heapify(heap)
        building = False
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= len(ids) or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = rank, -1, after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [x for x in ids if x >= 0]

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Packed ids (little-endian, 32 bits) of each piece."""
        raw = [x.encode() for x in pieces]
        out: list[bytes] = [b""] * len(raw)
        size = np.array([len(x) for x in raw], np.int64)
        low = 0
        for width in WIDTHS:
            wanted = np.flatnonzero((size > low) & (size <= width))
            low = width
            for first in range(0, len(wanted), ROWS):
                self._encode_rows([raw[i] for i in wanted[first : first + ROWS]], width, wanted[first : first + ROWS], out)
        for i in np.flatnonzero(size > WIDTHS[-1]):
            out[i] = np.array(self.merge_long(raw[i]), "<u4").tobytes()
        return out

    def _encode_rows(self, rows: list[bytes], width: int, places: np.ndarray, out: list[bytes]) -> None:
        flat = np.frombuffer(b"".join([x.ljust(width, b"\0") for x in rows]), np.uint8).reshape(-1, width)
        size = np.array([len(x) for x in rows])
        cells = np.where(np.arange(width) < size[:, None], self.byte[flat], -1).astype(np.int32)
        done = self.merge_matrix(cells)
        count = (done >= 0).sum(axis=1)
        packed = done.astype("<i4").tobytes()
        for k, (i, n) in enumerate(zip(places.tolist(), count.tolist(), strict=True)):
            out[i] = packed[4 * width * k : 4 * (width * k + n)]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(read_ranks(path))


@lru_cache(maxsize=2)
def _pieces(path: str) -> Pieces:
    encode = vocabulary(path).encode_pieces
    return Pieces(encode, Remembered(encode).texts)


def local_file(path: str, shipped: bool) -> str:
    return SparkFiles.get(path.rpartition("/")[2]) if shipped else path


def encode_text(text: Column, path: str, shipped: bool = False) -> Column:
    """Ids of a text (NULL: empty) as binary: little-endian unsigned 32-bit integers.

    ``path`` is the rank file, there on every machine, or sent to them by
    ``SparkContext.addFile`` if ``shipped``. Special tokens are ordinary text.
    """

    def encode(column: pa.Array) -> pa.Array:
        known = _pieces(local_file(path, shipped))
        data, offsets = utf8(column)
        out: list[bytes] = []
        for a, b in slices(offsets, SLICE_BYTES):
            out += known.texts(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        return binary_array(out)

    encode.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(encode, "binary")(text)


def decode_ids(ids: Column, path: str, shipped: bool = False) -> Column:
    """The bytes that packed ids stand for; an id that is not in the vocabulary is an error."""

    def decode(column: pa.Array) -> pa.Array:
        known = vocabulary(local_file(path, shipped)).bytes_of
        return binary_array(
            [b"".join(map(known.__getitem__, np.frombuffer(x or b"", "<u4").tolist())) for x in column.to_pylist()]
        )

    decode.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(decode, "binary")(ids)

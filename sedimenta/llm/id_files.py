"""Token ids in compressed files: an adaptive context-mixing range coder.

An id is predicted by the last two ids, by the last one, and without any. Order 2 is learned
within the block: a table of what followed two ids, each entry with how often it held. Order 1
has the id that mostly follows in the frame, order 0 the shares of all ids in the frame. Each
order gives the next id a probability, by how often it held lately, and the three are mixed
by weights that follow how well each did. One step of the coder says which of the longer
orders is right, or which id it is by order 0.

A block is a fixed number of ids, in a small frame a smaller one. Model and coder are reset in each, to a start that the frame
has once (its ids' shares and followers), and its checksum is verified when it is read. Blocks
do not depend on each other, so all blocks of a frame go through the coder side by side, one
id of each at a time, as numpy vectors. A frame is a row of the file and holds whole documents.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sedimenta.llm.common import SLICE_BYTES, Scratch, quoted, ready, slices, text_of, utf8
from sedimenta.llm.pieces import Pieces

#: Ids of a block, and of a frame (more only if one document has more).
BLOCK_IDS, FRAME_IDS = 2048, 1 << 22
#: A frame of fewer ids has this many blocks, of fewer ids each but not below the second
#: number: the steps of the coder are as many as a block has ids, however few the blocks.
BLOCKS, SHORTEST = 256, 256
#: Entries of a block's table of predictions, as a power of two.
TABLE_BITS = 11
END_ID = 2

_32, _LOW = np.uint64(32), np.uint64((1 << 32) - 1)
#: Shares of a step are of 2**28: 12 bits for the prediction that holds, 16 for an id by itself.
_STEP_BITS = np.uint64(28)
_ORDER_BITS = 16
#: How much better than order 0 one hit may make a longer order look.
_GAIN = 300


class _Start:
    """What every block of a frame begins with: ids are numbered by their place in ``ids``,
    have a share of 65536 each, and one that mostly follows, with how often it does in 256."""

    def __init__(self, ids: np.ndarray, share: np.ndarray, follower: np.ndarray, often: np.ndarray):
        self.ids, self.share, self.follower, self.often = ids, share, follower, often
        self.width = share.astype(np.int32)
        self.edge = np.concatenate([[0], np.cumsum(share)]).astype(np.int32)
        self.at = np.repeat(np.arange(len(ids), dtype=np.int32), share)
        self.next = follower.astype(np.int32)
        self.sure = (often.astype(np.float32) + np.float32(0.5)) / np.float32(256)
        self.gain = np.minimum(np.float32(1 << _ORDER_BITS) / self.width, np.float32(_GAIN)).astype(np.float32)

    def packed(self) -> bytes:
        numbers = np.concatenate([np.diff(self.ids, prepend=0), self.share - 1, self.follower])
        return zlib.compress(numbers.astype("<u2").tobytes() + self.often.astype(np.uint8).tobytes(), 6)

    @classmethod
    def unpacked(cls, data: bytes) -> _Start:
        raw = zlib.decompress(data)
        n = len(raw) // 7
        gaps, share, follower = np.frombuffer(raw, "<u2", 3 * n).astype(np.int64).reshape(3, n)
        return cls(np.cumsum(gaps), share + 1, follower, np.frombuffer(raw, np.uint8, n, 6 * n))

    @classmethod
    def blank(cls) -> _Start:
        """All ids alike, and nothing known of what follows."""
        n = 1 << _ORDER_BITS
        zeros = np.zeros(n, np.int64)
        return cls(np.arange(n), np.ones(n, np.int64), zeros, zeros)

    @classmethod
    def fitted(cls, ids: np.ndarray) -> _Start:
        """By the counts of ``ids`` and of their pairs; of equal counts the smaller id follows."""
        counts = np.bincount(ids, minlength=1 << _ORDER_BITS)
        known = np.flatnonzero(counts)
        count, n = counts[known], len(known)
        share = count * ((1 << _ORDER_BITS) - n) // len(ids) + 1
        share[count.argmax()] += (1 << _ORDER_BITS) - share.sum()
        number = _numbers(known, ids).astype(np.uint32)
        pairs = np.sort(number[:-1] * np.uint32(n) + number[1:])
        first = np.flatnonzero(np.diff(pairs, prepend=pairs[:1] + np.uint32(1)))
        times = np.diff(first, append=len(pairs))
        pairs = pairs[first].astype(np.int64)
        order = np.lexsort((pairs, -times, pairs // n))
        before, after, times = pairs[order] // n, pairs[order] % n, times[order]
        lead = np.diff(before, prepend=-1) > 0
        follower, often = np.zeros(n, np.int64), np.zeros(n, np.int64)
        follower[before[lead]] = after[lead]
        often[before[lead]] = np.minimum(times[lead] * 256 // count[before[lead]], 250)
        return cls(known, share, follower, often)


def _numbers(known: np.ndarray, ids: np.ndarray) -> np.ndarray:
    place = np.zeros(1 << _ORDER_BITS, np.int64)
    place[known] = np.arange(len(known))
    return place[ids]


class _Model:
    """The predictions of every lane, and how they are mixed.

    Every order gives the next id a probability: order 2 what it remembers of the block,
    order 1 what mostly follows, both by how surely it holds and the rest of them as order
    0 has it. The mixture's weights follow how well each did, with a fixed share that moves.
    """

    def __init__(self, lanes: int, start: _Start):
        self.start, lane = start, np.arange(lanes)
        # an entry has the number said and, in its lowest two bits, how often it held
        self.entry = np.zeros(lanes << TABLE_BITS, np.int32)
        self.base, self.rows = lane << TABLE_BITS, lane * 4
        self.hold = np.tile(np.array([0, 0.25, 0.45, 0.7], np.float32), lanes)
        self.weight2, self.weight1 = np.full(lanes, 0.4, np.float32), np.full(lanes, 0.4, np.float32)
        self.last, self.before = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)

    def predict(self) -> None:
        """What the longer orders say, and where their shares of 4096 end; the rest is order 0's.

        Where both say the same, the mixture of both counts for the longer one.
        """
        at = self.last * 40503
        at += self.before * 30011
        at >>= 4
        at &= (1 << TABLE_BITS) - 1
        at += self.base
        entry = self.entry.take(at, mode="clip")
        self.at, self.trust, self.said2 = at, entry & 3, entry >> 2
        self.row = self.rows + self.trust
        self.odds2 = self.hold.take(self.row, mode="clip")
        self.said1 = self.start.next.take(self.last, mode="clip")
        self.odds1 = self.start.sure.take(self.last, mode="clip")
        a, b = self.weight2 * self.odds2, self.weight1 * self.odds1
        same = b * (self.said1 == self.said2)
        a += same
        b -= same
        a *= np.float32(4000)
        b *= np.float32(4000)
        self.end2 = a.astype(np.int32)
        self.end2 += 1
        self.end1 = b.astype(np.int32)
        self.end1 += 1
        self.end1 += self.end2

    def span(self, now: np.ndarray, is2: np.ndarray, is1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and size of each number's share of 2**28."""
        rest, end2, end1 = 4096 - self.end1, self.end2 << _ORDER_BITS, self.end1 << _ORDER_BITS
        first = self.start.edge.take(now, mode="clip")
        first *= rest
        first += end1
        share = self.start.width.take(now, mode="clip")
        share *= rest
        first, share = np.where(is1, end2, first), np.where(is1, end1 - end2, share)
        return np.where(is2, 0, first).astype(np.uint64), np.where(is2, end2, share).astype(np.uint64)

    def update(self, now: np.ndarray, hit2: np.ndarray, hit1: np.ndarray) -> None:
        gain = self.start.gain.take(now, mode="clip")
        fit2 = np.where(hit2, self.odds2 * gain, 1 - self.odds2)
        fit2 *= self.weight2
        fit1 = np.where(hit1, self.odds1 * gain, 1 - self.odds1)
        fit1 *= self.weight1
        whole = 1 - self.weight2
        whole -= self.weight1
        whole += fit2
        whole += fit1
        np.divide(np.float32(0.94), whole, out=whole)
        for fit in (fit2, fit1):
            fit *= whole
            fit += np.float32(0.02)
        self.weight2, self.weight1 = fit2, fit1
        odds = hit2 - self.odds2
        odds *= np.float32(0.04)
        odds += self.odds2
        self.hold[self.row] = odds
        stay = hit2 | (self.trust > 1)
        entry = np.where(stay, self.said2, now)
        entry <<= 2
        trust = self.trust + np.where(hit2, np.int32(1), np.int32(-1))
        np.clip(trust, 0, 3, out=trust)
        trust += ~stay & (trust == 0)
        entry += trust
        self.entry[self.at] = entry
        self.before, self.last = self.last, now


def code_blocks(ids: np.ndarray, start: _Start | None = None) -> list[bytes]:
    """Each row of ``ids`` (below 2**16) coded on its own, all from the same ``start``.

    A lane's interval is 64 bits; 32 of them leave as soon as its size fits the others. A
    carry is added to the word that left last, and goes further up when all is done.
    """
    lanes, length = ids.shape
    start = start or _Start.blank()
    model = _Model(lanes, start)
    low, size = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)
    width = length + 2
    out = np.zeros(lanes * width, np.uint64)
    end = np.arange(lanes) * width
    columns = np.ascontiguousarray(_numbers(start.ids, ids).T)
    for now in columns:
        model.predict()
        hit2, hit1 = now == model.said2, now == model.said1
        first, share = model.span(now, hit2, hit1)
        unit = size >> _STEP_BITS
        first *= unit
        low += first
        size = share
        size *= unit
        over = np.flatnonzero(low < first)
        if len(over):
            out[end[over] - 1] += np.uint64(1)
        todo = np.flatnonzero(size <= _LOW)
        if len(todo):
            a, place = low[todo], end[todo]
            out[place] = a >> _32
            end[todo] = place + 1
            low[todo] = a << _32
            size[todo] <<= _32
        model.update(now, hit2, hit1)
    # one more word names a number inside the interval; zeros are read after it
    out[end] = (low >> _32) + ((low & _LOW) != 0)
    out = out.reshape(lanes, width)
    while (carry := out >> _32).any():
        out &= _LOW
        out[:, :-1] += carry[:, 1:]
    words = end + 1 - np.arange(lanes) * width
    return [row[:n].astype("<u4").tobytes() for row, n in zip(out, words.tolist(), strict=True)]


def decode_blocks(coded: list[bytes], length: int, start: _Start | None = None) -> np.ndarray:
    """The inverse of ``code_blocks`` for rows of ``length`` ids."""
    lanes = len(coded)
    start = start or _Start.blank()
    model = _Model(lanes, start)
    width = max(map(len, coded)) // 4 + 3
    words = np.zeros((lanes, width), np.uint64)
    for i, data in enumerate(coded):
        words[i, : len(data) // 4] = np.frombuffer(data, "<u4", len(data) // 4)
    # how far the code is above the interval's low end
    above = (words[:, 0] << _32) | words[:, 1]
    words = words.ravel()
    at = np.arange(lanes) * width + 2
    last = np.arange(1, lanes + 1) * width - 1
    size = np.full(lanes, (1 << 64) - 1, np.uint64)
    out = np.zeros((length, lanes), np.uint16)
    top, ids = np.uint64((1 << 28) - 1), start.ids.astype(np.uint16)
    for t in range(length):
        model.predict()
        unit = size >> _STEP_BITS
        value = np.minimum(above // unit, top).astype(np.int32)
        end1 = model.end1 << _ORDER_BITS
        is2, missed = value < model.end2 << _ORDER_BITS, value >= end1
        value -= end1
        value //= 4096 - model.end1
        now = np.where(missed, start.at.take(value, mode="clip"), model.said1)
        now = np.where(is2, model.said2, now).astype(np.int64)
        first, share = model.span(now, is2, ~missed & ~is2)
        first *= unit
        above -= first
        size = share
        size *= unit
        todo = np.flatnonzero(size <= _LOW)
        if len(todo):
            place = at[todo]
            above[todo] = (above[todo] << _32) | words.take(np.minimum(place, last[todo]))
            at[todo] = place + 1
            size[todo] <<= _32
        out[t] = ids.take(now, mode="clip")
        model.update(now, now == model.said2, now == model.said1)
    return np.ascontiguousarray(out.T)


# --- frames -------------------------------------------------------------------------


def write_frame(ids: np.ndarray, block_ids: int = BLOCK_IDS) -> bytes:
    """All ids of a frame: length of a block, number of blocks, size and checksum of the start,
    sizes and checksums of the blocks, the start, the blocks.

    The start is left out where it would take a byte or more for each id. The last block is
    filled up with its last id; the number of ids is kept beside the frame.
    """
    if len(ids) and int(ids.max()) >= 1 << 16:
        raise ValueError("ids must be below 65536")
    length = max(1, min(block_ids, len(ids), max(SHORTEST, -(-len(ids) // BLOCKS))))
    lanes = -(-len(ids) // length)
    padded = np.full(lanes * length, ids[-1] if len(ids) else 0, np.uint16)
    padded[: len(ids)] = ids
    rows = padded.reshape(lanes, length)
    start = _Start.fitted(padded) if lanes else None
    known = start.packed() if start else b""
    if len(known) >= len(ids):
        start, known = None, b""
    coded = code_blocks(rows, start) if lanes else []
    head = [length, lanes, len(known), zlib.crc32(known)]
    for row, data in zip(rows, coded, strict=True):
        head += [len(data), zlib.crc32(row.astype("<u2").tobytes())]
    return b"".join([np.array(head, "<u4").tobytes(), known, *coded])


def read_frame(data: bytes, n_ids: int) -> np.ndarray:
    """The ids; a start or a block whose checksum is wrong is an error."""
    length, lanes, size, known_sum = np.frombuffer(data, "<u4", 4).tolist()
    head = np.frombuffer(data, "<u4", 2 * lanes, 16).reshape(lanes, 2)
    if not lanes:
        return np.zeros(0, np.uint16)
    first = 16 + 8 * lanes
    known = data[first : first + size]
    if zlib.crc32(known) != known_sum:
        raise ValueError("the start of the frame's blocks is damaged")
    ends = first + size + np.cumsum(head[:, 0], dtype=np.int64)
    blocks = [data[e - n : e] for e, n in zip(ends.tolist(), head[:, 0].tolist(), strict=True)]
    rows = decode_blocks(blocks, length, _Start.unpacked(known) if size else None)
    for i, (row, sum_) in enumerate(zip(rows, head[:, 1].tolist(), strict=True)):
        if zlib.crc32(row.astype("<u2").tobytes()) != sum_:
            raise ValueError(f"block {i} is damaged")
    return rows.reshape(-1)[:n_ids]


_FRAME = "part int, frame int, doc_ids array<long>, sizes array<int>, n_ids long, data binary"
_READ = "doc_id long, start long, n_ids long, ids binary"


def _encode_texts(path: str, shipped: bool, plain_special: bool):
    """Function from texts (bytes end to end, and where they begin) to packed ids, by the tokenizers library."""
    return _library(SparkFiles.get(path.rpartition("/")[2]) if shipped else path, plain_special)


# the character that stands for a byte in byte-level vocabularies: itself if it can be seen,
# else the next one from 256 on
_SEEN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_SHOWN = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _SEEN)}
_BLANK = chr(_SHOWN[32])


@lru_cache(maxsize=2)
def _library(path: str, plain_special: bool):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    if plain_special:
        tokenizer.encode_special_tokens = True
    # what the library looks for in a text before it splits it
    added = [x for x in tokenizer.get_added_tokens_decoder().values() if not (plain_special and x.special)]
    # only this way of splitting is done here
    steps = json.loads(tokenizer.to_str())
    split = steps["pre_tokenizer"] or {}
    as_split = (split.get("type"), split.get("add_prefix_space"), split.get("use_regex", True)) == ("ByteLevel", False, True)
    all_whole = not as_split or steps["normalizer"] is not None or steps["model"]["type"] != "BPE"
    special = re.compile(b"|".join(re.escape(x.content.encode()) for x in added)) if added else None

    def whole(texts: list[str]) -> list[bytes]:
        found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def merged(words: list[str]) -> list[bytes]:
        # a piece is what the library would split off, so its model can take it as it is
        tokenize, out = tokenizer.model.tokenize, []
        for word in words:
            if word.isascii() and word.isprintable():
                shown = word.replace(" ", _BLANK)
            else:
                shown = word.encode().decode("latin-1").translate(_SHOWN)
            out.append(array("I", [x.id for x in tokenize(shown)]).tobytes())
        return out

    pieces = Pieces(merged, whole)

    def run(data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        # a text of unusual characters, or with an added token, is left to the library as a whole
        odd = np.full(len(offsets) - 1, all_whole)
        if special and not all_whole:
            raw, edges = data.tobytes(), offsets.tolist()
            odd[:] = [bool(special.search(raw, a, b)) for a, b in zip(edges, edges[1:], strict=False)]
        return pieces.texts(data, offsets, odd)

    return run


def _frames(path: str, shipped: bool, end_id: int, frame_ids: int, plain_special: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encode_texts(path, shipped, plain_special)
        part, frame = TaskContext.get().partitionId(), 0
        docs: list = []
        held: list[np.ndarray] = []

        def close() -> pa.RecordBatch:
            nonlocal frame, docs, held
            ids = np.concatenate(held)
            row = [[part], [frame], [docs], [[len(x) for x in held]], [len(ids)], [write_frame(ids)]]
            kinds = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int64(), pa.binary()]
            docs, held, frame = [], [], frame + 1
            return pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(row, kinds, strict=True)],
                names=["part", "frame", "doc_ids", "sizes", "n_ids", "data"],
            )

        total = 0
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in slices(offsets, SLICE_BYTES):
                names = batch.column(0).slice(a, b - a).to_pylist()
                found = encode(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                for name, packed in zip(names, found, strict=True):
                    ids = np.append(np.frombuffer(packed, "<u4"), np.uint32(end_id))
                    if held and total + len(ids) > frame_ids:
                        yield close()
                        total = 0
                    docs.append(name)
                    held.append(ids)
                    total += len(ids)
        if held:
            yield close()

    return run


def write_ids(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    shipped: bool = False,
    frame_ids: int = FRAME_IDS,
    plain_special: bool = True,
) -> None:
    """Write the ids of every text (NULL: empty), each followed by ``end_id``, below ``path``.

    Documents are in ascending order of their ids (NULL first; of equal ids by the text's
    hash), over all files. ``tokenizer`` is a file of the tokenizers library, there on every
    machine or sent by ``SparkContext.addFile`` if ``shipped``; special tokens in a text are
    ordinary text if ``plain_special``, else what the library's default makes of them. An empty table gives files without frames.
    """
    ready(docs.sparkSession)
    rows = docs.select(quoted(id_col).cast("long").alias("id"), text_of(docs, text_col).alias("text"))
    tie = F.xxhash64("text")
    # rows with one id, or without, are split by their texts
    ordered = rows.repartitionByRange(F.col("id"), tie).sortWithinPartitions("id", tie)
    frames = ordered.mapInArrow(_frames(tokenizer, shipped, end_id, frame_ids, plain_special), _FRAME)
    frames.write.option("compression", "uncompressed").parquet(path)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = read_frame(row["data"], row["n_ids"]).astype("<u4")
            sizes = np.array(row["sizes"], np.int64)
            ends = np.cumsum(sizes)
            n = len(sizes)
            places = pa.array(np.concatenate([[0], ends]).astype(np.int32) * 4)
            packed = pa.Array.from_buffers(pa.binary(), n, [None, places.buffers()[1], pa.py_buffer(ids.tobytes())])
            for a in range(0, n, 256):
                k = min(256, n - a)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"][a : a + k], pa.int64()),
                        pa.array((row["first"] + ends - sizes)[a : a + k]),
                        pa.array(sizes[a : a + k]),
                        packed.slice(a, k),
                    ],
                    names=["doc_id", "start", "n_ids", "ids"],
                )


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_ids``, ``ids`` (packed,
    little-endian, 32 bits) of every document written below ``path``."""
    ready(spark)
    frames = spark.read.schema(_FRAME).parquet(path)
    sizes = frames.select("part", "frame", "n_ids")
    # a row per part, so no more than tasks that wrote
    outer = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).withColumn(
        "before", F.coalesce(F.sum("n").over(outer), F.lit(0))
    )
    inner = Window.partitionBy("part").orderBy("frame").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("inner", F.coalesce(F.sum("n_ids").over(inner), F.lit(0))).join(
        parts.select("part", "before"), "part"
    ).select("part", "frame", (F.col("before") + F.col("inner")).alias("first"))
    # a row per frame, so a few for each GB; kept, so that Catalyst knows how small it is
    kept = Scratch(spark, "starts").keep(starts)
    return frames.join(kept, ["part", "frame"]).mapInArrow(_documents, _READ)


def ids_crc32(ids: Column) -> Column:
    return F.crc32(ids)

"""What the operators of this package share: batches, word hashes, scratch tables."""

from __future__ import annotations

import gc
import tempfile
import time
import zipfile
from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import sedimenta
from sedimenta.session import scratch_path
from sedimenta.sources import storage

#: Rows in an Arrow batch; texts can be very long, so far fewer than Spark's default.
BATCH_ROWS = 512
#: Bytes of text that are hashed at a time inside a task.
SLICE_BYTES = 1 << 20

_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


_SHIPPED: set[str] = set()


def ready(spark: SparkSession) -> None:
    """Before functions of this package run in tasks: send it to the executors, once for
    each application, and keep Arrow batches small, unless they are smaller already."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(sedimenta.__file__).parent
        archive = Path(tempfile.mkdtemp(prefix="sedimenta-")) / "sedimenta.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(str(archive))
        _SHIPPED.add(context.applicationId)
    held = int(spark.conf.get(_BATCH_SETTING, "10000"))
    if not 0 < held <= BATCH_ROWS:  # 0 or less sets no limit
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))


class Scratch:
    """Written tables in the shared folder of ``spark.checkpoint.dir``.

    ``keep`` writes a table and reads it back: its lineage is cut in a way that
    survives lost executors, and Catalyst knows its true size. ``free`` removes
    the tables that no returned DataFrame reads any more.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label, self.paths = spark, label, {}

    def path(self) -> str:
        return scratch_path(self.spark, self.label)

    def keep(self, df: DataFrame) -> DataFrame:
        path = self.path()
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (out, path)
        return out

    def free(self, *tables: DataFrame) -> None:
        for table in tables:
            _, path = self.paths.pop(id(table), (None, None))
            if path:
                storage.remove_tree(self.spark, path)
        self.spark._jvm.System.gc()

    def settle(self) -> None:
        """Let go of the shuffle files of finished jobs, before a job that needs the room.

        Spark deletes them once the driver has collected the plans that made them, and
        the driver may not collect for long; a written table does not need them. Plans
        are held by Python's objects first, and the deletion runs beside the program.
        """
        for _ in range(2):
            gc.collect()
            self.spark._jvm.System.gc()
            time.sleep(1)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores put before it until ``df`` has no such column."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def refuse_taken(df: DataFrame, *names: str) -> None:
    """Columns of a result must not be there already; case makes no difference, as in Spark."""
    taken = {c.lower() for c in df.columns}
    for name in names:
        if name.lower() in taken:
            raise ValueError(f"there is a column {name} already")


def aside(df: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns of these names under fresh ones, and what each column is called now."""
    held = {n.lower() for n in names}
    clashing = [c for c in df.columns if c.lower() in held]
    now = dict(zip(clashing, fresh(df, *clashing), strict=True))
    called = {c: now.get(c, c) for c in df.columns}
    return (df.select(*[quoted(c).alias(called[c]) for c in df.columns]) if now else df), called


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(df: DataFrame, name: str = "text") -> Column:
    return F.coalesce(quoted(name).cast("string"), F.lit(""))


# --- texts as bytes -----------------------------------------------------------------


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All texts end to end as bytes, and the n + 1 places where they begin and end."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    kind = column.type
    if pa.types.is_string(kind) or pa.types.is_large_string(kind):
        column = pc.fill_null(column, "").cast(pa.large_string())
    else:
        column = pc.fill_null(column, b"").cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(
    offsets: np.ndarray, limit: int = SLICE_BYTES, most: int | None = None
) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes, and of ``most`` texts at the most; a longer
    text stands alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n, n if most is None else first + most)
        yield first, last
        first = last


def binary_array(parts: Sequence[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


# --- hashes of words ----------------------------------------------------------------

_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = np.uint64(0x9E3779B97F4A7C15)
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of ``x``."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _STEP)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            table = np.full(n, base, np.uint64)
            table[0] = 1
            _POWERS[i] = np.cumprod(table)
    return _POWERS


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and how many words lie before each text (n + 1 numbers).

    A word is a run of ASCII letters, digits and bytes of other characters.
    """
    n = len(data)
    inside = _WORD[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    after = np.empty(n, bool)
    if n:
        before[0], after[-1] = False, False
        before[1:], after[:-1] = inside[:-1], inside[1:]
    start = np.flatnonzero(inside & (~before | edge[:n]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    out = np.empty(len(start), np.uint64)
    first = 0
    while first < len(start):
        last = int(np.searchsorted(end, start[first] + SLICE_BYTES, side="right"))
        last = max(last, first + 1)
        low, high = int(start[first]), int(end[last - 1])
        power, inverse = _powers(max(SLICE_BYTES, high - low))
        total = np.zeros(high - low + 1, np.uint64)
        np.cumsum(_BYTE[data[low:high]] * power[: high - low], out=total[1:])
        a, b = start[first:last] - low, end[first:last] - low
        out[first:last] = (total[b] - total[a]) * inverse[a]
        first = last
    return mix(out), np.searchsorted(start, offsets)


def shingles(words: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``size`` words and its text; a shorter text with words is one run."""
    count = np.diff(bounds)
    each = np.where(count >= size, count - size + 1, (count > 0).astype(count.dtype))
    text = np.repeat(np.arange(len(count)), each)
    first = np.arange(len(text)) - np.repeat(np.cumsum(each) - each, each)
    place = bounds[text] + first
    out = np.zeros(len(text), np.uint64)
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    short = count[text] < size
    for k in range(size):
        part = padded[place + k]
        if short.any():
            part = np.where(short & (k >= count[text]), np.uint64(0), part)
        out = mix(out + part * np.uint64(2 * k + 3) + _STEP)
    return out, text

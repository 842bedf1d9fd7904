"""Reading tables, cutting lineage, checked broadcasts and vectorised text for the operators of this subpackage."""

from __future__ import annotations

import ctypes
import pickle
import uuid

import numpy as np
import pyarrow as pa
from pyspark import SparkContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorgnette.sources.shared import cut, shared_folder

__all__ = ["chunks", "column", "cut", "grouped", "held", "mix", "runs", "shared_folder", "small", "table", "text_bytes", "word_table", "written"]
#: A side of a join is broadcast only when its counted rows stay below this many bytes.
BROADCAST_LIMIT = 32 << 20
#: Bytes of text, and rows, that the vectorised functions take at once.
CHUNK, CHUNK_ROWS = 1 << 20, 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """Like ``cut``, but as a Parquet table in the shared folder: smaller where columns compress well."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows fit in ``BROADCAST_LIMIT``; else as it is, for a shuffled join."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_LIMIT else df


def held(sc: SparkContext, value):
    """A function that gives ``value`` in tasks. Classes of this package go along with it, so executors need no copy of them."""
    shared, seen = sc.broadcast(cloudpickle.dumps(value)), []

    def get():
        if not seen:
            seen.append(pickle.loads(shared.value))
        return seen[0]

    return get


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array end to end, and where each row begins; a null is an empty text."""
    column = column.fill_null("").cast(pa.large_string())
    off = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    if off[-1] == off[0]:
        return np.zeros(0, np.uint8), off - off[0]
    return np.frombuffer(column.buffers()[2], np.uint8)[off[0] : off[-1]], off - off[0]


def chunks(batches, name: str, limit: int = CHUNK, rows: int = CHUNK_ROWS):
    """Slices of the record batches that hold about ``limit`` bytes of text in the column ``name``, one row at least and ``rows`` at most."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = text_bytes(batch.column(name))
        at = 0
        while at < batch.num_rows:
            to = min(max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1), at + rows)
            yield batch.slice(at, to - at)
            at = to
    release()


def release() -> None:
    """Gives freed memory back to the system, which a worker would keep while it waits for other tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim:
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Polynomial hashes, modulo 2**64, of any stretches of a sequence, in constant time for each."""

    def __init__(self, base: int = 0x9E3779B97F4A7C15):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.grow(1 << 10)

    def grow(self, n: int) -> None:
        up, down = np.full(n + 1, self.base, np.uint64), np.full(n + 1, self.inverse, np.uint64)
        up[0] = down[0] = 1
        self.up, self.down = np.cumprod(up), np.cumprod(down)

    def prefix(self, x: np.ndarray) -> np.ndarray:
        if len(x) >= len(self.up):
            self.grow(2 * len(x))
        out = np.zeros(len(x) + 1, np.uint64)
        np.cumsum((x.astype(np.uint64) + np.uint64(1)) * self.up[: len(x)], out=out[1:])
        return out

    def stretch(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((prefix[end] - prefix[start]) * self.down[start] + (end - start).astype(np.uint64))


def word_table() -> np.ndarray:
    """True for the bytes of words: ASCII letters and digits, underscore, and all beyond ASCII."""
    ok = np.zeros(256, bool)
    for a, b in ((48, 58), (65, 91), (95, 96), (97, 123), (128, 256)):
        ok[a:b] = True
    return ok


def runs(data: np.ndarray, off: np.ndarray, ok: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the longest stretches of bytes in the table ``ok`` begin and end; none goes past the end of its text."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    is_in = ok[data]
    first, last = is_in.copy(), is_in.copy()
    first[1:] &= ~is_in[:-1]
    last[:-1] &= ~is_in[1:]
    edges = off[1:-1][(off[1:-1] > 0) & (off[1:-1] < len(data))]
    first[edges] = is_in[edges]
    last[edges - 1] = is_in[edges - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


class Words:
    """Hashes of the words of many texts at once. The texts have to be in lower case already."""

    def __init__(self):
        self.rolling, self.ok = Rolling(), word_table()

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The hash of every word, and where each text's words begin in that array."""
        data, off = text_bytes(column)
        start, end = runs(data, off, self.ok)
        return self.rolling.stretch(self.rolling.prefix(data), start, end), np.searchsorted(start, off).astype(np.int64)


def grouped(batches, keys: list[str]):
    """Record batches whose rows are sorted by ``keys``, cut anew so that no group of equal keys is divided."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        if held:
            same = all(held[-1].column(k)[held[-1].num_rows - 1].as_py() == c[0] for k, c in zip(keys, columns, strict=True))
            if not same:
                yield pa.Table.from_batches(held)
                held = []
        differs = np.zeros(max(batch.num_rows - 1, 0), bool)
        for c in columns:
            differs |= c[1:] != c[:-1]
        if differs.any():
            last = int(np.flatnonzero(differs)[-1]) + 1
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = [batch.slice(last)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)
        held = []
    release()


def column(t: pa.Table, name: str) -> np.ndarray:
    return t.column(name).to_numpy()

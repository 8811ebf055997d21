"""Byte-level word handling for kernels that run inside Spark tasks.

Texts reach the kernels as Arrow string arrays, whose UTF-8 bytes are read in
place.  Words are found and hashed with whole-array numpy steps, a bounded
chunk of texts at a time, so a task's memory follows the chunk (or the one
longest text), never the partition.
"""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

import brisa
from brisa.session import scratch_path

CHUNK_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Words of the class [^\x20\x09-\x0D]+ (anything but ASCII white space).
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False

#: Words of the class [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_P = 0x9E3779B97F4A7C15 | 1
_PINV = pow(_P, -1, 1 << 64)
_PIECE = 1 << 20
_powers: dict[int, np.ndarray] = {}
_libc = ctypes.CDLL(None) if hasattr(ctypes.CDLL(None), "malloc_trim") else None


def release() -> None:
    """Give freed memory back to the system; workers live on between tasks and share their executor's limit."""
    pa.default_memory_pool().release_unused()
    if _libc is not None:
        _libc.malloc_trim(0)


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, end row, bytes, offsets) for runs of rows of about ``limit`` bytes.

    ``offsets`` has one more entry than the run has rows and counts from 0.  Null texts are empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    _, off_buf, data_buf = column.buffers()
    off = np.frombuffer(off_buf, dtype=np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data_buf, dtype=np.uint8) if data_buf else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, side="right")) - 1)
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi
    release()


def words(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and for each row the index of its first word (one more entry at the end)."""
    m = member[data]
    before = np.empty_like(m)
    before[:1] = False
    before[1:] = m[:-1]
    inner = offsets[(offsets > 0) & (offsets < len(m))]
    before[inner] = False
    starts = np.flatnonzero(m & ~before)
    after = np.empty_like(m)
    after[-1:] = False
    after[:-1] = m[1:]
    after[inner - 1] = False
    ends = np.flatnonzero(m & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over a 64-bit value (split-mix)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, _PIECE), base, dtype=np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of every word's bytes, from prefix sums (no loop over words)."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _PIECE, side="right")))
        base, stop = int(starts[i]), int(ends[j - 1])
        piece = np.zeros(stop - base + 1, dtype=np.uint64)
        np.cumsum((data[base:stop].astype(np.uint64) + np.uint64(1)) * _power(_P, stop - base), out=piece[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        h = (piece[e] - piece[s]) * _power(_PINV, stop - base)[s]
        out[i:j] = mix(h + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        i = j
    return out


def shingle_hashes(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``k`` words in each row, and the index of each row's first run.

    A row with fewer than ``k`` words, but not none, has one run of all its words.
    """
    n = np.diff(first)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    at = np.concatenate([[0], np.cumsum(count)])
    row = np.repeat(np.arange(len(n)), count)
    pos = first[row] + np.arange(at[-1]) - at[row]
    out = np.zeros(at[-1], dtype=np.uint64)
    last = first[row + 1]
    padded = np.concatenate([h, np.zeros(1, np.uint64)])
    for j in range(k):
        inside = pos + j < last
        out = mix(out * np.uint64(0x9FB21C651E98DF25) + np.where(inside, padded[np.minimum(pos + j, len(h))], np.uint64(0)) + np.uint64(j + 1))
    return out, at


def whole_groups(batches, *keys: str) -> Iterator[pa.Table]:
    """Tables in which every run of equal keys is complete, from batches sorted by those columns.

    Memory holds one batch and the last run.
    """
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = (table if held is None else pa.concat_tables([held, table])).combine_chunks()
        if not held.num_rows:
            continue
        last = np.ones(held.num_rows, bool)
        for k in keys:
            col = held.column(k).to_numpy()
            last &= col == col[-1]
        cut = int(np.argmax(last))  # keys are sorted: the last run begins at its first row
        if cut:
            yield held.slice(0, cut)
            held = held.slice(cut)
    if held is not None and held.num_rows:
        yield held


def group_starts(*columns: np.ndarray) -> np.ndarray:
    """First row of every run of equal values, and the number of rows at the end."""
    n = len(columns[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(new), n)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: lineage ends there, and the
    work is done once however often the result is used."""
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def prepare(spark: SparkSession, limit: int = 16 << 20) -> None:
    """Ready a session for kernels: executors get this package, and Arrow batches stay small.

    The package goes to the executors as a Spark file (as with ``--py-files``), once for each context,
    so it need not be installed there.  Texts are long and a task holds a few copies of a batch.
    """
    sc = spark.sparkContext
    if not getattr(sc, "_brisa_shipped", False):
        root = Path(brisa.__file__).parent
        archive = Path(tempfile.mkdtemp(prefix="brisa-py-")) / "brisa-package.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        sc.addPyFile(str(archive))
        sc._brisa_shipped = True
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key).rstrip("b")
    if not now.isdigit() or not 0 < int(now) <= limit:
        spark.conf.set(key, str(limit))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")

"""Helpers that the corpus operators share: lineage cuts, hold-out rules, and text as numpy arrays.

Texts reach Python workers as Arrow buffers, so words are found and hashed for a whole batch at
once; no Python string is made for a word. Words are known by 64-bit hashes and sets of words by
128-bit ones.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_SETTING = "spark.checkpoint.dir"

#: Rows with texts that travel to a Python worker at a time.
BATCH_ROWS = 1000
#: Bytes of text that a worker turns into arrays at a time; a longer text is a batch of its own.
BATCH_BYTES = 2 << 20
#: Bytes of words hashed at a time.
HASH_BYTES = 1 << 19


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, shared by all executors.

    Where none is named, a local session gets one of its own, deleted at exit; any other session
    is refused.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get(CHECKPOINT_SETTING, None)
        if folder is None:
            if context.master != "local" and not context.master.startswith("local["):
                raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="contentloom-llm-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """``checkpoint()`` in the shared folder, which survives lost executors.

    Spark deletes the files with the last frame that reads them if
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()


class Shared:
    """A value of the package's own types, broadcast by value; its size must be bounded."""

    def __init__(self, spark: SparkSession, value: object):
        self._sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def load(self) -> object:
        """The value in a task; once a task is enough."""
        return cloudpickle.loads(self._sent.value)


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def set_aside(docs: DataFrame) -> DataFrame:
    """(doc_id, text, rest): every other column goes into the struct ``rest``, named by position.

    So no name of ``docs`` can clash with an operator's own, whatever its case. The session sends
    at most ``BATCH_ROWS`` rows at a time to Python from here on, which bounds what a task holds.
    """
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(docs.sparkSession.conf.get(setting)) <= BATCH_ROWS:
        docs.sparkSession.conf.set(setting, BATCH_ROWS)
    names = docs.columns
    placed = docs.toDF(*[f"c{i}" for i in range(len(names))])
    others = [F.col(f"c{i}") for i, name in enumerate(names) if name not in ("doc_id", "text")]
    return placed.select(
        F.col(f"c{names.index('doc_id')}").alias("doc_id"),
        F.col(f"c{names.index('text')}").alias("text"),
        F.struct(*others, F.lit(0).alias("end")).alias("rest"),
    )


def restored(df: DataFrame, names: list[str], **changed: Column) -> DataFrame:
    """The columns that ``set_aside`` took apart, in their order; ``changed`` replaces some."""
    own = ("doc_id", "text")
    columns = [
        changed.get(name, F.col(name) if name in own else F.col(f"rest.c{i}")).alias(f"c{i}")
        for i, name in enumerate(names)
    ]
    return df.select(*columns).toDF(*names)


def keyed_only(docs: DataFrame) -> DataFrame:
    """(doc_id, text) alone."""
    return set_aside(docs).select("doc_id", "text")


def parts_of(rows: int, per_part: int) -> int:
    """How many parts of about ``per_part`` rows there are, one at least."""
    return max(1, -(-rows // per_part))


# --- text as arrays -------------------------------------------------------------------------


class Texts:
    """The UTF-8 bytes of a column of texts: text i is data[bounds[i]:bounds[i + 1]]; NULL is empty."""

    def __init__(self, column: pa.Array):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        self.valid = np.asarray(pc.is_valid(column))
        column = pc.fill_null(column.cast(pa.large_binary()), b"")
        _, bounds, data = column.buffers()
        self.bounds = np.frombuffer(bounds, np.int64)[column.offset : column.offset + len(column) + 1]
        low, high = (int(self.bounds[0]), int(self.bounds[-1])) if len(column) else (0, 0)
        self.data = np.frombuffer(data, np.uint8)[low:high] if high > low else np.empty(0, np.uint8)
        self.bounds = self.bounds - low if len(column) else np.zeros(1, np.int64)

    def __len__(self) -> int:
        return len(self.bounds) - 1


def text_batches(
    batches: Iterable[pa.RecordBatch], column: str, most: int = BATCH_BYTES
) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """The rows in slices of at most ``most`` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            base = ends[start] - sizes[start]
            stop = max(start + 1, int(np.searchsorted(ends, base + most, "right")))
            part = batch.slice(start, stop - start)
            yield part, Texts(part.column(column))
            start = stop


def _byte_set(test: Callable[[int], bool]) -> np.ndarray:
    return np.array([test(b) for b in range(256)])


def _lowered(b: int) -> int:
    return b + 32 if 0x41 <= b <= 0x5A else b


#: Bytes of words [^\x20\x09-\x0D]+, and of words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ once A-Z are lowered.
SPACED = _byte_set(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
LETTERED = _byte_set(lambda b: 0x30 <= b <= 0x39 or 0x61 <= _lowered(b) <= 0x7A or b >= 0x80)

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_UNFACTOR = np.uint64(pow(int(_FACTOR), -1, 1 << 64))
_BYTE_VALUES = np.random.Generator(np.random.PCG64(20240131)).integers(0, 1 << 63, 256, np.uint64)
_LOWER_VALUES = _BYTE_VALUES[[_lowered(b) for b in range(256)]]


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of x."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the factor and of its inverse, as many as were needed so far."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(cls.up):
            n = max(n, HASH_BYTES + 4096)
            with np.errstate(over="ignore"):
                cls.up, cls.down = (
                    np.multiply.accumulate(np.r_[np.uint64(1), np.full(n - 1, f, np.uint64)])
                    for f in (_FACTOR, _UNFACTOR)
                )
        return cls.up, cls.down


class Words:
    """Word hashes of a batch of texts; the words of text i are hashes[first[i]:first[i + 1]]."""

    def __init__(self, texts: Texts, kind: np.ndarray, lower: bool = True):
        inside = kind[texts.data]
        cut = np.zeros(len(texts.data) + 1, bool)
        cut[texts.bounds] = True
        if len(inside):
            before = np.r_[False, inside[:-1]]
            after = np.r_[inside[1:], False]
            self.starts = np.flatnonzero(inside & (~before | cut[:-1]))
            self.ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
        else:
            self.starts = self.ends = np.empty(0, np.int64)
        self.first = np.searchsorted(self.starts, texts.bounds)
        self.data, self.values = texts.data, _LOWER_VALUES if lower else _BYTE_VALUES
        self.hashes = self._hashed(self.ends)

    def beginnings(self, size: int) -> np.ndarray:
        """Hashes of the first ``size`` bytes of each word, or of all of a shorter one."""
        return self._hashed(np.minimum(self.ends, self.starts + size))

    def _hashed(self, ends: np.ndarray) -> np.ndarray:
        out = np.empty(len(self.starts), np.uint64)
        i = 0
        while i < len(out):
            low = self.starts[i]
            j = max(i + 1, int(np.searchsorted(ends, low + HASH_BYTES, "right")))
            high = ends[j - 1]
            up, down = _Powers.to(int(high - low) + 1)
            sums = np.zeros(high - low + 1, np.uint64)
            np.cumsum(self.values[self.data[low:high]] * up[: high - low], out=sums[1:])
            s, e = self.starts[i:j] - low, ends[i:j] - low
            out[i:j] = mixed((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
            i = j
        return out


def chained(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k consecutive hashes."""
    n = len(hashes) - k + 1
    out = mixed(hashes[:n] + np.uint64(k))
    for j in range(1, k):
        out = mixed(out * _FACTOR + hashes[j : j + n])
    return out


def shingle_sets(words: Words, k: int) -> Iterator[np.ndarray]:
    """Per text, the sorted distinct hashes of its k-word shingles.

    A text of fewer words has its whole sequence as one shingle; one without words has none.
    """
    whole = chained(words.hashes, k) if len(words.hashes) >= k else None
    for a, b in zip(words.first[:-1], words.first[1:]):
        if b - a >= k:
            yield np.unique(whole[a : b - k + 1])
        elif b > a:
            yield chained(words.hashes[a:b], b - a)
        else:
            yield np.empty(0, np.uint64)


def binaries(rows: np.ndarray) -> pa.Array:
    """The rows of a two-dimensional array as binary values."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize if rows.ndim == 2 else 0
    bounds = pa.py_buffer(np.arange(len(rows) + 1, dtype=np.int32) * np.int32(width))
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, bounds, pa.py_buffer(rows)])

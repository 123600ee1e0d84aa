"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import drop_scratch, scratch_path

#: Fixed values of the contracts: a word is a run of characters outside space, tab..carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole(text) -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def crc_mod(key: str, m: int) -> Column:
    """crc32 of the key as text, modulo m; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % m


def per_worker(key, make):
    """What ``make()`` gives, made once in a Python worker process and kept over its tasks. (The modules here are
    pickled by value, so their own globals are new in every task.)"""
    box = sys.modules.setdefault("_tidewater_per_worker", types.ModuleType("_tidewater_per_worker")).__dict__
    if key not in box:
        box[key] = make()
    return box[key]


def hand_back() -> None:
    """Give the memory that a task no longer uses back to the system. Python workers are used again by later tasks, and would
    otherwise keep their largest batch for as long as the executor lives."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):        # a C library without it
        pass


#: shuffle files of a write are of no use once its result is on the shared disk
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: rows of an Arrow batch: a row can be a whole text, or two
BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "1000"


@contextmanager
def settings(spark: SparkSession, **values: str):
    """The session with these settings, and as it was afterwards."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a frame below the shared checkpoint folder and read it back: cuts the
    lineage, is computed once, and survives the loss of any executor. Spark removes the
    shuffle files of the write when it is done."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    with settings(spark, **{CLEAN: "true", BATCH: BATCH_ROWS}):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the folder of a frame that :func:`saved` gave and that nothing reads any more."""
    folders = {f.rpartition("/")[0] for f in df.inputFiles()}
    for folder in folders:
        if "/tidewater/llm-" in folder:
            drop_scratch(df.sparkSession, folder)


def whole_row(df: DataFrame, first: str) -> tuple[Column, Column]:
    """(the row as one struct, what to order rows by: ``first``, then the other columns that have an order). Maps have
    none, so rows that differ only there are in no order. As a struct a row keeps its columns, whatever names are added."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    ordered = [f.name for f in df.schema.fields if f.name != first and not any(x in f.dataType.simpleString() for x in ("map<", "variant"))]
    return row, F.struct(*[F.col(f"`{c}`") for c in (first, *ordered)])


class Ids(dict):
    """Words (bytes) to dense local ids, in order of first use."""

    def __missing__(self, word):
        i = self[word] = len(self)
        return i


def encode(texts, lower: bool = False, ids: Ids | None = None) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(ids of all words one after the other, words per text, the words by id).

    Words are split at ASCII white space, as :data:`WORD` does; ``lower`` folds A-Z;
    ``ids`` continues an earlier numbering.
    """
    ids, parts, lens = Ids() if ids is None else ids, [], []
    get = ids.__getitem__
    for t in texts:
        raw = (t or "").encode("utf-8", "surrogatepass")
        ws = (raw.lower() if lower else raw).split()
        lens.append(len(ws))
        parts.append(np.fromiter(map(get, ws), np.int32, len(ws)))
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    return flat, np.asarray(lens, np.int64), list(ids)


def flat_bytes(texts) -> tuple[np.ndarray, np.ndarray]:
    """(the bytes of all texts one after the other, the start of each text and the end of the last); null counts as empty.
    ``texts``: an Arrow array, whose buffer is not copied, or a list of str."""
    if not isinstance(texts, pa.Array):
        texts = pa.array([(t or "").encode("utf-8", "surrogatepass") for t in texts], pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(pa.scalar("", texts.type))
    kind = np.dtype(np.int64 if texts.type in (pa.large_string(), pa.large_binary()) else np.int32)
    _, at, data = texts.buffers()
    at = np.frombuffer(at, kind, len(texts) + 1, texts.offset * kind.itemsize).astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if at[-1] > at[0] else np.zeros(0, np.uint8)
    return (data[at[0]:at[-1]] if len(data) else data), at - at[0]


def binaries(data: np.ndarray, at: np.ndarray) -> pa.Array:
    """An Arrow array of the runs of ``data`` that start at ``at`` (one more for the end)."""
    buffers = [None, pa.py_buffer(np.ascontiguousarray(at, np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.large_binary(), len(at) - 1, buffers)


def arrow_blocks(texts: pa.Array, limit: int) -> Iterator[pa.Array]:
    """The texts in order, in slices of at most ``limit`` bytes (or one text)."""
    at, lo = flat_bytes(texts)[1], 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, "right")) - 1)
        yield texts.slice(lo, hi - lo)
        lo = hi


_INSIDE = ~np.isin(np.arange(256), [32, *range(9, 14)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def arrow_words(data: np.ndarray, at: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(all words one after the other, words per text) of texts as :func:`flat_bytes` gives them; as :func:`encode`
    splits them, but no word becomes a Python object."""
    inside = _INSIDE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    held = at[:-1] < at[1:]
    s, e = at[:-1][held], at[1:][held] - 1          # a text's ends are ends of words
    first[s], last[e] = inside[s], inside[e]
    begin = np.flatnonzero(first)
    return binaries(data[inside], starts_of(np.flatnonzero(last) + 1 - begin)), np.diff(np.searchsorted(begin, at))


def lower(words: pa.Array) -> pa.Array:
    """The words with A-Z folded."""
    data, at = flat_bytes(words)
    return binaries(_LOWER[data], at)


def starts_of(lens: np.ndarray) -> np.ndarray:
    """Start of each run, and the end of the last."""
    out = np.zeros(len(lens) + 1, np.int64)
    np.cumsum(lens, out=out[1:])
    return out


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (the finalizer of splitmix64), on uint64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def unit(x: np.ndarray) -> np.ndarray:
    """uint64 hashes to floats strictly between 0 and 1."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * (1.0 / (1 << 53))


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


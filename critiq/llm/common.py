"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from critiq.session import remove_path, scratch_path

#: A word of the contracts: a run of anything but space, \t, \n, \v, \f, \r.
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"
#: Whether an execution's shuffle files go when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes that part words.
SPACES = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(spark: SparkSession, df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back.

    Cuts the lineage: an executor lost later never makes the work above it run
    again, and rows that hold task-dependent numbers keep them. The write's shuffle files go
    with it, not when the driver happens to collect its garbage. The
    folder goes when the application ends.
    """
    path = scratch_path(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path, compression=compression)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.staged_path = path
    return table


def discard(spark: SparkSession, *tables: DataFrame) -> None:
    """Deletes ``staged`` tables that nothing reads again, neither the caller nor what it returns."""
    for table in tables:
        remove_path(spark, table.staged_path)


def per_worker(name: str, make):
    """``make()``, called once in each Python worker and kept for its later tasks."""
    import sys
    from types import ModuleType

    kept = sys.modules.setdefault("_kept_by_worker", ModuleType("_kept_by_worker")).__dict__
    if name not in kept:
        kept[name] = make()
    return kept[name]


def one_blas_thread() -> None:
    """Matrix products of this process take one thread: an executor's tasks share its cores already, and
    more threads would mostly wait for each other. Nothing happens where numpy brings no OpenBLAS of its own."""
    import ctypes
    import glob
    import os

    for path in glob.glob(os.path.join(os.path.dirname(os.path.dirname(np.__file__)), "numpy.libs", "*openblas*")):
        for name in ("scipy_openblas_set_num_threads64_", "openblas_set_num_threads64_", "openblas_set_num_threads"):
            if set_threads := getattr(ctypes.CDLL(path), name, None):
                set_threads(1)


def give_back() -> None:
    """Hands memory that a task has freed back to the system. Python workers live on for later tasks, and an executor
    holds several; without this each keeps what its largest task ever took."""
    import ctypes

    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(column: pa.Array) -> Iterator[bytes | None]:
    """The UTF-8 bytes of each row of a string column, None for null."""
    if column.null_count == len(column):
        yield from [None] * len(column)
        return
    if not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        column = column.cast(pa.large_string())
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], "<i8" if wide else "<i4")
    offsets = offsets[column.offset : column.offset + len(column) + 1].tolist()
    data = column.buffers()[2]
    data = memoryview(data) if data is not None else memoryview(b"")
    valid = column.is_valid().to_numpy(zero_copy_only=False) if column.null_count else None
    for i in range(len(column)):
        if valid is not None and not valid[i]:
            yield None
        else:
            yield bytes(data[offsets[i] : offsets[i + 1]])


def words_in(texts: list[bytes | None], table: bytes | None = None) -> tuple[pa.Array, np.ndarray]:
    """The words of texts (translated by ``table``), end to end, and how many each has."""
    data = np.frombuffer(b"\n".join([x or b"" for x in texts]).translate(table), np.uint8)
    keep = ~SPACES[data]
    begins = keep.copy()
    begins[1:] &= ~keep[:-1]
    letters = data[keep]
    offsets = np.r_[np.flatnonzero(begins[keep]), len(letters)]
    ends = np.cumsum([len(x or b"") + 1 for x in texts])
    many = np.diff(np.searchsorted(np.flatnonzero(begins), ends), prepend=0)
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(letters)]), many


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows, for work that holds many Python objects for each row."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    batch = None
    give_back()


def n_words(text: Column) -> Column:
    """Words of a text; null counts none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def sorted_groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[pa.RecordBatch]:
    """Batches of a partition sorted by its first ``n_keys`` columns, cut again so
    that no group of equal keys is split between two of them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = [batch.column(k)[batch.num_rows - 1] for k in range(n_keys)]
        if held and all(held[0].column(k)[0].equals(last[k]) for k in range(n_keys)):
            held.append(batch)
            continue
        keys = np.ones(batch.num_rows, bool)
        for k in range(n_keys):
            column = batch.column(k)
            keys &= np.asarray(
                pc.equal(column, last[k]).fill_null(False)
                if last[k].is_valid
                else column.is_null()
            )
        cut = int(np.argmax(keys))
        if cut or held:
            yield pa.concat_batches([*held, batch.slice(0, cut)])
        held = [batch.slice(cut)]
    if held:
        yield pa.concat_batches(held)
    held = batch = None
    give_back()

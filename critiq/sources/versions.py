"""Folders that are replaced as a whole, in one step.

A versioned folder holds its data in sub-folders (``v-...``), each written once, and numbered pointer
files in ``_pointer``. The pointer of the highest number says what is current. Publishing
is one rename: a complete pointer file appears under the next number. A reader sees the old state or
the new one, never neither, and what it has resolved stays: data goes only when no pointer of the
last ``KEEP`` names it. Two writers that publish at once collide on the number, and the second one fails.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

#: Pointers that stay, the current one included.
KEEP = 2
POINTERS = "_pointer"


class PublishConflict(RuntimeError):
    """Another writer has published in the meantime."""


def _path(spark: SparkSession, *parts: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join(p.rstrip("/") for p in parts))


def _fs(spark: SparkSession, path):
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def new_version(path: str) -> str:
    """The path of a version to be written under ``path``."""
    return f"{path.rstrip('/')}/v-{uuid.uuid4().hex[:16]}"


def pointers(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the pointer files of ``path``, ascending."""
    folder = _path(spark, path, POINTERS)
    fs = _fs(spark, folder)
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n) for n in names if n.isdigit())


def _read(spark: SparkSession, path: str, number: int) -> str:
    file = _path(spark, path, POINTERS, f"{number:012d}")
    stream = _fs(spark, file).open(file)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def current(spark: SparkSession, path: str) -> tuple[int, str | None]:
    """(number, content) of the current pointer; (0, None) if nothing is published."""
    for attempt in range(3):  # a pointer can go between listing and reading, when newer ones are there
        numbers = pointers(spark, path)
        if not numbers:
            return 0, None
        try:
            return numbers[-1], _read(spark, path, numbers[-1])
        except Exception:
            if attempt == 2:
                raise
    return 0, None


def publish(spark: SparkSession, path: str, content: str, after: int) -> int:
    """Make ``content`` current, if pointer ``after`` still is; gives the new number."""
    jvm = spark.sparkContext._jvm
    number = after + 1
    draft = _path(spark, path, POINTERS, f".draft-{uuid.uuid4().hex}")
    target = _path(spark, path, POINTERS, f"{number:012d}")
    fs = _fs(spark, target)
    out = fs.create(draft, False)
    try:
        out.write(bytearray(content.encode()))
    finally:
        out.close()
    options = jvm.org.apache.hadoop.fs.Options.Rename
    none = spark.sparkContext._gateway.new_array(options, 1)
    none[0] = options.NONE  # refuses to replace a file
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        if pointers(spark, path)[-1:] not in ([after], []):
            raise PublishConflict(f"{path}: pointer {after} is no longer current")
        context.rename(fs.makeQualified(draft), fs.makeQualified(target), none)
    except PublishConflict:
        fs.delete(draft, False)
        raise
    except Exception as exc:
        fs.delete(draft, False)
        if fs.exists(target):
            raise PublishConflict(f"{path}: pointer {number} exists already") from exc
        raise
    return number


def clean(spark: SparkSession, path: str, named_by) -> list[str]:
    """Delete old pointers, and versions that none of the last ``KEEP`` pointers names.

    ``named_by(content)`` gives the version folders' names in a pointer. Only versions that an old pointer
    named are deleted, so one that another writer has not published yet stays. Gives what went.
    """
    numbers = pointers(spark, path)
    old, kept = numbers[:-KEEP], numbers[-KEEP:]
    if not old:
        return []
    needed = {v for n in kept for v in named_by(_read(spark, path, n))}
    gone = sorted({v for n in old for v in named_by(_read(spark, path, n))} - needed)
    for version in gone:
        folder = _path(spark, path, version)
        _fs(spark, folder).delete(folder, True)
    for n in old:
        file = _path(spark, path, POINTERS, f"{n:012d}")
        _fs(spark, file).delete(file, False)
    return gone

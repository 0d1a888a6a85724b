"""WARC archives with a two-level capture index.

``write_archive`` writes one WARC record for each page, each its own gzip member. Of
records with equal payloads the one with the smallest page_id is a ``response``, the others
are ``revisit`` records without payload that refer to it. The capture index has a line for each
record: its reversed-host URL key, then where the record is. Lines are sorted by key and
compressed in blocks of ``block_lines``; a sparse directory holds each block's first
key and place. ``find`` binary-searches the directory by range reads, fetches only the blocks
that can hold a key, and from them the byte ranges of the records.

Everything lies in ``root``, a folder that all executors reach (``file:``, ``hdfs:``, ``s3:`` or
``gs:``, whatever pyarrow opens), by default under the cluster's shared folder. A
task writes files of its own name; the tables that name files are written by Spark, so
a lost or repeated attempt leaves files that nothing refers to. A part of the index is one
range of keys; the list of the parts' first keys is as long as the index has parts, and is the only
thing held in memory.

Defined cases: a null html is an empty payload, equal to other empty ones; a null URL has
the empty key; a null page_id counts as larger than any other, and where all rows of a payload
have none, each is a response; rows that share the smallest page_id of a payload
are all responses; rows that repeat another are written and read back as often as they
are there; an empty table gives an empty archive and result; other columns are ignored.
"""

from __future__ import annotations

import json
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from critiq.llm.common import shuffle_partitions, sorted_groups, staged
from critiq.session import scratch_path

BLOCK_LINES = 1024
DATE = "2024-01-01T00:00:00Z"
GZIP_LEVEL = 6
#: Bytes of a directory that one range read fetches.
WINDOW = 4096
#: Records whose places fall in the same so many bytes of a file are read by one task.
SPAN = 1 << 26

RECORDS = "page_id long, url string, record_type string, payload_digest string, refers_to long, payload binary"


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels in reverse, lower case, then the path and query."""
    rest = (url or "").partition("#")[0]
    _, mark, after = rest.partition("://")
    rest = after if mark else rest
    if not rest:
        return ""
    cut = min((i for i in map(rest.find, "/?") if i >= 0), default=len(rest))
    host = ",".join(reversed(rest[:cut].lower().split(".")))
    return "".join(f"%{ord(c):02X}" if c <= " " or c == "\x7f" else c for c in f"{host}){rest[cut:] or '/'}")


def _open(root: str):
    """(file system, path) of a URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(root)


def _base32_sha1(payload: bytes) -> str:
    import base64
    import hashlib

    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def warc_record(page_id, url: str | None, payload: bytes, digest: str, holder=None) -> bytes:
    """A response record, or a revisit of ``holder`` if that is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if holder is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if holder is None else 'revisit'}"]
    head += [f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + json.dumps(url, ensure_ascii=False)[1:-1])
    if holder is not None:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:x-page:{holder}>")
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(member: bytes) -> dict:
    """The fields of a gzip member that holds one record; a response's payload must match its digest."""
    import zlib

    record = zlib.decompress(member, 31)
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if kind == "response" and _base32_sha1(payload) != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    number = lambda uri: int(n) if (n := uri[len("<urn:x-page:") : -1]) else None
    return {
        "page_id": number(fields["WARC-Record-ID"]),
        "url": json.loads(f'"{fields["WARC-Target-URI"]}"') if "WARC-Target-URI" in fields else None,
        "record_type": kind,
        "payload_digest": digest,
        "refers_to": number(fields["WARC-Refers-To"]) if "WARC-Refers-To" in fields else None,
        "payload": payload if kind == "response" else None,
    }


@dataclass(frozen=True)
class Archive:
    root: str
    #: (first key, directory file, bytes of it) of each part of the index, by key.
    parts: tuple[tuple[str, str, int], ...]


def payload_holders(pages: DataFrame, min_bytes: int) -> DataFrame:
    """``digest, size, holder``: the smallest page_id of each payload that several rows have."""
    return (
        pages.select("page_id", "digest", "size")
        .where(F.col("size") >= min_bytes)
        .groupBy("digest", "size")
        .agg(F.min("page_id").alias("holder"), F.count("*").alias("n"))
        .where("n > 1 and holder is not null")
        .drop("n")
    )


def write_archive(
    spark: SparkSession, pages: DataFrame, root: str | None = None, min_bytes: int = 0, block_lines: int = BLOCK_LINES
) -> Archive:
    """Write ``pages`` (page_id, url, html). Payloads under ``min_bytes`` are all responses.

    Only (digest, page_id) is shuffled to find equal payloads, after a partial aggregate.
    The table of shared payloads is written first, so Spark broadcasts it if its file size allows,
    and else joins by shuffle with hot digests split.
    """
    if root is None:
        root = scratch_path(spark, "warc")
    for name in ("records", "index"):
        files, path = _open(f"{root}/{name}")
        files.create_dir(path, recursive=True)
    text = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long"), "url", F.encode(text, "UTF-8").alias("payload"), F.octet_length(text).alias("size")
    ).withColumn("digest", F.unhex(F.sha1("payload")))
    holders = staged(spark, payload_holders(rows, min_bytes), "holders").withColumnsRenamed({"digest": "d", "size": "s"})
    joined = rows.join(holders, (F.col("digest") == F.col("d")) & (F.col("size") == F.col("s")), "left")
    revisit = F.col("holder").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("holder"))
    joined = joined.select("page_id", "url", "payload", "digest", F.when(revisit, F.col("holder")).alias("holder"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import base64
        import zlib

        from pyspark import TaskContext

        task = TaskContext.get()
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz"
        files, path = _open(f"{root}/records")
        out, at = None, 0
        try:
            for batch in batches:
                lines = []
                for page_id, url, payload, digest, holder in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    out = out or files.open_output_stream(f"{path}/{name}", compression=None)
                    shown = base64.b32encode(digest).decode()
                    packer = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
                    member = packer.compress(warc_record(page_id, url, payload, shown, holder)) + packer.flush()
                    out.write(member)
                    lines.append((url_key(url), name, at, len(member)))
                    at += len(member)
                columns = list(zip(*lines, strict=True)) or [(), (), (), ()]
                kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["key", "file", "at", "length"]
                )
        finally:
            if out:
                out.close()

    captures = staged(spark, joined.mapInArrow(write, "key string, file string, at long, length long"), "captures")
    return _write_index(spark, captures, root, block_lines)


def _write_index(spark: SparkSession, captures: DataFrame, root: str, block_lines: int) -> Archive:
    """Sort the captures into compressed blocks and their directories. The sort's ranges are cut by
    key and place, so one URL with a third of all captures fills many parts."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        from pyspark import TaskContext

        task = TaskContext.get()
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
        files, path = _open(f"{root}/index")
        blocks = directory = first = None
        at = size = 0
        held: list[str] = []

        def flush(lines: list[str]) -> None:
            nonlocal at, size
            packed = zlib.compress("".join(lines).encode(), GZIP_LEVEL)
            blocks.write(packed)
            entry = f"{lines[0].partition(' ')[0]}\t{at}\t{len(packed)}\n".encode()
            directory.write(entry)
            at, size = at + len(packed), size + len(entry)

        for batch in batches:
            if batch.num_rows and blocks is None:
                blocks = files.open_output_stream(f"{path}/{name}.blocks", compression=None)
                directory = files.open_output_stream(f"{path}/{name}.directory", compression=None)
                first = batch.column(0)[0].as_py()
            for key, file, place, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(f"{key} {file} {place} {length}\n")
                if len(held) == block_lines:
                    flush(held)
                    held = []
        if held:
            flush(held)
        if blocks:
            blocks.close()
            directory.close()
            yield pa.RecordBatch.from_arrays([pa.array([first]), pa.array([name]), pa.array([size])], ["key", "name", "size"])

    parts = (
        captures.repartitionByRange(shuffle_partitions(spark), "key", "file", "at")
        .sortWithinPartitions("key", "file", "at")
        .mapInArrow(write, "key string, name string, size long")
    )
    table = f"{root}/parts"
    parts.write.parquet(table)
    return open_archive(spark, root)


def open_archive(spark: SparkSession, root: str) -> Archive:
    rows = spark.read.schema("key string, name string, size long").parquet(f"{root}/parts").collect()
    # parts that begin with the same key are in the order of their names
    return Archive(root, tuple(sorted(((r["key"], r["name"], r["size"]) for r in rows), key=lambda p: (p[0].encode(), p[1]))))


def directory_entries(file, size: int, key: bytes) -> Iterator[tuple[int, int]]:
    """(place, bytes) of the blocks that can hold ``key``: the last that begins before it and all that begin
    with it. Halves the directory by range reads, then reads on from there."""

    def line_from(at: int) -> tuple[int, bytes]:
        """The first whole line that begins at or after byte ``at``: its beginning, its key."""
        if at:
            at -= 1  # a line begins after a line end
            while at < size:
                window = file.read_at(min(WINDOW, size - at), at)
                end = window.find(b"\n")
                at += end + 1 if end >= 0 else len(window)
                if end >= 0:
                    break
        text = b""
        while at + len(text) < size and b"\t" not in text:
            text += file.read_at(min(WINDOW, size - at - len(text)), at + len(text))
        return at, text.partition(b"\t")[0]

    low, high = 0, size  # the line at low begins before the key, or is the first; none at or after high does
    while high - low > 1:
        middle = (low + high) // 2
        at, found = line_from(middle)
        if at < size and found < key:
            low = max(at, middle)
        else:
            high = middle
    at, rest = line_from(low)[0], b""
    while at < size:
        window = file.read_at(min(WINDOW, size - at), at)
        at += len(window)
        *lines, rest = (rest + window).split(b"\n")
        for line in lines:
            first, place, length = line.split(b"\t")
            if first > key:
                return
            yield int(place), int(length)


def find_blocks(archive: Archive, keys) -> Iterator[tuple[str, str, int, int]]:
    """(key, part, place, bytes) of every block that can hold one of ``keys``."""
    files, path = _open(f"{archive.root}/index")
    firsts = [p[0].encode() for p in archive.parts]
    opened: dict[str, object] = {}
    for key in keys:
        raw = key.encode()
        at = max(0, bisect_left(firsts, raw) - 1)  # the last part that begins before the key
        while at < len(firsts) and firsts[at] <= raw:
            _, name, size = archive.parts[at]
            if name not in opened:
                opened.clear()  # keys come in order: one directory at a time
                opened[name] = files.open_input_file(f"{path}/{name}.directory")
            for place, length in directory_entries(opened[name], size, raw):
                yield key, name, place, length
            at += 1


def find(spark: SparkSession, archive: Archive, keys: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records (``RECORDS`` and payload_bytes) of all captures whose key is in ``keys`` (one string column).

    Three steps, each dealt out anew: keys to blocks, blocks to record places (a block is unpacked
    once for all its keys), places to records. A URL captured very often is many blocks and many
    places, spread over tasks.
    """
    n = shuffle_partitions(spark)
    asked = keys.toDF("key").where("key is not null").distinct().repartitionByRange(n, "key").sortWithinPartitions("key")

    def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(find_blocks(archive, batch.column(0).to_pylist()))
            columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
            kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "part", "place", "size"])

    def to_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        files, path = _open(f"{archive.root}/index")
        for batch in sorted_groups(batches, 2):
            wanted: dict[tuple[str, int, int], set[str]] = {}
            for part, place, size, key in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                wanted.setdefault((part, place, size), set()).add(key)
            for (part, place, size), own in wanted.items():
                with files.open_input_file(f"{path}/{part}.blocks") as file:
                    lines = zlib.decompress(file.read_at(size, place)).decode().split("\n")[:-1]
                rows = [line.rsplit(" ", 3) for line in lines]
                rows = [(f, int(a), int(n)) for key, f, a, n in rows if key in own]
                columns = list(zip(*rows, strict=True)) or [(), (), ()]
                kinds = (pa.string(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["file", "at", "length"]
                )

    def to_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = _open(f"{archive.root}/records")
        name = file = None
        kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.int64()]
        names = [f.split()[0] for f in RECORDS.split(", ")] + ["payload_bytes"]
        for batch in batches:
            rows, held = [], 0

            def out() -> pa.RecordBatch:
                columns = list(zip(*rows, strict=True)) or [()] * len(names)  # noqa: B023
                return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

            for part, at, length in zip(*(c.to_pylist() for c in batch.columns[:3]), strict=True):
                if part != name:
                    name, file = part, files.open_input_file(f"{path}/{part}")
                r = parse_record(file.read_at(length, at))
                size = None if r["payload"] is None else len(r["payload"])
                if not with_payload:
                    r["payload"] = None
                rows.append((*r.values(), size))
                held += len(r["payload"] or b"")
                if held > WINDOW * WINDOW:
                    yield out()
                    rows, held = [], 0
            yield out()

    places = (
        asked.mapInArrow(to_blocks, "key string, part string, place long, size long")
        .select("part", "place", "size", "key")
        .repartition(n, "part", "place")
        .sortWithinPartitions("part", "place")
        .mapInArrow(to_places, "file string, at long, length long")
    )
    span = F.floor(F.col("at") / F.lit(SPAN))
    return (
        places.repartition(n, "file", span)
        .sortWithinPartitions("file", "at")
        .mapInArrow(to_records, f"{RECORDS}, payload_bytes long")
    )


def url_keys(pages: DataFrame) -> DataFrame:
    """``key``: the distinct keys of the pages' URLs."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [url_key(u) for u in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string())], ["key"])

    return pages.select("url").distinct().mapInArrow(each, "key string").distinct()


def archive_round_trip(spark: SparkSession, pages: DataFrame, **how) -> DataFrame:
    """Write ``pages`` and read every page back through the index: ``page_id, payload_bytes,
    payload_digest, record_type, refers_to, url``. A revisit's size is that of the response it refers to."""
    archive = write_archive(spark, pages, **how)
    read = staged(spark, find(spark, archive, url_keys(pages), with_payload=False).drop("payload"), "records")
    full = (
        read.where("record_type = 'response'")
        .groupBy(F.col("page_id").alias("holder"), F.col("payload_digest").alias("d"))
        .agg(F.max("payload_bytes").alias("size"))
    )
    same = (F.col("refers_to") == F.col("holder")) & (F.col("payload_digest") == F.col("d"))
    return read.join(full, same, "left").select(
        "page_id", F.coalesce("payload_bytes", "size").alias("payload_bytes"), "payload_digest", "record_type", "refers_to", "url"
    )

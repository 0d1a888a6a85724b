"""Session helpers: building a local session and locating the shared folder.

Intermediate tables and round-trip outputs go under the cluster's shared
checkpoint folder (``spark.checkpoint.dir``), never a machine-local temp
folder. Only a local-mode session without that setting (tests, bench) gets
a folder of its own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(
    master: str = "local[*]",
    shuffle_partitions: int = 8,
    app_name: str = "critiq",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session for tests and the bench: UI off, AQE on, session zone UTC."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of this application.

    Uses the folder the cluster names in ``spark.checkpoint.dir``. When it is
    unset, a local-mode session gets a fresh folder under the system temp dir;
    a cluster session without it is a configuration error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - key absent
            configured = None
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a cluster run needs a shared folder for "
                "intermediate tables"
            )
        configured = tempfile.mkdtemp(prefix="critiq-checkpoint-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared folder.

    Everything under it goes when the application ends.
    """
    base = f"{shared_root(spark).rstrip('/')}/critiq"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(target)
    fs.deleteOnExit(target)
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def input_bytes(df) -> int:
    """Bytes of the files (or relations) a DataFrame scans: the sum of the size
    statistics of its plan's leaves. Unlike the root estimate (a product
    for joins without CBO), this tracks the actual input."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def shuffle_partitions_for(df, input_bytes_per_partition: int = 1 << 30, current: int = 0) -> int:
    """Shuffle partitions for a full shuffle of ``df``: one per
    ``input_bytes_per_partition`` of input, never fewer than ``current``.

    For whoever owns the session to set before a run. A window's partitions cannot be split later,
    and small ones are coalesced; but map tasks times partitions is the number of shuffle
    blocks, so at 100 TB raise ``spark.sql.files.maxPartitionBytes`` too, or merge blocks on the
    push side.
    """
    return max(current, -(-input_bytes(df) // input_bytes_per_partition))


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder of the shared file system (recursively), if present."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(target) and fs.delete(target, True))


def move_only_file(spark: SparkSession, folder: str, target: str) -> None:
    """Move the one data file that a write left in ``folder`` to the path ``target``, in place of what is there."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    source, goal = jvm.org.apache.hadoop.fs.Path(folder), jvm.org.apache.hadoop.fs.Path(target)
    fs = goal.getFileSystem(conf)
    files = [s.getPath() for s in fs.listStatus(source) if s.getPath().getName().startswith("part-")]
    if len(files) != 1:
        raise OSError(f"{folder} holds {len(files)} data files, not one")
    options = jvm.org.apache.hadoop.fs.Options.Rename
    overwrite = spark.sparkContext._gateway.new_array(options, 1)
    overwrite[0] = options.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
    context.rename(fs.makeQualified(files[0]), fs.makeQualified(goal), overwrite)


def rename_children(spark: SparkSession, folder: str, prefix: str, new_prefix: str) -> None:
    """Rename the direct children of ``folder`` that begin with ``prefix``."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for child in fs.listStatus(path):
        name = child.getPath().getName()
        if name.startswith(prefix):
            fs.rename(child.getPath(), jvm.org.apache.hadoop.fs.Path(path, new_prefix + name[len(prefix) :]))


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme, for local-only checks in tests."""
    if path.startswith("file:"):
        path = path[len("file:") :]
        while path.startswith("//"):
            path = path[1:]
    return os.path.normpath(path)

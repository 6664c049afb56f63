"""Session settings and the shared scratch folder."""

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path
from types import ModuleType

from pyspark.sql import SparkSession

import vitaelake

# A shuffle partition for every 256 MB of stored input.
BYTES_PER_SHUFFLE_PARTITION = 256 << 20

# Whether a query's shuffle files go when it ends; else they stay until the driver collects its garbage.
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_shipped: set[tuple[str, str]] = set()


def spark_session(name: str = "vitaelake", master: str | None = None, **settings) -> SparkSession:
    """A session with the settings the jobs count on, whose tasks can import this package."""
    builder = (
        SparkSession.builder.appName(name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    session = builder.getOrCreate()
    ship_packages(session, vitaelake)
    return session


def scratch_location(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared checkpoint folder, for staged tables.

    Every executor must reach it, so only a local session may fall back to this machine's
    temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        root = tempfile.mkdtemp(prefix="vitaelake-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/vitaelake/{label}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, location: str):
    """A path and the file system it lives on."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def drop_scratch(spark: SparkSession, folder: str) -> None:
    """Delete a staged table that no output needs any more."""
    path, files = hadoop_path(spark, folder)
    files.delete(path, True)


def stored_bytes(spark: SparkSession, *locations: str) -> int:
    """Size of the files below the locations, from their listing; 0 for a missing one."""
    total = 0
    for location in locations:
        path, files = hadoop_path(spark, location)
        if files.exists(path):
            total += files.getContentSummary(path).getLength()
    return total


@contextmanager
def shuffles_sized_for(spark: SparkSession, *locations: str) -> Iterator[None]:
    """Enough shuffle partitions for these inputs, for what is run inside.

    Adaptive execution merges partitions that turn out small, but cannot split one that a
    window or an aggregation finds too large, so their number must grow with the data. It is
    never lowered below the session's own.
    """
    key = "spark.sql.shuffle.partitions"
    own = spark.conf.get(key)
    needed = -(-stored_bytes(spark, *locations) // BYTES_PER_SHUFFLE_PARTITION)
    spark.conf.set(key, str(max(int(own), needed)))
    try:
        yield
    finally:
        spark.conf.set(key, own)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of every query that is run inside go as soon as it ends.

    For writes: their plans are made anew for each, so nothing reads those files again. Without it
    the shuffles of many steps lie on the disks beside each other.
    """
    own = spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if own is None:
            spark.conf.unset(_SHUFFLE_CLEANUP)
        else:
            spark.conf.set(_SHUFFLE_CLEANUP, own)


def ship_packages(spark: SparkSession, *packages: ModuleType) -> None:
    """Let the tasks of a session import the packages, once per application.

    The same as naming them in ``--py-files``; nothing to do where they are installed.
    """
    application = spark.sparkContext.applicationId
    for package in packages:
        if (application, package.__name__) in _shipped:
            continue
        source = Path(package.__file__).parent
        target = f"{tempfile.mkdtemp(prefix='vitaelake-ship-')}/{package.__name__}"
        archive = shutil.make_archive(target, "zip", source.parent, source.name)
        spark.sparkContext.addPyFile(archive)
        _shipped.add((application, package.__name__))

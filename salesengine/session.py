"""Session settings and the shared folder for results that are read twice."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from contextvars import ContextVar
from typing import Any

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # The JIT leaves methods above 8000 bytes interpreted. The cleaning projection is
    # longer than that as one method, and runs twice as fast split into several.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Lists of this many keys reach the Bloom filters of a scan.
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
}


HUGE_METHODS = "spark.sql.codegen.hugeMethodLimit"


def split_huge_methods(spark: SparkSession) -> None:
    """Set the limit on generated methods where a session still has Spark's default of 65535.

    It is read when a plan runs, so it must hold until the results are there.
    """
    if int(spark.conf.get(HUGE_METHODS)) == 65535:
        spark.conf.set(HUGE_METHODS, SETTINGS[HUGE_METHODS])


def local_session(
    app: str, cores: str | int = "*", shuffle_partitions: int = 8, memory: str = "8g"
) -> SparkSession:
    """A local session for tests and the bench; on a cluster use spark-submit."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session, which has no other machine, may leave it unset.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    # Beside the tables of the same session, not in a folder of one machine's own.
    folder = spark.conf.get("spark.sql.warehouse.dir", "spark-warehouse").rstrip("/") + "/_scratch"
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def located(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """The Hadoop file system of a path, and the path."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def path_exists(spark: SparkSession, path: str) -> bool:
    files, location = located(spark, path)
    return bool(files.exists(location))


def join_parts(spark: SparkSession, folder: str, path: str, head: bytes) -> None:
    """One file of ``head`` and the part files of ``folder`` in their order.

    A file system that can concatenate takes the parts over without reading them; elsewhere
    their bytes are copied in blocks, and no row is looked at.
    """
    files, source = located(spark, folder)
    names = sorted(
        s.getPath().toString()
        for s in files.listStatus(source)
        if s.getPath().getName().startswith("part-") and s.getLen()
    )
    parts = [located(spark, name)[1] for name in names]
    target = located(spark, path)[1]
    files.mkdirs(target.getParent())
    out = files.create(target, True)
    try:
        out.write(bytearray(head))
        if not files.hasPathCapability(target, "fs.capability.paths.concat"):
            copy = spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.copyBytes
            for part in parts:
                stream = files.open(part)
                try:
                    copy(stream, out, 1 << 20, False)
                finally:
                    stream.close()
            return
    finally:
        out.close()
    if parts:
        gateway = spark.sparkContext._gateway
        listed = gateway.new_array(gateway.jvm.org.apache.hadoop.fs.Path, len(parts))
        for i, part in enumerate(parts):
            listed[i] = part
        files.concat(target, listed)


DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of each query that runs inside as soon as it has ended.

    For writes, whose frames nobody runs again. Spark else keeps the files until the driver
    happens to collect its garbage, so that a load of several writes holds those of all.
    """
    before = spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, before)


_open_scratch: ContextVar[list[str] | None] = ContextVar("open_scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete what ``materialize`` stores inside, once the block has written its result."""
    paths: list[str] = []
    token = _open_scratch.set(paths)
    try:
        yield
    finally:
        _open_scratch.reset(token)
        for path in paths:
            files, location = located(spark, path)
            files.delete(location, True)


_swept: set[str] = set()


def _application_folder(spark: SparkSession) -> str:
    """This application's own folder in the shared one, deleted when its driver ends."""
    context = spark.sparkContext
    folder = f"{checkpoint_dir(spark).rstrip('/')}/salesengine-{context.applicationId}"
    if folder not in _swept:
        _swept.add(folder)
        atexit.register(_sweep, *located(spark, folder))
    return folder


def _sweep(files: Any, folder: Any) -> None:
    with suppress(Exception):  # the JVM may be gone by then
        files.delete(folder, True)


def scratch_path(spark: SparkSession) -> str:
    """A new place in the shared folder."""
    path = f"{_application_folder(spark)}/{uuid.uuid4().hex}"
    paths = _open_scratch.get()
    if paths is not None:
        paths.append(path)
    return path


#: For stores of whole loads, which are read a few times and then deleted.
PACKED = {"compression": "zstd"}


def materialize(df: DataFrame, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder, with the ``options`` of the writer, and read it back.

    For results with several readers: the work behind them runs once, a lost
    executor costs nothing but a re-read, and the file sizes tell Catalyst
    whether a side is small enough to broadcast. The frame stays readable until
    the surrounding ``scratch`` block ends, and without one until the driver does.
    """
    path = scratch_path(df.sparkSession)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

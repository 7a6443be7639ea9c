"""Session defaults and the shared folder for written intermediate tables."""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from contextvars import ContextVar
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.sources.fs import make_parent, open_fs

_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_SMALL_BATCH = "2m"
# Keeps a stream's state on the executors' disks instead of in their heaps.
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_LOCAL_SHARED: dict[str, str] = {}
_SHIPPED: set[str] = set()
_WORK: ContextVar[str | None] = ContextVar("work folder", default=None)


def build_session(app: str, master: str | None = None, shuffle_partitions: int | None = None,
                  settings: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings the operators expect, and more on request.

    Speculation stays off: a copy or a move is a side effect, and a second
    attempt of a healthy task would do the work twice.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.speculation", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKS_DB)
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for name, value in (settings or {}).items():
        builder = builder.config(name, value)
    return ship_package(builder.getOrCreate())


def ship_package(spark: SparkSession) -> SparkSession:
    """Give the executors this package by way of the shared folder, once per application.

    Not needed where the package is installed on every node.
    """
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED and has_shared_folder(spark):
        _SHIPPED.add(app)
        package = Path(__file__).parent
        zipped = io.BytesIO()
        with zipfile.ZipFile(zipped, "w", zipfile.ZIP_DEFLATED) as archive:
            for module in sorted(package.rglob("*.py")):
                archive.write(module, module.relative_to(package.parent))
        uri = f"{shared_folder(spark)}/package-{uuid.uuid4().hex}/{package.name}.zip"
        files, path = open_fs(uri)
        make_parent(files, path)
        with files.open_output_stream(path, compression=None) as stream:
            stream.write(zipped.getvalue())
        spark.sparkContext.addPyFile(uri)
    return spark


def has_shared_folder(spark: SparkSession) -> bool:
    named = spark.conf.get("spark.checkpoint.dir", None)
    return bool(named) or spark.sparkContext.master.startswith("local")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local session without the setting gets a folder of its own; on a
    cluster a machine-local folder would be lost with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return qualify(spark, named.rstrip("/"))
    if not has_shared_folder(spark):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SHARED:
        _LOCAL_SHARED[app] = tempfile.mkdtemp(prefix="tidemark-")
    return _LOCAL_SHARED[app]


def qualify(spark: SparkSession, uri: str) -> str:
    """Name the file system of a bare path where the cluster's default is not the local one.

    Spark reads a bare path there too, so tasks have to look in the same place.
    """
    if ":/" in uri:
        return uri
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS")
    return uri if default.startswith("file:") else default.rstrip("/") + uri


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses; not created yet."""
    return f"{_WORK.get() or shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def work_folder(spark: SparkSession) -> Iterator[str]:
    """Intermediate tables written meanwhile go to one folder, which is removed at the end.

    What is needed longer has to be written elsewhere before.
    """
    folder = new_folder(spark, "work")
    token = _WORK.set(folder)
    try:
        yield folder
    finally:
        _WORK.reset(token)
        files, path = open_fs(folder)
        with suppress(FileNotFoundError):
            files.delete_dir(path)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Rows that hold contents reach Python 2 MiB at a time, not in batches of the usual size.

    A batch lies in memory beside the heap, twice its size while it grows, once per running task.
    """
    before = spark.conf.get(_BATCH_BYTES, None)
    spark.conf.set(_BATCH_BYTES, _SMALL_BATCH)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_BATCH_BYTES)
        else:
            spark.conf.set(_BATCH_BYTES, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, so the plan behind it (and any side effect in it) runs
    once, and the result outlives the executors that made it.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def literal_rows(spark: SparkSession, rows: list[tuple], schema: StructType) -> DataFrame:
    """A few known rows as part of the plan, without a Python job to make them."""
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def read_table(spark: SparkSession, uri: str, schema: StructType, base: str | None = None) -> DataFrame:
    """Read a parquet table, or one partition of the table at ``base``; one not written yet is empty."""
    reader = spark.read.schema(schema)
    if base:
        reader = reader.option("basePath", base)
    try:
        return reader.parquet(uri)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return literal_rows(spark, [], schema)

"""Session helpers: settings, the shared working folder, written intermediates, sized broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECKPOINT_DIR = "spark.checkpoint.dir"

# One scratch folder per local application; removed by tempfile when Python exits.
_local_scratch: dict[str, tempfile.TemporaryDirectory] = {}


def build_session(app_name: str = "wardloom", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings the plans in this package count on.

    Adaptive execution splits skewed join partitions and sizes shuffles at run time. Extra
    settings are passed by keyword with dots written as double underscores.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.driver.host", "127.0.0.1").config("spark.ui.enabled", "false")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder; on a cluster a
    machine-local folder would be lost with its machine, so there it is an error.
    """
    sc = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_DIR, None) or sc.getConf().get(CHECKPOINT_DIR) or sc.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    if sc.applicationId not in _local_scratch:
        _local_scratch[sc.applicationId] = tempfile.TemporaryDirectory(prefix="wardloom-")
    return _local_scratch[sc.applicationId].name


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new path (not yet created) below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_open_owners: ContextVar[tuple["Intermediates", ...]] = ContextVar("open_owners", default=())


class Intermediates:
    """Owns what ``materialize`` writes while it is open, and deletes the files when it ends.

    For work that ends in a write::

        with Intermediates(spark):
            table.append(doctor_notes(...))

    A frame that is read after the work is passed to ``keep``: folders that it reads stay, and belong to the owner
    around this one; without one they still belong to this one, until ``release``.
    """

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._folders: list[str] = []
        self._readers: tuple[DataFrame, ...] = ()

    def __enter__(self) -> "Intermediates":
        self._token = _open_owners.set((*_open_owners.get(), self))
        return self

    def __exit__(self, *failure: object) -> None:
        _open_owners.reset(self._token)
        self.release(*self._readers)
        if _open_owners.get():
            _open_owners.get()[-1]._folders += self._folders
            self._folders = []

    def keep(self, *readers: DataFrame) -> None:
        """Frames that will be read after the end."""
        self._readers = readers

    def release(self, *readers: DataFrame) -> None:
        """Delete the folders that none of ``readers`` reads."""
        read = {file for reader in readers for file in reader.inputFiles()} if self._folders else set()
        kept = [f for f in self._folders if any(_name(f) in file for file in read)]
        for folder in self._folders:
            if folder not in kept:
                delete_folder(self._spark, folder)
        self._folders = kept


def _name(folder: str) -> str:
    """The last part of a folder from ``fresh_dir``, which no other path holds."""
    return f"/{folder.rsplit('/', 1)[-1]}/"


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files behind a write are deleted as soon as the write ends."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def materialize(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage so that later plans see the same rows even after lost executors, and gives
    the optimizer true file sizes to choose joins by. What was written does not need its shuffles
    again, so their files are given free as soon as the write ends. The files belong to the innermost open
    ``Intermediates``; without one they stay until the shared folder is cleared.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    if _open_owners.get():
        _open_owners.get()[-1]._folders.append(path)
    with shuffles_freed(spark):
        df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def replaced(old: DataFrame, new: DataFrame) -> DataFrame:
    """``new``, a written frame, after the files of ``old``, the written frame it was made from, have been deleted.

    For loops that write a frame in every round. The caller vouches that nobody else reads ``old``.
    """
    folders = {file.rsplit("/", 1)[0] for file in old.inputFiles()}
    for folder in folders:
        delete_folder(old.sparkSession, unquote(folder))
    return new


BROADCAST_MAX_BYTES = 64 << 20


def _width(value: Column, kind: T.DataType) -> Column:
    """About how many bytes a value takes."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return 16 + F.coalesce(F.octet_length(value), F.lit(0)).cast("long")
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)):
            inner = F.aggregate(value, F.lit(0).cast("long"), lambda total, item: total + _width(item, kind.elementType))
        else:
            inner = 16 * F.array_size(value).cast("long")
        return 16 + F.coalesce(inner, F.lit(0))
    if isinstance(kind, T.MapType):
        entries = T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)])
        return _width(F.map_entries(value), T.ArrayType(entries))
    if isinstance(kind, T.StructType):
        total = F.lit(16).cast("long")
        for field in kind:
            total = total + F.coalesce(_width(value[field.name], field.dataType), F.lit(0))
        return total
    return F.lit(16).cast("long")


def is_small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Whether the values of ``df`` take at most ``max_bytes``, counted in a job."""
    total = F.lit(0).cast("long")
    for field in df.schema:
        total = total + _width(F.col(f"`{field.name}`"), field.dataType)
    return (df.agg(F.sum(total)).first()[0] or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES, unique: str | None = None) -> DataFrame:
    """Hint a broadcast of ``df`` only after measuring it; beyond the bound the join shuffles.

    The measure counts texts, and what arrays, maps and structs hold, by their length and any other value as
    16 bytes. With ``unique``, repeated values in that column are an error.
    """
    if unique:
        repeated = df.agg((F.count(unique) - F.count_distinct(unique)).alias("repeated")).first()["repeated"]
        if repeated:
            raise ValueError(f"column {unique} repeats {repeated} values")
    return F.broadcast(df) if is_small(df, max_bytes) else df

"""Helpers shared by the corpus operators: row keys, stored intermediate tables, table reads, memory of workers."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# What a Python worker gets at once; texts may be long, so rows alone are no bound.
BATCH = {"spark.sql.execution.arrow.maxBytesPerBatch": "8m", "spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}


def settle(spark: SparkSession) -> SparkSession:
    """Session settings that every operator here relies on."""
    for key, value in BATCH.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`; a folder of our own only for a local session that names none."""
    sc = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if shared is None:
        if sc.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="railloom-shared-"))
        shared = sc.getCheckpointDir()
    return shared.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and return the stored table: cuts lineage and survives lost executors.

    The shuffle files behind it are dropped as soon as the table is written.
    """
    spark = settle(df.sparkSession)
    path = new_folder(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.stash_path = path
    return stored


def discard(*stored: DataFrame) -> None:
    """Delete stashed tables that nothing reads any more."""
    for df in stored:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stash_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return settle(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def settled(df: DataFrame) -> DataFrame:
    """`df` when its rows still know their files, else a stored copy: what `numbered` can number."""
    try:
        df.select(df.metadataColumn("_metadata").getField("row_index"))
        return df
    except AnalysisException:
        return stash(df, "rows")


def numbered(df: DataFrame, name: str) -> DataFrame:
    """`df` with a number for each row in column `name`: the place of its file among all and its place in the file.

    The same stored table gives the same numbers each time it is read, however Spark splits the files, which depends on the cores at
    hand. Frames that are not read from files are stored first; an operator that numbers one twice calls `settled` before.
    """
    df = settled(df)
    own = [F.col(f"`{c}`") for c in df.columns]
    file, at, base = fresh(df, "_file"), fresh(df, "_at"), fresh(df, "_base")
    place = df.metadataColumn("_metadata")
    rows = df.select(*own, place.getField("file_path").alias(file), place.getField("row_index").alias(at))
    # As many rows as files, which the driver lists anyway.
    files = df.select(place.getField("file_path").alias(file)).distinct().withColumn(base, F.row_number().over(Window.orderBy(file)).cast("long"))
    return rows.join(F.broadcast(files), file).select(*own, (F.shiftleft(base, 40) + F.col(at)).alias(name))


def keyed(df: DataFrame, **columns: str | Column) -> DataFrame:
    """The named columns behind `rid`, a number for each row (see `numbered`), so that rows stay apart even when their ids are null or
    repeated. Other columns of `df` are left out, whatever their names.
    """
    picked = [(F.col(f"`{c}`") if isinstance(c, str) else c).alias(n) for n, c in columns.items()]
    rid = fresh(df, "rid")
    return numbered(df, rid).select(F.col(rid).alias("rid"), *picked)


def fresh(df: DataFrame, name: str) -> str:
    """`name`, or with underscores before it until no column of `df` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


_HOLDER: list = []


def remembers(name: str, forget: Callable[[], None]) -> None:
    """Called by a worker's operator that keeps words between batches: what another one kept is forgotten first."""
    if not _HOLDER or _HOLDER[0] != name:
        if _HOLDER:
            _HOLDER[1]()
            give_back()
        _HOLDER[:] = [name, forget]


@cache
def _trim() -> Callable[[int], int]:
    """malloc_trim of the C library; nothing where it has none."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):
        return lambda _: 0


def give_back() -> None:
    """Return what this worker has freed to the system. Workers stay for later tasks, and what they keep adds up with their executor's."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`run` for mapInArrow, giving back at the end of each task."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


def tidy_group(run: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """`run` for applyInArrow, giving back after each group."""

    def tidied(rows: pa.Table) -> pa.Table:
        try:
            return run(rows)
        finally:
            give_back()

    return tidied


def tidy_groups(run: Callable[[pa.Table, pa.Table], pa.Table]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The same for two groups with one key."""

    def tidied(left: pa.Table, right: pa.Table) -> pa.Table:
        try:
            return run(left, right)
        finally:
            give_back()

    return tidied

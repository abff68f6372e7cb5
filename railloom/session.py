"""Session settings and durable intermediate results."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key is worth one more shuffle: split it even when that costs an exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rounds of a loop share their compiled code, wherever in a plan they stand.
    "spark.sql.codegen.useIdInClassName": "false",
    # Tables bucketed and sorted by a key with one file a bucket are not sorted again.
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
}

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def tune(spark: SparkSession) -> SparkSession:
    """Set the runtime options every job relies on; cluster sizing stays with the caller."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own. States of loops that nothing reads any more are deleted."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("railloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = tune(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`; only a session in one process may do without and gets its own."""
    sc = spark.sparkContext
    shared = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if shared is None:
        if sc.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="railloom-checkpoint-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared)
    return shared.rstrip("/")


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files behind; its result does not need them."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def durable(df: DataFrame) -> DataFrame:
    """Materialise in the shared checkpoint folder, so that a lost executor costs no earlier round."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def replace_state(old: DataFrame, new: DataFrame) -> DataFrame:
    """The state of a loop's next round, written; the files of the round before are deleted, which nothing may read any more."""
    new = durable(new)
    path = old._jdf.queryExecution().logical().rdd().getCheckpointFile()
    if path.isDefined():
        jvm, conf = new.sparkSession._jvm, new.sparkSession._jsc.hadoopConfiguration()
        place = jvm.org.apache.hadoop.fs.Path(path.get())
        place.getFileSystem(conf).delete(place, True)
    return new

"""Session helpers: shared working folder and lineage cuts."""

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from itertools import count

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs are written for; everything else is left to the cluster.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Read when the session starts: removes checkpoints that nothing refers to.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

def working_root(spark: SparkSession) -> str:
    """The folder shared by all executors: ``spark.checkpoint.dir``, made known to Spark.

    A local session without the setting, as in tests, gets a temporary folder; on a cluster
    the setting is required.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="shelfmark-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder name under the shared root that no other run uses. Its caller owns it."""
    return f"{working_root(spark).rstrip('/')}/shelfmark/{name}-{uuid.uuid4().hex}"


#: Whether Spark deletes the shuffle files of an action at its end; else they stay until the
#: driver happens to collect its garbage.
SHUFFLES_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Plans made in it, each of which must run once only, delete what they shuffled."""
    before = spark.conf.get(SHUFFLES_FREED, None)
    spark.conf.set(SHUFFLES_FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_FREED)
        else:
            spark.conf.set(SHUFFLES_FREED, before)


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared folder, so that lost executors cost a read only.

    What was shuffled to make them is deleted at once. Spark deletes what it wrote once nothing
    refers to it, if ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    working_root(df.sparkSession)
    with _shuffles_freed(df.sparkSession):
        return df.select("*").checkpoint()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Gives a function like `cut` for rows that are not read after the block: its tables are
    deleted at the end of it."""
    folder, made = new_folder(spark, "scratch"), count()

    def keep(df: DataFrame) -> DataFrame:
        path = f"{folder}/{next(made)}"
        with _shuffles_freed(spark):
            df.select("*").write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield keep
    finally:
        remove_folder(spark, folder)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder, through the file system its path names."""
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)

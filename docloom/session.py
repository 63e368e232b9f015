"""Session helpers."""

from __future__ import annotations

import re
import shutil
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ARCHIVE = "docloom_package.zip"
#: Drops the shuffle files of a query when it ends, not when the driver happens to collect garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_step: ContextVar[str | None] = ContextVar("step", default=None)


def local_session(app: str = "docloom", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session on this machine, for tests and trials; on a cluster use the session it provides."""
    session = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        # Both are needed: with the bind address alone, large results cannot be fetched back.
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    ship(session)
    return session


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read, as the cluster names it in ``spark.checkpoint.dir``.

    Only where the setting is empty and all runs on this machine a fresh temporary folder is made, once per context. On a
    cluster such a folder would be another one on every machine, so there the setting is required.
    """
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path and not re.match(r"local(\[|$)", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(path or tempfile.mkdtemp(prefix="docloom-"))
    return path or context.getCheckpointDir()


def run_dir(spark: SparkSession) -> str:
    """The folder of this application's intermediate tables, in the shared one."""
    return f"{shared_dir(spark)}/docloom-{spark.sparkContext.applicationId}"


def release(spark: SparkSession) -> None:
    """Remove this application's intermediate tables; frames that still read them can't be used any more."""
    remove(spark, run_dir(spark))


def remove(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def step(spark: SparkSession):
    """A step of a longer run: its intermediate tables are removed when it ends, and its shuffle files with each of its queries.

    So the disk holds what one step needs, however many there are. Frames made inside can't be used afterwards, unless they are
    stored elsewhere.
    """
    folder, before = f"{run_dir(spark)}/step-{uuid.uuid4()}", spark.conf.get(DROP_SHUFFLES, None)
    outer = _step.set(folder)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        _step.reset(outer)
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)
        remove(spark, folder)


def pinned(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back.

    For what is used more than once: later reads see the same rows after an executor is lost, read only the
    columns they need, and carry a measured size, by which Spark decides whether a join may broadcast them.
    """
    spark = df.sparkSession
    path = f"{_step.get() or run_dir(spark)}/{uuid.uuid4()}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of the session, wherever they run."""
    context = spark.sparkContext
    if ARCHIVE not in context._python_includes:
        base = Path(tempfile.mkdtemp(prefix="docloom-")) / ARCHIVE.removesuffix(".zip")
        root = Path(__file__).resolve().parent
        context.addPyFile(shutil.make_archive(str(base), "zip", root.parent, root.name))

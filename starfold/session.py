"""Session helpers: a local session for tests, and the cluster's shared folder."""

from __future__ import annotations

import os
import sys
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Property of a thread: the pool that its jobs go to where ``spark.scheduler.mode`` is FAIR.
SCHEDULER_POOL = "spark.scheduler.pool"


def local_session(cores: int | str = 8, app: str = "starfold") -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("STARFOLD_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_by_value(module_name: str) -> None:
    """Send the task functions of a module along with the job.

    Executors then need no installed copy of this package.
    """
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a session without ``spark.checkpoint.dir`` (a local test) gets a fresh
    temporary folder; a cluster must name a shared one.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="starfold-")
    spark.sparkContext.setCheckpointDir(own)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/starfold/{label}-{uuid.uuid4().hex}"


def small_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A frame of a few driver-made rows (metadata), in one task."""
    return spark.createDataFrame(rows, schema).coalesce(1)


def _hadoop_path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder on whatever file system it is; a missing one is fine."""
    found, system = _hadoop_path(spark, path)
    system.delete(found, True)


def find_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, in order; none if nothing does."""
    found, system = _hadoop_path(spark, pattern)
    return sorted(str(s.getPath().toString()) for s in system.globStatus(found) or [])


def path_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path; a missing one has none."""
    found, system = _hadoop_path(spark, path)
    return system.getContentSummary(found).getLength() if system.exists(found) else 0


def read_text(spark: SparkSession, path: str) -> str:
    """The whole of a small text file."""
    found, system = _hadoop_path(spark, path)
    stream = system.open(found)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with its whole content, or return False if the name is taken.

    A draft is written next to it and then linked (local files) or renamed, which on HDFS
    never replaces a file. Of several writers exactly one succeeds.
    """
    found, system = _hadoop_path(spark, path)
    draft, _ = _hadoop_path(spark, f"{path.rsplit('/', 1)[0]}/.draft-{uuid.uuid4().hex}")
    stream = system.create(draft, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    if system.getUri().getScheme() != "file":
        if not system.exists(found) and system.rename(draft, found):
            return True
        system.delete(draft, False)
        return False
    own = [str(system.makeQualified(p).toUri().getPath()) for p in (draft, found)]
    try:
        os.link(*own)
    except FileExistsError:
        return False
    finally:
        system.delete(draft, False)
    return True


@contextmanager
def scratch_dir(spark: SparkSession, label: str) -> Iterator[str]:
    """A path below the shared folder that is deleted at the end."""
    path = fresh_dir(spark, label)
    try:
        yield path
    finally:
        delete_path(spark, path)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, survives the loss of executors, and gives the planner true
    file sizes, so that it decides on broadcasts by size and not by guess.
    """
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

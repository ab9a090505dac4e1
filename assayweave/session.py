"""Session settings and the shared scratch location."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def recommended_conf() -> dict[str, str]:
    """Settings the operators are tuned for; all of them are runtime SQL settings.

    ``spark.sql.shuffle.partitions`` is deliberately absent: it belongs to the cluster
    (roughly total shuffle bytes / 128 MB), and AQE coalesces what turns out too fine.
    """
    return {
        "spark.sql.session.timeZone": "UTC",
        # Off: capturing a Python call site per column expression costs driver time only.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh sub-directory path of the shared checkpoint folder.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. Only a local
    session may do without it: there it is pointed at a temporary folder once.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        own = tempfile.mkdtemp(prefix="assayweave-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        context.setCheckpointDir(own)
        base = context.getCheckpointDir()
    path = f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


_scratch: list[str] = []


def release_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders handed out so far, for when their results are written; returns how many.

    Frames that still read them fail afterwards. Only folders this process named are touched.
    """
    context = spark.sparkContext
    released = 0
    while _scratch:
        path = context._jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        released += bool(path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True))
    return released


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back.

    Cuts lineage for a frame several branches read, and gives those branches real sizes to
    choose their join strategies by. ``release_scratch`` deletes what was written.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Whole texts go to Python workers in batches of at most ``rows`` from now on; a smaller setting stays.

    A batch stands in the executor's memory outside the heap and again in the worker, on the way there and back. At
    Spark's 10,000 rows that is some tens of MB each time for texts of a few KB. No result depends on it.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    most = int(spark.conf.get(name))
    if most <= 0 or most > rows:
        spark.conf.set(name, rows)


def spread(df: DataFrame) -> DataFrame:
    """Redistribute a frame read in fewer splits than there are cores.

    Meant before heavy row-wise work (tokenising, hashing). A large table already comes in
    more splits than cores and is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df

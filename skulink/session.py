"""Session helpers: one place for the configs every job relies on.

The library never creates its own session inside an operator; callers pass
one in.  ``get_spark`` is for tests, the bench and ad-hoc use.
"""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

# Configs the plans are written against.  AQE re-plans joins from runtime
# sizes, splits skewed shuffle partitions and coalesces tiny ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of a finished reuse point go once nothing refers to it
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# tables written by cut(), so a loop can drop what it has replaced
_PATHS: dict = {}


def get_spark(master: str | None = None, app_name: str = "skulink",
              shuffle_partitions: int | None = None,
              extra: dict | None = None, checkpoint_dir: str | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, checkpoint_dir)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, path: str | None = None) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    The session's setting always wins; ``path`` is used where it is unset.  With
    neither, a ``local[...]`` session (tests, one machine) gets a fresh
    folder of its own, and any other master is an error: a machine-local
    folder is never used on a cluster.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    path = (spark.conf.get("spark.checkpoint.dir", None)
            or sc.getConf().get("spark.checkpoint.dir", None) or path)
    if not path:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; name a folder that the driver and "
                "all executors share")
        path = tempfile.mkdtemp(prefix="skulink-checkpoints-")
    sc.setCheckpointDir(path)
    return sc._jsc.sc().getCheckpointDir().get()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location (never local tmp).

    The application's scratch folder is removed when the application ends.
    """
    # the checkpoint dir is this application's own sub-folder of the setting
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/skulink-scratch"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        fs.mkdirs(path)
        fs.deleteOnExit(path)
    return f"{root}/{name}-{uuid.uuid4().hex}"


def materialize(df, eager: bool = True):
    """Cut lineage at a reuse point with a reliable checkpoint.

    The data goes to ``spark.checkpoint.dir`` (a shared folder on a
    cluster), so a lost executor does not force recomputing the plan
    behind it, and later plans start from a leaf instead of re-planning
    the whole sub-tree.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def cut(df: DataFrame, name: str = "table", partition_by: str | None = None) -> DataFrame:
    """Cut lineage at a reuse point with a Parquet table in the shared folder.

    Same purpose as :func:`materialize`, for results that are read more than
    once: the table is columnar and compressed, readers prune its columns,
    and a lost executor re-reads it instead of recomputing the plan.  With
    ``partition_by`` readers that ask for one value open its folder only.
    """
    path = scratch_path(df.sparkSession, name)
    out = df.write.partitionBy(partition_by) if partition_by else df.write
    out.parquet(path)
    df = df.sparkSession.read.schema(df.schema).parquet(path)
    _PATHS[id(df)] = (weakref.ref(df), path)
    return df


def reclaim(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files behind tables that have been written.

    They go once the driver's garbage collector finds their plans unused, by default
    within half an hour; a job that shuffles its input several times asks earlier.
    """
    for _ in range(2):       # a plan's last user is found by the first, its shuffles by the second
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def discard(*dfs: DataFrame | None) -> None:
    """Delete tables written by :func:`cut` once nothing reads them any more.

    Loops call it for the table that a new one replaced; anything else given is left alone.
    """
    for df in dfs:
        ref, path = _PATHS.pop(id(df), (None, None))
        if ref is not None and ref() is df:
            spark = df.sparkSession
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

"""Session helpers: recommended configuration and the shared scratch folder.

Intermediate data that must survive executor loss (checkpointed buckets,
scan/sink round trips) goes under the checkpoint directory the cluster names
in ``spark.checkpoint.dir``. We only pick our own folder when the session has
none, which is the case in unit tests on a laptop.
"""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale. AQE re-plans joins from runtime sizes (it only
# broadcasts a side whose measured size is under autoBroadcastJoinThreshold),
# coalesces small shuffle partitions and splits skewed ones.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Floor of AQE's coalescing; below the 1 MB default so that small inputs
    # still spread over the cores (a cluster sets its own).
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "reelstack", extra: dict | None = None) -> SparkSession:
    """Session for tests and the benchmark (the cluster brings its own)."""
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    for key, value in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The session's checkpoint directory. Only a local session (tests) that
    has none gets a fresh local folder; a cluster must name a shared one."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured and not (
            sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="reelstack-ckpt-"))
    return sc.getCheckpointDir()


# Folders of the innermost scope. A context variable: jobs in other threads have
# scopes of their own.
_SCOPE: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("scratch_scope", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared checkpoint directory."""
    folder = f"{checkpoint_root(spark).rstrip('/')}/scratch/{uuid.uuid4().hex}"
    scope = _SCOPE.get()
    if scope is not None:
        scope.append(folder)
    return f"{folder}/{name}"


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Scratch folders made inside are removed at the end. For jobs that have
    written their outputs by then: no DataFrame of the scope is read later."""
    folders: list[str] = []
    token = _SCOPE.set(folders)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        remove_scratch(spark, folders)


def remove_scratch(spark: SparkSession, folders) -> None:
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def materialize(df, name: str):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back. It cuts the lineage (a lost executor recomputes from the files,
    not from the inputs), and later passes read only the columns they use."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    # The schema is known: no job that reads it from the files.
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, name: str, make) -> DataFrame:
    """``make()`` written as Parquet and read back, like ``materialize``; all
    scratch that making it took is removed as soon as it is written."""
    path = scratch_path(spark, name)
    with scratch_scope(spark):
        made = make()
        made.write.parquet(path)
        schema = made.schema
    return spark.read.schema(schema).parquet(path)

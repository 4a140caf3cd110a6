"""Tables bucketed and sorted by a key, for joins without a shuffle.

Two tables with the same number of buckets on their join key are joined bucket by
bucket: neither is shuffled again, whatever their size. The files carry their bucket
in their names, so a table is its folder; the catalog entry that tells Spark of the
buckets is made when it is read and not needed afterwards.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..storage import Store, staging_folder


def sink_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> str:
    """Write ``df`` to ``path`` in ``buckets`` buckets of ``key``, one file each,
    sorted by the key. The rows are shuffled once, by the hash that names the
    buckets; a single hot key is one bucket, so deduplicate before (as the
    trusted tables are) or choose another layout. The folder is replaced in one move."""
    spark = df.sparkSession
    store, staging = Store(spark, path), staging_folder(path.rstrip("/").rsplit("/", 1)[0])
    name = f"reelstack_{uuid.uuid4().hex}"
    try:
        (df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
         .option("path", staging).saveAsTable(name))
        # An empty table has no files that tell its columns.
        spark.createDataFrame([], df.schema).write.parquet(f"{staging}/_schema")
        store.replace(staging, path.rstrip("/"))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        store.delete(staging)
    return path


def scan_bucketed(spark: SparkSession, path: str, key: str, buckets: int) -> DataFrame:
    """Read a table of ``sink_bucketed`` with its buckets known to the planner."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(f"{path}/_schema").schema.fields)
    name = f"reelstack_{uuid.uuid4().hex}"
    place = path.replace("'", "\\'")
    try:
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
                  f"INTO {int(buckets)} BUCKETS LOCATION '{place}'")
        # The DataFrame is bound to the files here; the entry may go.
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")

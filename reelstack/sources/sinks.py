"""Sinks: chunked NDJSON, Parquet, date-partitioned Parquet, star tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keys import row_number_scaled
from ..operators.profile import profile_state
from ..operators.setops import union_all
from ..session import shuffle_partitions
from ..storage import TASKS_PLACE_FILES, Store, staging_folder

# Rows per NDJSON file unless the caller asks for another number.
NDJSON_RECORDS = 100_000
_CHUNK = "_parte"
# Mergeable profiles of a star's tables, beside them.
STATES = "_profile"


def sink_ndjson(df: DataFrame, path: str, max_records: int = NDJSON_RECORDS, order=None,
                mode: str = "overwrite") -> str:
    """NDJSON files of at most ``max_records`` rows each (also when there are
    fewer rows than that: something is always written).

    Without ``order`` each task rolls its own files. With ``order`` the files
    are exact chunks of the ordered rows, named by their number: with 100, rows 1-100
    are ``parte_0.json``, 101-200 ``parte_1.json``, ... (no file for no rows). The chunk
    of each row comes from a distributed row number; each chunk is one folder
    of a partitioned write, sorted by row number, so it is one file of one task. All
    of it happens in a hidden folder beside ``path``, whose committed files are
    then given their names and put in place of ``path`` in one move: a task or job
    that fails leaves the earlier files as they were.
    """
    if order is None:
        df.write.mode(mode).option("maxRecordsPerFile", max_records).json(path)
        return path
    assert mode == "overwrite", "numbered files are written as a whole"
    spark, cols = df.sparkSession, df.columns
    assert _CHUNK not in cols, f"{_CHUNK} names the chunks"
    store = Store(spark, path)
    staging = staging_folder(path.rstrip("/").rsplit("/", 1)[0])
    try:
        numbered = row_number_scaled(df, order, "_nd_rn")
        chunked = numbered.withColumn(_CHUNK, F.floor((F.col("_nd_rn") - 1) / max_records))
        (chunked.repartition(shuffle_partitions(spark), _CHUNK).sortWithinPartitions(_CHUNK, "_nd_rn")
         .select(*cols, _CHUNK).write.partitionBy(_CHUNK).option("maxRecordsPerFile", 0).options(**TASKS_PLACE_FILES).json(f"{staging}/chunks"))
        store.make(f"{staging}/named")
        # A listing by Spark, no contents; a chunk of two files would be a broken one.
        written = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{staging}/chunks").select("_metadata.file_path")
        files = [row[0].rsplit("/", 2)[1:] for row in written.collect()]
        assert len({folder for folder, _ in files}) == len(files), f"{path}: a chunk is in several files"
        store.rename_all([(f"{staging}/chunks/{folder}/{file}", f"{staging}/named/parte_{folder.split('=', 1)[1]}.json")
                          for folder, file in files])
        store.replace(f"{staging}/named", path.rstrip("/"))
    finally:
        store.delete(staging)
    return path


def sink_parquet(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite") -> str:
    """Parquet overwrite. ``single_file`` always writes one file, through one
    task: ask for it only where a reader needs it. The last stage is
    repartitioned, not coalesced, so upstream work stays parallel."""
    (df.repartition(1) if single_file else df).write.mode(mode).parquet(path)
    return path


def sink_partitioned(df: DataFrame, path: str, dt=None, partition_col: str = "dt",
                     mode: str = "overwrite") -> str:
    """Parquet partitioned by ``partition_col``. With ``dt`` every row goes to
    that one ``dt=YYYY-MM-DD`` partition, which is replaced even by an empty
    input; the other partitions stay. Otherwise the column must exist, and the
    partitions present in ``df`` are replaced (dynamic overwrite)."""
    if dt is not None:
        day = str(dt).replace("/", "-")
        df.drop(partition_col).write.mode(mode).parquet(f"{path}/{partition_col}={day}")
        return path
    # Many partition values: without this every task writes a file into every
    # folder. REBALANCE groups rows by value and lets AQE split a value holding
    # a large share of the rows across several tasks.
    (df.hint("rebalance", partition_col).write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))
    return path


def write_star(tables: dict[str, DataFrame], root: str, keep: int = 2) -> dict[str, str]:
    """Publish the tables of a star together, as ``{root}/v={number}/{name}``.

    All tables are written into a hidden folder first; one move gives it the next
    number, and readers (``star_paths``, ``read_star``) take the highest. So a
    reader never sees new keys against old dimensions, and a job that dies
    leaves the star before it. The last ``keep`` versions stay, for readers
    that still read one. Of two writers at once, the later move fails. The mergeable
    profile of every table is kept with it (``star_states``). Returns the paths of
    the new tables.
    """
    spark = next(iter(tables.values())).sparkSession
    store, staging = Store(spark, root), staging_folder(root)
    try:
        for name, df in tables.items():
            df.write.parquet(f"{staging}/{name}")
        written = {n: spark.read.schema(df.schema).parquet(f"{staging}/{n}") for n, df in tables.items()}
        states = [profile_state(df).select(F.lit(n).alias("tbl"), "*") for n, df in written.items()]
        union_all(*states).coalesce(1).write.parquet(f"{staging}/{STATES}")
        old = _versions(store, root)
        number = old[-1] + 1 if old else 1
        store.rename(staging, f"{root}/v={number}")
    finally:
        store.delete(staging)
    for gone in old[:max(0, len(old) + 1 - keep)]:
        store.delete(f"{root}/v={gone}")
    return {name: f"{root}/v={number}/{name}" for name in tables}


def _versions(store: Store, root: str) -> list[int]:
    return sorted(int(n[2:]) for n in store.names(root) if n.startswith("v=") and n[2:].isdigit())


def star_paths(spark: SparkSession, root: str) -> dict[str, str]:
    """Paths of the published star's tables, by name, all of one version."""
    store = Store(spark, root)
    versions = _versions(store, root)
    if not versions:
        raise FileNotFoundError(f"{root}: no star was published")
    current = f"{root}/v={versions[-1]}"
    return {name: f"{current}/{name}" for name in store.names(current) if name[0] not in "._"}


def star_states(spark: SparkSession, root: str) -> DataFrame | None:
    """Mergeable profiles (``profile_state``) of the tables of the star version
    at ``root``, one row per table and column; None where none are kept."""
    return spark.read.parquet(f"{root}/{STATES}") if Store(spark, root).exists(f"{root}/{STATES}") else None


def read_star(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(path) for name, path in star_paths(spark, root).items()}


def file_stats(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """Number of data files and rows under ``path`` (one distributed job)."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path).agg(F.count_distinct("_metadata.file_path").alias("n_files"),
                                 F.count(F.lit(1)).alias("n_rows"))

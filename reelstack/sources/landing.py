"""Byte-exact landing of extract files, with a manifest.

An extract lands as the folder ``{layer}/yyyy/MM/dd/file={name}``. Each split that
Spark reads of it becomes one part in a folder ``at={offset}`` of its own; parts in
the order of these names are the extract's bytes, every one of them: lines end at
``\\n`` only, so a ``\\r`` stays where it is, and a missing last line end, a byte
order mark and bytes that are no UTF-8 stay, too. The copy runs in parallel, inside
the JVM.

``_manifest`` beside the landed files has a row per part: bytes, lines, SHA-256,
the number of lines with an odd number of quotes, and the first line where the part
begins a source file. The CSV reader takes the header from it.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import base_name
from ..layout import date_path
from ..session import shuffle_partitions
from ..storage import TASKS_PLACE_FILES, Store, staging_folder

MANIFEST = "_manifest"
BOM = b"\xef\xbb\xbf"
# Files of which a task may hold all bytes.
SMALL_FILE = 1 << 20


def text_lines(spark: SparkSession, path) -> DataFrame:
    """Lines as they are (ended by ``\\n`` alone), with the file they come from,
    the offset of their split and their order in it."""
    return (spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(path)
            .select("value", F.col("_metadata.file_path").alias("source"),
                    F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("no")))


def odd_quotes(value: str = "value") -> Column:
    """1 when the line holds an odd number of quotes, else 0."""
    return (F.length(value) - F.length(F.replace(F.col(value), F.lit('"'), F.lit("")))) % 2


def decoded(c, times: int = 1) -> Column:
    """A name as it is, from a URI that spells it; a ``+`` is no space there.
    Twice for the value in a partition folder's name, which Spark escapes, too."""
    c = F.col(c) if isinstance(c, str) else c
    for _ in range(times):
        c = F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))
    return c


def source_files(spark: SparkSession, src: str) -> dict[str, int]:
    """The files under ``src`` that hold anything and their lengths (a listing,
    no contents)."""
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(src)
               .select(F.col("_metadata.file_path").alias("f"), "length"))
    return {r.f: r.length for r in listing.collect()}


def land_raw(spark: SparkSession, src: str, layer: str, as_of, file_col: str = "file",
             name: str | None = None) -> str:
    """Land the text files under ``src`` into ``{layer}/yyyy/MM/dd`` byte for byte.

    Each source file keeps its base name as the ``file=`` folder, and only the
    folders of the same names are replaced, whole and at the end: a landing that
    dies leaves the earlier one as it was. ``name`` lands a folder of parts as one
    file of that name, its parts in the order of their names. Returns the landed
    folder; reading it with ``spark.read.text`` gives the lines and the ``file``
    column. The landed bytes are checked against the source's length.

    ``src`` must be readable by the executors (an upload or staging area on
    shared storage), not a folder on the driver machine only. A file that does
    not end in a line end must end in a UTF-8 character; two source files of one
    base name raise, as they would land as one.
    """
    target = f"{layer}/{date_path(as_of)}"
    staging = staging_folder(target)
    store = Store(spark, target)
    try:
        _copy(spark, src, f"{staging}/files", file_col, name)
        _write_manifest(spark, f"{staging}/files", f"{staging}/{MANIFEST}", file_col)
        _check(spark, src, staging)
        _place(store, staging, target, file_col)
    finally:
        store.delete(staging)
    return target


def _place(store: Store, staging: str, target: str, file_col: str) -> None:
    """Each landed folder, then its manifest, in place of the earlier one. What is
    there is listed once; a new folder takes one move."""
    places = {"files": target, MANIFEST: f"{target}/{MANIFEST}"}
    new = {part: set(store.names(f"{staging}/{part}")) for part in places}
    old = {part: set(store.names(place)) for part, place in places.items()}
    for part, place in places.items():
        if new[part]:
            store.make(place)
    for folder in sorted(n for n in new["files"] if n.startswith(f"{file_col}=")):
        for part, place in places.items():
            if folder in new[part]:
                if folder in old[part]:
                    store.delete(f"{place}/{folder}")
                store.rename_all([(f"{staging}/{part}/{folder}", f"{place}/{folder}")])


def _ends(spark: SparkSession, src: str, files: dict[str, int]) -> dict[str, tuple[bytes, bytes]]:
    """The first three and last four bytes of every file: tasks take them from
    the files of up to ``SMALL_FILE`` bytes, which may be many, the driver from
    the others."""
    small = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(src)
             .filter(F.col("length") <= SMALL_FILE)
             .select(F.col("_metadata.file_path").alias("f"), F.substring("content", 1, 3).alias("head"),
                     F.expr("substring(content, greatest(length(content) - 3, 1), 4)").alias("tail")))
    ends = {r.f: (bytes(r.head), bytes(r.tail)) for r in small.collect()}
    reader = Store(spark, src)
    return {f: ends[f] if f in ends else reader.ends(f, tail=4) for f in files}


def _copy(spark: SparkSession, src: str, out: str, file_col: str, name: str | None) -> None:
    files = source_files(spark, src)
    reader, target = Store(spark, src), Store(spark, out)
    named = [unquote(f.rsplit("/", 1)[1]) for f in files]
    twice = next((n for n in named if named.count(n) > 1), None) if len(set(named)) < len(named) else None
    if twice:
        raise ValueError(f"{src}: two files are named {twice}")
    # Files the line reader would not give back whole: a byte order mark is
    # skipped, and a last line without an end looks like one with it.
    ends = _ends(spark, src, files)
    marked = [f for f, (head, _) in ends.items() if head == BOM]
    unended = {f: tail for f, (_, tail) in ends.items() if not tail.endswith(b"\n")}
    lines = text_lines(spark, src)
    at = F.lpad(F.col("block").cast("string"), 18, "0")
    if name is not None:
        at = F.concat_ws("-", decoded(base_name("source")), at)
    file = F.lit(name) if name is not None else decoded(base_name("source"))
    place = {file_col: file, "at": at}
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for empty in reader.empty_files(src) if name is None else ():
        target.make(f"{out}/{file_col}={escape(empty)}")
    edges = marked + list(unended)
    if edges:
        # One row per such file: its first and last line. Its size is bounded by
        # the number of source files.
        spans = (lines.filter(F.col("source").isin(edges)).groupBy("source")
                 .agg(F.min(F.struct("block", "no")).alias("lo"), F.max(F.struct("block", "no")).alias("hi")))
        lines = lines.join(F.broadcast(spans), "source", "left")
        here = F.struct("block", "no")
        value = F.when(F.col("source").isin(marked) & (here == F.col("lo")), F.concat(F.lit("﻿"), "value")).otherwise(F.col("value"))
        lines = lines.withColumn("value", value).withColumn(
            "last", F.col("source").isin(list(unended)) & (here == F.col("hi")))
    else:
        lines = lines.withColumn("last", F.lit(False))
    # Rows are sorted as they come, which keeps the writer from sorting them
    # by folder alone.
    body = lines.filter(~F.coalesce("last", F.lit(False))).withColumns(place)
    (body.sortWithinPartitions(file_col, "at", "no").select("value", file_col, "at")
     .write.mode("append").option("lineSep", "\n").options(**TASKS_PLACE_FILES).partitionBy(file_col, "at").text(out))
    # A last line without an end is written as its text up to the last
    # character, with that character as the line end.
    for char in sorted({_last_char(f, tail) for f, tail in unended.items()}):
        tails = [f for f, tail in unended.items() if _last_char(f, tail) == char]
        ending = (lines.filter("last").filter(F.col("source").isin(tails)).withColumns(place)
                  .withColumn("at", F.concat("at", F.lit("-end"))))
        (ending.select(F.expr("substring(value, 1, length(value) - 1)").alias("value"), file_col, "at")
         .write.mode("append").option("lineSep", char).options(**TASKS_PLACE_FILES).partitionBy(file_col, "at").text(out))


def _last_char(file: str, tail: bytes) -> str:
    for n in range(1, 5):
        try:
            return tail[-n:].decode("utf-8")
        except UnicodeDecodeError:
            continue
    raise ValueError(f"{file}: ends neither in a line end nor in a UTF-8 character")


def _write_manifest(spark: SparkSession, files: str, out: str, file_col: str) -> None:
    if not [n for n in Store(spark, files).names(files) if n.startswith(f"{file_col}=")]:
        return
    value = decoded(F.regexp_extract("part", r"/[^/=]*=([^/]*)/at=[^/]*/[^/]*$", 1), 2)
    digests = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(files)
               .select(F.col("_metadata.file_path").alias("part"), F.col("length").alias("bytes"),
                       F.sha2("content", 256).alias("sha256")))
    lines = text_lines(spark, files).withColumnRenamed("source", "part")
    texts = lines.groupBy("part").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(odd_quotes()).alias("odd_quotes"),
        F.min_by("value", F.struct("block", "no")).alias("first_line"))
    begins = F.col("part").rlike(r"/at=([^/]*-)?0{18}(-end)?/[^/]*$")
    rows = digests.join(texts, "part").select(
        value.alias(file_col), F.regexp_extract("part", r"/(at=[^/]*/[^/]*)$", 1).alias("part"), "bytes", "lines",
        "sha256", "odd_quotes", F.when(begins, F.col("first_line")).alias("first_line"))
    # The rows are few and their files many: a number of its own keeps them from one task.
    (rows.repartition(shuffle_partitions(spark), file_col)
     .write.options(**TASKS_PLACE_FILES).partitionBy(file_col).json(out))


def manifest(spark: SparkSession, landed: str) -> DataFrame | None:
    """The manifest of a landed day, or of one ``file=`` folder of it; None
    where nothing of the kind was written. ``folder`` is the landed folder."""
    landed = landed.rstrip("/")
    parent, last = landed.rsplit("/", 1)
    store = Store(spark, landed)
    rows = f"{landed}/{MANIFEST}"
    if "=" in last and store.exists(f"{parent}/{MANIFEST}/{last}"):
        rows, landed = f"{parent}/{MANIFEST}/{last}", parent
    elif not store.exists(rows):
        return None
    folders = [rows] if rows.startswith(parent + "/" + MANIFEST) else [f"{rows}/{n}" for n in store.names(rows)]
    read = spark.read.schema("part string, bytes long, lines long, sha256 string, odd_quotes long, first_line string").json(folders)
    name = F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]*=[^/]*)/[^/]*$", 1)
    return read.select(F.concat(F.lit(f"{landed}/"), decoded(name)).alias("folder"), "*")


def _check(spark: SparkSession, src: str, staging: str) -> None:
    """As many bytes have landed as there were."""
    want, files = sum(source_files(spark, src).values()), f"{staging}/files"
    got = sum(source_files(spark, files).values()) if Store(spark, files).exists(files) else 0
    if want != got:
        raise IOError(f"{src}: {want} bytes, landed {got}")


def verify_landing(spark: SparkSession, landed: str) -> DataFrame:
    """Parts of a landed day whose bytes are not (or no longer) those of the
    manifest: (folder, part, expected, found), empty when all is well."""
    listed = manifest(spark, landed)
    assert listed is not None, f"{landed}: no manifest"
    path = F.col("_metadata.file_path")
    now = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(landed)
           .filter(~path.contains(f"/{MANIFEST}/"))
           .select(F.regexp_extract(path, r"/([^/]*=[^/]*)/at=[^/]*/[^/]*$", 1).alias("f"),
                   F.regexp_extract(path, r"/(at=[^/]*/[^/]*)$", 1).alias("part"), F.sha2("content", 256).alias("found")))
    want = listed.select(F.substring_index("folder", "/", -1).alias("f"), "part", F.col("sha256").alias("expected"))
    both = want.join(now.withColumn("f", decoded("f")), ["f", "part"], "full")
    return both.filter(~F.col("expected").eqNullSafe(F.col("found"))).withColumnRenamed("f", "folder")

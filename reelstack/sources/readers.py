"""Readers; every schema is declared."""

from __future__ import annotations

import csv
from collections.abc import Iterable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, ByteType, DataType, DecimalType, DoubleType, FloatType, IntegerType,
                               LongType, ShortType, StringType, StructField, StructType)

from ..functions.casts import whole
from ..schemas import MOVIES_CSV
from ..session import materialize
from .landing import manifest, odd_quotes, text_lines

_WHOLE = (ByteType, ShortType, IntegerType, LongType)
_READ_AS_TEXT = (*_WHOLE, FloatType, DoubleType, DecimalType, BooleanType)


# ------------------------------------------------------------------------ JSON


def text_schema(dtype: DataType) -> DataType:
    """The type a JSON field is read as: numbers and flags as their own text."""
    if isinstance(dtype, StructType):
        return StructType([StructField(f.name, text_schema(f.dataType), True) for f in dtype.fields])
    if isinstance(dtype, ArrayType):
        return ArrayType(text_schema(dtype.elementType), True)
    return StringType() if isinstance(dtype, _READ_AS_TEXT) else dtype


def _typed(c: Column, dtype: DataType) -> Column:
    """The declared type from the text: ``1000.0`` is a whole number, too."""
    if isinstance(dtype, StructType):
        return F.when(c.isNotNull(), F.struct(*[_typed(c[f.name], f.dataType).alias(f.name) for f in dtype.fields]))
    if isinstance(dtype, ArrayType):
        return F.transform(c, lambda x: _typed(x, dtype.elementType))
    if isinstance(dtype, _WHOLE):
        return whole(c, dtype)
    return c.try_cast(dtype) if isinstance(dtype, _READ_AS_TEXT) else c


def _lost(c: Column, dtype: DataType, typed: Column) -> Column:
    """Whether a value is there whose type cannot be had from its text, given what
    was had from it."""
    if isinstance(dtype, StructType):
        return reduce(lambda a, b: a | b, [_lost(c[f.name], f.dataType, typed[f.name]) for f in dtype.fields], F.lit(False))
    if isinstance(dtype, ArrayType):
        both = F.arrays_zip(c.alias("c"), typed.alias("t"))
        return F.coalesce(F.exists(both, lambda x: _lost(x["c"], dtype.elementType, x["t"])), F.lit(False))
    if isinstance(dtype, _READ_AS_TEXT):
        return c.isNotNull() & typed.isNull()
    return F.lit(False)


def typed_columns(schema: StructType) -> list[Column]:
    """The declared columns of rows read with ``text_schema``."""
    return [_typed(F.col(_quoted(f.name)), f.dataType).alias(f.name) for f in schema.fields]


def scan_ndjson(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Line-delimited JSON with a declared schema (no inference job).

    Numbers and flags are read as the text they are written in and then cast, so
    a field that is ``1000`` in one file and ``1000.0`` (or ``"1000"``) in the next gives the
    same value. What cannot be cast is null; ``scan_ndjson_checked`` also
    tells which records that befell."""
    return spark.read.schema(text_schema(schema)).json(path).select(*typed_columns(schema))


def scan_ndjson_checked(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """The rows of ``scan_ndjson`` but for lines that are no JSON object, and the
    records that did not decode in full: ``file``, ``record`` (the line) and
    ``fields`` (the names whose value was lost; empty for a line that is no
    object, which is in no row). Every line is decoded once, when this is called."""
    decoded = materialize(decode_ndjson(spark, path, schema), "ndjson")
    return decoded.filter("NOT broken").select("row.*"), decoded.filter("record IS NOT NULL").select("file", "record", "fields")


def decode_ndjson(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """(file, row, broken, fields, record) per line that is not blank: the typed
    fields, whether the line is no JSON object, the names of the lost fields,
    and the line where something was lost. A filter on these columns would go
    below the decoding and decode the line again for each field it names: store
    them first."""
    options = {"columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE"}
    as_text = StructType([*text_schema(schema).fields, StructField("_bad", StringType(), True)])
    lines = spark.read.text(path).filter(F.trim("value") != "")
    read = lines.select("value", F.col("_metadata.file_path").alias("file"), F.from_json("value", as_text, options).alias("r"))
    field = lambda f: F.col(f"r.{_quoted(f.name)}")
    read = read.withColumn("row", F.struct(*[_typed(field(f), f.dataType).alias(f.name) for f in schema.fields]))
    lost = F.array_compact(F.array(*[F.when(_lost(field(f), f.dataType, F.col(f"row.{_quoted(f.name)}")), F.lit(f.name)) for f in schema.fields]))
    read = read.select("value", "file", "row", (F.col("r").isNull() | F.col("r._bad").isNotNull()).alias("broken"), lost.alias("lost"))
    return read.select("file", "row", "broken", F.when(F.col("broken"), F.array().cast("array<string>")).otherwise(F.col("lost")).alias("fields"),
                       F.when(F.col("broken") | (F.size("lost") > 0), F.col("value")).alias("record"))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


# ------------------------------------------------------------------------- CSV


def _fields(header: str) -> list[str]:
    return [name.strip() for name in next(csv.reader([header], delimiter="|"), [])]


def _is_header(header: str | None, schema: StructType, key: str) -> bool:
    """A header names the key and at least half of the declared columns."""
    names = _fields(header or "")
    return key in names and 2 * len(set(names) & set(schema.names)) >= len(schema.names)


def _landed_headers(files: DataFrame, schema: StructType, key: str) -> dict[str, tuple[set[str], int]]:
    """Per landed file its headers (first lines of its source files) and the
    number of its lines with an odd number of quotes."""
    per_file = files.groupBy("folder").agg(F.collect_set("first_line").alias("firsts"), F.sum("odd_quotes").alias("odd"))
    return {r.folder: ({h.rstrip("\r") for h in r.firsts if _is_header(h.rstrip("\r"), schema, key)}, r.odd)
            for r in per_file.collect()}


def _searched_headers(lines: DataFrame, schema: StructType, key: str) -> dict[str, tuple[set[str], int]]:
    """The same for files that were not landed, by a pass over their lines."""
    fields = F.transform(F.split("value", r"\|"), lambda f: F.btrim(f, F.lit(' "\r')))
    declared = F.array(*[F.lit(name) for name in schema.names])
    maybe = F.array_contains(fields, key) & (2 * F.size(F.array_intersect(fields, declared)) >= len(schema.names))
    per_file = lines.groupBy("source").agg(F.collect_set(F.when(maybe, F.rtrim("value", F.lit("\r")))).alias("headers"),
                                           F.sum(odd_quotes()).alias("odd"))
    return {r.source: (set(r.headers), r.odd) for r in per_file.collect()}


def whole_records(lines: DataFrame) -> DataFrame:
    """Records of ``lines`` (src, block, no, value): a line break inside quotes
    belongs to its record. Whether a line begins inside quotes follows from the quotes
    before it: a running count inside each block (one split's lines) and one over
    the blocks, which are few. Records of several lines are joined again, all
    others pass as they are."""
    lines = lines.withColumn("q", odd_quotes())
    order = Window.partitionBy("src").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy("src", "block").agg((F.sum("q") % 2).alias("odd"))
    opened = materialize(blocks.select("src", "block", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).alias("open")),
                         "csv_open")
    inside = Window.partitionBy("src", "block").orderBy("no")
    marked = lines.join(opened, ["src", "block"]).withColumn("after", (F.col("open") + F.sum("q").over(inside)) % 2)
    marked = marked.withColumn("begins", (F.col("after") + F.col("q")) % 2 == 0)
    marked = marked.withColumn("start", F.last(F.when(F.col("begins"), F.col("no")), ignorenulls=True).over(inside))
    single = marked.filter(F.col("begins") & (F.col("after") == 0)).select("src", "value")
    parts = materialize(marked.filter(~(F.col("begins") & (F.col("after") == 0)))
                        .select("src", "block", "no", "value", "start"), "csv_parts")
    # Lines before the first start of a block go on with the record that was open
    # at the end of an earlier one: its last start. Records that end before
    # that are no part of this.
    last_start = marked.groupBy("src", "block").agg(F.max(F.when(F.col("begins"), F.struct("block", "no"))).alias("ls"))
    carried = materialize(last_start.select("src", "block", F.last("ls", ignorenulls=True).over(before).alias("carried")),
                          "csv_carried")
    own = F.when(F.col("start").isNotNull(), F.struct("block", F.col("start").alias("no")))
    keyed = parts.join(carried, ["src", "block"]).withColumn("record", F.coalesce(own, F.col("carried")))
    joined = keyed.groupBy("src", "record").agg(F.array_sort(F.collect_list(F.struct("block", "no", "value"))).alias("l"))
    return single.unionByName(joined.select("src", F.array_join(F.transform("l", lambda x: x["value"]), "\n").alias("value")))


def _parsed(lines: DataFrame, header: str, schema: StructType) -> DataFrame:
    """Declared columns of lines under one header, matched by name."""
    names = _fields(header)
    by_place = StructType([StructField(f"c{i}", StringType(), True) for i in range(len(names))])
    options = {"sep": "|", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    text = F.regexp_replace("value", "\r$", "")
    rows = (lines.filter((text != header) & (F.trim(text) != ""))
            .select(F.from_csv(text, by_place.simpleString()[len("struct<"):-1].replace(":", " "), options).alias("r")))
    return rows.select(*[
        (F.col(f"r.c{names.index(f.name)}") if f.name in names else F.lit(None)).try_cast(f.dataType).alias(f.name)
        for f in schema.fields])


def scan_csv_pipe(spark: SparkSession, path: str, schema: StructType = MOVIES_CSV,
                  key: str | None = None, quoted_newlines: str = "keep") -> DataFrame:
    """Pipe-separated CSV with a header line, columns matched by *name*; a
    declared column that is missing is null.

    ``path`` is a landed day or one landed file of it (the headers then come from
    the manifest), or any file or folder of files (the lines are searched for
    headers). Lines end at ``\\n``, a ``\\r`` before it is no part of the line. Files whose
    headers order the columns differently are read in their own order.

    Nothing is guessed: it raises when no line names ``key`` (the first declared
    column) and half of the others, when one file holds two different headers,
    and when a file has no header while others have different ones. Files
    without a header take the only one there is.

    A line break inside quotes is kept in its field; ``quoted_newlines="raise"``
    raises where a line has an odd number of quotes, ``"lines"`` takes every line
    for a record, as a reader without a multi-line option does. Where the
    quotes of a file do not pair up at all, ``"keep"`` raises, too.
    """
    assert quoted_newlines in ("keep", "raise", "lines"), quoted_newlines
    key = key or schema.names[0]
    listed = manifest(spark, path)
    lines = text_lines(spark, path)
    if listed is not None:
        found = _landed_headers(listed, schema, key)
    else:
        found = _searched_headers(lines, schema, key)
    headers = {h for hs, _ in found.values() for h in hs}
    two = [f for f, (hs, _) in found.items() if len(hs) > 1]
    none = [f for f, (hs, _) in found.items() if not hs]
    if not headers:
        raise ValueError(f"{path}: no header line with the column {key!r}")
    if two:
        raise ValueError(f"two headers in one file: {two[0]}")
    if none and len(headers) > 1:
        raise ValueError(f"no header, and those of other files differ: {none[0]}")
    only = next(iter(headers))
    by_header: dict[str, list[str]] = {}
    for place, (hs, _) in found.items():
        by_header.setdefault(next(iter(hs), only), []).append(place)
    odd = [f for f, (_, n) in found.items() if n]
    if odd and quoted_newlines == "raise":
        raise ValueError(f"a line with an odd number of quotes: {odd[0]}")
    torn = [f for f, (_, n) in found.items() if n % 2]
    if torn and quoted_newlines == "keep":
        raise ValueError(f"quotes do not pair up: {torn[0]} (quoted_newlines='lines' takes each line for a record)")

    def read(header: str, places: Iterable[str]) -> DataFrame:
        lines = _lines_of(spark, places, listed is not None)
        if odd and quoted_newlines == "keep":
            lines = whole_records(lines)
        return _parsed(lines, header, schema)

    return reduce(DataFrame.unionByName, [read(h, sorted(places)) for h, places in sorted(by_header.items())])


def _lines_of(spark: SparkSession, places: Iterable[str], landed: bool) -> DataFrame:
    """(src, block, no, value) of files, or of landed folders, whose parts go in
    the order of their names."""
    places = list(places)
    lines = text_lines(spark, places if landed else [_as_path(spark, p) for p in places])
    folder = F.regexp_extract("source", r"^(.*)/at=[^/]*/[^/]*$", 1) if landed else F.col("source")
    return lines.select(folder.alias("src"), F.struct("source", "block").alias("block"), "no", "value")


def _as_path(spark: SparkSession, uri: str) -> str:
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).toString()


# --------------------------------------------------------------------- Parquet


def scan_layer(spark: SparkSession, root: str, table: str | None = None,
               dt: str | None = None) -> DataFrame:
    """A Parquet layer table; with ``dt`` only that ``dt=`` partition is
    listed and read, and the ``dt`` column is kept."""
    path = f"{root}/{table}" if table else root
    if dt is None:
        return spark.read.parquet(path)
    # Read only the wanted partition folder (basePath keeps the ``dt`` column):
    # the other partitions are never even listed.
    day = str(dt).replace("/", "-")
    wanted = F.col("dt") == F.lit(day).cast("date")
    try:
        df = spark.read.option("basePath", path).parquet(f"{path}/dt={day}")
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        # No such partition: the pruned read of the root gives the empty table.
        df = spark.read.parquet(path)
    return df.filter(wanted)

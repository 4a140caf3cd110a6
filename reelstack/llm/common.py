"""Column expressions and helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fixed values of the contracts: a word is a run of characters outside these.
SPACES = " \t\n\u000b\f\r"
NON_WORD = r"[\x20\x09-\x0D]+"
# Elements per run of a running fold, as a power of two.
RUN_BITS = 6
# Bits of a lookup of keys, as a power of two: 4 MB, however many keys there are.
LOOKUP_BITS = 25


def text_or_empty(col: str | Column = "text") -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(col, F.lit(""))


def words(col: str | Column = "text") -> Column:
    """Array of the words of a text; empty for a null or blank text."""
    trimmed = F.btrim(text_or_empty(col), F.lit(SPACES))
    return (F.when(trimmed == "", F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, NON_WORD)))


def unit_random(*cols) -> Column:
    """A number in [0, 1) that depends on the given columns alone, so a
    recomputed task or a rerun draws the same one."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") / F.lit(float(2 ** 53))


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = 2000):
    """Jobs run inside hand Python at most ``rows`` rows of long texts at once,
    which bounds what a task holds on both sides."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def with_maybe_in(rows: DataFrame, keys: DataFrame, column: str, flag: str) -> DataFrame:
    """``rows`` with ``flag``: false where ``column`` is surely not among the keys'
    (never null) values of it, by one bit of a lookup of fixed size that goes to all tasks.
    Before an exact join, so that few rows without a partner are moved."""
    place = F.shiftrightunsigned(F.xxhash64(column), 64 - LOOKUP_BITS)
    bits = keys.select(place.alias("_b")).groupBy(F.shiftright("_b", 6).alias("_w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(_b & 63 as int))")).alias("_v"))
    found = rows.withColumn("_b", place).withColumn("_w", F.shiftright("_b", 6)).join(F.broadcast(bits), "_w", "left")
    bit = F.getbit(F.coalesce("_v", F.lit(0)), F.col("_b").bitwiseAND(F.lit(63)).cast("int"))
    return found.withColumn(flag, bit == 1).drop("_b", "_w", "_v")


def maybe_in(rows: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """``rows`` but those whose ``column`` is surely not among the keys'."""
    return with_maybe_in(rows, keys, column, "_in").filter("_in").drop("_in")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running_before(values: Column, combine: Callable[[Column, Column], Column], zero: Column) -> Column:
    """Per element of an array the combination (a sum, a maximum) of all elements
    before it. Whole runs of ``1 << RUN_BITS`` elements are combined first, so the
    cost is a few dozen steps per element; appending to an array in a fold would
    copy it at every step."""
    fold = lambda part: F.aggregate(part, zero, lambda a, b: combine(a, b))
    run = lambda v, r: F.slice(v, F.shiftleft(r, RUN_BITS) + 1, F.lit(1 << RUN_BITS))

    def starts(v: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.shiftright(F.size(v) - 1, RUN_BITS)), lambda r: fold(run(v, r)))
        return let(runs, lambda whole: let(
            F.transform(whole, lambda _, r: fold(F.slice(whole, F.lit(1), r))),
            lambda upto: F.transform(v, lambda _, i: combine(
                F.get(upto, F.shiftright(i, RUN_BITS)),
                fold(F.slice(v, F.shiftleft(F.shiftright(i, RUN_BITS), RUN_BITS) + 1, i.bitwiseAND((1 << RUN_BITS) - 1)))))))
    return F.when(F.size(values) > 0, let(values, starts)).otherwise(F.slice(values, 1, 0))


def only(df: DataFrame, *cols: str) -> DataFrame:
    """The named columns alone: extra columns of the input cannot clash with
    the working columns of an operator."""
    return df.select(*[F.col(f"`{c}`") for c in cols])


def with_row(df: DataFrame, *cols: str) -> DataFrame:
    """The whole row as one struct ``row`` beside the named columns, for
    operators that hand rows on unchanged; ``row.*`` brings it back."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
                     *[F.col(f"`{c}`") for c in cols])

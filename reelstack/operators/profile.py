"""Row counts and column profiles, each in a single aggregation job."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .setops import union_all


def count_tables(tables: dict[str, DataFrame], name_col: str = "tbl",
                 count_col: str = "n") -> DataFrame:
    """One row per table with its row count (a union of global aggregates:
    one job, each branch counts with a partial aggregate)."""
    return union_all(*[
        df.agg(F.count(F.lit(1)).alias(count_col))
          .select(F.lit(name).alias(name_col), F.col(count_col))
        for name, df in tables.items()
    ])


def profile(df: DataFrame, cols=None, digits: int | None = None) -> DataFrame:
    """Profile of numeric and text columns, one row per column: count, mean and
    sample stddev (null for text), min and max as exact text. All statistics of
    all columns come from one pass; the single result row is then unpivoted.
    ``digits`` rounds mean and stddev."""
    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    types = dict(df.dtypes)
    number = lambda c: types[c] in numeric or types[c].startswith("decimal")
    cols = cols or [c for c in df.columns if number(c) or types[c] == "string"]
    assert all(c in types for c in cols), f"unknown column in {cols}"
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double") if number(c) else F.lit(None).cast("double")
        mean, std = F.avg(x), F.stddev_samp(x)
        if digits is not None:
            mean, std = F.round(mean, digits), F.round(std, digits)
        aggs += [F.count(F.col(c)).alias(f"c{i}"), mean.alias(f"m{i}"), std.alias(f"s{i}"),
                 F.min(c).cast("string").alias(f"lo{i}"), F.max(c).cast("string").alias(f"hi{i}")]
    row = df.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("col"), F.col(f"c{i}").alias("cnt"), F.col(f"m{i}").alias("mean"),
                 F.col(f"s{i}").alias("stddev"), F.col(f"lo{i}").alias("mn"),
                 F.col(f"hi{i}").alias("mx"))
        for i, c in enumerate(cols)
    ]))
    return row.select(rows.alias("p")).select("p.*")


def describe(df: DataFrame, cols=None) -> DataFrame:
    """count, mean, stddev, min, max of numeric *and* text columns, every
    statistic as text, one row per statistic (Spark's ``describe``: one
    aggregation pass). ``profile`` is the form with one row per column."""
    return df.describe(*(cols or []))


# A profile that merges: per column the count, mean and sum of squared
# deviations, and the extremes in a column of their own kind.
_KINDS = {"tinyint": "whole", "smallint": "whole", "int": "whole", "bigint": "whole", "float": "float",
          "double": "double", "string": "text"}


def profile_state(df: DataFrame, cols=None) -> DataFrame:
    """Mergeable profile of a table, or of one write of it: a row per column
    with ``n`` (rows), ``cnt``, ``mean``, ``m2`` and the extremes. One pass over
    the rows; ``merge_profiles`` needs none. A row with the column ``*`` holds the number
    of rows alone, so a table without such columns counts, too."""
    types = {c: _KINDS.get(t, "double" if t.startswith("decimal") else None) for c, t in df.dtypes}
    cols = [c for c in cols or df.columns if types[c]]
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(cols):
        x = F.col(c).cast("double") if types[c] != "text" else F.lit(None).cast("double")
        aggs += [F.count(c).alias(f"c{i}"), F.avg(x).alias(f"m{i}"), (F.var_pop(x) * F.count(x)).alias(f"q{i}"),
                 F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]
    row = df.agg(*aggs)

    def one(name, kind, cnt, mean, m2, lo, hi):
        as_kind = lambda v, k, t: (v if kind in k else F.lit(None)).cast(t)
        number = ("float", "double")
        return F.struct(F.lit(name).alias("col"), F.lit(kind).alias("kind"), cnt.alias("cnt"), mean.alias("mean"), m2.alias("m2"),
                        *[as_kind(v, k, t).alias(f"{side}_{t}") for side, v in (("lo", lo), ("hi", hi))
                          for k, t in ((("whole",), "bigint"), (number, "double"), (("text",), "string"))])

    none = F.lit(None)
    rows = [one("*", "rows", F.col("n"), none.cast("double"), none.cast("double"), none, none)]
    rows += [one(c, types[c], F.col(f"c{i}"), F.col(f"m{i}"), F.col(f"q{i}"), F.col(f"lo{i}"), F.col(f"hi{i}"))
             for i, c in enumerate(cols)]
    return row.select("n", F.explode(F.array(*rows)).alias("p")).select("n", "p.*")


def merge_profiles(states: DataFrame, by=(), digits: int | None = None) -> DataFrame:
    """The profile (columns of ``profile``, and ``n_rows``) of all writes whose
    states are given, per ``by`` columns, from a few rows per write. Deviations
    are put together around the common mean, so nothing cancels."""
    by = list(by)
    group = Window.partitionBy(*by, "col")
    total = F.sum("cnt").over(group)
    # Around one of the means, so that large means do not eat the digits.
    base = F.min("mean").over(group)
    mean = base + F.sum("_off").over(group) / F.nullif(total, F.lit(0))
    states = states.withColumn("_off", F.col("cnt") * (F.col("mean") - base))
    shifted = states.withColumn("_mean", mean).withColumn(
        "_m2", F.coalesce("m2", F.lit(0.0)) + F.col("cnt") * F.pow(F.coalesce("mean", F.col("_mean")) - F.col("_mean"), 2))
    merged = shifted.groupBy(*by, "col", "kind").agg(
        F.sum("n").alias("n_rows"), F.sum("cnt").alias("cnt"), F.max("_mean").alias("mean"), F.sum("_m2").alias("_m2"),
        *[f(f"{side}_{t}").alias(f"{side}_{t}") for side, f in (("lo", F.min), ("hi", F.max))
          for t in ("bigint", "double", "string")])
    number = F.col("kind").isin("whole", "float", "double")
    deviation = F.when(number & (F.col("cnt") > 1), F.sqrt(F.col("_m2") / (F.col("cnt") - 1)))
    rounded = (lambda c: c) if digits is None else (lambda c: F.round(c, digits))
    text = lambda side: F.coalesce(
        F.col(f"{side}_bigint").cast("string"),
        F.when(F.col("kind") == "float", F.col(f"{side}_double").cast("float").cast("string")).otherwise(
            F.col(f"{side}_double").cast("string")), F.col(f"{side}_string"))
    return merged.select(*by, "col", "n_rows", "cnt", rounded(F.when(number, F.col("mean"))).alias("mean"),
                         rounded(deviation).alias("stddev"), text("lo").alias("mn"), text("hi").alias("mx"))

"""Surrogate keys: the distributed numbering equals the single-task window."""

import datetime
import decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from reelstack import operators as op
from reelstack.operators import keys as keys_mod

from .conftest import rows


def test_dense_key_prefixed(spark):
    df = spark.createDataFrame([(2003,), (2001,), (2002,)], "ano int")
    assert rows(op.dense_key(df, "ano", "id_data", "dt")) == [(2001, "dt1"), (2002, "dt2"),
                                                              (2003, "dt3")]


def test_dense_key_scaled_equals_window_on_150k_rows(spark):
    df = spark.range(150_000).select((F.col("id") * 7919 % 150_001).alias("k"))
    expected = op.dense_key(df, "k", "n", "tig")
    got = op.dense_key_scaled(df, "k", "n", "tig", buckets=16)
    assert got.count() == 150_000
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_row_number_scaled_partitioned_with_hot_group(spark):
    # Group 0 holds half of all rows; it is split over many buckets.
    df = spark.range(20_000).select(
        F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 37).alias("g"),
        (F.col("id") * 31 % 20_011).alias("o"))
    w = Window.partitionBy("g").orderBy("o")
    expected = df.withColumn("rn", F.row_number().over(w).cast("bigint"))
    got = op.row_number_scaled(df, "o", "rn", partition_by="g", buckets=8)
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 3) | st.none(), st.integers(-50, 50)), max_size=60),
       st.integers(1, 6))
def test_row_number_scaled_property(spark, data, buckets):
    data = [(g, o, i) for i, (g, o) in enumerate(data)]  # i makes the order total
    df = spark.createDataFrame(data, "g int, o int, i int")
    w = Window.partitionBy("g").orderBy("o", "i")
    expected = rows(df.withColumn("rn", F.row_number().over(w).cast("bigint")))
    got = rows(op.row_number_scaled(df, ["o", "i"], "rn", partition_by="g", buckets=buckets)
               .select("g", "o", "i", "rn"))
    assert got == expected


def test_scaled_keys_are_stable_across_runs_and_partitionings(spark):
    df = spark.range(5000).select((F.col("id") * 13 % 5003).alias("k"))
    a = op.dense_key_scaled(df.repartition(3), "k", "n", "ti", buckets=5)
    b = op.dense_key_scaled(df.repartition(11), "k", "n", "ti", buckets=9)
    assert rows(a) == rows(b)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 1000)), min_size=1, max_size=80,
                unique=True), st.integers(1, 7))
def test_keep_first_is_independent_of_partitioning(spark, data, parts):
    df = spark.createDataFrame(data, "id int, ord int")
    one = rows(op.keep_first(df.coalesce(1), "id", ["ord"]))
    many = rows(op.keep_first(df.repartition(parts), "id", ["ord"]))
    expected = sorted((i, min(o for j, o in data if j == i)) for i in {i for i, _ in data})
    assert one == many == expected


def test_scaled_numbering_of_empty_input(spark):
    df = spark.createDataFrame([], "k long, g string")
    assert op.dense_key_scaled(df, "k", "n", "ti").count() == 0
    assert op.row_number_scaled(df, "k", "n", partition_by="g").count() == 0


@pytest.mark.parametrize("dtype, make", [
    ("date", lambda i: datetime.date(2000, 1, 1) + datetime.timedelta(days=i)),
    ("timestamp_ntz", lambda i: datetime.datetime(2000, 1, 1, 0, 0, i % 60, i)),
    ("double", lambda i: i / 7.0 - 50),
    ("decimal(12,2)", lambda i: decimal.Decimal(i) / 4),
    ("string", lambda i: f"tt{i * 37 % 1000:07d}"),
    ("boolean", lambda i: i % 3 == 0),
])
def test_scaled_numbering_key_types(spark, dtype, make):
    data = [(make(i) if i % 17 else None, i) for i in range(400)]
    df = spark.createDataFrame(data, f"k {dtype}, i int")
    w = Window.orderBy("k", "i")
    expected = rows(df.withColumn("n", F.row_number().over(w).cast("bigint")))
    got = rows(op.row_number_scaled(df, ["k", "i"], "n", buckets=7))
    assert got == expected
    single = rows(op.row_number_scaled(df.select("k").distinct(), "k", "n", buckets=5))
    assert [r[1] for r in single] == list(range(1, len(single) + 1))


def test_null_and_repeated_keys_spread_over_ranges(spark, monkeypatch):
    """Half the keys null, a quarter one value: no range holds much more than
    its share, and the numbers are those of one window over the whole order."""
    df = spark.range(40_000).select(
        F.when(F.col("id") % 2 == 0, F.lit(None)).when(F.col("id") % 4 == 1, F.lit("hot"))
        .otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k"), "id")
    stored = []
    real = keys_mod.materialize
    monkeypatch.setattr(keys_mod, "materialize", lambda d, n: stored.append(real(d, n)) or stored[-1])
    got = op.row_number_scaled(df, "k", "n", buckets=16)
    sizes = [r["count"] for r in stored[0].groupBy("_rk_part").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 40_000 / 16
    assert got.agg(F.min("n"), F.max("n"), F.count_distinct("n")).first() == (1, 40_000, 40_000)
    w = Window.orderBy("n")
    down = got.withColumn("prev", F.lag("k").over(w)).filter("prev > k or (k is null and prev is not null)")
    assert down.count() == 0


def test_identical_rows_are_numbered_apart(spark):
    df = spark.range(5000).select(F.lit("same").alias("k"))
    out = op.dense_key_scaled(df, "k", "n", buckets=4)
    assert out.select("n").distinct().count() == 5000 and out.agg(F.max("n")).first()[0] == 5000


def test_scaled_numbering_with_awkward_column_names(spark):
    df = spark.createDataFrame([(i % 3, i) for i in range(50)], "`it's` int, `a b` int")
    w = Window.orderBy("it's", "a b")
    expected = rows(df.withColumn("n", F.row_number().over(w).cast("bigint")))
    assert rows(op.row_number_scaled(df, ["it's", "a b"], "n", buckets=4)) == expected

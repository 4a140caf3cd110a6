"""Column functions: lenient casts, keywords, JSON fields, paths (FIXTURES A4 edge values)."""

import pytest
from pyspark.sql import functions as F

from reelstack import functions as fn
from reelstack.functions import casts


def test_lenient_int_never_throws(spark):
    df = spark.createDataFrame([("\\N",), ("",), ("29.9",), (None,), ("80",), ("-3.7",),
                                ("9999999999",), (" 42 ",), ("abc",)], "s string")
    got = [r.v for r in df.select(fn.to_int("s").alias("v")).collect()]
    assert got == [None, None, 29, None, 80, -3, None, 42, None]


def test_lenient_long_keeps_money_above_int32(spark):
    df = spark.createDataFrame([("2923706026",), ("2923706026.9",), (None,)], "s string")
    got = [r.v for r in df.select(fn.to_long("s").alias("v")).collect()]
    assert got == [2923706026, 2923706026, None]
    nums = spark.createDataFrame([(2923706026.0,), (0.5,)], "d double")
    assert [r.v for r in nums.select(fn.to_long("d").alias("v")).collect()] == [2923706026, 0]
    # int32 target: overflow is null, never a wrapped negative number.
    assert [r.v for r in nums.select(fn.to_int("d").alias("v")).collect()] == [None, 0]


def test_lenient_float_and_double(spark):
    df = spark.createDataFrame([("7.5",), ("\\N",), ("",)], "s string")
    assert [r.v for r in df.select(fn.to_float("s").alias("v")).collect()] == [7.5, None, None]
    assert [r.v for r in df.select(fn.to_double("s").alias("v")).collect()] == [7.5, None, None]


def test_keyword_any_substring_case_and_null(spark):
    df = spark.createDataFrame([("Harry Potter",), ("young harry potter",), ("Bella Swan (voice)",),
                                (None,), ("a.b",), ("axb",)], "t string")
    hit = df.filter(fn.keyword_any("t", ["Harry Potter", "Bella Swan", "a.b"]))
    assert sorted(r.t for r in hit.collect()) == ["Bella Swan (voice)", "Harry Potter", "a.b"]
    # regex=True: the words are patterns ('.' matches any character).
    assert df.filter(fn.keyword_any("t", ["a.b"], regex=True)).count() == 2


def test_regex_escape_is_literal(spark):
    df = spark.createDataFrame([("Sci-Fi (1999) [x]",), ("Sci-Fi 1999 x",)], "t string")
    pat = fn.regex_escape("(1999) [x]")
    assert df.filter(F.col("t").rlike(pat)).count() == 1


def test_json_fields_missing_key_is_null(spark):
    df = spark.createDataFrame([('{"budget": 10, "imdb_id": "tt1"}',), ('{"runtime": 90}',),
                                ("not json",)], "j string")
    got = df.select(fn.json_fields("j", {"budget": "bigint", "imdb_id": "string",
                                         "runtime": "int"}).alias("x")).select("x.*").collect()
    assert [tuple(r) for r in got] == [(10, "tt1", None), (None, None, 90), (None, None, None)]


def test_date_path_and_base_name(spark):
    df = spark.createDataFrame([("2024-04-12", "s3://b/Raw/x/movies.csv")], "d string, p string")
    r = df.select(fn.date_path(F.to_date("d")).alias("dp"), fn.base_name("p").alias("b")).first()
    assert (r.dp, r.b) == ("2024/04/12", "movies.csv")


def test_predicates(spark):
    df = spark.createDataFrame([(2000, 79, 0, None), (2001, 80, 1, "tt1"), (2015, 100, 5, "tt2"),
                                (2016, 80, 1, "tt3")], "y int, m int, b int, i string")
    keep = df.filter(fn.all_of(fn.between("y", 2001, 2015), fn.at_least("m", 80),
                               fn.positive("b"), fn.present("i")))
    assert sorted(r.i for r in keep.collect()) == ["tt1", "tt2"]
    assert df.filter(fn.any_of(fn.id_in("i", ["tt1"]), fn.id_not_in("y", [2000, 2001, 2015]))) \
        .count() == 2


@pytest.mark.parametrize("kind", ["tinyint", "int", "bigint"])
def test_whole_is_the_plain_casts(spark, kind):
    texts = [None, "", " ", "7", " 7 ", "+7", "-7", "7.", "7.0", ".5", "7.9", "-0", "1e3", "1E3", "7d", "7L", "0x1F", "NaN", "Infinity",
             "\\N", "n/a", "--7", "7-", "7 7", "\t7\n", "9" * 30, "9007199254740993", "9007199254740993.0", "300", "\u0667", "7,5", "7\u00a0"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.coalesce(F.col("t").try_cast(kind), F.col("t").try_cast("double").try_cast(kind))
    got = rows.select("t", plain.alias("a"), casts.whole("t", kind).alias("b")).collect()
    assert [(r.t, r.b) for r in got] == [(r.t, r.a) for r in got]
    money = spark.range(1).select(F.lit("9007199254740993.50").cast("decimal(20,2)").alias("m"), F.lit(7.9).alias("d"))
    assert tuple(money.select(casts.whole("m", "bigint"), casts.whole("d", kind)).first()) == (9007199254740993, 7)

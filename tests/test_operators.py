"""DataFrame operators on small hand-made frames with the edge rows of FIXTURES.md."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from reelstack import operators as op

from .conftest import rows


def test_project_rename_drop_missing_names_are_ignored(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "id long, t string, x double")
    out = op.drop_cols(op.rename(df, {"id": "imdb_id", "nope": "zz"}), "x", "nope")
    assert out.columns == ["imdb_id", "t"]
    assert op.project(df, {"k": "id", "titulo": F.upper("t")}).first() == (1, "A")


def test_fill_nulls_casts_value_to_column_type(spark):
    df = spark.createDataFrame([(None, None, None)], "genero string, ano string, m int")
    r = op.fill_nulls(df, {"genero": "", "ano": 0, "m": 0, "missing": 1}).first()
    assert (r.genero, r.ano, r.m) == ("", "0", 0)


def test_stamp_and_move_last(spark):
    df = spark.createDataFrame([("tt1", 1, 2)], "imdb_id string, a int, b int")
    out = op.stamp(op.move_last(df, "imdb_id"), "data_coleta_tmdb", "2024/04/12")
    assert out.columns == ["a", "b", "imdb_id", "data_coleta_tmdb"]
    assert out.first().data_coleta_tmdb == "2024/04/12"


def test_keep_and_drop_ids_of_any_length_and_kind(spark):
    df = spark.createDataFrame([("tt1",), ("tt2",), ("tt3",), (None,)], "id string")
    assert rows(op.keep_ids(df, "id", ["tt1", "tt3", "tt9"])) == [("tt1",), ("tt3",)]
    assert rows(op.drop_ids(df, "id", ["tt1"])) == [("tt2",), ("tt3",)]
    # The same answer for three ids, twelve thousand, and a table of ids; a null
    # id in the list changes nothing.
    many = [f"x{i}" for i in range(12_000)]
    for extra in ([], many):
        ids = ["tt1", None, "tt9", *extra]
        table = spark.createDataFrame([(i,) for i in ids], "k string")
        for form in (ids, iter(ids), table):
            assert rows(op.keep_ids(df, "id", form)) == [("tt1",)]
        for form in (ids, iter(ids), table):
            assert rows(op.drop_ids(df, "id", form)) == [("tt2",), ("tt3",)]
    assert rows(op.keep_ids(df, "id", [])) == [] and op.drop_ids(df, "id", []).count() == 3


def test_keep_first_picks_first_in_order(spark):
    df = spark.createDataFrame(
        [(7, 2001, 878, 1, 0), (7, 2001, 14, 3, 5), (8, 2002, 14, 2, 1), (8, 2002, 14, 1, 9)],
        "id long, ano int, genre int, page int, pos int")
    out = op.keep_first(df, "id", ["ano", "genre", "page", "pos"])
    assert rows(out, "id", "genre", "page") == [(7, 14, 3), (8, 14, 1)]


def test_keep_one_and_distinct(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "id int, t string")
    assert rows(op.keep_one(df, "id")) == [(1, "a"), (2, "b")]
    assert op.distinct_rows(df).count() == 2
    assert op.distinct_rows(df, ["t"]).count() == 2


def test_join_on_key_and_enrich(spark):
    movies = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "id long, title string")
    details = spark.createDataFrame([(3, 90), (1, None)], "mid long, runtime int")
    out = op.enrich(movies, details, "id", "mid")
    assert rows(out) == [(1, "x", None), (2, "y", None), (3, "z", 90)]
    repeated = details.union(spark.createDataFrame([(3, 10), (3, 95)], "mid long, runtime int"))
    for d in (repeated, repeated.repartition(5)):
        assert rows(op.enrich(movies, d, "id", "mid")) == [(1, "x", None), (2, "y", None), (3, "z", 10)]
    inner = op.join_on_key(movies, details, "id", "mid")
    assert sorted(inner.columns) == ["id", "mid", "runtime", "title"] and inner.count() == 2


def test_lookup_key_keeps_fact_grain_and_fanout_counts(spark):
    # Three movies in one year: 9 rows with the per-movie date grain, 3 with DISTINCT.
    fact = spark.createDataFrame([(1, 2001), (2, 2001), (3, 2001), (4, 2002)], "id long, ano int")
    dim = op.dense_key(fact.select("ano").distinct(), "ano", "id_data", "dtg")
    out = op.lookup_key(fact, dim, "ano", "ano", "id_data")
    assert rows(out, "id", "id_data") == [(1, "dtg1"), (2, "dtg1"), (3, "dtg1"), (4, "dtg2")]
    per_row = op.fanout_counts(fact, fact.select("ano"), "ano", "ano")
    assert rows(per_row) == [(2001, 9), (2002, 1)]


def test_union_typed_reconciles_types(spark):
    a = spark.createDataFrame([("tt1", 2001.0, "95")], "id string, ano float, m string")
    b = spark.createDataFrame([("tt2", 2002, 100)], "id string, ano int, m int")
    schema = StructType([StructField("id", a.schema["id"].dataType),
                         StructField("ano", IntegerType()), StructField("m", IntegerType())])
    out = op.union_typed(schema, a, b)
    assert out.dtypes == [("id", "string"), ("ano", "int"), ("m", "int")]
    assert rows(out) == [("tt1", 2001, 95), ("tt2", 2002, 100)]
    dirty = spark.createDataFrame([("tt3", "\\N", "29.9"), ("tt4", "", "x")], "id string, ano string, m string")
    assert rows(op.union_typed(schema, dirty, b)) == [("tt2", 2002, 100), ("tt3", None, 29), ("tt4", None, None)]


def test_union_filters_is_bag_union_of_branches(spark):
    df = spark.createDataFrame([(1, "small ring"), (2, "gear"), (3, None), (4, "x")],
                               "k int, t string")
    branches = {"ring": F.col("t").contains("ring"), "small": F.col("t").contains("small"),
                "gear": F.col("t").contains("gear")}
    one_pass = op.union_filters(df, branches)
    union = op.union_all(*[df.filter(p) for p in branches.values()])
    assert rows(one_pass) == rows(union) == [(1, "small ring"), (1, "small ring"), (2, "gear")]
    assert "tag" in op.union_filters(df, branches, tag="tag").columns


def test_preview_and_sort(spark):
    df = spark.range(100).select(F.col("id").alias("k"))
    assert [r.k for r in op.preview(df, F.col("k").desc(), 3).collect()] == [99, 98, 97]
    assert [r.k for r in op.sort_by(df, "k").limit(2).collect()] == [0, 1]


def test_count_tables_and_profile(spark):
    a = spark.range(5)
    b = spark.createDataFrame([(1, 2.0), (3, None), (None, 4.0)], "x int, y double")
    assert rows(op.count_tables({"a": a, "b": b})) == [("a", 5), ("b", 3)]
    prof = {r.col: r for r in op.profile(b).collect()}
    assert prof["x"].cnt == 2 and prof["x"].mean == 2.0 and prof["x"].mn == "1"
    assert prof["y"].stddev == pytest.approx(1.4142, abs=1e-4) and prof["y"].mx == "4.0"
    big = spark.createDataFrame([(9007199254740993, "b"), (2, None), (3, "a")], "n long, t string")
    prof = {r.col: r for r in op.profile(big).collect()}
    assert prof["n"].mx == "9007199254740993" and (prof["t"].cnt, prof["t"].mn, prof["t"].mx) == (2, "a", "b")
    assert prof["t"].mean is None and prof["n"].mean == pytest.approx(9007199254740998 / 3)


def test_run_sql_with_parameter_markers(spark):
    df = spark.createDataFrame([("tt1", 2001), ("tt2", 2002), ("tt3", 2003)], "id string, y int")
    markers, args = op.in_list_markers("p", ["tt1", "tt3"])
    out = op.run_sql(spark, {"geral_view": df},
                     f"SELECT id AS ts_imdb_id FROM geral_view WHERE id IN {markers}", args)
    assert rows(out) == [("tt1",), ("tt3",)]
    assert not spark.catalog.tableExists("geral_view")  # the view is gone, the result stays
    assert op.in_list_markers("p", []) == ("(NULL)", {})
    assert op.run_sql(spark, {"v": df}, "SELECT id FROM v WHERE id IN (NULL)").count() == 0


def test_unique_key_is_unique(spark):
    df = spark.range(1000).repartition(4)
    out = op.unique_key(df, "k")
    assert out.select("k").distinct().count() == 1000
    assert out.agg(F.min("k")).first()[0] == 1
    assert dict(out.dtypes)["k"] == "bigint" and LongType


def test_describe_covers_text_columns(spark):
    df = spark.createDataFrame([("b", 1), ("a", 3)], "t string, x int")
    stats = {r.summary: r for r in op.describe(df).collect()}
    assert stats["count"].t == "2" and stats["min"].t == "a" and stats["max"].x == "3"

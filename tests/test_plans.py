"""Physical-plan properties the design relies on (checked with explain)."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from reelstack import operators as op
from reelstack.plans.acceptance import QUERIES, table
from reelstack.session import scratch_path
from reelstack.sources.readers import decode_ndjson, scan_ndjson_checked

from .conftest import SF001

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
                "PythonUDF", "MapInArrow")


def plan(df, mode="simple") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def test_keep_first_limits_before_the_shuffle(spark):
    events = table(spark, SF001, "events")
    text = plan(op.keep_first(events, "user_id", ["event_id"]))
    partial = text.index("WindowGroupLimit")  # innermost first in reading order is the final one
    assert "Partial" in text and "Final" in text
    lines = [ln for ln in text.splitlines() if "WindowGroupLimit" in ln or "Exchange" in ln]
    kinds = [("partial" if "Partial" in ln else "final" if "Final" in ln else "exchange")
             for ln in lines]
    assert kinds.index("exchange") < kinds.index("partial") and partial >= 0


def test_scaled_key_never_funnels_rows_into_one_partition(spark):
    df = table(spark, SF001, "orders").select("o_orderkey")
    text = plan(op.dense_key_scaled(df, "o_orderkey", "k", "tig"))
    assert "SinglePartition" not in text and "Window" not in text
    plain = plan(op.dense_key(df, "o_orderkey", "k", "tig"))
    assert "SinglePartition" in plain  # the reason dense_key is for small inputs only


def test_subset_filter_reaches_both_scans(spark):
    from reelstack.plans.star import joined_base
    movies = table(spark, SF001, "lineitem").select(F.col("l_orderkey").alias("imdb_id"))
    api = table(spark, SF001, "orders").select(F.col("o_orderkey").alias("imdb_id"),
                                               "o_totalprice")
    base = op.keep_ids(joined_base(movies, api), "imdb_id", [1, 5, 9])
    text = plan(base, "formatted")
    pushed = [ln for ln in text.splitlines() if "PushedFilters" in ln]
    assert len(pushed) == 2 and all("In(" in ln for ln in pushed), pushed


def test_projection_prunes_the_scan(spark):
    text = plan(QUERIES["scan_parquet_layer"](spark, SF001), "formatted")
    schema = [ln for ln in text.splitlines() if "ReadSchema" in ln][0]
    assert "p_partkey" in schema and "p_brand" not in schema and "p_retailprice" not in schema


def test_id_in_is_pushed_to_parquet(spark):
    text = plan(QUERIES["id_in"](spark, SF001), "formatted")
    pushed = [ln for ln in text.splitlines() if "PushedFilters" in ln]
    assert len(pushed) == 1 and "In(o_orderkey, [1,410,5,77,9])" in pushed[0], pushed


def test_union_branches_scans_once(spark):
    text = plan(QUERIES["union_branches"](spark, SF001))
    assert text.count("FileScan parquet") == 1 and "Union" not in text
    pushed = [ln for ln in plan(QUERIES["union_branches"](spark, SF001), "formatted").splitlines()
              if "PushedFilters" in ln]
    assert "StringContains(p_name,ring)" in pushed[0], pushed


def test_year_range_is_pushed(spark):
    text = plan(QUERIES["year_between"](spark, SF001), "formatted")
    pushed = [ln for ln in text.splitlines() if "PushedFilters" in ln][0]
    assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThan(o_orderdate" in pushed


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_evaluation(spark, name):
    text = plan(QUERIES[name](spark, SF001))
    assert not any(node in text for node in PYTHON_NODES), name


def test_star_fact_needs_no_shuffled_join(spark):
    from reelstack.plans.star import GENERAL, build_star, joined_base
    movies = table(spark, SF001, "lineitem").select(F.col("l_orderkey").alias("imdb_id"))
    api = table(spark, SF001, "orders").select(
        F.col("o_orderkey").alias("imdb_id"), F.year("o_orderdate").alias("anoLancamento_tmdb"),
        F.col("o_totalprice").alias("orcamento"))
    fact = build_star(joined_base(movies, api), GENERAL, measures=["orcamento"])[GENERAL.fact]
    text = plan(fact)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    # the only shuffle left is the tiny DISTINCT of years feeding the lookup
    exchanges = [ln for ln in text.splitlines() if "Exchange hashpartitioning" in ln]
    assert all("Ano_Lancamento" in ln or "anoLancamento_tmdb" in ln for ln in exchanges), exchanges


def test_flatten_pages_never_shuffles_pages_by_group(spark):
    from reelstack.sources import flatten_pages
    pages = spark.createDataFrame(
        [(2001, 14, 1, 200, 1, [(1, "a", "d", 1.0, 1.0, 1, False)])],
        "ano int, genre_id int, page int, status int, total_pages int, "
        "results array<struct<id:bigint,title:string,release_date:string,popularity:double,"
        "vote_average:double,vote_count:bigint,adult:boolean>>")
    path = scratch_path(spark, "pages")
    pages.write.json(path)
    landed = spark.read.schema(pages.schema).json(path)
    text = plan(flatten_pages(landed, ["ano", "genre_id"]))
    kept_side = text.split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in kept_side


def test_checked_lines_are_decoded_once(spark):
    """Filters on decoded columns must not decode a line once per field."""
    path = scratch_path(spark, "lines")
    spark.range(3).select(F.to_json(F.struct("id", (F.col("id") * 2.0).alias("budget"))).alias("value")).write.text(path)
    schema = StructType([StructField("id", LongType()), StructField("budget", LongType())])
    rows, rejects = scan_ndjson_checked(spark, path, schema)
    for df in (rows.filter("budget > 0 AND id >= 0"), rejects):
        assert plan(df, "extended").split("Optimized Logical Plan")[1].count("from_json(") <= 2  # both plans name it
    assert sorted(rows.collect()) == [(0, 0), (1, 2), (2, 4)]
    decoded = decode_ndjson(spark, path, schema)
    assert plan(decoded, "extended").split("Optimized Logical Plan")[1].split("Physical Plan")[0].count("from_json(") == 1

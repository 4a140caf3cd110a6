"""Published stars, stable keys, merged profiles, bucketed joins, drifting JSON."""

import contextlib
import glob
import io
import json
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType)

from reelstack import operators as op, sources as src
from reelstack.layout import Layout
from reelstack.params import ApiParams
from reelstack.plans import jobs
from reelstack.schemas import API_RAW, PAGES_RAW
from reelstack.session import materialize, scratch_path, scratch_scope
from reelstack.storage import Store

from .conftest import rows

DAY = "2024-04-12"


def local(path):
    return path.removeprefix("file:")


# ------------------------------------------------------------------ the star


def _tables(spark, n, name="t"):
    dim = spark.range(n).select(F.col("id").alias("k"), F.concat(F.lit(name), "id").alias("title"))
    return {"dim": dim, "fact": dim.select("k", (F.col("k") * 2).alias("v"))}


def test_a_star_is_published_as_one_and_old_versions_go(spark):
    root = scratch_path(spark, "star")
    first = src.write_star(_tables(spark, 3, "a"), root)
    held = src.read_star(spark, root)
    src.write_star(_tables(spark, 5, "b"), root)
    assert held["fact"].count() == 3 and spark.read.parquet(first["dim"]).count() == 3  # still readable
    now = src.read_star(spark, root)
    assert {n: df.count() for n, df in now.items()} == {"dim": 5, "fact": 5}
    assert {p.split("/")[-2] for p in src.star_paths(spark, root).values()} == {"v=2"}
    src.write_star(_tables(spark, 1), root)
    assert Store(spark, root).names(root) == ["v=2", "v=3"]
    with pytest.raises(FileNotFoundError):
        src.star_paths(spark, scratch_path(spark, "nothing"))


def test_a_star_job_that_dies_leaves_the_old_star(spark):
    root = scratch_path(spark, "star")
    src.write_star(_tables(spark, 3), root)
    bad = _tables(spark, 4)
    bad["fact"] = bad["fact"].withColumn("v", F.raise_error(F.lit("killed")).cast("long"))
    with pytest.raises(Exception, match="killed"):
        src.write_star(bad, root)
    assert src.read_star(spark, root)["dim"].count() == 3
    assert Store(spark, root).names(root) == ["v=1"]


def test_report_reads_kept_profiles_only(spark):
    root = scratch_path(spark, "star")
    paths = src.write_star(_tables(spark, 4), root)
    Store(spark, root).delete(paths["fact"])  # the rows are not needed
    counts, profiles = jobs.star_report(spark, paths)
    assert rows(counts, "tbl", "n") == [("dim", 4), ("fact", 4)]
    got = {(r.tbl, r.col): (r.cnt, r["mean"], r.mn, r.mx) for r in profiles.collect()}
    assert got[("fact", "v")] == (4, 3.0, "0", "6") and got[("dim", "title")] == (4, None, "t0", "t3")
    assert ("fact", "v") in got and len(got) == 4


# ---------------------------------------------------------------- stable keys


def test_registry_keeps_numbers_over_extractions(spark):
    root = scratch_path(spark, "keys")
    ids = lambda values: spark.createDataFrame([(v,) for v in values], "tt string")
    first = {r.id: r.number for r in op.register(ids(["c", "a", "b", "a", None]), "tt", root).collect()}
    assert first == {"a": 1, "b": 2, "c": 3}
    second = {r.id: r.number for r in op.register(ids(["d", "b", "Z", None]), "tt", root).collect()}
    assert second == {**first, "Z": 4, "d": 5}  # a and c are gone and keep theirs
    assert {r.id: r.number for r in op.register(ids(["b"]), "tt", root).collect()} == second
    assert Store(spark, root).names(root) == ["batch=1", "batch=2"]
    keyed = op.registered_key(ids(["b", None, "e"]), "tt", "key", root, prefix="tig")
    assert rows(keyed, "tt", "key") == [(None, None), ("b", "tig2"), ("e", "tig6")]


def test_two_writers_do_not_hand_out_a_number_twice(spark, monkeypatch):
    from reelstack.operators import registry
    root = scratch_path(spark, "keys")
    op.register(spark.range(3), "id", root)
    plain = registry.row_number_scaled

    def slow(df, *args, **kw):
        out = plain(df, *args, **kw)
        monkeypatch.setattr(registry, "row_number_scaled", plain)
        op.register(spark.range(3, 5), "id", root)  # the other writer is faster
        return out

    monkeypatch.setattr(registry, "row_number_scaled", slow)
    with pytest.raises(FileExistsError):
        op.register(spark.range(5, 9), "id", root)
    assert rows(op.read_registry(spark, root), "id", "number") == [(i, i + 1) for i in range(5)]


def test_star_keys_stay_the_same(spark):
    from reelstack.plans.star import GENERAL, build_star
    root = scratch_path(spark, "keys")

    def keys(ids, year=2001):
        base = spark.createDataFrame([(i, year + len(i), f"T {i}", True, 10) for i in ids],
                                     "imdb_id string, anoLancamento_tmdb int, tituloPrincipal string, adulto boolean, orcamento int")
        t = build_star(base, GENERAL, measures=["orcamento"], registry=root)
        return ({r.titulo_imdb_id: r.id_titulo for r in t["tabela_titulo"].collect()},
                {r.Ano_Lancamento: r.id_data for r in t["tabela_data"].collect()},
                {r.fato_imdb_id: (r.id_titulo, r.id_data) for r in t["tabela_fato"].collect()})

    titles, years, fact = keys(["b", "dd"])
    assert titles == {"b": "tig1", "dd": "tig2"} and years == {2002: "dtg1", 2003: "dtg2"}
    titles2, years2, fact2 = keys(["a", "dd", "ccc", "x"], 2000)
    assert titles2 == {"dd": "tig2", "a": "tig3", "ccc": "tig4", "x": "tig5"}
    # years: 2001, 2002, 2003 and the known ones keep their keys
    assert years2 == {2001: "dtg3", 2002: "dtg1", 2003: "dtg2"}
    assert fact2["dd"] == ("tig2", "dtg1") and fact["dd"] == ("tig2", "dtg2")


# ------------------------------------------------------------------- profiles


def test_merged_profiles_equal_a_full_pass(spark):
    df = spark.range(1000).select(
        F.col("id").alias("k"), (1e6 + F.rand(3)).alias("x"), F.when(F.col("id") % 7 == 0, F.col("id").cast("float") / 10).alias("f"),
        F.concat(F.lit("é"), F.col("id").cast("string")).alias("s"), (F.col("id") % 3).alias("part"),
        F.lit(None).cast("int").alias("nothing"), (F.lit(2 ** 62) + F.col("id")).alias("big"))
    df = materialize(df, "rows")
    parts = [op.profile_state(df.filter(F.col("part") == p)) for p in range(3)] + [op.profile_state(df.limit(0))]
    merged = {r.col: r for r in op.merge_profiles(op.union_all(*parts)).collect()}
    full = {r.col: r for r in op.profile(df).collect()}
    assert set(merged) == {*full, "*"} and merged["*"].n_rows == 1000
    for c, want in full.items():
        got = merged[c]
        assert (got.cnt, got.mn, got.mx) == (want.cnt, want.mn, want.mx), c
        # Doubles do not tell the values of "big" apart: only its extremes are exact.
        for k in ("mean", "stddev") if c != "big" else ():
            assert got[k] == pytest.approx(want[k], rel=1e-9) if want[k] is not None else got[k] is None, (c, k)


def test_api_profile_merges_days_without_reading_rows(spark):
    layout = Layout(scratch_path(spark, "lake"))
    raw = lambda ids: spark.createDataFrame(
        [(2005, 14, i, f"t{i}", "2005-01-01", 1.0, 7.0, 100, False, 10 * i, f"tt{i}", 100, 5 * i) for i in ids], API_RAW)
    for day, ids in (("2024-04-11", range(1, 6)), (DAY, range(6, 9)), (DAY, range(6, 10))):
        path = scratch_path(spark, "raw")
        raw(ids).write.json(path)
        jobs.trusted_api_job(spark, path, layout, day)
    Store(spark, layout.root).delete(layout.trusted_api)
    got = {r.col: r for r in jobs.api_profile(spark, layout).collect()}
    assert (got["orcamento"].n_rows, got["orcamento"].mn, got["orcamento"].mx, got["orcamento"]["mean"]) == (9, "10", "90", 50.0)
    assert got["orcamento"].stddev == pytest.approx(27.386127875, rel=1e-9)
    assert {(str(r.dt), r.n_rows) for r in jobs.api_profile(spark, layout, by_day=True).collect()} == {("2024-04-11", 5), (DAY, 4)}


# ------------------------------------------------------------------- bucketed


def _plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucketed_tables_join_without_an_exchange(spark, no_broadcast):
    from reelstack.plans.star import joined_base
    movies = spark.range(500).select(F.concat(F.lit("tt"), F.col("id") % 400).alias("imdb_id"), F.col("id").alias("tempoMinutos"))
    api = spark.range(300, 900).select(F.concat(F.lit("tt"), "id").alias("imdb_id"), F.col("id").alias("receita"))
    m, a = (src.sink_bucketed(df, scratch_path(spark, n), "imdb_id", 6) for n, df in (("m", movies), ("a", api)))
    assert len(glob.glob(f"{local(m)}/part-*.parquet")) == 6
    base = joined_base(src.scan_bucketed(spark, m, "imdb_id", 6), src.scan_bucketed(spark, a, "imdb_id", 6))
    assert "Exchange" not in _plan(base) and "SortMergeJoin" in _plan(base)
    assert rows(base) == rows(joined_base(movies, api))
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("reelstack_")]


def test_star_job_on_bucketed_tables_gives_the_same_star(spark):
    plain, bucketed = Layout(scratch_path(spark, "lake")), Layout(scratch_path(spark, "lake"))
    raw = scratch_path(spark, "raw")
    spark.createDataFrame([(2005, 14, i, f"t{i}", "2005-01-01", 1.0, 7.0, 100, False, 10 * i, f"tt{i % 7}", 100, 5 * i)
                           for i in range(1, 30)], API_RAW).write.json(raw)
    movies = spark.range(2, 12).select(F.concat(F.lit("tt"), "id").alias("imdb_id"), F.lit("T").alias("tituloPrincipal"),
                                       F.lit(90).alias("tempoMinutos"))
    src.sink_parquet(movies, plain.trusted_movies)
    src.sink_bucketed(movies, bucketed.trusted_movies, "imdb_id", 4)
    out = []
    for layout, n in ((plain, None), (bucketed, 4)):
        jobs.trusted_api_job(spark, raw, layout, DAY, buckets=n)
        paths = jobs.star_job(spark, layout, DAY, buckets=n)
        out.append({t: rows(spark.read.parquet(p)) for t, p in paths.items()})
    assert out[0] == out[1] and len(out[0]["tabela_fato"]) == 5


# ----------------------------------------------------------------- JSON types


def _write_lines(path, lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def _record(i, **fields):
    return {"Ano": 2005, "Genre_ID": 14, "id": i, "title": f"t{i}", "release_date": "2005-01-01", "popularity": 1.5,
            "vote_average": 7.0, "vote_count": 100, "adult": False, "budget": 1000 + i, "imdb_id": f"tt{i}", "runtime": 95,
            "revenue": 2923706026, **fields}


def test_numbers_that_change_their_type_reach_trusted(spark, tmp_path):
    layout = Layout(scratch_path(spark, "lake"))
    folder = tmp_path / "raw"
    folder.mkdir()
    _write_lines(folder / "a.json", [json.dumps(_record(i)) for i in range(5)])
    _write_lines(folder / "b.json", [json.dumps(_record(i, budget=1000.0 + i, runtime=95.0, vote_count=100.0, revenue=2.923706026e9,
                                                        Ano="2005", adult="false")) for i in range(5, 10)])
    jobs.trusted_api_job(spark, str(folder), layout, DAY, ApiParams(extraction_date="2024/04/12"))
    got = src.scan_layer(spark, layout.trusted_api, dt=DAY)
    assert rows(got, "imdb_id", "orcamento", "receita", "duracao", "anoLancamento_tmdb", "adulto") == [
        (f"tt{i}", 1000 + i, 2923706026, 95, 2005, False) for i in range(10)]
    assert jobs.quarantine_report(spark, layout, DAY).count() == 0


def test_undecodable_records_are_kept_aside_and_counted(spark, tmp_path):
    layout = Layout(scratch_path(spark, "lake"))
    lines = [json.dumps(_record(1)), json.dumps(_record(2, vote_average="n/a")), json.dumps(_record(3, budget=[1])),
             '{"id": 4, "budg', "[1, 2]", "", json.dumps(_record(5, budget=None)), json.dumps(_record(6, runtime=1e12, adult="?"))]
    path = _write_lines(tmp_path / "a.json", lines)
    jobs.trusted_api_job(spark, path, layout, DAY)
    assert rows(src.scan_layer(spark, layout.trusted_api, dt=DAY), "imdb_id") == [("tt1",), ("tt2",)]
    report = {(r.file.rsplit("/", 1)[1], r.field): r.n for r in jobs.quarantine_report(spark, layout, DAY).collect()}
    assert report == {("a.json", "vote_average"): 1, ("a.json", "budget"): 1, ("a.json", "-"): 2,
                      ("a.json", "runtime"): 1, ("a.json", "adult"): 1}
    kept = {r.record for r in src.scan_layer(spark, layout.quarantine_api, dt=DAY).collect()}
    assert kept == {lines[k] for k in (1, 2, 3, 4, 7)}


def test_nested_numbers_and_column_names(spark, tmp_path):
    schema = StructType([StructField("a.b`c", LongType()), StructField("l", ArrayType(StructType([
        StructField("n", IntegerType()), StructField("d", DoubleType()), StructField("s", StringType())]))),
        StructField("f", BooleanType())])
    path = _write_lines(tmp_path / "x.json", [
        json.dumps({"a.b`c": 1.0, "l": [{"n": 2.0, "d": 3, "s": 4}, None], "f": True}),
        json.dumps({"a.b`c": "7", "l": [], "f": None}), json.dumps({"l": [{"n": "x"}]})])
    want = [(1, [(2, 3.0, "4"), None], True), (7, [], None), (None, [(None, None, None)], None)]
    plain = src.scan_ndjson(spark, path, schema)
    assert plain.schema == schema
    checked, rejects = src.scan_ndjson_checked(spark, path, schema)
    for df in (plain, checked):
        got = [(r[0], [None if x is None else tuple(x) for x in r[1]], r[2]) for r in df.collect()]
        assert got == want
    assert [r.fields for r in rejects.collect()] == [["l"]]


# ----------------------------------------------------------- files by number


def test_numbered_files_hold_their_chunk_and_a_failed_job_leaves_the_old_ones(spark):
    path = scratch_path(spark, "nd")
    df = spark.range(250).select("id", (F.col("id") % 7).alias("_x"))
    src.sink_ndjson(df.repartition(5), path, 100, order="id")
    names = sorted(n.rsplit("/", 1)[1] for n in glob.glob(f"{local(path)}/*.json"))
    assert names == ["parte_0.json", "parte_1.json", "parte_2.json"]
    for i, name in enumerate(names):
        got = [json.loads(line)["id"] for line in open(f"{local(path)}/{name}")]
        assert got == list(range(100 * i, min(100 * i + 100, 250)))
    bad = df.withColumn("id", F.when(F.col("id") == 249, F.raise_error(F.lit("killed")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="killed"):
        src.sink_ndjson(bad, path, 100, order="_x")
    assert sorted(n.rsplit("/", 1)[1] for n in glob.glob(f"{local(path)}/*.json")) == names
    src.sink_ndjson(df.limit(20), path, 100, order="id")
    assert [n.rsplit("/", 1)[1] for n in glob.glob(f"{local(path)}/*.json")] == ["parte_0.json"]
    assert not [n for n in Store(spark, path).names(path.rsplit("/", 1)[0]) if n.startswith("_staging")]


# -------------------------------------------------------------- missing pages


def test_a_crawl_stops_at_a_page_that_never_landed(spark):
    result = (1, "m", "2001-01-01", 1.0, 5.0, 40, False)
    page = lambda ano, genre, p, total=9, status=200: (ano, genre, p, status, total, [result])
    data = ([page(2001, 14, p) for p in (1, 2, 4, 5, 9)]          # page 3 is missing
            + [page(2001, 878, p) for p in (2, 3)]                # the first one is
            + [page(2002, 14, p, 3) for p in (1, 2, 3, 5)]        # beyond the last: no matter
            + [page(2002, 878, p) for p in (1, 1, 2)]             # a page landed twice
            + [page(None, 14, p) for p in (1, 3)])
    df = spark.createDataFrame(data, PAGES_RAW)
    got = rows(src.flatten_pages(df, ["ano", "genre_id"]), "ano", "genre_id", "page")
    assert got == [(None, 14, 1), (2001, 14, 1), (2001, 14, 2), (2002, 14, 1), (2002, 14, 2), (2002, 14, 3),
                   (2002, 878, 1), (2002, 878, 1), (2002, 878, 2)]


# ------------------------------------------------------------ views and scopes


def test_run_sql_puts_back_a_view_of_the_caller(spark):
    spark.range(3).createOrReplaceTempView("mine")
    try:
        got = op.run_sql(spark, {"mine": spark.range(10), "other": spark.range(2)}, "SELECT count(*) AS n FROM mine, other")
        assert got.first().n == 20 and spark.table("mine").count() == 3
        assert not spark.catalog.tableExists("other")
    finally:
        spark.catalog.dropTempView("mine")


def test_scopes_of_two_threads_do_not_meet(spark):
    started, done, seen = threading.Event(), threading.Event(), {}

    def other():
        with scratch_scope(spark):
            seen["path"] = materialize(spark.range(5), "other").inputFiles()[0]
            started.set()
            done.wait(60)
            seen["rows"] = spark.read.parquet(seen["path"]).count()

    thread = threading.Thread(target=other)
    thread.start()
    started.wait(60)
    with scratch_scope(spark):
        materialize(spark.range(3), "mine")
    done.set()
    thread.join()
    assert seen["rows"] >= 0 and not Store(spark, seen["path"]).exists(seen["path"])

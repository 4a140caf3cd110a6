"""Layer jobs end to end on hand-made rows (FIXTURES A4, A6-A8)."""

import glob

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reelstack.layout import Layout
from reelstack.params import CatalogParams
from reelstack.plans import jobs
from reelstack.schemas import API_RAW, MOVIES_CSV
from reelstack.session import scratch_path
from reelstack.sources import scan_layer, sink_parquet

from .conftest import rows


def _csv_row(id_, title="T", ano="2005", minutes="95", genre="Drama", rating="7.0",
             votes="100", character="Someone"):
    values = dict(zip(MOVIES_CSV.names, [None] * 15))
    values.update(id=id_, tituloPincipal=title, anoLancamento=ano, tempoMinutos=minutes,
                  genero=genre, notaMedia=rating, numeroVotos=votes, personagem=character)
    return tuple(values[n] for n in MOVIES_CSV.names)


def catalog_rows(spark):
    data = [
        # keyword branch: no gate applies, deny-list does
        _csv_row("tt01", character="Harry Potter", ano="1990", minutes="\\N", votes="1"),
        _csv_row("tt01", character="Young Harry Potter"),           # same id, twice -> once
        _csv_row("tt0092115", character="Bella Swan"),                # denied, keyword only -> out
        _csv_row("tt8443702", character="Katniss Everdeen", genre="Sci-Fi", ano="2012",
                 minutes="120", votes="500"),                         # denied but genre gates -> in
        # genre branch gates
        _csv_row("tt10", genre="Fantasy", ano="2000"), _csv_row("tt11", genre="Fantasy", ano="2001"),
        _csv_row("tt12", genre="Sci-Fi,Drama", ano="2015"), _csv_row("tt13", genre="Fantasy", ano="2016"),
        _csv_row("tt14", genre="Fantasy", minutes="79"), _csv_row("tt15", genre="Fantasy", minutes="80"),
        _csv_row("tt16", genre="Fantasy", votes="29"), _csv_row("tt17", genre="Fantasy", votes="30"),
        _csv_row("tt18", genre="Fantasy", minutes="95.7"), _csv_row("tt19", genre=None),
        _csv_row("tt20", genre="Fantasy", ano=None), _csv_row("tt21", genre="Fantasy", minutes=""),
        _csv_row("tt22", character=None, genre="Horror"),
    ]
    return spark.createDataFrame(data, MOVIES_CSV)


def test_trusted_catalog_gates(spark):
    out = jobs.trusted_catalog(catalog_rows(spark))
    assert out.columns == ["imdb_id", "tituloPrincipal", "tempoMinutos", "notaMedia_imdb",
                           "numeroVotos_imdb"]
    assert dict(out.dtypes)["tempoMinutos"] == "int"
    got = {r.imdb_id: r for r in out.collect()}
    assert sorted(got) == ["tt01", "tt11", "tt12", "tt15", "tt17", "tt18", "tt8443702"]
    assert got["tt18"].tempoMinutos == 95 and got["tt17"].numeroVotos_imdb == 30


def test_trusted_catalog_one_pass_equals_branch_union(spark):
    csv = catalog_rows(spark)
    p = CatalogParams()
    from reelstack import functions as fn
    saga = csv.filter(fn.keyword_any("personagem", p.saga_keywords)) \
        .filter(~F.col("id").isin(p.deny_ids))
    gen = csv.filter(fn.keyword_any(F.coalesce("genero", F.lit("")), p.genre_keywords)
                     & fn.to_int(F.coalesce("anoLancamento", F.lit("0"))).between(2001, 2015))
    gen = gen.filter(F.coalesce(fn.to_int("tempoMinutos"), F.lit(0)) >= 80) \
        .filter(fn.to_double("numeroVotos") >= 30)
    branch_ids = {r.id for r in saga.union(gen).select("id").distinct().collect()}
    assert branch_ids == {r.imdb_id for r in jobs.trusted_catalog(csv).collect()}


def test_trusted_catalog_pick_is_the_same_under_any_order(spark):
    data = [_csv_row("tt30", title=t, genre="Fantasy", minutes=m) for t, m in (("B", "90"), ("A", "100"), ("A", "95"))]
    for rows_ in (data, data[::-1]):
        for parts in (1, 3):
            out = jobs.trusted_catalog(spark.createDataFrame(rows_, MOVIES_CSV).repartition(parts)).collect()
            assert [(r.tituloPrincipal, r.tempoMinutos) for r in out] == [("A", 95)]


def api_rows(spark):
    base = dict(Ano=2005, Genre_ID=14, title="t", release_date="2005-01-01", popularity=1.5,
                vote_average=7.0, vote_count=100, adult=False, budget=10, runtime=100, revenue=20)
    cases = [
        dict(id=1, imdb_id="tt1"), dict(id=2, imdb_id="tt2", vote_count=29),
        dict(id=3, imdb_id="tt3", vote_count=30), dict(id=4, imdb_id="tt4", runtime=79),
        dict(id=5, imdb_id="tt5", runtime=80), dict(id=6, imdb_id="tt6", budget=0),
        dict(id=7, imdb_id="tt7", budget=1), dict(id=8, imdb_id="tt8", revenue=0),
        dict(id=9, imdb_id="tt9", revenue=None), dict(id=10, imdb_id="tt10", revenue=2923706026),
        dict(id=11, imdb_id=None),
    ]
    data = [tuple({**base, **c}[f] for f in API_RAW.names) for c in cases]
    return spark.createDataFrame(data, API_RAW)


def test_trusted_api_gates_and_schema(spark):
    out = jobs.trusted_api(api_rows(spark))
    assert out.columns[-2:] == ["imdb_id", "data_coleta_tmdb"] and "release_date" not in out.columns
    assert dict(out.dtypes)["receita"] == "bigint"
    got = [r.imdb_id for r in out.collect()]
    assert got == sorted(got) == ["tt1", "tt10", "tt3", "tt5", "tt7"]
    assert out.filter("imdb_id = 'tt10'").first().receita == 2923706026


def _trusted_layers(spark, layout, dt):
    movies = spark.createDataFrame(
        [("tt1", "A", 100, 7.0, 50), ("tt2", "B", 90, 6.0, 40), ("tt3", "C", 95, 8.0, 60),
         ("tt4", "D", 85, 5.0, 31), ("tt9", "Z", 99, 1.0, 99)],
        "imdb_id string, tituloPrincipal string, tempoMinutos int, notaMedia_imdb double, "
        "numeroVotos_imdb int")
    sink_parquet(movies, layout.trusted_movies, single_file=True)
    api = jobs.trusted_api(spark.createDataFrame([
        (2001, 14, 1, "a", "x", 1.0, 7.0, 100, False, 10, "tt1", 100, 20),
        (2001, 14, 2, "b", "x", 2.0, 6.0, 100, True, 10, "tt2", 100, 20),
        (2001, 878, 3, "c", "x", 3.0, 8.0, 100, False, 10, "tt3", 100, 20),
        (2003, 14, 4, "d", "x", 4.0, 5.0, 100, False, 10, "tt4", 100, 20),
        (2003, 14, 5, "d2", "x", 4.0, 5.0, 100, False, 10, "tt4", 100, 20),  # 2 API rows, 1 imdb id
        (2004, 14, 6, "e", "x", 1.0, 1.0, 100, False, 10, "tt5", 100, 20),   # no movie row
    ], API_RAW))
    from reelstack.sources import sink_partitioned
    sink_partitioned(api, layout.trusted_api, dt=dt)


def test_star_jobs_invariants(spark):
    layout, dt = Layout(scratch_path(spark, "lake")), "2024-04-12"
    _trusted_layers(spark, layout, dt)
    paths = jobs.star_job(spark, layout, dt)
    t = {name: spark.read.parquet(p) for name, p in paths.items()}
    fact, dates = t["tabela_fato"], t["tabela_data"]
    titles, adults = t["tabela_titulo"], t["tabela_adulto"]
    # one fact row per joined id; 3 movies in 2001 do not multiply the fact
    assert rows(fact, "fato_imdb_id") == [("tt1",), ("tt2",), ("tt3",), ("tt4",)]
    assert rows(dates) == [(2001, "dtg1"), (2003, "dtg2")]
    assert rows(titles, "titulo_imdb_id", "id_titulo") == [("tt1", "tig1"), ("tt2", "tig2"),
                                                          ("tt3", "tig3"), ("tt4", "tig4")]
    assert rows(adults, "adulto_imdb_id", "id_adulto", "Adulto")[1] == ("tt2", "adg2", True)
    # every fact key exists in its dimension; keys unique
    for dim, key in [(dates, "id_data"), (titles, "id_titulo"), (adults, "id_adulto")]:
        assert dim.select(key).distinct().count() == dim.count()
        assert fact.join(dim, key, "left_anti").count() == 0
    assert "id_genero" in fact.columns
    # a rerun gives identical tables
    before = {name: rows(df) for name, df in t.items()}
    paths2 = jobs.star_job(spark, layout, dt)
    assert {name: rows(spark.read.parquet(p)) for name, p in paths2.items()} == before


def test_star_subset_job(spark):
    layout, dt = Layout(scratch_path(spark, "lake")), "2024-04-12"
    _trusted_layers(spark, layout, dt)
    paths = jobs.star_job(spark, layout, dt, star="sagas", ids=["tt3", "tt1", "tt404"])
    fact = spark.read.parquet(paths["tabela_fato_sagas"])
    assert rows(fact, "fs_movie_imdb_id", "id_tabela_data", "id_tabela_titulo",
                "id_tabela_adulto") == [("tt1", "dt1", "ti1", "ad1"), ("tt3", "dt1", "ti2", "ad2")]
    assert "id_genero" not in fact.columns
    assert spark.read.parquet(paths["tabela_sagas_data"]).count() == 1


def test_raw_to_trusted_files(spark, tmp_path):
    layout = Layout(scratch_path(spark, "lake"))
    pages = spark.createDataFrame(
        [(2001, 14, 1, 200, 1, [(1, "a", "2001-01-01", 1.0, 7.0, 100, False),
                                (2, "b", "2001-01-01", 1.0, 7.0, 10, False)])],
        "ano int, genre_id int, page int, status int, total_pages int, "
        "results array<struct<id:bigint,title:string,release_date:string,popularity:double,"
        "vote_average:double,vote_count:bigint,adult:boolean>>")
    pages_path = scratch_path(spark, "pages")
    pages.write.json(pages_path)
    details = spark.createDataFrame([(1, 100, "tt1", 120, 500), (2, 5, "tt2", 90, 10)],
                                    "id long, budget long, imdb_id string, runtime int, revenue long")
    out = jobs.raw_ingest_job(spark, pages_path, details, layout.raw_api("2024-04-12"))
    jobs.trusted_api_job(spark, out, layout, "2024-04-12")
    api = scan_layer(spark, layout.trusted_api, dt="2024-04-12")
    assert rows(api, "imdb_id", "orcamento") == [("tt1", 100)]


def test_land_then_trusted_catalog_from_split_parts(spark, tmp_path):
    """A landed CSV split into several part files keeps every data row."""
    layout = Layout(scratch_path(spark, "lake"))
    local = tmp_path / "extract"
    local.mkdir()
    header = "|".join(MOVIES_CSV.names)
    lines = [header] + ["|".join(v or "" for v in _csv_row(f"tt{i:03d}", genre="Fantasy"))
                        for i in range(300)]
    (local / "movies.csv").write_text("\n".join(lines) + "\n")
    (local / "series.csv").write_text("a|b\n1|2\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # force several parts
    try:
        landed = jobs.land_extracts_job(spark, {"Movies": str(local / "movies.csv"),
                                                "Series": str(local / "series.csv")},
                                        layout, "2024-04-12")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert landed["Movies"].endswith("Movies/2024/04/12")
    parts = glob.glob(landed["Movies"].replace("file:", "") + "/file=movies.csv/at=*/part-*")
    assert len(parts) > 1, parts
    out = jobs.trusted_catalog_job(spark, layout, "2024-04-12")
    movies = spark.read.parquet(out)
    assert movies.count() == 300 and movies.select("imdb_id").distinct().count() == 300


def test_star_of_an_empty_join(spark):
    from reelstack.plans.star import GENERAL, build_star, joined_base
    movies = spark.createDataFrame([("tt1", "A")], "imdb_id string, tituloPrincipal string")
    api = spark.createDataFrame([("tt2", 2001, 10, False)],
                                "imdb_id string, anoLancamento_tmdb int, orcamento long, "
                                "adulto boolean")
    tables = build_star(joined_base(movies, api), GENERAL)
    assert {name: df.count() for name, df in tables.items()} == dict.fromkeys(tables, 0)
    assert tables[GENERAL.fact].columns == ["fato_imdb_id", "orcamento", "id_data", "id_titulo",
                                            "id_adulto"]


def test_star_with_tabela_key_names(spark):
    from reelstack.plans.star import GENERAL_TABELA_KEYS
    layout, dt = Layout(scratch_path(spark, "lake")), "2024-04-12"
    _trusted_layers(spark, layout, dt)
    paths = jobs.star_job(spark, layout, dt, spec=GENERAL_TABELA_KEYS)
    fact = spark.read.parquet(paths["tabela_fato"])
    assert fact.columns == ["fato_imdb_id", "orcamento", "receita", "tempoMinutos",
                            "popularidade", "contagem_de_voto", "votacao_media",
                            "data_coleta_tmdb", "id_tabela_data", "id_tabela_titulo",
                            "id_tabela_adulto"]
    assert rows(fact, "fato_imdb_id", "id_tabela_titulo")[0] == ("tt1", "tig1")


_MOVIE = st.fixed_dictionaries({
    "anoLancamento": st.sampled_from([None, "2000", "2001", "2015", "2016", "x", "2005.0"]),
    "tempoMinutos": st.sampled_from([None, "79", "80", "95.5", "\\N", ""]),
    "genero": st.sampled_from([None, "Fantasy", "Drama", "Sci-Fi,Drama", "fantasy"]),
    "numeroVotos": st.sampled_from([None, "29", "30", "100", "", "29.9"]),
})


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.dictionaries(st.sampled_from(["tt0092115", "tt1", "tt2", "tt3", "tt4", "tt5"]),
                       _MOVIE, min_size=1),
       st.lists(st.tuples(st.integers(0, 5), st.sampled_from(
           [None, "Harry Potter", "Bella Swan", "Katniss Everdeen", "x"])), max_size=25))
def test_one_pass_catalogue_equals_branch_form(spark, movies, cast):
    ids = sorted(movies)
    data = []
    for i, character in cast + [(k, None) for k in range(len(ids))]:
        imdb = ids[i % len(ids)]
        data.append(_csv_row(imdb, character=character, **{
            {"anoLancamento": "ano", "tempoMinutos": "minutes", "genero": "genre",
             "numeroVotos": "votes"}[k]: v for k, v in movies[imdb].items()}))
    csv = spark.createDataFrame(data, MOVIES_CSV)
    p = CatalogParams()
    from reelstack import functions as fn
    # The branch form, step by step as the reference runs it.
    sagas = [csv.filter(F.col("personagem").rlike(w)) for w in p.saga_keywords]
    saga = sagas[0].union(sagas[1]).union(sagas[2]).filter(~F.col("id").isin(p.deny_ids))
    gen = csv.fillna({"genero": ""}).withColumn(
        "anoLancamento", fn.to_int(F.coalesce("anoLancamento", F.lit("0"))))
    gen = gen.filter(F.col("genero").rlike("|".join(p.genre_keywords))
                     & F.col("anoLancamento").between(2001, 2015)).dropDuplicates(["id"])
    gen = gen.filter(F.coalesce(fn.to_int("tempoMinutos"), F.lit(0)) >= 80) \
        .filter(fn.to_double("numeroVotos") >= 30)
    branch_ids = {r.id for r in saga.select("id").union(gen.select("id")).distinct().collect()}
    assert branch_ids == {r.imdb_id for r in jobs.trusted_catalog(csv).collect()}

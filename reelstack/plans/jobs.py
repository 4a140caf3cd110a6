"""The five layer jobs: raw ingest, trusted catalogue, trusted API, and the
general and subset stars. Each has a pure transform (DataFrame in, DataFrame
out) and a job function that reads and writes the layer paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import (at_least, between, keyword_any, positive, present, to_double, to_int,
                         to_long)
from ..layout import Layout
from ..operators.dedup import keep_first
from ..operators.joins import enrich
from ..operators.projection import drop_cols, move_last, rename, stamp
from ..operators.ordering import sort_by
from ..operators.profile import merge_profiles, profile_state
from ..operators.setops import union_all
from ..params import ApiParams, CatalogParams
from ..schemas import API_RAW, MOVIES_CSV, PAGES_RAW
from ..session import materialize, scratch_scope
from ..sources.pages import flatten_pages
from ..sources.bucketed import scan_bucketed, sink_bucketed
from ..sources.landing import land_raw
from ..sources.readers import scan_csv_pipe, scan_layer, scan_ndjson, scan_ndjson_checked
from ..sources.sinks import (NDJSON_RECORDS, sink_ndjson, sink_parquet, sink_partitioned, star_states,
                             write_star)
from .star import GENERAL, StarSpec, star_general, star_subset

# --------------------------------------------------------------------------- raw


def land_extracts_job(spark: SparkSession, sources: dict[str, str], layout: Layout, day) -> dict:
    """Land local extract files (for example ``{"Movies": ..., "Series": ...}``)
    under ``Raw/Local/CSV/{kind}/yyyy/MM/dd``; returns the landed folders."""
    return {kind: land_raw(spark, src, layout.raw_files_root(kind), day)
            for kind, src in sources.items()}


def raw_rows(pages: DataFrame, details: DataFrame, keys=("ano", "genre_id"), id_col: str = "id",
             details_key: str = "id", max_pages: int | None = None,
             rename_map: dict | None = None) -> DataFrame:
    """Discover pages -> one row per movie (first in crawl order) + details.

    Crawl order is (keys, page, position): years outer, genres in ascending
    id (the reference lists 14 before 878), pages upward. A movie in both
    genres keeps the first genre. Details join by id; a missing record gives
    nulls instead of shifting every later row, a repeated record counts once.
    """
    keys = list(keys)
    rows = flatten_pages(pages, keys, max_pages=max_pages)
    first = keep_first(rows, id_col, [*keys, "page", "position"]).drop("page", "position")
    out = enrich(first, details, id_col, details_key)
    return rename(out, rename_map) if rename_map else out


def raw_ingest_job(spark: SparkSession, pages_path: str, details: DataFrame, out_path: str,
                   max_records: int = NDJSON_RECORDS, exact_files: bool = False) -> str:
    """Landed pages -> raw API NDJSON files of at most ``max_records`` rows
    (the reference's files hold ``RECORDS_PER_FILE``)."""
    pages = scan_ndjson(spark, pages_path, PAGES_RAW)
    with scratch_scope(spark):
        rows = raw_rows(pages, details, rename_map={"ano": "Ano", "genre_id": "Genre_ID"})
        if exact_files:
            # Ordered numbering reads its input twice: store the joined rows.
            rows = materialize(rows, "raw_rows")
        return sink_ndjson(rows, out_path, max_records, order="id" if exact_files else None)


# ---------------------------------------------------------------- trusted movies


def _typed(df: DataFrame, name: str, cast) -> Column:
    """Lenient cast for text columns; typed input columns are kept as they are."""
    return cast(F.col(name)) if dict(df.dtypes)[name] == "string" else F.col(name)


def trusted_catalog(csv: DataFrame, params: CatalogParams = CatalogParams(), id_col: str = "id",
                    title: str = "tituloPincipal", year: str = "anoLancamento",
                    minutes: str = "tempoMinutos", genre: str = "genero",
                    rating: str = "notaMedia", votes: str = "numeroVotos",
                    character: str = "personagem") -> DataFrame:
    """Movies CSV rows -> trusted movies, one row per id.

    A row is kept by the keyword branch (its character names a saga and the
    id is not denied; no other gate) or by the genre branch (genre keyword,
    year in range, enough minutes and votes). The deny-list binds the keyword
    branch only, so a denied id passing the genre gates stays. Both branches
    are one filter over one scan, then one dedup by id — the same id set as
    the union of the branches deduplicated by id.
    """
    year_v = to_int(F.coalesce(F.col(year).cast("string"), F.lit("0")))
    minutes_v = F.coalesce(_typed(csv, minutes, to_int), F.lit(0))
    saga = keyword_any(F.col(character), params.saga_keywords) \
        & ~F.col(id_col).isin([i for i in params.deny_ids if i is not None])
    by_genre = (keyword_any(F.coalesce(F.col(genre), F.lit("")), params.genre_keywords)
                & between(year_v, params.year_first, params.year_last)
                & at_least(minutes_v, params.min_minutes)
                & at_least(_typed(csv, votes, to_double), params.min_votes))
    kept = csv.filter(saga | by_genre).select(
        F.col(id_col).alias("imdb_id"),
        F.col(title).alias("tituloPrincipal") if title in csv.columns
        else F.lit(None).cast("string").alias("tituloPrincipal"),
        _typed(csv, minutes, to_int).alias("tempoMinutos"),
        _typed(csv, rating, to_double).alias("notaMedia_imdb") if rating in csv.columns
        else F.lit(None).cast("double").alias("notaMedia_imdb"),
        _typed(csv, votes, to_int).alias("numeroVotos_imdb"),
    )
    # First in the total order of the kept columns: conflicting rows of one id
    # give the same pick under any partitioning.
    return keep_first(kept, "imdb_id", [c for c in kept.columns if c != "imdb_id"])


def trusted_catalog_job(spark: SparkSession, layout: Layout, day,
                        params: CatalogParams = CatalogParams(), single_file: bool = False,
                        buckets: int | None = None) -> str:
    """Landed movies CSV of ``day`` -> trusted movies Parquet; ``single_file``
    writes one file, as the reference does, ``buckets`` a table bucketed by the id."""
    movies = trusted_catalog(scan_csv_pipe(spark, layout.raw_files("Movies", day), MOVIES_CSV), params)
    if buckets:
        return sink_bucketed(movies, layout.trusted_movies, "imdb_id", buckets)
    return sink_parquet(movies, layout.trusted_movies, single_file=single_file)


# ------------------------------------------------------------------- trusted api

# Raw API names -> trusted API names, as the reference names them.
API_RENAMES = {
    "Ano": "anoLancamento_tmdb", "Genre_ID": "id_genero", "id": "id_tmdb", "title": "titulo",
    "popularity": "popularidade", "vote_average": "votacao_media",
    "vote_count": "contagem_de_voto", "adult": "adulto", "budget": "orcamento",
    "runtime": "duracao", "revenue": "receita",
}


def trusted_api_rows(raw: DataFrame, params: ApiParams = ApiParams()) -> DataFrame:
    """The row-by-row part of the trusted API job (also valid on a stream):
    money as bigint (no int32 overflow), positive budget and revenue, enough
    votes and minutes, an imdb id, imdb id moved last."""
    df = rename(drop_cols(raw, "release_date"), API_RENAMES)
    df = df.withColumns({
        "orcamento": to_long("orcamento"), "receita": to_long("receita"),
        "contagem_de_voto": to_int("contagem_de_voto"), "duracao": to_int("duracao"),
    })
    df = df.filter(positive("orcamento") & positive("receita")
                   & at_least("contagem_de_voto", params.min_votes)
                   & at_least("duracao", params.min_minutes)
                   & present("imdb_id"))
    return move_last(df, "imdb_id")


def trusted_api(raw: DataFrame, params: ApiParams = ApiParams()) -> DataFrame:
    """Raw API rows -> trusted API rows, sorted by imdb id (tight file
    statistics on the key), extraction date stamped."""
    df = sort_by(trusted_api_rows(raw, params), "imdb_id")
    return stamp(df, "data_coleta_tmdb", params.extraction_date)


def trusted_api_job(spark: SparkSession, src: str, layout: Layout, dt: str,
                    params: ApiParams = ApiParams(), buckets: int | None = None) -> str:
    """Raw API rows of one extraction -> the ``dt`` partition of the trusted
    table (``buckets``: bucketed by the title id), and its mergeable profile.
    Records that do not decode in full go to ``layout.quarantine_api`` of the same
    ``dt`` with the fields that were lost; what decodes of them is processed like
    any other row, a line that is no JSON object is only there."""
    day = f"{layout.trusted_api}/dt={str(dt).replace('/', '-')}"
    with scratch_scope(spark):
        raw, rejects = scan_ndjson_checked(spark, src, API_RAW)
        sink_partitioned(rejects, layout.quarantine_api, dt=dt)
        if buckets:
            sink_bucketed(stamp(trusted_api_rows(raw, params), "data_coleta_tmdb", params.extraction_date),
                          day, "imdb_id", buckets)
        else:
            sink_partitioned(trusted_api(raw, params), layout.trusted_api, dt=dt)
    sink_partitioned(profile_state(spark.read.parquet(day)), layout.profiles_api, dt=dt)
    return layout.trusted_api


def api_profile(spark: SparkSession, layout: Layout, by_day: bool = False) -> DataFrame:
    """Profile of the whole trusted API table (or of each ``dt``), merged from
    what every extraction stored; reads none of its rows."""
    states = spark.read.parquet(layout.profiles_api)
    return merge_profiles(states, ["dt"] if by_day else []).filter("col <> '*'")


def quarantine_report(spark: SparkSession, layout: Layout, dt: str) -> DataFrame:
    """Undecodable records of one extraction: how many by source file and lost
    field (``-`` for lines that are no JSON object)."""
    rejects = scan_layer(spark, layout.quarantine_api, dt=dt)
    fields = F.when(F.size("fields") == 0, F.array(F.lit("-"))).otherwise(F.col("fields"))
    return rejects.select("file", F.explode(fields).alias("field")).groupBy("file", "field").agg(
        F.count(F.lit(1)).alias("n"))


# ----------------------------------------------------------------------- refined


def star_job(spark: SparkSession, layout: Layout, dt: str, star: str = "geral",
             ids=None, measures=None, spec: StarSpec = GENERAL, stable_keys: bool = False,
             buckets: int | None = None) -> dict[str, str]:
    """Read both trusted tables, build the star, publish its four tables.
    Without ``ids`` it is the general star (``spec`` picks the key naming),
    with ``ids`` the star of that id allow-list. ``stable_keys`` takes the keys from
    the star's registries, ``buckets`` tells that both trusted tables were
    written in that many buckets, which are then joined without a shuffle."""
    if buckets:
        movies = scan_bucketed(spark, layout.trusted_movies, "imdb_id", buckets)
        api = scan_bucketed(spark, f"{layout.trusted_api}/dt={str(dt).replace('/', '-')}", "imdb_id", buckets)
    else:
        movies = scan_layer(spark, layout.trusted_movies)
        api = scan_layer(spark, layout.trusted_api, dt=dt).drop("dt")
    registry = layout.registry(star) if stable_keys else None
    with scratch_scope(spark):
        tables = (star_general(movies, api, measures, spec, registry) if ids is None
                  else star_subset(movies, api, ids, measures, registry))
        return write_star(tables, layout.refined(star))


def star_report(spark: SparkSession, paths: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Row count of every table of a published star and the profile of their
    numeric and text columns, by ``tbl``, from the profiles kept with it: no table
    is read. Tables written otherwise are profiled in one pass each."""
    states = star_states(spark, next(iter(paths.values())).rsplit("/", 1)[0])
    if states is None:
        states = union_all(*[profile_state(spark.read.parquet(p)).select(F.lit(n).alias("tbl"), "*")
                             for n, p in paths.items()])
    merged = merge_profiles(states.filter(F.col("tbl").isin(list(paths))), ["tbl"])
    return (merged.filter("col = '*'").select("tbl", F.col("n_rows").alias("n")),
            merged.filter("col <> '*'").drop("n_rows"))

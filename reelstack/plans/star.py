"""Star schemas of the refined layer: a fact with date, title and adult
dimensions keyed by prefixed dense surrogate keys.

Grain and stability (the reference leaves both to chance):

* the base is one row per movie id, so the fact is one row per movie;
* the date dimension is ``DISTINCT`` years, so the fact-to-date lookup is m:1
  (the per-movie date grain of one reference job multiplies the fact by the
  movies of each year; ``operators.fanout_counts`` reports that size);
* every key follows a total order (year; movie id), so a rerun — or a stage
  recomputed after a lost executor — yields the same keys;
* title and adult dimensions share one ranking of the movie ids, computed once,
  without a single-task window, and stored with the base, so the fact reads
  its title and adult keys from the same rows instead of joining on the id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dedup import distinct_rows, keep_first
from ..operators.filters import keep_ids
from ..operators.joins import join_on_key, lookup_key
from ..operators.keys import dense_key, row_number_scaled, with_prefix
from ..operators.registry import registered_key
from ..params import GENERAL_PREFIXES, SUBSET_PREFIXES
from ..session import materialize

# Fixed values (FACT_MEASURES and the three StarSpec blocks below): table,
# column and key names of the reference's stars.
# Measures of the fact, in output order (``id_genero`` only in the general star).
FACT_MEASURES = ["orcamento", "receita", "tempoMinutos", "id_genero", "popularidade",
                 "contagem_de_voto", "votacao_media", "data_coleta_tmdb"]


@dataclass(frozen=True)
class StarSpec:
    fact: str
    date_dim: str
    title_dim: str
    adult_dim: str
    fact_id: str
    title_id: str
    adult_id: str
    date_key: str
    title_key: str
    adult_key: str
    prefixes: tuple
    with_genre: bool


GENERAL = StarSpec(
    fact="tabela_fato", date_dim="tabela_data", title_dim="tabela_titulo",
    adult_dim="tabela_adulto", fact_id="fato_imdb_id", title_id="titulo_imdb_id",
    adult_id="adulto_imdb_id", date_key="id_data", title_key="id_titulo",
    adult_key="id_adulto", prefixes=GENERAL_PREFIXES, with_genre=True)

# Same star with the other naming of the reference's general star: keys
# ``id_tabela_*`` and no genre id in the fact.
GENERAL_TABELA_KEYS = StarSpec(
    fact="tabela_fato", date_dim="tabela_data", title_dim="tabela_titulo",
    adult_dim="tabela_adulto", fact_id="fato_imdb_id", title_id="titulo_imdb_id",
    adult_id="adulto_imdb_id", date_key="id_tabela_data", title_key="id_tabela_titulo",
    adult_key="id_tabela_adulto", prefixes=GENERAL_PREFIXES, with_genre=False)

SUBSET = StarSpec(
    fact="tabela_fato_sagas", date_dim="tabela_sagas_data", title_dim="tabela_sagas_titulo",
    adult_dim="tabela_sagas_adulto", fact_id="fs_movie_imdb_id", title_id="ts_imdb_id",
    adult_id="as_imdb_id", date_key="id_tabela_data", title_key="id_tabela_titulo",
    adult_key="id_tabela_adulto", prefixes=SUBSET_PREFIXES, with_genre=False)


def joined_base(movies: DataFrame, api: DataFrame, key: str = "imdb_id") -> DataFrame:
    """Trusted movies x trusted API on the title id, one row per id.

    Each side is cut to one row per id *before* the join (first row in a
    total order of its columns): same ids as deduplicating after the join,
    but a hot id never multiplies through the join, and the pick is stable.
    """
    def one_per_key(df: DataFrame) -> DataFrame:
        others = [c for c in df.columns if c != key]
        # Key only: a DISTINCT (hash aggregation, combined map-side) does it.
        return keep_first(df, key, others) if others else distinct_rows(df)
    return join_on_key(one_per_key(movies), one_per_key(api), key)


def build_star(base: DataFrame, spec: StarSpec, measures=None, key: str = "imdb_id",
               year: str = "anoLancamento_tmdb", title: str = "tituloPrincipal",
               adult: str = "adulto", registry: str | None = None) -> dict[str, DataFrame]:
    """Dimension and fact DataFrames of one star from a one-row-per-id base.

    A base row without a year stays in the title and adult dimensions and
    drops out of the fact, as with the reference's inner join.

    With ``registry`` (a folder) the keys are stable: they come from append-only
    registries of titles and years there, so a later extraction keeps every key of
    an earlier one. Without it they are dense over this base alone.
    """
    date_p, title_p, adult_p = spec.prefixes
    measures = [m for m in (measures or FACT_MEASURES)
                if m in base.columns and (spec.with_genre or m != "id_genero")]
    # Number the base itself, once: both dimensions and the fact are then
    # projections of one stored table, so the fact needs no join on the id. The
    # base is stored first because range partitioning reads it twice.
    base = materialize(base, "star_base")
    ranked = (registered_key(base, key, "_rank", f"{registry}/titles") if registry
              else row_number_scaled(base, key, "_rank"))

    # Years: a natural small bound, so a global window is safe. Stored, so that
    # the lookup is planned from their real size.
    years = ranked.select(F.col(year).alias("Ano_Lancamento")).distinct()
    date_dim = materialize(
        registered_key(years.filter("Ano_Lancamento is not null"), "Ano_Lancamento", spec.date_key, f"{registry}/years", date_p)
        if registry else dense_key(years, "Ano_Lancamento", spec.date_key, date_p), "star_years")

    def text_or_null(c: str, dtype: str):
        return F.col(c) if c in base.columns else F.lit(None).cast(dtype)

    title_dim = ranked.select(text_or_null(title, "string").alias("Titulo"),
                              F.col(key).alias(spec.title_id),
                              with_prefix(title_p, F.col("_rank")).alias(spec.title_key))
    adult_dim = ranked.select(text_or_null(adult, "boolean").alias("Adulto"),
                              F.col(key).alias(spec.adult_id),
                              with_prefix(adult_p, F.col("_rank")).alias(spec.adult_key))

    # The base is unique per id, so SELECT DISTINCT of the fact row is the identity.
    fact = ranked.select(F.col(key).alias(spec.fact_id), *measures, F.col(year).alias("_year"),
                         with_prefix(title_p, F.col("_rank")).alias(spec.title_key),
                         with_prefix(adult_p, F.col("_rank")).alias(spec.adult_key))
    fact = lookup_key(fact, date_dim, "_year", "Ano_Lancamento", spec.date_key)
    fact = fact.select(spec.fact_id, *measures, spec.date_key, spec.title_key, spec.adult_key)
    return {spec.fact: fact, spec.date_dim: date_dim, spec.title_dim: title_dim,
            spec.adult_dim: adult_dim}


def star_general(movies: DataFrame, api: DataFrame, measures=None,
                 spec: StarSpec = GENERAL, registry: str | None = None) -> dict[str, DataFrame]:
    return build_star(joined_base(movies, api), spec, measures, registry=registry)


def star_subset(movies: DataFrame, api: DataFrame, ids, measures=None,
                registry: str | None = None) -> dict[str, DataFrame]:
    """The star of an id allow-list. The IN filter is on the join and
    dedup key, so Catalyst pushes it into both scans."""
    base = keep_ids(joined_base(movies, api), "imdb_id", ids)
    return build_star(base, SUBSET, measures, registry=registry)

"""Declared schemas of every layer (nothing is inferred at read time).

Fixed values: the column names below (including the extract's own spelling
``tituloPincipal``) must equal the reference's, so the layers it writes and
reads keep their names.
"""

from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, IntegerType, LongType,
                               StringType, StructField, StructType)


def _struct(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


# One movie inside the ``results`` list of a discover page.
PAGE_RESULT = _struct(
    ("id", LongType()), ("title", StringType()), ("release_date", StringType()),
    ("popularity", DoubleType()), ("vote_average", DoubleType()),
    ("vote_count", LongType()), ("adult", BooleanType()),
)

# A landed discover page: the request keys, the response status and body.
PAGES_RAW = _struct(
    ("ano", IntegerType()), ("genre_id", IntegerType()), ("page", IntegerType()),
    ("status", IntegerType()), ("total_pages", IntegerType()),
    ("results", ArrayType(PAGE_RESULT)),
)

# One detail record per movie id; every field may be missing.
DETAILS_RAW = _struct(
    ("id", LongType()), ("budget", LongType()), ("imdb_id", StringType()),
    ("runtime", IntegerType()), ("revenue", LongType()),
)

# Raw API layer: a discover row enriched with its details.
API_RAW = _struct(
    ("Ano", IntegerType()), ("Genre_ID", IntegerType()), ("id", LongType()),
    ("title", StringType()), ("release_date", StringType()), ("popularity", DoubleType()),
    ("vote_average", DoubleType()), ("vote_count", LongType()), ("adult", BooleanType()),
    ("budget", LongType()), ("imdb_id", StringType()), ("runtime", IntegerType()),
    ("revenue", LongType()),
)

# Movies CSV: pipe separated, header, one row per movie x artist, all strings.
MOVIES_CSV_COLUMNS = [
    "id", "tituloPincipal", "tituloOriginal", "anoLancamento", "tempoMinutos", "genero",
    "notaMedia", "numeroVotos", "generoArtista", "personagem", "nomeArtista",
    "anoNascimento", "anoFalecimento", "profissao", "titulosMaisConhecidos",
]
MOVIES_CSV = _struct(*[(name, StringType()) for name in MOVIES_CSV_COLUMNS])

MOVIES_TRUSTED = _struct(
    ("imdb_id", StringType()), ("tituloPrincipal", StringType()),
    ("tempoMinutos", IntegerType()), ("notaMedia_imdb", DoubleType()),
    ("numeroVotos_imdb", IntegerType()),
)

API_TRUSTED = _struct(
    ("adulto", BooleanType()), ("anoLancamento_tmdb", IntegerType()),
    ("id_genero", IntegerType()), ("id_tmdb", LongType()), ("orcamento", LongType()),
    ("popularidade", DoubleType()), ("duracao", IntegerType()), ("receita", LongType()),
    ("titulo", StringType()), ("votacao_media", DoubleType()),
    ("contagem_de_voto", IntegerType()), ("imdb_id", StringType()),
    ("data_coleta_tmdb", StringType()),
)

"""Independent ANSI SQL (DuckDB dialect) for every acceptance query.

Each text reads the driver tables as views of the same names and gives the
same rows, column names and types as the Spark query of that name.
"""

ORACLE_SQL: dict[str, str] = {
    "scan_parquet_layer": "SELECT p_partkey, p_name, p_size FROM part",
    "scan_csv_pipe": """
        SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN p_name || chr(10) || '"again"|' ELSE p_name END AS p_name,
               p_size, p_retailprice FROM part""",
    "scan_ndjson": "SELECT event_id, user_id, event_type, value FROM events",
    "json_quarantine": """
        SELECT 'rows' AS field, count(*) AS n,
               CAST(sum(CASE WHEN o_orderkey % 7 <> 0 THEN CAST(trunc(o_totalprice) AS BIGINT) END) AS BIGINT) AS total
        FROM orders WHERE o_orderkey % 11 <> 0
        UNION ALL SELECT 'budget', count(*), NULL FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderkey % 7 = 0
        UNION ALL SELECT 'adult', count(*), NULL FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderkey % 13 = 0
        UNION ALL SELECT '-', count(*), NULL FROM orders WHERE o_orderkey % 11 = 0""",
    "flatten_pages": """
        WITH r AS (SELECT event_type AS genre, event_id AS id, value AS popularity,
          CAST((row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1) // 20 + 1 AS BIGINT) AS page
          FROM events)
        SELECT genre, page, id, popularity FROM r
        WHERE (genre <> 'error' OR page <= (SELECT floor(max(page) * 2 / 3.0) FROM r WHERE genre = 'error'))
          AND (genre <> 'click' OR page <= (SELECT floor(max(page) / 3.0) FROM r WHERE genre = 'click'))""",
    "land_raw": """
        SELECT '2024/04/12' AS landed_path, true AS on_day, 'movies.csv' AS file_name, p_name AS line FROM part
        UNION ALL SELECT '2024/04/12', true, 'series.csv', s_name FROM supplier
        UNION ALL SELECT '2024/04/12', true, 'parte_' || CAST((row_number() OVER (ORDER BY s_suppkey) - 1) // 40 AS VARCHAR)
          || '.json', '{"s_suppkey":' || CAST(s_suppkey AS VARCHAR) || '}' FROM supplier""",
    "landing_manifest": """
        SELECT CAST(sum(strlen(p_name) + strlen(p_brand) + 4) AS BIGINT) AS n_bytes, count(*) AS n_lines,
               count(*) AS n_odd, 64 AS digest_chars, CAST(0 AS BIGINT) AS n_changed FROM part""",
    "sink_ndjson_chunked": """
        SELECT 'parte_' || CAST(chunk AS VARCHAR) || '.json' AS file_name,
               min(p_partkey) AS first_key, max(p_partkey) AS last_key, count(*) AS n_rows,
               CAST(sum(p_size) AS BIGINT) AS sizes
        FROM (SELECT *, (row_number() OVER (ORDER BY p_partkey) - 1) // 100 AS chunk FROM part) GROUP BY chunk""",
    "sink_single_file": "SELECT s_suppkey, s_name, s_acctbal, CAST(1 AS BIGINT) AS n_files FROM supplier",
    "sink_partition_dt": """
        SELECT o_orderkey, o_totalprice, '2024-04-11' AS dt FROM orders
        UNION ALL SELECT o_orderkey, -o_totalprice, '2024-04-12' FROM orders""",
    "sink_star_roundtrip": """
        SELECT 'dim' AS tbl, count(DISTINCT year(o_orderdate)) AS n_rows FROM orders
        UNION ALL SELECT 'fact', count(*) FROM orders
        UNION ALL SELECT 'kept:tabela_data', count(DISTINCT year(o_orderdate)) FROM orders
        UNION ALL SELECT 'kept:tabela_fato', count(*) FROM orders""",
    "project_alias": "SELECT o_orderkey AS imdb_id, o_orderpriority AS titulo FROM orders",
    "rename_drop": "SELECT p_partkey AS imdb_id, p_name AS titulo, p_retailprice AS nota FROM part",
    "stamp_literal": "SELECT c_custkey, c_name, '2024/04/12' AS data_coleta FROM customer",
    "lenient_cast_int": """
        WITH d AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN '\\N' WHEN event_id % 5 = 0 THEN ''
                   ELSE CAST(value AS VARCHAR) END AS raw FROM events)
        SELECT event_id, TRY_CAST(trunc(TRY_CAST(raw AS DOUBLE)) AS INTEGER) AS v FROM d""",
    "lenient_cast_float": """
        WITH d AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN '\\N'
                   ELSE CAST(event_id % 50 AS VARCHAR) END AS raw FROM events)
        SELECT event_id, TRY_CAST(raw AS FLOAT) AS v FROM d""",
    "cast_overflow_safe": """
        WITH d AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN CAST(2923706026 AS BIGINT) + p_partkey
                   ELSE p_partkey END AS receita FROM part)
        SELECT p_partkey, receita, TRY_CAST(receita AS INTEGER) AS receita_int FROM d WHERE receita > 0""",
    "fillna_typed": """
        WITH d AS (SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_type END AS genero,
                   CASE WHEN event_id % 6 = 0 THEN NULL ELSE CAST(event_id % 90 AS INTEGER) END AS minutos
                   FROM events)
        SELECT event_id, coalesce(genero, '') AS genero, coalesce(minutos, 0) AS minutos FROM d""",
    "move_column_last": "SELECT c_name, c_acctbal, c_custkey FROM customer",
    "keyword_any": "SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, 'ring|widget')",
    "year_between": """
        SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS ano FROM orders
        WHERE year(o_orderdate) BETWEEN 1996 AND 1999 AND regexp_matches(o_orderpriority, 'URGENT|HIGH')""",
    "quality_gate": """
        WITH a AS (SELECT CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE 'tt' || CAST(o_orderkey AS VARCHAR) END AS imdb_id,
                   CAST(trunc(o_totalprice) AS BIGINT) AS orcamento, CAST(trunc(c_acctbal) AS BIGINT) AS receita,
                   CAST(o_custkey % 200 AS INTEGER) AS duracao, CAST(o_orderkey % 500 AS INTEGER) AS votos
                   FROM orders JOIN customer ON c_custkey = o_custkey)
        SELECT * FROM a
        WHERE orcamento > 0 AND receita > 0 AND votos >= 30 AND duracao >= 80 AND imdb_id IS NOT NULL""",
    "id_in": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (1, 5, 9, 77, 410)",
    "id_not_in": "SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey NOT IN (2, 4, 6)",
    "join_inner_key": """
        SELECT DISTINCT o_orderkey AS imdb_id, o_totalprice, o_orderstatus
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey""",
    "join_left_details": """
        WITH det AS (SELECT l_orderkey, max(l_quantity) AS runtime FROM lineitem GROUP BY l_orderkey)
        SELECT o_orderkey, runtime FROM orders LEFT JOIN det ON l_orderkey = o_orderkey""",
    "dedup_keep_first": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey
                                   ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) = 1""",
    "dedup_key": """
        SELECT user_id, event_id, event_type FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1""",
    "select_distinct": "SELECT DISTINCT p_brand, p_type FROM part",
    "surrogate_prefixed": """
        SELECT 'dtg' || CAST(row_number() OVER (ORDER BY ano) AS VARCHAR) AS id_tabela_data, ano
        FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS ano FROM orders)""",
    "surrogate_distributed": """
        SELECT 'tig' || CAST(row_number() OVER (ORDER BY o_orderkey) AS VARCHAR) AS id_tabela_titulo, o_orderkey
        FROM orders""",
    "fact_date_lookup": """
        WITH d AS (SELECT ano, 'dtg' || CAST(row_number() OVER (ORDER BY ano) AS VARCHAR) AS id_data
                   FROM (SELECT DISTINCT year(o_orderdate) AS ano FROM orders))
        SELECT o_orderkey, o_totalprice, id_data FROM orders JOIN d ON d.ano = year(o_orderdate)""",
    "fact_date_fanout": """
        WITH o AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS ano FROM orders)
        SELECT a.ano, count(*) AS n_rows FROM o a JOIN o b ON a.ano = b.ano GROUP BY a.ano""",
    "fact_attr_lookup": """
        WITH t AS (SELECT c_custkey, 'tig' || CAST(row_number() OVER (ORDER BY c_custkey) AS VARCHAR) AS id_titulo
                   FROM customer)
        SELECT o_orderkey, id_titulo FROM orders JOIN t ON c_custkey = o_custkey""",
    "union_branches": """
        SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring%'
        UNION ALL SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%small%'
        UNION ALL SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%gear%'""",
    "union_reconciled": """
        SELECT p_partkey AS id, CAST(p_size AS INTEGER) AS minutos FROM part
        UNION ALL SELECT s_suppkey, TRY_CAST(trunc(TRY_CAST(m AS DOUBLE)) AS INTEGER)
        FROM (SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN '\\N' WHEN 1 THEN '29.9' WHEN 2 THEN ''
              ELSE CAST(s_acctbal AS VARCHAR) END AS m FROM supplier)""",
    "sort_limit": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 25",
    "count_tables": """
        SELECT 'orders' AS tbl, count(*) AS n FROM orders
        UNION ALL SELECT 'part', count(*) FROM part
        UNION ALL SELECT 'lineitem', count(*) FROM lineitem""",
    "profile_merged": """
        SELECT 'o_orderkey' AS col, count(*) AS n_rows, count(o_orderkey) AS cnt, round(avg(o_orderkey), 4) AS mean,
               round(stddev_samp(o_orderkey), 4) AS stddev, CAST(min(o_orderkey) AS VARCHAR) AS mn,
               CAST(max(o_orderkey) AS VARCHAR) AS mx FROM orders
        UNION ALL SELECT 'o_custkey', count(*), count(o_custkey), round(avg(o_custkey), 4), round(stddev_samp(o_custkey), 4),
               CAST(min(o_custkey) AS VARCHAR), CAST(max(o_custkey) AS VARCHAR) FROM orders
        UNION ALL SELECT 'o_totalprice', count(*), count(o_totalprice), round(avg(o_totalprice), 4),
               round(stddev_samp(o_totalprice), 4), CAST(min(o_totalprice) AS VARCHAR), CAST(max(o_totalprice) AS VARCHAR)
               FROM orders
        UNION ALL SELECT 'o_orderpriority', count(*), count(o_orderpriority), NULL, NULL, min(o_orderpriority),
               max(o_orderpriority) FROM orders""",
    "surrogate_registry": """
        WITH a AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS n FROM orders WHERE o_custkey % 2 = 0),
        b AS (SELECT o_orderkey, (SELECT count(*) FROM a) + row_number() OVER (ORDER BY o_orderkey) AS n FROM orders
              WHERE o_custkey % 3 = 0 AND o_custkey % 2 <> 0)
        SELECT o.o_orderkey, 'tig' || CAST(coalesce(a.n, b.n) AS VARCHAR) AS id_titulo, a.n AS n_first
        FROM orders o LEFT JOIN a ON a.o_orderkey = o.o_orderkey LEFT JOIN b ON b.o_orderkey = o.o_orderkey
        WHERE o_custkey % 3 = 0""",
    "join_bucketed": """
        SELECT o_orderkey AS imdb_id, o_totalprice, o_orderstatus
        FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)""",
    "describe_profile": """
        SELECT 'p_size' AS col, count(p_size) AS cnt, round(avg(p_size), 4) AS mean,
               round(stddev_samp(p_size), 4) AS stddev, CAST(min(p_size) AS VARCHAR) AS mn,
               CAST(max(p_size) AS VARCHAR) AS mx FROM part
        UNION ALL SELECT 'p_partkey', count(p_partkey), round(avg(p_partkey), 4), round(stddev_samp(p_partkey), 4),
               CAST(min(p_partkey) AS VARCHAR), CAST(max(p_partkey) AS VARCHAR) FROM part
        UNION ALL SELECT 'p_retailprice', count(p_retailprice), round(avg(p_retailprice), 4),
               round(stddev_samp(p_retailprice), 4), CAST(min(p_retailprice) AS VARCHAR),
               CAST(max(p_retailprice) AS VARCHAR) FROM part
        UNION ALL SELECT 'p_name', count(p_name), NULL, NULL, min(p_name), max(p_name) FROM part
        UNION ALL SELECT 'p_brand', count(p_brand), NULL, NULL, min(p_brand), max(p_brand) FROM part""",
    "json_field_default": """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
               CAST(json_extract_string(props, '$.zz') AS INTEGER) AS missing FROM events""",
    "sql_view_query": """
        SELECT DISTINCT o_custkey AS cliente, o_orderstatus AS situacao FROM orders
        WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""",
    "pipe_raw_ingest": """
        WITH f AS (SELECT user_id AS id, event_type AS genre, event_id, value AS popularity FROM events
                   QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_type, event_id) = 1)
        SELECT f.id, f.genre, f.event_id, f.popularity, c.c_acctbal AS receita
        FROM f LEFT JOIN customer c ON c.c_custkey = f.id""",
    "pipe_trusted_catalog": """
        WITH cat AS (SELECT o_orderkey AS id, o_orderpriority AS genero, year(o_orderdate) AS ano,
                            CAST(o_custkey % 200 AS INTEGER) AS minutos, o_totalprice AS votos, p_name AS personagem
                     FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey),
        saga AS (SELECT * FROM cat WHERE regexp_matches(personagem, 'red ring|small gizmo') AND id NOT IN (1, 2, 3)),
        gen AS (SELECT * FROM cat WHERE regexp_matches(genero, 'URGENT|HIGH') AND ano BETWEEN 1996 AND 1999
                AND minutos >= 80 AND votos >= 30000)
        SELECT DISTINCT id AS imdb_id, minutos AS tempoMinutos, votos AS numeroVotos_imdb
        FROM (SELECT * FROM saga UNION ALL SELECT * FROM gen)""",
    "pipe_trusted_api": """
        SELECT o_orderkey AS id_tmdb, CAST(trunc(o_totalprice) AS BIGINT) AS orcamento,
               CAST(trunc(c_acctbal) AS BIGINT) AS receita, CAST(year(o_orderdate) AS INTEGER) AS anoLancamento_tmdb,
               'tt' || CAST(o_orderkey AS VARCHAR) AS imdb_id, '2024/04/12' AS data_coleta_tmdb
        FROM orders JOIN customer ON c_custkey = o_custkey
        WHERE trunc(o_totalprice) > 0 AND trunc(c_acctbal) > 0 AND o_custkey % 200 >= 80
          AND o_orderkey % 500 >= 30 AND o_orderkey % 17 <> 0""",
    "pipe_star_general": """
        WITH g AS (SELECT DISTINCT o_orderkey AS id, year(o_orderdate) AS ano, o_totalprice AS orcamento
                   FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
        d AS (SELECT ano, 'dtg' || CAST(row_number() OVER (ORDER BY ano) AS VARCHAR) AS id_data
              FROM (SELECT DISTINCT ano FROM g)),
        t AS (SELECT id, 'tig' || CAST(row_number() OVER (ORDER BY id) AS VARCHAR) AS id_titulo,
                     'adg' || CAST(row_number() OVER (ORDER BY id) AS VARCHAR) AS id_adulto FROM g)
        SELECT g.id AS fato_imdb_id, g.orcamento, d.id_data, t.id_titulo, t.id_adulto
        FROM g JOIN d ON d.ano = g.ano JOIN t ON t.id = g.id""",
    "surrogate_monotonic": """
        SELECT count(*) AS n_rows, count(*) AS n_keys, CAST(1 AS BIGINT) AS least, count(*) AS n_text FROM orders""",
    "sort_file_order": """
        SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_down, CAST(0 AS BIGINT) AS n_overlap FROM orders""",
    "star_dims_general": """
        WITH g AS (SELECT DISTINCT o_orderkey AS id, year(o_orderdate) AS ano, o_orderpriority AS titulo,
                          o_orderstatus = 'F' AS adulto FROM orders JOIN lineitem ON l_orderkey = o_orderkey)
        SELECT 'date' AS dim, CAST(NULL AS BIGINT) AS id, CAST(ano AS VARCHAR) AS value,
               'dtg' || CAST(row_number() OVER (ORDER BY ano) AS VARCHAR) AS key FROM (SELECT DISTINCT ano FROM g)
        UNION ALL SELECT 'title', id, titulo, 'tig' || CAST(row_number() OVER (ORDER BY id) AS VARCHAR) FROM g
        UNION ALL SELECT 'adult', id, CAST(adulto AS VARCHAR),
               'adg' || CAST(row_number() OVER (ORDER BY id) AS VARCHAR) FROM g""",
    "star_dims_subset": """
        WITH g AS (SELECT DISTINCT o_orderkey AS id, year(o_orderdate) AS ano, o_orderpriority AS titulo,
                          o_orderstatus = 'F' AS adulto FROM orders JOIN lineitem ON l_orderkey = o_orderkey
                   WHERE o_orderkey IN (1, 5, 9, 13, 77, 410, 411, 900))
        SELECT 'date' AS dim, CAST(NULL AS BIGINT) AS id, CAST(ano AS VARCHAR) AS value,
               'dt' || CAST(row_number() OVER (ORDER BY ano) AS VARCHAR) AS key FROM (SELECT DISTINCT ano FROM g)
        UNION ALL SELECT 'title', id, titulo, 'ti' || CAST(row_number() OVER (ORDER BY id) AS VARCHAR) FROM g
        UNION ALL SELECT 'adult', id, CAST(adulto AS VARCHAR),
               'ad' || CAST(row_number() OVER (ORDER BY id) AS VARCHAR) FROM g""",
    "pipe_star_subset": """
        WITH g AS (SELECT DISTINCT o_orderkey AS id, year(o_orderdate) AS ano, o_totalprice AS orcamento
                   FROM orders JOIN lineitem ON l_orderkey = o_orderkey
                   WHERE o_orderkey IN (1, 5, 9, 13, 77, 410, 411, 900)),
        d AS (SELECT ano, 'dt' || CAST(row_number() OVER (ORDER BY ano) AS VARCHAR) AS id_tabela_data
              FROM (SELECT DISTINCT ano FROM g)),
        t AS (SELECT id, 'ti' || CAST(row_number() OVER (ORDER BY id) AS VARCHAR) AS id_tabela_titulo FROM g)
        SELECT g.id AS fs_movie_imdb_id, g.orcamento, d.id_tabela_data, t.id_tabela_titulo
        FROM g JOIN d ON d.ano = g.ano JOIN t ON t.id = g.id""",
}

"""DuckDB SQL of the queries that SQL can express.

The other operators are tested against brute force: rounding by hashed draws
(op4), near duplicates and alignment (op3, op9), float sums of two language
models (op8) and a trained labeller (op1) have no SQL form with equal values.
"""

from reelstack.llm.embedding_dedup import THRESHOLD
from reelstack.llm.quality_rules import GRID_TOP, NAMES, SHRINK, SLACK, SPREADS, TWO_SIDED
from reelstack.llm.queries import HOSTILE_TEXT
from reelstack.llm.secret_scans import RULES as SECRET_RULES
from reelstack.llm.url_filters import RULES as URL_RULES

WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def quality_sql() -> str:
    ratios = {"symbols": "n_symbols * 1000 // word_chars", "dup_lines": "n_dup_lines * 1000 // n_lines",
              "repeats": "n_repeat_words * 1000 // n_words", "capitals": "n_upper * 1000 // word_chars",
              "word_length": "word_chars * 100 // n_words"}
    # A zero divisor gives null, which counts as step 0.
    steps = ", ".join(f"coalesce(least({GRID_TOP}, {v}), 0) AS s_{k}" for k, v in ratios.items())
    stacked = " UNION ALL ".join(
        f"SELECT lang, source, '{k}' AS ratio, {SLACK[k][0]} AS low_end, {SLACK[k][1]} AS slack, s_{k} AS step "
        "FROM s WHERE NOT base_failed" for k in NAMES)
    two_sided = ", ".join(f"'{k}'" for k in TWO_SIDED)
    covers = lambda k, n, q: f"min(step) FILTER (4 * {k} >= {q} * {n})"
    drawn = lambda o, l: f"CAST(floor(({o} * n_some + {l} * {SHRINK}) / (n_some + {SHRINK})) AS BIGINT)"
    pick = ", ".join(f"max(high) FILTER (ratio = '{k}') AS high_{k}, max(low) FILTER (ratio = '{k}') AS low_{k}"
                     for k in NAMES)
    inside = " AND ".join([f"s_{k} <= high_{k}" for k in NAMES] + [f"s_{k} >= low_{k}" for k in TWO_SIDED])
    return rf"""
        WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, {WORDS} AS w,
                   list_filter(string_split(coalesce(text, ''), chr(10)),
                               lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
        g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
              FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
        r AS (SELECT doc_id, count(DISTINCT i + k) AS n
              FROM (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
                   (VALUES (0), (1), (2)) AS v(k) GROUP BY doc_id),
        m AS (SELECT d.doc_id, lang, source, len(w) AS n_words, len(array_to_string(w, '')) AS word_chars,
                     len(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
                     len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
                     len(l) AS n_lines, len(regexp_replace(t, '[^\p{{Lu}}]', '', 'g')) AS n_upper
              FROM d LEFT JOIN r ON r.doc_id = d.doc_id),
        s AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, {steps} FROM m),
        a AS ({stacked}),
        o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, ratio ORDER BY step) AS k,
                     count(*) OVER (PARTITION BY lang, source, ratio) AS n FROM a),
        q0 AS (SELECT lang, source, ratio, any_value(low_end) AS low_end, any_value(slack) AS slack, any_value(n) AS n,
                     {covers('k', 'n', 1)} AS q1, {covers('k', 'n', 2)} AS q2, {covers('k', 'n', 3)} AS q3
              FROM o GROUP BY lang, source, ratio),
        q AS (SELECT * REPLACE (CASE WHEN ratio IN ({two_sided}) THEN greatest(slack, q2 // 4) ELSE slack END AS slack) FROM q0),
        p AS (SELECT *, row_number() OVER (PARTITION BY lang, source, ratio ORDER BY step) AS k,
                     count(*) OVER (PARTITION BY lang, source, ratio) AS n,
                     row_number() OVER (PARTITION BY lang, ratio ORDER BY step) AS lk,
                     count(*) OVER (PARTITION BY lang, ratio) AS ln FROM a WHERE step > 0),
        po AS (SELECT lang, source, ratio, any_value(n) AS n_some, {covers('k', 'n', 1)} AS o1, {covers('k', 'n', 3)} AS o3
               FROM p GROUP BY lang, source, ratio),
        pl AS (SELECT lang, ratio, {covers('lk', 'ln', 1)} AS l1, {covers('lk', 'ln', 3)} AS l3 FROM p GROUP BY lang, ratio),
        z AS (SELECT po.lang AS zl, source AS zs, po.ratio AS zr, n_some, {drawn('o1', 'l1')} AS n1, {drawn('o3', 'l3')} AS n3
              FROM po JOIN pl ON pl.lang IS NOT DISTINCT FROM po.lang AND pl.ratio = po.ratio),
        f AS (SELECT lang, source, ratio, CASE WHEN q2 > 0 THEN q2 + {SPREADS} * least(q2 - q1, slack) + slack
                     WHEN n_some IS NULL THEN slack
                     ELSE least(greatest(slack, slack + CAST(floor(2 * n_some * (n1 - slack) / n) AS BIGINT)),
                                greatest(low_end, n3 + {SPREADS} * (n3 - n1))) END AS high,
                     q2 - {SPREADS} * least(q3 - q2, slack) - slack AS low
              FROM q LEFT JOIN z ON zl IS NOT DISTINCT FROM lang AND zs IS NOT DISTINCT FROM source AND zr = ratio),
        b AS (SELECT lang AS bl, source AS bs, {pick} FROM f GROUP BY lang, source)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND coalesce({inside}, true) AS kept
        FROM s LEFT JOIN b ON bl IS NOT DISTINCT FROM lang AND bs IS NOT DISTINCT FROM source"""


def secrets_sql() -> str:
    spans = []
    for order, rule in enumerate(SECRET_RULES):
        pattern = rule.pattern.replace("'", "''")
        least = f"len(regexp_extract_all(t, '{pattern}', {rule.group})[i]) >= {rule.least}" if rule.group else "true"
        spans.append(f"""
            SELECT doc_id, {order} AS ord, '{rule.kind}' AS kind,
                   len(array_to_string(p[1:i], '')) + len(array_to_string(h[1:i - 1], '')) AS a, len(h[i]) AS n
            FROM (SELECT doc_id, t, string_split_regex(t, '{pattern}') AS p, h, unnest(range(1, len(h) + 1)) AS i
                  FROM (SELECT doc_id, t, regexp_extract_all(t, '{pattern}') AS h FROM d)) WHERE {least}""")
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in SECRET_RULES)
    return f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        s AS ({' UNION ALL '.join(spans)}),
        j AS (SELECT doc_id, {counts}, string_agg(kind || ':' || a || ':' || (a + n), ',' ORDER BY a, ord) AS x
              FROM s GROUP BY doc_id)
        SELECT d.doc_id, {', '.join(f'coalesce(n_{r.kind}, 0) AS n_{r.kind}' for r in SECRET_RULES)},
               sha256(coalesce(x, '')) AS base_sha256, coalesce(x, '') AS spans
        FROM d LEFT JOIN j ON j.doc_id = d.doc_id"""


SUBSTRING = f"""
    WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
    g AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g
          FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
    x AS (SELECT DISTINCT doc_id, i + k AS p
          FROM (SELECT doc_id, i FROM g QUALIFY min(doc_id) OVER (PARTITION BY g) < doc_id), range(13) AS v(k)),
    o AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
    k AS (SELECT o.doc_id, count(x.p) AS gone, string_agg(word, ' ' ORDER BY o.p) FILTER (x.p IS NULL) AS kept
          FROM o LEFT JOIN x ON x.doc_id = o.doc_id AND x.p = o.p GROUP BY o.doc_id)
    SELECT d.doc_id, len(w) AS n_words, coalesce(gone, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM d LEFT JOIN k ON k.doc_id = d.doc_id"""

CHAT = f"""
    WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
               UNION ALL SELECT -7, turn, role, '{HOSTILE_TEXT}' FROM (VALUES (0, 'user'), (1, 'assistant')) v(turn, role)),
    e AS (SELECT *, len(role) + len(text) + len(regexp_extract_all(role || chr(0) || text,
                 '\\\\|<s>|</s>|\\[INST\\]|\\[/INST\\]')) + len('<s>[INST][/INST]</s>') AS n FROM t),
    c AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS x,
                 coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
                 CAST(sum(n) AS BIGINT) AS formatted_chars FROM e GROUP BY conv_id)
    SELECT conv_id, n_turns, sha256(x) AS turns_sha256, len(loss) AS loss_chars, sha256(loss) AS loss_sha256,
           formatted_chars FROM c"""


def urls_sql() -> str:
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)
    lower = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

    def node(url: str) -> str:
        path = rf"regexp_extract({url}, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"
        kept = (f"list_reduce(list_transform(string_split({path}, '/'), lambda s: [s]), lambda a, s: CASE s[1] WHEN '.' THEN a "
                "WHEN '..' THEN a[1:greatest(len(a) - 1, 1)] ELSE list_concat(a, s) END)")
        plain = f"""CASE WHEN contains({path}, '/.') THEN array_to_string({kept}, '/') ||
            CASE WHEN regexp_matches({path}, '/[.][.]?$') THEN '/' ELSE '' END ELSE {path} END"""
        return rf"""CASE WHEN regexp_extract({url}, '(?s)^(.*?://[^/?#]*)', 1) <> ''
            THEN translate(regexp_extract({url}, '(?s)^(.*?://[^/?#]*)', 1), {lower}) || {plain} ||
                 regexp_extract({url}, '(?s)^[^#]*?://[^?#]*(\?[^#]*)', 1)
            ELSE regexp_extract({url}, '(?s)^([^#]*)', 1) END"""
    return rf"""
        WITH RECURSIVE rules(verdict, rh, rp) AS (VALUES {rules}),
        raw AS (
          SELECT url, regexp_extract(regexp_extract(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>'),
                                     '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1) AS x FROM pages WHERE contains(url, '://')
          UNION ALL
          SELECT url, regexp_extract(regexp_extract(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>'),
                                     '(?is)\burl\s*=\s*["'']?([^"''\s>]+)', 1) FROM pages WHERE contains(url, '://')),
        abs AS (SELECT url, CASE
                   WHEN regexp_matches(y, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN y
                   WHEN starts_with(y, '//') THEN regexp_extract(url, '(?s)^(.*?:)//', 1) || y
                   WHEN starts_with(y, '/') THEN site || y
                   WHEN starts_with(y, '?') THEN site || path || y
                   WHEN y <> '' AND NOT starts_with(y, '#') AND NOT regexp_matches(y, '^[A-Za-z][A-Za-z0-9+.-]*:')
                     THEN site || CASE WHEN path = '' THEN '/' ELSE regexp_extract(path, '(?s)^(.*/)[^/]*$', 1) END || y END AS t
                 FROM (SELECT url, trim(regexp_replace(x, '&(?:amp|#38|#[xX]26);', '&', 'g')) AS y,
                              regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) AS site,
                              regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM raw)),
        link AS (SELECT {node('url')} AS u, {node('t')} AS v FROM abs WHERE t IS NOT NULL),
        edge AS (SELECT u, v FROM link WHERE v <> '' UNION SELECT v, u FROM link WHERE v <> ''),
        reach(u, v) AS (SELECT u, u FROM edge UNION SELECT r.u, e.v FROM reach r JOIN edge e ON e.u = r.v),
        -- Rules see the url as it stands; aliases meet at their nodes.
        pg AS (SELECT page_id, regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1) AS h0,
                      regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path, {node('url')} AS n FROM pages),
        nd AS (SELECT DISTINCT u AS n, regexp_extract(u, '(?s)^.*?://([^/?#]*)', 1) AS h0,
                      regexp_extract(u, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM edge),
        hp AS (SELECT DISTINCT h0, path, translate(h0, {lower}) AS host FROM (SELECT h0, path FROM pg UNION SELECT h0, path FROM nd)),
        fit AS (SELECT h0, path, host, arg_max(rh || rp, len(rh || rp)) AS rule, arg_max(verdict, len(rh || rp)) AS own
                FROM hp LEFT JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
                GROUP BY h0, path, host),
        alias AS (SELECT r.u AS n, min(f.own) AS verdict FROM reach r JOIN nd ON nd.n = r.v
                  JOIN fit f ON f.h0 = nd.h0 AND f.path = nd.path WHERE f.own IS NOT NULL GROUP BY r.u)
        SELECT page_id, coalesce(host, '') AS host, coalesce(pg.path, '') AS path, rule,
               coalesce(own, alias.verdict, 'allow') AS verdict
        FROM pg LEFT JOIN fit ON fit.h0 = pg.h0 AND fit.path = pg.path LEFT JOIN alias ON alias.n = pg.n"""


def crc32_sql(text: str) -> str:
    """The checksum of an ASCII text, bit by bit."""
    bits = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, (y & 1) * 3988292384))"
    bytes_ = f"list_transform(string_split({text}, ''), lambda ch: CAST(ascii(ch) AS BIGINT))"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {bytes_}), lambda c, b: {bits}), 4294967295)"


TRIE = f"""
    WITH t AS (SELECT conv_id, turn, len(coalesce(text, '')) AS size, left(sha256(concat(
                      len(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))), 32) AS name
               FROM conversations WHERE conv_id IS NOT NULL),
    o AS (SELECT conv_id, name, size, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, name) AS p FROM t),
    h AS (SELECT conv_id, conv_id - conv_id % 100 AS head, {crc32_sql("CAST(conv_id AS VARCHAR)")} % 6 AS h
          FROM (SELECT DISTINCT conv_id FROM t)),
    b AS (SELECT h.conv_id, p, name, size FROM h JOIN o ON o.conv_id = head AND p <= h
          UNION ALL SELECT h.conv_id, p + 5, name, size FROM h JOIN o ON o.conv_id = h.conv_id AND p > h),
    s AS (SELECT conv_id, size, row_number() OVER (PARTITION BY conv_id ORDER BY p) AS d,
                 string_agg(name, '') OVER (PARTITION BY conv_id ORDER BY p) AS k FROM b
          UNION ALL SELECT conv_id, 0, 0, '' FROM h),
    n AS (SELECT k, d, any_value(size) AS size, count(*) AS members, min(conv_id) AS c FROM s GROUP BY k, d),
    m AS (SELECT n.*, left(n.k, len(n.k) - 32) AS up, coalesce(kids, 0) AS kids, (members - 1) * size AS v
          FROM n LEFT JOIN (SELECT left(k, len(k) - 32) AS k, count(*) AS kids FROM n WHERE d > 0 GROUP BY 1) x ON x.k = n.k),
    z AS (SELECT s.k, count(*) FILTER (kids = 0) AS leaves, CAST(sum(v) AS BIGINT) AS saved
          FROM m JOIN s ON s.conv_id = m.c AND s.d <= m.d GROUP BY s.k),
    e AS (SELECT k, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS x
          FROM (SELECT conv_id, arg_max(k, d) AS k FROM s GROUP BY conv_id) GROUP BY k)
    SELECT m.c AS conv_id, m.d AS depth, p.c AS parent_conv_id, m.members AS n_convs, m.kids AS n_children,
           leaves AS n_leaves, saved AS saved_tokens, coalesce(x, sha256('')) AS ends_sha256
    FROM m LEFT JOIN n p ON m.d > 0 AND p.k = m.up JOIN z ON z.k = m.k LEFT JOIN e ON e.k = m.k"""


def repair_sql() -> str:
    """The cheapest repair by the states of the grammar, from the last turn up: a
    state's value is its cost in eight digits followed by its least audit."""
    add = lambda x, edit, cost: f"lpad(CAST(CAST(left({x}, 8) AS BIGINT) + {cost} AS VARCHAR), 8, '0') || '{edit}' || substr({x}, 9)"
    follows = {"st": "u", "s": "u", "a": "u", "u": "a"}

    def taken(state: str) -> str:
        to = follows[state]
        fit = f"CASE WHEN i0 = '{to}' THEN {add('f.' + to, 'K', 'extra')} ELSE {add('f.' + to, 'R', '3 + extra')} END"
        lead = f", CASE WHEN i0 = 's' THEN {add('f.s', 'K', 'extra')} ELSE '99999999' END" if state == "st" else ""
        gone = add("f." + state, "D", 4)
        return f"CASE WHEN must THEN {gone} ELSE least({gone}, {fit}{lead}) END AS b_{state}"

    def inserted(state: str) -> str:
        one = follows[state]
        return f"least(b_{state}, {add('b_' + one, 'I', 3)}, {add('b_' + follows[one], 'II', 6)}) AS {state}"

    states = list(follows)
    spaces = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    draw = crc32_sql("concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' '))")
    return f"""
        WITH RECURSIVE r AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {draw} % 20 AS k
                             FROM conversations),
        x AS (SELECT conv_id, turn, CASE k WHEN 4 THEN 'user' ELSE role END AS role,
                     CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                     unnest(CASE k WHEN 0 THEN []::INT[] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM r),
        o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
                     left(role, 1) AS i0, right(rtrim(text, {spaces}), 1) AS last FROM x),
        q AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
                     lag(i0) OVER (PARTITION BY conv_id ORDER BY i) AS prev FROM o),
        g AS (SELECT *, last = '' OR again AS must, CASE WHEN last <> '' AND NOT again AND last NOT IN ('.', '!', '?')
                     THEN 3 ELSE 0 END AS extra FROM q),
        c AS (SELECT ids.conv_id, count(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                     count(*) FILTER (last = '') AS blank, count(*) FILTER (last <> '' AND again) AS duplicate,
                     count(*) FILTER (extra = 3) AS truncated,
                     count(*) FILTER (prev IS NOT NULL AND prev || i0 NOT IN ('su', 'ua', 'au')) AS illegal
              FROM (SELECT DISTINCT conv_id FROM conversations) ids LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM ids.conv_id
              GROUP BY ids.conv_id),
        f(conv_id, i, {', '.join(states)}) AS (
          SELECT conv_id, n + 1, '00000000', '00000006II', '00000000', '00000003I' FROM c
          UNION ALL
          SELECT conv_id, i, {', '.join(inserted(x) for x in states)}
          FROM (SELECT g.conv_id, g.i, {', '.join(taken(x) for x in states)}
                FROM f JOIN g ON g.conv_id IS NOT DISTINCT FROM f.conv_id AND g.i = f.i - 1)),
        w AS (SELECT conv_id, CAST(left(st, 8) AS BIGINT) AS cost, substr(st, 9) AS audit FROM f WHERE i = 1),
        l AS (SELECT conv_id, audit, unnest(range(1, len(audit) + 1)) AS j FROM w),
        a AS (SELECT conv_id, j, audit[j] AS edit, len(replace(audit[1:j], 'I', '')) AS i,
                     len(replace(audit[j:], 'D', '')) AS rest FROM l),
        y AS (SELECT a.conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN g.role WHEN rest % 2 = 0 THEN 'user'
                       ELSE 'assistant' END || ':' || CASE WHEN edit = 'I' THEN '' ELSE g.text END, chr(10) ORDER BY j)) AS digest
              FROM a LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM a.conv_id AND g.i = a.i WHERE edit <> 'D' GROUP BY a.conv_id)
        SELECT c.conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, coalesce(digest, sha256('')) AS repaired_sha256
        FROM c JOIN w ON w.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN y ON y.conv_id IS NOT DISTINCT FROM c.conv_id"""


VECTORS = f"""
    WITH RECURSIVE e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
        WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    l AS MATERIALIZED (SELECT a.vec_id AS u, b.vec_id AS v FROM e a JOIN e b ON a.label = b.label AND len(a.v) = len(b.v)
          WHERE a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= {THRESHOLD}),
    reach(u, v) AS (SELECT u, v FROM l UNION SELECT r.u, l.v FROM reach r JOIN l ON l.u = r.v),
    n AS (SELECT u, count(*) AS n FROM l GROUP BY u),
    m AS (SELECT u, min(v) AS least FROM reach GROUP BY u)
    SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(least, vec_id)) AS component_id,
           vec_id = least(vec_id, coalesce(least, vec_id)) AS kept
    FROM embeddings LEFT JOIN n ON n.u = vec_id LEFT JOIN m ON m.u = vec_id"""


ORACLE_SQL: dict[str, str] = {
    "op2_secret_scans": secrets_sql(),
    "op5_substring_dedup": SUBSTRING,
    "op6_chat_format": CHAT,
    "op7_url_filters": urls_sql(),
    "op10_quality_rules": quality_sql(),
    "op11_prefix_trie": TRIE,
    "op12_structure_repair": repair_sql(),
    "op13_embedding_dedup": VECTORS,
}

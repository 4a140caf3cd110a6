"""Quality rules, secret scans, mixing, chat format and URL filters against
brute force, on a small table and on awkward rows."""

import collections
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from reelstack.llm import chat_format, graph, mixing, quality_rules, secret_scans, url_filters
from reelstack.llm.queries import HOSTILE
from reelstack.session import materialize
from tests.conftest import SF001
from tests.llm import edge


def given(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select(
        "doc_id", "text", "lang", "source", "n_chars").collect()]


def doc_key(r):
    return (r[0] is None, r[0] or 0, r[1] or "")


@pytest.fixture(params=["table", "awkward"])
def docs(request, spark):
    return given(spark) if request.param == "table" else edge.documents()


def metrics(text):
    w = edge.words(text)
    seen = collections.Counter(zip(w, w[1:], w[2:]))
    inside = {p for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if edge.words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside))


def test_quality_metrics(spark, docs):
    got = quality_rules.quality_rules(edge.frame(spark, docs, clash=True)).collect()
    counts = lambda r: (r.doc_id is None, r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
    want = sorted((d[0] is None, d[0] or 0, *metrics(d[1])) for d in docs)
    assert sorted(map(counts, got)) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_quality_thresholds_match_exact_quartiles(spark):
    table = edge.frame(spark, given(spark))
    m = materialize(quality_rules.document_metrics(table, ["doc_id", "lang", "source"]), "m")
    rows = m.filter("not base_failed").collect()
    found = quality_rules.quartiles(quality_rules.quantile_sketch(m)).collect()
    assert found
    for r in found:
        values = sorted(x[f"_{r.ratio}"] for x in rows if (x.lang, x.source) == (r.lang, r.source))
        rank = lambda q: values[-(-q * len(values) // 4) - 1]
        assert (r.q1, r.q2, r.q3) == (rank(1), rank(2), rank(3))


def test_quality_sketches_merge(spark):
    m = materialize(quality_rules.document_metrics(
        edge.frame(spark, given(spark)), ["doc_id", "lang", "source"]), "m")
    halves = [quality_rules.quantile_sketch(m.filter(f"doc_id % 2 = {k}")) for k in (0, 1)]
    merged = quality_rules.merge_sketches(halves[0].unionByName(halves[1]), "lang", "source")
    whole = quality_rules.quantile_sketch(m).select(*merged.columns)
    assert sorted(map(tuple, merged.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)


def test_quality_rejects_junk_keeps_uniform_groups(spark):
    clean = [(i, edge.prose(80 + i, i), "en", "a", 0) for i in range(60)]
    junk = [(100 + i, " ".join(w + "###" for w in edge.prose(80, 200 + i).split()), "en", "a", 0) for i in range(5)]
    kept = {r.doc_id for r in quality_rules.keep_good(edge.frame(spark, clean + junk)).collect()}
    assert kept == set(range(60))


SPANS = ((re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A),
          "assign", lambda m: len(m[2]) >= 6), (re.compile(r"AKIA[A-Z0-9]+"), "access", lambda m: len(m[0]) >= 20),
         (re.compile(r"[0-9a-f]+"), "hex", lambda m: len(m[0]) >= 24))


def secrets(text):
    found = sorted((m.start(), k, name, m.end()) for k, (p, name, ok) in enumerate(SPANS)
                   for m in p.finditer(text or "") if ok(m))
    return ",".join(f"{n}:{a}:{b}" for a, _, n, b in found)


def test_secret_spans(spark, docs):
    extra = [(900, "token=tok : secret = \"ABCDEFG\" Password:'a/b=c+d' api_key==x", "en", "s", 0),
             (901, "éé secret:" + "f" * 30 + " AKIA" + "Z" * 16 + "apikey=1234567", "en", "s", 0)]
    rows = secret_scans.secret_scans(edge.frame(spark, docs + extra, clash=True)).collect()
    want = sorted((d[0] is None, d[0] or 0, secrets(d[1])) for d in docs + extra)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.spans) for r in rows) == want
    for r in rows:
        assert r.base_sha256 == hashlib.sha256(r.spans.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(r.spans.count(f"{k}:") for k in ("assign", "access", "hex"))


def test_ledger_scans_only_unseen_pairs(spark, tmp_path):
    path = str(tmp_path / "ledger")
    table = edge.frame(spark)
    secret_scans.scan(table, path)
    first = spark.read.parquet(path).count()
    assert first == len({d[1] or "" for d in edge.documents()})
    secret_scans.scan(table, path)
    assert spark.read.parquet(path).count() == first
    new = [*secret_scans.RULES[:2], secret_scans.Rule("hex", 2, r"[0-9a-f]{40,}")]
    found = secret_scans.scan(table, path, tuple(new)).collect()
    added = spark.read.parquet(path).filter(F.array_contains("rules", "hex@2"))
    assert added.count() == first and added.filter(F.size("rules") != 1).count() == 0
    assert not any(s["kind"] == "hex" for r in found for s in r["found"])


def test_redaction(spark):
    rows = {(r.doc_id, r.text) for r in secret_scans.redact(edge.frame(spark)).collect()}
    text = {d[0]: d[1] for d in edge.documents()}
    for i, t in rows:
        if secrets(text[i]):
            assert not secrets(t) and "[assign]" in t and "[hex]" in t
        else:
            assert t == text[i]
    assert len(secret_scans.redact(edge.frame(spark)).columns) == 5


def targets(rows):
    size = collections.Counter()
    for _, t, _, s, _ in rows:
        size[s] += len(edge.words(t))
    names = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, full = 1.5 * sum(size.values()), set()
    while True:
        rest = total - sum(2 * size[s] for s in full)
        open_weight = sum(weight[s] for s in names if s not in full)
        more = {s for s in names if s not in full and rest * weight[s] / open_weight > 2 * size[s] + 1e-9}
        if not more:
            return size, {s: 2 * size[s] if s in full else rest * weight[s] / open_weight for s in names}
        full |= more


def test_mixing(spark, docs):
    size, target = targets(docs)
    rows = mixing.mix(edge.frame(spark, docs, clash=True)).collect()
    assert len(rows) == len(docs)
    want = sorted((d[0] is None, d[0] or 0, len(edge.words(d[1]))) for d in docs)
    assert sorted((r.doc_id is None, r.doc_id or 0, r["size"]) for r in rows) == want
    taken, largest = collections.Counter(), collections.Counter()
    for r in rows:
        assert r.source_size == size[r.source] and abs(r.target - target[r.source]) < 1e-6
        assert r.taken <= 2 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0)
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
    for s in target:
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6
    again = mixing.mix(edge.frame(spark, docs).repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_mixing_tree_of_many_groups(spark):
    rows = [(i, "w " * (1 + i * i % 37), "en", "ab"[i % 3 == 0], 0) for i in range(3000)]
    out = mixing.mix(edge.frame(spark, rows)).groupBy("source").agg(
        F.max("target").alias("t"), F.sum("taken").alias("taken"), F.count("*").alias("n")).collect()
    assert sum(r.n for r in out) == 3000
    assert all(abs(r.t - r.taken) <= 19 for r in out)


def test_mixing_is_fair(spark):
    """Over many sources, as independent draws: a document's mean outcome is
    its wanted fraction, and the words of a group are kept."""
    rows = [(f"s{t}", k, 3 + 2 * k, 7, 0.3) for t in range(1500) for k in range(7)]
    df = spark.createDataFrame(rows, "source string, doc_id long, size long, n long, p double")
    out = mixing.round_groups(df, 0, 1).collect()
    assert len(out) == 1500
    mean = collections.Counter()
    for r in out:
        assert len(r.out) == 6
        words = sum(x["hit"] * x["size"] for x in r.out) + r.r.p * r.r["size"]
        assert abs(words - 0.3 * sum(3 + 2 * k for k in range(7))) < 1e-6
        for x in r.out:
            mean[x.doc_id] += x.hit / 1500
        mean[r.r.doc_id] += r.r.p / 1500
    assert all(abs(v - 0.3) < 0.05 for v in mean.values()) and len(mean) == 7


def conversations(spark, name):
    if name == "table":
        rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet").select(
            "conv_id", "turn", "role", "text").collect()]
    else:
        rows = [(1, 0, "user", None), (1, 1, "assistant", "a\\b \\\\ [INST]</s>\n<s>"), (1, 1, "assistant", "same turn"),
                (2, 0, None, ""), (2, None, "assistant", "no turn"), (None, 3, "assistant", "\x00\u2028😀" * 50),
                (3, 0, "assistant", "x" * 200_000), (4, 0, "we[/INST]ird", "<[INST]></s></s>\\"), (4, 0, "we[/INST]ird", "<")]
    return rows + [tuple(r) for r in spark.sql(HOSTILE).collect()]


@pytest.mark.parametrize("name", ["table", "awkward"])
def test_chat_format(spark, name):
    rows = conversations(spark, name)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.withColumns({"formatted": F.lit("x"), "loss": F.lit(1), "record": F.lit("{}")})
    formatted = chat_format.chat_format(df)
    got = {r.conv_id: r for r in chat_format.digests(formatted).collect()}
    strings = {r.conv_id: r.formatted for r in formatted.collect()}
    by = collections.defaultdict(list)
    for c, t, role, text in rows:
        by[c].append((t is not None, t or 0, role or "", text or ""))
    assert set(got) == set(by)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for c, turns in by.items():
        turns = sorted(turns, key=lambda t: t[:3]) if name == "table" else sorted(turns, key=lambda t: (t[0], t[1], t[2], t[3]))
        r, loss = got[c], "".join(t[3] for t in turns if t[2] == "assistant")
        assert r.n_turns == len(turns)
        if c != 4:
            assert r.turns_sha256 == sha("".join(f"{t[2]}\n{t[3]}\n" for t in turns))
        assert (r.loss_chars, r.formatted_chars) == (len(loss), len(strings[c]))
        assert r.loss_sha256 == sha(loss)
        for mark in ("<s>", "</s>", "[INST]", "[/INST]"):
            assert strings[c].count(mark) == len(turns)


def test_chat_layouts(spark):
    records = [(1, '{"prompt":"p","completion":"c"}'), (2, '{"instruction":"i","output":"o"}'),
               (3, '{"messages":[{"role":"user","content":"u"},{"role":"assistant","content":null}]}'),
               (4, '{"messages":[{"role":"user","content":"u"},{"role":"assistant","content":"a"}]}'),
               (5, '{"conversations":[{"from":"human","value":"h"}]}'), (6, '{"other":1}'), (7, "not json"), (8, None),
               (9, '{"response":"r","prompt":"p"}')]
    out = {r.n: r for r in chat_format.canonical_turns(spark.createDataFrame(records, "n int, record string")).collect()}
    turns = lambda n: [tuple(t) for t in out[n].turns]
    assert turns(1) == [("user", "p"), ("assistant", "c")] and turns(2) == [("user", "i"), ("assistant", "o")]
    assert turns(4) == [("user", "u"), ("assistant", "a")] and turns(5) == [("human", "h")]
    assert turns(9) == [("user", "p"), ("assistant", "r")]
    assert out[6].turns is None and out[7].turns is None and out[8].turns is None
    assert out[6].fingerprint != out[1].fingerprint
    assert chat_format.unknown(chat_format.canonical_turns(
        spark.createDataFrame(records, "n int, record string"))).count() >= 2


def test_chat_roles_of_other_layouts_reach_the_loss(spark):
    records = [(1, 0, '{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":"answer"}]}'),
               (1, 1, '{"role":"gpt","text":"as given"}'), (2, 0, '{"prompt":"p","completion":"c"}')]
    rows = chat_format.chat_format(spark.createDataFrame(records, "conv_id int, turn int, record string"))
    out = {r.conv_id: r for r in chat_format.read_back(rows).collect()}
    assert [tuple(t) for t in out[1].turns] == [("user", "q"), ("assistant", "answer"), ("gpt", "as given")]
    assert out[1].loss_texts == ["answer"] and out[2].loss_texts == ["c"]


def judged(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host = re.sub("[A-Z]", lambda c: c[0].lower(), m[1]) if m else ""
    path = m[2] if m else ""
    fit = [(len(h + p), h + p, v) for v, h, p in url_filters.RULES
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit)[1:] if fit else (None, None)))


URLS = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?y#z", "http://example.com/en", "http://example.com/en/",
        "http://aexample.com/en/", "ftp://x.net/es/a", "http://net/fr/", "http://É.net/fr/q?", "a://b.com://c/d",
        "http://org?x=/en/", "http://x.com"]


def test_url_rules(spark):
    rows = [(i, u, None) for i, u in enumerate(URLS + URLS[4:6])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(
        {c: F.lit("x") for c in ("host", "path", "rule", "_node", "node", "target")})
    got = {r.page_id: r for r in url_filters.url_filters(df).collect()}
    assert len(got) == len(rows)
    for i, u, _ in rows:
        host, path, rule, verdict = judged(u)
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict or "allow")


def test_url_aliases_take_decisions(spark):
    link = lambda u: f'<html><head><LINK rel="canonical" href="{u}"></head></html>'
    rows = [(1, "http://a.org/1", link("http://x.net/es/1")), (2, "http://b.org/1", link("http://a.org/1")),
            (3, "http://c.org/", '<meta http-equiv="refresh" content="0; url=http://b.org/1">'),
            (4, "http://d.org/", link("http://c.org/#top")), (5, "http://lone.org/", None),
            (6, "http://e.org/", link("http://f.com/ok")), (7, "http://g.org/", link("http://e.org/")),
            (8, "http://g.org/#frag", ""), (9, "http://h.net/fr/", link("http://f.com/ok"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in url_filters.url_filters(df).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "block", 5: "allow", 6: "allow", 7: "allow", 8: "allow", 9: "block"}
    log = spark.createDataFrame([("http://lone.org/", "http://x.net/es/1"), (None, "x")], "url string, target string")
    assert {r.page_id: r.verdict for r in url_filters.url_filters(df, log).collect()}[5] == "block"


def test_components(spark):
    import random
    r = random.Random(4)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100)] + [(200, 200 + k) for k in range(1, 40)] * 2
    edges += [(r.randint(300, 400), r.randint(300, 400)) for _ in range(70)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    got = {x.node: x.component for x in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: root(x) for x in parent}


@pytest.mark.parametrize("op", [quality_rules.quality_rules, secret_scans.secret_scans, mixing.mix, quality_rules.keep_good,
                                secret_scans.redact])
def test_empty_tables(spark, op):
    assert op(edge.frame(spark, [])).collect() == []


def test_empty_pages_and_conversations(spark):
    assert url_filters.url_filters(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_format.digests(chat_format.chat_format(empty)).collect() == []


def test_quality_fences_follow_their_group(spark):
    """Two sources of one language where few and where many texts hold symbols,
    and a small one that leans on the language."""
    def doc(i, source, marks):
        w = edge.prose(120, i).split()
        for k in range(marks):
            w[7 * k] += "#" * 6
        return (i, " ".join(w), "en", source, 0)
    rows = [doc(i, "few", 15 if i % 20 == 0 else 0) for i in range(200)]
    rows += [doc(1000 + i, "many", 15 if i % 5 < 2 else 0) for i in range(200)]
    rows += [doc(2000 + i, "small", 15 if i == 0 else 0) for i in range(8)]
    m = quality_rules.document_metrics(edge.frame(spark, rows), ["doc_id", "lang", "source"])
    got = {r.source: r for r in quality_rules.thresholds(quality_rules.quantile_sketch(materialize(m, "m"))).collect()}
    high = {s: r.high_symbols for s, r in got.items()}
    some = next(r._symbols for r in materialize(m, "m2").filter("doc_id = 0").collect())
    least, slack = quality_rules.SLACK["symbols"]
    assert slack < high["few"] < high["small"] < high["many"] < some
    assert high["few"] == pytest.approx(slack + 2 * 0.05 * (some - slack), abs=5)
    assert high["many"] == pytest.approx(slack + 2 * 0.4 * (some - slack), abs=20)


def test_quality_word_lengths_beyond_a_line(spark):
    """Texts without spaces have ratios of their own, far up the grid."""
    rows = [(i, " ".join("x" * (150 + 5 * i) for _ in range(60)), "zh", "s", 0) for i in range(30)]
    rows.append((99, " ".join("x" * 9000 for _ in range(60)), "zh", "s", 0))
    kept = {r.doc_id for r in quality_rules.quality_rules(edge.frame(spark, [
        (i, " ".join(f"{j}{w}" for j, w in enumerate(t.split())), *rest) for i, t, *rest in rows])).collect() if r.kept}
    assert kept == set(range(30))


LINKS = ["http://www.M.org/1", "HTTP://WWW.m.ORG/1#x", "//cdn.org/a", "/root/x", "page.html", "?id=3&amp;k=4", "../up/./y", "a/b/../../c",
         "../../../../top", "./", "..", "#here", "", "mailto:a@b.c", "javascript:void(0)", "dir/", "x?y=../z", "/a/./b/../c/.", "&#38;q"]
BASES = ["http://Host.org/one/two/three.html?q=1#f", "https://host.org", "http://host.org/", "http://host.org/d/", "ftp://x/y"]


def test_url_links_resolve_like_a_browser(spark):
    from urllib.parse import urljoin, urlsplit
    rows = [(b, x) for b in BASES for x in LINKS]
    df = spark.createDataFrame(rows, "url string, link string").select(
        "url", "link", url_filters.link_target(F.col("url"), F.col("link")).alias("t"))
    for r in df.select("*", url_filters.node(F.col("t")).alias("n")).collect():
        plain = r.link.replace("&amp;", "&").replace("&#38;", "&")
        if plain == "" or plain[0] == "#" or plain.startswith(("mailto:", "javascript:")):
            assert r.t is None and r.n is None
            continue
        want = urlsplit(urljoin(r.url, plain))
        query = f"?{want.query}" if want.query else ""
        path = want.path if want.path or not plain.startswith("?") else ""
        assert r.n == f"{want.scheme}://{want.netloc.lower()}{path}{query}", (r.url, r.link)


def test_url_verdicts_over_links_equal_sql(spark):
    """The SQL of the query on pages that link to one another in every way."""
    import duckdb
    from reelstack.llm.oracle import urls_sql
    tags = ['<link rel="canonical" href="{}">', "<LINK  href='{}' rel=canonical>", '<meta http-equiv="Refresh" content="0; URL={}">']
    rows, at = [], 0
    for b in BASES + ["HTTP://WWW.m.org/1", "http://x.net/es/1", "http://a.org/es/../1", "no url", None]:
        for k, x in enumerate([*LINKS, "http://x.net/es/1", "http://A.org/1"]):
            rows.append((at, b if k % 3 else f"{b}?p={k}" if b else None, "<html>" + tags[k % 3].format(x) + "</html>" if k % 4 else None))
            at += 1
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filters.url_filters(df).collect())
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    want = sorted(con.execute(urls_sql()).fetchall())
    assert got == want
    assert {v for *_, rule, v in want if rule is None} == {"allow", "block"}

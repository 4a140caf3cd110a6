"""Near dedup, substring dedup, decontamination, LM scores and html extraction
against brute force, on a small table and on awkward rows."""

import collections
import hashlib
import html
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelstack.llm import decontamination, html_extract, html_training, lm_scoring, near_dedup, substring_dedup, tokens
from reelstack.llm.html_blocks import blocks_of
from tests.conftest import SF001
from tests.llm import edge


def given(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select(
        "doc_id", "text", "lang", "source", "n_chars").collect()]


@pytest.fixture(params=["table", "awkward"])
def docs(request, spark):
    return given(spark) if request.param == "table" else edge.documents()


def test_word_hashes(monkeypatch):
    r = random.Random(1)
    w = ["x" * r.randint(1, 9) + str(r.randint(0, 400)) + "é" * r.randint(0, 2) for _ in range(4000)]
    text = " ".join(w).encode()
    whole = tokens.word_hashes(text)
    seen = {}
    assert all(seen.setdefault(x, h) == h for x, h in zip(w, whole.tolist())) and len(set(seen.values())) == len(seen)
    monkeypatch.setattr(tokens, "BLOCK_BYTES", 64)
    assert (tokens.word_hashes(text) == whole).all()
    assert tokens.normal("\x0b a b\r\nc\x85d ") == "a b c\x85d".encode()


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_banded_alignment():
    r = random.Random(5)
    for _ in range(3000):
        a = [r.randint(0, 5) for _ in range(r.randint(0, 35))]
        b = list(a)
        for _ in range(r.randint(0, 9)):
            i = r.randint(0, len(b))
            b[i:i + r.randint(0, 1)] = [r.randint(0, 6)] * r.randint(0, 1)
        like = not max(len(a), len(b)) or 1 - distance(a, b) / max(len(a), len(b)) >= 0.8 - 1e-12
        assert near_dedup.similar(np.array(a, np.uint32), np.array(b, np.uint32)) == like
        if len(a) < len(b):
            a, b = b, a
        band = max(1, len(a) - len(b), r.randint(0, 12))
        if len(a) > band:
            assert near_dedup.banded_distance(a, b, band) == min(distance(a, b), band + 1)


def test_near_dedup_classes(spark, docs):
    rows = near_dedup.near_dedup(edge.frame(spark, docs, clash=True)).collect()
    assert len(rows) == len(docs)
    got = {r.doc_id: r.class_id for r in rows}
    text = {d[0]: edge.words(d[1]) for d in docs if d[0] is not None}
    ids = sorted(text)
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    number = {}
    arrays = {i: np.array([number.setdefault(w, len(number)) for w in text[i]], np.uint32) for i in ids}
    shingles = {i: set(zip(*[text[i][k:] for k in range(5)])) for i in ids}
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            shared = text[a] == text[b] or (shingles[a] & shingles[b])
            if shared and near_dedup.similar(arrays[a], arrays[b]):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    assert {i: got[i] for i in ids} == {i: root(i) for i in ids}


def test_near_dedup_finds_planted_edits(spark):
    r = random.Random(9)
    rows, n = [], 120
    for i in range(n):
        w = edge.prose(150 + i, i).split()
        rows.append((i, " ".join(w), "en", "s", 0))
        for _ in range(8):
            w[r.randrange(len(w))] = f"edit{r.randint(0, 999)}"
        rows.append((1000 + i, " ".join(w), "en", "s", 0))
    got = {x.doc_id: x.class_id for x in near_dedup.near_dedup(edge.frame(spark, rows)).collect()}
    assert got == {**{i: i for i in range(n)}, **{1000 + i: i for i in range(n)}}


def test_near_dedup_mixed_bucket_comes_apart(spark):
    """Texts that share one long passage but are not similar keep their own
    near copies, though all of them meet in the passage's buckets."""
    passage = edge.prose(40, 77)
    rows = []
    for i in range(40):
        own = edge.prose(60, 500 + i)
        rows += [(2 * i, f"{own} {passage}", "en", "s", 0), (2 * i + 1, f"{own} {passage} end", "en", "s", 0)]
    got = {x.doc_id: x.class_id for x in near_dedup.near_dedup(edge.frame(spark, rows)).collect()}
    assert got == {i: i - i % 2 for i in range(80)}


def test_near_dedup_finds_scattered_edits_near_the_threshold(spark):
    """Edit similarity 0.80 to 0.85: nearly all pairs are proposed."""
    r = random.Random(12)
    rows, n = [], 120
    for i in range(n):
        w = edge.prose(300, 2000 + i).split()
        rows.append((i, " ".join(w), "en", "s", 0))
        for k in r.sample(range(300), r.randint(45, 60)):
            w[k] = f"edit{r.randint(0, 9999)}"
        rows.append((1000 + i, " ".join(w), "en", "s", 0))
    got = {x.doc_id: x.class_id for x in near_dedup.near_dedup(edge.frame(spark, rows)).collect()}
    assert sum(got[1000 + i] == i for i in range(n)) >= 0.98 * n


def linked(spark, texts, values):
    """Classes among texts (id to words) that have the given sketch values."""
    docs = edge.frame(spark, [(i, " ".join(w), "en", "s", 0) for i, w in texts.items()]).select(
        F.col("doc_id").alias("id"), F.xxhash64("text").alias("tx"), "text")
    schema = "id long, tx long, copy binary, n int, sketch array<long>, bins binary, words binary"
    sketched = docs.mapInArrow(near_dedup.sketch_batches, schema)
    given = spark.createDataFrame(list(values.items()), "id long, sketch array<long>")
    table = sketched.drop("sketch").join(given, "id").withColumn("node", F.col("id"))
    found = near_dedup.links(table).collect()
    root = {i: i for i in texts}
    for _ in texts:
        for x in found:
            root[x.u] = root[x.v] = min(root[x.u], root[x.v])
    return root


def test_near_dedup_chain_in_one_bucket(spark):
    """L-B-A, where B is similar to L and A only to B, with one sketch in
    common and an unlike text before them in the bucket."""
    base = edge.prose(100, 31).split()
    b = [f"b{k}" if k < 15 else w for k, w in enumerate(base)]
    a = [f"a{k}" if 50 <= k < 65 else w for k, w in enumerate(b)]
    texts = {1: edge.prose(100, 32).split(), 2: base, 3: b, 4: a}
    assert linked(spark, texts, {i: [7, *range(10 * i, 10 * i + 3)] for i in texts}) == {1: 1, 2: 2, 3: 2, 4: 2}


def test_near_dedup_classes_that_meet_in_one_group_only(spark):
    texts = {}
    for i in range(7):
        texts[2 * i] = edge.prose(40, 60 + i).split()
        texts[2 * i + 1] = [*texts[2 * i], "end"]
    assert linked(spark, texts, {i: [5, 6] for i in texts}) == {i: i - i % 2 for i in texts}


def test_near_dedup_copies_in_a_large_mixed_group(spark, monkeypatch):
    """Two large classes and many single texts share values; each class has one
    of its own, and single texts stay single."""
    monkeypatch.setattr(near_dedup, "SMALL", 64)
    texts, at = {}, 10
    for k, size in ((1, 90), (2, 70)):
        base = edge.prose(60, 90 + k).split()
        for i in range(size):
            texts[at] = [f"e{i}" if j == i % 60 else w for j, w in enumerate(base)] + ["x"] * (i // 60)
            at += 1
    for i in range(80):
        texts[1000 + i] = edge.prose(60, 300 + i).split()
    kind = lambda i: 10 if i < 100 else 100 if i < 170 else i
    assert linked(spark, texts, {i: [5, 6, kind(i)] for i in texts}) == {i: kind(i) for i in texts}


def test_near_dedup_judges_all_pairs_of_a_large_group(spark, monkeypatch):
    """Similar texts far apart in the lengths of a group of many unlike texts,
    with no other value in common, and two of one length."""
    for name, size in (("SMALL", 16), ("CELL", 16)):
        monkeypatch.setattr(near_dedup, name, size, raising=False)
    texts = {i: edge.prose(100 + i % 24, 400 + i).split() for i in range(2, 120)}
    texts[200] = [*texts[24 * 2], *(f"more{k}" for k in range(20))]
    texts[201] = [f"new{k}" if k < 9 else w for k, w in enumerate(texts[50])]
    texts[202] = [f"last{k}" if k > 90 else w for k, w in enumerate(texts[201])]
    same = {200: 48, 201: 50, 202: 50}
    assert linked(spark, texts, {i: [5] for i in texts}) == {i: same.get(i, i) for i in texts}


def test_near_dedup_deals_a_text_once_to_groups_of_like_members(spark, monkeypatch):
    """Unlike texts share up to 20 values, each value's texts are part of those of the
    one before: not a row per text and value is dealt, but one per text. The similar
    pair shares all but the last values."""
    dealt, stored = [], near_dedup.materialize

    def watched(df, name):
        out = stored(df, name)
        if name == "omh_dealt_a":
            dealt.append(out.count())
        return out
    monkeypatch.setattr(near_dedup, "materialize", watched)
    texts = {i: edge.prose(100, 600 + i).split() for i in range(80)}
    texts[41] = [f"new{k}" if k < 9 else w for k, w in enumerate(texts[40])]
    assert linked(spark, texts, {i: [*range(20 - i // 4)] for i in texts}) == {i: 40 if i == 41 else i for i in texts}
    assert dealt == [80]


def test_near_dedup_merged_groups_keep_every_pair(spark):
    """Groups are merged where that is no more pairs, and no pair is lost by it."""
    r = random.Random(5)
    groups = {g: {1 + 100 * (g // 8), *r.sample(range(2 + 100 * (g // 8), 100 * (g // 8) + (24, 99)[g // 16]), 12)} for g in range(32)}
    n = lambda node: 100 + node % 40
    low = np.floor(np.log([n(node) for node in range(400)]) / np.log(near_dedup.CLASS_STEP))
    upper = max(low)
    rows = [(g, node, node, n(node), bool(low[node] == upper), len(nodes), min(nodes))
            for g, nodes in groups.items() for node in nodes if low[node] >= upper - 1]
    given = spark.createDataFrame(rows, "g long, node long, class long, n int, own boolean, size long, lead long")
    got = near_dedup.merged(given).collect()

    def pairs(rows):
        found = {}
        for x in rows:
            found.setdefault(x[0], []).append((x[1], x[4]))
        return [{(a, b) for a, own in m for b, other in m if a < b and (own or other)} for m in found.values()]
    before, after = pairs(rows), pairs([(x.g, x.node, 0, 0, x.own) for x in got])
    assert set().union(*before) <= set().union(*after)
    assert len(after) < len(before) and len(got) < len(rows)
    assert sum(map(len, after)) < sum(map(len, before))
    assert len({(x.g, x.node) for x in got}) == len(got)


def test_near_dedup_moves_neither_words_nor_kept_texts(spark, monkeypatch):
    """The words of all rows are not stored or dealt by copy, only those of aligned
    texts; of the documents only those are looked up that may go."""
    stored, found = {}, {}

    def watched(make):
        def made(df, name):
            out = make(df, name)
            stored.setdefault(name, []).append((out.columns, out.count()))
            if name == "omh_open_ids":
                found["ids"] = sorted(r.id for r in out.collect())
            return out
        return made
    for name in ("materialize", "bucketed"):
        monkeypatch.setattr(near_dedup, name, watched(getattr(near_dedup, name)))
    near = edge.prose(60, 900)
    rows = [(i, edge.prose(60, 700 + i), "en", "s", 0) for i in range(100)]
    rows += [(200, near, "en", "s", 0), (201, near + " end", "en", "s", 0), (202, near, "en", "s", 0), (5, rows[5][1], "en", "s", 0)]
    kept = near_dedup.keep_first(edge.frame(spark, rows))
    assert sorted(r.doc_id for r in kept.collect()) == [*range(100), 200]
    assert "words" not in stored["omh_sketches"][0][0]
    assert all(n <= 4 for _, n in stored["omh_words"])
    assert found["ids"] == [5, 201, 202]


def test_near_dedup_aligns_a_pair_in_the_first_of_its_groups(monkeypatch):
    """Two unlike texts that pass the bounds of the words and meet in three groups; in
    the first both are guests."""
    aligned, similar = [], near_dedup.similar
    monkeypatch.setattr(near_dedup, "similar", lambda a, b: aligned.append(1) or similar(a, b))
    a = np.arange(100, dtype=np.uint32)
    b = np.concatenate([a[:60], a[60:][::-1]])
    pair = [near_dedup.histogram(x) for x in (a, b)]
    found = {}
    for g, own in ((2, False), (6, True), (10, True)):
        before = len(aligned)
        near_dedup.tied(g, [(k, k, 100, own, 0, pair[k], (a, b)[k].tobytes(), [2, 7, 11]) for k in (0, 1)])
        found[g] = len(aligned) - before
    assert found == {2: 0, 6: 1, 10: 0}


def test_near_dedup_word_pairs_rule_out_only_unlike_texts():
    r = random.Random(8)
    for n in (1, 2, 30, 200):
        a = np.array([r.randint(0, 30) for _ in range(n)], np.uint32)
        b = a.copy()
        for k in r.sample(range(n), n // 5):
            b[k] = 1000 + k
        bins = near_dedup.pair_bins([a, b])
        assert np.abs(bins[0] - bins[1]).sum() <= 4 * (n // 5)


@pytest.mark.parametrize("shared,own_only", [(0, False), (90, False), (150, False), (90, True)])
def test_near_dedup_recall_beside_a_common_passage(spark, shared, own_only):
    """Pairs of similarity 0.80 to 0.85 whose texts hold a passage that hundreds
    of others hold, too; the edits are anywhere, or in the rest alone."""
    r = random.Random(21)
    passage = edge.prose(150, 4000).split()[:shared]
    rows, n = [], 60
    for i in range(n):
        w = edge.prose(300 - shared, 5000 + i).split()
        rows.append((i, " ".join(w + passage), "en", "s", 0))
        edited = w + passage
        for k in r.sample(range(len(w) if own_only else 300), r.randint(45, 58)):
            edited[k] = f"edit{r.randint(0, 9999)}"
        rows.append((1000 + i, " ".join(edited), "en", "s", 0))
    for i in range(300):
        rows.append((2000 + i, " ".join(edge.prose(200 + i % 90, 7000 + i).split() + passage), "en", "s", 0))
    got = {x.doc_id: x.class_id for x in near_dedup.near_dedup(edge.frame(spark, rows)).collect()}
    assert sum(got[1000 + i] == i for i in range(n)) >= 0.98 * n
    assert all(got[2000 + i] == 2000 + i for i in range(300))


def test_near_dedup_texts_of_one_word_take_few_jobs(spark):
    """2,000 texts of one repeated word, each similar to the next: one class."""
    rows = [(i, "w " * (5 + i), "en", "s", 0) for i in range(2000)]
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("one-word", "")
    got = {x.doc_id: x.class_id for x in near_dedup.near_dedup(edge.frame(spark, rows)).collect()}
    spark.sparkContext.setJobGroup("", "")
    # 5 to 6, 6 to 7, ... words: 5/6 and all later ratios are 0.8 or more.
    assert set(got.values()) == {0}
    assert len(tracker.getJobIdsForGroup("one-word")) < 500


def test_near_dedup_one_id_with_several_texts(spark):
    a, b = edge.prose(60, 1), edge.prose(60, 2)
    rows = [(1, a, "en", "s", 0), (1, b, "en", "s", 0), (2, b + " end", "en", "s", 0), (3, a + " end", "en", "s", 0),
            (4, edge.prose(60, 3), "en", "s", 0), (4, edge.prose(60, 3) + " end", "en", "s", 0)]
    got = sorted((x.doc_id, x.class_id) for x in near_dedup.near_dedup(edge.frame(spark, rows)).collect())
    assert got == [(1, 1), (1, 1), (2, 1), (3, 1), (4, 4), (4, 4)]
    kept = [(r.doc_id, r.text) for r in near_dedup.keep_first(edge.frame(spark, rows)).collect()]
    assert sorted(i for i, _ in kept) == [1, 1, 4] and {t for i, t in kept if i == 1} == {a, b}


def test_near_dedup_keeps_one_row_with_its_columns(spark):
    kept = near_dedup.keep_first(edge.frame(spark, clash=True))
    rows = kept.collect()
    assert set(kept.columns) >= set(edge.CLASHING) and "doc_id" in kept.columns
    classes = {r.class_id for r in near_dedup.near_dedup(edge.frame(spark)).collect()}
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == sorted((c < 0, max(c, 0)) for c in classes)


def stripped(docs):
    least = {}
    key = lambda i: (i is None, i or 0)
    for i, t, *_ in sorted(docs, key=lambda d: key(d[0])):
        w = edge.words(t)
        for k in range(len(w) - 12):
            least.setdefault(tuple(w[k:k + 13]), key(i))
    out = []
    for i, t, *_ in docs:
        w = edge.words(t)
        gone = set()
        for k in range(len(w) - 12):
            if least[tuple(w[k:k + 13])] < key(i):
                gone.update(range(k, k + 13))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((*key(i), len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def test_substring_dedup(spark, docs):
    rows = substring_dedup.substring_dedup(edge.frame(spark, docs, clash=True)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_removed, r.kept_sha256) for r in rows) == stripped(docs)


def test_substring_dedup_of_random_overlaps(spark):
    r = random.Random(3)
    pool = [edge.prose(r.randint(5, 30), 40 + k) for k in range(25)]
    docs = [(r.randint(0, 200), " ".join(r.choices(pool, k=r.randint(1, 6))), "en", "s", 0) for _ in range(300)]
    rows = substring_dedup.substring_dedup(edge.frame(spark, docs).repartition(6)).collect()
    assert sorted((False, x.doc_id, x.n_words, x.n_removed, x.kept_sha256) for x in rows) == stripped(docs)


def test_windows_with_equal_hashes_are_told_apart(monkeypatch):
    """With a useless window hash the byte comparison still counts exactly."""
    docs = [(k, edge.prose(40, k % 3), "", "", 0) for k in range(6)]
    ids = np.array([d[0] for d in docs])
    rows = []
    for k in range(0, 6, 2):
        texts = [tokens.normal(d[1]) for d in docs[k:k + 2]]
        unit = substring_dedup.pack_unit(texts, ids[k:k + 2], ids[k:k + 2], 1, np.zeros(0, np.uint64))
        rows += [r[3] for r in unit if r[0] >= 0]
    want = sorted(substring_dedup.removed_in_bucket(rows))
    assert want
    real = substring_dedup.rolling
    monkeypatch.setattr(substring_dedup, "rolling", lambda h, k: real(h, k) % np.uint64(3) if k == 13 else real(h, k))
    assert sorted(substring_dedup.removed_in_bucket(rows)) == want


def smith_waterman(a, b):
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b, 1):
            new.append(max(0, row[j - 1] + (2 if x == y else -1), row[j] - 1, new[j - 1] - 1))
        best, row = max(best, *new), new
    return best


def test_local_alignment():
    r = random.Random(8)
    for _ in range(400):
        a, b = ([r.randint(0, 4) for _ in range(r.randint(1, 15))] for _ in range(2))
        score, end = decontamination.local_alignment(np.array(a), np.array(b))
        assert score == smith_waterman(a, b) and (score == 0 or b[end - 1] in a)


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string").withColumns(
        {c: F.lit("x") for c in ("item", "words", "grams", "id", "gram", "n")})


def test_decontamination_finds_exact_and_edited_copies(spark):
    r = random.Random(6)
    items = [(i, edge.prose(30, 900 + i)) for i in range(8)] + [(100, None), (101, "three short words"), (0, edge.prose(30, 900))]
    docs, want = [(500, None, "", "", 0), (501, "", "", "", 0)], set()
    for i in range(8):
        w = items[i][1].split()
        docs.append((i, f"{edge.prose(50, i)} {' '.join(w)} {edge.prose(400, 70 + i)}", "en", "s", 0))
        for k in (3, 11, 19, 25):
            w[k] = "other"
        w.insert(8, "added")
        docs.append((10 + i, f"{edge.prose(3, i)} {' '.join(w)}", "en", "s", 0))
        docs.append((20 + i, edge.prose(300, 200 + i), "en", "s", 0))
        docs.append((30 + i, f"{' '.join(w[:6])} {edge.prose(300, 300 + i)}", "en", "s", 0))
        want |= {(i, i), (10 + i, i)}
    docs += [docs[2], (None, docs[2][1], "en", "s", 0)]
    r.shuffle(docs)
    table = edge.frame(spark, docs, clash=True)
    found = decontamination.contaminated(table, bench(spark, items)).collect()
    assert {(x.doc_id, x.item_id) for x in found if x.doc_id >= 0} == want and len(found) == len(want) + 1
    whole = {x.doc_id: x for x in found}
    assert whole[0].score == 1 and (whole[0].start, whole[0].end) == (50, 80)
    assert 0.5 < whole[10].score < 1
    clean = decontamination.decontaminate(table, bench(spark, items))
    assert {x.doc_id for x in clean.collect()} == {500, 501, *range(20, 28), *range(30, 38)}
    assert clean.columns == table.columns


def test_decontamination_against_all_pairs(spark):
    docs = given(spark)
    items = [tuple(r) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").select("item_id", "text").collect()]
    want = set()
    for d in docs:
        w = edge.words(d[1])
        grams = set(zip(*[w[k:] for k in range(4)]))
        for i, t in items:
            v = edge.words(t)
            if grams & set(zip(*[v[k:] for k in range(4)])) and smith_waterman(v, w) >= min(len(v), 26):
                want.add((d[0], i))
    found = decontamination.contaminated(edge.frame(spark, docs), bench(spark, items))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == want and want


def test_decontamination_of_a_hot_partial_passage(spark):
    """Part of an item in many documents is found in each of them, also where
    its grams are far more frequent than the rest of the item's."""
    item = edge.prose(60, 950).split()
    docs = [(0, f"{edge.prose(40, 1)} {' '.join(item)} {edge.prose(40, 2)}", "en", "s", 0), (99, edge.prose(90, 3), "en", "s", 0)]
    docs += [(i, f"{edge.prose(30, 10 + i)} {' '.join(item[20:45])} {edge.prose(30, 80 + i)}", "en", "s", 0) for i in range(1, 31)]
    found = decontamination.contaminated(edge.frame(spark, docs), bench(spark, [(7, " ".join(item))]))
    assert {(x.doc_id, x.item_id) for x in found.collect()} == {(i, 7) for i in range(31)}


def test_lm_scores(spark, docs):
    r = random.Random(2)
    labels = [(d[0], r.choice([0, 1, 1, None])) for d in docs] + [(99_999, 1), (docs[0][0], 1), (None, 1)]
    good = {i for i, q in labels if q == 1 and i is not None}
    corpora = [[edge.words(d[1]) for d in docs if d[0] in good], [edge.words(d[1]) for d in docs]]
    counts = []
    for corpus in corpora:
        one, two = collections.Counter(), collections.Counter()
        for w in corpus:
            s = ["\0", *w, "\0"]
            one.update(s[1:])
            two.update(zip(s, s[1:]))
        counts.append((one, two, sum(one.values())))
    size = len(counts[1][0]) + 1

    def loss(model, a, b):
        one, two, n = model
        return -math.log((two[a, b] + lm_scoring.MU * (one[b] + 1) / (n + size)) / (one[a] + lm_scoring.MU))

    table = edge.frame(spark, docs, clash=True).repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int").withColumn("id", F.lit("x"))
    rows = lm_scoring.lm_scores(table, marks).collect()
    got = collections.defaultdict(list)
    for x in rows:
        got[x.doc_id].append((x.n_tokens, x.score))
    assert len(rows) == len(docs)
    for d in docs:
        s = ["\0", *edge.words(d[1]), "\0"]
        score = sum(loss(counts[0], a, b) - loss(counts[1], a, b) for a, b in zip(s, s[1:])) / (len(s) - 1)
        assert any(n == len(s) - 1 and abs(v - score) < 1e-4 for n, v in got[d[0]])


def test_lm_scores_beyond_the_broadcast_words(spark, docs, monkeypatch):
    """Words outside the table that every task has keep their own counts."""
    monkeypatch.setattr(lm_scoring, "FREQUENT", 40)
    test_lm_scores(spark, docs)


def test_labeller_on_held_out_layouts(spark):
    model = html_extract.Labeller(html_extract.trained())
    pages = html_training.pages(300, 12345)
    found = model.label([blocks for blocks, _ in pages])
    wrong = sum(int((np.array(y) != g).sum()) for (_, y), g in zip(pages, found))
    assert wrong / sum(len(y) for _, y in pages) < 0.01


def test_labeller_gradients():
    rng = np.random.default_rng(1)
    weights = {k: rng.standard_normal(s) * 0.3 for k, s in html_extract.Labeller.SHAPES.items()}
    pages = html_training.pages(4, 3)
    model = html_extract.Labeller(weights)
    of = lambda: model.gradients([p[0] for p in pages], [p[1] for p in pages])
    grad, _ = of()
    slot = html_extract.path_slots(pages[0][0][0].path, pages[0][0][0].linked)[0]
    for name, at in (("back", (1, 2, 5)), ("word", (html_extract.WORD_SIZE + 1, 7)), ("out", (3,)), ("path", (slot, 20))):
        weights[name][at] += 1e-3
        high = of()[1]
        weights[name][at] -= 2e-3
        low = of()[1]
        weights[name][at] += 1e-3
        assert abs((high - low) / 2e-3 - grad[name][at]) < 1e-4


def test_blocks_of_html():
    page = ('<!doctype html><html><head><title>T &amp; t</title><style>p{}</style><script>var t="</p>";</script></head><body>'
            '<!-- x <p>no</p> --><p>One &eacute;<b>two</b> \n three<br>four<p>Next<ul><li>a<li>b <a href="x>y">link</a></ul>'
            '<div class="SiteMenu main-nav" id=top>tail < 3 &lt;b&gt; &am</div><p>cut <b')
    assert [b.text for b in blocks_of(page)] == ["T & t", "One étwo three four", "Next", "a", "b link", "tail < 3 <b> &am", "cut"]
    assert blocks_of(page)[5].path == ("html", "body", "div site menu main nav top")
    assert blocks_of(None) == blocks_of("") == blocks_of(" <p> </p>") == []
    assert len(blocks_of("<p>x" * 50_000)) == 50_000 and len(blocks_of('<p class="' * 2000)) <= 1


PARTS = [("<h1>Some title</h1>", ["Some title"]), ("<p>First &amp; foremost,\n it goes.</p>", ["First & foremost, it goes."]),
         ("<ul><li>one thing</li><li>other thing</li></ul>", ["one thing", "other thing"]),
         ("<p>More of <a href='/x'>the story</a> is here, and it ends.</p>", ["More of the story is here, and it ends."])]
NOISE = ['<nav><ul><li><a href="/a">Start</a></li><li><a href="/b">News</a></li></ul></nav>',
         '<aside class="sidebar"><h3>Read also</h3><p>Another long story that is not this one, at all.</p></aside>',
         '<div class="cookie-notice"><p>This place keeps cookies on you, do you agree?</p><button>Yes</button></div>',
         '<div class="ad">Buy the thing that you never knew of.</div>',
         '<form class="newsletter"><label>Your address</label><input><button>Send</button></form>',
         '<section class="comments"><h2>Replies</h2><div class="comment"><p>I do not agree with a word of it.</p></div></section>',
         '<footer>&copy; somebody &middot; some place.</footer>', '<header class="site-header"><p>The daily paper</p></header>']


def test_extraction(spark):
    rows, want = [], {}
    for i, noise in enumerate(NOISE):
        for j, (top, end) in enumerate((("<article>", "</article>"), ('<div class="post-content">', "</div>"))):
            key = 10 * i + j
            rows.append((key, f"u{key}", f"<html><body>{NOISE[0]}{top}{''.join(p for p, _ in PARTS)}{end}{noise}</body></html>"))
            want[key] = "\n\n".join(t for _, ts in PARTS for t in ts)
    rows += [(500, None, None), (501, "u", ""), (502, "u", " "), rows[0], (None, "u", rows[0][2])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(
        {c: F.lit("x") for c in ("text", "n_chars", "path")})
    got = html_extract.extract(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.text == want.get(r.page_id, "" if r.page_id else want[0]) and r.n_chars == len(r.text)


def test_extraction_of_the_given_pages(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF001}/pages.parquet").collect()}
    for r in html_extract.extract(spark.read.parquet(f"{SF001}/pages.parquet")).collect():
        body = pages[r.page_id].split("<article>")[1].split("</article>")[0]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in re.split(r"</?(?:p|h1|br)>", body)]
        assert r.text == "\n\n".join(p for p in parts if p)


@pytest.mark.parametrize("op", [near_dedup.near_dedup, near_dedup.keep_first, substring_dedup.substring_dedup])
def test_empty_documents(spark, op):
    assert op(edge.frame(spark, [])).collect() == []


def test_empty_companions(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contaminated(edge.frame(spark), none).collect() == []
    assert decontamination.contaminated(edge.frame(spark, []), bench(spark, [(1, edge.prose(20, 1))])).collect() == []
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert lm_scoring.lm_scores(edge.frame(spark, []), labels).collect() == []
    assert lm_scoring.lm_scores(edge.frame(spark), labels).count() == len(edge.documents())
    assert html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []

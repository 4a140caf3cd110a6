"""Prefix trie, structure repair and vector near-duplicates against brute force."""

import functools
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelstack.llm import embedding_dedup as ed, prefix_trie as pt, queries, structure_repair as sr
from reelstack.llm.radix_tree import RadixTree
from tests.conftest import SF001
from tests.llm.edge import CLASHING

CONV = "conv_id long, turn long, role string, text string"
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


def conversations():
    r = random.Random(4)
    out = []
    for c in [*range(0, 12), *range(100, 140), 205, 299, 301, -7, -100]:
        for t in range(r.randint(1, 7)):
            out.append((c, t, "user" if t % 2 == 0 else "assistant", f"t{r.randint(0, 2)} says this."))
    out += [(300, None, None, None), (300, None, "user", "é😀 x?"), (300, 4, "system", ""), (300, 4, "user", " \t\n"),
            (302, 0, "user", "w " * 30_000 + "."), (302, 1, "", "no stop"), (302, 1, "tool", "No!"),
            (303, 9, "system", "S."), (303, 2, "system", "T."), (None, 1, "user", "lost")]
    out += [(310, 0, "user", "again."), (310, 0, "user", "again."), (310, 1, "assistant", "ok.")]
    out += [(320, t, r.choice(["user", "assistant", "assistant", "system"]), f"x {t}" + r.choice([".", "", "!"])) for t in range(150)]
    return out


def conv_frame(spark, rows=None):
    return spark.createDataFrame(conversations() if rows is None else rows, CONV)


def clashing(df):
    return df.withColumns({c: F.lit("x") for c in CLASHING + ("names", "sizes", "least", "gone", "above", "node", "block")
                           if c not in df.columns})


# ------------------------------------------------------------------ the trie


def brute_trie(rows):
    name = lambda role, text: hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
    convs = {}
    for c, t, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, name(role or "", text or ""), role or "", text or ""))
    convs = {c: [x[3:] for x in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        built[c] = tuple(convs.get(base, [])[:h] + own[h:])
    members = {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    sums = {}
    for p in sorted(members, key=len, reverse=True):
        saved = (len(members[p]) - 1) * (len(p[-1][1]) if p else 0) + sum(sums[k][1] for k in kids.get(p, []))
        sums[p] = (sum(sums[k][0] for k in kids[p]) if p in kids else 1, saved)
    return {(min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, [])), *sums[p],
             sha(",".join(str(c) for c in sorted(m) if len(built[c]) == len(p)))) for p, m in members.items()}


TRIE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def run_trie(df):
    got = [tuple(r[c] for c in TRIE) for r in pt.prefix_trie(pt.rebuilt(pt.sequences(df))).collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_trie_matches_brute_force(spark, monkeypatch):
    rows = conversations()
    want = brute_trie(rows)
    assert run_trie(conv_frame(spark)) == want
    assert run_trie(clashing(conv_frame(spark).repartition(5))) == want
    assert run_trie(conv_frame(spark, [])) == set()


def test_trie_of_many_small_trees_and_one_hot_conversation(spark, monkeypatch):
    """Trees read off after a few keys, ids digested in small chunks, and two
    thirds of all conversations alike."""
    rows = conversations()
    rows += [(c, t, "user", f"same {t}") for c in range(1000, 1600) for t in range(3) if c % 100]
    monkeypatch.setattr(pt, "TREE_BYTES", 600)
    monkeypatch.setattr(pt, "CHUNK", 50)
    assert run_trie(conv_frame(spark, rows).repartition(7)) == brute_trie(rows)


def test_turnless_conversations_end_at_the_root(spark):
    rows = [(c, 0, "user", "x") for c in range(1, 60)]  # no conversation 0
    assert run_trie(conv_frame(spark, rows)) == brute_trie(rows)


def test_radix_tree_grows_through_its_layouts():
    tree, r = RadixTree(), random.Random(1)
    keys = [bytes([b]) + bytes(r.choices(range(3), k=r.randint(0, 40))) for b in range(256) for _ in range(3)] + [b""]
    seen_kinds = set()
    for i, k in enumerate(keys):
        tree.insert(k, i, k)
        seen_kinds.add((type(tree.root.table).__name__, getattr(tree.root.table, "room", 0)))
    assert seen_kinds >= {("Sorted", 4), ("Sorted", 16), ("Indexed", 0), ("Whole", 0)}
    nodes = list(tree.walk())
    for node, _ in nodes:
        prefix = node.sample[:node.depth]
        inside = [i for i, k in enumerate(keys) if k.startswith(prefix)]
        assert (node.n, node.least) == (len(inside), min(inside))
    depths = {node.sample[:node.depth] for node, _ in nodes}
    assert set(keys) <= depths


# ---------------------------------------------------------------- the repair


def brute_repair(initials, must, cut):
    """(cost, audit) over all repairs: states of the grammar, from the end."""
    n = len(initials)

    @functools.lru_cache(None)
    def best(i, state, inserted):
        # state: start, s (only s so far), u, a
        found = []
        if i == n and state in ("start", "a"):
            found.append((0, ""))
        after = {"start": "u", "s": "u", "a": "u", "u": "a"}[state]
        if inserted < 3:
            c, w = best(i, after, inserted + 1)
            found.append((c + 3, "I" + w))
        if i < n:
            c, w = best(i + 1, state, 0)
            found.append((c + 4, "D" + w))
            if not must[i]:
                extra = 3 * cut[i]
                if initials[i] == after:
                    c, w = best(i + 1, after, 0)
                    found.append((c + extra, "K" + w))
                if initials[i] == "s" and state == "start":
                    c, w = best(i + 1, "s", 0)
                    found.append((c + extra, "K" + w))
                c, w = best(i + 1, after, 0)
                found.append((c + extra + 3, "R" + w))
        return min(found) if found else (10 ** 9, "")
    return best(0, "start", 0)


@pytest.mark.parametrize("seed", range(6))
def test_alignment_matches_all_repairs(seed):
    r = random.Random(seed)
    for _ in range(400):
        n = r.randint(0, 14)
        weights = r.choice([(1, 5, 5, 1), (3, 3, 3, 1), (0, 9, 1, 0), (1, 1, 1, 9)])
        initials = r.choices(["s", "u", "a", "t"], weights, k=n)
        must = [r.random() < 0.15 for _ in range(n)]
        cut = [not m and r.random() < r.choice([0.1, 0.6]) for m in must]
        assert sr.least_audit(initials, must, cut) == brute_repair(tuple(initials), tuple(must), tuple(cut)), (initials, must, cut)


@pytest.mark.parametrize("seed", range(4))
def test_shared_cells_give_the_same_audits(seed, monkeypatch):
    monkeypatch.setattr(sr, "CELLS", -1)
    test_alignment_matches_all_repairs(seed + 20)
    test_long_alignment_in_blocks()


def test_a_very_long_damaged_conversation():
    r = random.Random(2)
    initials = [r.choice("uast") if r.random() < 0.3 else "ua"[i % 2] for i in range(60_000)]
    must, cut = [r.random() < 0.1 for _ in initials], [r.random() < 0.1 for _ in initials]
    cut = [c and not m for c, m in zip(cut, must)]
    cost, audit = sr.least_audit(initials, must, cut)
    turns = [({"u": "user", "a": "assistant", "s": "system", "t": "tool"}[c], "x.") for c in initials]
    roles = "".join(t["role"][0] for t in sr.applied(turns, audit))
    assert roles.lstrip("s") == "ua" * (len(roles.lstrip("s")) // 2) and roles.count("s") <= 1
    left = [c for c, e in zip(cut, audit.replace("I", "")) if e != "D"]
    assert cost == 3 * (audit.count("R") + audit.count("I") + sum(left)) + 4 * audit.count("D")


def test_long_alignment_in_blocks():
    r = random.Random(9)
    initials = [r.choice("ua") if r.random() < 0.2 else "ua"[i % 2] for i in range(180)]
    must, cut = [r.random() < 0.05 for _ in initials], [r.random() < 0.1 for _ in initials]
    cut = [c and not m for c, m in zip(cut, must)]
    assert sr.least_audit(initials, must, cut) == brute_repair(tuple(initials), tuple(must), tuple(cut))
    turns = [("user" if i == "u" else "assistant", "t.") for i in initials]
    cost, audit = sr.least_audit(initials, must, cut)
    out = "".join(t["role"][0] for t in sr.applied(turns, audit))
    assert out == "ua" * (len(out) // 2)


def brute_conversations(rows):
    space = " \t\n\x0b\x0c\r"
    convs = {}
    for c, t, role, text in rows:
        kept = convs.setdefault(c, [])
        show = lambda v: " " if v is None else str(v)
        role, text = show(role), show(text)
        k = zlib.crc32(f"{show(c)}:{show(t)}".encode()) % 20
        if k == 0:
            continue
        text = "" if k == 1 else "".join(x for x in text if x not in ".!?") if k == 2 else text
        kept += [(t is not None, t or 0, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    out = set()
    for c, kept in convs.items():
        kept.sort()
        known = [x[1] for x in kept if x[0]]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        ini = [x[2][:1] for x in kept]
        faults = []
        for i, x in enumerate(kept):
            core = x[3].strip(space)
            faults.append("b" if not core else "d" if any(y[2:] == x[2:] for y in kept[:i]) else "t" if core[-1] not in ".!?" else "")
        cost, audit = brute_repair(tuple(ini), tuple(f in ("b", "d") for f in faults), tuple(f == "t" for f in faults))
        lines, at, m = [], 0, len(audit) - audit.count("D")
        for op in audit:
            if op == "D":
                at += 1
                continue
            left = m - len(lines)
            role = "user" if left % 2 == 0 else "assistant"
            if op == "I":
                lines.append(f"{role}:")
                continue
            lines.append(f"{kept[at][2] if op == 'K' else role}:{kept[at][3]}")
            at += 1
        out.add((c, gaps, *[faults.count(f) for f in "bdt"],
                 sum(a + b not in ("su", "ua", "au") for a, b in zip(ini, ini[1:])), cost, audit, sha("\n".join(lines))))
    return out


def run_repair(df):
    got = [tuple(r) for r in sr.digests(sr.repair(sr.damaged(df))).collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_repair_matches_brute_force(spark):
    rows = conversations()
    assert run_repair(conv_frame(spark)) == brute_conversations(rows)
    assert run_repair(clashing(conv_frame(spark).repartition(3))) == brute_conversations(rows)
    assert run_repair(conv_frame(spark, [])) == set()


def test_repair_returns_turns(spark):
    rows = [(1, 0, "assistant", "Hi."), (1, 1, "assistant", "Yes."), (1, 2, "assistant", "Yes.")]
    got = sr.repair(conv_frame(spark, rows)).first()
    assert (got.cost, got.audit, got.duplicate) == (7, "RKD", 1)
    assert [(t.role, t.text) for t in got.repaired] == [("user", "Hi."), ("assistant", "Yes.")]


# ---------------------------------------------------------------- the vectors


def brute_vectors(rows, threshold=ed.THRESHOLD):
    ok = lambda v: v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    n = len(rows)
    links = [set() for _ in rows]
    for i, (_, v, lab) in enumerate(rows):
        for j, (_, w, lab2) in enumerate(rows[:i]):
            if lab is not None and lab == lab2 and ok(v) and ok(w) and len(v) == len(w):
                a, b = np.asarray(v, np.float64), np.asarray(w, np.float64)
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                    links[i].add(j)
                    links[j].add(i)
    out, done = [None] * n, set()
    for i in range(n):
        if i in done:
            continue
        group, todo = {i}, [i]
        while todo:
            for k in links[todo.pop()] - group:
                group.add(k)
                todo.append(k)
        done |= group
        ids = [rows[k][0] for k in group if rows[k][0] is not None]
        least = min(ids) if ids else None
        for k in group:
            out[k] = (rows[k][0], len(links[k]), least, least is not None and rows[k][0] == least)
    return sorted(out, key=repr)


def vectors(dim=24, n=500, seed=2):
    r = np.random.default_rng(seed)
    rows, basis = [], r.normal(size=(30, dim))
    for i in range(n):
        noise = r.choice([0.0, 0.02, 0.08, 0.13, 0.16, 1.0])
        v = basis[r.integers(0, 30)] / np.sqrt(dim) * 5 + r.normal(size=dim) * noise
        rows.append((i, [float(np.float32(x)) for x in v], int(r.integers(0, 3))))
    return rows


def run_vectors(spark, rows, type_="float", label="int", clash=False):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{type_}>, label {label}")
    if clash:
        df = clashing(df)
    return sorted([tuple(r) for r in ed.embedding_dedup(df).select("vec_id", "n_links", "component_id", "kept").collect()], key=repr)


EDGE = [(900, None, 1), (901, [], 1), (902, [0.0, 0.0], 1), (903, [1.0, None], 1), (904, [float("nan"), 1.0], 1),
        (905, [float("inf"), 1.0], 1), (906, [1.0, 2.0], None), (907, [1.0, 2.0], 1), (907, [1.0, 2.0], 1), (908, [2.0, 4.0], 1),
        (None, [1.0, 2.0], 1), (None, [-5.0, 1.0], 1), (None, [-5.0, 1.0], 1), (909, [1e30, 2e30], 2), (910, [1e-30, 2e-30], 2),
        (911, [1.0, 2.0, 3.0], 1), (3, [-1.0, -2.0], 1)]


@pytest.mark.parametrize("tile,block", [(256, 4 << 20), (16, 4 << 10)])
def test_vectors_match_brute_force(spark, monkeypatch, tile, block):
    monkeypatch.setattr(ed, "TILE", tile)
    monkeypatch.setattr(ed, "BLOCK_BYTES", block)
    rows = vectors() + EDGE
    assert run_vectors(spark, rows, clash=tile == 16) == brute_vectors(rows)


def test_vectors_of_doubles_text_labels_and_without_a_frame(spark, monkeypatch):
    monkeypatch.setattr(ed, "FRAMES", 1)
    rows = [(i, v, f"l{lab}") for i, v, lab in vectors(n=150) + vectors(dim=5, n=60, seed=5)]
    assert run_vectors(spark, rows, "double", "string") == brute_vectors(rows)


def test_vectors_edge_tables(spark):
    assert run_vectors(spark, []) == []
    assert run_vectors(spark, EDGE[:7]) == brute_vectors(EDGE[:7])


def test_a_hot_group_of_near_copies_is_counted_without_pairs(monkeypatch):
    """Tiles that lie inside the reach of one another are never multiplied."""
    r = np.random.default_rng(3)
    x = np.concatenate([r.normal(size=24) + r.normal(size=(3000, 24)) * 1e-3, r.normal(size=(50, 24))])
    frame = np.eye(24, ed.LEAD)
    monkeypatch.setattr(ed, "linked", lambda *a: pytest.fail("a tile was multiplied"))
    tiles = ed.Tiles(x[:3000].tobytes(), 24, 0, "<f8", frame)
    nodes, links, root = ed.compare(tiles, tiles, 0.98)
    assert len(nodes) == 3000 and set(links) == {2999} and set(root) == {0}


def test_two_thirds_of_the_rows_near_copies(spark, monkeypatch):
    monkeypatch.setattr(ed, "TILE", 32)
    monkeypatch.setattr(ed, "BLOCK_BYTES", 8 << 10)
    r = np.random.default_rng(7)
    hot = r.normal(size=16)
    rows = [(i, [float(np.float32(x)) for x in (hot + r.normal(size=16) * 0.05 if i % 3 else r.normal(size=16))], 1)
            for i in range(450)]
    assert run_vectors(spark, rows) == brute_vectors(rows)


def test_pairs_grow_with_rows_not_with_their_square():
    """What a pair of blocks gives is at most a row per vector."""
    x = np.ones((700, 8)) + np.random.default_rng(1).normal(size=(700, 8)) * 0.03
    tiles = ed.Tiles(x.tobytes(), 8, 5, "<f8", np.eye(8))
    nodes, links, _ = ed.compare(tiles, tiles, 0.98)
    assert len(nodes) == len(set(nodes)) <= 700 and links.max() <= 699


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op12_structure_repair", "op13_embedding_dedup"])
def test_queries_on_given_tables(spark, name):
    conv = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.QUERIES[name](spark, SF001)
    if name == "op11_prefix_trie":
        assert {tuple(r[c] for c in TRIE) for r in got.collect()} == brute_trie(conv)
    elif name == "op12_structure_repair":
        assert {tuple(r) for r in got.collect()} == brute_conversations(conv)
    else:
        rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
        assert sorted([tuple(r) for r in got.collect()], key=repr) == brute_vectors(rows)

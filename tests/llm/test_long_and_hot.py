"""Very long texts, very many matches, phrases that everybody uses."""

import random

from pyspark.sql import functions as F

from reelstack.llm import chat_format, common, decontamination, secret_scans, substring_dedup
from tests.llm import edge
from tests.llm.test_native_ops import secrets
from tests.llm.test_text_ops import smith_waterman

CONV = "conv_id long, turn long, role string, text string"


def test_running_before(spark):
    r = random.Random(1)
    arrays = [[r.randint(-5, 9) for _ in range(n)] for n in (0, 1, 2, 63, 64, 65, 127, 128, 129, 1000, 5000)]
    df = spark.createDataFrame([(a,) for a in [*arrays, None]], "v array<int>")
    got = df.select("v", common.running_before(F.col("v"), lambda a, b: a + b, F.lit(0)).alias("sums"),
                    common.running_before(F.col("v"), F.greatest, F.lit(0)).alias("most")).collect()
    for row in got:
        if row.v is None:
            continue
        assert row.sums == [sum(row.v[:i]) for i in range(len(row.v))]
        assert row.most == [max([0, *row.v[:i]]) for i in range(len(row.v))]


def test_very_many_secrets_in_one_text(spark):
    r = random.Random(3)
    text = " ".join(r.choice(["token=" + "a" * r.randint(3, 9), "AKIA" + "Z9" * r.randint(7, 11), "ab" * r.randint(9, 15), "é\n"])
                    for _ in range(12_000))
    rows = [(1, text, "en", "s", 0), (2, text, "en", "s", 0), (3, "x" * 3_000_000 + " token=abcdefgh", "en", "s", 0)]
    got = {x.doc_id: x.spans for x in secret_scans.secret_scans(edge.frame(spark, rows)).collect()}
    assert got[1] == secrets(text) and got[2] == got[1] and got[3] == "assign:3000001:3000015"
    clean = {x.doc_id: x.text for x in secret_scans.redact(edge.frame(spark, rows)).collect()}
    spans, out, at = [s.split(":") for s in got[1].split(",")], [], 0
    for kind, a, b in spans:
        if int(a) >= at:
            out += [text[at:int(a)], f"[{kind}]"]
        at = max(at, int(b))
    assert clean[1] == "".join(out) + text[at:] and clean[3] == "x" * 3_000_000 + " [assign]"


def test_chat_texts_beyond_the_json_reader(spark):
    """A text of 21 million characters is a turn like any other."""
    rows = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "a"), (2, 0, "user", "only")], CONV)
    long = F.when(F.col("conv_id") == 2, F.repeat(F.lit("z</s>"), 4_200_000)).otherwise(F.col("text"))
    formatted = chat_format.chat_format(rows.withColumn("text", long))
    got = {r.conv_id: r for r in chat_format.digests(formatted).collect()}
    assert got[2].n_turns == 1 and got[1].n_turns == 2 and got[1].loss_chars == 1
    assert got[2].formatted_chars == len("<s>[INST]user[/INST]</s>") + 4_200_000 * 6


def test_chat_very_many_turns(spark):
    rows = spark.range(9000).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(
        F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("t"), "id").alias("text"))
    back = chat_format.read_back(chat_format.chat_format(rows)).first()
    assert [t.text for t in back.turns] == [f"t{i}" for i in range(9000)]
    assert back.loss_texts == [f"t{i}" for i in range(1, 9000, 2)]


def test_chat_records_without_turns_keep_their_conversation(spark):
    records = [(1, 0, '{"unknown":1}'), (2, 0, "no json"), (2, 1, '{"prompt":"p","completion":"c"}'), (3, 0, None)]
    rows = chat_format.chat_format(spark.createDataFrame(records, "conv_id long, turn long, record string"))
    got = {r.conv_id: (r.n_turns, r.formatted_chars) for r in chat_format.digests(rows).collect()}
    assert got[1] == (0, 0) and got[3] == (0, 0) and got[2][0] == 2


def test_chat_columns_of_another_layout(spark):
    rows = spark.createDataFrame([("p", None)], "prompt string, completion string")
    got = chat_format.canonical_columns(rows, ["prompt", "completion"]).first()
    assert [tuple(t) for t in got.turns] == [("user", "p"), ("assistant", "")]
    as_json = chat_format.canonical_turns(spark.createDataFrame([('{"prompt":"p","completion":"c"}',)], "record string")).first()
    assert got.fingerprint == as_json.fingerprint


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def found(spark, docs, items):
    rows = decontamination.contaminated(edge.frame(spark, docs), bench(spark, items)).collect()
    return {(r.doc_id, r.item_id) for r in rows}


def test_a_common_phrase_is_no_seed(spark, monkeypatch):
    """A phrase in all items and documents aligns nothing; copies beside it, edited
    and partial ones, are found as brute force over all pairs finds them."""
    r = random.Random(5)
    phrase = "which of the following is".split()
    items = [(i, " ".join(edge.prose(25, 100 + i).split() + phrase + edge.prose(8, 300 + i).split())) for i in range(40)]
    docs = [(i, f"{edge.prose(60, 900 + i).upper()} {' '.join(phrase)} {edge.prose(30, 1900 + i).upper()}", "en", "s", 0) for i in range(60)]
    for i in range(12):
        w = items[i][1].split()
        copy = w[:] if i < 4 else w[5:19] if i < 8 else [x for x in w if r.random() < 0.85]
        docs.append((100 + i, f"{edge.prose(40, 50 + i)} {' '.join(copy)} {edge.prose(20, 70 + i)}", "en", "s", 0))
    words = {d[0]: edge.words(d[1]) for d in docs}
    want = {(d, i) for d, w in words.items() for i, t in items
            if smith_waterman(edge.words(t), w) >= decontamination.least_score(len(edge.words(t)))}
    assert len(want) >= 10
    assert found(spark, docs, items) == want
    # Documents with the phrase alone are never aligned.
    monkeypatch.setattr(decontamination, "align_pair", refuse)
    assert found(spark, docs[:60], items) == set()


def refuse(*_):
    raise AssertionError("aligned")


def test_a_copied_run_counts_however_many_items_hold_it(spark):
    """13 words in a row that more items hold than a seed may name."""
    shared = edge.prose(13, 1).split()
    items = [(i, " ".join(edge.prose(20, 10 + i).split() + shared + edge.prose(20, 50 + i).split())) for i in range(20)]
    docs = [(1, f"{edge.prose(30, 200)} {' '.join(shared)} {edge.prose(30, 201)}", "en", "s", 0),
            (2, f"{edge.prose(30, 202)} {' '.join(shared[:12])} {edge.prose(30, 203)}", "en", "s", 0)]
    assert found(spark, docs, items) == {(1, i) for i in range(20)}


def test_short_items_must_be_copied(spark):
    items = [(4, "one two three four"), (5, "alpha beta gamma delta epsilon"), (10, edge.prose(10, 3)), (3, "too short item")]
    ten = edge.prose(10, 3).split()
    docs = [(1, "so one two three four it is", "en", "s", 0), (2, "alpha beta gamma delta and not more", "en", "s", 0),
            (3, "see alpha beta gamma delta epsilon here", "en", "s", 0), (4, " ".join(ten[:4]) + " x", "en", "s", 0),
            (5, "y " + " ".join(ten[1:9]), "en", "s", 0), (6, "too short item", "en", "s", 0)]
    assert found(spark, docs, items) == {(1, 4), (3, 5), (5, 10)}


def test_an_item_in_a_very_long_text(spark):
    item = edge.prose(40, 8)
    docs = [(1, edge.prose(150_000, 4) + " " + item, "en", "s", 0), (2, edge.prose(150_000, 5), "en", "s", 0)]
    assert found(spark, docs, [(7, item)]) == {(1, 7)}


def test_a_bucket_combines_what_has_arrived(spark, monkeypatch):
    """A passage in two thirds of all documents, packed in many units that meet
    in buckets which may hold next to nothing."""
    passage = edge.prose(80, 1).split()
    r = random.Random(4)
    rows = []
    for i in range(300):
        own = edge.prose(60, 100 + i).split()
        cut = r.randint(0, 30)
        rows.append((i, " ".join(own[:30] + (passage[cut:] if i % 3 else []) + own[30:]), "en", "s", 0))
    monkeypatch.setattr(substring_dedup, "UNIT_BYTES", 4000)
    want = {x.doc_id: tuple(x) for x in substring_dedup.substring_dedup(edge.frame(spark, rows)).collect()}
    monkeypatch.setattr(substring_dedup, "HELD_BYTES", 2000)
    called = substring_dedup.combined([next(p for b, _, _, p in substring_dedup.pack_unit(
        [rows[k][1].encode()], *substring_dedup.np.array([[k], [7]]), 1, substring_dedup.np.zeros(0, "u8"))) for k in (1, 2, 4)])
    assert sum(len(s) for _, _, s in called[1]) > 0
    got = {x.doc_id: tuple(x) for x in substring_dedup.substring_dedup(edge.frame(spark, rows)).collect()}
    assert got == want
    seen, removed = {}, 0
    for i, t, *_ in rows:
        w = t.split()
        gone = set()
        for k in range(len(w) - 12):
            if seen.setdefault(tuple(w[k:k + 13]), i) < i:
                gone |= set(range(k, k + 13))
        assert got[i][2] == len(gone)
        removed += len(gone)
    assert removed > 5000

"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Test items are cut into 4-word grams. One that at most ``RARE`` items hold is a
seed: each of its occurrences in a document names few items, however many
documents hold it. A common phrase (held by more items) is none, so it does not
align every document that uses it with every item. Where it is part of a longer copy,
the longer gram is a seed: the item's 8-word grams, where rare, and always
its grams of the run that is a verdict by itself (``run_of``). So a copied run of
that length is found whatever else holds it; an edited copy is found by any seed
that survives.

Two bitmaps of fixed size go to the executors, one of all 4-grams, one of the
seeds. Each text looks its own 4-grams up in the first and the seeds along runs of
hits in the second, so only texts with a possible seed leave the scan (with
their words packed to four bytes each). Their hits are joined to the seeds
exactly, and each (document, item) pair is aligned locally around its seeds'
diagonals, which scores edited and paraphrased copies too.

A pair counts as contaminated when its alignment reaches ``LEAST_SHARE`` of the
score of a whole copy, or the score of ``LEAST_RUN`` copied words; never below
that of ``SHORTEST`` words, so a common phrase does not condemn a document for a
short item: an item of fewer words must be copied whole.

Defined results: null text or an item of under four words has no seeds and
matches nothing; repeated rows and ids are one document (the best score of a
pair is reported); a null doc_id gets a negative stand-in made from its text;
empty tables give an empty result; extra columns are ignored or carried along.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reelstack.llm.common import only, with_row
from reelstack.llm.near_dedup import keyed, working_id
from reelstack.llm.tokens import U64, blocks, mix, normal, rolling, word_hashes
from reelstack.session import materialize

GRAM = 4
# Items that may hold a gram for it to be a seed by itself.
RARE = 8
LEAST_SHARE = 0.5
LEAST_RUN = 13
SHORTEST = 8
MATCH, MISMATCH, GAP = 2, -1, -1
# Bits of each lookup: 4 MB, whatever the benchmark's size.
BITS = 25
HIT = "array<struct<pos:int,gram:bigint>>"


def least_score(n: int) -> float:
    """Score at which an item of n words counts as copied."""
    wanted = min(LEAST_SHARE * MATCH * n, MATCH * LEAST_RUN)
    return min(max(wanted, MATCH * SHORTEST), MATCH * n)


def run_of(n: int) -> int:
    """Copied words in a row that reach that score by themselves."""
    return int(-(-least_score(n) // MATCH))


def grams_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n words; runs of another length hash otherwise."""
    return mix(rolling(hashes, n) + U64(n)).view(np.int64)


def item_batches(batches):
    """(item, text) to (item, words, grams): (length, hash, place, whether the
    gram is a seed however common)."""
    for batch in batches:
        words, grams = [], []
        for text in batch.column(1).to_pylist():
            h = word_hashes(normal(text))
            run = run_of(len(h))
            lengths = sorted({GRAM, SHORTEST, run}) if len(h) >= GRAM else []
            words.append((h >> U64(32)).astype(np.uint32).tobytes())
            grams.append([{"n": n, "gram": int(g), "ipos": i, "run": n == run}
                          for n in lengths if n <= len(h) for i, g in enumerate(grams_of(h, n))])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(words, pa.binary()),
             pa.array(grams, pa.list_(pa.struct([("n", pa.int32()), ("gram", pa.int64()), ("ipos", pa.int32()),
                                                 ("run", pa.bool_())])))], names=["item", "words", "grams"])


def bit_places(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two bits of the lookup per gram."""
    g = grams.view(U64)
    return (g >> U64(64 - BITS)).astype(np.int64), (g & U64((1 << BITS) - 1)).astype(np.int64)


def lookup_bitmap(grams: DataFrame) -> np.ndarray:
    """The bitmap, put together by an aggregation to at most 2**(BITS-6) words."""
    bits = F.array(F.shiftrightunsigned("gram", 64 - BITS), F.col("gram").bitwiseAND(F.lit((1 << BITS) - 1)))
    words = (grams.select(F.explode(bits).alias("b"))
             .groupBy(F.shiftright("b", 6).alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(b & 63 as int))")).alias("v")).toArrow())
    out = np.zeros(1 << (BITS - 6), np.int64)
    out[words.column("w").to_numpy()] = words.column("v").to_numpy()
    return out.view(U64)


def in_bitmap(hashes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which 64-bit hashes have both their bits in a bitmap of ``lookup_bitmap``."""
    one, two = bit_places(hashes)
    holds = lambda at: (table[at >> 6] >> (at & 63).astype(U64)) & U64(1)
    return (holds(one) & holds(two)).astype(bool)


def seeds_of(h: np.ndarray, gate: np.ndarray, seeds: np.ndarray, lengths: tuple) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of the possible seeds in a row of word hashes."""
    short = grams_of(h, GRAM)
    if not len(short):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    hit = in_bitmap(short, gate)
    # How many 4-grams in a row, from each place on, are hits.
    gaps = np.flatnonzero(np.concatenate([~hit, [True]]))
    row = gaps[np.searchsorted(gaps, np.arange(len(hit)))] - np.arange(len(hit))
    places, hashes = [], []
    for n in lengths:
        at = np.flatnonzero(row >= n - GRAM + 1)
        if not len(at):
            continue
        grams = short[at] if n == GRAM else grams_of_places(h, at, n)
        found = in_bitmap(grams, seeds)
        places.append(at[found])
        hashes.append(grams[found])
    return (np.concatenate(places), np.concatenate(hashes)) if places else (np.zeros(0, np.int64),) * 2


def grams_of_places(h: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """``grams_of`` at the given places alone."""
    acc = np.zeros(len(at), U64)
    with np.errstate(over="ignore"):
        for i in range(n):
            acc = mix(acc * U64(0x9E3779B97F4A7C15) + h[at + i])
        return mix(acc + U64(n)).view(np.int64)


def hit_batches(gate, seeds, lengths):
    """A function from (id, text) to (id, words, hits) of the texts with a
    possible seed."""
    def run(batches):
        for batch in batches:
            texts = [normal(t) for t in batch.column(1).to_pylist()]
            rows, words, hits = [], [], []
            for lo, hi in blocks([len(t) for t in texts]):
                h = word_hashes(b" ".join(t for t in texts[lo:hi] if t))
                counts = [t.count(b" ") + 1 if t else 0 for t in texts[lo:hi]]
                ends = np.cumsum(counts)
                # Texts without any 4-gram of an item are left at once.
                hit = np.flatnonzero(in_bitmap(grams_of(h, GRAM), gate.value))
                for k in np.unique(np.searchsorted(ends, hit, side="right")):
                    own = h[ends[k] - counts[k]:ends[k]]
                    at, grams = seeds_of(own, gate.value, seeds.value, lengths)
                    if len(at):
                        rows.append(lo + int(k))
                        words.append((own >> U64(32)).astype(np.uint32).tobytes())
                        hits.append([{"pos": int(p), "gram": int(g)} for p, g in zip(at, grams)])
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(rows, pa.int32())), pa.array(words, pa.binary()),
                pa.array(hits, pa.list_(pa.struct([("pos", pa.int32()), ("gram", pa.int64())])))],
                names=["id", "words", "hits"])
    return run


def local_alignment(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Best Smith-Waterman score and the end of its match in ``text``. One row
    of the table per word of ``item``, each row as whole-array operations."""
    place = np.arange(len(text) + 1, dtype=np.int64) * -GAP
    row = np.zeros(len(text) + 1, np.int64)
    best, end = 0, 0
    for word in item:
        step = np.where(text == word, MATCH, MISMATCH)
        new = np.maximum(row + GAP, 0)
        new[1:] = np.maximum(new[1:], row[:-1] + step)
        # A gap along the text: the best earlier cell less its distance.
        row = np.maximum.accumulate(new + place) - place
        at = int(row.argmax())
        if row[at] > best:
            best, end = int(row[at]), at
    return best, end


def align_pair(item: np.ndarray, text: np.ndarray, diagonals: list[int]) -> tuple[int, int, int]:
    """(score, start, end) of the best alignment near the diagonals."""
    slack = len(item) // 4 + 8
    spans: list[list[int]] = []
    for d in sorted(diagonals):
        lo, hi = max(0, d - slack), min(len(text), d + len(item) + slack)
        if spans and lo <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], hi)
        else:
            spans.append([lo, hi])
    best = (0, 0, 0)
    for lo, hi in spans:
        score, end = local_alignment(item, text[lo:hi])
        if score > best[0]:
            # The start is the end of the best alignment of the reversed texts.
            _, back = local_alignment(item[::-1], text[lo:lo + end][::-1])
            best = (score, lo + end - back, lo + end)
    return best


def align_batches(batches):
    for batch in batches:
        _, _, diagonals, text_words, item_words = (c.to_pylist() for c in batch.columns)
        keep, score, start, end = [], [], [], []
        for k, (ds, tw, iw) in enumerate(zip(diagonals, text_words, item_words)):
            item = np.frombuffer(iw, np.uint32)
            s, a, b = align_pair(item, np.frombuffer(tw, np.uint32), ds)
            if s >= least_score(len(item)):
                keep.append(k), score.append(s / (MATCH * len(item))), start.append(a), end.append(b)
        ids = batch.select([0, 1]).take(pa.array(keep, pa.int32()))
        yield pa.RecordBatch.from_arrays(
            [*ids.columns, pa.array(score, pa.float64()), pa.array(start, pa.int32()), pa.array(end, pa.int32())],
            names=["id", "item", "score", "start", "end"])


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(id, item, score, start, end) of contaminated pairs; ``docs`` has id and
    text, the span is in words of the text, the score 1 for a whole copy."""
    spark = docs.sparkSession
    items = only(benchmark, "item_id", "text")
    items = materialize(items.select(
        F.coalesce(F.col("item_id").cast("long"), F.xxhash64("text")).alias("item"), "text").mapInArrow(
        item_batches, "item long, words binary, grams array<struct<n:int,gram:bigint,ipos:int,run:boolean>>").distinct(),
        "bench_items")
    grams = items.select("item", F.inline("grams"))
    holders = grams.groupBy("gram").agg(F.count_distinct("item").alias("_c"))
    seeds = materialize(grams.join(holders, "gram").filter(F.col("run") | (F.col("_c") <= RARE)).select(
        "gram", "item", "ipos", "n"), "bench_seeds")
    lengths = tuple(sorted(r.n for r in seeds.select("n").distinct().collect()))  # at most LEAST_RUN
    share = spark.sparkContext.broadcast
    gate, wanted = share(lookup_bitmap(grams.filter(F.col("n") == GRAM))), share(lookup_bitmap(seeds))
    found = materialize(docs.select("id", "text").mapInArrow(
        hit_batches(gate, wanted, lengths), f"id long, words binary, hits {HIT}"), "bench_hits")
    hits = found.select("id", F.inline("hits"))
    pairs = (hits.join(seeds, "gram").groupBy("id", "item")
             .agg(F.collect_set(F.col("pos") - F.col("ipos")).alias("diagonals")))
    pairs = (pairs.join(found.select("id", "words"), "id")
             .join(items.select("item", F.col("words").alias("iwords")), "item")
             .select("id", "item", "diagonals", "words", "iwords"))
    scored = pairs.mapInArrow(align_batches, "id long, item long, score double, start int, end int")
    best = F.max(F.struct("score", "start", "end")).alias("b")
    return scored.groupBy("id", "item").agg(best).select("id", "item", "b.*")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per contaminated pair: doc_id, item_id, score, start and end."""
    return matches(keyed(only(docs, "doc_id", "text")), benchmark).withColumnsRenamed(
        {"id": "doc_id", "item": "item_id"})


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any contaminated pair, with their own columns."""
    bad = contaminated(docs, benchmark).select(F.col("doc_id").alias("bad")).distinct()
    rows = with_row(docs, "doc_id", "text").withColumn("id", working_id())
    return rows.join(bad, F.col("id") == F.col("bad"), "left_anti").select("row.*")

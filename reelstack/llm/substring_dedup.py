"""Substring dedup by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words. Its minimiser is the least hash among
its ``MINI``-word grams. Consecutive windows with the same minimiser travel
together as one packed string (a super-k-mer) to the minimiser's bucket, so equal
windows always meet in one bucket and each word is sent about three times, not
``WINDOW`` times. All strings of a batch for one bucket are one compressed row.
In the bucket the windows are sorted by a hash and equal neighbours compared byte
by byte, which counts them exactly: a window whose words also start in a document
with a smaller doc_id is removed with all words it covers.

Hot grams: the most frequent grams of a sample come last in the order, so they
are minimisers only where a window has nothing else. The order decides where a
window is counted, never its count.

Hot passages: within a batch equal super-k-mers are combined before they are
sent; only that of the smallest doc_id goes on, the others are known to be
removed and their spans pass through as such. So a passage that a third of all
documents hold arrives once per batch, and a bucket that outgrows ``HELD_BYTES``
combines what has arrived in the same way: it holds each super-k-mer of different
text once, however many documents and batches it comes from.

Defined results: null text has no words; texts under ``WINDOW`` words lose
nothing; repeated rows (same doc_id) are judged alike and do not remove each
other; a null doc_id counts as larger than any other; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, functions as F

from reelstack.llm.common import only
from reelstack.llm.decontamination import in_bitmap, lookup_bitmap
from reelstack.llm.tokens import U64, blocks, normal, rolling, seeded, mix, word_hashes, word_starts
from reelstack.session import materialize, shuffle_partitions

WINDOW = 13
MINI = 3
# Packed text that one bucket holds, and how often a word is sent, on average.
BUCKET_BYTES = 6 << 20
SENT = 3.0
# Text that is packed together: equal super-k-mers in it are combined.
UNIT_BYTES = 6 << 20
# Text of a bucket that is held before equal super-k-mers in it are combined.
HELD_BYTES = 32 << 20
# Buckets of one task, on average.
BUCKETS_PER_TASK = 8
# Frequent grams that come last in the order, and the share of documents that
# names them.
HOT = 1 << 14
SAMPLE = 64
NO_ID = np.iinfo(np.int64).max
PACKED = "bucket int, id long, print long, packed binary"


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    size, out = 1, x
    while size * 2 <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def gram_ranks(hashes: np.ndarray) -> np.ndarray:
    return mix(rolling(hashes, MINI) ^ seeded(1, 5)[0])


def is_in(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def super_kmers(hashes: np.ndarray, counts: np.ndarray, hot: np.ndarray):
    """Runs of windows that share a minimiser, for texts of ``counts`` words
    laid end to end: (text, first word in the block, windows, minimiser). Grams
    in ``hot`` come after all others in the order."""
    n = len(hashes) - WINDOW + 1
    ends = np.cumsum(counts)
    owner = np.repeat(np.arange(len(counts)), counts)
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none, none.view(U64)
    rank = gram_ranks(hashes)
    late = is_in(rank, hot)
    rank = (rank >> U64(1)) | (late.astype(U64) << U64(63))
    least = sliding_min(rank, WINDOW - MINI + 1)[:n]
    inside = np.arange(n) + WINDOW <= ends[owner[:n]]
    at = np.flatnonzero(inside)
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, none, none.view(U64)
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) > 1) | (least[at[1:]] != least[at[:-1]]) | (owner[at[1:]] != owner[at[:-1]])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(at)))
    start = at[first]
    return owner[start], start, size, least[start]


def pack_unit(texts: list[bytes], ids: np.ndarray, prints: np.ndarray, buckets: int, hot: np.ndarray):
    """Rows (bucket, id, print, packed) of some texts: one per bucket, then one
    per text with windows known to be removed (in buckets below zero)."""
    words: list[bytes] = []
    columns = []
    for lo, hi in blocks([len(t) for t in texts]):
        part = texts[lo:hi]
        buf = b" ".join(t for t in part if t)
        counts = np.array([t.count(b" ") + 1 if t else 0 for t in part])
        text, start, size, mini = super_kmers(word_hashes(buf), counts, hot)
        cuts, base = word_starts(buf), np.cumsum(counts) - counts
        words += [buf[a:b] for a, b in zip(cuts[start].tolist(), (cuts[start + size + WINDOW - 1] - 1).tolist())]
        columns.append(np.stack([text + lo, start - base[text], size, (mini % U64(buckets)).astype(np.int64)]))
    if not words:
        return
    text, first, size, bucket = np.concatenate(columns, axis=1)
    # Equal super-k-mers: only those of the least id go on.
    place: dict[bytes, int] = {}
    same = np.fromiter((place.setdefault(w, k) for k, w in enumerate(words)), np.int64, len(words))
    del place
    least = np.full(len(words), NO_ID)
    np.minimum.at(least, same, ids[text])
    known = ids[text] > least[same]
    sent = np.flatnonzero(~known)
    order = sent[np.argsort(bucket[sent], kind="stable")]
    for k in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
        yield int(bucket[k[0]]), None, None, pack(k, ids, prints, text, first, size, words)
    for i, p, spans in known_spans(np.flatnonzero(known), ids, prints, text, first, size):
        yield -1 - i % buckets, i, p, spans


def pack(k: np.ndarray, ids, prints, text, first, size, words) -> bytes:
    """Super-k-mers ``k`` as one compressed row: of each its text, first word in
    it, windows and words."""
    docs, index = np.unique(text[k], return_inverse=True)
    # Steps between texts and small numbers compress well.
    parts = [np.array([len(k), len(docs)], np.int64), ids[docs], prints[docs],
             np.diff(index, prepend=0).astype(np.int32), first[k].astype(np.int32), size[k].astype(np.int32)]
    return zstandard.ZstdCompressor(level=6).compress(
        b"".join([*[x.tobytes() for x in parts], b" ".join([words[j] for j in k.tolist()])]))


def known_spans(known: np.ndarray, ids, prints, text, first, size):
    """(id, print, spans) of super-k-mers whose windows are known to go."""
    known = known[np.argsort(text[known], kind="stable")]
    for k in np.split(known, np.flatnonzero(np.diff(text[known])) + 1) if len(known) else ():
        yield (int(ids[text[k[0]]]), int(prints[text[k[0]]]),
               np.stack([first[k], size[k]], axis=1).astype(np.int32).tobytes())


def combined(rows: list[bytes]) -> tuple[bytes, list[tuple]]:
    """Packed rows of one bucket as one: of equal super-k-mers only those of the
    least id stay, the spans of the others are known."""
    parts = [unpack(r) for r in rows]
    offset = np.cumsum([0] + [len(p[0]) for p in parts])
    ids, prints = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    text = np.concatenate([p[2] + offset[k] for k, p in enumerate(parts)])
    first, size = (np.concatenate([p[k] for p in parts]) for k in (3, 4))
    words: list[bytes] = []
    for p in parts:
        cuts = word_starts(p[5])
        ends = np.cumsum(p[4] + WINDOW - 1)
        starts = ends - (p[4] + WINDOW - 1)
        words += [p[5][a:b] for a, b in zip(cuts[starts].tolist(), (cuts[ends] - 1).tolist())]
    place: dict[bytes, int] = {}
    same = np.fromiter((place.setdefault(w, k) for k, w in enumerate(words)), np.int64, len(words))
    least = np.full(len(words), NO_ID)
    np.minimum.at(least, same, ids[text])
    known = ids[text] > least[same]
    kept = np.flatnonzero(~known)
    kept = kept[np.argsort(text[kept], kind="stable")]
    return (pack(kept, ids, prints, text, first, size, words),
            list(known_spans(np.flatnonzero(known), ids, prints, text, first, size)))


def unpack(packed: bytes):
    """(ids, prints, text index, first word, windows, words) of a packed row."""
    raw = zstandard.ZstdDecompressor().decompress(packed)
    n, docs = np.frombuffer(raw, np.int64, 2).tolist()
    at = 16
    take = lambda kind, count: np.frombuffer(raw, kind, count, at)
    ids = take(np.int64, docs)
    at += 8 * docs
    prints = take(np.int64, docs)
    at += 8 * docs
    fields = []
    for _ in range(3):
        fields.append(take(np.int32, n).astype(np.int64))
        at += 4 * n
    return ids, prints, np.cumsum(fields[0]), fields[1], fields[2], raw[at:]


def text_size(packed: bytes) -> int:
    return zstandard.frame_content_size(packed)


def pack_batches(buckets: int, frequent):
    """A function from (id, print, text) to rows of ``PACKED``."""
    def run(batches):
        for batch in batches:
            ids = batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            prints = batch.column(1).to_numpy(zero_copy_only=False)
            sizes = pc.fill_null(pc.binary_length(batch.column(2)), 0).to_pylist()
            for lo, hi in blocks(sizes, UNIT_BYTES):
                texts = [normal(t) for t in batch.column(2).slice(lo, hi - lo).to_pylist()]
                rows = list(pack_unit(texts, ids[lo:hi], prints[lo:hi], buckets, frequent.value))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()),
                     pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.binary())],
                    names=["bucket", "id", "print", "packed"])
    return run


def removed_in_bucket(rows: list[bytes]):
    """(id, print, spans) of the windows of one bucket that start in a
    document with a smaller id. Spans are (first word, windows)."""
    parts = [unpack(r) for r in rows]
    offset = np.cumsum([0] + [len(p[0]) for p in parts])
    ids, prints = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    text = np.concatenate([p[2] + offset[k] for k, p in enumerate(parts)])
    first, size = (np.concatenate([p[k] for p in parts]) for k in (3, 4))
    buf = b" ".join(p[5] for p in parts)
    del parts
    cuts = word_starts(buf)
    # Every super-k-mer has its windows plus WINDOW - 1 words.
    base = np.cumsum(size + WINDOW - 1) - (size + WINDOW - 1)
    kmer = np.repeat(np.arange(len(size)), size)
    inner = np.arange(len(kmer)) - np.repeat(np.cumsum(size) - size, size)
    at = base[kmer] + inner
    key = rolling(word_hashes(buf), WINDOW)[at]
    order = np.argsort(key, kind="stable")
    owner = ids[text[kmer[order]]]
    edge = np.flatnonzero(np.concatenate(([True], np.diff(key[order]) != 0)))
    least = np.minimum.reduceat(owner, edge)
    run = np.repeat(np.arange(len(edge)), np.diff(np.append(edge, len(order))))
    later = np.flatnonzero(owner > least[run])
    # Exact check: the words of each candidate against those of the first of
    # its run that has the least id; a run of unlike words is sorted out by them.
    holder = np.full(len(edge), -1, np.int64)
    firsts = np.flatnonzero(owner == least[run])[::-1]
    holder[run[firsts]] = firsts
    place, bounds = at[order], lambda p: buf[cuts[p]:cuts[p + WINDOW] - 1]
    gone = np.ones(len(later), bool)
    mixed = set()
    lo_a, hi_a = cuts[place[later]].tolist(), (cuts[place[later] + WINDOW] - 1).tolist()
    other = place[holder[run[later]]]
    lo_b, hi_b = cuts[other].tolist(), (cuts[other + WINDOW] - 1).tolist()
    for k, (a, b, c, d) in enumerate(zip(lo_a, hi_a, lo_b, hi_b)):
        if buf[a:b] != buf[c:d]:
            mixed.add(int(run[later[k]]))
    if mixed:
        for r in mixed:
            stop = edge[r + 1] if r + 1 < len(edge) else len(order)
            best: dict[bytes, int] = {}
            for p in range(edge[r], stop):
                words = bounds(place[p])
                best[words] = min(best.get(words, NO_ID), int(owner[p]))
            for k in np.flatnonzero(run[later] == r):
                gone[k] = best[bounds(place[later[k]])] < owner[later[k]]
    hit = order[later[gone]]
    if not len(hit):
        return
    hit.sort()
    # Neighbouring windows of one super-k-mer become one span.
    new = np.ones(len(hit), bool)
    new[1:] = (np.diff(hit) > 1) | (kmer[hit[1:]] != kmer[hit[:-1]])
    head = np.flatnonzero(new)
    length = np.diff(np.append(head, len(hit)))
    k = kmer[hit[head]]
    spans = np.stack([first[k] + inner[hit[head]], length], axis=1).astype(np.int32)
    doc = text[k]
    by_doc = np.argsort(doc, kind="stable")
    doc, spans = doc[by_doc], spans[by_doc]
    edge = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    for a, b in zip(edge.tolist(), np.append(edge[1:], len(doc)).tolist()):
        yield int(ids[doc[a]]), int(prints[doc[a]]), spans[a:b].tobytes()


def bucket_batches(batches):
    """Rows of ``PACKED``, sorted by bucket, to (id, print, spans)."""
    def out(rows):
        rows = list(rows)
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([r[2] for r in rows], pa.binary())], names=["id", "print", "spans"])

    current, held, size, most = None, [], 0, HELD_BYTES
    for batch in batches:
        known = []
        for bucket, i, p, packed in zip(*[c.to_pylist() for c in batch.columns]):
            if bucket < 0:
                known.append((i, p, packed))
                continue
            if bucket != current and held:
                yield out(removed_in_bucket(held))
                held, size, most = [], 0, HELD_BYTES
            current = bucket
            held.append(packed)
            size += text_size(packed)
            if size > most:
                row, gone = combined(held)
                held, size = [row], text_size(row)
                # What is left is text of its own.
                most = max(HELD_BYTES, 2 * size)
                known += gone
        if known:
            yield out(known)
    if held:
        yield out(removed_in_bucket(held))


def strip_batches(batches):
    """(doc_id, text, spans) to the words that stay."""
    for batch in batches:
        ids, texts, all_spans = batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()
        n_words, n_removed, kept_text = [], [], []
        for text, spans in zip(texts, all_spans):
            text = normal(text)
            n = text.count(b" ") + 1 if text else 0
            gone = 0
            if spans:
                pairs = np.frombuffer(b"".join(spans), np.int32).reshape(-1, 2)
                change = np.zeros(n + 1, np.int64)
                np.add.at(change, pairs[:, 0], 1)
                np.add.at(change, pairs[:, 0] + pairs[:, 1] + WINDOW - 1, -1)
                stay = np.cumsum(change[:n]) == 0
                gone = n - int(stay.sum())
                words = text.split(b" ")
                text = b" ".join([words[k] for k in np.flatnonzero(stay).tolist()])
            n_words.append(n), n_removed.append(gone), kept_text.append(text)
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
             pa.array(kept_text, pa.binary()).cast(pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_text"])


def gram_batches(batches):
    for batch in batches:
        grams = [gram_ranks(word_hashes(normal(t))) for t in batch.column(0).to_pylist()]
        values, n = np.unique(np.concatenate(grams), return_counts=True) if grams else (np.zeros(0, U64), np.zeros(0, np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n.astype(np.int64))], names=["gram", "n"])


def hot_grams(docs: DataFrame) -> np.ndarray:
    """The ``HOT`` most frequent grams of a sample, sorted."""
    sample = docs.filter(F.pmod(F.xxhash64("id", "print"), F.lit(SAMPLE)) == 0).select("text")
    top = (sample.mapInArrow(gram_batches, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
           .filter("n > 1").orderBy(F.col("n").desc(), "gram").limit(HOT).select("gram").toArrow())
    return np.sort(top.column("gram").to_numpy().view(U64))


def removed_windows(docs: DataFrame) -> DataFrame:
    """(id, print, spans) of ``docs`` (id, print, text)."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(16, math.ceil(size * SENT / BUCKET_BYTES))
    frequent = docs.sparkSession.sparkContext.broadcast(hot_grams(docs))
    packed = docs.select("id", "print", "text").mapInArrow(pack_batches(buckets, frequent), PACKED)
    tasks = max(shuffle_partitions(docs.sparkSession), math.ceil(buckets / BUCKETS_PER_TASK))
    return (packed.repartition(tasks, "bucket").sortWithinPartitions("bucket")
            .mapInArrow(bucket_batches, "id long, print long, spans binary"))


def bitmap_batches(bits, wanted: bool):
    """A function that keeps the rows whose first column, a hash, is in the
    bitmap (or is not), without that column."""
    def run(batches):
        for batch in batches:
            known = in_bitmap(batch.column(0).to_numpy(zero_copy_only=False), bits.value)
            yield batch.select(range(1, batch.num_columns)).filter(pa.array(known == wanted))
    return run


def untouched_batches(bits):
    """Rows (hash, doc_id, text) outside the bitmap lose nothing."""
    def run(batches):
        for batch in bitmap_batches(bits, False)(batches):
            nothing = pa.nulls(batch.num_rows, pa.list_(pa.binary()))
            yield from strip_batches([pa.RecordBatch.from_arrays([*batch.columns, nothing],
                                                                 names=["doc_id", "text", "spans"])])
    return run


def strip(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text of every document. Only texts
    with removed windows meet their spans in a shuffle: a bitmap of fixed size
    sets the others apart before it (a full bitmap sends all, with the same
    result)."""
    docs = only(docs, "doc_id", "text").select(
        "doc_id", "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
        F.xxhash64("text").alias("print"))
    removed = materialize(removed_windows(docs), "removed_windows")
    own = F.xxhash64("id", "print").alias("h")
    bits = docs.sparkSession.sparkContext.broadcast(
        lookup_bitmap(removed.select(own).distinct().withColumnRenamed("h", "gram")))
    kind = dict(docs.dtypes)["doc_id"]
    out = f"doc_id {kind}, n_words long, n_removed long, kept_text string"
    whole = docs.select(own, "doc_id", "text").mapInArrow(untouched_batches(bits), out)
    touched = docs.select(own, "doc_id", "text", "id", "print").mapInArrow(
        bitmap_batches(bits, True), f"doc_id {kind}, text string, id long, print long")
    spans = removed.groupBy("id", "print").agg(F.collect_list("spans").alias("spans"))
    joined = touched.join(spans, ["id", "print"], "left")
    return whole.unionByName(joined.select("doc_id", "text", "spans").mapInArrow(strip_batches, out))


def substring_dedup(docs: DataFrame) -> DataFrame:
    """Columns of the contract."""
    return strip(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))

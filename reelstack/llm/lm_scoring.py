"""LM scoring by cross-entropy difference.

Two bigram models share one vocabulary: the target model is counted over the
target documents (those labelled as good), the background model over all
documents. The score of a document is its mean loss per token under the target
model less that under the background model; lower means closer to the target.

Every word has its own counts. Those of the ``FREQUENT`` most frequent words go
to every task, a table of fixed size; all other counts grow with the corpus and
stay distributed: (bigram, word, document, count) entries travel packed to a
bucket, where they are counted for both models, turned into loss differences and
summed per document. A frequent word's bigrams are dealt out by bigram; all
bigrams that end in one rare word meet in one bucket, so its own counts are their
sum there. Bigrams that are frequent in a sample would make hot buckets, so they
are counted by partial aggregation and scored where the text is. The table and
the sample decide only where something is handled, never its count.

The loss needs the count of the word before, c(h), too. The words before the
tokens of a text are its tokens again (the end mark stands before the first), so
the term of c(h) is charged to the token itself and summed over the text.

Smoothing: p(w|h) = (c(h,w) + MU p(w)) / (c(h) + MU) and add-one for p(w), so
each model is a proper distribution over all words of both corpora, one unseen
word and the end of a text.

Defined results: a text without words (or null) has n_tokens 1, its end mark;
repeated rows count as often as they occur and each get the score; label rows may
repeat, and a null label is none; without any target document the target model
is uniform over the vocabulary; empty tables give an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from reelstack.llm.common import only
from reelstack.llm.decontamination import in_bitmap, lookup_bitmap
from reelstack.llm.tokens import U64, blocks, mix, normal, word_hashes
from reelstack.session import materialize, shuffle_partitions

# Words whose counts every task has.
FREQUENT = 1 << 17
MU = 50.0
# Bigrams handled where the text is, and the share of documents that names them.
HEAD = 1 << 16
SAMPLE = 32
# Entries a bucket holds on average, and texts that share a packed row.
BUCKET_ENTRIES = 2 << 20
# Buckets of one task, on average.
BUCKETS_PER_TASK = 4
UNIT_BYTES = 8 << 20
PACKED = "bucket int, unit long, packed binary"


class Model:
    """Unigram counts of both corpora for the frequent words, and the totals.
    Labels: the frequent words sorted by hash are 1..V, V + 1 is the end of a
    text, which also stands before its first word; rare words keep their hash."""

    END = U64(0x5851F42D4C957F2D)

    def __init__(self, words: np.ndarray, target: np.ndarray, background: np.ndarray,
                 totals: tuple[int, int], texts: tuple[int, int], types: int):
        # Plain arrays, to be sent to the tasks.
        self.parts = (words, target, background, totals, texts, types)
        order = np.argsort(words)
        self.words = words[order]
        self.end = len(words) + 1
        self.target, self.background = (np.concatenate(([0], known[order], [n])).astype(np.float64)
                                        for known, n in zip((target, background), texts))
        # Tokens of each corpus, end marks included, and kinds of tokens.
        self.sums = [float(total + n) for total, n in zip(totals, texts)]
        self.size = types + 2

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Labels of the frequent words, 0 for rare ones."""
        if not len(self.words):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, at + 1, 0)

    def bigrams(self, hashes: np.ndarray, counts: np.ndarray):
        """(bigram, label of its word, whether that is rare, text index) of
        texts laid end to end; a text of n words has n + 1 bigrams."""
        where = np.repeat(np.arange(len(counts)), counts + 1)
        last = np.cumsum(counts + 1) - 1
        inner = np.ones(len(where), bool)
        inner[last] = False
        token = np.full(len(where), self.END, U64)
        token[inner] = hashes
        label = np.full(len(where), self.end, np.int64)
        label[inner] = self.ids(hashes)
        rare = label == 0
        label[rare] = token[rare].view(np.int64)
        before = np.concatenate(([self.END], token[:-1])) if len(token) else token
        with np.errstate(over="ignore"):
            bigram = mix(mix(before) * U64(0x9E3779B97F4A7C15) + token)
        return bigram.view(np.int64), label, rare, where

    def difference(self, target: np.ndarray, background: np.ndarray,
                   one_target: np.ndarray, one_background: np.ndarray) -> np.ndarray:
        """Target loss less background loss of one token, per bigram, from the
        counts of the bigram and of its word."""
        def loss(pair, single, total):
            p = (single + 1) / (total + self.size)
            return np.log(single + MU) - np.log(pair + MU * p)

        return loss(target, one_target, self.sums[0]) - loss(background, one_background, self.sums[1])


def text_blocks(batch, column: int):
    """(lo, hi, hashes, words per text) of the texts of a batch."""
    texts = [normal(t) for t in batch.column(column).to_pylist()]
    for lo, hi in blocks([len(t) for t in texts]):
        part = texts[lo:hi]
        yield lo, hi, word_hashes(b" ".join(t for t in part if t)), np.array(
            [t.count(b" ") + 1 if t else 0 for t in part], np.int64)


def counted(keys: list[np.ndarray], name: str) -> pa.RecordBatch:
    values, n = np.unique(np.concatenate(keys) if keys else np.zeros(0, np.int64), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(values), pa.array(n.astype(np.int64))], names=[name, "n"])


def word_count_batches(batches):
    for batch in batches:
        yield counted([h.view(np.int64) for _, _, h, _ in text_blocks(batch, 0)], "word")


def bigram_count_batches(model, keep=None):
    """A function from (text) to (bigram, n) per batch, of ``keep`` if given,
    else of all that end in a frequent word, with its label."""
    def run(batches):
        m = Model(*model.value)
        wanted = None if keep is None else keep.value
        for batch in batches:
            found = [m.bigrams(h, c)[:3] for _, _, h, c in text_blocks(batch, 0)]
            if wanted is not None:
                yield counted([g[is_in(g, wanted)] for g, _, _ in found], "bigram")
                continue
            empty = [np.zeros(0, np.int64)]
            grams, labels = (np.concatenate([f[k][~f[2]] for f in found] or empty) for k in range(2))
            values, first, n = np.unique(grams, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(values), pa.array(labels[first]), pa.array(n.astype(np.int64))], names=["bigram", "label", "n"])
    return run


def is_in(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


def target_texts(docs: DataFrame, good: DataFrame) -> DataFrame:
    """Texts of the documents with an id in ``good`` (id). A fixed bitmap of
    the ids thins the documents out before the exact join, so only about the
    target's texts are shuffled."""
    good = good.na.drop().distinct()
    bits = docs.sparkSession.sparkContext.broadcast(lookup_bitmap(good.select(F.xxhash64("id").alias("gram"))))

    def thin(batches):
        for batch in batches:
            known = in_bitmap(batch.column(2).to_numpy(zero_copy_only=False), bits.value)
            yield batch.select([0, 1]).filter(pa.array(known))

    some = docs.select("id", "text", F.xxhash64("id").alias("h")).mapInArrow(thin, "id long, text string")
    return some.join(good, "id", "left_semi").select("text")


def shared_model(docs: DataFrame, target: DataFrame) -> Model:
    """Unigram counts by partial aggregation; the driver gets those of the
    ``FREQUENT`` most frequent words and five totals."""
    count = lambda df: df.select("text").mapInArrow(word_count_batches, "word long, n long")
    words = count(target).select("word", F.col("n").alias("t"), F.lit(0).cast("long").alias("b")).unionByName(
        count(docs).select("word", F.lit(0).cast("long").alias("t"), F.col("n").alias("b")))
    words = materialize(words.groupBy("word").agg(F.sum("t").alias("t"), F.sum("b").alias("b")), "lm_words")
    *totals, types = words.agg(F.coalesce(F.sum("t"), F.lit(0)), F.coalesce(F.sum("b"), F.lit(0)), F.count("*")).first()
    top = words.orderBy((F.col("t") + F.col("b")).desc(), "word").limit(FREQUENT).toArrow()
    column = lambda c: top.column(c).to_numpy()
    return Model(column("word").view(U64), column("t"), column("b"), tuple(totals),
                 (target.count(), docs.count()), types)


def head_bigrams(docs: DataFrame, target: DataFrame, model) -> tuple[np.ndarray, ...]:
    """The frequent bigrams, the labels of their words, and their whole counts
    in both corpora."""
    sc = docs.sparkSession.sparkContext
    sample = docs.filter(F.pmod(F.xxhash64("id", "text"), F.lit(SAMPLE)) == 0).select("text")
    named = sample.mapInArrow(bigram_count_batches(model), "bigram long, label long, n long").groupBy("bigram").agg(
        F.first("label").alias("label"), F.sum("n").alias("n")).orderBy(
        F.col("n").desc(), "bigram").limit(HEAD).select("bigram", "label").toArrow()
    grams, labels = (named.column(c).to_numpy() for c in ("bigram", "label"))
    order = np.argsort(grams)
    grams, labels = grams[order], labels[order]
    keep = sc.broadcast(grams)
    found = []
    for corpus in (target, docs):
        rows = corpus.select("text").mapInArrow(bigram_count_batches(model, keep), "bigram long, n long")
        rows = rows.groupBy("bigram").agg(F.sum("n").alias("n")).toArrow()
        n = np.zeros(len(grams))
        n[np.searchsorted(grams, rows.column("bigram").to_numpy())] = rows.column("n").to_numpy()
        found.append(n)
    return grams, labels, found[0], found[1]


def grouped(values: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sums of runs after sorting by ``values`` and ``more``."""
    new = np.ones(len(values), bool)
    if len(values):
        new[1:] = values[1:] != values[:-1]
        for x in more:
            new[1:] |= x[1:] != x[:-1]
    start = np.flatnonzero(new)
    return start, np.diff(np.append(start, len(values)))


def planes(values: np.ndarray, kind) -> bytes:
    """The first bytes of all numbers, then their second bytes, and so on: the
    high bytes are alike and pack well on their own."""
    values = np.ascontiguousarray(values, kind)
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def from_planes(raw: bytes, kind, n: int, at: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n).T).view(kind).ravel()


def pack(bigrams: np.ndarray, labels: np.ndarray, texts: np.ndarray, counts: np.ndarray) -> bytes:
    head = np.array([len(bigrams)], np.int64).tobytes()
    steps = np.diff(bigrams, prepend=0)
    return zstandard.ZstdCompressor(level=1).compress(
        head + planes(steps, np.int64) + planes(labels, np.int64) + planes(texts, np.int32) + planes(counts, np.int32))


def unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(packed)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    return (np.cumsum(from_planes(raw, np.int64, n, 8)), from_planes(raw, np.int64, n, 8 + 8 * n),
            from_planes(raw, np.int32, n, 8 + 16 * n), from_planes(raw, np.int32, n, 8 + 20 * n))


def entry_batches(model, head, buckets: int, rare_buckets: int, is_target: bool):
    """A function from (id, text) to rows of ``PACKED``: one per unit of texts
    and bucket (rare words' buckets come after the ``buckets`` others), and for scored texts one per unit (bucket -1) with their ids,
    tokens and the part of the score that the head gives."""
    def run(batches):
        m = Model(*model.value)
        grams, difference = head.value
        part, unit = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids = None if is_target else batch.column(0)
            held, size, first = [], 0, 0
            n = batch.num_rows
            for lo, hi, hashes, counts in text_blocks(batch, 1):
                g, label, rare, where = m.bigrams(hashes, counts)
                held.append((g, label, rare, where + lo - first, counts))
                size += 8 * len(g)
                if size < UNIT_BYTES and hi < n:
                    continue
                g, label, rare, where, counts = (np.concatenate([h[k] for h in held]) for k in range(5))
                rows = []
                frequent = is_in(g, grams)
                if is_target:
                    values, start, times = np.unique(g[~frequent], return_index=True, return_counts=True)
                    at = np.full(len(values), -1, np.int64)
                    label, rare = label[~frequent][start], rare[~frequent][start]
                else:
                    near = np.bincount(where[frequent], difference[np.searchsorted(grams, g[frequent])],
                                       len(counts)).astype(np.float64)
                    values, at, label, rare = (x[~frequent] for x in (g, where, label, rare))
                    # The texts are in order already.
                    order = np.argsort(values, kind="stable")
                    values, at = values[order], at[order]
                    start, times = grouped(values, at)
                    values, at = values[start], at[start]
                    label, rare = label[order[start]], rare[order[start]]
                    table = pa.RecordBatch.from_arrays(
                        [ids.slice(first, len(counts)), pa.array(counts + 1), pa.array(near)], ["id", "n", "near"])
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, table.schema) as writer:
                        writer.write_batch(table)
                    rows.append((-1, sink.getvalue().to_pybytes()))
                bucket = np.where(rare, buckets + label % rare_buckets, values % buckets)
                order = np.argsort(bucket, kind="stable")
                start, sizes = grouped(bucket[order])
                for s, z in zip(start.tolist(), sizes.tolist()):
                    k = order[s:s + z]
                    rows.append((int(bucket[k[0]]), pack(values[k], label[k], at[k], times[k])))
                key = (part << 32) + unit
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int32()), pa.array([key] * len(rows), pa.int64()),
                     pa.array([r[1] for r in rows], pa.binary())], names=["bucket", "unit", "packed"])
                held, size, first, unit = [], 0, hi, unit + 1
    return run


def scored_bucket(model: Model, is_rare: bool, bucket: int, rows: list[tuple[int, bytes]]):
    """Rows (bucket, unit, packed sums per text) of one bucket's entries."""
    parts = [unpack(p) for _, p in rows]
    values, labels, texts, times = (np.concatenate([p[k] for p in parts]) for k in range(4))
    row = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
    del parts
    grams, first, which = np.unique(values, return_index=True, return_inverse=True)
    in_target = texts < 0
    count = lambda mask: np.bincount(which[mask], times[mask], len(grams))
    pairs = count(in_target), count(~in_target)
    label = labels[first]
    del values, labels, first
    if is_rare:
        # All bigrams of the word are here, so their counts add up to its own.
        names, word = np.unique(label, return_inverse=True)
        singles = [np.bincount(word, n, len(names))[word] for n in pairs]
    else:
        singles = [model.target[label], model.background[label]]
    loss = model.difference(*pairs, *singles)
    mine = np.flatnonzero(~in_target)
    gain = loss[which[mine]] * times[mine]
    order = np.lexsort((texts[mine], row[mine]))
    row, texts, gain = row[mine][order], texts[mine][order], gain[order]
    start, _ = grouped(row, texts)
    if not len(start):
        return
    total = np.add.reduceat(gain, start)
    row, texts = row[start], texts[start]
    start, sizes = grouped(row)
    for s, z in zip(start.tolist(), sizes.tolist()):
        body = np.array([z], np.int64).tobytes() + np.diff(texts[s:s + z], prepend=0).astype(np.int32).tobytes() \
            + total[s:s + z].astype(np.float32).tobytes()
        yield bucket, rows[row[s]][0], zstandard.ZstdCompressor(level=1).compress(body)


def grouped_rows(batches, key: int):
    """(key, rows) of consecutive rows with an equal key column."""
    current, held = None, []
    for batch in batches:
        for r in zip(*[c.to_pylist() for c in batch.columns]):
            if held and r[key] != current:
                yield current, held
                held = []
            current = r[key]
            held.append(r)
    if held:
        yield current, held


def as_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(3)],
                                      names=["bucket", "unit", "packed"])


def bucket_batches(model, buckets: int):
    """Entries sorted by bucket to sums per unit; unit tables pass through."""
    def run(batches):
        def split():
            for batch in batches:
                own = pa.array(batch.column(0).to_numpy() < 0)
                if own.true_count:
                    passed.append(batch.filter(own))
                yield batch.filter(pc.invert(own))
        passed: list = []
        m = Model(*model.value)
        for bucket, rows in grouped_rows(split(), 0):
            yield from passed
            passed.clear()
            yield as_batch(list(scored_bucket(m, bucket >= buckets, bucket, [(r[1], r[2]) for r in rows])))
        yield from passed
    return run


def unit_batches(batches):
    """Rows sorted by unit and bucket to (doc_id, n_tokens, score)."""
    for _, rows in grouped_rows(batches, 1):
        table = pa.ipc.open_stream(rows[0][2]).read_all()
        total = table.column("near").to_numpy().copy()
        for _, _, packed in rows[1:]:
            raw = zstandard.ZstdDecompressor().decompress(packed)
            n = int(np.frombuffer(raw, np.int64, 1)[0])
            at = np.cumsum(np.frombuffer(raw, np.int32, n, 8))
            total[at] += np.frombuffer(raw, np.float32, n, 8 + 4 * n)
        n = table.column("n").to_numpy()
        yield pa.RecordBatch.from_arrays(
            [table.column("id").combine_chunks(), pa.array(n), pa.array(total / n)],
            names=["doc_id", "n_tokens", "score"])


def cross_entropy_difference(docs: DataFrame, good: DataFrame) -> DataFrame:
    """doc_id, n_tokens and score of every row of ``docs`` (doc_id, text);
    ``good`` has the ids (doc_id) of the target documents."""
    sc = docs.sparkSession.sparkContext
    docs = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("id"), "text")
    good = good.select(F.col("doc_id").cast("long").alias("id"))
    target = materialize(target_texts(docs, good), "lm_target")
    shared = shared_model(docs, target)
    model = sc.broadcast(shared.parts)
    grams, labels, in_target, in_all = head_bigrams(docs, target, model)
    head = sc.broadcast((grams, shared.difference(
        in_target, in_all, shared.target[labels], shared.background[labels])))
    frequent = shared.background.sum() + shared.target.sum()
    count = lambda entries: max(16, math.ceil(entries / BUCKET_ENTRIES))
    buckets, rare_buckets = count(frequent), count(sum(shared.sums) - frequent)
    packed = docs.mapInArrow(entry_batches(model, head, buckets, rare_buckets, False), PACKED).unionByName(
        target.select(F.lit(0).alias("id"), "text").mapInArrow(
            entry_batches(model, head, buckets, rare_buckets, True), PACKED))
    # Unit tables (bucket -1) need no bucket: they are dealt out by unit.
    place = F.when(F.col("bucket") < 0, -1 - F.pmod("unit", F.lit(buckets)).cast("int")).otherwise(F.col("bucket"))
    # The number of tasks follows the entries, as that of the buckets does.
    tasks = max(shuffle_partitions(docs.sparkSession), math.ceil((buckets + rare_buckets) / BUCKETS_PER_TASK))
    sums = (packed.withColumn("bucket", place).repartition(tasks, "bucket").sortWithinPartitions("bucket", "unit")
            .mapInArrow(bucket_batches(model, buckets), PACKED))
    return (sums.repartition(tasks, "unit").sortWithinPartitions("unit", "bucket")
            .mapInArrow(unit_batches, "doc_id long, n_tokens long, score double"))


def lm_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores with the documents labelled ``quality = 1`` as the target."""
    return cross_entropy_difference(docs, labels.filter(F.col("quality") == 1).select("doc_id"))

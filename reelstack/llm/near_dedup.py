"""Near-duplicate classes by Order MinHash.

A sketch of a text: among its 5-word shingles, labelled by their occurrence
number, take the ``SAMPLE`` with the least hash and keep them in text order.
Texts that agree on a sketch share those shingles in the same order, which makes
the sketch sensitive to edit similarity rather than to set overlap alone. Few
texts near the threshold agree on two shingles, so the ``SINGLES`` least labelled
shingles of one hash propose pairs, too.

Copies (equal word sequences) are collapsed first. Texts that share a sketch
value and are of like length form a group: lengths of similar texts lie within
a factor of 1.25, so a text stands in the group of its own length class and of the
next; two texts that are both guests from the class below meet in that one.
Groups of the same members count once. All pairs of different classes in a group,
whatever its size, are judged, in a fixed number of steps (each a Spark job over all
groups):

* every member is aligned with the group's lead, its least text;
* of the groups that still hold texts no accepted links tie together, those of one lead
  and length class become one where that is no more pairs; they are dealt to tasks,
  one of up to ``SMALL`` members whole, a larger one in cells of up to about ``CELL``
  members of nearest length, and the pairs inside are judged;
* larger groups that are still mixed then deal every two of their cells whose
  lengths allow a similar pair to a task, which judges the pairs across.

An alignment is a banded one of the words; bounds that are exact come before it:
first the lengths, then histograms of the words, a few times smaller than the
words, which rule nearly all unlike pairs out before any words travel. Accepted links
are closed to classes by connected components. Two texts are never compared only if
they share none of the values. The pairs of a large group of unlike texts grow with
the square of its size; what a task holds does not, and a group's rows travel once for
each of its cells.

Similar means a word edit similarity of ``SIMILARITY`` or more:
1 - distance / longer length.

Defined results: null text and text without words count as one group of empty
texts; texts under five words are only equal or different; repeated rows share
their class; rows of one doc_id with different texts each get the class of their
own text; a null doc_id gets a negative stand-in made from its text; an
empty table gives an empty result; extra columns are ignored or carried along.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from reelstack.llm.common import maybe_in, only, small_batches, with_maybe_in, with_row
from reelstack.llm.graph import components
from reelstack.llm.tokens import U64, blocks, mix, normal, rolling, seeded, word_hashes
from reelstack.session import materialize, scratch_path, settled, shuffle_partitions
from reelstack.sources import scan_bucketed, sink_bucketed

SHINGLE = 5
SAMPLE = 2
PAIRED = 12
SINGLES = 32
SIMILARITY = 0.8
# Members of a group that one task judges whole.
SMALL = 256
# Members of a cell of a larger group, and bytes of their words.
CELL = 2048
CELL_BYTES = 8 << 20
# A little over 1 / SIMILARITY: like lengths are in the same class or the next.
CLASS_STEP = 1.26
# Bins of a text's histogram, at most; of that of its word pairs, which only the
# members of one group at a time have.
BINS = 8192
PAIR_BINS = 1024


def occurrence_labels(grams: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Which occurrence (0, 1, ...) of its shingle each position is, per text."""
    with np.errstate(over="ignore"):
        key = mix(grams + owner.astype(U64) * U64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    first = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    run_start = np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))
    label = np.empty(len(key), np.int64)
    label[order] = np.arange(len(key)) - run_start
    return label


def paired(labelled: np.ndarray, flat: np.ndarray, starts: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """``PAIRED`` order-min-hash values per text of a block."""
    out = np.empty((n, PAIRED), U64)
    for j, seed in enumerate(seeded(PAIRED, 71)):
        rank = mix(labelled ^ seed)
        picked = np.empty((n, SAMPLE), np.int64)
        for s in range(SAMPLE):
            least = np.minimum.reduceat(rank, starts)
            at = np.flatnonzero(rank == least[owner])
            # One position per text: the first that holds the least rank.
            own, where = np.unique(owner[at], return_index=True)
            picked[own, s] = at[where]
            rank[picked[:, s]] = U64(0xFFFFFFFFFFFFFFFF)
        picked.sort(axis=1)
        value = np.full(n, seed, U64)
        with np.errstate(over="ignore"):
            for s in range(SAMPLE):
                value = mix(value * U64(0x9E3779B97F4A7C15) + flat[picked[:, s]])
        out[:, j] = value
    return out


def sketches(texts: list[bytes]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Of a block of normal texts: the paired values, the up to ``SINGLES`` least
    labelled shingles in order, and the hashes of the words."""
    hashes = [word_hashes(t) for t in texts]
    grams = [rolling(h, SHINGLE) if len(h) >= SHINGLE else rolling(h, len(h)) if len(h) else np.zeros(1, U64)
             for h in hashes]
    counts = np.array([len(g) for g in grams])
    starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
    owner = np.repeat(np.arange(len(texts)), counts)
    flat = np.concatenate(grams)
    with np.errstate(over="ignore"):
        labelled = mix(flat + occurrence_labels(flat, owner).astype(U64) * U64(0xD1B54A32D192ED03))
    least = [labelled[s:s + c] if c <= SINGLES else np.partition(labelled[s:s + c], SINGLES)[:SINGLES]
             for s, c in zip(starts, counts)]
    return paired(labelled, flat, starts, owner, len(texts)), [np.sort(v) for v in least], hashes


def histogram(words: np.ndarray) -> bytes:
    """How many words fall on each bin, a power of two of them that grows with the
    text. Empty where a count does not fit (it then rules nothing out)."""
    size = 1 << min(BINS.bit_length() - 1, max(6, (len(words) // 2).bit_length() - 1))
    counts = np.bincount(words % np.uint32(size), minlength=size)
    return counts.astype(np.uint16).tobytes() if counts.max(initial=0) < 1 << 16 else b""


def folded(bins: bytes, size: int) -> np.ndarray:
    """A histogram in fewer bins."""
    return np.frombuffer(bins, np.uint16).reshape(-1, size).sum(axis=0, dtype=np.int64)


SKETCHED = "id long, tx long, copy binary, n int, sketch array<long>, bins binary, words binary"


def sketch_batches(batches):
    """(id, tx, text) to (id, tx, copy key, number of words, sketch, words): the
    sketch is the paired values, then the least shingles; of each word four bytes
    stay, enough to tell words of two texts apart, and their histogram."""
    for batch in batches:
        ids = batch.select([0, 1])
        texts = [normal(t) for t in batch.column(2).to_pylist()]
        for lo, hi in blocks([len(t) for t in texts]):
            part = texts[lo:hi]
            pairs, least, hashes = sketches(part)
            values = [np.concatenate(x).view(np.int64) for x in zip(pairs, least)]
            short = [(h >> U64(32)).astype(np.uint32) for h in hashes]
            ends = np.cumsum([0, *[len(v) for v in values]]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                *ids.slice(lo, hi - lo).columns,
                pa.array([hashlib.blake2b(t, digest_size=16).digest() for t in part], pa.binary()),
                pa.array([len(h) for h in hashes], pa.int32()),
                pa.ListArray.from_arrays(ends, pa.array(np.concatenate(values))),
                pa.array([histogram(w) for w in short], pa.binary()),
                pa.array([w.tobytes() for w in short], pa.binary())],
                names=["id", "tx", "copy", "n", "sketch", "bins", "words"])


def word_batches(batches):
    """(id, tx, text) to (id, tx, words as in ``sketch_batches``); repeats in a
    batch are left out."""
    for batch in batches:
        found = {}
        for i, tx, text in zip(*[c.to_pylist() for c in batch.columns]):
            if (i, tx) not in found:
                found[i, tx] = (word_hashes(normal(text)) >> U64(32)).astype(np.uint32).tobytes()
        if found:
            yield pa.RecordBatch.from_arrays([
                pa.array([i for i, _ in found], pa.int64()), pa.array([tx for _, tx in found], pa.int64()),
                pa.array(list(found.values()), pa.binary())], names=["id", "tx", "words"])


def banded_distance(a: list, b: list, band: int) -> int:
    """Edit distance of ``a`` (the longer) and ``b`` if it is at most ``band``,
    else ``band + 1``. One diagonal band of the alignment table is kept as bit
    vectors, two bits of difference per cell, and slides down the diagonal.
    Needs len(a) > band and len(a) - len(b) <= band."""
    width = 2 * band + 2
    full = (1 << width) - 1
    at: dict = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | (1 << i)
    up, down = (full << (width - band - 1)) & full, 0
    diagonal, level = 1 << (width - 1), 1 << (width - 2)
    score, give_up = band, 2 * band + len(b) - len(a)
    shift, turn = band + 1 - width, len(a) - band
    for i, x in enumerate(b):
        match = at.get(x, 0)
        match = ((match >> shift) if shift >= 0 else (match << -shift)) & full
        same = ((((match & up) + up) ^ up) | match | down) & full
        right_up = (down | ~(same | up)) & full
        right_down = same & up
        if i < turn:
            score += not same & diagonal
        else:
            score += bool(right_up & level) - bool(right_down & level)
            level >>= 1
        if score > give_up:
            return band + 1
        along = same >> 1
        up = (right_down | ~(along | right_up)) & full
        down = along & right_up
        shift += 1
    return min(score, band + 1)


def similar(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> bool:
    """Whether two word arrays reach the edit similarity ``least``. Common
    ends are cut off, lengths and shared words bound the distance, and the band
    of the alignment doubles until the distance fits or the limit is reached."""
    n, m = len(a), len(b)
    limit = int((1 - least) * max(n, m) + 1e-9)
    if abs(n - m) > limit:
        return False
    short = min(n, m)
    differ = np.flatnonzero(a[:short] != b[:short])
    head = int(differ[0]) if len(differ) else short
    a, b = a[head:], b[head:]
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[::-1][:short] != b[::-1][:short])
    tail = int(differ[0]) if len(differ) else short
    a, b = a[:len(a) - tail], b[:len(b) - tail]
    if len(a) < len(b):
        a, b = b, a
    if len(a) <= limit:
        return True
    words, count_a = np.unique(a, return_counts=True)
    other, count_b = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(words, other, assume_unique=True, return_indices=True)
    if len(a) - int(np.minimum(count_a[i], count_b[j]).sum()) > limit:
        return False
    a, b, band = a.tolist(), b.tolist(), max(16, len(a) - len(b))
    while True:
        band = min(band, limit)
        if banded_distance(a, b, band) <= band:
            return True
        if band == limit:
            return False
        band *= 4


def align_batches(batches):
    """(u, v, words of u, words of v) to the pairs that are similar."""
    for batch in batches:
        left, right = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        keep = [similar(np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)) for x, y in zip(left, right)]
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def near_batches(batches):
    """(u, v, longer length, bins of u, bins of v) to the pairs (u, v) whose
    words may be alike: an edit changes the counts by two at most."""
    for batch in batches:
        longer, left, right = (batch.column(c).to_pylist() for c in (2, 3, 4))
        keep = []
        for n, x, y in zip(longer, left, right):
            size = min(len(x), len(y)) // 2
            keep.append(not size or int(np.abs(folded(x, size) - folded(y, size)).sum()) <= 2 * ((1 - SIMILARITY) * n + 1e-9))
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def near_pairs(members: list[tuple]):
    """(place, later places) of the pairs of different classes in one group that pass
    both bounds. A member is (node, class, length, own, side, bins, ...): two guests
    (not ``own``) meet elsewhere, and so do two of one side but 0."""
    sized = [len(m[5]) // 2 for m in members if m[5]]
    size = min(sized, default=1)
    bins = np.zeros((len(members), size), np.int32)
    for row, m in zip(bins, members):
        if m[5]:
            row[:] = folded(m[5], size)
    group, n, own, side = (np.array([m[k] for m in members]) for k in (1, 2, 3, 4))
    known = np.array([bool(m[5]) for m in members])
    for i in range(len(members) - 1):
        limit = (1 - SIMILARITY) * np.maximum(n[i + 1:], n[i]) + 1e-9
        near = (np.abs(n[i + 1:] - n[i]) <= limit) & (group[i + 1:] != group[i])
        if not own[i]:
            near &= own[i + 1:]
        if side[i]:
            near &= side[i + 1:] != side[i]
        at = np.flatnonzero(near)
        if known[i] and len(at):
            apart = np.abs(bins[at + i + 1] - bins[i]).sum(axis=1) > 2 * limit[at]
            at = at[~(apart & known[at + i + 1])]
        if len(at):
            yield i, at + i + 1


def in_near_pairs(members: list[tuple]) -> list[tuple]:
    """Members of one group that are in a pair of ``near_pairs``."""
    found = np.zeros(len(members), bool)
    for i, others in near_pairs(members):
        found[i] = True
        found[others] = True
    return [members[i] for i in np.flatnonzero(found)]


def pair_bins(words: list[np.ndarray]) -> np.ndarray:
    """How many pairs of neighbouring words fall on each bin, for every text: an edit
    changes the counts by four at most, two pairs that go and two that come."""
    longest = max((len(w) for w in words), default=0)
    size = min(1 << max(6, longest.bit_length()), PAIR_BINS)
    bins = np.zeros((len(words), size), np.int32)
    for row, w in zip(bins, words):
        pairs = mix(w[:-1].astype(U64) << U64(32) | w[1:].astype(U64))
        row[:] = np.bincount((pairs & U64(size - 1)).astype(np.int64), minlength=size)
    return bins


def tied(g: int, members: list[tuple]) -> list[tuple[int, int]]:
    """Links (node, node) that tie the similar texts of one group, given as for
    ``near_pairs`` with their words and the groups they are in: sorted, 1 as last bit
    where the text is no guest. Pairs in one class by then are not aligned, and texts that
    meet in several groups are aligned in the first of them alone."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    words = [np.frombuffer(m[6], np.uint32) for m in members]
    bins, n = pair_bins(words), np.array([len(w) for w in words])
    groups = [{x & ~1: x & 1 for x in m[7]} for m in members]

    def met_before(i: int, j: int) -> bool:
        for x, own in groups[i].items():
            if x == g & ~1:
                return False
            if x in groups[j] and (own or groups[j][x]):
                return True
        return False

    found = []
    for i, others in near_pairs(members):
        apart = np.abs(bins[others] - bins[i]).sum(axis=1, dtype=np.int64)
        others = others[apart <= 4 * ((1 - SIMILARITY) * np.maximum(n[others], n[i]) + 1e-9)]
        for j in others.tolist():
            a, b = find(members[i][1]), find(members[j][1])
            if a != b and not met_before(i, j) and similar(words[i], words[j]):
                root[b] = a
                found.append((members[i][0], members[j][0]))
    return found


def by_group(batches, work, names):
    """``work`` on the members of each group of sorted (g, member...) batches; a
    batch of its results for each of them."""
    now, members, out = None, [], []
    for batch in batches:
        for g, *member in zip(*[c.to_pylist() for c in batch.columns]):
            if g != now:
                out += work(now, members)
                now, members = g, []
            members.append(member)
        if out:
            yield number_batch(out, names)
            out = []
    out += work(now, members)
    if out:
        yield number_batch(out, names)


def number_batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)


def near_batches_of_groups(batches):
    """(g, node, class, n, own, side, bins) sorted by group to the members, less the
    histogram, of a pair that passes the bounds."""
    return by_group(batches, lambda g, members: [(g, *m[:3], int(m[3]), m[4]) for m in in_near_pairs(members)],
                    ["g", "node", "class", "n", "own", "side"])


def tied_batches(batches):
    """(g, node, class, n, own, side, bins, words, groups) sorted by group to links (u, v)."""
    return by_group(batches, tied, ["u", "v"])


def proposals(texts: DataFrame) -> DataFrame:
    """(key, node, n) of the sketch values of every text."""
    values = F.slice(F.transform("sketch", lambda s, j: F.xxhash64(j, s)), 1, PAIRED)
    values = F.concat(values, F.slice("sketch", PAIRED + 1, SINGLES))
    return texts.select("node", "n", F.explode(values).alias("key"))


def grouped(rows: DataFrame) -> DataFrame:
    """(g, node, n, own) of the groups of like length that share a value; ``own``
    tells texts of the group's length class from guests of the one below. Groups of
    guests alone hold no pair that the class below lacks; those of
    the same members are kept once. The counts come from partial aggregates and are
    stored, so that the joins on them are of two plain exchanges, which can split a
    hot group over tasks."""
    shared = rows.groupBy("key").agg(F.count("*").alias("_c")).filter("_c > 1").select("key")
    shared = materialize(shared, "omh_shared")
    rows = maybe_in(rows, shared, "key").join(shared, "key")
    length = length_class(F.col("n"))
    rows = materialize(rows.select("key", "node", "n", F.posexplode(F.array(length, length + 1)).alias("_p", "_l")).select(
        F.xxhash64("key", "_l").alias("g"), "node", "n", (F.col("_p") == 0).alias("own")), "omh_classes")
    h = F.xxhash64("node")
    groups = rows.groupBy("g").agg(F.count("*").alias("_c"), F.bit_xor(h).alias("_x"), F.sum(F.shiftright(h, 24)).alias("_s"),
                                   F.max("own").alias("_o")).filter("_c > 1 AND _o")
    once = materialize(groups.groupBy("_c", "_x", "_s").agg(F.min("g").alias("g")).select("g"), "omh_once")
    return materialize(maybe_in(rows, once, "g").join(once, "g"), "omh_groups")


def sides(pairs: DataFrame, words: DataFrame, column: str) -> DataFrame:
    """Pairs with a column of both their texts."""
    of = lambda side: words.select(F.col("node").alias(side), F.col(column).alias(f"_{side}"))
    return pairs.join(of("u"), "u").join(of("v"), "v").select(*pairs.columns, "_u", "_v")


def bucketed(texts: DataFrame, name: str) -> DataFrame:
    """``texts`` stored by ``node``: joins that fetch its columns move the pairs and
    groups, never the whole table again."""
    spark = texts.sparkSession
    path = sink_bucketed(texts, scratch_path(spark, name), "node", shuffle_partitions(spark))
    return scan_bucketed(spark, path, "node", shuffle_partitions(spark))


def led(pairs: DataFrame, bins: DataFrame, words_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Links (u, v) among pairs (lead, node, their lengths). Pairs of unlike length
    are left out."""
    longer = F.greatest("n", "lead_n")
    pairs = pairs.filter(F.abs(F.col("n") - F.col("lead_n")) <= (1 - SIMILARITY) * longer + 1e-9)
    pairs = pairs.select(F.least("lead", "node").alias("u"), F.greatest("lead", "node").alias("v"), longer.alias("longer")).distinct()
    near = materialize(sides(materialize(pairs, "omh_pairs"), bins, "bins").mapInArrow(near_batches, "u long, v long"), "omh_near")
    words = words_of(near.select(F.explode(F.array("u", "v")).alias("node")).distinct())
    return materialize(sides(near, words, "words").mapInArrow(align_batches, "u long, v long"), "omh_links")


def length_class(n: Column) -> Column:
    return F.floor(F.log(F.greatest(n, F.lit(1))) / F.log(F.lit(CLASS_STEP)))


def mixed(members: DataFrame, links: DataFrame, step: str) -> DataFrame:
    """Members of the groups whose texts are of several classes by the links, with the
    class and the group's lead and size. A lead settles a group of two."""
    known = components(links).withColumnRenamed("component", "class")
    rest = members.join(known, "node", "left").withColumn("class", F.coalesce("class", "node"))
    rest = materialize(rest, f"omh_rest_{step}")
    state = rest.groupBy("g").agg(F.count("*").alias("size"), F.min("node").alias("lead"), F.min("class").alias("_a"), F.max("class").alias("_b"))
    state = state.filter("_a < _b AND size > 2").select("g", "lead", "size")
    state = materialize(state, f"omh_open_{step}")
    return materialize(maybe_in(rest, state, "g").join(state, "g"), f"omh_mixed_{step}")


def merged(rest: DataFrame) -> DataFrame:
    """Members (g, node, class, n, own, size) of open groups, those of one lead and one
    length class as one group where that is no more pairs: texts with a passage in common
    share many values, which makes many groups of nearly the same members. Every pair
    of a group is in the group that takes it in, where its texts are guests as before."""
    block = F.xxhash64("lead", length_class(F.col("n")) + F.when(F.col("own"), 0).otherwise(1))
    rest = rest.withColumn("block", block)
    once = materialize(rest.groupBy("block", "node", "class", "n", "own").agg(F.sum("size").alias("_s")), "omh_blocks")
    fewer = once.groupBy("block").agg(F.count("*").alias("_u"), F.sum("_s").alias("_s")).filter("_u * _u <= _s")
    fewer = materialize(fewer.select("block", F.col("_u").alias("size")), "omh_fewer")
    cols = ["g", "node", "class", "n", "own", "size"]
    return materialize(once.join(fewer, "block").withColumnRenamed("block", "g").select(*cols).unionByName(
        rest.join(fewer, "block", "left_anti").select(*cols)), "omh_merged")


def inside(dealt: DataFrame, bins: DataFrame, words_of: Callable[[DataFrame], DataFrame], step: str, whole: bool) -> DataFrame:
    """Links (u, v) among the members (g, node, class, n, own, side) of each g: first
    which of them are in a pair that the bounds leave, by their histograms alone;
    then these with their words. ``whole``: a text is in few g and on no side, so that
    it takes the list of them along."""
    tasks = shuffle_partitions(dealt.sparkSession)
    rows = lambda df: df.repartition(tasks, "g").sortWithinPartitions("g", "node")
    cols = ["g", "node", "class", "n", "own", "side"]
    dealt = materialize(dealt.select(*cols), f"omh_dealt_{step}")
    near = rows(dealt.join(bins, "node").select(*cols, "bins")).mapInArrow(
        near_batches_of_groups, "g long, node long, class long, n long, own long, side long")
    near = materialize(near, f"omh_near_{step}").withColumn("own", F.col("own") == 1)
    words = words_of(near.select("node").distinct())
    if whole:
        place = F.col("g").bitwiseAND(F.lit(-2)) + F.col("own").cast("long")
        texts = near.groupBy("node").agg(F.sort_array(F.collect_list(place)).alias("groups"))
    else:
        texts = near.select("node", F.array().cast("array<long>").alias("groups")).distinct()
    # A text gets its columns once, then goes to its groups.
    texts = texts.join(bins, "node").join(words, "node")
    near = near.join(texts, "node").select(*cols, "bins", "words", "groups")
    return materialize(rows(near).mapInArrow(tied_batches, "u long, v long"), f"omh_links_{step}")


def link_groups(members: DataFrame, bins: DataFrame, words_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Links (u, v) that tie all similar texts of every group."""
    lead = members.groupBy("g").agg(F.min(F.struct("node", "n")).alias("_l")).select(
        "g", F.col("_l.node").alias("lead"), F.col("_l.n").alias("lead_n"))
    found = led(members.join(materialize(lead, "omh_leads"), "g").filter("node <> lead"), bins, words_of)
    rest = merged(mixed(members, found, "a"))
    large = rest.filter(F.col("size") > SMALL).drop("size")
    large = materialize(large.join(runs(large), ["g", "n"]).withColumn(
        "cell", F.shiftleft("run", 20) + F.pmod(F.xxhash64("node"), "parts")).drop("run", "parts"), "omh_cells")
    dealt = rest.filter(F.col("size") <= SMALL).drop("size").unionByName(
        large.withColumn("g", F.xxhash64("g", "cell")).drop("cell"))
    found = found.unionByName(inside(dealt.withColumn("side", F.lit(0)), bins, words_of, "a", True))
    if large.isEmpty():
        return found
    rest = mixed(large.drop("class"), found, "b")
    return found.unionByName(inside(across(rest), bins, words_of, "b", False))


def runs(large: DataFrame) -> DataFrame:
    """(g, n, run, parts) of large groups: lengths next to one another make runs of
    one cell's members, and members of one length are dealt to parts where they
    are more. Only counts by group and length meet in a window."""
    room = F.greatest(F.lit(1), F.least(F.lit(CELL), F.floor(F.lit(CELL_BYTES) / (4 * F.greatest("n", F.lit(1))))))
    counts = large.groupBy("g", "n").agg((F.count("*") / room).alias("_c"))
    before = Window.partitionBy("g").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    return materialize(counts.select(
        "g", "n", F.floor(F.coalesce(F.sum("_c").over(before), F.lit(0))).alias("run"),
        F.ceil("_c").alias("parts")), "omh_runs")


def across(large: DataFrame) -> DataFrame:
    """Members (g, node, class, n, own, side) of every two cells of a group that may
    hold a similar pair, one cell on side 1, the other on side 2. The pairs are of
    cells, whose number is a small part of that of the members."""
    cells = materialize(large.groupBy("g", "cell").agg(
        F.min("n").alias("lo"), F.max("n").alias("hi"), F.min("class").alias("a"), F.max("class").alias("b"),
        F.max("own").alias("o")), "omh_cell_list")
    x, y = cells.alias("x"), cells.alias("y")
    later = F.greatest("x.lo", "y.lo")
    pairs = x.join(y, F.col("x.g") == F.col("y.g")).filter(
        (F.col("x.cell") < F.col("y.cell")) & (F.col("x.o") | F.col("y.o"))
        & (later - F.least("x.hi", "y.hi") <= (1 - SIMILARITY) * later + 1e-9)
        & (F.least("x.a", "y.a") < F.greatest("x.b", "y.b")))
    key = F.xxhash64("x.g", "x.cell", "y.cell").alias("key")
    both = F.array(*[F.struct(F.col(f"{c}.cell").alias("cell"), F.lit(k).alias("side")) for k, c in ((1, "x"), (2, "y"))])
    dealt = materialize(pairs.select(F.col("x.g").alias("g"), key, F.explode(both).alias("_s")).select("g", "key", "_s.*"), "omh_cell_pairs")
    return large.join(dealt, ["g", "cell"]).select(F.col("key").alias("g"), "node", "class", "n", "own", "side")


def links(texts: DataFrame, words_of: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Accepted pairs (u, v) among distinct texts (node, n, sketch, bins).
    ``words_of`` gives a bucketed table (node, words) with the texts of a table of
    nodes at least; else ``texts`` has the words, too."""
    members = grouped(proposals(texts))
    wanted = materialize(members.select("node").distinct(), "omh_wanted")
    bins = bucketed(maybe_in(texts.select("node", "bins"), wanted, "node").join(wanted, "node"), "omh_bins")
    return link_groups(members, bins, words_of or (
        lambda nodes: bucketed(texts.select("node", "words").join(nodes, "node"), "omh_words")))


def names(copies: DataFrame, firsts: DataFrame) -> DataFrame:
    """(id, tx, node) of all texts of the ids that have several among the rows (id,
    tx); a text that is none of ``firsts`` (id, tx, _n) has no node. Any other text is
    named by its id, these by numbers out of the ids' way."""
    several = copies.groupBy("id").agg(F.min("tx").alias("_a"), F.max("tx").alias("_b")).filter("_a < _b").select("id")
    of = copies.select("id", "tx").distinct().join(materialize(several, "omh_several"), "id")
    return materialize(of.join(firsts, ["id", "tx"], "left").select(
        "id", "tx", (F.col("_n") + F.lit(-2 ** 63)).alias("node")), "omh_names")


def named(rows: DataFrame, names: DataFrame) -> DataFrame:
    """Rows (id, tx, ...) of texts that have a node, with it."""
    of = names.withColumn("_t", F.lit(True))
    node = F.when(F.col("_t"), F.col("node")).otherwise(F.col("id"))
    return rows.join(of, ["id", "tx"], "left").withColumn("node", node).drop("_t").filter("node IS NOT NULL")


def classes(docs: DataFrame) -> DataFrame:
    """(id, tx, component, class_id) per row of ``docs`` (id, text): the class
    and its least id. ``tx`` tells the texts of one id apart, ``component`` the
    classes of one least id. The words of a text are made anew where they are needed:
    few texts are ever aligned, and the sketches without the words are a small table."""
    spark = docs.sparkSession

    def make() -> DataFrame:
        rows = docs.select("id", F.xxhash64("text").alias("tx"), "text")
        copies = scratch_path(spark, "omh_ids")

        def make_texts() -> DataFrame:
            sketched = materialize(rows.mapInArrow(sketch_batches, SKETCHED).drop("words"), "omh_sketches")
            sketched.select("id", "tx", "copy").write.parquet(copies)
            first = F.row_number().over(Window.partitionBy("copy").orderBy("id", "tx"))
            return sketched.withColumn("_r", first).filter("_r = 1").drop("_r").withColumn(
                "_n", F.monotonically_increasing_id())

        # The sketches of all rows go when those of the distinct texts are stored.
        texts = settled(spark, "omh_copies", make_texts)
        ids = spark.read.schema("id long, tx long, copy binary").parquet(copies)
        other = names(ids, texts.select("id", "tx", "_n"))
        texts = named(texts.drop("_n"), other)

        def words_of(nodes: DataFrame) -> DataFrame:
            wanted = materialize(nodes.join(other.select("node", F.col("id").alias("_i")).filter("node IS NOT NULL"), "node", "left").select(
                F.coalesce("_i", "node").alias("id")), "omh_aligned")
            words = maybe_in(docs.select("id", "text"), wanted, "id").select("id", F.xxhash64("text").alias("tx"), "text")
            words = words.mapInArrow(word_batches, "id long, tx long, words binary")
            return bucketed(named(words, other).select("node", "words"), "omh_words").dropDuplicates(["node"])

        groups = components(links(texts, words_of))
        known = texts.select("node", "id", "copy").join(groups, "node", "left").withColumn(
            "component", F.coalesce("component", "node"))
        least = materialize(known.groupBy("component").agg(F.min("id").alias("class_id")), "omh_least")
        known = known.join(least, "component").select("copy", "component", "class_id")
        return ids.join(known, "copy").select("id", "tx", "component", "class_id")

    with small_batches(spark):
        return settled(spark, "omh_result", make)


def working_id() -> Column:
    """doc_id, or a negative stand-in made from the text for null."""
    return F.coalesce(F.col("doc_id").cast("long"), -F.abs(F.shiftright(F.xxhash64("text"), 1)) - 1)


def keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("id", working_id())


def near_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id and class_id, the least doc_id of its class."""
    return classes(keyed(only(docs, "doc_id", "text"))).select(F.col("id").alias("doc_id"), "class_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """One document per class, the one with the least doc_id, with its own
    columns; of one id with several texts in the class one stays, and repeated rows of
    it collapse."""
    rows = with_row(docs, "doc_id", "text").withColumn("id", working_id())
    found = classes(rows)
    kept = found.filter("id = class_id").groupBy("component").agg(
        F.min(F.struct("id", "tx")).alias("k")).select("k.*")
    # The only row of an id that is its class's stays where it is; the others are
    # looked up, which moves them.
    open_ids = materialize(found.groupBy("id").agg(F.count("*").alias("_c"), F.max("class_id").alias("_k")).filter(
        "_c > 1 OR id <> _k").select("id"), "omh_open_ids")
    rows = with_maybe_in(rows.select("id", F.xxhash64("text").alias("tx"), "row"), open_ids, "id", "_open")
    moved = rows.filter("_open").join(kept, ["id", "tx"], "left_semi").dropDuplicates(["id", "tx"])
    return rows.filter("NOT _open").select("row.*").unionByName(moved.select("row.*"))

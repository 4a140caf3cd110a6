"""The prefix trie of conversations, built from adaptive radix trees.

A turn is named by the first 16 bytes of a SHA-256 over its role and text, read
as a big-endian number of fixed width, so a conversation is a byte string of 16
bytes per turn and a prefix of turns is a prefix of bytes. Each task enters its
share of the conversations into a radix tree (``radix_tree``) and reads the trie
off it: only byte depths that are a multiple of 16 are nodes, and a compressed
path stands for a chain of them with the same members.

Trees of different tasks overlap in their upper nodes, so everything a tree tells
adds up: members and least members first; then, when every node knows its
members and children, its own value is entered once, at its least member, and a
second pass over the trees sums values over subtrees. Both passes end in a
partial aggregation by node, so a first turn that a third of all conversations
share is one row per tree. A tree is read off and begun anew at ``TREE_BYTES`` of
keys. Texts are left behind when turns are named: only names, lengths and
numbers travel.

The ids of one conversation (20 bytes per turn) meet in one task, as its key is one
byte string.

Defined results: a null role or text is empty; turns go by number, null first,
equal numbers by the turn's name; rows without a conv_id belong to no
conversation and are left
out; repeated rows are turns of their own; an empty text is a turn of no code
points; an empty table has no nodes; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from reelstack.llm.common import only, text_or_empty
from reelstack.llm.radix_tree import RadixTree
from reelstack.session import materialize, shuffle_partitions

WIDTH = 16
# Bytes of keys in one tree before it is read off.
TREE_BYTES = 2 << 20
# Code points of ids hashed at once.
CHUNK = 1 << 16
ROOT = b"\0" * WIDTH

# Fixed values of the query's contract: conversations share the first turns of
# the conversation at the last round number, fewer than SHARED of them.
ROUND, SHARED = 100, 6


def turn_name() -> Column:
    """16 bytes that name a role and a text; the role's length keeps them apart."""
    role, text = text_or_empty("role"), text_or_empty("text")
    named = F.sha2(F.concat_ws(":", F.length(role).cast("string"), F.concat(role, text)), 256)
    return F.substring(F.unhex(named), 1, WIDTH)


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns' names and code points in order."""
    rows = only(conversations, "conv_id", "turn", "role", "text").filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        turn_name().alias("name"), F.length(text_or_empty("text")).alias("size"))
    ordered = F.array_sort(F.collect_list(F.struct("turn", "name", "size")))
    return rows.groupBy("conv_id").agg(ordered.alias("t")).select(
        "conv_id", F.transform("t", lambda t: F.struct(t["name"].alias("name"), t["size"].alias("size"))).alias("turns"))


def rebuilt(seqs: DataFrame) -> DataFrame:
    """Sequences that begin with turns of the conversation at the last round
    number: its first h turns, then the conversation's own after its first h."""
    h = (F.crc32(F.col("conv_id").cast("string")) % SHARED).cast("int")
    heads = seqs.filter(F.col("conv_id") % ROUND == 0).select(
        F.col("conv_id").alias("head_id"), F.slice("turns", 1, SHARED - 1).alias("head"))
    own = seqs.select("conv_id", "turns", (F.col("conv_id") - F.col("conv_id") % ROUND).alias("head_id"), h.alias("h"))
    none = F.expr("array()").cast("array<struct<name: binary, size: int>>")
    head = F.slice(F.coalesce("head", none), F.lit(1), F.col("h"))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return own.join(heads, "head_id", "left").select("conv_id", F.concat(head, rest).alias("turns"))


def keys(seqs: DataFrame) -> DataFrame:
    """(conv_id, names, sizes) of sequences."""
    return seqs.select("conv_id", F.transform("turns", lambda t: t["name"]).alias("names"),
                       F.transform("turns", lambda t: t["size"]).alias("sizes"))


def chain(above: bytes, name: bytes) -> bytes:
    """The id of the node that ``name`` leads to from the node ``above``."""
    return hashlib.blake2b(above + name, digest_size=WIDTH).digest()


def trees(batches):
    """Trees of about TREE_BYTES over (conv_id, names, sizes, ...) batches, with
    (turns, columns after those three) of every conversation in them."""
    tree, held, size = RadixTree(), {}, 0
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for conv_id, names, sizes, *more in zip(*columns):
            key = b"".join(names)
            tree.insert(key, conv_id, (key, sizes))
            held[conv_id] = (len(names), *more)
            size += len(key) + 64
            if size >= TREE_BYTES:
                yield tree, held
                tree, held, size = RadixTree(), {}, 0
    if tree.root.n:
        yield tree, held


def aligned(tree: RadixTree):
    """Per radix node: (node, its parent's place, [(id, id above, depth in
    turns)]), the turn-aligned depths on its path from the top down."""
    last: list[bytes] = []
    for node, above in tree.walk():
        if above < 0:
            last.append(ROOT)
            yield node, above, [(ROOT, None, 0)]
            continue
        key, _ = node.sample
        at, found = last[above], []
        start = node.depth - len(node.path)
        for depth in range(start // WIDTH + 1, node.depth // WIDTH + 1):
            below = chain(at, key[(depth - 1) * WIDTH:depth * WIDTH])
            found.append((below, at, depth))
            at = below
        last.append(at)
        yield node, above, found


def batches_of(rows, schema: pa.Schema, limit: int = 8192):
    part = []
    for row in rows:
        part.append(row)
        if len(part) == limit:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)
            part = []
    if part:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)


def node_batches(batches):
    """Conversations to (id, above, depth, size, n, least) of their trees' nodes."""
    schema = pa.schema([("id", pa.binary()), ("above", pa.binary()), ("depth", pa.int64()), ("size", pa.int64()),
                        ("n", pa.int64()), ("least", pa.int64())])

    def rows():
        for tree, _ in trees(batches):
            for node, _, found in aligned(tree):
                for own, above, depth in found:
                    size = node.sample[1][depth - 1] if depth else 0
                    yield own, above, depth, size, node.n, node.least
    return batches_of(rows(), schema)


def sum_batches(batches):
    """(conv_id, names, sizes, values, leaf) to (id, leaves, saved): per node
    of a tree, the sums over its subtree there. ``values`` are the saved code points of the
    nodes that have this conversation as least member, the deepest last."""
    schema = pa.schema([("id", pa.binary()), ("leaves", pa.int64()), ("saved", pa.int64())])

    def rows():
        for tree, held in trees(batches):
            nodes = list(aligned(tree))
            leaves, saved = [0] * len(nodes), [0] * len(nodes)
            for place in range(len(nodes) - 1, -1, -1):
                node, above, found = nodes[place]
                turns, values, leaf = held[node.least]
                first = turns + 1 - len(values or ())
                for own, _, depth in reversed(found):
                    if depth >= first:
                        saved[place] += values[depth - first]
                        leaves[place] += int(leaf and depth == turns)
                    yield own, leaves[place], saved[place]
                if above >= 0:
                    leaves[above] += leaves[place]
                    saved[above] += saved[place]
    return batches_of(rows(), schema)


def end_batches(batches):
    """(conv_id, names) to (id, conv_id) of the node a conversation ends at."""
    for batch in batches:
        ids = []
        for names in batch.column(1).to_pylist():
            at = ROOT
            for name in names:
                at = chain(at, name)
            ids.append(at)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), batch.column(0)], names=["id", "conv_id"])


def text_batches(batches):
    """Sorted (id, conv_id) to (id, first, ids): runs of ids as comma-joined text."""
    schema = pa.schema([("id", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])

    def rows():
        at, first, parts, size = None, 0, [], 0
        for batch in batches:
            for own, conv_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if parts and (own != at or size > CHUNK):
                    yield at, first, ",".join(parts)
                    parts, size = [], 0
                if not parts:
                    at, first = own, conv_id
                parts.append(str(conv_id))
                size += len(parts[-1]) + 1
        if parts:
            yield at, first, ",".join(parts)
    return batches_of(rows(), schema, 256)


def digest_batches(batches):
    """Sorted (id, first, ids) to (id, ends_sha256), one running digest at a time."""
    schema = pa.schema([("id", pa.binary()), ("ends_sha256", pa.string())])

    def rows():
        at, digest = None, None
        for batch in batches:
            for own, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if digest is not None and own == at:
                    digest.update(b"," + ids.encode())
                    continue
                if digest is not None:
                    yield at, digest.hexdigest()
                at, digest = own, hashlib.sha256(ids.encode())
        if digest is not None:
            yield at, digest.hexdigest()
    return batches_of(rows(), schema)


def ends(found: DataFrame) -> DataFrame:
    """(id, ends_sha256) of the nodes where conversations end. Ids are range
    partitioned and sorted, joined to text there, and each node's texts hashed in
    order: the digest is the one step that takes a node's ids one after another."""
    n = shuffle_partitions(found.sparkSession)
    sorted_ends = found.repartitionByRange(n, "id", "conv_id").sortWithinPartitions("id", "conv_id")
    texts = sorted_ends.mapInArrow(text_batches, "id binary, first long, ids string")
    return (texts.repartition(n, "id").sortWithinPartitions("id", "first")
            .mapInArrow(digest_batches, "id binary, ends_sha256 string"))


def prefix_trie(seqs: DataFrame) -> DataFrame:
    """The trie's nodes of sequences (conv_id, turns): conv_id (least member),
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and
    ends_sha256."""
    held = materialize(keys(seqs), "trie_keys")
    nodes = materialize(
        held.mapInArrow(node_batches, "id binary, above binary, depth long, size long, n long, least long")
        .groupBy("id", "above", "depth", "size").agg(F.sum("n").alias("n"), F.min("least").alias("least")), "trie_nodes")
    kids = materialize(nodes.filter("above is not null").groupBy("above").agg(F.count("*").alias("kids")), "trie_kids")
    nodes_kids = nodes.join(kids.withColumnRenamed("above", "id"), "id", "left").withColumn(
        "kids", F.coalesce("kids", F.lit(0).cast("long")))
    full = materialize(nodes_kids, "trie_full")
    # What a node itself saves, at its least member; these are the last nodes of
    # that member's path, as members only get fewer on the way down.
    own = full.groupBy("least").agg(
        F.array_sort(F.collect_list(F.struct("depth", ((F.col("n") - 1) * F.col("size")).alias("v"),
                                             (F.col("kids") == 0).alias("leaf")))).alias("own")).select(
        F.col("least").alias("conv_id"), F.transform("own", lambda o: o["v"]).alias("values"),
        F.element_at("own", -1)["leaf"].alias("leaf"))
    sums = (held.join(own, "conv_id", "left").select("conv_id", "names", "sizes", "values", "leaf")
            .mapInArrow(sum_batches, "id binary, leaves long, saved long")
            .groupBy("id").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens")))
    ended = materialize(held.select("conv_id", "names").mapInArrow(end_batches, "id binary, conv_id long"), "trie_ends")
    parents = nodes.select(F.col("id").alias("above"), F.col("least").alias("parent_conv_id"))
    nothing = hashlib.sha256(b"").hexdigest()
    return (full.join(parents, "above", "left").join(sums, "id").join(ends(ended), "id", "left").select(
        F.col("least").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"),
        F.col("kids").alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256")))

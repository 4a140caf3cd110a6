"""Near-duplicate vectors by a PCA-ordered, tiled comparison.

Vectors of one label and one length are compared exactly, by cosine in double
precision. The principal directions of all vectors (sums of products over every
row, merged by Spark) give an orthonormal frame whose leading coordinates carry
most of a product:

* rows are range partitioned by label and by a code of their leading
  coordinates, and cut to blocks; blocks whose coordinates lie further apart than
  the threshold allows are never paired;
* a pair of blocks is worked off tile by tile. A tile is a ball (centre, radius):
  tiles too far apart are skipped, tiles so close that every pair must link are
  counted without a comparison, so thousands of near copies cost no pairs;
* for other tiles the products of the leading coordinates are taken first; what
  the rest can add is at most the product of the two suffix norms, and a pair stops
  as soon as it cannot reach the threshold. What is left is decided by the whole
  cosine.

Pairs are never emitted: a pair of blocks gives at most one row per vector, with
its number of links there and the least vector it hangs together with. Links are
summed and components closed by ``graph.components``.

The frame only steers the pruning, which leaves a margin of ``EPS``; a length
without a frame (beyond the ``FRAMES`` most frequent ones, or over ``FRAME_DIM``)
uses its first coordinates as they are. What the driver sees is one frame of LEAD directions
per such length.

Defined results: a null, zero or empty vector, one that holds a null, NaN or
infinite component, and one without a label link with nothing, nor do vectors of
different lengths; every row counts as a vector of its own, repeated rows and
repeated ids included, so copies link; a null vec_id never names a component
(unless the component holds no other id) and is never kept; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reelstack.llm.common import only
from reelstack.llm.graph import components
from reelstack.session import materialize, shuffle_partitions

THRESHOLD = 0.98
# Leading coordinates kept; the first FIRST are multiplied for whole tiles.
LEAD, FIRST = 32, 16
# Coordinates in the sort code, and the bins of each in standard deviations.
CODED = 8
BINS = (-1.15, -0.67, -0.32, 0.0, 0.32, 0.67, 1.15)
TILE = 256
BLOCK_BYTES = 4 << 20
# Lengths that get a frame: the most frequent ones up to FRAME_DIM components.
FRAMES = 16
FRAME_DIM = 2048
EPS = 1e-9

BLOCK_SCHEMA = ("label {label}, dim int, block long, n int, ids binary, id_null binary, vectors binary, "
                "low array<double>, high array<double>")


def reach(threshold: float) -> float:
    """Largest distance of two unit vectors whose cosine is ``threshold``."""
    return math.sqrt(max(0.0, 2 - 2 * threshold))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows as unit vectors; scaled by the largest component first, so that
    squares neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def usable(lists: pa.Array) -> list[np.ndarray | None]:
    """The vectors of a list column; None where one links with nothing."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    offsets = np.asarray(lists.offsets)
    values = lists.values.to_numpy(zero_copy_only=False)
    out: list[np.ndarray | None] = []
    for i, null in enumerate(lists.is_null().to_pylist()):
        v = values[offsets[i]:offsets[i + 1]]
        good = not null and len(v) > 0 and np.isfinite(v).all() and v.any()
        out.append(v if good else None)
    return out


# ------------------------------------------------------------------- the frame


def moment_batches(batches):
    """(label, vector) to sums of products of unit vectors, one upper triangle
    per length and task: (dim, at, s), with the number of vectors at -1."""
    sums: dict[int, np.ndarray] = {}
    counts: dict[int, int] = {}
    for batch in batches:
        labels = batch.column(0).is_valid().to_pylist()
        by_dim: dict[int, list] = {}
        for ok, v in zip(labels, usable(batch.column(1))):
            if ok and v is not None:
                by_dim.setdefault(len(v), []).append(v)
        for dim, rows in by_dim.items():
            x = unit(np.asarray(rows, np.float64))
            sums[dim] = sums.get(dim, 0) + x.T @ x
            counts[dim] = counts.get(dim, 0) + len(rows)
    for dim, s in sums.items():
        at = np.triu_indices(dim)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(len(at[0]) + 1, dim, np.int32)),
            pa.array(np.concatenate([[-1], at[0] * dim + at[1]]).astype(np.int64)),
            pa.array(np.concatenate([[float(counts[dim])], s[at]]))], names=["dim", "at", "s"])


def principal(group: pd.DataFrame) -> pd.DataFrame:
    """One length's summed products to its leading directions and their spreads."""
    dim = int(group["dim"].iloc[0])
    at, s = group["at"].to_numpy(), group["s"].to_numpy()
    n, at, s = s[at < 0][0], at[at >= 0], s[at >= 0]
    m = np.zeros((dim, dim))
    m[at // dim, at % dim] = s
    m = m + np.triu(m, 1).T
    values, vectors = np.linalg.eigh(m / n)
    order = np.argsort(values)[::-1][:LEAD]
    return pd.DataFrame({"dim": [dim], "n": [int(n)], "frame": [np.ascontiguousarray(vectors[:, order]).tobytes()],
                         "spread": [np.sqrt(np.maximum(values[order], 1e-12)).tobytes()]})


def frames(vectors: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Leading directions and spreads of the most frequent lengths. A task sums one
    square matrix for each of them."""
    size = F.size("embedding")
    lengths = (vectors.filter(F.col("label").isNotNull() & size.between(1, FRAME_DIM)).groupBy(size.alias("dim"))
               .agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").limit(FRAMES).collect())
    if not lengths:
        return {}
    vectors = vectors.filter(size.isin([r.dim for r in lengths]))
    moments = (vectors.mapInArrow(moment_batches, "dim int, at long, s double")
               .groupBy("dim", "at").agg(F.sum("s").alias("s")))
    found = moments.groupBy("dim").applyInPandas(principal, "dim int, n long, frame binary, spread binary").collect()
    return {r.dim: (np.frombuffer(r.frame).reshape(r.dim, -1), np.frombuffer(r.spread)) for r in found}


def frame_of(given: dict, dim: int) -> tuple[np.ndarray, np.ndarray]:
    if dim in given:
        return given[dim]
    k = min(dim, LEAD)
    return np.eye(dim, k), np.full(k, 1 / math.sqrt(dim))


# ------------------------------------------------------------------ the blocks


def code_of(lead: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Interleaved bins of the first coordinates, coarse bits of all of them first."""
    k = min(CODED, lead.shape[1])
    bins = np.searchsorted(BINS, lead[:, :k] / spread[:k])
    code = np.zeros(len(lead), np.int64)
    for bit in (2, 1, 0):
        for j in range(k):
            code = (code << 1) | ((bins[:, j] >> bit) & 1)
    return code


def coder(given: dict, dtype: str):
    def code_batches(batches):
        """(vec_id, label, vector) to (vec_id, label, dim, code, vector bytes);
        dim is 0 for vectors that link with nothing."""
        for batch in batches:
            labels = batch.column(1).is_valid().to_pylist()
            vectors = [v if ok else None for ok, v in zip(labels, usable(batch.column(2)))]
            dims = np.array([0 if v is None else len(v) for v in vectors], np.int32)
            codes = np.zeros(len(vectors), np.int64)
            for dim in set(dims.tolist()) - {0}:
                at = np.flatnonzero(dims == dim)
                frame, spread = frame_of(given, dim)
                codes[at] = code_of(unit(np.asarray([vectors[i] for i in at], np.float64)) @ frame, spread)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(dims), pa.array(codes),
                pa.array([b"" if v is None else v.astype(dtype).tobytes() for v in vectors], pa.binary())],
                names=["vec_id", "label", "dim", "code", "vector"])
    return code_batches


def coordinates(x: np.ndarray, frame: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Leading coordinates, and the norms of what follows the first FIRST and
    all of them."""
    lead = x @ frame
    left = lambda k: np.sqrt(np.maximum(0.0, 1 - np.einsum("ij,ij->i", lead[:, :k], lead[:, :k])))
    return lead, left(FIRST), left(lead.shape[1])


def blocker(given: dict, dtype: str):
    def block_batches(batches):
        """Sorted (vec_id, label, dim, vector) rows to blocks. Node numbers are
        the task's number and the row's place in it."""
        from pyspark import TaskContext
        node = TaskContext.get().partitionId() << 33
        open_rows: list = []
        size, group, first = 0, None, node

        def close():
            label, dim = group
            ids = [r[0] for r in open_rows]
            raw = b"".join(r[1] for r in open_rows)
            low = high = []
            if dim:
                frame, _ = frame_of(given, dim)
                lead, _, rest = coordinates(unit(np.frombuffer(raw, dtype).reshape(-1, dim).astype(np.float64)), frame)
                box = np.column_stack([lead, rest])
                low, high = box.min(axis=0).tolist(), box.max(axis=0).tolist()
            return (label, dim, first, len(ids), np.array([i or 0 for i in ids], np.int64).tobytes(),
                    np.array([i is None for i in ids], np.uint8).tobytes(), raw, low, high)

        def batch_of(rows):
            types = [label_type, pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(),
                     pa.list_(pa.float64()), pa.list_(pa.float64())]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                              names=["label", "dim", "block", "n", "ids", "id_null", "vectors", "low", "high"])

        for batch in batches:
            label_type = batch.schema.field("label").type
            for vec_id, label, dim, vector in zip(*[batch.column(c).to_pylist()
                                                    for c in ("vec_id", "label", "dim", "vector")]):
                if open_rows and ((label, dim) != group or size + len(vector) + 16 > BLOCK_BYTES):
                    yield batch_of([close()])
                    open_rows, size, first = [], 0, node
                group = (label, dim)
                open_rows.append((vec_id, vector))
                size += len(vector) + 16
                node += 1
        if open_rows:
            yield batch_of([close()])
    return block_batches


# -------------------------------------------------------------- the comparison


class Tiles:
    """One block: unit vectors, leading coordinates, and the balls of its tiles."""

    def __init__(self, raw: bytes, dim: int, first: int, dtype: str, frame: np.ndarray):
        self.x = unit(np.frombuffer(raw, dtype).reshape(-1, dim).astype(np.float64))
        self.first = first
        self.lead, self.after_first, self.after_lead = coordinates(self.x, frame)
        self.starts = list(range(0, len(self.x), TILE))
        parts = [self.x[s:s + TILE] for s in self.starts]
        self.centres = np.array([p.mean(axis=0) for p in parts])
        self.radii = np.array([np.sqrt(((p - c) ** 2).sum(axis=1).max()) for p, c in zip(parts, self.centres)])

    def rows(self, tile: int) -> slice:
        return slice(self.starts[tile], self.starts[tile] + TILE)


def linked(a: Tiles, b: Tiles, i: slice, j: slice, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places (in the tiles) of the pairs whose cosine reaches the threshold."""
    bound = a.lead[i, :FIRST] @ b.lead[j, :FIRST].T + np.multiply.outer(a.after_first[i], b.after_first[j])
    u, v = np.nonzero(bound >= threshold - EPS)
    if len(u) * 8 > bound.size:
        return np.nonzero(a.x[i] @ b.x[j].T >= threshold)
    if len(u):
        lead = np.einsum("ij,ij->i", a.lead[i][u], b.lead[j][v]) + a.after_lead[i][u] * b.after_lead[j][v]
        u, v = u[lead >= threshold - EPS], v[lead >= threshold - EPS]
    if len(u):
        cos = np.einsum("ij,ij->i", a.x[i][u], b.x[j][v])
        u, v = u[cos >= threshold], v[cos >= threshold]
    return u, v


class Forest:
    """Least member of every group of places, merged as links come in."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def join(self, u: np.ndarray, v: np.ndarray) -> None:
        while True:
            ru, rv = self.parent[u], self.parent[v]
            differ = ru != rv
            if not differ.any():
                return
            u, v, ru, rv = u[differ], v[differ], ru[differ], rv[differ]
            np.minimum.at(self.parent, np.maximum(ru, rv), np.minimum(ru, rv))
            while True:
                up = self.parent[self.parent]
                if np.array_equal(up, self.parent):
                    break
                self.parent = up


def compare(a: Tiles, b: Tiles, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, links, root) of the vectors of two blocks (or of one, given
    twice) that link there."""
    same = a is b
    shift = 0 if same else len(a.x)
    links = np.zeros(len(a.x) + (0 if same else len(b.x)), np.int64)
    forest = Forest(len(links))
    far = reach(threshold)
    for ti in range(len(a.starts)):
        i = a.rows(ti)
        gap = np.sqrt(np.maximum(0.0, ((b.centres - a.centres[ti]) ** 2).sum(axis=1)))
        near = np.flatnonzero(gap - b.radii - a.radii[ti] <= far + EPS)
        for tj in near[near >= ti] if same else near:
            j = b.rows(int(tj))
            at_i, at_j = np.arange(i.start, min(i.stop, len(a.x))), np.arange(j.start, min(j.stop, len(b.x))) + shift
            itself = same and ti == tj
            if gap[tj] + a.radii[ti] + b.radii[tj] < far - EPS:
                # Every pair of the two balls links.
                links[at_i] += len(at_j) - itself
                if not itself:
                    links[at_j] += len(at_i)
                forest.join(np.concatenate([at_i, at_j]), np.full(len(at_i) + len(at_j), at_i[0]))
                continue
            u, v = linked(a, b, i, j, threshold)
            if itself:
                u, v = u[u != v], v[u != v]
            if len(u):
                links[at_i] += np.bincount(u, minlength=len(at_i))
                if not itself:
                    links[at_j] += np.bincount(v, minlength=len(at_j))
                forest.join(at_i[u], at_j[v])
    nodes = a.first + np.arange(len(a.x))
    if not same:
        nodes = np.concatenate([nodes, b.first + np.arange(len(b.x))])
    some = links > 0
    return nodes[some], links[some], nodes[forest.parent[some]]


def comparer(given: dict, dtype: str, threshold: float):
    def compare_batches(batches):
        """(dim, block, vectors[, other block, its vectors]) to (node, links, root)."""
        for batch in batches:
            for row in range(batch.num_rows):
                dim, first, raw, *other = [batch.column(c)[row].as_py() for c in range(batch.num_columns)]
                frame, _ = frame_of(given, dim)
                a = Tiles(raw, dim, first, dtype, frame)
                b = Tiles(other[1], dim, other[0], dtype, frame) if other else a
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in compare(a, b, threshold)],
                                                 names=["node", "links", "root"])
    return compare_batches


def block_pairs(blocks: DataFrame, threshold: float) -> DataFrame:
    """(a, b) of different blocks of one label whose boxes lie near enough. Which
    of the two is a follows a hash, so that no block is the a of all its pairs."""
    meta = blocks.filter("dim > 0").select("label", "dim", "block", "low", "high")
    other = meta.select("label", "dim", *[F.col(c).alias(f"{c}_2") for c in ("block", "low", "high")])
    apart = F.zip_with(
        F.arrays_zip(F.col("low").alias("l"), F.col("high").alias("h")),
        F.arrays_zip(F.col("low_2").alias("l"), F.col("high_2").alias("h")),
        lambda p, q: F.greatest(F.lit(0.0), p["l"] - q["h"], q["l"] - p["h"]))
    square = F.aggregate(apart, F.lit(0.0), lambda s, g: s + g * g)
    near = (meta.join(other, ["label", "dim"]).filter("block < block_2")
            .filter(square <= F.lit(2 - 2 * threshold + EPS)))
    turn = F.xxhash64("block", "block_2") % 2 == 0
    return near.select(F.when(turn, F.col("block")).otherwise(F.col("block_2")).alias("a"),
                       F.when(turn, F.col("block_2")).otherwise(F.col("block")).alias("b"))


def vector_links(embeddings: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(node, vec_id) of every row, and (node, links, root) parts of the links."""
    spark = embeddings.sparkSession
    rows = only(embeddings, "vec_id", "label", "embedding")
    types = {f.name: f.dataType for f in rows.schema}
    dtype = "<f4" if types["embedding"].elementType.simpleString() == "float" else "<f8"
    label = types["label"].simpleString()
    if dtype == "<f8":
        rows = rows.withColumn("embedding", F.col("embedding").cast("array<double>"))
    rows = rows.withColumn("vec_id", F.col("vec_id").cast("long"))
    given = frames(rows.select("label", "embedding"))
    coded = rows.mapInArrow(coder(given, dtype), f"vec_id long, label {label}, dim int, code long, vector binary")
    total = rows.select(F.sum(F.size("embedding")).alias("n")).first().n or 0
    n = max(1, math.ceil(total * int(dtype[2]) / BLOCK_BYTES))
    order = ["label", "dim", "code", "vec_id"]
    spread = coded.withColumn("tie", F.xxhash64("vec_id", "vector"))
    sorted_rows = spread.repartitionByRange(n, *order, "tie").sortWithinPartitions(*order, "tie")
    blocks = materialize(sorted_rows.select("vec_id", "label", "dim", "vector")
                         .mapInArrow(blocker(given, dtype), BLOCK_SCHEMA.format(label=label)), "vec_blocks")
    run = comparer(given, dtype, threshold)
    schema = "node long, links long, root long"
    inside = blocks.filter("dim > 0").select("dim", "block", "vectors").mapInArrow(run, schema)
    pairs = materialize(block_pairs(blocks, threshold), "vec_pairs")
    parts = shuffle_partitions(spark)
    vectors = blocks.select("dim", "block", "vectors")
    left = pairs.join(vectors.withColumnRenamed("block", "a"), "a").repartition(parts, "b")
    right = vectors.select(F.col("block").alias("b"), F.col("vectors").alias("vectors_b")).repartition(parts, "b")
    across = left.join(right, "b").select("dim", "a", "vectors", "b", "vectors_b").mapInArrow(run, schema)
    found = materialize(inside.unionByName(across), "vec_links")
    return blocks.select("block", "n", "ids", "id_null"), found


def id_batches(batches):
    """(first node, ids) of blocks to (node, vec_id)."""
    for batch in batches:
        for first, _, ids, null in zip(*[c.to_pylist() for c in batch.columns]):
            ids = np.frombuffer(ids, np.int64)
            mask = np.frombuffer(null, np.uint8).astype(bool)
            yield pa.RecordBatch.from_arrays([pa.array(first + np.arange(len(ids))), pa.array(ids, mask=mask)],
                                             names=["node", "vec_id"])


def embedding_dedup(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``embeddings`` (vec_id, embedding, label): vec_id,
    n_links, component_id and kept (see the module's text)."""
    blocks, found = vector_links(embeddings, threshold)
    nodes = blocks.mapInArrow(id_batches, "node long, vec_id long")
    linked_nodes = nodes.join(found.groupBy("node").agg(F.sum("links").alias("n_links")), "node")
    groups = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    linked_nodes = materialize(linked_nodes.join(groups, "node"), "vec_groups")
    least = materialize(linked_nodes.groupBy("component").agg(F.min("vec_id").alias("least")), "vec_least")
    named = linked_nodes.join(least, "component").select("node", "n_links", "least")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("least"))
    return nodes.join(named, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))

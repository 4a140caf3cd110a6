"""Mixing sources to target weights by pivotal dependent rounding.

Each source has a target number of words; a document of the source is wanted
``target / source_size`` times on average. The whole part is taken for sure.
The fractional parts are rounded in pairs: mass (words) moves at random from
one document of the pair to the other until one of them is integral, keeping
the expected copies of each document and the words of the pair. Pairs are
worked off inside groups of about ``ARITY`` documents, each group hands one
fractional document on, and the next level groups those: a reduction tree whose
tasks are bounded and whose last document alone is rounded freely. So a source
ends within one document of its target.

All draws are hashes of the document's key, so reruns and recomputed tasks
agree. Defined results: null or blank text has size 0 and is never taken; a
null source is a source of its own, last in order; rows with the same doc_id,
source and size are rounded together exactly; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from reelstack.llm.common import only, unit_random, words
from reelstack.session import materialize

# Fixed values of the contract.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_COPIES = 2.0
# Documents that one group of the tree rounds, on average.
ARITY = 256


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE,
                   most: float = MOST_COPIES) -> DataFrame:
    """One row per source: its size, number of rows and target. Weighted
    filling with a ceiling per source: sources are ordered by ceiling per unit
    of weight; below the level all are full, above it all get level x weight."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), (rank - 1) % len(weights))
    per = per.select("*", weight.alias("weight"), (most * F.col("source_size")).alias("ceiling"))
    by_ratio = Window.orderBy(F.col("ceiling") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = F.coalesce(F.sum("ceiling").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(everything) * share
    per = per.select("*", ((total - before) / rest).alias("_level"))
    level = F.max(F.when(F.col("ceiling") >= F.col("_level") * F.col("weight"), F.col("_level")))
    return per.select("source", "source_size", "n", F.least(
        "ceiling", F.col("weight") * F.coalesce(level.over(everything), F.lit(0.0))).alias("target"))


def pivot(left: Column, right: Column) -> tuple[Column, Column]:
    """One step on two fractional documents: (decided, still open)."""
    mass_l, room_l = left["p"] * left["size"], (1 - left["p"]) * left["size"]
    mass_r, room_r = right["p"] * right["size"], (1 - right["p"]) * right["size"]
    to_left, to_right = F.least(room_l, mass_r), F.least(mass_l, room_r)
    go_left = right["u"] * (to_left + to_right) < to_right
    with_p = lambda x, p: F.struct(x["doc_id"].alias("doc_id"), x["size"].alias("size"),
                                   p.alias("p"), x["u"].alias("u"))
    settle = lambda x, hit: F.struct(x["doc_id"].alias("doc_id"), x["size"].alias("size"),
                                     F.lit(hit).alias("hit"))
    left_ends = F.when(go_left, room_l <= mass_r).otherwise(mass_l <= room_r)
    decided = (F.when(left_ends & go_left, settle(left, 1)).when(left_ends, settle(left, 0))
               .when(go_left, settle(right, 0)).otherwise(settle(right, 1)))
    clip = lambda p: F.greatest(F.lit(0.0), F.least(F.lit(1.0), p))
    right_p = clip(right["p"] + F.when(go_left, -to_left).otherwise(to_right) / right["size"])
    left_p = clip(left["p"] + F.when(go_left, to_left).otherwise(-to_right) / left["size"])
    return decided, F.when(left_ends, with_p(right, right_p)).otherwise(with_p(left, left_p))


def round_groups(open_rows: DataFrame, level: int, seed: int) -> DataFrame:
    """One level of the tree: per (source, group) the documents that became
    integral and the one that is still open."""
    key = [F.lit(seed), F.lit(level), F.col("doc_id"), F.col("size"), F.col("source")]
    doc = F.struct(unit_random(*key, F.lit("order")).alias("o"), "doc_id", "size", "p",
                   unit_random(*key, F.lit("draw")).alias("u"))
    groups = F.greatest(F.lit(1), F.ceil(F.col("n") / F.lit(ARITY))).cast("long")
    rows = open_rows.select("source", groups.alias("n"), doc.alias("d"),
                            F.pmod(F.xxhash64(*key), groups).alias("g"))
    rows = rows.groupBy("source", "n", "g").agg(F.sort_array(F.collect_list("d")).alias("ds"))
    state = "struct<r:struct<doc_id:bigint,size:bigint,p:double,u:double>," \
            "out:array<struct<doc_id:bigint,size:bigint,hit:int>>>"

    def step(acc, d):
        item = F.struct(d["doc_id"].alias("doc_id"), d["size"].alias("size"), d["p"].alias("p"), d["u"].alias("u"))
        decided, left = pivot(acc["r"], item)
        return F.when(acc["r"].isNull(), F.struct(item.alias("r"), acc["out"].alias("out"))).otherwise(
            F.struct(left.alias("r"), F.concat(acc["out"], F.array(decided)).alias("out"))).cast(state)

    start = F.struct(F.lit(None).alias("r"), F.array().alias("out")).cast(state)
    return rows.select("source", "n", F.aggregate("ds", start, step).alias("s")).select(
        "source", "n", "s.r", "s.out")


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE,
        most: float = MOST_COPIES, seed: int = 0) -> DataFrame:
    """doc_id, source, size, source_size, target and taken of every row."""
    sizes = materialize(only(docs, "doc_id", "source", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), "source",
        F.size(words()).cast("long").alias("size")), "mix_sizes")
    targets = materialize(source_targets(sizes, weights, share, most), "mix_targets")
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = targets.select("*", F.floor(wanted).alias("whole"), (wanted - F.floor(wanted)).alias("part"))
    side = targets.withColumnRenamed("source", "_source")
    on_source = lambda df: df.join(side, df["source"].eqNullSafe(side["_source"])).drop("_source")

    # Equal rows (same key and size) exchange mass among themselves first:
    # of m rows floor(m * part) get one more copy and at most one stays open.
    alike = on_source(sizes.groupBy("source", "doc_id", "size").agg(F.count("*").alias("m")))
    more = F.floor(F.col("m") * F.col("part"))
    alike = alike.select("source", "doc_id", "size", "n", "m", more.alias("more"),
                         F.when(F.col("size") > 0, F.col("m") * F.col("part") - more).otherwise(0.0).alias("p"))
    alike = materialize(alike, "mix_alike")
    open_rows = alike.filter("p > 0").select("source", "doc_id", "size", "n", "p")

    most_rows = targets.agg(F.max("n")).first()[0] or 1
    levels = max(1, math.ceil(math.log(most_rows, ARITY)))
    hits = []
    for level in range(levels):
        done = materialize(round_groups(open_rows, level, seed), f"mix_level_{level}")
        hits.append(done.select("source", F.inline("out")))
        open_rows = done.filter("r is not null").select("source", "r.doc_id", "r.size", "n", "r.p")
    # The last level leaves one document per source, the top of the tree: it goes
    # to the nearer side, so a source ends within half a document of its target.
    hits.append(open_rows.select("source", "doc_id", "size",
                                 (F.col("p") >= 0.5).cast("int").alias("hit")))
    extra = hits[0]
    for h in hits[1:]:
        extra = extra.unionByName(h)
    # Bring the draws back to the groups of equal rows by one aggregation.
    rounded = alike.select("source", "doc_id", "size", "m", "more").unionByName(
        extra.select("source", "doc_id", "size", F.lit(0).cast("long").alias("m"),
                     F.col("hit").cast("long").alias("more")))
    rounded = on_source(rounded.groupBy("source", "doc_id", "size").agg(
        F.sum("m").alias("m"), F.sum("more").alias("more")))
    copies = F.col("whole") + (F.col("k") <= F.col("more")).cast("long")
    # Copies of one row are unfolded in blocks, so no array grows with them.
    block = 4096
    rounded = rounded.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("m") - 1) / block)))
                             .alias("b"))
    rounded = rounded.select("*", F.explode(F.sequence(
        F.col("b") * block + 1, F.least("m", (F.col("b") + 1) * block))).alias("k"))
    return rounded.select(
        "doc_id", "source", "size", "source_size", "target", (copies * F.col("size")).alias("taken"))

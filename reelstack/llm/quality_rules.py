"""Quality rules with adaptive thresholds per language and source.

Every document gets a few ratios (symbols, repeated lines, repeated words,
capitals, mean word length). For each (language, source) and ratio a quantile
sketch is built: counts on a fixed grid of the ratio. Two sketches merge by
adding their counts, so the sketch is a plain partial aggregation, its error is
one grid step, and its answer does not depend on the order of merging. The
sketch of a group gives its fence, and the fences are joined back to the
documents:

* where at least half of the documents have a ratio above zero (capitals, word
  length), the fence lies ``SPREADS`` quarter spreads and a slack from the median;
* where most have none (symbols, repeats), quartiles of all are zero and tell
  nothing. The fence then comes from the documents that have some: it lies
  above their upper quartile by ``SPREADS`` times its distance from the lower one,
  and, as such documents are outliers where they are few, no further up than the
  slack and the lower quartile, weighed by how common they are. Quartiles of few
  documents are drawn towards those of the language, whose sketch is the merged
  one of its groups.

Ratios beyond the grid's top share its last step; the grid reaches up to a mean
word length of 10,000 characters.

Defined results: null text counts as empty (no words, base rules reject it);
null language or source is a group of its own; repeated rows each get their
verdict; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from reelstack.llm.common import SPACES, only, text_or_empty, with_row, words
from reelstack.session import materialize

# Fixed values of the base rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"

# Ratio -> (least fence, slack) in grid steps. The grid is per mille for the
# shares and a hundredth of a character for the mean word length.
SLACK = {"symbols": (20, 20), "dup_lines": (100, 400), "repeats": (100, 350), "capitals": (100, 100),
         "word_length": (100, 100)}
TWO_SIDED = ("word_length",)
GRID_TOP = 1_000_000
SPREADS = 6
# Documents with some of a ratio whose quartiles weigh as much as the language's.
SHRINK = 32
NAMES = tuple(SLACK)


def repeated_words(w: Column, n: Column) -> list[tuple[str, Column]]:
    """Steps that count the words inside 3-word windows found twice or more in
    the text. A window is compared by its 64-bit hash within its document."""
    i3 = F.sequence(F.lit(0), F.col("n_words") - 3)
    window = F.transform(i3, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    none = F.array().cast("array<bigint>")
    s, at = F.col("_sorted"), F.col("_at")
    same = lambda x, i: F.coalesce(x["h"] == F.get(s, i - 1)["h"], F.lit(False)) | F.coalesce(
        x["h"] == F.get(s, i + 1)["h"], F.lit(False))
    return [
        ("_win", F.when(n >= 3, window).otherwise(none)),
        # Most texts repeat no window: one hash set tells, and the sort is skipped.
        ("_sorted", F.when(F.size(F.array_distinct("_win")) < F.size("_win"), F.sort_array(
            F.transform("_win", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))),
        ("_at", F.sort_array(F.transform(F.filter(s, same), lambda x: x["i"]))),
        ("n_repeat_words", F.coalesce(F.aggregate(
            F.transform(at, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1), x + 3) - x)),
            F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long")),
    ]


def document_metrics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns plus the counts and the grid ratios of each text."""
    text = F.col("_text")
    df = docs.select(*[F.col(f"`{c}`") for c in keep], text_or_empty().alias("_text"))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    df = (df.withColumn("_w", words(text)).withColumn("_lines", lines)
          .withColumn("n_words", F.size("_w").cast("int")))
    for name, step in repeated_words(F.col("_w"), F.col("n_words")):
        df = df.withColumn(name, step)
    count = lambda cls: F.char_length(F.regexp_replace(text, f"[^{cls}]+", ""))
    df = df.select(
        *[F.col(f"`{c}`") for c in keep], F.col("n_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        count(SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words", F.size("_lines").alias("_n_lines"), count(r"\p{Lu}").alias("_n_upper"))
    n = F.col("n_words")
    step = lambda part, whole, scale: F.when(
        whole > 0, F.least(F.lit(GRID_TOP).cast("long"), F.floor(part * scale / whole))
    ).otherwise(F.lit(0)).cast("int")
    ratios = {"symbols": step(F.col("n_symbols"), F.col("word_chars"), 1000),
              "dup_lines": step(F.col("n_dup_lines"), F.col("_n_lines"), 1000),
              "repeats": step(F.col("n_repeat_words"), n, 1000),
              "capitals": step(F.col("_n_upper"), F.col("word_chars"), 1000),
              "word_length": step(F.col("word_chars"), n, 100)}
    df = df.select("*", *[v.alias(f"_{k}") for k, v in ratios.items()])
    return (df.drop("_n_lines", "_n_upper")
            .withColumn("base_failed", (n < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n)))


def quantile_sketch(metrics: DataFrame) -> DataFrame:
    """(lang, source, ratio, step, n): the mergeable counts. Documents that the
    base rules reject take no part, so that junk does not set the thresholds."""
    pairs = F.array(*[F.struct(F.lit(k).alias("ratio"), F.col(f"_{k}").alias("step")) for k in NAMES])
    return (metrics.filter(~F.col("base_failed"))
            .select("lang", "source", F.inline(pairs))
            .groupBy("lang", "source", "ratio", "step").agg(F.count("*").alias("n")))


def merge_sketches(sketch: DataFrame, *by: str) -> DataFrame:
    """Add sketches up to coarser groups (or several runs to one)."""
    return sketch.groupBy(*by, "ratio", "step").agg(F.sum("n").alias("n"))


def quartiles(sketch: DataFrame, *by: str) -> DataFrame:
    """Smallest grid step that covers each quarter of a group's documents."""
    by = by or ("lang", "source")
    group = Window.partitionBy(*by, "ratio")
    below = F.sum("n").over(group.orderBy("step"))
    ranked = sketch.select("*", below.alias("below"), F.sum("n").over(group).alias("total"))
    at = lambda q: F.min(F.when(4 * F.col("below") >= q * F.col("total"), F.col("step")))
    return ranked.groupBy(*by, "ratio").agg(
        at(1).alias("q1"), at(2).alias("q2"), at(3).alias("q3"), F.max("total").alias("total"))


def of_some(sketch: DataFrame) -> DataFrame:
    """Per group and ratio the quartiles n1 and n3 of the documents above zero,
    drawn towards the language's, and how many there are (``some``)."""
    some = sketch.filter("step > 0")
    own = quartiles(some, "lang", "source").select("lang", "source", "ratio", "q1", "q3", F.col("total").alias("some"))
    lang = quartiles(merge_sketches(some, "lang"), "lang").select(
        F.col("lang").alias("_lang"), F.col("ratio").alias("_ratio"), F.col("q1").alias("l1"), F.col("q3").alias("l3"))
    both = own.join(lang, own["lang"].eqNullSafe(F.col("_lang")) & (own["ratio"] == F.col("_ratio")))
    drawn = lambda o, l: F.floor((F.col(o) * F.col("some") + F.col(l) * SHRINK) / (F.col("some") + SHRINK))
    return both.select("lang", "source", "ratio", "some", drawn("q1", "l1").alias("n1"), drawn("q3", "l3").alias("n3"))


def thresholds(sketch: DataFrame) -> DataFrame:
    """One row per (lang, source): ``low_*``/``high_*`` of each ratio (the
    module's text tells how). A uniform group loses nothing, and up to half a
    group may be junk."""
    given = lambda i: F.create_map(*[x for k, v in SLACK.items() for x in (F.lit(k), F.lit(v[i]))])[F.col("ratio")]
    # A length has no scale of its own: its slack grows with the median.
    least = given(0)
    slack = F.when(F.col("ratio").isin(*TWO_SIDED), F.greatest(given(1), F.floor(F.col("q2") / 4))).otherwise(given(1))
    q = quartiles(sketch, "lang", "source").alias("q")
    some = of_some(sketch).select(*[F.col(c).alias(f"_{c}") for c in ("lang", "source", "ratio", "some", "n1", "n3")])
    q = q.join(some, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
               & (F.col("ratio") == F.col("_ratio")), "left")
    common = F.col("q2") + SPREADS * F.least(F.col("q2") - F.col("q1"), slack) + slack
    near = F.greatest(slack, slack + F.floor(2 * F.col("_some") * (F.col("_n1") - slack) / F.col("total")))
    far = F.greatest(least, F.col("_n3") + SPREADS * (F.col("_n3") - F.col("_n1")))
    fences = q.select(
        "lang", "source", "ratio",
        F.when(F.col("q2") > 0, common).otherwise(F.coalesce(F.least(near, far), slack)).alias("high"),
        (F.col("q2") - SPREADS * F.least(F.col("q3") - F.col("q2"), slack) - slack).alias("low"))
    pick = lambda k, side: F.max(F.when(F.col("ratio") == k, F.col(side))).alias(f"{side}_{k}")
    return fences.groupBy("lang", "source").agg(
        *[pick(k, "high") for k in NAMES], *[pick(k, "low") for k in TWO_SIDED])


def judged(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns (with lang and source), the counts, ``base_failed`` and
    ``kept``. The metrics are stored once; the sketch and the verdict read them."""
    keep = [*keep, *[c for c in ("lang", "source") if c not in keep]]
    metrics = materialize(document_metrics(docs, keep), "quality_metrics")
    limits = materialize(thresholds(quantile_sketch(metrics)), "quality_thresholds")
    limits = limits.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    joined = metrics.join(limits, metrics["lang"].eqNullSafe(F.col("_lang"))
                          & metrics["source"].eqNullSafe(F.col("_source")), "left")
    inside = F.lit(True)
    for k in NAMES:
        inside = inside & (F.col(f"_{k}") <= F.col(f"high_{k}"))
    for k in TWO_SIDED:
        inside = inside & (F.col(f"_{k}") >= F.col(f"low_{k}"))
    kept = ~F.col("base_failed") & F.coalesce(inside, F.lit(True))
    return joined.select(*[F.col(f"`{c}`") for c in keep], "n_words", "word_chars", "n_symbols",
                         "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"))


def quality_rules(docs: DataFrame) -> DataFrame:
    """Counts and verdict of every document (columns of the contract)."""
    return judged(only(docs, "doc_id", "text", "lang", "source"), ["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns. The row stays with the
    stored metrics, so the verdict needs no shuffle of texts."""
    rows = with_row(docs, "text", "lang", "source")
    return judged(rows, ["row"]).filter("kept").select("row.*")

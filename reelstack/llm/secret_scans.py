"""Secret scans over an incremental blob ledger.

Every version of every path is content-addressed by the SHA-256 of its text.
The ledger holds, per blob, the rule versions it has been scanned with and what
they found. A scan looks only at (blob, rule version) pairs the ledger does not
know: each new text is scanned once however many paths and versions hold it, and
a new rule rescans old blobs with that rule alone. Findings are joined back to
all paths. Rules are regular expressions; the matches of a text are found by
splitting it at them, so positions come without a Python function.

Positions are code points, the end exclusive. Defined results: null text is the
empty blob, without findings; repeated rows and equal texts share one blob and
each get its findings; an empty table gives an empty result; extra columns are
ignored or carried along.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reelstack.llm.common import let, only, running_before, text_or_empty, with_row
from reelstack.session import materialize, scratch_path


class Rule(NamedTuple):
    kind: str
    version: int
    pattern: str
    # Group whose length must reach ``least``; shorter matches are dropped
    # after matching, so they still hide what they overlap.
    group: int = 0
    least: int = 0

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# Fixed values of the contract, in its order of kinds. A run of 20 or 24
# characters is maximal under greedy matching, so the length stands in the pattern.
RULES = (
    Rule("assign", 1, r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
                      r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?"
                      r"([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
)
FOUND = "array<struct<start:int,ord:int,kind:string,end:int,version:int>>"


def blob_id(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def rule_matches(df: DataFrame, rule: Rule, order: int) -> DataFrame:
    """Add ``_found_<order>``: the spans of one rule in ``text`` where
    ``_todo`` holds the rule."""
    parts, hits, lens, group = (f"_{n}_{order}" for n in ("parts", "hits", "lens", "group"))
    todo = F.array_contains("_todo", rule.key)
    df = df.withColumn(parts, F.when(todo, F.split("text", rule.pattern, -1)))
    some = F.size(parts) > 1
    find = lambda g: F.when(some, F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(g)))
    df = df.withColumn(hits, find(0))
    if rule.group:
        df = df.withColumn(group, find(rule.group))
    # Running offsets: the text before match i, then match i.
    pieces = F.arrays_zip(F.slice(parts, F.lit(1), F.size(hits)).alias("p"), F.col(hits).alias("h"))
    sizes = F.transform(pieces, lambda x: F.struct(F.char_length(x["p"]).alias("p"), F.char_length(x["h"]).alias("h")))

    def placed(sizes: Column) -> Column:
        before = running_before(F.transform(sizes, lambda x: x["p"] + x["h"]), lambda a, b: a + b, F.lit(0))
        return F.zip_with(before, sizes, lambda at, x: F.struct(
            (at + x["p"]).alias("start"), (at + x["p"] + x["h"]).alias("end")))

    df = df.withColumn(lens, F.when(some, let(sizes, placed)))
    spans = F.transform(lens, lambda s, i: F.struct(
        s["start"].alias("start"), F.lit(order).alias("ord"), F.lit(rule.kind).alias("kind"),
        s["end"].alias("end"), F.lit(rule.version).alias("version")))
    if rule.group:
        spans = F.filter(spans, lambda s, i: F.char_length(F.get(F.col(group), i)) >= rule.least)
    df = df.withColumn(f"_found_{order}", F.coalesce(spans, F.array().cast(FOUND)))
    return df.drop(parts, hits, lens, *([group] if rule.group else []))


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, rules, found) of blobs with ``text`` and ``_todo``."""
    for order, rule in enumerate(rules):
        blobs = rule_matches(blobs, rule, order)
    found = F.array_sort(F.concat(*[F.col(f"_found_{k}") for k in range(len(rules))]))
    return blobs.select("blob", F.col("_todo").alias("rules"), found.alias("found"))


def unseen(blobs: DataFrame, ledger: DataFrame | None, rules: tuple[Rule, ...]) -> DataFrame:
    """One row per blob that some rule version has not seen, with ``_todo``."""
    keys = F.array(*[F.lit(r.key) for r in rules])
    fresh = blobs.dropDuplicates(["blob"])
    if ledger is None:
        return fresh.withColumn("_todo", keys)
    seen = ledger.groupBy("blob").agg(F.flatten(F.collect_list("rules")).alias("_seen"))
    fresh = fresh.join(seen, "blob", "left")
    todo = F.array_except(keys, F.coalesce("_seen", F.array().cast("array<string>")))
    return fresh.withColumn("_todo", todo).drop("_seen").filter(F.size("_todo") > 0)


def scan(versions: DataFrame, ledger_path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what the ledger at ``ledger_path`` does not know, append it there,
    and return the ledger's findings per blob: (blob, found) for those of the
    given rule versions, blobs without findings left out. ``versions`` has a
    ``text`` column; a missing ledger is an empty one."""
    spark = versions.sparkSession
    blobs = versions.select(text_or_empty().alias("text")).withColumn("blob", blob_id(F.col("text")))
    scan_blobs(unseen(blobs, read_ledger(spark, ledger_path), rules), rules).write.mode(
        "append").parquet(ledger_path)
    current = [r.key for r in rules]
    spans = read_ledger(spark, ledger_path).select("blob", F.filter(
        "found", lambda s: F.concat_ws("@", s["kind"], s["version"].cast("string")).isin(current)).alias("found"))
    return spans.filter(F.size("found") > 0).groupBy("blob").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("found")))).alias("found"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs_path):
        return None
    return spark.read.parquet(path)


def digest(spans: Column) -> Column:
    text = F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(text, ",")


def secret_scans(docs: DataFrame, ledger_path: str | None = None) -> DataFrame:
    """Findings of every document (columns of the contract). The path of a
    blob is its doc_id; without a ledger a fresh one is kept in the scratch folder."""
    docs = only(docs, "doc_id", "text")
    ledger_path = ledger_path or scratch_path(docs.sparkSession, "secret_ledger")
    # Stored, so that the join is planned from its size, and split where a blob is hot.
    found = materialize(scan(docs, ledger_path), "secret_found")
    paths = docs.select("doc_id", blob_id(text_or_empty()).alias("blob"))
    spans = F.coalesce("found", F.array().cast(FOUND))
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return paths.join(found, "blob", "left").select("doc_id", spans.alias("spans")).select(
        "doc_id", *[n(r.kind).alias(f"n_{r.kind}") for r in RULES],
        F.sha2(digest(F.col("spans")), 256).alias("base_sha256"), digest(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, ledger_path: str | None = None) -> DataFrame:
    """The documents with every secret replaced by ``[kind]``; ``n_chars``
    (where present) follows the new text. Texts without findings are unchanged
    (a null text stays null)."""
    ledger_path = ledger_path or scratch_path(docs.sparkSession, "secret_ledger")
    # Stored, so that the join is planned from its size, and split where a blob is hot.
    found = materialize(scan(docs, ledger_path), "secret_found")
    keyed = with_row(docs, "text").withColumn("blob", blob_id(text_or_empty()))
    text = F.col("text")
    # The spans go by start; ``at`` is the end of all before, and a span that
    # begins before it is already gone.
    at = running_before(F.transform("found", lambda s: s["end"]), F.greatest, F.lit(0))
    pieces = F.zip_with("found", at, lambda s, at: F.when(s["start"] >= at, F.concat(
        F.substring(text, at + 1, s["start"] - at), F.lit("["), s["kind"], F.lit("]"))).otherwise(""))
    last = F.array_max(F.transform("found", lambda s: s["end"]))
    clean = F.concat(F.array_join(pieces, ""), F.substring(
        text, last + 1, F.greatest(F.char_length(text) - last, F.lit(0))))
    hit = F.col("found").isNotNull()
    joined = keyed.join(found, "blob", "left").withColumn("text", F.when(hit, clean).otherwise(text))
    row = F.col("row").withField("text", F.col("text"))
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        row = row.withField("n_chars", F.when(hit, length).otherwise(F.col("row.n_chars")))
    return joined.select(row.alias("row")).select("row.*")

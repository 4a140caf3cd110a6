"""Chat formatting by schema fingerprint.

A record is a JSON document in one of several layouts (prompt and completion,
instruction and output, lists of messages, single turns). The paths of its
nested fields, with their types, are hashed to a fingerprint; the fingerprint
selects a declared mapping from the layout to canonical turns (role, text). New
layouts are added by declaring a mapping, not by code for each record.

Turns are written with the template ``<s>[INST]role[/INST]text</s>``. Inside
roles and texts a backslash is doubled and each control string gets a backslash
after its first character, so no control string survives in a text and the
original is read back by dropping every backslash that quotes a character. The
loss mask is a list of spans of the formatted string, one per assistant text.

Defined results: null role or text is empty; turns are ordered by turn (nulls
first), then role and text; a null conversation id is one conversation; a record
of an unknown layout gives no turns and keeps its fingerprint (``unknown`` lists
them), its conversation stays; a text given in a column may have any length; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from reelstack.llm.common import only, running_before

# Fixed values of the template.
OPEN, HEAD, BODY, CLOSE = "<s>", "[INST]", "[/INST]", "</s>"
CONTROL = r"(<)(?=/?s>)|(\[)(?=/?INST\])"
ASSISTANT = "assistant"
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


class Layout(NamedTuple):
    """``schema`` as a variant describes it; ``turns`` are (role, path) pairs
    of single fields, or ``list_path`` with the names of role and text."""
    schema: str
    turns: tuple[tuple[str, str], ...] = ()
    list_path: str = ""
    role: str = ""
    text: str = ""


LAYOUTS = (
    Layout("OBJECT<role: STRING, text: STRING>", list_path="$", role="role", text="text"),
    Layout("OBJECT<content: STRING, role: STRING>", list_path="$", role="role", text="content"),
    Layout("OBJECT<completion: STRING, prompt: STRING>", (("user", "$.prompt"), ("assistant", "$.completion"))),
    Layout("OBJECT<prompt: STRING, response: STRING>", (("user", "$.prompt"), ("assistant", "$.response"))),
    Layout("OBJECT<instruction: STRING, output: STRING>", (("user", "$.instruction"), ("assistant", "$.output"))),
    Layout("OBJECT<input: STRING, instruction: STRING, output: STRING>",
           (("system", "$.instruction"), ("user", "$.input"), ("assistant", "$.output"))),
    Layout("OBJECT<messages: ARRAY<OBJECT<content: STRING, role: STRING>>>",
           list_path="$.messages", role="role", text="content"),
    Layout("OBJECT<conversations: ARRAY<OBJECT<from: STRING, value: STRING>>>",
           list_path="$.conversations", role="from", text="value"),
)
TURNS = "array<struct<role:string,text:string>>"


def fingerprint(schema: Column) -> Column:
    """Hash of the nested field paths and types of a record."""
    return F.sha2(schema, 256)


def turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def canonical_turns(records: DataFrame, layouts=LAYOUTS) -> DataFrame:
    """All columns of ``records`` but ``record`` (a JSON string), plus its
    ``fingerprint`` and its ``turns`` (null when the layout is unknown)."""
    others = [F.col(f"`{c}`") for c in records.columns if c != "record"]
    parsed = records.select(*others, F.try_parse_json("record").alias("_v"))
    parsed = parsed.withColumn("fingerprint", fingerprint(F.schema_of_variant("_v")))
    turns = F.lit(None).cast(TURNS)
    for layout in layouts:
        if layout.turns:
            found = F.array(*[turn(F.lit(r), F.try_variant_get("_v", p, "string")) for r, p in layout.turns])
        else:
            kind = f"struct<`{layout.role}`:string,`{layout.text}`:string>"
            items = (F.array(F.try_variant_get("_v", "$", kind)) if layout.list_path == "$"
                     else F.try_variant_get("_v", layout.list_path, f"array<{kind}>"))
            found = F.transform(items, lambda x: turn(x[layout.role], x[layout.text]))
        turns = F.when(F.col("fingerprint") == fingerprint(F.lit(layout.schema)), found).otherwise(turns)
    return parsed.select(*others, "fingerprint", turns.alias("turns"))


def canonical_columns(rows: DataFrame, fields: list[str], layouts=LAYOUTS) -> DataFrame:
    """The same of records whose fields are columns, texts of any length: their
    paths are the columns' names, and the mapping reads the columns themselves,
    without a detour over JSON. All columns but ``fields``, plus ``fingerprint`` and
    ``turns``; a null field is empty."""
    schema = f"OBJECT<{', '.join(f'{f}: STRING' for f in sorted(fields))}>"
    mark = fingerprint(F.lit(schema))
    turns = F.lit(None).cast(TURNS)
    for layout in layouts:
        if layout.list_path not in ("", "$") or layout.schema != schema:
            continue
        pairs = ([(F.lit(r), F.col(p[len("$."):])) for r, p in layout.turns]
                 or [(F.col(layout.role), F.col(layout.text))])
        found = F.array(*[turn(role, text.cast("string")) for role, text in pairs])
        turns = F.when(mark == fingerprint(F.lit(layout.schema)), found).otherwise(turns)
    others = [F.col(f"`{c}`") for c in rows.columns if c not in fields]
    return rows.select(*others, mark.alias("fingerprint"), turns.alias("turns"))


def unknown(canonical: DataFrame) -> DataFrame:
    """Fingerprints without a mapping, with their number of records."""
    return canonical.filter("turns is null").groupBy("fingerprint").agg(F.count("*").alias("n"))


def role_name(role: Column) -> Column:
    names = F.create_map(*[F.lit(x) for kv in ROLE_NAMES.items() for x in kv])
    return F.coalesce(F.try_element_at(names, role), role)


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONTROL, r"$1$2\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_turns(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) to one row per conversation:
    ``formatted``, ``turn_starts`` and ``loss`` (turn, start, end), offsets in
    code points of ``formatted``, the ends exclusive."""
    head = F.concat(F.lit(OPEN + HEAD), escape(F.col("role")), F.lit(BODY))
    body = escape(F.col("text"))
    rows = turns.select("conv_id", F.struct(
        F.col("turn").alias("turn"), F.col("role").alias("role"), head.alias("head"), body.alias("body")).alias("t"))
    # A record without turns (a null role) only names its conversation.
    turn = F.when(F.col("t.role").isNotNull(), F.col("t"))
    convs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("ts"))
    total = lambda t: F.char_length(t["head"]) + F.char_length(t["body"]) + len(CLOSE)
    starts = running_before(F.transform("ts", lambda t: total(t).cast("long")), lambda a, b: a + b, F.lit(0).cast("long"))
    convs = convs.select("conv_id", "ts", starts.alias("turn_starts"))
    loss = F.filter(F.transform("ts", lambda t, i: F.struct(
        i.alias("turn"), (F.get("turn_starts", i) + F.char_length(t["head"])).alias("start"),
        (F.get("turn_starts", i) + F.char_length(t["head"]) + F.char_length(t["body"])).alias("end"),
        (t["role"] == ASSISTANT).alias("on"))), lambda s: s["on"])
    return convs.select(
        "conv_id",
        F.array_join(F.transform("ts", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))), "").alias("formatted"),
        "turn_starts", F.transform(loss, lambda s: F.struct(
            s["turn"].alias("turn"), s["start"].alias("start"), s["end"].alias("end"))).alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``turns`` (role, text) and ``loss_texts`` read from ``formatted`` and its
    mask. Each masked span is cut from its own turn, so the cost is linear."""
    pieces = F.split("formatted", CLOSE, -1)
    df = formatted.withColumn("_pieces", F.slice(pieces, F.lit(1), F.size(pieces) - 1))
    parts = lambda p: F.split(p, r"\[/INST\]", 2)
    role = lambda p: F.substring(F.get(parts(p), F.lit(0)), F.lit(len(OPEN + HEAD) + 1), F.char_length(p))
    return df.select(
        "*", F.transform("_pieces", lambda p: F.struct(
            unescape(role(p)).alias("role"), unescape(F.get(parts(p), F.lit(1))).alias("text"))).alias("turns"),
        F.transform("loss", lambda s: unescape(F.substring(
            F.get("_pieces", s["turn"]), (s["start"] - F.get("turn_starts", s["turn"]) + 1).cast("int"),
            (s["end"] - s["start"]).cast("int")))).alias("loss_texts")).drop("_pieces")


def chat_format(conversations: DataFrame) -> DataFrame:
    """Format conversations given as rows (conv_id, turn, role, text), each a
    record of the single-turn layout whose fields are columns, or as rows (conv_id,
    turn, record), whose JSON records may hold any layout. A record of no known
    layout, or too long for the JSON reader (20 million characters), has no turns;
    a conversation without any is kept and formatted as nothing."""
    if {"role", "text"} <= set(conversations.columns):
        rows = canonical_columns(only(conversations, "conv_id", "turn", "role", "text"), ["role", "text"])
    else:
        rows = canonical_turns(only(conversations, "conv_id", "turn", "record"))
    # Roles of single turns are as given; other layouts have names of their own.
    given = F.col("fingerprint") == fingerprint(F.lit(LAYOUTS[0].schema))
    turns = rows.select("conv_id", "turn", given.alias("given"), F.posexplode_outer("turns").alias("k", "t"))
    role = F.when(F.col("given"), F.col("t.role")).otherwise(role_name(F.col("t.role")))
    turns = turns.select("conv_id", F.struct("turn", "k").alias("turn"), role.alias("role"), F.col("t.text").alias("text"))
    return format_turns(turns)


def digests(formatted: DataFrame) -> DataFrame:
    """Columns of the contract, read back from the formatted strings."""
    back = read_back(formatted)
    turn_text = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turn_text, 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))

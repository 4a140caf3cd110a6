"""Awkward documents, and brute-force helpers, for the tests of this folder."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns of the same names as working columns of the operators.
CLASHING = ("id", "size", "n", "blob", "key", "copy", "sketch", "print", "bucket", "found", "unit", "score",
            "target", "_text", "_w", "component", "u", "v", "k", "text_", "spans")


def words(text):
    return WORD.findall(text or "")


def prose(n, seed):
    import random
    r = random.Random(seed)
    return " ".join("".join(r.choices(["ba", "ke", "lo", "mi", "nu", "ra", "so", "ti"], k=r.randint(1, 3)))
                    for _ in range(n))


def documents():
    """(doc_id, text, lang, source, n_chars): nulls, blanks, copies, repeated
    rows, ties, a very long text, control and non-ASCII characters."""
    long_text = prose(30_000, 1)
    base = prose(120, 2)
    texts = [base, base, base + " tail", prose(200, 3), None, "", " \t\n\x0b\x0c\r ", "one", "one two three four five",
             long_text, long_text.replace("ba ", "xx ", 3), "é\u00a0ñ " * 40 + "\u2028 ż 😀", "a\nb\na\n\nb",
             "password = 'hunter22' token:abc AKIA" + "A1" * 10 + " " + "0f" * 16 + "\\ [INST]", base.upper(),
             prose(60, 5) + " " + prose(40, 6), prose(60, 7) + " " + prose(40, 6)]
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 2}" if i % 5 else None, len(t or "")) for i, t in enumerate(texts)]
    rows.append(rows[0])
    rows.append(rows[0])
    rows.append((None, "words of a row without an id " * 5, "en", "s1", 0))
    return rows


def frame(spark, rows=None, clash=False):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(documents() if rows is None else rows, DOC_SCHEMA)
    return df.withColumns({c: F.lit("x") for c in CLASHING}) if clash else df

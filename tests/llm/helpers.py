"""Small tables with every awkward case, for all operators."""

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHING = ["score", "size", "shard", "slot", "ids", "digest", "key", "src", "bucket", "node", "half", "toxic", "block", "part", "lang_pred"]


def docs_of(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, source); every column name the operators use inside is there too."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or ""), *("x" for _ in CLASHING)) for r in rows]
    return spark.createDataFrame(full, DOCS + "".join(f", {c} string" for c in CLASHING))


def awkward():
    """(doc_id, text): nulls, empty, no letters, very long, repeated rows, a null id, marks and odd white space."""
    long = " ".join(f"word{n % 977}" for n in range(40_000))
    return [
        (1, None), (2, ""), (3, " \t\n\x0b\r "), (4, "12345 !!!"), (5, long), (6, "Same text here"), (6, "Same text here"),
        (7, "same TEXT here"), (None, "no id at all"), (None, None), (8, "a\x00b ﻿ é é 😀 ▁ 中文字 ß İ"), (9, "x" * 50_000), (10, "one"),
    ]


def sentences(seed, n, words=400):
    pick = random.Random(seed)
    vocabulary = ["".join(pick.choice("abcdefghijklmnoprstuvw") for _ in range(pick.randint(2, 8))) for _ in range(words)]
    return [" ".join(pick.choice(vocabulary) for _ in range(n)) for _ in range(n)]

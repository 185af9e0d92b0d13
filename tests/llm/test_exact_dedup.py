import hashlib
import random

from pyspark.sql import functions as F

from helpers import awkward, docs_of
from vitrine.llm import exact_dedup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows):
    """(doc_id, keep_id, group_size, kept, sha) by a dictionary."""
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(LOWER), []).append(i)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        left = 1
        for i in ids:
            kept = i == keep and left > 0
            left -= kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.digest) for r in df.collect()), key=str)


def test_awkward_and_empty_tables(spark):
    assert found(exact_dedup.duplicates(docs_of(spark, awkward()))) == plain(awkward())
    assert found(exact_dedup.duplicates(docs_of(spark, []))) == []


def test_a_large_group_and_only_ascii_is_lowered(spark):
    rows = [(n, "Hot TEXT") for n in range(700)] + [(700 + n, t) for n, t in enumerate(["ÄB", "äb", "Äb", "ÄB ", "İ", "i"])]
    random.Random(1).shuffle(rows)
    assert found(exact_dedup.duplicates(docs_of(spark, rows))) == plain(rows)


def test_texts_that_share_a_digest_are_told_apart(spark):
    rows = [(n, f"{'ab'[n % 2]}{n % 5}") for n in range(60)] + [(100, "longer"), (101, None), (None, "a0")]
    out = exact_dedup.duplicates(docs_of(spark, rows), digest=lambda text: F.char_length(text).cast("string"))
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in out.collect()), key=str)
    assert got == sorted((x[:4] for x in plain(rows)), key=str)


def test_state_goes_on_where_it_stopped(spark, tmp_path):
    arrivals, root = f"{tmp_path}/arrivals", f"{tmp_path}/state"
    schema = exact_dedup.ARRIVALS
    spark.createDataFrame([(1, "x", "f"), (5, "x", "f"), (2, "y", "f")], schema).write.parquet(arrivals)
    first = exact_dedup.update_state(spark, arrivals, root).collect()
    assert sorted((r.digest, r.keep_id, r.group_size) for r in first) == [("x", 5, 2), ("y", 2, 1)]
    spark.createDataFrame([(9, "y", "g"), (3, "x", "g"), (4, "z", "g")], schema).write.mode("append").parquet(arrivals)
    second = exact_dedup.update_state(spark, arrivals, root).collect()
    assert sorted((r.digest, r.keep_id, r.locator, r.group_size) for r in second) == [("x", 5, "f", 3), ("y", 9, "g", 2), ("z", 4, "g", 1)]
    again = exact_dedup.update_state(spark, arrivals, root).collect()
    assert sorted(map(str, again)) == sorted(map(str, second))


def test_rows_that_stay(spark):
    docs = docs_of(spark, awkward())
    out = exact_dedup.keep_one(docs)
    assert out.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in out.collect()]
    assert sorted((i, (t or "").translate(LOWER)) for i, t in kept if i is not None) == sorted(
        {(x[1], (t or "").translate(LOWER)) for x in plain(awkward()) for i, t in awkward() if x[3] and i == x[0] and i is not None and hashlib.sha256((t or "").translate(LOWER).encode()).hexdigest() == x[4]}
    )
    assert sum(i is None for i, _ in kept) == 1

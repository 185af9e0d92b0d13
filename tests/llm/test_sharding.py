import hashlib

from helpers import awkward, docs_of
from vitrine.llm import sharding


def jump(key, shards):
    """The published algorithm."""
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2**31 / ((key >> 33) + 1)))
    return b


def key_of(value):
    return int(hashlib.md5(b"" if value is None else str(value).encode()).hexdigest()[:16], 16)


def test_shards_are_those_of_the_published_algorithm(spark):
    rows = spark.range(3000).selectExpr("id AS k").unionByName(spark.createDataFrame([(None,)], "k bigint"))
    for shards in (1, 2, 24):
        for row in sharding.with_shards(rows, "k", shards).collect():
            assert row.shard == jump(key_of(row.k), shards)
            assert row.grown_shard == jump(key_of(row.k), shards + 1)
            assert row.grown_shard in (row.shard, shards)


def test_string_keys_and_clashing_columns(spark):
    rows = spark.createDataFrame([("a", 1, 2), ("b", 3, 4), (None, 5, 6)], "k string, hi int, next int")
    out = sharding.with_shards(rows, "k").orderBy("hi").collect()
    assert [(r.k, r.hi, r.next) for r in out] == [("a", 1, 2), ("b", 3, 4), (None, 5, 6)]
    assert [r.shard for r in out] == [jump(key_of(k), 24) for k in ("a", "b", None)]


def test_slots_have_no_gap_and_follow_the_order(spark):
    rows = [(g, b, k) for g in range(3) for b in range(5) for k in range(7)] + [(0, 2, 3)] * 500
    df = spark.createDataFrame(rows, "g int, b int, k int")
    out = sharding.with_slots(df, "g", "b", ["k"]).collect()
    assert len(out) == len(rows)
    for g in range(3):
        ordered = sorted((r.slot, r.b, r.k) for r in out if r.g == g)
        assert [x[0] for x in ordered] == list(range(len(ordered)))
        assert [x[1:] for x in ordered] == sorted(x[1:] for x in ordered)


def test_the_query_on_awkward_documents(spark, tmp_path):
    for name, rows in (("some", awkward()), ("none", [])):
        docs_of(spark, rows).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        out = sharding.op3_jump_shards(spark, f"{tmp_path}/{name}").collect()
        assert len(out) == len(rows)
        assert sorted((r.doc_id is None, r.doc_id or 0, r["size"]) for r in out) == sorted(
            (i is None, i or 0, 8 + len((t or "").encode())) for i, t in rows
        )
        for shard in {r.shard for r in out}:
            assert sorted(r.slot for r in out if r.shard == shard) == list(range(sum(r.shard == shard for r in out)))

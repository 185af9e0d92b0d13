import hashlib
import random
import re

from helpers import awkward, docs_of
from vitrine.llm import mixing


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def filled(sizes, weights=(5, 2, 1), most=3):
    """Shares by weight; what is above `most` times a size is dealt out again until nothing is."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[n % len(weights)] for n, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(most * sizes[s] for s in capped)
        target = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if target[s] > most * sizes[s]}
        if not over:
            return target | {s: most * sizes[s] for s in capped}
        capped |= over


def test_targets_and_cuts_match_a_plain_version(spark):
    pick = random.Random(3)
    rows = [(n, pick.choice(["a", "b", "c", "d", "e", None]), pick.choice([0, 1, 5, 40, 300])) for n in range(400)]
    rows += [(1000 + n, "tiny", 3) for n in range(4)] + [(2000, "none", 0)] + [(3000, "z", 7)] * 20
    keyed = mixing.with_source_key(spark.createDataFrame(rows, "id bigint, source string, size bigint"), "source", "src")
    out = mixing.mix(keyed.select("src", "id", "size")).collect()
    assert len(out) == len(rows)
    sizes = {}
    for _, source, size in rows:
        sizes[source] = sizes.get(source, 0) + size
    targets = filled(sizes)
    for source, size in sizes.items():
        src = "1" if source is None else "0" + source
        mine = [r for r in out if r.src == src]
        assert all(r.source_size == size and abs(r.target - targets[source]) < 1e-6 for r in mine)
        assert sum(r.taken for r in mine) == int(targets[source] + 1e-9)
        assert all(0 <= r.taken <= 3 * r["size"] for r in mine)
        # Along the hash order: as many more times, then one part, then as many fewer.
        mine.sort(key=lambda r: (hashlib.md5(str(r.id).encode()).hexdigest(), r.id, r["size"], -r.taken))
        whole = [r.taken / r["size"] for r in mine if r["size"]]
        assert whole == sorted(whole, reverse=True)


def test_whole_copies_keep_all_columns(spark):
    docs = docs_of(spark, [(n, "w " * (n % 9 + 1), "ab"[n % 2]) for n in range(60)] + [(60, None, None), (61, "", "a")])
    out = mixing.with_copies(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    total = sum(size_of(r.text) for r in docs.collect())
    assert abs(sum(size_of(r.text) for r in rows) - total) <= 9
    counts = {}
    for r in rows:
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert max(counts.values()) <= 3


def test_awkward_and_empty_tables(spark, tmp_path):
    for name, rows in (("some", awkward()), ("none", [])):
        docs = docs_of(spark, rows)
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        out = mixing.op8_mix_sources(spark, f"{tmp_path}/{name}").collect()
        assert sorted(((r.doc_id is None, r.doc_id or 0, r["size"]) for r in out)) == sorted((i is None, i or 0, size_of(t)) for i, t in rows)
        # One source: everything once.
        assert all(r.taken == r["size"] for r in out)
        assert mixing.with_copies(docs).count() == sum(size_of(t) > 0 for _, t in rows)

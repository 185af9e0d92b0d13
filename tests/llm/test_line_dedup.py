import hashlib
import random

import numpy as np

from helpers import awkward, docs_of
from vitrine.llm import line_dedup as ld

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = "this line is shared by many documents number %d of all"


def key(line):
    return line.strip(ld.SPACE).translate(LOWER)


def plain(rows):
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 40:
                holders.setdefault(key(line), set()).add(i)
    keeper = {k: max(i for i in v if i is not None) for k, v in holders.items() if len(v) >= 5}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in keeper or keeper[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def found(state, docs):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in ld.kept_texts(state, docs).collect()), key=str)


def corpus(seed, ids):
    pick = random.Random(seed)
    shared = [LONG % n for n in range(12)]
    rows = []
    for i in ids:
        lines = [pick.choice(shared) if pick.random() < 0.5 else f"own line {i} {n} that is long enough to count here" for n in range(6)]
        lines = [pick.choice([x, x.upper(), f"\t {x} \r", x]) for x in lines] + ["short", "short"]
        rows.append((i, "\n".join(lines)))
    return rows


def test_filter_holds_everything_put_in_and_forgets_what_is_taken_out():
    random = np.random.default_rng(5)
    hashes = random.integers(-(2**62), 2**62, 30_000)
    held = ld.CuckooFilter.sized(len(hashes))
    held.insert(hashes)
    held = ld.CuckooFilter.from_bytes(held.to_bytes())
    assert held.contains(hashes).all()
    assert held.contains(random.integers(-(2**62), 2**62, 100_000)).mean() < 0.001
    held.remove(hashes[:10_000])
    assert held.contains(hashes[10_000:]).all()
    assert held.contains(hashes[:10_000]).mean() < 0.001


def test_an_overfull_filter_loses_nothing():
    hashes = np.random.default_rng(6).integers(-(2**62), 2**62, 300)
    held = ld.CuckooFilter(np.zeros((32, ld.SLOTS), np.uint16), np.zeros((0, 2), np.uint32))
    held.insert(hashes)
    assert len(held.stash) >= 300 - 128 and ld.CuckooFilter.from_bytes(held.to_bytes()).contains(hashes).all()
    held.remove(hashes)
    assert not held.slots.any() and not len(held.stash)


def test_kept_lines_match_a_plain_version(spark):
    rows = corpus(1, range(80)) + [(200 + n, LONG % 3) for n in range(300)] + [(None, LONG % 1), (600, "\n\n"), (601, None)]
    docs = docs_of(spark, rows)
    assert found(ld.insert(ld.empty_state(spark), docs), docs) == plain(rows)


def test_deleted_documents_leave_no_trace_and_lines_come_back(spark):
    rows = corpus(2, range(60))
    half = docs_of(spark, rows[:30])
    state = ld.insert(ld.empty_state(spark), half)
    more = ld.insert(state, docs_of(spark, rows[20:]))  # ten of them a second time
    assert found(more, docs_of(spark, rows)) == plain(rows)
    gone = spark.createDataFrame([(i,) for i in range(30, 60)], "doc_id bigint")
    back = ld.delete(more, gone)
    assert found(back, half) == plain(rows[:30])
    pairs = lambda s: sorted((r.doc_id, bytes(r.key)) for r in s.postings.collect())
    counts = lambda s: sorted((bytes(r.key), r.n_docs, r.keeper) for r in s.refs.collect())
    assert pairs(back) == pairs(state) and counts(back) == counts(state)
    assert back.filters.agg({"n_keys": "sum"}).first()[0] == state.filters.agg({"n_keys": "sum"}).first()[0]


def test_awkward_and_empty_tables(spark, tmp_path):
    for name, rows in (("some", awkward()), ("none", [])):
        docs_of(spark, rows).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        out = ld.op7_line_dedup(spark, f"{tmp_path}/{name}").collect()
        assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in out), key=str) == sorted(
            ((i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in plain(rows)), key=str
        )

import itertools

import numpy as np
from pyspark.sql import functions as F

from vitrine.llm import neighbours as nb

SCHEMA = "vec_id bigint, embedding array<float>, label int, entry string, vec string, keys string, curve string"


def table_of(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "x", "x", "x") for i, v in rows], SCHEMA)


def plain(rows, k=5):
    """{query: [(vec_id, score)]} by comparing with every row."""
    good = {}
    for i, v in rows:
        if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v):
            good.setdefault(i, []).append(np.array(v, np.float32).astype(float))
    out = {}
    for q in good:
        if q % 50 == 0:
            best = {}
            for i, vs in good.items():
                if i != q:
                    best[i] = max(float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b))) for a in good[q] for b in vs)
            out[q] = sorted(best.items(), key=lambda x: (-round(x[1], 12), x[0]))[:k]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def search(spark, rows):
    return found(nb.nearest(table_of(spark, rows), F.col("vec_id") % 50 == 0))


def test_the_curve_visits_every_cell_and_moves_by_one():
    for axes, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=axes)))
        keys = nb.hilbert_keys(cells, bits)
        assert sorted(keys) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1) == 1).all()


def test_recall_against_brute_force(spark):
    random = np.random.default_rng(1)
    centres = random.normal(size=(30, 24))
    rows = [(int(n), [float(x) for x in centres[n % 30] + 0.6 * random.normal(size=24)]) for n in range(3000)]
    got, want = search(spark, rows), plain(rows)
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    truth = {q: dict(plain(rows, 3000)[q]) for q in (0, 50)}
    for q, scores in truth.items():
        assert all(abs(scores[i] - s) < 1e-12 for i, s in got[q])
        assert [i for i, _ in got[q]] == sorted((i for i, _ in got[q]), key=lambda i: (-round(scores[i], 12), i))


def test_many_copies_and_ties_take_the_smallest_ids(spark):
    rows = [(n, [1.0, 2.0, 0.5]) for n in range(400)] + [(400 + n, [2.0, 4.0, 1.0]) for n in range(100)]
    got = search(spark, rows)
    assert set(got) == {q for q in range(0, 500, 50)}
    for q, best in got.items():
        assert [i for i, _ in best] == [i for i in range(7) if i != q][:5]


def test_many_parallel_vectors_of_different_lengths(spark):
    rows = [(n, [x * 2.0 ** (n % 30 - 15) for x in (1.0, 2.0, 0.5)]) for n in range(60)]
    got = search(spark, rows)
    assert {q: [i for i, _ in best] for q, best in got.items()} == {0: [1, 2, 3, 4, 5], 50: [0, 1, 2, 3, 4]}


def test_recall_beside_a_tight_cluster(spark):
    random = np.random.default_rng(7)
    rows = [(n, [float(x) for x in random.normal(size=16)]) for n in range(800)]
    rows += [(800 + n, [float(x) for x in np.eye(16)[3] + 1e-4 * random.normal(size=16)]) for n in range(400)]
    got, want = search(spark, rows), plain(rows)
    assert sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) >= 0.9 * 5 * len(want)


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.1]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [1.0, nan]), (6, [inf, 1.0]), (7, [None, 1.0]),
            (8, [1.0, 2.0, 3.0]), (50, [0.0, 1.0]), (50, [0.0, 1.0]), (100, None), (None, [1.0, 1.0]), (9, [-0.0, 1.0]), (9, [1.0, 0.0])]
    got, want = search(spark, rows), plain([r for r in rows if r[0] != 8])
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    assert search(spark, []) == {} and search(spark, [(0, [1.0])]) == {}

import numpy as np

from vitrine.llm import vector_codes as vc

SCHEMA = "vec_id bigint, embedding array<float>, label int, code string, numbers string, row string, error string"


def table_of(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", "x", "x", "x") for i, v, label in rows], SCHEMA)


def plain(rows, entries, rounds, parts=4):
    """(vec_id, code, error, label_error) of all rows and the codebooks, point by point."""
    kept = [(i, np.floor(np.array(v, np.float32).astype(float) * 1024).astype(np.int64), label) for i, v, label in rows if v is not None and None not in v and np.isfinite(v).all()]
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1].tolist()))
    split = lambda v: v.reshape(parts, -1)
    books = np.stack([split(v) for _, v, _ in order[:entries]], 1)

    def nearest(v):
        return [((books[p] - split(v)[p]) ** 2).sum(1) for p in range(parts)]

    for _ in range(rounds):
        sums, counts = np.zeros_like(books), np.zeros(books.shape[:2], np.int64)
        for _, v, _ in kept:
            for p, d in enumerate(nearest(v)):
                sums[p, d.argmin()] += split(v)[p]
                counts[p, d.argmin()] += 1
        books = np.where(counts[:, :, None] > 0, sums // np.maximum(counts, 1)[:, :, None], books)
    out = []
    for i, v, label in kept:
        d = nearest(v)
        out.append((i, "".join(f"{x.argmin():02x}" for x in d), int(sum(x.min() for x in d)), label))
    total = {}
    for *_, error, label in out:
        total[label] = total.get(label, 0) + error
    return sorted(((i, code, error, total[label]) for i, code, error, label in out), key=str), books


def found(spark, rows, **kw):
    codes, books = vc.coded(table_of(spark, rows), **kw)
    whole = vc.with_label_errors(codes)
    return sorted((tuple(r) for r in whole.select("vec_id", "code", "error", "label_error").collect()), key=str), books


def vectors(seed, n, size=16, spread=0.1):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(12, size))
    return [[float(x) for x in centres[k % 12] + spread * random.normal(size=size)] for k in range(n)]


def test_codes_are_those_of_plain_rounds(spark):
    rows = [(n * 31 % 997, v, n % 3 or None) for n, v in enumerate(vectors(1, 400))]
    rows += [(2000 + n, v, 1) for n, v in enumerate([rows[5][1]] * 60)]  # copies
    rows += [(3000 + n, [float(n % 3 == k % 3) for k in range(16)], 2) for n in range(40)]  # ties
    got, books = found(spark, rows, entries=30, rounds=3, tree_rows=50)
    want, exact = plain(rows, 30, 3)
    assert got == want and (books == exact).all()
    assert vc.digest(books) == __import__("hashlib").sha256(",".join(str(x) for x in exact.ravel()).encode()).hexdigest()


def test_trees_cover_separate_and_nest():
    points = np.floor(np.array(vectors(2, 500, 4, 0.02)) * 1024).astype(np.int64)
    points = np.concatenate([points, points[:70]])
    tree, place = vc.CoverTree.of(points)
    assert (tree.points[place] == points).all() and tree.counts[-1] == len(points) and (tree.sums[-1] == points.sum(0)).all()
    apart = np.sqrt(((tree.points[:, None] - tree.points[None]) ** 2).sum(2))
    for node, (start, end) in enumerate(zip(tree.start, tree.end)):
        assert np.isclose(apart[start, start:end].max(), tree.radius[node])
        below = range(tree.first_child[node], tree.first_child[node] + tree.children[node])
        assert (end - start == 1 and not below) or [(tree.start[c], tree.end[c]) for c in below][0][0] == start
        assert sum(tree.end[c] - tree.start[c] for c in below) in (0, end - start)
        own = tree.start[list(below)]
        if len(own) > 1:
            scale = 2.0 ** (np.ceil(np.log2(tree.radius[node])) - 1)
            assert apart[np.ix_(own, own)][~np.eye(len(own), dtype=bool)].min() > scale and max(tree.radius[list(below)]) <= scale


def test_whole_subtrees_are_assigned_without_comparing_their_points():
    points = np.floor(np.array(vectors(3, 1000, 8, 0.01)) * 1024).astype(np.int64)
    tree, _ = vc.CoverTree.of(points)
    entries = points[:12]
    nodes, entry, compared = tree.settle(entries)
    assert (tree.end - tree.start)[nodes].sum() == len(tree.points) and (tree.end - tree.start)[nodes].max() > 20
    assert compared < 0.2 * len(tree.points) * len(entries)
    code, distance = tree.codes(entries)
    exact = ((tree.points[:, None] - entries[None]) ** 2).sum(2)
    assert (code == exact.argmin(1)).all() and (distance == exact.min(1)).all()


def test_vectors_that_are_dropped(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(4, [0.5, -0.5, 1.0, 2.0], 1), (3, [0.25, 0.0, -1.0, 2.0], None), (3, [-0.0001, 0.0, -1.0, 2.0], None), (None, [0.1, 0.2, 0.3, 0.4], 7), (7, [0.1, 0.2, 0.3, 0.4], 7),
            (8, None, 1), (9, [None, 1.0, 1.0, 1.0], 1), (10, [nan, 1.0, 1.0, 1.0], 1), (11, [1.0, inf, 1.0, 1.0], 1), (None, None, None)]
    got, _ = found(spark, rows, entries=3, rounds=2)
    assert got == plain(rows, 3, 2)[0]
    odd = [(20, [], 1), (21, [1.0, 2.0, 3.0], 1), (22, [1.0] * 8, 1), (23, [5000.0, 0.0, 0.0, 0.0], 1)]
    assert found(spark, rows + odd, entries=3, rounds=2)[0] == got
    assert found(spark, [])[0] == [] and found(spark, rows[5:])[0] == []
    alone, _ = found(spark, rows[:1])
    assert alone == [(4, "00000000", 0, 0)]

"""Product codes of vectors, their codebooks fitted by Lloyd rounds over cover trees.

A vector's components become integers and are cut into PARTS equal parts. Every Spark task builds, for each
part position of TREE_ROWS vectors at a time, a cover tree: a node is one of the points and covers all points of
its subtree within its radius; its children are points of the subtree further from each other than half the
node's scale, every point with its nearest child. The points lie in the tree's order, so a subtree is a stretch
of them and its sum is a difference of two cumulative sums. Trees are written once and read in every round.

A round sends the codebooks to the trees. At a node with distance d to its nearest entry and radius r, no point
below can be nearer to an entry beyond d + 2r (the triangle inequality, twice). If one entry is left, the whole
subtree goes to it by its cumulative sums; otherwise the children go on with the entries that are left. Points
that no wider node could settle are compared exactly, ties to the lower index. All sums are integers and
distances squares of integers, so trees of any shape give the same codes.

Defined results: a vector that is null or holds null or non-finite components is dropped; so is one without
components, of another length than most (of equally frequent lengths the larger counts), of a length that PARTS
does not divide, or with a component so large that squared distances leave 2**53 (from 4096 up for up to
512 dimensions). Null ids come last in the order that the codebooks start from; rows with equal ids are ordered
by their vectors. With fewer than ENTRIES vectors there are as many entries. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm.common import stored, table

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
TREE_ROWS = 1_024  # vectors of one task that share a tree
TREE = "row array<bigint>, trees array<struct<part: int, points: array<int>, copies: array<int>, rows: array<int>, node_start: array<int>, node_end: array<int>, first_child: array<int>, children: array<int>, radius: array<double>>>"


# --- cover trees ---------------------------------------------------------------------------


class CoverTree:
    """Different points with how often each occurs; nodes in order of their level, each a stretch of points."""

    def __init__(self, points: np.ndarray, copies: np.ndarray, start, end, first_child, children, radius):
        self.points, self.copies = points, copies
        self.start, self.end, self.first_child, self.children, self.radius = start, end, first_child, children, radius
        weighted = points.astype(np.int64) * copies[:, None]
        self.sums = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(weighted, axis=0)])
        self.counts = np.concatenate([[0], np.cumsum(copies)])

    @classmethod
    def of(cls, vectors: np.ndarray) -> tuple[CoverTree, np.ndarray]:
        """The tree of rows of integers, and each row's place among its points."""
        points, row, copies = np.unique(vectors, axis=0, return_inverse=True, return_counts=True)
        exact = points.astype(np.float64)
        square = (exact**2).sum(1)
        apart = np.sqrt(np.maximum(square[:, None] + square[None] - 2 * exact @ exact.T, 0))
        order = np.arange(len(points))
        start, end, radius, first_child, children = [0], [len(points)], [apart[0].max()], [], []
        node = 0
        while node < len(start):
            first_child.append(len(start))
            below = order[start[node] : end[node]]
            if radius[node]:
                scale = 2.0 ** (np.ceil(np.log2(radius[node])) - 1)
                # The node's own point is its first child; the farthest point is the next, until all are covered.
                chosen, nearest, child = [below[0]], apart[below[0], below].copy(), np.zeros(len(below), np.int64)
                while nearest[far := nearest.argmax()] > scale:
                    distance = apart[below[far], below]
                    closer = distance < nearest
                    child[closer], nearest[closer] = len(chosen), distance[closer]
                    chosen.append(below[far])
                # Points by child, the child's own point first.
                order[start[node] : end[node]] = below = below[np.lexsort((nearest, child))]
                sizes = np.bincount(child, minlength=len(chosen))
                ends = np.cumsum(sizes)
                ordered = np.sort(child, kind="stable")
                reach = np.maximum.reduceat(apart[np.array(chosen)[ordered], below], ends - sizes)
                start += (start[node] + ends - sizes).tolist()
                end += (start[node] + ends).tolist()
                radius += reach.tolist()
            children.append(len(start) - first_child[-1])
            node += 1
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        tree = cls(points[order], copies[order], *(np.array(x, np.int64) for x in (start, end, first_child, children)), np.array(radius))
        return tree, place[row.ravel()]

    def settle(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(settled nodes, the entry of each, distances computed): every point is below one settled node."""
        exact, square = entries.astype(np.float64), (entries.astype(np.float64) ** 2).sum(1)
        nodes, left = np.zeros(1, np.int64), np.ones((1, len(entries)), bool)
        settled, entry, compared = [], [], 0
        while len(nodes):
            able = np.flatnonzero(left.any(0))  # ascending, so the first of equals is the lowest
            left = left[:, able]
            own = self.points[self.start[nodes]].astype(np.float64)
            distance = (own**2).sum(1)[:, None] + square[able][None] - 2 * own @ exact[able].T  # integers below 2**53
            distance[~left] = np.inf
            compared += int(left.sum())
            best = distance.argmin(1)
            root = np.sqrt(np.maximum(distance, 0))
            reach = root[np.arange(len(nodes)), best] + 2 * self.radius[nodes]
            left &= root <= (reach * (1 + 1e-9) + 1e-6)[:, None]
            done = (left.sum(1) == 1) | (self.radius[nodes] == 0)
            settled.append(nodes[done])
            entry.append(able[best[done]])
            many = self.children[nodes[~done]]
            nodes = np.repeat(self.first_child[nodes[~done]], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            wider = np.zeros((int((~done).sum()), len(entries)), bool)
            wider[:, able] = left[~done]
            left = np.repeat(wider, many, axis=0)
        return np.concatenate(settled), np.concatenate(entry), compared

    def add_to(self, sums: np.ndarray, counts: np.ndarray, entries: np.ndarray) -> None:
        """Adds the points to the sums and counts of their entries, subtree by subtree."""
        nodes, entry, _ = self.settle(entries)
        np.add.at(sums, entry, self.sums[self.end[nodes]] - self.sums[self.start[nodes]])
        np.add.at(counts, entry, self.counts[self.end[nodes]] - self.counts[self.start[nodes]])

    def codes(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every point's entry and squared distance."""
        nodes, entry, _ = self.settle(entries)
        order = np.argsort(self.start[nodes])
        code = np.repeat(entry[order], (self.end - self.start)[nodes[order]])
        return code, ((self.points.astype(np.int64) - entries[code]) ** 2).sum(1)

    def columns(self, part: int, rows: np.ndarray) -> dict:
        lists = {"points": self.points.ravel(), "copies": self.copies, "rows": rows, "node_start": self.start, "node_end": self.end, "first_child": self.first_child, "children": self.children}
        return {"part": part} | {k: v.astype(np.int32) for k, v in lists.items()} | {"radius": self.radius}


# --- tasks ---------------------------------------------------------------------------------


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _plant(batches: Iterator[pa.RecordBatch], parts: int, tree_rows: int) -> Iterator[pa.RecordBatch]:
    """Per `tree_rows` vectors one row: their row numbers and the trees of all part positions."""
    tree_type = pa.list_(pa.struct([
        ("part", pa.int32()), *((n, pa.list_(pa.int32())) for n in ("points", "copies", "rows", "node_start", "node_end", "first_child", "children")),
        ("radius", pa.list_(pa.float64())),
    ]))

    def planted(pieces: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(pieces).combine_chunks()
        vectors = _matrix(rows["numbers"].combine_chunks())
        width = vectors.shape[1] // parts
        trees = []
        for part in range(parts):
            tree, place = CoverTree.of(vectors[:, part * width : (part + 1) * width])
            trees.append(tree.columns(part, place))
        one = lambda name: pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows[name].combine_chunks())
        return pa.RecordBatch.from_arrays([one("row"), pa.array([trees], tree_type)], ["row", "trees"])

    pieces: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            some = batch.slice(at, tree_rows - held)
            pieces.append(some)
            at, held = at + some.num_rows, held + some.num_rows
            if held == tree_rows:
                yield planted(pieces)
                pieces, held = [], 0
    if pieces:
        yield planted(pieces)


def _trees(column: pa.ListArray) -> Iterator[tuple[int, CoverTree, np.ndarray]]:
    """(part, tree, place of each of its rows) of one stored row."""
    for one in column.values:
        get = lambda name: one[name].values.to_numpy()  # noqa: B023, E731
        copies = get("copies").astype(np.int64)
        tree = CoverTree(
            get("points").reshape(len(copies), -1), copies, *(get(n).astype(np.int64) for n in ("node_start", "node_end", "first_child", "children")), get("radius")
        )
        yield one["part"].as_py(), tree, get("rows")


def _sums(codebooks: np.ndarray):
    """One round in a task: sums and counts of what falls to every entry, as (part, entry, position, total, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(codebooks.shape, np.int64), np.zeros(codebooks.shape[:2], np.int64)
        for batch in batches:
            for row in batch.column("trees"):
                for part, tree, _ in _trees(row):
                    tree.add_to(sums[part], counts[part], codebooks[part])
        part, entry, position = np.nonzero(np.broadcast_to(counts[:, :, None] > 0, sums.shape))
        if len(part):
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x, pa.int32()) for x in (part, entry, position)), pa.array(sums[part, entry, position]), pa.array(counts[part, entry])],
                ["part", "entry", "position", "total", "n"],
            )

    return run


def _encode(codebooks: np.ndarray):
    """Every vector's code as hex digits and its squared distance to it."""
    digits = max(1, -(-(codebooks.shape[1] - 1).bit_length() // 8)) * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, trees in zip(batch.column("row"), batch.column("trees")):
                codes, error = [], 0
                for part, tree, place in _trees(trees):
                    code, distance = tree.codes(codebooks[part])
                    codes.append(code[place])
                    error = error + distance[place]
                text = ["".join(f"{n:0{digits}x}" for n in one) for one in np.stack(codes, 1).tolist()]
                yield pa.RecordBatch.from_arrays([rows.values, pa.array(text), pa.array(error, pa.int64())], ["row", "code", "error"])

    return run


# --- tables --------------------------------------------------------------------------------


def usable(vectors: DataFrame, vec_id: str, embedding: str, label: str, parts: int) -> DataFrame:
    """vec_id, label, numbers array<int> of the vectors that are encoded."""
    some = vectors.select(
        F.col(vec_id).cast("bigint").alias("vec_id"), F.col(label).alias("label"), F.col(embedding).cast("array<double>").alias("vec")
    ).where("vec IS NOT NULL")
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = some.where(finite).where((F.size("vec") > 0) & (F.size("vec") % parts == 0))
    usual = good.groupBy(F.size("vec").alias("length")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), F.desc("length")).first()
    length = usual["length"] if usual else 0
    # 2**53 holds the squared distance of two parts: width * (2 * largest * SCALE)**2
    largest = min(4096.0, 2.0 ** ((51 - (max(1, length // parts) - 1).bit_length()) // 2) / SCALE)
    fits = F.forall("vec", lambda x: F.abs(x) < largest)
    numbers = F.transform("vec", lambda x: F.floor(x * F.lit(float(SCALE))).cast("int")).alias("numbers")
    return good.where((F.size("vec") == length) & fits).select("vec_id", "label", numbers)


def coded(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
    tree_rows: int = TREE_ROWS,
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error of every vector; the codebooks by part, entry, position).

    On the driver are the codebooks alone: parts * entries rows of a vector's part.
    """
    spark = vectors.sparkSession
    rows = stored(usable(vectors, vec_id, embedding, label, parts).withColumn("row", F.monotonically_increasing_id()), "code-vectors")
    first = [r.numbers for r in rows.orderBy(F.col("vec_id").asc_nulls_last(), "numbers").select("numbers").limit(entries).collect()]
    if not first:
        return rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error")), np.zeros((parts, 0, 0), np.int64)
    codebooks = np.array(first, np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2)
    planted = stored(rows.select("row", "numbers").mapInArrow(lambda batches: _plant(batches, parts, tree_rows), TREE), "cover-trees")
    for _ in range(rounds):
        fallen = planted.select("trees").mapInArrow(_sums(codebooks), "part int, entry int, position int, total bigint, n bigint")
        means = fallen.groupBy("part", "entry", "position").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()
        codebooks = codebooks.copy()
        for r in means:
            codebooks[r.part, r.entry, r.position] = r.total // r.n
    codes = planted.mapInArrow(_encode(codebooks), "row bigint, code string, error bigint")
    return rows.select("row", "vec_id", "label").join(codes, "row").drop("row"), codebooks


def digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, chain.from_iterable(codebooks.reshape(len(codebooks), -1).tolist()))).encode()).hexdigest()


def with_label_errors(codes: DataFrame) -> DataFrame:
    """label_error: the errors summed over equal labels, nulls together (null where the sum leaves 64 bits)."""
    sums = codes.groupBy("label").agg(F.try_sum("error").alias("label_error")).withColumnRenamed("label", "__label")
    return codes.join(sums, F.col("label").eqNullSafe(F.col("__label"))).drop("__label")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's product code with its errors and the codebooks' digest."""
    codes, codebooks = coded(table(spark, sf_dir, "embeddings"))
    codes = with_label_errors(stored(codes, "vector-codes"))
    return codes.select("vec_id", "code", "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256"))


def _sql() -> str:
    """Every round as two tables: the nearest entry of every part, and the entries' next places."""
    nearest = """near{n} AS (
  SELECT row, part, m % {entries} AS entry, m // {entries} AS d
  FROM (SELECT p.row, p.part, min(CAST(list_inner_product(p.v, p.v) + list_inner_product(c.v, c.v) - 2 * list_inner_product(p.v, c.v) AS BIGINT) * {entries} + c.entry) AS m
        FROM parts p JOIN book{n} c ON c.part = p.part GROUP BY ALL)
), """
    moved = """sums{n} AS (
  SELECT n.part, n.entry, i, floor(sum(p.v[i]) / count(*)) AS m
  FROM near{n} n JOIN parts p ON p.row = n.row AND p.part = n.part, range(1, {width} + 1) t(i) GROUP BY ALL
), book{next} AS (
  SELECT b.part, b.entry, coalesce(s.v, b.v) AS v
  FROM book{n} b LEFT JOIN (SELECT part, entry, list(m ORDER BY i) AS v FROM sums{n} GROUP BY part, entry) s ON s.part = b.part AND s.entry = b.entry
), """
    width = 16
    rounds = "".join(nearest.format(n=n, entries=ENTRIES) + (moved.format(n=n, next=n + 1, width=width) if n < ROUNDS else "") for n in range(ROUNDS + 1))
    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) AS row, vec_id, label, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * {SCALE})) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
  SELECT row, part, v[part * {width} + 1 : part * {width} + {width}] AS v FROM kept, range({PARTS}) t(part)
), book0 AS (
  SELECT part, row - 1 AS entry, v FROM parts WHERE row <= {ENTRIES}
), {rounds}codes AS (
  SELECT k.vec_id, any_value(k.label) AS label, string_agg(format('{{:02x}}', n.entry), '' ORDER BY n.part) AS code, CAST(sum(n.d) AS BIGINT) AS error
  FROM kept k JOIN near{ROUNDS} n ON n.row = k.row GROUP BY k.row, k.vec_id
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(CAST(v[i] AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, i)) FROM book{ROUNDS}, range(1, {width} + 1) t(i)) AS codebooks_sha256
FROM codes
"""


OP13_SQL = _sql()

"""Approximate nearest neighbours on shifted space-filling curves.

A vector's direction is projected onto a few random axes, once per curve, shifted by the curve's own
offset, and mapped to its place on a Hilbert curve. Near vectors tend to be near on some curve. Each
curve is cut into blocks of equally many rows; a query looks at its own block and the neighbouring ones
of every curve, ranks what lies there by its exact cosine, and the curves' finds are merged.

The window is a share of all rows, BESIDE * 2 + 1 of BLOCKS per curve and never few rows, so recall does
not fall with the size of the table. Equal vectors are one entry with their smallest ids, which is all that any query
can need of them.

Blocks are dealt out in parts of at most PART_ROWS entries. A part's entries come first and are held as a
matrix, its queries stream past it.

Defined results: vectors that are null, empty, zero, or hold null or non-finite numbers take no part, nor
do those of another length than most have (of equally frequent lengths the larger counts); null ids take
no part; rows with a query's own id are not its candidates, and an id with several vectors counts with
its nearest; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vitrine.llm.common import stored, table

NEAREST = 5
CURVES = 16
AXES = 8
BITS = 7
BLOCKS = 40
BESIDE = 1
LEAST_ROWS = 50  # of a block; a table of fewer rows than two blocks is one block
PART_ROWS = 20_000
QUERY_EVERY = 50
SEED = 20
ROUNDING = 1e-12  # of a cosine computed by matrix product


# --- the curves ----------------------------------------------------------------------------


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places on the Hilbert curve of rows of cell numbers below 2**bits (Skilling's transform, on columns)."""
    x = cells.astype(np.int64).T.copy()
    axes = len(x)
    for bit in range(bits - 1, 0, -1):
        high, low = 1 << bit, (1 << bit) - 1
        for i in range(axes):
            inverted = (x[i] & high) != 0
            swap = np.where(inverted, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(inverted, low, swap)
            x[i] ^= swap
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    x ^= turn
    key = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(axes):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def curve_keys(vectors: np.ndarray, curves: int = CURVES) -> np.ndarray:
    """Rows of vectors → rows of their places on every curve."""
    size = vectors.shape[1]
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    random = np.random.default_rng(SEED)
    out = []
    for _ in range(curves):
        axes = np.linalg.qr(random.normal(size=(size, min(AXES, size))))[0]
        shift = random.random(axes.shape[1])
        spread = 1 / (1 + np.exp(-1.702 * (unit @ axes) * np.sqrt(size)))  # about evenly over 0 to 1
        out.append(hilbert_keys(((spread + shift) * (1 << (BITS - 1))).astype(np.int64)))
    return np.stack(out, 1)


# --- tables --------------------------------------------------------------------------------


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, vec array<double>) of the vectors that take part."""
    some = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    zero = F.forall("vec", lambda x: x == 0)
    good = some.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull()).where((F.size("vec") > 0) & finite & ~zero)
    sizes = good.groupBy(F.size("vec").alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), F.desc("n")).limit(1)
    return good.join(sizes.select("n"), F.size("vec") == F.col("n"), "left_semi")


def entries(good: DataFrame, most_ids: int) -> DataFrame:
    """One row per different vector: entry (its smallest id), vec, ids (its smallest ones).

    The rank below a bound is taken before the rows move as well, so a vector with very many copies
    sends a few rows from each task.
    """
    by_id = W.partitionBy("vec").orderBy("vec_id")
    # Zero has two signs; sums with zero have one.
    plain = good.select("vec_id", F.transform("vec", lambda x: x + F.lit(0.0)).alias("vec")).distinct()
    few = plain.withColumn("nth", F.row_number().over(by_id)).where(F.col("nth") <= most_ids)
    return few.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(F.col("ids")[0].alias("entry"), "vec", "ids")


def _matrix(column: pa.ListArray) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _with_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            keys = curve_keys(_matrix(batch.column("vec")))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), keys.shape[1]).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "keys"])


def _search(width: int):
    """Streams a sorted partition: per part its entries, then its queries; returns each query's nearest ids in the part."""

    def best(queries: pa.RecordBatch, held: np.ndarray, norms: np.ndarray, ids: list[list[int]]) -> Iterator[tuple[int, int, float]]:
        vectors = _matrix(queries.column("vec"))
        own = np.linalg.norm(vectors, axis=1)
        for start in range(0, len(vectors), 256):
            some = slice(start, start + 256)
            score = (vectors[some] @ held.T) / norms
            keep = min(width, len(held))
            # All that may be among the nearest by the exact score, ties included, are scored exactly.
            least = np.partition(score, len(held) - keep, axis=1)[:, len(held) - keep] - ROUNDING * own[some]
            for row, low, entry, vector, norm in zip(score, least, queries.column("entry").to_pylist()[some], vectors[some], own[some]):
                near = np.flatnonzero(row >= low)
                # The same sum wherever the pair is met.
                exact = (held[near] * vector).sum(1) / (norms[near] * norm)
                if len(near) > width:
                    near, exact = near[exact >= (cut := np.partition(exact, len(near) - width)[len(near) - width])], exact[exact >= cut]
                found = sorted((-s, i) for s, n in zip(exact.tolist(), near) for i in ids[n])[:width]
                for s, i in found:
                    yield entry, i, -s

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None
        matrices: list[np.ndarray] = []
        ids: list[list[int]] = []
        held = norms = None
        for batch in batches:
            part = np.stack([batch.column(c).to_numpy() for c in ("curve", "block", "part")], 1)
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            change = np.flatnonzero((np.diff(part, axis=0) != 0).any(1) | (np.diff(asks) != 0)) + 1
            for start, end in zip([0, *change], [*change, batch.num_rows]):
                if start == end:
                    continue
                some = batch.slice(start, end - start)
                if at is None or (part[start] != at).any():
                    at, matrices, ids, held = part[start], [], [], None
                if not asks[start]:
                    matrices.append(_matrix(some.column("vec")))
                    ids += some.column("ids").to_pylist()
                    continue
                if not ids:
                    continue
                if held is None:
                    held = np.concatenate(matrices)
                    norms = np.linalg.norm(held, axis=1)
                rows = list(best(some, held, norms, ids))
                if rows:
                    entry, vec_id, score = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(entry, pa.int64()), pa.array(vec_id, pa.int64()), pa.array(score, pa.float64())], ["entry", "vec_id", "score"]
                    )

    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = NEAREST, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row for which `is_query` (of vec_id) holds."""
    good = usable(vectors, vec_id, embedding)
    width = k + 1  # a query's own id may be among them
    plain = F.transform("vec", lambda x: x + F.lit(0.0)).alias("vec")
    every = entries(good, width)
    asking = good.where(is_query).select(F.col("vec_id").alias("query_id"), plain).distinct()
    known = stored(every.mapInArrow(_with_keys, "entry bigint, vec array<double>, ids array<bigint>, keys array<bigint>"), "curve-keys")
    queries = stored(asking.join(known.select("vec", "entry"), "vec").select("query_id", "entry"), "curve-queries")
    placed = known.select("entry", F.posexplode("keys").alias("curve", "key"))
    blocks = max(1, min(BLOCKS, known.count() // LEAST_ROWS))
    shares = [n / blocks for n in range(1, blocks)] or [0.0]  # a cut below all keys if there is one block
    cuts = placed.groupBy("curve").agg(F.percentile_approx("key", shares, 10_000).alias("cuts"))
    # Cuts that fall on one key are one cut, so no block between them is empty.
    block = F.size(F.filter(F.array_distinct("cuts"), lambda c: c <= F.col("key")))
    blocked = stored(placed.join(cuts, "curve").select("entry", "curve", block.alias("block")), "curve-blocks")
    parts = blocked.groupBy("curve", "block").agg(F.ceil(F.count(F.lit(1)) / PART_ROWS).cast("int").alias("parts"))
    slim = known.select("entry", "vec", "ids")
    held = (
        blocked.join(parts, ["curve", "block"])
        .withColumn("part", F.pmod(F.xxhash64("entry"), F.col("parts")).cast("int"))
        .join(slim, "entry")
        .select("curve", "block", "part", F.lit(0).alias("asks"), "entry", "vec", "ids")
    )
    around = F.explode(F.sequence(F.col("block") - BESIDE, F.col("block") + BESIDE))
    asks = (
        blocked.join(queries.select("entry").distinct(), "entry", "left_semi")
        .select("entry", "curve", around.alias("block"))
        .join(parts, ["curve", "block"])
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .join(slim, "entry")
        .select("curve", "block", "part", F.lit(1).alias("asks"), "entry", "vec", F.lit(None).cast("array<bigint>").alias("ids"))
    )
    dealt = held.unionByName(asks).repartition("curve", "block", "part").sortWithinPartitions("curve", "block", "part", "asks")
    found = dealt.mapInArrow(_search(width), "entry bigint, vec_id bigint, score double")
    one = found.groupBy("entry", "vec_id").agg(F.max("score").alias("score"))
    order = [F.desc("score"), F.asc("vec_id")]
    few = one.withColumn("nth", F.row_number().over(W.partitionBy("entry").orderBy(*order))).where(F.col("nth") <= width).drop("nth")
    each = queries.join(few, "entry").where(F.col("vec_id") != F.col("query_id"))
    # A query id with several vectors takes the nearer of what they find.
    best = each.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(*order))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest found of every fiftieth vector."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_EVERY == 0)

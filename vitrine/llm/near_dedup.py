"""Near-duplicate classes by DartMinHash (Christiani, 2020) and banded joining.

A text is the weighted set of its five-word sequences, a sequence weighing as often as it occurs.
Hashing throws darts at the plane of weight and rank: every sequence has darts of its own, the same in
every text, and a text owns those below its weight. The earliest dart of each of COORDINATES
coordinates is the signature; two texts agree in a coordinate with the probability of their weighted
Jaccard similarity. Only darts of low rank are thrown, about K ln K of them whatever the text's length.

Texts that agree in a whole band of coordinates meet in a bucket. Equal texts are one node there. First
every node is compared with the smallest node it meets; what links forms components. Then, in buckets
that still hold several components, every node outside the bucket's largest component is compared with
all nodes of other components: by signature, and what is near enough by the exact similarity. So no
pairs are made inside a component, and no pair of a bucket is left out.

Defined results: words are runs of letters, digits and underscores, lower-cased; a text of one to four
words is a single sequence; a text without words is in a class of its own; so is every row without an
id; rows with the same id are one document for the class's smallest id; an empty table gives an empty
table.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vitrine.llm import linking
from vitrine.llm.common import merge_join, stored, table
from vitrine.llm.letters import pieces_of

WORDS = 5
SIMILAR = 0.8
BANDS, ROWS = 25, 5
COORDINATES = BANDS * ROWS
# Coordinates in which texts at SIMILAR agree at least, but for seven standard deviations.
AGREEING = int(COORDINATES * SIMILAR - 7 * (COORDINATES * SIMILAR * (1 - SIMILAR)) ** 0.5)
KNOWN_WORDS = 100_000

_WORD = re.compile(r"\w+")
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]
_POISSON = np.cumsum(np.exp(-1) / np.cumprod([1, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12]))


def _mixed(x: np.ndarray, by: np.uint64) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * by
    x = (x ^ (x >> np.uint64(29))) * _M[1]
    return x ^ (x >> np.uint64(32))


def _uniform(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


# --- texts as weighted sets ----------------------------------------------------------------


class _Words(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        number = self[word] = xxhash.xxh3_64_intdigest(word)
        return number


_numbers = _Words()


def weighted_sets(texts: list[str | None]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """(digest of each text's words; text number, sequence and weight of each different sequence, by text)."""
    words = [_WORD.findall((t or "").lower()) for t in texts]
    digests = [hashlib.md5(" ".join(w).encode()).digest() for w in words]
    counts = np.array([len(w) for w in words], np.int64)
    flat = np.fromiter((_numbers[x] for w in words for x in w), np.uint64, int(counts.sum()))
    owner = np.repeat(np.arange(len(texts)), counts)
    left = np.repeat(np.cumsum(counts), counts) - np.arange(len(flat))  # words from here to the text's end
    sequence = np.zeros(len(flat), np.uint64)
    padded = np.concatenate([flat, np.zeros(WORDS, np.uint64)])
    for ahead in range(WORDS):
        sequence = _mixed(sequence + np.where(left > ahead, padded[ahead : ahead + len(flat)], np.uint64(0)), _M[ahead])
    first = np.repeat(np.cumsum(counts) - counts, counts) == np.arange(len(flat))
    whole = (left >= WORDS) | first
    owner, sequence = owner[whole], sequence[whole]
    order = np.lexsort((sequence, owner))
    owner, sequence = owner[order], sequence[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (sequence[1:] != sequence[:-1])
    starts = np.flatnonzero(new)
    return digests, owner[starts], sequence[starts], np.diff(np.append(starts, len(owner)))


def elements(owner: np.ndarray, sequence: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, number) of the units of every sequence's weight: plain sets with the same similarity."""
    nth = np.arange(weight.sum()) - np.repeat(np.cumsum(weight) - weight, weight)
    return np.repeat(owner, weight), _mixed(np.repeat(sequence, weight) + nth.astype(np.uint64) * _M[2], _M[3])


# --- darts ---------------------------------------------------------------------------------


def _darts(sequence: np.ndarray, weight: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(element, dart, rank) of all darts below each element's weight and rank limit.

    The weights are cut into slabs 0 to 1, 1 to 2, 2 to 4, 4 to 8 and so on, the ranks of a slab into
    cells of area 1. A cell holds Poisson many darts, evenly spread.
    """
    found = []
    slab = 0
    inside = np.arange(len(sequence))
    while len(inside):
        low, width = (0.0, 1.0) if slab == 0 else (2.0 ** (slab - 1), 2.0 ** (slab - 1))
        cells = np.ceil(rank[inside] * width).astype(np.int64)
        element = np.repeat(inside, cells)
        cell = np.arange(len(element)) - np.repeat(np.cumsum(cells) - cells, cells)
        seed = _mixed(sequence[element] + (cell.astype(np.uint64) * np.uint64(64) + np.uint64(slab)) * _M[0], _M[4])
        many = np.searchsorted(_POISSON, _uniform(seed), "right")
        at = np.repeat(np.arange(len(element)), many)
        nth = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
        dart = _mixed(seed[at] + (nth.astype(np.uint64) + np.uint64(1)) * _M[3], _M[2])
        element = element[at]
        ranks = (cell[at] + _uniform(_mixed(dart, _M[0]))) / width
        hit = (ranks < rank[element]) & (low + _uniform(_mixed(dart, _M[4])) * width < weight[element])
        found.append((element[hit], dart[hit], ranks[hit]))
        inside = inside[weight[inside] > low + width]
        slab += 1
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*found))


def signatures(n_texts: int, owner: np.ndarray, sequence: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A byte of the earliest dart of every coordinate, per text; zeros for a text without sequences."""
    out = np.zeros((n_texts, COORDINATES), np.uint8)
    total = np.bincount(owner, weight, n_texts)
    darts = COORDINATES * (np.log(COORDINATES) + 4)
    todo = total > 0
    while todo.any():
        some = todo[owner]
        texts = owner[some]
        element, dart, rank = _darts(sequence[some], weight[some].astype(float), darts / total[texts])
        seat = texts[element] * COORDINATES + (_mixed(dart, _M[2]) % np.uint64(COORDINATES)).astype(np.int64)
        earliest = np.full(n_texts * COORDINATES, np.inf)
        np.minimum.at(earliest, seat, rank)
        wins = rank == earliest[seat]
        sign = np.zeros(n_texts * COORDINATES, np.uint8)
        sign[seat[wins]] = (dart[wins] >> np.uint64(20)).astype(np.uint8)
        full = ~np.isinf(earliest.reshape(n_texts, COORDINATES)).any(1) & todo
        out[full] = sign.reshape(n_texts, COORDINATES)[full]
        todo &= ~full
        darts *= 2
    return out


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces_of(batches, 64):
        digests, owner, sequence, weight = weighted_sets(batch.column("text").to_pylist())
        total = np.bincount(owner, weight, batch.num_rows).astype(np.int64)
        signed = signatures(batch.num_rows, owner, sequence, weight)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(digests, pa.binary()), pa.array(total), pa.array([s.tobytes() if t else None for s, t in zip(signed, total)], pa.binary())],
            ["doc_id", "digest", "weight", "signature"],
        )


def sketched(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, digest of the words, weight, signature (null without words)."""
    some = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return some.mapInArrow(_sketch, "doc_id bigint, digest binary, weight bigint, signature binary")


# --- candidates ----------------------------------------------------------------------------


def _buckets(nodes: DataFrame) -> DataFrame:
    """(bucket, node, weight) of the buckets in which nodes meet."""
    band = F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band")
    each = nodes.select("node", "weight", "signature", band)
    rows = F.conv(F.hex(F.expr(f"substring(signature, band * {ROWS} + 1, {ROWS})")), 16, 10).cast("bigint")
    keyed = each.select((F.shiftleft(F.col("band").cast("bigint"), 8 * ROWS) + rows).alias("bucket"), "node", "weight")
    shared = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    return merge_join(keyed, shared, "bucket")


# --- exact similarity ----------------------------------------------------------------------


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces_of(batches, 64):
        digests, *sets = weighted_sets(batch.column("text").to_pylist())
        owner, units = elements(*sets)
        sizes = np.bincount(owner, minlength=batch.num_rows)
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(units.view(np.int64)))
        own = pa.array([d == w for d, w in zip(digests, batch.column("digest").to_pylist())])
        rows = pa.RecordBatch.from_arrays([batch.column("node"), lists], ["node", "elements"])
        yield rows.filter(own)  # another text may have the same id


def _elements(docs: DataFrame, nodes: DataFrame, buckets: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(node, elements) of the nodes that meet others."""
    met = merge_join(nodes, buckets.select("node").distinct(), "node").select("node", "digest", "rep")
    texts = merge_join(docs.select(F.col(doc_id).cast("bigint").alias("rep"), F.col(text).alias("text")), met, "rep")
    return texts.select("node", "digest", "text").mapInArrow(_units, "node bigint, elements array<bigint>").dropDuplicates(["node"])


class Signed:
    """The signatures and elements of a part's nodes."""

    def __init__(self, held: pa.Table):
        self.weight = held["weight"].to_numpy()
        self.signed = np.frombuffer(b"".join(held["signature"].to_pylist()), np.uint8).reshape(-1, COORDINATES)
        sets = held["elements"].combine_chunks()
        self.sizes = np.diff(sets.offsets.to_numpy())
        units = sets.flatten().to_numpy()
        order = np.argsort(units, kind="stable")
        self.units, self.owner = units[order], np.repeat(np.arange(len(self.sizes)), self.sizes)[order]

    def near(self, rows: pa.Table, i: int, others: np.ndarray) -> np.ndarray:
        """By signature first, and what is near enough by the exact similarity."""
        weight = rows["weight"][i].as_py()
        alike = np.minimum(self.weight, weight) >= SIMILAR * np.maximum(self.weight, weight)
        able = np.flatnonzero(others & alike)
        able = able[(self.signed[able] == np.frombuffer(rows["signature"][i].as_py(), np.uint8)).sum(1) >= AGREEING]
        if not len(able):
            return able
        mine = rows["elements"][i].values.to_numpy()
        low, high = np.searchsorted(self.units, mine, "left"), np.searchsorted(self.units, mine, "right")
        count = high - low
        at = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
        common = np.bincount(self.owner[at], minlength=len(self.sizes))[able]
        return able[common >= SIMILAR * (len(mine) + self.sizes[able] - common)]


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, class_id (the class's smallest id), class_size (rows); one row per row of `docs`."""
    rows = stored(sketched(docs, doc_id, text), "sketches")
    alone = F.col("signature").isNull() | F.col("doc_id").isNull()
    nodes = rows.where(~alone).groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.first("weight").alias("weight"), F.first("signature").alias("signature"), F.count(F.lit(1)).alias("n")
    )
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")  # numbers stay as written
    buckets = stored(_buckets(nodes), "buckets")
    units = _elements(docs, nodes, buckets, doc_id, text)
    payload = stored(merge_join(nodes.select("node", "weight", "signature"), units, "node"), "elements")
    labels = linking.connected(buckets, payload, Signed)
    final = merge_join(nodes.select("digest", "node", "rep", "n"), labels, "node", "left")
    final = final.select("digest", "rep", "n", F.coalesce("component", "node").alias("class"))
    sizes = final.groupBy("class").agg(F.min("rep").alias("class_id"), F.sum("n").alias("class_size"))
    named = final.join(sizes, "class").select("digest", "class_id", "class_size")
    linked = merge_join(rows.where(~alone).select("doc_id", "digest"), named, "digest").select("doc_id", "class_id", "class_size")
    own = rows.where(alone).select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("bigint").alias("class_size"))
    return linked.unionByName(own)


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` with the smallest id of their class, all columns as they were.

    Of rows equal in id and text one stays; rows without an id stay.
    """
    columns = docs.columns
    kept = classes(docs, doc_id, text).where("doc_id = class_id").select(F.col("doc_id").alias("__id")).distinct()
    joined = docs.join(kept, F.col(doc_id).cast("bigint") == F.col("__id"), "left")
    first = F.row_number().over(W.partitionBy(F.col("__id"), F.col(doc_id), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))).orderBy(F.lit(1)))
    stays = F.col(doc_id).isNull() | (F.col("__id").isNotNull() & (F.col("__first") == 1))
    return joined.withColumn("__first", first).where(stays).select(*[F.col(f"`{c}`") for c in columns])


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return classes(table(spark, sf_dir, "documents").select("doc_id", "text"))

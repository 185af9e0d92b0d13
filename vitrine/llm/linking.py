"""Components of similar nodes that meet in buckets, without the pairs of a group ever being rows.

Nodes that share one bucket mostly share many. So buckets with the same smallest node are one group, in which every
node of theirs is once, and what a node holds travels once per group. A group is dealt into parts of bounded size;
a part searches itself, joins what is similar in a union-find and returns a spanning forest, at most one
link less than it has nodes. That settles groups of one part. Groups of several parts are dealt and searched
once more in another way, which joins nearly all that hangs together; then, in groups that still hold several
components, the nodes outside the largest one are looked up in all parts, and again only a forest comes back. So
no similar pair of a bucket is left out, and a group of any size is linear in its nodes as long as its parts hang
together.

What similar means, and how a part is searched, is up to the caller: `index_of(held)` takes the rows of a part
(an Arrow table) and returns an object whose `near(rows, i, others)` gives the positions of held rows similar
to row `i` of `rows`; it may leave out those that the mask `others` leaves out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import merge_join, stored

PART_NODES, PART_WEIGHT = 1_000, 1_000_000  # of a group's nodes that one search holds
DEALS = 2
EDGES = "a bigint, b bigint"


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes with an edge (a, b) of a written table; a component is its smallest node.

    Every round takes the smallest label among neighbours and then that label's own label; rounds grow
    with the logarithm of a component's diameter, and each is a written table.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("component"))
    labels = stored(labels, "labels")
    while True:
        seen = merge_join(both, labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        nearer = merge_join(labels, seen, "node").select("node", "component", F.least("component", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("component").alias("far"))
        moved = stored(merge_join(nearer, jump, "next", "left").select("node", "component", F.least("next", F.coalesce("far", "next")).alias("next")), "labels")
        labels = moved.select("node", F.col("next").alias("component"))
        if moved.where("component <> next").isEmpty():
            return labels


# --- a part --------------------------------------------------------------------------------


class Part:
    """The held rows of one part, and which of their components have been joined so far."""

    def __init__(self, held: pa.Table, index_of: Callable):
        names, label = np.unique(held["component"].to_numpy(), return_inverse=True)
        self.names: list[int] = names.tolist()
        self.number = {name: n for n, name in enumerate(self.names)}
        self.root = list(range(len(names)))  # of a component: the one it has been joined to
        self.label = label  # of a held row: its component's root
        self.index = index_of(held)

    def _root(self, name: int) -> int:
        at = self.number.get(name)
        if at is None:
            at = self.number[name] = len(self.names)
            self.names.append(name)
            self.root.append(at)
        while self.root[at] != at:
            self.root[at] = at = self.root[self.root[at]]
        return at

    def ask(self, rows: pa.Table) -> Iterator[tuple[int, int]]:
        """Links between components that hold rows similar to these, each joining two that were apart."""
        for i, name in enumerate(rows["component"].to_pylist()):
            mine = self._root(name)
            others = self.label != mine
            if others.any():
                for other in np.unique(self.label[self.index.near(rows, i, others)]).tolist():
                    if other != mine:
                        yield self.names[mine], self.names[other]
                        self.root[other] = mine
                        self.label[self.label == other] = mine


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """((bucket, part, asks), rows that follow each other with it) of a sorted partition."""
    for batch in batches:
        key = np.stack([batch.column(c).to_numpy() for c in ("bucket", "part", "asks")], 1)
        change = np.flatnonzero((np.diff(key, axis=0) != 0).any(1)) + 1
        for start, end in zip([0, *change], [*change, batch.num_rows]):
            if start < end:
                yield tuple(key[start].tolist()), batch.slice(start, end - start)


def forest(index_of: Callable) -> Callable:
    """Links of a partition sorted by bucket, part, asks. A part without asking rows searches itself."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int]]:
        at, pieces, part = None, [], None
        for (*key, asks), rows in _stretches(batches):
            if key != at:
                if pieces and part is None:
                    yield from _own(pieces)
                at, pieces, part = key, [], None
            if not asks:
                pieces.append(rows)
            elif pieces:
                part = part or Part(pa.Table.from_batches(pieces).combine_chunks(), index_of)
                yield from part.ask(pa.Table.from_batches([rows]))
        if pieces and part is None:
            yield from _own(pieces)

    def _own(pieces: list[pa.RecordBatch]) -> Iterator[tuple[int, int]]:
        held = pa.Table.from_batches(pieces).combine_chunks()
        if held.num_rows > 1:
            yield from Part(held, index_of).ask(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = list(links(batches))  # fewer than the partition has rows
        if found:
            a, b = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


# --- tables --------------------------------------------------------------------------------


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after components have been linked."""
    if links.isEmpty():
        return labels
    whole = components(links).select(F.col("node").alias("component"), F.col("component").alias("whole"))
    return stored(merge_join(labels, whole, "component", "left").select("node", F.coalesce("whole", "component").alias("component")), "labels")


def _searched(rows: DataFrame, payload: DataFrame, index_of: Callable) -> DataFrame:
    """Links of rows (bucket, part, asks, node, component)."""
    dealt = merge_join(rows, payload, "node").repartition("bucket", "part").sortWithinPartitions("bucket", "part", "asks")
    return stored(dealt.mapInArrow(forest(index_of), EDGES), "links")


def _grouped(buckets: DataFrame) -> DataFrame:
    """(bucket, node, parts): groups of more than one node, named by the smallest node of their buckets."""
    lead = buckets.groupBy("bucket").agg(F.min("node").alias("lead"))
    led = merge_join(buckets, lead, "bucket").groupBy(F.col("lead").alias("bucket"), "node").agg(F.max("weight").alias("weight"))
    parts = F.ceil(F.greatest(F.count(F.lit(1)) / PART_NODES, F.sum("weight") / PART_WEIGHT)).cast("int")
    sizes = led.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), parts.alias("parts")).where("n > 1").drop("n")
    return stored(led.join(sizes, "bucket").select("bucket", "node", "parts"), "groups")


def _part(salt: int) -> Column:
    return F.pmod(F.xxhash64("node", F.lit(salt)), F.col("parts")).cast("int").alias("part")


def connected(buckets: DataFrame, payload: DataFrame, index_of: Callable) -> DataFrame:
    """(node, component) of all nodes of `buckets` (bucket, node, weight), each at most once per bucket.

    `payload` has one row per node with the columns that `index_of` reads, `weight` says how much a node holds.
    """
    groups = _grouped(buckets)
    own = groups.select("bucket", _part(0), F.lit(0).alias("asks"), "node", F.col("node").alias("component"))
    labels = groups.select("node").distinct().withColumn("component", F.col("node"))
    labels = _joined(labels, _searched(own, payload, index_of))
    large = groups.where("parts > 1")
    if large.isEmpty():
        return labels
    for deal in range(1, DEALS):
        again = merge_join(large, labels, "node").select("bucket", _part(deal), F.lit(0).alias("asks"), "node", "component")
        labels = _joined(labels, _searched(again, payload, index_of))
    placed = merge_join(large, labels, "node")
    per = placed.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    mixed = per.groupBy("bucket").agg(F.count(F.lit(1)).alias("components"), F.max_by("component", F.struct("n", "component")).alias("main"))
    rows = stored(placed.join(mixed.where("components > 1").drop("components"), "bucket"), "mixed-groups")
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    held = rows.select("bucket", _part(0), F.lit(0).alias("asks"), "node", "component")
    asks = rows.where("component <> main").select("bucket", every, F.lit(1).alias("asks"), "node", "component")
    return _joined(labels, _searched(held.unionByName(asks), payload, index_of))

"""N-gram Jaccard join by T-occurrence search.

A text is its set of different five-word shingles. Texts link when at least four fifths of their shingles, of
all that either has, are in both. A text of n shingles so needs candidates that are in at least T = 4n/5 of
the inverted lists of its shingles. DivideSkip finds them: the L longest lists are set apart; the short ones
are merged through a heap, the two shortest runs first; whoever is in T - L of those is probed for in the
long lists by binary search and retained if its count reaches the overlap that its own size asks for.

Where inverted lists lie together is settled by sketches, the SKETCH smallest shingle numbers of every set. Of
a linked pair's joint SKETCH smallest at least four fifths are expected in both, so either sketch shares a
third of its numbers with the other but for a chance of 6 in 10^15 (texts of up to SKETCH shingles: certainly).
Texts sharing less with all other texts have no link and are done. Of the others' shared numbers, ordered by
how many texts have them, the frequent ones that any partner must exceed are left out; each remaining
number is a bucket, and buckets with the same texts are searched together, in parts of bounded size (see linking).

Equal sets are one node. Shingles are 64-bit hashes.

Defined results: A-Z are lower-cased and words end at ASCII white space, nothing else; a text of one to four
words has its whole sequence as its one shingle; null, empty and wordless texts have no shingle and no link, nor
do rows without an id (they still count their shingles); rows are linked one by one, also where an id comes again, and
a component's smallest id is that of its rows; an empty table gives an empty table. One row per row of the input; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from math import log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vitrine.llm import linking
from vitrine.llm.common import UPPER, stored, table
from vitrine.llm.letters import pieces_of

WORDS = 5
SKETCH = 64
SHARED = 3  # a linked text shares at least one in so many of its sketch
PROBE_COST = 0.0085  # of a binary probe against a step of the merge, for the number of lists set apart
PROBES = 1_000_000  # made at once
KNOWN_WORDS = 100_000

_M = [np.uint64(x) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]


# --- texts as sets -------------------------------------------------------------------------


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        number = self[word] = xxhash.xxh3_64_intdigest(word)
        return number


_numbers = _Words()


def shingle_sets(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, shingle) of the different shingles of every text in UTF-8, ascending by both."""
    words = [(t or b"").lower().split() for t in texts]  # of bytes: ASCII letters and white space only
    counts = np.array([len(w) for w in words], np.int64)
    flat = np.fromiter((_numbers[x] for w in words for x in w), np.uint64, int(counts.sum()))
    owner = np.repeat(np.arange(len(texts)), counts)
    left = np.repeat(np.cumsum(counts), counts) - np.arange(len(flat))  # words from here to the text's end
    padded = np.concatenate([flat, np.zeros(WORDS, np.uint64)])
    shingle = np.full(len(flat), _M[2])
    for ahead in range(WORDS):
        mixed = (shingle ^ np.where(left > ahead, padded[ahead : ahead + len(flat)], np.uint64(ahead))) * _M[0]
        shingle = (mixed ^ (mixed >> np.uint64(29))) * _M[1]
        shingle ^= shingle >> np.uint64(32)
    first = np.repeat(np.cumsum(counts) - counts, counts) == np.arange(len(flat))
    whole = (left >= WORDS) | first
    owner, shingle = owner[whole], shingle[whole].view(np.int64)
    order = np.lexsort((shingle, owner))
    owner, shingle = owner[order], shingle[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (shingle[1:] != shingle[:-1])
    return owner[new], shingle[new]


def _lists(owner: np.ndarray, values: np.ndarray, rows: int) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=rows))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


def _digests(lists: pa.ListArray) -> list[bytes]:
    flat, ends = lists.flatten().to_numpy(), lists.offsets.to_numpy()
    return [hashlib.md5(flat[a:b].tobytes()).digest() for a, b in zip(ends, ends[1:])]


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces_of(batches, 64):
        owner, shingle = shingle_sets(batch.column("text").to_pylist())
        sets = _lists(owner, shingle, batch.num_rows)
        sizes = np.diff(sets.offsets.to_numpy())
        low = np.arange(len(owner)) - np.repeat(sets.offsets.to_numpy()[:-1], sizes) < SKETCH
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(_digests(sets), pa.binary()), pa.array(sizes, pa.int64()), _lists(owner[low], shingle[low], batch.num_rows)],
            ["doc_id", "digest", "n_shingles", "sketch"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces_of(batches, 64):
        owner, shingle = shingle_sets(batch.column("text").to_pylist())
        sets = _lists(owner, shingle, batch.num_rows)
        own = pa.array([d == w for d, w in zip(_digests(sets), batch.column("digest").to_pylist())])
        yield pa.RecordBatch.from_arrays([batch.column("node"), sets], ["node", "shingles"]).filter(own)  # another text may have the same id


# --- the search ----------------------------------------------------------------------------


def heap_merged(runs: list[np.ndarray]) -> np.ndarray:
    """Ascending runs as one, the two shortest first."""
    heap = [(len(run), n, run) for n, run in enumerate(runs)]
    heapify(heap)
    n = len(runs)
    while len(heap) > 1:
        both = np.concatenate([heappop(heap)[2], heappop(heap)[2]])
        both.sort(kind="stable")
        heappush(heap, (len(both), n := n + 1, both))
    return heap[0][2] if heap else np.zeros(0, np.int64)


class InvertedLists:
    """The shingles of a part's texts, each with the positions of the texts that have it."""

    def __init__(self, held: pa.Table):
        sets = held["shingles"].combine_chunks()
        self.sizes = np.diff(sets.offsets.to_numpy())
        flat = sets.flatten().to_numpy()
        order = np.argsort(flat, kind="stable")
        flat, self.texts = flat[order], np.repeat(np.arange(len(self.sizes)), self.sizes)[order]
        new = np.ones(len(flat), bool)
        new[1:] = flat[1:] != flat[:-1]
        self.starts = np.append(np.flatnonzero(new), len(flat))
        self.shingles = flat[new]
        self.members = (np.cumsum(new) - 1) * len(self.sizes) + self.texts  # list and text as one ascending number

    def near(self, rows: pa.Table, i: int, others: np.ndarray) -> np.ndarray:
        mine = rows["shingles"][i].values.to_numpy()
        n = len(mine)
        at = np.searchsorted(self.shingles, mine)
        at[at == len(self.shingles)] = 0
        lists = at[self.shingles[at] == mine]
        least = -(-4 * n // 5)  # T, of the smallest text that can link
        if len(lists) < least:
            return np.zeros(0, np.int64)
        lengths = self.starts[lists + 1] - self.starts[lists]
        order = np.argsort(lengths, kind="stable")
        lists, lengths = lists[order], lengths[order]
        apart = min(least - 1, int(least / (PROBE_COST * log2(lengths[-1] + 1) + 1)))  # L
        short, long = lists[: len(lists) - apart], lists[len(lists) - apart :]
        single = lengths[: len(short)] == 1
        runs = [self.texts[self.starts[k] : self.starts[k + 1]] for k in short[~single]]
        merged = heap_merged([np.sort(self.texts[self.starts[short[single]]]), *runs])
        new = np.ones(len(merged), bool)
        new[1:] = merged[1:] != merged[:-1]
        starts = np.flatnonzero(new)
        texts, count = merged[starts], np.diff(np.append(starts, len(merged)))
        sizes = self.sizes[texts]
        needed = -(-4 * (n + sizes) // 9)  # the overlap that makes four fifths of the union
        able = (count >= least - apart) & (count + apart >= needed) & others[texts] & (5 * sizes >= 4 * n) & (4 * sizes <= 5 * n)
        texts, count, needed = texts[able], count[able], needed[able]
        step = max(1, PROBES // max(1, len(long)))
        for start in range(0, len(texts), step):
            some = slice(start, start + step)
            sought = (long * len(self.sizes))[:, None] + texts[some][None]
            place = np.searchsorted(self.members, sought)
            place[place == len(self.members)] = 0
            count[some] += (self.members[place] == sought).sum(0)
        return texts[count >= needed]


# --- tables --------------------------------------------------------------------------------


def sketched(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, digest of the set, n_shingles, sketch."""
    some = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return some.mapInArrow(_sketch, "doc_id bigint, digest binary, n_shingles bigint, sketch array<bigint>")


def _buckets(nodes: DataFrame) -> DataFrame:
    """(bucket, node, weight): the shared sketch numbers in which any linked pair meets."""
    each = nodes.select("node", F.col("n_shingles").alias("weight"), F.explode("sketch").alias("bucket"))
    shared = each.groupBy("bucket").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1")
    hits = stored(each.join(shared, "bucket"), "shared-numbers")
    least = F.ceil(F.least("weight", F.lit(SKETCH)) / SHARED)
    able = hits.groupBy("node", "weight").agg(F.count(F.lit(1)).alias("hits")).withColumn("spare", F.col("hits") - least).where("spare >= 0")
    rarest = F.row_number().over(W.partitionBy("node").orderBy("texts", "bucket"))
    kept = hits.join(able.select("node", "spare"), "node").withColumn("nth", rarest).where("nth <= spare + 1")
    full = kept.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    return kept.select("bucket", "node", "weight").join(full, "bucket")


def linked(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id reachable by links); one row per row of `docs`."""
    rows = stored(sketched(docs, doc_id, text), "shingle-sketches")
    alone = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    nodes = rows.where(~alone).groupBy("digest").agg(F.min("doc_id").alias("node_id"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "shingle-nodes")  # numbers stay as written
    buckets = stored(_buckets(nodes), "shingle-buckets")
    met = nodes.join(buckets.select("node").distinct(), "node").select("node", "digest", F.col("node_id").alias("__id"))
    texts = docs.select(F.col(doc_id).cast("bigint").alias("__id"), F.col(text).cast("binary").alias("text")).join(met, "__id")
    sets = texts.select("node", "digest", "text").mapInArrow(_sets, "node bigint, shingles array<bigint>").dropDuplicates(["node"])
    labels = linking.connected(buckets, stored(sets, "shingle-sets"), InvertedLists)
    named = nodes.select("digest", "node", "node_id").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("node_id").alias("component_id"))
    whole = named.join(smallest, "component").select("digest", "component_id")
    found = rows.where(~alone).select("doc_id", "n_shingles", "digest").join(whole, "digest").select("doc_id", "n_shingles", "component_id")
    own = rows.where(alone).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return found.unionByName(own)


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its number of shingles and the component of its links."""
    return linked(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP11_SQL = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), sets AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), links AS (
  SELECT a, b
  FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM sets x JOIN sets y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL) p
  JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
  WHERE 100 * common >= 80 * (s.n + t.n - common)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sizes
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
)
SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, coalesce(min(r.other), d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN reach r ON r.doc_id = d.doc_id
GROUP BY d.doc_id
"""

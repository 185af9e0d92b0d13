"""Reversible line dedup: sharded cuckoo filters in front of exact reference counts.

The state is three tables. `postings` says which document holds which line key, `refs` counts the
documents of each key and knows the largest one, and `filters` has, per shard of the keys, a cuckoo
filter of the keys that at least `min_docs` documents share. Documents can be added and deleted
again; a key whose count falls below the bound leaves its filter, and its lines come back.

To decide, a document's keys are first asked of the shard's filter. It has no false negatives, so
most keys end there; hits are settled by the exact counts.

Defined results: a null text is one empty line; keys shorter than `min_chars` never count; a null
id is below every other and all rows with a null id are one document; a document given twice counts
once; an empty table gives empty tables.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm.common import UPPER, ascii_lower, stored, table

MIN_CHARS = 40
MIN_DOCS = 5
SHARDS = 256  # a shard's keys are in one task when its filter is built anew
SALTS = 8  # parts in which the askers of one shard are dealt out, each with a copy of the filter
SPACE = " \t\n\x0b\x0c\r"

SLOTS = 4
LOAD = 0.8  # a filter is built anew, twice as large, before it is fuller
KICKS = 500  # rounds of displacement before the rest goes to the stash

FILTER = "shard int, n_keys bigint, capacity bigint, filter binary"


# --- the filter ----------------------------------------------------------------------------


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; a key lies in one of two buckets or in the stash.

    Insertion and lookup take whole arrays of 64-bit hashes.
    """

    def __init__(self, slots: np.ndarray, stash: np.ndarray):
        self.slots, self.stash = slots, stash

    @classmethod
    def sized(cls, n_keys: int) -> CuckooFilter:
        buckets = 2
        while buckets * SLOTS * LOAD < 2 * n_keys:
            buckets *= 2
        return cls(np.zeros((buckets, SLOTS), np.uint16), np.zeros((0, 2), np.uint32))

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        buckets, stashed = struct.unpack_from("<II", data)
        slots = np.frombuffer(data, np.uint16, buckets * SLOTS, 8).reshape(buckets, SLOTS).copy()
        return cls(slots, np.frombuffer(data, np.uint32, stashed * 2, 8 + slots.nbytes).reshape(stashed, 2).copy())

    def to_bytes(self) -> bytes:
        return struct.pack("<II", len(self.slots), len(self.stash)) + self.slots.tobytes() + self.stash.tobytes()

    @property
    def capacity(self) -> int:
        return int(self.slots.size * LOAD)

    def _other(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        return bucket ^ ((prints.astype(np.uint32) * np.uint32(0x5BD1E995)) & np.uint32(len(self.slots) - 1))

    def _place(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = hashes.astype(np.int64).view(np.uint64)
        prints = ((h >> np.uint64(48)) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
        return prints, (h & np.uint64(len(self.slots) - 1)).astype(np.uint32)

    def insert(self, hashes: np.ndarray) -> None:
        """Adds each hash once; all pending fingerprints move together, one eviction per bucket and round."""
        prints, bucket = self._place(hashes)
        for turn in range(KICKS):
            for _ in range(2):  # its bucket, then its other one
                if not len(prints):
                    return
                order = np.argsort(bucket, kind="stable")
                prints, bucket = prints[order], bucket[order]
                first = np.searchsorted(bucket, bucket)
                nth = np.arange(len(bucket)) - first
                free = self.slots[bucket] == 0
                fits = nth < free.sum(1)
                rank = np.cumsum(free, 1) - 1
                slot = ((rank == nth[:, None]) & free).argmax(1)
                self.slots[bucket[fits], slot[fits]] = prints[fits]
                prints, bucket = prints[~fits], bucket[~fits]
                bucket = self._other(bucket, prints)
            if not len(prints):
                return
            _, one = np.unique(bucket, return_index=True)
            seat = (bucket[one] + np.uint32(turn)) % np.uint32(SLOTS)
            out = self.slots[bucket[one], seat].copy()
            self.slots[bucket[one], seat] = prints[one]
            prints[one] = out
            bucket[one] = self._other(bucket[one], out)
        low = np.minimum(bucket, self._other(bucket, prints))
        self.stash = np.concatenate([self.stash, np.stack([prints.astype(np.uint32), low], 1)])

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        prints, bucket = self._place(hashes)
        other = self._other(bucket, prints)
        wanted = prints[:, None]
        found = (self.slots[bucket] == wanted).any(1) | (self.slots[other] == wanted).any(1)
        if len(self.stash):
            pairs = (prints.astype(np.uint64) << np.uint64(32)) | np.minimum(bucket, other)
            found |= np.isin(pairs, (self.stash[:, 0].astype(np.uint64) << np.uint64(32)) | self.stash[:, 1])
        return found

    def remove(self, hashes: np.ndarray) -> None:
        """Takes one copy of each hash out; the hash must have been inserted."""
        prints, bucket = self._place(hashes)
        other = self._other(bucket, prints)
        for p, a, b in zip(prints, bucket, other):
            for row in (a, b):
                at = np.flatnonzero(self.slots[row] == p)
                if len(at):
                    self.slots[row, at[0]] = 0
                    break
            else:
                at = np.flatnonzero((self.stash[:, 0] == p) & (self.stash[:, 1] == min(a, b)))
                self.stash = np.delete(self.stash, at[:1], 0)


def _updated_filter(rows: pd.DataFrame) -> pd.DataFrame:
    """A shard's filter after its changes. rows: its old filter, or none, and hashes with +1 or -1."""
    old = rows["filter"].dropna()
    change, hashes = rows["change"].to_numpy(), rows["hash"].to_numpy()
    before = int(rows["n_keys"].sum())
    n_keys = before + int(change.sum())
    held = CuckooFilter.from_bytes(old.iloc[0]) if len(old) else CuckooFilter.sized(n_keys)
    held.remove(hashes[change < 0])
    held.insert(hashes[change > 0])
    return pd.DataFrame(
        {"shard": [rows["shard"].iloc[0]], "n_keys": [n_keys], "capacity": [held.capacity], "filter": [held.to_bytes()]}
    )


# --- the state -----------------------------------------------------------------------------


@dataclass(frozen=True)
class LineState:
    """postings (doc_id, key), refs (key, n_docs, keeper), filters (shard, n_keys, capacity, filter)."""

    postings: DataFrame
    refs: DataFrame
    filters: DataFrame
    min_chars: int = MIN_CHARS
    min_docs: int = MIN_DOCS


def empty_state(spark: SparkSession, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> LineState:
    return LineState(
        spark.createDataFrame([], "doc_id bigint, key binary"),
        spark.createDataFrame([], "key binary, n_docs bigint, keeper bigint"),
        spark.createDataFrame([], FILTER),
        min_chars,
        min_docs,
    )


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Distinct (doc_id, key) of the lines that count; a key is the 128-bit digest of the normalised line."""
    lines = docs.select(F.col(doc_id).alias("doc_id"), F.explode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("line"))
    trimmed = lines.select("doc_id", F.btrim("line", F.lit(SPACE)).alias("line")).where(F.char_length("line") >= min_chars)
    return trimmed.select("doc_id", F.unhex(F.md5(ascii_lower(F.col("line")).cast("binary"))).alias("key")).distinct()


def _shard(key: str = "key"):
    return F.pmod(F.hash(key), F.lit(SHARDS)).cast("int")


def _changed_filters(filters: DataFrame, refs: DataFrame, changes: DataFrame, min_docs: int) -> DataFrame:
    """Filters after `changes` (key, change): in place, or from the exact counts where a filter gets too full."""
    changes = changes.select(_shard().alias("shard"), F.xxhash64("key").alias("hash"), "change")
    added = changes.groupBy("shard").agg(F.sum("change").alias("more"))
    full = filters.join(added, "shard").where(F.col("n_keys") + F.col("more") > F.col("capacity")).select("shard")
    none = F.lit(None).cast("binary")
    old = filters.join(full, "shard", "left_anti").select(
        "shard", F.lit(0).cast("bigint").alias("hash"), F.lit(0).alias("change"), "n_keys", "filter"
    )
    in_place = changes.join(full, "shard", "left_anti").select("shard", "hash", "change", F.lit(0).cast("bigint").alias("n_keys"), none.alias("filter"))
    anew = (
        refs.where(F.col("n_docs") >= min_docs)
        .select(_shard().alias("shard"), F.xxhash64("key").alias("hash"), F.lit(1).alias("change"), F.lit(0).cast("bigint").alias("n_keys"), none.alias("filter"))
        .join(full, "shard", "left_semi")
    )
    return old.unionByName(in_place).unionByName(anew).groupBy("shard").applyInPandas(_updated_filter, FILTER)


def insert(state: LineState, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> LineState:
    """The state with `docs` added; pairs it holds already are not counted again."""
    fresh = line_keys(docs, state.min_chars, doc_id, text)
    if not state.postings.isEmpty():
        known = state.postings.select(F.col("doc_id").alias("known_id"), F.col("key").alias("known_key"))
        fresh = fresh.join(known, F.col("doc_id").eqNullSafe(F.col("known_id")) & (F.col("key") == F.col("known_key")), "left_anti")
    fresh = stored(fresh, "line-postings")
    counted = fresh.groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keeper"))
    both = counted.withColumn("old", F.lit(0).cast("bigint")).unionByName(state.refs.withColumn("old", F.col("n_docs")))
    merged = stored(
        both.groupBy("key").agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"), F.sum("old").alias("old")), "line-refs"
    )
    risen = merged.where((F.col("n_docs") >= state.min_docs) & (F.col("old") < state.min_docs)).select("key", F.lit(1).alias("change"))
    refs = merged.drop("old")
    filters = stored(_changed_filters(state.filters, refs, risen, state.min_docs), "line-filters")
    return LineState(state.postings.unionByName(fresh), refs, filters, state.min_chars, state.min_docs)


def delete(state: LineState, doc_ids: DataFrame) -> LineState:
    """The state without the documents of `doc_ids` (doc_id): exactly the state of the others."""
    ids = doc_ids.select(F.col("doc_id").alias("gone")).distinct()
    match = F.col("doc_id").eqNullSafe(F.col("gone"))
    postings = stored(state.postings.join(ids, match, "left_anti"), "line-postings")
    touched = stored(state.postings.join(ids, match, "left_semi").select("key").distinct(), "line-touched")
    again = postings.join(touched, "key", "left_semi").groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keeper"))
    refs = stored(state.refs.join(touched, "key", "left_anti").unionByName(again), "line-refs")
    fallen = (
        state.refs.where(F.col("n_docs") >= state.min_docs)
        .join(touched, "key", "left_semi")
        .join(again.where(F.col("n_docs") >= state.min_docs), "key", "left_anti")
        .select("key", F.lit(-1).alias("change"))
    )
    filters = stored(_changed_filters(state.filters, refs, fallen, state.min_docs), "line-filters")
    return LineState(postings, refs, filters, state.min_chars, state.min_docs)


# --- decisions -----------------------------------------------------------------------------


def _ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Askers that their shard's filter has. A part's rows come in order, each filter before its askers."""
    at, held = None, None
    for batch in batches:
        shard, salt = batch.column("shard").to_numpy(), batch.column("salt").to_numpy()
        filters = batch.column("filter")
        hashes = batch.column("hash").to_numpy(zero_copy_only=False)
        found = np.zeros(batch.num_rows, bool)
        part = shard.astype(np.int64) * SALTS + salt
        edges = np.flatnonzero(np.diff(part)) + 1
        for start, end in zip([0, *edges], [*edges, len(part)]):
            if start == end:
                continue
            if part[start] != at:
                at, held = part[start], None
            if filters[start].is_valid:
                held = CuckooFilter.from_bytes(filters[start].as_py())
                start += 1
            if held is not None and start < end:
                found[start:end] = held.contains(hashes[start:end])
        yield batch.filter(pa.array(found)).select(["doc_id", "key"])


def asked(filters: DataFrame, askers: DataFrame) -> DataFrame:
    """The (doc_id, key) rows whose key's shard filter says maybe.

    A shard's askers are dealt out over parts by their document, so a key that a third of all
    documents hold is not one task's; every part gets its own copy of the shard's filter.
    """
    parts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    held = filters.select(
        "shard", parts.alias("salt"), F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("binary").alias("key"),
        F.lit(0).cast("bigint").alias("hash"), "filter",
    )
    asking = askers.select(
        _shard().alias("shard"), F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"), "doc_id", "key",
        F.xxhash64("key").alias("hash"), F.lit(None).cast("binary").alias("filter"),
    )
    dealt = held.unionByName(asking).repartition("shard", "salt").sortWithinPartitions("shard", "salt", F.col("filter").isNull())
    return dealt.mapInArrow(_ask, "doc_id bigint, key binary")


def drops(state: LineState, postings: DataFrame) -> DataFrame:
    """The (doc_id, key) rows of `postings` whose lines go: shared by enough documents, not the largest one's."""
    maybe = asked(state.filters, postings)
    shared = state.refs.where(F.col("n_docs") >= state.min_docs)
    return maybe.join(shared, "key").where(~F.col("doc_id").eqNullSafe(F.col("keeper"))).select("doc_id", "key")


_TRIM = re.compile(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$")
_LOWER = str.maketrans(UPPER, UPPER.lower())


def _keep(text: str | None, gone: list[bytes] | None) -> tuple[int, int, str]:
    lines = (text or "").split("\n")
    if not gone:
        return len(lines), 0, text or ""
    out = set(gone)
    kept = [x for x in lines if hashlib.md5(_TRIM.sub("", x).translate(_LOWER).encode()).digest() not in out]
    return len(lines), len(lines) - len(kept), "\n".join(kept)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            some = batch.slice(start, 256)
            rows = [_keep(t.as_py(), g.as_py()) for t, g in zip(some.column("text"), some.column("gone"))]
            n_lines, n_dropped, kept = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [some.column("doc_id"), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.string())],
                ["doc_id", "n_lines", "n_dropped", "kept_text"],
            )


def kept_texts(state: LineState, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_text of documents that the state holds."""
    some = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    gone = drops(state, state.postings).groupBy(F.col("doc_id").alias("gone_id")).agg(F.collect_list("key").alias("gone"))
    joined = some.join(gone, F.col("doc_id").eqNullSafe(F.col("gone_id")), "left").select("doc_id", "text", "gone")
    return joined.mapInArrow(_cut, "doc_id bigint, n_lines bigint, n_dropped bigint, kept_text string")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that other documents keep."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    state = insert(empty_state(spark), docs)
    kept = kept_texts(state, docs)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


OP7_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
), shared AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT doc_id, i, line, keeper IS NOT NULL AND doc_id <> keeper AS gone FROM k LEFT JOIN shared USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

"""Jump consistent hashing (Lamping and Veach, 2014) as SQL expressions.

A key's shard is the last stop before `shards` of an increasing chain of jumps that the
key's random stream decides. No ring table exists; with one more shard a key either stays
or moves into the new one.

Defined results: a null key hashes like the empty string; rows with the same key share a
shard; identical rows get slots one after another; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vitrine.llm.common import table

SHARDS = 24
BUCKETS = 4096  # slices of a shard that are numbered apart

# The published algorithm's generator: state * MULTIPLIER + 1 in 64 bits.
MULTIPLIER = 2862933555777941757

_LOW = 0xFFFFFFFF
_MUL_HIGH, _MUL_LOW = MULTIPLIER >> 32, MULTIPLIER & _LOW


def _times_low32(word: str, factor: int) -> str:
    """word * factor modulo 2^32, both below 2^32, without leaving a signed 64-bit number."""
    return f"((({word}) & 65535) * {factor}L + shiftleft((shiftright({word}, 16) * {factor}L) & 65535, 16))"


def _step(state: str) -> str:
    """The chain's next state: (hi, lo) the generator's halves, at the present shard, next the one jumped to."""
    hi, lo = f"{state}.hi", f"{state}.lo"
    first, second = f"(({lo} & 65535) * {_MUL_LOW}L)", f"(shiftright({lo}, 16) * {_MUL_LOW}L)"
    low_sum = f"({first} + shiftleft({second} & 65535, 16) + 1L)"
    new_lo = f"({low_sum} & {_LOW}L)"
    new_hi = (
        f"((shiftright({low_sum}, 32) + shiftright({second}, 16) + {_times_low32(hi, _MUL_LOW)}"
        f" + {_times_low32(lo, _MUL_HIGH)}) & {_LOW}L)"
    )
    # The next stop from the generator's upper 31 bits.
    jump = f"cast(floor(({state}.next + 1) * (2147483648D / (shiftright({new_hi}, 1) + 1))) AS bigint)"
    return f"named_struct('hi', {new_hi}, 'lo', {new_lo}, 'at', {state}.next, 'next', {jump})"


def jump_chain(digest: str, shards: int) -> str:
    """SQL for the struct (hi, lo, at, next) at the chain's last stop before `shards`.

    `digest`: SQL text of a hex string whose first 16 digits are the key's 64 bits. `at` is
    the shard, `next` the first stop at or past `shards`, so a key moves into the appended
    shard exactly when next = shards. Every stop is at least one further than the last, so
    `shards` steps always suffice; about ln(shards) of them are real.
    """
    start = (
        f"named_struct('hi', cast(conv(substr({digest}, 1, 8), 16, 10) AS bigint),"
        f" 'lo', cast(conv(substr({digest}, 9, 8), 16, 10) AS bigint), 'at', -1L, 'next', 0L)"
    )
    return f"aggregate(sequence(1, {shards}), {start}, (s, i) -> CASE WHEN s.next >= {shards} THEN s ELSE {_step('s')} END)"


def with_shards(df: DataFrame, key: str, shards: int = SHARDS, shard: str = "shard", grown: str = "grown_shard") -> DataFrame:
    """`df` with each row's shard of `shards`, and of one more. Narrow: no row moves."""
    digest = f"md5(cast(coalesce(cast(`{key}` AS string), '') AS binary))"
    chain = F.expr(jump_chain(digest, shards))
    named = df.withColumn("__chain", chain)
    return named.withColumns(
        {
            shard: F.col("__chain.at").cast("int"),
            grown: F.when(F.col("__chain.next") == shards, shards).otherwise(F.col("__chain.at")).cast("int"),
        }
    ).drop("__chain")


def with_slots(rows: DataFrame, group: str, bucket: str, order: list[str], slot: str = "slot") -> DataFrame:
    """Numbers the rows of each `group` from 0 without a gap, by (bucket, order).

    Equal rows are counted before anything moves, so copies cannot pile up; a task orders
    one bucket of one group, and only a row per bucket is summed along a group.
    """
    columns = rows.columns
    counted = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n"))
    totals = counted.groupBy(group, bucket).agg(F.sum("__n").alias("__total"))
    before = W.partitionBy(group).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    bases = totals.select(group, bucket, F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__base"))
    inside = W.partitionBy(group, bucket).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    numbered = counted.withColumn("__last", F.sum("__n").over(inside)).join(bases, [group, bucket])
    return numbered.withColumn("__i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__n")))).select(
        *columns, (F.col("__base") + F.col("__last") - F.col("__n") + F.col("__i") - 1).alias(slot)
    )


def op3_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards by jump hash of doc_id; law `key`."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("bigint").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 17, 3), 16, 10)
        .cast("int")
        .alias("bucket"),
    )
    rows = with_slots(with_shards(docs, "doc_id"), "shard", "bucket", ["doc_id", "size", "text_crc32"])
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


OP3_SQL = """
WITH RECURSIVE bytes AS (
  SELECT range AS n, range::UBIGINT AS c FROM range(256)
), t AS (
  SELECT n, list_reduce([c] || [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0],
    lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END) AS c
  FROM bytes
), crc AS (
  SELECT list(c ORDER BY n) AS tab FROM t
), d AS (
  SELECT doc_id, row_number() OVER () AS row_no, coalesce(strlen(text), 0) + 8 AS size,
         coalesce(text, '') AS text, md5(coalesce(doc_id::VARCHAR, '')) AS digest
  FROM documents
), chain(row_no, state, stop, nxt) AS (
  SELECT row_no, ('0x' || substr(digest, 1, 16))::UBIGINT::HUGEINT, -1::BIGINT, 0::BIGINT FROM d
  UNION ALL
  SELECT row_no, next_state, nxt,
         floor((nxt + 1) * (2147483648::DOUBLE / ((next_state // 8589934592) + 1)::DOUBLE))::BIGINT
  FROM (SELECT row_no, stop, nxt, (state * 2862933555777941757 + 1) % 18446744073709551616::HUGEINT AS next_state
        FROM chain WHERE nxt < 24)
), ends AS (
  SELECT row_no, stop, nxt FROM chain WHERE nxt >= 24
), summed AS (
  SELECT d.*, ends.stop, ends.nxt,
    xor(list_reduce([4294967295::UBIGINT] || list_transform(range(1, 2 * (size - 8) + 1, 2),
          lambda i: ('0x' || substr(hex(text), i, 2))::UBIGINT),
        lambda x, b: xor(x >> 8, tab[((xor(x, b) & 255) + 1)::BIGINT])), 4294967295::UBIGINT)::BIGINT AS text_crc32
  FROM d JOIN ends USING (row_no), crc
)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, stop::INTEGER AS shard,
  row_number() OVER (PARTITION BY stop ORDER BY ('0x' || substr(digest, 17, 3))::INTEGER, doc_id, size, text_crc32) - 1 AS slot,
  (CASE WHEN nxt = 24 THEN 24 ELSE stop END)::INTEGER AS grown_shard
FROM summed
"""

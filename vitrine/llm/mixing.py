"""Mixing sources to target weights: hash-random order, distributed prefix sums, exact cuts.

Every source gets a budget of words. Its documents are put in a hash-random order, their
words are summed along it, and the source is read over and over until the budget is used up:
whole passes, then the documents before the cut, the one at the cut in part.

Defined results: a null text has size 0 and nothing is taken of it; a null source is a source
of its own, last; rows equal in source, id and size follow one another in the order; a null id
hashes like the empty string; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vitrine.llm.common import table

WEIGHTS = (5, 2, 1)
MOST_PASSES = 3
BUCKET_DIGITS = 3  # 4096 slices of a source's hash order are summed apart

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str) -> str:
    return f"coalesce(regexp_count({text}, r'{WORD}'), 0)"


def with_source_key(df: DataFrame, source: str, out: str) -> DataFrame:
    """A never-null key that sorts by code point, the null source last."""
    return df.withColumn(out, F.when(F.col(source).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source))))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_PASSES) -> DataFrame:
    """(src, source_size) → plus target: weights in source order, none above `most` times its size.

    A capped source leaves its excess to the others by weight, until none is above. In order of
    size per weight the capped ones come first, so running sums find where capping ends. One row
    per source; the two windows see only this table.
    """
    order = W.orderBy("src")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(order) - 1) % len(weights) + 1)
    weighted = sizes.withColumn("w", weight.cast("bigint"))
    fill = W.orderBy(F.col("source_size") / F.col("w"), "src")
    past = fill.rowsBetween(W.unboundedPreceding, -1)
    everything = fill.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    caps = weighted.withColumns(
        {
            "total": F.sum("source_size").over(everything),
            "capped_before": F.coalesce(F.sum(most * F.col("source_size")).over(past), F.lit(0)),
            "w_left": F.sum("w").over(everything) - F.coalesce(F.sum("w").over(past), F.lit(0)),
        }
    ).withColumn("capped", most * F.col("source_size") * F.col("w_left") <= F.col("w") * (F.col("total") - F.col("capped_before")))
    shares = caps.withColumns(
        {
            "rest": F.col("total") - F.coalesce(F.sum(F.when(F.col("capped"), most * F.col("source_size"))).over(everything), F.lit(0)),
            "rest_w": F.coalesce(F.sum(F.when(~F.col("capped"), F.col("w"))).over(everything), F.lit(1)),
        }
    )
    own = (most * F.col("source_size")).cast("double")
    shared = (F.col("w") * F.col("rest")).cast("double") / F.col("rest_w").cast("double")
    return shares.select("src", "source_size", F.when(F.col("capped"), own).otherwise(F.least(own, shared)).alias("target"))


def mix(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_PASSES) -> DataFrame:
    """(src, id, size) → src, id, size, source_size, target, taken; one row for each row.

    Equal rows are counted before they move. A task orders one slice of one source's hash order;
    along a source only a row per slice is summed.
    """
    key = F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary"))
    counted = (
        rows.groupBy("src", "id", "size")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("key", key)
        .withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS))
        .repartition("src", "bucket")
    )
    slices = counted.groupBy("src", "bucket").agg(F.sum(F.col("size") * F.col("n")).alias("words"))
    along = W.partitionBy("src").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    bases = slices.select("src", "bucket", F.coalesce(F.sum("words").over(along), F.lit(0)).alias("base"))
    targets = source_targets(slices.groupBy("src").agg(F.sum("words").alias("source_size")), weights, most)
    starts = bases.join(targets, "src")
    inside = W.partitionBy("src", "bucket").orderBy("key", "id", "size").rowsBetween(W.unboundedPreceding, -1)
    placed = (
        counted.withColumn("ahead", F.coalesce(F.sum(F.col("size") * F.col("n")).over(inside), F.lit(0)))
        .join(starts, ["src", "bucket"])
        .withColumn("i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)))
        .withColumn("start", F.col("base") + F.col("ahead") + F.col("i") * F.col("size"))
        .withColumn("budget", F.floor("target"))
    )
    return (
        placed.withColumn("passes", F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0)))
        .withColumn("left", F.col("budget") - F.col("passes") * F.col("source_size"))
        .withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), F.col("left") - F.col("start"))))
        .select(
            "src", "id", "size", "source_size", "target",
            (F.col("passes") * F.col("size") + F.col("part")).cast("bigint").alias("taken"),
        )
    )


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by the weights 5, 2, 1, to as many words as they have."""
    docs = with_source_key(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), "source", "src")
    rows = docs.select("src", F.col("doc_id").alias("id"), F.expr(word_count("text")).cast("bigint").alias("size"))
    return mix(rows).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def with_copies(docs: DataFrame, source: str = "source", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Whole documents as often as the mix takes them: the document at a cut counts if half of it is before the cut.

    Rows equal in source, id and size are taken alike, as often as the first of them.
    """
    columns = docs.columns
    keyed = with_source_key(docs, source, "__src").withColumn("__size", F.expr(word_count(f"`{text}`")).cast("bigint"))
    rows = keyed.select(F.col("__src").alias("src"), F.col(doc_id).alias("id"), F.col("__size").alias("size"))
    copies = F.when(F.col("size") > 0, F.expr("div(taken + size div 2, size)")).otherwise(F.lit(0))
    often = (
        mix(rows).groupBy("src", "id", "size").agg(F.max("taken").alias("taken")).withColumn("__copies", copies).where("__copies > 0")
    )
    joined = keyed.alias("d").join(
        often.alias("o"),
        F.col("d.__src").eqNullSafe(F.col("o.src")) & F.col(f"d.{doc_id}").eqNullSafe(F.col("o.id")) & (F.col("d.__size") == F.col("o.size")),
    )
    return joined.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__copies")))).select(
        *[F.col(f"d.`{c}`") for c in columns]
    )


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS src,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS key
  FROM documents
), s AS (
  SELECT src, sum(size)::BIGINT AS source_size FROM d GROUP BY src
), w AS (
  SELECT *, ([5, 2, 1])[((row_number() OVER (ORDER BY src) - 1) % 3 + 1)::INTEGER]::BIGINT AS w FROM s
), c AS (
  SELECT *, sum(source_size) OVER ()::BIGINT AS total,
         coalesce(sum(3 * source_size) OVER (ORDER BY source_size / w, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS capped_before,
         (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY source_size / w, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS w_left
  FROM w
), k AS (
  SELECT *, 3 * source_size * w_left <= w * (total - capped_before) AS capped FROM c
), r AS (
  SELECT *, (total - coalesce(sum(3 * source_size) FILTER (WHERE capped) OVER (), 0))::BIGINT AS rest,
         coalesce(sum(w) FILTER (WHERE NOT capped) OVER (), 1)::BIGINT AS rest_w
  FROM k
), t AS (
  SELECT src, source_size, CASE WHEN capped THEN (3 * source_size)::DOUBLE
         ELSE least((3 * source_size)::DOUBLE, (w * rest)::DOUBLE / rest_w::DOUBLE) END AS target
  FROM r
), p AS (
  SELECT d.*, t.source_size, t.target, floor(t.target)::BIGINT AS budget,
         coalesce(sum(size) OVER (PARTITION BY src ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM d JOIN t USING (src)
)
SELECT doc_id, size, source_size, target,
  (CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
     + greatest(0, least(size, budget % source_size - start)) END)::BIGINT AS taken
FROM p
"""

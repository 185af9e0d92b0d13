"""Joins and ordered look-backs that stay spread when one key holds much of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SALTS = 8
SLICE_ROWS = 1_000_000  # rows of one key that are put in order together
MOST_SLICES = 1_000  # of one key; a slice is larger only if a key has more than both together


def hot_key_join(many: DataFrame, one: DataFrame, on: str | list[str], spread_by: Column, how: str = "left", salts: int = SALTS) -> DataFrame:
    """`many` ⋈ `one` (one row per key) with each key of `many` split over `salts` parts.

    The split is a hash of a column, so a recomputed task sends rows to the same place.
    """
    salted = many.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    copies = one.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*([on] if isinstance(on, str) else on), "_salt"], how).drop("_salt")


def sliced(df: DataFrame, keys: list[str], position: Column, slice_rows: int = SLICE_ROWS, out: str = "_slice") -> DataFrame:
    """`df` with the number of its slice: the rows of a key, cut at measured quantiles of `position` so that no slice
    holds many more than `slice_rows`. Equal positions share a slice; a null is below all numbers.

    The counts and cuts are aggregated before they are shuffled. A table without a large key is not cut.
    """
    placed = df.withColumn("_position", F.coalesce(position.cast("bigint"), F.lit(-(2**62))))
    counts = placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    most = counts.agg(F.max("_n")).first()[0] or 0
    if most <= slice_rows:
        # 0, but not as a literal: joins on it stay joins on a key.
        return df.withColumn(out, F.pmod(F.xxhash64(position), F.lit(1)).cast("int"))
    slices = min(MOST_SLICES, -(-most // slice_rows))
    shares = [n / slices for n in range(1, slices)]
    large = counts.where(F.col("_n") > slice_rows).drop("_n")
    own = placed.join(large, keys, "left_semi") if keys else placed
    cuts = own.groupBy(*keys).agg(F.percentile_approx("_position", shares, 20 * slices).alias("_cuts"))
    # Of the whole table the cuts are one row: its numbers go into the plan.
    cut = placed.join(cuts, keys, "left") if keys else placed.withColumn("_cuts", F.array(*map(F.lit, cuts.first()[0])))
    number = F.coalesce(F.size(F.filter("_cuts", lambda c: c < F.col("_position"))), F.lit(0))
    return cut.withColumn(out, F.when(F.col("_cuts").isNull(), 0).otherwise(number)).drop("_cuts", "_position")


def previous_row(
    df: DataFrame, keys: list[str], order: list[str], carried: list[str], position: Column, prefix: str = "prev_", slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """The `carried` values of the row before, per key in `order`, without one task per key.

    `position` is a number that does not decrease along `order`. Rows are ordered only within a slice
    of their key; the first row of a slice takes the last row of the slice before it, found on a table with
    one row per slice.
    """
    names = [f"{prefix}{c}" for c in carried]
    parts = sliced(df, keys, position, slice_rows)
    inside = W.partitionBy(*keys, "_slice").orderBy(*order)
    row = F.struct(*carried)
    near = parts.withColumn("_near", F.lag(row).over(inside))
    lasts = parts.groupBy(*keys, "_slice").agg(F.max(F.struct(*order, row.alias("_row")))["_row"].alias("_last"))
    across = W.partitionBy(*keys).orderBy("_slice")
    before = lasts.select(*keys, "_slice", F.lag("_last").over(across).alias("_far"))
    # Partitioned by key and slice already, the rows stay where they are; only the
    # slice table moves.
    picked = F.coalesce("_near", "_far")
    return near.join(before, [*keys, "_slice"], "left").select(
        *df.columns, *[picked[c].alias(n) for c, n in zip(carried, names)]
    )


def running_total(df: DataFrame, order: list[str], value: Column, position: Column, out: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Running sum over the whole table in `order`: totals per slice first, then within slices.

    `position` is a number that does not decrease along `order`. The unpartitioned window sees one row per slice.
    """
    parts = sliced(df.withColumn("_value", value), [], position, slice_rows)
    totals = parts.groupBy("_slice").agg(F.sum("_value").alias("_total"))
    before = totals.select(
        "_slice",
        F.coalesce(F.sum("_total").over(W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_base"),
    )
    inside = W.partitionBy("_slice").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return (
        parts.withColumn("_run", F.sum("_value").over(inside))
        .join(before, "_slice")
        .select(*df.columns, (F.col("_base") + F.col("_run")).alias(out))
    )

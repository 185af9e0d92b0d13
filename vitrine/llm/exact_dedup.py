"""Exact dedup as a stateful stream over document digests.

The stream's keyed state (RocksDB, on the executors' disks, checkpointed to the shared folder,
never expired) holds per digest the largest document id, where its content lies and how many rows
came. Rows of a batch are reduced per digest before they reach the state, so a text with very
many copies is one row per task. Hits are confirmed on full texts: the rows of digests seen more
than once are grouped by their whole normalised text; if a digest turns out to stand for several
texts, each text is its own group.

Defined results: a null text counts as empty; A-Z are lower-cased, nothing else; a null id is below
every other; of rows with the same id and the same text one is kept; an empty table gives an
empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from vitrine.llm.common import ascii_lower, new_folder, stored, table

ARRIVALS = "doc_id bigint, digest string, locator string"
STATE = "digest string, keep_id bigint, locator string, group_size bigint"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    # Else every state partition takes 4 MB of disk for its manifest, however small it is.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normal_text(text: Column) -> Column:
    return ascii_lower(F.coalesce(text, F.lit("")))


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def update_state(spark: SparkSession, arrivals: str, root: str) -> DataFrame:
    """Feeds the arrivals not yet seen to the keyed state under `root`; returns the whole state.

    Run it again after more files have come to `arrivals`, or after a crash: the checkpoint knows
    what has been read, and a repeated batch rewrites its own folder. A digest's newest row counts.
    """
    news = (
        spark.readStream.schema(ARRIVALS)
        .parquet(arrivals)
        .groupBy("digest")
        .agg(F.max(F.struct("doc_id", "locator")).alias("best"), F.count(F.lit(1)).alias("group_size"))
        .select("digest", F.col("best.doc_id").alias("keep_id"), F.col("best.locator").alias("locator"), "group_size")
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/state/batch_id={batch_id}")

    before = {k: spark.conf.get(k, None) for k in STREAM_SETTINGS}
    for k, v in STREAM_SETTINGS.items():
        spark.conf.set(k, v)
    try:
        query = (
            news.writeStream.outputMode("update")
            .option("checkpointLocation", f"{root}/checkpoint")
            .trigger(availableNow=True)
            .foreachBatch(write)
            .start()
        )
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    if query.lastProgress is None:  # nothing has ever come
        return spark.createDataFrame([], STATE)
    changes = spark.read.schema(f"{STATE}, batch_id bigint").parquet(f"{root}/state")
    newest = F.max(F.struct("batch_id", "keep_id", "locator", "group_size")).alias("s")
    return changes.groupBy("digest").agg(newest).select("digest", "s.keep_id", "s.locator", "s.group_size")


def duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", digest=sha256) -> DataFrame:
    """One row per row of `docs`: doc_id, digest, keep_id, group_size, kept.

    `digest` maps the normalised text to a string key. `keep_id` is the largest id of the rows with
    the same text, and `kept` is true for one row of it.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), normal_text(F.col(text)).alias("text"))
    root = new_folder(spark, "exact")
    arrivals = slim.select("doc_id", digest(F.col("text")).alias("digest"), F.input_file_name().alias("locator"))
    arrivals.write.parquet(f"{root}/arrivals")
    state = stored(update_state(spark, f"{root}/arrivals", root), "exact-state")
    seen = spark.read.schema(ARRIVALS).parquet(f"{root}/arrivals")
    # Copies of a row are one row with a count from here on.
    rows = seen.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("n")).join(state.drop("locator"), "digest")
    checked = _confirm(slim, rows, digest)
    return checked.select(
        "doc_id", "digest", "keep_id", "group_size", F.posexplode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))).alias("i", "_"),
    ).select("doc_id", "digest", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("i") == 0)).alias("kept"))


def _confirm(slim: DataFrame, rows: DataFrame, digest) -> DataFrame:
    """Checks the full texts of all hits; texts that merely share a digest are taken apart."""
    hits = rows.where("group_size > 1").select(F.col("doc_id").alias("hit_id"), "digest")
    with_text = slim.join(hits, F.col("doc_id").eqNullSafe(F.col("hit_id"))).where(digest(F.col("text")) == F.col("digest"))
    texts = with_text.groupBy("digest", "text").agg(F.count(F.lit(1)).alias("n"))
    shared = stored(texts.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("digest"), "exact-shared")
    if shared.isEmpty():
        return rows
    each = with_text.join(shared, "digest", "left_semi").groupBy("doc_id", "digest", "text").agg(F.count(F.lit(1)).alias("n"))
    one = each.groupBy("digest", "text").agg(F.max("doc_id").alias("keep_id"), F.sum("n").alias("group_size"))
    apart = each.join(one, ["digest", "text"]).select("digest", "doc_id", "n", "keep_id", "group_size")
    return rows.join(shared, "digest", "left_anti").select("digest", "doc_id", "n", "keep_id", "group_size").unionByName(apart)


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that stay, all columns as they were."""
    columns = docs.columns
    kept = duplicates(docs, doc_id, text).where("kept").select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"))
    keyed = docs.withColumn("__own", sha256(normal_text(F.col(text))))
    joined = keyed.join(kept, F.col(doc_id).eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__digest")))
    first = F.row_number().over(W.partitionBy(doc_id, "__own").orderBy(F.lit(1)))
    return joined.withColumn("__first", first).where("__first = 1").select(*[F.col(f"`{c}`") for c in columns])


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the id of its text's row that stays."""
    found = duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


OP9_SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents
)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY norm)
"""

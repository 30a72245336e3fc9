"""Exact deduplication by a streaming aggregation with disk-backed keyed state.

Every row's normalised text (A-Z lower-cased) is reduced to a SHA-256 digest. The digests run as a stream through keyed state that
never expires: for each digest it retains the stable identifier (the largest doc_id so far), the number of rows and the locator of
the retained row (its file and place there). The state lives in RocksDB on the executors' disks and is checkpointed to
the shared folder, so a lost executor, or a later run over new rows, continues from it. On a hit (a digest with more than one
row) the rows are read again by their locators, and the full texts are compared with that at the retained locator; where they
differ, equality of texts decides instead of the digest. Texts without a copy are never moved.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from episodica.llm.common import ascii_lower, materialize, staging_path, text_or_empty

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STORE = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    # many small stores: no megabytes set aside on disk for each, and a batch checkpoints its changes alone
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

#: Rows that are looked up by a broadcast of their locators' hashes (some 60 bytes each) instead of a shuffle.
BROADCAST_ROWS = 250_000

STATE = "digest binary, keep_id bigint, group_size bigint, locator string, batch bigint"


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(ascii_lower(text), 256))


def keyed_state(rows: DataFrame) -> DataFrame:
    """The state of a stream of rows (digest, doc_id, locator): digest, keep_id, group_size, locator. It never expires."""
    groups = rows.groupBy("digest").agg(F.max(F.struct("doc_id", "locator")).alias("one"), F.count("*").alias("group_size"))
    return groups.select("digest", F.col("one.doc_id").alias("keep_id"), "group_size", F.col("one.locator").alias("locator"))


def located(docs: DataFrame) -> DataFrame:
    """docs with __locator: a row's file and place there, or, where docs isn't read from files, its doc_id and the hash of its text
    (which rows that repeat both share)."""
    try:
        return docs.withColumn("__locator", F.concat(F.col("_metadata.file_path"), F.lit("#"), F.col("_metadata.row_index").cast("string")))
    except AnalysisException:
        return docs.withColumn("__locator", F.concat_ws("#", F.lit("row"), F.col("doc_id").cast("string"), F.sha2(text_or_empty(), 256)))


def _looked_up(rows: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """rows with (left_semi) or without (left_anti) the __locator of found: by a broadcast of two hashes of 64 bits, if these are few."""
    if found.count() > BROADCAST_ROWS:
        return rows.join(found, "__locator", how)
    hashes = lambda: {"__h1": F.xxhash64("__locator"), "__h2": F.xxhash64(F.lit(1), "__locator")}
    return rows.withColumns(hashes()).join(F.broadcast(found.select(*(c.alias(k) for k, c in hashes().items()))), ["__h1", "__h2"], how).select(rows.columns)


def start(rows: DataFrame, state_dir: str, checkpoint: str) -> StreamingQuery:
    """Run keyed_state over the stream rows until its present input is used up; changed keys are appended to state_dir by batch.

    A batch that is repeated after a failure overwrites what it wrote before.
    """

    def put(changed: DataFrame, batch: int) -> None:
        changed.withColumn("batch", F.lit(batch).cast("bigint")).write.mode("overwrite").parquet(f"{state_dir}/batch={batch:09d}")

    spark = rows.sparkSession
    before = {k: spark.conf.get(k, None) for k in STORE}
    for k, v in STORE.items():
        spark.conf.set(k, v)
    try:
        return keyed_state(rows).writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:  # the query keeps the settings that it began with
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def latest(state: DataFrame) -> DataFrame:
    """Each key's last state: digest, keep_id, group_size, locator."""
    own = F.struct("keep_id", "group_size", "locator")
    return state.groupBy("digest").agg(F.max_by(own, "batch").alias("s")).select("digest", "s.*")


def deduplicate(docs: DataFrame, digest=digest_of, files_per_batch: int = 1000) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, locator, stays for each row of docs (doc_id, text).

    Texts are equal when identical after lower-casing A-Z; null counts as empty. Of equal texts the largest doc_id stays. Rows
    that repeat it, text and id alike, are all marked kept, but stays is true for one row of a group (for those with one locator,
    see located). Null doc_ids count in group_size, and stay only if the group has no other (keep_id null). digest can be
    replaced, say by a short one in tests: results don't depend on it.
    """
    spark = docs.sparkSession
    own = located(docs.select("doc_id", "text")).select(F.col("doc_id").cast("bigint"), text_or_empty().alias("text"), "__locator")
    normal = ascii_lower(F.col("text"))
    staged = staging_path(spark, "digests")
    own.select("doc_id", digest(F.col("text")).alias("digest"), F.sha2(normal, 256).alias("text_sha256"), F.col("__locator").alias("locator")).write.parquet(staged)
    rows = spark.read.parquet(staged)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files_per_batch).parquet(staged).select("digest", "doc_id", "locator")
    state_dir, checkpoint = staging_path(spark, "state"), staging_path(spark, "state_checkpoint")
    start(stream, state_dir, checkpoint).awaitTermination()
    # an empty input makes no batch, so the folder may be missing: its parent always exists
    state = spark.read.schema(STATE).option("ignoreMissingFiles", "true").option("recursiveFileLookup", "true").parquet(staged_or_empty(spark, state_dir))
    groups = materialize(latest(state).withColumnRenamed("locator", "one"), "groups")
    # full bytes: the texts of hits, read by their locators, against the text at the retained locator of their digest. Both sides of
    # a join by digest are written first, as an aggregation on either would keep its hot groups from being split
    hits = materialize(groups.filter("group_size > 1").select("digest", "one"), "hits")
    wanted = materialize(rows.select("digest", F.col("locator").alias("__locator")).join(hits, "digest").select("__locator").distinct(), "wanted")
    texts = materialize(_looked_up(own, wanted, "left_semi").select(digest(F.col("text")).alias("digest"), "doc_id", "__locator", normal.alias("text")), "texts")
    ones = materialize(hits.select(F.col("one").alias("__locator")), "ones")
    retained = materialize(_looked_up(texts, ones, "left_semi").groupBy("digest").agg(F.min("text").alias("retained")), "retained")
    clashing = materialize(texts.join(retained, "digest").filter("text <> retained").select("digest"), "clashing").distinct()
    alone = materialize(groups.join(clashing, "digest", "left_anti").select("digest", "keep_id", "group_size", "one"), "alone")
    by_digest = rows.join(alone, "digest")
    by_text = texts.join(clashing, "digest", "left_semi").groupBy("text").agg(F.max(F.struct("doc_id", "__locator")).alias("o"), F.count("*").alias("group_size"))
    by_text = materialize(by_text.select(F.sha2("text", 256).alias("text_sha256"), F.col("o.doc_id").alias("keep_id"), "group_size", F.col("o.__locator").alias("one")), "by_text")
    rest = rows.join(clashing, "digest", "left_semi").join(by_text, "text_sha256")
    columns = ["doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256", "locator", (F.col("locator") == F.col("one")).alias("stays")]
    return by_digest.select(columns).union(rest.select(columns))


def staying(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of docs that stay by found (see deduplicate): one of each group. Only what goes is looked up."""
    gone = materialize(found.filter("not stays").select(F.col("locator").alias("__locator")).distinct(), "gone")
    rows = located(docs)
    left = _looked_up(rows, gone, "left_anti")
    if "_metadata" not in str(rows._jdf.queryExecution().analyzed()):
        left = left.dropDuplicates(["__locator"])
    return left.select(docs.columns)


def staged_or_empty(spark, path: str) -> str:
    """path, made if it doesn't exist."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(target)
    return path

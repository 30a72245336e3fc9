"""The ledger of uploads, cursors, runs, consent, revocations and snapshots, as versioned Parquet tables.

A table is a folder of numbered versions and a pointer file that names the current one. A write makes a new version and then moves the
pointer, so readers never see half a table and a failed job leaves the old one. One writer at a time is assumed.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from episodica.functions.staging import materialize

# The tables, their columns, and their keys (first column).
SCHEMAS = {
    "sources": "source_name string, last_scan_ts string, cursor_json string",
    "files": "path string, fingerprint string, last_seen_ts string",
    "uploads": "doc_id string, content_hash string, source_name string, session_id string, ts_start string, ts_end string, uploaded_at string",
    "runs": "run_id string, started_at string, finished_at string, scanned_files int, produced_docs int, uploaded_docs int, redactions int, errors int",
    "consent_state": "id int, accepted_at string, consent_version string, license string, public_searchable int, trainable int, ack_sanitization int, ack_public_search int, ack_training_release int",
    "episodes": "id string, content_hash string, source_tool string, session_id_hash string, r2_object_key string, indexed_at string, uploaded_at string, consent_version string, license string",
    "revocations": "episode_id string, reason string, revoked_at string, pushed_at string, push_status string",
    "snapshots": "version string, built_at string, train_count int, val_count int, manifest_hash string, published_at string",
}
KEPT_ON_RESET = ("runs",)
ALLOWED_LICENSES = ("CC0-1.0", "CC-BY-4.0")


def key_of(table: str) -> str:
    return SCHEMAS[table].split()[0]


# ---- statements as DataFrame operations ------------------------------------------------------------------------------


def _in_turn(rows: DataFrame, order: list[str] | None) -> Column:
    return F.struct(*(order or rows.columns))


def merge(old: DataFrame, new: DataFrame, key: str, update: list[str] | None = None, order: list[str] | None = None) -> DataFrame:
    """old with the rows of new: inserted where the key is new, else only the columns update (all by default) are replaced.

    Rows of new that repeat a key count as written one after another by the columns order (by all of new, where none are given): what
    the first inserts stays but for the columns update, which the last sets. One full join; null keys never match, as in SQL.
    """
    update = [c for c in old.columns if c != key] if update is None else update
    kept = [c for c in old.columns if c != key and c not in update]
    turn = _in_turn(new, order)
    once = new.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.struct(F.lit(0).alias("__"), *kept), turn).alias("f"), F.max_by(F.struct(F.lit(0).alias("__"), *update), turn).alias("l"))
    once = once.select(*(c if c == key else F.col(f"{'f' if c in kept else 'l'}.{c}").alias(c) for c in old.columns)).union(new.filter(F.col(key).isNull()).select(*old.columns))
    o, n = old.alias("o"), once.select("*", F.lit(True).alias("__new")).alias("n")
    fresh, known = F.col("n.__new").isNotNull(), F.col(f"o.{key}").isNotNull()

    def pick(c: str) -> Column:
        if c == key:
            return F.coalesce(f"o.{c}", f"n.{c}")
        return F.when(fresh & (~known | F.lit(c in update)), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))

    return o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer").select(*(pick(c).alias(c) for c in old.columns))


def insert_or_ignore(old: DataFrame, new: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """old and those rows of new whose key it lacks; of rows that repeat a key the first by the columns order (by all of new, where
    none are given). Null keys never match, so each such row is inserted."""
    missing = new.join(old.select(key), key, "left_anti").select(*new.columns)
    first = F.when(F.col(key).isNull(), 1).otherwise(F.row_number().over(W.partitionBy(key).orderBy(_in_turn(new, order))))
    return old.unionByName(missing.withColumn("__first", first).filter("__first = 1").select(*old.columns))


def not_uploaded(episodes: DataFrame, ledger: DataFrame) -> DataFrame:
    """Episodes whose id the ledger lacks: one anti-join instead of a look-up for each."""
    return episodes.join(ledger.select("id").distinct(), "id", "left_anti")


#: On conflict an episode's hash, source and session stay as they were first recorded.
EPISODE_UPDATES = ["r2_object_key", "indexed_at", "uploaded_at", "consent_version", "license"]


def upsert_episodes(old: DataFrame, new: DataFrame) -> DataFrame:
    return merge(old, new, "id", EPISODE_UPDATES)


def upsert_revocations(old: DataFrame, new: DataFrame) -> DataFrame:
    """A repeated revocation replaces all but pushed_at."""
    return merge(old, new, "episode_id", ["reason", "revoked_at", "push_status"])


def pending_revocations(revocations: DataFrame) -> DataFrame:
    return revocations.filter(F.col("push_status").isNull() | (F.col("push_status") != "pushed")).orderBy("revoked_at")


def mark_pushed(revocations: DataFrame, ids: list[str], at: str) -> DataFrame:
    own = F.col("episode_id").isin(*ids) if ids else F.lit(False)
    return revocations.withColumns({"pushed_at": F.when(own, F.lit(at)).otherwise(F.col("pushed_at")), "push_status": F.when(own, "pushed").otherwise(F.col("push_status"))})


def totals_by(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(column).agg(F.count("*").alias("n")).orderBy(column)


def running_sums(rows: DataFrame, lane: str, order: str, value: str) -> DataFrame:
    """rows with running: the sum of value up to each row in the order of its lane.

    A lane may hold most rows, so it isn't one window: rows are dealt out by ranges of (lane, order), each range is summed on its own,
    and the sums of the ranges before are added. order must tell the rows of a lane apart.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialize(rows.repartitionByRange(parts, lane, order).withColumn("__range", F.spark_partition_id()), "ranges")
    before = W.partitionBy(lane).orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    offsets = dealt.groupBy(lane, "__range").agg(F.sum(value).alias("__sum")).withColumn("__before", F.coalesce(F.sum("__sum").over(before), F.lit(0)))
    inside = F.sum(value).over(W.partitionBy(lane, "__range").orderBy(order).rowsBetween(W.unboundedPreceding, 0))
    summed = dealt.withColumn("__inside", inside).join(offsets.select(lane, "__range", "__before"), [lane, "__range"])
    return summed.withColumn("running", F.col("__inside") + F.col("__before")).drop("__range", "__inside", "__before")


def byte_cap(rows: DataFrame, order: str, size: str, limit: int, lane: str | None = None) -> DataFrame:
    """rows with admitted, decided in the order given within each lane (a source, say): a row is skipped if it would exceed limit
    with those admitted before it, and smaller ones after it may still be. No limit for 0.

    Each round admits every lane's rows up to the first that doesn't fit, and goes on behind it with those that are no larger than
    what is left; that is soon less than any row. order must identify the rows of a lane; rows without a size aren't admitted.
    """
    if not limit:
        return rows.withColumn("admitted", F.lit(True))
    key = F.col(lane) if lane else F.lit(0)
    named = rows.withColumns({"__lane": F.struct(key.alias("k")), "__o": F.col(order)})
    rest = named.select("__lane", "__o", F.col(size).cast("bigint").alias("__s"), F.lit(limit).cast("bigint").alias("__left")).filter("__s <= __left")
    admitted: DataFrame | None = None
    while True:
        rest = materialize(running_sums(rest, "__lane", "__o", "__s"), "running")
        if rest.isEmpty():
            break
        stops = rest.groupBy("__lane").agg(F.min(F.when(F.col("running") > F.col("__left"), F.col("__o"))).alias("__stop"))
        marked = rest.join(stops, "__lane")
        fits = F.col("__stop").isNull() | (F.col("__o") < F.col("__stop"))
        own = marked.filter(fits).select("__lane", "__o")
        admitted = own if admitted is None else admitted.union(own)
        used = marked.groupBy("__lane").agg(F.coalesce(F.sum(F.when(fits, F.col("__s"))), F.lit(0)).alias("__used"))
        after = marked.filter(F.col("__o") > F.col("__stop")).join(used, "__lane")
        rest = after.select("__lane", "__o", "__s", (F.col("__left") - F.col("__used")).alias("__left")).filter("__s <= __left")
    if admitted is None:
        return named.withColumn("admitted", F.lit(False)).drop("__lane", "__o")
    found = named.join(admitted.withColumn("__in", F.lit(True)), ["__lane", "__o"], "left")
    return found.withColumn("admitted", F.coalesce("__in", F.lit(False))).select(*rows.columns, "admitted")


def size_stats(rows: DataFrame, source: str, parts: dict[str, Column]) -> DataFrame:
    """Rows and bytes by source: parts names the byte columns."""
    return rows.groupBy(source).agg(F.count("*").alias("n"), *(F.sum(c).alias(name) for name, c in parts.items()))


def with_namespace(episodes: DataFrame, namespace: str | None) -> DataFrame:
    """source_tool prefixed by the namespace; ids stay."""
    return episodes.withColumn("source_tool", F.concat(F.lit(f"{namespace}:"), F.col("source_tool"))) if namespace else episodes


# ---- the tables ------------------------------------------------------------------------------------------------------


class Ledger:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def _versions(self, table: str) -> list[str]:
        folder = self._path(f"{self.root}/{table}")
        found = [s.getPath().getName() for s in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        return sorted(v for v in found if v.startswith("v") and self._fs.exists(self._path(f"{self.root}/{table}/{v}.done")))

    def read(self, table: str) -> DataFrame:
        versions = [v for v in self._versions(table) if not v.endswith(".done")]
        if not versions:
            return self.spark.createDataFrame([], SCHEMAS[table])
        return self.spark.read.schema(SCHEMAS[table]).parquet(f"{self.root}/{table}/{versions[-1]}")

    def write(self, table: str, rows: DataFrame) -> None:
        """Make rows the current version; only the one before it is kept besides."""
        name = f"v{time.time_ns():020d}"
        rows.select(*self.spark.createDataFrame([], SCHEMAS[table]).columns).write.parquet(f"{self.root}/{table}/{name}")
        self._fs.create(self._path(f"{self.root}/{table}/{name}.done")).close()
        for old in [v for v in self._versions(table) if not v.endswith(".done")][:-2]:
            self._fs.delete(self._path(f"{self.root}/{table}/{old}.done"), False)
            self._fs.delete(self._path(f"{self.root}/{table}/{old}"), True)

    def upsert(self, table: str, rows: DataFrame, update: list[str] | None = None) -> None:
        self.write(table, merge(self.read(table), rows, key_of(table), update))

    def put(self, table: str, **values) -> None:
        """Insert or replace one row."""
        columns = [c.split()[0] for c in SCHEMAS[table].split(", ")]
        self.upsert(table, self.spark.createDataFrame([tuple(values.get(c) for c in columns)], SCHEMAS[table]))

    def insert_uploads(self, rows: DataFrame) -> None:
        self.write("uploads", insert_or_ignore(self.read("uploads"), rows, "doc_id"))

    def upsert_episodes(self, rows: DataFrame) -> None:
        self.write("episodes", upsert_episodes(self.read("episodes"), rows))

    # runs
    def start_run(self, run_id: str, at: str) -> None:
        self.put("runs", run_id=run_id, started_at=at, scanned_files=0, produced_docs=0, uploaded_docs=0, redactions=0, errors=0)

    def finish_run(self, run_id: str, at: str, **totals: int) -> None:
        row = self.read("runs").filter(F.col("run_id") == run_id).first()
        if row is not None:
            self.put("runs", **row.asDict() | {"finished_at": at} | totals)

    # cursors
    def cursor(self, source: str) -> str | None:
        row = self.read("sources").filter(F.col("source_name") == source).first()
        return row["cursor_json"] if row else None

    def set_cursor(self, source: str, cursor: str, at: str) -> None:
        self.put("sources", source_name=source, last_scan_ts=at, cursor_json=cursor)

    def fingerprint(self, path: str) -> str | None:
        row = self.read("files").filter(F.col("path") == path).first()
        return row["fingerprint"] if row else None

    # consent
    def init_consent(self, license: str, consent_version: str, at: str) -> None:
        if license not in ALLOWED_LICENSES:
            raise ValueError(f"license must be one of {', '.join(ALLOWED_LICENSES)}")
        flags = dict.fromkeys(("public_searchable", "trainable", "ack_sanitization", "ack_public_search", "ack_training_release"), 1)
        self.put("consent_state", id=1, accepted_at=at, consent_version=consent_version, license=license, **flags)

    def consent(self) -> dict | None:
        row = self.read("consent_state").first()
        flags = ("public_searchable", "trainable", "ack_sanitization", "ack_public_search", "ack_training_release")
        return None if row is None else {k: (v != 0 if k in flags else v) for k, v in row.asDict().items() if k != "id"}

    def require_consent(self) -> dict:
        state = self.consent()
        if state is None or not all(v for k, v in state.items() if isinstance(v, bool)):
            raise PermissionError("consent is required: run consent init first")
        return state

    # revocations
    def revoke(self, episode_id: str, reason: str | None, at: str) -> None:
        new = self.spark.createDataFrame([(episode_id, reason, at, None, "pending")], SCHEMAS["revocations"])
        self.write("revocations", upsert_revocations(self.read("revocations"), new))

    def sync_revocations(self, sink, now) -> int:
        """Push pending revocations one after another; a failure ends the loop, what was pushed before stays so."""
        done = 0
        for row in pending_revocations(self.read("revocations")).collect():  # a person's own revocations
            sink.push_revocation(row["episode_id"], row["reason"], row["revoked_at"])
            self.write("revocations", mark_pushed(self.read("revocations"), [row["episode_id"]], now()))
            done += 1
        return done

    def revoked_ids(self) -> DataFrame:
        return self.read("revocations").select("episode_id").orderBy("episode_id")

    # snapshots
    def record_snapshot(self, version: str, at: str, train: int, val: int, manifest_hash: str) -> None:
        self.put("snapshots", version=version, built_at=at, train_count=train, val_count=val, manifest_hash=manifest_hash)

    def mark_snapshot_published(self, version: str, at: str) -> None:
        row = self.read("snapshots").filter(F.col("version") == version).first()
        if row is not None:
            self.put("snapshots", **row.asDict() | {"published_at": at})

    # reset
    def reset_all(self) -> None:
        for table in SCHEMAS:
            if table not in KEPT_ON_RESET:
                self.write(table, self.spark.createDataFrame([], SCHEMAS[table]))

    def reset_source(self, source: str) -> None:
        """Forget a source's cursor and its uploads by document; episodes and file fingerprints stay."""
        for table in ("sources", "uploads"):
            self.write(table, self.read(table).filter(F.col("source_name") != source))

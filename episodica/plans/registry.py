"""Queries over the engine's own operators and the DuckDB SQL that states the same results.

Hashes use the sha256 profile here, because DuckDB has no BLAKE3; everything else is what the jobs run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episodica.functions.blake3 import content_digest, digests
from episodica.functions.staging import staging_path
from episodica.functions.text import blank, format_bytes, is_newer, normalize_text, preview, role_of
from episodica.operators import chunks, episodes, ledger, redact, snapshot
from episodica.operators.events import from_activity, from_conversations
from episodica.operators.normalize import normalize_files
from episodica.plans import sql
from episodica.sources import readers, registry, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLES[f.__name__] = oracle
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """More partitions for a costly row-by-row stage where a small file would be one task; large inputs stay as they are."""
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df


def conversation_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_conversations(table(spark, sf_dir, "conversations"))


def activity_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_activity(table(spark, sf_dir, "events"))


# ---- redaction -------------------------------------------------------------------------------------------------------


@query(sql.REDACT_TEXT)
def redact_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = redact.redact(spread(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return found.select("doc_id", F.sha2("text", 256).alias("text_sha256"), "n_secret", "n_email", "n_ip", "n_path", "n_total")


@query(sql.REDACTION_REPORT)
def redaction_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redact.report(redact.redact(spread(table(spark, sf_dir, "documents").select("doc_id", "text"))))


@query(sql.REDACT_LITERALS)
def redact_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(sql.LITERALS)], "k long, text string")
    return redact.redact(rows).select("k", "text", "n_secret", "n_email", "n_ip", "n_path", "n_total")


@query(sql.RESIDUAL_GATE)
def residual_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.lit("document").alias("origin"), F.col("doc_id").alias("id"), "text")
    turns = table(spark, sf_dir, "conversations").select(F.lit("turn").alias("origin"), (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text")
    return spread(docs.union(turns)).select("origin", "id", redact.is_sensitive(F.col("text")).alias("sensitive"))


@query(sql.DETECTOR_LITERALS)
def detector_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(sql.LITERALS)], "k long, text string")
    return rows.select("k", redact.is_sensitive(F.col("text")).alias("sensitive"))


@query(sql.ENTROPY_TOKENS)
def entropy_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    h, n = F.md5(F.col("doc_id").cast("string")), F.col("doc_id") % 5
    token = F.when(n == 0, h).when(n == 1, F.concat(F.lit("Zz"), h)).when(n == 2, F.concat(F.upper(F.substring(h, 1, 12)), F.lit("xyz"), F.substring(h, 1, 12)))
    token = token.when(n == 3, F.concat(F.substring(h, 1, 20), F.lit("Q"))).otherwise(F.concat(h, F.lit("."), h))
    rows = table(spark, sf_dir, "documents").select("doc_id", token.alias("token"))
    text = F.concat(F.lit("a "), "token", F.lit(" (b"))
    return rows.select("doc_id", "token", redact.is_high_entropy(F.col("token")).alias("high"), F.regexp_replace(text, redact.ENTROPY, redact.ENTROPY_REPLACEMENT).alias("redacted"))


# ---- windows and episodes --------------------------------------------------------------------------------------------


@query(sql.EPISODE_WINDOWS)
def episode_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = episodes.with_windows(conversation_events(spark, sf_dir).union(activity_events(spark, sf_dir).withColumn("path", F.concat(F.lit("u"), "path"))))
    return windows.groupBy("path", "turn", "part").agg(F.count("*").alias("n"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"))


@query(sql.WINDOW_CAP)
def window_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cap on a long session: all activity as one path per event type, no boundaries."""
    events = activity_events(spark, sf_dir).withColumn("path", F.concat("source", F.col("kind"))).filter("kind <> 'user_msg'")
    return episodes.with_windows(events).groupBy("path", "turn", "part").agg(F.count("*").alias("n"), F.min("seq").alias("first_seq"))


@query(sql.EPISODE_OUTCOME)
def episode_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = episodes.build_episodes(activity_events(spark, sf_dir), profile="sha256", gate=False)
    return made.select("path", "turn", "part", "ts_start", "ts_end", F.col("outcome.success").alias("success"), F.col("outcome.signals.exit_code").alias("exit_code"), F.array_join("meta.tool_names", ",").alias("tool_names"), F.size("meta.error_types").cast("bigint").alias("n_errors"))


@query(sql.SUMMARY_CONTEXT)
def summary_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return episodes.collect_windows(activity_events(spark, sf_dir)).select("path", "turn", "part", episodes.summary_context(F.col("ev")).alias("context"))


@query(sql.KIND_HISTOGRAM)
def kind_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity_events(spark, sf_dir).groupBy("source", "kind").agg(F.count("*").alias("n"), F.sum((~blank(F.col("text"))).cast("int")).alias("n_text"))


@query(sql.EPISODES_SUMMARY)
def episodes_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: conversations redacted, cut into turns, summarised, gated."""
    events = redact.redact(spread(conversation_events(spark, sf_dir))).drop("n_secret", "n_email", "n_ip", "n_path", "n_total")
    made = episodes.build_episodes(events, profile="sha256")
    return made.select("path", "turn", "part", "prompt", "result", "context", F.size("trace").cast("bigint").alias("n_steps"), F.element_at("trace", 3)["content"].alias("first_event"))


@query(sql.EPISODES_RAW)
def episodes_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = episodes.build_episodes(conversation_events(spark, sf_dir), include_raw=True, profile="sha256")
    return made.select("path", "turn", "part", "id", "content_hash", "prompt", "result", "context", "ts_start", "ts_end")


@query()
def episodes_default_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes with the ids that users get by default (BLAKE3, which SQL lacks)."""
    made = episodes.build_episodes(conversation_events(spark, sf_dir), include_raw=True)
    return made.select("path", "turn", "part", "id", "content_hash")


@query(sql.SFT_EXPORT)
def sft_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = episodes.derive_sft(episodes.build_episodes(conversation_events(spark, sf_dir), include_raw=True, profile="sha256"))
    return made.select("id", "instruction", "input", "output", "license", F.col("consent.trainable").alias("trainable"))


@query(sql.TOOLTRACE_EXPORT)
def tooltrace_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = episodes.build_episodes(activity_events(spark, sf_dir), include_raw=True, profile="sha256", gate=False)
    steps = episodes.derive_tooltrace(made).select("id", F.posexplode("messages").alias("step", "m"))
    return steps.select("id", "step", F.col("m.role").alias("role"), F.col("m.content").alias("content"), F.col("m.name").alias("name"))


@query(sql.ROLE_MAP)
def role_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = activity_events(spark, sf_dir).select("kind").union(conversation_events(spark, sf_dir).select("kind"))
    return rows.groupBy("kind", role_of(F.col("kind")).alias("role")).agg(F.count("*").alias("n"))


@query(sql.TEXT_FUNCTIONS)
def text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", preview(text, 140).alias("preview"), F.sha2(normalize_text(text), 256).alias("normal_sha256"), F.octet_length(text).alias("bytes"), format_bytes(F.octet_length(text)).alias("size"), blank(text).alias("is_blank"))


@query(sql.VERSION_CHECK)
def version_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", F.concat_ws(".", (F.col("p_partkey") % 3).cast("string"), (F.col("p_size") % 12).cast("string"), (F.col("p_partkey") % 7).cast("string")).alias("version"))
    return part.select("p_partkey", is_newer(F.concat(F.lit("v"), "version"), F.lit("1.9.3")).alias("newer"))


# ---- chunks ----------------------------------------------------------------------------------------------------------


@query(sql.CHUNK_PACK)
def chunk_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = chunks.chunk_events(conversation_events(spark, sf_dir), profile="sha256")
    return made.select("path", "chunk_index", F.sha2("text", 256).alias("text_sha256"), F.octet_length("text").alias("bytes"), F.col("metadata.ts_start").alias("ts_start"), F.col("metadata.content_hash").alias("content_hash"), "id")


@query(sql.ANONYMIZE)
def anonymize_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = chunks.anonymize(chunks.chunk_events(activity_events(spark, sf_dir), profile="sha256"), "salt", "sha256")
    m = F.col("metadata")
    return made.select("path", "chunk_index", m["source"].alias("source"), m["session_id"].alias("session_id"), F.array_join(m["tool_names"], ",").alias("tool_names"))


# ---- snapshots -------------------------------------------------------------------------------------------------------


def release_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as episode records: labels stand for consent, sources for licences."""
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    number = F.regexp_extract("source", r"(\d+)", 1).cast("int")
    consent = F.struct(F.coalesce(F.col("quality") == 1, F.lit(True)).alias("public_searchable"), F.coalesce(F.col("toxic") == 0, F.lit(True)).alias("trainable"))
    return docs.select(F.lit("documents").alias("path"), F.col("doc_id").alias("seq"), F.col("doc_id").cast("string").alias("id"), F.when(number % 4 == 0, "CC0-1.0").when(number % 4 == 1, "CC-BY-4.0").when(number % 4 == 2, "MIT").otherwise("CC0-1.0").alias("license"), consent.alias("consent"), F.sha2("text", 256).alias("content_hash"))


def revoked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revocations: the short documents."""
    return table(spark, sf_dir, "documents").filter(F.char_length("text") < 200).select(F.col("doc_id").cast("string").alias("episode_id"))


@query(sql.SNAPSHOT_FILTER)
def snapshot_filter_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.select_episodes(release_candidates(spark, sf_dir), revoked(spark, sf_dir)).select("id", "license", "content_hash")


@query(sql.SNAPSHOT_SPLIT)
def snapshot_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.with_split(release_candidates(spark, sf_dir), "seed-1", "sha256").select("id", "bucket", "split")


@query(sql.SNAPSHOT_DERIVED)
def snapshot_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived records of a release whose records share ids (that of a path): one record each, in order of their places."""
    made = episodes.build_episodes(conversation_events(spark, sf_dir), include_raw=True, profile="sha256").withColumn("id", F.col("path"))
    sft = episodes.derive_sft(made, ("path", "turn", "part")).select("path", "turn", "part", "id", F.col("instruction").alias("first"), F.lit("sft").alias("kind"))
    trace = episodes.derive_tooltrace(made, ("path", "turn", "part")).select("path", "turn", "part", "id", F.col("messages")[0]["content"].alias("first"), F.lit("tooltrace").alias("kind"))
    return sft.union(trace)


@query(sql.LICENSES)
def license_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.license_breakdown(snapshot.select_episodes(release_candidates(spark, sf_dir), revoked(spark, sf_dir)))


# ---- ledger ----------------------------------------------------------------------------------------------------------


def uploaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger of episodes from labels: the older state, whose times differ from what is written now."""
    row = table(spark, sf_dir, "labels")
    text = lambda c: c.cast("string")
    return row.select(text(F.col("doc_id")).alias("id"), F.concat(F.lit("old"), text(F.col("quality"))).alias("content_hash"), F.lit("old").alias("source_tool"), F.lit("s").alias("session_id_hash"), F.lit(None).cast("string").alias("r2_object_key"), F.lit("2025").alias("indexed_at"), F.lit("2025").alias("uploaded_at"), F.lit("v1").alias("consent_version"), F.lit("CC0-1.0").alias("license"))


def uploads_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").cast("string").alias("id"), F.lit("new").alias("content_hash"), F.col("source").alias("source_tool"), F.lit("t").alias("session_id_hash"), F.concat(F.lit("k/"), F.col("doc_id").cast("string")).alias("r2_object_key"), F.lit("2026").alias("indexed_at"), F.lit("2026").alias("uploaded_at"), F.lit("v2").alias("consent_version"), F.lit("CC-BY-4.0").alias("license"))


@query(sql.LEDGER_UPSERT)
def ledger_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.upsert_episodes(uploaded(spark, sf_dir), uploads_now(spark, sf_dir))


def uploads_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that repeats every key, with other values later."""
    later = {"content_hash": F.lit("later"), "uploaded_at": F.lit("2027"), "license": F.lit("CC0-1.0")}
    return uploads_now(spark, sf_dir).union(uploads_now(spark, sf_dir).withColumns(later))


@query(sql.LEDGER_UPSERT_REPEATS)
def ledger_upsert_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.merge(uploaded(spark, sf_dir), uploads_twice(spark, sf_dir), "id", ledger.EPISODE_UPDATES, ["uploaded_at"])


@query(sql.DEDUPE_LEDGER)
def dedupe_against_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.not_uploaded(uploads_now(spark, sf_dir), uploaded(spark, sf_dir)).select("id", "source_tool")


@query(sql.INSERT_OR_IGNORE)
def insert_or_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.insert_or_ignore(uploaded(spark, sf_dir), uploads_twice(spark, sf_dir), "id", ["uploaded_at"]).select("id", "content_hash", "uploaded_at")


@query(sql.TOTALS)
def totals_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.totals_by(uploads_now(spark, sf_dir), "source_tool")


def revocation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = table(spark, sf_dir, "labels")
    status = F.when(F.col("doc_id") % 3 == 0, "pushed").when(F.col("doc_id") % 3 == 1, "pending")
    return row.select(F.col("doc_id").cast("string").alias("episode_id"), F.lit(None).cast("string").alias("reason"), F.format_string("2026-%06d", "doc_id").alias("revoked_at"), F.when(F.col("doc_id") % 3 == 0, "2026").alias("pushed_at"), status.alias("push_status"))


@query(sql.PENDING)
def pending_revocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.pending_revocations(revocation_rows(spark, sf_dir)).select("episode_id", "revoked_at", "push_status")


@query(sql.UPSERT_REVOCATIONS)
def upsert_revocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    toxic = table(spark, sf_dir, "labels").filter("toxic = 1").select(F.col("doc_id").cast("string").alias("episode_id"))
    new = revocation_rows(spark, sf_dir).join(toxic, "episode_id", "left_semi").withColumns({"reason": F.lit("again"), "pushed_at": F.lit(None).cast("string"), "push_status": F.lit("pending")})
    return ledger.upsert_revocations(revocation_rows(spark, sf_dir), new)


@query(sql.BYTE_CAP)
def byte_cap_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("source", "doc_id", F.octet_length("text").alias("size"))
    return ledger.byte_cap(docs, "doc_id", "size", 20_000, "source").select("source", "doc_id", "size", "admitted")


@query(sql.SIZE_STATS)
def size_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("source", "text", redact.redacted(F.col("text")).alias("clean"))
    return ledger.size_stats(spread(docs), "source", {"raw_bytes": F.octet_length("text"), "clean_bytes": F.octet_length("clean")})


@query(sql.NAMESPACE)
def namespace_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.with_namespace(uploads_now(spark, sf_dir), "team").select("id", "source_tool")


# ---- sources, readers, sinks -----------------------------------------------------------------------------------------


@query(sql.SOURCE_OVERRIDE)
def source_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").select(F.concat(F.lit("id"), (F.col("s_suppkey") % 40).cast("string")).alias("id"), F.col("s_suppkey").alias("position"), F.col("s_name").alias("definition"))
    return registry.override(rows)


@query(sql.GLOB_MATCH)
def glob_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.regexp_replace("url", "^https?://", "")
    return table(spark, sf_dir, "pages").select("page_id", path.rlike(registry.glob_regex("**/en/*")).alias("nested"), path.rlike(registry.glob_regex("*.example.com/*")).alias("crossing"), path.rlike(registry.glob_regex("[mt]?*.[!x]*")).alias("classes"))


@query(sql.NORMALIZE_EVENTS)
def normalize_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's activity as a JSON lines file, read back into canonical events."""
    body = F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp"), F.lit("event_msg").alias("type"), F.struct(F.when(F.col("event_type") == "error", "error").when(F.col("event_type") == "purchase", "tool_call").otherwise("user_message").alias("type"), F.array(F.struct(F.lit("text").alias("type"), F.col("event_type").alias("text")), F.struct(F.lit("text").alias("type"), F.format_string("%d", "event_id").alias("text"))).alias("content"), F.when(F.col("event_type") == "purchase", F.lit("shop")).alias("name"), F.from_json("props", "k int").alias("args")).alias("payload"))
    line = F.to_json(body)
    files = table(spark, sf_dir, "events").groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_id", line.alias("line")))).alias("l"))
    files = files.select(F.concat(F.lit("/logs/u"), F.col("user_id").cast("string"), F.lit(".jsonl")).alias("path"), F.array_join("l.line", "\n").alias("content"))
    found = normalize_files(files, "activity", "jsonl")
    return found.select("path", "seq", "source", "session_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "kind", "text", F.col("tool.name").alias("tool_name"), F.col("tool.args_json").alias("args_json"), "ts_inferred")


@query(sql.READ_LINES)
def read_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("path"), F.col("text").alias("content"))
    return readers.lines(files).select("path", "seq", F.sha2("line", 256).alias("line_sha256"), "next_offset")


@query(sql.PAYLOAD_PREVIEW)
def payload_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = episodes.build_episodes(conversation_events(spark, sf_dir), include_raw=True, profile="sha256")
    return sinks.head(made, 5).select("path", "turn", "part", "id", F.substring("prompt", 1, 240).alias("prompt"))


# ---- what the jobs and readers are made of ---------------------------------------------------------------------------


@query(sql.NORMALIZE_META)
def normalize_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with offsets and nanoseconds, nested texts, metadata inside and outside the payload, wrapped exit codes, and bad lines."""
    e = table(spark, sf_dir, "events")
    number = F.col("event_id").cast("string")
    payload = F.struct(F.lit("tool_result").alias("type"), F.array(F.struct(F.lit("a").alias("text"), F.lit(None).cast("string").alias("value")), F.struct(F.lit(None).cast("string").alias("text"), number.alias("value"))).alias("content"), F.lit("/w").alias("cwd"), (F.col("event_id") * 3_000_000_000).alias("exit_code"))
    later = F.concat(F.date_format(F.col("ts") + F.expr("interval 2 hours"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("789+02:00"))
    called = F.to_json(F.struct(later.alias("time"), F.lit("event_msg").alias("type"), F.lit("r").alias("repo"), payload.alias("payload")))
    plain = F.to_json(F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ts"), F.lit("note").alias("kind"), number.alias("text"), F.lit("m").alias("model")))
    line = F.when(F.col("event_type") == "error", F.concat(F.lit("{bad "), number)).when(F.col("event_type") == "purchase", called).otherwise(plain)
    files = e.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_id", line.alias("line")))).alias("l"))
    files = files.select(F.concat(F.lit("/logs/"), F.col("user_id").cast("string"), F.lit(".jsonl")).alias("path"), F.array_join("l.line", "\r\n").alias("content"))
    found = normalize_files(files, "s", "jsonl")
    return found.select("path", "seq", "kind", "text", "ts_inferred", F.when(~F.col("ts_inferred"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("at"), F.col("meta.cwd").alias("cwd"), F.col("meta.repo").alias("repo"), F.col("meta.exit_code").alias("exit_code"), F.col("meta.model").alias("model"))


@query(sql.SESSION_FILES)
def session_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation as a file of one session by key."""
    parts = F.array(F.struct(F.lit("text").alias("type"), F.col("text")), F.struct(F.lit("image").alias("type"), F.lit("no").alias("text")))
    message = F.struct("turn", "role", F.lit("2026-01-02T03:04:05Z").alias("created_at"), parts.alias("parts"))
    files = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(message)).alias("messages"))
    session = F.struct(F.concat(F.lit("s"), F.col("conv_id").cast("string")).alias("id"), F.lit("/w").alias("workspace_root"), "messages")
    key = F.concat(F.lit("c"), F.col("conv_id").cast("string"))
    files = files.select(key.alias("path"), F.to_json(F.map_from_arrays(F.array(key), F.array(session))).alias("content"))
    found = normalize_files(files, "tool", "json", "tandem_v1")
    return found.select("path", "seq", "session_id", "kind", "text", F.col("meta.cwd").alias("cwd"), F.array_join("meta.tags", ",").alias("tags"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"))


@query(sql.MIXED_FILES)
def mixed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as whole JSON files, JSON lines, and files of another suffix that hold anything."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("k"), "text", (F.col("doc_id") % 3).alias("way"))
    whole = F.to_json(F.struct(F.lit("page").alias("type"), F.struct(F.struct(F.col("text").alias("value")).alias("content")).alias("message")))
    lines = F.concat(F.to_json(F.struct(F.lit("first").alias("kind"), F.col("k").alias("input"))), F.lit("\n\n"), F.to_json(F.struct(F.col("k").alias("text"))))
    path = F.concat("k", F.when(F.col("way") == 0, ".json").when(F.col("way") == 1, ".JSONL").otherwise(".log"))
    files = docs.select(path.alias("path"), F.when(F.col("way") == 0, whole).when(F.col("way") == 1, lines).otherwise(F.concat(F.lit("log "), "k", F.lit("\nend"))).alias("content"))
    return normalize_files(spread(files), "s", "mixed").select("path", "seq", "session_id", "kind", F.sha2("text", 256).alias("text_sha256"))


@query(sql.STRICT_EVENTS)
def strict_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as strict lines, some with a field that is missing or has another type."""
    made = activity_events(spark, sf_dir)
    value = sinks.event_lines(made.withColumn("meta", F.lit(None).cast(made.schema["meta"].dataType)))
    kind = F.get_json_object("value", "$.kind")
    broken = F.when(kind == "error", F.regexp_replace("value", '"text":"', '"texts":"')).when(kind == "tool_call", F.regexp_replace("value", '"name":"[^"]*"', '"name":null')).when(kind == "user_msg", F.regexp_replace("value", '"ts":"([^"]*)"', '"ts":"later"')).otherwise(F.col("value"))
    found = readers.parse_events(value.select("path", "seq", broken.alias("line")))
    return found.select("path", "seq", "source", "session_id", "kind", "text", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"))


@query(sql.STRICT_EPISODES)
def strict_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episode records written as lines and read back; those of a first turn have a number for a flag."""
    made = episodes.build_episodes(conversation_events(spark, sf_dir), include_raw=True, profile="sha256")
    values = sinks.episode_lines(made.withColumn("path", F.concat_ws("/", "path", "turn", "part")))
    line = F.when(F.split("path", "/")[1] == "1", F.regexp_replace("value", '"trainable":true', '"trainable":1')).otherwise(F.col("value"))
    found = readers.parse_episodes(values.select("path", F.lit(0).cast("bigint").alias("seq"), line.alias("line")))
    return found.select("path", "id", "prompt", F.size("trace").cast("bigint").alias("n_steps"), F.col("consent.trainable").alias("trainable"), F.col("meta.raw_content_included").alias("raw"))


@query(sql.SUMMARY_TRACE)
def summary_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every step of the summarised traces."""
    windows = episodes.collect_windows(activity_events(spark, sf_dir))
    steps = windows.select("path", "turn", "part", F.posexplode(episodes.summary_trace(F.col("ev"))).alias("step", "s"))
    return steps.select("path", "turn", "part", "step", F.col("s.role").alias("role"), F.col("s.content").alias("content"), F.col("s.name").alias("name"), F.col("s.ts").alias("ts"))


@query(sql.EVENT_LINES)
def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the lines that scans write."""
    return sinks.event_lines(conversation_events(spark, sf_dir)).select("path", "seq", F.sha2("value", 256).alias("line_sha256"))


@query(sql.INDEX_POINTERS)
def index_pointers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the search index gets for each episode, but for hashes and key."""
    made = sinks.pointer_rows(episodes.build_episodes(conversation_events(spark, sf_dir), include_raw=True, profile="sha256"))
    part = lambda path: F.get_json_object("pointer", path)
    return made.select("id", part("$.prompt").alias("data"), part("$.source_tool").alias("source_tool"), part("$.session_id").alias("session_id"), part("$.license").alias("license"), part("$.consent.trainable").alias("trainable"), part("$.meta.tool_names").alias("tool_names"))


@query(sql.BLAKE3)
def blake3_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of published texts, by the column function, and of the published bytes 0 to 250 repeated."""
    texts = spark.createDataFrame([(t,) for t in sql.BLAKE3_TEXTS], "input string")
    lengths = spark.createDataFrame([(f"{n} bytes", d) for n, d in zip(sql.BLAKE3_LENGTHS, digests([bytes(k % 251 for k in range(n)) for n in sql.BLAKE3_LENGTHS]), strict=True)], "input string, digest string")
    return texts.select("input", content_digest(F.col("input")).alias("digest")).union(lengths)


# ---- the ledger's tables ---------------------------------------------------------------------------------------------


def new_ledger(spark: SparkSession) -> ledger.Ledger:
    return ledger.Ledger(spark, staging_path(spark, "ledger"))


@query(sql.LEDGER_RESET_SOURCE)
def ledger_reset_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uploads of all documents and cursors of two sources, after one source was reset."""
    book = new_ledger(spark)
    none = F.lit(None).cast("string")
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), F.sha2("text", 256).alias("content_hash"), F.col("source").alias("source_name"), none.alias("session_id"), none.alias("ts_start"), none.alias("ts_end"), F.lit("2026").alias("uploaded_at"))
    book.insert_uploads(docs)
    for name in ("src1", "src2"):
        book.set_cursor(name, "{}", "1")
    book.reset_source("src1")
    left = book.read("uploads").select("doc_id", "content_hash", "source_name")
    return left.union(book.read("sources").select("source_name", "cursor_json", F.lit("cursor")))


@query(sql.LEDGER_RUNS)
def ledger_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs that were started, and one that was finished; they outlive a reset."""
    book = new_ledger(spark)
    book.start_run("a", "1")
    book.start_run("b", "2")
    book.finish_run("a", "3", scanned_files=4, produced_docs=5, uploaded_docs=6, redactions=7, errors=0)
    book.finish_run("missing", "9", errors=1)
    book.reset_all()
    return book.read("runs")


@query(sql.LEDGER_CONSENT)
def ledger_consent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consent given twice: the last one counts."""
    book = new_ledger(spark)
    book.init_consent("CC0-1.0", "v1", "1")
    book.init_consent("CC-BY-4.0", "v2", "2")
    return spark.createDataFrame([(k, str(v)) for k, v in book.require_consent().items()], "name string, value string")


@query(sql.LEDGER_REVOCATIONS)
def ledger_revocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three revocations pushed, one of them made again after that, and the ids for releases."""
    book = new_ledger(spark)
    for k, name in enumerate("cab"):
        book.revoke(name, None, f"2026-0{k + 1}")
    book.sync_revocations(sinks.MemorySink(), lambda: "pushed")
    book.revoke("a", "again", "2027")
    return book.read("revocations").join(book.revoked_ids(), "episode_id")


@query(sql.LEDGER_SNAPSHOTS)
def ledger_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Releases recorded and one published, beside cursors and file fingerprints."""
    book = new_ledger(spark)
    book.record_snapshot("1", "1", 2, 3, "m")
    book.record_snapshot("2", "2", 4, 5, "n")
    book.mark_snapshot_published("1", "9")
    book.mark_snapshot_published("none", "9")
    return book.read("snapshots")


@query(sql.LEDGER_CURSORS)
def ledger_cursors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cursors and fingerprints by point reads: the last ones, null for unknown names."""
    book = new_ledger(spark)
    book.set_cursor("s", "{}", "1")
    book.set_cursor("s", '{"files":{}}', "2")
    book.put("files", path="p", fingerprint="f", last_seen_ts="1")
    return spark.createDataFrame([("s", book.cursor("s")), ("t", book.cursor("t")), ("p", book.fingerprint("p")), ("q", book.fingerprint("q"))], "name string, value string")


@query(sql.MARK_PUSHED)
def mark_pushed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.mark_pushed(revocation_rows(spark, sf_dir), ["1", "2", "3"], "now").select("episode_id", "pushed_at", "push_status")


@query(sql.SOURCE_CHECKS)
def source_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources that are refused, and one that isn't."""

    def verdict(*sources: registry.Source, version: int | None = 1) -> bool:
        try:
            registry.validate_manifest(version, list(sources))
        except ValueError:
            return False
        return True

    good = registry.Source("logs", ("~/logs",), ("*.jsonl",), "jsonl")
    changed = {"id": "a b", "roots": (), "globs": (), "format": "xml"}
    rows = [("good", verdict(good)), ("none", verdict()), ("version", verdict(good, version=2)), ("repeated", verdict(good, good))]
    rows += [(name, verdict(registry.Source(**({"id": "logs", "roots": ("~/logs",), "globs": ("*",), "format": "jsonl"} | {name: value})))) for name, value in changed.items()]
    rows += [("traversal", verdict(registry.Source("logs", ("~/logs/../x",), ("*",), "jsonl"))), ("parent", verdict(registry.Source("logs", ("~/logs",), ("../*",), "jsonl"))), ("outside", verdict(registry.Source("logs", ("/etc",), ("*",), "jsonl")))]
    return spark.createDataFrame(rows, "name string, valid boolean")

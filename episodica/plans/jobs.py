"""Whole jobs: incremental runs over sources, and the scan, sanitize and publish steps over files."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import UTC, datetime
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from episodica.functions.ship import ship_package
from episodica.functions.staging import discard, materialize
from episodica.operators import redact
from episodica.operators.chunks import hash_identifier
from episodica.operators.episodes import build_episodes, is_turn_boundary
from episodica.operators.ledger import Ledger, byte_cap, not_uploaded, running_sums, size_stats, with_namespace
from episodica.sources import readers, registry, sinks

POLICY_VERSION, SANITIZER_VERSION = "policy-v1", "sanitizer-v1"
ORDER = ("path", "turn", "part")


def utc_now() -> str:
    return datetime.now(UTC).isoformat()


@dataclass
class Result:
    scanned_files: int = 0
    produced_docs: int = 0
    would_upload_docs: int = 0
    uploaded_docs: int = 0
    skipped_existing_docs: int = 0
    capped_docs: int = 0
    redactions: int = 0
    would_upload_bytes: int = 0
    uploaded_bytes: int = 0
    capped_bytes: int = 0
    exported_payload_docs: int = 0
    by_source: dict[str, int] = field(default_factory=dict)
    payload_preview: list[dict] = field(default_factory=list)
    source_stats: list[dict] = field(default_factory=list)


def load_salt(path: str | Path) -> str:
    """The salt of anonymised identifiers; made once and kept private."""
    path = Path(path)
    if path.exists() and (salt := path.read_text().strip()):
        return salt
    salt = str(uuid.uuid4())
    registry.write_private(path, salt)
    return salt


def upload_all(chosen: DataFrame, sink, salt: str) -> DataFrame:
    """id, key of the episodes of chosen (id, payload, pointer) after each was uploaded and indexed, as a staged table."""

    def send(ids: list[str], payloads: list[str], pointers: list[str]) -> list[str]:
        keys = [sink.upload(i, body) for i, body in zip(ids, payloads, strict=True)]
        if ids:
            sink.index_vectors([sinks.pointer_of(*row, salt) for row in zip(ids, pointers, keys, strict=True)])
        return keys

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                own = batch.slice(at, 100)
                keys = send(*(own.column(k).to_pylist() for k in range(3)))
                yield pa.RecordBatch.from_arrays([own.column(0), pa.array(keys, pa.string())], ["id", "key"])

    own = chosen.select("id", "payload", "pointer")
    if sink.distributed:
        ship_package(chosen.sparkSession)
        return materialize(own.mapInArrow(rows, "id string, key string"), "sent")
    found = [(r["id"], send([r["id"]], [r["payload"]], [r["pointer"]])[0]) for r in own.toLocalIterator()]
    return materialize(chosen.sparkSession.createDataFrame(found, "id string, key string"), "sent")


def deliver(found: DataFrame, ledger: Ledger, sink, result: Result, dry_run: bool, limit: int | None, preview: int = 0, export: Path | None = None, export_limit: int | None = None, now: Callable[[], str] = utc_now, salt: str = "") -> None:
    """Deduplicate against the ledger, preview, export, cap by bytes, upload and index, and record.

    Within a real run a repeated id is uploaded once; in a dry run each copy counts. A distributed sink is called on the executors, any
    other in the driver, a partition at a time. What was uploaded is recorded by one merge. Uploads are idempotent by id, so a run that
    failed before it is repeated as a whole.
    """
    known = found.count()
    fresh = not_uploaded(found, ledger.read("episodes"))
    if not dry_run:
        first = F.row_number().over(W.partitionBy("id").orderBy(*ORDER))
        fresh = fresh.withColumn("__n", first).filter("__n = 1").drop("__n")
    payload = F.to_json(F.struct(*sinks.RECORD), {"ignoreNullFields": "false"})
    fresh = fresh.withColumns({"payload": payload, "pos": F.struct(*ORDER)}).withColumn("bytes", F.octet_length("payload").cast("bigint")).persist()
    try:
        docs, size = fresh.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
        result.produced_docs += known
        result.skipped_existing_docs += known - docs
        result.would_upload_docs += docs
        result.would_upload_bytes += size
        room = max(preview - len(result.payload_preview), 0)
        if room:
            result.payload_preview += [json.loads(r["payload"]) for r in sinks.head(fresh, room, ORDER).select("payload").collect()]
        if export is not None:
            left = None if export_limit is None else export_limit - result.exported_payload_docs
            if left is None or left > 0:
                with export.open("a") as out:
                    for row in sinks.head(fresh, left or 0, ORDER).select("payload").toLocalIterator():
                        out.write(row["payload"] + "\n")
                        result.exported_payload_docs += 1
        if dry_run:
            return
        admitted = fresh.withColumn("admitted", F.lit(True))
        if limit:
            admitted = byte_cap(fresh, "pos", "bytes", limit - result.uploaded_bytes) if limit > result.uploaded_bytes else fresh.withColumn("admitted", F.lit(False))
        refused = admitted.filter("not admitted").agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
        result.capped_docs += refused[0]
        result.capped_bytes += refused[1]
        chosen = sinks.pointer_rows(admitted.filter("admitted"))
        recorded = ["id", "content_hash", "source_tool", F.col("session_id").alias("session_id_hash"), F.col("key").alias("r2_object_key"), F.lit(now()).alias("indexed_at"), F.lit(now()).alias("uploaded_at"), F.col("consent.consent_version").alias("consent_version"), "license"]
        sent = upload_all(chosen, sink, salt)
        try:
            done = chosen.join(sent, "id")
            counts = done.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
            result.uploaded_docs += counts[0]
            result.uploaded_bytes += counts[1]
            if counts[0]:
                ledger.upsert_episodes(done.select(*recorded))
        finally:
            discard(sent)
    finally:
        fresh.unpersist()


def changed_files(files: DataFrame, cursor: str | None, format: str) -> DataFrame:
    """files with fingerprint, without those lines-files that an earlier run has read to their end unchanged.

    The cursor is JSON {"files": {path: {"last_byte_offset", "file_fingerprint"}}}; one that can't be read counts as empty. An
    appended file has another fingerprint and is read whole again; the ledger absorbs what was uploaded before.
    """
    marked = files.withColumn("fingerprint", readers.fingerprint(F.col("length"), F.col("modified")))
    if format != "jsonl" or not cursor:
        return marked
    try:
        seen = [(path, entry["file_fingerprint"]) for path, entry in json.loads(cursor)["files"].items()]
    except (ValueError, KeyError, TypeError, AttributeError):
        seen = []
    known = files.sparkSession.createDataFrame(seen, "path string, fingerprint string")
    return marked.join(known, ["path", "fingerprint"], "left_anti")


def run(
    spark: SparkSession, sources: list[registry.Source], ledger: Ledger, salt: str, sink=None, dry_run: bool = True, confirmed: bool = False, include_raw: bool = False,
    max_upload_bytes: int | None = None, preview: int = 0, export: Path | None = None, export_limit: int | None = None, commit_on_dry_run: bool = False, pack: str = "default", now: Callable[[], str] = utc_now, scanner=None,
) -> Result:
    """One incremental run: discover, parse, redact (and ask an outside scanner, if one is given), build episodes, anonymise,
    deduplicate, cap, upload, index, record.

    Uploads need confirmed. A source's cursor is committed after its episodes; on dry runs only if commit_on_dry_run asks for it, since
    it would hide the same files from the real run that follows.
    """
    if not dry_run and not confirmed:
        raise PermissionError("uploads must be reviewed and confirmed, or use a dry run")
    consent = ledger.require_consent()
    run_id = str(uuid.uuid4())
    ledger.start_run(run_id, now())
    result = Result()
    if export is not None:
        export.parent.mkdir(parents=True, exist_ok=True)
        export.write_text("")
    for source in sources:
        files = changed_files(registry.discover(spark, source), ledger.cursor(source.id), source.format).persist()
        listed = files.collect()  # at most registry.MAX_FILES
        result.scanned_files += len(listed)
        stats = {"source": source.id, "scanned_files": len(listed), "input_file_bytes": sum(f["length"] for f in listed)}
        before = result.produced_docs
        if listed:
            events = readers.read_source(spark, [f["path"] for f in listed], source.id, source.format, source.parser_hint).persist()
            clean = redact.apply_scanner(redact.redact(events, pack=pack), scanner).persist()
            result.redactions += redact.report(clean).first()["total_redactions"]
            raw = events.select(F.lit(source.id).alias("source"), F.col("text"))
            sizes = size_stats(raw, "source", {"parsed_event_text_bytes": F.octet_length("text")}).first()
            stats |= {"events": sizes["n"], "parsed_event_text_bytes": sizes["parsed_event_text_bytes"]} if sizes else {"events": 0}
            stats["sanitized_event_text_bytes"] = clean.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
            made = build_episodes(clean, include_raw, source_tool=source.id, accepted_at=consent["accepted_at"], consent_version=consent["consent_version"], license=consent["license"], policy_version=POLICY_VERSION, sanitizer_version=SANITIZER_VERSION)
            made = made.withColumn("session_id", hash_identifier(F.col("session_id"), salt)).persist()
            deliver(made, ledger, sink, result, dry_run, max_upload_bytes, preview, export, export_limit, now, salt)
            for held in (made, clean, events):
                held.unpersist()
        if not dry_run or commit_on_dry_run:
            cursor = json.loads(ledger.cursor(source.id) or '{"files": {}}')
            cursor["files"] |= {f["path"]: {"last_byte_offset": f["length"], "file_fingerprint": f["fingerprint"]} for f in listed}
            ledger.set_cursor(source.id, json.dumps(cursor, sort_keys=True), now())
            if listed:
                ledger.upsert("files", spark.createDataFrame([(f["path"], f["fingerprint"], now()) for f in listed], "path string, fingerprint string, last_seen_ts string"))
        result.by_source[source.id] = result.produced_docs - before
        result.source_stats.append(stats)
        files.unpersist()
    ledger.finish_run(run_id, now(), scanned_files=result.scanned_files, produced_docs=result.produced_docs, uploaded_docs=result.uploaded_docs, redactions=result.redactions, errors=0)
    return result


# ---- the same in steps over files ------------------------------------------------------------------------------------


def scan(spark: SparkSession, input: str | list[str], out: str) -> dict:
    """JSON lines at input to canonical events under out."""
    files = readers.input_files(spark, input).count()
    events = readers.read_source(spark, input, "manual_scan", "jsonl").persist()
    sinks.write_events(events, f"{out}/canonical_events")
    found = {"input_files": files, "produced_events": events.count(), "output": f"{out}/canonical_events"}
    events.unpersist()
    return found


def sanitize(spark: SparkSession, input: str | list[str], out: str, pack: str = "default", scanner=None) -> dict:
    """Canonical events at input to redacted ones, and a report, under out."""
    events = readers.read_events(spark, input).persist()
    clean = redact.apply_scanner(redact.redact(events, pack=pack), scanner).persist()
    sinks.write_events(clean, f"{out}/sanitized_events")
    report = redact.report(clean).first().asDict()
    report["sample_redacted"] = [r["text"] for r in redact.samples(events, clean, ["path", "seq"]).collect()]
    spark.createDataFrame([(json.dumps(report, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{out}/redaction_report")
    found = {"input_events": events.count(), "output_events": clean.count(), "report": report}
    events.unpersist()
    clean.unpersist()
    return found


def one_session(events: DataFrame, name: str) -> DataFrame:
    """events of all files as one session in the order of path and seq: numbered, with turn, and the session_id of the first.

    The numbers are running sums over ranges of the order (see ledger.running_sums), so no task holds the whole session.
    """
    rows = events.withColumns({"lane": F.lit(0), "place": F.struct("path", "seq"), "one": F.lit(1), "boundary": F.coalesce(is_turn_boundary(F.col("kind"), F.col("text")), F.lit(False)).cast("int")})
    numbered = running_sums(rows, "lane", "place", "one").withColumnRenamed("running", "number")
    numbered = running_sums(numbered, "lane", "place", "boundary").withColumnRenamed("running", "turn")
    first = events.agg(F.min_by("session_id", F.struct("path", "seq"))).first()[0]
    fresh = {"path": F.lit(name), "seq": F.col("number").cast("bigint"), "turn": F.col("turn").cast("bigint"), "session_id": F.lit(first).cast("string")}
    return numbered.withColumns(fresh).select(*events.columns, "turn")


def publish(spark: SparkSession, input: str | list[str], ledger: Ledger, sink=None, namespace: str | None = None, dry_run: bool = True, confirmed: bool = False, include_raw: bool = False, max_upload_bytes: int | None = None, now: Callable[[], str] = utc_now, salt: str = "") -> Result:
    """Episodes at input, or, if there are none, episodes built from the canonical events there as one session; deliver them.

    Events aren't redacted here: the residual gate alone protects them, so sanitize first.
    """
    if not dry_run and not confirmed:
        raise PermissionError("uploads must be reviewed and confirmed, or use a dry run")
    consent = ledger.require_consent()
    found = readers.read_episodes(spark, input).withColumns({"turn": F.col("seq"), "part": F.lit(0).cast("bigint")})
    if found.isEmpty():
        events = readers.read_events(spark, input)
        found = build_episodes(one_session(events, "manual_scan"), include_raw, in_turns=True, source_tool="manual_scan", accepted_at=consent["accepted_at"], consent_version=consent["consent_version"], license=consent["license"], policy_version=POLICY_VERSION, sanitizer_version=SANITIZER_VERSION)
    result = Result()
    deliver(with_namespace(found, namespace), ledger, sink, result, dry_run, max_upload_bytes, 5, now=now, salt=salt)
    return result

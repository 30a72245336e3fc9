"""Where episodes, revocations and snapshots go. Connections are made by a transport alone, which can be passed in."""

from __future__ import annotations

import json
import random
import time
from collections.abc import Callable, Iterator
from datetime import UTC, datetime
from pathlib import Path
from typing import Protocol
from urllib.error import HTTPError
from urllib.parse import urlsplit
from urllib.request import Request, urlopen

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.functions.blake3 import digests
from episodica.functions.ship import ship_package
from episodica.functions.staging import materialize
from episodica.functions.text import rfc3339_z
from episodica.operators.episodes import RECORD
from episodica.operators.redact import is_sensitive


class Sink(Protocol):
    """distributed sinks are sent to the executors, where upload and index are called for each episode, maybe again after a failure:
    both must be idempotent by id. All other calls come from the driver."""

    distributed: bool

    def upload(self, episode_id: str, body: str) -> str: ...
    def index_vectors(self, vectors: list[dict]) -> None: ...
    def push_revocation(self, episode_id: str, reason: str | None, revoked_at: str) -> None: ...
    def publish_snapshot(self, version: str, manifest: dict, checksums: str, files: list[dict], card: str) -> str: ...
    def index_snapshot(self, version: str, manifest: dict, prefix: str | None) -> None: ...


class MemorySink:
    distributed = False

    def __init__(self) -> None:
        self.episodes: dict[str, str] = {}
        self.vectors: dict[str, dict] = {}
        self.revocations: list[tuple[str, str | None, str]] = []
        self.snapshots: dict[str, dict] = {}
        self.index: dict[str, dict] = {}

    def upload(self, episode_id: str, body: str) -> str:
        self.episodes[episode_id] = body
        return f"episodes/{episode_id}.json"

    def index_vectors(self, vectors: list[dict]) -> None:
        self.vectors |= {v["id"]: v for v in vectors}

    def push_revocation(self, episode_id: str, reason: str | None, revoked_at: str) -> None:
        self.revocations.append((episode_id, reason, revoked_at))

    def publish_snapshot(self, version: str, manifest: dict, checksums: str, files: list[dict], card: str) -> str:
        self.snapshots[version] = {"manifest": manifest, "checksums": checksums, "files": files, "card": card}
        return f"snapshots/{version}"

    def index_snapshot(self, version: str, manifest: dict, prefix: str | None) -> None:
        self.index[version] = {"manifest": manifest, "prefix": prefix}


class DirectorySink(MemorySink):
    """Files by id under a folder that all executors share, so that a repeated upload writes the same file again."""

    distributed = True

    def __init__(self, root: str | Path) -> None:
        super().__init__()
        self.root = Path(root)

    def upload(self, episode_id: str, body: str) -> str:
        target = self.root / "episodes" / f"{episode_id}.json"
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(body)
        return str(target.relative_to(self.root))

    def index_vectors(self, vectors: list[dict]) -> None:
        folder = self.root / "index"
        folder.mkdir(parents=True, exist_ok=True)
        for vector in vectors:
            (folder / f"{vector['id']}.json").write_text(json.dumps(vector, sort_keys=True, ensure_ascii=False))

    def publish_snapshot(self, version: str, manifest: dict, checksums: str, files: list[dict], card: str) -> str:
        target = self.root / "snapshots" / version
        target.mkdir(parents=True, exist_ok=True)
        (target / "manifest.json").write_text(json.dumps({"manifest": manifest, "files": files}, sort_keys=True))
        return str(target.relative_to(self.root))


# ---- transport policy ------------------------------------------------------------------------------------------------


class HttpError(Exception):
    def __init__(self, status: int) -> None:
        super().__init__(f"status={status}")
        self.status = status


def should_retry(status: int) -> bool:
    return status == 429 or 500 <= status < 600


def with_retries(send: Callable[[], tuple[int, str]], attempts: int = 5, sleep: Callable[[float], None] = time.sleep, jitter: Callable[[], float] = lambda: random.uniform(0.05, 0.3)) -> str:
    """The body of a successful answer. 429, 5xx and transport errors are tried again, 2^n x 200 ms plus jitter later."""
    for attempt in range(attempts):
        last = attempt + 1 == attempts
        try:
            status, body = send()
        except OSError:
            if last:
                raise
        else:
            if 200 <= status < 300:
                return body
            if last or not should_retry(status):
                raise HttpError(status)
        sleep(2**attempt * 0.2 + jitter())
    raise AssertionError("no attempts")


def upload(legacy: Callable[[], str], presigned: Callable[[], str], mode: str = "auto") -> str:
    """One of two upload ways; auto tries the presigned one and goes back to the other where it doesn't exist (404, 501)."""
    if mode == "legacy":
        return legacy()
    try:
        return presigned()
    except HttpError as problem:
        if mode != "auto" or problem.status not in {404, 501}:
            raise
        return legacy()


def ensure_secure(url: str, allow_http: bool = False) -> None:
    scheme = urlsplit(url).scheme
    if scheme != "https" and not (scheme == "http" and allow_http):
        raise ValueError(f"insecure URL: {url}")


def http(method: str, url: str, headers: dict[str, str], body: bytes | None, timeout: int = 30) -> tuple[int, str, dict[str, str]]:
    """Status, text and headers of an answer; OSError where there is none."""
    try:
        with urlopen(Request(url, body, headers, method=method), timeout=timeout) as answer:
            return answer.status, answer.read().decode(), {k.lower(): v for k, v in answer.headers.items()}
    except HTTPError as problem:
        return problem.code, problem.read().decode(errors="replace"), {}


class HttpSink:
    """A service that takes episodes, revocations and snapshots, and a search index. Requests are tried again (see with_retries).

    mode is how episodes are sent: legacy (one request), presigned (ask for an address, send there, confirm), or auto (presigned,
    and legacy where the service doesn't know that). Addresses must be https, but for local tests with allow_http.
    """

    distributed = True

    def __init__(self, base: str | None, token: str | None = None, mode: str = "legacy", index: str | None = None, index_token: str | None = None, timeout: int = 30, allow_http: bool = False, transport=http, retries: dict | None = None) -> None:
        for url in filter(None, (base, index)):
            ensure_secure(url, allow_http)
        self.base, self.token, self.mode, self.index, self.index_token = base, token, mode.lower(), index, index_token
        self.timeout, self.transport, self.retries = max(timeout, 5), transport, retries or {}

    def _send(self, method: str, url: str, body, token: str | None, headers: dict[str, str] | None = None) -> dict:
        data = body if isinstance(body, bytes) else json.dumps(body, ensure_ascii=False).encode()
        own = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {token}"} if token else {}) if headers is None else headers
        text = with_retries(lambda: self.transport(method, url, own, data, self.timeout)[:2], **self.retries)
        return json.loads(text) if text.strip().startswith("{") else {}

    def _to_base(self, path: str, body) -> dict:
        if not self.base:
            raise ValueError("no address of the service is set")
        return self._send("POST", f"{self.base.rstrip('/')}{path}", body, self.token)

    def upload(self, episode_id: str, body: str) -> str:
        digest = json.loads(body).get("content_hash")

        def legacy() -> str:
            return self._to_base("/v1/episodes", body.encode())["object_key"]

        def presigned() -> str:
            given = self._to_base("/v1/episodes/presign", {"episode_id": episode_id, "content_hash": digest, "content_type": "application/json"})
            self._send("PUT", given["upload_url"], body.encode(), None, given.get("headers") or {"Content-Type": "application/json"})
            return self._to_base("/v1/episodes/complete", {"episode_id": episode_id, "object_key": given["object_key"], "content_hash": digest})["object_key"]

        return upload(legacy, presigned, self.mode)

    def index_vectors(self, vectors: list[dict]) -> None:
        if not self.index or not self.index_token:
            raise ValueError("no address or token of the index is set")
        self._send("POST", f"{self.index.rstrip('/')}/upsert-data", {"vectors": vectors}, self.index_token)

    def push_revocation(self, episode_id: str, reason: str | None, revoked_at: str) -> None:
        self._to_base("/v1/revocations", {"episode_id": episode_id, "revoked_at": revoked_at, "reason": reason})

    def publish_snapshot(self, version: str, manifest: dict, checksums: str, files: list[dict], card: str) -> str | None:
        created = datetime.now(UTC).isoformat()
        return self._to_base("/v1/snapshots", {"version": version, "created_at": created, "manifest": manifest, "checksums": checksums, "files": files, "data_card": card}).get("object_prefix")

    def index_snapshot(self, version: str, manifest: dict, prefix: str | None) -> None:
        counts = {k: manifest.get(k) for k in ("total_records", "train_count", "val_count")}
        meta = {"kind": "dataset_snapshot", "snapshot_version": version, **counts, "pointer": {"storage": "r2", "object_key": prefix, "snapshot_version": version}}
        self.index_vectors([{"id": f"snapshot:{version}", "data": f"dataset snapshot {version}", "metadata": meta}])


# ---- tables ----------------------------------------------------------------------------------------------------------


def event_lines(events: DataFrame) -> DataFrame:
    """Canonical events as JSON lines with path and seq."""
    own = F.struct("source", "session_id", rfc3339_z(F.col("ts")).alias("ts"), "kind", "text", "tool", "meta")
    return events.select("path", "seq", F.to_json(own, {"ignoreNullFields": "false"}).alias("value"))


def episode_lines(episodes: DataFrame) -> DataFrame:
    return episodes.select("path", F.to_json(F.struct(*RECORD), {"ignoreNullFields": "false"}).alias("value"))


def write_events(events: DataFrame, out: str) -> None:
    event_lines(events).orderBy("path", "seq").select("value").write.mode("overwrite").text(out)


def head(episodes: DataFrame, n: int, order: tuple[str, ...] = ("path", "turn", "part")) -> DataFrame:
    """The first n by order: a payload preview or a limited export. n 0 exports all."""
    return episodes.orderBy(*order).limit(n) if n else episodes.orderBy(*order)


#: What of an episode goes into the metadata of its pointer.
POINTER = ("source_tool", "session_id", "license", "consent", "meta")


def pointer_rows(episodes: DataFrame) -> DataFrame:
    """episodes with pointer: JSON of what the search index gets, without hashes and key (see pointer_of).

    Fails on the first record whose metadata, but for what is hashed, looks sensitive.
    """
    open_meta = F.concat_ws(" ", "license", "consent.consent_version", F.array_join("meta.error_types", " "))
    pointer = F.to_json(F.struct("prompt", *POINTER), {"ignoreNullFields": "false"})
    return episodes.withColumn("pointer", F.when(is_sensitive(open_meta), F.raise_error(F.lit("metadata looks sensitive"))).otherwise(pointer))


def pointer_of(episode_id: str, pointer: str, key: str, salt: str, snapshot: str | None = None) -> dict:
    """The vector of an episode: the prompt as its text, and metadata with source, session and tools as salted hashes."""
    row = json.loads(pointer)
    meta, consent = row["meta"], row["consent"]
    tools = meta.get("tool_names") or []
    source, session, *names = digests([f"{salt}|{v}".encode() for v in (row["source_tool"], row["session_id"], *tools)])
    metadata = {
        "kind": "episode_pointer", "source_tool": source, "session_id": session, "license": row["license"], "consent_version": consent["consent_version"],
        "public_searchable": consent["public_searchable"], "trainable": consent["trainable"], "tool_names": names, "error_types": meta.get("error_types") or [],
        "pointer": {"storage": "r2", "object_key": key, "snapshot_version": snapshot},
    }
    return {"id": episode_id, "data": row["prompt"], "metadata": metadata}


def checked_chunks(chunks: DataFrame) -> DataFrame:
    """Anonymised chunk documents (id, text, metadata) for upload; the job fails if a text or its metadata looks sensitive."""
    m = F.col("metadata")
    shown = F.concat_ws(" ", m["source"], m["session_id"], m["repo_fingerprint"], m["tool_names"], m["error_types"], m["language"])
    unsafe = is_sensitive(F.col("text")) | is_sensitive(F.regexp_replace(shown, "[0-9a-f]{64}", ""))
    return chunks.withColumn("id", F.when(unsafe, F.raise_error(F.lit("a chunk looks sensitive"))).otherwise(F.col("id")))


def publish_chunks(chunks: DataFrame, sink) -> int:
    """Check every chunk before the first is handed to the sink's index; the number sent. A distributed sink gets them on the executors,
    a few at a time, another one a partition at a time."""
    safe = checked_chunks(chunks).persist()
    bodies = safe.select(F.to_json(F.struct("id", F.col("text").alias("data"), "metadata"), {"ignoreNullFields": "false"}).alias("body"))
    try:
        safe.count()
        if not sink.distributed:
            sent = 0
            for row in bodies.toLocalIterator():
                sink.index_vectors([json.loads(row["body"])])
                sent += 1
            return sent
        ship_package(chunks.sparkSession)

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                vectors = list(map(json.loads, batch.column(0).to_pylist()))
                for at in range(0, len(vectors), 100):
                    sink.index_vectors(vectors[at : at + 100])
                yield pa.RecordBatch.from_arrays([pa.array([len(vectors)], pa.int64())], ["n"])

        return materialize(bodies.mapInArrow(send, "n bigint"), "sent").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    finally:
        safe.unpersist()

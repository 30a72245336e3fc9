"""Raw JSON values to canonical events.

Texts nest to a depth of five in arrays and objects of any shape, which built-in functions can't flatten, so the normaliser runs
over Arrow batches. Two rules hold everywhere: of several keys the first that is present is taken, and only then is its type
tested; and objects are read and written with their keys sorted.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from datetime import UTC, datetime
from pathlib import PurePosixPath

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from episodica.functions.ship import ship_package
from episodica.operators.events import EVENT

# Where texts are looked for, and how kinds are named.
TEXT_KEYS = ("text", "message", "content", "delta", "output_text", "input")
NESTED_KEYS = ("text", "content", "value", "output_text", "message")
TIME_KEYS = ("ts", "timestamp", "time")
MAX_DEPTH = 5
MESSAGE_KINDS = {"user": "user_msg", "assistant": "assistant_msg"}
EVENT_KINDS = {"user_message": "user_msg", "tool_call": "tool_call", "tool_result": "tool_result", "error": "error"}
PART_TYPES = ("text", "input_text", "output_text")

_RFC3339 = re.compile(r"(\d{4}-\d\d-\d\d)[Tt ](\d\d:\d\d:\d\d)(?:\.(\d+))?([Zz]|[+-]\d\d:\d\d)")


def parse_json(line: str):
    """A JSON value; ValueError for what strict JSON excludes. The last of repeated keys counts."""

    def refuse(name: str):
        raise ValueError(name)

    value = json.loads(line, parse_constant=refuse)
    json.dumps(value, ensure_ascii=False).encode()  # lone surrogates aren't text
    return value


def compact_json(value) -> str:
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def member(value, *keys: str):
    """The first of keys that an object has, whatever its value; None for other values or without any."""
    if isinstance(value, dict):
        for key in keys:
            if key in value:
                return value[key]
    return None


def as_text(value) -> str | None:
    return value if isinstance(value, str) else None


def flatten(value, depth: int = 0) -> str:
    if depth > MAX_DEPTH:
        return ""
    if isinstance(value, str):
        return value
    if isinstance(value, list):
        return " ".join(part for item in value if (part := flatten(item, depth + 1)).strip())
    if isinstance(value, dict):
        found = (flatten(value[key], depth + 1) for key in NESTED_KEYS if key in value)
        return next((text for text in found if text.strip()), "")
    return ""


def text_of(value) -> str:
    if not isinstance(value, dict):
        return ""
    found = (flatten(value[key]) for key in (*TEXT_KEYS, "item") if key in value)
    return next((text for text in found if text.strip()), "")


def kind_of(outer_type: str, payload) -> str:
    inner = as_text(member(payload, "type"))
    if outer_type == "response_item" and inner == "message":
        return MESSAGE_KINDS.get(as_text(member(payload, "role")), "system")
    if outer_type == "event_msg":
        return EVENT_KINDS.get(inner, "system")
    named = as_text(member(payload, "kind", "type"))
    return named if named is not None else outer_type or "system"


def parse_time(text: str | None) -> datetime | None:
    """RFC 3339 with an offset, to UTC; digits beyond microseconds are dropped."""
    m = _RFC3339.fullmatch(text) if text else None
    if m is None:
        return None
    day, clock, fraction, zone = m.groups()
    try:
        return datetime.fromisoformat(f"{day}T{clock}.{(fraction or '0')[:6].ljust(6, '0')}{'+00:00' if zone in 'Zz' else zone}").astimezone(UTC)
    except (ValueError, OverflowError):
        return None


def exit_code(value) -> int | None:
    """A whole number that fits 64 bits, wrapped to 32."""
    if isinstance(value, bool) or not isinstance(value, int) or not -(2**63) <= value < 2**63:
        return None
    low = value & 0xFFFFFFFF
    return low - 2**32 if low >= 2**31 else low


def _event(source: str, session: str, ts: datetime | None, kind: str, text: str, tool, meta) -> dict:
    return {"source": source, "session_id": session, "ts": ts, "kind": kind, "text": text, "tool": tool, "meta": meta}


def event_of(source: str, session: str, value) -> dict:
    """The canonical event of a JSON value; ts None where none can be read."""
    payload = value["payload"] if isinstance(value, dict) and "payload" in value else value
    text = text_of(payload)
    if not text.strip():
        text = text_of(value)
    tool = member(payload, "tool")
    if isinstance(payload, dict) and "tool" in payload:
        name = as_text(tool["name"] if isinstance(tool, dict) and "name" in tool else tool)
    else:
        name = as_text(member(payload, "name"))
    shown = lambda key: compact_json(payload[key]) if key in payload else None
    either = lambda key: payload[key] if isinstance(payload, dict) and key in payload else member(value, key)
    return _event(
        source,
        session,
        parse_time(as_text(member(value, *TIME_KEYS))),
        kind_of(as_text(member(value, "type")) or "", payload),
        text,
        None if name is None else {"name": name, "args_json": shown("args"), "result_json": shown("result")},
        {"cwd": as_text(either("cwd")), "repo": as_text(either("repo")), "exit_code": exit_code(either("exit_code")), "model": as_text(either("model")), "tags": []},
    )


def fallback(source: str, session: str, line: str) -> dict:
    return _event(source, session, None, "system", line, None, None)


def session_events(source: str, root) -> Iterator[dict]:
    """The messages of a file of sessions by key: {key: {id, workspace_root, messages: [{role, created_at, parts}]}}."""
    for key in sorted(root) if isinstance(root, dict) else []:
        session = root[key]
        ident = as_text(member(session, "id"))
        messages = member(session, "messages")
        meta = {"cwd": as_text(member(session, "workspace_root", "directory")), "repo": None, "exit_code": None, "model": as_text(member(session, "model")), "tags": ["tandem_v1"]}
        session_time = parse_time(as_text(member(member(session, "time"), "updated", "created")))
        for message in messages if isinstance(messages, list) else []:
            parts = member(message, "parts")
            texts = [p["text"] for p in parts if member(p, "type") in PART_TYPES and isinstance(member(p, "text"), str)] if isinstance(parts, list) else []
            text = "\n".join(texts)
            text = text if text.strip() else text_of(message)
            if text.strip():
                kind = MESSAGE_KINDS.get(as_text(member(message, "role")), "system")
                ts = parse_time(as_text(member(message, "created_at"))) or session_time
                yield _event(source, key if ident is None else ident, ts, kind, text, None, meta)


def _stem(path: str) -> str:
    return PurePosixPath(path).stem or "unknown-session"


def document_events(source: str, path: str, content: str, format: str, hint: str | None) -> Iterator[dict]:
    """The events of one file's content. A json file that doesn't parse is an error, a bad line of jsonl an event of its own."""
    suffix = PurePosixPath(path).suffix.lower()
    lenient = False
    if format == "mixed":
        lenient = suffix not in {".jsonl", ".ndjson", ".json"}
        format = "jsonl" if suffix in {".jsonl", ".ndjson"} else "json"
    if format == "json":
        try:
            value = parse_json(content)
        except ValueError:
            if not lenient:
                raise
        else:
            yield from session_events(source, value) if hint == "tandem_v1" else [event_of(source, _stem(path), value)]
            return
    elif format != "jsonl":
        raise ValueError(f"unsupported source format: {format}")
    for line in content.split("\n"):
        line = line.rstrip("\r\n")
        if line.strip():
            try:
                value = parse_json(line)
            except ValueError:
                yield fallback(source, _stem(path), line)
            else:
                yield event_of(source, _stem(path), value)


def normalize_files(files: DataFrame, source: str, format: str, hint: str | None = None) -> DataFrame:
    """Canonical events of files (path, content string), in file order.

    Where a file gives no time, ts is the job's one current time and ts_inferred is set, so a rerun is recognisable.
    """
    ship_package(files.sparkSession)
    schema = to_arrow_schema(EVENT)
    fields = {f.name: f.type for f in schema}

    def rows(batches):
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                events = [e | {"path": path, "seq": k, "ts_inferred": e["ts"] is None} for k, e in enumerate(document_events(source, path, content or "", format, hint))]
                for at in range(0, len(events), 2000):
                    part = events[at : at + 2000]
                    yield pa.RecordBatch.from_arrays([pa.array([e[n] for e in part], t) for n, t in fields.items()], names=list(fields))

    made = files.select("path", "content").mapInArrow(rows, EVENT)
    return made.withColumn("ts", F.coalesce("ts", F.current_timestamp()))

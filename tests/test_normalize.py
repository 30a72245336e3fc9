"""Raw JSON to canonical events."""

import json

import pytest
from pyspark.sql import functions as F

from episodica.operators import normalize as nz
from episodica.sources import readers


def event(value, **more):
    return nz.event_of("src", "s", value) | more


@pytest.mark.parametrize(
    ("value", "text"),
    [
        ({"content": [{"type": "text", "text": "a"}, {"text": " "}, "b"]}, "a b"),
        ({"text": " ", "message": {"content": "m"}}, "m"),
        ({"item": {"value": "i"}}, "i"),
        ({"payload": {"text": ""}, "content": "outer"}, "outer"),
        ({"content": [[[[["deep"]]]]]}, "deep"),
        ({"content": [[[[[["too deep"]]]]]]}, ""),
        ({"content": 5}, ""),
        ([1], ""),
    ],
)
def test_texts(value, text):
    assert event(value)["text"] == text


@pytest.mark.parametrize(
    ("value", "kind"),
    [
        ({"type": "response_item", "payload": {"type": "message", "role": "user"}}, "user_msg"),
        ({"type": "response_item", "payload": {"type": "message", "role": "x"}}, "system"),
        ({"type": "event_msg", "payload": {"type": "error"}}, "error"),
        ({"type": "event_msg", "payload": {"type": "other"}}, "system"),
        ({"type": "a", "payload": {"kind": "k", "type": "t"}}, "k"),
        ({"type": "a", "payload": {"kind": 5, "type": "t"}}, "a"),
        ({"type": "", "payload": {}}, "system"),
        ({"type": "t"}, "t"),
    ],
)
def test_kinds(value, kind):
    assert event(value)["kind"] == kind


def test_the_first_present_time_decides():
    assert event({"ts": 5, "timestamp": "2026-01-01T00:00:00Z"})["ts"] is None
    assert event({"timestamp": "2026-01-01T01:00:00.1234567+01:00"})["ts"].isoformat() == "2026-01-01T00:00:00.123456+00:00"
    assert event({"ts": "2026-01-01"})["ts"] is None


@pytest.mark.parametrize(
    ("payload", "tool"),
    [
        ({"tool": {"name": "grep"}, "args": {"b": 1, "a": "é"}, "result": None}, {"name": "grep", "args_json": '{"a":"é","b":1}', "result_json": "null"}),
        ({"tool": "ls"}, {"name": "ls", "args_json": None, "result_json": None}),
        ({"name": "cat"}, {"name": "cat", "args_json": None, "result_json": None}),
        ({"tool": 5, "name": "cat"}, None),
        ({}, None),
    ],
)
def test_tools(payload, tool):
    assert event({"payload": payload})["tool"] == tool


def test_meta_prefers_the_payload_by_presence():
    meta = event({"cwd": "/a", "exit_code": 2**32 + 1, "payload": {"cwd": 5, "model": "m"}})["meta"]
    assert meta == {"cwd": None, "repo": None, "exit_code": 1, "model": "m", "tags": []}
    assert nz.exit_code(True) is None and nz.exit_code(1.0) is None and nz.exit_code(2**63) is None


def test_sessions_file():
    root = {"b": {"messages": [{"role": "user", "parts": [{"type": "text", "text": "x"}, {"type": "image"}, {"type": "input_text", "text": "y"}]}, {"role": "assistant", "content": " "}]}, "a": {"id": "A", "workspace_root": "/w", "time": {"updated": "2026-01-01T00:00:00Z"}, "messages": [{"role": "assistant", "text": "hi"}]}}
    found = list(nz.session_events("t", root))
    assert [(e["session_id"], e["kind"], e["text"]) for e in found] == [("A", "assistant_msg", "hi"), ("b", "user_msg", "x\ny")]
    assert found[0]["meta"]["cwd"] == "/w" and found[0]["ts"] is not None and found[1]["ts"] is None
    assert list(nz.session_events("t", [1])) == []


def test_lines_fall_back_and_formats_dispatch():
    content = '{"text":"a"}\r\n\n{bad\n{"a":1,"a":2,"text":"b\\rc"}'
    assert [(e["kind"], e["text"]) for e in nz.document_events("s", "/x/f.jsonl", content, "jsonl", None)] == [("system", "a"), ("system", "{bad"), ("system", "b\rc")]
    assert len(list(nz.document_events("s", "/x/f.json", '{"text":"a"}', "mixed", None))) == 1
    assert len(list(nz.document_events("s", "/x/f.log", '{"text":"a"}\n{"text":"b"}', "mixed", None))) == 2
    with pytest.raises(ValueError):
        list(nz.document_events("s", "/x/f.json", "{bad", "json", None))
    with pytest.raises(ValueError):
        list(nz.document_events("s", "/x/f.csv", "a", "csv", None))


def test_reading_a_folder(spark, tmp_path):
    (tmp_path / "one.jsonl").write_text('{"ts":"2026-01-01T00:00:00Z","kind":"user_msg","text":"a"}\n{"kind":"error","text":"b"}\n')
    (tmp_path / "bad.jsonl").write_bytes(b"\xff\xfe\n")
    rows = readers.read_source(spark, str(tmp_path), "src", "jsonl").orderBy("seq").collect()
    assert [(r["session_id"], r["kind"], r["ts_inferred"]) for r in rows] == [("one", "user_msg", False), ("one", "error", True)]
    assert readers.read_source(spark, str(tmp_path), "src", "jsonl").filter(F.col("ts").isNull()).count() == 0


def test_line_offsets(spark):
    files = spark.createDataFrame([("p", "ab\r\n\né\rx\nlast")], "path string, content string")
    assert [(r["seq"], r["line"], r["next_offset"]) for r in readers.lines(files).orderBy("seq").collect()] == [(0, "ab", 4), (2, "é\rx", 10), (3, "last", 14)]


def test_strict_events_drop_mismatches(spark, tmp_path):
    good = {"source": "s", "session_id": "x", "ts": "2026-01-01T00:00:00Z", "kind": "k", "text": "t", "tool": None, "meta": {"tags": []}}
    bad = [good | {"text": 5}, {k: v for k, v in good.items() if k != "kind"}, good | {"ts": "2026"}, good | {"tool": {"args_json": "x"}}, good | {"meta": {}}]
    (tmp_path / "e.jsonl").write_text("".join(json.dumps(x) + "\n" for x in [good, *bad, good | {"tool": {"name": "n"}}]))
    assert [r["seq"] for r in readers.read_events(spark, str(tmp_path)).orderBy("seq").collect()] == [0, 6]

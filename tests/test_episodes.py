"""Windows, episodes, chunks and snapshots."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from episodica.operators import chunks, episodes, snapshot
from episodica.operators.events import EVENT
from episodica.sources import readers, sinks

START = dt.datetime(2026, 1, 1, tzinfo=dt.UTC)


def events(spark, items, path="p"):
    rows = []
    for k, item in enumerate(items):
        kind, text, *rest = item
        tool = ({"name": rest[0], "args_json": "{}", "result_json": None}) if rest and rest[0] else None
        meta = {"cwd": None, "repo": None, "exit_code": rest[1], "model": None, "tags": []} if len(rest) > 1 else None
        rows.append((path, k, "src", "sess", START + dt.timedelta(seconds=k), kind, text, tool, meta, False))
    return spark.createDataFrame(rows, EVENT)


def window_sizes(spark, items, cap=300):
    made = episodes.with_windows(events(spark, items), cap).groupBy("turn", "part").agg(F.count("*").alias("n")).orderBy("turn", "part")
    return [r["n"] for r in made.collect()]


def folded(items, cap):
    out, current = [], 0
    for kind, text in items:
        if current and (kind == "turn_context" or (kind == "user_msg" and text.strip()) or current >= max(cap, 50)):
            out.append(current)
            current = 0
        current += 1
    return [*out, current] if current else out


def test_cap_without_boundaries(spark):
    assert window_sizes(spark, [("other", "x")] * 301) == [300, 1]


def test_turns_end_windows(spark):
    items = [("user_msg" if k % 120 == 0 else "assistant_msg", "x") for k in range(620)]
    assert window_sizes(spark, items) == [120, 120, 120, 120, 120, 20]


def test_windows_equal_the_sequential_fold(spark):
    rnd = random.Random(5)
    for cap in (50, 60):
        items = [rnd.choices([("user_msg", "q"), ("user_msg", " "), ("turn_context", ""), ("assistant_msg", "a")], [1, 5, 1, 60])[0] for _ in range(700)]
        assert window_sizes(spark, items, cap) == folded(items, cap)


def test_summary_episode(spark):
    items = [("user_msg", " Fix  the\nbug "), ("tool_call", "", "grep", 0), ("tool_call", "", "ls", 2), ("tool_call", "", "grep"), ("error", "boom"), ("assistant_msg", "done"), ("event_msg", "")]
    row = episodes.build_episodes(events(spark, items), source_tool="t").first()
    assert row["prompt"] == "summary_user_prompt: Fix the bug"
    assert row["result"] == "summary_assistant_result: done"
    assert row["context"] == 'summary: tools=["grep", "ls"] exit_codes=[0, 2] events_by_kind={"assistant_msg": 1, "error": 1, "event_msg": 1, "tool_call": 3, "user_msg": 1} error_events=1'
    assert row["trace"][0]["content"] == "summary: total_events=7 duration_secs=6 source_kinds_compacted=true"
    assert row["trace"][2]["content"] == 'summary_event: kind=user_msg chars=14 tool_args_bytes=0 tool_result_bytes=0 preview="Fix the bug"'
    assert row["trace"][3]["content"].endswith('tool_args_bytes=2 tool_result_bytes=0 preview=""') and row["trace"][3]["name"] == "grep"
    assert len(row["trace"]) == 8  # two of summary, six meaningful events
    assert row["outcome"]["success"] is False and row["outcome"]["signals"]["exit_code"] == 2
    assert row["meta"]["tool_names"] == ["grep", "ls", "grep"] and row["meta"]["error_types"] == ["error"]
    assert (row["ts_start"], row["ts_end"]) == ("2026-01-01T00:00:00+00:00", "2026-01-01T00:00:06+00:00")
    assert len(row["id"]) == 64 and row["id"] != row["content_hash"]


def test_sensitive_prompt_falls_back_in_summaries_and_drops_raw_episodes(spark):
    own = events(spark, [("user_msg", "token=[REDACTED] hello"), ("assistant_msg", "ok")])
    row = episodes.build_episodes(own).first()
    assert row["prompt"] == "summary: user_messages=1 meaningful_events=2 (raw prompt omitted)"
    assert episodes.build_episodes(own, include_raw=True).count() == 0


def test_raw_context_and_empty_fields(spark):
    items = [("system", f"s{k}") for k in range(7)] + [("error", "e1"), ("error", "e2")]
    row = episodes.build_episodes(events(spark, items), include_raw=True).first()
    assert row["context"] == "errors: e1 | e2\nsystem: s0 | s1 | s2 | s3 | s4"
    assert row["prompt"] == "" and row["result"] == ""


def test_ids_are_stable_and_profiles_differ(spark):
    own = events(spark, [("user_msg", "a"), ("assistant_msg", "b")])
    ids = [episodes.build_episodes(own, profile=p).first()["id"] for p in ("blake3", "blake3", "sha256")]
    assert ids[0] == ids[1] != ids[2]


def test_no_events_no_episodes(spark):
    assert episodes.build_episodes(events(spark, [])).count() == 0


def test_derived_records(spark):
    made = episodes.build_episodes(events(spark, [("user_msg", "a"), ("assistant_msg", "b")]), include_raw=True)
    sft = episodes.derive_sft(made).first()
    assert (sft["instruction"], sft["input"], sft["output"]) == ("a", "", "b")
    messages = episodes.derive_tooltrace(made).first()["messages"]
    assert [m["role"] for m in messages] == ["user", "assistant"] and "ts" not in messages[0].asDict()


# ---- chunks ----------------------------------------------------------------------------------------------------------


def test_chunks_overflow_by_bytes(spark):
    made = chunks.chunk_events(events(spark, [("user_msg", "é" * 800)] * 4 + [("user_msg", "x" * 9000), ("user_msg", "y")])).orderBy("chunk_index").collect()
    assert [r["text"].count("\n") + 1 for r in made] == [1, 1, 1, 1, 1, 1]
    made = chunks.chunk_events(events(spark, [("user_msg", "x" * 1000)] * 7)).orderBy("chunk_index").collect()
    assert [r["text"].count("\n") + 1 for r in made] == [3, 3, 1]
    assert made[0]["metadata"]["source"] == "src" and len({r["id"] for r in made}) == 3


def test_anonymised_chunks(spark):
    made = chunks.chunk_events(events(spark, [("tool_call", "x", "grep"), ("tool_call", "y", "ls")]))
    a, b = (chunks.anonymize(made, "salt", p).first()["metadata"] for p in ("blake3", "sha256"))
    assert len(a["tool_names"]) == len(b["tool_names"]) == 2 and a["source"] != "src" != b["source"]
    assert a["repo_fingerprint"] is None and a["tool_names"] != b["tool_names"]


def test_chunks_are_published_only_if_all_are_clean(spark):
    made = chunks.anonymize(chunks.chunk_events(events(spark, [("tool_call", "x", "grep")])), "salt")
    sink = sinks.MemorySink()
    assert sinks.publish_chunks(made, sink) == 1 and [v["data"] for v in sink.vectors.values()] == [made.first()["text"]]
    with pytest.raises(Exception, match="sensitive"):
        sinks.publish_chunks(chunks.anonymize(chunks.chunk_events(events(spark, [("user_msg", "a@b.com")])), "salt"), sink)


# ---- snapshots -------------------------------------------------------------------------------------------------------


def record(k, content, license="CC0-1.0", trainable=True):
    signals = {"tests_passed": None, "exit_code": None, "lint_fixed": None}
    meta = {"lang": None, "tool_names": [], "error_types": [], "repo_fingerprint": None, "os": "linux", "editor": None, "raw_content_included": False}
    consent = {"accepted_at": "2026", "consent_version": "v1", "public_searchable": True, "trainable": trainable}
    return {"id": f"id{k}", "source_tool": "t", "session_id": "s", "ts_start": "a", "ts_end": "b", "prompt": "p", "context": "c", "trace": [{"role": "user", "content": "x", "name": None, "ts": "a"}], "result": "r", "outcome": {"success": True, "signals": signals}, "meta": meta, "consent": consent, "license": license, "policy_version": "1", "sanitizer_version": "1", "content_hash": content}


def read_back(spark, tmp_path, records, extra=()):
    path = tmp_path / "episodes.jsonl"
    path.write_text("".join(json.dumps(r) + "\n" for r in records) + "".join(f"{x}\n" for x in extra))
    return readers.read_episodes(spark, str(path))


def unpacked(path):
    import zstandard

    return zstandard.ZstdDecompressor().stream_reader(path.open("rb")).read().decode().splitlines()


def test_snapshot_keeps_the_first_allowed_copy(spark, tmp_path):
    rows = [record(0, "h1"), record(1, "h1"), record(2, "h2"), record(3, "h3", "MIT"), record(4, "h4", trainable=False)]
    missing = {k: v for k, v in record(9, "h9").items() if k != "prompt"}
    own = read_back(spark, tmp_path, rows, ["not json", json.dumps(missing), json.dumps(record(9, 5))])
    assert own.count() == 5
    revoked = spark.createDataFrame([("id2",)], "episode_id string")
    made = snapshot.build_snapshot(own, "v1", tmp_path / "out", "seed", revoked)
    assert made.train_count + made.val_count == 1
    lines = unpacked(made.out_dir / "train.jsonl.zst") + unpacked(made.out_dir / "val.jsonl.zst")
    assert [json.loads(x)["id"] for x in lines] == ["id0"]
    assert json.loads(lines[0]) == rows[0]
    assert json.loads(unpacked(made.out_dir / "sft.jsonl.zst")[0])["instruction"] == "p"
    manifest = json.loads((made.out_dir / "manifest.json").read_text())
    assert manifest["license_breakdown"] == {"CC0-1.0": 1}
    sums = (made.out_dir / "CHECKSUMS.txt").read_text().splitlines()
    assert len(sums) == 5 and sums == sorted(sums)
    dry = snapshot.publish_snapshot("v1", tmp_path / "out", dry_run=True)
    assert not dry["indexed"] and len(dry["files"]) == 7
    sink = sinks.MemorySink()
    assert snapshot.publish_snapshot("v1", made.out_dir, sink)["object_prefix"] == "snapshots/v1" and "v1" in sink.index
    with pytest.raises(FileNotFoundError):
        snapshot.publish_snapshot("v2", tmp_path / "out", dry_run=True)


def test_snapshots_repeat_byte_for_byte(spark, tmp_path):
    own = read_back(spark, tmp_path, [record(k, f"h{k}") for k in range(40)])
    a, b = (snapshot.build_snapshot(own, v, tmp_path / "out", "seed") for v in ("a", "b"))
    for name in ("train.jsonl.zst", "val.jsonl.zst"):
        assert (a.out_dir / name).read_bytes() == (b.out_dir / name).read_bytes()


def test_empty_snapshot_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError):
        snapshot.build_snapshot(read_back(spark, tmp_path, []), "v", tmp_path, "s")


def test_split_uses_the_first_byte(spark):
    rows = spark.createDataFrame([(f"id{k}",) for k in range(500)], "id string")
    found = snapshot.with_split(rows, "seed").collect()
    assert all((r["split"] == "train") == (r["bucket"] < 98) for r in found)
    assert 0 < sum(r["split"] == "val" for r in found) < 25


def test_a_release_with_shared_ids_derives_one_record_each(spark, tmp_path):
    import io

    import zstandard

    rows = spark.createDataFrame([("p", k, "user_msg" if k % 2 == 0 else "assistant_msg", f"t{k}") for k in range(8)], "path string, seq long, kind string, text string")
    events = rows.selectExpr("path", "seq", "'s' as source", "'x' as session_id", "timestamp_seconds(seq) as ts", "kind", "text", "cast(null as struct<name:string,args_json:string,result_json:string>) as tool", "cast(null as struct<cwd:string,repo:string,exit_code:int,model:string,tags:array<string>>) as meta")
    made = episodes.build_episodes(events, include_raw=True).withColumn("id", F.when(F.col("turn") > 1, "same")).withColumn("seq", F.col("turn"))
    snapshot.build_snapshot(made, "1", tmp_path, "seed")
    for name in ("sft", "tooltrace"):
        with (tmp_path / "dataset-1" / f"{name}.jsonl.zst").open("rb") as raw:
            lines = [json.loads(x) for x in io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw))]
        assert [x["id"] for x in lines] == [None, "same", "same", "same"], name

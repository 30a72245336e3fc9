"""Ledger, incremental runs, the split steps, the stream and the command line."""

import json
import random

import pytest
from pyspark.sql import functions as F

from episodica import cli, config
from episodica.functions.blake3 import content_digest
from episodica.operators import ledger as lg
from episodica.plans import jobs
from episodica.sources import readers, sinks
from episodica.sources import registry as rg
from episodica.streaming import incremental


def line(kind, text, second):
    return json.dumps({"ts": f"2026-01-01T00:00:{second:02d}Z", "kind": kind, "text": text}) + "\n"


@pytest.fixture
def home(tmp_path, monkeypatch):
    monkeypatch.setenv("HOME", str(tmp_path))
    logs = tmp_path / "logs"
    logs.mkdir()
    (logs / "one.jsonl").write_text(line("user_msg", "mail a@b.com", 0) + line("assistant_msg", "ok", 1) + line("user_msg", "more", 2))
    (logs / "two.jsonl").write_text(line("user_msg", "other", 0))
    return tmp_path


@pytest.fixture
def book(spark, tmp_path):
    made = lg.Ledger(spark, str(tmp_path / "ledger"))
    made.init_consent("CC0-1.0", "v1", "2026")
    return made


SOURCE = rg.Source("logs", ("~/logs",), ("**/*.jsonl",), "jsonl")


def test_run_uploads_once(spark, home, book):
    sink = sinks.MemorySink()
    dry = jobs.run(spark, [SOURCE], book, "salt", dry_run=True, preview=2, export=home / "x" / "e.jsonl", export_limit=1)
    assert (dry.scanned_files, dry.produced_docs, dry.would_upload_docs, dry.uploaded_docs, dry.redactions) == (2, 3, 3, 0, 1)
    assert len(dry.payload_preview) == 2 and dry.exported_payload_docs == 1
    assert "a@b.com" not in json.dumps(dry.payload_preview)
    real = jobs.run(spark, [SOURCE], book, "salt", sink, dry_run=False, confirmed=True)
    assert real.uploaded_docs == 3 and len(sink.episodes) == 3
    assert real.source_stats[0]["sanitized_event_text_bytes"] > 0
    again = jobs.run(spark, [SOURCE], book, "salt", sink, dry_run=False, confirmed=True)
    assert (again.scanned_files, again.uploaded_docs) == (0, 0)
    with (home / "logs" / "two.jsonl").open("a") as out:
        out.write(line("user_msg", "new turn", 5))
    grown = jobs.run(spark, [SOURCE], book, "salt", sink, dry_run=False, confirmed=True)
    assert (grown.scanned_files, grown.skipped_existing_docs, grown.uploaded_docs) == (1, 1, 1)
    assert lg.totals_by(book.read("episodes"), "source_tool").first()["n"] == 4
    assert book.read("runs").filter("finished_at is not null").count() == 4
    book.reset_source("logs")
    assert book.cursor("logs") is None and book.read("episodes").count() == 4
    book.reset_all()
    assert book.read("episodes").count() == 0 and book.read("runs").count() == 4


def test_byte_limit_in_a_run(spark, home, book):
    sink = sinks.MemorySink()
    capped = jobs.run(spark, [SOURCE], book, "salt", sink, dry_run=False, confirmed=True, max_upload_bytes=1)
    assert (capped.uploaded_docs, capped.capped_docs) == (0, 3) and capped.capped_bytes > 0


def test_run_needs_confirmation_and_consent(spark, home, book, tmp_path):
    with pytest.raises(PermissionError):
        jobs.run(spark, [SOURCE], book, "salt", dry_run=False)
    with pytest.raises(PermissionError):
        jobs.run(spark, [SOURCE], lg.Ledger(spark, str(tmp_path / "none")), "salt")
    with pytest.raises(ValueError):
        book.init_consent("MIT", "v1", "2026")


def test_fingerprints(spark):
    row = spark.sql("select 10L as n, timestamp '1970-01-01 00:00:05' as t").select(readers.fingerprint(F.col("n"), F.col("t")).alias("f"), content_digest(F.lit("10:5")).alias("g")).first()
    assert row["f"] == row["g"]


def test_byte_cap_skips_and_admits_later_smaller_ones(spark):
    rows = spark.createDataFrame([(1, 6), (2, 5), (3, 4), (4, 1)], "k long, size long")
    admitted = lambda limit: [r["admitted"] for r in lg.byte_cap(rows, "k", "size", limit).orderBy("k").collect()]
    assert admitted(10) == [True, False, True, False]
    assert admitted(0) == [True] * 4


def test_byte_cap_equals_the_sequential_fold(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice(["a", "b", None]), k, rnd.choice([1, 3, 7, 20, 50, 200])) for k in range(300)]
    left, want = {}, {}
    for lane, k, size in rows:
        have = left.setdefault(lane, 180)
        want[k] = size <= have
        left[lane] = have - size * want[k]
    table = spark.createDataFrame(rows, "lane string, k long, size long").repartition(5)
    assert {r["k"]: r["admitted"] for r in lg.byte_cap(table, "k", "size", 180, "lane").collect()} == want
    assert lg.byte_cap(table.limit(0), "k", "size", 180, "lane").count() == 0
    assert not any(r["admitted"] for r in lg.byte_cap(table.filter("size > 20"), "k", "size", 20).collect())


def test_revocations(spark, book):
    class Flaky(sinks.MemorySink):
        def push_revocation(self, *row):
            if row[0] == "b":
                raise OSError
            super().push_revocation(*row)

    for k, i in enumerate("abc"):
        book.revoke(i, None, f"2026-0{k + 1}")
    with pytest.raises(OSError):
        book.sync_revocations(Flaky(), lambda: "now")
    assert [r["episode_id"] for r in lg.pending_revocations(book.read("revocations")).collect()] == ["b", "c"]
    book.revoke("a", "again", "2027")
    row = book.read("revocations").filter("episode_id = 'a'").first()
    assert (row["pushed_at"], row["push_status"], row["reason"]) == ("now", "pending", "again")
    assert book.sync_revocations(sinks.MemorySink(), lambda: "later") == 3
    assert [r["episode_id"] for r in book.revoked_ids().collect()] == ["a", "b", "c"]


def test_upserts_keep_what_was_first_recorded(spark):
    schema = lg.SCHEMAS["episodes"]
    old = spark.createDataFrame([("a", "h1", "s", "x", "k1", "1", "1", "v", "l")], schema)
    new = spark.createDataFrame([("a", "h2", "t", "y", "k2", "2", "2", "w", "m"), ("b", "h", "s", "x", "k", "1", "1", "v", "l")], schema)
    rows = {r["id"]: r for r in lg.upsert_episodes(old, new).collect()}
    assert (rows["a"]["content_hash"], rows["a"]["r2_object_key"], rows["b"]["content_hash"]) == ("h1", "k2", "h")


def test_ledger_point_reads(spark, book):
    assert book.cursor("s") is None and book.fingerprint("p") is None
    book.set_cursor("s", "{}", "1")
    book.set_cursor("s", '{"a":1}', "2")
    assert book.cursor("s") == '{"a":1}'
    book.put("files", path="p", fingerprint="f", last_seen_ts="1")
    assert book.fingerprint("p") == "f"
    book.insert_uploads(spark.createDataFrame([("d", "h", "s", None, None, None, "1")], lg.SCHEMAS["uploads"]))
    book.insert_uploads(spark.createDataFrame([("d", "h2", "s", None, None, None, "2")], lg.SCHEMAS["uploads"]))
    assert [r["content_hash"] for r in book.read("uploads").collect()] == ["h"]
    book.record_snapshot("v", "1", 2, 3, "m")
    book.mark_snapshot_published("v", "2")
    assert book.read("snapshots").first()["published_at"] == "2"


def test_unreadable_cursors_count_as_empty(spark):
    files = spark.createDataFrame([("p", 1, None)], "path string, length long, modified timestamp")
    for cursor in (None, "", "{bad", "[]", '{"files": {"p": {}}}'):
        assert jobs.changed_files(files, cursor, "jsonl").count() == 1


def test_scan_sanitize_publish(spark, home, book, tmp_path):
    out = str(tmp_path / "steps")
    assert jobs.scan(spark, str(home / "logs"), out)["produced_events"] == 4
    done = jobs.sanitize(spark, f"{out}/canonical_events", out)
    assert done["report"]["email_redactions"] == 1 and done["report"]["sample_redacted"] == ["mail [REDACTED_EMAIL]"]
    sink = sinks.DirectorySink(tmp_path / "box")
    result = jobs.publish(spark, f"{out}/sanitized_events", book, sink, "team", dry_run=False, confirmed=True)
    assert result.uploaded_docs == 3
    written = [json.loads(p.read_text()) for p in (tmp_path / "box" / "episodes").iterdir()]
    assert {w["source_tool"] for w in written} == {"team:manual_scan"}
    (tmp_path / "records.jsonl").write_text("".join(json.dumps(w | {"id": w["id"][:-1] + "x"}) + "\n" for w in written) + '{"kind":"not an episode"}\n')
    assert jobs.publish(spark, str(tmp_path / "records.jsonl"), book).would_upload_docs == 3


def test_stream_restarts_where_it_stopped(spark, home, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "ck")
    go = lambda: incremental.start(spark, str(home / "logs"), out, checkpoint, "logs", "jsonl", files_per_batch=1).awaitTermination()
    go()
    assert incremental.written(spark, out).count() == 3
    (home / "logs" / "three.jsonl").write_text(line("user_msg", "third", 9))
    (home / "logs" / "two-copy.jsonl").write_text(line("user_msg", "third", 9))
    go()
    rows = incremental.written(spark, out).collect()
    assert len(rows) == len({r["id"] for r in rows}) == 5


def test_command_line(spark, home, monkeypatch, capsys):
    monkeypatch.setenv("EPISODICA_HOME", str(home / "state"))
    go = lambda *argv: cli.main(list(argv), spark)
    go("sources", "add", "--name", "logs", "--root", "~/logs", "--glob", "**/*.jsonl", "--format", "jsonl")
    go("sources", "detect")
    go("consent", "init", "--license", "CC0-1.0")
    go("run", "--dry-run", "--source", "logs", "--explain-size")
    go("run", "--review", "--yes", "--source", "logs")
    go("revoke", "add", "--episode-id", "e")
    go("revoke", "sync")
    go("status")
    go("scan", "--in", str(home / "logs"), "--out", str(home / "s"))
    go("sanitize", "--in", str(home / "s" / "canonical_events"), "--out", str(home / "s"))
    go("publish", "--in", str(home / "s" / "sanitized_events"), "--dry-run")
    lines = [json.dumps(json.loads(p.read_text())) for p in (home / "state" / "outbox" / "episodes").iterdir()]
    (home / "eps.jsonl").write_text("\n".join(lines))
    go("snapshot", "build", "--version", "1", "--in", str(home / "eps.jsonl"), "--out", str(home / "rel"))
    go("snapshot", "build", "--version", "1", "--in", str(home / "eps.jsonl"), "--tables", str(home / "tables"))
    assert spark.read.parquet(str(home / "tables" / "episodes")).count() == spark.read.parquet(str(home / "tables" / "sft")).count() == 3
    go("snapshot", "publish", "--version", "1", "--from", str(home / "rel"), "--yes")
    go("reset", "--all", "--yes")
    said = capsys.readouterr().out
    for part in ("logs format=jsonl", "uploaded_docs=3", "would_upload_bytes=", "pushed=1", "logs => 3 episodes", "produced_events=4", "train_count=", "indexed=True", "reset all"):
        assert part in said, part
    with pytest.raises(PermissionError):
        go("reset", "--all")


def test_config_layers(tmp_path):
    (tmp_path / "config.toml").write_text('upload_mode = "auto"\nallowlist_mode = true\n')
    found = config.load(env={"EPISODICA_HOME": str(tmp_path), "EPISODICA_ALLOWLIST_MODE": "0", "EPISODICA_SOURCES_PATH": "/x"})
    assert found.upload_mode == "auto" and not found.allowlist_mode and str(found.sources_path) == "/x"


def test_update_notice(monkeypatch):
    assert "0.10.0" in cli.update_notice("0.9.10", lambda: "v0.10.0")
    assert cli.update_notice("0.10.0", lambda: "v0.10.0-rc1") is None and cli.update_notice("0.1.0", lambda: "x") is None

    def offline():
        raise OSError

    assert cli.update_notice("0.1.0", offline) is None
    monkeypatch.setenv("EPISODICA_DISABLE_UPDATE_CHECK", "1")
    assert cli.update_notice("0.1.0", lambda: "v9.0.0") is None


def test_input_files(spark, home):
    found = readers.input_files(spark, [str(home / "logs"), str(home / "logs" / "*.jsonl")]).collect()
    assert [r["path"].rsplit("/", 1)[1] for r in found] == ["one.jsonl", "two.jsonl"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.input_files(spark, str(home / "missing")).collect()


def test_repeated_keys_in_one_batch(spark):
    """As single statements one after another: the first insert stays, and the last update."""
    old = spark.createDataFrame([("a", 1, 1)], "k string, kept long, moved long")
    new = spark.createDataFrame([("a", 2, 2), ("a", 3, 3), ("b", 5, 5), ("b", 4, 4), (None, 6, 6), (None, 6, 6)], "k string, kept long, moved long")
    rows = lambda df: sorted(df.collect(), key=str)
    assert rows(lg.merge(old, new, "k", ["moved"], ["kept"])) == [("a", 1, 3), ("b", 4, 5), (None, 6, 6), (None, 6, 6)]
    assert rows(lg.merge(old, new, "k")) == [("a", 3, 3), ("b", 5, 5), (None, 6, 6), (None, 6, 6)]
    assert rows(lg.insert_or_ignore(old, new, "k", ["kept"])) == [("a", 1, 1), ("b", 4, 4), (None, 6, 6), (None, 6, 6)]


def test_runs_index_what_they_upload(spark, home, book):
    sink = sinks.DirectorySink(home / "box")
    done = jobs.run(spark, [SOURCE], book, "salt", sink, dry_run=False, confirmed=True)
    ids = {p.stem for p in (home / "box" / "episodes").iterdir()}
    vectors = [json.loads(p.read_text()) for p in (home / "box" / "index").iterdir()]
    assert done.uploaded_docs == 3 == len(ids) and {v["id"] for v in vectors} == ids
    assert all(v["metadata"]["pointer"]["object_key"] == f"episodes/{v['id']}.json" and len(v["metadata"]["source_tool"]) == 64 for v in vectors)
    rows = book.read("episodes").collect()
    assert {r["r2_object_key"] for r in rows} == {f"episodes/{i}.json" for i in ids} and all(r["session_id_hash"] for r in rows)


def test_events_of_all_files_are_one_session(spark):
    rows = [(f"f{k // 40}", k % 40, "user_msg" if k % 13 == 0 else "assistant_msg", f"t{k}", f"s{k}") for k in range(400)]
    events = spark.createDataFrame(rows, "path string, seq long, kind string, text string, session_id string").repartition(5)
    from pyspark.sql import Window as W

    from episodica.operators import episodes

    got = jobs.one_session(events, "all")
    place = F.row_number().over(W.orderBy("path", "seq")).cast("bigint")
    first = events.orderBy("path", "seq").first()["session_id"]
    want = episodes.with_windows(events.withColumns({"seq": place, "path": F.lit("all"), "session_id": F.lit(first)}))
    key = ["path", "seq", "kind", "text", "session_id", "turn", "part"]
    assert sorted(episodes.with_parts(got).select(key).collect()) == sorted(want.select(key).collect())


def test_service_settings(tmp_path):
    env = {"EPISODICA_HOME": str(tmp_path), "EPISODICA_WORKER_URL": "https://w", "EPISODICA_INDEX_URL": "https://i", "EPISODICA_UPLOAD_MODE": "auto", "EPISODICA_REGISTRY_ENABLED": "1", "EPISODICA_REGISTRY_URL": "https://r/x.toml", "EPISODICA_UPDATE_URL": "https://u"}
    conf = config.load(env=env)
    sink = cli._sink(None, conf)
    assert isinstance(sink, sinks.HttpSink) and (sink.mode, sink.index) == ("auto", "https://i") and isinstance(cli._sink(tmp_path, conf), sinks.DirectorySink)
    manifest = rg.format_manifest([rg.Source("far", ("~/logs",), ("*.jsonl",), "jsonl")])
    remote = cli._remote(conf, lambda *a: (200, manifest, {"etag": "t"}))
    assert [s.id for s in remote.load()] == ["far"]
    assert cli._latest(conf, lambda *a: (200, '{"tag_name": "v9.9.9"}', {})) == "v9.9.9"
    with pytest.raises(OSError):
        cli._latest(conf, lambda *a: (500, "", {}))
    (tmp_path / "policy.toml").write_text('rules = "strict"\n')
    assert cli._pack(conf) == "default" and cli._pack(config.load(env=env | {"EPISODICA_POLICY_PATH": str(tmp_path / "policy.toml")})) == "strict"
    with pytest.raises(ValueError):
        cli._remote(config.load(env=env | {"EPISODICA_REGISTRY_URL": "http://r"}))

"""Source registry, discovery, transport policy."""

import json
import re

import pytest

from episodica.sources import registry as rg
from episodica.sources import sinks


@pytest.fixture
def home(tmp_path, monkeypatch):
    monkeypatch.setenv("HOME", str(tmp_path))
    return tmp_path


def source(**more):
    return rg.Source(**({"id": "s", "roots": ("~/logs",), "globs": ("**/*.jsonl",), "format": "jsonl"} | more))


@pytest.mark.parametrize("more", [{"id": "a b"}, {"id": ""}, {"roots": ()}, {"globs": ()}, {"format": "csv"}, {"roots": ("/etc",)}, {"roots": ("~/../x",)}, {"globs": ("../*",)}, {"globs": ("[a",)}, {"globs": ("a**",)}])
def test_unsafe_sources(home, more):
    with pytest.raises(ValueError):
        rg.validate(source(**more))


def test_builtin_sources_are_safe(home):
    for s in rg.BUILTIN:
        rg.validate(s)


@pytest.mark.parametrize(
    ("glob", "path", "matches"),
    [("**/*.jsonl", "a.jsonl", True), ("**/*.jsonl", "x/y/a.jsonl", True), ("*.jsonl", "x/a.jsonl", True), ("a?c", "abc", True), ("[!a]b", "ab", False), ("**/sessions/*.jsonl", "p/sessions/a.jsonl", True), ("x/**", "x/a/b", True), ("a.b", "aXb", False)],
)
def test_globs(glob, path, matches):
    assert bool(re.search(rg.glob_regex(glob), path)) is matches


def test_discovery(spark, home):
    logs = home / "logs" / "deep"
    logs.mkdir(parents=True)
    for name, size in (("b.jsonl", 5), ("a.jsonl", 5), ("c.txt", 5), ("big.jsonl", 50)):
        (logs / name).write_text("x" * size)
    found = [r["path"].rsplit("/", 1)[1] for r in rg.discover(spark, source(), max_bytes=20).collect()]
    assert found == ["a.jsonl", "b.jsonl"]
    assert rg.discover(spark, source(), max_files=1).count() == 1
    assert rg.discover(spark, source(roots=("~/nowhere",))).count() == 0


def test_local_sources(home):
    path = home / "sources.toml"
    for s in (source(id="z"), source(id="a"), source(id="z", format="json")):
        rg.add_local(path, s)
    assert [(s.id, s.format) for s in rg.load_local(path)] == [("a", "jsonl"), ("z", "json")]
    assert path.stat().st_mode & 0o777 == 0o600
    path.write_text(rg.format_manifest([source(), source()]))
    with pytest.raises(ValueError, match="duplicate"):
        rg.load_local(path)
    with pytest.raises(ValueError):
        rg.parse_manifest("version = 2\n" + rg.format_manifest([source()]).split("\n", 1)[1])
    with pytest.raises(ValueError):
        rg.parse_manifest("version = 1")


def test_layers_override_by_id(home):
    merged = rg.merge_sources([source(id="a"), source(id="b")], [source(id="a", format="json")])
    assert [(s.id, s.format) for s in merged] == [("b", "jsonl"), ("a", "json")]
    (home / "s.toml").write_text(rg.format_manifest([source(id="codex_cli", format="mixed")]))
    found, warnings = rg.resolve(home / "s.toml")
    assert found[-1].format == "mixed" and len(found) == 4 and not warnings
    assert [s.id for s in rg.select(found, ["codex_cli"])] == ["codex_cli"] and rg.select(found, []) == found


def test_remote_registry_cache(home):
    answers = [(200, "tag", rg.format_manifest([source(id="r")])), (304, None, ""), (500, None, "")]
    asked, clock = [], [0.0]

    def fetch(etag):
        asked.append(etag)
        return answers[len(asked) - 1]

    remote = rg.RemoteRegistry(fetch, home / "cache.json", lambda: clock[0], ttl_hours=0)
    assert [s.id for s in remote.load()] == ["r"]
    assert remote.load() and len(asked) == 1  # fresh for an hour at least
    clock[0] = 3601
    assert remote.load() and remote.load()
    assert asked == [None, "tag", "tag"]
    failing = rg.RemoteRegistry(lambda etag: (500, None, ""), home / "other.json", lambda: 0.0)
    assert rg.resolve(None, failing)[1]


def test_retries():
    answers = iter([(500, ""), OSError(), (200, "ok")])
    waits = []

    def send():
        a = next(answers)
        if isinstance(a, OSError):
            raise a
        return a

    assert sinks.with_retries(send, sleep=waits.append, jitter=lambda: 0.05) == "ok"
    assert waits == [0.25, 0.45]
    calls = []
    with pytest.raises(sinks.HttpError):
        sinks.with_retries(lambda: (calls.append(1), (400, ""))[1], sleep=waits.append)
    assert len(calls) == 1
    with pytest.raises(sinks.HttpError):
        sinks.with_retries(lambda: (calls.append(1), (503, ""))[1], sleep=lambda s: None)
    assert len(calls) == 6


def test_upload_modes():
    def missing():
        raise sinks.HttpError(404)

    def broken():
        raise sinks.HttpError(400)

    assert sinks.upload(lambda: "old", missing) == "old"
    assert sinks.upload(lambda: "old", lambda: "new") == "new"
    assert sinks.upload(lambda: "old", lambda: "new", "legacy") == "old"
    for way, mode in ((broken, "auto"), (missing, "presigned")):
        with pytest.raises(sinks.HttpError):
            sinks.upload(lambda: "old", way, mode)


def test_secure_urls():
    sinks.ensure_secure("https://a.b")
    sinks.ensure_secure("http://a.b", allow_http=True)
    with pytest.raises(ValueError):
        sinks.ensure_secure("http://a.b")


class Service:
    """A transport that answers like the service and remembers what was asked."""

    def __init__(self, missing=(), key="k"):
        self.asked, self.missing, self.key = [], missing, key

    def __call__(self, method, url, headers, body, timeout):
        self.asked.append((method, url, headers, body, timeout))
        path = url.removeprefix("https://w")
        if path in self.missing:
            return 404, "", {}
        if path == "/v1/episodes/presign":
            return 200, '{"upload_url": "https://store/x", "object_key": "p"}', {}
        return 200, json.dumps({"object_key": self.key, "object_prefix": "snap"}), {}


def test_http_sink():
    body = json.dumps({"content_hash": "h"})
    service = Service()
    sink = sinks.HttpSink("https://w/", "tok", index="https://i", index_token="it", timeout=1, transport=service)
    assert sink.upload("e", body) == "k"
    method, url, headers, sent, timeout = service.asked[-1]
    assert (method, url, headers["Authorization"], sent, timeout) == ("POST", "https://w/v1/episodes", "Bearer tok", body.encode(), 5)
    sink.push_revocation("e", None, "2026")
    assert json.loads(service.asked[-1][3]) == {"episode_id": "e", "revoked_at": "2026", "reason": None}
    assert sink.publish_snapshot("1", {"total_records": 2}, "c", [], "card") == "snap"
    sink.index_snapshot("1", {"total_records": 2}, "snap")
    vector = json.loads(service.asked[-1][3])["vectors"][0]
    assert service.asked[-1][1] == "https://i/upsert-data" and vector["id"] == "snapshot:1" and vector["metadata"]["pointer"]["object_key"] == "snap"


def test_http_sink_modes():
    body = json.dumps({"content_hash": "h"})
    for mode, missing, paths in (("presigned", (), ["/v1/episodes/presign", "https://store/x", "/v1/episodes/complete"]), ("auto", ("/v1/episodes/presign",), ["/v1/episodes/presign", "/v1/episodes"])):
        service = Service(missing)
        assert sinks.HttpSink("https://w", mode=mode, transport=service).upload("e", body) == "k"
        assert [url.removeprefix("https://w") for _, url, *_ in service.asked] == paths
    with pytest.raises(sinks.HttpError):
        sinks.HttpSink("https://w", mode="presigned", transport=Service(("/v1/episodes/presign",))).upload("e", body)
    with pytest.raises(ValueError):
        sinks.HttpSink("http://w")
    with pytest.raises(ValueError):
        sinks.HttpSink("https://w", transport=Service()).index_vectors([])


def test_pointer_of_an_episode():
    pointer = json.dumps({"prompt": "p", "source_tool": "s", "session_id": "x", "license": "CC0-1.0", "consent": {"consent_version": "v", "public_searchable": True, "trainable": True}, "meta": {"tool_names": ["t"], "error_types": ["error"]}})
    got = sinks.pointer_of("e", pointer, "key", "salt")
    assert got["id"] == "e" and got["data"] == "p" and got["metadata"]["pointer"] == {"storage": "r2", "object_key": "key", "snapshot_version": None}
    from episodica.functions.blake3 import digests

    assert [got["metadata"]["source_tool"], got["metadata"]["session_id"], *got["metadata"]["tool_names"]] == digests([b"salt|s", b"salt|x", b"salt|t"])

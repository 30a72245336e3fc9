"""Source definitions: built-in, remote and local registries, validation, and file discovery."""

from __future__ import annotations

import json
import os
import re
import tomllib
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Limits of discovery.
MAX_FILES = 5000
MAX_FILE_BYTES = 20 * 1024 * 1024
FORMATS = ("jsonl", "json", "mixed")


@dataclass(frozen=True)
class Source:
    id: str
    roots: tuple[str, ...]
    globs: tuple[str, ...]
    format: str
    display_name: str | None = None
    parser_hint: str | None = None
    platforms: tuple[str, ...] | None = None
    requires_opt_in: bool | None = None


# The built-in sources.
BUILTIN = (
    Source("codex_cli", ("~/.codex/sessions",), ("**/*",), "jsonl", "Codex CLI", "codex_cli_v1", None, False),
    Source("claude_code", ("~/.claude/projects",), ("**/sessions/*.jsonl",), "jsonl", "Claude Code", "claude_code_v1", None, False),
    Source(
        "vscode_global_storage",
        ("~/.config/Code/User/globalStorage", "~/Library/Application Support/Code/User/globalStorage", "~/AppData/Roaming/Code/User/globalStorage"),
        ("**/*.jsonl", "**/*.json"), "jsonl", "VS Code Global Storage", "vscode_storage_v1", None, False,
    ),
    Source(
        "tandem_sessions",
        ("~/.local/share/tandem/data/storage", "~/Library/Application Support/tandem/data/storage", "~/AppData/Roaming/tandem/data/storage"),
        ("**/sessions.json",), "json", "Tandem Sessions", "tandem_v1", ("linux", "macos", "windows"), True,
    ),
)


def expand(path: str) -> str:
    home = os.environ.get("HOME") or os.environ.get("USERPROFILE")
    return home + path[1:] if home and (path == "~" or path[:2] in {"~/", "~\\"}) else path


def allowed_roots() -> list[str]:
    home = os.environ.get("HOME") or os.environ.get("USERPROFILE")
    return [p for p in (home, os.environ.get("APPDATA"), os.environ.get("LOCALAPPDATA")) if p]


def is_allowed(path: str) -> bool:
    """Whether path is one of the allowed roots or below it, component by component."""
    return any(Path(path).is_relative_to(root) for root in allowed_roots())


def glob_regex(glob: str) -> str:
    """The glob as a regular expression on a relative path: ** stands for whole folders, * and ? also match a slash."""
    out, i = "", 0
    while i < len(glob):
        c = glob[i]
        if c == "*":
            run = len(glob) - len(glob[i:].lstrip("*")) - i
            if run > 2:
                raise ValueError(f"invalid glob pattern: {glob}")
            if run == 2:
                if (i and glob[i - 1] != "/") or glob[i + 2 : i + 3] not in {"", "/"}:
                    raise ValueError(f"invalid glob pattern: {glob}")
                out += "(?:.*/)?" if glob[i + 2 : i + 3] else ".*"
                i += 3
                continue
            out += ".*"
        elif c == "?":
            out += "."
        elif c == "[":
            end = glob.find("]", i + 3 if glob[i + 1 : i + 2] == "!" else i + 2)
            if end < 0:
                raise ValueError(f"invalid glob pattern: {glob}")
            body = glob[i + 1 : end]
            negated = body.startswith("!")
            out += "[" + "^" * negated + re.sub(r"([\\\[\]^&])", r"\\\1", body[negated:]) + "]"
            i = end
        else:
            out += re.escape(c)
        i += 1
    return f"(?s)^{out}$"


def validate(source: Source) -> None:
    """ValueError unless the id, roots, globs and format are safe."""
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", source.id):
        raise ValueError("source id is empty or contains invalid characters")
    if not source.roots or not source.globs:
        raise ValueError("source must declare at least one root and one glob")
    if source.format not in FORMATS:
        raise ValueError(f"source format must be one of: {', '.join(FORMATS)}")
    for root in map(expand, source.roots):
        if ".." in Path(root).parts:
            raise ValueError("root has path traversal segments")
        if not is_allowed(root):
            raise ValueError(f"root is outside allowlisted user locations: {root}")
    for glob in source.globs:
        glob_regex(glob)
        if ".." in glob:
            raise ValueError("glob cannot include parent traversal")


def validate_manifest(version: int | None, sources: list[Source]) -> None:
    if not sources:
        raise ValueError("manifest must contain at least one source")
    if version not in {None, 1}:
        raise ValueError(f"unsupported manifest version: {version} (expected 1)")
    for source in sources:
        validate(source)
    ids = [s.id for s in sources]
    repeated = sorted({i for i in ids if ids.count(i) > 1})
    if repeated:
        raise ValueError(f"duplicate source ids in manifest: {', '.join(repeated)}")


def parse_manifest(text: str) -> list[Source]:
    data = tomllib.loads(text)
    listed = lambda v: None if v is None else tuple(v)
    sources = [Source(**(s | {k: listed(s.get(k)) for k in ("roots", "globs", "platforms")})) for s in data.get("sources", [])]
    validate_manifest(data.get("version"), sources)
    return sources


def format_manifest(sources: list[Source]) -> str:
    lines = ["version = 1"]
    for s in sources:
        shown = {k: v for k, v in asdict(s).items() if v is not None}
        lines += ["", "[[sources]]", *(f"{k} = {json.dumps(list(v) if isinstance(v, tuple) else v, ensure_ascii=False)}" for k, v in shown.items())]
    return "\n".join(lines) + "\n"


def write_private(path: str | Path, data: str) -> None:
    """Write to a file beside it, readable by the owner alone, then rename."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    other = path.with_name(f".{path.name}.{os.getpid()}.tmp")
    with os.fdopen(os.open(other, os.O_WRONLY | os.O_CREAT | os.O_TRUNC, 0o600), "w") as out:
        out.write(data)
    os.replace(other, path)


def load_local(path: str | Path) -> list[Source]:
    path = Path(path)
    return parse_manifest(path.read_text()) if path.exists() else []


def add_local(path: str | Path, source: Source) -> None:
    """Insert or replace by id; the file is kept in order of ids."""
    validate(source)
    others = [s for s in load_local(path) if s.id != source.id]
    write_private(path, format_manifest(sorted([*others, source], key=lambda s: s.id)))


@dataclass
class RemoteRegistry:
    """A registry behind fetch(etag) -> (status, etag, text), cached in a file for ttl_hours (one at least).

    A fresh cache is used as it is; a stale one is sent with its tag, and still serves if the answer is 304 or an error status.
    """

    fetch: Callable[[str | None], tuple[int, str | None, str]]
    cache: Path
    now: Callable[[], float]
    ttl_hours: int = 24
    cached: dict | None = field(default=None, init=False)

    def load(self) -> list[Source]:
        try:
            self.cached = json.loads(self.cache.read_text())
        except (OSError, ValueError):
            self.cached = None
        if self.cached and self.now() - self.cached["fetched_at"] < max(self.ttl_hours, 1) * 3600:
            return parse_manifest(self.cached["manifest"])
        status, etag, text = self.fetch(self.cached and self.cached.get("etag"))
        if not 200 <= status < 300:
            if self.cached:
                return parse_manifest(self.cached["manifest"])
            raise OSError(f"remote registry fetch failed: {status}")
        found = parse_manifest(text)
        write_private(self.cache, json.dumps({"fetched_at": self.now(), "etag": etag, "manifest": text}))
        return found


def merge_sources(*layers: list[Source]) -> list[Source]:
    """The last definition of each id, in its last place."""
    last = {s.id: k for k, s in enumerate(s for layer in layers for s in layer)}
    return [s for k, s in enumerate(s for layer in layers for s in layer) if last[s.id] == k]


def override(definitions: DataFrame, position: str = "position") -> DataFrame:
    """The same on a table of definitions (id, position, ...)."""
    newest = F.row_number().over(W.partitionBy("id").orderBy(F.desc(position)))
    return definitions.withColumn("__newest", newest).filter("__newest = 1").drop("__newest").orderBy(position)


def resolve(local: str | Path | None = None, remote: RemoteRegistry | None = None) -> tuple[list[Source], list[str]]:
    """Valid sources of all layers, and warnings about the others. A remote registry that fails is left out."""
    far: list[Source] = []
    warnings = []
    if remote is not None:
        try:
            far = remote.load()
        except (OSError, ValueError) as problem:
            warnings.append(f"remote registry left out: {problem}")
    valid = []
    for source in merge_sources(list(BUILTIN), far, load_local(local) if local else []):
        try:
            validate(source)
            valid.append(source)
        except ValueError as problem:
            warnings.append(f"skipping unsafe source {source.id}: {problem}")
    return valid, warnings


def select(sources: list[Source], ids: list[str]) -> list[Source]:
    return [s for s in sources if not ids or s.id in ids]


FILES = "path string, length bigint, modified timestamp"


def discover(spark: SparkSession, source: Source, max_files: int = MAX_FILES, max_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """path, length, modified of a source's files: in allowed, existing roots, matching a glob, not too large; the first
    max_files by path (the cap applies in order of path, so that the choice can be repeated)."""
    validate(source)
    found = None
    for root in map(expand, source.roots):
        if not Path(root).is_dir():
            continue
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"file://{root}").select("path", "length", F.col("modificationTime").alias("modified"))
        relative = F.regexp_replace("path", f"^file:/*{re.escape(root.strip('/'))}/", "")
        matching = F.lit(False)
        for glob in source.globs:
            matching = matching | relative.rlike(glob_regex(glob))
        part = listed.filter(matching & (F.col("length") <= max_bytes))
        found = part if found is None else found.union(part)
    if found is None:
        return spark.createDataFrame([], FILES)
    return found.distinct().orderBy("path").limit(max_files)

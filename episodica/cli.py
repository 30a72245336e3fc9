"""python -m episodica.cli: run, sources, consent, revoke, snapshot, scan, sanitize, publish, status, reset."""

from __future__ import annotations

import argparse
import json
import os
import sys
import time
import tomllib
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import SparkSession

from episodica import config as settings
from episodica.operators import ledger as lg
from episodica.operators import redact, snapshot
from episodica.plans import jobs
from episodica.sources import readers, registry, sinks

VERSION = "0.2.0"
SPLIT_SEED = "episodica-split-v1"


def show_bytes(n: int) -> str:
    for power, unit in ((3, "GiB"), (2, "MiB"), (1, "KiB")):
        if n >= 1024**power:
            return f"{n / 1024**power:.2f} {unit}"
    return f"{n} B"


def version(text: str) -> tuple[int, int, int]:
    """Three numbers of v1.2.3-more; parts that are missing or no numbers are 0."""
    parts = [int(p) if p.isdigit() else 0 for p in text.lstrip("v").split("-")[0].split(".")]
    return tuple([*parts, 0, 0, 0][:3])


def update_notice(current: str, latest: Callable[[], str]) -> str | None:
    """What to say if latest() names a newer release; nothing where updates aren't to be looked for or can't be."""
    if os.environ.get("EPISODICA_DISABLE_UPDATE_CHECK") in {"1", "true", "TRUE", "yes"}:
        return None
    try:
        found = latest()
    except OSError:
        return None
    return f"update available: {found.lstrip('v')} (current {current})" if version(found) > version(current) else None


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="episodica", description=__doc__)
    top.add_argument("--config")
    commands = top.add_subparsers(dest="command", required=True)

    run = commands.add_parser("run")
    run.add_argument("--source", action="append", default=[])
    run.add_argument("--since", help="accepted and ignored: runs are incremental by the ledger")
    for flag in ("--dry-run", "--review", "--yes", "--include-raw", "--show-payload", "--explain-size"):
        run.add_argument(flag, action="store_true")
    run.add_argument("--preview-limit", type=int, default=10)
    run.add_argument("--export-payload", type=Path)
    run.add_argument("--export-limit", type=int)
    run.add_argument("--max-upload-bytes", type=int)
    run.add_argument("--to", type=Path, help="folder that receives episodes")

    sources = commands.add_parser("sources").add_subparsers(dest="action", required=True)
    for name in ("detect", "list", "update"):
        sources.add_parser(name)
    add = sources.add_parser("add")
    for flag in ("--name", "--root", "--glob", "--format"):
        add.add_argument(flag, required=True)
    add.add_argument("--parser")

    consent = commands.add_parser("consent").add_subparsers(dest="action", required=True)
    init = consent.add_parser("init")
    init.add_argument("--license", required=True)
    init.add_argument("--consent-version", default="2026-02-25")
    consent.add_parser("status")

    revoke = commands.add_parser("revoke").add_subparsers(dest="action", required=True)
    added = revoke.add_parser("add")
    added.add_argument("--episode-id", required=True)
    added.add_argument("--reason")
    revoke.add_parser("sync").add_argument("--to", type=Path)

    snap = commands.add_parser("snapshot").add_subparsers(dest="action", required=True)
    build = snap.add_parser("build")
    build.add_argument("--version", required=True)
    build.add_argument("--in", dest="input", required=True)
    build.add_argument("--out", default=".")
    build.add_argument("--split-seed", default=SPLIT_SEED)
    build.add_argument("--tables", help="write the release as distributed tables to this folder instead, without files through the driver")
    release = snap.add_parser("publish")
    release.add_argument("--version", required=True)
    release.add_argument("--from", dest="origin", default=".")
    release.add_argument("--to", type=Path)
    for flag in ("--dry-run", "--yes"):
        release.add_argument(flag, action="store_true")

    for name in ("scan", "sanitize"):
        step = commands.add_parser(name)
        step.add_argument("--in", dest="input", required=True)
        step.add_argument("--out", required=True)
        if name == "sanitize":
            step.add_argument("--policy", choices=("default", "strict"), default="default")
    publish = commands.add_parser("publish")
    publish.add_argument("--in", dest="input", required=True)
    publish.add_argument("--namespace")
    for flag in ("--dry-run", "--review", "--yes", "--include-raw"):
        publish.add_argument(flag, action="store_true")
    publish.add_argument("--max-upload-bytes", type=int)
    publish.add_argument("--to", type=Path)

    commands.add_parser("status")
    reset = commands.add_parser("reset")
    reset.add_argument("--source")
    for flag in ("--all", "--yes"):
        reset.add_argument(flag, action="store_true")
    return top


def _sink(to: Path | None, conf: settings.Config):
    """The service of the settings; a folder, where one is given or no service is set."""
    if to or not conf.worker_url:
        return sinks.DirectorySink(to or conf.home / "outbox")
    return sinks.HttpSink(conf.worker_url, conf.worker_token, conf.upload_mode, conf.index_url, conf.index_token, conf.timeout_seconds, conf.allow_insecure_http)


def _remote(conf: settings.Config, transport=sinks.http) -> registry.RemoteRegistry | None:
    """The remote registry, if the settings ask for one."""
    if not conf.registry_enabled or not conf.registry_url:
        return None
    sinks.ensure_secure(conf.registry_url, conf.allow_insecure_http)

    def fetch(etag: str | None) -> tuple[int, str | None, str]:
        status, text, headers = transport("GET", conf.registry_url, {"If-None-Match": etag} if etag else {}, None, conf.timeout_seconds)
        return status, headers.get("etag"), text

    return registry.RemoteRegistry(fetch, conf.home / "registry-cache.json", time.time, conf.registry_ttl_hours)


def _latest(conf: settings.Config, transport=sinks.http) -> str:
    """The name of the latest release at the settings' address (JSON with tag_name)."""
    status, text, _ = transport("GET", conf.update_url, {"User-Agent": "episodica"}, None, 2)
    if status != 200:
        raise OSError(f"status={status}")
    return json.loads(text)["tag_name"]


def _pack(conf: settings.Config) -> str:
    """The rule pack of the settings' policy file (TOML, rules = "default" or "strict")."""
    return tomllib.loads(conf.policy_path.read_text()).get("rules", "default") if conf.policy_path else "default"


def _print(values: dict) -> None:
    for key, value in values.items():
        print(f"{key}={value} ({show_bytes(value)})" if key.endswith("_bytes") else f"{key}={value}")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    conf = settings.load(args.config)
    sources_file = conf.sources_path or conf.home / "sources.toml"
    if conf.update_url and (notice := update_notice(VERSION, lambda: _latest(conf))):
        print(notice, file=sys.stderr)
    if args.command == "sources":
        return _sources(args, sources_file, _remote(conf))
    spark = spark or SparkSession.builder.appName("episodica").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    book = lg.Ledger(spark, conf.ledger)
    raw = getattr(args, "include_raw", False) or not conf.allowlist_mode
    if args.command == "run":
        found, warnings = registry.resolve(sources_file, _remote(conf))
        for warning in warnings:
            print(warning, file=sys.stderr)
        result = jobs.run(spark, registry.select(found, args.source), book, jobs.load_salt(conf.home / "anonymization_salt"), _sink(args.to, conf), args.dry_run, args.yes and args.review, raw, args.max_upload_bytes, args.preview_limit if args.dry_run or args.show_payload else 0, args.export_payload, args.export_limit, pack=_pack(conf), scanner=redact.find_scanner())
        shown = vars(result) | {}
        previews, stats = shown.pop("payload_preview"), shown.pop("source_stats")
        _print(shown)
        for row in stats if args.explain_size else []:
            print(json.dumps(row, sort_keys=True))
        for episode in previews:
            print(json.dumps(episode, sort_keys=True, ensure_ascii=False))
    elif args.command == "consent":
        if args.action == "init":
            book.init_consent(args.license, args.consent_version, jobs.utc_now())
        state = book.consent()
        print("consent=missing" if state is None else f"consent=initialized license={state['license']} version={state['consent_version']}")
    elif args.command == "revoke":
        if args.action == "add":
            book.revoke(args.episode_id, args.reason, jobs.utc_now())
            print(f"revoked={args.episode_id}")
        else:
            print(f"pushed={book.sync_revocations(_sink(args.to, conf), jobs.utc_now)}")
    elif args.command == "snapshot":
        if args.action == "build":
            if args.tables:
                snapshot.write_tables(readers.read_episodes(spark, args.input), args.tables, args.split_seed, book.revoked_ids())
                _print({"version": args.version, "tables": args.tables})
                return 0
            made = snapshot.build_snapshot(readers.read_episodes(spark, args.input), args.version, args.out, args.split_seed, book.revoked_ids())
            book.record_snapshot(args.version, jobs.utc_now(), made.train_count, made.val_count, made.manifest_hash)
            _print({"version": made.version, "train_count": made.train_count, "val_count": made.val_count, "out_dir": made.out_dir})
        else:
            if not args.dry_run and not args.yes:
                raise PermissionError("snapshot publish requires --yes (or use --dry-run)")
            _print({k: v for k, v in snapshot.publish_snapshot(args.version, args.origin, _sink(args.to, conf), args.dry_run).items() if k != "files"})
            if not args.dry_run:
                book.mark_snapshot_published(args.version, jobs.utc_now())
    elif args.command == "scan":
        _print(jobs.scan(spark, args.input, args.out))
    elif args.command == "sanitize":
        _print(jobs.sanitize(spark, args.input, args.out, args.policy, redact.find_scanner()))
    elif args.command == "publish":
        result = jobs.publish(spark, args.input, book, _sink(args.to, conf), args.namespace or conf.namespace, args.dry_run, args.yes and args.review, raw, args.max_upload_bytes, salt=jobs.load_salt(conf.home / "anonymization_salt"))
        _print({k: v for k, v in vars(result).items() if k in {"produced_docs", "would_upload_docs", "uploaded_docs", "skipped_existing_docs", "capped_docs", "would_upload_bytes", "uploaded_bytes", "capped_bytes"}})
    elif args.command == "status":
        state = book.consent()
        print("consent=missing" if state is None else f"consent=initialized license={state['license']} version={state['consent_version']}")
        print(f"pending_revocations={lg.pending_revocations(book.read('revocations')).count()}")
        totals = lg.totals_by(book.read("episodes"), "source_tool").collect()  # a row for each source
        print("\n".join(f"{r['source_tool']} => {r['n']} episodes" for r in totals) or "no episode uploads yet")
    elif args.command == "reset":
        if not args.yes or not (args.all or args.source):
            raise PermissionError("reset requires --yes and --all or --source <name>")
        if args.all:
            book.reset_all()
        else:
            book.reset_source(args.source)
        print("reset all" if args.all else f"reset source={args.source}")
    return 0


def _sources(args: argparse.Namespace, sources_file: Path, remote: registry.RemoteRegistry | None = None) -> int:
    if args.action == "add":
        registry.add_local(sources_file, registry.Source(args.name, (args.root,), (args.glob,), args.format, parser_hint=args.parser))
        print(f"added={args.name}")
        return 0
    if args.action == "update":
        print(f"remote sources={len(remote.load())}" if remote else "remote registry is not enabled")
    found, warnings = registry.resolve(sources_file, remote)
    for source in found:
        present = any(Path(registry.expand(r)).is_dir() for r in source.roots)
        if args.action != "detect" or present:
            print(f"{source.id} format={source.format} roots={','.join(source.roots)}" + (" detected" if present else ""))
    for warning in warnings:
        print(warning, file=sys.stderr)
    return 0


if __name__ == "__main__":
    sys.exit(main())

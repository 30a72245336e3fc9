"""Dataset snapshots: filters, deduplication, deterministic split, and the files of a release."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from episodica.functions.blake3 import content_digest, first_byte
from episodica.operators.episodes import RECORD, derive_sft, derive_tooltrace

# Licences that may be released, the share of the split in hundredths, and a release's files.
LICENSES = ("CC0-1.0", "CC-BY-4.0")
TRAIN_BELOW = 98
DATA_FILES = ("train.jsonl.zst", "val.jsonl.zst", "sft.jsonl.zst", "tooltrace.jsonl.zst")
REQUIRED_FILES = (*DATA_FILES, "manifest.json", "CHECKSUMS.txt", "DATA_CARD.md")


def select_episodes(episodes: DataFrame, revoked: DataFrame | None = None, order: tuple[str, ...] = ("path", "seq")) -> DataFrame:
    """Episodes that may be released, the first by order for each content_hash.

    The filters come before the deduplication, so a revoked first copy doesn't hide a valid second one. revoked has episode_id;
    the join is planned by the size of that table.
    """
    kept = episodes if revoked is None else episodes.join(revoked.select(F.col("episode_id").alias("id")), "id", "left_anti")
    kept = kept.filter(F.col("license").isin(*LICENSES) & F.col("consent.public_searchable") & F.col("consent.trainable"))
    first = F.row_number().over(W.partitionBy("content_hash").orderBy(*order))
    return kept.withColumn("__first", first).filter("__first = 1").drop("__first")


def split_bucket(id_column: Column, seed: str, profile: str = "blake3") -> Column:
    """The first byte of the hash of id|seed, modulo 100. As a byte has 256 values, 98 and 99 come up four times in 256."""
    return first_byte(content_digest(F.concat(id_column, F.lit(f"|{seed}")), profile)) % 100


def with_split(episodes: DataFrame, seed: str, profile: str = "blake3") -> DataFrame:
    bucket = split_bucket(F.col("id"), seed, profile)
    return episodes.withColumn("bucket", bucket).withColumn("split", F.when(F.col("bucket") < TRAIN_BELOW, "train").otherwise("val"))


def license_breakdown(episodes: DataFrame) -> DataFrame:
    return episodes.groupBy("license").agg(F.count("*").alias("n")).orderBy("license")


@dataclass(frozen=True)
class Snapshot:
    version: str
    train_count: int
    val_count: int
    out_dir: Path
    manifest_hash: str


def sha256_file(path: Path) -> str:
    with path.open("rb") as data:
        return hashlib.file_digest(data, "sha256").hexdigest()


def write_zst(path: Path, lines: Iterator[str], level: int = 3) -> int:
    """Lines as a zstd file; the number of lines."""
    import zstandard

    count = 0
    with path.open("wb") as raw, zstandard.ZstdCompressor(level=level).stream_writer(raw) as out:
        for line in lines:
            out.write(line.encode() + b"\n")
            count += 1
    return count


def _json_lines(df: DataFrame, columns: list[str], order: tuple[str, ...]) -> Iterator[str]:
    rows = df.orderBy(*order).select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("line"))
    return (row["line"] for row in rows.toLocalIterator(prefetchPartitions=True))


def build_snapshot(episodes: DataFrame, version: str, out_root: str | Path, seed: str, revoked: DataFrame | None = None, profile: str = "blake3", order: tuple[str, ...] = ("path", "seq")) -> Snapshot:
    """Write dataset-<version> under out_root: train, val, sft and tooltrace as zstd JSON lines, manifest, checksums, data card.

    A release is one file of each kind by contract, so lines are streamed through the driver in order, a partition at a time; use
    write_tables for releases too large for that. Fails if there are no episodes at all.
    """
    if episodes.isEmpty():
        raise ValueError("no episode records found")
    chosen = with_split(select_episodes(episodes, revoked, order), seed, profile).persist()
    try:
        out = Path(out_root) / f"dataset-{version}"
        out.mkdir(parents=True, exist_ok=True)
        train = write_zst(out / DATA_FILES[0], _json_lines(chosen.filter("split = 'train'"), RECORD, order))
        val = write_zst(out / DATA_FILES[1], _json_lines(chosen.filter("split = 'val'"), RECORD, order))
        for name, derive in ((DATA_FILES[2], derive_sft), (DATA_FILES[3], derive_tooltrace)):
            keys = tuple(f"__key{k}" for k in range(len(order)))  # a record keeps its place, whatever its id
            made = derive(chosen.withColumns(dict(zip(keys, map(F.col, order), strict=True))), keys)
            write_zst(out / name, _json_lines(made, [c for c in made.columns if c not in keys], keys))
        licenses = {r["license"]: r["n"] for r in license_breakdown(chosen).collect()}  # one row for each allowed licence
    finally:
        chosen.unpersist()
    rule = f"{profile}(id|seed)%100 < {TRAIN_BELOW} => train"
    manifest = {"version": version, "total_records": train + val, "train_count": train, "val_count": val, "split_rule": rule, "license_breakdown": licenses, "files": list(DATA_FILES)}
    (out / "manifest.json").write_text(json.dumps(manifest, indent=2, sort_keys=True, ensure_ascii=False))
    (out / "CHECKSUMS.txt").write_text(checksums([out / name for name in (*DATA_FILES, "manifest.json")]))
    card = ["# DATA_CARD", f"Version: {version}", f"Total: {train + val}\nTrain: {train}\nVal: {val}", "Sanitized traces suitable for SFT and tool-use training."]
    (out / "DATA_CARD.md").write_text("\n\n".join(card) + "\n")
    return Snapshot(version, train, val, out, sha256_file(out / "manifest.json"))


def write_tables(episodes: DataFrame, out_dir: str, seed: str, revoked: DataFrame | None = None, profile: str = "blake3", order: tuple[str, ...] = ("path", "seq")) -> None:
    """The same release as distributed tables: episodes partitioned by split, sft, tooltrace. Nothing passes the driver."""
    chosen = with_split(select_episodes(episodes, revoked, order), seed, profile)
    chosen.select("split", *RECORD).write.partitionBy("split").mode("overwrite").parquet(f"{out_dir}/episodes")
    derive_sft(chosen).write.mode("overwrite").parquet(f"{out_dir}/sft")
    derive_tooltrace(chosen).write.mode("overwrite").parquet(f"{out_dir}/tooltrace")


def checksums(paths: list[Path]) -> str:
    """Lines of digest, two spaces and file name, sorted (so by digest)."""
    return "\n".join(sorted(f"{sha256_file(p)}  {p.name}" for p in paths)) + "\n"


def resolve_dir(version: str, path: str | Path) -> Path:
    """path itself if it holds a manifest, or its dataset-<version>."""
    path = Path(path)
    for candidate in (path, path / f"dataset-{version}"):
        if (candidate / "manifest.json").is_file():
            return candidate
    raise FileNotFoundError(f"no snapshot {version} in {path}")


def file_entries(directory: Path) -> list[dict]:
    """Name, bytes and sha256 of the required files by name; fails if one is missing."""
    missing = [name for name in REQUIRED_FILES if not (directory / name).is_file()]
    if missing:
        raise FileNotFoundError(f"snapshot lacks {', '.join(missing)}")
    return [{"name": n, "bytes": os.path.getsize(directory / n), "sha256": sha256_file(directory / n)} for n in sorted(REQUIRED_FILES)]


def publish_snapshot(version: str, path: str | Path, sink=None, dry_run: bool = False) -> dict:
    """Hand the metadata of a built snapshot to sink.publish_snapshot and sink.index_snapshot; data files aren't sent."""
    directory = resolve_dir(version, path)
    entries = file_entries(directory)
    manifest = json.loads((directory / "manifest.json").read_text())
    prefix = None
    if not dry_run:
        prefix = sink.publish_snapshot(version, manifest, (directory / "CHECKSUMS.txt").read_text(), entries, (directory / "DATA_CARD.md").read_text())
        sink.index_snapshot(version, manifest, prefix)
    return {"version": version, "snapshot_dir": str(directory), "object_prefix": prefix, "indexed": not dry_run, "files": entries}

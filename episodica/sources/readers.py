"""Reading transcripts and records."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from episodica.functions.blake3 import content_digest
from episodica.functions.ship import ship_package
from episodica.functions.text import parse_rfc3339
from episodica.operators.events import META, TOOL
from episodica.operators.normalize import normalize_files

STEP = "struct<role:string,content:string,name:string,ts:string>"
EPISODE = (
    "id string, source_tool string, session_id string, ts_start string, ts_end string, prompt string, context string, "
    f"trace array<{STEP}>, result string, outcome struct<success:boolean,signals:struct<tests_passed:boolean,exit_code:int,lint_fixed:boolean>>, "
    "meta struct<lang:string,tool_names:array<string>,error_types:array<string>,repo_fingerprint:string,os:string,editor:string,raw_content_included:boolean>, "
    "consent struct<accepted_at:string,consent_version:string,public_searchable:boolean,trainable:boolean>, "
    "license string, policy_version string, sanitizer_version string, content_hash string"
)


#: Whether a line holds anything but white space (the Unicode property White_Space).
VISIBLE = re.compile(r"[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]").search


def whole_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """path, content of text files; files that aren't UTF-8 are left out."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    text = F.col("content").cast("string")
    return raw.filter(F.is_valid_utf8(text)).select("path", text.alias("content"))


def input_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """path, length, modified of the files at paths (files, folders or globs), each once, in order; an error if there is no such path."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    return listed.select("path", "length", F.col("modificationTime").alias("modified")).distinct().orderBy("path")


def read_source(spark: SparkSession, paths: str | list[str], source: str, format: str, hint: str | None = None) -> DataFrame:
    """Canonical events of the files at paths."""
    return normalize_files(whole_files(spark, paths), source, format, hint)


LINES = "path string, seq bigint, line string, next_offset int"
#: Lines of a batch, about.
BATCH_LINES = 10_000


def lines(files: DataFrame) -> DataFrame:
    """path, seq, line, next_offset for the lines of files (path, content): only a newline ends one, a carriage return before it is
    dropped, blank lines are skipped. next_offset is the byte after the line, from which an appended file could be read on.

    A running sum over the lines of a file is linear in Arrow batches; as an expression it isn't, and as a window it shuffles all lines.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.string(), pa.int64(), pa.string(), pa.int32())
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                parts = (content or "").split("\n")
                ends = np.minimum(np.cumsum(np.fromiter((len(p.encode()) + 1 for p in parts), np.int64, len(parts))), len((content or "").encode()))
                for at in range(0, len(parts), BATCH_LINES):
                    own = [(path, seq, line, end) for seq, (p, end) in enumerate(zip(parts[at : at + BATCH_LINES], ends[at : at + BATCH_LINES].tolist(), strict=True), at) if (line := p.rstrip("\r")) and VISIBLE(line)]
                    if own:
                        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*own, strict=True), types, strict=True)], ["path", "seq", "line", "next_offset"])

    ship_package(files.sparkSession)
    return files.select("path", "content").mapInArrow(rows, LINES)


def fingerprint(length: Column, modified: Column, profile: str = "blake3") -> Column:
    """A file's identity for incremental runs: its size and the second of its last change."""
    return content_digest(F.concat_ws(":", length.cast("string"), F.unix_seconds(modified).cast("string")), profile)


# ---- strict records: a line with a missing field or another type is dropped ------------------------------------------


def _is(value: Column, path: str, *types: str) -> Column:
    """Whether the value at path has one of the types, as VARIANT names them; 'VOID' also stands for a missing one."""
    found = F.coalesce(F.schema_of_variant(F.try_variant_get(value, path, "variant")), F.lit("VOID"))
    test = F.lit(False)
    for t in types:
        test = test | (found.startswith(t) if t in {"OBJECT", "ARRAY"} else found == t)
    return test


def _strict(rows: DataFrame, schema: T.StructType, required: dict[str, tuple[str, ...]]) -> DataFrame:
    v = F.try_parse_json("line")
    good = v.isNotNull()
    for path, types in required.items():
        good = good & _is(v, path, *types)
    parsed = F.from_json("line", schema)
    return rows.filter(good).select("path", "seq", parsed.alias("r")).select("path", "seq", "r.*")


def read_events(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return parse_events(lines(whole_files(spark, paths)))


def parse_events(rows: DataFrame) -> DataFrame:
    """Canonical events from strict JSON lines (path, seq, line)."""
    plain = ["source", "session_id", "kind", "text"]
    schema = T.StructType([*(T.StructField(c, T.StringType()) for c in (*plain, "ts")), T.StructField("tool", TOOL), T.StructField("meta", META)])
    required = {f"$.{c}": ("STRING",) for c in (*plain, "ts")} | {"$.tool": ("VOID", "OBJECT"), "$.meta": ("VOID", "OBJECT")}
    rows = _strict(rows, schema, required).withColumn("ts", parse_rfc3339(F.col("ts")))
    named = F.col("tool").isNull() | F.col("tool.name").isNotNull()
    tagged = F.col("meta").isNull() | F.col("meta.tags").isNotNull()
    return rows.filter(F.col("ts").isNotNull() & named & tagged).withColumn("ts_inferred", F.lit(False))


def read_episodes(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return parse_episodes(lines(whole_files(spark, paths)))


def parse_episodes(rows: DataFrame) -> DataFrame:
    """Episode records from strict JSON lines (path, seq, line), with path and seq."""
    texts = "id source_tool session_id ts_start ts_end prompt context result license policy_version sanitizer_version content_hash".split()
    required = {f"$.{c}": ("STRING",) for c in texts} | {"$.trace": ("ARRAY",), "$.outcome": ("OBJECT",), "$.outcome.success": ("BOOLEAN",), "$.outcome.signals": ("OBJECT",), "$.meta": ("OBJECT",), "$.meta.tool_names": ("ARRAY",), "$.meta.error_types": ("ARRAY",), "$.meta.raw_content_included": ("BOOLEAN",), "$.consent": ("OBJECT",), "$.consent.accepted_at": ("STRING",), "$.consent.consent_version": ("STRING",), "$.consent.public_searchable": ("BOOLEAN",), "$.consent.trainable": ("BOOLEAN",)}
    schema = rows.sparkSession.createDataFrame([], EPISODE).schema
    return _strict(rows, schema, required)

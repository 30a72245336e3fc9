"""Chunk documents: greedy packing of a session's events up to a byte limit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodica.functions.blake3 import content_digest
from episodica.functions.text import normalize_text, rfc3339

#: Bytes of a chunk's pieces, the newlines between them not counted.
CHUNK_BYTES = 3200


def piece(ts: Column, kind: Column, text: Column) -> Column:
    return F.concat(F.lit("["), rfc3339(ts), F.lit("]["), kind, F.lit("] "), text)


def chunk_numbers(sizes: Column, limit: int) -> Column:
    """The chunk of each of an array of sizes: a new one begins where a size no longer fits to those before it."""
    start = F.struct(F.lit(0).cast("bigint").alias("held"), F.lit(0).alias("chunk"), F.array().cast("array<int>").alias("out"))

    def step(acc: Column, size: Column) -> Column:
        full = (acc["held"] > 0) & (acc["held"] + size > limit)
        held = F.when(full, size).otherwise(acc["held"] + size)
        chunk = F.when(full, acc["chunk"] + 1).otherwise(acc["chunk"])
        return F.struct(held.cast("bigint").alias("held"), chunk.alias("chunk"), F.concat(acc["out"], F.array(chunk)).alias("out"))

    return F.aggregate(sizes, start, step)["out"]


def chunk_events(events: DataFrame, profile: str = "blake3", limit: int = CHUNK_BYTES, policy_version: str = "", sanitizer_version: str = "") -> DataFrame:
    """id, text, metadata for each chunk of each session (path), with path and chunk_index.

    Only the sizes of a session are folded in one row; texts are grouped again by chunk, so rows stay small.
    """
    made = events.withColumn("piece", piece(F.col("ts"), F.col("kind"), F.col("text")))
    sizes = made.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("seq", F.octet_length("piece").cast("bigint").alias("size")))).alias("s"))
    placed = sizes.select("path", F.explode(F.arrays_zip(F.col("s.seq").alias("seq"), chunk_numbers(F.transform("s", lambda x: x["size"]), limit).alias("chunk_index"))).alias("z")).select("path", "z.*")
    item = F.struct("seq", "piece", "source", "session_id", "ts", "kind", F.col("tool.name").alias("tool_name"))
    grouped = made.join(placed, ["path", "seq"]).groupBy("path", "chunk_index").agg(F.array_sort(F.collect_list(item)).alias("i"))
    i = F.col("i")
    first, last = F.get(i, F.lit(0)), F.element_at(i, -1)
    rows = grouped.select(
        "path",
        "chunk_index",
        F.array_join(F.transform(i, lambda x: x["piece"]), "\n").alias("text"),
        first["source"].alias("source"),
        first["session_id"].alias("session_id"),
        rfc3339(first["ts"]).alias("ts_start"),
        rfc3339(last["ts"]).alias("ts_end"),
        F.transform(F.filter(i, lambda x: x["tool_name"].isNotNull()), lambda x: x["tool_name"]).alias("tool_names"),
        F.transform(F.filter(i, lambda x: x["kind"] == "error"), lambda x: x["kind"]).alias("error_types"),
    )
    rows = rows.withColumn("content_hash", content_digest(normalize_text(F.col("text")), profile))
    seed = F.concat_ws("|", "source", "session_id", F.col("chunk_index").cast("string"), "content_hash")
    none = F.lit(None).cast("string")
    meta = F.struct("source", "session_id", "chunk_index", "ts_start", "ts_end", "tool_names", "error_types", none.alias("repo_fingerprint"), none.alias("language"), F.lit(policy_version).alias("policy_version"), F.lit(sanitizer_version).alias("sanitizer_version"), "content_hash")
    return rows.select("path", "chunk_index", content_digest(seed, profile).alias("id"), "text", meta.alias("metadata"))


def hash_identifier(value: Column, salt: str, profile: str = "blake3") -> Column:
    return content_digest(F.concat(F.lit(f"{salt}|"), value), profile)


def anonymize(chunks: DataFrame, salt: str, profile: str = "blake3") -> DataFrame:
    """Source, session, repository fingerprint and tool names of the metadata as salted hashes.

    Tool names are exploded, hashed as a column (a hash may be a Python function) and gathered again in order.
    """
    hashed = lambda c: hash_identifier(c, salt, profile)
    m = F.col("metadata")
    if profile == "sha256":
        tools = F.transform(m["tool_names"], hashed)
        return chunks.withColumn("metadata", m.withField("source", hashed(m["source"])).withField("session_id", hashed(m["session_id"])).withField("repo_fingerprint", hashed(m["repo_fingerprint"])).withField("tool_names", tools))
    names = chunks.select("id", F.posexplode("metadata.tool_names").alias("p", "t")).withColumn("t", hashed(F.col("t")))
    names = names.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("p", "t"))).alias("n")).select("id", F.col("n.t").alias("__tools"))
    rows = chunks.withColumns({"__source": hashed(m["source"]), "__session": hashed(m["session_id"]), "__repo": hashed(m["repo_fingerprint"])}).join(names, "id", "left")
    empty = F.array().cast("array<string>")
    meta = m.withField("source", F.col("__source")).withField("session_id", F.col("__session")).withField("repo_fingerprint", F.col("__repo")).withField("tool_names", F.coalesce("__tools", empty))
    return rows.withColumn("metadata", meta).select(chunks.columns)

"""Byte-level BPE encoding and decoding through one global shuffle of distinct words.

encode: pre-tokens are kept with their positions in blocks (``blocks.pack``); each distinct pre-token of the corpus is encoded
once; its ids are joined back to the blocks that use it, and every document is reassembled by position.
decode: token ids are mapped through the token-byte table of the vocabulary (about 50,000 entries whatever the input).
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episodica.llm import blocks as bl
from episodica.llm.common import lean, prepare, text_or_empty

#: Bytes of text of a block.
BLOCK_BYTES = 10 << 20
#: Buckets of the block table at most; Spark refuses more than 100,000.
MOST_BUCKETS = 20_000
SCHEMA = "doc_id bigint, n_tokens bigint, ids binary"


def load_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a .tiktoken file: token bytes to id."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@cache
def _splitter(pattern: str):
    import regex

    return regex.compile(pattern).findall


def pre_tokens(pattern: str, text: str) -> list[bytes]:
    return [w.encode() for w in _splitter(pattern)(text)]


_ENCODERS: dict[str, object] = {}


def _encoder(name: str, ranks: dict[bytes, int], pattern: str):
    import tiktoken

    if name not in _ENCODERS:
        _ENCODERS[name] = tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[name]


def _vocabulary(spark: SparkSession, path: str):
    """The ranks, broadcast: their size is that of the vocabulary file and doesn't depend on the input."""
    prepare(spark)
    return spark.sparkContext.broadcast(load_ranks(path))


def encode(docs: DataFrame, vocabulary: str, pattern: str, block_bytes: int = BLOCK_BYTES, decoded: bool = False, **sizes: int) -> DataFrame:
    """doc_id, n_tokens long, ids binary (little-endian unsigned 32-bit) for each row of docs (doc_id, text).

    With decoded, the ids are decoded again in the same pass (see decode), which spares a second worker for each task.

    Each match of pattern is merged separately by the ranks in the file vocabulary; there are no special tokens. Null and empty
    texts give no ids. Repeated rows and null doc_ids are encoded row by row; other columns are ignored. sizes are those of the
    exchange (``blocks.Exchange.of``).
    """
    ranks = _vocabulary(docs.sparkSession, vocabulary)
    own = docs.select("doc_id", text_or_empty().alias("text"))
    buckets = min(MOST_BUCKETS, 2 * max(docs.sparkSession.sparkContext.defaultParallelism, own.rdd.getNumPartitions()))
    packed = bl.pack(own, partial(bl.ListBuilder, partial(pre_tokens, pattern)), block_bytes, buckets)
    exchange = bl.Exchange.of(packed, **sizes)

    def encode_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merge = _encoder(vocabulary, ranks.value, pattern)._core_bpe.encode_single_piece
        part, known = None, {}
        for key, (blocks, counts, idx, words, *_, block) in bl.rows_of(batches):
            if key != part:
                part, known = key, {}
            words = bl.unsqueeze_strings(words)
            for word in words:
                if word not in known:
                    known[word] = merge(word)
            ids = [known[word] for word in words]
            lens, vals = np.fromiter(map(len, ids), np.uint32, len(ids)), np.fromiter(chain.from_iterable(ids), np.uint32)
            yield bl.batch_of([(key, 0, blocks, counts, idx, None, None, bl.squeeze(lens), bl.squeeze(vals), block)])

    encoded = exchange.send_words(packed).mapInArrow(lean(encode_words), bl.ITEMS)
    joined = packed.select("block", "doc_ids", "sizes", "codes").join(exchange.send_back(encoded, buckets), "block", "left")
    joined = joined.select("doc_ids", "sizes", "codes", "table")
    if not decoded:
        return joined.mapInArrow(lean(_assemble), SCHEMA)
    return joined.mapInArrow(lean(lambda batches: _decode(_assemble(batches), ranks.value)), f"{SCHEMA}, decoded binary")


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield from _documents(*(batch.column(c)[k].as_py() for c in range(4)))


def _documents(doc_ids: list, sizes: bytes, codes: bytes, table: list[dict] | None) -> Iterator[pa.RecordBatch]:
    """The documents of one block, a few at a time."""
    ends = np.cumsum(np.frombuffer(sizes, "<u4"), dtype=np.int64).tolist()
    codes = bl.unsqueeze(codes)
    idx, n, flat = bl.answers_of(table)
    if len(codes) and int(codes.max()) >= len(idx):
        raise ValueError("a block lacks the ids of some of its words")
    lengths, starts = np.empty_like(n), np.empty_like(n)
    lengths[idx], starts[idx] = n, np.cumsum(n) - n
    at = 0
    out_ids, out_n, out_bytes, held = [], [], [], 0
    for doc_id, end in zip(doc_ids, ends, strict=True):
        own = codes[at:end]
        at = end
        n = lengths[own]
        total = int(n.sum())
        places = np.repeat(starts[own] - (np.cumsum(n) - n), n) + np.arange(total)
        out_ids.append(doc_id)
        out_n.append(total)
        out_bytes.append(flat[places].astype("<u4").tobytes())
        held += total
        if held > (1 << 20):
            yield _batch(out_ids, out_n, out_bytes)
            out_ids, out_n, out_bytes, held = [], [], [], 0
    if out_ids:
        yield _batch(out_ids, out_n, out_bytes)


def _batch(ids: list, n: list, data: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(data, pa.binary())], ["doc_id", "n_tokens", "ids"])


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """The columns doc_id, n_tokens and ids of encode(), and decoded: the bytes that the ids stand for.

    Null ids decode to null; an id that the vocabulary lacks is an error.
    """
    ranks = _vocabulary(encoded.sparkSession, vocabulary)
    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(lean(lambda batches: _decode(batches, ranks.value)), f"{SCHEMA}, decoded binary")


def token_table(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The token-byte table: where the bytes of each id begin, how many they are (-1: no such id), and all bytes."""
    tokens = sorted(ranks.items(), key=lambda x: x[1])
    starts, lengths = np.zeros(tokens[-1][1] + 1 if tokens else 0, np.int64), np.full(tokens[-1][1] + 1 if tokens else 0, -1)
    at = 0
    for token, i in tokens:
        starts[i], lengths[i] = at, len(token)
        at += len(token)
    return starts, lengths, np.frombuffer(b"".join(t for t, _ in tokens), np.uint8)


def _decode(batches: Iterator[pa.RecordBatch], ranks: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """An index join of the ids of each text with the token-byte table."""
    starts, lengths, table = token_table(ranks)

    def bytes_of(ids: bytes) -> bytes:
        own = np.frombuffer(ids, "<u4")
        if len(own) and (int(own.max()) >= len(lengths) or int(lengths[own].min()) < 0):
            raise ValueError("an id that the vocabulary lacks")
        out, step = [], 1 << 20
        for at in range(0, len(own), step):
            part = own[at : at + step]
            n = lengths[part]
            out.append(table[np.repeat(starts[part] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))].tobytes())
        return b"".join(out)

    for batch in batches:
        texts = [None if ids is None else bytes_of(ids) for ids in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], [*batch.schema.names, "decoded"])

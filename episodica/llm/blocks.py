"""Document blocks factorised by their own vocabulary, and an exchange of items between blocks and parts.

A block is a run of documents of bounded size within one task. It keeps its distinct words once, and every document as the
positions of its words in that list. What has to be known globally about a word (its ids, its corpus count) is then
exchanged once per block and distinct word, never once per occurrence.

An item is a pair of block and word. Items travel packed: a row holds all items of one sender for one key. A sender makes at most
FAN rows, however many parts there are: beyond FAN parts a first exchange brings ranges of parts together, tasks merge what they
hold of a range up to MERGE_ITEMS items, and only these are cut by part. Answers go back to the blocks the same way, so that rows
and steps for each block are bounded and all work is in proportion to the items.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import count
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodica.llm.common import lean, materialize, materialize_bucketed, prepare

#: A block is closed once it holds so many bytes of text; a single longer document makes a block of its own.
BLOCK_BYTES = 24 << 20
#: Items that one part of the exchange holds, about.
PART_ITEMS = 250_000
#: Rows that a sender makes at most.
FAN = 2048
#: Items that are merged before they are cut further.
MERGE_ITEMS = 500_000
#: Tasks of an exchange at most; parts beyond share tasks.
MOST_TASKS = 20_000

SCHEMA = "block bigint, doc_ids array<bigint>, sizes binary, codes binary, words array<binary>, n_words int"
ARROW = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.binary()), ("codes", pa.binary()), ("words", pa.list_(pa.binary())), ("n_words", pa.int32())])

ITEMS = "key int, salt int, blocks binary, counts binary, idx binary, words binary, n binary, lens binary, vals binary, block bigint"
ITEMS_ARROW = pa.schema([("key", pa.int32()), ("salt", pa.int32()), *((c, pa.binary()) for c in ("blocks", "counts", "idx", "words", "n", "lens", "vals")), ("block", pa.int64())])


def spread(blocks: np.ndarray | int, n: int) -> np.ndarray:
    """Names of blocks, which follow patterns, evenly over n."""
    return ((np.asarray(blocks).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % n


def squeeze(codes: np.ndarray) -> bytes:
    """Integers below 2**32 as four compressed byte planes."""
    planes = codes.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(planes).tobytes())


def unsqueeze(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def squeeze_strings(strings: list[bytes]) -> bytes:
    """Byte strings: their lengths, then all of them, each compressed."""
    lengths = squeeze(np.fromiter(map(len, strings), np.uint32, len(strings)))
    return len(lengths).to_bytes(4, "little") + lengths + zstandard.ZstdCompressor(level=3).compress(b"".join(strings))


def unsqueeze_strings(data: bytes) -> list[bytes]:
    at = 4 + int.from_bytes(data[:4], "little")
    ends = np.cumsum(unsqueeze(data[4:at]), dtype=np.int64).tolist()
    whole = zstandard.ZstdDecompressor().decompress(data[at:])
    return [whole[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)] if ends else []


# ---- blocks ----------------------------------------------------------------------------------------------------------


def _close(name: int, doc_ids: list, sizes: np.ndarray, codes: np.ndarray, words: list[bytes]) -> pa.RecordBatch:
    order = np.argsort(-np.bincount(codes, minlength=len(words)), kind="stable")
    rank = np.empty(len(words), np.uint32)
    rank[order] = np.arange(len(words), dtype=np.uint32)
    row = [[name], [doc_ids], [sizes.astype("<u4").tobytes()], [squeeze(rank[codes])], [[words[i] for i in order.tolist()]], [len(words)]]
    return pa.RecordBatch.from_arrays([pa.array(v, t.type) for v, t in zip(row, ARROW, strict=True)], schema=ARROW)


class ListBuilder:
    """A block under construction from a function that gives a text's words."""

    def __init__(self, split: Callable[[str], list[bytes]]) -> None:
        self.split, self.parts = split, []
        self.words: dict[bytes, int] = defaultdict()
        self.words.default_factory = count().__next__

    def add(self, texts: pa.Array) -> None:
        for text in texts.to_pylist():
            found = self.split(text or "")
            self.parts.append(np.fromiter(map(self.words.__getitem__, found), np.uint32, len(found)))

    def done(self) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        return np.array(list(map(len, self.parts)), np.uint32), np.concatenate(self.parts) if self.parts else np.empty(0, np.uint32), list(self.words)


class SpaceBuilder:
    """The same for words between ASCII white space with A-Z lower-cased, all texts of a batch at once."""

    def __init__(self) -> None:
        self.sizes: list[np.ndarray] = []
        self.flat: list[pa.Array] = []

    def add(self, texts: pa.Array) -> None:
        if texts.offset:  # casts and kernels may misread slices
            texts = texts.take(pa.array(np.arange(len(texts))))
        lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
        flat, of = lists.flatten(), np.asarray(pc.list_parent_indices(lists))
        real = pc.greater(pc.binary_length(flat), 0)  # the ends of a text with white space there are empty
        self.sizes.append(np.bincount(of[np.asarray(real)], minlength=len(texts)))
        self.flat.append(flat.filter(real))

    def done(self) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        sizes = np.concatenate(self.sizes) if self.sizes else np.empty(0, np.int64)
        encoded = pa.chunked_array(self.flat, pa.large_string()).combine_chunks().dictionary_encode()
        encoded = encoded.combine_chunks() if isinstance(encoded, pa.ChunkedArray) else encoded
        return sizes, np.asarray(encoded.indices).astype(np.uint32), encoded.dictionary.cast(pa.large_binary()).to_pylist()


def pack(docs: DataFrame, builder: Callable[[], ListBuilder | SpaceBuilder], block_bytes: int = BLOCK_BYTES, buckets: int | None = None) -> DataFrame:
    """The blocks of docs (doc_id, text), as a written table (bucketed by block if so asked), so that all its readers see the same.

    A block is named by its task and its number there. Null texts count as empty; null or repeated doc_ids are kept row by row.
    """
    prepare(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = count(TaskContext.get().partitionId() << 24)
        made, ids, held = builder(), [], 0
        for batch in batches:
            sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(1)), 0)) + 16
            at = 0
            while at < batch.num_rows:
                room = np.searchsorted(np.cumsum(sizes[at:]), block_bytes - held)
                upto = min(at + int(room) + 1, batch.num_rows)
                made.add(batch.column(1).slice(at, upto - at))
                ids += batch.column(0).slice(at, upto - at).to_pylist()
                held += int(sizes[at:upto].sum())
                at = upto
                if held >= block_bytes:
                    yield _close(next(names), ids, *made.done())
                    made, ids, held = builder(), [], 0
        if ids:
            yield _close(next(names), ids, *made.done())

    packed = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(lean(rows), SCHEMA)
    return materialize_bucketed(packed, "blocks", "block", buckets) if buckets else materialize(packed, "blocks")


# ---- items -----------------------------------------------------------------------------------------------------------


@dataclass
class Items:
    """Items of blocks: idx is the word's place in the block's list. Besides either words and maybe n (a number for each), or lens
    numbers of each, all of them being vals."""

    block: np.ndarray
    idx: np.ndarray
    words: list[bytes] | None = None
    n: np.ndarray | None = None
    lens: np.ndarray | None = None
    vals: np.ndarray | None = None

    def take(self, order: np.ndarray) -> Items:
        lens = vals = None
        if self.lens is not None:
            lens = self.lens[order]
            starts = np.cumsum(self.lens, dtype=np.int64) - self.lens
            vals = self.vals[np.repeat(starts[order] - (np.cumsum(lens, dtype=np.int64) - lens), lens) + np.arange(int(lens.sum()))]
        return Items(self.block[order], self.idx[order], None if self.words is None else [self.words[i] for i in order.tolist()], None if self.n is None else self.n[order], lens, vals)

    def row(self, key: int, salt: int = 0) -> tuple:
        """Packed, with the first block's name at the end; items of one block must stand together."""
        first = np.flatnonzero(np.concatenate(([True], self.block[1:] != self.block[:-1])))
        packed = lambda x: None if x is None else squeeze(x)
        return key, salt, self.block[first].astype("<i8").tobytes(), squeeze(np.diff(np.append(first, len(self.block)))), squeeze(self.idx), None if self.words is None else squeeze_strings(self.words), packed(self.n), packed(self.lens), packed(self.vals), int(self.block[0])


def unpack(row: tuple) -> Items:
    """The items of a row's columns from blocks on."""
    blocks, counts, idx, words, n, lens, vals, _ = row
    opened = lambda x: None if x is None else unsqueeze(x)
    return Items(np.repeat(np.frombuffer(blocks, "<i8"), unsqueeze(counts)), unsqueeze(idx), None if words is None else unsqueeze_strings(words), opened(n), opened(lens), opened(vals))


def joined(parts: list[Items]) -> Items:
    if len(parts) == 1:
        return parts[0]
    whole = lambda name: None if getattr(parts[0], name) is None else np.concatenate([getattr(p, name) for p in parts])
    return Items(whole("block"), whole("idx"), None if parts[0].words is None else [w for p in parts for w in p.words], whole("n"), whole("lens"), whole("vals"))


def cut(items: Items, key: np.ndarray, salt: int = 0) -> list[tuple]:
    """A row for each key that occurs; in it the items keep their order, but those of a block stand together."""
    order = np.lexsort((items.block, key)) if len(items.block) and items.block[0] != items.block[-1] else np.argsort(key, kind="stable")
    items, key = items.take(order), key[order]
    cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)] if len(key) else []
    starts = None if items.lens is None else np.concatenate(([0], np.cumsum(items.lens, dtype=np.int64)))
    part = lambda x, a, b: None if x is None else x[a:b]
    return [
        Items(items.block[a:b], items.idx[a:b], part(items.words, a, b), part(items.n, a, b), part(items.lens, a, b), None if starts is None else items.vals[starts[a] : starts[b]]).row(int(key[a]), salt)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True)
    ]


def batch_of(rows: list[tuple], schema: pa.Schema = ITEMS_ARROW) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, schema, strict=True)], schema=schema)


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, tuple]]:
    """Key and packed columns of each row, one at a time."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.column(0)[k].as_py(), tuple(batch.column(c)[k].as_py() for c in range(2, 10))


def merged(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[int, Items]]:
    """Rows with equal keys (which stand together) as one, up to about most items."""
    held: list[Items] = []
    key, size = None, 0
    for k, row in rows_of(batches):
        if held and (k != key or size >= most):
            yield key, joined(held)
            held, size = [], 0
        key = k
        held.append(unpack(row))
        size += len(held[-1].idx)
    if held:
        yield key, joined(held)


def _gather(rows: DataFrame, tasks: int, *salt: Column | str) -> DataFrame:
    return rows.repartition(max(1, min(tasks, MOST_TASKS)), "key", *salt).sortWithinPartitions("key")


def part_of(words: list[bytes], parts: int) -> np.ndarray:
    return np.fromiter(map(crc32, words), np.uint32, len(words)).astype(np.int64) % parts


@dataclass(frozen=True)
class Exchange:
    """The sizes of an exchange: items in all, parts, rows of a sender, items merged at a time."""

    items: int
    parts: int
    fan: int = FAN
    merge: int = MERGE_ITEMS

    @classmethod
    def of(cls, packed: DataFrame, part_items: int = PART_ITEMS, fan: int = FAN, merge: int = MERGE_ITEMS) -> Exchange:
        """For the sum of n_words of packed."""
        items = packed.agg(F.sum("n_words")).first()[0] or 0
        return cls(items, max(2 * int(packed.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-items // part_items)), fan, merge)

    @property
    def deep(self) -> bool:
        return self.parts > self.fan

    @property
    def salts(self) -> int:
        """Tasks that share a range, so that each has about enough of it to merge."""
        return max(1, self.items // (self.fan * self.merge))

    def send(self, rows: DataFrame, part: Callable[[Items, int], np.ndarray]) -> DataFrame:
        """Items dealt out by part(items, number of parts), their key; rows of a key stand together.

        rows has each sender's items already cut by their part modulo fan, with a salt from the sender's block.
        """
        parts, merge = self.parts, self.merge

        def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, items in merged(batches, merge):
                yield batch_of(cut(items, part(items, parts)))

        if self.deep:
            rows = _gather(rows, -(-self.items // merge), F.col("salt") % self.salts).mapInArrow(lean(split), ITEMS)
        return _gather(rows, parts)

    def send_words(self, packed: DataFrame, count: Callable[[list, np.ndarray, np.ndarray, int], np.ndarray] | None = None) -> DataFrame:
        """The distinct words of each block as items, dealt out by the word, so that equal words of all blocks have one key.

        count(doc_ids, sizes, codes, number of words) gives n for each word.
        """
        parts, fan = self.parts, self.fan

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    block, listed = batch.column(0)[k].as_py(), batch.column(1)[k].values
                    order = np.asarray(pc.sort_indices(listed)).astype(np.int64)  # neighbours compress better
                    words = listed.take(pa.array(order)).to_pylist()
                    n = None
                    if count is not None:
                        n = count(batch.column(2)[k].as_py(), np.frombuffer(batch.column(3)[k].as_py(), "<u4"), unsqueeze(batch.column(4)[k].as_py()), len(words))[order]
                    yield batch_of(cut(Items(np.full(len(words), block), order.astype(np.uint32), words, n), part_of(words, parts) % fan, int(spread(block, parts))))

        columns = ["block", "words"] + ([] if count is None else ["doc_ids", "sizes", "codes"])
        return self.send(packed.select(*columns).mapInArrow(lean(deal), ITEMS), lambda items, n: part_of(items.words, n))

    def send_back(self, answers: DataFrame, tasks: int) -> DataFrame:
        """block, table: the answers (rows of items) gathered by block, in so many partitions by block."""
        fan, merge = self.fan, self.merge

        def to_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for key, items in merged(batches, merge):
                yield batch_of(cut(items, spread(items.block, fan), key))

        def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, items in merged(batches, merge):
                yield batch_of(cut(items, np.unique(items.block, return_inverse=True)[1]))

        if self.deep:
            answers = _gather(answers.mapInArrow(lean(to_ranges), ITEMS), -(-self.items // merge), F.col("salt") % self.salts).mapInArrow(lean(to_blocks), ITEMS)
        return answers.select("block", "idx", "lens", "vals").repartition(tasks, "block").groupBy("block").agg(F.collect_list(F.struct("idx", "lens", "vals")).alias("table"))


def answers_of(table: list[dict] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """idx, lens and vals of a block's table."""
    pieces = [[unsqueeze(row[k]) for k in ("idx", "lens", "vals")] for row in table or []]
    return tuple(np.concatenate([p[k] for p in pieces]).astype(np.int64) if pieces else np.empty(0, np.int64) for k in range(3))

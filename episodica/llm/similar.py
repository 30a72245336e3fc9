"""Near copies: the components of all pairs of texts whose distinct shingles have a Jaccard similarity of at least some value.

Candidates come from two sides. The SimHash trie (``simhash.links``) links fingerprints within a few bits, which finds most copies of
long texts; no bit budget finds all pairs of a given similarity, so an exact join on prefixes completes it. There shingles are
ordered by the number of texts that hold them, rarest first. Of two sets of n and m shingles with a similarity of at least s, each
holds s n (s m) of the other's, so they share one among the first n - ceil(s n) + 1 (m - ...) in that order. Texts that share none
there are never compared, and all others are, exactly; no pair is given up before that.

Equal sets, told by a SHA-256, are one item. Blocks of texts send their shingles' hashes through the packed exchange (``blocks``) and
are sent back the numbers of those that more than one text holds. Hashes are cut to the part and 32 bits, which can only add
candidates. Shingles that are common in a sample of texts aren't sent: they stand last in the order, by their hashes, so no part
has to hold a shingle of a third of all texts. (Any one order gives the same pairs, so the sample only decides on the work.) The
texts that share a shingle are compared with one of them, another one for each shingle and round, until classes hardly merge; only
shingles whose texts aren't all connected by then form pairs, between the classes. With both sizes known more is asked of a pair:
it must share o = ceil(s (n + m) / (1 + s)) shingles, so each must have as many that any other text holds at all, and one
that they share must be among the first n - o + 1 and m - o + 1. And at most n + m - 2 o shingles stand in one of the two only. A text's
mark has a bit for each of so many buckets of shingles, set if the text holds an odd number of them. Two marks differ in no more bits than
there are such shingles, so pairs whose marks differ in more aren't formed. In a large group of edited versions of one text, whose rarest
shingles are the same few, that leaves hardly more than the pairs that are similar, and rounds connect most of those before.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodica.llm import blocks as bl
from episodica.llm import components, simhash
from episodica.llm.common import discard, lean, materialize, prepare, text_or_empty
from episodica.llm.simhash import _signed, majority_bits, shingle_hashes

#: Shingles that make one part of the exchange, about.
PART_ITEMS = 1_000_000
#: Texts of a block at most, and the bytes of their texts, about.
BLOCK_ROWS, BLOCK_BYTES = 1 << 16, 4 << 20
#: Texts that common shingles are looked for in, about; the share of them that makes a shingle common; how many such at most.
SAMPLE_TEXTS, COMMON_SHARE, COMMON_MOST = 20_000, 0.005, 1 << 16
#: Texts that are joined by a broadcast of their hashes (some 50 bytes each) instead of moving all texts.
BROADCAST_TEXTS = 250_000
#: Rounds in which the texts of a shingle are compared with one of them, at most.
STAR_ROUNDS = 5
#: Texts of a shingle that the others are compared with in one of the later rounds, at most.
PIVOTS = 16
#: A round that leaves more than this share of the pairs between classes is the last.
LEAST_MERGED = 0.75
#: Bits of a mark; those of texts with more shingles have a second part with a bit or two for each.
MARK_BITS = 1024
#: What the trie finds: bits and rotations.
TRIE_BITS, TRIE_ROTATIONS = 2, 3

SHINGLED = f"{bl.ITEMS}, row bigint, doc_id bigint, fp bigint, text_hash bigint, digest binary, mark array<bigint>, sizes binary"
SHINGLED_ARROW = pa.schema([*bl.ITEMS_ARROW, ("row", pa.int64()), ("doc_id", pa.int64()), ("fp", pa.int64()), ("text_hash", pa.int64()), ("digest", pa.binary()), ("mark", pa.list_(pa.int64())), ("sizes", pa.binary())])
_NO_ITEMS, _NO_TEXT = (None,) * 10, (None,) * 7


def set_digest(own: np.ndarray) -> bytes:
    return hashlib.sha256(own.astype("<u8").tobytes()).digest()


def mark_of(own: np.ndarray) -> np.ndarray:
    """MARK_BITS bits as longs and, of more hashes than that, as many bits as the next power of two, and half as many: in how many of
    one part two sets differ is at most the number of hashes that stand in one of the two only."""

    def part(bits: int) -> np.ndarray:
        odd = np.bincount((own % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
        return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")

    if len(own) <= MARK_BITS:
        return part(MARK_BITS)
    wide = 1 << (len(own) - 1).bit_length()
    return np.concatenate((part(MARK_BITS), part(wide), part(wide // 2)))


def apart(x: str, y: str) -> Column:
    """At least so many hashes stand in one only of the sets with the marks x and y."""
    longs = MARK_BITS // 64
    first = sum((F.bit_count(F.get(x, F.lit(k)).bitwiseXOR(F.get(y, F.lit(k)))) for k in range(longs)), F.lit(0))
    wide = lambda c: ((F.size(c) - longs) / 3 * 2).cast("int")
    # of two sizes the smaller one, which the other has as its half if it is the next
    own = lambda c, d: F.when(wide(c) <= wide(d), F.slice(c, longs + 1, wide(c))).otherwise(F.slice(c, wide(c) + (longs + 1), (wide(c) / 2).cast("int")))
    p, q = own(x, y), own(y, x)
    bits = F.aggregate(F.zip_with(p, q, lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda s, n: s + n)
    return F.when((F.size(x) > longs) & (F.size(y) > longs) & (F.size(p) == F.size(q)), F.greatest(first, bits)).otherwise(first)


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return (((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def common_shingles(docs: DataFrame, texts: int, width: int) -> np.ndarray:
    """The hashes, in order, of shingles that are common in a sample of docs by the hash of the text: a bounded list."""
    every = max(1, texts // SAMPLE_TEXTS)
    chosen = docs.select(text_or_empty().alias("text")).filter(F.pmod(F.xxhash64("text", F.lit("common")), F.lit(every)) == 0)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(shingle_hashes(text, width)) for text in batch.column(0).to_pylist()]
            hashes, n = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.empty(0, np.uint64), np.empty(0))
            many = n > 1 if len(sets) > 100 else n > 0  # a shingle of half a per cent of all texts meets itself in most batches
            yield pa.RecordBatch.from_arrays([pa.array(hashes[many].view(np.int64)), pa.array(n[many].astype(np.int64))], ["h", "n"])

    least = max(8, COMMON_SHARE * texts / every)
    counts = chosen.mapInArrow(lean(rows), "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    found = counts.orderBy(F.desc("n"), "h").limit(COMMON_MOST).select("h").toArrow()
    return np.sort(found.column("h").to_numpy().astype(np.int64).view(np.uint64))


def shingled(docs: DataFrame, width: int, parts: int, fan: int, common: np.ndarray) -> DataFrame:
    """For each text a row (row, doc_id, fp, text_hash, digest, mark), for each block one (sizes, and the common shingles as its items), and
    the block's other shingles as items cut by part; the text at place idx of a block has the row block + idx."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(common)  # COMMON_MOST hashes at most

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        usual = shared.value
        for batch in filter(lambda b: b.num_rows, batches):
            lengths = np.array([len(t) for t in batch.column(3).to_pylist()])
            number = np.maximum(np.cumsum(lengths) // BLOCK_BYTES, np.arange(len(lengths)) // BLOCK_ROWS)
            cuts = [0, *(np.flatnonzero(number[1:] != number[:-1]) + 1).tolist(), len(lengths)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                yield from block(batch.slice(lo, hi - lo), usual)

    def block(batch: pa.RecordBatch, usual: np.ndarray) -> Iterator[pa.RecordBatch]:
        out, sets = [], []
        for row, doc_id, text_hash, text in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            every = shingle_hashes(text, width)
            sets.append(np.unique(every))
            out.append((*_NO_ITEMS, row, doc_id, _signed(majority_bits(every)), text_hash, set_digest(sets[-1]), mark_of(sets[-1]), None))
        name = out[0][10]
        sizes = np.fromiter(map(len, sets), "<u4", len(sets))
        hashes, place = np.concatenate(sets), np.repeat(np.arange(len(sets), dtype=np.uint32), sizes)
        at = np.searchsorted(usual, hashes)
        is_common = usual[np.minimum(at, len(usual) - 1)] == hashes if len(usual) else np.zeros(len(hashes), bool)
        out.append((*(_items(name, place[is_common], hashes[is_common], True).row(-1) if is_common.any() else (-1, 0, np.array([name], "<i8").tobytes(), *[None] * 6, name)), *_NO_TEXT[:6], sizes.tobytes()))
        rest = ~is_common
        if rest.any():
            out += [(*row, *_NO_TEXT) for row in bl.cut(_items(name, place[rest], hashes[rest], parts > fan), part_of(hashes[rest], parts) % fan, int(bl.spread(name, parts)))]
        yield bl.batch_of(out, SHINGLED_ARROW)

    # the ids of a task's rows are consecutive
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint"), F.xxhash64(text_or_empty()).alias("text_hash"), text_or_empty().alias("text"))
    return materialize(numbered.mapInArrow(lean(rows), SHINGLED), "shingled")


def _items(name: int, place: np.ndarray, hashes: np.ndarray, whole: bool) -> bl.Items:
    """n is the lower half of a hash; the upper half is only sent where it is needed to find the part."""
    items = bl.Items(np.full(len(place), name), place, n=(hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32))
    if whole:
        items.lens, items.vals = np.ones(len(place), np.uint32), (hashes >> np.uint64(32)).astype(np.uint32)
    return items


def _hashes(items: bl.Items) -> np.ndarray:
    return (items.vals.astype(np.uint64) << np.uint64(32)) | items.n.astype(np.uint64)


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items, a part's together, to answers for those whose 32 bits stand more than once in the part: how often, part and bits."""
    held: list[tuple] = []
    part = None

    def close() -> Iterator[pa.RecordBatch]:
        whole = [bl.unpack(row) for row in held]
        held.clear()
        bits = np.concatenate([items.n for items in whole])
        order = np.argsort(bits, kind="stable")
        ranked = bits[order]
        first = np.append(np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1]))), len(bits))
        times = np.empty(len(bits), np.uint32)
        times[order] = np.repeat(np.diff(first), np.diff(first))
        at = 0
        for items in whole:
            own = times[at : at + len(items.idx)]
            at += len(items.idx)
            many = own > 1
            if many.any():
                vals = np.stack((own[many], np.full(int(many.sum()), part, np.uint32), items.n[many]), axis=1).ravel()
                yield bl.batch_of([bl.Items(items.block[many], items.idx[many], lens=np.full(int(many.sum()), 3, np.uint32), vals=vals).row(part)])

    for key, row in bl.rows_of(batches):
        if held and key != part:
            yield from close()
        part = key
        held.append(row)
    if held:
        yield from close()


def prefixes(table: DataFrame, exchange: bl.Exchange, similarity: float) -> DataFrame:
    """key, row, n, v, place: the shared shingles among the first n - ceil(similarity n) + 1 of each text's n, rarest first, common ones
    last; place is a shingle's among the n, from 0, and v how many of them are shared."""
    sent = exchange.send(table.filter("key >= 0").select(*bl.ITEMS_ARROW.names), lambda items, n: part_of(_hashes(items), n))
    tasks = max(exchange.parts // 4, int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    back = exchange.send_back(sent.mapInArrow(lean(_common), bl.ITEMS), min(tasks, bl.MOST_TASKS))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                name, packed, idx, n, vals = (batch.column(c)[k].as_py() for c in range(5))
                size = np.frombuffer(packed, "<u4").astype(np.int64)
                place, _, answer = bl.answers_of(batch.column(5)[k].as_py())
                answer = answer.reshape(-1, 3)
                times, key = answer[:, 0], (answer[:, 1] << 32) | answer[:, 2]  # a part and the bits in it
                if idx is not None:
                    usual = bl.unsqueeze(idx).astype(np.int64)
                    place, times = np.concatenate((place, usual)), np.concatenate((times, np.full(len(usual), 1 << 40)))
                    key = np.concatenate((key, -((bl.unsqueeze(vals).astype(np.int64) >> 1 << 32) | bl.unsqueeze(n)) - 1))  # below 0: apart from the others
                order = np.lexsort((key, times, place))
                place, key = place[order], key[order]
                known = np.bincount(place, minlength=len(size))
                rank = np.arange(len(place)) - (np.cumsum(known) - known)[place]
                reach = size - np.ceil(similarity * size - 1e-9).astype(np.int64) + 1 - (size - known)  # shingles of no other text come first
                near = rank < reach[place]
                own = place[near]
                columns = (key[near], name + own, size[own], known[own], (rank + (size - known)[place])[near])
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["key", "row", "n", "v", "place"])

    own = table.filter("key = -1").select("block", "sizes", "idx", "n", "vals")
    return own.join(back, "block", "left").select("block", "sizes", "idx", "n", "vals", "table").mapInArrow(lean(first), "key bigint, row bigint, n bigint, v bigint, place bigint").dropDuplicates(["key", "row"])


def verified(pairs: DataFrame, items: DataFrame, docs: DataFrame, width: int, similarity: float) -> DataFrame:
    """The pairs a, b of items (row, text_hash, digest) whose texts have a Jaccard similarity of at least similarity over distinct shingles."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, digest, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                own = np.unique(shingle_hashes(text, width))
                if set_digest(own) == digest:
                    out.append((row, own.tobytes()))
            yield bl.batch_of(out, pa.schema([("row", pa.int64()), ("held", pa.binary())]))

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for k in range(batch.num_rows):
                p, q = (np.frombuffer(batch.column(c)[k].as_py() or b"", np.uint64) for c in (2, 3))
                at = np.searchsorted(p, q)
                shared = int((p[np.minimum(at, len(p) - 1)] == q).sum()) if len(p) else 0
                keep.append(shared >= similarity * (len(p) + len(q) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    ends = materialize(pairs.select(F.col("a").alias("row")).union(pairs.select("b")).distinct().join(items, "row").select("row", "text_hash", "digest"), "ends")
    wanted = F.broadcast(ends) if ends.count() <= BROADCAST_TEXTS else ends
    texts = docs.select(F.xxhash64(text_or_empty()).alias("text_hash"), text_or_empty().alias("text")).join(wanted, "text_hash").select("row", "digest", "text")
    held = materialize(texts.mapInArrow(lean(sets), "row bigint, held binary").dropDuplicates(["row"]), "shingles")
    discard(ends)
    side = lambda c: held.select(F.col("row").alias(c), F.col("held").alias(f"held_{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "held_a", "held_b").mapInArrow(lean(similar), "a bigint, b bigint")


def trie_candidates(rows: DataFrame) -> DataFrame:
    """a, b: pairs of rows (row, fp) that connect all whose fingerprints are equal or linked by the trie."""
    fps = materialize(rows.groupBy("fp").agg(F.min("row").alias("least")).withColumn("fp2", F.lit(0).cast("bigint")), "fps")
    found = simhash.links(fps.select("fp", "fp2"), TRIE_BITS, TRIE_ROTATIONS)
    end = lambda c: fps.select(F.col("fp").alias(c), F.col("least").alias(f"row_{c}"))
    linked = found.join(end("a"), "a").join(end("b"), "b").select(F.least("row_a", "row_b").alias("a"), F.greatest("row_a", "row_b").alias("b"))
    equal = rows.join(fps, "fp").filter("row > least").select(F.col("least").alias("a"), F.col("row").alias("b"))
    return linked.union(equal)


def links(keys: DataFrame, candidates: DataFrame, items: DataFrame, marks: DataFrame, docs: DataFrame, width: int, similarity: float) -> DataFrame:
    """node, root (as of components.roots) by all pairs of rows of items of at least similarity: keys are their prefixes, marks (row, mark)."""
    needed = lambda n, m: F.ceil(F.lit(similarity / (1 + similarity)) * (n + m) - 1e-9)
    pair = lambda x, y: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))

    most = lambda n, m: n + m - 2 * needed(n, m)

    placed, tried, root, before = keys.withColumns({"root": F.col("row"), "mark": F.lit(None).cast("array<bigint>")}), None, None, None
    for number in range(STAR_ROUNDS):
        # rows of one key meet one of them, later up to PIVOTS: linear in keys, and a text of many keys meets many others
        drawn = F.xxhash64("row", "key", F.lit(number))
        pivot = materialize(placed.groupBy("key", F.pmod(drawn, F.lit(PIVOTS if number else 1)).alias("of")).agg(F.min_by(F.struct("row", "n", "v", "root", "mark"), drawn).alias("p")).drop("of"), "pivots")
        possible = (F.col("root") != F.col("p.root")) & (F.least("v", "p.v") >= needed(F.col("n"), F.col("p.n")))
        if number:
            bits = apart("mark", "p.mark")
            met = placed.join(pivot, "key").filter(possible & (bits <= most(F.col("n"), F.col("p.n"))))
            star = met.groupBy("row", "p.root").agg(F.min_by("p.row", F.struct(bits, "p.row")).alias("other")).select(*pair(F.col("row"), F.col("other")))  # of a class the nearest is enough for now
        else:
            star = placed.join(pivot, "key").filter(possible).select(*pair(F.col("row"), F.col("p.row")))
        fresh = star.union(candidates.select("a", "b")).distinct() if tried is None else star.distinct().join(tried, ["a", "b"], "left_anti")
        fresh = materialize(fresh, "tried")
        tried = fresh if tried is None else tried.union(fresh)
        more = materialize(verified(fresh, items, docs, width, similarity), "links")
        root = components.roots(more) if root is None else components.extended(root, more)
        placed = materialize(keys.join(root.select(F.col("node").alias("row"), "root"), "row", "left").withColumn("root", F.coalesce("root", "row")), "placed")
        classes = placed.groupBy("key", "root").agg(F.count("*").alias("n")).groupBy("key").agg(F.sum("n").alias("all"), F.sum(F.col("n") * F.col("n")).alias("own"), F.count("*").alias("kinds"))
        every = placed
        open_keys = materialize(classes.filter("kinds > 1").select("key", "all", ((F.col("all") * F.col("all") - F.col("own")) / 2).alias("pairs")), "open")
        placed = materialize(placed.join(open_keys.select("key"), "key", "left_semi").join(marks, "row"), "placed")
        rows, pairs = open_keys.agg(F.coalesce(F.sum("all"), F.lit(0)), F.coalesce(F.sum("pairs"), F.lit(0))).first()
        discard(pivot, every, open_keys)
        # no more than another round would try, or the last one hardly merged anything
        if pairs <= 2 * rows or (before is not None and pairs > LEAST_MERGED * before):
            break
        before = pairs
    side = lambda c: placed.select("key", *(F.col(x).alias(f"{c}_{x}") for x in ("row", "n", "v", "place", "root", "mark")))
    o = needed(F.col("x_n"), F.col("y_n"))
    # what the pair can share before this shingle (none of those that no other text holds, which come first), it, and after it
    ahead = F.least(*(F.col(f"{c}_place") - F.col(f"{c}_n") + F.col(f"{c}_v") for c in "xy"))
    after = F.least(*(F.col(f"{c}_n") - F.col(f"{c}_place") for c in "xy"))
    possible = (F.least("x_v", "y_v") >= o) & (F.col("x_place") <= F.col("x_n") - o) & (F.col("y_place") <= F.col("y_n") - o) & (ahead + after >= o)
    possible &= apart("x_mark", "y_mark") <= most(F.col("x_n"), F.col("y_n"))
    rest = side("x").join(side("y"), "key").filter((F.col("x_row") < F.col("y_row")) & (F.col("x_root") != F.col("y_root")) & possible).select(*pair(F.col("x_row"), F.col("y_row"))).distinct()
    rest = materialize(rest.join(tried, ["a", "b"], "left_anti"), "rest")
    return components.extended(root, materialize(verified(rest, items, docs, width, similarity), "links"))


def near_copies(docs: DataFrame, width: int, similarity: float, part_items: int = PART_ITEMS, fan: int = bl.FAN, merge: int = bl.MERGE_ITEMS) -> DataFrame:
    """doc_id, fp (the SimHash, long), text_hash (xxhash64), component_id and kept for each row of docs (doc_id, text).

    component_id is the smallest doc_id that is reachable over pairs of at least similarity, the document's own included; kept is
    true for one row of each component, that with the smallest doc_id (of several the one with the smallest hash). Documents
    without words are copies of each other. Null doc_ids name no component (null if nothing else does) and are kept last. Rows
    that repeat a doc_id with another text have components of their own.
    """
    size, texts = docs.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    guess = (size or 0) // 6  # bytes of a word, about
    exchange = bl.Exchange(guess, max(1, math.ceil(guess / part_items)), fan, merge)
    table = shingled(docs, width, exchange.parts, fan, common_shingles(docs, texts, width))
    own = materialize(table.filter("row is not null").select("row", "doc_id", "fp", "text_hash", "digest"), "own")
    place = F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("id"), "text_hash", "row")
    sets = materialize(own.groupBy("digest").agg(F.min("row").alias("row"), F.min("doc_id").alias("least"), F.min(place).alias("first")), "sets")
    items = materialize(own.join(sets.select("row"), "row", "left_semi").select("row", "fp", "text_hash", "digest"), "items")
    marks = materialize(table.filter("row is not null").select("row", "mark").join(items.select("row"), "row", "left_semi"), "marks")
    keys = materialize(prefixes(table, exchange, similarity).join(items.select("row"), "row", "left_semi"), "prefixes")
    discard(table)
    root = links(keys, trie_candidates(items.select("row", "fp")), items.drop("fp"), marks, docs, width, similarity)
    placed = sets.join(root, sets.row == root.node, "left").select("digest", "least", "first", F.coalesce("root", "row").alias("root"))
    smallest = placed.groupBy("root").agg(F.min("least").alias("component_id"), F.min("first").alias("one"))
    classes = materialize(placed.join(smallest, "root").select("digest", "component_id", F.col("one.row").alias("one")), "classes")
    return own.join(classes, "digest").select("doc_id", "fp", "text_hash", "component_id", (F.col("row") == F.col("one")).alias("kept"))

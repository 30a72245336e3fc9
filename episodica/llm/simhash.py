"""SimHash near-duplicates by a binary-trie self-join.

A document's fingerprint has 64 bits; two fingerprints link at ``max_bits`` or fewer differing bits. The distinct fingerprints
form a binary trie that is joined with itself: two nodes of one depth are visited together, the bits in which their prefixes
differ are accumulated, and the pair is pruned once they exceed the error budget.

To spread the traversal, the trie is walked in ``rotations`` bit orders. If two fingerprints differ in k bits, then in one of m
equal parts they differ in k // m or fewer; so in each rotation the budget within the leading part is only k // m, and k below
it. For the contract's 2 bits in 3 rotations the leading 21 bits must be equal, so the upper levels need no pairs at all and
a fingerprint is shuffled three times. Nodes that hold more than ``node_items`` fingerprints are split level by level, as
distributed tables; smaller ones are walked to the leaves within a task. No pair of documents is ever formed: equal
fingerprints are one item, and a node pair yields a spanning set of its links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodica.llm import components
from episodica.llm.common import lean, materialize, prepare, text_or_empty

SEED = 42
#: Largest number of fingerprints of a trie node that one task compares with another such node.
NODE_ITEMS = 1024
#: Pairs of keys up to which two nodes are compared as one matrix instead of being walked further.
LEAF_PAIRS = 1 << 15
#: Bits by which a node that is too large is split at a time.
STRIDE = 6


def shingle_hashes(text: str, width: int) -> np.ndarray:
    """XXH64 of every run of width words (fewer words: of all of them; none: nothing), repeats included."""
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - width + 1
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[width - 1 :].tolist(), strict=True)], np.uint64)


def majority_bits(hashes: np.ndarray) -> int:
    """The number whose bits are set in more than half of the hashes; zero for none."""
    m = len(hashes)
    if not m:
        return 0
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(m, 8), axis=1, bitorder="little")
    sums = np.add.reduceat(bits, np.arange(0, m, 255), axis=0, dtype=np.uint8)  # 255 ones still fit into a byte
    return int(np.packbits(sums.sum(axis=0, dtype=np.int64) * 2 > m, bitorder="little").view("<u8")[0])


def remix(hashes: np.ndarray) -> np.ndarray:
    """A second, independent set of 64 bits from the same hashes (a finaliser of multiply and shift)."""
    x = hashes ^ (hashes >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, width: int = 3, confirm: bool = False) -> DataFrame:
    """doc_id, fp and fp2 (long) of each row of docs (doc_id, text); fp2 is a second fingerprint, or 0 without confirm.

    A-Z are lower-cased and words split at ASCII white space. A text without words has fingerprint 0; null counts as empty.
    """
    prepare(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second = [], []
            for text in batch.column(1).to_pylist():
                h = shingle_hashes(text, width)
                first.append(_signed(majority_bits(h)))
                second.append(_signed(majority_bits(remix(h))) if confirm else 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(first, pa.int64()), pa.array(second, pa.int64())], ["doc_id", "fp", "fp2"])

    return docs.select(F.col("doc_id").cast("bigint"), text_or_empty().alias("text")).mapInArrow(lean(rows), "doc_id bigint, fp bigint, fp2 bigint")


# ---- the trie within a task ------------------------------------------------------------------------------------------


def node_pairs(u: np.ndarray, v: np.ndarray, max_bits: int, lead: int, lead_bits: int, stride: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Positions i, j of u[i], v[j] (sorted uint64) that differ in max_bits bits or fewer: all that differ in lead_bits or fewer of the
    leading lead bits, and maybe others.

    The tries of u and v are walked together, stride bits at a time, and a node pair is pruned beyond the budget of its depth. Once
    the nodes of a pair hold few keys, these are compared as one small matrix.
    """
    a, b, diff = np.array([0]), np.array([0]), np.zeros(1, np.int64)
    bounds_u, bounds_v = np.array([0, len(u)]), np.array([0, len(v)])
    found_u, found_v = [a[:0]], [b[:0]]
    for depth in range(0, 65, stride):
        few = (bounds_u[a + 1] - bounds_u[a]) * (bounds_v[b + 1] - bounds_v[b]) <= (LEAF_PAIRS if depth < 64 else np.inf)
        for u0, u1, v0, v1 in zip(bounds_u[a[few]].tolist(), bounds_u[a[few] + 1].tolist(), bounds_v[b[few]].tolist(), bounds_v[b[few] + 1].tolist(), strict=True):
            near = np.bitwise_count(u[u0:u1, None] ^ v[None, v0:v1]) <= max_bits
            if near.any():
                x, y = np.nonzero(near)
                found_u.append(x + u0)
                found_v.append(y + v0)
        a, b, diff = a[~few], b[~few], diff[~few]
        if not len(a):
            break
        shift = np.uint64(64 - depth - stride)
        next_u, next_v = _bounds(u >> shift), _bounds(v >> shift)
        first_u, first_v = np.searchsorted(next_u, bounds_u), np.searchsorted(next_v, bounds_v)
        digits_u, digits_v = (((x[n[:-1]] >> shift) & np.uint64((1 << stride) - 1)).astype(np.uint8) for x, n in ((u, next_u), (v, next_v)))
        budget = lead_bits if depth + stride <= lead else max_bits
        kept = []
        for pair, x, y in _children(a, b, first_u, first_v):
            grown = diff[pair] + np.bitwise_count(digits_u[x] ^ digits_v[y])
            near = grown <= budget
            kept.append((x[near], y[near], grown[near]))
        a, b, diff = (np.concatenate(part) for part in zip(*kept, strict=True))
        bounds_u, bounds_v = next_u, next_v
    return np.concatenate(found_u), np.concatenate(found_v)


def _children(a: np.ndarray, b: np.ndarray, first_u: np.ndarray, first_v: np.ndarray, most: int = 1 << 19) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """All pairs of children of the node pairs a, b, about most of them at a time: position of the node pair, child, child."""
    nu, nv = first_u[a + 1] - first_u[a], first_v[b + 1] - first_v[b]
    total = np.cumsum(nu * nv)
    at = 0
    while at < len(a):
        upto = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + most, "right")))
        own_u, own_v = nu[at:upto], nv[at:upto]
        # a row for each child of a, then each row as often as b has children
        row = np.repeat(np.arange(at, upto), own_u)
        child = np.arange(len(row)) + np.repeat(first_u[a[at:upto]] - (np.cumsum(own_u) - own_u), own_u)
        times = nv[row]
        pair, x = np.repeat(row, times), np.repeat(child, times)
        y = np.arange(len(pair)) + np.repeat(first_v[b[row]] - (np.cumsum(times) - times), times)
        yield pair, x, y
        at = upto


def _bounds(prefixes: np.ndarray) -> np.ndarray:
    """Where the runs of equal prefixes begin, and the end."""
    return np.concatenate(([0], np.flatnonzero(prefixes[1:] != prefixes[:-1]) + 1, [len(prefixes)]))


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels after joining the ends of the links i-j: the smallest label of each class."""
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _forest(i: np.ndarray, j: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """The links of a minimum spanning forest, ties by position: in each round every class takes its lightest way out."""
    order = np.argsort(weight, kind="stable")
    label, picked = np.arange(n), []
    while True:
        order = order[label[i[order]] != label[j[order]]]
        if not len(order):
            return np.concatenate(picked) if picked else order
        rank = np.arange(len(order))
        best = np.full(n, len(order))
        np.minimum.at(best, label[i[order]], rank)
        np.minimum.at(best, label[j[order]], rank)
        own = order[np.unique(best[best < len(order)])]
        picked.append(own)
        label = _merge(label, i[own], j[own])


def _rotate(keys: np.ndarray, bits: int) -> np.ndarray:
    return keys if not bits else (keys << np.uint64(bits)) | (keys >> np.uint64(64 - bits))


def _links_of(batches: Iterator[pa.RecordBatch], max_bits: int, lead: int, lead_bits: int, confirm: bool) -> Iterator[pa.RecordBatch]:
    """Columns rot, u_fp, u_fp2, v_fp, v_fp2 (lists; v null where a node meets itself) to links a, b of fingerprints."""
    for batch in batches:
        for k in range(batch.num_rows):
            rot = batch.column(0)[k].as_py()
            lists = [None if not batch.column(c)[k].is_valid else batch.column(c)[k].values.to_numpy().view(np.uint64) for c in (1, 2, 3, 4)]
            u, u2 = lists[:2]
            v, v2 = (u, u2) if lists[2] is None else lists[2:]
            ku, kv = _rotate(u, rot), _rotate(v, rot)
            ou, ov = np.argsort(ku, kind="stable"), np.argsort(kv, kind="stable")
            i, j = node_pairs(ku[ou], kv[ov], max_bits, lead, lead_bits)
            if lists[2] is None:  # by sorted place, so that ties don't depend on the order of the list
                i, j = i[i < j], j[i < j]
            i, j = ou[i], ov[j]
            weight = np.bitwise_count(u[i] ^ v[j]).astype(np.int64)
            if confirm:
                other = np.bitwise_count(u2[i] ^ v2[j])
                near = other <= max_bits
                i, j, weight = i[near], j[near], weight[near] + other[near]
            if not len(i):
                continue
            both, inverse = np.unique(np.concatenate((u[i], v[j])), return_inverse=True)
            own = _forest(inverse[: len(i)], inverse[len(i) :], weight, len(both))
            yield pa.RecordBatch.from_arrays([pa.array(u[i][own].view(np.int64)), pa.array(v[j][own].view(np.int64))], ["a", "b"])


# ---- the trie as tables ----------------------------------------------------------------------------------------------


def _prefix(key: Column | str, depth: int) -> Column:
    return F.shiftrightunsigned(key, 64 - depth)


def links(items: DataFrame, max_bits: int, rotations: int, confirm: bool = False, depth: int | None = None, node_items: int = NODE_ITEMS) -> DataFrame:
    """Links a, b between distinct fingerprints of items (fp, fp2: one row for each fp) that connect all pairs within max_bits.

    depth is that at which the distributed walk begins; by default the leading part where that must be equal, and else where nodes
    hold half of node_items on average. A pair of nodes is walked within one task if neither holds over node_items fingerprints;
    else it is split by STRIDE bits, which ends at the latest with single fingerprints.
    """
    part = 64 // rotations
    allowed = max_bits // rotations
    if depth is None:
        depth = part if not allowed else max(4, math.ceil(math.log2(max(items.count(), 1) * 2 / node_items)))
    depth = min(depth, part)
    shifts = [r * 64 // rotations for r in range(rotations)]
    turned = F.when(F.col("rot") == 0, F.col("fp"))
    for s in shifts[1:]:
        turned = turned.when(F.col("rot") == s, F.shiftleft("fp", s).bitwiseOR(F.shiftrightunsigned("fp", 64 - s)))
    keys = items.select("fp", "fp2", F.explode(F.array(*map(F.lit, shifts))).alias("rot")).withColumn("key", turned)

    def nodes_at(at: int) -> DataFrame:
        return keys.groupBy("rot", _prefix("key", at).alias("node")).agg(F.count("*").alias("n"))

    walk = partial(_links_of, max_bits=max_bits, lead=part // 4 * 4, lead_bits=allowed, confirm=confirm)
    counts = nodes_at(depth)
    masks = [sum(1 << b for b in bits) for k in range(allowed + 1) for bits in combinations(range(depth), k)]
    if len(masks) > 1:
        near = counts.select("rot", F.col("node").alias("u"), F.col("n").alias("nu"), F.explode(F.array(*(F.lit(m).cast("bigint") for m in masks))).alias("mask"))
        pairs = near.withColumn("v", F.col("u").bitwiseXOR(F.col("mask"))).filter("u <= v").join(counts.select("rot", F.col("node").alias("v"), F.col("n").alias("nv")), ["rot", "v"])
        pairs = pairs.select("rot", "u", "nu", "v", "nv", F.bit_count("mask").alias("diff"))
    else:
        pairs = counts.select("rot", F.col("node").alias("u"), F.col("n").alias("nu"), F.col("node").alias("v"), F.col("n").alias("nv"), F.lit(0).alias("diff"))
    pairs = materialize(pairs.filter("u <> v or nu > 1"), "pairs")
    found = []
    while True:
        large = F.greatest("nu", "nv") > node_items
        small = pairs if depth >= 64 else pairs.filter(~large)
        found.append(_walk_nodes(keys, small, depth, walk))
        if depth >= 64 or pairs.filter(large).isEmpty():
            break
        deeper = min(64, depth + STRIDE)
        parents = pairs.filter(large)
        touched = parents.select("rot", F.col("u").alias("node")).union(parents.select("rot", F.col("v").alias("node"))).distinct()
        own = keys.withColumn("node", _prefix("key", depth)).join(touched, ["rot", "node"], "left_semi")
        children = materialize(own.groupBy("rot", "node", _prefix("key", deeper).alias("child")).agg(F.count("*").alias("n")), "nodes")
        budget = allowed if deeper <= part else max_bits
        grown = F.col("diff") + F.bit_count(F.col("cu").bitwiseXOR(F.col("cv")).bitwiseAND(F.lit((1 << (deeper - depth)) - 1).cast("bigint")))
        split = (
            parents.select("rot", "u", "v", "diff")
            .join(children.select("rot", F.col("node").alias("u"), F.col("child").alias("cu"), F.col("n").alias("nu")), ["rot", "u"])
            .join(children.select("rot", F.col("node").alias("v"), F.col("child").alias("cv"), F.col("n").alias("nv")), ["rot", "v"])
            .withColumn("diff", grown)
            .filter((F.col("diff") <= budget) & ((F.col("u") != F.col("v")) | (F.col("cu") <= F.col("cv"))))
            .select("rot", F.col("cu").alias("u"), "nu", F.col("cv").alias("v"), "nv", "diff")
        )
        pairs, depth = materialize(split.filter("u <> v or nu > 1"), "pairs"), deeper
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def _walk_nodes(keys: DataFrame, pairs: DataFrame, depth: int, walk) -> DataFrame:
    """The links within the node pairs (rot, u, v), whose nodes each fit into a task."""
    touched = pairs.select("rot", F.col("u").alias("node")).union(pairs.select("rot", F.col("v").alias("node"))).distinct()
    own = keys.withColumn("node", _prefix("key", depth)).join(touched, ["rot", "node"], "left_semi")
    held = own.groupBy("rot", "node").agg(F.collect_list(F.struct("fp", "fp2")).alias("held"))
    held = materialize(held.select("rot", "node", F.col("held.fp").alias("fp"), F.col("held.fp2").alias("fp2")), "held")
    held_u = held.select("rot", F.col("node").alias("u"), F.col("fp").alias("u_fp"), F.col("fp2").alias("u_fp2"))
    same = pairs.filter("u = v").select("rot", "u").join(held_u, ["rot", "u"])
    none = F.lit(None).cast("array<bigint>")
    same = same.select("rot", "u_fp", "u_fp2", none.alias("v_fp"), none.alias("v_fp2"))
    held_v = held.select("rot", F.col("node").alias("v"), F.col("fp").alias("v_fp"), F.col("fp2").alias("v_fp2"))
    other = pairs.filter("u <> v").select("rot", "u", "v").join(held_u, ["rot", "u"]).join(held_v, ["rot", "v"])
    return same.union(other.select("rot", "u_fp", "u_fp2", "v_fp", "v_fp2")).mapInArrow(lean(walk), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, width: int = 3, max_bits: int = 2, rotations: int = 3, confirm: bool = False, depth: int | None = None, node_items: int = NODE_ITEMS, similarity: float | None = None) -> DataFrame:
    """doc_id, fp (long) and component_id for each row of docs (doc_id, text).

    component_id is the smallest doc_id reachable over links, the document's own included. With confirm, a link must also hold
    between second fingerprints. Rows with equal fingerprints are linked, whatever their number; documents without words have
    fingerprint 0 and link like any other. Rows with a null doc_id are kept but name no component (null if nothing else does).
    With similarity, fingerprints link nothing: links are all pairs of at least that Jaccard similarity (``similar.near_copies``).
    """
    if similarity is not None:
        from episodica.llm import similar

        return similar.near_copies(docs, width, similarity)
    own = materialize(fingerprints(docs, width, confirm), "fingerprints")
    items = materialize(own.groupBy("fp").agg(F.min("doc_id").alias("first"), F.min_by("fp2", F.coalesce("doc_id", F.lit(2**63 - 1))).alias("fp2")), "items")
    edges = materialize(links(items, max_bits, rotations, confirm, depth, node_items), "links")
    root = components.roots(edges)
    placed = items.join(root, items.fp == root.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    linked = root.select("root").distinct()
    smallest = placed.join(linked, "root", "left_semi").groupBy("root").agg(F.min("first").alias("least"))
    classes = placed.join(smallest, "root", "left").select("fp", F.coalesce("least", "first").alias("component_id"))
    return own.select("doc_id", "fp").join(classes, "fp").select("doc_id", "fp", "component_id")


def hex16(fp: Column | str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))

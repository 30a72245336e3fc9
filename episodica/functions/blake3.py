"""BLAKE3 (the published specification), computed for all rows of a batch in lockstep with numpy."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from episodica.functions.ship import ship_package

# Fixed values of the specification.
IV = np.array([0x6A09E667, 0xBB67AE85, 0x3C6EF372, 0xA54FF53A, 0x510E527F, 0x9B05688C, 0x1F83D9AB, 0x5BE0CD19], np.uint32)
PERMUTATION = [2, 6, 3, 10, 7, 0, 4, 13, 1, 11, 12, 5, 9, 14, 15, 8]
CHUNK_START, CHUNK_END, PARENT, ROOT = 1, 2, 4, 8
CHUNK, BLOCK = 1024, 64

_COLUMNS = ((0, 4, 8, 12), (1, 5, 9, 13), (2, 6, 10, 14), (3, 7, 11, 15))
_DIAGONALS = ((0, 5, 10, 15), (1, 6, 11, 12), (2, 7, 8, 13), (3, 4, 9, 14))


def _turn(x: np.ndarray, bits: int) -> np.ndarray:
    return (x >> np.uint32(bits)) | (x << np.uint32(32 - bits))


def _compress(chain: np.ndarray, words: np.ndarray, counter: np.ndarray, length: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """The new chaining values (8, n) for chain (8, n), message words (16, n) and per-column counter, block length and flags."""
    n = chain.shape[1]
    v = np.empty((16, n), np.uint32)
    v[:8], v[8:12] = chain, IV[:4, None]
    v[12], v[13] = (counter & 0xFFFFFFFF).astype(np.uint32), (counter >> 32).astype(np.uint32)
    v[14], v[15] = length, flags
    order = list(range(16))
    for _ in range(7):
        for half, quads in enumerate((_COLUMNS, _DIAGONALS)):
            for k, (a, b, c, d) in enumerate(quads):
                for turn, word in ((16, 0), (8, 1)):
                    v[a] += v[b] + words[order[8 * half + 2 * k + word]]
                    v[d] = _turn(v[d] ^ v[a], turn)
                    v[c] += v[d]
                    v[b] = _turn(v[b] ^ v[c], 12 if turn == 16 else 7)
        order = [order[p] for p in PERMUTATION]
    return v[:8] ^ v[8:]


def digests(messages: list[bytes]) -> list[str]:
    """The hex BLAKE3 hash of each message."""
    counts = np.array([max(1, -(-len(m) // CHUNK)) for m in messages], np.int64)
    if not len(counts):
        return []
    owner = np.repeat(np.arange(len(messages)), counts)
    first = np.cumsum(counts) - counts
    number = np.arange(len(owner)) - first[owner]
    lengths = np.minimum(np.array([len(m) for m in messages], np.int64)[owner] - number * CHUNK, CHUNK)
    data = np.zeros((len(owner), CHUNK), np.uint8)
    for row, (m, k) in enumerate(zip(owner.tolist(), number.tolist(), strict=True)):
        part = np.frombuffer(messages[m], np.uint8, count=max(0, int(lengths[row])), offset=k * CHUNK if lengths[row] > 0 else 0)
        data[row, : len(part)] = part
    words = np.ascontiguousarray(data).view("<u4").reshape(len(owner), 16, 16)
    blocks = np.maximum(1, -(-lengths // BLOCK))
    alone = counts[owner] == 1
    chain = np.repeat(IV[:, None], len(owner), axis=1)
    for b in range(int(blocks.max())):
        own = np.flatnonzero(blocks > b)
        last = blocks[own] == b + 1
        flags = np.where(b == 0, CHUNK_START, 0) + np.where(last, CHUNK_END, 0) + np.where(last & alone[own], ROOT, 0)
        size = np.minimum(np.maximum(lengths[own] - b * BLOCK, 0), BLOCK)
        chain[:, own] = _compress(chain[:, own], words[own, b, :].T, number[own].astype(np.uint64), size.astype(np.uint32), flags.astype(np.uint32))
    # pairs of neighbours merge level by level; an odd last node moves up, which gives the specified left-full tree
    while (counts > 1).any():
        first = np.cumsum(counts) - counts
        place = np.arange(chain.shape[1]) - np.repeat(first, counts)
        size = np.repeat(counts, counts)
        left = np.flatnonzero((place % 2 == 0) & (place + 1 < size))
        carried = (place % 2 == 0) & (place + 1 == size)
        merged = np.concatenate((chain[:, left], chain[:, left + 1]))
        flags = PARENT + np.where(size[left] == 2, ROOT, 0)
        new = _compress(np.repeat(IV[:, None], len(left), axis=1), merged, np.zeros(len(left), np.uint64), np.full(len(left), BLOCK, np.uint32), flags.astype(np.uint32))
        keep = np.flatnonzero((place % 2 == 0))
        up = chain[:, keep].copy()
        up[:, ~carried[keep]] = new
        chain, counts = up, -(-counts // 2)
    raw = np.ascontiguousarray(chain.T.astype("<u4")).view(np.uint8)
    return [row.tobytes().hex() for row in raw]


@F.pandas_udf(StringType())
def _blake3_udf(texts: pd.Series) -> pd.Series:
    out = []
    for at in range(0, len(texts), 512):
        part = texts.iloc[at : at + 512]
        out += digests([b"" if t is None else t.encode() for t in part])
    return pd.Series(out, index=texts.index).where(texts.notna(), None)


def content_digest(text: Column, profile: str = "blake3") -> Column:
    """Hex digest of a text. blake3 matches published ids; sha256 stays in the JVM and is the profile of the SQL checks."""
    if profile == "sha256":
        return F.sha2(text, 256)
    if profile == "blake3":
        ship_package(SparkSession.active())
        return _blake3_udf(text)
    raise ValueError(f"unknown hash profile: {profile}")


def first_byte(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 2), 16, 10).cast("int")

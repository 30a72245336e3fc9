"""Exact top-k search by inner product with block-at-a-time pruning.

Vectors are dealt out by ranges of vec_id into shards. Within a shard rows are put in order by halving along main axes, so that
neighbours are alike, and cut into blocks of BLOCK_ROWS. A block keeps a forward index (its rows' components) and, for each term
(dimension), the largest and least component. A query's bound for a block is the sum over its terms of the larger of query x
maximum and query x minimum. Blocks are visited in order of their bounds and scored through the forward index, until the best bound
left is below the query's k-th score; equal scores must still be seen, as ties go to the smaller vec_id. Every query first meets a
sample of at most FLOOR_ROWS rows, whose k-th score is a floor for its k-th score in every shard: a shard is scored only where bounds
reach the floor, and returns only rows that do. Queries travel in groups to the shards (each group meets each shard once); a window
merges what they return.

How much is pruned depends on the vectors: where they gather around centres most blocks are; where they are spread evenly in all
directions (as random ones are) every bound stays above the k-th score, and all rows are scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from episodica.llm.common import lean, materialize, prepare

BLOCK_ROWS = 64
SHARD_ROWS = 8192
GROUP_QUERIES = 512
#: Blocks that a query group scores between two looks at the bounds.
STEP = 4
#: Rows of the sample that gives the floors, at most, and their share of all rows at most.
FLOOR_ROWS, FLOOR_SHARE = 16384, 1 / 16

LIST = "ids binary, dims binary, data binary"


def usable(vector: Column) -> Column:
    """Whether a vector is neither null nor holds null, NaN or infinite components."""
    return vector.isNotNull() & F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))), F.lit(False))


def integers(values: np.ndarray, scale: int = 1024) -> np.ndarray:
    """floor(scale * x) as whole float64 numbers."""
    return np.floor(values.astype(np.float64) * scale)


def _lists(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """vec_id, vector to packed lists of at most rows vectors in the order of vec_id."""
    ids: list[np.ndarray] = []
    dims: list[np.ndarray] = []
    data: list[np.ndarray] = []
    held = 0

    def close():
        i, d, x = np.concatenate(ids), np.concatenate(dims), np.concatenate(data)
        return pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (i, d, x)], ["ids", "dims", "data"])

    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            lists = part.column(1)
            ids.append(part.column(0).to_numpy().astype("<i8"))
            dims.append(np.asarray(lists.value_lengths()).astype("<i4"))
            data.append(lists.flatten().to_numpy().astype("<f8"))
            held += part.num_rows
            if held >= rows:
                yield close()
                ids, dims, data, held = [], [], [], 0
    if held:
        yield close()


def _matrix(ids: bytes, dims: bytes, data: bytes, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and components, shorter vectors padded by zeros."""
    i, d, x = np.frombuffer(ids, "<i8"), np.frombuffer(dims, "<i4").astype(np.int64), integers(np.frombuffer(data, "<f8"), scale)
    out = np.zeros((len(i), int(d.max(initial=0))))
    rows = np.repeat(np.arange(len(i)), d)
    out[rows, np.arange(len(x)) - np.repeat(np.cumsum(d) - d, d)] = x
    return i, out


def _exact(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether all inner products, and their partial sums, are whole numbers below 2**53."""
    return float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1) < 2**53


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T as longs; beyond 2**53 in exact integers, beyond a long at its limits."""
    if _exact(a, b):
        return (a @ b.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in row] for row in m], object).reshape(m.shape)
    return np.clip(whole(a) @ whole(b).T, -(2**63), 2**63 - 1).astype(np.int64)


def alike(x: np.ndarray, rows: int) -> np.ndarray:
    """An order of the rows of x that puts similar ones together: halves along the axis of widest spread, down to rows."""
    order, todo = np.arange(len(x)), [(0, len(x))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo <= rows:
            continue
        own = x[order[lo:hi]] - x[order[lo:hi]].mean(axis=0)
        axis = own[np.abs(own).sum(axis=1).argmax()]
        for _ in range(3):  # towards the main axis
            axis = own.T @ (own @ axis)
            axis /= max(float(np.abs(axis).max()), 1e-300)
        order[lo:hi] = order[lo:hi][np.argsort(own @ axis, kind="stable")]
        half = lo + max(rows, (hi - lo) // 2 // rows * rows)
        todo += [(lo, half), (half, hi)]
    return order


def search_shard(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int, block_rows: int = BLOCK_ROWS, floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The k best of x for each query as (query position, id, score), and how many rows were scored for a query, in all. With floor,
    scores below a query's floor are left out."""
    width = max(q.shape[1], x.shape[1])
    q, x = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (q, x))
    order = alike(x, block_rows)
    ids, x = ids[order], x[order]
    cuts = np.arange(0, len(ids), block_rows)
    high, low = np.maximum.reduceat(x, cuts, axis=0), np.minimum.reduceat(x, cuts, axis=0)
    pos, neg = np.maximum(q, 0), np.minimum(q, 0)
    bound = pos @ high.T + neg @ low.T
    if not _exact(q, x):
        bound = bound + np.abs(bound) * 1e-9 + 1  # rounding must not lower a bound
    ranked = np.argsort(-bound, axis=1, kind="stable")
    n = len(q_ids)
    best = np.full((n, k), np.iinfo(np.int64).min)
    best_id = np.full((n, k), np.iinfo(np.int64).max)
    filled = np.zeros((n, k), bool)
    active, scored = np.arange(n), 0
    floor = np.full(n, np.iinfo(np.int64).min) if floor is None else floor
    for at in range(0, len(cuts), STEP):
        # a block can matter while its bound reaches the floor and the k-th score, or while there are fewer than k
        top = bound[active, ranked[active, at]]
        active = active[(top >= floor[active]) & (~filled[active, -1] | (top >= best[active, -1]))]
        if not len(active):
            break
        wanted = ranked[active, at : at + STEP]
        for block in np.unique(wanted):
            own = active[(wanted == block).any(axis=1)]
            lo, hi = cuts[block], min(cuts[block] + block_rows, len(ids))
            got = _product(q[own], x[lo:hi])
            scored += got.size
            ok = ids[lo:hi][None, :] != q_ids[own][:, None]
            s = np.concatenate((best[own], got), axis=1)
            i = np.concatenate((best_id[own], np.broadcast_to(ids[lo:hi], got.shape)), axis=1)
            f = np.concatenate((filled[own], ok), axis=1)
            pick = np.lexsort((i, -s.astype(np.float64) if s.size and np.abs(s).max() < 2**53 else ~s, ~f), axis=1)[:, :k]
            best[own], best_id[own], filled[own] = (np.take_along_axis(m, pick, 1) for m in (s, i, f))
    row, col = np.nonzero(filled & (best >= floor[:, None]))
    return row, best_id[row, col], best[row, col], scored


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, scale: int = 1024, shard_rows: int = SHARD_ROWS, group_queries: int = GROUP_QUERIES) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row of queries its k best rows of vectors (both vec_id, embedding).

    Components count as floor(scale * x). Ties go to the smaller vec_id; a query's own vec_id is no candidate. Null vectors, and
    those with null or non-finite components, take no part; neither do null vec_ids. Shorter vectors are padded by zeros. Rows that
    repeat a vec_id are separate candidates, and a repeated query is answered once.
    """
    spark = vectors.sparkSession
    prepare(spark)
    plain = lambda df: df.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>").alias("embedding")).filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    corpus = plain(vectors)
    n = corpus.count()
    shards_wanted = max(1, -(-n // shard_rows))
    ranged = corpus.repartitionByRange(shards_wanted, "vec_id").sortWithinPartitions("vec_id")
    numbered = ranged.mapInArrow(lean(lambda b: _lists(b, shard_rows)), LIST).withColumn("lane", F.spark_partition_id())
    shards = materialize(numbered, "shards")
    last = shards.agg(F.max("lane")).first()[0]
    sample = spark.sparkContext.broadcast(floor_sample(corpus, n))
    # each query group goes to every shard: a pair of group and shard meets exactly once
    asked = plain(queries).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    groups_wanted = max(1, -(-asked.count() // group_queries))

    def with_floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _lists(batches, group_queries):
            q_ids, q = _matrix(*(batch.column(c)[0].as_py() for c in range(3)), scale)
            low = np.full(len(q_ids), np.iinfo(np.int64).min)
            s_ids, s_dims, s_data = sample.value
            if len(s_ids):
                row, _, score, _ = search_shard(q_ids, q, *_matrix(s_ids, s_dims, s_data, scale), k)
                full = np.bincount(row, minlength=len(q_ids)) == k
                worst = np.full(len(q_ids), np.iinfo(np.int64).max)
                np.minimum.at(worst, row, score)
                low[full] = worst[full]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([low.tobytes()], pa.binary())], [*batch.schema.names, "floor"])

    groups = asked.repartition(groups_wanted, "vec_id").mapInArrow(lean(with_floors), f"{LIST}, floor binary")
    groups = groups.select(*(F.col(c).alias(f"q_{c}") for c in ("ids", "dims", "data")), "floor", F.explode(F.sequence(F.lit(0), F.lit(last or 0))).alias("lane"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                q_ids, q = _matrix(*(batch.column(c)[i].as_py() for c in range(3)), scale)
                ids, x = _matrix(*(batch.column(c)[i].as_py() for c in range(4, 7)), scale)
                row, found, score, _ = search_shard(q_ids, q, ids, x, k, floor=np.frombuffer(batch.column(3)[i].as_py(), np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[row]), pa.array(found), pa.array(score)], ["query_id", "vec_id", "score"])

    met = groups.join(shards, "lane").select("q_ids", "q_dims", "q_data", "floor", "ids", "dims", "data")
    found = met.mapInArrow(lean(rows), "query_id bigint, vec_id bigint, score bigint")
    best = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", best).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def floor_sample(corpus: DataFrame, n: int) -> tuple[bytes, bytes, bytes]:
    """A packed list of about FLOOR_ROWS rows of corpus at most, by the hash of vec_id. It only sets floors, so any rows would do; the
    rows are candidates of the search themselves, so each query's k best are at least as good."""
    every = max(round(1 / FLOOR_SHARE), -(-n // FLOOR_ROWS))
    found = corpus.filter(F.pmod(F.xxhash64("vec_id", F.lit("floor")), F.lit(every)) == 0).limit(2 * FLOOR_ROWS).toArrow()
    packed = list(_lists(iter(found.combine_chunks().to_batches()), len(found) + 1)) if len(found) else []
    return tuple(packed[0].column(c)[0].as_py() for c in range(3)) if packed else (b"", b"", b"")

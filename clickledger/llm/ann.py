"""Nearest neighbours by randomly rotated one-bit codes with error bounds and exact reranking."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickledger.llm.common import stage

#: Vectors, those with the least id hash, whose mean is the centre that codes are taken around.
SAMPLE = 10_000
#: A block of queries holds at most so many, a slice of the index so many vectors, and each so many bytes of
#: vectors (or one longer vector): what a task holds of either side at once.
QUERY_BLOCK, INDEX_SLICE, BLOCK_BYTES = 4096, 8192, 4 << 20
#: Blocks of queries that a task keeps the nearest of while it goes through its part of the index.
BLOCKS_A_TASK = 16
#: Queries compared at once inside a task.
_TOGETHER = 256
#: Deviations of the estimate that the error bound allows for.
EPSILON = 3.0


@lru_cache(maxsize=4)
def rotation(size: int, seed: int = 5) -> np.ndarray:
    """A random orthogonal matrix, the same on every machine up to rounding."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, size)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits of the rotated unit residuals, residual norms, and correction scalars.

    The correction is the inner product of a unit residual with its code vector (signs over the root of
    the size); dividing an estimate by it makes it unbiased.
    """
    residual = vectors - centre
    norm = np.linalg.norm(residual, axis=1)
    unit = (residual / np.maximum(norm, 1e-300)[:, None]) @ rotation(vectors.shape[1])
    correction = np.abs(unit).sum(axis=1) / np.sqrt(vectors.shape[1])
    return np.packbits(unit > 0, axis=1), norm, np.where(norm > 0, correction, 1.0)


def bounds(
    codes: np.ndarray, norm: np.ndarray, correction: np.ndarray, queries: np.ndarray, centre: np.ndarray, epsilon: float = EPSILON
) -> tuple[np.ndarray, np.ndarray]:
    """Estimated squared distances of all codes to all queries, and their lower bounds."""
    size = queries.shape[1]
    residual = queries - centre
    query_norm = np.linalg.norm(residual, axis=1)
    turned = (residual / np.maximum(query_norm, 1e-300)[:, None]) @ rotation(size)
    signs = np.unpackbits(codes, axis=1, count=size).astype(np.float32) * 2 - 1
    product = (signs @ turned.T.astype(np.float32)).astype(np.float64) / np.sqrt(size) / correction[:, None]
    error = epsilon * np.sqrt(np.maximum(1 - correction**2, 0)) / correction / np.sqrt(max(size - 1, 1))
    scale = 2 * norm[:, None] * query_norm[None, :]
    squares = norm[:, None] ** 2 + query_norm[None, :] ** 2
    return squares - scale * product, squares - scale * np.minimum(product + error[:, None], 1.0)


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding`` of the vectors that take part: named, not null or zero, all components finite."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    narrow = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return narrow.filter("vec_id IS NOT NULL AND embedding IS NOT NULL").filter(finite & F.exists("embedding", lambda x: x != 0))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def centres(vectors: DataFrame, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """The mean of a bounded sample for each size of vector; sizes outside it have the centre 0."""
    chosen = vectors.select("vec_id", "embedding").orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toArrow()
    rows = sorted(zip(chosen["vec_id"].to_pylist(), chosen["embedding"].to_pylist()))
    by_size: dict[int, list] = {}
    for _, v in rows:
        by_size.setdefault(len(v), []).append(v)
    return {size: np.mean(np.array(v), axis=0) for size, v in by_size.items()}


_SLICE = ["size", "ids", "vectors", "codes", "norms", "corrections"]


def build_index(vectors: DataFrame, middle: dict[int, np.ndarray]) -> DataFrame:
    """Every usable vector with its code, norm and correction, in slices: a row has packed arrays of one size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, part in _by_size(batch):
                step = max(1, min(INDEX_SLICE, BLOCK_BYTES // (8 * size)))
                for low in range(0, part.num_rows, step):
                    rows = part.slice(low, step)
                    ids, vectors = rows.column("vec_id").to_numpy(), _matrix(rows.column("embedding"), size)
                    arrays = [ids, vectors, *encode(vectors, middle.get(size, np.zeros(size)))]
                    packed = [pa.array([x.tobytes()], pa.binary()) for x in arrays]
                    yield pa.RecordBatch.from_arrays([pa.array([size], pa.int32()), *packed], _SLICE)

    return usable(vectors).mapInArrow(run, "size int, " + ", ".join(f"{c} binary" for c in _SLICE[1:]))


def query_blocks(queries: DataFrame) -> DataFrame:
    """``block, asked_size, asked``: queries of one size in lists of bounded length."""
    size = F.size("embedding")
    buckets = max(1, -(-queries.count() // QUERY_BLOCK))
    named = queries.select("vec_id", "embedding", size.alias("asked_size"), F.pmod(F.xxhash64("vec_id"), F.lit(buckets)).alias("bucket"))
    order = F.row_number().over(Window.partitionBy("asked_size", "bucket").orderBy("vec_id")) - 1
    most = F.greatest(F.lit(1), F.least(F.lit(QUERY_BLOCK), F.floor(F.lit(BLOCK_BYTES) / (8 * F.col("asked_size")))))
    named = named.withColumn("part", F.floor(order / most))
    blocks = named.groupBy("asked_size", "bucket", "part").agg(F.collect_list(F.struct("vec_id", "embedding")).alias("asked"))
    return blocks.select(F.concat_ws("-", "asked_size", "bucket", "part").alias("block"), "asked_size", "asked")


def _by_size(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    sizes = pa.compute.list_value_length(batch.column("embedding")).to_numpy(zero_copy_only=False)
    for size in np.unique(sizes):
        yield int(size), batch.filter(pa.array(sizes == size))


class Nearest:
    """The k nearest candidates so far of each query of one size, equal distances by smaller id."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.found = [(np.empty(0), np.empty(0, np.int64))] * len(ids)

    def offer(
        self, ids: np.ndarray, vectors: np.ndarray, codes: np.ndarray, norm: np.ndarray, correction: np.ndarray, centre: np.ndarray, epsilon: float
    ) -> None:
        for low in range(0, len(self.ids), _TOGETHER):
            block = slice(low, low + _TOGETHER)
            estimate, least = bounds(codes, norm, correction, self.vectors[block], centre, epsilon)
            for j in range(estimate.shape[1]):
                self._one(low + j, ids, vectors, estimate[:, j], least[:, j])

    def _one(self, q: int, ids: np.ndarray, vectors: np.ndarray, estimate: np.ndarray, least: np.ndarray) -> None:
        best, held = self.found[q]
        if len(best) < self.k:  # the likeliest give a first threshold
            at = np.flatnonzero(ids != self.ids[q])
            at = at[np.argpartition(estimate[at], self.k)[: self.k]] if len(at) > self.k else at
            best, held = self._merge(q, best, held, ids[at], vectors[at])
        limit = best[self.k - 1] ** 2 if len(best) >= self.k else np.inf
        at = np.flatnonzero((least <= limit * (1 + 1e-9) + 1e-12) & (ids != self.ids[q]))
        self.found[q] = self._merge(q, best, held, ids[at], vectors[at])

    def _merge(self, q: int, best: np.ndarray, held: np.ndarray, ids: np.ndarray, vectors: np.ndarray):
        if not len(ids):
            return best, held
        exact = np.sqrt(((vectors - self.vectors[q]) ** 2).sum(axis=1))
        score, names = np.concatenate([best, exact]), np.concatenate([held, ids])
        order = np.lexsort((names, score))
        names, score = names[order], score[order]
        fresh = np.sort(np.unique(names, return_index=True)[1])[: self.k]
        return score[fresh], names[fresh]


def search(index: DataFrame, queries: DataFrame, middle: dict[int, np.ndarray], k: int = 10, epsilon: float = EPSILON) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k nearest in the index but itself, nearest first.

    ``index`` is that of ``build_index``, written to a table. All blocks of queries meet all slices of the
    index in one job, whose tasks are parts of the index times groups of BLOCKS_A_TASK blocks; nothing is
    shuffled but the queries and each task's k nearest of a query. The work is queries times vectors, mostly
    on one-bit codes. A vector is reranked by its exact Euclidean distance, in double precision, where the
    lower bound of its estimate does not exceed the k-th distance so far. Only vectors of a query's own size
    are its candidates; with fewer than k all are returned. Ids are unique; rows that share one count once,
    with the smaller distance.
    """
    blocks = stage(query_blocks(queries), "queries")
    blocks = blocks.repartition(max(1, -(-blocks.count() // BLOCKS_A_TASK)))
    # The blocks are held by a task, the slices stream past them; other join forms would sort by size.
    pairs = index.join(blocks.hint("shuffle_replicate_nl"), F.col("size") == F.col("asked_size"))
    near = pairs.select(*_SLICE, "block", "asked").mapInArrow(_nearest_of(middle, k, epsilon), "query_id long, vec_id long, score double")
    near = near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return near.select("query_id", rank.alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)


def _nearest_of(middle: dict[int, np.ndarray], k: int, epsilon: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest: dict[str, Nearest] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                size, block = batch.column("size")[row].as_py(), batch.column("block")[row].as_py()
                if block not in nearest:
                    asked = batch.column("asked")[row].values
                    nearest[block] = Nearest(asked.field("vec_id").to_numpy(), _matrix(asked.field("embedding"), size), k)
                ids, vectors, codes, norm, correction = (
                    np.frombuffer(batch.column(c)[row].as_buffer(), kind)
                    for c, kind in zip(_SLICE[1:], (np.int64, np.float64, np.uint8, np.float64, np.float64))
                )
                n, centre = len(ids), middle.get(size, np.zeros(size))
                nearest[block].offer(ids, vectors.reshape(n, size), codes.reshape(n, -1), norm, correction, centre, epsilon)
        for some in nearest.values():
            count = [len(names) for _, names in some.found]
            if sum(count):
                columns = [np.repeat(some.ids, count), np.concatenate([n for _, n in some.found]), np.concatenate([s for s, _ in some.found])]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "vec_id", "score"])

    return run


def nearest_neighbours(vectors: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """Neighbours of the vectors whose id is divisible by ``every`` among all vectors.

    Vectors that are null, zero, unnamed or hold null or non-finite components take no part, as queries
    or as candidates. Columns other than vec_id and embedding are ignored; an empty table gives no rows.
    """
    taking_part = usable(vectors)
    middle = centres(taking_part)
    index = stage(build_index(vectors, middle), "index")
    return search(index, taking_part.filter(F.col("vec_id") % every == 0), middle, k)

"""Nearest neighbours by inner product from one-bit codes of randomly rotated vectors.

Every vector is taken relative to the mean of all, scaled to length 1 and rotated at random, ``CODES``
times; a code is one sign bit for each dimension, packed, with the length before scaling and the inner
product of code and vector, which corrects the estimate. A query is compared with codes first, by the mean
of their estimates, whose error falls with the root of their number. It has a bound that fails with a
probability set by ``EPSILON``. The k likeliest vectors of a block are compared exactly first, in double precision
on the original numbers; then all others whose upper bound reaches the least of these.

Vectors that are null, zero, of another length than most, or hold a null or a non-finite number take
no part, neither as queries nor as candidates. A query's own row (equal vec_id) is no candidate. Rows
that repeat a vec_id are rows of their own. Ties go to the smaller vec_id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

EPSILON = 4.0
CODES = 4
QUERY_BLOCK = 512
VECTOR_BLOCK = 8192
MOST_TASKS = 20_000
SEED = 11
FOUND = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector, as doubles, of the rows that take part."""
    vectors = vectors.select("vec_id", F.col("vector").cast("array<double>").alias("vector")).filter(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists("vector", lambda x: x != 0))
    return vectors


def rotation(dimensions: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dimensions, dimensions)))
    return q * np.sign(np.diag(r))


class Codes:
    """Packed codes and correction numbers of a block of vectors, a code for each rotation in ``turns``."""

    def __init__(self, vectors: np.ndarray, mean: np.ndarray, turns: np.ndarray):
        count, dimensions = len(turns), vectors.shape[1]
        rest = vectors - mean
        self.lengths = np.linalg.norm(rest, axis=1)
        unit = rest / np.maximum(self.lengths, 1e-300)[:, None]
        turned = (unit @ turns.reshape(-1, dimensions).T).reshape(len(vectors), count, dimensions)
        self.packed = np.packbits(turned >= 0, axis=2)
        self.agree = np.maximum(np.abs(turned).sum(axis=2) / np.sqrt(dimensions), 1e-12)

    def signs(self, dimensions: int) -> np.ndarray:
        """The codes as numbers whose product with a turned query estimates an inner product: the mean of
        the estimates of all codes."""
        scale = np.where(self.lengths[:, None] > 0, self.lengths[:, None] / self.agree, 0) / np.sqrt(dimensions)
        signs = np.unpackbits(self.packed, axis=2, count=dimensions).astype(np.float32) * 2 - 1
        signs *= (scale / self.agree.shape[1]).astype(np.float32)[:, :, None]
        return signs.reshape(len(self.lengths), -1)

    def spread(self, dimensions: int, epsilon: float) -> np.ndarray:
        """How far off the estimates may be, for a query of length 1. Errors of codes are independent."""
        each = np.maximum(1 - self.agree ** 2, 0) / self.agree ** 2
        return self.lengths * (epsilon * np.sqrt(each.sum(axis=1)) / each.shape[1] / np.sqrt(max(dimensions - 1, 1)) + 1e-5)


def exact(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products summed from first to last, so that a score does not depend on who adds it up."""
    return np.cumsum(vectors * query, axis=1)[:, -1]


def search(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int,
           mean: np.ndarray, turns: np.ndarray, epsilon: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each query its k best of this block: positions of queries, vec_ids and exact scores."""
    dimensions = vectors.shape[1]
    codes = Codes(vectors, mean, turns)
    signs, spread = codes.signs(dimensions), codes.spread(dimensions, epsilon).astype(np.float32)
    longest = np.linalg.norm(vectors, axis=1).max()
    out = []
    for a in range(0, len(queries), 128):
        part, own = queries[a:a + 128], query_ids[a:a + 128]
        size = np.linalg.norm(part, axis=1)
        estimate = (part @ turns.reshape(-1, dimensions).T).astype(np.float32) @ signs.T
        estimate += (part @ mean).astype(np.float32)[:, None]
        same = own[:, None] == ids[None, :]
        estimate[same] = -np.inf
        if len(ids) > k:
            likely = np.argpartition(estimate, len(ids) - k, axis=1)[:, len(ids) - k:]
            there = np.take_along_axis(estimate, likely, axis=1) > -np.inf
            scores = np.einsum("ij,ikj->ik", part, vectors[likely])
            least = np.where(there, scores, -np.inf).min(axis=1)
            estimate += size[:, None].astype(np.float32) * spread[None, :]
            near = (estimate >= least[:, None].astype(np.float32)) & ~same
        else:
            near = ~same
        for i, mine in enumerate(near):
            column = np.flatnonzero(mine)
            if len(column) > k:  # by a fast sum first, with more than its error
                quick = vectors[column] @ part[i]
                least = np.partition(quick, len(column) - k)[len(column) - k]
                column = column[quick >= least - 1e-9 * max(size[i] * longest, 1e-300)]
            score = exact(vectors[column], part[i])
            best = np.lexsort((ids[column], -score))[:k]
            out.append((np.full(len(best), a + i), ids[column[best]], score[best]))
    return tuple(np.concatenate(x) for x in zip(*out))


def nearest(queries: DataFrame, vectors: DataFrame, k: int = 20, epsilon: float = EPSILON, seed: int = SEED) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest of ``vectors`` (vec_id, vector) for each row
    of ``queries``, which has the same columns.

    Both sides are cut into blocks of rows, and each block of queries meets each block of vectors in a
    task of its own, so that a task's memory does not depend on the number of rows. The driver gets the
    mean and the most frequent length alone.
    """
    vectors, queries = usable(vectors), usable(queries)
    sizes = vectors.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    empty = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if sizes is None:
        return empty
    dimensions, rows = sizes["n"], sizes["count"]
    vectors, queries = (x.filter(F.size("vector") == dimensions) for x in (vectors, queries))
    mean = np.array(vectors.select([F.avg(F.col("vector")[i]) for i in range(dimensions)]).first(), float)
    turns = np.stack([rotation(dimensions, seed + i) for i in range(CODES)])
    asked = queries.count()
    many, few = -(-rows // VECTOR_BLOCK), max(1, -(-asked // QUERY_BLOCK))
    tasks = min(2 * many * few, MOST_TASKS)
    numbered = lambda n, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("int")
    left = queries.select(
        numbered(few, 1).alias("q"), F.explode(F.sequence(F.lit(0), F.lit(many - 1))).alias("v"), "vec_id", "vector")
    right = vectors.select(
        numbered(many, 2).alias("v"), F.explode(F.sequence(F.lit(0), F.lit(few - 1))).alias("q"), "vec_id", "vector")

    def block(asked: pa.Table, there: pa.Table) -> pa.Table:
        query_ids, q = arrays(asked)
        ids, v = arrays(there)
        if not len(query_ids) or not len(ids):
            return pa.table({n: pa.array([], t) for n, t in (
                ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()))})
        row, found, score = search(ids, v, query_ids, q, k, mean, turns, epsilon)
        return pa.table({"query_id": query_ids[row], "vec_id": found, "score": score})

    def arrays(table: pa.Table):
        table = table.combine_chunks()
        vector = table.column("vector").combine_chunks()
        flat = vector.flatten().to_numpy(zero_copy_only=False)
        return table.column("vec_id").to_numpy().astype(np.int64), flat.reshape(-1, dimensions)

    # Few bytes, much work: a stated number of partitions is not made smaller for small tables.
    left, right = (x.repartition(tasks, "q", "v") for x in (left, right))
    found = left.groupBy("q", "v").cogroup(right.groupBy("q", "v")).applyInArrow(block, FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")

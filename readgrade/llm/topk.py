"""Exact top-k search by the threshold algorithm over sorted lists of each dimension.

A cell sorts its shard once by every dimension. For a query the lists are read from the end where the component helps its sign,
in rounds of doubling depth; every row met is scored whole. What is left unseen can reach at most the sum over the dimensions of
query component times the value at the depth reached. Reading stops as soon as that bound is below the kth result, strictly, as an
equal score may still win by a smaller id. A first shard is searched alone: the kth score there is a bound from which the
other shards start, so most of their lists are left early where the data allow it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from readgrade.llm.common import stored, table
from readgrade.llm.vectors import BLOCK_ROWS, SHARD_ROWS, both, in_cells, integer_rows, numbers, part_of, parts

DEPTH = 16
FOUND = "q_row long, q_id long, id long, row long, score long"


class Lists:
    """The rows of a shard, sorted by each dimension."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        self.x, self.ids, self.rows = x, ids, rows
        self.order = np.ascontiguousarray(np.argsort(x, axis=0, kind="stable").T.astype(np.int32))
        self.values = np.take_along_axis(x.T, self.order, axis=1)

    def _rounds(self, q: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
        """Rows at the next depths of the lists, and the most that a row not yet met can score."""
        n, up, down = len(self.x), np.flatnonzero(q > 0), np.flatnonzero(q < 0)
        begin, size = 0, DEPTH
        while begin < n and len(up) + len(down):
            end = min(n, begin + size)
            yield (np.concatenate((self.order[up, n - end:n - begin].ravel(), self.order[down, begin:end].ravel())),
                   q[up] @ self.values[up, n - end] + q[down] @ self.values[down, end - 1])
            begin, size = end, 2 * size
        if not begin and n:  # all scores are zero, no list tells them apart
            yield np.arange(n), 0

    def best(self, q: np.ndarray, own: int, k: int, floor: float = -np.inf) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the ``k`` best rows, ties to the smaller id; rows below ``floor`` may be left out."""
        seen, top, scores, limit = self.rows == own, np.empty(0, np.int64), np.empty(0, self.x.dtype), floor
        for met, bound in self._rounds(q):
            new = np.zeros(len(seen), bool)
            new[met] = True
            new &= ~seen
            seen |= new
            at = np.flatnonzero(new)
            s = self.x[at] @ q
            good = s >= limit
            top, scores = np.concatenate((top, at[good])), np.concatenate((scores, s[good]))
            if len(top) > k:
                first = np.lexsort((self.rows[top], self.ids[top], -scores))[:k]
                top, scores = top[first], scores[first]
            if len(top) == k:
                limit = max(floor, scores.min())
            if bound < limit or seen.all():
                break
        return top, scores


def _search(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[np.empty(0, np.int64)] for _ in range(5)]
        if left.num_rows and right.num_rows:
            x, q = both(left, right)
            ids, rows = numbers(left["id"]), numbers(left["row"])
            lists = Lists(x, ids, rows)
            q_rows, q_ids, floors = numbers(right["row"]), numbers(right["id"]), right["floor"].to_pylist()
            for j, floor in enumerate(floors):
                top, scores = lists.best(q[j], q_rows[j], k, -np.inf if floor is None else floor)
                same = np.ones(len(top), np.int64)
                for column, new in zip(out, (same * q_rows[j], same * q_ids[j], ids[top], rows[top], scores.astype(np.int64))):
                    column.append(new)
        q_row, q_id, id, row, score = map(np.concatenate, out)
        none = pa.array(id, mask=id == np.iinfo(np.int64).max) if len(id) else pa.array(id)
        return pa.table([q_row, q_id, none, row, score], names=["q_row", "q_id", "id", "row", "score"])
    return run


def search(rows: DataFrame, queries: DataFrame, k: int, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(q_row, q_id, rank, id, score) over stored rows (row, id, v); a query does not find its own row."""
    shards = parts(rows, shard_rows)
    dealt = rows.select("row", "id", "v", part_of(shards).alias("shard"))
    queries = queries.select("row", "id", "v")
    no_floor = queries.withColumn("floor", F.lit(None).cast("long"))
    found = stored(in_cells(dealt.where("shard = 0"), [0], no_floor, _search(k), FOUND, block_rows), "first-shard")
    if shards > 1:
        floors = found.groupBy(F.col("q_row").alias("row")).agg(
            F.when(F.count("*") >= k, F.min("score")).alias("floor"))
        seeded = stored(queries.join(floors, "row", "left"), "seeded-queries")
        found = found.unionByName(
            in_cells(dealt.where("shard > 0"), list(range(1, shards)), seeded, _search(k), FOUND, block_rows))
    order = Window.partitionBy("q_row").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("row")


def top_k(df: DataFrame, k: int = 5, every: int = 50, id: str = "vec_id", vector: str = "embedding",
          shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest integer inner products of every row whose id is divisible by ``every``.

    Vectors that are null or hold null or non-finite components take no part; an empty vector scores 0 with all, shorter vectors
    count as ending in zeros. Equal scores go by the smaller id, a null id last (it is found, but asks nothing). Rows of one id are
    rows of their own: each is a query where its id is, and finds the others. Fewer than ``k`` other rows: all of them. An empty
    table has no result. Other columns, whatever their names, are not looked at. Products must fit in a long.
    """
    rows = integer_rows(df.select(F.col(id).alias("i"), F.col(vector).alias("x")), "i", "x")
    return search(rows, rows.where(F.col("id") % every == 0), k, shard_rows, block_rows).select(
        F.col("q_id").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")


def op12_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


#: Usable vectors as whole numbers in doubles, which are exact far beyond these products.
ROWS_SQL = """
rows AS (
    SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
)"""
OP12_SQL = f"""
WITH {ROWS_SQL},
scored AS (
    SELECT q.r AS qr, q.vec_id AS query_id, c.r, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
    FROM rows q JOIN rows c ON q.r <> c.r WHERE q.vec_id % 50 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id NULLS LAST, r)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""

"""Hard negatives by bounds along a spanning tree of anchors.

The anchors of a block form a minimum spanning tree. At the root every row of a shard is scored. For a child c of p,
|c.x - p.x| <= |c - p| |x|, so the score at the parent plus or minus edge length times row norm bounds the score at the
child; rows that are not scored there hand their bounds on, widened, to the next child. Scored again are only rows whose
bounds reach the window that is asked for: the best so far of the same label, and then, with the positives known, the
windows below them. Edges and norms are rounded up, so no row in a window is missed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from readgrade.llm.common import stored, table
from readgrade.llm.topk import ROWS_SQL
from readgrade.llm.vectors import BLOCK_ROWS, NO_ID, SHARD_ROWS, both, in_cells, integer_rows, numbers, part_of, parts

POSITIVES, NEGATIVES, LOW, HIGH = 5, 5, 80, 100
#: Rounding of square roots and sums of doubles, upwards.
UP = 1 + 1e-9


def spanning_tree(a: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Order in which parents come before children, parents and edge lengths of a minimum spanning tree of the rows."""
    n, a = len(a), a.astype(np.float64)
    parent, order, left = np.zeros(n, np.int64), [], np.ones(n, bool)
    near = np.full(n, np.inf)
    near[:1] = 0
    for _ in range(n):
        k = int(np.argmin(np.where(left, near, np.inf)))
        if not left[k]:  # all that is left is infinitely far
            k = int(np.flatnonzero(left)[0])
        order.append(k)
        left[k] = False
        far = np.square(a - a[k]).sum(axis=1)
        closer = left & (far < near)
        near[closer], parent[closer] = far[closer], k
    return order, parent, np.sqrt(near) * UP


def walk(anchors: np.ndarray, x: np.ndarray, wanted: Callable[[int, np.ndarray, np.ndarray], np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(anchor, rows, their scores): the rows that ``wanted(anchor, low, high)`` marks, from the bounds handed down."""
    order, parent, edge = spanning_tree(anchors)
    norms = np.sqrt(np.square(x.astype(np.float64)).sum(axis=1)) * UP
    rounding = np.sqrt(np.square(anchors.astype(np.float64)).sum(axis=1)) * 1e-12  # of products beyond exact doubles
    children = np.bincount(parent[order[1:]], minlength=len(anchors))
    kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for k in order:
        if not kept and k == order[0]:
            low = high = (x @ anchors[k]).astype(np.float64)
            low, high = low - rounding[k] * norms, high + rounding[k] * norms
            at = np.flatnonzero(wanted(k, low, high))
            scores = x[at] @ anchors[k]
        else:
            low, high = kept[parent[k]]
            reach = (edge[k] + rounding[k]) * norms + 1
            low, high = low - reach, high + reach
            at = np.flatnonzero(wanted(k, low, high))
            scores = x[at] @ anchors[k]
            low[at] = high[at] = scores
            children[parent[k]] -= 1
            if not children[parent[k]]:
                del kept[parent[k]]
        if children[k]:
            kept[k] = low, high
        yield k, at, scores.astype(np.int64)


def _table(columns: list[list[np.ndarray]], names: list[str], ids: str) -> pa.Table:
    done = [np.concatenate([np.empty(0, np.int64), *c]) for c in columns]
    return pa.table([pa.array(c, mask=c == NO_ID) if n == ids else c for c, n in zip(done, names)], names=names)


def _first(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((rows, ids, -scores))[:k]


def _positives(k: int):
    names = ["a_row", "id", "row", "score"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list = [[] for _ in names]
        if left.num_rows and right.num_rows:
            x, a = both(left, right)
            ids, rows, labels = (numbers(left[c]) for c in ("id", "row", "label"))
            a_rows, a_labels = numbers(right["row"]), numbers(right["label"])

            def wanted(j, low, high):
                same = (labels == a_labels[j]) & (rows != a_rows[j])
                if same.sum() > k:
                    same &= high >= np.partition(low[same], -k)[-k]
                return same

            for j, at, scores in walk(a, x, wanted):
                top = _first(scores, ids[at], rows[at], k)
                at = at[top]
                for column, new in zip(out, (np.full(len(at), a_rows[j]), ids[at], rows[at], scores[top])):
                    column.append(new)
        return _table(out, names, "id")
    return run


def _negatives(k: int, low_share: int, high_share: int):
    names = ["a_row", "p_row", "id", "row", "score"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list = [[] for _ in names]
        if left.num_rows and right.num_rows:
            x, a = both(left, right)
            ids, rows, labels = (numbers(left[c]) for c in ("id", "row", "label"))
            a_rows, a_labels = numbers(right["row"]), numbers(right["label"])
            windows = [np.array([(p["row"], p["score"]) for p in w], np.int64).reshape(-1, 2) for w in right["positives"].to_pylist()]

            def wanted(j, low, high):
                reach = np.zeros(len(low), bool)
                for score in windows[j][:, 1].tolist():
                    reach |= (100 * high >= low_share * score) & (100 * low <= high_share * score)
                return reach & (labels != a_labels[j])

            for j, at, scores in walk(a, x, wanted):
                for p_row, score in windows[j].tolist():
                    inside = np.flatnonzero((100 * scores >= low_share * score) & (100 * scores <= high_share * score))
                    inside = inside[_first(scores[inside], ids[at[inside]], rows[at[inside]], k)]
                    new = at[inside]
                    for column, values in zip(out, (np.full(len(new), a_rows[j]), np.full(len(new), p_row), ids[new], rows[new], scores[inside])):
                        column.append(values)
        return _table(out, names, "id")
    return run


def mine(df: DataFrame, anchor: Column, id: str = "vec_id", vector: str = "embedding", label: str | Column = "label", positives: int = POSITIVES,
         negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows where ``anchor`` holds.

    The positives of an anchor are its best other rows of the same label; the negatives of a positive are the best rows of another label
    whose score, in hundredths of the positive's, is from ``low`` to ``high``. Rows with a null label, a null vector or a null or
    non-finite component take no part. Equal scores go by the smaller id, a null id last, so copies of one vector are ordered by id. Rows of one
    id are rows of their own, also as anchors and positives. A positive without negatives, an anchor without positives and an empty table give
    no rows; below a score of zero no window is open. Empty vectors score 0, shorter ones count as ending in zeros. Other columns,
    whatever their names, are not looked at. A hundred times each product must fit in a long.
    """
    own = F.col(label) if isinstance(label, str) else label
    named = df.select(F.col(id).alias("i"), F.col(vector).alias("x"), own.cast("long").alias("l"), F.coalesce(anchor, F.lit(False)).alias("a"))
    rows = integer_rows(named.where("l is not null"), "i", "x", label=F.col("l"), anchor=F.col("a"))
    shards = parts(rows, shard_rows)
    dealt = rows.select("row", "id", "v", "label", part_of(shards).alias("shard"))
    anchors, every = rows.where("anchor").select("row", "id", "v", "label"), list(range(shards))

    near = stored(in_cells(dealt, every, anchors, _positives(positives), "a_row long, id long, row long, score long", block_rows), "near-rows")
    order = Window.partitionBy("a_row").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    best = stored(near.withColumn("k", F.row_number().over(order)).where(F.col("k") <= positives).drop("k"), "positives")
    windows = best.groupBy("a_row").agg(F.collect_list(F.struct("row", "score")).alias("positives"))  # a few each
    asked = stored(anchors.join(windows.withColumnRenamed("a_row", "row"), "row"), "anchor-windows")

    found = in_cells(dealt, every, asked, _negatives(negatives, low, high), "a_row long, p_row long, id long, row long, score long", block_rows)
    order = Window.partitionBy("a_row", "p_row").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    pairs = best.select("a_row", F.col("row").alias("p_row"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    names = anchors.select(F.col("row").alias("a_row"), F.col("id").alias("anchor_id"))
    return ranked.join(pairs, ["a_row", "p_row"]).join(names, "a_row").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


OP13_SQL = f"""
WITH {ROWS_SQL},
labelled AS (
    SELECT r, vec_id, v, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS l FROM rows WHERE label IS NOT NULL
),
scored AS (
    SELECT a.r AS ar, a.vec_id AS anchor_id, c.r, c.vec_id, a.l = c.l AS same, list_dot_product(a.v, c.v)::BIGINT AS score
    FROM labelled a JOIN labelled c ON a.r <> c.r WHERE a.vec_id % 100 = 0
),
positives AS (
    SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id NULLS LAST, r) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
       row_number() OVER (PARTITION BY p.ar, p.r ORDER BY n.score DESC, n.vec_id NULLS LAST, n.r)::INTEGER AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.ar = p.ar AND NOT n.same AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5
"""

"""Exact top-k inner products by Fagin's threshold algorithm.

Vectors are integers.  Equal vectors are one class (a hot vector is one row, with its
smallest ids).  Classes are dealt into blocks; each block keeps one sorted list per
dimension.  For a query the lists are walked from the end that its sign asks for: at
depth t every object on some list above t has been seen and scored whole (the random
access), and the threshold, the score of an imaginary object made of the values at
depth t, bounds every object not yet seen.  A query stops in a block as soon as its
threshold is below its k-th score; the bounds of a batch of queries are walked together.
The best of all blocks are the best of the whole table, so the result is exact.

Scores are exact integers.  Where a product can pass 2**53, the walk goes by its double with a
margin for rounding, and every vector within the margin of the k-th is scored again in whole
numbers.  A component or score beyond 64 bits is held at the nearest 64-bit number.

Edge cases, all defined: null vectors and vectors with a null or non-finite component
take no part; vectors of other lengths than the query's are no candidates of it; ties
go to the smaller id; a query with fewer candidates than k returns them all; repeated
ids are one vector each and an id never meets itself; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewlake.llm.common import pick, stage

BLOCK, QUERY_BLOCK = 8192, 1024  # candidates and queries that meet in one task
BATCH = 128  # queries walked together


def clean_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v array<double>) without nulls and vectors that hold null, NaN or infinite components."""
    v = F.transform(F.col(f"`{vec_col}`"), lambda x: x.cast("double"))
    ok = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return pick(df, id_col, vec_col).select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & ok
    )


def classes(vectors: DataFrame, keep: int) -> DataFrame:
    """(v, ids): one row per distinct vector with its ``keep`` smallest distinct ids.

    Ids are first cut to the smallest per vector with a ranked window, which Spark limits
    map-side, so that a vector shared by a third of all rows never gathers its rows.
    """
    w = Window.partitionBy("v").orderBy("id")
    few = vectors.select("v", "id").distinct().withColumn("r", F.row_number().over(w)).where(F.col("r") <= keep)
    return few.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))


def top_rows(scores: np.ndarray, seen: np.ndarray, least: np.ndarray, k: int) -> list[np.ndarray]:
    """Per column of ``scores`` the rows of the k best seen ones: score first, then the smaller least id."""
    s = np.where(seen, scores, -np.inf)
    n = s.shape[0]
    out = []
    kth = np.partition(s, n - k, axis=0)[n - k] if n > k else np.full(s.shape[1], -np.inf)
    for j in range(s.shape[1]):
        rows = np.flatnonzero((s[:, j] >= kth[j]) & seen[:, j])
        out.append(rows[np.lexsort((least[rows], -s[rows, j]))][:k])
    return out


EXACT = 2.0**53  # doubles hold every integer up to here
LOW, HIGH = -(2**63), 2**63 - 1


def whole_product(a: np.ndarray, b: np.ndarray) -> int:
    """Inner product of two 64-bit integer vectors, held within 64 bits."""
    return min(max(sum(map(int.__mul__, a.tolist(), b.tolist())), LOW), HIGH)


class SortedLists:
    """A block's integer vectors with a sorted list per dimension, as ranks from either end."""

    def __init__(self, x: np.ndarray, least: np.ndarray):
        self.whole, self.least = x.astype(np.int64), least
        self.x = x = x.astype(np.float64)
        self.most = np.abs(x).max(axis=0, initial=0)
        n = len(x)
        order = np.argsort(-x, axis=0, kind="stable")
        self.down = np.take_along_axis(x, order, axis=0)  # values from the largest
        self.rank = np.empty(x.shape, dtype=np.int32)
        np.put_along_axis(self.rank, order, np.arange(n, dtype=np.int32)[:, None], axis=0)

    def search(self, q: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """(rows, scores as 64-bit integers) of the k best per query, by the threshold algorithm."""
        n, whole, q = len(self.x), q.astype(np.int64), q.astype(np.float64)
        largest = np.abs(q) @ self.most
        # twice what rounding can add to a sum, or nothing where all sums are exact
        margin = np.where(largest < EXACT, 0, largest * (q.shape[1] + 8) * 2.0**-51)
        up, low = np.maximum(q, 0), np.minimum(q, 0)
        found: list = [None] * len(q)
        live = np.arange(len(q))
        scores = np.zeros((n, len(q)))
        seen = np.zeros((n, len(q)), dtype=bool)
        depth = max(1, n // 64)
        while len(live):
            depth = min(depth, n)
            # sorted access: whose rank is above the depth on a list the query walks
            near = (self.rank < depth).astype(np.float32) @ (up[live] > 0).T.astype(np.float32)
            near += (self.rank >= n - depth).astype(np.float32) @ (low[live] < 0).T.astype(np.float32)
            now = near > 0 if depth < n else np.ones((n, len(live)), dtype=bool)
            # random access: whole scores of the objects that some query of the batch has newly seen
            new = np.flatnonzero((now & ~seen[:, live]).any(axis=1))
            scores[np.ix_(new, live)] = np.clip(self.x[new] @ q[live].T, LOW, HIGH)
            seen[:, live] |= now
            best = top_rows(scores[:, live], seen[:, live], self.least, k)
            bound = np.clip(self.down[depth - 1] @ up[live].T + self.down[n - depth] @ low[live].T, LOW, HIGH)
            rest = []
            for j, (i, rows) in enumerate(zip(live, best, strict=True)):
                if depth == n or (len(rows) == k and scores[rows[-1], i] - margin[i] > bound[j]):
                    found[i] = (rows, scores[rows, i].astype(np.int64)) if not margin[i] else self.settle(whole[i], scores[:, i], seen[:, i], rows, margin[i], k)
                else:
                    rest.append(i)
            live, depth = np.array(rest, dtype=int), depth * 4
        return found

    def settle(self, q: np.ndarray, scores: np.ndarray, seen: np.ndarray, rows: np.ndarray, margin: float, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best by whole numbers, from all seen rows that rounding may have put behind the k-th."""
        near = np.flatnonzero(seen & (scores >= scores[rows[-1]] - margin))
        best = sorted((-whole_product(self.whole[r], q), int(self.least[r]), r) for r in near)[:k]
        return np.array([r for _, _, r in best]), np.array([-s for s, _, _ in best], dtype=np.int64)


def grid(cands: DataFrame, queries: DataFrame, run, schema: str) -> DataFrame:
    """Every block of candidates with every block of queries, one pair of blocks a task."""
    n, q = cands.count(), queries.count()
    cb, qb = max(1, -(-n // BLOCK)), max(1, -(-q // QUERY_BLOCK))
    c = cands.withColumn("cb", F.pmod(F.xxhash64("v"), F.lit(cb))).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(qb - 1))))
    p = queries.withColumn("qb", F.pmod(F.xxhash64("v", F.lit(1)), F.lit(qb)).cast("int")).withColumn(
        "cb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cb - 1).cast("long")))
    )
    return p.groupBy("qb", "cb").cogroup(c.groupBy("qb", "cb")).applyInArrow(run, schema)


def matrix(col: pa.ChunkedArray, dtype: type = np.float64) -> list[np.ndarray]:
    return [np.asarray(x, dtype=dtype) for x in col.to_pylist()]


def by_length(vs: list[np.ndarray]) -> dict[int, np.ndarray]:
    out: dict[int, list[int]] = {}
    for i, v in enumerate(vs):
        out.setdefault(len(v), []).append(i)
    return {d: np.array(r) for d, r in out.items()}


def answer(hits: DataFrame, asked: DataFrame, k: int, score_type: str) -> DataFrame:
    """From (v, score, ids) per distinct query vector to (query_id, rank, id, score) per query.

    k + 1 classes per vector hold the k best ids other than the query's own, because each
    class brings at least one id and no class beyond them can hold a better one.
    """
    best = Window.partitionBy("v").orderBy(F.desc("score"), F.col("ids")[0])
    short = hits.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1)
    ids = short.select("v", "score", F.explode("ids").alias("id"))
    w = Window.partitionBy("v").orderBy(F.desc("score"), "id")
    ranked = ids.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k + 1)
    lists = stage(ranked.groupBy("v").agg(F.array_sort(F.collect_list(F.struct("r", "id", "score"))).alias("best")), "best")
    mine = asked.join(lists, "v").select("id", F.filter("best", lambda b: b["id"] != F.col("id")).alias("best"))
    cut = F.slice("best", 1, k)
    return mine.select(F.col("id").alias("query_id"), F.posexplode(cut).alias("p", "b")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("b.id").alias("vec_id"), F.col("b.score").cast(score_type).alias("score")
    )


def top_inner_products(df: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 64) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest integer inner products of floor(scale * x)."""
    v = clean_vectors(df, id_col, vec_col).select("id", F.transform("v", lambda x: F.floor(x * scale)).alias("v")).distinct()
    v = stage(v, "vectors")
    asked = v.where(is_query)
    cands = stage(classes(v, k + 1), "classes")
    queries = stage(asked.select("v").distinct(), "queries")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        qs, xs = matrix(left.column("v"), np.int64), matrix(right.column("v"), np.int64)
        ids = right.column("ids").to_pylist()
        rows: tuple[list, list, list] = ([], [], [])
        by = by_length(xs)
        for d, mine in by_length(qs).items():
            at = by.get(d)
            if at is None:
                continue
            block = SortedLists(np.array([xs[i] for i in at]), np.array([ids[i][0] for i in at]))
            for s in range(0, len(mine), BATCH):
                part = mine[s : s + BATCH]
                for i, (hit, score) in zip(part, block.search(np.array([qs[i] for i in part]), k + 1), strict=True):
                    vec = qs[i].tolist()
                    for h, sc in zip(hit, score, strict=True):
                        rows[0].append(vec)
                        rows[1].append(int(sc))
                        rows[2].append(ids[at[h]])
        return pa.table([pa.array(rows[0], pa.list_(pa.int64())), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.list_(pa.int64()))], names=["v", "score", "ids"])

    hits = grid(cands, queries, run, "v array<bigint>, score bigint, ids array<bigint>")
    return answer(hits, asked, k, "long")

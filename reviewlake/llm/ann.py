"""Approximate nearest neighbours with a permutation index.

Pivots are a bounded sample of the vectors.  A vector is represented by its nearest
pivots in order; each pivot's inverted file lists the vectors that have it, with its
place in their order.  A query reads the files of its own nearest pivots and adds up
the footrule distance (places apart; a pivot that is missing counts as one place past
the end).  The vectors of the least footrule distance are reranked by their cosine.

The index is cut into blocks of vectors, each with its own inverted files; a block
returns the best of its reranked share, so memory is bounded and every vector is
indexed.  Equal vectors are one entry with their smallest ids.

Edge cases, all defined: null, zero and non-finite vectors take no part; only vectors
of the query's length are its candidates; ties go to the smaller id; fewer candidates
than k are all returned when the rerank share covers them; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import stage
from reviewlake.llm.topk import answer, by_length, classes, clean_vectors, grid, matrix

PIVOTS = 256  # the bound of the sample that the index is fitted on
PREFIX = 96  # nearest pivots that represent a vector
SHARE, LEAST = 0.125, 256  # of a block's vectors, and at least so many, are reranked


def nearest_pivots(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """Per vector the numbers of its nearest pivots by cosine, nearest first."""
    return np.argsort(-(x @ pivots.T), axis=1, kind="stable")[:, :prefix]


class PermutationBlock:
    def __init__(self, x: np.ndarray, pivots: np.ndarray, prefix: int):
        self.n, self.pivots, self.prefix = len(x), pivots, min(prefix, len(pivots))
        order = nearest_pivots(x, pivots, self.prefix)
        flat = order.ravel()
        by = np.argsort(flat, kind="stable")
        starts = np.searchsorted(flat[by], np.arange(len(pivots) + 1))
        self.files = [
            (by[a:b] // self.prefix, (by[a:b] % self.prefix).astype(np.int32)) for a, b in zip(starts, starts[1:], strict=False)
        ]

    def footrule(self, q: np.ndarray) -> np.ndarray:
        """Footrule distance of every vector of the block to one query.

        All pivots missing would cost the most; each posting found takes off what it saves:
        its two absences (the query's and the vector's) become the places between.
        """
        k = self.prefix
        saved = np.zeros(self.n, dtype=np.int32)
        for place, p in enumerate(nearest_pivots(q[None], self.pivots, k)[0]):
            rows, places = self.files[p]
            saved[rows] += (k - place) + (k - places) - np.abs(places - place)
        return k * (k + 1) - saved


def permutation_search(
    df: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
    pivots: int = PIVOTS, prefix: int = PREFIX, share: float = SHARE, least: int = LEAST,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found by cosine, in double precision."""
    v = clean_vectors(df, id_col, vec_col).where(F.exists("v", lambda x: x != 0)).distinct()
    v = stage(v, "vectors")
    asked = v.where(is_query)
    cands = stage(classes(v, k + 1), "classes")
    queries = stage(asked.select("v").distinct(), "queries")
    # the sample: the vectors of the smallest hash
    sample = [r.v for r in cands.select("v").orderBy(F.xxhash64("v"), "v").limit(pivots).collect()]

    def unit(x: np.ndarray) -> np.ndarray:
        m = np.abs(x).max(axis=1, keepdims=True)  # first by the largest component, against overflow
        x = x / m
        return x / np.sqrt((x * x).sum(axis=1, keepdims=True))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        qs, xs = matrix(left.column("v")), matrix(right.column("v"))
        ids = right.column("ids").to_pylist()
        rows: tuple[list, list, list] = ([], [], [])
        by = by_length(xs)
        for d, mine in by_length(qs).items():
            at = by.get(d)
            if at is None:
                continue
            x = unit(np.array([xs[i] for i in at]))
            first = np.array([ids[i][0] for i in at])
            own = [p for p in sample if len(p) == d]
            # a length with fewer pivots than a prefix has no order to tell its vectors apart: all are reranked
            index = PermutationBlock(x, unit(np.array(own)), prefix) if len(own) >= min(prefix, pivots) else None
            most = max(least, int(np.ceil(share * len(x))))
            for i in mine:
                q = unit(qs[i][None])[0]
                near = np.arange(len(x))
                if index is not None and most < len(x):
                    near = np.sort(np.argpartition(index.footrule(q), most - 1)[:most])
                score = (x[near] * q).sum(axis=1)
                top = np.lexsort((first[near], -score))[: k + 1]
                vec = qs[i].tolist()
                for h in top:
                    rows[0].append(vec)
                    rows[1].append(float(score[h]))
                    rows[2].append(ids[at[near[h]]])
        return pa.table([pa.array(rows[0], pa.list_(pa.float64())), pa.array(rows[1], pa.float64()), pa.array(rows[2], pa.list_(pa.int64()))], names=["v", "score", "ids"])

    hits = grid(cands, queries, run, "v array<double>, score double, ids array<bigint>")
    return answer(hits, asked, k, "double")

"""Centroid clustering: exact integer k-means whose assignment is a threshold algorithm.

Components are integers, floor(scale * x).  Per dimension the centroids stand in a list
sorted by that component.  For a vector the lists are entered at its own values and
walked outward, nearest centroid first; a centroid met on any list gets its exact
squared distance (random access).  A centroid not met yet is at least as far off in
every dimension as that list's frontier, so the sum of the squared frontier distances
bounds it from below.  The walk stops when this sum strictly exceeds the best exact
distance: a tie could still go to a smaller number, so equality goes on.

Spark carries the rows: every round is one narrow pass over the vectors.  A task returns
sums per centroid and dimension (a few thousand rows whatever its size), which are added
up with a shuffle; the driver holds the ``k`` centroids only, never a vector.  Sums
travel as signed limbs of 40 bits, so they are exact at any size.

Edge cases, all defined: vectors that are null, of another width, or hold a null or
non-finite component take no part; fewer vectors than ``k`` give as many centroids;
an empty table gives no rows; a null id is clustered but never a start centroid;
repeated rows are one vector each (equal start vectors: the smaller number gets all,
the others stay empty); equal hashes go by the vector; distances and inertias that
do not fit 64 bits are null, the clusters are exact all the same; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import pick, stage

ROWS = 4096  # vectors walked together
SMALL = 1 << 27  # components up to this size are exact in 64 bits: 64 dimensions of (2 * SMALL)**2 stay below 2**63
LIMB = 40


def quantise(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as int64, or as Python integers where 64 bits could overflow later on."""
    with np.errstate(over="ignore"):
        y = np.floor(x * scale)
    if not len(y) or np.abs(y).max() <= SMALL:
        return y.astype(np.int64)
    # a double this large is an integer already; what overflowed by the scale is multiplied exactly
    flat = [int(b) if np.isfinite(b) else int(a) * scale for a, b in zip(x.ravel().tolist(), y.ravel().tolist(), strict=True)]
    return np.array(flat, dtype=object).reshape(x.shape)


class SortedCentroids:
    def __init__(self, centroids: list[list[int]]):
        self.k = len(centroids)
        wide = max(abs(c) for row in centroids for c in row) > SMALL
        self.c = np.array(centroids, dtype=object if wide else np.int64)
        self.order = np.argsort(self.c, axis=0, kind="stable").T.copy()  # per dimension, by value
        self.values = np.take_along_axis(self.c.T, self.order, axis=1)

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of the nearest centroid per vector; ties to the smaller number."""
        exact = object if object in (x.dtype, self.c.dtype) else np.int64
        x, c, values = x.astype(exact), self.c.astype(exact), self.values.astype(exact)
        n, dims = x.shape
        right = np.stack([np.searchsorted(values[d], x[:, d]) for d in range(dims)], axis=1)
        left = right - 1
        met = np.zeros((n, self.k), dtype=bool)
        best, at = np.zeros(n, dtype=exact), np.full(n, -1)
        dim = np.arange(dims)
        live = np.arange(n)

        def gaps(l: np.ndarray, r: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, ...]:
            """Distance to the next centroid on either side, and where there is one."""
            has_l, has_r = l >= 0, r < self.k
            return v - values[dim, np.maximum(l, 0)], values[dim, np.minimum(r, self.k - 1)] - v, has_l, has_r

        while len(live):
            l, r, v = left[live], right[live], x[live]
            gl, gr, has_l, has_r = gaps(l, r, v)
            go_left = has_l & (~has_r | (gl <= gr))
            # sorted access: one centroid per list, the nearer of both sides
            new = np.zeros((len(live), self.k), dtype=bool)
            new[np.arange(len(live))[:, None], self.order[dim, np.where(go_left, l, np.minimum(r, self.k - 1))]] = True
            new &= ~met[live]
            met[live] |= new
            for j in range(self.k):  # random access, by ascending number so that ties keep the smaller one
                rows = np.flatnonzero(new[:, j])
                if len(rows):
                    d = v[rows] - c[j]
                    d = (d * d).sum(axis=1)
                    i = live[rows]
                    better = (at[i] < 0) | (d < best[i]) | ((d == best[i]) & (j < at[i]))
                    best[i[better]], at[i[better]] = d[better], j
            l, r = l - go_left, r + ~go_left
            left[live], right[live] = l, r
            gl, gr, has_l, has_r = gaps(l, r, v)
            front = np.where(has_l & (~has_r | (gl <= gr)), gl, gr)
            # a list walked to both ends has met every centroid
            more = (has_l | has_r).all(axis=1) & ~met[live].all(axis=1)
            live = live[more & ~((front * front).sum(axis=1) > best[live])]
        return at, best


def _limbs(x: int) -> list[tuple[int, int]]:
    """(place, signed limb) of an integer, least place first."""
    out, place, sign, x = [], 0, -1 if x < 0 else 1, abs(x)
    while x:
        x, low = divmod(x, 1 << LIMB)
        out.append((place, sign * low))
        place += 1
    return out


def _matrices(batch: pa.RecordBatch, dims: int, scale: int):
    """(first row, integer matrix) of the vectors of an Arrow batch; huge ones stand apart, so they slow down no others."""
    for at in range(0, batch.num_rows, ROWS):
        x = batch.column("v").slice(at, ROWS).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
        big = (np.abs(x) * scale > SMALL).any(axis=1)
        for rows in (np.flatnonzero(~big), np.flatnonzero(big)):
            if len(rows):
                yield at + rows, quantise(x[rows], scale)


def cluster(
    df: DataFrame, k: int = 40, rounds: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", dims: int = 64, scale: int = 256, salt: str = "2:"
) -> DataFrame:
    """(id, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string), one row per kept vector.

    Start centroids: the ``k`` vectors with the smallest hash, sha256 of ``salt`` and the id.
    Each round assigns every vector, then moves each non-empty centroid to the
    componentwise floor of the mean; a last assignment follows.
    """
    spark = df.sparkSession
    v = F.col(f"`{vec_col}`").cast("array<double>")
    ok = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    src = pick(df, id_col, vec_col).select(F.col(f"`{id_col}`").alias("id"), v.alias("v")).where((F.size("v") == dims) & ok)

    key = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256)
    start = src.select(key.alias("h"), "v").where("h IS NOT NULL").orderBy("h", "v").limit(k).collect()
    if not start:  # without an id there is no start; without a vector there are no rows either
        start = src.select("v").orderBy("v").limit(k).collect()
    centroids = [[int(c) for c in row] for row in (quantise(np.array([r.v]), scale)[0] for r in start)]

    def sums(index: SortedCentroids):
        def run(batches):
            total: dict[int, list] = {}
            count: dict[int, int] = {}
            for b in batches:
                for _, x in _matrices(b, dims, scale):
                    at, _ = index.assign(x)
                    for j in np.unique(at).tolist():
                        mine = x[at == j]
                        add = mine.sum(axis=0).tolist()
                        total[j] = [p + q for p, q in zip(total[j], add, strict=True)] if j in total else add
                        count[j] = count.get(j, 0) + len(mine)
            rows = [(j, d, p, s) for j, t in total.items() for d, value in enumerate(t) for p, s in _limbs(int(value))]
            rows += [(j, -1, 0, n) for j, n in count.items()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)], names=["cluster", "dim", "place", "part"])

        parts = src.select("v").mapInArrow(run, "cluster int, dim int, place int, part long")
        return parts.groupBy("cluster", "dim", "place").agg(F.sum("part").alias("part")).collect()

    for _ in range(rounds if centroids else 0):
        total: dict[tuple[int, int], int] = {}
        for r in sums(SortedCentroids(centroids)):
            total[r.cluster, r.dim] = total.get((r.cluster, r.dim), 0) + (r.part << (LIMB * r.place))
        centroids = [
            [total.get((j, d), 0) // total[j, -1] for d in range(dims)] if (j, -1) in total else old for j, old in enumerate(centroids)
        ]

    schema = src.select("id").schema.add("cluster", "integer").add("distance", "long")
    index = SortedCentroids(centroids) if centroids else None

    def last(batches):
        for b in batches:
            for rows, x in _matrices(b, dims, scale):
                at, best = index.assign(x)
                fits = [d if d < 1 << 63 else None for d in best.tolist()]
                yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(rows)), pa.array(at, pa.int32()), pa.array(fits, pa.int64())], names=["id", "cluster", "distance"])

    done = stage(src.mapInArrow(last, schema), "assigned")
    # k rows: inertia and digest per cluster
    per = done.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"), F.count("*").alias("n"), F.count("distance").alias("m")).collect()
    own = {r.cluster: int(r.s) if r.n == r.m else None for r in per}
    whole = sum(own.values()) if None not in own.values() else None
    fit = lambda x: x if x is not None and x < 1 << 63 else None
    digest = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    rows = [(j, fit(own[j]), fit(whole), digest(centroids[j])) for j in own]
    info = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return done.join(F.broadcast(info), "cluster").select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")

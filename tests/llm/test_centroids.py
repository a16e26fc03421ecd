import hashlib
import math

import numpy as np

from reviewlake.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, cluster string, v int"


def brute(rows, k=40, rounds=5, dims=64):
    kept = [(i, [math.floor(256 * int(x)) if abs(x) > 2**60 else math.floor(256 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    cs = [v for _, v in order[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(cs))

    for _ in range(rounds):
        at = [near(v)[1] for _, v in kept]
        for j in range(len(cs)):
            mine = [v for (_, v), a in zip(kept, at, strict=True) if a == j]
            if mine:
                cs[j] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    last = [(i, *near(v)) for i, v in kept]
    own = {}
    for _, d, j in last:
        own[j] = own.get(j, 0) + d
    fit = lambda x: x if x < 2**63 else None
    bad = {j for _, d, j in last if fit(d) is None}
    whole = None if bad else fit(sum(own.values()))
    return sorted(
        (i is None, i or 0, j, fit(d), None if j in bad else fit(own[j]), whole, hashlib.sha256(",".join(map(str, cs[j])).encode()).hexdigest())
        for i, d, j in last
    )


def got(df, **kw):
    return sorted((r[0] is None, r[0] or 0, r[1], *r[2:]) for r in centroids.cluster(df, **kw).collect())


def test_against_brute_force_with_invalid_repeated_and_tied_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(300)]
    rows += [(i, [round(x) / 8 for x in rng.normal(size=6) * 8]) for i in range(300, 400)]  # many ties
    rows += [(400, None), (401, [1.0]), (402, [float("nan")] * 6), (403, [None] * 6), (404, [float("inf")] * 6), (None, [0.5] * 6)]
    rows += [(i, [0.25] * 6) for i in range(500, 700)] + [(7, rows[7][1])] * 3  # a third of all rows are one vector; repeated rows
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA).repartition(5)
    assert got(df, k=12, dims=6) == brute(rows, k=12, dims=6)


def test_huge_components_are_exact(spark):
    rows = [(i, [float(10**9 * (i % 7)) + i, 3e38 if i == 4 else -1e17 * i, 1.5]) for i in range(40)] + [(99, [1e308, 1.0, 0.0])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA).repartition(3)
    assert got(df, k=5, dims=3) == brute(rows, k=5, dims=3)


def test_few_vectors_and_empty_table(spark):
    rows = [(1, [1.0, 2.0]), (2, [3.0, -4.0])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    assert got(df, k=40, dims=2) == brute(rows, dims=2)
    assert got(df.limit(0), k=40, dims=2) == []
    assert len(got(df.selectExpr("cast(null as bigint) vec_id", "embedding"), dims=2)) == 2


def test_walk_stops_early_and_stays_exact():
    rng = np.random.default_rng(1)
    c = [[i * 1000, -i * 1000] for i in range(40)]
    index = centroids.SortedCentroids(c)
    x = rng.integers(-40_000, 40_000, size=(500, 2))
    at, best = index.assign(x)
    d = ((x[:, None, :] - np.array(c)) ** 2).sum(axis=2)
    assert (best == d.min(axis=1)).all() and (at == d.argmin(axis=1)).all()

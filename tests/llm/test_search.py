import math

import duckdb
import numpy as np
from pyspark.sql import functions as F

from reviewlake.llm import ann, topk
from reviewlake.llm.oracle import ORACLE
from reviewlake.llm.queries import Q

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, v int, ids string, best int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v and [c if c is None else float(c) for c in v], 1, "x", 2) for i, v in rows], SCHEMA)


def traps(hot=60):
    rnd = np.random.default_rng(3)
    rows = [(i, rnd.normal(size=8).tolist()) for i in range(300)]
    rows += [(1000 + i, [1.0, 0, 0, 0, 0, 0, 0, 0]) for i in range(hot)]  # a hot vector
    rows += [(2000, None), (2020, [None] * 8), (2040, [float("nan")] + [0.0] * 7), (2060, [float("inf")] * 8), (2080, []), (2100, [0.0] * 8)]
    return [*rows, rows[5], (None, [1.0] * 8)]


def test_threshold_algorithm_against_sql(spark):
    rows = traps()
    got = topk.top_inner_products(frame(spark, rows), F.col("id") % 20 == 0).collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", [list(r) for r in rows])
    assert sorted(map(tuple, got)) == sorted(con.execute(ORACLE["op2_threshold_topk"]).fetchall())
    assert topk.top_inner_products(frame(spark, []), F.col("id") % 20 == 0).count() == 0


def test_sorted_lists_stop_early_and_stay_exact():
    rnd = np.random.default_rng(0)
    x = np.floor(rnd.normal(size=(3000, 4)) * 40)
    lists = topk.SortedLists(x, np.arange(3000))
    for q, (rows, scores) in zip(x[:20], lists.search(x[:20], 5), strict=True):
        s = x @ q
        want = np.lexsort((np.arange(3000), -s))[:5]
        assert rows.tolist() == want.tolist() and scores.tolist() == s[want].tolist()


def test_large_components_are_exact(spark):
    rnd = np.random.default_rng(7)
    for size in (1e5, 1e7, 1e9, 1e12, 1e17, 1e19, 1e300):
        rows = [(i, (rnd.normal(size=6) * size).tolist()) for i in range(200)]
        rows += [(300 + i, [*rows[i][1][:5], rows[i][1][5] + 1 / 64]) for i in range(100)]  # a little more than a row before
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        got = topk.top_inner_products(df, F.col("id") % 20 == 0, k=5).collect()
        held = lambda n: min(max(n, -(2**63)), 2**63 - 1)
        x = {i: [held(math.floor(c * 64)) if abs(c) < 1e306 else held(int(c)) for c in v] for i, v in rows}
        for q in [i for i in x if i % 20 == 0]:
            want = sorted((-held(sum(a * b for a, b in zip(x[q], v, strict=True))), i) for i, v in x.items() if i != q)[:5]
            mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
            assert mine == [(n + 1, i, -s) for n, (s, i) in enumerate(want)], size


def cosines(rows):
    x = {i: np.array(v, dtype=float) for i, v in rows if i is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v)}
    return x


def test_permutation_search_recall_and_scores(spark):
    got = Q["op1_permutation_search"](spark, SF).collect()
    x = cosines([(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()])
    hit = n = 0
    for q in [i for i in x if i % 50 == 0]:
        s = sorted((-float(x[q] @ v / np.linalg.norm(x[q]) / np.linalg.norm(v)), i) for i, v in x.items() if i != q)[:5]
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [m[0] for m in mine] == [1, 2, 3, 4, 5]
        hit += len({m[1] for m in mine} & {i for _, i in s})
        n += 5
        for _, i, score in mine:
            assert abs(score - float(x[q] @ x[i] / np.linalg.norm(x[q]) / np.linalg.norm(x[i]))) < 1e-12
    assert hit / n >= 0.9


def test_permutation_edges(spark):
    got = ann.permutation_search(frame(spark, traps()), F.col("id") % 50 == 0).collect()
    assert not {2000, 2020, 2040, 2060, 2080, 2100} & {r.vec_id for r in got} | ({2000, 2100} & {r.query_id for r in got})
    hot = sorted((r.rank, r.vec_id) for r in got if r.query_id == 1000)
    assert hot == [(k, 1000 + k) for k in range(1, 6)]  # equal vectors: ties to the smaller id, never itself
    assert ann.permutation_search(frame(spark, []), F.col("id") % 50 == 0).count() == 0


def test_footrule_is_the_footrule():
    rnd = np.random.default_rng(1)
    x, piv = rnd.normal(size=(50, 6)), rnd.normal(size=(12, 6))
    b = ann.PermutationBlock(x, piv, 5)
    order = ann.nearest_pivots(x, piv, 5)
    place = lambda o: {p: i for i, p in enumerate(o)}
    a = place(order[0])
    want = [sum(abs(a.get(p, 5) - place(o).get(p, 5)) for p in {*a, *o}) for o in order]
    assert b.footrule(x[0]).tolist() == want


def test_rare_length_is_searched_whole(spark):
    import numpy as np
    from pyspark.sql import functions as F

    from reviewlake.llm import ann

    rnd = np.random.default_rng(5)
    rows = [(i, rnd.normal(size=8).tolist()) for i in range(3000)] + [(10_000 + i, rnd.normal(size=6).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.permutation_search(df, F.col("id").isin(*range(10_000, 10_020)), pivots=40, prefix=20, share=0.05, least=10).collect()
    x = np.array([v for i, v in rows if i >= 10_000])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for q in range(20):
        near = [int(n) for n in np.argsort(-(x @ x[q])) if n != q][:5]
        assert [r.vec_id - 10_000 for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == 10_000 + q] == near

import duckdb

from reviewlake.llm import mixing
from reviewlake.llm.oracle import ORACLE

SCHEMA = "doc_id long, text string, source string, size int, h string, copies int"


def against_sql(spark, rows):
    df = spark.createDataFrame([(*r, 7, "x", 3) for r in rows], SCHEMA)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    if rows:
        con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [list(r) for r in rows])
    want = con.execute(ORACLE["op5_mixing"]).fetchall()
    got = [(r.id, r["size"], r.source_size, r.target, r["size"] * r.copies) for r in mixing.mix(df).collect()]
    key = lambda r: tuple((x is None, x or 0) for x in r[:3])
    rnd = lambda rs: [(a, b, c, round(d, 6), e) for a, b, c, d, e in sorted(rs, key=key)]
    assert rnd(got) == rnd(want)
    return got, df


def test_hot_source_null_source_and_targets(spark):
    rows = [(i, "w " * (1 + i * 7 % 90), "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(600)]
    rows += [(1000 + i, "a b c", None) for i in range(40)]
    got, df = against_sql(spark, rows)
    size = {}
    for (i, t, s) in rows:
        size.setdefault(s, []).append(len((t or "").split()))
    assert all(t <= 2 * n for _, n, _, _, t in got)
    taken = {}
    for i, n, ss, target, t in got:
        s = rows[i][2] if i < 1000 else None
        taken[s] = (taken.get(s, (0, 0))[0] + t, target)
    assert all(abs(t - target) <= max(size[s]) for s, (t, target) in taken.items())
    copies = mixing.mix_rows(df)
    assert copies.columns == df.columns
    assert sum(len(r.text.split()) for r in copies.collect()) == sum(t for *_, t in got)


def test_edges(spark):
    against_sql(spark, [(1, None, "a"), (2, "", "a"), (3, "x y", None), (3, "x y", None), (None, "q r s", "b"), (None, None, None)])
    df = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(df).count() == 0 and mixing.mix_rows(df).count() == 0


def test_columns_of_any_name_come_through_unchanged(spark):
    from reviewlake.llm import simhash

    schema = "doc_id long, text string, source string, __n int, __h string, __a int, __s int, c0 string, `a.b` int"
    rows = [(i, f"one two three four five {i} {i * 7} {i * 13}", "s", i, "h", i + 1, i + 2, "c", i) for i in range(20)]
    df = spark.createDataFrame(rows, schema)
    assert simhash.keep_one(df).columns == df.columns
    assert set(map(tuple, simhash.keep_one(df).collect())) <= set(rows)
    mixed = mixing.mix_rows(df)
    assert mixed.columns == df.columns and set(map(tuple, mixed.collect())) <= set(rows)
    assert mixed.count() > 0

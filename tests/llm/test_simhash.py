import xxhash
import pytest

from reviewlake.llm import simhash
from reviewlake.llm.queries import Q

SF = "/root/testdata/sf0.001"


def fp_of(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute(rows):
    ids = [(i, fp_of(t)) for i, t in rows]
    fps = sorted({f for _, f in ids})
    up = {f: f for f in fps}

    def root(f):
        while up[f] != f:
            f = up[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= 4:
                up[root(a)] = root(b)
    least = {}
    for i, f in ids:
        if i is not None:
            least[root(f)] = min(least.get(root(f), i), i)
    return sorted((i is None, i or 0, format(f, "016x"), least.get(root(f))) for i, f in ids)


def test_query_against_brute_force(spark):
    got = Q["op10_simhash"](spark, SF).collect()
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted((r.doc_id is None, r.doc_id or 0, r.fingerprint, r.component_id) for r in got) == brute(rows)


def test_edges_nulls_ties_long_and_repeats(spark):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(5, base), (3, base), (3, base), (9, base.replace("w7 ", "x ")), (1, None), (2, ""), (4, "  \t"), (None, base),
            (6, "one two"), (7, "ONE two"), (8, "z " * 300_000)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, fp string, comp int")
    got = simhash.simhash_components(df).collect()
    have = sorted((r.doc_id is None, r.doc_id or 0, format(r.fp & (2**64 - 1), "016x"), r.component_id) for r in got)
    assert have == brute(rows)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r[3] for r in brute(rows)})
    assert simhash.simhash_components(df.limit(0)).count() == 0


def test_keep_one_keeps_a_row_of_every_group(spark):
    text = lambda n: " ".join(f"g{n}w{i}" for i in range(60))
    rows = [(None, text(0), "x"), (None, text(1), None), (None, text(1), "y"), (None, text(2), "x"), (None, text(2), "x"),  # null ids only
            (5, text(3), "x"), (5, text(4), "x"), (5, text(4), "x"),  # one id, two groups
            (8, text(5), "x"), (None, text(5), "a"), (None, text(5), "b"), (3, text(6), "x"), (7, text(6), "x"),
            (9, None, "q"), (None, "q", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = simhash.keep_one(df).collect()
    assert sorted((r.text or "", r.doc_id is None, r.doc_id or 0) for r in got) == sorted(
        [(text(0), True, 0), (text(1), True, 0), (text(2), True, 0), (text(3), False, 5), (text(4), False, 5),
         (text(5), False, 8), (text(6), False, 3), ("", False, 9), ("q", True, 0)])
    plan = simhash.keep_one(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_chains_and_large_groups_lose_no_link(spark):
    import random

    rnd = random.Random(7)
    fps, at = [], rnd.getrandbits(64)
    for _ in range(60):  # a chain: each at most 4 bits from the last
        for _ in range(rnd.randint(1, 4)):
            at ^= 1 << rnd.randrange(64)
        fps.append(at)
    hub = rnd.getrandbits(64)
    fps += [hub ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for _ in range(300)]
    fps += [rnd.getrandbits(64) for _ in range(300)]
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = {r.fp: r.comp for r in simhash.fingerprint_components(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()}
    up = {f: f for f in signed}

    def root(f):
        while up[f] != f:
            f = up[f]
        return f

    nodes = list(up)
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= 4:
                up[root(a)] = root(b)
    want = {}
    for f in nodes:
        want.setdefault(root(f), set()).add(f)
    have = {}
    for f, c in got.items():
        have.setdefault(c, set()).add(f)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, have.values()))


@pytest.mark.parametrize("n", [2, 3, 4, 5])
def test_segments_cover_all_bits(n):
    parts = simhash._segments(n)
    assert sum(w for _, w in parts) == 64 and all(a + w == b for (a, w), (b, _) in zip(parts, parts[1:]))

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from reviewlake.llm import jaccard

SCHEMA = "doc_id long, text string, n string, comp int, cid long"


def set_of(text):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    k = min(3, len(w))
    return frozenset(b" ".join(w[i : i + k]) for i in range(len(w) - k + 1))


def brute(rows, percent=90):
    sets = [set_of(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted((d is None, d or 0, len(sets[i]), least.get(root(i)) is None, least.get(root(i)) or 0) for i, (d, _) in enumerate(rows))


def got(spark, rows, parts=4, **kw):
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA).repartition(parts)
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id is None, r.component_id or 0) for r in jaccard.jaccard_components(df, **kw).collect())


def family(rng, words, edits, size):
    """Near copies around the threshold, some made from other copies so that chains form."""
    out = [[f"w{rng.randrange(10**6)}" for _ in range(words)]]
    while len(out) < size:
        t = list(rng.choice(out))
        for _ in range(rng.randrange(edits + 1)):
            t[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        out.append(t)
    return [" ".join(t) for t in out]


def test_query_against_brute_force_at_every_size(spark):
    rng = random.Random(3)
    texts = []
    for words in (1, 2, 3, 4, 8, 11, 12, 13, 20, 21, 31, 45, 70, 130, 400):
        texts += family(rng, words, max(1, words // 25), 14)
    # one very common passage, a hot exact copy, and texts of repeated shingles
    texts += [" ".join([f"p{j}" for j in range(40)] + [f"q{i}_{j}" for j in range(40)]) for i in range(30)]
    texts += [texts[100]] * 100 + ["a b c " * 30, "a b c " * 31, "A b\tc " * 30]
    rows = [(1000 - i, t) for i, t in enumerate(texts)]
    rows += [(2000, None), (2001, ""), (2002, " \t\n"), (None, texts[100]), (None, "only one null"), (None, "only one null"), (2003, "x"), (2003, "x"), (2004, "z " * 200_000)]
    rng.shuffle(rows)
    assert got(spark, rows) == brute(rows)


def test_large_group_of_near_copies_with_lanes(spark):
    rng = random.Random(4)
    rows = list(enumerate(family(rng, 60, 1, 150) + family(rng, 60, 4, 150)))
    assert got(spark, rows) == brute(rows)


def test_rounds_of_sampled_hubs_lose_no_link(spark, monkeypatch):
    for name, value in (("CROWDED", 3), ("HUBS", 1), ("WIDEN", 2), ("FEW", 1)):
        monkeypatch.setattr(jaccard, name, value)
    rng = random.Random(6)
    texts = [t for words in (12, 30, 61, 130) for edits in (1, 3, 5) for t in family(rng, words, edits, 35)]
    rows = [(500 - i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (7, texts[40]), (7, texts[40]), (8, None)]
    assert got(spark, rows) == brute(rows)


def test_pairs_grow_with_a_group_of_near_copies_not_with_its_square(spark, monkeypatch):
    """Half of the copies have one edit and link with each other; those with two link with few."""
    made, real = [], jaccard.stage

    def counted(df, name):
        out = real(df, name)
        if name.endswith("-pairs"):
            made.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "stage", counted)
    rng = random.Random(5)
    rows = []
    for i in range(2000):
        t = [f"w{j}" for j in range(150)]
        for p in rng.sample(range(150), 1 + i % 2):
            t[p] = f"e{i}_{p}"
        rows.append((i, " ".join(t)))
    assert {c for *_, c in got(spark, rows)} == {0}
    assert sum(made) <= 8 * len(rows), made


def test_empty_table(spark):
    assert got(spark, []) == []


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=400), st.data())
def test_linked_sets_always_share_a_tile(base, data):
    base = sorted(base)
    drop = data.draw(st.integers(0, max(0, len(base) // 9)))
    other = sorted(set(base[drop:]) | data.draw(st.sets(st.integers(0, 2**64 - 1), max_size=len(base) // 9)))
    a, b = sorted(((base), other), key=len)
    if not a or 10 * len(set(a) & set(b)) < 9 * len(set(a) | set(b)) or a == b:
        return
    first = jaccard.bands(90, 10_000)
    band = [int(np.searchsorted(first, len(x), side="right")) - 1 for x in (a, b)]
    assert band[1] - band[0] in (0, 1)
    parts = jaccard.parts_of_band(first, band[1], 90)
    x, y = (jaccard.tile_keys(np.array(s, np.uint64), band[1], parts) for s in (a, b))
    assert parts > 1 and (x == y).any()
    p, q = (jaccard.parity(np.array(s, np.uint64)) for s in (a, b))
    assert sum((int(u) ^ int(v)).bit_count() if u >= 0 and v >= 0 else bin((int(u) ^ int(v)) & (2**64 - 1)).count("1") for u, v in zip(p, q, strict=True)) <= len(set(a) ^ set(b))

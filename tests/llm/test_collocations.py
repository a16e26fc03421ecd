import random
import re
from collections import Counter

import numpy as np
import pytest

from reviewlake.llm import collocations as C

SCHEMA = "doc_id long, text string, lang string, n string, phrase int, k int"
A_Z = {i: i + 32 for i in range(65, 91)}


def counts(rows):
    f, total = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        c = f.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(A_Z)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(ws)
            c.update(" ".join(ws[i : i + k]) for k in range(1, 5) for i in range(len(ws) - k + 1))
    return f, total


def brute(rows, least=30, top=2000):
    out = []
    f, total = counts(rows)
    for lang, c in f.items():
        cands = {p: a for p, a in c.items() if " " in p and a >= least}
        found = []
        for p, a in cands.items():
            ws = p.split(" ")
            if any(" " in q and len(q.split(" ")) > len(ws) and f" {p} " in f" {q} " and 100 * b >= 80 * a for q, b in cands.items()):
                continue
            score, cut = min((2000000 * a // (c[" ".join(ws[:k])] + c[" ".join(ws[k:])]), k) for k in range(1, len(ws)))
            found.append((-score, -a, p.encode(), c[" ".join(ws[:cut])], c[" ".join(ws[cut:])]))
        out += [(lang, i, p.decode(), -a, l, r, total[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def corpus():
    rng = random.Random(9)
    words = ["the", "The", "of", "a", "sum", "é", "É", "日本", "x y", "\x1cq", "in", "art"]
    rows = []
    for i in range(1200):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n", "!"]) for _ in range(rng.randrange(60)))
        if i % 9 == 0:
            text += " New york city hall is New York"
        rows.append((text, rng.choice(["en", "de", None, "und", ""])))
    rows += [(None, "en"), ("", None), (" .,\n", "fr"), ("hot pair " * 5000, "en"), ("n o . " * 7, "en")]
    rows += [("one fixed passage of words", "de")] * 120
    return rows


def got(spark, rows, **kw):
    df = spark.createDataFrame([(None if i % 5 else i, t, l, "x", 1, 2) for i, (t, l) in enumerate(rows)], SCHEMA).repartition(4)
    return sorted(tuple(r) for r in C.collocations(df, **kw).collect())


@pytest.mark.parametrize("limits", [{}, {"entries": 50, "burst": 4, "vocabulary": 12, "chunk": 64}])
def test_against_brute_force_also_when_containers_burst_and_spill(spark, limits):
    rows = corpus()
    want = brute(rows)
    assert len(want) > 60 and any(len(r[2].split(" ")) == 4 for r in want)
    assert got(spark, rows, **limits) == want


def test_top_cuts_ties_by_bytes(spark):
    rows = [("b c. a b. é z. z é. ", "en")] * 30
    assert [r[2] for r in got(spark, rows, top=3)] == [r[2] for r in brute(rows, top=3)]


def test_empty_table_and_nothing_frequent(spark):
    assert got(spark, []) == []
    assert got(spark, [("a b c", "en")] * 29) == []


def test_trie_bursts_and_spills_whole_subtrees():
    t = C.HatTrie(burst=8)
    rng = random.Random(2)
    want = Counter()
    for _ in range(400):
        add = {rng.choice([3, 515, 7, 1 << 80]) + (rng.randrange(1 << rng.randrange(1, 50)) << 8): rng.randrange(1, 9) for _ in range(10)}
        t.add(np.array(list(add), dtype=object), np.array(list(add.values())))
        want.update(add)
    assert any(type(x) is list for x in t.root) and t.entries == len(want)
    some = t.spill(t.entries // 2, wide=True)
    gone = {k & 255 for k in some[0].tolist()}
    assert 0 < len(gone) < len({k & 255 for k in want}) and all(not t.root[i] for i in gone) and t.entries == len(want) - len(some[0])
    rest = t.spill(wide=True)
    have = Counter()
    for keys, n in (some, rest):
        for k, c in zip(keys.tolist(), n.tolist(), strict=True):
            have[k] += c
    assert have == want and t.entries == 0

import math
import time

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

import corpus_pipeline
from reviewlake.llm import chat, licenses, lmscore, rollup, toxicity
from reviewlake.llm.oracle import ORACLE

SF = "/root/testdata/sf0.001"


def test_restore_undoes_disguises():
    words = "the idiot stupid people went home with their trash and pathetic clown loser scum moron " * 30
    c = toxicity.CLASS[np.frombuffer(words.encode(), dtype=np.uint8)].astype(np.int64)
    counts = np.bincount((c[:-2] * 32 + c[1:-1]) * 32 + c[2:], minlength=32**3)
    lm = toxicity.language_model(counts).tolist()
    for seen, plain in {"1d10t": "idiot", "i.d.i.o.t": "idiot", "stuuuupid": "stupid", "m0r0n": "moron", "tr@sh": "trash", "s-c-u-m": "scum"}.items():
        assert toxicity.restore(seen, lm) == plain
    r = toxicity.Reader(np.array(lm))
    assert set(toxicity.word_features(b"idiot")) <= r.features(b"you i d i o t there")
    assert r.features(None) == r.features(b"") == set()


def test_every_disguise_enters_the_lattice():
    words = "you are a the idiot stupid people went home with their trash and clown loser in a big class of an area " * 30
    c = toxicity.CLASS[np.frombuffer(words.encode(), dtype=np.uint8)].astype(np.int64)
    lm = toxicity.language_model(np.bincount((c[:-2] * 32 + c[1:-1]) * 32 + c[2:], minlength=32**3))
    r, idiot = toxicity.Reader(lm), set(toxicity.word_features(b"idiot"))
    for text in ("you are a i d i o t", "i d i o t a clown", "y o u i d i o t", "i  d  i  o  t", "i d\ni\r\nd o i d\ti o t", "idiiot", "id!ot", "idi0+", "1diot", "i.diot", "so idi-ot, you",
                 "!diot", "x " * 60 + "i d i o t"):
        assert idiot <= r.features(text.encode()), text
    for text in ("you are a big class", "t h e", ""):
        assert not idiot & r.features(text.encode())
    assert toxicity.restore("the" * 15 + "idi0t" + "clown" * 20, lm.tolist()) == "the" * 15 + "idiot" + "clown" * 20


def test_words_of_a_run_against_all_cuts():
    words = "you are a idiot clown in the area of oui " * 9
    c = toxicity.CLASS[np.frombuffer(words.encode(), dtype=np.uint8)].astype(np.int64)
    lm = toxicity.language_model(np.bincount((c[:-2] * 32 + c[1:-1]) * 32 + c[2:], minlength=32**3)).tolist()
    for run in (b"aidiot", b"youidiot", b"clowna", b"x"):
        cuts = []
        for mask in range(1 << len(run) - 1):
            cut = b"".join(run[i : i + 1] + (b" " if mask >> i & 1 else b"") for i in range(len(run)))
            k = toxicity.CLASS[np.frombuffer(b"  " + cut + b" ", dtype=np.uint8)]
            cuts.append((sum(lm[x][y][z] for x, y, z in zip(k, k[1:], k[2:])), cut.split()))
        best = max(cuts)[0]
        assert set(toxicity.run_words(run, lm)) == {w for s, cut in cuts if s > best - toxicity.NEAR for w in cut}


def test_toxicity_learns_and_rejects(spark):
    rows = [(i, ("plain words about the weather " * (1 + i % 5)) + ("grubblix " if i % 4 == 0 else "") + f"n{i}", i % 4 == 0) for i in range(400)]
    docs = spark.createDataFrame([(i, t, "en", 1.0, 3) for i, t, _ in rows] + [(900, None, "x", 0.0, 1), (901, "", None, 0.0, 1), (None, "gruuubblix", "x", 0.0, 1)],
                                 "doc_id long, text string, lang string, score double, total int")
    labels = spark.createDataFrame([(i, 0, int(y)) for i, _, y in rows] * 2 + [(901, 0, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    m = toxicity.train(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.score(docs, m).collect()}
    assert all((got[i] >= 0.5) == y for i, _, y in rows) and got[900] == got[901] < 0.5
    kept = toxicity.reject(docs, m)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {i for i, _, y in rows if not y} | {900, 901}
    blank = toxicity.train(docs, labels.limit(0))
    assert {r.score for r in toxicity.score(docs, blank).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), m).count() == 0


def test_one_doubled_letter_is_read_as_the_whole_search_reads_it(monkeypatch):
    rng = np.random.default_rng(3)
    lm = toxicity.language_model(rng.integers(0, 60, 32**3)).tolist()
    words = ["".join(rng.choice(list("abc"), rng.integers(2, 9))) for _ in range(3000)]
    fast = [toxicity.restore(w, lm) for w in words]
    assert sum(toxicity._one_double(w) > 0 for w in words) > 500 and sum(f != w for f, w in zip(fast, words, strict=True)) > 100
    monkeypatch.setattr(toxicity, "_one_double", lambda token: 0)
    assert fast == [toxicity.restore(w, lm) for w in words]


def test_toxicity_on_held_out_labels(spark):
    from reviewlake.llm.queries import Q

    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in Q["op7_toxicity"](spark, sf).collect()}
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(got[i], y) for i, y in truth.items() if y is not None and i in got and got[i].held_out]
    assert len(held) > 20 and any(y for _, y in held)
    assert sum(r.predicted == y for r, y in held) >= 0.95 * len(held)
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count() and all(0 <= r.score <= 1 for r in got.values())


def test_toxicity_keeps_columns_of_any_name_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "fine words", 7, "a"), (1, "fine words", 7, "a"), (2, "w " * 100_000, 8, "b")], "doc_id long, text string, __ int, c0 string")
    m = toxicity.train(docs, spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, toxic int"))
    kept = toxicity.reject(docs, m, limit=2.0)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect())) == sorted(map(tuple, docs.collect()))


def brute_forward(word, pieces):
    if not word:
        return 1.0
    return sum(p * brute_forward(word[n:], pieces) for n in range(1, len(word) + 1) if (p := pieces.get(word[:n])) is not None)


def test_lattice_sums_all_segmentations():
    pieces = lmscore.normalised({b"a": 3.0, b"b": 1.0, b"ab": 2.0, b"aba": 1.0, b"bb": 0.5}, 0.25)
    assert math.isclose(lmscore.stop_share(pieces), 0.25, rel_tol=1e-9)
    for w in (b"a", b"abab", b"ababbaab", b"xyz"):
        assert math.isclose(10 ** lmscore.forward(w, pieces.get), brute_forward(w, pieces), rel_tol=1e-9)
    assert lmscore.forward(b"a" * 5000, pieces.get) < -300  # far below the smallest double


def test_long_pieces_and_long_words_count_whole():
    pieces = lmscore.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    most = lmscore.longest(pieces)
    assert most > 12 and {b"international", b"implementation", b"infrastructure"} <= set(pieces)
    assert math.isclose(lmscore.forward(b"internationals", pieces.get, most), lmscore.forward(b"internationals", pieces.get), rel_tol=1e-12)
    small = lmscore.normalised({b"a": 3.0, b"b": 1.0, b"ab": 2.0, b"aba": 1.0, b"x" * 30: 0.5, b"x": 1e-9}, 0.25)

    def uses(word):
        if not word:
            return [(1.0, ())]
        return [(small[word[:n]] * q, (word[:n], *r)) for n in range(1, len(word) + 1) if word[:n] in small for q, r in uses(word[n:])]

    got, want = {}, {}
    lmscore.expected_pieces(b"abababab", small.get, got, lmscore.longest(small))
    total = math.fsum(q for q, _ in uses(b"abababab"))
    for q, cut in uses(b"abababab"):
        for x in cut:
            want[x] = want.get(x, 0.0) + q / total
    assert got.keys() == want.keys() and all(math.isclose(got[x], want[x], rel_tol=1e-9) for x in want)
    for word, cut in ((b"z" * 50 + b"x" * 30 + b"z" * 50, b"x" * 30), (b"z" * 5000 + b"x" * 30 + b"z" * 5000, b"x" * 30)):
        got = {}
        lmscore.expected_pieces(word, small.get, got, 30)  # far below the smallest double
        assert math.isclose(got[cut], 1.0, rel_tol=1e-3) and math.isclose(got[b"z"], word.count(b"z"), rel_tol=1e-6)


def test_lm_base_scores_by_brute_force(spark):
    from zlib import crc32

    rows = [(i, f"The cat sat on mat number {i % 9} " * (i % 4), "en" if i % 3 else "fr") for i in range(120)] + [(500, None, "en"), (501, "", None), (None, "the the", "en"), (7, "cat " * 40_000, "en")]
    df = spark.createDataFrame([(*r, 5, "z") for r in rows], "doc_id long, text string, lang string, block int, word string")
    got = lmscore.lm_scores(df, public_tokenizers.path("piece_bpe_32k.model")).collect()
    toks = lambda t: [*(t or "").lower().split(), None]
    train = [toks(t) for i, t, _ in rows if crc32(str(i if i is not None else "").encode()) % 7 != 2]
    count = {}
    for d in train:
        for w in d:
            count[w] = count.get(w, 0) + 1
    n, v = sum(count.values()), len(count)
    want = sorted(((i is None, i or 0), len(toks(t)), sum(w in count for w in toks(t)), n, round(sum(math.log10((count.get(w, 0) + 1) / (n + v + 1)) for w in toks(t)), 6)) for i, t, _ in rows)
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)
    assert lmscore.lm_scores(df.limit(0), public_tokenizers.path("piece_bpe_32k.model")).count() == 0


def test_template_language():
    t = chat.compile_template("{% for m in messages %}{% if loop.first %}<{% endif %}{{ m.role + ':' | upper }}{% if 1 == 2 %}no{% elif m.role in 'user bot' and not loop.last %}+{% else %}-{% endif %}{% endfor %}")
    assert "".join(p for p, _ in t([{"role": "user"}, {"role": "sys"}])) == "<USER:+SYS:-"
    assert chat.fold(chat.parse("a{{ 'b' + 'c' }}{% if 'x' == 'x' %}d{% else %}e{% endif %}")) == [("text", "abcd")]
    for bad in ("{{ m.__class__ }}", "{{ open('x') }}", "{% import os %}", "{% for x in y %}{% endfor %}", "{% if 1 %}", "{{ a | exec }}", "{{ 'a }}"):
        with pytest.raises(chat.TemplateError):
            chat.compile_template(bad)
    for s in ("<|im_end|>", "<\\|x", "<<||", "a<\\\\|b", "", "\\n", "\n"):
        assert chat.unguard(chat.guard(s)) == s and "<|" not in chat.guard(s) and chat.unline(chat.line(s)) == s and "\n" not in chat.line(s)


def test_conversations_read_back(spark):
    import duckdb

    rows = [(1, 0, "user", "hi <|im_end|>"), (1, 1, "assistant", "x" * 1_500_000), (1, 1, "assistant", "b"), (1, 1, "assistant", "b"), (2, None, None, None), (2, 3, "as\\s\nt", "<\\|"),
            (None, 0, "assistant", ""), (3, 0, "assistant", "<")]
    df = spark.createDataFrame([(*r, 1, "q") for r in rows], "conv_id long, turn long, role string, text string, part int, loss string")
    got = chat.digests(chat.format_conversations(df)).collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", [list(r) for r in rows])
    cols = "conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars"
    want = [r for r in con.execute(f"SELECT {cols} FROM ({ORACLE['op6_chat']})").fetchall() if r[0] != -1]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert chat.digests(chat.format_conversations(df.limit(0))).count() == 0


def test_license_scan_is_linear(spark):
    n = 1_000_000
    mit = licenses.SENTENCES["f"]
    rows = [(1, " " * n + mit), (2, mit + "." * n), (3, "\n" * n + mit), (4, mit + " x" + " \t\r" * (n // 3) + "y"), (5, ("a. " * (n // 3) + mit + " ") * 2 + "b"), (6, mit + "\n" + ";" * n + "x")]
    start = time.monotonic()
    got = {r.doc_id: r.licences for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert time.monotonic() - start < 30
    assert {i: got[i] for i in (1, 3, 5)} == {1: "MIT", 3: "MIT", 5: "MIT"} and len(got) == 6
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_license_rules(spark):
    apache = ('Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in compliance\nwith the License. '
              "You may obtain a copy of the License at\n\nhttp://x.y\n")
    rows = [(1, None), (2, ""), (3, "Text. Released under the MIT License. More."), (4, apache), (5, apache + "LICENSED under CC BY-NC 4.0."),
            (6, "you may not use this file except in compliance with the License."), (3, "a " * 100_000 + ". Released  under the MIT licence."), (None, "All rights reserved.")]
    got = sorted((r.doc_id or 0, r.licences) for r in licenses.scan(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, s int")).collect())
    assert got == [(0, "Proprietary"), (1, ""), (2, ""), (3, ""), (3, "MIT"), (4, "Apache-2.0"), (5, "Apache-2.0,CC-BY-NC-4.0"), (6, "")]


def test_wrapped_indented_and_commented_notices(spark):
    import textwrap

    S = licenses.SENTENCES
    bsd = (S["p"], "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
           "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
           "documentation and/or other materials provided with the distribution.", "3. " + S["q"])
    notices = {
        "Apache-2.0": (f"{S['b']} {S['c']} {S['d']}", "http://www.apache.org/licenses/LICENSE-2.0", S["e"]),
        "MIT": (S["h"], S["i"]), "GPL-3.0-or-later": (f"{S['k']} {S['l']}",), "BSD-3-Clause": bsd, "BSD-2-Clause": bsd[:3],
    }
    rows, want = [], {}
    for name, paragraphs in notices.items():
        for width in (40, 72):
            for mark in ("", "    ", "\t", "# ", " * ", "// ", "; ", ";; ", "-- ", "! "):
                body = [x for k, q in enumerate(paragraphs) for x in ([""] if k else []) + textwrap.wrap(q, width, subsequent_indent="    ", break_long_words=False)]
                rows.append((len(rows), "\n".join((mark + x).rstrip() for x in ["Copyright 2020 Someone", "", *body, "", "int main() {}"])))
                want[rows[-1][0]] = name
    rows += [(1000, "Released under\n\nthe MIT License."), (1001, "Text of no end\n  Released under\n  the MIT License.\nMore"), (1002, "x\n" * 3000 + "All rights\n Reserved.")]
    want |= {1000: "", 1001: "MIT", 1002: "Proprietary"}
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: r.licences for i, r in got.items()} == want


def test_rollup_is_idempotent_and_additive(spark, scratch):
    r = rollup.TokenRollup(spark, scratch("rollup"))
    schema = "source string, lang string, tokenizer string, before long, after long"
    df = lambda rows: spark.createDataFrame(rows, schema)
    assert r.totals().count() == 0
    assert r.commit("b1", df([("a", "en", "w", None, 10), ("a", "en", "w", None, 5), (None, None, "w", None, 0)]))
    assert r.commit("b2", df([("a", "en", "w", 5, None), ("a", "en", "w", 10, 7)]))
    assert not r.commit("b2", df([("a", "en", "w", 5, None)]))
    assert r.commit("b3", df([]))
    assert {tuple(x) for x in r.totals().collect()} == {("a", "en", "w", 1, 7), (None, None, "w", 1, 0)}
    assert r.commit("b4", df([("a", "en", "w", 7, None)]))
    assert {tuple(x) for x in r.totals().collect()} == {(None, None, "w", 1, 0)}


def test_pipeline_against_the_stages_by_hand(spark):
    from tests.llm.test_simhash import brute

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one = corpus_pipeline.drop_toxic(spark, docs, SF).collect()
    two = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(one, docs.schema), SF).collect()
    assert sorted(r.doc_id for r in two) == sorted({c for *_, c in brute([(r.doc_id, r.text) for r in one])})
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in got} <= {r.doc_id for r in two}
    assert all(sum(x.length for x in got if x.doc_id == i) in (n, 2 * n) for i, n in {(r.doc_id, r.doc_tokens) for r in got})


def test_features_of_many_texts_are_those_of_each(spark, monkeypatch):
    texts = [None, b"", b"  ", b"you i d i o t there", b"\x01a b c\x02 x y z", b"\xc3\xa9 a b c", b"\xff\xfe id1ot, idiiot", b"you are an id!ot\x1f x", b"plain words"]
    lm = toxicity.language_model(np.ones(toxicity.SYMBOLS**3))
    each = [sorted(toxicity.Reader(lm).features(x)) for x in texts]
    monkeypatch.setattr(toxicity, "VOLUME", 20)  # a few texts at once
    row, f = toxicity.Reader(lm).pairs(pa.array([b"cut off", *texts], pa.binary()).slice(1))
    assert [f[row == i].tolist() for i in range(len(texts))] == each
    # readings that cannot matter are not searched, and the rest is as without the short cut
    for keep in ({x: 1 for x in each[6]}, {x: 1 for x in toxicity.word_features(b"idiot")}, {}):
        got = [sorted(toxicity.Reader(lm, keep).features(x)) for x in texts]
        assert got == [[x for x in fs if x in keep] for fs in each]
    assert set(toxicity.ways("id1iot,")) == {x + y + "ot" for x in ("id",) for y in ("ii", "li", "i")}
    assert toxicity.restore("idiiot", lm.tolist()) in toxicity.ways("idiiot") and toxicity.ways("1" * 9) is None


def test_trigrams_of_joined_texts_are_those_of_each(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "GRAM_ROWS", 3)
    texts = [None, b"", b"ab", b" x ", b"", b"\xc3\xa9", b"a"]
    got = toxicity.trigram_counts(spark.createDataFrame([(x,) for x in texts], "t binary").coalesce(1))
    want = np.zeros_like(got)
    for x in texts:
        c = toxicity.CLASS[np.frombuffer(b"  " + (x or b"") + b" ", dtype=np.uint8)]
        np.add.at(want, (c[:-2] * toxicity.SYMBOLS + c[1:-1]) * toxicity.SYMBOLS + c[2:], 1)
    assert (got == want).all()

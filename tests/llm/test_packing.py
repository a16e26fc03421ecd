import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from reviewlake.llm import packing
from reviewlake.llm.queries import Q
from reviewlake.llm.tokens import word_ids

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, got):
    tok = Tokenizer.from_file(PATH)
    want = sorted(([*tok.encode(t or "", add_special_tokens=False).ids, 1] for _, t in rows), key=len)
    by_seq, docs = {}, {}
    for r in got:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
        docs.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.length, r.ids_crc32))
    for parts in by_seq.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 2048
    assert sum(r.length for r in got) == sum(map(len, want))
    rows_of = Counter((i, len(tok.encode(t or "", add_special_tokens=False).ids) + 1) for i, t in rows)
    for i, t in rows:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4")
        pieces = docs[(i, len(ids))]
        for s, n, crc in pieces:
            assert zlib.crc32(ids[s : s + n].tobytes()) == crc
        if rows_of[i, len(ids)] == 1:  # each id lies in exactly one piece
            starts = sorted((s, n) for s, n, _ in pieces)
            assert [s for s, _ in starts] == [sum(n for _, n in starts[:j]) for j in range(len(starts))]
            assert sum(n for _, n in starts) == len(ids)
    return by_seq


def test_query_against_the_tokenizer(spark):
    got = Q["op4_packing"](spark, SF).collect()
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    seqs = check(rows, got)
    total = sum(r.length for r in got)
    assert len(seqs) * 2048 <= total * 1.03 + 2048


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "word " * 9000), (3, "word " * 9000), (None, "Ünï’s “x” <|endoftext|> a"), (5, "İstanbul ΑΣ  12½")]
    df = spark.createDataFrame([(*r, 0, "g") for r in rows], "doc_id long, text string, offset int, `group` string")
    got = packing.pack_documents(df, PATH).collect()
    check(rows, got)
    assert packing.pack_documents(df.limit(0), PATH).count() == 0


def test_real_sequences_hold_the_ids(spark):
    df = spark.createDataFrame([(i, f"some words number {i} " * 40) for i in range(50)], "doc_id long, text string")
    from reviewlake.llm.common import stage

    seqs = packing.sequences(packing.pack(stage(packing.token_pieces(df, PATH), "p"))).collect()
    tok = Tokenizer.from_file(PATH)
    want = sorted(x for i in range(50) for x in [*tok.encode(f"some words number {i} " * 40, add_special_tokens=False).ids, 1])
    assert sorted(x for r in seqs for x in np.frombuffer(bytes(r.ids), dtype="<u4").tolist()) == want


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("aZé ß'strl1½!?.\t\n\x85\xa0\x1cÀŸſµΣİ“<|>_"), max_size=60))
def test_cached_ids_are_the_librarys(text):
    enc = word_ids(PATH)
    assert np.frombuffer(enc.encode([text])[0], dtype="<u4").tolist() == enc.tok.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 2048), max_size=60))
def test_windows_hold_every_item_once(sizes):
    w = packing.windows_of(sizes, 2048)
    assert sorted(i for p in w for i in p) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in p) <= 2048 for p in w)


def test_differencing_is_near_equal():
    rnd = np.random.default_rng(1)
    sizes = rnd.integers(1, 513, 800).tolist()
    loads = [sum(sizes[i] for i in p) for p in packing.differencing(sizes, 96)]
    assert max(loads) - min(loads) <= 12

"""Phrase collocation mining with HAT-trie counting.

Texts are cut into pieces and words; phrases never cross a piece, counts are per language.
A task counts phrases in a HAT-trie: a shallow trie over the digits of word ids whose leaves
are hash containers of the remaining word ids.  A container that grows past ``BURST`` entries
bursts into sixteen by the next digit.  When all containers together pass ``ENTRIES``, the largest
subtrees are spilled whole, as sorted runs; the rest goes on counting, and what is left at
the end is spilled too.  Spark merges the runs per prefix partition: runs are dealt by a
phrase's first words (in the passes by hash, by that) and equal phrases are added up there.
Memory per task is bounded, and a phrase that fills a third of all texts is a few rows per task.

Three passes.  A phrase can only reach the least count if every shorter phrase inside it
does.  The first pass counts words and pairs by a 64-bit hash, the second so counts the
phrases of three words whose pairs have reached it; what reaches it marks a bit set each
time (its size follows the number of marks up to ``MOST_BITS``).  The third counts, exactly and by text,
the phrases all of whose parts are marked.  A false mark costs time, never a result: the
exact counts decide.

Scores, drops and ranks are DataFrame joins on the frequent phrases only.

Edge cases, all defined: null texts are empty, a null language is ``und``; an empty table
or no frequent phrase gives no rows; texts are read whole (a long one in overlapping
chunks, cut between words); repeated rows count again; ids are not needed, and extra columns are ignored.
"""

from __future__ import annotations

import operator
import re
from collections import defaultdict
from itertools import count, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlake.llm.common import pick, stage

LONGEST = 4  # words of a phrase; a key holds three further word ids of 21 bits
ID_BITS = 21
ID = (1 << ID_BITS) - 1
BURST = 1 << 14  # entries of a container
ENTRIES = 600_000  # entries of a task's tries
VOCABULARY = 1 << 19  # word ids of a task
CHUNK = 1 << 20  # bytes of text that are counted together
MOST_BITS = 1 << 30  # of the bit set (128 MB)
DIGIT = 4  # bits of a word id that a burst uses up

_BREAK = b".,;:!?\n\x0b\x0c\r"  # fixed by the contract: pieces end here
_PIECES = bytes.maketrans(_BREAK, b"\xff" * len(_BREAK))  # \xff is in no UTF-8 text
_GAP = re.compile(rb"[ \t\xff]")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class HatTrie:
    """Counts per phrase.  A phrase is one integer, its word ids packed with word 1 lowest, so
    that the trie's digits run through the first word's id, then the second's.  The root has
    256 subtrees; every other inner node has sixteen."""

    def __init__(self, burst: int = BURST):
        self.burst, self.root, self.size = burst, [{} for _ in range(256)], [0] * 256

    @property
    def entries(self) -> int:
        return sum(self.size)

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Adds the counts of distinct packed phrases."""
        for i, k, n in self._deal(keys, counts, 8):
            new = self._into(self.root[i], k, n)
            if type(self.root[i]) is dict and len(self.root[i]) > self.burst:
                self.root[i] = self._split(self.root[i])
            self.size[i] += new

    @staticmethod
    def _deal(keys: np.ndarray, counts: np.ndarray, bits: int):
        digit = (keys & ((1 << bits) - 1)).astype(np.int64)
        order = np.argsort(digit, kind="stable")
        digit, keys, counts = digit[order], keys[order] >> bits, counts[order]
        edges = np.flatnonzero(np.diff(digit, prepend=-1, append=-1)).tolist()
        for s, e in zip(edges, edges[1:], strict=False):
            yield int(digit[s]), keys[s:e], counts[s:e]

    def _into(self, node, keys: np.ndarray, counts: np.ndarray) -> int:
        if type(node) is dict:
            before, k = len(node), keys.tolist()
            node.update(zip(k, map(operator.add, map(node.get, k, repeat(0)), counts.tolist()), strict=True))
            return len(node) - before
        new = 0
        for i, k, n in self._deal(keys, counts, DIGIT):
            new += self._into(node[i], k, n)
            if type(node[i]) is dict and len(node[i]) > self.burst:
                node[i] = self._split(node[i])
        return new

    @staticmethod
    def _split(box: dict[int, int]) -> list:
        out: list = [{} for _ in range(1 << DIGIT)]
        for r, n in box.items():
            out[r & 15][r >> DIGIT] = n
        return out

    def _walk(self, node, low: int, bits: int, wide: bool):
        if type(node) is dict:
            if node:
                keys = np.fromiter(node.keys(), object if wide else np.int64, len(node))
                yield (keys << bits) | low, np.fromiter(node.values(), np.int64, len(node))
        else:
            for i, child in enumerate(node):
                yield from self._walk(child, low | i << bits, bits + DIGIT, wide)

    def spill(self, keep: int = 0, wide: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Takes whole subtrees out, largest first, until at most ``keep`` entries are left:
        (packed phrases, counts).  ``wide``: the phrases may pass 63 bits."""
        found = []
        left = self.entries
        for i in sorted(range(256), key=self.size.__getitem__, reverse=True):
            if left <= keep:
                break
            found += self._walk(self.root[i], i, 8, wide)
            left -= self.size[i]
            self.root[i], self.size[i] = {}, 0
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate([k for k, _ in found]), np.concatenate([n for _, n in found])


class PhraseCounter:
    """A task's tries, one per language, with one vocabulary.

    ``marks`` are the bit sets of the passes before.  Without any, words and pairs are
    counted by hash; with the first, phrases of three words whose pairs are marked; with both,
    phrases of one to four words by text whose pairs and threes are all marked, and the
    words of each language.  ``out`` gets the runs.
    """

    def __init__(self, marks: list[np.ndarray], entries: int = ENTRIES, burst: int = BURST, vocabulary: int = VOCABULARY, chunk: int = CHUNK):
        self.marks, self.limit, self.burst, self.most_words, self.chunk = marks, entries, burst, vocabulary, chunk
        self.tries: dict[str, HatTrie] = {}
        self.words: dict[str, int] = defaultdict(int)
        self.held: dict[str, list[bytes]] = {}
        self.bytes: dict[str, int] = {}
        self.carry: dict[str, list[bytes]] = {}
        self.out: list[pa.RecordBatch] = []
        self._new_vocabulary()

    def _new_vocabulary(self) -> None:
        self.ids: dict[bytes, int] = defaultdict(count(1).__next__)
        self.ids[b"\xff"] = 0
        self.by_id: list[bytes] = []
        self.hashes = np.zeros(1, np.uint64)

    def _known(self) -> None:
        """Text and hash of the ids that are new since the last call."""
        have = max(1, len(self.by_id))
        if len(self.ids) > have:
            if not self.by_id:
                self.by_id.append(b"\xff")
            new = [w for w, _ in zip(reversed(self.ids), range(len(self.ids) - have), strict=False)][::-1]
            self.by_id += new
            self.hashes = np.concatenate([self.hashes, np.fromiter((xxhash.xxh64_intdigest(w, 3) for w in new), np.uint64, len(new))])

    def feed(self, lang: str, text: bytes) -> None:
        text = text.lower().translate(_PIECES)
        at = 0
        while len(text) - at > self.chunk and (cut := _GAP.search(text, at + self.chunk)):
            self._hold(lang, text[at : cut.start()], False)
            at = cut.start()
        self._hold(lang, text[at:], True)

    def _hold(self, lang: str, text: bytes, ends: bool) -> None:
        held = self.held.setdefault(lang, [])
        held.append(text + b"\xff" if ends else text)
        self.bytes[lang] = self.bytes.get(lang, 0) + len(text)
        if self.bytes[lang] >= self.chunk:
            self._count(lang)

    def _count(self, lang: str) -> None:
        tokens = b"".join(self.held[lang]).replace(b"\xff", b" \xff ").split()
        # the next chunk starts with the last three words, so that no phrase is cut
        carry = self.carry.get(lang, [])
        tokens = carry + tokens
        self.carry[lang] = tokens[-(LONGEST - 1) :]
        self.held[lang], self.bytes[lang] = [], 0
        a = np.fromiter(map(self.ids.__getitem__, tokens), np.int64, len(tokens))
        self._known()
        self._grams(lang, a, len(carry))
        while sum(t.entries for t in self.tries.values()) > self.limit:
            largest = max(self.tries, key=lambda x: self.tries[x].entries)
            self._emit(largest, self.tries[largest].entries // 2)
        if len(self.ids) > self.most_words:
            self._flush()
            self._new_vocabulary()

    def _grams(self, lang: str, a: np.ndarray, carried: int) -> None:
        """Counts the phrases of the ids ``a`` that end after the first ``carried`` ones."""
        trie = self.tries.setdefault(lang, HatTrie(self.burst))
        word = a > 0
        if not self.marks:
            ok = {1: word, 2: word[:-1] & word[1:]}
        else:
            h = self._hash(lang, a)
            h2 = self._next(h[:-1], a[1:])
            pair = word[:-1] & word[1:] & self._marked(h2, 0)
            three = pair[:-1] & pair[1:]
            if len(self.marks) == 1:
                ok = {3: three}
            else:
                self.words[lang] += int(word[carried:].sum())
                at = np.flatnonzero(three)
                three[at] = self._marked(self._next(h2[at], a[at + 2]), 1)
                ok = {1: word & self._marked(h, 0), 2: pair, 3: three, 4: three[:-1] & three[1:]}
        for k, good in ok.items():
            i = np.flatnonzero(good)
            i = i[i + k > carried]
            if len(i):
                key = a[i]
                for j in range(1, min(k, 3)):
                    key = key | a[i + j] << (ID_BITS * j)
                if k == LONGEST:  # four ids pass 64 bits: number the first three
                    lead, number = np.unique(key, return_inverse=True)
                    u, n = np.unique(number << ID_BITS | a[i + 3], return_counts=True)
                    key = lead[u >> ID_BITS].astype(object) | (u & ID).astype(object) << (3 * ID_BITS)
                else:
                    key, n = np.unique(key, return_counts=True)
                trie.add(key, n)

    def _hash(self, lang: str, ids: np.ndarray) -> np.ndarray:
        return _mix(self.hashes[ids] + np.uint64(xxhash.xxh64_intdigest(lang.encode(), 5)))

    def _next(self, h: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return _mix(h * np.uint64(0x9E3779B97F4A7C15) + self.hashes[ids])

    def _marked(self, h: np.ndarray, level: int) -> np.ndarray:
        marks = self.marks[level]
        slot = h & np.uint64(64 * len(marks) - 1)
        return (marks[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)

    def _emit(self, lang: str, keep: int = 0) -> None:
        """Spills a language's trie as a sorted run: by hash, or by phrase."""
        exact = len(self.marks) == 2
        keys, n = self.tries[lang].spill(keep, wide=exact)
        if not len(n):
            return
        if not exact:
            h = self._hash(lang, keys & ID)
            for j in (1, 2):
                ids = keys >> (ID_BITS * j) & ID
                h = np.where(ids > 0, self._next(h, ids), h)
            h = h.view(np.int64)
            order = np.argsort(h)
            self.out.append(pa.RecordBatch.from_arrays([pa.array(h[order]), pa.array(n[order])], names=["h", "n"]))
            return
        rows = []
        for key, c in zip(keys.tolist(), n.tolist(), strict=True):
            ws = []
            while key:
                ws.append(self.by_id[key & ID])
                key >>= ID_BITS
            rows.append((b" ".join(ws), b" ".join(ws[:2]), len(ws), c))
        rows.sort()
        phrase, prefix, k, c = zip(*rows, strict=True)
        self._rows([lang] * len(rows), prefix, phrase, k, c)

    def _rows(self, lang, prefix, phrase, k, n) -> None:
        text = lambda x: pa.array(x, pa.binary()).cast(pa.string())
        self.out.append(pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), text(prefix), text(phrase), pa.array(k, pa.int32()), pa.array(n, pa.int64())], names=["lang", "prefix", "phrase", "k", "n"]))

    def _flush(self) -> None:
        for lang in self.tries:
            self._emit(lang)

    def close(self) -> None:
        for lang in self.held:
            self._count(lang)
        self._flush()
        if self.words:
            self._rows(list(self.words), [b""] * len(self.words), [b""] * len(self.words), [0] * len(self.words), list(self.words.values()))


def _pass(docs: DataFrame, lang_col: str, text_col: str, marks: list, schema: str, limits: dict) -> DataFrame:
    src = pick(docs, text_col, lang_col).select(
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary").alias("t"),
    )

    def run(batches):
        counter = PhraseCounter([m.value for m in marks], **limits)
        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("t"), strict=True):
                counter.feed(lang, text.as_py())
                if counter.out:
                    yield from counter.out
                    counter.out.clear()
        counter.close()
        yield from counter.out

    return src.mapInArrow(run, schema)


def _marks(frequent: DataFrame) -> np.ndarray:
    bits = 1 << 16
    n = frequent.count()
    while bits < min(16 * n, MOST_BITS):
        bits *= 2
    slot = F.col("h").bitwiseAND(F.lit(bits - 1))
    words = frequent.select(F.shiftright(slot, 6).cast("int").alias("w"), F.expr("shiftleft(1L, cast(h & 63L as int))").alias("bit"))
    got = words.groupBy("w").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[got.column("w").to_numpy()] = got.column("bits").to_numpy()
    return out.view(np.uint64)


def frequent_phrases(docs: DataFrame, least: int = 30, lang_col: str = "lang", text_col: str = "text", **limits) -> DataFrame:
    """(lang, phrase, k, n): exact counts of every phrase of one to four words that occurs at
    least ``least`` times in its language, and with k = 0 the words of each language."""
    marks = []
    for level in ("pairs", "threes"):
        counted = _pass(docs, lang_col, text_col, list(marks), "h long, n long", limits).groupBy("h").agg(F.sum("n").alias("n"))
        frequent = stage(counted.where(F.col("n") >= least).select("h"), level)
        marks.append(docs.sparkSession.sparkContext.broadcast(_marks(frequent)))
    runs = _pass(docs, lang_col, text_col, marks, "lang string, prefix string, phrase string, k int, n long", limits)
    merged = runs.repartition("lang", "prefix").groupBy("lang", "prefix", "phrase", "k").agg(F.sum("n").alias("n"))
    return stage(merged.where((F.col("k") == 0) | (F.col("n") >= least)).select("lang", "phrase", "k", "n"), "phrases")


def collocations(
    docs: DataFrame, least: int = 30, top: int = 2000, covered: int = 80, lang_col: str = "lang", text_col: str = "text", **limits
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of two to four words per language.

    ``score`` is floor(2000000 * a / (l + r)) at the cut that gives the least.  Phrases inside a
    longer one with at least ``covered`` percent of their count are dropped.
    """
    f = frequent_phrases(docs, least, lang_col, text_col, **limits)
    totals = f.where("k = 0").select("lang", F.col("n").alias("total"))
    part = f.where("k > 0").select("lang", "phrase", "n")
    cands = f.where("k > 1").select("lang", "phrase", "k", F.col("n").alias("a"))
    cuts = cands.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1))).select(
        "*", F.expr("substring_index(phrase, ' ', cut)").alias("left"), F.expr("substring_index(phrase, ' ', cut - k)").alias("right")
    )
    cuts = cuts.join(part.toDF("lang", "left", "l"), ["lang", "left"]).join(part.toDF("lang", "right", "r"), ["lang", "right"])
    score = F.expr("(2000000 * cast(a as decimal(20, 0))) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))")
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("b"))
    # every shorter phrase inside a candidate, with the largest count it is covered by
    w = F.split("phrase", " ")
    spans = F.expr("flatten(transform(sequence(2, k - 1), m -> transform(sequence(1, k - m + 1), s -> concat_ws(' ', slice(w, s, m)))))")
    inside = cands.where("k > 2").withColumn("w", w).select("lang", F.explode(spans).alias("phrase"), "a")
    inside = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = best.join(inside, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * covered))
    order = Window.partitionBy("lang").orderBy(F.desc("b.score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(F.broadcast(totals), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "b.l", "b.r", F.col("total").alias("n"), "b.score"
    )

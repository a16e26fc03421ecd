"""Exact Jaccard self-join over word shingles: size-banded tiles, bitmap bounds, sorted-array checks.

A document is the set of its distinct word shingles, kept as 64-bit hashes.  Two sets
link when 100 * intersection >= percent * union.

Tiles.  Sizes are cut into bands so that linked sets lie in one band or in two
neighbouring ones.  Linked sets of a band differ in at most ``d`` shingles; each set is
therefore dealt by hash into ``d + 1`` parts, and at least one part must be the same on
both sides (pigeonhole).  A tile is (band, part, content of the part): only sets that
meet in a tile are compared, and no linked pair misses every tile.  Each set stands in
the tiles of its own band and, as a visitor, in those of the next band.

Bounds.  A set has a bitmap of 512 parity bits, one per hash bucket.  The bits in which
two bitmaps differ bound the shingles in which the sets differ from below, hence their
overlap from above; pairs whose bound is too small go inside the tile join, before they
are rows.  What is left is checked by intersecting the sorted arrays.

Large groups.  Equal sets are one class.  In each tile all classes are first checked
against one hub (the smallest).  A hub on the rim of a group of near copies joins few of
them, and all pairs across the parts left would be the square of the group; in crowded
tiles, rounds therefore follow in which ever larger samples of the members (8, 64, 512,
...) are hubs, each checked against the members of other components only.  A member with
many links meets a hub early and leaves, one with few makes few pairs in any round.  At
last all pairs of different components not yet checked are compared, and in a crowded
tile the members of its main component are never compared among themselves.  Between
members of one component a further link changes nothing, so no link between different
components is lost.

Arrays are not stored: the classes that have a pair left are marked in a bit set of
fixed size, and a second pass over the texts makes arrays for marked rows only (a false
mark costs time, never a result).  No text is ever shuffled.

Edge cases, all defined: a document without words has an empty set, is linked with
nothing and is its own component; null texts are empty; fewer words than a shingle are
one shingle; texts are read whole; null ids take part in links but name no component
(null, where a component has no other id); repeated rows and repeated ids are rows of
their own; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.llm.common import connected, pick, stage

CROWDED = 64  # members from which on a tile has sampled hubs, and its main component a lane of its own
HUBS = 8  # sampled hubs of a crowded tile in the first round; each further round has WIDEN times as many
WIDEN = 8
FEW = 4  # a sample is taken of tiles with more than so many times its hubs
LANES = 8  # longs of parity bits per set
MARKS = 1 << 23  # bits of the mark set (1 MB, sent to every task)
WORDS = 1 << 19  # distinct words a task remembers hashes of
LONGEST = 1 << 40  # sizes the bands reach


def _mix(x: np.ndarray) -> np.ndarray:
    """A full 64-bit finaliser (wraps on purpose)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hash per word, each distinct word hashed once."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word, 7)
        return h


def shingle_set(text: bytes | None, words: WordHashes, shingle: int = 3) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes.  ``bytes.lower`` touches A-Z only and
    ``bytes.split`` splits at \\x20 and \\x09-\\x0D only, the operator's definition of a word."""
    tokens = text.lower().split() if text else []
    if not tokens:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, tokens), np.uint64, len(tokens))
    k = min(shingle, len(h))
    n = len(h) - k + 1
    grams = np.full(n, k, np.uint64)
    for i in range(k):
        grams = _mix(grams * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n])
    return np.unique(grams)


def bands(percent: int, longest: int = LONGEST) -> np.ndarray:
    """First size of each band; a set and its largest possible partner are at most one band apart."""
    out = [1]
    while out[-1] <= longest:
        out.append(max(out[-1] + 1, out[-1] * 100 // percent + 1))
    return np.array(out, dtype=np.int64)


def parts_of_band(first: np.ndarray, band: int, percent: int) -> int:
    """Parts of a band: one more than the shingles that two linked sets up to its last size may differ in."""
    last = int(first[band + 1]) - 1
    # intersection >= p% of union, so the difference is at most (100 - p) / (100 + p) of both sizes together
    return 2 * last * (100 - percent) // (100 + percent) + 1


def tile_keys(h: np.ndarray, band: int, parts: int) -> np.ndarray:
    """One key per part: a hash of band, part and the part's content (empty parts too)."""
    part = ((h >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)  # ascending, as h is sorted
    content = np.zeros(parts, np.uint64)
    np.add.at(content, part, _mix(h + np.uint64(0x632BE59BD9B4E019)))
    place = np.arange(parts, dtype=np.uint64) + (np.uint64(band) << np.uint64(40))
    return _mix(content + _mix(place * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)))


def parity(h: np.ndarray) -> np.ndarray:
    """512 parity bits: bit b is the count of hashes in bucket b, mod 2."""
    odd = np.bincount((h & np.uint64(64 * LANES - 1)).astype(np.int64), minlength=64 * LANES) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def signatures(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int) -> DataFrame:
    """(id, t1, t2, n, c1, c2, bits, home, visit) per row: text hashes, set size, set
    digest, parity bits and tile keys.  One narrow pass."""
    t = F.col(f"`{text_col}`")
    src = pick(docs, id_col, text_col).select(
        F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.lit(1), t).alias("t1"), F.xxhash64(F.lit(2), t).alias("t2"), t.cast("binary").alias("t")
    )
    first = bands(percent)
    longs = T.ArrayType(T.LongType())
    schema = src.drop("t").schema.add("n", "long").add("c1", "long").add("c2", "long").add("bits", longs).add("home", longs).add("visit", longs)

    def run(batches):
        words = WordHashes()
        for b in batches:
            for at in range(0, b.num_rows, 256):
                p = b.slice(at, 256)
                n, digests, bits, home, visit = [], [], [], [], []
                for text in p.column("t").to_pylist():
                    h = shingle_set(text, words, shingle)
                    n.append(len(h))
                    d = xxhash.xxh128_intdigest(h.tobytes())
                    digests.append((d >> 64, d & (1 << 64) - 1))
                    band = int(np.searchsorted(first, len(h), side="right")) - 1
                    here = parts_of_band(first, band, percent) if len(h) else 0
                    after = parts_of_band(first, band + 1, percent) if len(h) else 0
                    # where no shingle may differ, linked sets are equal, and those are one class
                    home.append(_signed(tile_keys(h, band, here)) if here > 1 else [])
                    visit.append(_signed(tile_keys(h, band + 1, after)) if after > 1 else [])
                    bits.append(parity(h) if here > 1 or after > 1 else [])
                c = np.array(digests, dtype=np.uint64).reshape(-1, 2)
                made = [pa.array(n, pa.int64()), pa.array(_signed(c[:, 0].copy())), pa.array(_signed(c[:, 1].copy()))]
                made += [pa.array(x, pa.list_(pa.int64())) for x in (bits, home, visit)]
                yield pa.RecordBatch.from_arrays([p.column(x) for x in ("id", "t1", "t2")] + made, names=[f.name for f in schema])

    return src.mapInArrow(run, schema)


def _marks(needed: DataFrame) -> np.ndarray:
    """The text hashes of ``needed`` as a bit set of fixed size."""
    slot = F.pmod("t1", F.lit(MARKS))
    words = needed.select((slot / 64).cast("int").alias("w"), F.expr("shiftleft(1L, cast(pmod(t1, 64) as int))").alias("bit"))
    got = words.groupBy("w").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(MARKS // 64, np.int64)
    out[got.column("w").to_numpy()] = got.column("bits").to_numpy()
    return out


def arrays(docs: DataFrame, needed: DataFrame, text_col: str, shingle: int) -> DataFrame:
    """(cid, h): the sorted array of every class in ``needed`` (cid, t1, t2), made anew from the texts."""
    t = F.col(f"`{text_col}`")
    src = pick(docs, text_col).select(F.xxhash64(F.lit(1), t).alias("t1"), F.xxhash64(F.lit(2), t).alias("t2"), t.cast("binary").alias("t"))
    marks = docs.sparkSession.sparkContext.broadcast(_marks(needed))

    def run(batches):
        words, bits, done = WordHashes(), marks.value, set()
        for b in batches:
            t1 = b.column("t1").to_numpy()
            slot = t1 % MARKS
            rows = np.flatnonzero(bits[slot // 64] >> (slot % 64) & 1)
            for at in range(0, len(rows), 64):
                out = []
                for r in rows[at : at + 64].tolist():
                    key = (int(t1[r]), b.column("t2")[r].as_py())
                    if key not in done:  # a copy in the same task is made once
                        if len(done) >= WORDS:
                            done.clear()
                        done.add(key)
                        out.append((*key, shingle_set(b.column("t")[r].as_py(), words, shingle).tobytes()))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, ty) for c, ty in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["t1", "t2", "h"])

    made = src.mapInArrow(run, "t1 long, t2 long, h binary")
    return made.join(needed, ["t1", "t2"]).groupBy("cid").agg(F.max("h").alias("h"))


def linked_pairs(docs: DataFrame, pairs: DataFrame, classes: DataFrame, text_col: str, shingle: int, percent: int, name: str) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets link, by intersecting their sorted arrays."""
    pairs = stage(pairs.distinct(), f"{name}-pairs")
    if pairs.isEmpty():
        return pairs
    ends = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct()
    needed = stage(classes.select("cid", "t1", "t2").join(ends, "cid"), f"{name}-needed")
    h = stage(arrays(docs, needed, text_col, shingle), f"{name}-arrays")
    both = pairs.join(h.toDF("a", "ha"), "a").join(h.toDF("b", "hb"), "b").select("a", "b", "ha", "hb")

    def run(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column("ha"), b.column("hb"), strict=True):
                p, q = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
                same = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * same >= percent * (len(p) + len(q) - same))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(c).filter(mask) for c in ("a", "b")], names=["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, percent: int = 90
) -> DataFrame:
    """(id, n_shingles long, component_id, n_set long): one row per document.  ``component_id``
    is the smallest id reachable over links, ``n_set`` the documents of the same set."""
    sets = stage(signatures(docs, id_col, text_col, shingle, percent), "sets")
    # equal sets are one class; a task's copies meet before the shuffle
    digest = ["n", "c1", "c2"]
    classes = sets.where("size(bits) > 0").groupBy(*digest).agg(F.first(F.struct("t1", "t2", "bits", "home", "visit")).alias("s"))
    lanes = [F.col("s.bits")[i].alias(f"b{i}") for i in range(LANES)]
    classes = stage(classes.select(F.monotonically_increasing_id().alias("cid"), *digest, "s.t1", "s.t2", "s.home", "s.visit", *lanes), "classes")
    bits = [f"b{i}" for i in range(LANES)]

    def keys(kind: str) -> DataFrame:
        return classes.select(F.explode(kind).alias("key"), F.lit(kind == "home").alias("own"), "cid")

    members = keys("home").union(keys("visit"))
    hubs = members.groupBy("key").agg(F.min("cid").alias("hub"), F.max("cid").alias("last"), F.max("own").alias("own"), F.count(F.lit(1)).alias("m"))
    hubs = stage(hubs.where("hub < last AND own").select("key", "hub", "m"), "hubs")
    tiles = stage(members.join(hubs, "key"), "tiles")

    narrow = classes.select("cid", "n", *bits)

    def near(left: str, right: str):
        """The sizes and the parity bits allow a link."""
        differ = reduce(lambda p, q: p + q, [F.bit_count(F.col(f"{left}{b}").bitwiseXOR(F.col(f"{right}{b}"))) for b in bits])
        total = F.col(f"{left}n") + F.col(f"{right}n")
        small, large = F.least(f"{left}n", f"{right}n"), F.greatest(f"{left}n", f"{right}n")
        return (small * 100 >= large * percent) & (differ * (100 + percent) <= total * (100 - percent))

    def side(prefix: str, cid: str) -> DataFrame:
        return narrow.select(F.col("cid").alias(cid), *[F.col(c).alias(prefix + c) for c in ["n", *bits]])

    # first links: every class of a tile with the tile's hub
    stars = tiles.where("cid <> hub").select(F.col("cid").alias("a"), F.col("hub").alias("b")).distinct()
    stars = stars.join(side("p", "a"), "a").join(side("q", "b"), "b")
    first = linked_pairs(docs, stars.where(near("p", "q")).select("a", "b"), classes, text_col, shingle, percent, "stars")
    comps = connected(first, "stars")
    labelled = narrow.join(comps, narrow.cid == comps.node, "left").select("cid", "n", *bits, F.coalesce("comp", "cid").alias("comp"))
    in_tiles = stage(labelled.join(tiles.select("cid").distinct(), "cid", "left_semi"), "labelled")

    def merged(labels: DataFrame, links: DataFrame, name: str) -> DataFrame:
        """``labels`` after the components that ``links`` (a, b) join have become one."""
        label = labels.select("cid", "comp")
        joined = links.join(label.toDF("a", "ca"), "a").join(label.toDF("b", "cb"), "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
        found = connected(joined, name)
        return labels.join(found, labels.comp == found.node, "left").select("cid", "n", *bits, F.coalesce(found.comp, labels.comp).alias("comp"))

    sent, kept = ([F.col(c).alias(x + c) for c in ["cid", "own", "comp", "n", *bits]] for x in "pq")
    other = (F.col("pcomp") != F.col("qcomp")) & (F.col("pown") | F.col("qown"))
    ends = [F.least("pcid", "qcid").alias("a"), F.greatest("pcid", "qcid").alias("b")]
    # a member's place in its tile's random order, about; the same classes come first in all tiles
    place = F.pmod(F.xxhash64(F.lit(3), "cid"), F.lit(1 << 31)) / F.lit(1 << 31) * F.col("m")

    # sampled hubs of crowded tiles against the members of other components, in rounds of ever more hubs
    hubs_of, done, k = F.lit(0), 0, HUBS  # hubs_of: the hubs a tile has had; done: those of one that is in all rounds
    while True:
        large = tiles.where((F.col("m") >= CROWDED) & (F.col("m") > FEW * k)).select("key", "own", "m", "cid")
        seats = stage(large.join(in_tiles, "cid"), "round-seats")
        mixed = stage(seats.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key"), "round-mixed")
        if mixed.isEmpty():
            break
        seats = seats.join(mixed, "key").where(place >= done)
        met = seats.select("key", *sent).join(seats.where(place < k).select("key", *kept), "key").where(other & near("p", "q"))
        links = linked_pairs(docs, met.select(*ends), classes, text_col, shingle, percent, "round")
        in_tiles = stage(merged(in_tiles, links, "round"), "labelled")
        hubs_of, done, k = F.when(F.col("m") > FEW * k, k).otherwise(hubs_of), k, k * WIDEN

    # then pairs of different components, with lanes for crowded tiles
    seats = stage(tiles.select("key", "own", "m", "cid").join(in_tiles, "cid"), "seats")
    crowded = stage(
        seats.groupBy("key", "m", "comp").agg(F.count(F.lit(1)).alias("of"))
        .groupBy("key", "m").agg(F.max_by("comp", F.struct("of", "comp")).alias("main"), F.count(F.lit(1)).alias("k"))
        .where("k > 1").select("key", F.when(F.col("m") >= CROWDED, F.col("main")).alias("main")),
        "crowded",
    )
    # tiles of one component only are done, and so are hubs
    seats = seats.join(crowded, "key").where((F.col("m") < CROWDED) | (place >= hubs_of))
    hits = seats.select("key", F.when(F.col("comp") == F.col("main"), 1).otherwise(0).alias("lane"), *kept)
    probes = seats.where("main IS NULL OR comp <> main").select("key", F.lit(0).alias("lane"), *sent)
    probes = probes.union(seats.where("comp <> main").select("key", F.lit(1).alias("lane"), *sent))
    met = probes.join(hits, ["key", "lane"]).where(other & ((F.col("lane") == 1) | (F.col("pcid") < F.col("qcid"))) & near("p", "q"))
    links = linked_pairs(docs, met.select(*ends), classes, text_col, shingle, percent, "links")
    final = merged(in_tiles, links, "links").select("cid", "comp")
    # a set's component: over tiles and links where it has some, else itself; in digests, so that every set has one
    named = classes.select("cid", *digest).join(final, "cid")
    # the smallest id per set first, so that a hot group is one row before components are named
    least = sets.where("n > 0").groupBy(*digest).agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n_set")).join(named.drop("cid"), digest, "left")
    least = stage(least, "least")
    names = least.where("comp IS NOT NULL").groupBy("comp").agg(F.min("least").alias("name"))
    by_set = least.join(names, "comp", "left").select(*digest, F.coalesce("name", "least").alias("component_id"), "n_set")
    rows = sets.select("id", *digest)
    full = rows.where("n > 0").join(by_set, digest).select("id", "n", "component_id", "n_set")
    empty = rows.where("n = 0").select("id", "n", F.col("id").alias("component_id"), F.lit(1).cast("long").alias("n_set"))
    return full.union(empty).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", "n_set")

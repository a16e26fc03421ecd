"""SimHash near-duplicate detection by multi-index hashing.

Fingerprints are 64-bit majorities over the XXH64 hashes of word shingles.  Two
fingerprints link when they differ in at most ``max_bits`` bits.  The 64 bits are
cut into ``segments``; by the pigeonhole principle two linked fingerprints agree
in some segment up to ``max_bits // segments`` bits.  Every fingerprint is listed
in one hash table per segment; a look-up enumerates the small Hamming ball around
its own segment value, fetches the matches from the table and verifies the whole
64-bit distance.

Edge cases, all defined: null and empty texts have fingerprint zero and link like
any other; repeated rows and equal texts share one fingerprint and so one
component; null ids keep their row but never name a component unless the component
has no other id; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations, islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.llm.common import connected, numbered, pick, stage

CROWDED = 64  # members from which on a bucket's main component gets its own lane
CHUNK = 1 << 18  # shingle hashes turned into bit counts at once (16 MB of bits)


def _bit_counts(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.add.reduceat(bits, starts, axis=0, dtype=np.int64)


def _shingle_hashes(words: list[bytes], k: int, seed: int):
    grams = map(b" ".join, zip(*(words[i:] for i in range(k)), strict=False)) if len(words) >= k else iter([b" ".join(words)])
    return map(xxhash.xxh64_intdigest, grams, repeat(seed))


def batch_fingerprints(texts: list[bytes | None], k: int = 4, seed: int = 42) -> np.ndarray:
    """Fingerprints (as signed 64-bit integers) of a list of UTF-8 texts.

    ``bytes.lower`` touches A-Z only and ``bytes.split`` splits at \\x20 and \\x09-\\x0D
    only, which is the operator's definition of a word.
    """
    counts = np.zeros((len(texts), 64), dtype=np.int64)
    totals = np.zeros(len(texts), dtype=np.int64)
    buf: list[np.ndarray] = []
    rows: list[int] = []
    held = 0

    def flush():
        nonlocal held
        if buf:
            sizes = np.array([len(b) for b in buf])
            counts[rows] = _bit_counts(np.concatenate(buf), np.concatenate([[0], np.cumsum(sizes)[:-1]]))
            buf.clear()
            rows.clear()
            held = 0

    for i, t in enumerate(texts):
        words = t.lower().split() if t else []
        if not words:
            continue
        n = totals[i] = max(1, len(words) - k + 1)
        it = _shingle_hashes(words, k, seed)
        if n <= CHUNK:
            buf.append(np.fromiter(it, dtype=np.uint64, count=n))
            rows.append(i)
            held += n
            if held >= CHUNK:
                flush()
        else:  # a very long text is counted chunk by chunk
            while len(h := np.fromiter(islice(it, CHUNK), dtype=np.uint64)):
                counts[i] += _bit_counts(h, np.array([0]))[0]
    flush()
    return np.packbits(2 * counts > totals[:, None], axis=1, bitorder="little").view(np.int64).reshape(-1)


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, seed: int = 42, more: tuple[str, ...] = ()
) -> DataFrame:
    """(id, fp long, ``more`` columns) for every row of ``docs``; one narrow pass, no shuffle."""
    src = pick(docs, id_col, text_col, *more).select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("t"), *more
    )
    schema = T.StructType([T.StructField("id", src.schema["id"].dataType), T.StructField("fp", T.LongType()), *[src.schema[m] for m in more]])

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                fp = batch_fingerprints(part.column(1).to_pylist(), shingle, seed)
                rest = [part.column(2 + i) for i in range(len(more))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fp), *rest], names=["id", "fp", *more])

    return src.mapInArrow(run, schema)


def _segments(n: int) -> list[tuple[int, int]]:
    """(first bit, width) of each segment."""
    edges = [round(i * 64 / n) for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _tables(nodes: DataFrame, segments: int, *more: str) -> DataFrame:
    """One row per fingerprint and segment: (seg, key, fp, ...)."""
    keys = F.array(*[
        F.struct(F.lit(s).alias("seg"), F.shiftrightunsigned("fp", a).bitwiseAND(F.lit((1 << w) - 1)).alias("key"))
        for s, (a, w) in enumerate(_segments(segments))
    ])
    return nodes.select(F.explode(keys).alias("k"), "fp", *more).select("k.seg", "k.key", "fp", *more)


def _ball(table: DataFrame, segments: int, radius: int) -> DataFrame:
    """Every segment value within ``radius`` flips of a row's own, one row each.

    A pair whose segments differ is met from both sides; only the side that holds
    0 in the lowest differing bit enumerates the flip, so that each pair is met once.
    """
    out = []
    for s, (_, w) in enumerate(_segments(segments)):
        masks = [0] + [sum(1 << b for b in bits) for r in range(1, radius + 1) for bits in combinations(range(w), r)]
        lit = F.array(*[F.lit(m).cast("long") for m in masks])
        out.append((s, lit))
    masks = F.when(F.col("seg") == 0, out[0][1])
    for s, lit in out[1:]:
        masks = masks.when(F.col("seg") == s, lit)
    rows = table.withColumn("flip", F.explode(masks))
    lowest = F.col("flip").bitwiseAND(-F.col("flip"))
    return rows.where(F.col("key").bitwiseAND(lowest) == 0).withColumn("key", F.col("key").bitwiseXOR(F.col("flip"))).drop("flip")


def fingerprint_components(fps: DataFrame, max_bits: int = 4, segments: int = 3) -> DataFrame:
    """(fp, comp) for every distinct fingerprint in ``fps``; comp is the smallest
    fingerprint reachable over links of at most ``max_bits`` differing bits.

    Two passes keep large groups of near copies linear.  First every table bucket
    is linked to one hub (its smallest fingerprint), which joins most of a group.
    Then the Hamming balls are enumerated and every pair that meets in a bucket is
    verified, except pairs that are in one component already: between such pairs a
    link changes nothing.  No other pair is skipped, so no link is lost.
    """
    nodes = stage(fps.select("fp").distinct(), "nodes")
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= max_bits

    index = _tables(nodes, segments)
    hubs = index.groupBy("seg", "key").agg(F.min("fp").alias("other"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    stars = index.join(hubs, ["seg", "key"]).where((F.col("fp") != F.col("other")) & near)
    first = connected(stars.select(F.col("fp").alias("a"), F.col("other").alias("b")), "stars")
    nodes = stage(
        nodes.join(first, nodes.fp == first.node, "left").select("fp", F.coalesce("comp", "fp").alias("comp")), "labelled"
    )

    index = _tables(nodes, segments, "comp")
    # crowded buckets, and the component that most of their members are in
    crowded = stage(
        index.groupBy("seg", "key", "comp").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("seg", "key").agg(F.sum("n").alias("n"), F.max_by("comp", F.struct("n", "comp")).alias("main"))
        .where(F.col("n") >= CROWDED).drop("n"),
        "crowded",
    )
    # members of a main component stand in a lane of their own, which only probes of other
    # components enter: a large group's members are never compared with each other
    hits = index.join(crowded, ["seg", "key"], "left").select(
        "seg", "key", F.when(F.col("comp") == F.col("main"), 1).otherwise(0).alias("lane"),
        F.col("fp").alias("other"), F.col("comp").alias("comp2"),
    )
    probes = _ball(index, segments, max_bits // segments).select("seg", "key", "fp", "comp")
    more = probes.join(crowded, ["seg", "key"]).where("comp <> main").select("seg", "key", F.lit(1).alias("lane"), "fp", "comp")
    probes = probes.select("seg", "key", F.lit(0).alias("lane"), "fp", "comp").union(more)
    links = probes.join(hits, ["seg", "key", "lane"]).where((F.col("comp") != F.col("comp2")) & near)
    second = connected(links.select(F.col("comp").alias("a"), F.col("comp2").alias("b")), "links")
    return nodes.join(second, nodes.comp == second.node, "left").select("fp", F.coalesce(second.comp, nodes.comp).alias("comp"))


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4, segments: int = 3
) -> DataFrame:
    """One row per document: id, fp (long) and component_id, the smallest id reachable."""
    fps = stage(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    comps = fingerprint_components(fps, max_bits, segments)
    # the smallest id per fingerprint first, so that a hot group is one row before the components are joined
    least = fps.groupBy("fp").agg(F.min("id").alias("least")).join(comps, "fp")
    names = least.groupBy("comp").agg(F.min("least").alias("component_id"))
    by_fp = stage(least.join(names, "comp").select("fp", "component_id"), "by_fp")
    return fps.join(by_fp, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def _row_hash(docs: DataFrame, salt: int):
    """64-bit hash of a whole row.  Spark's hash skips nulls, so what is null is hashed too."""
    parts = []
    for c, f in zip(docs.columns, docs.schema.fields, strict=True):
        col = F.col(f"`{c}`")
        nested = isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType))
        parts += [col.isNull(), F.to_json(col) if nested else col.cast("string")]
    return F.xxhash64(F.lit(salt), *parts)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` with exactly one row of each near-duplicate group: the smallest id (nulls
    last); of rows that share this id, the one with the smallest row hash.  Columns unchanged.

    A row is known by 128 bits of hash over all its columns, never by its id: ids may be
    null or stand for several texts, and every group still keeps its own row.
    """
    columns = docs.columns
    docs, (id_col, text_col) = numbered(docs, id_col, text_col)
    hashed = docs.withColumns({"__a": _row_hash(docs, 1), "__b": _row_hash(docs, 2)})
    fps = stage(fingerprints(hashed, id_col, text_col, shingle, more=("__a", "__b")), "fingerprints")
    comps = fingerprint_components(fps, max_bits)
    # the first row per fingerprint first, so that a hot group is one row before the components are joined
    order = F.struct(F.col("id").isNull().alias("none"), "id", "__a", "__b")
    least = fps.groupBy("fp").agg(F.min(order).alias("least")).join(comps, "fp")
    keep = stage(least.groupBy("comp").agg(F.min("least").alias("k")).select("k.__a", "k.__b"), "keep")
    from pyspark.sql.window import Window

    # row_number() = 1 is limited map-side by Spark before the shuffle, so a row repeated many times stays cheap
    w = Window.partitionBy("__a", "__b").orderBy(f"`{id_col}`")
    once = hashed.withColumn("__n", F.row_number().over(w)).where("__n = 1")
    return once.join(keep, ["__a", "__b"], "left_semi").select(*docs.columns).toDF(*columns)

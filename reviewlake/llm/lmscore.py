"""Language-model scores: marginal document probability over subword lattices.

A word is generated either as a whole, by the training counts of its class of texts
(absolute discounting), or piece by piece, by a unigram vocabulary: then every
segmentation of the word into vocabulary pieces counts, weighted by the pieces'
scores, and a forward recursion over the word's lattice sums them all.  A document's
probability is the sum, in log space, over the text classes of the class prior times
the product of its words and its end.  No label of a scored text is used: the class is
summed out.

The vocabulary and its first scores are those of an existing unigram file (pieces with
scores, in its order of ranks); one round of expected counts over the lattices of all
distinct training words re-weights them.  Nothing that grows with the corpus is
collected or broadcast: word counts are a distributed table, and each block of texts
receives only the counts of its own words.

Edge cases, all defined: a null or empty text is its end alone; words of any length and
any bytes have a lattice (every byte is a piece); repeated rows count and are scored
once each; without training texts the pieces alone give the score; extra columns are
ignored.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.llm.common import crc_bucket, pick, stage

CLASSES = 64  # text classes by hash of the class column; only those with training texts are used
BLOCK_BYTES = 24 << 20  # of text; the words of a block and their counts are what a scoring task holds
DISCOUNT = 0.75
END = b""  # the end of a text, as a word: no real word is empty
TINY = 1e-12

Pieces = dict[bytes, float]


def vocabulary(path: str) -> Pieces:
    """piece -> probability from a sentencepiece file's scores, and every single byte.

    The file's scores are minus the rank of a piece, so a piece weighs 1 / (10 + rank).
    """
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    weight: Counter = Counter()
    for i in range(sp.get_piece_size()):
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i):
            continue
        piece = sp.id_to_piece(i).replace("▁", "").encode().lower()
        if piece:
            weight[piece] += 1.0 / (10.0 - min(sp.get_score(i), 0.0))
    return normalised(weight, 0.3)


def normalised(weight: dict, stop: float) -> Pieces:
    """Probabilities with a floor for every single byte; the stop has its own share."""
    for b in range(256):
        weight[bytes([b])] = weight.get(bytes([b]), 0.0)
    total = sum(weight.values()) or 1.0
    return {p: (1 - stop) * (0.999 * w / total + (0.001 / 256 if len(p) == 1 else 0.0)) for p, w in weight.items()}


def stop_share(pieces: Pieces) -> float:
    return 1 - math.fsum(pieces.values())


def longest(pieces: Pieces) -> int:
    return max(map(len, pieces))


def forward(word: bytes, get, most: int | None = None) -> float:
    """log10 of the summed probability of all segmentations, rescaled as it goes.
    ``most``: the length of the longest piece, where known."""
    n = len(word)
    most = most or n
    alpha = [0.0] * (n + 1)
    alpha[0], scale = 1.0, 0.0
    for i in range(n):
        a = alpha[i]
        if a == 0.0:
            continue
        if a < 1e-200:  # only ever in words of many pieces
            for j in range(i, min(n, i + most) + 1):
                alpha[j] *= 1e200
            a, scale = alpha[i], scale - 200.0
        for j in range(i + 1, min(n, i + most) + 1):
            p = get(word[i:j])
            if p is not None:
                alpha[j] += a * p
    return math.log10(alpha[n]) + scale


def expected_pieces(word: bytes, get, into: dict, most: int | None = None) -> None:
    """Adds the expected number of uses of each piece over all segmentations of ``word``.

    Both passes are rescaled as they go: ``up`` and ``down`` count the steps of 1e200 by place.
    """
    n = len(word)
    most = most or n
    alpha, beta, up, down = [0.0] * (n + 1), [0.0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
    alpha[0] = beta[n] = 1.0
    steps = 0
    for i in range(n + 1):
        if 0.0 < alpha[i] < 1e-200:
            for j in range(i, min(n, i + most) + 1):
                alpha[j] *= 1e200
            steps += 1
        up[i] = steps
        a = alpha[i]
        if a:
            for j in range(i + 1, min(n, i + most) + 1):
                p = get(word[i:j])
                if p is not None:
                    alpha[j] += a * p
    whole = alpha[n]
    if whole <= 0.0:
        return
    steps = 0
    for j in range(n, 0, -1):
        low = max(0, j - most)
        if 0.0 < beta[j] < 1e-200:
            for i in range(low, j + 1):
                beta[i] *= 1e200
            steps += 1
        down[j] = steps
        b = beta[j]
        if not b:
            continue
        for i in range(low, j):
            s = word[i:j]
            p = get(s)
            if p is not None:
                beta[i] += p * b
                if alpha[i] > 0.0:
                    shift = up[n] - up[i] - down[j]
                    if up[n] or down[j]:  # a long word
                        e = math.log10(alpha[i]) + math.log10(p) + math.log10(b) - math.log10(whole) + 200.0 * shift
                        share = 10.0 ** min(e, 0.0) if e > -300.0 else 0.0
                    else:
                        share = alpha[i] * p * b / whole
                    into[s] = into.get(s, 0.0) + share


def words_of(text: bytes | None) -> list[bytes]:
    """ASCII lower case, cut at \\x20 and \\x09-\\x0D: what ``bytes`` itself does."""
    return text.lower().split() if text else []


def _encoded(docs: DataFrame) -> DataFrame:
    """Staged blocks of rows: runs of texts of about BLOCK_BYTES, whose words are numbered
    in the block (0 is the end).  A block is two kinds of rows: its words (no, word and the
    training count n per class; ``first`` marks one row per number) and its texts (id,
    train and code, the compressed numbers of its words)."""
    id_type = docs.schema["id"].dataType
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("no", T.IntegerType()), T.StructField("word", T.BinaryType()),
        T.StructField("class", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("first", T.BooleanType()),
        T.StructField("id", id_type), T.StructField("train", T.BooleanType()), T.StructField("code", T.BinaryType()),
    ])

    def run(batches):
        import zstandard
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int64(), pa.bool_(), to_arrow_type(id_type), pa.bool_(), pa.binary()]
        pack = zstandard.ZstdCompressor(level=1).compress
        block, size = TaskContext.get().partitionId() << 32, 0
        number: defaultdict = defaultdict()
        seen: dict[int, list[np.ndarray]] = {}

        def fresh():
            number.clear()
            number.default_factory = number.__len__
            number[END]  # noqa: B018  the end is number 0 of every block
            seen.clear()

        def batch(size_, **cols):
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[f], k) if f in cols else pa.nulls(size_, k) for f, k in zip(schema.names, kinds, strict=True)], names=schema.names
            )

        def word_rows():
            words = pa.array(list(number), pa.binary())
            left = np.ones(len(words), dtype=bool)
            for k, parts in seen.items():
                n = np.bincount(np.concatenate(parts), minlength=len(words))
                yield k, np.flatnonzero(n), n, words, left
                left &= n == 0
            yield -1, np.flatnonzero(left), np.zeros(len(words), dtype=np.int64), words, left

        def flush():
            for k, at, n, words, left in word_rows():
                for i in range(0, len(at), 100_000):
                    a = at[i : i + 100_000]
                    yield batch(len(a), block=np.full(len(a), block), no=a.astype(np.int32), word=words.take(pa.array(a)),
                                **{"class": np.full(len(a), k, dtype=np.int32)}, n=n[a], first=left[a])

        fresh()
        for b in batches:
            out: list[tuple] = []
            for i, k, train, t in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if size and size + len(t or b"") > BLOCK_BYTES:
                    if out:
                        yield batch(len(out), **dict(zip(("block", "id", "train", "code"), zip(*out, strict=True), strict=True)))
                        out = []
                    yield from flush()
                    fresh()
                    block, size = block + 1, 0
                size += len(t or b"") + 16
                words = words_of(t)
                nums = np.fromiter(map(number.__getitem__, words), dtype=np.uint32, count=len(words))
                if train:
                    seen.setdefault(k, []).extend((nums, np.zeros(1, dtype=np.uint32)))
                out.append((block, i, train, pack(nums.tobytes())))
            if out:
                yield batch(len(out), **dict(zip(("block", "id", "train", "code"), zip(*out, strict=True), strict=True)))
        yield from flush()

    return stage(docs.mapInArrow(run, schema), "blocks")


def reweighted(words: DataFrame, pieces: Pieces) -> Pieces:
    """Piece probabilities from expected counts over the distinct words of ``words``.
    The result has at most as many entries as the vocabulary file and the 256 bytes."""
    box = words.sparkSession.sparkContext.broadcast(pieces)

    def run(batches):
        into: dict[bytes, float] = {}
        n, get, most = 0, box.value.get, longest(box.value)
        for b in batches:
            for w in b.column(0).to_pylist():
                expected_pieces(w, get, into, most)
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([*into, END], pa.binary()), pa.array([*into.values(), float(n)])], names=["piece", "n"])

    got = words.select("word").mapInArrow(run, "piece binary, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()
    weight = {bytes(r.piece): r.n for r in sorted(got, key=lambda r: bytes(r.piece))}
    n = weight.pop(END, 0.0)
    if not weight:
        return pieces
    weight = {p: weight.get(p, 0.0) + 0.05 for p in pieces}
    return normalised(weight, n / (n + sum(weight.values())))


def _lattices(words: DataFrame, pieces: Pieces) -> DataFrame:
    """Adds ``sub``, the log10 probability of the word by its pieces."""
    box = words.sparkSession.sparkContext.broadcast(pieces)
    schema = T.StructType([*words.schema.fields, T.StructField("sub", T.DoubleType())])

    def run(batches):
        get, stop, most = box.value.get, math.log10(max(stop_share(box.value), TINY)), longest(box.value)
        for b in batches:
            sub = [forward(w, get, most) + stop if w else stop for w in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sub, pa.float64())], names=[f.name for f in schema.fields])

    return words.mapInArrow(run, schema)


def lm_scores(
    docs: DataFrame, vocabulary_path: str, fold: int = 7, held: int = 2,
    id_col: str = "doc_id", text_col: str = "text", class_col: str = "lang",
) -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    k = F.crc32(F.coalesce(F.col(f"`{class_col}`").cast("string"), F.lit("")).cast("binary")) % CLASSES
    src = pick(docs, id_col, text_col, class_col).select(
        F.col(f"`{id_col}`").alias("id"), k.cast("int").alias("class"),
        (crc_bucket(F.col(f"`{id_col}`"), fold) != held).alias("train"), F.col(f"`{text_col}`").cast("binary").alias("t"),
    )
    blocks = _encoded(src)
    rows = blocks.where("word IS NOT NULL").select("block", "no", "word", "class", "n", "first")
    active = sorted(r["class"] for r in rows.where("n > 0").select("class").distinct().collect())  # at most CLASSES
    words = rows.groupBy("word").agg(
        F.sum("n").alias("c"), *[F.sum(F.when(F.col("class") == x, F.col("n")).otherwise(0)).alias(f"c{i}") for i, x in enumerate(active)]
    )
    words = stage(words, "words")
    sums = words.agg(
        F.sum("c").alias("n"), F.count_if(F.col("c") > 0).alias("v"),
        *[f(f"c{i}").alias(f"{a}{i}") for i in range(len(active)) for a, f in (
            ("n", F.sum), ("v", lambda c: F.count_if(F.col(c) > 0)), ("d", lambda c: F.sum(F.when(F.length("word") == 0, F.col(c)).otherwise(0))))],
    ).first()
    n_all, v_all = sums["n"] or 0, sums["v"] or 0
    per = [(sums[f"n{i}"], sums[f"v{i}"], sums[f"d{i}"]) for i in range(len(active))]
    pieces = reweighted(words.where("c > 0 AND length(word) > 0"), vocabulary(vocabulary_path))
    known = _lattices(words, pieces)
    slices = rows.where("first").select("block", "no", "word").join(known, "word").drop("word")

    texts = sum(d for *_, d in per)
    prior = [math.log10(d / texts) for *_, d in per] or [0.0]
    size = np.array([n for n, *_ in per] or [1.0], dtype=float)
    back = np.array([DISCOUNT * v / n for n, v, _ in per] or [1.0])  # what the discount leaves to the pieces
    base_of = math.log10(n_all + v_all + 1)
    id_type = src.schema["id"].dataType
    out = T.StructType([
        T.StructField("id", id_type), T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()), T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType()),
    ])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        order = np.argsort(right.column("no").to_numpy())  # the numbers of a block are 0, 1, 2, ...
        sub = right.column("sub").to_numpy()[order]
        m = 10.0 ** np.maximum(sub, -300.0)[:, None] * back[None, :]
        for i in range(len(per)):
            n = right.column(f"c{i}").to_numpy()[order]
            m[:, i] += np.where(n > 0, n - DISCOUNT, 0.0) / size[i]
        with np.errstate(divide="ignore"):
            m = np.where(m > 1e-290, np.log10(np.maximum(m, 1e-300)), sub[:, None] + np.log10(back)[None, :])
        c = right.column("c").to_numpy()[order]
        base = np.log10(c + 1.0) - base_of
        got: tuple[list, ...] = ([], [], [], [])
        for code in left.column("code").to_pylist():
            i = np.append(np.frombuffer(unpack(code), dtype=np.uint32), 0).astype(np.int64)
            got[0].append(len(i))
            got[1].append(int(np.count_nonzero(c[i])))
            got[2].append(float(base[i].sum()))
            s = m[i].sum(axis=0) + prior
            top = s.max()
            got[3].append(float(top + np.log10(np.sum(10.0 ** (s - top)))))
        held_out = pa.compute.invert(left.column("train"))
        return pa.table([left.column("id"), held_out, *(pa.array(g) for g in got)], names=[f.name for f in out.fields])

    docs_of = blocks.where("code IS NOT NULL").select(F.col("block").alias("of"), "id", "train", "code")
    scored = docs_of.groupBy("of").cogroup(slices.groupBy("block")).applyInArrow(run, out)
    return scored.withColumnRenamed("id", id_col).withColumn("train_tokens", F.lit(n_all).cast("long"))

"""Packing token streams into near-equal windows by Karmarkar-Karp differencing.

Each document becomes its ids and an end id, cut into full windows and a rest of
pieces of at most ``piece`` ids.  The pieces are dealt by hash into groups of
about ``windows`` windows (the number of groups follows the total, counted from
the pieces themselves).  Within a group the multiway differencing method starts
from one partial partition per piece (k slots, one of them filled) and keeps
merging the two partial partitions of the largest imbalance, the heaviest slots
of one onto the lightest of the other.  A window count that leaves a window over
its capacity is raised until all fit.

Edge cases, all defined: a null or empty text is the end id alone; a text of any
length is cut, never shortened; repeated rows are packed once each; null ids are
kept as null; an empty table gives no piece; extra columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.llm.common import pick, stage
from reviewlake.llm.tokens import slices, word_ids


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = 2048, piece: int = 512, end_id: int = 1,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, doc_tokens, start, length, ids) per piece; ids is a buffer of little-endian
    unsigned 32-bit ids.  Pieces of a document follow each other without gap."""
    src = pick(docs, id_col, text_col).toDF("id", "t")
    schema = T.StructType([
        T.StructField("id", src.schema["id"].dataType), T.StructField("doc_tokens", T.LongType()),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
    ])
    end = np.array([end_id], dtype="<u4").tobytes()
    types = [src.schema["id"].dataType]

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        id_type = to_arrow_type(types[0])
        enc = word_ids(tokenizer)
        for b in batches:
            ids, at = b.column(0).to_pylist(), 0
            for texts in slices(b.column(1).to_pylist()):
                out: list[tuple] = []
                for i, buf in zip(ids[at : at + len(texts)], enc.encode(texts), strict=True):
                    buf += end
                    n, full = len(buf) // 4, len(buf) // (4 * capacity) * capacity
                    starts = [*range(0, full, capacity), *range(full, n, piece)]
                    for s, e in zip(starts, [*starts[1:], n], strict=True):
                        out.append((i, n, s, e - s, buf[4 * s : 4 * e]))
                at += len(texts)
                for k in range(0, len(out), 4096):
                    cols = list(zip(*out[k : k + 4096], strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(cols, (id_type, pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
                        names=["id", "doc_tokens", "start", "length", "ids"],
                    )

    return src.mapInArrow(run, schema)


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Karmarkar-Karp partition of the item numbers 0..n-1 into k lists.

    A partial partition is (loads in descending order, its non-empty slots); only
    differences matter, so the smallest load is taken off all slots.
    """
    heap: list[tuple[int, int, list[int], list[list[int]]]] = []
    for i, s in enumerate(sizes):
        heap.append((-s, i, [s] + [0] * (k - 1), [[i]] + [[] for _ in range(k - 1)]))
    if not heap:
        return [[] for _ in range(k)]
    heapq.heapify(heap)
    tick = len(sizes)
    while len(heap) > 1:
        _, _, la, sa = heapq.heappop(heap)
        _, _, lb, sb = heapq.heappop(heap)
        loads = [x + y for x, y in zip(la, reversed(lb), strict=True)]
        slots = [x + y for x, y in zip(sa, reversed(sb), strict=True)]
        order = sorted(range(k), key=loads.__getitem__, reverse=True)
        low = loads[order[-1]]
        loads, slots = [loads[j] - low for j in order], [slots[j] for j in order]
        heapq.heappush(heap, (-loads[0], tick, loads, slots))
        tick += 1
    return heap[0][3]


def windows_of(sizes: list[int], capacity: int) -> list[list[int]]:
    """Item numbers per window, none above ``capacity``; no size is above it.

    Items of a whole window stand alone.  The window count starts at the least
    possible and rises whenever a window is above its capacity.
    """
    alone = [[i] for i, s in enumerate(sizes) if s == capacity]
    rest = [i for i, s in enumerate(sizes) if s < capacity]
    if not rest:
        return alone
    small = [sizes[i] for i in rest]
    total = sum(small)
    k = max(1, -(-total // capacity))
    while True:
        parts = differencing(small, k)
        over = max(sum(small[i] for i in p) for p in parts)
        if over <= capacity:
            return alone + [[rest[i] for i in p] for p in parts if p]
        k += max(1, (over - capacity) * k // (8 * capacity))


def pack(pieces: DataFrame, capacity: int = 2048, windows: int = 96) -> DataFrame:
    """Adds sequence_id and offset to every row of ``pieces`` (id, start, length and
    whatever else it holds, but for the ids themselves it should be narrow).

    ``pieces`` must be a staged table: it is read twice.  The number of groups is the
    total of all lengths over ``windows`` windows, so a group is as large at any input size.
    """
    total = pieces.agg(F.sum("length")).first()[0] or 0
    groups = max(1, round(total / (capacity * windows)))
    g = F.pmod(F.xxhash64("id", "start", "salt"), F.lit(groups)).alias("group")
    # copies of a row differ in nothing but where they stand in the staged table
    dealt = pieces.withColumn("salt", F.monotonically_increasing_id()).select("*", g)
    out = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["salt"], kind="stable").reset_index(drop=True)
        size = pdf["length"].tolist()
        seq, off = np.zeros(len(pdf), dtype=np.int64), np.zeros(len(pdf), dtype=np.int64)
        base = int(pdf["group"].iloc[0]) << 24
        for w, items in enumerate(windows_of(size, capacity)):
            at = 0
            for i in sorted(items):
                seq[i], off[i] = base + w, at
                at += size[i]
        return pdf.assign(sequence_id=seq, offset=off)[[f.name for f in out.fields]]

    return dealt.groupBy("group").applyInPandas(run, out)


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = 2048, piece: int = 512, windows: int = 96,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Placement of every piece: id, start, length, doc_tokens, ids_crc32 (of the ids'
    buffer), sequence_id, offset.  ``sequences`` joins the ids back for writing."""
    p = token_pieces(docs, tokenizer, capacity, piece, id_col=id_col, text_col=text_col)
    narrow = stage(p.select("id", "doc_tokens", "start", "length", F.crc32("ids").alias("ids_crc32")), "pieces")
    return pack(narrow, capacity, windows).withColumnRenamed("id", id_col)


def sequences(packed_with_ids: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): the training windows, ids joined in offset order.
    A window is bounded by its capacity, so the grouping is too."""
    return packed_with_ids.groupBy("sequence_id").agg(
        F.sum("length").alias("length"),
        F.expr("unhex(array_join(transform(array_sort(collect_list(struct(offset, hex(ids) AS h))), x -> x.h), ''))").alias("ids"),
    )

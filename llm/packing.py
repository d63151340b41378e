"""Operator 8: documents packed into sequences of at most 1024 tokens, by hierarchical best fit.

A document is its ids and an end id. Longer ones are cut so that all pieces
but the first are full; full pieces are sequences of their own. The others are
items: each partition packs its items best fit, largest first. Bins that are
nearly full are emitted; the rest go on as items of their fill, in fewer
partitions, until one partition holds them or a round no longer helps. A task
holds at most about ``ITEMS`` items, a few integers each.

How many partitions there are follows from the number of items, so that the
number of sequences doesn't depend on the session's settings.

Rows: null text is empty: the end id alone. Null and repeated doc_ids are
documents like others. Very long texts are a batch of their own, then cut. Items
of one length are alike; ties go to the earlier one. An empty table gives no
rows. Other columns are not looked at.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import _tables as T
from llm import _words as W
from llm import tokens

SIZE, END = 1024, 2
NEARLY = SIZE - 4  # bins so full are emitted
ITEMS = 100_000  # items in a partition
FAN_IN = 8  # partitions that merge into one


def cuts(n: int, size: int = SIZE) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n tokens."""
    first = n % size or size
    return [(0, min(n, first)), *((s, size) for s in range(first, n, size))]


def _pieces(batches):
    uid = TaskContext.get().partitionId() << 36  # the table is stored before it is read twice
    end = np.array([END], "<u4").tobytes()
    for b in W.slices(batches, "text"):
        out = []
        texts = [(x or b"").decode("utf-8", "replace") for x in b.column("text").to_pylist()]
        for i, ids in zip(b.column("doc_id").to_pylist(), tokens.encode(texts)):
            ids += end
            for k, (start, length) in enumerate(cuts(len(ids) // 4)):
                out.append((uid, i, k, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])))
                uid += 1
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int32() if j == 2 else pa.int64()) for j, x in enumerate(zip(*out))], ["uid", "doc_id", "piece", "start", "length", "ids_crc32"])


def best_fit(lengths: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and the bins' fills; the largest item first, into the fullest bin that takes it."""
    bin_of, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    fill: list[int] = []
    room: list[list[int]] = [[] for _ in range(size + 1)]
    some = 0  # bit r: there is a bin with room r
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        at = some >> n
        if at:
            r = n + (at & -at).bit_length() - 1
            k = room[r].pop()
            if not room[r]:
                some ^= 1 << r
        else:
            r, k = size, len(fill)
            fill.append(0)
        bin_of[i], offset[i] = k, fill[k]
        fill[k] += n
        if not room[r - n]:
            some |= 1 << (r - n)
        room[r - n].append(k)
    return bin_of, offset, np.array(fill, np.int64)


def _packed(batches):
    got = [(b.column("uid").to_numpy(), b.column("length").to_numpy()) for b in batches if b.num_rows]
    if not got:
        return
    uid, length = (np.concatenate(x) for x in zip(*got))
    order = np.argsort(uid)
    uid, length = uid[order], length[order]
    bin_of, offset, fill = best_fit(length)
    first = np.zeros(len(fill), np.int64)
    first[bin_of[offset == 0]] = uid[offset == 0]
    for i in range(0, len(uid), 100_000):
        s = slice(i, i + 100_000)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (uid[s], first[bin_of[s]], offset[s], fill[bin_of[s]])], ["uid", "bin", "offset", "fill"])


def packed(items: DataFrame) -> DataFrame:
    """(uid, sequence_id, offset) of ``items(uid, length)``, lengths from 1 to SIZE."""
    rounds, count = [], items.count()
    width = max(1, -(-count // ITEMS))  # by the items alone: the session's partitions don't bear on the result
    while True:
        placed = T.store(items.repartition(width, "uid").mapInArrow(_packed, "uid long, bin long, offset long, fill long"), "bins")
        rounds.append(placed)
        items = placed.filter((F.col("offset") == 0) & (F.col("fill") < NEARLY)).select(F.col("bin").alias("uid"), F.col("fill").alias("length"))
        left = items.count()
        if not left or width == 1 or (len(rounds) > 1 and left >= 0.99 * count):
            break
        count, width = left, max(-(-width // FAN_IN), -(-left // ITEMS))
    last = rounds.pop()
    out = last.select("uid", F.col("bin").alias("sequence_id"), "offset")
    for placed in reversed(rounds):
        up = out.select(F.col("uid").alias("inner"), F.col("sequence_id").alias("outer"), F.col("offset").alias("moved"))
        out = (placed.join(up, F.when(F.col("fill") < NEARLY, F.col("bin")) == up.inner, "left")
               .select("uid", F.coalesce("outer", "bin").alias("sequence_id"), (F.col("offset") + F.coalesce("moved", F.lit(0))).alias("offset")))
    return out


def pack(docs: DataFrame) -> DataFrame:
    """One row per piece of ``docs(doc_id, text)``: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    pieces = T.store(docs.mapInArrow(_pieces, "uid long, doc_id long, piece int, start long, length long, ids_crc32 long"), "pieces")
    place = packed(pieces.filter(F.col("length") < SIZE).select("uid", "length")).withColumnRenamed("uid", "item")
    return (pieces.join(place, pieces.uid == place.item, "left")
            .select("doc_id", "piece", "start", "length", "ids_crc32", F.coalesce("sequence_id", "uid").alias("sequence_id"), F.coalesce("offset", F.lit(0)).alias("offset")))


def op8_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack(T.documents(spark, sf_dir))

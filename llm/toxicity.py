"""Operator 10: toxicity by FTRL-proximal logistic regression over hashed n-grams and skip-grams.

Features of a text: its distinct words, pairs of adjacent words and pairs with
one word between, hashed to ``SLOTS``. FTRL keeps a rate for each coordinate;
its L1 term leaves most weights at exactly 0, so that the model is a short
list, broadcast with the scoring tasks.

It learns from about ``SAMPLE`` labelled rows, taken by a hash of doc_id, in
one task and in a fixed order. Scoring is one narrow pass over whole texts.

Rates and L1 were chosen inside the labels that may be learned from (crc32 of
doc_id mod 5 from 1 to 4): fitted on remainders 2 to 4, least log loss on 1.

Rows: null and empty texts have no features and score the bias. Labels other
than 0 and 1, and null ids, are not learned from; if a doc_id has several
labels the largest holds. Repeated rows count each; very long texts are a batch
of their own; other columns are not looked at; an empty table gives no rows. Without labels every score is 0.5 and predicted 1.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import _tables as T
from llm import _words as W
from llm.language_id import held_out

SAMPLE = 20_000  # labelled rows learned from
SLOTS = 1 << 20
ALPHA, BETA, L1, L2, PASSES = 2.0, 1.0, 6.0, 0.0, 8  # least log loss on the labels with remainder 1 of those learned from, fitted on 2 to 4
GAP = np.ones(256, bool)  # words are runs of ASCII letters, digits and bytes beyond ASCII
GAP[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Slots of each row's distinct features, ascending, and where each row's begin."""
    h, _, _, first = W.words(column, GAP)
    rows = len(first) - 1
    row = np.repeat(np.arange(rows), np.diff(first))
    parts, whose = [h], [row]
    for step in (1, 2):
        same = row[step:] == row[:-step]
        parts.append(W.mix(h[:-step] * np.uint64(W.BASE) + h[step:] + np.uint64(step))[same])
        whose.append(row[step:][same])
    both = np.sort((np.concatenate(whose).astype(np.uint64) << np.uint64(20)) | (np.concatenate(parts) % np.uint64(SLOTS)))
    both = both[np.concatenate([[True], both[1:] != both[:-1]])] if len(both) else both
    return (both & np.uint64(SLOTS - 1)).astype(np.int32), np.searchsorted(both >> np.uint64(20), np.arange(rows + 1).astype(np.uint64))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def ftrl(rows: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, float]:
    """Weights and bias from (slots, label) rows, in the order given."""
    z, n = np.zeros(SLOTS + 1), np.zeros(SLOTS + 1)  # the last one is the bias, without L1

    def weights(at):
        w = -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        w[np.abs(z[at]) <= L1] = 0
        w[-1] = -z[SLOTS] / ((BETA + np.sqrt(n[SLOTS])) / ALPHA + L2)
        return w

    for _ in range(PASSES):
        for slots, label in rows:
            at = np.append(slots, np.int32(SLOTS))
            w = weights(at)
            g = _sigmoid(w.sum()) - label
            root = np.sqrt(n[at])
            n[at] += g * g
            z[at] += g - (np.sqrt(n[at]) - root) / ALPHA * w
    w = weights(np.arange(SLOTS + 1))
    return w[:-1], float(w[-1])


def _features(batches):
    for b in W.slices(batches, "text"):
        slots, begin = features(b.column("text"))
        cut = [slots[a:e].tobytes() for a, e in zip(begin, begin[1:])]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("toxic").cast(pa.int32()), pa.array(cut, pa.binary())], ["doc_id", "toxic", "slots"])


def _fit(batches):
    rows = [(i, np.frombuffer(s, np.int32), y) for b in batches for i, y, s in zip(*(b.column(c).to_pylist() for c in ("doc_id", "toxic", "slots")))]
    rows.sort(key=lambda r: (W.mix(np.array([r[0]], np.int64).view(np.uint64))[0], len(r[1]), r[1].tobytes()))
    w, bias = ftrl([(s, y) for _, s, y in rows])
    at = np.flatnonzero(w)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, SLOTS)), pa.array(np.append(w[at], bias))], ["slot", "weight"])


def learn(docs: DataFrame, labels: DataFrame) -> dict:
    """Non-zero weights by slot, and the bias at SLOTS."""
    given = labels.filter(~held_out(5, 0) & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    share = int(min(1.0, SAMPLE / max(given.count(), 1)) * float(1 << 64)) - (1 << 63)
    sample = F.broadcast(given.filter(F.xxhash64("doc_id") <= F.lit(min(share, (1 << 63) - 1))))  # about SAMPLE rows of 12 bytes
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    slots = rows.join(sample, "doc_id").mapInArrow(_features, "doc_id long, toxic int, slots binary")
    found = slots.repartition(1).mapInArrow(_fit, "slot long, weight double").collect()  # the bounded sample's features
    return {r.slot: r.weight for r in found}


def score(docs: DataFrame, model: dict) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, held_out, score, predicted."""
    def run(batches):
        w = np.zeros(SLOTS)
        for k, v in model.items():
            if k < SLOTS:
                w[k] = v
        for b in W.slices(batches, "text"):
            slots, begin = features(b.column("text"))
            total = np.concatenate([[0.0], np.cumsum(w[slots])])
            s = _sigmoid(total[begin[1:]] - total[begin[:-1]] + model.get(SLOTS, 0.0))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(5, 0).alias("held_out"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = T.documents(spark, sf_dir)
    return score(docs, learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))

"""Operator 5: passages of benchmark items in documents, by SimHash of item-sized windows.

A window is as many words of a document as an item has. Windows and items are
multisets of word 5-grams; they match at a weighted Jaccard similarity (sum of
the lesser counts over sum of the greater) of 0.8 or more.

Each item length in turn: windows that have too few 5-grams of items of that
length to match are passed over, which loses none. The others get a 256-bit
SimHash. Fingerprints are cut into 16 blocks of 16 bits; of two within RADIUS
bits one block is within RADIUS // 16, so searching each block to that small
radius finds every item within the large one, and about a sixth of unrelated
items. A block's index holds its distinct values, 65536 at most, and which
items have each. What is found is compared in all bits and then verified on
the exact counts. At similarity 0.8 fingerprints differ in 38 bits on average,
with a deviation of 5.7; RADIUS is 61, four deviations away.

Items are broadcast in blocks of at most ``ITEM_BYTES`` of text, so that a
larger benchmark takes more passes, not more memory.

Rows: null and empty texts and items match nothing; items of fewer than five
words are one shingle. Null or repeated doc_ids are reported as they stand.
Items that repeat a text are each reported. Of equal windows the first counts.
Very long texts are a batch of their own. Empty tables of documents or items
give no matches. ``clean`` keeps all other columns, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import _tables as T
from llm import _words as W

WORDS = 256 // 64
RADIUS = 61
BLOCKS = 16  # of 16 bits
PAIRS = 4 << 20  # windows times items that are compared at once
SIMILAR = 0.8
ITEM_BYTES = 16 << 20


def simhash(shingles: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Fingerprints (rows of 64-bit words) of the shingles from begin[i] to begin[i + 1]."""
    out = np.zeros((len(begin) - 1, WORDS), np.uint64)
    for w in range(WORDS):
        h = W.mix(shingles + np.uint64((w + 1) * W.BASE % (1 << 64)))
        for bit in range(64):
            sums = np.concatenate([[0], np.cumsum(((h >> np.uint64(bit)) & np.uint64(1)).astype(np.int64) * 2 - 1)])
            out[:, w] |= ((sums[begin[1:]] - sums[begin[:-1]]) > 0).astype(np.uint64) << np.uint64(bit)
    return out


def _blocks(prints: np.ndarray) -> np.ndarray:
    """The 16-bit blocks of each fingerprint."""
    return np.ascontiguousarray(prints).view(np.uint16).reshape(len(prints), BLOCKS)


class BlockIndex:
    """Fingerprints by the values of their blocks."""

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        self.blocks = [np.unique(x, return_inverse=True) for x in _blocks(prints).T]

    def lookup(self, made: np.ndarray) -> np.ndarray:
        """(fingerprints of ``made``, indexed ones): whether a block is within RADIUS // BLOCKS bits."""
        found = np.zeros((len(made), len(self.prints)), bool)
        for x, (values, which) in zip(_blocks(made).T, self.blocks):
            near = np.bitwise_count(x[:, None] ^ values) <= RADIUS // BLOCKS
            found |= near[:, which]
        return found

    def within(self, made: np.ndarray):
        """(index in ``made``, indexed one, differing bits) of all within RADIUS bits."""
        step = max(1, PAIRS // max(len(self.prints), 1))
        for i in range(0, len(made), step):
            w, r = np.nonzero(self.lookup(made[i : i + step]))
            differ = np.bitwise_count(made[i + w] ^ self.prints[r]).sum(1)
            near = differ <= RADIUS
            yield from zip((i + w[near]).tolist(), r[near].tolist(), differ[near].tolist())


class Items:
    """Benchmark items by length: shingle counts and the index of their fingerprints."""

    def __init__(self, ids: list, texts: list[bytes]):
        h, _, _, first = W.words(pa.array(texts, pa.binary()))
        sh, begin = W.shingles(h, first)
        n_words = np.diff(first)
        self.all = np.unique(sh)
        self.by_length: dict[int, tuple] = {}
        self.of_length: dict[int, np.ndarray] = {}
        for n in np.unique(n_words[n_words > 0]).tolist():
            rows = np.flatnonzero(n_words == n)
            parts = [sh[begin[r] : begin[r + 1]] for r in rows]
            prints = simhash(np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])]))
            self.of_length[n] = np.unique(np.concatenate(parts))
            self.by_length[n] = [ids[r] for r in rows], [np.unique(p, return_counts=True) for p in parts], BlockIndex(prints)


def similarity(x: tuple, y: tuple) -> float:
    """Weighted Jaccard of two multisets, each sorted distinct values and counts."""
    at = np.minimum(np.searchsorted(y[0], x[0]), len(y[0]) - 1)
    both = np.where(y[0][at] == x[0], np.minimum(x[1], y[1][at]), 0).sum()
    return float(both / (x[1].sum() + y[1].sum() - both))


def matches(column: pa.Array, items: Items) -> dict[tuple[int, object], tuple]:
    """Best match of each (row, item id): (similarity, first word of the window, words, differing bits)."""
    h, _, _, first = W.words(column)
    best: dict = {}
    row_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    runs: dict[int, tuple] = {}  # by shingle size: the hashes of all runs of words, and where those of an item stand
    for n, (ids, counts, index) in items.by_length.items():
        if len(h) < n:
            continue
        size, m = min(n, 5), max(1, n - 4)
        if size not in runs:
            sh = _run_hashes(h, size)
            runs[size] = sh, np.flatnonzero(_among(sh, items.all))
        sh, known = runs[size]
        known = known[_among(sh[known], items.of_length[n])]
        least = -(-8 * m // 9)  # a match has so many shingles in common
        if len(known) < least:
            continue
        low, high = known[least - 1 :] - m + 1, known[: len(known) - least + 1]
        low = np.maximum(low, 0)
        some = low <= high
        low, width = low[some], (high - low + 1)[some]
        begin = np.cumsum(width) - width
        enough = np.unique(np.repeat(low - begin, width) + np.arange(width.sum()))
        enough = enough[enough + n <= len(h)]
        enough = enough[row_of[enough] == row_of[enough + n - 1]]
        for i in range(0, len(enough), 4096):
            pos = enough[i : i + 4096]
            flat = sh[pos[:, None] + np.arange(m)]
            made = simhash(flat.ravel(), np.arange(len(pos) + 1) * m)
            of_window: dict[int, tuple] = {}
            for w, r, d in index.within(made):
                if w not in of_window:
                    of_window[w] = np.unique(flat[w], return_counts=True)
                s, p = similarity(of_window[w], counts[r]), int(pos[w])
                key = int(row_of[p]), ids[r]
                if s >= SIMILAR and (key not in best or s > best[key][0]):
                    best[key] = s, p - int(first[row_of[p]]), n, d
    return best


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Membership in a sorted array, which is not empty."""
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _run_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words, as ``W.shingles`` makes it."""
    out = np.full(len(h) - size + 1, W.mix(np.array([size], np.uint64))[0])
    for j in range(size):
        out = W.mix(out * np.uint64(W.BASE) + h[j : len(h) - size + 1 + j])
    return out


def _search(ids: list, texts: list[bytes]):
    def run(batches):
        items = Items(ids, texts)
        for b in W.slices(batches, "text"):
            docs = b.column("doc_id").to_pylist()
            rows = [(docs[r], i, float(s), p, n, d) for (r, i), (s, p, n, d) in matches(b.column("text"), items).items()]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()))],
                                             ["doc_id", "item_id", "similarity", "first_word", "n_words", "differing_bits"])
    return run


def blocks_of(benchmark: DataFrame) -> Iterator[tuple[list, list[bytes]]]:
    """The items in lists of at most about ITEM_BYTES of text, one list after the other on the driver."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text")).filter("octet_length(text) > 0")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = int(total // ITEM_BYTES) + 1
    for k in range(count):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k).collect()
        if rows:
            yield [r.item_id for r in rows], [bytes(r.text) for r in rows]


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of ``docs(doc_id, text)`` and item that it holds: the most similar window, the first of equals."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    kind = "doc_id long, item_id long, similarity double, first_word long, n_words long, differing_bits long"
    out = docs.sparkSession.createDataFrame([], kind)
    for ids, items in blocks_of(benchmark):
        out = out.unionByName(texts.mapInArrow(_search(ids, items), kind))
    return out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no item."""
    def without(ids, texts):
        def run(batches):
            items = Items(ids, texts)
            for batch in batches:
                at = batch.schema.get_field_index("text")
                small = pa.RecordBatch.from_arrays([batch.column(at).cast(pa.binary()), pa.array(range(batch.num_rows))], ["text", "row"])
                bad = np.zeros(batch.num_rows, bool)
                for b in W.slices([small], "text"):
                    for r, _ in matches(b.column("text"), items):
                        bad[b.column("row")[r].as_py()] = True
                yield batch.filter(pa.array(~bad))
        return run

    for ids, texts in blocks_of(benchmark):
        docs = docs.mapInArrow(without(ids, texts), docs.schema)
    return docs


def op5_decontamination(spark, sf_dir: str) -> DataFrame:
    return contamination(T.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))

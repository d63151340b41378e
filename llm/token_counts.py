"""Operator 11: token counts of a byte-level BPE file, by rank-synchronous merging of arrays.

Texts are cut at the file's added tokens (one token each) and then into
pre-tokens. Pre-tokens that a task has not met yet are held together as one
ragged array of symbols. In each round every sequence looks up the rank of its
neighbouring pairs, takes its lowest one, and merges all places of that pair
at once (every other one in a run of equal symbols); sequences without a pair
in the table leave, and their symbols are their tokens. That equals merging
one place after another, because a pair that holds a merged symbol always
ranks after the merge that made it, which is checked when the file is read.

A pre-token over ``LONG`` symbols would need very many rounds over a long
array. It is merged rank by rank too, but each step touches only the places of
one rank, linked to their neighbours.

Counts of met pre-tokens are kept, up to ``KEPT``; then the memory starts anew.

Rows: every row gives one, repeated rows too. A null text is empty and has no
tokens. A null doc_id stays null. A very long text is a batch of its own.
Other columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import json
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm import _tables as T
from llm import _words as W
from llm import tokens

FILE = public_tokenizers.path("byte_bpe_50k.json")
LIMIT = 512  # tokens
LONG = 512  # symbols of a pre-token that is merged on its own
KEPT = 600_000  # pre-tokens whose counts a task remembers
NO_RANK = np.iinfo(np.int32).max


class Merges:
    """The merge table of a tokenizer file: rank and result of a pair of symbols."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        model = data["model"]
        if model["type"] != "BPE" or data["normalizer"] or model.get("ignore_merges") or data["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError(f"{path} is no plain byte-level BPE file")
        ids = model["vocab"]
        self.byte = np.zeros(256, np.int32)
        for b, c in tokens._alphabet().items():
            self.byte[b] = ids[c]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right, made = (np.array([ids[x] for x in xs], np.int64) for xs in ([a for a, _ in pairs], [b for _, b in pairs], [a + b for a, b in pairs]))
        self.size = int(max(ids.values())) + 1
        born = np.full(self.size, -1, np.int64)
        born[made[::-1]] = np.arange(len(pairs))[::-1]  # the first merge that makes a symbol
        if (np.maximum(born[left], born[right]) >= np.arange(len(pairs))).any():
            raise ValueError(f"a pair of {path} ranks before the merge that makes one of its symbols")
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        first = np.append(True, np.diff(keys[order]) > 0)  # a repeated pair keeps its lowest rank
        order = order[first]
        # open addressing: a slot for each key at its hash or, if taken, one of the next places
        self.bits = int(len(order) * 4).bit_length()
        self.keys = np.full((1 << self.bits) + 1, -1, np.int64)
        self.ranks = np.full((1 << self.bits) + 1, NO_RANK, np.int32)
        self.made = made.astype(np.int32)
        todo, at = keys[order], self._slot(keys[order])
        rank, self.probes = order.astype(np.int32), 0
        while len(todo):
            self.probes += 1
            free = np.flatnonzero(self.keys[at] == -1)
            slots, who = np.unique(at[free], return_index=True)
            won = free[who]
            self.keys[slots], self.ranks[slots] = todo[won], rank[won]
            rest = np.ones(len(todo), bool)
            rest[won] = False
            todo, rank, at = todo[rest], rank[rest], (at[rest] + 1) & ((1 << self.bits) - 1)
        specials = [t["content"] for t in data["added_tokens"]]
        self.special = re.compile("|".join(re.escape(s) for s in sorted(specials, key=len, reverse=True))) if specials else None
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in data["added_tokens"]):
            raise ValueError(f"{path} has added tokens that match more than their own text")

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs; NO_RANK where the table lacks one."""
        keys = left.astype(np.int64) * self.size + right
        at = self._slot(keys)
        out = np.where(self.keys[at] == keys, self.ranks[at], NO_RANK)
        open_ = np.flatnonzero((self.keys[at] != keys) & (self.keys[at] != -1))
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            there = self.keys[at[open_]]
            hit = there == keys[open_]
            out[open_[hit]] = self.ranks[at[open_[hit]]]
            open_ = open_[~hit & (there != -1)]
        return out


def merge(symbols: np.ndarray, lengths: np.ndarray, table: Merges) -> np.ndarray:
    """How many symbols are left of each sequence; ``symbols`` holds them one after another, ``lengths`` are 1 at least."""
    out = lengths.copy()
    who = np.arange(len(lengths))
    sym = symbols
    last = np.zeros(len(sym), bool)  # of a sequence
    last[np.cumsum(lengths) - 1] = True
    rank = np.full(len(sym), NO_RANK, np.int32)
    inner = np.flatnonzero(~last)
    rank[inner] = table.rank(sym[inner], sym[inner + 1])
    while len(who):
        starts = np.concatenate([[0], np.flatnonzero(last)[:-1] + 1])
        lowest = np.minimum.reduceat(rank, starts)
        alive = lowest < NO_RANK
        size = np.diff(np.append(starts, len(sym)))
        out[who] = size
        if not alive.all():
            keep = np.repeat(alive, size)
            sym, last, rank, who, lowest, size = sym[keep], last[keep], rank[keep], who[alive], lowest[alive], size[alive]
            if not len(who):
                break
        chosen = rank == np.repeat(lowest, size)
        run = chosen[1:] & chosen[:-1]  # neighbours chosen both: a run of one symbol, in which every other place merges
        if run.any():
            at = np.arange(len(chosen))
            begins = np.where(chosen & ~np.append(False, run), at, 0)
            chosen &= (at - np.maximum.accumulate(begins)) % 2 == 0
        places = np.flatnonzero(chosen)
        sym = sym.copy()
        sym[places] = table.made[rank[places]]
        last[places] |= last[places + 1]
        keep = np.ones(len(sym), bool)
        keep[places + 1] = False
        new = np.cumsum(keep) - 1
        sym, last, rank = sym[keep], last[keep], rank[keep]
        changed = new[places]
        before = changed - 1
        before = before[(before >= 0)]
        changed = np.concatenate([changed, before[~last[before]]])
        rank[changed] = NO_RANK
        changed = changed[~last[changed]]
        rank[changed] = table.rank(sym[changed], sym[changed + 1])
    return out


def merge_long(symbols: np.ndarray, table: Merges) -> int:
    """How many symbols are left of one long sequence: the same merges, rank after rank, each at its own places only."""
    n = len(symbols)
    sym = symbols.copy()
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)  # n and -1 are the ends
    alive = np.ones(n, bool)
    rank = np.full(n, NO_RANK, np.int32)
    rank[:-1] = table.rank(sym[:-1], sym[1:])
    waiting: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def wait(places: np.ndarray) -> None:
        r = rank[places]
        places, r = places[r < NO_RANK], r[r < NO_RANK]
        order = np.argsort(r, kind="stable")
        places, r = places[order], r[order]
        for part in np.split(places, np.flatnonzero(np.diff(r)) + 1) if len(r) else []:
            k = int(rank[part[0]])
            if k not in waiting:
                waiting[k] = []
                heapq.heappush(heap, k)
            waiting[k].append(part)

    wait(np.arange(n - 1))
    left = n
    while heap:
        r = heapq.heappop(heap)
        places = np.unique(np.concatenate(waiting.pop(r)))
        places = places[alive[places] & (rank[places] == r)]
        if not len(places):
            continue
        follows = np.append(False, after[places[:-1]] == places[1:])
        at = np.arange(len(places))
        places = places[(at - np.maximum.accumulate(np.where(follows, 0, at))) % 2 == 0]
        gone = after[places]
        sym[places] = table.made[r]
        alive[gone] = False
        rank[gone] = NO_RANK
        after[places] = after[gone]
        inner = places[after[places] < n]
        before[after[inner]] = inner
        rank[places] = NO_RANK
        rank[inner] = table.rank(sym[inner], sym[after[inner]])
        previous = before[places]
        previous = previous[previous >= 0]
        rank[previous] = table.rank(sym[previous], sym[after[previous]])
        wait(np.unique(np.concatenate([inner, previous])))
        left -= len(gone)
    return left


class Counter:
    """Token counts of texts, with a bounded memory of pre-tokens."""

    def __init__(self, path: str):
        self.table = Merges(path)
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, int] = {}

    def pieces(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of ``text`` and the number of added tokens between them."""
        parts = self.table.special.split(text) if self.table.special and self.table.special.search(text) else [text]
        out: list[str] = []
        for part in parts:
            if tokens.OTHER.search(part):  # characters on whose class Python and the tokenizer might differ
                out += [part[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(part)]
            else:
                out += tokens.WORD.findall(part)
        return out, len(parts) - 1

    def learn(self, words: list[str]) -> None:
        """Count the tokens of distinct pre-tokens."""
        data = [w.encode() for w in words]
        lengths = np.array(list(map(len, data)), np.int64)
        for i in np.flatnonzero(lengths > LONG).tolist():
            self.known[words[i]] = merge_long(self.table.byte[np.frombuffer(data[i], np.uint8)], self.table)
        short = np.flatnonzero(lengths <= LONG)
        if len(short):
            symbols = self.table.byte[np.frombuffer(b"".join(data[i] for i in short.tolist()), np.uint8)]
            for i, n in zip(short.tolist(), merge(symbols, lengths[short], self.table).tolist()):
                self.known[words[i]] = n

    def count(self, texts: list[str]) -> list[int]:
        found = [self.pieces(t) for t in texts]
        new = set().union(*(p for p, _ in found)).difference(self.known) if found else set()
        if len(self.known) + len(new) > KEPT:
            self.known.clear()
            new = set().union(*(p for p, _ in found))
        if new:
            self.learn(list(new))
        return [sum(map(self.known.__getitem__, p)) + n for p, n in found]


_counters: dict[str, Counter] = {}


def _counted(path: str):
    def run(batches):
        tokens.forget()  # if this worker has packed before
        if path not in _counters:
            _counters[path] = Counter(path)
        counter = _counters[path]
        for b in W.slices(batches, "text"):
            column = b.column("text")
            sizes = np.diff(W.raw(column)[1])
            n = counter.count([x.decode("utf-8", "replace") for x in column.to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])
    return run


def count_tokens(docs: DataFrame, path: str = FILE, limit: int = LIMIT) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_bytes, n_tokens, over_limit."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    return rows.mapInArrow(_counted(path), "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)


def op11_rank_synchronous_counts(spark, sf_dir: str) -> DataFrame:
    return count_tokens(T.documents(spark, sf_dir))

"""Operator 13: fill-in-middle, with cuts located by ranks in a wavelet matrix over character classes.

Each byte of a batch of texts has one of eight classes (``CLASSES``). The
wavelet matrix keeps them as three bit vectors with cumulative counts. The
number of boundaries of a unit before a byte is the sum of the ranks of the
classes that mark the unit: the first bytes of characters, or line feeds. A
cut after k units is the last byte place whose boundary count is still k,
found by bisection on these ranks for all texts of the batch at once.

A text of n units is cut after the smaller and the larger of h1 mod (n + 1)
and h2 mod (n + 1) units into prefix, middle and suffix; h1 to h4 come from
the SHA-256 of ``seed:doc_id``. The form is ``plain`` (the text itself) for an
empty text, for one that holds a marker, and by h3; else ``spm`` by h4, or
``psm``.

Rows: every row gives one, repeated rows too. A null text is empty. A null
doc_id is hashed as the empty string. A very long text is a batch of its own:
a task holds a few times its size. Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm import _tables as T
from llm import _words as W

MARKERS = ("<P>", "<S>", "<M>")
PLAIN_FROM, SPM_BELOW = 90, 20  # h3 % 100 and h4 % 100
SEED = 1

CLASSES = ["inside", "line feed", "space", "digit", "letter", "mark", "lead of two", "lead of more"]  # "inside": later bytes of a character
UNITS = {"char": ("starts", range(1, 8)), "line": ("ends", [1])}  # the classes that start, or end, a unit


def _class_table() -> np.ndarray:
    t = np.full(256, CLASSES.index("mark"), np.uint8)
    for c in range(128):
        if chr(c).isspace():
            t[c] = CLASSES.index("space")
        elif chr(c).isdigit():
            t[c] = CLASSES.index("digit")
        elif chr(c).isalpha():
            t[c] = CLASSES.index("letter")
    t[10] = CLASSES.index("line feed")
    t[0x80:0xC0] = CLASSES.index("inside")
    t[0xC0:0xE0] = CLASSES.index("lead of two")
    t[0xE0:] = CLASSES.index("lead of more")
    return t


_CLASS_OF = _class_table()


class Bits:
    """A bit vector with the number of ones before each 64-bit word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, bool)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.zeros(len(self.words) + 1, np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place of ``at``."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(below)


class WaveletMatrix:
    """Symbols below 2**LEVELS; ``rank`` counts one symbol before a place in LEVELS steps."""

    LEVELS = 3

    def __init__(self, symbols: np.ndarray):
        self.levels, self.zeros = [], []
        for level in reversed(range(self.LEVELS)):
            bits = (symbols >> level & 1).astype(bool)
            self.levels.append(Bits(bits))
            self.zeros.append(len(bits) - int(self.levels[-1].before[-1]))
            symbols = np.concatenate([symbols[~bits], symbols[bits]])
        last = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=1 << self.LEVELS))])
        reverse = [int(f"{c:0{self.LEVELS}b}"[::-1], 2) for c in range(1 << self.LEVELS)]
        order = np.argsort(reverse)  # the last level's symbols stand in the order of their reversed bits
        size = np.diff(last)
        self.first = np.zeros(1 << self.LEVELS, np.int64)
        self.first[order] = np.concatenate([[0], np.cumsum(size[order])[:-1]])

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` before each place of ``at``."""
        for level, bits, zeros in zip(reversed(range(self.LEVELS)), self.levels, self.zeros):
            ones = bits.ones(at)
            at = zeros + ones if symbol >> level & 1 else at - ones
        return at - self.first[symbol]

    def count(self, symbols, at: np.ndarray) -> np.ndarray:
        """Occurrences of any of ``symbols`` before each place of ``at``."""
        return sum(self.rank(c, at) for c in symbols)


class Boundaries:
    """Units of the texts whose bytes ``offsets`` delimits in ``buf``."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, unit: str):
        self.matrix = WaveletMatrix(_CLASS_OF[buf])
        self.side, self.symbols = UNITS[unit]
        self.start, self.end = offsets[:-1], offsets[1:]
        self.base = self.matrix.count(self.symbols, self.start)
        marks = self.matrix.count(self.symbols, self.end) - self.base
        if self.side == "ends" and len(buf):  # what follows the last end is a unit as well
            open_end = (self.end > self.start) & ~np.isin(_CLASS_OF[buf[np.maximum(self.end - 1, 0)]], list(self.symbols))
            marks = marks + open_end
        self.units = marks

    def cut(self, k: np.ndarray) -> np.ndarray:
        """The byte place after the first k units of each text, 0 <= k <= units."""
        lo, hi = self.start.copy(), self.end.copy()
        if self.side == "starts":  # the last place with at most k starts before it
            while (lo < hi).any():
                mid = (lo + hi + 1) >> 1
                fine = self.matrix.count(self.symbols, mid) - self.base <= k
                lo, hi = np.where(fine, mid, lo), np.where(fine, hi, np.maximum(mid - 1, lo))
            return lo
        while (lo < hi).any():  # the first place with k ends before it
            mid = (lo + hi) >> 1
            fine = self.matrix.count(self.symbols, mid) - self.base >= k
            lo, hi = np.where(fine, lo, np.minimum(mid + 1, hi)), np.where(fine, mid, hi)
        return lo


def _transformed(unit: str):
    p, s, m = (x.encode() for x in MARKERS)

    def run(batches):
        for b in W.slices(batches, "text"):
            buf, off = W.raw(b.column("text"))
            made = Boundaries(buf, off, unit)
            n = made.units
            h = [b.column(f"h{i}").to_numpy(zero_copy_only=False) for i in range(1, 5)]
            a, e = h[0] % (n + 1), h[1] % (n + 1)
            first, second = made.cut(np.minimum(a, e)), made.cut(np.maximum(a, e))
            out, forms = [], []
            data = buf.tobytes()
            for i in range(b.num_rows):
                lo, x, y, hi = off[i], first[i], second[i], off[i + 1]
                text = data[lo:hi]
                if not text or h[2][i] % 100 >= PLAIN_FROM or p in text or s in text or m in text:
                    forms.append("plain")
                    out.append(text)
                elif h[3][i] % 100 < SPM_BELOW:
                    forms.append("spm")
                    out.append(b"".join((s, data[y:hi], p, data[lo:x], m, data[x:y])))
                else:
                    forms.append("psm")
                    out.append(b"".join((p, data[lo:x], s, data[y:hi], m, data[x:y])))
            plain = np.array([f == "plain" for f in forms], bool)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(forms, pa.string()),
                 pa.array(np.minimum(a, e), pa.int64(), mask=plain), pa.array(np.abs(a - e), pa.int64(), mask=plain), pa.array(out, pa.large_binary()).cast(pa.binary())],
                ["doc_id", "n", "form", "prefix_units", "middle_units", "output"])
    return run


def transform(docs: DataFrame, unit: str = "char", seed: int = SEED) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n (units), form, prefix_units, middle_units, output (text).

    ``unit`` is "char" (code points) or "line". The units are null where the form is plain.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))), 256)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"),
                       *[F.conv(F.substr(digest, F.lit(8 * i + 1), F.lit(8)), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)])
    made = rows.mapInArrow(_transformed(unit), "doc_id long, n long, form string, prefix_units long, middle_units long, output binary")
    return made.withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column) -> Column:
    """The text that ``transform`` made ``output`` of: texts with markers are plain, so that the markers split it."""
    parts = F.split(output, "|".join(MARKERS))
    psm, spm = (F.concat(*[F.element_at(parts, i) for i in order]) for order in ((2, 4, 3), (3, 4, 2)))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def op13_wavelet_fill_middle(spark, sf_dir: str) -> DataFrame:
    made = transform(T.documents(spark, sf_dir))
    return made.select("doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"),
                       F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"))

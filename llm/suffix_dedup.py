"""Operator 3: removal of byte strings of 50 that also start in a document with a smaller id.

Documents are dealt into batches of a few MB. Every window of 50 bytes is
assigned to its mark, the least hash among its 20-byte strings: equal windows
have equal marks, so that shards of marks can be sorted apart.

1. Batches send their distinct marks (8 bytes each, about one for 16 bytes of
   text) to mark shards, which return the marks that two documents have.
2. Successive windows with one repeated mark make a string. Batches send each
   distinct string once, with the smallest id that has it, to its shard.
3. A string whose mark no other string has shares no window with another. Of
   the others shards sort all suffixes by induced sorting with common prefixes
   (``llm.induced_sort``, queues on disk beyond a memory budget). Neighbours
   that share 50 bytes hold one window; its smallest id is known. A bit for
   each window goes back: whether an id smaller than the string's is.
4. Batches cover the bytes of windows that a smaller document has.

Texts are shuffled once: the three steps that read them use one exchange. A
group of copies costs one string for each batch, whatever its size.

Rows: null text is empty. A null doc_id counts as larger than all. Rows that
repeat a doc_id don't cover each other. An empty table gives no rows; other
columns are not looked at; a very long text is in one batch and makes that
batch larger. Texts under 50 bytes stay whole. Marks
and strings are identified by 64-bit hashes; the windows themselves by bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import _tables as T
from llm import _words as W
from llm.induced_sort import suffix_array

LENGTH, GRAM = 50, 20
BATCH = 4 << 20  # bytes of text in a batch
PIECE = 1 << 18  # windows hashed at once
SORTED = 1 << 19  # bytes sorted at once; more only for the strings of one mark
MEMORY = 64 << 20  # bytes of queues held in memory
NO_ID = np.iinfo(np.int64).max


def _pieces(buf: np.ndarray, off: np.ndarray):
    """(window starts, rows, marks, prefix sums, first byte) of the windows, PIECE at a time."""
    row = np.repeat(np.arange(len(off) - 1, dtype=np.int32), np.diff(off))
    for a in range(0, len(buf) - LENGTH + 1, PIECE):
        seg = buf[a : a + PIECE + LENGTH - 1]
        n = len(seg)
        h = W.prefix_sums(seg.astype(np.uint64) + np.uint64(1))
        m = W.mix((h[GRAM:] - h[:-GRAM]) * W.powers(n + 1)[1][: n - GRAM + 1])
        width = LENGTH - GRAM + 1  # 31 strings of GRAM bytes in a window
        for step in (1, 2, 4, 8):
            m = np.minimum(m[:-step], m[step:])
        m = np.minimum(m[: -(width - 16)], m[width - 16 :])
        pos = np.arange(a, a + len(m))
        r = row[a : a + len(m)]
        whole = off[r + 1] - pos >= LENGTH
        yield pos[whole], r[whole], W.mix(m[whole]), h, a  # least hashes crowd at 0; mixed again, shards are even


def _runs(pos, row, mark):
    """Bounds of the successive windows of one row and mark."""
    if not len(pos):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.concatenate([[True], (mark[1:] != mark[:-1]) | (row[1:] != row[:-1])])
    first = np.flatnonzero(new)
    return first, np.append(first[1:], len(pos)) - 1


def _in(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Membership in a sorted array."""
    return among[np.minimum(np.searchsorted(among, values), len(among) - 1)] == values if len(among) else np.zeros(len(values), bool)


def _shard(mark: np.ndarray, count: int) -> np.ndarray:
    return (((mark >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)).astype(np.int64)


def _blob(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).tobytes()


def _squeezed(x: bytes) -> bytes:
    return zstandard.compress(x, 1)


def _unsqueezed(x: bytes) -> bytes:
    return zstandard.decompress(x)


def _ordered(t: pa.Table) -> pa.Table:
    return t.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def _ids(t: pa.Table) -> np.ndarray:
    return t.column("doc_id").combine_chunks().fill_null(NO_ID).to_numpy().astype(np.int64)


def _marks(count: int):
    """Batch -> (shard, batch, distinct marks, whether two documents of the batch have each)."""
    def run(key, t):
        seen = []
        t = _ordered(t)
        for b in W.slices(t.to_batches(), "text"):
            ids = _ids(pa.table(b))
            for pos, row, mark, _, _ in _pieces(*W.raw(b.column("text"))):
                first, _ = _runs(pos, row, mark)
                seen.append(np.unique(np.stack([mark[first], ids[row[first]].view(np.uint64)], 1), axis=0) if len(first) < 4096 else _distinct(mark[first], ids[row[first]]))
        if not seen:
            return pa.table([[], [], [], []], schema=MARKS)
        m = np.concatenate(seen)
        m = _distinct(m[:, 0], m[:, 1].view(np.int64))[:, 0]
        mark, n = np.unique(m, return_counts=True)
        cut = np.searchsorted(_shard(mark, count), np.arange(count + 1))
        full = np.flatnonzero(np.diff(cut))
        return pa.table([full, np.full(len(full), key[0].as_py()), [_blob(mark[cut[i] : cut[i + 1]]) for i in full], [_blob(n[cut[i] : cut[i + 1]] > 1) for i in full]], schema=MARKS)
    return run


def _distinct(mark: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Distinct (mark, id) pairs, as unsigned rows."""
    order = np.lexsort((ids, mark))
    m, i = mark[order], ids[order].view(np.uint64)
    new = np.ones(len(m), bool)
    new[1:] = (m[1:] != m[:-1]) | (i[1:] != i[:-1])
    return np.stack([m[new], i[new]], 1)


def _repeated(t):
    """Mark shard -> (batch, marks of it that two documents have)."""
    marks = [np.frombuffer(x, np.uint64) for x in t.column("marks").to_pylist()]
    twice = np.concatenate([np.frombuffer(x, bool) for x in t.column("twice").to_pylist()])
    whose = np.repeat(np.arange(len(marks)), [len(x) for x in marks])
    mark = np.concatenate(marks)
    order = np.argsort(mark, kind="stable")
    s = mark[order]
    same = np.zeros(len(s), bool)
    same[1:] = s[1:] == s[:-1]
    same[:-1] |= same[1:]
    twice = twice.copy()
    twice[order[same]] = True
    batch = t.column("batch").to_pylist()
    kept = [mark[a:e][twice[a:e]] for a, e in zip(np.searchsorted(whose, np.arange(len(marks))), np.searchsorted(whose, np.arange(len(marks)), "right"))]
    full = [i for i, x in enumerate(kept) if len(x)]
    return pa.table([[batch[i] for i in full], [_blob(kept[i]) for i in full]], schema=REPEATED)


class _Strings:
    """The strings of a batch: runs of windows whose mark is repeated, and the distinct ones among them."""

    def __init__(self, t: pa.Table, repeated: np.ndarray):
        found = []
        self.slices = list(W.slices(_ordered(t).to_batches(), "text")) if t.num_rows else []
        for k, b in enumerate(self.slices):
            ids = _ids(pa.table(b))
            for pos, row, mark, h, a in _pieces(*W.raw(b.column("text"))):
                first, last = _runs(pos, row, mark)
                keep = _in(mark[first], repeated)
                first, last = first[keep], last[keep]
                s, e = pos[first] - a, pos[last] - a + LENGTH
                key = W.mix((h[e] - h[s]) * W.powers(len(h))[1][s] + (e - s).astype(np.uint64) * np.uint64(W.BASE))
                found.append((np.full(len(s), k), s + a, e - s, mark[first], key, ids[row[first]]))
        self.slice, self.start, self.length, self.mark, self.key, self.id = (np.concatenate(x) for x in zip(*found)) if found else [np.zeros(0, d) for d in ("i8", "i8", "i8", "u8", "u8", "i8")]
        order = np.lexsort((self.id, self.key, self.mark))
        new = np.ones(len(order), bool)
        new[1:] = (self.key[order][1:] != self.key[order][:-1]) | (self.mark[order][1:] != self.mark[order][:-1])
        self.distinct = order[new]  # by mark, then key: the first occurrence has the smallest id
        self.which = np.empty(len(order), np.int64)  # of each run, its distinct string
        self.which[order] = np.cumsum(new) - 1


def _strings(count: int):
    """Batch and its repeated marks -> (shard, batch, strings, lengths, marks, smallest ids)."""
    def run(key, docs, marks):
        if not marks.num_rows or not docs.num_rows:
            return pa.table([[]] * 6, schema=STRINGS)
        s = _Strings(docs, np.unique(np.concatenate([np.frombuffer(x, np.uint64) for x in marks.column("marks").to_pylist()])))
        bufs = [W.raw(b.column("text"))[0] for b in s.slices]
        d = s.distinct
        cut = np.searchsorted(_shard(s.mark[d], count), np.arange(count + 1))
        out = []
        for i in np.flatnonzero(np.diff(cut)):
            x = d[cut[i] : cut[i + 1]]
            data = b"".join(bufs[k][a : a + n].tobytes() for k, a, n in zip(s.slice[x].tolist(), s.start[x].tolist(), s.length[x].tolist()))
            out.append((int(i), key[0].as_py(), _squeezed(data), _squeezed(_blob(s.length[x].astype(np.int32))), _blob(s.mark[x]), _squeezed(_blob(s.id[x]))))
        return pa.table([list(x) for x in zip(*out)] or [[]] * 6, schema=STRINGS)
    return run


def _smaller(data: list[bytes], ids: np.ndarray, memory: int) -> list[np.ndarray]:
    """Of each of the distinct strings, for each of its windows: the smallest id of all strings that hold it."""
    lengths = np.array([len(x) for x in data])
    begin = np.concatenate([[0], np.cumsum(lengths + 1)])
    text = np.frombuffer(b"\0".join(data) + b"\0\0", np.uint8).astype(np.int16) + 2
    text[begin[1:] - 1] = 1  # ends of strings
    text[-1] = 0
    sa, lcp = suffix_array(text, 258, LENGTH, memory)
    head = np.flatnonzero(lcp < LENGTH)
    whose = np.repeat(np.arange(len(data)), lengths + 1)
    owner = np.append(ids[whose], NO_ID)
    left = np.append(begin[1:][whose] - 1, 0) - np.arange(len(text))
    owner[left < LENGTH] = NO_ID  # no window starts here
    least = np.empty(len(text), np.int64)
    least[sa] = np.repeat(np.minimum.reduceat(owner[sa], head), np.diff(np.append(head, len(sa))))
    return [least[b : b + n - LENGTH + 1] for b, n in zip(begin.tolist(), lengths.tolist())]


def _sorted(t):
    """String shard -> (batch, marks, a bit for each window of each string: a smaller id than the string's has it)."""
    strings: dict[bytes, int] = {}
    ids: list[int] = []
    mark: list[int] = []
    rows = []
    for data, lens, marks, owners in zip(*(t.column(c).to_pylist() for c in ("data", "lens", "marks", "owners"))):
        a, which, data = 0, [], _unsqueezed(data)
        own = np.frombuffer(_unsqueezed(owners), np.int64)
        for n, m, o in zip(np.frombuffer(_unsqueezed(lens), np.int32).tolist(), np.frombuffer(marks, np.uint64).tolist(), own.tolist()):
            k = strings.setdefault(data[a : a + n], len(ids))
            a += n
            if k == len(ids):
                ids.append(o)
                mark.append(m)
            else:
                ids[k] = min(ids[k], o)
            which.append(k)
        rows.append((which, own))
    texts, of, owner = list(strings), np.array(mark, np.uint64), np.array(ids, np.int64)
    order = np.argsort(of, kind="stable")
    shared = np.zeros(len(of), bool)  # another string has the mark; else no other one has any of the windows
    shared[1:] = of[order][1:] == of[order][:-1]
    shared[:-1] |= shared[1:]
    least = {k: np.full(len(texts[k]) - LENGTH + 1, ids[k]) for k in order[~shared].tolist()}
    order = order[shared].tolist()
    part, held = [], 0
    for j, k in enumerate(order):
        part.append(k)
        held += len(texts[k])
        if j + 1 == len(order) or (held > SORTED and mark[order[j + 1]] != mark[k]):  # equal windows have equal marks
            least.update(zip(part, _smaller([texts[k] for k in part], owner[part], MEMORY)))
            part, held = [], 0
    bits = [_blob(np.packbits(np.concatenate([least[k] < o for k, o in zip(which, own.tolist())]))) for which, own in rows]
    return pa.table([t.column("shard").to_pylist(), t.column("batch").to_pylist(), t.column("marks").to_pylist(), bits], schema=BITS)


def _result(count: int):
    """Batch and the bits of its strings -> the documents' digests (and kept texts)."""
    def run(key, docs, found):
        marks = [np.frombuffer(x, np.uint64) for x in found.column("marks").to_pylist()]
        s = _Strings(docs, np.unique(np.concatenate(marks)) if marks else np.zeros(0, np.uint64))
        windows = s.length - LENGTH + 1
        d = s.distinct
        flags = np.zeros(0, bool)
        if len(d):
            parts = dict(zip(found.column("shard").to_pylist(), found.column("bits").to_pylist()))
            shard = _shard(s.mark[d], count)
            cut = np.searchsorted(shard, np.arange(count + 1))
            flags = np.concatenate([np.unpackbits(np.frombuffer(parts[int(i)], np.uint8), count=int(windows[d[cut[i] : cut[i + 1]]].sum())) for i in np.flatnonzero(np.diff(cut))]).astype(bool)
        at = np.concatenate([[0], np.cumsum(windows[d])])
        out = []
        by_slice = np.searchsorted(s.slice, np.arange(len(s.slices) + 1))
        for k, b in enumerate(s.slices):
            buf, off = W.raw(b.column("text"))
            change = np.zeros(len(buf) + LENGTH + 1, np.int32)
            runs = np.arange(by_slice[k], by_slice[k + 1])
            if len(runs):
                w = windows[runs]
                lead = np.repeat(np.concatenate([[0], np.cumsum(w)[:-1]]), w)
                inner = np.arange(w.sum()) - lead
                covered = flags[np.repeat(at[s.which[runs]], w) + inner] | np.repeat(s.id[runs] > s.id[d][s.which[runs]], w)
                p = (np.repeat(s.start[runs], w) + inner)[covered]
                change[: len(buf)] += np.bincount(p, minlength=len(buf))[: len(buf)].astype(np.int32)
                np.subtract.at(change, p + LENGTH, 1)
            gone = np.cumsum(change)[: len(buf)] > 0
            for r, i in enumerate(b.column("doc_id").to_pylist()):
                x = gone[off[r] : off[r + 1]]
                kept = buf[off[r] : off[r + 1]][~x].tobytes()
                out.append((i, len(x), int(x.sum()), int(x[0]) + int((x[1:] & ~x[:-1]).sum()) if len(x) else 0, hashlib.sha256(kept).hexdigest(), kept))
        return pa.table([list(x) for x in zip(*out)] or [[]] * 6, schema=RESULT)
    return run


def _schema(**kinds) -> pa.Schema:
    return pa.schema([(k, {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}[v]) for k, v in kinds.items()])


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {({pa.int64(): 'long', pa.binary(): 'binary', pa.string(): 'string'})[f.type]}" for f in schema)


MARKS = _schema(shard="long", batch="long", marks="binary", twice="binary")
REPEATED = _schema(batch="long", marks="binary")
STRINGS = _schema(shard="long", batch="long", data="binary", lens="binary", marks="binary", owners="binary")
BITS = _schema(shard="long", batch="long", marks="binary", bits="binary")
RESULT = _schema(doc_id="long", n_bytes="long", n_removed="long", n_spans="long", kept_sha256="string", kept="binary")


def repeated_removed(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (bytes)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = int(total // BATCH) + 1
    dealt = docs.withColumn("batch", F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(count))).select("doc_id", F.coalesce("text", F.lit(b"")).alias("text"), "batch").groupBy("batch")
    marks = dealt.applyInArrow(_marks(count), _ddl(MARKS))
    repeated = marks.groupBy("shard").applyInArrow(_repeated, _ddl(REPEATED))
    strings = dealt.cogroup(repeated.groupBy("batch")).applyInArrow(_strings(count), _ddl(STRINGS))
    bits = strings.groupBy("shard").applyInArrow(_sorted, _ddl(BITS))
    return dealt.cogroup(bits.groupBy("batch")).applyInArrow(_result(count), _ddl(RESULT))


def op3_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    return repeated_removed(T.documents(spark, sf_dir)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")

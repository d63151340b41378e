"""Operator 9: join of documents whose sets of word 5-grams have Jaccard similarity 0.8 or more.

Sets with equal contents are one entity from the start, so exact copies cost
one row each. Each set puts its prefix (the rarest 20 % of its shingles and
one more: two sets that link share one of them) into tiles, one tile for each
shingle and size band. In a tile only sets whose sizes allow a link meet:

1. each tile links its members to the first one of their size range; these
   pairs are verified, and their components are found;
2. what is left are members of one tile in different components. Each is
   verified with its nearest one by bitmaps, which joins most of a large group
   by few links, and then all that remain in different components. Tiles
   beyond ``TILE_ROWS`` are cut into blocks; each pair of blocks stands alone.

Pairs are compared by parity bitmaps: the differing bits bound the symmetric
difference from below, hence the overlap from above. Survivors are verified
by intersecting the sorted hash arrays. Nothing is
lost: a linked pair shares a tile, and is either already in one component or
compared in step 2.

Rows: null text or no words: empty set, linked with nothing. Null doc_id: set
size given, component null, linked with nothing. Rows that repeat a doc_id
each stand for their own text. Very long texts are a batch of their own; an
empty table gives no rows; other columns are kept by ``one_of_each`` and not
looked at elsewhere. Shingles and sets are identified by 64-bit
hashes (sets with their size as well). Which shingles count as rare is read
from a sample of the documents; that order changes the cost, never the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm import _tables as T
from llm import _words as W

SAMPLE = 64  # one document in 64 tells which shingles are common
COMMON = 8  # a shingle in so many sampled documents is common
MOST_COMMON = 65_536  # common shingles that are broadcast (512 KB); others only cost time
TILE_ROWS = 4096
BITS = 512  # of the smallest bitmap
MOST_BROADCAST = 2_000_000  # document ids (16 MB); more are joined by a shuffle
TILE_SHARE = 50_000  # tile rows with bitmaps for each shuffle partition
ENTRIES = 1_000_000  # tile entries for each shuffle partition


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each row of the batch."""
    hashes, _, _, first = W.words(batch.column("text"))
    sh, begin = W.shingles(hashes, first)
    for r in range(batch.num_rows):
        yield r, np.unique(sh[begin[r] : begin[r + 1]])


def _sid(u: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(u.tobytes(), digest_size=8).digest(), "little", signed=True)


def bitmap(u: np.ndarray) -> bytes:
    """Parity of the shingles that fall on each bit; the first power of two from the set's size on, BITS at least."""
    bits = max(BITS, 1 << (len(u) - 1).bit_length())
    return np.packbits((np.bincount((u >> np.uint64(7)) & np.uint64(bits - 1), minlength=bits) & 1).astype(np.uint8)).tobytes()


def folded(x: np.ndarray, width: int) -> np.ndarray:
    """Bitmaps (rows of 64-bit words) brought to ``width`` words: what they would be with so many bits."""
    return np.bitwise_xor.reduce(x.reshape(len(x), -1, width), axis=1)


def _describe(batches):
    for b in W.slices(batches, "text"):
        found = [(len(u), _sid(u), bitmap(u)) for _, u in _sets(b)]
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), *(pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary())))],
            ["doc_id", "n_shingles", "sid", "bitmap"])


def _spread(batches):
    for b in W.slices(batches, "text"):
        parts = [u for _, u in _sets(b)] or [np.zeros(0, np.uint64)]
        h, n = np.unique(np.concatenate(parts), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])


def prefix_size(n: int) -> int:
    """How many of n shingles, in any order shared by all sets, must hold a common one of two linked sets."""
    return n - (4 * n + 4) // 5 + 1


def _prefixes(common: np.ndarray):
    def run(batches):
        seen: set[int] = set()  # copies met by this task again; forgetting them costs repeated entries only
        for b in W.slices(batches, "text"):
            hs, sids, ns = [], [], []
            for _, u in _sets(b):
                if not len(u) or (s := _sid(u)) in seen:
                    continue
                seen.add(s)
                hot = np.zeros(len(u), bool)
                if len(common):
                    hot = common[np.minimum(np.searchsorted(common, u), len(common) - 1)] == u
                p = prefix_size(len(u))
                take = u[~hot][:p]
                if len(take) < p:
                    take = np.concatenate([take, u[hot][: p - len(take)]])
                hs.append(take)
                sids.append(np.full(p, s))
                ns.append(np.full(p, len(u), np.int32))
            if len(seen) > 200_000:
                seen.clear()
            if hs:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(hs).view(np.int64)), pa.array(np.concatenate(sids)), pa.array(np.concatenate(ns))], ["h", "sid", "n"])
    return run


def _shared(batches):
    """The entries of shingles that two different sets have; all rows of a shingle are in this partition."""
    got = [(b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy()) for b in batches if b.num_rows]
    if not got:
        return
    h, s, n = (np.concatenate(x) for x in zip(*got))
    del got
    order = np.argsort(h, kind="stable")  # most shingles stand alone: drop them before the full sort
    hh = h[order]
    twin = np.zeros(len(hh), bool)
    twin[1:] = hh[1:] == hh[:-1]
    twin[:-1] |= twin[1:]
    keep = order[twin]
    h, s, n = h[keep], s[keep], n[keep]
    order = np.lexsort((s, n, h))
    h, s, n = h[order], s[order], n[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (s[1:] != s[:-1]) | (n[1:] != n[:-1])
    h, s, n = h[new], s[new], n[new]
    near = np.zeros(len(h), bool)  # a neighbour of a size that allows a link
    near[1:] = (h[1:] == h[:-1]) & (5 * n[:-1].astype(np.int64) >= 4 * n[1:].astype(np.int64))
    near[:-1] |= near[1:]
    h, s, n = h[near], s[near], n[near]
    pivot = np.zeros(len(h), np.int64)
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    for a, e in zip(first, np.append(first[1:], len(h))):
        while a < e:  # the first one pairs with all of its size range
            z = a + int(np.searchsorted(n[a:e], n[a] * 5 // 4, "right"))
            pivot[a:z] = s[a]
            a = z
    for i in range(0, len(h), 200_000):
        j = slice(i, i + 200_000)
        yield pa.RecordBatch.from_arrays([pa.array(h[j]), pa.array(s[j]), pa.array(n[j]), pa.array(pivot[j])], ["h", "sid", "n", "pivot"])
    del h, hh, order, twin, keep, s, n, new, near, pivot
    W.release()


def _contents(batches):
    """(sid, sorted shingle hashes)."""
    for b in W.slices(batches, "text"):
        out = {_sid(u): u.tobytes() for _, u in _sets(b) if len(u)}
        yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.int64()), pa.array(list(out.values()), pa.binary())], ["sid", "shingles"])


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays without repeats."""
    z = np.concatenate([x, y])
    z.sort(kind="stable")
    return int((z[1:] == z[:-1]).sum())


def _verify(batches):
    for b in batches:
        cut = [memoryview(v.as_buffer()) for v in b.column("x")], [memoryview(v.as_buffer()) for v in b.column("y")]
        ok = []
        for x, y in zip(*cut):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            ok.append(9 * overlap(x, y) >= 4 * (len(x) + len(y)))
        yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(ok, pa.bool_())], ["a", "b", "ok"])


def _allowed(batches):
    for b in batches:
        n = b.column("n").to_numpy().astype(np.int64) + b.column("m").to_numpy()
        k = np.arange(len(n))
        ok = pa.array(9 * (n - _Bitmaps(b.column("x").to_pylist() + b.column("y").to_pylist()).differ(k, k + len(n))) >= 8 * n)
        yield pa.RecordBatch.from_arrays([b.column("a").filter(ok), b.column("b").filter(ok)], ["a", "b"])


def allowed(pairs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` whose sizes and bitmaps allow a link."""
    x = bitmaps.select(F.col("sid").alias("a"), F.col("n_shingles").alias("n"), F.col("bitmap").alias("x"))
    y = bitmaps.select(F.col("sid").alias("b"), F.col("n_shingles").alias("m"), F.col("bitmap").alias("y"))
    both = pairs.join(x, "a").join(y, "b").filter("5 * least(n, m) >= 4 * greatest(n, m)")
    return both.select("a", "b", "n", "m", "x", "y").mapInArrow(_allowed, "a long, b long")


def verified(pairs: DataFrame, known: DataFrame, owner: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` that link; only the texts of their sets are read again."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct().join(owner, "sid").select("doc_id")
    wanted = T.store(wanted, "wanted")
    if wanted.count() <= MOST_BROADCAST:  # 8 bytes a row
        wanted = F.broadcast(wanted)
    sets = known.join(wanted, "doc_id", "left_semi").mapInArrow(_contents, "sid long, shingles binary").dropDuplicates(["sid"])
    sets = T.store(sets, "contents")
    x, y = (sets.select(F.col("sid").alias(f"sid_{k}"), F.col("shingles").alias(k)) for k in "xy")
    full = pairs.join(y, F.col("b") == y.sid_y).drop("sid_y").join(x, F.col("a") == x.sid_x).select("a", "b", "x", "y")
    links = T.store(full.mapInArrow(_verify, "a long, b long, ok boolean").filter("ok").select("a", "b"), "links")
    T.drop(sets, wanted)
    return links


class _Bitmaps:
    """Bitmaps of many sets, by width, for counting the differing bits of pairs whose widths are equal or 1 : 2."""

    def __init__(self, bitmaps: list[bytes]):
        self.width = np.fromiter(map(len, bitmaps), np.int64, len(bitmaps)) // 8
        self.at, self.own, self.half = np.zeros(len(bitmaps), np.int64), {}, {}
        for w in np.unique(self.width).tolist():
            rows = np.flatnonzero(self.width == w)
            self.at[rows] = np.arange(len(rows))
            self.own[w] = np.frombuffer(b"".join(bitmaps[r] for r in rows), np.uint64).reshape(-1, w)
            self.half[w] = folded(self.own[w], max(1, w // 2))

    def differ(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), np.int64)
        low, high = np.where(self.width[i] <= self.width[j], (i, j), (j, i))
        for w in np.unique(self.width[low]).tolist():
            for wide, of in ((w, self.own), (2 * w, self.half)):
                at = np.flatnonzero((self.width[low] == w) & (self.width[high] == wide))
                for a in range(0, len(at), max(1, (1 << 20) // w)):
                    k = at[a : a + max(1, (1 << 20) // w)]
                    out[k] = np.bitwise_count(self.own[w][self.at[low[k]]] ^ of[wide][self.at[high[k]]]).sum(1)
        return out


def _compare(nearest: bool):
    """Pairs of a tile's rows in different components that the bitmaps allow; a partition holds whole tiles, sorted.

    With ``nearest``, each row of a tile only with the row whose bitmap differs least.
    """
    def run(batches):
        got = [pa.table(b) for b in batches if b.num_rows]
        if not got:
            return
        t = pa.concat_tables(got)
        h, p, q, part, n, c, s = (t.column(k).to_numpy() for k in ("h", "p", "q", "part", "n", "component", "sid"))
        bits = _Bitmaps(t.column("bitmap").to_pylist())
        n = n.astype(np.int64)
        live = np.arange(len(h))
        best, mate = np.ones(len(h)), np.full(len(h), -1)
        for d in range(1, len(h)):  # each row with the d-th after it, as long as that is in its tile and size range
            live = live[live + d < len(h)]
            j = live + d
            keep = (h[live] == h[j]) & (p[live] == p[j]) & (q[live] == q[j]) & (5 * n[live] >= 4 * n[j])
            live, j = live[keep], j[keep]
            if not len(live):
                break
            new = (c[live] != c[j]) & ((p[live] == q[live]) | (part[live] != part[j]))
            i, j = live[new], j[new]
            if not len(i):
                continue
            both, differ = n[i] + n[j], bits.differ(i, j)
            ok = 9 * (both - differ) >= 8 * both  # twice the overlap is at most both - differ
            i, j = i[ok], j[ok]
            if nearest:
                far = differ[ok] / both[ok]
                for x, y in ((i, j), (j, i)):
                    less = far < best[x]
                    best[x[less]], mate[x[less]] = far[less], y[less]
            elif len(i):
                yield _pairs(s[i], s[j])
        i = np.flatnonzero(mate >= 0)
        yield _pairs(s[i], s[mate[i]])
        del got, t, bits
        W.release()
    return run


def _pairs(a, b) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_shingles, component_id (smallest doc_id reachable), sid (the set's hash)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    known = docs.filter("doc_id is not null")
    rows = T.store(docs.mapInArrow(_describe, "doc_id long, n_shingles long, sid long, bitmap binary"), "sets")

    sample = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0).mapInArrow(_spread, "h long, n long")
    often = sample.groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") >= COMMON).orderBy(F.desc("n"), "h").limit(MOST_COMMON).collect()
    common = np.sort(np.array([r.h for r in often], np.int64).view(np.uint64))

    total = rows.agg(F.sum(F.col("n_shingles") / 5 + 1)).first()[0] or 0
    entries = known.mapInArrow(_prefixes(common), "h long, sid long, n int").repartition(T.partitions_for(spark, total, ENTRIES), "h")
    tiles = T.store(entries.mapInArrow(_shared, "h long, sid long, n int, pivot long"), "tiles")

    owner = T.store(rows.filter("doc_id is not null and n_shingles > 0").groupBy("sid").agg(F.min("doc_id").alias("doc_id")), "owner")
    inside = tiles.select("sid").distinct()
    bitmaps = T.store(rows.filter("doc_id is not null").join(inside, "sid", "left_semi").select("sid", "n_shingles", "bitmap").dropDuplicates(["sid"]), "bitmaps")

    star = tiles.filter("sid <> pivot").select(F.col("pivot").alias("a"), F.col("sid").alias("b")).distinct()
    links = verified(T.store(allowed(star, bitmaps), "star"), known, owner)
    part = T.components(links)

    for nearest in (True, False):
        member = tiles.select("h", "sid", "n").join(part, tiles.sid == part.node, "left").select("h", "sid", "n", F.coalesce("component", "sid").alias("component"))
        open_tiles = T.store(member.groupBy("h").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("size")).filter("lo <> hi").select("h", "size"), "open")
        rows_left = open_tiles.agg(F.sum(F.col("size") * F.ceil(F.col("size") / TILE_ROWS))).first()[0] or 0  # a row is copied once for each part of its tile
        cut = (member.join(open_tiles, "h").withColumn("k", F.ceil(F.col("size") / TILE_ROWS).cast("int")).withColumn("part", F.pmod(F.xxhash64("sid"), F.col("k")).cast("int"))
               .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
               .select("h", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), "part", "sid", "n", "component"))
        near = (cut.join(bitmaps.select("sid", "bitmap"), "sid").select("h", "p", "q", "part", "sid", "n", "component", "bitmap")
                .repartition(T.partitions_for(spark, rows_left, TILE_SHARE), "h", "p", "q").sortWithinPartitions("h", "p", "q", "n", "sid")
                .mapInArrow(_compare(nearest), "a long, b long").distinct())
        links = T.store(links.unionByName(verified(T.store(near, "near"), known, owner)), "links")
        part = T.components(links)

    group = owner.join(part, owner.sid == part.node, "left").select("sid", "doc_id", F.coalesce("component", "sid").alias("component"))
    first = group.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("sets")).filter("sets > 1")
    first = T.small(T.store(first.select(F.col("component").alias("of"), "component_id"), "first"))
    of_set = group.join(first, F.col("component") == F.col("of"), "left").select(F.col("sid").alias("set"), F.coalesce("component_id", "doc_id").alias("component_id"))
    alone = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return rows.join(of_set, (rows.sid == of_set.set) & (rows.n_shingles > 0), "left").select("doc_id", "n_shingles", alone.alias("component_id"), "sid")


def _sids(batches):
    for batch in batches:
        small = pa.RecordBatch.from_arrays([batch.column("text").cast(pa.binary())], ["text"])
        sids = [_sid(u) for b in W.slices([small], "text") for _, u in _sets(b)]
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(sids, pa.int64())], ["row", "sid"])


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns: of each component the one with the smallest doc_id.

    Rows without a doc_id stay. Of rows that repeat a doc_id in one component the first by text stays.
    """
    found = T.store(near_duplicates(docs), "near")
    gone = T.store(found.filter("doc_id <> component_id").select("doc_id"), "gone")
    twice = T.store(found.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "twice")
    clear = T.store(gone.unionByName(twice).distinct(), "clear").withColumnRenamed("doc_id", "gone_id")
    if clear.count() <= MOST_BROADCAST:  # 8 bytes a row
        clear = F.broadcast(clear)
    kept = docs.join(clear, F.col("doc_id") == F.col("gone_id"), "left_anti")
    if not twice.limit(1).count():
        return kept
    rows = docs.join(twice.withColumnRenamed("doc_id", "twice_id"), F.col("doc_id") == F.col("twice_id"), "left_semi")
    rows = rows.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    rows = rows.mapInArrow(_sids, f"row {rows.schema['row'].dataType.simpleString()}, sid long")
    told = found.select(F.col("doc_id").alias("id"), "component_id", F.col("sid").alias("set")).distinct()
    of = Window.partitionBy("component_id").orderBy("row.text", "sid")
    rows = (rows.join(told, (F.col("row.doc_id") == F.col("id")) & (F.col("sid") == F.col("set"))).filter("id = component_id")
            .withColumn("nth", F.row_number().over(of)).filter("nth = 1"))
    return kept.unionByName(rows.select(*[F.col("row").getField(c).alias(c) for c in docs.columns]))


def op9_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(T.documents(spark, sf_dir)).drop("sid")

"""Induced sorting of suffixes with common-prefix values, through queues that spill to disk.

Suffixes are S-type (smaller than the next suffix) or L-type. The S* suffixes,
S-type after an L-type, are sorted first: their substrings get names in order,
and the string of names is sorted by the same procedure, one level down. Then
two passes induce the rest: in rising order each suffix puts the L-type suffix
before it into the queue of its first character; in falling order the same for
S-type. Each queue receives its tuples (position, common prefix with the tuple
before) in sorted order, so first-in first-out is priority order. A batch of
a queue is handled with array operations; range minima over the batch give the
common prefixes of what it pushes. Queues beyond a memory budget go to a
nameless scratch file of the task, which goes when the task ends.

Common prefixes are exact up to ``cap`` and stay at ``cap`` beyond.
"""

from __future__ import annotations

import tempfile

import numpy as np

LARGEST_ALPHABET = 1024  # beyond it a level is sorted by doubling ranks
CHUNK = 1 << 18


class Queues:
    """First-in first-out queues of (position, common prefix), on disk beyond ``memory`` bytes."""

    def __init__(self, count: int, memory: int):
        self.parts: list[list] = [[] for _ in range(count)]
        self.memory, self.held, self.file = memory, 0, None

    def push(self, q: int, pos: np.ndarray, lcp: np.ndarray) -> None:
        if len(pos):
            self.parts[q].append((pos, lcp))
            self.held += pos.nbytes + lcp.nbytes
            if self.held > self.memory:
                self._spill()

    def _spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        for parts in self.parts:
            for i, p in enumerate(parts):
                if len(p) == 2:
                    at = self.file.seek(0, 2)
                    self.file.write(p[0].tobytes() + p[1].tobytes())
                    parts[i] = at, len(p[0]), p[0].dtype
        self.held = 0

    def take(self, q: int):
        """The tuples of a queue in order, some CHUNK at a time; those pushed meanwhile follow."""
        while self.parts[q]:
            batch, size = [], 0
            while size < CHUNK and len(batch) < len(self.parts[q]):
                p = self._read(self.parts[q][len(batch)])
                batch.append(p)
                size += len(p[0])
            del self.parts[q][: len(batch)]
            yield tuple(np.concatenate(x) for x in zip(*batch))

    def _read(self, p: tuple) -> tuple[np.ndarray, np.ndarray]:
        if len(p) == 2:
            self.held -= p[0].nbytes + p[1].nbytes
            return p
        at, n, kind = p
        self.file.seek(at)
        pos = np.frombuffer(self.file.read(n * kind.itemsize), kind)
        return pos, np.frombuffer(self.file.read(n), np.uint8)


def _minima(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Minimum of values[lo:hi] of each pair, lo < hi, from a doubling table."""
    if not len(lo):
        return np.zeros(0, np.uint8)
    level = np.frexp((hi - lo).astype(np.float64))[1] - 1
    out, table, width = np.empty(len(lo), np.uint8), values, 1
    for k in range(int(level.max()) + 1):
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(table[lo[at]], table[hi[at] - width])
        if len(table) > width:
            table = np.minimum(table[:-width], table[width:])
            width *= 2
    return out


class _Pass:
    """One scan in order: ``feed`` pushes the predecessors of the wanted type."""

    def __init__(self, text, wanted, sigma, cap, memory):
        self.text, self.wanted, self.cap = text, wanted, cap
        self.queues = Queues(sigma, memory)
        self.least = np.full(sigma, 255, np.uint8)  # minimum since the last push of each queue; 255: none yet
        self.fresh = np.ones(sigma, bool)

    def feed(self, pos: np.ndarray, lcp: np.ndarray) -> None:
        for i in range(0, len(pos), CHUNK):
            self._feed(pos[i : i + CHUNK], lcp[i : i + CHUNK])

    def _feed(self, pos, lcp):
        n = len(pos)
        before = pos - 1
        at = np.flatnonzero((pos > 0) & self.wanted[before])
        before = before[at]
        char = self.text[before]
        order = np.argsort(char, kind="stable")
        char, at, before = char[order], at[order], before[order]
        if not len(at):
            np.minimum(self.least, lcp.min(), out=self.least)
            return
        head = np.flatnonzero(np.concatenate([[True], char[1:] != char[:-1]])) if len(char) else np.zeros(0, np.int64)
        lo = np.zeros(len(at), np.int64)
        lo[1:] = at[:-1] + 1
        lo[head] = 0
        made = _minima(lcp, lo, at + 1)
        queues = char[head]
        made[head] = np.minimum(made[head], self.least[queues])
        made = np.minimum(made + np.uint8(1), np.uint8(self.cap))
        made[head[self.fresh[queues]]] = 0
        np.minimum(self.least, lcp.min(), out=self.least)
        ends = np.append(head[1:], len(char))
        after = np.full(len(queues), 255, np.uint8)
        last = at[ends - 1] + 1
        rest = np.flatnonzero(last < n)
        after[rest] = _minima(lcp, last[rest], np.full(len(rest), n))
        self.least[queues] = after
        self.fresh[queues] = False
        for q, a, e in zip(queues.tolist(), head.tolist(), ends.tolist()):
            self.queues.push(q, before[a:e], made[a:e])


def _refined(rank: np.ndarray, key_of, todo: np.ndarray) -> np.ndarray:
    """``rank`` with ties among ``todo`` broken by key_of(members); equal keys keep equal ranks.

    Ranks are dense only in order: a group's rank is the number of members before it.
    """
    key = key_of(todo)
    r = rank[todo]
    if not r.any():
        order = np.argsort(key)
    elif len(rank) < 1 << 31 and int(key.max()) < 1 << 32:
        order = np.argsort((r.astype(np.uint64) << np.uint64(32)) | key.astype(np.uint64))
    else:
        order = np.lexsort((key, r))
    members, key = todo[order], key[order]
    r = rank[members]
    new = np.ones(len(r), bool)
    new[1:] = r[1:] != r[:-1]
    begin = np.maximum.accumulate(np.where(new, np.arange(len(r)), 0))
    new[1:] |= key[1:] != key[:-1]
    here = np.maximum.accumulate(np.where(new, np.arange(len(r)), 0))
    out = rank.copy()
    out[members] = r + (here - begin)
    return out


def _tied(rank: np.ndarray, members: np.ndarray) -> np.ndarray:
    """The members that share their rank with another."""
    return members[np.bincount(rank[members], minlength=1)[rank[members]] > 1]


def _names(text, stype, stars):
    """Rank of each S* substring (with its end) among all, by rounds of six symbols."""
    ends = np.append(stars[1:], len(text) - 1)
    length = ends - stars + 1
    rank = np.zeros(len(stars), np.int64)
    todo, done = np.arange(len(stars)), 0
    wide = len(text) and int(text.max()) >= 511
    bits, step = (32, 1) if wide else (10, 6)
    while len(todo):
        def key(m, done=done):
            k = np.zeros(len(m), np.uint64)
            for j in range(done, done + step):
                at = stars[m] + j
                inside = j < length[m]
                at = np.where(inside, at, 0)
                k = (k << np.uint64(bits)) | np.where(inside, 2 * text[at].astype(np.int64) + stype[at] + 1, 0).astype(np.uint64)
            return k
        rank = _refined(rank, key, todo)
        done += step
        todo = _tied(rank, todo)
        todo = todo[length[todo] > done]
    return rank


def _by_doubling(rank: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of ranks (a rank: number of smaller symbols)."""
    width, n = 1, len(rank)
    todo = _tied(rank, np.arange(n))
    while len(todo) and width < n:
        def key(m, rank=rank, width=width):
            at = m + width
            return np.where(at < n, rank[np.minimum(at, n - 1)] + 1, 0)
        rank = _refined(rank, key, todo)
        todo = _tied(rank, todo)
        width *= 2
    return np.argsort(rank, kind="stable")


def _types(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each suffix is S-type, and the length of the run of its first character."""
    n = len(text)
    until = np.append(np.flatnonzero(text[1:] != text[:-1]), n - 1)
    length = np.diff(until, prepend=-1)
    rises = text[np.minimum(until + 1, n - 1)] > text[until]
    rises[-1] = True
    left = np.repeat(until + 1, length) - np.arange(n)
    return np.repeat(rises, length), left.astype(np.int32 if n < 1 << 31 else np.int64)


def _common(text, a, b, cap):
    """Common prefix, up to cap, of the suffixes at a and at b."""
    out = np.zeros(len(a), np.uint8)
    live = np.arange(len(a))
    n = len(text)
    for done in range(0, cap, 8):
        j = np.arange(done, min(done + 8, cap))
        x, y = a[live][:, None] + j, b[live][:, None] + j
        same = (text[np.minimum(x, n - 1)] == text[np.minimum(y, n - 1)]) & (x < n) & (y < n)
        run = np.cumprod(same, axis=1).sum(1)
        out[live] += run.astype(np.uint8)
        live = live[run == len(j)]
        if not len(live):
            break
    return out


def suffix_array(text: np.ndarray, sigma: int, cap: int = 50, memory: int = 64 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Sorted suffixes of ``text`` and the common prefix of each with the one before.

    ``text`` holds integers below ``sigma`` and ends with 0, which stands nowhere else.
    """
    n = len(text)
    stype, run = _types(text)
    ltype = ~stype
    star = stype.copy()
    star[1:] &= ltype[:-1]
    star[0] = False
    stars = np.flatnonzero(star)
    if n <= 1:
        return np.arange(n, dtype=np.int64), np.zeros(n, np.uint8)
    names = _names(text, stype, stars)
    if len(np.unique(names)) == len(names):
        order = np.argsort(names, kind="stable")
    else:
        dense = np.unique(names, return_inverse=True)[1].astype(np.int64)
        if int(dense.max()) + 2 <= LARGEST_ALPHABET and len(dense) < n:
            order = suffix_array(np.append(dense + 1, 0), int(dense.max()) + 2, 1, memory)[0][1:]
        else:
            order = _by_doubling(names)
    pos = stars[order].astype(np.int32 if n < 2**31 else np.int64)
    lcp = np.zeros(len(pos), np.uint8)
    for i in range(1, len(pos), CHUNK):
        lcp[i : i + CHUNK] = _common(text, pos[i - 1 : i - 1 + len(pos[i : i + CHUNK])].astype(np.int64), pos[i : i + CHUNK].astype(np.int64), cap)

    up = _Pass(text, ltype, sigma, cap, memory)
    first = np.searchsorted(text[pos], np.arange(sigma + 1))
    kept = Queues(sigma, memory)  # the L-type suffixes, for the pass down
    for c in range(sigma):
        tail = None
        for p, v in up.queues.take(c):
            kept.push(c, p, v)
            up.feed(p, v)
            tail = p[-1]
        a, e = int(first[c]), int(first[c + 1])
        if e > a:
            v = lcp[a:e].copy()
            v[0] = 0 if tail is None else min(cap, int(min(run[tail], run[pos[a]])))
            up.feed(pos[a:e], v)

    down = _Pass(text, stype, sigma, cap, memory)
    out_p, out_v = [], []
    for c in range(sigma - 1, -1, -1):
        falling_p, falling_v, tail = [], [], None
        for p, v in down.queues.take(c):
            falling_p.append(p)
            falling_v.append(v)
            down.feed(p, v)
            tail = p[-1]
        rising = list(kept.take(c))
        if rising:
            p, v = (np.concatenate(x) for x in zip(*rising))
            seam = 0 if tail is None else min(cap, int(min(run[tail], run[p[-1]])))
            back = np.concatenate([[np.uint8(seam)], v[:0:-1]]).astype(np.uint8)
            down.feed(p[::-1], back)
        if c == 0:  # the end of the text, which nothing induces
            falling_p, falling_v = [np.array([n - 1], pos.dtype)], [np.zeros(1, np.uint8)]
        if falling_p:
            p, v = np.concatenate(falling_p)[::-1], np.concatenate(falling_v)
            up_v = np.zeros(len(p), np.uint8)
            up_v[1:] = v[:0:-1]
            if rising:
                up_v[0] = seam
            out_p.append(p)
            out_v.append(up_v)
        if rising:
            p, v = (np.concatenate(x) for x in zip(*rising))
            out_p.append(p)
            out_v.append(v)
    return np.concatenate(out_p[::-1]), np.concatenate(out_v[::-1])

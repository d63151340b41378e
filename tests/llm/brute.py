"""Plain restatements of the operators' results, for small inputs."""

from __future__ import annotations

import collections
import hashlib
import re


def words(text: str | None) -> list[str]:
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def shingles(w: list[str]) -> collections.Counter:
    return collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else collections.Counter([tuple(w)] if w else [])


def components(rows: list[tuple[int, str]]) -> dict[int, tuple[int, int]]:
    """doc_id -> (set size, smallest doc_id reachable); ids are distinct."""
    sets = {i: set(shingles(words(t))) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = collections.defaultdict(list)
    for i in sorted(sets):
        common = collections.Counter(j for s in sets[i] for j in holders[s])
        for j, n in common.items():
            if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
        for s in sets[i]:
            holders[s].append(i)
    return {i: (len(sets[i]), find(i)) for i in sets}


def without_repeats(rows: list[tuple[int, str | None]], length: int = 50) -> dict[int, tuple]:
    """doc_id -> (bytes, removed, spans, SHA-256 of the rest); ids are distinct."""
    texts = sorted((i, (t or "").encode()) for i, t in rows)
    first: dict[bytes, int] = {}
    for i, t in texts:
        for k in range(len(t) - length + 1):
            first.setdefault(t[k : k + length], i)
    out = {}
    for i, t in texts:
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if first[t[k : k + length]] < i:
                gone[k : k + length] = b"\1" * length
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()
    return out


def without_repeated_lines(rows: list[tuple[int, str]]) -> dict[int, str]:
    """doc_id -> what line dedup leaves: runs of two full lines that were there before go, and single lines of 50 words; ids are distinct."""
    seen, out = set(), {}
    for i, t in sorted(rows):
        lines = t.split("\n")
        goes, last = [False] * len(lines), None
        for k, line in enumerate(lines):
            if not line:
                continue
            if len(re.findall(r"[^\x20\x09-\x0D]+", line)) >= 50:
                goes[k] = goes[k] or line in seen
                seen.add(line)
            if last is not None:
                if (lines[last], line) in seen:
                    goes[last : k + 1] = [True] * (k + 1 - last)
                seen.add((lines[last], line))
            last = k
        out[i] = "\n".join(x for x, g in zip(lines, goes) if not g)
    return out


def contamination(rows: list[tuple[int, str]], items: list[tuple[int, str]]) -> dict[tuple[int, int], tuple[float, int]]:
    """(doc_id, item_id) -> (best weighted Jaccard of a window as long as the item, its first word), if 0.8 or more."""
    out: dict = {}
    for i, t in rows:
        w = words(t)
        own = set(shingles(w))
        for item, text in items:
            iw = words(text)
            if not iw or (len(iw) >= 5 and len(own & set(shingles(iw))) * 2 < len(set(shingles(iw)))):
                continue
            for k in range(len(w) - len(iw) + 1):
                x, y = shingles(w[k : k + len(iw)]), shingles(iw)
                both = sum((x & y).values())
                s = both / (sum(x.values()) + sum(y.values()) - both)
                if s >= 0.8 and s > out.get((i, item), (0, 0))[0]:
                    out[i, item] = s, k
    return out

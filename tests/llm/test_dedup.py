"""Operators 3, 4 and 9 against plain restatements, and on awkward rows."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm import _tables as T
from llm import _words as W
from llm import induced_sort as I
from llm import jaccard_join as J
from llm import line_dedup as L
from llm import suffix_dedup as S
from tests.llm import brute
from tests.llm.conftest import SF

EMPTY = "doc_id long, text string"


def _sorted_suffixes(t, cap):
    sa = sorted(range(len(t)), key=lambda i: t[i:])
    lcp = [0]
    for i, j in zip(sa, sa[1:]):
        k = 0
        while k < cap and max(i, j) + k < len(t) and t[i + k] == t[j + k]:
            k += 1
        lcp.append(k)
    return sa, lcp


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=90), st.sampled_from([0, 1024]), st.sampled_from([64, 1 << 20]), st.sampled_from([5, 50]))
def test_suffix_array(values, alphabet, memory, cap):
    """Sorted suffixes and common prefixes, with and without recursion, with queues in memory and on disk."""
    t = values + [0]
    old, I.LARGEST_ALPHABET = I.LARGEST_ALPHABET, alphabet
    try:
        sa, lcp = I.suffix_array(np.array(t), 6, cap, memory)
    finally:
        I.LARGEST_ALPHABET = old
    assert (sa.tolist(), lcp.tolist()) == _sorted_suffixes(t, cap)


def test_suffix_array_of_runs():
    t = [1] * 3000 + [2] * 50 + [1] * 3000 + [0]
    sa, lcp = I.suffix_array(np.array(t), 3, 50, 256)
    assert (sa.tolist(), lcp.tolist()) == _sorted_suffixes(t, 50)


def test_repeated_bytes(spark, rows):
    got = {r.doc_id: tuple(r)[1:] for r in S.op3_suffix_array_dedup(spark, SF).collect()}
    assert got == brute.without_repeats(rows)


@pytest.mark.parametrize("batch, sort", [(2000, 1 << 20), (1 << 20, 300)])
def test_repeated_bytes_across_many_batches(spark, rows, monkeypatch, batch, sort):
    """Small batches and shards: shared passages with different surroundings, runs, and spilled queues."""
    monkeypatch.setattr(S, "BATCH", batch)
    passage = rows[0][1][:300]
    some = [(i, t[:1500]) for i, t in rows[:25]] + [(100 + k, f"{k} " * k + passage[k : 250 + k] + " end" * k) for k in range(12)]
    some += [(200, "a" * 400), (201, "a" * 90 + "b"), (202, "ab" * 200), (203, ""), (204, "x" * 49), (205, "x" * 49)]
    docs = spark.createDataFrame(some, EMPTY)
    got = {r.doc_id: tuple(r)[1:5] for r in S.repeated_removed(docs).collect()}
    assert got == brute.without_repeats(some)


def test_repeated_bytes_of_awkward_rows(awkward):
    got = [r.asDict() for r in S.repeated_removed(awkward).collect()]
    assert len(got) == awkward.count()
    by = lambda i: sorted((r["n_bytes"], r["n_removed"]) for r in got if r["doc_id"] == i)
    assert by(1) == [(109, 0), (109, 0)]  # equal ids don't cover each other
    assert by(2) == [(27, 0), (109, 109)] and by(None) == [(0, 0), (109, 109)] and by(4) == [(0, 0)]
    assert by(8)[0][1] >= by(7)[0][0]  # the shorter text is all of the longer one but its end
    assert S.repeated_removed(awkward.limit(0)).count() == 0


def test_line_dedup(spark, rows):
    got = {r.doc_id: r.text for r in L.op4_line_dedup(spark, SF).collect()}
    assert got == brute.without_repeated_lines(rows)


def test_line_chunks():
    long = b" ".join(b"w%d" % k for k in range(50))
    assert L.chunks([]) == L.chunks([b""]) == L.chunks([b"x"]) == [] and L.chunks([long]) == [(0, 1)]
    assert L.chunks([b"a", b"", b"b", long]) == [(0, 3), (2, 4), (3, 4)]
    assert L.chunks([long[:-1].rsplit(b" ", 1)[0]]) == []  # 49 words


@pytest.mark.parametrize("batch", [1500, 4 << 20])
def test_line_dedup_finds_passages(spark, monkeypatch, batch):
    """Passages of 1 long to 8 lines, verbatim inside otherwise different documents: all but the first lose them, and nothing else."""
    monkeypatch.setattr(L, "BATCH", batch)
    rng = np.random.default_rng(4)
    line = lambda n: " ".join("".join(rng.choice(list("abcdefghij"), 5)) for _ in range(n))
    passages = [[line(60)]] + [[line(int(rng.integers(1, 30))) for _ in range(n)] for n in range(2, 9)] + [[line(9), "", line(7)]]
    docs, want = [], {}
    for k in range(90):
        before, after = ([line(int(rng.integers(1, 20))) for _ in range(int(rng.integers(0, 5)))] for _ in range(2))
        passage = passages[k % 9]
        docs.append((k, "\n".join([*before, *passage, *after])))
        want[k] = "\n".join([*before, *(passage if k < 9 else []), *after])
    got = {r["row"].doc_id: r.text for r in L.dedup_lines(spark.createDataFrame(docs, EMPTY)).collect()}
    assert got == want


def test_first_occurrences_stay(spark):
    """Of every line at least one copy is left, however chunks overlap."""
    rng = np.random.default_rng(1)
    docs = [(k, "\n".join(rng.choice(["a", "b", "c", "", "d"], int(rng.integers(1, 12))))) for k in range(60)]
    got = {r["row"].doc_id: r.text for r in L.dedup_lines(spark.createDataFrame(docs, EMPTY)).collect()}
    assert got == brute.without_repeated_lines(docs)
    assert {x for t in got.values() for x in t.split("\n")} >= {"a", "b", "c", "d"}


def test_line_dedup_across_batches(spark, rows, monkeypatch):
    monkeypatch.setattr(L, "BATCH", 3000)
    some = rows[:60] + [(1000 + i, t) for i, t in rows[:20]]
    got = {r["row"].doc_id: r.text for r in L.dedup_lines(spark.createDataFrame(some, EMPTY)).collect()}
    assert got == brute.without_repeated_lines(some)


def test_line_dedup_of_awkward_rows(awkward):
    out = L.without_repeated_lines(awkward)
    assert out.schema.names == awkward.schema.names
    got = out.collect()
    kept = [r for r in got if r.text and r.text.startswith("One two")]
    texts = lambda i: [r.text for r in got if r.doc_id == i]
    assert len(kept) <= awkward.filter("text like 'One two%'").count()
    assert texts(3) == [None] and texts(4) == [""] and texts(5) == ["  \n\n "] and texts(6) == ["a"]
    assert L.dedup_lines(awkward.limit(0)).count() == 0


def test_components(spark, rows):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.op9_jaccard_join(spark, SF).collect()}
    assert got == brute.components(rows)


def test_components_of_families(spark, monkeypatch):
    """Chains and families of near copies, in tiles that are cut into blocks, with most shingles common."""
    monkeypatch.setattr(J, "TILE_ROWS", 8)
    monkeypatch.setattr(J, "SAMPLE", 1)
    monkeypatch.setattr(J, "COMMON", 3)
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in range(150)]
    texts, walk = [], list(base)
    for k in range(40):
        texts.append(" ".join(walk))
        walk[int(rng.integers(150))] = f"new{k}"
        if k % 3 == 0:
            walk.append(f"more{k}")
    for k in range(40):
        one = list(base)
        for j in rng.integers(0, 150, size=int(rng.integers(1, 5))):
            one[j] = f"v{k}-{j}"
        texts.append(" ".join(one))
    texts += ["a b c", "A  B\tC", "a b", "", "x"]
    docs = list(enumerate(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.near_duplicates(spark.createDataFrame(docs, EMPTY)).collect()}
    assert got == brute.components(docs)


def test_components_of_awkward_rows(awkward):
    got = J.near_duplicates(awkward).collect()
    assert len(got) == awkward.count()
    by = lambda i: sorted((r.n_shingles, r.component_id) for r in got if r.doc_id == i)
    assert by(1) == [(13, 1), (13, 1)] and by(2) == [(2, 2), (13, 1)]
    assert all(c is None for _, c in by(None)) and by(3) == [(0, 3)] and by(4) == [(0, 4)] and by(6) == [(1, 6)]
    assert by(8)[0][1] == 7
    assert J.near_duplicates(awkward.limit(0)).count() == 0


def test_one_of_each(awkward):
    out = J.one_of_each(awkward)
    assert out.schema.names == awkward.schema.names
    got = sorted((r.doc_id is None, r.doc_id or 0, (r.text or "")[:7]) for r in out.collect())
    assert got == sorted([(False, 1, "One two"), (False, 2, "another"), (False, 3, ""), (False, 4, ""), (False, 5, "  \n\n "), (False, 6, "a"),
                          (False, 7, "word0 a"), (False, 9, "!!! 123"), (True, 0, "One two"), (True, 0, "")])


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=1500), st.sets(st.integers(0, 2**64 - 1), max_size=300), st.integers(0, 300))
def test_bitmaps_never_rule_out_a_link(x, more, fewer):
    x = sorted(x)
    y = sorted(set(x[fewer % len(x) :]) | more)
    a, b = np.array(x, np.uint64), np.array(y or x, np.uint64)
    both = J.overlap(a, b)
    assert both == len(set(a.tolist()) & set(b.tolist()))
    if 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)):
        differ = J._Bitmaps([J.bitmap(a), J.bitmap(b)]).differ(np.array([0]), np.array([1]))[0]
        assert differ <= len(a) + len(b) - 2 * both


def test_prefixes_hold_a_common_shingle():
    for n in range(1, 200):
        for m in range(n, n * 5 // 4 + 1):
            least = -(-4 * (n + m) // 9)  # overlap of a link
            assert J.prefix_size(n) + least > n and J.prefix_size(m) + least > m


def test_word_hashes_follow_the_definition():
    import pyarrow as pa
    texts = ["A b\tc", "a B  c", "", "ä Ä", None, "a\x0bb\x0cc", "one two three four five six"]
    h, ws, we, first = W.words(pa.array([t.encode() if t is not None else None for t in texts], pa.binary()))
    assert np.diff(first).tolist() == [len(brute.words(t)) for t in texts]
    assert h[first[0] : first[1]].tolist() == h[first[1] : first[2]].tolist() == h[first[5] : first[6]].tolist()
    assert h[first[3]] != h[first[3] + 1]  # only A-Z are lower-cased
    sh, begin = W.shingles(h, first)
    assert np.diff(begin).tolist() == [1, 1, 0, 1, 0, 1, 2] and sh[0] == sh[1]


def test_components_helper(spark):
    chain = spark.createDataFrame([(k, k + 1) for k in range(20)] + [(100, 101), (101, 102), (102, 100)], "a long, b long")
    got = {r.node: r.component for r in T.components(chain).collect()}
    assert got == {**{k: 0 for k in range(21)}, 100: 100, 101: 100, 102: 100}
    assert T.components(chain.limit(0)).count() == 0
